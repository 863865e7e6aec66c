"""Registered queries: names, columns, and the DuckDB oracle where there is one."""

import duckdb
import pytest

import __spark_entry__ as E
from settlekit.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, rows_of

COLUMNS = {
    2: ["doc_id", "start", "n_tokens", "ids_crc32"],
    3: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    5: ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    6: ["doc_id", "held_out", "score", "predicted"],
    7: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    8: ["doc_id", "held_out", "score", "predicted"],
    9: ["doc_id", "n_shingles", "component_id"],
    10: ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    11: ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    12: ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    13: ["page_id", "url", "text", "n_chars"],
}


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE_SQL[name])
    assert found == rows_of([c[0] for c in res.description], res.fetchall())


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if int(n[2:].split("_")[0]) in (6, 7, 8, 10, 11, 12, 13)])
def test_columns_and_whole_tables(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    want = COLUMNS[int(name[2:].split("_")[0])]
    assert df.columns[:len(want)] == want
    table, key = {"op10": ("pages", "page_id"), "op12": ("conversations", "conv_id"), "op13": ("pages", "page_id")}.get(
        name.split("_")[0], ("documents", "doc_id"))
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(key).distinct().count()
