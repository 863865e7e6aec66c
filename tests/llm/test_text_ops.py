"""The operators on awkward documents, against brute force."""

import hashlib
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from settlekit.llm import (decision_lists, hilbert_pack, latent_decon, line_runs, parity_join, scan, suffix_cover,
                           token_files, tokens)
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark):
    return brute.table(spark)


@pytest.fixture(scope="module")
def empty(spark):
    return brute.table(spark, [])


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# -- scanning ----------------------------------------------------------------


def test_words_lines_and_shingles_are_those_of_the_text():
    rows = [t or "" for _, t in brute.texts()]
    j = scan.join([t.encode() for t in rows])
    start, end, doc = scan.words(j)
    raw = j.buf.tobytes()
    found = [[] for _ in rows]
    for a, z, d in zip(start, end, doc):
        found[d].append(raw[a:z].decode())
    assert found == [brute.words(t) for t in rows]
    c = scan.prefix_hash(j.buf)
    h = scan.span_hash(c, start, end)
    by_text = {}
    for a, z, x in zip(start, end, h):
        assert by_text.setdefault(raw[a:z], x) == x
    assert len(set(by_text.values())) == len(by_text)
    sh, owner = scan.shingles(h, doc, j.docs, 4)
    got, doc_of, _ = scan.distinct(sh, owner)
    assert [int((doc_of == k).sum()) for k in range(len(rows))] == [
        len(frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3)))) if (w := brute.words(t)) else 0
        for t in rows]


def test_slices_keep_the_arrays_of_many_texts_small():
    rng = np.random.default_rng(4)
    vocabulary = [f"word{k}" for k in range(5000)]
    texts = [" ".join(rng.choice(vocabulary, 200)) for _ in range(2000)]
    batch = pa.record_batch({"doc_id": pa.array(range(2000)), "text": pa.array(texts)})
    scan.powers(1 << 21)     # kept by the worker
    bands, rows = parity_join.Bands(parity_join.Rule()), 0
    tracemalloc.start()
    for part in scan.slices(batch):
        h, doc, n_docs = parity_join.sets_of(scan.payloads(part.column(1)), parity_join.Rule())
        parity_join.sketch_keys(h, doc, parity_join.fingerprints(h, doc, n_docs)[0], bands)
        rows += n_docs
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 2000 and peak < 12 << 20, peak


# -- op 1 --------------------------------------------------------------------


def test_line_runs(docs, spark):
    want = brute.line_dedup(brute.texts())
    rows = {r.doc_id: r for r in line_runs.report(docs).collect()}
    kept = {r.doc_id: r for r in line_runs.dedup(docs).collect()}
    assert sum(map(len, want.values())) > 80
    for d, text in brute.texts():
        lines = [] if text is None else text.split("\n")
        left = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in want[d])
        runs = sum(1 for i in want[d] if i - 1 not in want[d])
        r = rows[d]
        assert (r.n_lines, r.n_removed, r.n_runs) == (len(lines), len(want[d]), runs), d
        assert r.kept_sha256 == hashlib.sha256((left or "").encode()).hexdigest()
        assert kept[d].text == left and kept[d].part == "clash"
    assert line_runs.dedup(docs).columns == docs.columns


def test_runs_of_short_lines_are_deleted(spark):
    song = "\n".join(f"la {k}" for k in range(60))
    rows = [(1, "First.\n" + song), (2, song + "\nla 1\nla 2"), (3, "la 5\nla 6"), (4, "\n".join(["x"] * 250)), (None, song),
            (5, "x\n \n" * 99 + "a" * 5000 + "\n\n" + song.replace("la 30", "lo 30"))]
    got = {r.doc_id: r for r in line_runs.report(brute.table(spark, rows)).collect()}
    want = brute.line_dedup([(6 if d is None else d, t) for d, t in rows])
    assert {d: got[None if d == 6 else d].n_removed for d in want} == {d: len(x) for d, x in want.items()}
    assert (got[2].n_removed, got[3].n_removed, got[None].n_removed, got[4].n_removed) == (60, 0, 60, 249)


def test_line_runs_repeated_rows_nulls_and_empty_tables(spark, empty):
    rows = line_runs.report(brute.table(spark, repeated=True)).collect()
    ones = [r for r in rows if r.doc_id == 1]
    assert len(ones) == 2 and all(r.n_removed == 0 for r in ones)          # one document, twice
    null = [r for r in rows if r.doc_id is None]
    assert sorted(r.n_removed for r in null) == [0, 1]                     # BASE is later than in document 1
    assert line_runs.report(empty).count() == 0 and line_runs.dedup(empty).count() == 0


# -- op 2 --------------------------------------------------------------------


def test_token_files_round_trip(spark, docs, empty):
    ids_of = library("word_bpe_49k.json")
    path = token_files.write(docs, tokens.vocabulary("word_bpe_49k.json"), parts=3)
    got = {r.doc_id: r for r in token_files.with_starts(token_files.read_documents(spark, path)).collect()}
    start = 0
    for d, text in sorted(brute.texts()):
        ids = ids_of(text)
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), crc(ids)), d
        start += len(ids)
    path = token_files.write(empty, tokens.vocabulary("word_bpe_49k.json"))
    assert token_files.with_starts(token_files.read_documents(spark, path)).count() == 0


def test_token_files_null_and_repeated_ids(spark):
    rows = brute.table(spark, repeated=True)
    path = token_files.write(rows, tokens.vocabulary("word_bpe_49k.json"), parts=4)
    got = token_files.with_starts(token_files.read_documents(spark, path)).orderBy("start").collect()
    assert len(got) == rows.count()
    assert [r.doc_id for r in got[:2]] == [None, None]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("ids", [
    [], [5], [7] * 1000, list(range(5000)), [0, 2**32 - 1] * 300, [3] * 250 + [2**31], [1, 2, 3] * 85 + [60000]])
def test_pfor_segments(ids):
    counts = np.array([len(ids)]) if ids else np.array([0])
    blob = token_files.encode_segment(3, 9, [None], counts, np.array(ids, np.uint32)) + token_files.SEPARATOR.encode()
    [(part, first, doc_id, n, back)] = list(token_files.decode_file(blob))
    assert (part, first, doc_id, list(n), list(back)) == (3, 9, [None], list(counts), ids)
    with pytest.raises(ValueError):
        list(token_files.decode_file(blob[:-1] + b"?"))


# -- op 3 --------------------------------------------------------------------


def test_suffix_cover(docs, empty):
    want = brute.byte_dedup(brute.texts())
    got = suffix_cover.dedup(docs, with_bytes=True, parts=4).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
    assert suffix_cover.dedup(empty).count() == 0


def test_suffix_cover_many_copies_and_hot_grams(spark, monkeypatch):
    monkeypatch.setattr(suffix_cover.answer_grams, "__defaults__", (2,))   # grams of three blocks are hot
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdef"), 6))
    rows = [(d, " ".join([word() for _ in range(12)] + ([brute.PASSAGE] if d % 3 else [])
                         + [word() for _ in range(int(rng.integers(0, 20)))])) for d in range(60)]
    rows += [(d, rows[d % 5][1]) for d in range(60, 90)]
    want = brute.byte_dedup(rows)
    got = suffix_cover.dedup(brute.table(spark, rows), parts=8).collect()
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in got)


def test_suffix_cover_null_and_repeated_ids(spark):
    got = suffix_cover.dedup(brute.table(spark, repeated=True), parts=4).collect()
    null = sorted((r.n_bytes, r.n_removed) for r in got if r.doc_id is None)
    size = len(brute.BASE)
    assert null == [(0, 0), (size, size)]                                  # every other id is smaller
    assert [r.n_removed for r in got if r.doc_id == 1] == [0, 0]


def _sent(texts, buckets, hot=False):
    """Rows that a block sends where other blocks hold all of its grams, by bucket."""
    block = suffix_cover.Block(np.arange(len(texts)), [t.encode() for t in texts], suffix_cover.LENGTH, suffix_cover.GRAM)
    grams, inside, counted = suffix_cover._distinct_grams(block)
    codes = np.full(len(grams), suffix_cover.HOT if hot else suffix_cover.SHARED, np.uint8)
    rows, bucket, own = suffix_cover._suffixes(block, codes, grams, inside, counted, buckets)
    return np.bincount(bucket, minlength=buckets), suffix_cover.context_blobs(0, block, rows, bucket)


def test_suffix_cover_deals_samples_evenly():
    rng = np.random.default_rng(5)
    rows, blobs = _sent([" ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(3000)) for _ in range(12)], 40)
    assert rows.min() > 0 and rows.max() < 2 * rows.mean()
    assert max(map(len, blobs.values())) < 2 * sum(map(len, blobs.values())) / 40


@pytest.mark.parametrize("hot", [False, True])
def test_suffix_cover_sends_a_repeating_text_once(hot, monkeypatch):
    monkeypatch.setattr(suffix_cover, "SLICE_BYTES", 2000)     # copies lie in different slices too
    rows, _ = _sent(["the " * 2000, "lead " + "the " * 900] + ["x" + "the " * 400] * 20, 8, hot)
    assert rows.sum() < 120                                    # not one for each of some 500 samples a document


def test_suffix_cover_repeats_and_blocks_of_bounded_bytes(spark, monkeypatch):
    monkeypatch.setattr(suffix_cover, "BLOCK_BYTES", 4000)
    rows = [(d, f"{d % 7} own start {d * d}. " + "the " * (50 + 40 * (d % 5)) + f"tail {d % 3} " + brute.PASSAGE * (1 + d % 2))
            for d in range(40)]
    rows += [(None, "the " * 300 + brute.PASSAGE), (None, "null " * 60), (None, "null " * 50)]
    docs = brute.table(spark, rows)
    size = sum(len(t) for _, t in rows)
    least = suffix_cover.BLOCKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert suffix_cover._blocks(docs) == max(least, -(-size // 4000)) and size > 4000
    monkeypatch.setattr(suffix_cover, "BLOCK_BYTES", size // (2 * least))
    assert suffix_cover._blocks(docs) >= 2 * least             # by the text, not by the shuffle partitions
    want = brute.byte_dedup([r for r in rows if r[0] is not None])
    for parts in (2, 30):
        for hot in (2, 1 << 15):
            monkeypatch.setattr(suffix_cover.answer_grams, "__defaults__", (hot,))
            got = suffix_cover.dedup(docs, parts=parts).collect()
            assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in got if r.doc_id is not None)
            # rows without an id are later than all others, and leave each other alone
            assert sorted((r.n_bytes, r.n_removed) for r in got if r.doc_id is None) == [
                (250, 0), (300, 0), (1200 + len(brute.PASSAGE), 1200 + len(brute.PASSAGE))]


# -- op 4 --------------------------------------------------------------------


def test_latent_decon(spark, empty):
    item = ("which river rises in the high marsh above the old mill town and runs west past seven stone bridges "
            "before it meets the estuary near the lighthouse. it is the harrow water")
    second = "name the metal that boils at a lower heat than water freezes in the story of the glass mountain. quicksilver"
    words = item.split()
    para = " ".join(w if k % 6 else "some" for k, w in enumerate(words))
    noise = " ".join(f"filler{k} the of" for k in range(300))
    rows = [(1, noise + " " + item + " " + noise), (2, item.upper()), (3, para), (4, noise), (5, None), (6, ""),
            (7, " ".join(words[:9]) + " " + noise), (8, "lead " + second), (None, item), (1, item), (9, "the of and")]
    bench = spark.createDataFrame([(10, item), (11, second), (12, None), (13, ""), (10, item)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in latent_decon.find(brute.table(spark, rows), bench).collect()}
    assert found == {(1, 10), (2, 10), (3, 10), (8, 11)}
    kept = latent_decon.clean(brute.table(spark, rows), bench)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 4), (False, 5), (False, 6), (False, 7), (False, 9), (True, 0)]
    assert kept.columns == brute.table(spark, []).columns
    assert latent_decon.find(empty, bench).count() == 0
    assert latent_decon.find(brute.table(spark, rows), bench.limit(0)).count() == 0


def test_latent_decon_in_blocks_of_items(spark):
    rng = np.random.default_rng(1)
    make = lambda: " ".join(f"w{x}" for x in rng.integers(0, 5000, 25))
    items = [(k, make()) for k in range(7)]
    rows = [(k, make() + " " + items[k % 7][1] + " " + make()) for k in range(21)]
    found = latent_decon.find(brute.table(spark, rows),
                              spark.createDataFrame(items, "item_id long, text string"), block_items=3)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(k, k % 7) for k in range(21)}


def test_latent_decon_long_items(spark):
    rng = np.random.default_rng(2)
    make = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 5000, n))
    items = [(k, make(n)) for k, n in enumerate((300, 180, 65, 30, 900))]
    rows = [(k, make(77) + " " + t + " " + make(50)) for k, t in items] + [(9, make(2000))]
    found = latent_decon.find(brute.table(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.lcs) for r in found.collect()} == {(k, k, 1.0) for k in range(5)}


def test_latent_decon_rarest_words_replaced(spark):
    rng = np.random.default_rng(3)
    common = lambda n: " ".join(f"c{x}" for x in rng.integers(0, 150, n))
    items, rows = [], [(100 + k, common(90)) for k in range(60)]
    for k in range(6):
        words = common(40).split()
        rare = [f"rare{k}x{x}" for x in range(8)]                # in the corpus once, or nowhere
        where = rng.permutation(40)[:8]
        for x, w in zip(where, rare):
            words[x] = w
        items.append((k, " ".join(words)))
        if k % 2:
            rows.append((200 + k, " ".join(rare) + " " + common(80)))
        for x in where:
            words[x] = "else"
        rows.append((k, common(70) + " " + " ".join(words) + " " + common(70)))
    found = latent_decon.find(brute.table(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    spans = lambda t: [t[max(a, 0):a + 128] for a in range(-64, len(t), 32)]
    want = {(d, k) for d, t in rows for k, i in items for s in spans(latent_decon.words_of(t))
            if latent_decon.common(latent_decon.words_of(i), s) >= 0.75 * 40}
    assert want >= {(k, k) for k in range(6)}
    assert {(r.doc_id, r.item_id) for r in found.collect() if r.lcs >= 0.75} == want


def test_latent_decon_finds_paraphrases_through_the_latent_space(spark, monkeypatch):
    """Half of the question's words are replaced, the answer stays; without the basis nothing is found."""
    rng = np.random.default_rng(11)
    pick = lambda n: [f"w{x}" for x in rng.integers(0, 4000, n)]
    items, rows = [], [(1000 + k, " ".join(pick(200))) for k in range(60)]
    for k in range(12):
        question, answer = pick(22), pick(7)
        items.append((k, " ".join(question) + ". " + " ".join(answer)))
        half = [w if x % 2 else f"else{k}x{x}" for x, w in enumerate(question)]
        rows.append((k, " ".join(pick(60) + half + answer + pick(60))))
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), brute.table(spark, rows)
    found = {(r.doc_id, r.item_id): r for r in latent_decon.find(docs, bench).collect()}
    assert len(found.keys() & {(k, k) for k in range(12)}) >= 11 and found.keys() <= {(k, k) for k in range(12)}
    assert all(r.lcs < latent_decon.WEAK + 0.05 and r.answer == 1.0 for r in found.values())
    whole = latent_decon.latent_basis
    monkeypatch.setattr(latent_decon, "latent_basis", lambda *a, **k: np.zeros_like(whole(*a, **k)))
    assert latent_decon.find(docs, bench).count() == 0


def test_latent_decon_recall_of_the_lexical_reference(spark):
    """Every pair that holds three quarters of an item in order, by trying all spans of all documents."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = [(i, set(i.words)) for i in latent_decon.items_of([(r.item_id, r.text) for r in bench.collect()])]
    want = set()
    for r in table.collect():
        words = latent_decon.words_of(r.text or "")
        for a in range(0, max(1, len(words)), 32):
            span = words[a:a + 128]
            held = set(span)
            for i, own in items:
                if 4 * len(own & held) >= 2 * len(own) and latent_decon.common(i.words, span) >= 0.75 * len(i.words):
                    want.add((r.doc_id, i.item_id))
    found = {(r.doc_id, r.item_id) for r in latent_decon.find(table, bench).collect()}
    assert len(want) >= 20 and len(found & want) >= 0.9 * len(want)


def test_all_texts_of_an_item_are_searched(spark):
    rows = [(1, "before " + "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "nothing here"),
            (3, "one two three four five six seven eight nine ten eleven twelve thirteen after")]
    items = [(5, rows[0][1][7:]), (5, rows[2][1][:-6]), (5, None), (6, "")]
    for block in (1, 2, 100):
        found = latent_decon.find(brute.table(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block)
        assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(1, 5), (3, 5)]


def test_randomised_svd_spans_the_leading_singular_vectors(spark):
    rng = np.random.default_rng(4)
    topic = rng.integers(0, 50, (8, 12))
    rows = [topic[k % 8][rng.integers(0, 12, 10)].astype("<i4").tobytes() for k in range(300)]
    items = [topic[k].astype("<i4").tobytes() for k in range(3)]
    idf = rng.random(50) + 0.5

    def dense(words):
        r, c, v = latent_decon._weights(words, idf)
        out = np.zeros((len(words), 50))
        out[r, c] = v
        return out

    a = np.concatenate([dense(rows), np.sqrt(300) * dense(items)])
    table = spark.createDataFrame([(bytearray(w),) for w in rows], "words binary").repartition(3)
    m = rng.random((50, 4))
    assert np.allclose(latent_decon.gram_times(table, idf, m), dense(rows).T @ (dense(rows) @ m))
    basis = latent_decon.latent_basis(table, items, idf, rank=6, power=2)
    lead = np.linalg.svd(a, full_matrices=False)[2][:6]
    assert basis.shape == (50, 6) and np.linalg.svd(lead @ basis)[1].min() > 0.95


def test_latent_basis_takes_little_of_the_drivers_memory(spark, monkeypatch):
    rng = np.random.default_rng(2)
    idf = rng.random(4000) + 0.5
    rows = [rng.integers(0, 4000, 50).astype("<i4").tobytes() for _ in range(300)]
    items = [rng.integers(0, 4000, 40).astype("<i4").tobytes() for _ in range(200)]
    table = spark.createDataFrame([(bytearray(w),) for w in rows], "words binary")
    tracemalloc.start()
    basis = latent_decon.latent_basis(table, items, idf, rank=20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20
    monkeypatch.setattr(latent_decon, "ENTRIES", 1 << 20)
    again = latent_decon.latent_basis(table, items, idf, rank=20)
    assert np.allclose(basis @ (basis.T @ again), again) and np.allclose(basis.T @ basis, np.eye(20))


def test_products_and_orthonormal_columns_by_blocks(monkeypatch):
    monkeypatch.setattr(latent_decon, "ENTRIES", 16)
    rng = np.random.default_rng(3)
    a = rng.random((30, 70)) * (rng.random((30, 70)) < 0.3)
    sparse = *np.nonzero(a), a[np.nonzero(a)]
    m = rng.random((70, 20))
    assert np.allclose(latent_decon._rows_times(sparse, 30, m), a @ m)
    back = latent_decon._transposed(sparse)
    assert np.allclose(latent_decon._rows_times(back, 70, a @ m, m.copy()), m + a.T @ (a @ m))
    for v, wide in ((70, 20), (70, 5), (20, 20), (7, 7)):      # blocks of fewer rows than columns, too
        m = rng.random((v, wide))
        q = latent_decon.orthonormal(m.copy())
        assert np.allclose(q.T @ q, np.eye(wide)) and np.allclose(q @ (q.T @ m), m)


def test_common_subsequence():
    def slow(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for k, y in enumerate(b):
                t[i + 1][k + 1] = t[i][k] + 1 if x == y else max(t[i][k + 1], t[i + 1][k])
        return t[-1][-1]

    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = ([b"%d" % x for x in rng.integers(0, 5, rng.integers(1, 90))] for _ in range(2))
        assert latent_decon.common(a, b) == slow(a, b)


# -- op 5 --------------------------------------------------------------------


def check_pieces(pieces, rows):
    ids_of = library("byte_bpe_50k.json")
    want = sorted((d is None, d or 0, len(i), crc(i)) for d, t in rows for i in [ids_of(t)])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.doc_tokens, 0) for r in pieces if r.start == 0)
    assert [x[:3] for x in want] == [x[:3] for x in got]
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 2048 or at & (at - 1) == 0


def test_hilbert_pack(spark, docs, empty):
    rows = brute.texts() + [(100 + k, f"row {k} " * (k % 50)) for k in range(120)]
    pieces = hilbert_pack.pack(brute.table(spark, rows), tokens.vocabulary("byte_bpe_50k.json"), with_ids=True,
                               parts=3).collect()
    check_pieces(pieces, rows)
    ids_of = library("byte_bpe_50k.json")
    by_doc = {}
    for r in sorted(pieces, key=lambda r: r.start):
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert r.start == len(by_doc.setdefault(r.doc_id, [])) and crc(ids) == r.ids_crc32
        by_doc[r.doc_id] += ids
    assert by_doc == {d: ids_of(t) for d, t in rows}
    assert hilbert_pack.pack(empty, tokens.vocabulary("byte_bpe_50k.json")).count() == 0


def test_hilbert_pack_null_and_repeated_ids(spark):
    rows = brute.texts() + [(None, brute.BASE), (None, None), (1, brute.BASE), (9, "one two three"), (9, "four five six")]
    check_pieces(hilbert_pack.pack(brute.table(spark, repeated=True), tokens.vocabulary("byte_bpe_50k.json"),
                                   parts=3).collect(), rows)


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_steps_to_neighbours(dims, bits):
    axes = np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")
    points = np.stack([a.reshape(-1) for a in axes], 1)
    place = hilbert_pack.hilbert_index(points, bits)
    assert sorted(place) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(place)], axis=0)).sum(1) == 1).all()


# -- op 7 --------------------------------------------------------------------


def test_decision_list_statistics(docs, empty):
    got = {r.doc_id: r for r in decision_lists.statistics(docs).collect()}
    for d, text in brute.texts():
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality_counts(text), d
    assert decision_lists.statistics(empty).count() == 0


def test_decision_list_learns_conjunctions(spark):
    rng = np.random.default_rng(7)
    rows, labels = [], []
    for d in range(900):
        n = int(rng.integers(60, 120))
        w = [f"word{x}" for x in rng.integers(0, 3000, n)]
        kind = d % 3
        if kind == 1:                                      # many symbols: bad
            w = [x + "#" if rng.random() < 0.5 else x for x in w]
        if kind == 2 and d % 2:                            # few symbols: fine
            w[0] += "#"
        rows.append((d, " ".join(w)))
        labels.append((d, int(kind != 1), 0))
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    stats = decision_lists.statistics(brute.table(spark, rows))
    rules = decision_lists.learn(stats, y)
    judged = decision_lists.judge(stats, rules).collect()
    assert rules and all(r.kept == (r.doc_id % 3 != 1) for r in judged)
    assert decision_lists.learn(stats, y.limit(0)) == []
    assert decision_lists.learn(stats, y.filter("quality = 1")) == []
    nothing = decision_lists.judge(stats, []).collect()
    assert all(r.kept != r.base_failed for r in nothing)


# -- op 9 --------------------------------------------------------------------


@pytest.mark.parametrize("rule", [parity_join.Rule(4, 85, 100), parity_join.Rule(5, 80, 100)])
def test_parity_join(docs, rule):
    want = brute.components(brute.texts(), rule.k, rule.p, rule.q)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.near_duplicates(docs, rule).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(want) - 2


def test_parity_join_finds_every_link_of_edited_copies(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(12):
        n = int(rng.integers(8, 260))
        base = [f"w{x}" for x in rng.integers(0, 900, n)]
        for _ in range(int(rng.integers(2, 14))):
            w = list(base)
            for _ in range(int(rng.integers(0, max(2, n // 40) + 1))):
                w[int(rng.integers(0, len(w)))] = f"e{rng.integers(0, 9)}"
            if rng.random() < 0.3:
                w += [f"t{x}" for x in rng.integers(0, 99, max(1, n // 20))]
            rows.append((len(rows), " ".join(w)))
    rule = parity_join.Rule()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           parity_join.near_duplicates(brute.table(spark, rows), rule).collect()}
    assert got == brute.components(rows, 4, 85, 100)


def test_sketches_share_enough_keys():
    rule, rng = parity_join.Rule(), np.random.default_rng(2)
    bands = parity_join.Bands(rule)
    for n in (7, 8, 11, 12, 13, 20, 40, 90, 300, 1500):
        for _ in range(20):
            a = rng.integers(1, 2**63, n, dtype=np.uint64)
            most = (rule.q - rule.p) * 2 * n // (rule.q + rule.p)
            b = np.concatenate([a[most // 2:], rng.integers(1, 2**63, most - most // 2, dtype=np.uint64)])
            both = len(np.intersect1d(a, b))
            if not rule.linked(both, len(a), len(b)) or set(a) == set(b):
                continue
            keys = []
            for s in (np.sort(a), np.sort(b)):
                key, _, tag = parity_join.sketch_keys(s, np.zeros(len(s), np.int64), np.array([len(s)]), bands)
                keys.append((key, tag))
            shared = np.intersect1d(keys[0][0], keys[1][0])
            assert len(shared)
            for key, tag in keys:      # a label with the keys that its tag promises
                hit = np.isin(key, shared)
                assert any(hit[tag == t].sum() >= t % 4096 for t in np.unique(tag))


def _family(rng, size: int, members: int, changed: float) -> list[np.ndarray]:
    """Sets of a family: each is the base with a share of its hashes replaced."""
    base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
    out = []
    for _ in range(members):
        keep = base[rng.random(len(base)) > rng.random() * changed]
        out.append(np.unique(np.concatenate([keep, rng.integers(0, 2**64, len(base) - len(keep), dtype=np.uint64)])))
    return out


def test_blocks_of_a_bucket_keep_every_linked_pair_and_few_others(monkeypatch):
    rule, rng = parity_join.Rule(5, 80, 100), np.random.default_rng(6)
    sets = _family(rng, 300, 120, 0.5)
    n = np.array([len(s) for s in sets])
    doc = np.repeat(np.arange(len(sets)), n)
    bits = parity_join.bit_sketches(np.concatenate(sets), doc, len(sets)).view(np.uint64)
    comp, side = rng.integers(0, 100, len(sets)), rng.integers(0, 2, len(sets))
    linked = {(i, j) for i in range(len(sets)) for j in range(i)
              if rule.linked(len(np.intersect1d(sets[i], sets[j])), n[i], n[j]) and comp[i] != comp[j]}
    assert len(linked) > 50
    for tried in (1, 300, 1 << 17):
        monkeypatch.setattr(parity_join, "TRIED", tried)
        for part, wanted in ((None, linked), (side, {(i, j) for i, j in linked if side[i] != side[j]})):
            i, j = parity_join.block_pairs(np.arange(len(sets)), comp, n, bits, part, rule)
            got = [(max(x), min(x)) for x in zip(i.tolist(), j.tolist())]
            assert len(got) == len(set(got)) and wanted <= set(got)
            assert len(got) < 3 * len(wanted) and all(part is None or part[a] != part[b] for a, b in got)


def test_wide_sketches_differ_in_no_more_bits_than_the_sets():
    rng, rule = np.random.default_rng(7), parity_join.Rule(5, 80, 100)
    assert parity_join.wide_sketch(np.arange(512, dtype=np.uint64)) is None
    sets = _family(rng, 4000, 12, 1.0) + _family(rng, 5000, 4, 1.0)
    wide = [parity_join.wide_sketch(s) for s in sets]
    assert len({len(w) for w in wide}) == 2
    for a, x in zip(sets, wide):
        for b, y in zip(sets, wide):
            apart, both = parity_join.wide_apart(x, y), len(np.intersect1d(a, b))
            assert apart <= len(a) + len(b) - 2 * both
            if 2 * both < len(a) + len(b) - 2 * both:   # far from linked: ruled out, though 2048 bits are full
                assert apart * (rule.q + rule.p) > (len(a) + len(b)) * (rule.q - rule.p)


def test_last_round_of_the_parity_join_tries_all_pairs_but_the_hubs_in_blocks(spark, monkeypatch):
    rule, rng = parity_join.Rule(5, 80, 100), np.random.default_rng(8)
    sets = _family(rng, 300, 40, 0.25)
    n = [len(s) for s in sets]
    bits = parity_join.bit_sketches(np.concatenate(sets), np.repeat(np.arange(40), n), 40)
    names = ["node", "n", *[f"s{k}" for k in range(parity_join.WORDS)]]
    sketches = spark.createDataFrame([(k, n[k], *map(int, bits[k])) for k in range(40)],
                                     ", ".join(f"{c} long" for c in names))
    rows = [(1, k, k // 2) for k in range(40)] + [(2, k, k // 2) for k in range(3)] + [(3, 5, 2), (3, 9, 4)]
    members = spark.createDataFrame(rows, "key long, node long, component long")
    hubs = {k: set() for k in (1, 2, 3)}
    for turn in (0, 1):
        for r in members.groupBy("key").agg(parity_join._hub(turn).alias("h")).collect():
            hubs[r.key].add(r.h.hub)
    linked = {(j, i) for i in range(40) for j in range(i) if i // 2 != j // 2
              and rule.linked(len(np.intersect1d(sets[i], sets[j])), n[i], n[j]) and not {i, j} & hubs[1]}
    assert len(linked) > 20
    for block in (5, 2048):     # eight parts of the first bucket, or one
        monkeypatch.setattr(parity_join, "BLOCK", block)
        found = [tuple(r) for r in parity_join.bucket_pairs(members, sketches, 2, rule).collect()]
        pairs = [(min(a, b), max(a, b)) for a, b, _, _ in found]
        assert linked <= set(pairs) and len(pairs) == len(set(pairs))
        assert all(ca == a // 2 and cb == b // 2 and ca != cb and not {a, b} & hubs[1] for a, b, ca, cb in found)


def test_parity_join_null_repeated_and_empty(spark, empty):
    rule = parity_join.Rule()
    table = brute.table(spark, repeated=True)
    got = parity_join.near_duplicates(table, rule).collect()
    assert len(got) == table.count()
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert {r.component_id for r in got if r.doc_id in (1, 4)} == {1}
    kept = parity_join.keep_first(table, rule)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == table.columns and ids.count(None) == 2
    assert sorted(i for i in ids if i is not None) == sorted(
        {r.doc_id for r in got if r.doc_id is not None and r.component_id == r.doc_id})
    assert parity_join.near_duplicates(empty, rule).count() == 0 and parity_join.keep_first(empty, rule).count() == 0


def test_latent_decon_is_fitted_on_the_passages_of_all_documents(spark, monkeypatch):
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60, rng.integers(1, 200))) for _ in range(2_300)]
    item = " ".join(f"w{x}" for x in range(60))
    monkeypatch.setattr(latent_decon, "FREQUENT", 20)
    idf = {}
    whole = latent_decon.latent_basis

    def spied(rows, items, weight, **k):
        m = rng.random((60, 3))
        idf.update(n=latent_decon.passage_count(rows), m=m, weight=weight, products=[
            latent_decon.gram_times(rows, weight, m, k["kind"]),
            latent_decon.products(latent_decon.gram(rows, weight, k["kind"]), weight, m)])
        return whole(rows, items, weight, **k)

    monkeypatch.setattr(latent_decon, "latent_basis", spied)
    latent_decon.find(brute.table(spark, list(enumerate(texts))), spark.createDataFrame([(1, item)], "item_id long, text string"))
    vocabulary = latent_decon.Vocabulary(latent_decon.hashes(latent_decon.words_of(item)))
    passages = []
    for t in texts:
        word = vocabulary.find(latent_decon.hashes(latent_decon.words_of(t)))[1].astype("<i4")
        passages += [word[a:a + 64].tobytes() for a in range(0, len(word), 32)]
    assert idf["n"] == len(passages)
    r, c, v = latent_decon._weights(passages, idf["weight"])
    a = np.zeros((len(passages), 60))
    a[r, c] = v
    assert all(np.allclose(x, a.T @ (a @ idf["m"]), rtol=1e-4) for x in idf["products"])
