"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

The sequence of a document is its lines that hold a word, short ones too. A run of
consecutive sequence lines counts when it has ``min_run`` characters in all.
Every line that lies in a counting run which also starts earlier (in the order of
doc_id, then place in the document) is deleted; the maximal runs that go are the
unions of overlapping counting runs. Single short lines stay, as they are no
counting run; lines without a word stay and break no run.

Ranks: the distinct repeated lines are sorted and numbered; a doubling round
numbers the sorted distinct pairs (rank at k, rank at k + 2**h), the order of the
suffixes by their first 2**(h + 1) lines, for the stretches of repeated lines that
hold a run of so many lines; it ends when no stretch does. The suffixes with a
common prefix of n lines, an LCP interval, are those with one pair (rank at k,
rank at k + n - 2**h), 2**h <= n < 2**(h + 1). Every counting run is covered by the
shortest counting runs from its starts and to its ends, and those are told by the
sizes of their own lines, so each line gives two of them at most; the earliest
suffix of an interval keeps its lines, the others lose them.

DataFrame functions only. Groups are counted with map-side combining and
joined back, so a line that a third of the documents share is a skewed join.

Defined results: a null text has no lines and stays null, an empty text has one
empty line. A null doc_id comes after all others. Rows with one doc_id are
ordered by a hash of their text; rows equal in both are one document and get
the same answer. An empty table gives an empty result. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settlekit.llm.folds import fresh
from settlekit.operators.joins import join_small_side
from settlekit.session import drop_tables, stage_table

MIN_RUN = 100
SMALL_ROWS = 500_000    # documents with deletions whose line numbers may be broadcast

DOC = ["_none", "_id", "_hash"]   # _none: the id is null (and _id 0)


def _numbered(pairs: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The keys that occur twice or more with an order-preserving number ``name``."""
    twice = pairs.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys)
    ranked = twice.orderBy(*keys).withColumn(name, F.monotonically_increasing_id())
    return stage_table(ranked, "line-ranks")  # written once: numbers must not change on a retry


WORD = "[^ \\t-\\r]"   # a character of a word


def sequences(docs: DataFrame) -> DataFrame:
    """_none, _id, _hash, k (place in the sequence), i (line number), size, h1, h2 of each line with a word."""
    lines = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("i"), line.alias("line")))
    said = F.filter(lines, lambda x: F.rlike(x["line"], F.lit(WORD)))
    return (docs.filter(F.col("text").isNotNull())
            .select(F.col("doc_id").isNull().alias("_none"),
                    F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)).alias("_id"),
                    F.xxhash64("text").alias("_hash"), F.posexplode(said).alias("k", "x"))
            .select(*DOC, "k", F.col("x.i").alias("i"), F.char_length("x.line").alias("size"),
                    F.xxhash64("x.line").alias("h1"), F.hash("x.line").alias("h2")))


STRETCH = [*DOC, "stretch"]   # consecutive repeated lines of a document


def _shortest_runs(live: DataFrame, min_run: int) -> DataFrame:
    """(stretch, k, n) of the shortest counting runs from each line and to each line.

    The run from line k ends where the characters before the next line reach
    ``min_run`` more than those before k: lines and such goals are sorted together, and
    a running last value gives each goal its line. No window looks at more.
    """
    runs = Window.partitionBy(*STRETCH)
    upto = F.sum("size").over(runs.orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    placed = live.select(*STRETCH, "k", "size", upto.alias("end")).withColumn("begin", F.col("end") - F.col("size"))
    none = F.lit(None).cast("int")
    # kind 0 gives a place, 1 asks for one; each line's end is the begin of the next
    goal = placed.select(*STRETCH, F.explode(F.array(
        F.struct(F.col("end").alias("at"), F.lit(0).alias("kind"), F.col("k").alias("k"), none.alias("asker")),
        F.struct((F.col("begin") + min_run).alias("at"), F.lit(1).alias("kind"), none.alias("k"), F.col("k").alias("asker")),
    )).alias("x")).select(*STRETCH, "x.*")
    # the first line that ends at the goal or later
    found = F.last("k", ignorenulls=True).over(runs.orderBy(F.desc("at"), "kind").rowsBetween(Window.unboundedPreceding, 0))
    forward = goal.withColumn("last", found).filter("kind = 1 AND last IS NOT NULL").select(
        *STRETCH, F.col("asker").alias("k"), (F.col("last") - F.col("asker") + 1).alias("n"))
    goal = placed.select(*STRETCH, F.explode(F.array(
        F.struct(F.col("begin").alias("at"), F.lit(0).alias("kind"), F.col("k").alias("k"), none.alias("asker")),
        F.struct((F.col("end") - min_run).alias("at"), F.lit(1).alias("kind"), none.alias("k"), F.col("k").alias("asker")),
    )).alias("x")).select(*STRETCH, "x.*")
    found = F.last("k", ignorenulls=True).over(runs.orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0))
    backward = goal.withColumn("first", found).filter("kind = 1 AND first IS NOT NULL").select(
        *STRETCH, F.col("first").alias("k"), (F.col("asker") - F.col("first") + 1).alias("n"))
    return forward.unionByName(backward).distinct()


def deleted_lines(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """_id, _hash, lines (sorted numbers of the lines to delete) of documents that lose any."""
    lines = sequences(docs)
    ids = _numbered(lines, ["h1", "h2"], "r0")
    live = lines.join(ids, ["h1", "h2"]).select(*DOC, "k", "i", "size", "r0").dropDuplicates([*DOC, "k"])
    number = F.row_number().over(Window.partitionBy(*DOC).orderBy("k"))
    live = stage_table(live.withColumn("stretch", F.col("k") - number), "line-live")
    runs = stage_table(_shortest_runs(live, min_run), "line-runs")
    drop_tables(ids)

    here = Window.partitionBy(*STRETCH).orderBy("k")
    level, ranks, windows = 0, live.select(*STRETCH, "k", F.col("r0").alias("rank")), None
    while True:
        step = 2 ** level
        # windows of n lines, step <= n < 2 * step: the pair of their first and their last step lines
        now = runs.filter((F.col("n") >= step) & (F.col("n") < 2 * step))
        head = now.join(ranks.withColumnRenamed("rank", "a"), [*STRETCH, "k"]).withColumn("k2", F.col("k") + F.col("n") - step)
        tail = ranks.select(*STRETCH, F.col("k").alias("k2"), F.col("rank").alias("b"))
        part = stage_table(head.join(tail, [*STRETCH, "k2"]).select(*STRETCH, "k", "n", "a", "b"), "line-windows")
        windows = part if windows is None else windows.unionByName(part)
        longer = runs.filter(F.col("n") >= 2 * step).select(*STRETCH).distinct()
        longer = stage_table(longer, "line-longer")
        if longer.isEmpty():
            break
        # prefix doubling, in the stretches that hold a longer run
        pairs = (ranks.join(longer, STRETCH, "left_semi").withColumn("next", F.lead("rank", step).over(here))
                 .withColumn("far", F.lead("k", step).over(here)).filter(F.col("far") == F.col("k") + step))
        pairs = stage_table(pairs.select(*STRETCH, "k", "rank", "next"), "line-pairs")
        names = _numbered(pairs, ["rank", "next"], "name")
        ranks = stage_table(pairs.join(names, ["rank", "next"]).select(*STRETCH, "k", F.col("name").alias("rank")),
                            "line-doubled")
        drop_tables(pairs, names, longer)
        level += 1

    order = F.struct(F.col("_none").alias("z"), F.col("_id").alias("d"), F.col("_hash").alias("t"), F.col("k").alias("p"))
    interval = ["n", "a", "b"]
    first = (windows.groupBy(*interval).agg(F.min(order).alias("first"), F.max(order).alias("last"))
             .filter(F.col("first") != F.col("last")).select(*interval, "first"))
    later = windows.join(first, interval).filter(order != F.col("first")).select(
        *STRETCH, F.explode(F.sequence(F.col("k"), F.col("k") + F.col("n") - 1)).alias("k")).distinct()
    return (later.join(live.select(*STRETCH, "k", "i"), [*STRETCH, "k"])
            .groupBy(*DOC).agg(F.sort_array(F.collect_list("i")).alias("lines"))
            .select(F.when(~F.col("_none"), F.col("_id")).alias("_id"), "_hash", "lines"))


def annotate(docs: DataFrame, min_run: int = MIN_RUN) -> tuple[DataFrame, str]:
    """The rows with the numbers of the lines to delete (null for none), and that column's name."""
    id_, hash_, key, lines = fresh(docs, "_id", "_hash", "_key", "_lines")
    found = stage_table(deleted_lines(docs.select("doc_id", "text"), min_run), "line-deletions")
    found = found.select(F.col("_id").alias(id_), F.col("_hash").alias(hash_), F.col("lines").alias(lines))
    on = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(hash_))
    rows = join_small_side(docs.withColumn(key, F.xxhash64("text")), found, on, "left", max_rows=SMALL_ROWS)
    return rows.drop(key, id_, hash_), lines


def kept_text(lines: str):
    """The text without the lines whose numbers the column ``lines`` holds."""
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(lines, i))
    return F.when(F.col(lines).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))


def dedup(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` with the repeated line runs gone from ``text``; all columns kept."""
    rows, lines = annotate(docs, min_run)
    return rows.withColumn("text", kept_text(lines)).select(*docs.columns)


def report(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs (maximal removed runs), kept_sha256 of every row."""
    rows, lines = annotate(docs.select("doc_id", "text"), min_run)
    # the deleted lines are sorted: a run starts where the line before isn't deleted
    heads = F.filter(lines, lambda x, i: (i == 0) | (F.get(lines, i - 1) != x - 1))
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"),
        F.when(F.col(lines).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_removed"),
        F.when(F.col(lines).isNull(), 0).otherwise(F.size(heads)).cast("long").alias("n_runs"),
        F.sha2(F.coalesce(kept_text(lines), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def oracle_sql(min_run: int = MIN_RUN) -> str:
    """DuckDB SQL for ``report`` over ``documents`` with distinct ids: the text of the shortest counting runs from
    and to every line, grouped."""
    return f"""
    WITH lines AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
      FROM documents WHERE text IS NOT NULL),
    seq AS (
      SELECT doc_id, i, line, length(line) AS size, row_number() OVER s AS k, sum(length(line)) OVER s AS upto
      FROM lines WHERE regexp_matches(line, '[^ \\t-\\r]') WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
    shortest AS (
      SELECT a.doc_id, a.k, min(b.k) AS e FROM seq a JOIN seq b
        ON b.doc_id = a.doc_id AND b.k >= a.k AND b.k < a.k + {min_run} AND b.upto - a.upto + a.size >= {min_run}
      GROUP BY a.doc_id, a.k
      UNION
      SELECT b.doc_id, max(a.k), b.k FROM seq a JOIN seq b
        ON b.doc_id = a.doc_id AND b.k >= a.k AND b.k < a.k + {min_run} AND b.upto - a.upto + a.size >= {min_run}
      GROUP BY b.doc_id, b.k),
    counting AS (
      SELECT r.doc_id, r.k, r.e, string_agg(q.line, chr(10) ORDER BY q.k) AS run
      FROM shortest r JOIN seq q ON q.doc_id = r.doc_id AND q.k BETWEEN r.k AND r.e GROUP BY r.doc_id, r.k, r.e),
    ranked AS (
      SELECT doc_id, k, e - k + 1 AS n, row_number() OVER (PARTITION BY run ORDER BY doc_id, k) AS place FROM counting),
    gone AS (
      SELECT DISTINCT q.doc_id, q.i FROM ranked r JOIN seq q
        ON q.doc_id = r.doc_id AND q.k >= r.k AND q.k < r.k + r.n WHERE r.place > 1),
    marked AS (
      SELECT l.doc_id, l.i, l.line, g.i IS NOT NULL AS dropped,
             g.i IS NOT NULL AND NOT coalesce(lag(g.i IS NOT NULL) OVER (PARTITION BY l.doc_id ORDER BY l.i), FALSE) AS head
      FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i),
    summed AS (
      SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_removed,
             count(*) FILTER (WHERE head) AS n_runs,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '') AS kept
      FROM marked GROUP BY doc_id)
    SELECT d.doc_id, coalesce(s.n_lines, 0) AS n_lines, coalesce(s.n_removed, 0) AS n_removed,
           coalesce(s.n_runs, 0) AS n_runs, sha256(coalesce(s.kept, '')) AS kept_sha256
    FROM documents d LEFT JOIN summed s ON s.doc_id = d.doc_id"""
