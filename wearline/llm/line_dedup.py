"""Removal of passages of three or more lines that repeat across the corpus.

Every three consecutive lines form a window. The first occurrence of a window is the one with the
smallest (doc_id, text hash, line); the lines covered by any later occurrence are removed, all
judged on the input. Windows overlap, so a longer repeated passage is covered by its windows.

Defined cases: a null text stays null and has no lines; an empty text is one empty line; a document
of fewer than three lines has no window and is kept; windows whose lines are all blank do not count;
rows equal in doc_id and text are one document, so neither removes the other's lines; a null doc_id
comes first. Other columns pass through; those named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_LINES = 3
OUTPUT = ["n_lines", "n_removed", "kept"]


def _lines(text: str) -> F.Column:
    return F.split(F.col(text), "\n", -1)


def repeated_positions(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(__id, __hash, __starts): lines at which a later occurrence of a repeated window starts."""
    lines = docs.select(F.col(key).alias("__id"), F.xxhash64(text).alias("__hash"), _lines(text).alias("lines"))
    lines = lines.where(F.size("lines") >= WINDOW_LINES)
    parts = lambda i: [F.get("lines", i + k) for k in range(WINDOW_LINES)]
    windows = F.transform(
        F.sequence(F.lit(0), F.size("lines") - WINDOW_LINES),
        lambda i: F.when(
            F.trim(F.concat(*parts(i))) != "",
            F.struct(
                i.alias("line"),
                F.xxhash64(*parts(i)).alias("w1"),
                # A second, independent hash: 128 bits in all.
                F.xxhash64(F.lit("window"), *reversed(parts(i))).alias("w2"),
            ),
        ),
    )
    placed = lines.select("__id", "__hash", F.explode(windows).alias("w")).where(F.col("w").isNotNull())
    placed = placed.select("__id", "__hash", "w.line", "w.w1", "w.w2")
    first = (
        placed.groupBy("w1", "w2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("__id", "__hash", "line")).alias("first"))
        .where("n > 1")
    )
    later = placed.join(first, ["w1", "w2"]).where(~F.struct("__id", "__hash", "line").eqNullSafe(F.col("first")))
    return later.groupBy("__id", "__hash").agg(F.collect_set("line").alias("__starts"))


def remove_repeated_windows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`docs` with n_lines, n_removed and the kept text."""
    docs = docs.drop(*OUTPUT)
    starts = repeated_positions(docs, text, key)
    joined = docs.join(
        starts,
        F.col(key).eqNullSafe(starts["__id"]) & (F.xxhash64(text) == starts["__hash"]),
        "left",
    ).drop("__id", "__hash")
    covered = F.array_distinct(
        F.flatten(F.transform("__starts", lambda s: F.sequence(s, s + (WINDOW_LINES - 1))))
    )
    joined = joined.withColumn("__covered", covered)
    # One sort sets each covered position before its line, so a long text takes n log n steps.
    marks = F.transform("__covered", lambda i: F.struct((2 * i).alias("at"), F.lit(None).cast("string").alias("line")))
    numbered = F.transform(_lines(text), lambda line, i: F.struct((2 * i + 1).alias("at"), line.alias("line")))
    joined = joined.withColumn("__sorted", F.array_sort(F.concat(marks, numbered)))
    follows = F.arrays_zip(F.col("__sorted").alias("own"), F.concat(F.array(F.lit(None)), F.slice("__sorted", 1, F.size("__sorted") - 1)).alias("last"))
    left = F.filter(follows, lambda z: z["own"]["line"].isNotNull() & ~F.coalesce(z["last"]["at"] == z["own"]["at"] - 1, F.lit(False)))
    kept = F.when(F.col("__covered").isNull(), F.col(text)).otherwise(F.array_join(F.transform(left, lambda z: z["own"]["line"]), "\n"))
    return joined.select(
        *docs.columns,
        F.when(F.col(text).isNull(), 0).otherwise(F.size(_lines(text))).cast("long").alias("n_lines"),
        F.coalesce(F.size("__covered"), F.lit(0)).cast("long").alias("n_removed"),
        kept.alias("kept"),
    )


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, i, l[i] AS a, l[i + 1] AS b, l[i + 2] AS c
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM lines WHERE len(l) >= 3)),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS nth
  FROM windows WHERE trim(a || b || c, ' ') <> ''),
covered AS (
  SELECT DISTINCT doc_id, i + k AS line FROM ranked, range(3) AS r(k) WHERE nth > 1),
kept AS (
  SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.i) FILTER (WHERE c.line IS NULL) AS kept, count(c.line) AS n_removed
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM lines) s
  LEFT JOIN covered c ON c.doc_id = s.doc_id AND c.line = s.i GROUP BY 1)
SELECT d.doc_id, coalesce(len(d.l), 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, md5(coalesce(k.kept, '')) AS kept_md5
FROM lines d LEFT JOIN kept k USING (doc_id)
"""
