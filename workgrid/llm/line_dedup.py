"""Line deduplication over overlapping windows of three consecutive lines.

Every window of three lines is hashed (two independent 64-bit hashes of the
trimmed lines); windows that occur more than once anywhere are found by one
aggregation, which reduces a very common window to one row per map task. The
smallest ``(doc_id, position)`` of a window is its first occurrence. All later
occurrences cover their three line positions; a text loses its covered lines.
A removed line always has an equal line at an earlier place, so no content
disappears from the corpus.

Only hashes and positions are shuffled for the search. The join of windows
with the repeated ones is an equi join of two plain exchanges, whose hot
partitions AQE splits; texts are shuffled once, when they meet their
positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _lines(docs: DataFrame) -> DataFrame:
    """Identity of a row (its id and the hash of its text) and its lines."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").alias("_id"),
        F.xxhash64(text).alias("_row"),
        F.split(text, "\n", -1).alias("_lines"),
    )


def covered_positions(docs: DataFrame) -> DataFrame:
    """``(_id, _row, _starts)``: starts of the later occurrences of repeated windows, per row that has any."""
    line = lambda i: F.trim(F.get("_lines", i))
    window = lambda i: [line(i + k) for k in range(WINDOW)]
    starts = F.sequence(F.lit(0), F.size("_lines") - WINDOW)
    windows = F.when(
        F.size("_lines") >= WINDOW,
        F.transform(
            F.filter(starts, lambda i: F.concat(*window(i)) != ""),
            lambda i: F.struct(
                i.alias("pos"),
                F.xxhash64(*window(i)).alias("h1"),
                F.xxhash64(F.lit("w"), *window(i)).alias("h2"),
            ),
        ),
    )
    at = F.struct("_id", "_row", "pos")
    w = _lines(docs).select("_id", "_row", F.explode(windows).alias("w")).select("_id", "_row", "w.*")
    # A repeated row is the same place, not a second occurrence.
    repeated = (
        w.groupBy("h1", "h2")
        .agg(F.min(at).alias("first"), F.max(at).alias("last"))
        .where("first < last")
        .select("h1", "h2", "first")
    )
    return (
        w.join(repeated, ["h1", "h2"])
        .where(F.struct("_id", "_row", "pos") > F.col("first"))
        .groupBy("_id", "_row")
        .agg(F.array_sort(F.collect_set("pos")).alias("_starts"))
    )


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cleaned, and the columns ``n_lines`` and ``n_removed`` added (replaced if present).

    * lines are separated by a line feed; windows compare trimmed lines; a window of blank lines is not one;
    * texts of fewer than three lines are unchanged; a null text stays null (0 removed, 1 line);
    * repeated rows (same id and text) are one place and get the same result; rows that
      share an id with different texts are ordered by their text's hash; a null id sorts first;
    * an empty table gives an empty result; other columns pass through.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    held = docs.select(*names).withColumns({f"_keep_{i}": F.col(c) for i, c in enumerate(names)})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = held.select(
        *(f"_keep_{i}" for i in range(len(names))),
        F.col("doc_id").alias("_id"),
        F.xxhash64(text).alias("_row"),
    )
    cov = covered_positions(docs.select("doc_id", "text")).withColumnsRenamed({"_id": "_cid", "_row": "_crow"})
    body = F.col(f"_keep_{names.index('text')}")
    lines = F.split(F.coalesce(body.cast("string"), F.lit("")), "\n", -1)
    gone = F.flatten(F.transform("_starts", lambda p: F.array(*(p + k for k in range(WINDOW)))))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_l") - 1), gone)
    joined = rows.join(
        cov.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_row") == F.col("_crow")), "left"
    ).withColumn("_l", lines)
    cut = joined.withColumn("_kept", F.when(F.col("_starts").isNotNull(), kept))
    clean = F.when(
        F.col("_kept").isNotNull(), F.array_join(F.transform("_kept", lambda i: F.get("_l", i)), "\n")
    ).otherwise(body)
    return cut.select(
        *(clean.alias(c) if c == "text" else F.col(f"_keep_{i}").alias(c) for i, c in enumerate(names)),
        F.size("_l").alias("n_lines"),
        F.coalesce(F.size("_l") - F.size("_kept"), F.lit(0)).alias("n_removed"),
    )


ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), w AS (
  SELECT doc_id, pos, trim(line) AS a,
         lead(trim(line), 1) OVER p AS b, lead(trim(line), 2) OVER p AS c
  FROM lines WINDOW p AS (PARTITION BY doc_id ORDER BY pos)
), f AS (
  SELECT a, b, c, min(doc_id * 1000000000 + pos) AS first_at
  FROM w WHERE c IS NOT NULL AND a || b || c <> '' GROUP BY a, b, c HAVING count(*) > 1
), later AS (
  SELECT w.doc_id, w.pos FROM w JOIN f USING (a, b, c) WHERE w.doc_id * 1000000000 + w.pos > f.first_at
), gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) AS t(k)
)
SELECT d.doc_id,
       CAST(count(*) AS INTEGER) AS n_lines,
       CAST(count(g.pos) AS INTEGER) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
FROM documents d JOIN lines l ON l.doc_id = d.doc_id
LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos
GROUP BY d.doc_id
"""
