"""Removal of repeated line windows, in column expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def line_windows(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``id, pos, h1, h2``: every window of ``size`` consecutive lines under two 64-bit hashes.

    Windows of blank lines alone are left out, as they hold no text.
    """
    lines = docs.select(F.col(doc_id).alias("id"), F.split(text, "\n").alias("lines")).where(
        F.col("id").isNotNull() & (F.size("lines") >= size)
    )
    each = lines.select("id", "lines", F.explode(F.sequence(F.lit(0), F.size("lines") - size)).alias("pos"))
    own = [F.get("lines", F.col("pos") + i) for i in range(size)]
    return each.where(F.trim(F.concat(*own)) != "").select("id", "pos", F.xxhash64(*own).alias("h1"), F.xxhash64(F.lit(1), *own).alias("h2"))


def repeated_positions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """``id, covered``: the line numbers (from 0) that later occurrences of a window cover, for documents that have any.

    The first occurrence is that of the smallest (id, line number).
    """
    windows = line_windows(docs, doc_id, text, size)
    firsts = windows.groupBy("h1", "h2").agg(F.min(F.struct("id", "pos")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = windows.join(firsts.drop("n"), ["h1", "h2"]).where(F.struct("id", "pos") > F.col("first"))
    return later.groupBy("id").agg(F.collect_set("pos").alias("begins")).select(
        "id",
        F.array_distinct(F.flatten(F.transform("begins", lambda p: F.sequence(p, p + size - 1)))).alias("covered"),
    )


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, prefix: str = "_lines_") -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without the lines that repeated windows cover, and three counts.

    The counts are ``<prefix>n``, ``<prefix>removed`` and ``<prefix>spans``
    (maximal runs of removed lines). A window is judged on the input: lines
    that leave do not bring others together. A document's own repeats count
    as later occurrences too. A null text stays null with counts of 0, an
    empty text is one empty line; texts under ``size`` lines stay as they are.
    doc_id identifies a document, rows that repeat one get the same result;
    rows without doc_id take no part and stay. An empty table stays empty. A
    column that already has one of the count names is replaced.
    """
    covered = repeated_positions(docs, doc_id, text, size).select(F.col("id").alias(f"{prefix}id"), F.col("covered").alias(f"{prefix}covered"))
    cov, lines = F.col(f"{prefix}covered"), F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cov)
    new = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    counts = {
        f"{prefix}n": F.coalesce(F.size(lines), F.lit(0)),
        f"{prefix}removed": F.coalesce(F.size(cov), F.lit(0)),
        f"{prefix}spans": F.coalesce(F.size(F.array_except(cov, F.transform(cov, lambda p: p + 1))), F.lit(0)),
    }
    plain = docs.drop(*counts)
    joined = plain.join(covered, plain[doc_id] == F.col(f"{prefix}id"), "left")
    # size(NULL) is NULL in ANSI mode and -1 outside of it.
    counts = {k: F.greatest(v, F.lit(0)) for k, v in counts.items()}
    columns = [F.when(cov.isNull(), F.col(text)).otherwise(new).alias(text) if c == text else F.col(c) for c in plain.columns]
    return joined.select(*columns, *[v.cast("int").alias(k) for k, v in counts.items()])


LINE_DEDUP_SQL = r"""WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, p.pos AS pos, lines[p.pos + 1] AS a, lines[p.pos + 2] AS b, lines[p.pos + 3] AS c
  FROM l, LATERAL (SELECT unnest(range(0, len(lines) - 2)) AS pos) p),
f AS (SELECT a, b, c, min((doc_id, pos)) AS first FROM w WHERE trim(a || b || c, ' ') <> '' GROUP BY a, b, c HAVING count(*) > 1),
cov AS (SELECT DISTINCT w.doc_id, w.pos + d.d AS pos FROM w JOIN f ON w.a = f.a AND w.b = f.b AND w.c = f.c,
  (VALUES (0), (1), (2)) d(d) WHERE (w.doc_id, w.pos) > f.first),
runs AS (SELECT c.doc_id, count(*) AS removed, count(*) FILTER (WHERE p.pos IS NULL) AS spans
  FROM cov c LEFT JOIN cov p ON p.doc_id = c.doc_id AND p.pos = c.pos - 1 GROUP BY c.doc_id),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM l) l
  ANTI JOIN cov c ON c.doc_id = l.doc_id AND c.pos = l.pos GROUP BY l.doc_id)
SELECT l.doc_id, CAST(coalesce(len(l.lines), 0) AS INTEGER) AS n_lines, CAST(coalesce(r.removed, 0) AS INTEGER) AS n_removed,
  CAST(coalesce(r.spans, 0) AS INTEGER) AS n_spans, CASE WHEN l.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM l LEFT JOIN runs r USING (doc_id) LEFT JOIN kept k USING (doc_id)"""
