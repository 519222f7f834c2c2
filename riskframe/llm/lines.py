"""Line dedup over overlapping three-line windows, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskframe.llm.common import documents, materialize

#: Lines of a window.
WINDOW = 3
#: Place of a document without an id: after all others.
LAST = 2**63 - 1


def _place(docs: DataFrame) -> DataFrame:
    """The whole row as ``row``, whatever its columns are called, and its place: its id (null: last), then a hash of its text."""
    return docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("__place"),
                       F.coalesce(F.xxhash64("text"), F.lit(0)).alias("__text"))


def _windows(docs: DataFrame) -> DataFrame:
    """(h1, h2, place, text, pos) of every window that isn't blank throughout; 128 hash bits."""
    lines = F.col("lines")

    def window(i: Column) -> Column:
        own = [F.get(lines, i + k) for k in range(WINDOW)]
        blank = F.btrim(F.concat(*own), F.lit(" \t\r")) == ""
        return F.when(~blank, F.struct(i.alias("pos"), F.xxhash64(*own).alias("h1"), F.xxhash64(F.lit("second"), *own[::-1]).alias("h2")))

    at = F.when(F.size("lines") >= WINDOW, F.sequence(F.lit(0), F.size("lines") - WINDOW))
    rows = _place(docs.select("doc_id", "text")).select("__place", "__text", F.split("row.text", "\n", -1).alias("lines"))
    rows = rows.select("__place", "__text", F.explode(F.transform(at, window)).alias("w")).where("w IS NOT NULL")
    return rows.select("w.h1", "w.h2", "__place", "__text", "w.pos")


def covered_lines(docs: DataFrame) -> DataFrame:
    """Per document with repeated windows: (__place, __text, covered array<int>), the lines to go.

    The first occurrence of a window is the one in the document with the smallest id, earliest
    line first; all others are later occurrences. First occurrences come from an aggregation that
    combines before the shuffle; the join that finds the others is one that Spark splits when a
    window is very frequent.
    """
    w = materialize(_windows(docs), "line-windows")
    here = F.struct("__place", "__text", "pos")
    first = w.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first")
    later = w.join(first, ["h1", "h2"]).where(here > F.col("first"))
    starts = later.groupBy("__place", "__text").agg(F.sort_array(F.collect_set("pos")).alias("starts"))
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (WINDOW - 1)))))
    return starts.select("__place", "__text", covered.alias("covered"))


def line_dedup(docs: DataFrame, counts: bool = True) -> DataFrame:
    """``docs`` with ``text`` cut to the lines kept, and n_lines, n_removed, n_spans (long) added.

    Own columns of these three names are replaced; without ``counts`` none is added or replaced.

    Lines are what ``\\n`` separates. Windows of three consecutive lines are compared over all
    documents, blank ones left out; each line that a later occurrence covers is removed, windows
    being judged on the input. Windows may overlap their own first occurrence: of four equal
    lines the first is kept. Texts of fewer than three lines stay as they are; an empty text has
    one line, a null text none and stays null. A null id counts as the largest. Rows repeated in
    full are one document and get one result each; rows of one id with other texts are told apart
    by a hash of the text. Other columns, whatever their names, are carried along; n_chars, if
    there, is set to the new length.
    """
    text = F.col("row.text")
    lines, kept = F.split(text, "\n", -1), F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.coalesce("covered", F.array().cast("array<int>")))
    placed, gone = _place(docs), covered_lines(docs).hint("shuffle_hash")
    out = placed.join(gone, ["__place", "__text"], "left").withColumn("__lines", lines)
    joined = F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n")
    out = out.withColumn("__kept", F.when(F.col("covered").isNull(), text).otherwise(joined))
    columns = {c: F.col("row").getField(c) for c in docs.columns}
    columns["text"] = F.col("__kept")
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("__kept").cast(docs.schema["n_chars"].dataType)
    n_spans = F.size(F.array_except("covered", F.transform("covered", lambda c: c + 1)))
    added = {"n_lines": F.coalesce(F.size("__lines"), F.lit(0)), "n_removed": F.coalesce(F.size("covered"), F.lit(0)), "n_spans": F.coalesce(n_spans, F.lit(0))}
    if not counts:
        return out.select(*(v.alias(k) for k, v in columns.items()))
    return out.select(*(v.alias(k) for k, v in columns.items() if k not in added),
                      *(F.when(F.col("__lines").isNull(), 0).when(F.col("covered").isNull() & F.lit(k != "n_lines"), 0).otherwise(v).cast("long").alias(k) for k, v in added.items()))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left after dedup of three-line windows over all documents."""
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "n_spans", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS p FROM l WHERE len(ls) >= 3),
k AS (SELECT doc_id, p, ls[p] || chr(10) || ls[p + 1] || chr(10) || ls[p + 2] AS h FROM w
      WHERE trim(ls[p] || ls[p + 1] || ls[p + 2], ' ' || chr(9) || chr(13)) <> ''),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS rn FROM k),
c AS (SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS q FROM r WHERE rn > 1),
g AS (SELECT doc_id, count(*) AS n_removed, sum(CASE WHEN prev = q - 1 THEN 0 ELSE 1 END) AS n_spans
      FROM (SELECT doc_id, q, lag(q) OVER (PARTITION BY doc_id ORDER BY q) AS prev FROM c) GROUP BY doc_id),
x AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS q, unnest(ls) AS line FROM l),
t AS (SELECT x.doc_id, string_agg(line, chr(10) ORDER BY x.q) AS kept
      FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.q = c.q WHERE c.q IS NULL GROUP BY x.doc_id)
SELECT l.doc_id, CAST(len(l.ls) AS BIGINT) AS n_lines, CAST(coalesce(g.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(g.n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM l LEFT JOIN g ON l.doc_id = g.doc_id LEFT JOIN t ON l.doc_id = t.doc_id
"""
