"""Source divergence audit: hash-consed segment trees of term counts, priced pair by pair.

Every (lang, source) group is a vector of counts over the lang's kept terms. A block of terms gives each
group a segment tree over its term ids; equal subtrees, of one group or of several, are one node
(hash-consing). The divergence of two groups is summed by walking their two trees together: a pair of
nodes that comes up again, at whatever place of the trees, has been priced already. Terms are ordered by
their lang's count, so that the long stretches without occurrences fall into few nodes.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskframe.llm.common import bounded_batches, data, documents, materialize

#: Terms of a block and sources of a chunk, about: a task prices the pairs of two chunks over one block.
BLOCK, CHUNK = 8192, 64
#: (term, group) entries that a task gathers before it hands them on, and bytes of terms in them.
GATHERED, GATHERED_BYTES = 1_500_000, 48 << 20
UNIT = 1_000_000_000

#: Bytes of terms: letters, A-Z as a-z, and everything beyond ASCII; other bytes a space.
TERM_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term in each group and documents with it.

    Null text, lang and source are ''. Every group has at least one row; a group without terms has one
    with a null term. Repeated rows count each. Counts are gathered in tasks first, so a frequent term
    leaves a task a few times, not once per document.
    """
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def counted(b: pa.RecordBatch, groups: dict[tuple[str, str], int]) -> pa.Table:
        """(group, term, n, docs) of a batch; new groups get the next number."""
        words, length, group = [], [], []
        for text, lang, source in zip(*(b.column(i) for i in range(3))):
            found = data(text.as_py()).translate(TERM_TABLE).split()
            words += found
            length.append(len(found))
            group.append(groups.setdefault((lang.as_py() or "", source.as_py() or ""), len(groups)))
        terms = pa.array(words, pa.binary()).dictionary_encode()
        v = max(1, len(terms.dictionary))
        each, n = np.unique(np.repeat(np.arange(len(length)), length) * v + np.asarray(terms.indices), return_counts=True)  # (document, term)
        both, at, docs = np.unique(np.array(group, np.int64)[each // v] * v + each % v, return_inverse=True, return_counts=True)  # (group, term)
        return pa.table({"group": both // v, "term": terms.dictionary.take(pa.array(both % v)), "n": np.bincount(at, n, len(both)).astype(np.int64), "docs": docs.astype(np.int64)})

    def rows(batches):
        groups: dict[tuple[str, str], int] = {}
        parts: list[pa.Table] = []

        def added() -> pa.Table:
            t = pa.concat_tables(parts).group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
            return t.select(["group", "term", "n_sum", "docs_sum"]).rename_columns(["group", "term", "n", "docs"])

        def handed(t: pa.Table) -> list[pa.RecordBatch]:
            k = len(groups)
            t = pa.concat_tables([t, pa.table({"group": np.arange(k), "term": pa.nulls(k, pa.binary()), "n": np.zeros(k, np.int64), "docs": np.zeros(k, np.int64)})])
            lang, source = (pa.array([g[i] for g in groups], pa.string()).take(pa.array(np.asarray(t["group"]))) for i in (0, 1))
            return pa.table([lang, source, t["term"], t["n"], t["docs"]], schema=schema).combine_chunks().to_batches(20_000)

        for b in batches:
            if b.num_rows:
                parts.append(counted(b, groups))
            if sum(p.num_rows for p in parts) > GATHERED or sum(p["term"].nbytes for p in parts) > GATHERED_BYTES:
                parts = [added()]
                if parts[0].num_rows > GATHERED // 2 or parts[0]["term"].nbytes > GATHERED_BYTES // 2:
                    yield from handed(parts[0])
                    groups, parts = {}, []
        if parts:
            yield from handed(added())

    bounded_batches(docs.sparkSession)
    out = docs.select("text", "lang", "source").mapInArrow(rows, "lang string, source string, term binary, n long, docs long")
    return out.select("lang", "source", F.col("term").cast("string").alias("term"), "n", "docs")


def tables(docs: DataFrame, min_docs: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``kept`` terms (lang, term, total), ``entries`` (lang, source, term, n, total) of them and ``groups`` (lang, source, size, v, total_size).

    A term is kept where at least ``min_docs`` documents of the lang have it; total is its count in the
    lang, size the group's occurrences of kept terms, v the lang's number of them.
    """
    one = Window.partitionBy("lang", "term")  # a row per source; all of them are dealt to one task by the first shuffle
    summed = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    summed = summed.select("lang", "source", "term", "n", F.sum("n").over(one).alias("total"), F.sum("docs").over(one).alias("docs"), (F.min("source").over(one) == F.col("source")).alias("first"))
    summed = materialize(summed.where((F.col("docs") >= min_docs) | F.col("term").isNull()).drop("docs"), "terms")
    entries = summed.where("term IS NOT NULL").drop("first")
    kept = summed.where("term IS NOT NULL AND first").select("lang", "term", "total")
    sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("total_size"))
    every = summed.where("term IS NULL").select("lang", "source")
    groups = every.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["size", "v", "total_size"])
    return kept, entries, materialize(groups, "groups")


def share(n: Column, size: Column, v: Column) -> Column:
    """``1 + floor(UNIT * (n + 1) / (size + v))``, exact for counts of any size."""
    return F.call_function("div", (n.cast("decimal(20,0)") + 1) * F.lit(UNIT).cast("decimal(10,0)"), (size + v).cast("decimal(20,0)")) + 1


def trees(counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Hash-consed segment trees of the rows of ``counts`` (a power of two wide).

    Returns the distinct counts (nodes of the lowest level), for each level above the (left, right)
    nodes of each distinct node, and each row's root. Equal subtrees of a level are one node, whichever
    rows and places they come from.
    """
    leaf, node = np.unique(counts, return_inverse=True)
    node = node.reshape(counts.shape)
    levels = []
    while node.shape[1] > 1:
        pair = node[:, ::2].astype(np.int64) << 32 | node[:, 1::2]
        distinct, at = np.unique(pair, return_inverse=True)
        levels.append(np.stack([distinct >> 32, distinct & 0xFFFFFFFF], 1))
        node = at.reshape(pair.shape)
    return leaf, levels, node[:, 0]


def walk(levels: list[np.ndarray], a: int, b: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The different node pairs that two trees meet when walked together: those of leaves (x, y), and for
    each level from the lowest the places of each pair's left and right pair one level below."""
    pairs = np.array([[a, b]], np.int64)
    links = []
    for children in reversed(levels):
        both = children[pairs]  # pair, side of the pair, left or right child
        met = np.concatenate([both[:, :, 0], both[:, :, 1]])
        distinct, at = np.unique(met[:, 0] << 32 | met[:, 1], return_inverse=True)
        links.append((at[: len(pairs)], at[len(pairs):]))
        pairs = np.stack([distinct >> 32, distinct & 0xFFFFFFFF], 1)
    return pairs, links[::-1]


def shares(counts: np.ndarray, size: int, v: int) -> np.ndarray:
    """``share`` of plain numbers."""
    return np.array([1 + UNIT * (n + 1) // (size + v) for n in counts.tolist()], np.int64)


def priced(p: np.ndarray, q: np.ndarray, links: list[tuple[np.ndarray, np.ndarray]]) -> int:
    """The sum over a pair of trees: each different pair is priced once, from its leaves to its root."""
    cost = (p - q) * (p - q) // q  # up to 1.1e18 each
    if int(cost.max()) << len(links) >= 1 << 63:
        cost = cost.astype(object)
    for left, right in links:
        cost = cost[left] + cost[right]
    return int(cost[0])


def pair_sums(kept: DataFrame, entries: DataFrame, groups: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``lang, source, item, value``: the divergence of each group from each other source of its lang.

    A task gets about ``block`` terms of two chunks of about ``chunk`` sources; sums of blocks are added.
    Terms of a block that neither chunk has count as well (0 occurrences): the block's size is given.
    """
    def dealt(name: str, k: Column) -> Column:
        return F.pmod(F.xxhash64(name), k).cast("int")

    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    g = groups.join(sources, "lang")
    g = g.withColumn("chunks", F.ceil(F.col("sources") / chunk)).withColumn("chunk", dealt("source", F.col("chunks")))
    g = g.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / block)))
    g = materialize(g.select("lang", "source", "size", "v", "chunk", "chunks", "blocks"), "chunks")

    met = F.expr("transform(sequence(0, int(chunks) - 1), x -> struct(least(x, chunk) AS i, greatest(x, chunk) AS j))")
    right = g.withColumn("met", F.explode(met)).withColumn("block", F.explode(F.expr("sequence(0, int(blocks) - 1)")))
    terms = kept.join(g.select("lang", "blocks").distinct(), "lang").groupBy("lang", dealt("term", F.col("blocks")).alias("block")).agg(F.count(F.lit(1)).alias("terms"))
    right = right.join(terms, ["lang", "block"], "left").select("lang", "met.i", "met.j", "block", "source", "size", "v", "chunk", F.coalesce("terms", F.lit(0)).alias("terms"))
    left = entries.join(g.select("lang", "source", "chunk", "chunks", "blocks"), ["lang", "source"])
    left = left.withColumn("block", dealt("term", F.col("blocks"))).withColumn("met", F.explode(met))
    left = left.select("lang", "met.i", "met.j", "block", "source", "term", "n", "total")

    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.decimal128(38, 0))])

    def price(counts: pa.Table, groups: pa.Table) -> pa.Table:
        names = groups.column("source").to_pylist()
        size, v, chunks = (groups.column(c).to_pylist() for c in ("size", "v", "chunk"))
        row = {s: k for k, s in enumerate(names)}
        total = np.asarray(counts.column("total").combine_chunks())
        distinct = counts.column("term").combine_chunks().dictionary_encode()
        term = np.asarray(distinct.indices)
        # term ids: by the lang's count, frequent first; then those that no group here has
        of = np.zeros(len(distinct.dictionary), np.int64)
        of[term] = total
        place = np.empty(len(of), np.int64)
        place[np.argsort(-of, kind="stable")] = np.arange(len(of))
        k = groups.column("terms")[0].as_py() if len(names) else 0
        matrix = np.zeros((len(names), 1 << max(0, k - 1).bit_length()), np.int64)
        at = np.array([row[s] for s in counts.column("source").to_pylist()], np.int64)
        matrix[at, place[term]] = np.asarray(counts.column("n").combine_chunks())
        matrix[:, k:] = -1  # places beyond the terms cost nothing
        leaf, levels, roots = trees(matrix)
        beyond = leaf < 0
        p = [np.where(beyond, 1, shares(leaf, size[x], v[x])) if v[x] else np.ones(len(leaf), np.int64) for x in range(len(names))]
        out = []
        two = len(names) > 0 and groups.column("i")[0] != groups.column("j")[0]
        for x in range(len(names)):
            for y in range(x):
                if two and chunks[x] == chunks[y]:
                    continue
                pairs, links = walk(levels, int(roots[x]), int(roots[y]))
                px, py = p[x][pairs[:, 0]], p[y][pairs[:, 1]]
                out.append((names[x], names[y], priced(px, py, links)))
                out.append((names[y], names[x], priced(py, px, links)))
        lang = groups.column("lang")[0].as_py() if len(names) else None
        return pa.Table.from_arrays([pa.array([lang] * len(out), pa.string()), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()),
                                     pa.array([decimal.Decimal(o[2]) for o in out], pa.decimal128(38, 0))], schema=schema)

    keys = ["lang", "i", "j", "block"]
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(price, "lang string, source string, item string, value decimal(38,0)")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def term_values(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the terms that a group has and uses more than its lang does."""
    e = entries.join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("size"), F.col("v")), share(F.col("total"), F.col("total_size"), F.col("v"))
    e = e.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    return e.select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))


def divergence(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``docs`` (text, lang, source).

    Part ``pair``: the divergence from each other source of the lang, all ranks; part ``term``: the
    ``top`` terms that a group uses more than its lang. Null text, lang and source are ''; a group
    without terms has pairs only; a lang without kept terms has pairs of value 0; an empty table gives
    none. A value beyond 64 bits is an error. Other columns aren't read.
    """
    kept, entries, groups = tables(docs, min_docs)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pair_sums(kept, entries, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    terms = term_values(entries, groups).select("lang", "source", F.lit("term").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms.where(F.col("rank") <= top))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of all (lang, source) groups of all documents."""
    return divergence(documents(spark, sf_dir))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), w AS (SELECT r, lang, source, unnest(terms) AS term FROM d
), kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), langs AS (SELECT lang, count(*) AS v, sum(total) AS total_size FROM kept GROUP BY lang
), e AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term
), g AS (
  SELECT g.lang, g.source, coalesce(s.size, 0) AS size, coalesce(v, 0) AS v, coalesce(total_size, 0) AS total_size
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n) AS size FROM e GROUP BY lang, source) s USING (lang, source) LEFT JOIN langs USING (lang)
), dense AS (
  SELECT g.lang, g.source, kept.term, coalesce(e.n, 0) AS n, kept.total,
         (1 + (1000000000::HUGEINT * (coalesce(e.n, 0) + 1)) // (size + v))::HUGEINT AS p,
         (1 + (1000000000::HUGEINT * (kept.total + 1)) // (total_size + v))::HUGEINT AS q
  FROM g JOIN kept USING (lang) LEFT JOIN e USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM dense WHERE n > 0 AND p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
