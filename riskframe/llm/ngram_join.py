"""N-gram Jaccard join: MinHash values compared step by step with Bayesian pruning, the rest exactly.

Documents of one shingle set are collapsed first. Bands of MinHash values give candidate groups
(connected through shared bands); a group's sets meet in blocks of bounded size, each pair of
blocks in one task. There the values of every pair are compared a step at a time; a pair whose
posterior probability of reaching the threshold has fallen below the tolerance is dropped, the
others are verified on the shingles themselves. Only counts and one edge per set leave a task, so
a group of thousands of near copies costs no row per pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import WordHashes, bounded_batches, components, data, documents, fold_words, materialize, mix64, packed, shingle_hashes

#: Place of a document without an id: after all others.
LAST = 2**63 - 1


@dataclass(frozen=True)
class JoinConfig:
    """Five-word shingles, similarity 4/5 (as a fraction, so that ties are exact).

    bands x rows MinHash values: a pair at the threshold shares no band with probability
    (1 - 0.8^6)^70 = 5.8e-10, which is below the tolerance of the pruning.
    step: values compared between two looks at the posterior; tolerance: least posterior.
    block: 8-byte units of shingles and values in a block of a group.
    """

    words: int = 5
    over: int = 4
    under: int = 5
    bands: int = 70
    rows: int = 6
    step: int = 21
    tolerance: float = 1e-9
    block: int = 2_000_000
    seed: int = 11

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def least_matches(self) -> list[tuple[int, int]]:
        """(values compared, matches needed): with a uniform prior the posterior that J >= t after
        m of n matches is P(Bin(n + 1, t) <= m); fewer matches than given have less than tolerance."""
        t, out = self.over / self.under, []
        for n in [*range(self.step, self.hashes, self.step), self.hashes]:
            total, m = 0.0, 0
            while (total := total + comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)) < self.tolerance:
                m += 1
            out.append((n, m))
        return out


class MinHash:
    """Linear permutations of 32-bit hashes."""

    def __init__(self, cfg: JoinConfig):
        rng = np.random.default_rng(cfg.seed)
        self.a = (rng.integers(0, 1 << 32, cfg.hashes, np.uint32) | np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, cfg.hashes, np.uint32)[:, None]

    def of(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for k in range(0, len(x), 4096):
            np.minimum(out, (self.a * x[k : k + 4096] + self.b).min(axis=1), out=out)
        return out


def band_keys(values: np.ndarray, cfg: JoinConfig) -> np.ndarray:
    """64-bit key of every band of every row of MinHash values."""
    v = values.reshape(len(values), cfg.bands, cfg.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(cfg.bands, dtype=np.uint64), v.shape[:2])
    for k in range(cfg.rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + v[:, :, k])
    return key.view(np.int64)


def digest_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


def node_of(digest: bytes) -> int:
    """A set's number in the graph."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _placed(docs: DataFrame) -> DataFrame:
    """Rows with their place: the id (null: last), then a hash of id and text."""
    return docs.withColumns({"place": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "key": F.xxhash64("doc_id", "text")})


def signatures(docs: DataFrame, cfg: JoinConfig) -> DataFrame:
    """(place, key, digest, node, n, bands) per document, written; a text without words has nulls."""
    schema = pa.schema([("place", pa.int64()), ("key", pa.int64()), ("digest", pa.binary()), ("node", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, minhash = WordHashes(), MinHash(cfg)
        for b in batches:
            sets = [shingle_hashes(hashes.of(fold_words(data(t.as_py()))), cfg.words) for t in b.column(2)]
            digests = [digest_of(s) if len(s) else None for s in sets]
            full = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            if full:
                for i, keys in zip(full, band_keys(np.stack([minhash.of(sets[i]) for i in full]), cfg)):
                    bands[i] = keys
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(digests, pa.binary()), pa.array([d and node_of(d) for d in digests], pa.int64()),
                                              pa.array([len(s) for s in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64()))], schema=schema)

    bounded_batches(docs.sparkSession)
    got = _placed(docs).select("place", "key", "text").mapInArrow(rows, "place long, key long, digest binary, node long, n long, bands array<long>")
    return materialize(got, "signatures")


def candidate_groups(sets: DataFrame) -> DataFrame:
    """(node, label): sets that share a band with another are in the group of that one.

    A band's sets are all linked to its smallest, one edge each; no list of a band's sets is made.
    """
    b = sets.select(F.explode("bands").alias("band"), "node")
    hubs = b.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("far")).where("hub < far").select("band", "hub")
    return components(b.join(hubs, "band").select(F.col("node").alias("a"), F.col("hub").alias("b")), "candidates")


@dataclass
class Member:
    node: int
    copies: int
    shingles: np.ndarray


def compare(one: list[Member], other: list[Member] | None, cfg: JoinConfig, least: list[tuple[int, int]], minhash: MinHash) -> list[tuple[int, int, int]]:
    """(node, documents of linked sets, root) of all members: pairs within ``one``, or between
    ``one`` and ``other``. Roots join what is linked, directly or over others."""
    members = one + (other or [])
    side = np.array([0] * len(one) + [1] * len(other or []))
    size = np.array([len(m.shingles) for m in members], np.int64)
    order = np.argsort(size, kind="stable")
    members, side, size = [members[i] for i in order], side[order], size[order]
    values = np.stack([minhash.of(m.shingles) for m in members])
    flat = np.unique(np.concatenate([m.shingles for m in members]), return_inverse=True)[1]
    first = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(flat.max() + 1, bool)
    copies = np.array([m.copies for m in members], np.int64)
    docs, root = np.zeros(len(members), np.int64), np.arange(len(members))
    for i in range(len(members)):
        # a larger set can reach the threshold up to size / t
        js = np.arange(i + 1, int(np.searchsorted(size, size[i] * cfg.under // cfg.over, "right")))
        if other is not None:
            js = js[side[js] != side[i]]
        same, done = np.zeros(len(js), np.int64), 0
        for n, m in least:
            if not len(js):
                break
            same += (values[js, done:n] == values[i, done:n]).sum(axis=1)
            done, stay = n, same >= m
            js, same = js[stay], same[stay]
        if not len(js):
            continue
        own = flat[first[i] : first[i + 1]]
        mark[own] = True
        n = size[js]
        begin = np.cumsum(n) - n
        at = np.arange(n.sum()) + np.repeat(first[js] - begin, n)
        common = np.add.reduceat(mark[flat[at]], begin, dtype=np.int64)
        mark[own] = False
        js = js[cfg.under * common >= cfg.over * (size[i] + n - common)]
        if len(js):
            docs[i] += copies[js].sum()
            docs[js] += copies[i]
            roots = np.unique(root[np.append(js, i)])
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]
    return [(m.node, int(d), members[r].node) for m, d, r in zip(members, docs, root)]


def verified_links(docs: DataFrame, sets: DataFrame, groups: DataFrame, cfg: JoinConfig) -> DataFrame:
    """(node, n_docs, root, whole) per candidate set and pair of blocks it took part in; ``whole`` if
    its group is one block."""
    cand = sets.join(groups, "node").select("place", "key", "digest", "node", "copies", "label", (F.col("n") + (cfg.hashes + 1) // 2).alias("weight"))
    cand = materialize(cand, "candidate-sets")
    blocks = cand.groupBy("label").agg(F.ceil(F.sum("weight") / cfg.block).cast("int").alias("n_blocks"))
    cand = cand.join(blocks, "label").withColumn("block", F.pmod(F.xxhash64("digest"), F.col("n_blocks")).cast("int")).drop("weight")
    texts = _placed(docs).select("place", "key", "text").join(cand.hint("shuffle_hash"), ["place", "key"])
    schema = pa.schema([("node", pa.int64()), ("copies", pa.int64()), ("label", pa.int64()), ("n_blocks", pa.int32()), ("block", pa.int32()), ("shingles", pa.binary())])

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array([shingle_hashes(hashes.of(fold_words(data(t.as_py()))), cfg.words).astype("<u8").tobytes() for t in b.column(5)], pa.binary())], schema=schema)

    spread = texts.select("node", "copies", "label", "n_blocks", "block", "text").mapInArrow(shingles, "node long, copies long, label long, n_blocks int, block int, shingles binary")
    pair = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("with")
    spread = spread.select("*", pair).select("label", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "n_blocks", "block", "node", "copies", "shingles")
    spread = spread.repartition("label", "low", "high").sortWithinPartitions("label", "low", "high", "block", "node")
    out = pa.schema([("node", pa.int64()), ("n_docs", pa.int64()), ("root", pa.int64()), ("whole", pa.bool_())])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, minhash = cfg.least_matches(), MinHash(cfg)

        def result(key: tuple, rows: dict[int, tuple[int, Member]]) -> pa.RecordBatch:
            of = lambda k: [m for b, m in rows.values() if b == k]
            got = [(*r, key[3] == 1) for r in compare(of(key[1]), of(key[2]) if key[1] != key[2] else None, cfg, least, minhash)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), out.types)], schema=out)

        key, rows = None, {}
        for b in batches:
            for *of, block, node, copies, raw in zip(*(c.to_pylist() for c in b.columns)):
                if tuple(of) != key:
                    if rows:
                        yield result(key, rows)
                    key, rows = tuple(of), {}
                rows[node] = block, Member(node, copies, np.frombuffer(raw, "<u8"))  # rows repeated in full come twice
        if rows:
            yield result(key, rows)

    return materialize(spread.mapInArrow(links, "node long, n_docs long, root long, whole boolean"), "links")


def near_duplicates(docs: DataFrame, cfg: JoinConfig = JoinConfig()) -> DataFrame:
    """One row per document: doc_id, key, class_id, n_links, n_copies, class_size, first.

    Words are lower-cased as in ASCII (runs of letters, digits and signs beyond ASCII); a text of
    fewer than five words is one shingle; one without words is a class of its own without links, as
    is a null text. ``n_links`` counts the other documents at similarity 0.8 or more, copies
    included; ``n_copies`` the documents of the same shingle set, itself included. Classes are what
    links connect; ``class_id`` is the smallest id in the class (null if none has one) and ``first``
    marks its first row, by id, nulls last, then by a hash of id and text. Rows repeated in full
    are copies of each other. Columns other than doc_id and text aren't read. Documents are told
    apart by 128 bits of their shingle sets; 64 of them number the nodes of the graph.
    """
    t = signatures(docs, cfg)
    sets = t.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("place", "key")).alias("head"), F.count("*").alias("copies"), F.first("node").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    sets = materialize(sets.select("digest", "head.place", "head.key", "copies", "node", "n", "bands"), "sets")
    links = verified_links(docs, sets, candidate_groups(sets), cfg)
    # what one task has compared is labelled; groups of several blocks are joined over their edges
    named = links.groupBy("node").agg(F.sum("n_docs").alias("linked"), F.min("root").alias("label"))
    parts = links.where("NOT whole").select(F.col("node").alias("a"), F.col("root").alias("b"))
    if not parts.isEmpty():
        joined = components(parts, "classes").withColumnRenamed("label", "over")
        named = named.join(joined, "node", "left").select("node", "linked", F.coalesce("over", "label").alias("label"))
    named = sets.select("digest", "place", "key", "copies", "node").join(named, "node", "left")
    named = materialize(named.where("copies > 1 OR label IS NOT NULL"), "classes-of-sets")
    heads = named.where("label IS NOT NULL").groupBy("label").agg(F.min(F.struct("place", "key")).alias("head"), F.sum("copies").alias("class_size"))
    named = named.join(heads, "label", "left").select("digest", F.coalesce("linked", F.lit(0)).alias("linked"), "copies",
                                                      F.coalesce("head", F.struct("place", "key")).alias("head"), F.coalesce("class_size", "copies").alias("class_size"))
    own = F.struct("place", "key")
    out = t.select("place", "key", "digest").join(named, "digest", "left")
    head = F.coalesce("head", own)
    as_id = lambda c: F.when(c != LAST, c)
    return out.select(as_id(F.col("place")).alias("doc_id"), "key", as_id(head.place).alias("class_id"),
                      F.coalesce(F.col("linked") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), (own == head).alias("first"))


def keep_first(docs: DataFrame, cfg: JoinConfig = JoinConfig()) -> DataFrame:
    """``docs`` with the first document of each class only (pipeline stage).

    Of rows repeated in full one stays, unless the text has no words.
    """
    got = near_duplicates(docs.select("doc_id", "text"), cfg).select("doc_id", "key", "first", "n_copies").where("NOT first OR n_copies > 1")
    got = got.groupBy("doc_id", "key").agg(F.bool_and("first").alias("first"), F.count("*").alias("n"))
    got = materialize(got.where("NOT first OR n > 1"), "not-first")
    on = (F.col("__row") == F.col("key")) & F.col("__id").eqNullSafe(F.col("doc_id"))
    left = packed(docs).join(got.where("NOT first").hint("shuffle_hash"), on, "left_anti")
    again = got.where("first")
    if not again.isEmpty():
        once = left.join(again.hint("shuffle_hash"), on, "left_semi").dropDuplicates(["__id", "__row"])
        left = left.join(again.hint("shuffle_hash"), on, "left_anti").unionByName(once)
    return left.select("row.*")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and links of all documents at five-word Jaccard similarity 0.8."""
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "n_copies", "class_size")


_FOLDED = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Exact links of all documents over shared shingles, and their classes.
ORACLE = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_FOLDED} AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y, k = na.n AND k = nb.n AS same FROM c JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y
      WHERE 5 * k >= 4 * (na.n + nb.n - k)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.other = l.x),
cl AS MATERIALIZED (SELECT doc_id, min(other) AS class_id FROM r GROUP BY doc_id)
SELECT cl.doc_id, cl.class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, CAST(1 + coalesce(n_same, 0) AS BIGINT) AS n_copies,
       CAST(class_size AS BIGINT) AS class_size
FROM cl LEFT JOIN (SELECT x, count(*) AS n_links, count(*) FILTER (WHERE same) AS n_same FROM l GROUP BY x) ON cl.doc_id = x
JOIN (SELECT class_id, count(*) AS class_size FROM cl GROUP BY class_id) z ON cl.class_id = z.class_id
"""
