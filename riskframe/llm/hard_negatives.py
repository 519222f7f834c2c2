"""Hard negatives by anchor-clustered shared lists.

Anchors (queries) are clustered by direction. For each cluster a block of candidates is sorted once by
an angular upper bound on the inner product with any member: with b the largest angle between a member
and the cluster's centre and t a candidate's angle to the centre, no member u scores above
|u| |c| cos(max(0, t - b)). Every member walks that shared list from its top, scoring as it goes, and
stops as soon as the bound of what is left is below the score of the last row that it still needs:
from there on nothing can change its result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskframe.llm.common import materialize

#: Rows of a block of candidates and of a block of anchors that meet in one task.
CANDIDATES, ANCHORS = 8192, 4096
#: Members of a cluster, about; rows of the shared list that are scored at once; rounds of k-means.
MEMBERS, STEP, ROUNDS = 32, 512, 4
#: Integers up to this are exact as floating-point numbers.
EXACT = float(1 << 53)

VECTORS = "vec_id long, key long, label long, vec binary"


def integer_vectors(embeddings: DataFrame, scale: int = 256, relabel_every: int = 7, n_labels: int = 10) -> DataFrame:
    """``vec_id, key, label, vec`` (little-endian 64-bit integers ``floor(scale * x)``), each different row once.

    Rows with a null label, a null vector or a null or non-finite component are left out. Every
    ``relabel_every``-th vec_id gets the next label modulo ``n_labels``. ``key`` tells rows of the same
    vec_id apart. Components beyond 64 bits raise an error.
    """
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("vec", pa.binary())])

    def rows(batches):
        for b in batches:
            lists = b.column(2)
            values = lists.flatten().cast(pa.float64())
            x = values.to_numpy(zero_copy_only=False)  # nulls become nan
            ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            whole = np.floor(np.where(np.isfinite(x), x, 0.0) * scale)
            if len(whole) and np.abs(whole).max() >= 2.0**63:
                raise ValueError("a component times the scale is beyond 64 bits")
            raw = whole.astype("<i8").tobytes()
            keep = np.flatnonzero((bad[ends] == bad[starts]) & ~np.asarray(lists.is_null()) & ~np.asarray(b.column(1).is_null())) if len(ends) else ends
            vec = pa.array([raw[8 * starts[i] : 8 * ends[i]] for i in keep.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep)), b.column(1).take(pa.array(keep)), vec], schema=schema)

    label = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label").cast("long") + 1) % n_labels).otherwise(F.col("label").cast("long"))
    clean = embeddings.select(F.col("vec_id").cast("long"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    ints = clean.mapInArrow(rows, "vec_id long, label long, vec binary").distinct()
    return ints.select("vec_id", F.xxhash64("label", "vec").alias("key"), "label", "vec")


class Vectors:
    """Rows of a table (vec_id, key, label, vec) as arrays; shorter vectors count as zero beyond their end."""

    def __init__(self, table: pa.Table, width: int):
        ids = table.column("vec_id").combine_chunks()
        self.no_id = np.asarray(ids.is_null())
        self.id = np.asarray(ids.fill_null(0))
        self.key, self.label = (np.asarray(table.column(c).combine_chunks()) for c in ("key", "label"))
        vecs = [np.frombuffer(v.as_py(), "<i8") for v in table.column("vec").combine_chunks()]
        self.v = np.zeros((len(vecs), width), np.int64)
        for row, v in zip(self.v, vecs):
            row[: len(v)] = v
        self.f = self.v.astype(np.float64)
        self.norm = np.sqrt((self.f * self.f).sum(1))
        self.unit = self.f / np.where(self.norm > 0, self.norm, 1)[:, None]

    def __len__(self) -> int:
        return len(self.id)


def width_of(*tables: pa.Table) -> int:
    """Components of the longest vector."""
    return max((len(v.as_py()) // 8 for t in tables for v in t.column("vec").combine_chunks()), default=0)


def clusters(x: Vectors) -> list[np.ndarray]:
    """Rows of ``x`` dealt out by direction: k-means on unit vectors, begun at evenly spaced rows of the key order."""
    k = max(1, len(x) // MEMBERS)
    centre = x.unit[np.argsort(x.key, kind="stable")[:: max(1, len(x) // k)][:k]]
    for _ in range(ROUNDS):
        near = (x.unit @ centre.T).argmax(1)
        total = np.zeros_like(centre)
        np.add.at(total, near, x.unit)
        length = np.sqrt((total * total).sum(1))
        centre = np.where(length[:, None] > 0, total / np.where(length > 0, length, 1)[:, None], centre)
    near = (x.unit @ centre.T).argmax(1)
    order = np.argsort(near, kind="stable")
    return [g for g in np.split(order, np.flatnonzero(np.diff(near[order])) + 1) if len(g)]


def angles(unit: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centre, -1, 1))


def products(a: Vectors, rows: np.ndarray, b: Vectors, others: np.ndarray) -> np.ndarray:
    """Exact integer inner products; through floating point where every partial sum is exact there."""
    if a.norm.max(initial=0) * b.norm.max(initial=0) < EXACT / 4:
        return (a.f[rows] @ b.f[others].T).astype(np.int64)
    out = a.v[rows].astype(object) @ b.v[others].T.astype(object)
    if out.size and max(abs(out.min()), abs(out.max())) >= 1 << 63:
        raise ValueError("an inner product is beyond 64 bits")
    return out.astype(np.int64)


class Best:
    """The first ``k`` of (score descending, null ids last, id ascending, key) for each of many needs."""

    def __init__(self, n: int, k: int, low: np.ndarray):
        self.k, self.low = k, low.copy()  # low: a row that a need still takes scores this or more
        self.need = np.zeros(0, np.int64)
        self.score, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.n = n

    def add(self, need: np.ndarray, score: np.ndarray, row: np.ndarray, b: Vectors) -> None:
        if not len(need):
            return
        need, score, row = (np.concatenate(x) for x in ((self.need, need), (self.score, score), (self.row, row)))
        order = np.lexsort((b.key[row], b.id[row], b.no_id[row], -score, need))
        need, score, row = need[order], score[order], row[order]
        first = np.searchsorted(need, need, "left")
        place = np.arange(len(need)) - first
        keep = place < self.k
        self.need, self.score, self.row = need[keep], score[keep], row[keep]
        full = place[keep] == self.k - 1
        at = self.need[full]
        self.low[at] = np.maximum(self.low[at], self.score[full])


def walk(a: Vectors, b: Vectors, needs_of: np.ndarray, best: Best, fits: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> None:
    """Every anchor walks its cluster's list of ``b`` until nothing left can enter one of its needs.

    ``needs_of``: the anchor row of each need, ascending. ``fits(needs, rows of b, scores)``: whether a
    candidate may serve a need (a matrix). ``best`` takes what is found.
    """
    if not len(a) or not len(b):
        return
    first = np.searchsorted(needs_of, np.arange(len(a) + 1))
    for members in clusters(a):
        members = members[first[members + 1] > first[members]]
        if not len(members):
            continue
        total = a.unit[members].sum(0)
        length = np.sqrt(total @ total)
        centre = total / length if length > 0 else total
        # a zero vector is at right angles to everything: its members' bound is 0 by their norm
        spread = angles(a.unit[members], centre).max() + 1e-7
        bound = b.norm * np.cos(np.clip(angles(b.unit, centre) - spread, 0, np.pi))
        order = np.argsort(-bound, kind="stable")
        needs = np.concatenate([np.arange(first[m], first[m + 1]) for m in members])
        norm = a.norm[needs_of[needs]]
        for start in range(0, len(order), STEP):
            top = bound[order[start]]
            # products of rounded norms and cosines are off by far less than this
            left = norm * top + 1e-6 * np.abs(norm * top) + 1e-3 >= best.low[needs]
            if not left.any():
                break
            needs, norm = needs[left], norm[left]
            some = order[start : start + STEP]
            rows, at = np.unique(needs_of[needs], return_inverse=True)
            score = products(a, rows, b, some)[at]
            ok = fits(needs, some, score) & (score >= best.low[needs][:, None])
            i, j = np.nonzero(ok)
            best.add(needs[i], score[i, j], some[j], b)


def _meet(vectors: DataFrame, anchors: DataFrame, n: int, n_anchors: int, func, schema: str) -> DataFrame:
    """``func(anchors, candidates)`` of every block of anchors with every block of candidates.

    Blocks are dealt out by hashes of whole rows and have about ANCHORS and CANDIDATES rows whatever
    the data; each pair of blocks is a task's group.
    """
    groups, slices = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n // CANDIDATES))

    def dealt(k: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "key"), F.lit(k)).cast("int")

    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # they come from the same table
    left = anchors.withColumn("g", dealt(groups)).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    right = vectors.withColumn("s", dealt(slices)).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(func, schema)


def _first(df: DataFrame, keys: list[str], k: int, score: str, row: str) -> DataFrame:
    """The first ``k`` rows of each key by score, then id, with ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(f"{row}_id").asc_nulls_last(), f"{row}_key")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives(vectors: DataFrame, anchors: DataFrame, n: int, n_anchors: int, k: int = 5) -> DataFrame:
    """``anchor_id, anchor_key, positive_id, positive_key, positive_score, rank``: each anchor's first ``k`` other rows of its label."""
    schema = pa.schema([("anchor_id", pa.int64()), ("anchor_key", pa.int64()), ("positive_id", pa.int64()), ("positive_key", pa.int64()), ("positive_score", pa.int64())])

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        width = width_of(left, right)
        a, b = Vectors(left, width), Vectors(right, width)
        best = Best(len(a), k, np.full(len(a), np.iinfo(np.int64).min))

        def fits(needs: np.ndarray, rows: np.ndarray, score: np.ndarray) -> np.ndarray:
            same_row = (a.id[needs][:, None] == b.id[rows]) & (a.key[needs][:, None] == b.key[rows]) & ~b.no_id[rows]
            return (a.label[needs][:, None] == b.label[rows]) & ~same_row

        walk(a, b, np.arange(len(a)), best, fits)
        return pa.Table.from_arrays([pa.array(a.id[best.need]), pa.array(a.key[best.need]), pa.array(b.id[best.row], mask=b.no_id[best.row]),
                                     pa.array(b.key[best.row]), pa.array(best.score)], schema=schema)

    found = _meet(vectors, anchors, n, n_anchors, pair, "anchor_id long, anchor_key long, positive_id long, positive_key long, positive_score long")
    return _first(found, ["anchor_id", "anchor_key"], k, "positive_score", "positive")


def negatives(vectors: DataFrame, needs: DataFrame, n: int, n_anchors: int, k: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Each need's first ``k`` rows of another label with ``low * p <= 100 * score <= high * p``, p its positive's score.

    ``needs``: anchors (vec_id, key, label, vec) with ``wanted``, an array of (positive_id, positive_key, positive_score).
    """
    columns = [("anchor_id", pa.int64()), ("anchor_key", pa.int64()), ("positive_id", pa.int64()), ("positive_key", pa.int64()),
               ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("negative_key", pa.int64()), ("negative_score", pa.int64())]
    schema = pa.schema(columns)

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        width = width_of(left, right)
        a, b = Vectors(left, width), Vectors(right, width)
        wanted = [[(w["positive_id"], w["positive_key"], w["positive_score"]) for w in x] for x in left.column("wanted").to_pylist()]
        needs_of = np.repeat(np.arange(len(a)), [len(x) for x in wanted])
        flat = [w for x in wanted for w in x]
        least = np.array([-(-low * p // 100) for _, _, p in flat], np.int64)
        most = np.array([high * p // 100 for _, _, p in flat], np.int64)
        least[least > most] = np.iinfo(np.int64).max  # a negative score of the positive: nothing lies between
        best = Best(len(flat), k, least)

        def fits(needs: np.ndarray, rows: np.ndarray, score: np.ndarray) -> np.ndarray:
            return (a.label[needs_of[needs]][:, None] != b.label[rows]) & (score <= most[needs][:, None])

        walk(a, b, needs_of, best, fits)
        of = needs_of[best.need]
        p_id, p_key, p_score = (pa.array([flat[i][c] for i in best.need.tolist()], pa.int64()) for c in range(3))
        return pa.Table.from_arrays([pa.array(a.id[of]), pa.array(a.key[of]), p_id, p_key, p_score,
                                     pa.array(b.id[best.row], mask=b.no_id[best.row]), pa.array(b.key[best.row]), pa.array(best.score)], schema=schema)

    found = _meet(vectors, needs, n, n_anchors, pair, ", ".join(f"{c} long" for c, _ in columns))
    return _first(found, ["anchor_id", "anchor_key", "positive_id", "positive_key"], k, "negative_score", "negative")


def hard_negatives(embeddings: DataFrame, every: int = 100, n_positives: int = 5, k: int = 10, low: int = 30, high: int = 90, **cleaning) -> DataFrame:
    """Hard negatives of ``embeddings`` (vec_id, embedding, label) for the rows whose id ``every`` divides.

    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Equal rows count
    once; rows without an id serve as candidates behind the ids of the same score, never as anchors. A
    vector that is shorter than another counts as zero beyond its end. Anchors without another row of
    their label have no rows; an empty table gives none. Other columns aren't read.
    """
    vectors = materialize(integer_vectors(embeddings, **cleaning), "vectors")
    queries = vectors.where(F.col("vec_id") % every == 0)
    n, n_anchors = vectors.count(), queries.count()
    found = materialize(positives(vectors, queries, n, n_anchors, n_positives), "positives")
    wanted = found.groupBy("anchor_id", "anchor_key").agg(F.collect_list(F.struct("positive_id", "positive_key", "positive_score")).alias("wanted"))  # n_positives at most
    needs = queries.join(wanted, (F.col("vec_id") == F.col("anchor_id")) & (F.col("key") == F.col("anchor_key"))).select("vec_id", "key", "label", "vec", "wanted")
    out = negatives(vectors, needs, n, n_anchors, k, low, high)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding among all embeddings."""
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), a AS (SELECT vec_id AS anchor_id, label, e FROM v WHERE vec_id % 100 = 0
), s AS (
  SELECT a.anchor_id, v.vec_id, a.label = v.label AS same, list_inner_product(a.e, v.e)::BIGINT AS score
  FROM a JOIN v ON a.anchor_id <> v.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""
