"""Minority oversampling (SMOTE) with an exact k-nearest-neighbour join.

Neighbours are searched inside each class without pairing every row with
every other row of the class:

1. every vector is projected on one fixed unit direction ``r``; for any two
   points ``|proj_a - proj_b| <= ||a - b||``;
2. the projection is cut into cells of about ``cell_rows`` points, dense cells
   into several blocks. A point's k nearest in its own block give an upper
   bound ``rho`` on its k-th neighbour distance;
3. only rows within ``proj +- rho`` can be true neighbours. Two blocks of which
   one reaches the other meet in one group, which takes the distances of both
   ways from matrix products, keeps k per point and checks those exactly; a
   window limit keeps the top k per point. No row per point pair is ever
   produced, and a group holds two blocks. Vectors of many columns reach
   almost every block, so that a class is then searched whole: rows travel
   ``n_c / cell_rows`` times.

Synthetic rows: class c needs ``n_major - n_c`` rows; row ``s`` of the class
takes base row ``s mod n_c`` (hash order), neighbour ``hash mod k`` and gap
``u ~ U(0,1)``: ``x + u (nn - x)``. All draws are hashes of (seed, class, s),
and the rows come from an evenly partitioned index range.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_key, uniform
from ..session import cut_lineage, written
from ..spec import RANDOM_SEED
from .rank import hash_rank
from .sampling import class_counts


def _direction(dim: int, seed: int) -> list[float]:
    """A fixed unit vector from hash uniforms (Box-Muller)."""
    import hashlib

    def u(i: int) -> float:
        h = hashlib.md5(f"{seed}:direction:{i}".encode()).hexdigest()
        return (int(h[:13], 16) + 0.5) / 2.0**52

    v = [math.sqrt(-2 * math.log(u(2 * i))) * math.cos(2 * math.pi * u(2 * i + 1)) for i in range(dim)]
    n = math.sqrt(sum(x * x for x in v))
    return [x / n for x in v]


#: Distances that a task holds at once.
HELD = 1 << 22


def _best(a: np.ndarray, a_ids: np.ndarray, b: np.ndarray, b_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance) of the k rows of b nearest to each row of a, of another id (ties by id).

    A matrix product gives squared distances up to a bound on its rounding; those that the bound leaves
    in reach of the k-th are taken again, a component after the other.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    with np.errstate(all="ignore"):  # what isn't finite stays a candidate
        a_sq, b_sq = (a * a).sum(1), (b * b).sum(1)
        for at in range(0, len(a), step := max(1, HELD // max(1, len(b)))):
            some, sq = a[at : at + step], a_sq[at : at + step]
            near = sq[:, None] + b_sq - 2 * (some @ b.T)
            other = a_ids[at : at + step, None] != b_ids
            near[~other] = np.inf
            kth = np.partition(near, min(k, len(b)) - 1, axis=1)[:, min(k, len(b)) - 1]
            slack = 16 * (a.shape[1] + 8) * np.finfo(float).eps * (sq + b_sq.max())
            i, j = np.nonzero(~(near > (kth + slack)[:, None]) & other)
            total = np.zeros(len(i))
            for c in range(a.shape[1]):
                gap = some[i, c] - b[j, c]
                total += gap * gap
            distance = np.sqrt(total)
            order = np.lexsort((b_ids[j], distance, i))
            i, j, distance = i[order], j[order], distance[order]
            first = np.arange(len(i)) - np.searchsorted(i, i) < k
            out.append((i[first] + at, j[first], distance[first]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _vectors(part: pa.Table) -> np.ndarray:
    return np.asarray(part.column("v").combine_chunks().flatten()).reshape(part.num_rows, -1)


def knn_within_class(df: DataFrame, id_col: str, label: str, vec: str, k: int = 5, cell_rows: int = 4096,
                     seed: int = RANDOM_SEED, candidates: bool = False):
    """Exact ``(id, label, nn_id, nn_rank, distance)``: the k nearest other rows
    of the same class (Euclidean; ties by neighbour id). With ``candidates``
    the table of each block's best is returned too (to measure the pruning). An empty table has no neighbours."""
    first = df.where(F.col(vec).isNotNull()).select(F.size(vec)).first()
    r = _direction(first[0] if first else 1, seed)
    rv = F.array(*[F.lit(x) for x in r])
    pts = df.where(F.col(id_col).isNotNull()).select(id_col, label, F.col(vec).cast("array<double>").alias("v"))
    pts = pts.withColumn("p", F.aggregate(F.zip_with("v", rv, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x))
    pts = pts.where(F.col("p").isNotNull()).withColumn("__row", F.monotonically_increasing_id())  # it only deals rows to blocks
    # cell width per class: the class's projection range over (n_c / cell_rows) cells
    ext = pts.groupBy(label).agg(F.min("p").alias("pmin"), F.max("p").alias("pmax"), F.count(F.lit(1)).alias("n"))
    ext = ext.withColumn("w", F.greatest((F.col("pmax") - F.col("pmin")) / F.greatest(F.ceil(F.col("n") / cell_rows), F.lit(1)),
                                         F.lit(1e-12)))
    pts = pts.join(ext.select(label, "pmin", "w"), label)  # one row per class; Spark broadcasts it by its size
    pts = pts.withColumn("cell", F.floor((F.col("p") - F.col("pmin")) / F.col("w")).cast("long")).drop("pmin", "w")
    # blocks: the points of a cell, a dense cell split by hash into several
    sizes = pts.groupBy(label, "cell").agg(F.count(F.lit(1)).alias("__cn"))  # one row per cell
    pts = pts.join(sizes, [label, "cell"]).withColumn(
        "__sub", F.pmod(F.xxhash64("__row"), F.ceil(F.col("__cn") / F.lit(cell_rows)))).drop("__cn", "__row")
    pts = cut_lineage(pts)
    types = dict(pts.dtypes)
    found = f"`{id_col}` {types[id_col]}, `{label}` {types[label]}, nn_id {types[id_col]}, distance double"
    block = [label, "cell", "__sub"]

    def pairs_of(a: pa.Table, b: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        ids = [x.column(id_col).combine_chunks() for x in (a, b)]
        codes = np.asarray(pc.rank(pa.concat_arrays(ids), tiebreaker="dense")).astype(np.int64)
        i, j, distance = _best(_vectors(a), codes[: a.num_rows], _vectors(b), codes[a.num_rows :], k)
        at = pa.array(i)
        return pa.table({id_col: ids[0].take(at), label: a.column(label).take(at), "nn_id": ids[1].take(pa.array(j)), "distance": distance}), i, distance

    # stage 1: neighbours inside the own block; the k-th bounds how far on the projection a nearer row can be
    def inside(part: pa.Table) -> pa.Table:
        out, i, distance = pairs_of(part, part)
        rho = np.full(part.num_rows, np.inf)
        ends = np.flatnonzero(np.bincount(i, minlength=part.num_rows) >= k)
        rho[ends] = distance[np.searchsorted(i, ends, "right") - 1]
        p = np.asarray(part.column("p").combine_chunks())
        rho = rho * (1 + 1e-9) + 1e-9 * np.abs(p)  # more than the projection's rounding
        low, high = (float((p - rho).min()), float((p + rho).max())) if np.isfinite(p).all() and np.isfinite(rho).all() else (-math.inf, math.inf)
        n = out.num_rows
        same = {c: part.column(c).take(pa.array(np.zeros(n, np.int64))) for c in ("cell", "__sub")}
        return pa.table({**{c: out.column(c) for c in out.column_names}, **same, "low": np.full(n, low), "high": np.full(n, high)})

    own = written(pts.groupBy(*block).applyInArrow(inside, f"{found}, cell long, __sub long, low double, high double"), "knn-own")

    # stage 2: two blocks of a class meet if either reaches the other; both ways in one matrix
    reach = own.groupBy(*block).agg(F.first("low").alias("low"), F.first("high").alias("high"))
    far, whole = F.lit(float("inf")), ~F.isnan(F.max("p")) & (F.max(F.abs("p")) < F.lit(float("inf")))
    spans = pts.groupBy(*block).agg(F.when(whole, F.min("p")).otherwise(-far).alias("from"), F.when(whole, F.max("p")).otherwise(far).alias("to"))
    spans = written(spans.join(reach, block, "left").withColumns({"low": F.coalesce("low", -far), "high": F.coalesce("high", far)}), "knn-blocks")
    a, b = spans.alias("a"), spans.alias("b")
    reaches = lambda x, y: (F.col(f"{y}.from") <= F.col(f"{x}.high")) & (F.col(f"{y}.to") >= F.col(f"{x}.low"))
    later = F.struct("a.cell", "a.__sub") < F.struct("b.cell", "b.__sub")
    meetings = a.join(b, (F.col(f"a.{label}") == F.col(f"b.{label}")) & later & (reaches("a", "b") | reaches("b", "a")))
    here, there = F.struct("a.cell", "a.__sub"), F.struct("b.cell", "b.__sub")
    sides = meetings.select(F.col(f"a.{label}").alias(label), here.alias("__a"), there.alias("__b"), F.explode(
        F.array(F.struct(F.lit(0).alias("side"), here.alias("at")), F.struct(F.lit(1).alias("side"), there.alias("at")))).alias("__s"))
    sides = written(sides.select(label, F.col("__s.at.cell").alias("cell"), F.col("__s.at.__sub").alias("__sub"), F.col("__s.side").alias("side"),
                                 F.col("__a.cell").alias("__ac"), F.col("__a.__sub").alias("__as"), F.col("__b.cell").alias("__bc"), F.col("__b.__sub").alias("__bs")), "knn-meetings")

    def meet(part: pa.Table) -> pa.Table:
        a, b = (part.filter(pc.equal(part.column("side"), s)) for s in (0, 1))
        return pa.concat_tables([pairs_of(a, b)[0], pairs_of(b, a)[0]])

    met = pts.drop("p").join(sides, block).groupBy(label, "__ac", "__as", "__bc", "__bs").applyInArrow(meet, found)
    every = own.select(id_col, label, "nn_id", "distance").unionByName(met)
    best = Window.partitionBy(id_col).orderBy("distance", "nn_id")
    out = every.withColumn("nn_rank", F.row_number().over(best)).where(F.col("nn_rank") <= k) \
        .select(id_col, label, "nn_id", F.col("nn_rank").cast("int").alias("nn_rank"), "distance")
    return (out, every) if candidates else out


SYNTHETIC_ROWS_PER_PARTITION = 1_000_000


def oversample(df: DataFrame, id_col: str, label: str, vec: str, k: int = 5, seed: int = RANDOM_SEED,
               copy_single: bool = False) -> DataFrame:
    """Synthetic rows ``(id, label, vec, synthetic=True)`` that bring every class
    below the largest one up to its count, unioned with the original rows.

    Synthetic row s (0 <= s < total need) is produced by an evenly partitioned
    ``range``, not by exploding its base row, so a tiny class that needs many
    rows does not load one task. Each minority row is packed with its k
    neighbour vectors (bounded by k) and joined once on (class, rank). A class of
    one row has no neighbour: that raises, or with ``copy_single`` gives copies.
    """
    counts = class_counts(df, label)  # one row per class, checked
    n_major = max(counts.values())
    need = {c: n_major - n for c, n in counts.items() if n < n_major}
    base = df.select(id_col, label, F.col(vec).cast("array<double>").alias(vec))
    orig = base.select(F.col(id_col).cast("string").alias(id_col), label, vec,
                       F.lit(None).cast("string").alias("base_id"), F.lit(None).cast("string").alias("nn_id"),
                       F.lit(None).cast("double").alias("gap"), F.lit(False).alias("synthetic"))
    if not need:
        return orig
    single = sorted((c for c in need if counts[c] == 1), key=str)
    if single and not copy_single:
        raise ValueError(f"classes of one row have no neighbour to interpolate with: {single}")
    spark = df.sparkSession
    ltype = df.schema[label].dataType.simpleString()
    minority = base.where(F.col(label).isin(*need.keys()))
    nn = knn_within_class(minority, id_col, label, vec, k, seed=seed)
    nbr_vecs = nn.join(base.select(F.col(id_col).alias("nn_id"), F.col(vec).alias("__nv")), "nn_id") \
        .groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("nn_rank", "nn_id", "__nv"))).alias("__nbrs"))  # <= k
    ranked = hash_rank(minority, [label], id_col, seed, "smote-base", rank_col="__r")
    packed = ranked.join(nbr_vecs, id_col, "left")

    # synthetic index space: class c owns [off_c, off_c + need_c)
    classes = sorted(need, key=lambda c: (c is None, c))
    offs, acc = [], 0
    for c in classes:
        offs.append((c, acc, int(need[c]), int(counts[c])))
        acc += int(need[c])
    total = acc
    idx = spark.range(0, total, numPartitions=max(1, -(-total // SYNTHETIC_ROWS_PER_PARTITION)))
    cls = None
    for c, off, _, _ in reversed(offs):  # one branch per minority class
        cls = F.when(F.col("id") >= F.lit(off), F.lit(c)) if cls is None else cls.when(F.col("id") >= F.lit(off), F.lit(c))
    plan = spark.createDataFrame(offs, f"{label} {ltype}, __off long, __need long, __n_c long")
    idx = idx.withColumn(label, cls.otherwise(F.lit(None)).cast(ltype))
    idx = idx.join(F.broadcast(plan), label)  # one row per class
    idx = idx.select(label, (F.col("id") - F.col("__off")).alias("__s"), "__n_c")
    idx = idx.withColumn("__r", (F.col("__s") % F.col("__n_c")) + 1)
    joined = idx.join(packed, [label, "__r"])
    skey = F.concat_ws(":", F.col(label).cast("string"), F.col("__s").cast("string"))
    pick = (F.conv(F.substring(hash_key(seed, "smote-nn", skey), 1, 8), 16, 10).cast("bigint") % F.size("__nbrs") + 1)
    joined = joined.withColumn("__nb", F.element_at("__nbrs", pick.cast("int"))) \
        .withColumn("__g", uniform(seed, "smote-gap", skey))
    synth = joined.select(
        F.concat_ws("-", F.lit("s"), F.col(label).cast("string"), F.col("__s").cast("string")).alias(id_col),
        label,
        F.zip_with(F.col(vec), F.coalesce("__nb.__nv", vec), lambda x, y: x + F.col("__g") * (y - x)).alias(vec),
        F.col(id_col).cast("string").alias("base_id"), F.col("__nb.nn_id").cast("string").alias("nn_id"),
        F.col("__g").alias("gap"), F.lit(True).alias("synthetic"),
    )
    return orig.unionByName(synth)


def oversample_columns(df: DataFrame, id_col: str, label: str, features: Sequence[str], k: int = 5,
                       seed: int = RANDOM_SEED) -> DataFrame:
    """SMOTE on feature columns: interpolated as DOUBLE, columns restored."""
    packed = df.select(id_col, label, F.array(*[F.col(c).cast("double") for c in features]).alias("__x"))
    out = oversample(packed, id_col, label, "__x", k, seed)
    return out.select(id_col, label, *[F.col("__x")[i].alias(c) for i, c in enumerate(features)], "synthetic")
