"""Benchmark decontamination over a stored positional inverted index of the training tokens.

The index is split by documents: each row is a segment with the postings of its documents' words.
Test windows go to the segments in blocks of bounded size and are answered there, by intersecting
offset-adjusted posting lists from each window's rarest term on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import WordHashes, arrow_rows, bounded_batches, data, documents, fold_words, materialize, packed

#: Words of a window.
WINDOW = 10
#: Characters of test items sent to the executors at once.
BLOCK_CHARS = 16 << 20
#: Bytes of text in a segment (a longer text is a segment of its own).
SEGMENT_BYTES = 8 << 20
#: Proximity: so many of a window's rarest words within so many words of the rarest.
NEAR_TERMS, NEAR_SPAN = 4, 20


@dataclass
class TestWindows:
    """Distinct windows of a block of items: ``terms[w, i]`` for i < ``size[w]``, and their items.

    ``order[w]`` lists a window's places from the rarest term in the corpus on, the earlier of
    equals first, unused places last.
    """

    terms: np.ndarray
    size: np.ndarray
    item_of: np.ndarray
    window_of: np.ndarray
    items: list[str] = field(default_factory=list)
    order: np.ndarray | None = None

    def ranked(self, terms: np.ndarray, counts: np.ndarray) -> TestWindows:
        """Sets ``order`` by the corpus counts of ``terms`` (sorted; others count 0)."""
        of = np.zeros(self.terms.shape, np.int64)
        if len(terms):
            at = np.minimum(np.searchsorted(terms, self.terms), len(terms) - 1)
            of = np.where(terms[at] == self.terms, counts[at], 0)
        used = np.arange(self.terms.shape[1]) < self.size[:, None]
        self.order = np.argsort(np.where(used, of, np.iinfo(np.int64).max), axis=1, kind="stable")
        return self

    @staticmethod
    def of(rows: list[tuple[str | None, str | None]], window: int = WINDOW) -> TestWindows:
        """From (item_id, text); an item without words has no window, a null id is the empty string."""
        hashes, known, names = WordHashes(), {}, {}
        pairs = set()
        for item, text in rows:
            words = fold_words(data(text))
            h = hashes.of(words).tolist()
            for p in range(max(1, len(h) - window + 1) if h else 0):
                w = known.setdefault(tuple(h[p : p + window]), len(known))
                pairs.add((w, names.setdefault("" if item is None else str(item), len(names))))
        terms, size = np.zeros((len(known), window), np.uint64), np.zeros(len(known), np.int64)
        for w, k in known.items():
            terms[k, : len(w)], size[k] = w, len(w)
        both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        return TestWindows(terms, size, both[:, 1], both[:, 0], list(names))


SEGMENT = "segment string, doc_ids array<long>, keys array<long>, n_words array<long>, terms binary, counts binary, positions binary"
_SEGMENT = pa.schema([("segment", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())),
                      ("terms", pa.binary()), ("counts", pa.binary()), ("positions", pa.binary())])


def build_index(docs: DataFrame, vocabulary: set[bytes] | None = None, name: str = "postings") -> DataFrame:
    """Postings of every document, written to the shared folder.

    A segment holds its documents' words at consecutive positions: ``terms`` (sorted 64-bit hashes),
    ``counts`` and ``positions`` (the terms' posting lists one after another, ascending).
    ``vocabulary`` keeps the postings of its words only; None keeps all.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        if vocabulary is not None:
            known = dict(zip(vocabulary, hashes.of(list(vocabulary)).tolist()))

        def segment(part: list[tuple]) -> tuple:
            at, n_words, terms, places = 0, [], [], []
            for _, _, text in part:
                words = fold_words(text)
                if vocabulary is None:
                    h = hashes.of(words)
                    p = np.arange(len(h))
                else:
                    h = np.fromiter((known.get(w, 0) for w in words), np.uint64, len(words))
                    p = np.flatnonzero(h)
                    h = h[p]
                terms.append(h)
                places.append(p + at)
                n_words.append(len(words))
                at += len(words)
            term, place = np.concatenate(terms), np.concatenate(places)
            order = np.argsort(term, kind="stable")
            distinct, counts = np.unique(term[order], return_counts=True)
            ids = [d for d, _, _ in part]
            return (uuid4().hex, ids, [k for _, k, _ in part], n_words, distinct.astype("<u8").tobytes(), counts.astype("<u4").tobytes(),
                    place[order].astype("<u8" if at >= 1 << 32 else "<u4").tobytes())

        def segments() -> Iterator[tuple]:
            part, size = [], 0
            for b in batches:
                for i, k, t in zip(*b.columns):
                    text = data(t.as_py())
                    if part and size + len(text) > SEGMENT_BYTES:
                        yield segment(part)
                        part, size = [], 0
                    part.append((i.as_py(), k.as_py(), text))
                    size += len(text)
            if part:
                yield segment(part)

        yield from arrow_rows(_SEGMENT, segments(), 1)

    bounded_batches(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("key"), "text")
    return materialize(keyed.mapInArrow(rows, SEGMENT), name)


class Postings:
    """A segment's lists as one ascending array of ``term number * width + position``."""

    def __init__(self, terms: bytes, counts: bytes, positions: bytes, n_words: list[int]):
        self.terms = np.frombuffer(terms, "<u8")
        self.counts = np.frombuffer(counts, "<u4").astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        wide = int(self.counts.sum()) * 8 == len(positions)
        self.positions = np.frombuffer(positions, "<u8" if wide and len(positions) else "<u4").astype(np.int64)
        self.width = int(sum(n_words)) + 1
        self.keys = np.repeat(np.arange(len(self.terms)), self.counts) * self.width + self.positions
        self.doc_start = np.concatenate([[0], np.cumsum(n_words)]).astype(np.int64)

    def has(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each term's list has a position from low to high."""
        at = np.searchsorted(self.keys, term * self.width + low)
        there = at < len(self.keys)
        there[there] = self.keys[at[there]] <= (term * self.width + high)[there]
        return there


def term_counts(index: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``terms`` that the corpus has, sorted, and how often; at most a row per term comes back."""
    sent = index.sparkSession.sparkContext.broadcast(np.unique(terms))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        total = np.zeros(len(wanted), np.int64)
        for b in batches:
            for t, n in zip(b.column(0), b.column(1)):
                own, counts = np.frombuffer(t.as_py(), "<u8"), np.frombuffer(n.as_py(), "<u4")
                if len(own):
                    at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                    total += np.where(own[at] == wanted, counts[at], 0)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[there].view(np.int64)), pa.array(total[there])], names=["term", "n"])

    got = index.select("terms", "counts").mapInArrow(rows, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    found = got.term.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], got.n.to_numpy(np.int64)[order]


def find(p: Postings, t: TestWindows, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window, first position) of every exact occurrence; (window, document) of proximity matches.

    A window's candidates are the postings of its rarest term. Those with the next rarest close by
    are proximity matches; of these, those whose lists all agree after adjusting by the places in
    the window are exact occurrences.
    """
    empty = np.zeros(0, np.int64)
    if not len(p.terms) or not len(t.terms):
        return empty, empty, empty, empty
    number = np.minimum(np.searchsorted(p.terms, t.terms), len(p.terms) - 1)
    length = np.where(p.terms[number] == t.terms, p.counts[number], 0)
    first = np.take_along_axis(length, t.order[:, :NEAR_TERMS], axis=1)
    used = np.arange(first.shape[1]) < t.size[:, None]
    windows = np.flatnonzero((~used | (first > 0)).all(axis=1))  # the rarest terms are here
    rarest = t.order[windows, 0]
    many = length[windows, rarest]
    ends = np.cumsum(many)
    out: list[tuple] = []
    begin = 0
    while begin < len(windows):  # parts of about ``step`` candidates
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + step, "right")))
        n = many[begin:end]
        w, offset = np.repeat(windows[begin:end], n), np.repeat(rarest[begin:end], n)
        at = p.first[number[w, offset]] + np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
        place = p.positions[at]
        doc = np.searchsorted(p.doc_start, place, "right") - 1
        low, high = np.maximum(place - NEAR_SPAN, p.doc_start[doc]), np.minimum(place + NEAR_SPAN, p.doc_start[doc + 1] - 1)
        for j in range(1, min(NEAR_TERMS, t.terms.shape[1])):
            o = t.order[w, j]
            ok = (j >= t.size[w]) | p.has(number[w, o], low, high)
            w, place, doc, low, high = (x[ok] for x in (w, place, doc, low, high))
        near = np.unique(np.column_stack([w, doc]), axis=0) if len(w) else np.zeros((0, 2), np.int64)
        start = place - t.order[w, 0]
        ok = (start >= p.doc_start[doc]) & (start + t.size[w] <= p.doc_start[doc + 1])
        w, start = w[ok], start[ok]
        for j in range(1, t.terms.shape[1]):
            o = t.order[w, j]
            ok = (j >= t.size[w]) | (length[w, o] > 0) & p.has(number[w, o], start + o, start + o)
            w, start = w[ok], start[ok]
        out.append((w, start, near[:, 0], near[:, 1]))
        begin = end
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (empty,) * 4


HITS = "segment string, at long, doc_id long, key long, n_words long, hits array<struct<start: long, stop: long>>, items array<string>, near array<string>"
_RUN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
_HITS = pa.schema([("segment", pa.string()), ("at", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()),
                   ("hits", pa.list_(_RUN)), ("items", pa.list_(pa.string())), ("near", pa.list_(pa.string()))])


def search(index: DataFrame, tests: TestWindows) -> DataFrame:
    """Per document of the index its hit runs of words, the items with exact windows and the items
    with proximity matches."""
    sent = index.sparkSession.sparkContext.broadcast(tests)

    def per_doc(docs: np.ndarray, windows: np.ndarray, t: TestWindows) -> dict[int, list[str]]:
        """Distinct items of (document, window) pairs."""
        order = np.argsort(t.window_of, kind="stable")
        begin = np.searchsorted(t.window_of[order], windows, "left")
        n = np.searchsorted(t.window_of[order], windows, "right") - begin
        items = t.item_of[order[np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]]
        out: dict[int, list[str]] = {}
        for d, i in np.unique(np.column_stack([np.repeat(docs, n), items]), axis=0).tolist():
            out.setdefault(d, []).append(t.items[i])
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        for b in batches:
            for r in b.to_pylist():
                p = Postings(r["terms"], r["counts"], r["positions"], r["n_words"])
                w, start, near_w, near_doc = find(p, t)
                edge = np.zeros(p.width + 1, np.int32)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + t.size[w], -1)
                hit = np.diff((np.cumsum(edge[: p.width]) > 0).astype(np.int8), prepend=0, append=0)
                first, last = np.flatnonzero(hit > 0), np.flatnonzero(hit < 0)
                # a run over two documents is split at their border
                runs: dict[int, list[dict]] = {}
                cuts = np.searchsorted(p.doc_start, first, "right") - 1
                for d, a, z in zip(cuts.tolist(), first.tolist(), last.tolist()):
                    while a < z:
                        stop = min(z, int(p.doc_start[d + 1]))
                        if stop > a:
                            runs.setdefault(d, []).append({"start": a - int(p.doc_start[d]), "stop": stop - int(p.doc_start[d])})
                        a, d = stop, d + 1
                items = per_doc(np.searchsorted(p.doc_start, start, "right") - 1, w, t)
                near = per_doc(near_doc, near_w, t)
                yield from arrow_rows(_HITS, ((r["segment"], d, i, k, n, runs.get(d, []), items.get(d, []), near.get(d, []))
                                              for d, (i, k, n) in enumerate(zip(r["doc_ids"], r["keys"], r["n_words"]))))

    return index.mapInArrow(rows, HITS)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document (doc_id, key, n_words, hits, items, near, n_hit, contaminated).

    Words are lower-cased as in ASCII; windows are ten consecutive words of an item, or all of a
    shorter one. ``hits`` are the words (start, stop) inside exact occurrences of windows, merged;
    ``items`` the items they are of, ``near`` those of which a window's four rarest words in the
    corpus (earlier in the window first, among equals) stand within 20 words of an occurrence of
    the rarest. A null or empty text has no words; an empty
    benchmark hits nothing. Items of one id are one item. Repeated rows are judged each. Columns
    other than doc_id, text, item_id aren't read.

    The items come to the driver in blocks of at most ``BLOCK_CHARS`` characters (one longer item
    aside) and are answered block by block from the same index.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n = max(1, -(-chars // BLOCK_CHARS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))

    def rows(k: int) -> list[tuple]:
        return [tuple(r) for r in (items if n == 1 else items.where(block == k)).collect()]

    first = rows(0)
    index = build_index(docs, {w for _, t in first for w in fold_words(data(t))} if n == 1 else None)
    bounded_batches(spark)
    found = []
    for k in range(n):
        tests = TestWindows.of(first if k == 0 else rows(k))
        found.append(search(index, tests.ranked(*term_counts(index, tests.terms))))
    out = reduce(DataFrame.unionByName, found)
    if n > 1:
        out = out.groupBy("segment", "at", "doc_id", "key", "n_words").agg(
            *(F.array_sort(F.flatten(F.collect_list(c))).alias(c) for c in ("hits", "items", "near")))
    added = F.aggregate("hits", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")), lambda a, x: F.struct(
        (a.n + F.greatest(F.lit(0), x.stop - F.greatest(x.start, a.to))).alias("n"), F.greatest(a.to, x.stop).alias("to")), lambda a: a.n)
    return out.select("doc_id", "key", "n_words", "hits", F.array_distinct("items").alias("items"), F.array_distinct("near").alias("near"),
                      added.alias("n_hit")).withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows (pipeline stage)."""
    bad = decontaminate(docs.select("doc_id", "text"), benchmark).where("contaminated").select("key", "doc_id").distinct()
    on = (F.col("__row") == F.col("key")) & F.col("__id").eqNullSafe(F.col("doc_id"))
    return packed(docs).join(bad.hint("shuffle_hash"), on, "left_anti").select("row.*")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document against every benchmark item."""
    got = decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated", F.size("near").cast("long").alias("n_near"))


_FOLDED = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_AT = "array_to_string(list_slice(w, p, p + n - 1), ' ')"

ORACLE = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_FOLDED} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS n FROM (SELECT item_id, {_FOLDED} AS w FROM benchmark) WHERE len(w) > 0),
bw AS MATERIALIZED (SELECT DISTINCT item, n, {_AT} AS g FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM b)),
dg AS (SELECT doc_id, p, n, {_AT} AS g FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS MATERIALIZED (SELECT DISTINCT doc_id, item, p, dg.n FROM dg JOIN bw ON dg.n = bw.n AND dg.g = bw.g),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY doc_id),
tok AS MATERIALIZED (SELECT doc_id, unnest(range(1, len(w) + 1)) AS q, unnest(w) AS term FROM d),
df AS (SELECT term, count(*) AS c FROM tok GROUP BY term),
win AS (SELECT DISTINCT n, g FROM bw),
pl AS (SELECT n, g, unnest(range(1, n + 1)) AS o, unnest(string_split(g, ' ')) AS term FROM win),
rk AS MATERIALIZED (SELECT n, g, pl.term, row_number() OVER (PARTITION BY n, g ORDER BY coalesce(c, 0), o) AS k FROM pl LEFT JOIN df ON pl.term = df.term),
an AS (SELECT rk.n, rk.g, tok.doc_id, tok.q FROM rk JOIN tok ON rk.term = tok.term WHERE k = 1),
cl AS (SELECT an.n, an.g, an.doc_id, an.q FROM an JOIN rk ON an.n = rk.n AND an.g = rk.g AND k <= {NEAR_TERMS}
       JOIN tok ON tok.doc_id = an.doc_id AND tok.term = rk.term AND tok.q BETWEEN an.q - {NEAR_SPAN} AND an.q + {NEAR_SPAN}
       GROUP BY an.n, an.g, an.doc_id, an.q HAVING count(DISTINCT k) = least(an.n, {NEAR_TERMS})),
nr AS (SELECT doc_id, count(DISTINCT item) AS n_near FROM cl JOIN bw ON cl.n = bw.n AND cl.g = bw.g GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN it ON d.doc_id = it.doc_id LEFT JOIN nr ON d.doc_id = nr.doc_id
"""
