"""Suffix-array dedup: removes bytes covered by a 50-byte string that a smaller document also has.

Texts are written once as blocks of documents, in a table bucketed by block, so that what is found
elsewhere comes back to a block without moving texts again. Each 50-byte window has an anchor, the
smallest-hashed 28-byte string in it; equal windows have equal anchors. Per block, the windows of
one anchor place form a snippet. In turn:

1. exact copies are found by digest: all but the smallest are covered throughout, and left out;
2. each block's distinct anchor hashes meet those of the others, by hash: an anchor of a single
   document can't be part of a match;
3. the other anchors' distinct snippets of each block, with their smallest document, meet by hash.
   There the suffixes of the distinct snippets are sorted (deep-shallow), and every run of equal
   50-byte strings learns its smallest document;
4. each block marks its covered bytes.

An anchor in very many blocks (over 1 GB of texts) is dealt out by digests of its windows in place
of snippets, so no task gets all contexts of a passage that a large part of the documents shares. Occurrences never leave their
block: a task gets each distinct snippet at most once from a block.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import bounded_batches, data, documents, mix64
from riskframe.llm.suffixes import suffix_order
from riskframe.session import checkpoint_root

#: Place of a document without an id: after all others.
LAST = 2**63 - 1


@dataclass(frozen=True)
class SubstringConfig:
    """length: bytes of a repeated string; gram: bytes of an anchor (24 to 32); block: bytes of
    texts in a block (a longer text is one of its own); heavy: blocks from which on an anchor is
    dealt out by windows; bucket: bytes of text per task that compares hashes; part: occurrences of
    shared contents that are numbered together; compared: bytes of contents in a suffix array, unless
    one anchor has more."""

    length: int = 50
    gram: int = 28
    block: int = 8 << 20
    heavy: int = 128
    bucket: int = 16 << 20
    part: int = 1 << 19
    compared: int = 2 << 20

    @property
    def span(self) -> int:
        """Anchor places in a window."""
        return self.length - self.gram + 1


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes at every place."""
    n = len(raw) - gram + 1
    word = np.ndarray(len(raw) - 7, "<u8", raw.tobytes(), strides=(1,)).astype(np.uint64)
    h = word[:n] * np.uint64(0x9E3779B97F4A7C15)
    for at, by in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9), (gram - 8, 0x27D4EB2F165667C5)):
        h = (h ^ (h >> np.uint64(29))) + word[at : at + n]
        h *= np.uint64(by)
    return mix64(h)


def snippets_of(raw: bytes, cfg: SubstringConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) of every anchor place, by place; none for a shorter text."""
    n = len(raw) - cfg.length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = gram_hashes(np.frombuffer(raw, np.uint8), cfg.gram)
    hashes, at = low, np.arange(len(low), dtype=np.int64 if len(low) >> 31 else np.int32)
    # smallest hash of each window, the leftmost of equals: spans of 1, 2, 4 .. places, then the rest
    have = 1
    while have < cfg.span:
        step = min(have, cfg.span - have)
        less = low[step:] < low[:-step]
        low, at = np.where(less, low[step:], low[:-step]), np.where(less, at[step:], at[:-step])
        have += step
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(first[1:], n) - 1
    return hashes[at[first]], first, last


def _anchors(texts: list[tuple[int, int, bytes]], cfg: SubstringConfig, slice_of: int = 1 << 20) -> list[np.ndarray]:
    """Anchors of (document, first byte, text) parts: hash, document, first window, last window.

    Long texts are taken in slices of windows; an anchor whose windows lie in two slices comes twice.
    """
    parts = [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)]
    for doc, begin, raw in texts:
        for at in range(0, len(raw) - cfg.length + 1, slice_of):
            h, first, last = snippets_of(raw[at : at + slice_of + cfg.length - 1], cfg)
            parts.append((h, np.full(len(h), doc), first + (begin + at), last + (begin + at)))
    return [np.concatenate(x) for x in zip(*parts)]


class Block:
    """A block's texts and the anchors of its documents but the copies.

    ``distinct`` and ``buckets`` number the block's distinct hashes by bucket, then hash; both
    later passes see the same numbers.
    """

    def __init__(self, row: dict, buckets: int, cfg: SubstringConfig):
        self.cfg, self.text, self.places = cfg, row["text"], row["places"]
        self.begin = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)
        self.copies = set(row["copies"] or [])
        texts = [(d, a, self.text[a:b]) for d, (a, b) in enumerate(zip(self.begin[:-1].tolist(), self.begin[1:].tolist())) if d not in self.copies]
        h, self.doc, self.first, self.last = _anchors(texts, cfg)
        bucket = h % np.uint64(buckets)
        key = (h // np.uint64(buckets)) & np.uint64((1 << 48) - 1)
        order = np.lexsort((self.doc, key, bucket))
        change = np.ones(len(h), bool)
        change[1:] = (key[order][1:] != key[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        self.number = np.empty(len(h), np.int64)  # of the distinct (bucket, key)
        self.number[order] = np.cumsum(change) - 1
        heads = np.flatnonzero(change)
        self.key, self.bucket = key[order][heads], bucket[order][heads].astype(np.int64)
        doc = self.doc[order]
        tails = np.append(heads[1:], len(h)) - 1
        self.several = doc[tails] != doc[heads] if len(h) else np.zeros(0, bool)

    def per_bucket(self) -> Iterator[tuple[int, slice]]:
        used, begin = np.unique(self.bucket, return_index=True)
        for b, a, z in zip(used.tolist(), begin.tolist(), [*begin[1:].tolist(), len(self.bucket)]):
            yield b, slice(a, z)

    def contents(self, masks: list[dict], buckets: int) -> Iterator[Contents]:
        """Contents of the anchors that other documents have too, in parts of about ``cfg.part`` occurrences."""
        shared, heavy = np.zeros(len(self.key), bool), np.zeros(len(self.key), bool)
        at = dict(self.per_bucket())
        for m in masks:
            s = at[m["bucket"]]
            bits = np.unpackbits(np.frombuffer(m["mask"], np.uint8), count=2 * (s.stop - s.start)).astype(bool)
            shared[s], heavy[s] = bits[::2], bits[1::2]
        pick = np.flatnonzero(shared[self.number])
        hot = heavy[self.number[pick]]
        # equal windows have equal anchors, so parts of whole anchors have no content in common
        many = np.bincount(self.number[pick], np.where(hot, self.last[pick] - self.first[pick] + 1, 1), len(self.key))
        part = ((np.cumsum(many) - many) // self.cfg.part).astype(np.int64)[self.number[pick]]
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
        for k, (a, z) in enumerate(zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)])):
            own = order[a:z]
            yield self._part(k, pick[own[~hot[own]]], pick[own[hot[own]]], buckets)

    def _part(self, k: int, plain: np.ndarray, hot: np.ndarray, buckets: int) -> Contents:
        n, text, places = self.cfg.length, self.text, np.array(self.places, np.int64)
        # snippets: equal ones have one anchor, so one bucket and key
        ids: dict[bytes, int] = {}
        of = np.empty(len(plain), np.int64)
        for a in range(0, len(plain), SLICE):
            some = plain[a : a + SLICE]
            of[a : a + SLICE] = [ids.setdefault(text[f:z], len(ids)) for f, z in zip(self.first[some].tolist(), (self.last[some] + n).tolist())]
        least = np.full(len(ids), LAST)
        np.minimum.at(least, of, places[self.doc[plain]])
        anchor = np.empty(len(ids), np.int64)
        anchor[of] = self.number[plain]
        # windows of heavy anchors: distinct digests, in order
        many = self.last[hot] - self.first[hot] + 1
        doc = np.repeat(self.doc[hot], many)
        first = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.first[hot], many)
        raw = b"".join(b"".join(hashlib.blake2b(text[f : f + n], digest_size=16).digest() for f in first[a : a + SLICE].tolist()) for a in range(0, len(first), SLICE))
        digests, window_of = distinct_digests(np.frombuffer(raw, "<u8").reshape(-1, 2))
        window_least = np.full(len(digests), LAST)
        np.minimum.at(window_least, window_of, places[doc])
        # all contents by bucket, snippets before digests
        bucket = np.concatenate([self.bucket[anchor], (digests[:, 0] % np.uint64(buckets)).astype(np.int64)])
        key = np.concatenate([self.key[anchor], digests[:, 0] // np.uint64(buckets) & np.uint64((1 << 48) - 1)])
        sizes = np.concatenate([np.fromiter(map(len, ids), np.int64, len(ids)), np.full(len(digests), DIGEST)])
        order = np.argsort(bucket, kind="stable")
        number = np.empty(len(order), np.int64)
        used, begin, count = np.unique(bucket[order], return_index=True, return_counts=True)
        number[order] = np.arange(len(order)) - np.repeat(begin, count)
        of = np.concatenate([of, window_of + len(ids)])
        return Contents(k, list(ids), digests, used, begin, order, key, sizes, np.concatenate([least, window_least]),
                        bucket[of], number[of], np.concatenate([self.doc[plain], doc]), np.concatenate([self.first[plain], first]))


#: Bytes of a window's digest, and how many places are read from an array at once.
DIGEST, SLICE = 16, 1 << 16


def distinct_digests(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows of two numbers, number of each row's)."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    change = np.ones(len(order), bool)
    change[1:] = (np.diff(digests[order], axis=0) != 0).any(axis=1)
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(change) - 1
    return digests[order[change]], of


@dataclass(frozen=True)
class Contents:
    """Distinct contents of a block's part, and where they occur (bucket, number of the content in
    it, document, first byte). A content is a snippet, or a heavy anchor's window as a 128-bit
    digest; in a bucket snippets come first. ``order`` has the contents by bucket."""

    part: int
    snippets: list[bytes]
    digests: np.ndarray
    used: np.ndarray
    begin: np.ndarray
    order: np.ndarray
    key: np.ndarray
    sizes: np.ndarray
    least: np.ndarray
    bucket: np.ndarray
    number: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def per_bucket(self) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """(bucket, keys, sizes, smallest places, contents)."""
        for bucket, a, z in zip(self.used.tolist(), self.begin.tolist(), [*self.begin[1:].tolist(), len(self.order)]):
            own = self.order[a:z]
            plain = own[own < len(self.snippets)]
            raw = b"".join([self.snippets[i] for i in plain.tolist()]) + self.digests[own[len(plain) :] - len(self.snippets)].astype("<u8").tobytes()
            yield bucket, self.key[own].astype("<u8").tobytes(), self.sizes[own].astype("<u4").tobytes(), self.least[own].astype("<i8").tobytes(), raw


def planes(x: np.ndarray, width: int) -> bytes:
    """Unsigned integers as ``width`` byte planes, the top one first: sorted numbers compress well so."""
    return np.ascontiguousarray(x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T).tobytes()


def from_planes(raw: bytes, width: int) -> np.ndarray:
    cells = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    out = np.zeros((len(cells), 8), np.uint8)
    out[:, 8 - width :] = cells
    return out.view(">u8").ravel().astype(np.uint64)


BLOCKS = "block long, places array<long>, digests array<binary>, lengths array<long>, text binary"
_BLOCKS = pa.schema([("block", pa.int64()), ("places", pa.list_(pa.int64())), ("digests", pa.list_(pa.binary())), ("lengths", pa.list_(pa.int64())), ("text", pa.binary())])


def write_blocks(docs: DataFrame, cfg: SubstringConfig) -> DataFrame:
    """The documents as blocks, in a table bucketed by block under the shared folder.

    The table leaves the catalog again at once; its files and the returned frame stay usable.
    """
    spark = docs.sparkSession

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(part: list[tuple[int, bytes]]) -> pa.RecordBatch:
            digests = [hashlib.sha256(t).digest() for _, t in part]
            name = int.from_bytes(uuid.uuid4().bytes[:8], "little", signed=True)
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(
                (name, [p for p, _ in part], digests, [len(t) for _, t in part], b"".join(t for _, t in part)), _BLOCKS.types)], schema=_BLOCKS)

        part, size = [], 0
        for b in batches:
            for place, t in zip(*b.columns):
                text = data(t.as_py())
                if part and size + len(text) > cfg.block:
                    yield block(part)
                    part, size = [], 0
                part.append((place.as_py(), text))
                size += len(text)
        if part:
            yield block(part)

    bounded_batches(spark)
    placed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("place"), "text")
    name = f"text_blocks_{uuid.uuid4().hex}"
    path = f"{checkpoint_root(spark)}/llm/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed.mapInArrow(rows, BLOCKS).write.bucketBy(buckets, "block").option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved before the name goes
    spark.sql(f"DROP TABLE {name}")
    return table


def copies_in(blocks: DataFrame) -> DataFrame:
    """(block, copies): numbers of the documents whose whole text a smaller document has."""
    each = blocks.select("block", F.posexplode(F.arrays_zip("places", "digests")).alias("at", "d")).select("block", "at", "d.places", "d.digests")
    first = each.groupBy("digests").agg(F.min("places").alias("least"), F.max("places").alias("most")).where("least < most").select("digests", "least")
    return each.join(first, "digests").where("places > least").groupBy("block").agg(F.collect_list("at").alias("copies"))


def beside(blocks: DataFrame, *sides: DataFrame) -> DataFrame:
    """Blocks with what tables by block say of them; only the latter are shuffled."""
    for s in sides:
        blocks = blocks.join(s.hint("shuffle_hash"), "block", "left")
    return blocks


def shared_anchors(blocks: DataFrame, buckets: int, cfg: SubstringConfig) -> DataFrame:
    """(block, masks): per bucket two bits for each distinct hash of the block, whether several
    documents have it and whether it is heavy."""
    sent = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("several", pa.binary())])
    reply = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("mask", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                own = Block(row, buckets, cfg)
                got = [(k, row["block"], planes(own.key[s], 6), np.packbits(own.several[s]).tobytes()) for k, s in own.per_bucket()]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), sent.types)], schema=sent)

    def meet(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        keys = [from_planes(r["keys"], 6) for r in rows]
        several = np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(k)) for r, k in zip(rows, keys)])
        _, at, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        shared = (n + np.bincount(at, several, minlength=len(n)) > 1)[at]
        bits = np.column_stack([shared, (n > cfg.heavy)[at]])
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        got = [(r["block"], r["bucket"], np.packbits(x.ravel()).tobytes()) for r, x in zip(rows, np.split(bits, cuts)) if x[:, 0].any()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), reply.types)] if got else [pa.array([], t) for t in reply.types], schema=reply)

    hashes = blocks.select("block", "places", "lengths", "text", "copies").mapInArrow(send, "bucket long, block long, keys binary, several binary")
    met = hashes.groupBy("bucket").applyInArrow(meet, "block long, bucket long, mask binary")
    return met.groupBy("block").agg(F.collect_list(F.struct("bucket", "mask")).alias("masks"))


def smallest_of_windows(keys: np.ndarray, contents: list[bytes], places: np.ndarray, length: int, compared: int = 2 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each content (key, bytes, smallest place) the smallest place of each of its windows, over
    all contents: (runs of each content, run lengths, places of runs).

    Contents are distinct. Equal windows are in contents of one key, so contents alone with their
    key are one run; the others' windows are compared through suffix arrays of whole keys, of about
    ``compared`` bytes.
    """
    size = np.fromiter(map(len, contents), np.int64, len(contents))
    windows = size - length + 1
    _, own, n = np.unique(keys, return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(n[own] > 1)
    n_runs = np.ones(len(contents), np.int64)
    if not len(mixed):
        return n_runs, windows, places
    mixed = mixed[np.argsort(own[mixed], kind="stable")]
    heads = np.flatnonzero(np.diff(own[mixed], prepend=-1))
    before = (np.cumsum(size[mixed]) - size[mixed])[heads] // compared  # of a key's first content
    parts = np.append(heads[np.diff(before, prepend=-1) != 0], len(mixed)).tolist()
    found = [_runs([contents[i] for i in mixed[a:z].tolist()], windows[mixed[a:z]], places[mixed[a:z]], length) for a, z in zip(parts, parts[1:])]
    n_runs[mixed] = np.concatenate([f[0] for f in found])
    begin = np.cumsum(n_runs) - n_runs
    lengths, out = np.repeat(windows, n_runs), np.repeat(places, n_runs)
    n = n_runs[mixed]
    into = np.repeat(begin[mixed], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    lengths[into], out[into] = np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found])
    return n_runs, lengths, out


def _runs(contents: list[bytes], windows: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of contents whose windows are all compared."""
    text = b"".join(contents)
    size, n = windows + length - 1, windows
    starts = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(np.cumsum(size) - size, n)
    least = np.zeros(len(text), np.int64)
    least[starts] = np.repeat(places, n)
    order, many = suffix_order(text, starts, length)
    least[order] = np.repeat(np.minimum.reduceat(least[order], np.cumsum(many) - many), many)
    # windows of the contents one after another, cut into runs
    least = least[starts]
    begins = np.zeros(len(least), bool)
    begins[np.cumsum(n) - n] = True
    begins[1:] |= least[1:] != least[:-1]
    heads = np.flatnonzero(begins)
    of = np.repeat(np.arange(len(contents)), n)[heads]
    return np.bincount(of, minlength=len(contents)), np.diff(np.append(heads, len(least))), least[heads]


def smallest_places(blocks: DataFrame, buckets: int, cfg: SubstringConfig) -> DataFrame:
    """(block, found): per bucket and part, for the block's contents in their order, runs of windows
    with the smallest place that has them."""
    sent = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("sizes", pa.binary()), ("places", pa.binary()), ("contents", pa.binary())])
    reply = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("part", pa.int64()), ("n_runs", pa.binary()), ("runs", pa.binary()), ("least", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                for part in Block(row, buckets, cfg).contents(row["masks"], buckets) if row["masks"] else ():
                    for bucket, *found in part.per_bucket():
                        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((bucket, row["block"], part.part, *found), sent.types)], schema=sent)

    def meet(table: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        of_row, digests = [], []
        for i in range(table.num_rows):
            sizes, raw = np.frombuffer(table.column("sizes")[i].as_py(), "<u4"), table.column("contents")[i].as_py()
            ends = np.cumsum(sizes[sizes > DIGEST]).tolist()
            of_row.append(np.array([numbers.setdefault(raw[a:z], len(numbers)) for a, z in zip([0, *ends], ends)], np.int64))
            digests.append(np.frombuffer(raw, "<u8", 2 * (len(sizes) - len(ends)), ends[-1] if ends else 0).reshape(-1, 2))
        of_digest = distinct_digests(np.concatenate(digests))[1]
        ahead = np.cumsum([0, *map(len, digests)])
        of_row = [np.concatenate([own, len(numbers) + of_digest[a:z]]) for own, a, z in zip(of_row, ahead, ahead[1:])]
        every = np.concatenate(of_row)
        keys, least = np.zeros(every.max() + 1, np.uint64), np.full(every.max() + 1, LAST)
        keys[every] = np.concatenate([np.frombuffer(k.as_py(), "<u8") for k in table.column("keys")])
        np.minimum.at(least, every, np.concatenate([np.frombuffer(p.as_py(), "<i8") for p in table.column("places")]))
        n = len(numbers)
        n_runs, runs, values = smallest_of_windows(keys[:n], list(numbers), least[:n], cfg.length, cfg.compared)
        alone = np.ones(len(keys) - n, np.int64)  # a digest is one window
        n_runs, runs, values = np.concatenate([n_runs, alone]), np.concatenate([runs, alone]), np.concatenate([values, least[n:]])
        begin = np.cumsum(n_runs) - n_runs
        got = []
        for i, own in enumerate(of_row):
            n = n_runs[own]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[own], n)
            got.append((*(table.column(c)[i].as_py() for c in ("block", "bucket", "part")), n.astype("<u4").tobytes(), runs[at].astype("<u4").tobytes(), values[at].astype("<i8").tobytes()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), reply.types)], schema=reply)

    sends = blocks.select("block", "places", "lengths", "text", "copies", "masks")
    met = sends.mapInArrow(send, "bucket long, block long, part long, keys binary, sizes binary, places binary, contents binary")
    met = met.groupBy("bucket").applyInArrow(meet, "block long, bucket long, part long, n_runs binary, runs binary, least binary")
    return met.groupBy("block").agg(F.collect_list(F.struct("bucket", "part", "n_runs", "runs", "least")).alias("found"))


def covered_bytes(block: Block, masks: list[dict], found: list[dict], buckets: int) -> np.ndarray:
    """Which bytes of the block go (copies aside)."""
    edge = np.zeros(len(block.text) + 1, np.int32)
    if masks and found:
        replies = {(f["part"], f["bucket"]): f for f in found}
        places = np.array(block.places)
        for part in block.contents(masks, buckets):
            by_bucket = np.argsort(part.bucket, kind="stable")
            begins = np.searchsorted(part.bucket[by_bucket], part.used).tolist()
            for used, a, z in zip(part.used.tolist(), begins, [*begins[1:], len(by_bucket)]):
                f, at = replies[part.part, used], by_bucket[a:z]
                n_runs = np.frombuffer(f["n_runs"], "<u4").astype(np.int64)
                runs, least = np.frombuffer(f["runs"], "<u4").astype(np.int64), np.frombuffer(f["least"], "<i8")
                head = np.cumsum(n_runs) - n_runs
                ahead = np.cumsum(runs) - runs  # windows before a run, over all contents
                content = part.number[at]
                n = n_runs[content]
                own = np.repeat(at, n)
                run = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(head[content], n)
                begin = part.first[own] + ahead[run] - ahead[np.repeat(head[content], n)]
                gone = least[run] < places[part.doc[own]]
                np.add.at(edge, begin[gone], 1)
                np.add.at(edge, begin[gone] + runs[run[gone]] + block.cfg.length - 1, -1)
    return np.cumsum(edge[:-1]) > 0


DEDUPED = "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"
_RUN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
_DEDUPED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(_RUN)), ("kept", pa.binary())])


def substring_dedup(docs: DataFrame, cfg: SubstringConfig = SubstringConfig()) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (removed runs of bytes) and kept (the rest).

    A byte goes if a string of ``cfg.length`` bytes that covers it also starts in a document of a
    smaller id; strings lie within one document and are judged on the input. A null or empty text
    has no bytes; a null id counts as the largest; of rows with equal ids none is smaller, so rows
    repeated in full stay or go alike. Columns other than doc_id and text aren't read.
    """
    spark = docs.sparkSession
    table = write_blocks(docs, cfg)
    total = table.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // cfg.bucket))
    blocks = beside(table, copies_in(table))
    masks = shared_anchors(blocks, buckets, cfg)
    marked = beside(blocks, masks)
    every = beside(marked, smallest_places(marked, buckets, cfg)).select("block", "places", "lengths", "text", "copies", "masks", "found")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = Block(row, buckets, cfg)
                gone = covered_bytes(block, row["masks"] or [], row["found"] or [], buckets)
                raw, out = np.frombuffer(block.text, np.uint8), []
                for d, (a, z) in enumerate(zip(block.begin[:-1].tolist(), block.begin[1:].tolist())):
                    off = np.full(z - a, z - a >= cfg.length) if d in block.copies else gone[a:z]
                    step = np.diff(off.astype(np.int8), prepend=0, append=0)
                    spans = [{"start": s, "stop": e} for s, e in zip(np.flatnonzero(step > 0).tolist(), np.flatnonzero(step < 0).tolist())]
                    place = block.places[d]
                    out.append((None if place == LAST else place, z - a, spans, raw[a:z][~off].tobytes() if spans else block.text[a:z]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _DEDUPED.types)], schema=_DEDUPED)

    return every.mapInArrow(rows, DEDUPED)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every whole document."""
    got = substring_dedup(documents(spark, sf_dir))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.stop - s.start)
    return got.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
