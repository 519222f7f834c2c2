"""Substring dedup by content-defined chunks: a gear rolling hash cuts, digests tell repeats.

Cuts follow the content, so text before or after a passage shifts its chunks but doesn't change
them. Texts lie in blocks of a bucketed table (see ``substring_dedup``); each block sends its
distinct digests with their smallest document, and gets back one bit for each: whether a smaller
document elsewhere has it. Occurrences never leave their block, and a task that compares digests
gets each at most once from a block, however many documents share it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import documents
from riskframe.llm.substring_dedup import LAST, SubstringConfig, beside, copies_in, write_blocks


@dataclass(frozen=True)
class ChunkConfig:
    """least, most: bytes of a chunk (a text's last may be shorter); bits: a place is a cut with
    probability 1/2^bits; run: least bytes of consecutive repeated chunks that are removed (about a
    chunk's size), so that short phrases met by chance stay; block, bucket: bytes of texts in a block and per task."""

    least: int = 16
    most: int = 256
    bits: int = 4
    run: int = 32
    block: int = 8 << 20
    bucket: int = 64 << 20


#: A random 16-bit number per byte value; the rolling hash sees the last 16 bytes.
GEAR = np.random.default_rng(20).integers(0, 1 << 16, 256, np.uint16)


def rolling(raw: bytes) -> np.ndarray:
    """The gear hash after every byte: h = (h << 1) + GEAR[byte], modulo 2^16."""
    h = GEAR[np.frombuffer(raw, np.uint8)]
    for s in (1, 2, 4, 8):
        more = h.copy()
        more[s:] += h[:-s] << np.uint16(s)
        h = more
    return h


def chunk_ends(raw: bytes, cfg: ChunkConfig) -> list[int]:
    """Ends of the chunks, between characters: the first cut place at least ``least`` bytes on, or
    the last character's end within ``most`` bytes."""
    if not raw:
        return []
    buf = np.frombuffer(raw, np.uint8)
    edge = np.ones(len(buf), bool)
    edge[:-1] = (buf[1:] & 0xC0) != 0x80
    places = np.flatnonzero((rolling(raw) >> np.uint16(16 - cfg.bits) == 0) & edge) + 1
    ends, last, n = [], 0, len(raw)
    for p in [*places.tolist(), n]:
        while p - last > cfg.most:
            last += cfg.most
            while not edge[last - 1]:
                last -= 1
            ends.append(last)
        if p - last >= cfg.least or p == n and p > last:
            ends.append(p)
            last = p
    return ends


class Chunks:
    """A block's chunks but those of copies: document, start, end, and the number of the digest.

    Distinct digests are numbered by bucket, then digest; both passes see the same numbers.
    """

    def __init__(self, row: dict, buckets: int, cfg: ChunkConfig):
        self.text, self.places = row["text"], np.array(row["places"], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)
        self.copies = set(row["copies"] or [])
        doc, start, end, digests = [], [], [], []
        for d, (a, b) in enumerate(zip(self.begin[:-1].tolist(), self.begin[1:].tolist())):
            if d not in self.copies:
                raw = self.text[a:b]
                ends = chunk_ends(raw, cfg)
                starts = [0, *ends][:-1]
                digests += [hashlib.blake2b(raw[s:e], digest_size=16).digest() for s, e in zip(starts, ends)]
                doc += [d] * len(ends)
                start += starts
                end += ends
        self.doc, self.start, self.end = (np.array(x, np.int64) for x in (doc, start, end))
        halves = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
        place = self.places[self.doc]
        bucket = (halves[:, 0] % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((place, halves[:, 1], halves[:, 0], bucket))
        sorted_halves = halves[order]
        new = np.ones(len(order), bool)
        new[1:] = (sorted_halves[1:] != sorted_halves[:-1]).any(axis=1)
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        heads = order[new]
        self.digest, self.bucket, self.least = halves[heads], bucket[heads], place[heads]

    def per_bucket(self) -> Iterator[tuple[int, slice]]:
        used, begin = np.unique(self.bucket, return_index=True)
        for b, a, z in zip(used.tolist(), begin.tolist(), [*begin[1:].tolist(), len(self.bucket)]):
            yield b, slice(a, z)

    def repeated(self, masks: list[dict]) -> np.ndarray:
        """Chunks that a smaller document has."""
        elsewhere = np.zeros(len(self.bucket), bool)
        at = dict(self.per_bucket())
        for m in masks:
            s = at[m["bucket"]]
            elsewhere[s] = np.unpackbits(np.frombuffer(m["mask"], np.uint8), count=s.stop - s.start)
        return elsewhere[self.number] | (self.places[self.doc] > self.least[self.number])


def digests_elsewhere(blocks: DataFrame, buckets: int, cfg: ChunkConfig) -> DataFrame:
    """(block, masks): per bucket a bit for each distinct digest of the block, whether a document
    smaller than all of the block's that have it has it too."""
    sent = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("digests", pa.binary()), ("places", pa.binary())])
    reply = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("mask", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                own = Chunks(row, buckets, cfg)
                for k, s in own.per_bucket():
                    yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(
                        (k, row["block"], own.digest[s].tobytes(), own.least[s].astype("<i8").tobytes()), sent.types)], schema=sent)

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        digests = np.concatenate([np.frombuffer(r["digests"], "<u8").reshape(-1, 2) for r in rows])
        places = np.concatenate([np.frombuffer(r["places"], "<i8") for r in rows])
        order = np.lexsort((places, digests[:, 1], digests[:, 0]))
        new = np.ones(len(order), bool)
        new[1:] = (digests[order][1:] != digests[order][:-1]).any(axis=1)
        least = np.empty(len(order), np.int64)
        least[order] = places[order[new]][np.cumsum(new) - 1]
        smaller = least < places
        cuts = np.cumsum([len(r["places"]) // 8 for r in rows])[:-1]
        got = [(r["block"], r["bucket"], np.packbits(x).tobytes()) for r, x in zip(rows, np.split(smaller, cuts)) if x.any()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), reply.types)] if got else [pa.array([], t) for t in reply.types], schema=reply)

    met = blocks.select("block", "places", "lengths", "text", "copies").mapInArrow(send, "bucket long, block long, digests binary, places binary")
    met = met.groupBy("bucket").applyInArrow(meet, "block long, bucket long, mask binary")
    return met.groupBy("block").agg(F.collect_list(F.struct("bucket", "mask")).alias("masks"))


OUT = "doc_id long, text string, n_bytes long, n_chunks long, spans array<struct<start: long, stop: long>>"
_RUN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_bytes", pa.int64()), ("n_chunks", pa.int64()), ("spans", pa.list_(_RUN))])


def chunk_dedup(docs: DataFrame, cfg: ChunkConfig = ChunkConfig()) -> DataFrame:
    """One row per document: doc_id, text (what is left), n_bytes, n_chunks, spans (bytes removed).

    Runs of chunks that documents of smaller ids also have go if they are at least ``cfg.run`` bytes
    long; judged on the input. Chunks repeated within a document only, and the first document of
    each, stay. A null or empty text has no chunks and gives an empty text. A null id counts as the
    largest; rows with equal ids aren't smaller than each other, so rows repeated in full stay or go
    alike. A whole copy of a smaller document is not cut into chunks (n_chunks 0): it goes whole,
    however short. Columns other than doc_id and text aren't read.
    """
    spark = docs.sparkSession
    table = write_blocks(docs, SubstringConfig(block=cfg.block))
    total = table.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // cfg.bucket))
    blocks = beside(table, copies_in(table))
    every = beside(blocks, digests_elsewhere(blocks, buckets, cfg)).select("block", "places", "lengths", "text", "copies", "masks")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                own = Chunks(row, buckets, cfg)
                again = own.repeated(row["masks"] or [])
                first = np.searchsorted(own.doc, np.arange(len(own.places) + 1))
                out = []
                for d, (a, z) in enumerate(zip(own.begin[:-1].tolist(), own.begin[1:].tolist())):
                    raw, chunks = own.text[a:z], slice(first[d], first[d + 1])
                    step = np.diff(again[chunks].astype(np.int8), prepend=0, append=0)
                    runs = zip(own.start[chunks][np.flatnonzero(step[:-1] > 0)].tolist(), own.end[chunks][np.flatnonzero(step < 0) - 1].tolist())
                    spans = [(s, e) for s, e in runs if e - s >= cfg.run]
                    if d in own.copies and raw:
                        spans = [(0, len(raw))]
                    kept = b"".join(raw[s:e] for s, e in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(raw)]))
                    place = int(own.places[d])
                    out.append((None if place == LAST else place, kept.decode(), len(raw), chunks.stop - chunks.start, [{"start": s, "stop": e} for s, e in spans]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _OUT.types)], schema=_OUT)

    return every.mapInArrow(rows, OUT)


def op3_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document without the runs of chunks that smaller documents have."""
    got = chunk_dedup(documents(spark, sf_dir))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.stop - s.start)
    return got.select("doc_id", "text", "n_bytes", "n_chunks", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"))
