"""Helpers shared by the document operators: inputs, scratch tables, words, components."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.session import checkpoint_root

#: Rows and bytes that Spark hands to a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20

#: Bytes of words: digits, letters and everything beyond ASCII; A-Z become a-z, other bytes a space.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches limited by bytes, so that very long texts don't pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back: it outlives executors."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """(row, __id, __row): the whole row, whatever its columns are called, its id, and the hash of id and text
    by which results name it."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("__id"), F.xxhash64("doc_id", "text").alias("__row"))


def data(value: str | None) -> bytes:
    """A text's UTF-8 bytes; null is empty, a lone surrogate becomes '?'."""
    return b"" if value is None else value.encode("utf-8", "replace")


def fold_words(text: bytes) -> list[bytes]:
    """Lower-cased words (runs of digits, ASCII letters and bytes beyond ASCII)."""
    return text.translate(WORD_TABLE).split()


def sha256_hex(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """Word -> 64-bit hash, filled on demand; emptied when it holds ``bound`` words."""

    bound = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct sorted hashes of all runs of ``n`` word hashes; a shorter text is one run."""
    if not len(words):
        return words
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i])
    return np.unique(h)


def arrow_rows(schema: pa.Schema, rows: Iterable[tuple], size: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of ``size`` rows."""
    part: list[tuple] = []
    for r in rows:
        part.append(r)
        if len(part) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), schema.types)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), schema.types)], schema=schema)


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges ``(a long, b long)``: one row ``(node, label)`` per
    node, label the smallest node of its component.

    Each round links every node to the smallest node it knows of (first from its larger
    neighbours, then from its smaller ones), so paths halve and a round moves as many edges as
    there are nodes; rounds end when every node hangs on one root. A star with very many leaves
    stays a list of edges: no neighbour list is gathered anywhere. Every round is written to the
    shared folder. Empty edges give an empty result.
    """
    def settled(e: DataFrame) -> bool:
        """Every node hangs on one other, on which nothing else is to be done."""
        ends = e.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
            e.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
        each = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
        return each.where("hangs > 1 OR hangs > 0 AND holds > 0").isEmpty()

    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialize(e, name)
    for _ in range(rounds):
        if settled(e):
            break
        # every node's smallest neighbour or itself; its larger neighbours are linked to that
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # every node's smaller neighbours are linked to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        own, other = F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        small = large.join(least, "a").select(F.explode(F.array(own, other)).alias("e"))
        e = materialize(small.select("e.a", "e.b").where("a <> b").distinct(), name)
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
