"""Quality rules: hashed n-gram log-likelihood ratio of trusted against raw text, plus counting rules."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import arrow_rows, bounded_batches, data, documents

SYMBOLS = frozenset(b"#*$%&|<>")
DROP_ALL_BUT_SYMBOLS = bytes(c for c in range(256) if c not in SYMBOLS)


@dataclass(frozen=True)
class QualityConfig:
    """Parameters of the rules.

    buckets: size of the two multinomials over hashed words and word pairs; it bounds the model,
        which is the only thing gathered (2 x buckets counts).
    prior: pseudo-counts per bucket added to the target, dealt out like the raw corpus, so that
        little trusted text gives ratios near 0.
    min_score: least mean log-likelihood ratio (nats per n-gram) of a kept document.
    trusted: most labelled rows (quality 1) that form the trusted target, smallest hashes first.
    min_words, repeat_percent: the base rule.
    """

    buckets: int = 10_000
    prior: float = 20.0
    min_score: float = -0.06
    trusted: int = 100_000
    min_words: int = 50
    repeat_percent: int = 50


class _Hashes(dict):
    """Word -> crc32, emptied when it holds a quarter of a million words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 250_000:
            self.clear()
        h = self[word] = crc32(word)
        return h


def _buckets(words: list[bytes], hashes: _Hashes, size: int) -> np.ndarray:
    """Bucket of every word and of every pair of neighbours."""
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(24)
    return (np.concatenate([h, pairs]) % np.uint64(size)).astype(np.int64)


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    chars = sum(map(len, words)) if text.isascii() else len(b"".join(words).decode("utf-8"))
    symbols = len(text.translate(None, DROP_ALL_BUT_SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    repeats = 0
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) < len(windows):
        reached = 0  # words before this one are counted already
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeats += i + 3 - max(reached, i)
                reached = i + 3
    return chars, symbols, len(lines) - len(set(lines)), repeats


def trusted_ids(spark: SparkSession, labels: DataFrame, cfg: QualityConfig) -> DataFrame:
    """Ids of the trusted target: at most ``cfg.trusted`` labelled rows of quality 1, by hash."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(cfg.trusted)


def fit(docs: DataFrame, trusted: DataFrame, cfg: QualityConfig = QualityConfig()) -> np.ndarray:
    """Log ratio of every bucket: trusted target against the whole raw corpus.

    Counts of all documents are summed within each task, then across tasks; what comes to the
    driver is one row per bucket, whatever the corpus holds. No trusted text gives zeros.
    """
    size = cfg.buckets
    schema = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = _Hashes(), np.zeros((2, size), np.int64)
        for b in batches:
            for text, good in zip(b.column(0), b.column(1)):
                words = data(text.as_py()).split()
                if words:
                    c = np.bincount(_buckets(words, hashes, size), minlength=size)
                    counts[0] += c
                    if good.as_py():
                        counts[1] += c
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[0][at]), pa.array(counts[1][at])], schema=schema)

    bounded_batches(docs.sparkSession)
    marked = docs.select("text", "doc_id").join(F.broadcast(trusted.withColumn("good", F.lit(True))), "doc_id", "left")
    got = marked.select("text", F.coalesce("good", F.lit(False)).alias("good")).mapInArrow(count, "bucket int, raw long, target long")
    got = got.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(size), np.zeros(size)
    raw[got.bucket], target[got.bucket] = got.raw, got.target
    if not target.sum():
        return np.zeros(size)
    share = np.divide(raw, raw.sum())
    prior = cfg.prior * size
    ratios, there = np.zeros(size), raw > 0
    ratios[there] = np.log((target[there] + prior * share[there]) / (target.sum() + prior) / share[there])
    return ratios


SCORED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, score double")


def score(docs: DataFrame, ratios: np.ndarray, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """One row per document with the base counts, the mean log ratio and the verdict.

    A null or empty text has no words: zero counts, score 0, base_failed. Ties need no rule: the
    score is compared by ``>=``. Repeated rows are scored each; other columns aren't read.
    """
    schema = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                       + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("score", pa.float64())])
    size = cfg.buckets

    def one(doc_id: int | None, text: str | None, hashes: _Hashes) -> tuple:
        raw = data(text)
        words = raw.split()
        n, counts = len(words), base_counts(raw, words)
        failed = n < cfg.min_words or 100 * counts[3] > cfg.repeat_percent * n
        # rounded, so that the order in which a machine adds up can't turn a verdict
        mean = round(float(ratios[_buckets(words, hashes, size)].mean()), 9) if n else 0.0
        return doc_id, n, *counts, failed, not failed and mean >= cfg.min_score, mean

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        yield from arrow_rows(schema, (one(i.as_py(), t.as_py(), hashes) for b in batches for i, t in zip(b.column(0), b.column(1))))

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, SCORED)


def quality_rules(spark: SparkSession, docs: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """Fits the two multinomials on ``docs`` and judges every document of ``docs``."""
    return score(docs, fit(docs, trusted_ids(spark, labels, cfg), cfg), cfg)


def keep_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """``docs`` without the rejected rows, columns unchanged (pipeline stage)."""
    ratios = fit(docs, trusted_ids(spark, labels, cfg), cfg)
    size, schema = cfg.buckets, docs.schema
    at = schema.names.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            good = []
            for t in b.column(at):
                raw = data(t.as_py())
                words = raw.split()
                good.append(bool(
                    len(words) >= cfg.min_words
                    and 100 * base_counts(raw, words)[3] <= cfg.repeat_percent * len(words)
                    and round(float(ratios[_buckets(words, hashes, size)].mean()), 9) >= cfg.min_score))
            yield b.filter(pa.array(good, pa.bool_()))

    bounded_batches(spark)
    # numbered, since names with dots don't reach a Python worker
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))).mapInArrow(keep, schema)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counting rules and hashed n-gram likelihood ratio over every whole document."""
    return quality_rules(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
