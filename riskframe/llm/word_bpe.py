"""BPE with word ends: part boundaries and the ranks of adjacent parts in contiguous arrays.

A word's parts lie in one row of an array, the ranks of its adjacent pairs in a second one. The row is
scanned for its smallest rank, the boundary between that pair is deleted by moving the rest of the row
up, and the ranks to the left and right of the new part are looked up again, until no pair of the row
has a rank. Many short words are worked on at once, a row each.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import arrow_rows, bounded_batches, documents, sha256_hex

#: Rank of a pair that nothing joins.
NONE = np.int32(2**31 - 1)
#: Widths of the arrays; longer words have a heap instead, since scanning them is quadratic.
WIDTHS = (4, 8, 12, 16, 24, 40, 64)
#: White space of Python that the vocabulary's pattern takes for signs.
SIGNS = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself where it prints, else from U+0100 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens, merges, pattern and special tokens of a vocabulary file (its JSON text)."""

    def __init__(self, raw: bytes):
        whole = json.loads(raw)
        model, kinds = whole["model"], [x["type"] for x in whole["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or whole.get("decoder") is not None:
            raise ValueError("not a vocabulary of lower-cased words with word ends")
        ids: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in whole["added_tokens"]}
        self.tokens = {i: t for t, i in (ids | self.special).items()}
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int32)
        self.last = np.array([ids[c + end] for c in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of_key = keys[order], order.astype(np.int32)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.find = regex.compile(whole["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.mark = commonprefix(list(self.special))  # text without it has no special token; "" is in every text
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, ``NONE`` where nothing joins it (or a side is -1)."""
        pair = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where((self.keys[at] == pair) & (left >= 0) & (right >= 0), self.rank_of_key[at], NONE)


def merge_rows(parts: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The parts of many words after all merges; a row per word, -1 beyond its parts.

    The last column of ``parts`` must be -1. Of equal ranks the leftmost goes first.
    """
    out = parts.copy()
    ranks = np.full(parts.shape, NONE, np.int32)
    ranks[:, :-1] = v.ranks(parts[:, :-1], parts[:, 1:])
    live, column = np.arange(len(parts)), np.arange(parts.shape[1])
    while len(live):
        at = ranks.argmin(1)
        best = np.take_along_axis(ranks, at[:, None], 1)[:, 0]
        more = best < NONE
        if not more.all():
            out[live[~more]] = parts[~more]
            live, parts, ranks, at, best = live[more], parts[more], ranks[more], at[more], best[more]
        # without the boundary behind ``at``, all that follows moves up by one
        source = np.minimum(column + (column > at[:, None]), column[-1])
        parts, ranks = np.take_along_axis(parts, source, 1), np.take_along_axis(ranks, source, 1)
        row = np.arange(len(live))
        parts[row, at] = v.made[best]
        ranks[row, at] = v.ranks(parts[row, at], parts[row, at + 1])
        row, at = row[at > 0], at[at > 0]
        ranks[row, at - 1] = v.ranks(parts[row, at - 1], parts[row, at])
    return out


def merge_long(parts: list[int], v: Vocabulary) -> list[int]:
    """The parts of one long word after all merges: linked parts and a heap of (rank, place)."""
    n = len(parts)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    whole = np.array(parts, np.int64)
    ranks = v.ranks(whole[:-1], whole[1:])
    heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(ranks.tolist()) if r < NONE]
    heapify(heap)
    known: dict[tuple[int, int], int] = {}

    def offer(i: int, j: int) -> None:
        pair = parts[i], parts[j]
        if pair not in known:
            known[pair] = int(v.ranks(np.array([pair[0]]), np.array([pair[1]]))[0])
        if known[pair] < NONE:
            heappush(heap, (known[pair], i, *pair))

    while heap:
        r, i, a, b = heappop(heap)
        j = right[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue  # one of the two has been merged meanwhile
        parts[i], parts[j], k = int(v.made[r]), -1, right[j]
        right[i] = k
        if k < n:
            left[k] = i
            offer(i, k)
        if left[i] >= 0:
            offer(left[i], i)
    return [p for p in parts if p >= 0]


def merge_words(words: list[bytes], v: Vocabulary) -> list[bytes]:
    """Token ids of each word as little-endian unsigned 32-bit integers."""
    out = [b""] * len(words)
    length = np.array([len(w) for w in words], np.int64)
    low = 0
    for width in WIDTHS:
        some = np.flatnonzero((length > low) & (length <= width))
        low = width
        if not len(some):
            continue
        n = length[some]
        text = np.frombuffer(b"".join(words[i].ljust(width + 1, b"\0") for i in some.tolist()), np.uint8).reshape(len(some), width + 1)
        column = np.arange(width + 1)
        parts = np.where(column < n[:, None], v.inner[text], np.int32(-1))
        row = np.arange(len(some))
        parts[row, n - 1] = v.last[text[row, n - 1]]
        merged = merge_rows(parts, v)
        ids = merged[merged >= 0].astype("<u4").tobytes()
        ends = (4 * np.cumsum((merged >= 0).sum(1))).tolist()
        for i, a, b in zip(some.tolist(), [0, *ends], ends):
            out[i] = ids[a:b]
    for i in np.flatnonzero(length > low).tolist():
        text = np.frombuffer(words[i], np.uint8)
        out[i] = np.array(merge_long([*v.inner[text[:-1]].tolist(), int(v.last[text[-1]])], v), "<u4").tobytes()
    return out


class Codec:
    """Encodes and decodes texts; ids of pieces between white space are kept, up to ``bound`` characters of them."""

    bound = 6 << 20

    def __init__(self, raw: bytes):
        self.v, self.known, self.size = Vocabulary(raw), {}, 0
        self.special = {i: i.to_bytes(4, "little") for i in self.v.special.values()}

    def pieces(self, text: str) -> list[str]:
        """The text between white space; no token reaches over it."""
        return text.split() if SIGNS.search(text) is None else regex.split(r"[\s--\x1c-\x1f]+", text, flags=regex.V1)

    def words(self, piece: str) -> list[str | int]:
        """The words of a piece, special tokens as their ids."""
        if self.v.mark not in piece and piece.isascii():
            return self.v.find(piece.lower())
        out: list[str | int] = []
        for x in self.v.cut(piece):
            if x in self.v.special:
                out.append(self.v.special[x])
            elif x:  # lower case letter by letter: no rule for the sigma that ends a word
                out += self.v.find((x if x.isascii() else unicodedata.normalize("NFC", x).replace("Σ", "σ")).lower())
        return out

    def learn(self, pieces: list[str]) -> None:
        split = list(map(self.words, pieces))
        fresh = list({w for words in split for w in words if w.__class__ is str})
        ids = self.special | dict(zip(fresh, merge_words([w.encode() for w in fresh], self.v)))
        join, of = b"".join, ids.__getitem__
        self.known.update(zip(pieces, [join(map(of, words)) for words in split]))
        self.size += sum(map(len, pieces))

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces = list(map(self.pieces, texts))
        if self.size > self.bound:
            self.known, self.size = {}, 0
        self.learn(list(set().union(*pieces).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, some)) for some in pieces]

    def decode(self, ids: list[int]) -> str:
        """The tokens' text as the vocabulary writes it, a space between tokens."""
        return " ".join(map(self.v.tokens.__getitem__, ids))


_CODECS: dict[int, Codec] = {}


def codec_of(raw: Broadcast) -> Codec:
    """The worker's codec for a vocabulary, so that its next task needn't begin anew."""
    key = hash(raw.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(raw.value)
    return _CODECS[key]


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file's bytes, read on the driver and sent to the executors (a file of fixed size)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _some(batch: pa.RecordBatch, size: int) -> Iterator[tuple[list, list[str]]]:
    """(doc ids, texts) of a batch, about ``size`` characters at a time or one longer text."""
    ids, texts, n = [], [], 0
    for i, t in zip(batch.column(0), batch.column(1)):
        ids.append(i.as_py())
        texts.append(t.as_py() or "")
        n += len(texts[-1])
        if n >= size:
            yield ids, texts
            ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


def encode(docs: DataFrame, path: str, size: int = 1 << 20) -> DataFrame:
    """``doc_id long, ids array<int>``: the token ids of every whole text.

    A null or empty text has no ids. Text is composed (NFC), lower-cased and cut into words by the
    vocabulary's pattern, each encoded by itself; a special token's text is that token. Repeated rows
    are encoded each; other columns aren't read. Letters, digits and cases are those of the running
    Python's Unicode tables: signs that a newer or older Unicode version knows may be cut otherwise.
    """
    raw = vocabulary(docs.sparkSession, path)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(raw)
        for b in batches:
            for ids, texts in _some(b, size):
                yield from arrow_rows(schema, ((i, np.frombuffer(x, "<i4")) for i, x in zip(ids, codec.encode(texts))), 200)

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id long, decoded string`` of ``encoded`` (doc_id, ids); null ids are none."""
    raw = vocabulary(encoded.sparkSession, path)
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(raw)
        for b in batches:
            yield from arrow_rows(schema, ((i.as_py(), codec.decode(x.as_py() or [])) for i, x in zip(b.column(0), b.column(1))), 200)

    bounded_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, decoded string")


def round_trip(docs: DataFrame, path: str, size: int = 1 << 20) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every text encoded, its ids decoded, both hashed.

    The same as :func:`encode` followed by :func:`decode`, in one Python worker, so that a task holds
    the vocabulary once and no ids travel. Digests are of the decimal ids joined by a space and of the
    decoded text in UTF-8.
    """
    raw = vocabulary(docs.sparkSession, path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(raw)
        decimal = {i: str(i) for i in codec.v.tokens}.__getitem__

        def digest(doc: int | None, ids: list[int]) -> tuple:
            return doc, len(ids), sha256_hex(" ".join(map(decimal, ids)).encode()), sha256_hex(codec.decode(ids).encode())

        for b in batches:
            for ids, texts in _some(b, size):
                yield from arrow_rows(schema, (digest(i, np.frombuffer(x, "<u4").tolist()) for i, x in zip(ids, codec.encode(texts))))

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded by the public vocabulary of lower-cased words and decoded."""
    import public_tokenizers

    return round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
