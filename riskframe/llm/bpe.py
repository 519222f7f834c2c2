"""Byte-level BPE: merges replayed in rank order over an inverted index of token pairs."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import arrow_rows, bounded_batches, data, documents, sha256_hex


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of ``base64 rank`` lines."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


#: Token of a place between two words, and of a place that a merge has taken up.
BETWEEN, TAKEN = 1 << 24, -1


class Pairs(dict):
    """(left token << 25 | right token) -> the token that they join to, or -1.

    All pairs that join are in two sorted arrays, made once from the ways to cut a token in two; the
    dictionary keeps what was asked for one by one, up to ``bound`` pairs.
    """

    bound = 200_000

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {i: t for t, i in ranks.items()}
        cuts = [(a << 25 | b, r) for t, r in ranks.items() for k in range(1, len(t))
                if (a := ranks.get(t[:k])) is not None and (b := ranks.get(t[k:])) is not None]
        both = np.array(cuts or [(-1, -1)], np.int64)
        both = both[np.argsort(both[:, 0], kind="stable")]
        self.keys, self.made = both[:, 0].copy(), both[:, 1].copy()

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What many pairs join to."""
        pair = left << 25 | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.made[at], -1)

    def __missing__(self, pair: int) -> int:
        a, b = self.tokens.get(pair >> 25), self.tokens.get(pair & (1 << 25) - 1)
        r = -1 if a is None or b is None else self.ranks.get(a + b, -1)
        if len(self) >= self.bound:
            self.clear()
        self[pair] = r
        return r


class Places:
    """Words' bytes one after another, a place between two words: tokens, neighbours, what each pair joins to, and the
    inverted index from that token to the pairs' places."""

    #: Fewer places of a rank than this, on the average of ``TRIED`` ranks, are quicker one by one.
    MANY, TRIED = 24, 64

    def __init__(self, words: list[bytes], pairs: Pairs):
        self.pairs, self.n = pairs, len(words)
        self.lengths = np.array([len(w) + 1 for w in words], np.int64)
        text = np.frombuffer(b"".join(w + b"\0" for w in words), np.uint8)
        single = np.array([pairs.ranks[bytes([c])] for c in range(256)], np.int64)
        self.token = np.concatenate([[BETWEEN], single[text]])
        self.token[np.cumsum(self.lengths)] = BETWEEN
        size = len(self.token)
        self.word = np.concatenate([[-1], np.repeat(np.arange(self.n), self.lengths)])
        self.right, self.left = np.arange(1, size + 1), np.arange(-1, size - 1)
        self.joins = np.concatenate([pairs.of(self.token[:-1], self.token[1:]), [-1]])
        self.index: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []
        self.enter(np.flatnonzero(self.joins >= 0))

    def enter(self, places: np.ndarray) -> None:
        """The places' pairs into the index."""
        made = self.joins[places]
        order = np.argsort(made, kind="stable")
        made, places = made[order], places[order]
        ends = np.flatnonzero(np.diff(made, append=-2)) + 1
        begin = 0
        for r, end in zip(made[ends - 1].tolist(), ends.tolist()):
            if r in self.index:
                self.index[r].append(places[begin:end])
            else:
                self.index[r] = [places[begin:end]]
                heappush(self.heap, r)
            begin = end

    def merge_many(self) -> set[int]:
        """Merges of all places of a rank at once, smallest ranks first, as long as ranks have many places.

        Returns words to be merged by themselves: where a merge makes a pair of a smaller rank, that
        pair goes before the word's further places of the rank at work.
        """
        token, right, left, joins, of = self.token, self.right, self.left, self.joins, self.pairs.of
        alone: set[int] = set()
        seen = count = 0
        while self.heap:
            if count == self.TRIED:
                if seen < self.MANY * self.TRIED:
                    break
                seen = count = 0
            r = heappop(self.heap)
            places = self.index.pop(r)
            p = np.unique(np.concatenate(places)) if len(places) > 1 else places[0]
            count, seen = count + 1, seen + len(p)
            p = p[joins[p] == r]
            if not len(p):
                continue
            begins = np.ones(len(p), bool)
            begins[1:] = right[p[:-1]] != p[1:]
            if not begins.all():  # places that overlap: of a run every second one goes
                number = np.arange(len(p))
                p = p[(number - np.maximum.accumulate(np.where(begins, number, 0))) % 2 == 0]
            q, before = right[p], left[p]
            after = right[q]
            high = np.full(len(p), r, np.int64)
            first = of(high, token[after])  # before what follows is merged as well
            token[p], token[q], joins[q], joins[p] = r, TAKEN, -1, -1
            right[p], left[after] = after, p
            y = of(token[before], high)
            early = ((first >= 0) & (first < r)) | ((y >= 0) & (y < r))
            if early.any():
                alone.update(self.word[p[early]].tolist())
            joins[before] = y
            joins[p] = of(high, token[after])
            new = np.concatenate([p, before])
            new = np.unique(new[joins[new] >= 0])
            self.enter(new)
        return alone


def replay_merges(words: list[bytes], pairs: Pairs) -> list[bytes]:
    """Token ids (little-endian unsigned 32-bit) of many words at once.

    The words' bytes lie one after another, a place between two words, as tokens with left and right
    neighbours (:class:`Places`). Ranks with many places are merged at all of them at once, then the rest
    one by one. An inverted index leads from each joined token to the places of its pair.
    Ranks are taken smallest first, their places from left to right; a merge touches its two
    neighbours only, whose new pairs enter the index. A pair that a merge makes may have a smaller
    rank than the one at work (vocabularies allow it): then the word's further places of the rank at
    work wait until the smaller is done, as they would were each word merged by itself.
    """
    ranks = pairs.ranks
    todo = [w for w in words if w not in ranks]  # a whole word of the vocabulary is one token
    all_places = Places(todo, pairs)
    alone = all_places.merge_many()
    heap = all_places.heap
    index = {r: np.concatenate(x).tolist() for r, x in all_places.index.items()}
    token, right, left, word, joins = (x.tolist() for x in (all_places.token, all_places.right, all_places.left, all_places.word, all_places.joins))
    while heap:
        r = heappop(heap)
        places = index.pop(r)
        if len(places) > 1:
            places = sorted(set(places))
        high = r << 25
        waiting: list[int] = []
        held: set[int] = set()  # words with a smaller pair to be merged first
        for p in places:
            if joins[p] != r:
                continue
            if held and word[p] in held:
                waiting.append(p)
                continue
            q, before = right[p], left[p]
            after = right[q]
            token[p], token[q], joins[q] = r, TAKEN, -1
            right[p], left[after] = after, p
            joins[p] = x = pairs[high | token[after]]
            joins[before] = y = pairs[token[before] << 25 | r]
            if x >= 0:
                if x in index:
                    index[x].append(p)
                else:
                    index[x] = [p]
                    heappush(heap, x)
            if y >= 0:
                if y in index:
                    index[y].append(before)
                else:
                    index[y] = [before]
                    heappush(heap, y)
            if -1 < x < r or -1 < y < r:
                held.add(word[p])
        if waiting:
            if r not in index:
                index[r] = []
                heappush(heap, r)
            index[r] += waiting
    left_over = np.array(token[1:], np.int64)
    alive = (left_over >= 0) & (left_over != BETWEEN)
    ids = left_over[alive].astype("<u4").tobytes()
    word_of = np.repeat(np.arange(len(todo)), all_places.lengths)
    ends = (4 * np.cumsum(np.bincount(word_of[alive], minlength=len(todo)))).tolist()
    merged = [ids[i:j] for i, j in zip([0, *ends], ends)]
    for w in alone:
        merged[w] = merge_one(todo[w], pairs)
    rest = iter(merged)
    return [ranks[w].to_bytes(4, "little") if w in ranks else next(rest) for w in words]


def merge_one(word: bytes, pairs: Pairs) -> bytes:
    """The ids of one word: its pair of the smallest rank, the leftmost first, again and again."""
    place = Places([word], pairs)
    token, right, left = place.token.tolist(), place.right.tolist(), place.left.tolist()
    heap = [(int(place.joins[p]), p, token[p], token[p + 1]) for p in np.flatnonzero(place.joins >= 0).tolist()]
    heap.sort()
    while heap:
        r, p, a, b = heappop(heap)
        q = right[p]
        if token[p] != a or q >= len(token) or token[q] != b:
            continue  # one of the two has been merged meanwhile
        token[p], token[q], after, before = r, TAKEN, right[q], left[p]
        right[p], left[after] = after, p
        for x, y in ((before, p), (p, after)):
            if (made := pairs[token[x] << 25 | token[y]]) >= 0:
                heappush(heap, (made, x, token[x], token[y]))
    return np.array([t for t in token if t >= 0 and t != BETWEEN], "<u4").tobytes()


def decode_ids(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    """The bytes of little-endian 32-bit ids."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Codec:
    """Encodes and decodes texts; ids of words and of chunks between spaces are kept, up to ``bound`` characters of each.

    ``spaced``: the pattern has no match that reaches over a space between two other signs, but begins
    the next one there, so that a text can be cut at such spaces before the pattern is applied, and a
    chunk that came up before needs neither the pattern nor its words.
    """

    bound = 3 << 20

    def __init__(self, ranks: dict[bytes, int], pattern: str, spaced: bool = False):
        self.pairs, self.find, self.spaced = Pairs(ranks), regex.compile(pattern).findall, spaced
        self.known: dict[str, bytes] = {}
        self.after: dict[str, bytes] = {}  # ids of a space and the chunk
        self.odd: set[str] = set()  # empty chunks and those with white space at an end
        self.sizes = [0, 0]

    def learn(self, words: set[str]) -> None:
        fresh = list(words.difference(self.known))
        self.known.update(zip(fresh, replay_merges([w.encode() for w in fresh], self.pairs)))
        self.sizes[0] += sum(map(len, fresh))

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if max(self.sizes) > self.bound:
            self.known, self.after, self.odd, self.sizes = {}, {}, set(), [0, 0]
        texts = list(texts)
        chunks = [t.split(" ") if self.spaced else [t] for t in texts]
        heads = [c[0] for c in chunks]
        chunks = [c[1:] for c in chunks]
        new = list(set().union(*chunks).difference(self.after))
        self.odd.update(c for c in new if not c or c[0].isspace() or c[-1].isspace())
        for k, (head, some) in enumerate(zip(heads, chunks)):
            if some and (head[-1:].isspace() or not self.odd.isdisjoint(some)):
                heads[k], chunks[k] = texts[k], []
        first, found = list(map(self.find, heads)), [self.find(" " + c) for c in new]
        self.learn(set().union(*first, *found))
        join, of = b"".join, self.known.__getitem__
        self.after.update(zip(new, [join(map(of, words)) for words in found]))
        self.sizes[1] += sum(map(len, new))
        return [join(map(of, words)) + join(map(self.after.__getitem__, some)) for words, some in zip(first, chunks)]

    def decode(self, ids: bytes) -> bytes:
        return decode_ids(ids, self.pairs.tokens)


_CODECS: dict[tuple[int, str, bool], Codec] = {}


def codec_of(raw: Broadcast, pattern: str, spaced: bool = False) -> Codec:
    """The worker's codec for a vocabulary, so that its next task needn't begin anew."""
    key = (hash(raw.value), pattern, spaced)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(read_ranks(raw.value), pattern, spaced)
    return _CODECS[key]


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The rank file's bytes, read on the driver and sent to the executors (a file of fixed size)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about ``size`` characters, or one longer text."""
    for b in batches:
        ids, texts, n = [], [], 0
        for i, t in zip(b.column(0), b.column(1)):
            ids.append(i.as_py())
            texts.append(data(t.as_py()).decode())
            n += len(texts[-1])
            if n >= size:
                yield ids, texts
                ids, texts, n = [], [], 0
        if ids:
            yield ids, texts


def encode(docs: DataFrame, path: str, pattern: str, size: int = 2 << 20) -> DataFrame:
    """``doc_id long, ids binary``: the token ids of every whole text, little-endian 32-bit.

    A null or empty text has no ids; a text is a str, so its bytes are UTF-8. Every match of
    ``pattern`` is merged separately; special tokens are ordinary text. Words of about ``size``
    characters of text are merged together, each distinct one once. Repeated rows are encoded each;
    other columns aren't read.
    """
    raw = vocabulary(docs.sparkSession, path)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(raw, pattern)
        for ids, texts in _parts(batches, size):
            yield from arrow_rows(schema, zip(ids, codec.encode(texts)))

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the column ``decoded binary`` added: the bytes of the ids; null ids are none."""
    raw = vocabulary(encoded.sparkSession, path)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {i: t for t, i in read_ranks(raw.value).items()}
        for b in batches:
            yield from arrow_rows(schema, ((i.as_py(), x := v.as_py() or b"", decode_ids(x, tokens)) for i, v in zip(b.column(0), b.column(1))), 500)

    bounded_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, ids binary, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str, spaced: bool = False, size: int = 4 << 20) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every text encoded, its ids decoded, both hashed.

    The same as :func:`encode` followed by :func:`decode`, in one Python worker, so that a task holds
    the vocabulary once and no ids travel.
    """
    raw = vocabulary(docs.sparkSession, path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(raw, pattern, spaced)
        for ids, texts in _parts(batches, size):
            yield from arrow_rows(schema, ((i, len(x) // 4, sha256_hex(x), sha256_hex(codec.decode(x))) for i, x in zip(ids, codec.encode(texts))))

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def round_trip(docs: DataFrame) -> DataFrame:
    """Digests of the ids by the public multilingual vocabulary and of what they decode to."""
    import public_tokenizers

    return digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, spaced=True)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded."""
    return round_trip(documents(spark, sf_dir))
