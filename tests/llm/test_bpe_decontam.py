"""Byte-level BPE against the public tokenizer; decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest_llm import ODD

from riskframe.llm import bpe, decontam

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as f:
        return bpe.read_ranks(f.read())


def test_bpe_equals_tokenizer(docs, ranks, rng):
    signs = " abcdeéñ漢字😀\n\t1!#'s"
    rows = ODD + [(100 + i, "".join(rng.choice(signs) for _ in range(rng.randint(0, 200)))) for i in range(150)]
    rows += [(9, "a" * 5000), (10, "ab" * 3000), (11, "<|endoftext|>"), (12, "é" * 999), (13, "퟿�")]
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.round_trip(docs(rows)).collect()
    assert len(got) == len(rows)
    for r, (i, t) in zip(got, rows):
        ids = enc.encode_ordinary(t or "")
        assert (r.doc_id, r.n_tokens) == (i, len(ids))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


@pytest.mark.parametrize("seed", range(6))
def test_replay_with_ranks_out_of_order(seed):
    """Vocabularies in which a merge makes a pair of smaller rank."""
    rng = random.Random(seed)
    longer = list({bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(40)})
    rng.shuffle(longer)
    ranks = {bytes([c]): c for c in range(256)} | {t: 256 + i for i, t in enumerate(longer)}

    def one(w):
        if w in ranks:
            return [ranks[w]]
        parts = [bytes([c]) for c in w]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 25))) for _ in range(500)]
    got = [np.frombuffer(x, "<u4").tolist() for x in bpe.replay_merges(words, bpe.Pairs(ranks))]
    assert got == [one(w) for w in words]


def test_codec_forgets_and_stays_right(ranks):
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    codec.bound = 10
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for k in range(5):
        texts = [f"words number {k} {i} and more" for i in range(8)]
        assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == enc.encode_ordinary_batch(texts)


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, items):
    out = []
    for i, t in rows:
        w, hit, names = words(t), set(), set()
        for item, text in items:
            b = words(text)
            for p in range(max(1, len(b) - 9) if b else 0):
                x = b[p : p + 10]
                for s in range(len(w) - len(x) + 1):
                    if w[s : s + len(x)] == x:
                        hit |= set(range(s, s + len(x)))
                        names.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.fixture
def contaminated(rng):
    vocab = [f"w{i}" for i in range(30)] + ["the", "of"] * 10
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(1, 40)) if i % 5 else text(3))) for i in range(30)] + [(30, ""), (31, None), (None, "é ü ö"), (7, " ".join(text(15)))]
    rows = [r for r in ODD if r[0] != 6]
    for i in range(120):
        body = text(rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            b = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(b) - 1))
            body[rng.randint(0, len(body)) : 0] = b[a : a + rng.randint(5, 30)]
        rows.append((100 + i, rng.choice([" ", ", ", "\n"]).join(body).upper() if i % 2 else " ".join(body)))
    return rows, items


def as_digest(df):
    return [(r.doc_id, r.n_words, r.n_hit, len(r.items), hashlib.sha256(",".join(sorted(r["items"])).encode()).hexdigest(), r.contaminated) for r in df.collect()]


@pytest.mark.parametrize("block", [1 << 24, 300])
def test_decontamination(spark, docs, contaminated, monkeypatch, block):
    """One block of items, and many."""
    rows, items = contaminated
    monkeypatch.setattr(decontam, "BLOCK_CHARS", block)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.decontaminate(docs(rows), bench)
    assert sorted(as_digest(got), key=repr) == sorted(brute(rows, items), key=repr)
    for r in got.collect():
        assert set(r["items"]) <= set(r.near) and sum(x.stop - x.start for x in r.hits) >= r.n_hit


def test_decontamination_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert as_digest(decontam.decontaminate(docs([(1, "alpha beta")]), none))[0][:4] == (1, 2, 0, 0)
    assert decontam.decontaminate(docs([]), none).count() == 0


def test_near_match_by_hand(spark, docs):
    item = "zulu yankee xray whiskey victor uniform tango sierra romeo quebec"
    moved = "zulu xray yankee whiskey victor uniform tango sierra quebec romeo"
    r = decontam.decontaminate(docs([(1, moved), (2, "nothing of it")]), spark.createDataFrame([(5, item)], "item_id long, text string")).orderBy("doc_id").collect()
    assert (r[0].n_hit, r[0].near) == (0, ["5"]) and r[1].near == []


def test_drop_contaminated_keeps_clean(spark, docs, contaminated):
    rows, items = contaminated
    left = decontam.drop_contaminated(docs(rows), spark.createDataFrame(items, "item_id long, text string"))
    clean = [(i, t) for (i, t), b in zip(rows, brute(rows, items)) if not b[-1]]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(clean, key=repr) and left.columns == ["doc_id", "text", "kept"]
