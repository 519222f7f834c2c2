"""BPE with word ends against the public tokenizer."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest_llm import ODD
from riskframe.llm import word_bpe as wb

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abcABÇçé̀ \t\n\x1c\x1f\x85 'stlrevdm1234½²ΣσςİIßẞ<|endoftext|>.,!?#_-漢字😀​é　İﬁ한글각Ω"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def texts(rng):
    some = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(60))) for _ in range(1500)]
    some += ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (3, 4, 5, 39, 40, 41, 63, 64, 65, 300, 3000)]
    return some + ["x" * 20_000, "ab" * 700, "<|endoftext|>" * 3, "a<|endoftext|>B's<|startoftext|>", "<|STARTOFTEXT|>", "THE'S I'LL we'Re", "ΟΔΟΣ οδος", "<|endoftext|"]


def test_ids_and_text_equal_the_library(spark, docs, library, rng):
    rows = list(enumerate(texts(rng)))
    encoded = wb.encode(docs(rows), PATH, size=500)
    got = {r.doc_id: (r.ids, r.decoded) for r in encoded.join(wb.decode(encoded, PATH), "doc_id").collect()}
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i] == (ids, library.decode(ids, skip_special_tokens=False)), t


def test_round_trip_digests(spark, docs, library, rng):
    rows = ODD + [(100 + i, t) for i, t in enumerate(texts(rng)[:200])]
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in wb.round_trip(docs(rows), PATH).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert wb.round_trip(docs(rows).limit(0), PATH).collect() == []


def test_production_query(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in wb.op13_word_bpe(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))


def test_rows_and_heap_agree(rng):
    v = wb.Vocabulary(open(PATH, "rb").read())
    for _ in range(300):
        w = "".join(rng.choice("theandingé") for _ in range(rng.randrange(1, 60))).encode()
        parts = [*v.inner[list(w[:-1])].tolist(), int(v.last[w[-1]])]
        assert wb.merge_words([w], v)[0] == b"".join(i.to_bytes(4, "little") for i in wb.merge_long(parts, v))


def test_cache_is_emptied(library, monkeypatch):
    monkeypatch.setattr(wb.Codec, "bound", 20)
    codec = wb.Codec(open(PATH, "rb").read())
    for t in ("alpha beta gamma delta", "epsilon zeta eta theta", "alpha zeta"):
        assert codec.encode([t])[0] == b"".join(i.to_bytes(4, "little") for i in library.encode(t, add_special_tokens=False).ids)
    assert codec.size < 60
