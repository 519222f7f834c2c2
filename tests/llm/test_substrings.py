"""Suffix sorting and substring dedup against brute force."""

import hashlib
import os

import numpy as np
import pytest
from conftest_llm import ODD

from riskframe.llm.substring_dedup import Block, SubstringConfig, _anchors, substring_dedup
from riskframe.llm.suffixes import BlindTrie, suffix_groups


@pytest.mark.parametrize("signs", [b"ab", b"abcdefgh", b"a"])
def test_suffix_groups(rng, signs):
    base = bytes(rng.choice(signs) for _ in range(300))
    text = base + bytes(rng.choice(signs) for _ in range(900)) + base + base[7:200]
    starts = np.array(rng.sample(range(len(text) - 50), 800))
    got = suffix_groups(text, starts, 50)
    want = {}
    for s in starts.tolist():
        want.setdefault(text[s : s + 50], []).append(s)
    assert [sorted(g) for g in got] == [sorted(want[k]) for k in sorted(want)]


def test_blind_trie(rng):
    words = [bytes(16) + bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(300)]
    text = b"".join(words)
    trie = BlindTrie(text, 16, 28)
    for i in range(len(words)):
        trie.add(28 * i)
    groups = trie.leaves()
    assert [text[g[0] : g[0] + 28] for g in groups] == sorted(set(words)) and sum(map(len, groups)) == len(words)


def test_equal_windows_have_equal_anchors(rng):
    cfg = SubstringConfig()
    base = os.urandom(400) + b"ab" * 200 + b"x" * 300
    for a, b in ((b"", b"123"), (b"zz" * 31, b""), (b"x" * 77, b"x" * 5)):
        out = []
        for text in (base, a + base + b):
            h, _, first, last = _anchors([(0, 0, text)], cfg, slice_of=130)
            at = {}
            for x, f, z in zip(h.tolist(), first.tolist(), last.tolist()):
                for p in range(f, z + 1):
                    at.setdefault(text[p : p + 50], set()).add(x)
            assert len(text) - 49 == sum(last - first + 1)
            out.append(at)
        assert all(out[0][w] == out[1][w] for w in out[0]) and all(len(x) == 1 for x in out[0].values())


def brute(rows):
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        off = bytearray(len(raw))
        smaller = {u[p : p + 50] for j, u in ((j, (u or "").encode()) for j, u in rows if j is not None and (i is None or j < i)) for p in range(len(u) - 49)}
        for p in range(len(raw) - 49):
            if raw[p : p + 50] in smaller:
                off[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, o in zip(raw, off) if not o)
        spans = sum(o and (p == 0 or not off[p - 1]) for p, o in enumerate(off))
        out.append((i, len(raw), sum(off), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cfg", [SubstringConfig(), SubstringConfig(block=2_000), SubstringConfig(block=500, heavy=0, bucket=3_000), SubstringConfig(block=900, heavy=2)])
def test_substring_dedup(docs, rng, cfg):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    shared = [" ".join(word() for _ in range(rng.randint(8, 60))) for _ in range(6)]
    rows = [(i, t if i not in (6, 7) else (t or "")[:3000]) for i, t in ODD] + [(None, shared[0] + "!"), (20, "ab" * 100), (21, "x" + "ab" * 60), (22, "a" * 130), (23, "a" * 49), (24, "a" * 50)]
    for k in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 12)))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            parts += [s[a : a + rng.randint(20, 200)], " ".join(word() for _ in range(rng.randint(0, 6)))]
        rows.append((rng.randint(100, 140), "".join(parts)))
    rows += [(500 + i, rows[30 + i][1]) for i in range(8)]
    rng.shuffle(rows)
    got = [(r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in substring_dedup(docs(rows), cfg).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_substring_dedup_empty_table(docs):
    assert substring_dedup(docs([])).count() == 0


@pytest.mark.parametrize("heavy", [0, 1, 100])
def test_contents_in_many_parts_and_suffix_arrays(docs, rng, heavy):
    """Few occurrences a part and few bytes a suffix array give what brute force gives."""
    shared = ["".join(rng.choice("ab ") for _ in range(200)) for _ in range(3)]
    rows = [(i, shared[i % 3][rng.randint(0, 60) : rng.randint(120, 200)] + "".join(rng.choice("abc") for _ in range(rng.randint(0, 80))) + shared[i * 7 % 3]) for i in range(40)]
    cfg = SubstringConfig(block=1_500, heavy=heavy, bucket=2_000, part=7, compared=90)
    got = [(r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in substring_dedup(docs(rows), cfg).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_windows_of_heavy_anchors_are_held_as_numbers():
    """A block whose windows are all of heavy anchors takes some 100 bytes a window of one part, and no objects."""
    import tracemalloc

    cfg = SubstringConfig(part=20_000)
    text = os.urandom(100_000)
    block = Block({"text": text * 2, "places": [1, 2], "lengths": [len(text)] * 2, "copies": []}, 4, cfg)
    masks = [{"bucket": b, "mask": b"\xff" * len(block.key[s])} for b, s in block.per_bucket()]
    tracemalloc.start()
    windows = contents = 0
    for part in block.contents(masks, 4):
        windows += len(part.number)
        contents += sum(len(raw) // 16 for *_, raw in part.per_bucket())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (windows, contents) == (2 * (100_000 - 49), 100_000 - 49) and peak < 16 << 20
