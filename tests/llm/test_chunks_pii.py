"""Content-defined chunk dedup against brute force; pseudonyms by round trip, format and linkage."""

import re
from datetime import date

import pytest
from conftest_llm import ODD

from riskframe.llm import pii
from riskframe.llm.chunk_dedup import GEAR, ChunkConfig, chunk_dedup, chunk_ends, rolling


def brute_ends(raw, cfg):
    """Cuts by one byte after another."""
    ends, last, h = [], 0, 0
    places = set()
    for i, b in enumerate(raw):
        h = ((h << 1) + int(GEAR[b])) % 2**16
        if h >> (16 - cfg.bits) == 0 and (i + 1 == len(raw) or raw[i + 1] & 0xC0 != 0x80):
            places.add(i + 1)
    p = 1
    while p <= len(raw):
        if p - last > cfg.most:
            cut = last + cfg.most
            while cut < len(raw) and raw[cut] & 0xC0 == 0x80:
                cut -= 1
            ends.append(cut)
            last = cut
            p = last
        elif p == len(raw) and p > last or p in places and p - last >= cfg.least:
            ends.append(p)
            last = p
        p += 1
    return ends


@pytest.mark.parametrize("cfg", [ChunkConfig(), ChunkConfig(least=4, most=20, bits=3)])
def test_chunk_ends(rng, cfg):
    for n in (0, 1, 5, 40, 700):
        raw = "".join(rng.choice("abcdeé漢 ") for _ in range(n)).encode()
        assert chunk_ends(raw, cfg) == brute_ends(raw, cfg)
        for a, b in zip([0, *chunk_ends(raw, cfg)], chunk_ends(raw, cfg)):
            raw[a:b].decode()
    assert chunk_ends(b"a" * 1000, cfg)[-1] == 1000 and rolling(b"").size == 0


def test_cuts_resist_insertions(rng):
    raw = bytes(rng.choice(b"abcdefgh ") for _ in range(5000))
    cfg = ChunkConfig()
    chunks = lambda x: [x[a:b] for a, b in zip([0, *chunk_ends(x, cfg)], chunk_ends(x, cfg))]
    before, after = set(chunks(raw)), set(chunks(raw[:2000] + b"inserted" + raw[2000:]))
    assert len(before - after) <= 6


def brute_chunks(rows, cfg):
    big = 2**63
    texts = [(big if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, raw in texts:
        for a, b in zip([0, *chunk_ends(raw, cfg)], chunk_ends(raw, cfg)):
            least[raw[a:b]] = min(least.get(raw[a:b], big), i)
    out = []
    for (i, _), (place, raw) in zip(rows, texts):
        ends, spans, run = chunk_ends(raw, cfg), [], None
        for a, b in [*zip([0, *ends], ends), (len(raw), len(raw))]:
            if a < b and least[raw[a:b]] < place:
                run = (run[0] if run else a, b)
            elif run:
                if run[1] - run[0] >= cfg.run:
                    spans.append(run)
                run = None
        kept = bytes(c for k, c in enumerate(raw) if not any(s <= k < e for s, e in spans))
        out.append((i, kept.decode(), len(raw), sorted(spans)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cfg", [ChunkConfig(), ChunkConfig(block=900, bucket=2_000, run=60)])
def test_chunk_dedup(docs, rng, cfg):
    word = lambda: "".join(rng.choice("abcdeéf") for _ in range(rng.randint(1, 9)))
    shared = [" ".join(word() for _ in range(60)) for _ in range(5)]
    rows = [(i, (t or "")[:2000] if i in (6, 7) else t) for i, t in ODD]
    for k in range(50):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))), *rng.sample(shared, rng.randint(0, 2)), " ".join(word() for _ in range(10))]
        rows.append((rng.randint(100, 150), " ".join(parts)))
    rows += [(600 + i, rows[30 + i][1]) for i in range(6)] + [(None, shared[0])]
    rng.shuffle(rows)
    got = chunk_dedup(docs(rows), cfg).collect()
    assert sorted(((r.doc_id, r.text, r.n_bytes, [tuple(s) for s in r.spans]) for r in got), key=repr) == brute_chunks(rows, cfg)
    assert sum(len(r.spans) for r in got) > 20


def test_passages_are_caught_and_clean_texts_left(docs, rng):
    """A passage of 51 words in many documents goes from all but the first; the rest stays whole."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(51))
    rows = []
    for i in range(60):
        own = [" ".join(word() for _ in range(80)), " ".join(word() for _ in range(80))]
        rows.append((i, f"{own[0]} {passage} {own[1]}" if i % 2 else " ".join(own)))
    got = {r.doc_id: r for r in chunk_dedup(docs(rows)).collect()}
    for i, t in rows:
        gone = sum(s.stop - s.start for s in got[i].spans)
        assert gone == 0 if i % 2 == 0 or i == 1 else 0.5 * len(passage) < gone <= len(passage) + 16


def test_short_copies_and_repeats_between_edits_go(docs, rng):
    """Whole copies of any length, and what is repeated between edits about 60 bytes apart."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    rows = []
    for i in range(10):
        base = [word() for _ in range(300)]
        rows += [(i, " ".join(base)), (100 + i, " ".join(word() if k % 10 == 9 else w for k, w in enumerate(base)))]
    got = chunk_dedup(docs(rows)).collect()
    assert sorted(((r.doc_id, r.text, r.n_bytes, [tuple(s) for s in r.spans]) for r in got), key=repr) == brute_chunks(rows, ChunkConfig(run=32))
    assert sum(len(r.spans) for r in got) > 20
    short = ["é", "short", "less than a hundred bytes, as a whole text"]
    got = {r.doc_id: (r.text, [tuple(s) for s in r.spans]) for r in chunk_dedup(docs([(i, t) for i, t in enumerate(short * 2)] + [(8, ""), (9, None)])).collect()}
    assert got == {i: (t, []) if i < 3 else ("", [(0, len(t.encode()))]) for i, t in enumerate(short * 2)} | {8: ("", []), 9: ("", [])}


def test_chunk_dedup_empty_table(docs):
    assert chunk_dedup(docs([])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 65536])
def test_feistel_is_a_permutation(n):
    f = pii.Feistel(b"key")
    got = [f.permute(x, n, "t") for x in range(min(n, 3000))]
    assert len(set(got)) == len(got) and all(0 <= y < n for y in got)
    assert [f.permute(y, n, "t", back=True) for y in got] == list(range(min(n, 3000)))
    if n > 90:
        assert got != [f.permute(x, n, "other") for x in range(min(n, 3000))]


VALUES = ["4532132264652876", "4111 1111 1111 1111", "5500-0000-0000-0004", "+1 (269) 555-3296", "(212) 555-0199", "+49 30 1234 5678", "123-45-6789", "665-01-0001", "899-99-9999",
          "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "2021-03-05", "12.11.1999", "3/14/2015", "13/5/2010", "31.12.2099", "70.123.182.155", "255.0.0.1",
          "some.one-2@mail6.example.com", "A9@b.org"]


def shape(s):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", s)))


@pytest.mark.parametrize("value", VALUES)
def test_pseudonyms_keep_format_validity_and_come_back(value):
    there, back = pii.Replacer(b"key"), pii.Replacer(b"key", back=True)
    text = f"é: {value} and"
    new, spans = there.replace(text)
    assert len(spans) == 1 and spans[0][:2] == (3, 3 + len(value)) and value not in new
    assert back.replace(new)[0].lower() == text.lower()
    changed = new[3:-4]
    kind = spans[0][2]
    if kind not in ("address", "date", "email"):
        assert shape(changed) == shape(value)
    assert there.replace(new)[1][0][2] == kind  # it is valid again
    assert pii.Replacer(b"other key").replace(text)[0] != new


def test_invalid_values_stay():
    for text in ("4532132264652879", "000-12-3456", "666-12-3456", "2021-02-30", "300.1.1.1", "DE88 3704 0044 0532 0130 00", "1.2.3", "12345", "0000000000000000", "no @ all"):
        assert pii.Replacer(b"key").replace(text) == (text, [])


def test_equal_values_stay_linked(docs):
    rows = [(1, "card 4111111111111111."), (2, "4111-1111-1111-1111"), (3, "on 2001-02-03"), (None, "on 03.02.2001")]
    got = {r.doc_id: r.text for r in pii.pseudonymise(docs(rows), b"key").collect()}
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(got[1]) == digits(got[2])
    y, m, d = got[3][3:].split("-")
    assert got[None] == f"on {d}.{m}.{y}" and date(int(y), int(m), int(d))


def test_pseudonymise_odd_rows(docs):
    got = pii.pseudonymise(docs(ODD), b"key").collect()
    assert sorted(((r.doc_id, r.text, r.n_found, r.spans) for r in got), key=repr) == sorted(((i, t, 0, "") for i, t in ODD), key=repr)
    assert pii.pseudonymise(docs([]), b"key").count() == 0


PLANTED = {
    "email": ["jo.doe@example.org", "A_B-c@mail.co.uk", "x1@y-z.net"], "date": ["2001-03-12", "3.4.1999", "12/31/2020"], "address": ["10.0.0.7", "192.168.254.1"],
    "ssn": ["123-45-6789"], "phone": ["212-555-0142", "+44 20 7946 0958", "(212) 555-0142"], "card": ["4111 1111 1111 1111", "5500005555555559"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
}


def test_planted_values_are_found_where_they_stand(docs, rng):
    """An independent finder: what was planted, at the places where it was planted, and nothing else."""
    rows, want = [], {}
    for i in range(120):
        text, spans = "", []
        for _ in range(rng.randrange(8)):
            text += " ".join(rng.choice(["alpha", "Beta", "é漢", "No", "12", "a@b", "1999", "7.5", "x-y"]) for _ in range(rng.randrange(1, 6))) + rng.choice([": ", " (", "; "])
            kind = rng.choice(list(PLANTED))
            value = rng.choice(PLANTED[kind])
            spans.append(f"{kind}:{len(text)}:{len(text) + len(value)}")
            text += value + rng.choice([", and ", "; then ", ") so "])
        rows.append((i, text))
        want[i] = ",".join(spans)
    assert {r.doc_id: r.spans for r in pii.pseudonymise(docs(rows), b"k").collect()} == want


def test_very_long_values_do_not_crash(docs):
    rows = [(1, "a" * 4000 + "@example.org"), (2, "5" * 5000 + "@example.org"), (3, "x@" + "b" * 9000 + ".org"), (4, "+1 " * 20_000), (5, "4" * 60_000), (6, "a" * 64 + "@example.org"),
            (7, "1." * 30_000), (8, "a@" * 20_000)]
    got = {r.doc_id: r for r in pii.pseudonymise(docs(rows), b"k").collect()}
    assert got[6].spans == "email:0:76" and len(got[6].text) == 76
    assert all(got[i].text == t for i, t in rows if i in (1, 2, 3, 5, 7, 8))
