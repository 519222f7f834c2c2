"""N-gram join and line dedup against brute force."""

import re
from collections import Counter, defaultdict

import pytest
from conftest_llm import ODD

from riskframe.llm import lines, ngram_join
from riskframe.llm.common import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_join(rows):
    """Per row: links, class (rows joined)."""
    s = [shingles(t) for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and 5 * both >= 4 * (len(s[i]) + len(s[j]) - both) and s[j]:
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    return links, root


@pytest.fixture
def copies(rng):
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyzuvw") + str(rng.randint(0, 99))
    rows = list(ODD)
    for g in range(12):
        base = [word() for _ in range(rng.randint(4, 120))]
        for _ in range(rng.choice([1, 2, 3, 40 if g == 3 else 4])):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = word()
            rows.append((1000 - len(rows), rng.choice([" ", "  ", ", "]).join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [2_000_000, 1_500])
def test_ngram_join(docs, copies, block):
    """Whole groups in one task, and groups cut into many blocks. At 0.8 exactly 3 in 1000 pairs
    may share no band, so more bands are taken for an exact comparison."""
    cfg = ngram_join.JoinConfig(block=block, bands=60, rows=3)
    got = ngram_join.near_duplicates(docs(copies), cfg).collect()
    links, root = brute_join(copies)
    want = defaultdict(list)
    for r, (i, _) in zip(root, copies):
        want[r].append(i)
    smallest = {r: min((i for i in ids if i is not None), default=None) for r, ids in want.items()}
    key = lambda x: repr(x)
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.class_size) for r in got), key=key) == sorted(
        ((i, smallest[r], n, len(want[r])) for n, r, (i, _) in zip(links, root, copies)), key=key)


def test_production_recall(docs, rng):
    """Planted near copies of a clear similarity are all found with the production parameters."""
    rows = []
    for g in range(60):
        base = [f"{g}w{rng.randint(0, 999)}" for _ in range(200)]
        other = list(base)
        other[100] = "other"
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(other))]
    got = {r.doc_id: r.class_id for r in ngram_join.near_duplicates(docs(rows)).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_production_recall_near_the_threshold(docs, rng):
    """Isolated pairs of J from 0.80 to 0.85, by the production parameters: links as by brute force."""
    cfg = ngram_join.JoinConfig()
    assert (1 - (cfg.over / cfg.under) ** cfg.rows) ** cfg.bands < cfg.tolerance
    rows = []
    for g in range(3000):
        base = [f"{g}w{k}" for k in range(rng.choice([48, 49, 49, 49, 54, 58, 64]))]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(base[:-5] + [f"{g}v{k}" for k in range(5)]))]
    near = {}
    for (i, a), (j, b) in zip(rows[::2], rows[1::2]):
        a, b = shingles(a), shingles(b)
        near[i] = near[j] = int(5 * len(a & b) >= 4 * len(a | b))
        assert 0.79 < len(a & b) / len(a | b) < 0.86
    got = {r.doc_id: r.n_links for r in ngram_join.near_duplicates(docs(rows), cfg).collect()}
    assert 4000 < sum(near.values()) < len(rows) and got == near


def test_keep_first(docs, copies):
    left = ngram_join.keep_first(docs(copies), ngram_join.JoinConfig(bands=60, rows=3)).collect()
    _, root = brute_join(copies)
    wordless = [(i, t) for i, t in copies if not shingles(t)]
    assert len(left) == len({r for r, (_, t) in zip(root, copies) if shingles(t)}) + len(wordless)
    order = lambda i: (i is None, i)
    first = {}
    for r, (i, t) in zip(root, copies):
        if shingles(t):
            first[r] = min(first.get(r, i), i, key=order)
    assert Counter(r.doc_id for r in left) == Counter(first.values()) + Counter(i for i, _ in wordless)


def test_join_empty_table(docs):
    assert ngram_join.near_duplicates(docs([])).count() == 0 and ngram_join.keep_first(docs([])).count() == 0


def test_pruning_table():
    """Posterior by summing the binomial; a pair at the threshold is dropped with probability below 1e-5."""
    from math import comb

    cfg = ngram_join.JoinConfig()
    for n, m in cfg.least_matches():
        p = lambda k: sum(comb(n + 1, x) * 0.8**x * 0.2 ** (n + 1 - x) for x in range(k + 1))
        assert p(m) >= cfg.tolerance and (m == 0 or p(m - 1) < cfg.tolerance)
        assert sum(comb(n, x) * 0.8**x * 0.2 ** (n - x) for x in range(m)) < 1e-5


def test_components(spark, rng):
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(70)] + [(900, 900 + i) for i in range(50)]
    root = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = root[a], root[b]
        root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    got = components(spark.createDataFrame(edges, "a long, b long"), "t").collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted((r.node, r.label) for r in got) == sorted((k, v) for k, v in root.items() if k in linked)


def brute_lines(rows):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    texts = {}
    for k in order:
        i, t = rows[k]
        if (i, t) in texts:  # a row repeated in full is the same document
            out.append(texts[i, t])
            continue
        ls = t.split("\n") if t is not None else []
        gone = set()
        for p in range(len(ls) - 2):
            w = tuple(ls[p : p + 3])
            if not "".join(w).strip(" \t\r"):
                continue
            if w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        spans = sum(p - 1 not in gone for p in gone)
        texts[i, t] = (i, "\n".join(x for p, x in enumerate(ls) if p not in gone) if t is not None else None, len(ls), len(gone), spans)
        out.append(texts[i, t])
    return out


def test_line_dedup(docs, rng):
    rows = list(ODD) + [(100 + i, "\n".join(rng.choice(["a", "b", "c", "", " ", "é"]) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    rng.shuffle(rows)
    got = lines.line_dedup(docs(rows))
    assert got.columns == ["doc_id", "text", "kept", "n_lines", "n_removed", "n_spans"]
    have = [(r.doc_id, r.text, r.n_lines, r.n_removed, r.n_spans) for r in got.collect()]
    assert sorted(have, key=repr) == sorted(brute_lines(rows), key=repr)


def test_line_dedup_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "a\nb\nc", 5, 9), (2, "a\nb\nc\nd", 7, 9)], "doc_id long, text string, n_chars long, n_lines long")
    got = sorted(lines.line_dedup(df).collect())
    assert [(r.doc_id, r.text, r.n_chars, r.n_lines, r.n_removed) for r in got] == [(1, "a\nb\nc", 5, 3, 0), (2, "d", 1, 4, 3)]
    assert lines.line_dedup(df.limit(0)).count() == 0


def test_four_equal_lines_keep_the_first(docs):
    assert [r.text for r in lines.line_dedup(docs([(1, "a\na\na\na")])).collect()] == ["a"]
