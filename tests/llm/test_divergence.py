"""Source divergence against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest_llm import ODD
from riskframe.llm import divergence as dv

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        others = [s for x, s in groups if x == lang]

        def p(count):
            size = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (size + len(kept)) for t in kept}

        mine, whole = p(counts[lang, source]), p(sum((counts[lang, s] for s in others), Counter()))
        pairs = []
        for s in others:
            if s != source:
                q = p(counts[lang, s])
                pairs.append((-sum((mine[t] - q[t]) ** 2 // q[t] for t in kept), s))
        terms = [(-((mine[t] - whole[t]) ** 2 // whole[t]), t) for t in kept if counts[lang, source][t] > 0 and mine[t] > whole[t]]
        for part, found in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
            out |= {(lang, source, part, item, -v, r) for r, (v, item) in enumerate(found, 1)}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n int")


def texts(rng, n, words):
    return [(" ".join(rng.choice(words) + rng.choice([" ", "-", "1", "É", ""]) for _ in range(rng.randrange(30))), rng.choice(["en", "de", None]),
             rng.choice(["a", "b", "c", "é", None])) for _ in range(n)]


def test_equals_plain_python(spark, rng):
    rows = texts(rng, 120, "alpha Beta GAMMA delta äpfel 漢字 x".split())
    rows += [(t, "odd", "s") for _, t in ODD] + [(None, "empty", "s1"), ("", "empty", "s2"), ("one two", "rare", "s1"), ("one", "rare", "s2")]
    got = dv.divergence(frame(spark, rows)).select("lang", "source", "part", "item", "value", "rank").collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == plain(rows)
    assert {(r.source, r.item, r.value) for r in got if r.lang == "rare"} == {("s1", "s2", 0), ("s2", "s1", 0)}


def test_blocks_and_chunks_add_up(spark, rng):
    rows = texts(rng, 200, [a + b for a in "abcdefgh" for b in "klmn"])
    some = dv.tables(frame(spark, rows))
    whole = {tuple(r) for r in dv.pair_sums(*some).collect()}
    assert {tuple(r) for r in dv.pair_sums(*some, block=5, chunk=2).collect()} == whole


def test_top_and_empty_table(spark, rng):
    rows = texts(rng, 80, "alpha beta gamma delta epsilon zeta eta".split())
    got = {tuple(r) for r in dv.divergence(frame(spark, rows), top=2).collect()}
    assert got == plain(rows, top=2)
    assert dv.divergence(frame(spark, rows).limit(0)).collect() == []


def test_equal_subtrees_are_one_node():
    counts = np.array([[1, 0, 1, 0, 0, 0, 0, 0], [0, 0, 0, 0, 1, 0, 1, 0]])
    leaf, levels, roots = dv.trees(counts)
    assert leaf.tolist() == [0, 1]
    assert [len(x) for x in levels] == [2, 2, 2]  # (0,0) and (1,0); their doubles; the two roots
    pairs, links = dv.walk(levels, int(roots[0]), int(roots[1]))
    assert sorted(map(tuple, pairs.tolist())) == [(0, 0), (0, 1), (1, 0)]
    p, q = np.array([10, 20]), np.array([10, 30])
    assert dv.priced(p[pairs[:, 0]], q[pairs[:, 1]], links) == 2 * ((20 - 10) ** 2 // 10) + 2 * ((10 - 30) ** 2 // 30)


@pytest.mark.parametrize("width", [1, 2, 16, 128])
def test_walk_equals_a_plain_sum(width):
    random = np.random.default_rng(width)
    counts = random.poisson(0.7, (4, width))
    leaf, levels, roots = dv.trees(counts)
    p = [dv.shares(leaf, int(c.sum()), width) for c in counts]
    for x in range(4):
        for y in range(4):
            pairs, links = dv.walk(levels, int(roots[x]), int(roots[y]))
            of = [dict(zip(leaf.tolist(), p[z].tolist())) for z in (x, y)]
            assert dv.priced(p[x][pairs[:, 0]], p[y][pairs[:, 1]], links) == sum((of[0][a] - of[1][b]) ** 2 // of[1][b] for a, b in zip(counts[x].tolist(), counts[y].tolist()))


def test_large_sums_stay_exact():
    cost = np.array([10**9 + 1, 1]), np.array([1, 10**9 + 1])
    links = [(np.array([0, 1]), np.array([0, 1]))] + [(np.array([0, 1]), np.array([0, 1]))] * 10
    assert dv.priced(*cost, links) == 2**11 * 10**18


def test_terms_are_counted_by_few_shuffles(spark, rng):
    """Totals and documents of a term come from the shuffle that adds up its sources, however often tasks hand counts on."""
    rows = texts(rng, 150, "alpha beta gamma delta epsilon zeta eta theta".split())
    kept, entries, groups = dv.tables(frame(spark, rows).repartition(5))
    n, docs = Counter(), Counter()
    for text, lang, source in rows:
        words = [t.translate(LOWER) for t in TERM.findall(text)]
        n.update((lang or "", source or "", w) for w in words)
        docs.update((lang or "", w) for w in set(words))
    assert {tuple(r) for r in groups.select("lang", "source").collect()} == {(l or "", s or "") for _, l, s in rows} and groups.count() == len({(l or "", s or "") for _, l, s in rows})
    want = {(l, w): sum(c for (l2, _, w2), c in n.items() if (l2, w2) == (l, w)) for l, w in docs if docs[l, w] >= 3}
    assert sorted(map(tuple, kept.collect())) == sorted((*k, v) for k, v in want.items())
    assert sorted(map(tuple, entries.select("lang", "source", "term", "n", "total").collect())) == sorted((l, s, w, c, want[l, w]) for (l, s, w), c in n.items() if (l, w) in want)


@pytest.mark.parametrize("gathered", [1, 7])
def test_counts_handed_on_often_are_whole(spark, rng, monkeypatch, gathered):
    monkeypatch.setattr(dv, "GATHERED", gathered)
    rows = texts(rng, 60, "alpha beta gamma delta".split()) + [(None, "de", "a")]
    assert {tuple(r) for r in dv.divergence(frame(spark, rows)).collect()} == plain(rows)


def test_terms_are_written_once(spark, rng, monkeypatch):
    made = []
    monkeypatch.setattr(dv, "materialize", lambda df, name: made.append((name, df._jdf.queryExecution().executedPlan().toString())) or df.cache())
    dv.tables(frame(spark, texts(rng, 30, "alpha beta".split())))
    assert [name for name, _ in made] == ["terms", "groups"]
    assert dict(made)["terms"].count("Exchange hashpartitioning") == 1
