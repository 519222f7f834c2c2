"""The pipeline against plain-Python versions of its stages, and the registration of the queries."""

import hashlib
import math
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_bpe_decontam import brute as brute_hits
from test_dedup import brute_join, brute_lines
from test_scans import base_quality

import corpus_pipeline
from riskframe.llm import bpe
from riskframe.llm.quality import QualityConfig


def brute_quality(rows, labels, cfg=QualityConfig()):
    """Kept rows: counting rules and the hashed likelihood ratio, one n-gram at a time."""
    def grams(text):
        h = [crc32(w) for w in (text or "").encode().split()]
        pairs = [((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % 2**64) >> 24 for a, b in zip(h, h[1:])]
        return [x % cfg.buckets for x in h + pairs]

    raw, target = Counter(), Counter()
    good = {i for i, q in labels if q == 1}
    for i, t in rows:
        raw.update(grams(t))
        if i in good:
            target.update(grams(t))
    total, trusted = sum(raw.values()), sum(target.values())
    prior = cfg.prior * cfg.buckets
    kept = []
    for i, t in rows:
        n, _, _, _, repeats = base_quality(t)
        if n < cfg.min_words or 100 * repeats > cfg.repeat_percent * n:
            continue
        ratio = [math.log((target[g] + prior * raw[g] / total) / (trusted + prior) / (raw[g] / total)) if trusted else 0.0 for g in grams(t)]
        if sum(ratio) / len(ratio) >= cfg.min_score:
            kept.append((i, t))
    return kept


@pytest.fixture
def tables(spark, rng, tmp_path):
    def write(rows, labels, items):
        d = str(tmp_path / "sf")
        spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        return d
    return write


def test_pipeline(spark, tables, rng):
    syllables = ["ka", "lo", "mi", "ter", "un", "son", "ri", "ba"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    prose = lambda n: "\n".join(" ".join(word() for _ in range(15)) for _ in range(n))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(6)]
    common = prose(4)
    rows = []
    for i in range(90):
        kind = i % 9
        text = prose(rng.randint(8, 14))
        if kind == 1:
            text = " | ".join(word() + word() + word() for _ in range(150))
        elif kind == 2:
            text = f"{text}\n{common}\n{prose(2)}"
        elif kind == 3:
            text = f"{text}\n{' '.join(items[i % 6][1].split()[5:22])}"
        elif kind == 4 and i > 9:
            text = rows[i - 9][1].replace(rows[i - 9][1].split()[40], "other", 1)
        elif kind == 5 and i > 9:
            text = rows[i - 9][1]
        elif kind == 6:
            text = " ".join(["again and"] * 60)
        rows.append((i, text))
    rows += [(200, None), (201, ""), (None, prose(9)), (203, "short text")]
    labels = [(i, int(i % 9 != 1)) for i in range(60)]
    d = tables(rows, labels, items)

    left = brute_quality(rows, labels)
    assert 50 < len(left) < len(rows) and not {i for i, _ in left} & {200, 201, 203}
    left = [(i, t) for i, t, *_ in brute_lines(left)]
    _, root = brute_join(left)
    first = {}
    for r, row in zip(root, left):
        if r not in first or (row[0] is None, row[0] or 0) < (first[r][0] is None, first[r][0] or 0):
            first[r] = row
    left = list(first.values())
    left = [row for row, b in zip(left, brute_hits(left, items)) if not b[-1]]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(f.read()), special_tokens={})
    want = []
    for i, t in left:
        ids = enc.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, d).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert 30 < len(want) < 80


def test_stages_keep_the_columns(spark, tables):
    d = tables([(1, " ".join(f"w{i}" for i in range(60))), (2, None)], [], [])
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "decontamination", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, d).columns == docs.columns
        assert stage(spark, docs.limit(0), d).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), d).count() == 0


def test_stages_carry_columns_of_any_name(spark, tables):
    """Names that the stages use themselves, also as results, pass through with their values."""
    words = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    passage = "\n".join(words[0].split()[:3])
    rows = [(1, words[0]), (2, words[0]), (3, words[1] + "\n" + passage), (4, words[2] + "\n" + passage), (4, words[2] + "\n" + passage), (None, words[3])]
    d = tables(rows, [], [(1, " ".join(words[3].split()[:20]))])
    names = ["row", "covered", "__place", "__text", "__lines", "__kept", "__id", "__row", "__key", "key", "first", "n", "n_lines", "n_spans",
             "n_removed", "place", "lines", "w", "h1", "kept", "score", "good", "label", "digest", "hits", "a.b", "Key word"]
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", *(F.concat_ws("-", F.lit(n), F.col("doc_id")).alias(n) for n in names))
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns, name
        got = out.collect()
        for r in got:
            assert list(r)[2:] == [n if r.doc_id is None else f"{n}-{r.doc_id}" for n in names], name
        left[name] = sorted((r.doc_id or 0) for r in got)
    assert left == {"quality_rules": [0, 1, 2, 3, 4, 4], "line_dedup": [0, 1, 2, 3, 4, 4], "ngram_join": [0, 1, 3, 4], "decontamination": [1, 2, 3, 4, 4]}


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1, n
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
