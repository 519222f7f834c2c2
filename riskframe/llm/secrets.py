"""Secret scans: all rules in one minimised byte automaton, stepped over many texts at once."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.automaton import GAP, Anchored, Dfa, compile_rules, scan_backwards
from riskframe.llm.common import arrow_rows, bounded_batches, data, documents, sha256_hex


@dataclass(frozen=True)
class SecretRule:
    """Matches are leftmost, longest and don't overlap; then those shorter than ``least`` bytes or
    whose group 2 of ``value`` is shorter than ``least_value`` are dropped."""

    kind: str
    regex: str
    least: int = 0
    value: bytes = b""
    least_value: int = 0


_WORDS = r"(password|passwd|secret|token|api_?key)"
_ASSIGN = r"""["']?\x20*[:=]\x20*["']?"""

#: The fixed base rules, in the order in which equal starts are listed.
BASE = [
    SecretRule("assign", rf"(?i){_WORDS}{_ASSIGN}[A-Za-z0-9+/_.=-]+", 0, rf"(?i:{_WORDS}){_ASSIGN}([A-Za-z0-9+/_.=-]+)".encode(), 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 20),
    SecretRule("hex", r"[0-9a-f]{24,}"),
]
#: Rules added to the base: tokens with a prefix of their own, key files, addresses with a password.
MORE = [
    SecretRule("github", r"gh[opusr]_[A-Za-z0-9]+", 40),
    SecretRule("github_fine", r"github_pat_[A-Za-z0-9_]+", 60),
    SecretRule("gitlab", r"glpat-[A-Za-z0-9_-]+", 26),
    SecretRule("slack", r"xox[abeoprs]-[A-Za-z0-9-]+", 20),
    SecretRule("slack_hook", r"https://hooks\.slack\.com/services/[A-Za-z0-9/]+", 55),
    SecretRule("stripe", r"[rs]k_(live|test)_[A-Za-z0-9]+", 24),
    SecretRule("google", r"AIza[A-Za-z0-9_-]+", 39),
    SecretRule("model_key", r"sk-(proj-)?[A-Za-z0-9]+", 35),
    SecretRule("npm", r"npm_[A-Za-z0-9]+", 40),
    SecretRule("pypi", r"pypi-[A-Za-z0-9_-]+", 50),
    SecretRule("sendgrid", r"SG\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 60),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    SecretRule("key_file", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    SecretRule("storage_key", r"AccountKey=[A-Za-z0-9+/]+=*", 60),
    SecretRule("cloud_secret", rf"(?i)aws_secret_access_key{_ASSIGN}[A-Za-z0-9/+]+", 60),
    SecretRule("bearer", r"(?i)bearer\x20+[A-Za-z0-9._~+/-]+=*", 30),
    SecretRule("address", r"(https?|ftp|postgres(ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._-]+:[^\x00-\x20@/:]+@"),
]


class Scanner:
    """``starts`` finds, in one pass from the last byte to the first, where each rule can begin."""

    def __init__(self, rules: list[SecretRule], starts: Dfa):
        self.rules, self.starts = rules, starts
        self.ends = [Anchored(r.regex) for r in rules]
        self.values = [re.compile(r.value) if r.value else None for r in rules]

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text its matches (start byte, rule, end byte) by start, then rule."""
        lengths = np.array([len(t) + 1 for t in texts])
        first = np.concatenate([[0], np.cumsum(lengths)])
        gap = bytes([GAP])
        places, states = scan_backwards(self.starts, np.frombuffer(gap.join(texts) + gap, np.uint8))
        owner = np.searchsorted(first, places, "right") - 1
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        until: dict[tuple[int, int], int] = {}
        for doc, place, state in zip(owner.tolist(), (places - first[owner]).tolist(), states.tolist()):
            for k in self.starts.accept[state]:
                if place < until.get((doc, k), 0):
                    continue
                end = self.ends[k].end(texts[doc], place)
                until[doc, k] = end
                rule, found = self.rules[k], texts[doc][place:end]
                if len(found) < rule.least or rule.value and len(self.values[k].fullmatch(found)[2]) < rule.least_value:
                    continue
                out[doc].append((place, k, end))
        return [sorted(x) for x in out]


def code_points(text: bytes, places: list[int]) -> dict[int, int]:
    """Byte places of a UTF-8 text as places in characters."""
    if text.isascii():
        return dict(zip(places, places))
    out, at, n = {}, 0, 0
    for p in sorted(set(places)):
        n += len(text[at:p].decode())
        at = out[p] = p
        out[p] = n
    return out


FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def secret_scan(docs: DataFrame, more: list[SecretRule] = MORE, buffer: int = 4 << 20) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, and all spans.

    Spans are ``kind:start:end`` in code points, by start, then kind in the order of the rules.
    Equal starts of two kinds are both listed; matches of one kind never overlap. A null or empty
    text has none (the digest is that of the empty string). Repeated rows are scanned each; other
    columns aren't read. Texts are scanned whole, joined to buffers of ``buffer`` bytes or one
    longer text, with a byte between them that no match crosses.
    """
    rules = BASE + list(more)
    starts = compile_rules([r.regex for r in rules], backwards=True, anywhere=True)
    schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules, starts)

        def found(ids: list, texts: list[bytes]) -> Iterator[tuple]:
            for doc_id, text, spans in zip(ids, texts, scanner.spans(texts)):
                at = code_points(text, [p for s, _, e in spans for p in (s, e)])
                base = [f"{rules[k].kind}:{at[s]}:{at[e]}" for s, k, e in spans if k < len(BASE)]
                counts = [sum(k == x for _, k, _ in spans) for x in range(len(BASE))]
                yield doc_id, *counts, sha256_hex(",".join(base).encode()), ",".join(f"{rules[k].kind}:{at[s]}:{at[e]}" for s, k, e in spans)

        def all_rows() -> Iterator[tuple]:
            for b in batches:
                ids, texts, size = [], [], 0
                for i, t in zip(b.column(0), b.column(1)):
                    ids.append(i.as_py())
                    texts.append(data(t.as_py()))
                    size += len(texts[-1])
                    if size >= buffer:
                        yield from found(ids, texts)
                        ids, texts, size = [], [], 0
                if ids:
                    yield from found(ids, texts)

        yield from arrow_rows(schema, all_rows())

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, FOUND)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added secrets in every whole document."""
    return secret_scan(documents(spark, sf_dir))
