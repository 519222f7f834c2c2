"""License scans: ordered signature rules behind a keyword prefilter, resolved by containment."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import arrow_rows, bounded_batches, data, documents, fold_words
from riskframe.llm.license_rules import keywords, parse

#: Fixed phrases and labels of the base scan.
BASE = [(b"mit license", "mit"), (b"apache license", "apache"), (b"general public license", "gpl")]
#: Confidence of a base place that no rule covers.
BASE_SCORE = 0.5


@dataclass(frozen=True)
class Detection:
    """A rule's match: words ``start`` to ``end`` (exclusive)."""

    level: int
    label: str
    score: float
    start: int
    end: int


class Scanner:
    """Compiled rules with an index from the rarest-looking keyword of each rule's alternative to the rule.

    ``gated`` False runs every rule on every text.
    """

    def __init__(self, rules: list | None = None, gated: bool = True):
        self.by_word: dict[bytes, list[tuple]] = {}
        self.always: list[tuple] = []
        for k, (level, label, sure, regex) in enumerate(parse() if rules is None else rules):
            rule = (k, level, label, sure, re.compile(rb"(?<= )(?:%b)(?= )" % regex))
            for words in keywords(regex) if gated else ():
                if words:
                    self.by_word.setdefault(max(words, key=lambda w: (len(w), w)), []).append((words, rule))
                else:
                    self.always.append(rule)
            if not gated:
                self.always.append(rule)
        self.gates = self.by_word.keys()
        self.base_gates = {p.split()[0] for p, _ in BASE}

    def matches(self, text: bytes, have: set[bytes]) -> Iterator[Detection]:
        """All matches of all rules of which the text has an alternative's keywords; ``text`` is `` word word `` folded."""
        rules = {rule[0]: rule for w in self.gates & have for words, rule in self.by_word[w] if words <= have}
        rules |= {rule[0]: rule for rule in self.always}
        for _, (_, level, label, sure, regex) in sorted(rules.items()):
            at, words = 0, 0  # words before byte ``at``
            for m in regex.finditer(text):
                words += text.count(b" ", at, m.start())
                at = m.start()
                yield Detection(level, label, sure, words - 1, words + m.group().count(b" "))

    @staticmethod
    def resolve(found: list[Detection]) -> list[Detection]:
        """Detections that no earlier one contains: smaller levels first, then longer matches."""
        kept: list[Detection] = []
        starts: list[int] = []
        reach: list[int] = []
        for level in sorted({d.level for d in found}):
            far, new = -1, []
            for d in sorted((d for d in found if d.level == level), key=lambda d: (d.start, -d.end, -d.score, d.label)):
                above = bisect_right(starts, d.start)
                if d.end > far and not (above and reach[above - 1] >= d.end):
                    new.append(d)
                    far = d.end
            kept = sorted(kept + new, key=lambda d: (d.start, d.end))
            starts, reach, far = [], [], -1
            for d in kept:
                far = max(far, d.end)
                starts.append(d.start)
                reach.append(far)
        return kept

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, str]], list[Detection]]:
        """Number of words, base places (first word, label), resolved detections."""
        words = fold_words(data(text))
        have = set(words)
        if not (self.always or have & self.gates or have & self.base_gates):
            return len(words), [], []
        folded = b" %b " % b" ".join(words)
        places = []
        for phrase, label in BASE:
            phrase, at, before = b" %b " % phrase, -1, 0
            while (to := folded.find(phrase, at + 1)) >= 0:
                before += folded.count(b" ", max(at, 0), to)
                places.append((before, label))
                at = to
        return len(words), sorted(places), self.resolve(list(self.matches(folded, have)))


SCANNED = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
           "score double, detections array<struct<label: string, score: double, start: long, stop: long>>")


def license_scan(docs: DataFrame, rules: list | None = None) -> DataFrame:
    """One row per document: base places, labels, score and the resolved detections by word.

    ``score`` is the largest confidence of a detection, at least 0.5 where a base phrase stands, 0
    where nothing does. A null or empty text has no words and empty labels. Equal matches of one
    level are one detection, the surer rule's. Repeated rows are scanned each; other columns aren't
    read. Every text is scanned whole; no document leaves its task.
    """
    spot = pa.struct([("label", pa.string()), ("score", pa.float64()), ("start", pa.int64()), ("stop", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("detections", pa.list_(spot))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)

        def one(doc_id: int | None, text: str | None) -> tuple:
            n, places, found = scanner.scan(text)
            base = {x for _, x in places}
            score = max([d.score for d in found] + [BASE_SCORE] * bool(places), default=0.0)
            return (doc_id, n, len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(base)),
                    ",".join(sorted(base | {d.label for d in found})), score,
                    [{"label": d.label, "score": d.score, "start": d.start, "stop": d.end} for d in found])

        yield from arrow_rows(schema, (one(i.as_py(), t.as_py()) for b in batches for i, t in zip(b.column(0), b.column(1))))

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, SCANNED)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and the ordered signature rules over every whole document."""
    return license_scan(documents(spark, sf_dir))
