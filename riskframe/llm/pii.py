"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

Numbers, dates and addresses are found by pattern and validated (check digits, calendar, ranges);
each is mapped to another value of its own format by a permutation of all such values. Equal
values get equal pseudonyms in all documents, and the key's holder can map them back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.common import arrow_rows, bounded_batches, documents

ROUNDS = 10
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
LETTERS = "abcdefghijklmnopqrstuvwxyz"


class Feistel:
    """Keyed permutations of 0 .. n - 1 for any n, one for each tweak.

    A balanced Feistel network over the next even number of bits, walked until it falls below n.
    """

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: str, i: int, half: int, bits: int, n: int) -> int:
        h = blake2b(b"%d:%d:%d" % (n, i, half), key=self.key, person=tweak.encode()[:16], digest_size=32)
        return int.from_bytes(h.digest(), "big") & (1 << bits) - 1

    def permute(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        if n < 2:
            return x
        bits = ((n - 1).bit_length() + 1) // 2
        while True:
            a, b = x >> bits, x & (1 << bits) - 1
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                a, b = (b ^ self._round(tweak, i, a, bits, n), a) if back else (b, a ^ self._round(tweak, i, b, bits, n))
            x = a << bits | b
            if x < n:
                return x

    def digits(self, value: str, tweak: str, back: bool = False) -> str:
        return f"{self.permute(int(value), 10 ** len(value), tweak, back):0{len(value)}d}" if value else ""

    def letters(self, value: str, tweak: str, back: bool = False) -> str:
        x = 0
        for c in value:
            x = x * 26 + LETTERS.index(c)
        x, out = self.permute(x, 26 ** len(value), tweak, back), ""
        for _ in value:
            x, r = divmod(x, 26)
            out = LETTERS[r] + out
        return out


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        x = int(c) * (2 - i % 2)
        total += x - 9 if x > 9 else x
    return str(-total % 10)


def iban_digits(bban: str, country: str) -> str:
    rest = int("".join(str(int(c, 36)) for c in bban + country + "00")) % 97
    return f"{98 - rest:02d}"


def _refill(shape: str, signs: str, of) -> str:
    """``shape`` with the characters that ``of`` accepts replaced by ``signs`` in turn."""
    it = iter(signs)
    return "".join(next(it) if of(c) else c for c in shape)


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


class Pseudonyms:
    """Pseudonym of a found value, or None where it isn't valid."""

    def __init__(self, key: bytes, back: bool = False):
        self.f, self.back = Feistel(key), back

    def card(self, s: str) -> str | None:
        """13 to 19 digits that end in their check digit; the new number does too."""
        d = _digits(s)
        if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
            return None
        new = self.f.digits(d[:-1], "card", self.back)
        return _refill(s, new + luhn_digit(new), str.isdigit)

    def iban(self, s: str) -> str | None:
        """Country and valid check digits; digits and letters of the account stay such."""
        flat = s.replace(" ", "")
        if not 15 <= len(flat) <= 34 or iban_digits(flat[4:], flat[:2]) != flat[2:4]:
            return None
        bban = self._classes(flat[4:], f"iban{flat[:2]}")
        return _refill(s, flat[:2] + iban_digits(bban, flat[:2]) + bban, str.isalnum)

    def ssn(self, s: str) -> str | None:
        """Areas 001-899 without 666, groups 01-99, serials 0001-9999."""
        a, g, n = map(int, s.split("-"))
        if not (0 < a < 900 and a != 666 and g and n):
            return None
        a -= 1 + (a > 666)
        x = self.f.permute((a * 99 + g - 1) * 9999 + n - 1, 898 * 99 * 9999, "ssn", self.back)
        x, n = divmod(x, 9999)
        a, g = divmod(x, 99)
        a += 1
        return f"{a + (a >= 666):03d}-{g + 1:02d}-{n + 1:04d}"

    def phone(self, s: str) -> str | None:
        """8 to 15 digits; a country code of an international number stays."""
        d = _digits(s)
        if not 8 <= len(d) <= 15:
            return None
        keep = min(len(m[0]) - 1 if (m := re.match(r"\+\d{1,3}(?=\D)", s)) else 0, len(d) - 7)
        return _refill(s, d[:keep] + self.f.digits(d[keep:], "phone", self.back), str.isdigit)

    def address(self, s: str) -> str | None:
        """Four numbers of 0 to 255."""
        parts = [int(x) for x in s.split(".")]
        if max(parts) > 255:
            return None
        x = self.f.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "address", self.back)
        return ".".join(map(str, x.to_bytes(4, "big")))

    def date(self, s: str) -> str | None:
        """A day of 1900 to 2099 as year-month-day, day.month.year or month/day/year (the other way
        round where only that is a date); order, separators and leading zeros stay."""
        sep = next(c for c in s if not c.isdigit())
        parts = s.split(sep)
        orders = [(0, 1, 2)] if sep == "-" else [(2, 1, 0), (2, 0, 1)] if sep == "." else [(2, 0, 1), (2, 1, 0)]
        for o in orders:
            try:
                day = date(*(int(parts[i]) for i in o)).toordinal()
            except ValueError:
                continue
            if not FIRST_DAY <= day <= LAST_DAY:
                return None
            # days that both orders can read keep their order: the other days are permuted apart
            new = self._day(day, o, sep)
            out = [""] * 3
            for i, x in zip(o, (new.year, new.month, new.day)):
                out[i] = f"{x:0{len(parts[i])}d}"
            return sep.join(out)
        return None

    def _day(self, day: int, order: tuple, sep: str) -> date:
        second = sep != "-" and order != ((2, 1, 0) if sep == "." else (2, 0, 1))
        while True:
            day = FIRST_DAY + self.f.permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date", self.back)
            new = date.fromordinal(day)
            if not second or new.day > 12:  # read the other way round only where the usual one is no date
                return new

    def email(self, s: str) -> str | None:
        """Letters and digits before the last dot, each permuted among themselves."""
        head, _, top = s.lower().rpartition(".")
        return f"{self._classes(head, 'email')}.{top}"

    def _classes(self, s: str, tweak: str) -> str:
        letters = "".join(c for c in s if c.isalpha())
        s = _refill(s, self.f.digits(_digits(s), tweak + "9", self.back), str.isdigit)
        new = self.f.letters(letters.lower(), tweak + "a", self.back)
        return _refill(s, new.upper() if letters.isupper() else new, str.isalpha)


#: Kinds in order of precedence where matches overlap.
PATTERNS = {
    # no longer than mail allows: 64 signs before the @, labels of 63, here eight of them and a last one
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,7}\.[A-Za-z]{2,63}(?![A-Za-z0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4})(?![0-9/-]|\.[0-9])",
    "address": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])|\+[0-9]{1,3}(?:[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})){2,4}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
_COMPILED = {k: re.compile(p) for k, p in PATTERNS.items()}
_MARK = re.compile("[0-9@]")


class Replacer:
    """Finds and replaces; pseudonyms of values met before are kept, up to a bound."""

    def __init__(self, key: bytes, back: bool = False):
        names = Pseudonyms(key, back)
        self.of = {k: lru_cache(50_000)(getattr(names, k)) for k in PATTERNS}

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """New text and the (start, end, kind) of what was replaced, in characters of the old."""
        if not _MARK.search(text):
            return text, []
        found: list[tuple[int, int, str, str]] = []
        for kind, pattern in _COMPILED.items():
            if kind == "email" and "@" not in text:
                continue
            own = [(m.start(), m.end(), kind, new) for m in pattern.finditer(text) if (new := self.of[kind](m[0])) is not None]
            if own:
                found = self._apart(found, own)
        out, at = [], 0
        for start, end, _, new in found:
            out += [text[at:start], new]
            at = end
        return "".join([*out, text[at:]]), [f[:3] for f in found]

    @staticmethod
    def _apart(found: list[tuple], own: list[tuple]) -> list[tuple]:
        """Matches by start, without those of ``own`` that overlap one of ``found``; neither overlaps itself."""
        fit, i = [], 0
        for f in own:
            while i < len(found) and found[i][1] <= f[0]:
                i += 1
            if i == len(found) or found[i][0] >= f[1]:
                fit.append(f)
        return sorted(found + fit)


#: Key of the registered query; a production run passes its own secret.
DEMO_KEY = b"pseudonyms of the test tables"
FOUND = "doc_id long, text string, n_found long, spans string"


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """One row per document: doc_id, text with pseudonyms, n_found, spans (``kind:start:end`` in
    code points of the input, by start, comma-joined).

    Values that fail their check (and so aren't of the kind) stay. Where kinds overlap the earlier
    of ``PATTERNS`` stands. A null text stays null with nothing found; an empty one is empty. Equal
    values get equal pseudonyms in every row, however they are separated. Repeated rows come out
    alike; other columns aren't read. Texts are read whole and no document leaves its task.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_found", pa.int64()), ("spans", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replacer = Replacer(key)

        def one(doc_id: int | None, text: str | None) -> tuple:
            new, spans = replacer.replace(text or "")
            return doc_id, None if text is None else new, len(spans), ",".join(f"{k}:{s}:{e}" for s, e, k in spans)

        yield from arrow_rows(schema, (one(i.as_py(), t.as_py()) for b in batches for i, t in zip(*b.columns)), 500)

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, FOUND)


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated personal data of every whole document under format-preserving pseudonyms."""
    return pseudonymise(documents(spark, sf_dir), DEMO_KEY)
