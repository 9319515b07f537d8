"""Format-preserving pseudonyms for personal data.

Card numbers, IBANs, social security numbers, telephone numbers, IPv4 addresses, dates, e-mail names and secret tokens
are found by pattern and validated (check digits, ranges, calendar).  Each is numbered within the set of values of its
format, and a keyed Feistel network permutes that set.  The result has the same length, separators, alphabet and valid
check digits; equal values get equal pseudonyms in every document, different values of one format stay different, and
whoever holds the key can invert the map.

Each document is handled by itself in the stage that reads it: no shuffle, no state, nothing to lose with an executor.

Defined results: a null text stays null and an empty one empty; numbers that fail validation are left alone; where
candidates overlap, the kind named first in ``KINDS`` wins; of the numbers with the same start, the first kind with a
valid reading and its longest one, but a card number with both blanks and hyphens only where nothing else fits; rows that repeat are treated alike; an empty table gives
an empty result; input columns with the names of added ones are replaced.
"""

from __future__ import annotations

import datetime
import hmac
import re
from collections.abc import Callable, Iterator
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.storage import bounded_batches

ROUNDS = 8
KINDS = ("secret", "email", "iban", "card", "ssn", "phone", "ip", "date")
ADDED = ("n_found", "found")
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
_DAYS = LAST_DAY.toordinal() - FIRST_DAY.toordinal() + 1
_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


class Permutation:
    """A keyed permutation of range(size) for any size, by unbalanced Feistel rounds and cycle walking."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.a = isqrt(size - 1) + 1 if size > 1 else 1
        self.b = -(-size // self.a)
        self.key = hmac.digest(key, f"{tweak}/{size}".encode(), "sha256")
        self.width = (max(self.a, self.b).bit_length() + 7) // 8

    def _f(self, n: int, x: int, modulus: int) -> int:
        out = blake2b(bytes([n]) + x.to_bytes(self.width, "big"), key=self.key, digest_size=min(64, self.width + 8)).digest()
        if self.width + 8 > 64:
            out = b"".join(blake2b(bytes([n, i]) + x.to_bytes(self.width, "big"), key=self.key).digest() for i in range(self.width // 64 + 2))
        return int.from_bytes(out, "big") % modulus

    def __call__(self, x: int) -> int:
        while True:
            left, right = divmod(x, self.b)
            for n in range(ROUNDS):
                if n % 2:
                    right = (right + self._f(n, left, self.b)) % self.b
                else:
                    left = (left + self._f(n, right, self.a)) % self.a
            x = left * self.b + right
            if x < self.size:
                return x

    def inverse(self, x: int) -> int:
        while True:
            left, right = divmod(x, self.b)
            for n in reversed(range(ROUNDS)):
                if n % 2:
                    right = (right - self._f(n, left, self.b)) % self.b
                else:
                    left = (left - self._f(n, right, self.a)) % self.a
            x = left * self.b + right
            if x < self.size:
                return x


def luhn_digit(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _fill(shape: str, values: str) -> str:
    """``shape`` with its letters and digits replaced by ``values`` one by one."""
    it = iter(values)
    return "".join(next(it) if c.isascii() and c.isalnum() else c for c in shape)


class Pseudonyms:
    """The map of one key.  ``replace(kind, value)`` is None where the value is not valid for its kind."""

    def __init__(self, key: bytes, invert: bool = False):
        if not key:
            raise ValueError("a key is needed")
        self.key, self.invert = key, invert
        self.permutations: dict[tuple[str, int], Permutation] = {}

    def permute(self, tweak: str, size: int, x: int) -> int:
        if (tweak, size) not in self.permutations:
            if len(self.permutations) > 10_000:
                self.permutations.clear()
            self.permutations[tweak, size] = Permutation(self.key, tweak, size)
        p = self.permutations[tweak, size]
        return p.inverse(x) if self.invert else p(x)

    def spelled(self, tweak: str, value: str, classes: tuple[str, ...] = _CLASSES) -> str:
        """Permute a string among those with the same class of characters at each place; other characters stay."""
        of = [next((c for c in classes if ch in c), "") for ch in value]
        size = x = 0
        size = 1
        for ch, c in zip(value, of):
            if c:
                size, x = size * len(c), x * len(c) + c.index(ch)
        y, out = self.permute(tweak + "".join(str(classes.index(c)) if c else ch for ch, c in zip(value, of)), size, x), []
        for ch, c in zip(reversed(value), reversed(of)):
            if c:
                y, d = divmod(y, len(c))
                ch = c[d]
            out.append(ch)
        return "".join(reversed(out))

    def replace(self, kind: str, value: str) -> str | None:
        return getattr(self, "_" + kind)(value)

    def _card(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
            return None
        while True:  # a number of one repeated digit is not accepted, so it must not come out
            body = self.spelled("card", digits[:-1])
            digits = body + str(luhn_digit(body))
            if len(set(digits)) > 1:
                return _fill(value, digits)

    def _iban(self, value: str) -> str | None:
        packed = value.replace(" ", "")
        if not 15 <= len(packed) <= 34 or iban_check(packed[:2], packed[4:]) != packed[2:4]:
            return None
        rest = self.spelled("iban" + packed[:2], packed[4:])
        return _fill(value, packed[:2] + iban_check(packed[:2], rest) + rest)

    def _ssn(self, value: str) -> str | None:
        def valid(d: str) -> bool:
            return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

        digits = re.sub(r"\D", "", value)
        if not valid(digits):
            return None
        while True:
            digits = self.spelled("ssn", digits)
            if valid(digits):
                return _fill(value, digits)

    def _phone(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not 9 <= len(digits) <= 15:
            return None
        keep = max(0, len(digits) - 10)
        return _fill(value, digits[:keep] + self.spelled("phone", digits[keep:]))

    def _ip(self, value: str) -> str | None:
        parts = value.split(".")
        if any(int(p) > 255 or (p != "0" and p[0] == "0") for p in parts):
            return None
        x = self.permute("ip", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"))
        return ".".join(map(str, x.to_bytes(4, "big")))

    def _date(self, value: str) -> str | None:
        numbers, marks = re.findall(r"\d+", value), re.findall(r"\D+", value)
        iso = len(numbers[0]) == 4
        year, month, day = map(int, numbers if iso else reversed(numbers))
        if iso or marks[0] != marks[1] or marks[0] != "/" or month <= 12:
            order = "ymd" if iso else "dmy"
        else:
            day, month, order = month, day, "mdy"
        try:
            n = datetime.date(year, month, day).toordinal() - FIRST_DAY.toordinal()
        except ValueError:
            return None
        if marks[0] != marks[1] or not 0 <= n < _DAYS:
            return None

        def written(n: int) -> str:
            d = datetime.date.fromordinal(n + FIRST_DAY.toordinal())
            part = {"y": f"{d.year:04d}", "m": f"{d.month:02d}", "d": f"{d.day:02d}"}
            return marks[0].join(part[c] for c in order)

        if order == "mdy":  # only days after the 12th read as month first, so walk among these
            while True:
                n = self.permute("date-mdy", _DAYS, n)
                if datetime.date.fromordinal(n + FIRST_DAY.toordinal()).day > 12:
                    return written(n)
        return written(self.permute("date", _DAYS, n))

    def _email(self, value: str) -> str | None:
        name, _, domain = value.rpartition("@")
        if ".." in domain or "." not in domain or domain[0] in ".-":
            return None
        return self.spelled("email@" + domain.lower(), name) + "@" + domain

    def _secret(self, value: str) -> str | None:
        if re.fullmatch(r"[0-9a-f]+", value):
            return self.spelled("secret", value, ("0123456789abcdef",))
        return self.spelled("secret", value)


#: The ways to write numbers, by kind, in order of precedence.
_WRITTEN = {
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "card": r"\d(?:[ -]?\d){12,18}",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "phone": r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}|\+\d{9,15}",
    "ip": r"\d{1,3}(?:\.\d{1,3}){3}",
    "date": r"\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}",
}
_LONGEST = 43  # characters of an IBAN in groups
_ENDS = r"(?![\w]|[.-]\d)"
#: The first reading at each start; the name of the group is the kind.
_NUMBERS = re.compile(r"(?<![\w.+-])(?:" + "|".join(f"(?P<{k}>{p})" for k, p in _WRITTEN.items()) + ")" + _ENDS, re.ASCII)
_END = re.compile(_ENDS, re.ASCII)
_KINDS = {k: re.compile(p, re.ASCII) for k, p in _WRITTEN.items()}
_EMAIL = re.compile(r"[^\s@<>\"'(),:;|\[\]]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_SECRET = re.compile(r"(?i:token|secret|passwo?r?d|api[_-]?key)[\"']?\s*[=:]\s*[\"']?([0-9A-Za-z+/_-]{16,})")
_DIGIT = re.compile(r"[0-9]")


def _mixed(kind: str, value: str) -> bool:
    """A card number with blanks and hyphens is more likely two values side by side."""
    return kind == "card" and " " in value and "-" in value


def _numbers(text: str, names: Pseudonyms) -> Iterator[tuple[int, int, str, str]]:
    """Valid numbers from left to right; a start without any valid reading takes nothing from what follows it."""
    at = 0
    while m := _NUMBERS.search(text, at):
        begin, end = m.span()
        kind, new = m.lastgroup, None if _mixed(m.lastgroup, m[0]) else names.replace(m.lastgroup, m[0])
        if new is None:
            for kind, end in _readings(text, begin):
                if (new := names.replace(kind, text[begin:end])) is not None:
                    break
        if new is None:
            at = begin + 1
        else:
            yield begin, end, kind, new
            at = end


def _readings(text: str, begin: int) -> Iterator[tuple[str, int]]:
    """(kind, end) of all readings at one start: kinds in order, longer before shorter, mixed card numbers last."""
    ends = [e for e in range(min(len(text), begin + _LONGEST), begin, -1) if _END.match(text, e)]
    last = []
    for kind, written in _KINDS.items():
        for end in ends:
            if written.fullmatch(text, begin, end):
                if _mixed(kind, text[begin:end]):
                    last.append((kind, end))
                else:
                    yield kind, end
    yield from last


def find(text: str, names: Pseudonyms) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, pseudonym) of all valid values, in order and without overlap."""
    found: list[tuple[int, int, str, str]] = []

    def offer(kind: str, begin: int, end: int) -> None:
        new = names.replace(kind, text[begin:end])
        if new is not None:
            found.append((begin, end, kind, new))

    if "=" in text or ":" in text:
        for m in _SECRET.finditer(text):
            offer("secret", *m.span(1))
    if "@" in text:
        for m in _EMAIL.finditer(text):
            offer("email", *m.span())
    if _DIGIT.search(text):
        found += _numbers(text, names)
    if len(found) < 2:
        return found
    rank = {k: i for i, k in enumerate(KINDS)}
    taken: list[tuple[int, int, str, str]] = []
    for x in sorted(found, key=lambda x: (x[0], rank[x[2]])):
        while taken and x[0] < taken[-1][1] and rank[x[2]] < rank[taken[-1][2]]:
            taken.pop()
        if not taken or x[0] >= taken[-1][1]:
            taken.append(x)
    return taken


def rewrite(text: str, found: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for begin, end, _, new in found:
        out += [text[at:begin], new]
        at = end
    return "".join([*out, text[at:]])


def _map(key: bytes, text_name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    spans = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for batch in batches:
            texts, lists = [], []
            for text in batch.column(text_name).to_pylist():
                found = find(text, names) if text else []
                texts.append(rewrite(text, found) if found else text)
                lists.append([{"kind": k, "begin": b, "end": e} for b, e, k, _ in found])
            columns = [pa.array(texts, pa.string()) if n == text_name else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lists, spans)], names=[*batch.schema.names, "found"])

    return run


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """The input rows with the text rewritten, ``n_found`` and ``found`` (kind, begin, end in the original text)."""
    bounded_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ADDED]
    picked = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(kept)])
    schema = T.StructType([*picked.schema.fields, *T.StructType.fromDDL("found array<struct<kind string, begin int, end int>>").fields])
    out = picked.mapInArrow(_map(key, f"_k{kept.index(text_col)}"), schema)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)], F.size("found").cast("long").alias("n_found"), "found")
