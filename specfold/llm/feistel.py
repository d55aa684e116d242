"""Format-preserving pseudonyms for personal data.

Validated numbers and dates are replaced by others of the same format: a keyed Feistel network
permutes the format's domain, and values that leave it are permuted again until they are back
(cycle walking). Equal values get equal pseudonyms in all documents, different values of a format
different ones, and whoever has the key can undo them.

Kinds, in order of precedence where they overlap: e-mail address (letters and digits of all but
the last label, class by class), IBAN (mod 97; country kept, check digits recomputed), payment
card (13 to 19 digits, Luhn; check digit recomputed), social security number, telephone number (8 to
15 digits after + and country code, which is kept, or ten in the forms (999) 999-9999 and
999-999-9999), IPv4 address, date (1900 to 2099 as y-m-d, d.m.y, d/m/y or, where only that is a
date, m/d/y; the day count is permuted). Separators, brackets and letter case stay. A number that is not
valid as a card or IBAN because more digits or words follow it is tried again up to each separator in it, longest first.
As a pseudonym may form a valid longer number with what follows it, such a value is undone by its span, not by search.

Texts without such values are returned as they are. Null text: null, no values. Empty text:
empty. Repeated rows are treated alike. A null doc_id stays null; an empty table gives no rows. A
single pass without shuffle; memory is bounded by an Arrow batch.
"""

from __future__ import annotations

import bisect
import contextlib
import datetime
import heapq
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specfold.llm.common import trimmed
from specfold.llm.encode import chunks

ROUNDS = 10
_DAY0 = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _DAY0 + 1


def _noise(key: bytes, tweak: str, i: int, x: int, below: int) -> int:
    digest = hashlib.blake2b(f"{tweak}:{i}:{x}".encode(), key=key, digest_size=32).digest()
    return int.from_bytes(digest, "big") % below


def permute(key: bytes, tweak: str, x: int, size: int, fits: Callable[[int], bool] = lambda _: True, back: bool = False) -> int:
    """A keyed permutation of the numbers below size that fit; x is one of them."""
    a = 1
    while a * a < size:
        a <<= 1
    b = -(-size // a)
    rounds = range(ROUNDS)[:: -1 if back else 1]
    sign = -1 if back else 1
    while True:
        left, right = divmod(x, b)
        for i in rounds:
            if i % 2:
                right = (right + sign * _noise(key, tweak, i, left, b)) % b
            else:
                left = (left + sign * _noise(key, tweak, i, right, a)) % a
        x = left * b + right
        if x < size and fits(x):
            return x


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _refill(shape: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _mixed(key: bytes, tweak: str, s: str, back: bool) -> str:
    """Permutes the ASCII letters and digits of s, class by class and case by case."""
    size, x = 1, 0
    for c in s:
        base, first = (10, "0") if "0" <= c <= "9" else (26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else (1, c)
        size, x = size * base, x * base + ord(c) - ord(first)
    if size == 1:
        return s
    x = permute(key, tweak, x, size, back=back)
    out = []
    for c in reversed(s):
        base, first = (10, "0") if "0" <= c <= "9" else (26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else (1, c)
        x, n = divmod(x, base)
        out.append(chr(ord(first) + n))
    return "".join(reversed(out))


def _email(s: str, key: bytes, back: bool) -> str | None:
    at = s.rindex(".")
    return _mixed(key, f"email{re.sub('[0-9]', '0', re.sub('[a-zA-Z]', 'a', s[:at]))}", s[:at], back) + s[at:]


def _iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02}"


def _iban(s: str, key: bytes, back: bool) -> str | None:
    plain = s.replace(" ", "")
    if not 15 <= len(plain) <= 34 or int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    rest = _mixed(key, f"iban{plain[:2]}", plain[4:], back)
    it = iter(plain[:2] + _iban_check(plain[:2], rest) + rest)
    return "".join(c if c == " " else next(it) for c in s)


def _card(s: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"\D", "", s)
    if not 13 <= len(digits) <= 19 or not luhn(digits) or digits[0] == "0":
        return None
    n = len(digits) - 1
    body = str(permute(key, f"card{n}", int(digits[:-1]), 10**n, lambda x: x >= 10 ** (n - 1), back))
    return _refill(s, body + next(c for c in "0123456789" if luhn(body + c)))


def _ssn_fits(x: int) -> bool:
    area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(s: str, key: bytes, back: bool) -> str | None:
    x = int(s.replace("-", ""))
    return _refill(s, f"{permute(key, 'ssn', x, 10**9, _ssn_fits, back):09}") if _ssn_fits(x) else None


def _phone(s: str, key: bytes, back: bool) -> str | None:
    lead = re.match(r"\+\d{1,3}(?=\D)", s)
    head = lead.group() if lead else s[:3] if s[0] == "+" else ""
    digits = re.sub(r"\D", "", s[len(head) :])
    if not (8 <= len(digits) + len(head) - 1 <= 15 if head else len(digits) == 10):
        return None
    return head + _refill(s[len(head) :], f"{permute(key, f'phone{head}/{len(digits)}', int(digits), 10 ** len(digits), back=back):0{len(digits)}}")


def _ip(s: str, key: bytes, back: bool) -> str | None:
    parts = s.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    x = permute(key, "ip", int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, back=back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _day(y: str, m: str, d: str) -> datetime.date | None:
    try:
        found = datetime.date(int(y), int(m), int(d))
    except ValueError:
        return None
    return found if 1900 <= found.year <= 2099 else None


def _date(s: str, key: bytes, back: bool) -> str | None:
    sep = re.search(r"\D", s).group()
    a, b, c = s.split(sep)
    order = "ymd" if len(a) == 4 else "dmy"
    day = _day(a, b, c) if order == "ymd" else _day(c, b, a)
    fits: Callable[[int], bool] = lambda _: True
    if day is None and sep == "/" and order == "dmy" and (day := _day(c, a, b)):
        order, fits = "mdy", lambda x: datetime.date.fromordinal(_DAY0 + x).day > 12
    if day is None:
        return None
    new = datetime.date.fromordinal(_DAY0 + permute(key, "date", day.toordinal() - _DAY0, _DAYS, fits, back))
    return sep.join({"y": f"{new.year:04}", "m": f"{new.month:02}", "d": f"{new.day:02}"}[o] for o in order)


_OUT = r"(?<![\w])(?<!\d[.,-])"
_END = r"(?![\w])(?![.,-]\d)"
#: kind, a string that a text must hold (None: a digit), candidate, pseudonym or None if not valid
KINDS: tuple[tuple[str, str | None, re.Pattern, Callable[[str, bytes, bool], str | None]], ...] = (
    ("email", "@", re.compile(r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w])"), _email),
    ("iban", None, re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"), _iban),
    ("card", None, re.compile(_OUT + r"\d(?:[ -]?\d){12,18}" + _END), _card),
    ("ssn", None, re.compile(_OUT + r"\d{3}-\d{2}-\d{4}" + _END), _ssn),
    ("phone", None, re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<!\d[.,-])\d{3}([.-])\d{3}\1\d{4})" + _END), _phone),
    ("ip", None, re.compile(r"(?<![\w])(?<!\d\.)\d{1,3}(?:\.\d{1,3}){3}(?![\w])(?!\.\d)"), _ip),
    ("date", None, re.compile(_OUT + r"(?:(?:19|20)\d\d([-/.])\d{2}\1\d{2}|\d{2}([./])\d{2}\2(?:19|20)\d\d)" + _END), _date),
)
_DIGIT = re.compile("[0-9]")
#: What separates the groups of the kinds whose candidates may run on into what follows.
_CUTS = {"iban": " ", "card": " -"}


def candidates(text: str, kind: str, pattern: re.Pattern) -> Iterator[tuple[int, list[int]]]:
    """Start of each candidate and its possible ends, longest first. The next one begins behind the end that is sent back; if none is, behind the next separator inside, so that a number behind another group is seen."""
    at, cut = 0, _CUTS.get(kind, "")
    while m := pattern.search(text, at):
        start, end = m.span()
        breaks = [i for i in range(start + 1, end) if text[i] in cut] if cut else []
        taken = yield start, [end, *(i for i in reversed(breaks) if pattern.fullmatch(text, start, i))]
        at = taken or (breaks[0] + 1 if breaks else end)


def _outdone(text: str, pattern: re.Pattern, start: int, end: int, whole: int, cut: str, valid: Callable[[str], bool]) -> bool:
    """Whether a shortened candidate is chance: a longer valid one, not shortened, begins behind a separator inside."""
    for i in range(start + 1, whole):
        if text[i] in cut and (m := pattern.match(text, i + 1)) and m.end() > end and m.end() - m.start() > end - start and valid(m.group()):
            return True
    return False


def found(text: str, key: bytes, back: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the values in a text, in order."""
    has_digit = _DIGIT.search(text) is not None
    out: list[tuple[int, int, str, str]] = []  # in order, none overlaps another
    for kind, needs, pattern, change in KINDS:
        if needs not in text if needs else not has_digit:
            continue
        tried, taken, own = candidates(text, kind, pattern), None, []
        valid = lambda s, f=change: f(s, key, back) is not None
        with contextlib.suppress(StopIteration):
            while True:
                start, ends = tried.send(taken)
                taken = None
                for end in ends:
                    before = bisect.bisect_left(out, (end,)) - 1  # the last span that begins ahead of this end
                    if (before < 0 or out[before][1] <= start) and (new := change(text[start:end], key, back)) is not None:
                        if end != ends[0] and _outdone(text, pattern, start, end, ends[0], _CUTS[kind], valid):
                            break
                        own.append((start, end, kind, new))
                        taken = end
                        break
        out = list(heapq.merge(out, own))
    return out


def replaced(text: str, spans: list[tuple[int, int, str, str]]) -> str:
    parts, at = [], 0
    for start, end, _, new in spans:
        parts += text[at:start], new
        at = end
    return "".join([*parts, text[at:]]) if parts else text


def pseudonymize(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """docs: doc_id, text. Adds nothing else: rows are doc_id, text (with pseudonyms), spans (array of kind, start, end in the given text).

    back undoes it with the same key.
    """
    return pseudonymize_columns(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), key, back)


def pseudonymize_columns(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """As pseudonymize, with all columns of docs kept; spans replaces a column of that name."""
    docs = docs.drop("spans")
    names = docs.columns
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                texts, spans = [], []
                for text in part.column("text").to_pylist():
                    own = found(text, key, back) if text else []
                    texts.append(replaced(text, own) if own else text)
                    spans.append([{"kind": k, "start": a, "end": b} for a, b, k, _ in own])
                columns = [pa.array(texts, pa.string()) if n == "text" else part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], [*names, "spans"])

    out = T.StructType([*docs.schema.fields, T.StructField("spans", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    return docs.mapInArrow(trimmed(run), out)
