"""Format-preserving Feistel pseudonyms for personal data.

Validated values are replaced by a keyed permutation within their own format, so equal values get equal pseudonyms in
every document, distinct values distinct ones, and the key's owner can invert them:
- email: letters and digits of the local part and of host labels before the last two, each within its class;
- phone: the digits after the country code of a number of 7 to 15 digits that starts with +, in any grouping; the ten digits of
  (nnn) nnn-nnnn, nnn-nnn-nnnn, nnn.nnn.nnnn and nnn nnn nnnn;
- ip: IPv4 addresses with octets up to 255;
- card: 13 to 19 digits that pass the Luhn check, check digit renewed; together, in fours, or 4-6-5 and 4-6-4;
- ssn: nnn-nn-nnnn in assigned ranges;
- iban: check digits valid (mod 97), renewed; in fours if the country's length is known;
- date: calendar dates 1900 to 2099, as yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, dd/mm/yyyy (or mm/dd/yyyy where only that is a date);
  with slashes or dots, day and month may have one digit, and keep as many as they have.
Values that fail validation are left as they are. The permutation is a balanced Feistel network (BLAKE2b rounds as wide as a half, tweaked by kind)
on the smallest even number of bits that holds the format's values, walked until it falls within them. Like any permutation it may
have a fixed point, one in as many as the format has values.

A map over rows: no exchange. Nulls and edges: a null text stays null and counts nothing; empty texts stay. Texts are treated
whole. Repeated rows and null ids are returned one for one; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "phone", "ip", "card", "ssn", "iban", "date")


def _stream(base, r: int, v: bytes, width: int) -> int:
    """Round function: ``width`` keyed digest bytes of a round and a half, 64 to a block."""
    out = []
    for block in range(-(-width // 64)):
        h = base.copy()
        h.update(bytes([r]) + block.to_bytes(4, "big") + v)
        out.append(h.digest())
    return int.from_bytes(b"".join(out)[:width], "big")


def permute(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed bijection of range(size), whatever its size; ``back`` inverts it."""
    if size < 2:
        return x
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    base = hashlib.blake2b(f"{tweak}|{size}".encode(), key=key, digest_size=64)
    while True:
        a, b = x >> half, x & mask
        for r in order:
            f = _stream(base, r, (a if back else b).to_bytes(width, "big"), width) & mask
            if back:
                a, b = b ^ f, a
            else:
                a, b = b, a ^ f
        x = (a << half) | b
        if x < size:
            return x


CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


#: Longer values are permuted in blocks of this many characters, so that time stays in proportion to their length.
BLOCK = 512


def permute_string(s: str, key: bytes, tweak: str, back: bool = False) -> str:
    """Each ASCII letter or digit moves within its class, all together; the rest stays.

    Beyond ``BLOCK`` characters, blocks are chained once from either end, each tweaked by what its pass has
    made so far, so that every character depends on all others and the whole stays a permutation.
    """
    tweak += "|" + _layout(s)
    blocks = [s[i : i + BLOCK] for i in range(0, len(s), BLOCK)]
    if len(blocks) < 2:
        return _permute_block(s, key, tweak, back)
    there = range(len(blocks))
    for which in (1, 0) if back else (0, 1):
        chain = hashlib.blake2b(f"{tweak}|{which}".encode(), key=key, digest_size=16)
        made = blocks.copy()
        # A pass runs over its blocks in one order both ways: what tweaks a block is the pass's output before it.
        for i in there if which == 0 else reversed(there):
            made[i] = _permute_block(blocks[i], key, chain.hexdigest(), back)
            chain.update((blocks[i] if back else made[i]).encode())
        blocks = made
    return "".join(blocks)


def _layout(s: str) -> str:
    """What a permutation keeps: length, classes and marks, as a digest where it is long."""
    shape = "".join(next((c[0] for c in CLASSES if ch in c), ch) for ch in s)
    return shape if len(shape) <= 64 else hashlib.blake2b(shape.encode(), digest_size=16).hexdigest()


def _permute_block(s: str, key: bytes, tweak: str, back: bool) -> str:
    """One mixed-radix number of all letters and digits."""
    alphabets = [next((c for c in CLASSES if ch in c), "") for ch in s]
    value, size = 0, 1
    for ch, c in zip(s, alphabets, strict=True):
        if c:
            value = value * len(c) + c.index(ch)
            size *= len(c)
    value = permute(value, size, key, tweak, back)
    out = []
    for ch, c in zip(reversed(s), reversed(alphabets), strict=True):
        if c:
            value, k = divmod(value, len(c))
            out.append(c[k])
        else:
            out.append(ch)
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _relayout(layout: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if ch.isdigit() else ch for ch in layout)


def _digits(s: str) -> str:
    return "".join(ch for ch in s if ch.isdigit())


def _card(s, key, back):
    d = _digits(s)
    if not 13 <= len(d) <= 19 or luhn(d[:-1]) != int(d[-1]):
        return None
    n = len(d) - 1
    body = f"{permute(int(d[:-1]), 10**n, key, 'card', back):0{n}d}"
    return _relayout(s, body + str(luhn(body)))


# Country codes of one and two digits; all others have three.
COUNTRY = re.compile("[017]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|...")


def _phone(s, key, back):
    d = _digits(s)
    at = COUNTRY.match(d).end() if s[0] == "+" else 0
    n = len(d) - at
    body = f"{permute(int(d[at:]), 10**n, key, 'phone', back):0{n}d}"
    return _relayout(s, d[:at] + body)


def _ip(s, key, back):
    octets = [int(x) for x in s.split(".")]
    if max(octets) > 255:
        return None
    v = permute(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ip", back)
    return ".".join(map(str, v.to_bytes(4, "big")))


AREAS = [a for a in range(1, 900) if a != 666]
AREA_AT = {a: i for i, a in enumerate(AREAS)}


def _ssn(s, key, back):
    a, g, n = (int(x) for x in s.split("-"))
    if a not in AREA_AT or not g or not n:
        return None
    v = permute((AREA_AT[a] * 99 + g - 1) * 9999 + n - 1, len(AREAS) * 99 * 9999, key, "ssn", back)
    v, n = divmod(v, 9999)
    a, g = divmod(v, 99)
    return f"{AREAS[a]:03d}-{g + 1:02d}-{n + 1:04d}"


def _mod97(s: str) -> int:
    return int("".join(str(int(ch, 36)) for ch in s)) % 97


def _iban(s, key, back):
    t = s.replace(" ", "")
    if _mod97(t[4:] + t[:4]) != 1:
        return None
    body = permute_string(t[4:], key, "iban" + t[:2], back)
    it = iter(f"{t[:2]}{98 - _mod97(body + t[:2] + '00'):02d}{body}")
    return "".join(ch if ch == " " else next(it) for ch in s)


FIRST, LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def _date(s, key, back):
    sep = next(ch for ch in s if not ch.isdigit())
    p = [int(x) for x in s.split(sep)]
    width = [len(x) for x in s.split(sep)]
    # What a form stands for: positions of year, month and day. The pseudonym must be read by the same rule.
    forms = [(0, 1, 2)] if width[0] == 4 else [(2, 1, 0)] if sep == "." else [(2, 1, 0), (2, 0, 1)]
    for k, (y, m, d) in enumerate(forms):
        try:
            o = datetime.date(p[y], p[m], p[d]).toordinal()
        except ValueError:
            continue
        if not FIRST <= o <= LAST:
            return None
        while True:
            o = FIRST + permute(o - FIRST, LAST - FIRST + 1, key, f"date{k}" if k else "date", back)
            t = datetime.date.fromordinal(o)
            q = [0, 0, 0]
            q[y], q[m], q[d] = t.year, t.month, t.day
            # A date that day-first order also reads would be inverted by that order; numbers keep their width.
            if (k == 0 or t.day > 12) and all(v < 10**w for v, w in zip(q, width, strict=True)):
                break
        return sep.join(f"{v:0{w}d}" for v, w in zip(q, width, strict=True))
    return None


def _email(s, key, back):
    local, _, host = s.partition("@")
    labels = host.split(".")
    inner = ".".join(labels[:-2])
    moved = permute_string(f"{local}@{inner}", key, "email", back)
    local, _, inner = moved.partition("@")
    return f"{local}@{inner}{'.' if inner else ''}{'.'.join(labels[-2:])}"


# What each kind looks like before validation.
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9])", re.ASCII)
# Countries by the length of their IBAN, so that a spaced one ends where it should and takes no word that follows.
IBANS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
SPACED = "|".join(f"(?:{c.replace(' ', '|')})\\d\\d(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBANS.items())
NUMBERS = re.compile(
    r"(?P<phone>(?<![\d+])\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d+])\+\d(?:[ .-]?\(?\d\)?){6,14}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)"
    r"|(?<![A-Za-z0-9+])(?<!\d[.-])(?:\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4})(?![.-]?\d)|(?<![A-Za-z0-9+])(?<!\d[ .-])\d{3} \d{3} \d{4}(?![ .-]?\d))"
    r"|(?P<ip>(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d))"
    r"|(?P<date>(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])|(?<![\d.])\d{1,2}\.\d{1,2}\.\d{4}(?!\.?\d)|(?<![\d/])(?:\d{1,2}/\d{1,2}/\d{4}|\d{4}/\d{1,2}/\d{1,2})(?![\d/]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\dA-Za-z])(?:\d{4}[ -]){3}\d{1,7}(?![\dA-Za-z])|(?<![\dA-Za-z])\d{4}[ -]\d{6}[ -]\d{4,5}(?![\dA-Za-z])|(?<![\dA-Za-z])\d{13,19}(?![\dA-Za-z]))"
    r"|(?P<iban>(?<![A-Za-z0-9])(?:[A-Z]{2}\d{2}[A-Z0-9]{11,30}|" + SPACED + r")(?![A-Za-z0-9]))",
    re.ASCII,
)
DIGIT = re.compile("[0-9]")
RULES = {"phone": _phone, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "iban": _iban, "email": _email}


@lru_cache(maxsize=65536)
def pseudonym(kind: str, value: str, key: bytes, back: bool = False) -> str | None:
    """The value's pseudonym (with ``back``, the value of a pseudonym); None if it is not valid for its kind."""
    return RULES[kind](value, key, back)


def rewrite(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int]]:
    counts: dict[str, int] = {}

    def swap(kind, value):
        new = pseudonym(kind, value, key, back)
        if new is None:
            return value
        counts[kind] = counts.get(kind, 0) + 1
        return new

    if not DIGIT.search(text) and "@" not in text:
        return text, counts
    mails = [(m.start(), m.end(), swap("email", m[0])) for m in EMAIL.finditer(text)] if "@" in text else []
    out, at = [], 0
    for a, b, new in [*mails, (len(text), len(text), "")]:
        out.append(NUMBERS.sub(lambda m: swap(m.lastgroup, m[0]), text[at:a]))
        out.append(new)
        at = b
    return "".join(out), counts


def pseudonymise(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text with pseudonyms, and a count per kind."""

    def run(batches):
        for batch in batches:
            texts, counts = [], {k: [] for k in KINDS}
            for t in batch.column("text"):
                t = t.as_py()
                new, found = (None, {}) if t is None else rewrite(t, key, back)
                texts.append(new)
                for k in KINDS:
                    counts[k].append(found.get(k, 0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), *(pa.array(counts[k], pa.int64()) for k in KINDS)], names=["doc_id", "text", *(f"n_{k}" for k in KINDS)])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS))
