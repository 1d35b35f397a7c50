"""Personal data: pseudonyms of the same format from a keyed Feistel permutation.

Found and validated: e-mail addresses, telephone numbers, IPv4 addresses, payment cards
(Luhn), bank accounts (IBAN, modulo 97), social security numbers, calendar dates and
quoted hexadecimal secrets. Each value is mapped within its own format: a card stays a
valid card with the same separators, a date a real date in the same notation, an
address keeps letters as letters and digits as digits. The permutation depends on key
and format only, so equal values stay linked across documents, and ``restore`` with the
key gives the values back. What does not validate is left alone.

Only rows with a digit or an at sign reach Python; all others stay in the JVM.

Defined results: a NULL text stays NULL and an empty one empty, both with no spans;
repeated rows get equal results; other columns and their names do not matter; an empty
table gives an empty result. Texts are taken whole, in time in proportion to their length
whatever they hold; an address whose name has more than 64 characters is none.
"""

from __future__ import annotations

import datetime
import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from foliant.llm.common import let

KEY = "foliant-pseudonyms"
SPAN = "array<struct<kind:string,start:int,length:int,pseudonym:string>>"
ROUNDS = 8


def _noise(key: bytes, tweak: bytes, turn: int, value: int, size: int) -> int:
    """A number below ``size`` that depends on everything else."""
    width = (size.bit_length() + 7) // 8 + 8
    text = tweak + bytes([turn]) + value.to_bytes((value.bit_length() + 7) // 8 or 1, "big")
    out = b""
    while len(out) < width:
        out += hashlib.blake2b(text + len(out).to_bytes(4, "big"), key=key, digest_size=32).digest()
    return int.from_bytes(out[:width], "big") % size


def permute(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A permutation of range(``size``): Feistel rounds over two halves, walked until back in range."""
    if size < 2:
        return value
    half = 1
    while half * half < size:
        half = half * 2
    low = half
    while low > 1 and half * (low // 2) >= size:
        low //= 2
    while True:
        left, right = divmod(value, low)
        turns = range(ROUNDS)
        for turn in reversed(turns) if back else turns:
            if turn % 2:
                step = _noise(key, tweak, turn, left, low)
                right = (right + (-step if back else step)) % low
            else:
                step = _noise(key, tweak, turn, right, half)
                left = (left + (-step if back else step)) % half
        value = left * low + right
        if value < size:
            return value


# --- formats: the value as a number below a size, and back ---------------------------

def _spread(digits: str, text: str) -> str:
    """``digits`` in place of the digits of ``text``."""
    left = iter(digits)
    return "".join(next(left) if c in "0123456789" else c for c in text)


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(digits: str) -> int:
    """The sum that is a multiple of ten for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10


def _card(text, turn):
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or luhn(digits) or not digits.strip("0"):
        return None
    n = len(digits) - 1
    body = str(turn(int(digits[:-1]), 10**n, f"card{n}")).zfill(n)
    check = -luhn(body + "0") % 10
    return _spread(body + str(check), text)


def _phone(text, turn):
    digits = _digits(text)
    if not 7 <= len(digits) <= 15:
        return None
    # A country code in front of brackets or a first blank stays.
    head = re.match(r"\+[0-9]{1,3}(?=[ .(-])", text)
    keep = len(head[0]) - 1 if head else 0
    n = len(digits) - keep
    return _spread(digits[:keep] + str(turn(int(digits[keep:]), 10**n, f"phone{n}")).zfill(n), text)


def _ipv4(text, turn):
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    value = turn(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ipv4")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _ssn(text, turn):
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    value = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    value = turn(value, len(areas) * 99 * 9999, "ssn")
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _mixed(text, turn, tweak):
    """Digits stay digits, small letters small and capitals capital; the rest stays."""
    value, size = 0, 1
    for c in text:
        base, zero = (10, "0") if c in "0123456789" else (26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else (1, c)
        value, size = value * base + ord(c) - ord(zero), size * base
    kinds = re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "0", text)))
    value = turn(value, size, tweak + kinds)
    out = []
    for c in reversed(text):
        base, zero = (10, "0") if c in "0123456789" else (26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else (1, c)
        value, d = divmod(value, base)
        out.append(chr(ord(zero) + d))
    return "".join(reversed(out))


def _email(text, turn):
    body, dot, top = text.rpartition(".")
    # One spelling, one pseudonym: capitals are put back where they were.
    told = _mixed(body.lower(), turn, "email") + dot + top
    return "".join(t.upper() if c.isupper() else t for t, c in zip(told, text))


def _iban(text, turn):
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return None
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _mixed(plain[4:], turn, "iban" + plain[:2])
    told = iter(plain[:2] + f"{98 - number(body + plain[:2] + '00') % 97:02d}" + body)
    return "".join(c if c == " " else next(told) for c in text)


_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
_END = datetime.date.max.toordinal()


def _date(text, turn):
    a, b, c = map(int, re.split(r"[-/.]", text))
    order = "ymd" if len(re.match(r"[0-9]+", text)[0]) == 4 else "dmy" if b <= 12 else "mdy"
    year, month, day = {"ymd": (a, b, c), "dmy": (c, b, a), "mdy": (c, a, b)}[order]
    try:
        at = datetime.date(year, month, day).toordinal()
    except ValueError:
        return None
    while True:
        if _FIRST <= at <= _LAST:
            at = _FIRST + turn(at - _FIRST, _LAST - _FIRST + 1, "date")
        else:
            # The other years, in one row.
            gap = _LAST - _FIRST + 1
            at = turn(at - 1 - (gap if at > _LAST else 0), _END - gap, "date-far") + 1
            at += gap if at >= _FIRST else 0
        told = datetime.date.fromordinal(at)
        # A month in front is only told from a day where the day is above twelve.
        if order != "mdy" or told.day > 12:
            break
    year, month, day = f"{told.year:04d}", f"{told.month:02d}", f"{told.day:02d}"
    parts = {"ymd": (year, month, day), "dmy": (day, month, year), "mdy": (month, day, year)}[order]
    return re.search(r"[-/.]", text)[0].join(parts)


def _secret(text, turn):
    zero = "0123456789ABCDEF" if text.upper() == text else "0123456789abcdef"
    try:
        value = turn(int(text, 16), 1 << 4 * len(text), f"hex{len(text)}")
    except ValueError:
        return None
    told = f"{value:0{len(text)}x}"
    return told.upper() if zero[-1] == "F" else told


KINDS = {
    "email": (_email, r"[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "secret": (_secret, r"(?<=[=:]\s[\"'])[0-9A-Fa-f]{32,128}(?=[\"'])|(?<=[=:][\"'])[0-9A-Fa-f]{32,128}(?=[\"'])|(?<![0-9A-Za-z])(?:[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{32})(?![0-9A-Za-z])"),
    "iban": (_iban, r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
    "date": (_date, r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}-[0-9]{1,2}-[0-9]{4})(?![0-9/-]|\.[0-9])"),
    "ssn": (_ssn, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "ipv4": (_ipv4, r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    "card": (_card, r"(?<![0-9+])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"),
    "phone": (_phone, r"(?<![0-9])\+1[ .-]?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|(?<![0-9])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])|(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-]?[0-9])"),
}


# A mailbox name of more characters is no valid one.
LONGEST_NAME = 64
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
NAME = re.compile(r"[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*")


def finder():
    """All kinds but e-mail; no pattern looks further than its own value is long."""
    return re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, (_, pattern) in KINDS.items() if kind != "email"))


def _addresses(text: str) -> list[tuple[int, int, int]]:
    """(first place of the name, place of the at sign, end) of e-mail addresses.

    Names are read backwards from their at sign, so that no run of letters is looked at twice.
    """
    out, before = [], 0
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        name = domain and NAME.match(text[max(before, at - LONGEST_NAME - 2) : at][::-1])
        if name and len(name[0]) <= LONGEST_NAME:
            out.append((at - len(name[0]), at, domain.end()))
        before = at + 1
        at = text.find("@", before)
    return out


DOUBLED = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def _card_end(found: str) -> int:
    """How much of ``found`` is the longest valid card that digits do not follow at once; 0 if none is."""
    n, best, sums = 0, 0, [0, 0]
    for at, c in enumerate(found):
        if c in " -":
            continue
        d = ord(c) - 48
        # By parity of the number's length: which digits count double.
        sums[n & 1] += DOUBLED[d]
        sums[~n & 1] += d
        n += 1
        if n >= 13 and sums[n & 1] % 10 == 0 and found[at + 1 : at + 2] in (" ", "-", ""):
            best = at + 1
    return best


def _valid(kind: str, found: str, start: int, turn) -> tuple[int, str | None]:
    """End and pseudonym of the value ``found`` at ``start``; a card may be followed by other digits."""
    if kind == "card":
        found = found[: _card_end(found)]
    return start + len(found), KINDS[kind][0](found, turn) if found else None


def replace_all(text: str, key: bytes, pattern=None, back: bool = False) -> tuple[str, list[tuple[str, int, int, str]]]:
    """``text`` with its values mapped, and (kind, start, length, pseudonym) of each, in code points of the result."""
    pattern = pattern or finder()
    turn = lambda value, size, tweak: permute(value, size, key, tweak.encode(), back)
    out, spans, at, size = [], [], 0, 0
    addresses = iter(_addresses(text))
    address, m, begin = next(addresses, None), pattern.search(text), 0
    while True:
        # The first value from ``begin`` on; of those that begin together the address.
        while address:
            first = max(address[0], begin)
            first += text[first : first + 1] == "."
            if first < address[1]:
                break
            address = next(addresses, None)
        if m and m.start() < begin:
            m = pattern.search(text, begin)
        if address and (not m or first <= m.start()):
            kind, start, found = "email", first, text[first : address[2]]
        elif m:
            kind, start, found = m.lastgroup, m.start(), m[0]
        else:
            break
        end, told = _valid(kind, found, start, turn)
        if told is None:
            # Another value may begin within what did not validate.
            begin = start + 1
            continue
        out.append(text[at:start])
        size += start - at
        spans.append((kind, size, len(told), told))
        out.append(told)
        size += len(told)
        at = begin = end
    out.append(text[at:])
    return "".join(out), spans


def restore(text: str, key: str = KEY) -> str:
    """The text before ``replace_all`` with the same key."""
    return replace_all(text, key.encode(), back=True)[0]


def pseudonyms(text: Column, key: str = KEY) -> Column:
    """A struct of the new text and the spans in it. ``key``: at most 64 bytes."""
    secret = key.encode()

    def mapped(texts: pd.Series) -> pd.DataFrame:
        pattern = finder()
        rows = [(None, None) if t is None else replace_all(t, secret, pattern) for t in texts]
        names = ("kind", "start", "length", "pseudonym")
        spans = [None if s is None else [dict(zip(names, x)) for x in s] for _, s in rows]
        return pd.DataFrame({"text": [t for t, _ in rows], "spans": spans})

    found = F.pandas_udf(mapped, f"text string, spans {SPAN}")(F.when(text.rlike("[0-9@]"), text))
    return let(
        found,
        lambda x: F.struct(
            F.coalesce(x["text"], text).alias("text"), F.coalesce(x["spans"], F.array().cast(SPAN)).alias("spans")
        ),
    )


def mask(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; the same columns in the same order."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), pseudonyms(F.col("text"), key).alias("_told"))
    return packed.select(*[(F.col("_told.text") if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns])


def pii(docs: DataFrame, key: str = KEY) -> DataFrame:
    """Per document: doc_id, the new text, how many values it holds, their kinds (distinct, sorted) and spans."""
    told = docs.select("doc_id", pseudonyms(F.col("text"), key).alias("_told"))
    kinds = F.array_join(F.sort_array(F.array_distinct(F.col("_told.spans.kind"))), ",")
    return told.select(
        "doc_id", F.col("_told.text").alias("text"), F.size("_told.spans").cast("bigint").alias("n_values"),
        kinds.alias("kinds"), F.col("_told.spans").alias("spans"),
    )
