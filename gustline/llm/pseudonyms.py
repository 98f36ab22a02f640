"""Personal data: format-preserving pseudonyms by keyed Feistel permutations.

Values are found by pattern and validated (checksums, calendar, ranges), then permuted within their own format: a card
number gives a card number of the same length with a right check digit, a date a date in the same notation, an address
part a part with as many letters and digits in the same places. The permutation depends on the key and the kind only, so
equal values get equal pseudonyms in every document, and whoever has the key can undo it (``Codec.restore``). Everything
outside a value stays as it is, byte for byte.

A permutation of a domain of n values is a balanced Feistel network over the next even number of bits, walked until it
falls back into the domain. A value never keeps its own form: a fixed point swaps places with the image of its successor.
Null text stays null, empty text stays empty. Repeated rows each get their own, equal result.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Callable
from datetime import date, timedelta
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType

from gustline.llm.arrow import annotate, col

_ROUNDS = 8
_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()


class Feistel:
    """A keyed permutation of 0 .. n-1 without fixed points (n > 1)."""

    def __init__(self, key: bytes, kind: str, n: int):
        self.n = n
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.key = hmac.new(key, f"{kind}/{n}".encode(), hashlib.sha256).digest()
        self.size = (self.half + 7) // 8

    def _round(self, i: int, x: int) -> int:
        # One 64-byte digest covers halves up to 512 bits; wider values take as many as they need.
        out = b""
        block = 0
        while len(out) < self.size:
            out += hashlib.blake2b(x.to_bytes(self.size, "big") + bytes([i, block]), key=self.key).digest()
            block += 1
        return int.from_bytes(out[:self.size], "big") & self.mask

    def _network(self, x: int, forward: bool) -> int:
        a, b = x >> self.half, x & self.mask
        for i in range(_ROUNDS) if forward else reversed(range(_ROUNDS)):
            a, b = (b, a ^ self._round(i, b)) if forward else (b ^ self._round(i, a), a)
        return a << self.half | b

    def _walk(self, x: int, forward: bool) -> int:
        x = self._network(x, forward)
        while x >= self.n:
            x = self._network(x, forward)
        return x

    def apply(self, x: int) -> int:
        # The cycle permutation x -> x + 1 conjugated with the keyed one has no fixed point.
        return self._walk((self._walk(x, True) + 1) % self.n, False) if self.n > 1 else x

    def undo(self, y: int) -> int:
        return self._walk((self._walk(y, True) - 1) % self.n, False) if self.n > 1 else y


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 1


#: Groups of digits that cards are printed in; a card may also be one group.
_PRINTED = {(4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4)}


def _printed(groups: list[tuple[int, int]]) -> list[int]:
    """Where cards end that are printed as one group or in usual ones, from the first group on; nearest first."""
    sizes = [b - a for a, b in groups]
    return [b for i, (_, b) in enumerate(groups) if tuple(sizes[:i + 1]) in _PRINTED or (i == 0 and 13 <= sizes[0] <= 19)]


def _check_digit(body: str) -> str:
    return next(c for c in _DIGITS if luhn(body + c))


def _iban(text: str) -> bool:
    t = re.sub(r"\s", "", text).upper()
    return len(t) >= 15 and int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


#: Length of the IBANs of each country.
_IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 "
    "SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}


def _ipv4(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(int(p) < 256 and (p == "0" or p[0] != "0") for p in parts)


#: Dates run from 1900-01-01 to 2099-12-31; pseudonyms stay in the same range.
_FIRST, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


@lru_cache(maxsize=1 << 14)
def _letters(c: str) -> str:
    """For a letter outside ASCII: the letters of its kind (case) in its block of 64 code points, so that it stays in its script."""
    kind = unicodedata.category(c)
    if c.isascii() or kind not in ("Ll", "Lu", "Lo"):
        return ""
    low = ord(c) & ~63
    return "".join(x for x in map(chr, range(low, low + 64)) if unicodedata.category(x) == kind)


class Codec:
    """Pseudonyms under one key. ``swap`` replaces a validated value by its pseudonym, or gives None if it is not one."""

    def __init__(self, key: bytes):
        self.key = key
        self.keyed = lru_cache(maxsize=4096)(lambda kind, n: Feistel(key, kind, n))

    def _number(self, kind: str, x: int, n: int, forward: bool) -> int:
        f = self.keyed(kind, n)
        return f.apply(x) if forward else f.undo(x)

    def pattern(self, kind: str, text: str, forward: bool, hexadecimal: bool = False) -> str:
        """Letters and digits within their class and place; other characters stay. Leading zeros are digits like others."""
        if hexadecimal:
            alphabets = [_DIGITS + ("ABCDEF" if re.search("[A-F]", text) else "abcdef")] * len(text)
        else:
            alphabets = [_DIGITS if c in _DIGITS else _LOWER if c in _LOWER else _UPPER if c in _UPPER else _letters(c) for c in text]
        x, n = 0, 1
        for c, a in zip(text, alphabets):
            if a:
                x, n = x * len(a) + a.index(c), n * len(a)
        # Equal formats share a permutation: the format is part of the kind.
        shape = "".join(a[-1] if a else "-" + c for c, a in zip(text, alphabets))
        y = self._number(f"{kind}:{shape}", x, n, forward)
        out = []
        for c, a in zip(reversed(text), reversed(alphabets)):
            if a:
                y, r = divmod(y, len(a))
                out.append(a[r])
            else:
                out.append(c)
        return "".join(reversed(out))

    def email(self, m: re.Match, forward: bool) -> str | None:
        name, host = m[0].rsplit("@", 1)
        # The part after the last dot says what kind of host it is and stays.
        body, _, last = host.rpartition(".")
        return self.pattern("mail", f"{name}@{body}", forward) + "." + last

    def card(self, m: re.Match, forward: bool) -> str | None:
        digits = re.sub(r"\D", "", m[0])
        if not _is_card(digits):
            return None
        # No shorter card may begin the pseudonym, as none begins the card; else its end would not be found again.
        ends = [len(re.sub(r"\D", "", m[0][:e])) for e in _printed([g.span() for g in re.finditer(r"\d+", m[0])]) if e < len(m[0])]
        last = digits
        while True:
            body = str(self._number("card", int(last[:-1]), 10 ** (len(digits) - 1), forward)).zfill(len(digits) - 1)
            last = body + _check_digit(body)
            if not any(_is_card(last[:e]) for e in ends):
                break
        new = iter(last)
        return "".join(next(new) if c in _DIGITS else c for c in m[0])

    def ssn(self, m: re.Match, forward: bool) -> str | None:
        a, b, c = (int(m[0][i:j]) for i, j in ((0, 3), (4, 6), (7, 11)))
        areas = [x for x in range(1, 900) if x != 666]
        if a not in areas or not b or not c:
            return None
        x = (areas.index(a) * 99 + b - 1) * 9999 + c - 1
        y = self._number("ssn", x, len(areas) * 99 * 9999, forward)
        y, c = divmod(y, 9999)
        a, b = divmod(y, 99)
        return f"{areas[a]:03d}{m[0][3]}{b + 1:02d}{m[0][6]}{c + 1:04d}"

    def address(self, m: re.Match, forward: bool) -> str | None:
        if not _ipv4(m[0]):
            return None
        x = int.from_bytes(bytes(map(int, m[0].split("."))), "big")
        return ".".join(map(str, self._number("ip", x, 1 << 32, forward).to_bytes(4, "big")))

    def iban(self, m: re.Match, forward: bool) -> str | None:
        if not _iban(m[0]):
            return None
        plain = re.sub(r"\s", "", m[0])
        body = self.pattern("iban", plain[4:], forward)
        rest = int("".join(str(int(c, 36)) for c in (body + plain[:2]).upper()) + "00") % 97
        new = iter(plain[:2] + f"{98 - rest:02d}" + body)
        return "".join(c if c.isspace() else next(new) for c in m[0])

    def phone(self, m: re.Match, forward: bool) -> str | None:
        digits = re.sub(r"\D", "", m[0])
        if not 7 <= len(digits) <= 15:
            return None
        # The digits after a plus sign begin with the country; its first digit stays, so does its being no zero.
        head = 1 if m[0][0] == "+" else 0
        y = str(self._number("phone", int(digits[head:]), 10 ** (len(digits) - head), forward)).zfill(len(digits) - head)
        new = iter(digits[:head] + y)
        return "".join(next(new) if c in _DIGITS else c for c in m[0])

    def day(self, m: re.Match, forward: bool) -> str | None:
        year_first = m["y1"] is not None
        y, mo, d = (m["y1"], m["m1"], m["d1"]) if year_first else (m["y2"], m["m2"], m["d2"])
        swap = False
        try:
            at = date(int(y), int(mo), int(d))
        except ValueError:
            # Month before day.
            try:
                at, swap = date(int(y), int(d), int(mo)), True
            except ValueError:
                return None
        x = (at - _FIRST).days
        if not 0 <= x < _DAYS:
            return None
        ambiguous = not year_first and not swap and int(d) > 12
        kind = "day:" + ("ymd" if year_first else "mdy" if swap else "dmy")
        # Notation is kept readable: dates that show which part is the day are permuted among those that do.
        if ambiguous or swap:
            x, n = self._place(at), _CLEAR_DAYS
            to = _clear(self._number(kind + "!", x, n, forward))
        elif not year_first:
            x, n = self._vague(at), 200 * 144
            to = _vague_day(self._number(kind + "?", x, n, forward))
        else:
            to = _FIRST + timedelta(days=self._number(kind, x, _DAYS, forward))
        parts = (to.year, to.month, to.day) if year_first else (to.month, to.day, to.year) if swap else (to.day, to.month, to.year)
        old = re.findall(r"\d+|\D+", m[0])
        numbers = iter(parts)
        wide = all(len(p) >= 2 for p in old if p.isdigit())
        return "".join(str(next(numbers)).zfill(2 if wide else 1) if p.isdigit() else p for p in old)

    @staticmethod
    def _place(at: date) -> int:
        return _clear_days()[1][at]

    @staticmethod
    def _vague(at: date) -> int:
        return ((at.year - 1900) * 12 + at.month - 1) * 12 + at.day - 1

    def secret(self, m: re.Match, forward: bool) -> str | None:
        return self.pattern("secret", m[0], forward, hexadecimal=bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", m[0])))


@lru_cache(maxsize=1)
def _clear_days() -> tuple[list[date], dict[date, int]]:
    """Dates whose day is over 12."""
    found = [d for d in (_FIRST + timedelta(days=i) for i in range(_DAYS)) if d.day > 12]
    return found, {d: i for i, d in enumerate(found)}


_CLEAR_DAYS = sum(1 for i in range(_DAYS) if (_FIRST + timedelta(days=i)).day > 12)


def _clear(i: int) -> date:
    return _clear_days()[0][i]


def _vague_day(i: int) -> date:
    rest, day = divmod(i, 12)
    year, month = divmod(rest, 12)
    return date(1900 + year, month + 1, day + 1)


#: Kinds in the order they are tried at a place.
KINDS: tuple[tuple[str, str, Callable], ...] = (
    ("email", r"(?u:(?<!\w)[^\W_][\w.%+\-]{0,63})@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]{0,62})\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])", Codec.email),
    ("iban", r"[A-Z]{2}\d{2}(?:\s?[A-Z0-9]{4}){2,7}(?:\s?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", Codec.iban),
    ("secret", r"(?:[0-9a-f]{24,128}|[0-9A-F]{24,128}|(?:sk|pk|ghp|gho|xox[abp]|AKIA)[\-_]?[A-Za-z0-9\-_]{16,128})(?![A-Za-z0-9])", Codec.secret),
    ("ip", r"\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", Codec.address),
    ("date", r"(?:(?P<y1>(?:19|20)\d\d)(?P<s1>[\-/.])(?P<m1>\d\d?)(?P=s1)(?P<d1>\d\d?)|(?P<d2>\d\d?)(?P<s2>[\-/.])(?P<m2>\d\d?)(?P=s2)(?P<y2>(?:19|20)\d\d))(?!\d)", Codec.day),
    ("ssn", r"\d{3}-\d{2}-\d{4}(?![\d\-])", Codec.ssn),
    ("card", r"\d(?:[ \-]?\d){12,18}(?!\d)", Codec.card),
    ("phone", r"(?:(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}|(?:\+\d{1,3}[ .\-]?)?\d{3}[ .\-]\d{3}[ .\-]\d{4}|\+\d{1,3}[ .\-]?\d{2,4}(?:[ .\-]?\d{2,4}){1,4})(?!\d)", Codec.phone),
)
#: A value begins where no letter or digit stands before it. All kinds begin with one of these characters.
_START = r"(?<![A-Za-z0-9_])(?:"
#: Digits and blanks are those of ASCII; digits of other scripts are read as these and written back in their own.
_ANY = re.compile(_START + "|".join(f"(?P<{name}>{pattern})" for name, pattern, _ in KINDS) + ")", re.ASCII)
_EACH = {name: (re.compile(r"(?<![A-Za-z0-9_])" + pattern, re.ASCII), swap) for name, pattern, swap in KINDS}
_OTHER_DIGIT = re.compile(r"(?![0-9])\d")
_MAYBE = re.compile(r"[0-9@]|(?:[0-9a-fA-F]{24})")


_RUN = re.compile(r"\d+(?:[ \-]\d+)*")
#: Characters in which a card and the numbers around it are looked at.
_NEAR = 128


def _card_ends(m: re.Match) -> list[int]:
    """Ends a card may have within a match that may have run into the numbers behind it: after usual groups of digits first,
    so that equal cards are found alike whatever follows; then after any group, the longest first. The latter only if no
    card in usual groups begins behind the first group."""
    run = _RUN.match(m.string, m.start(), m.start() + _NEAR)
    groups = [(g.start() + m.start(), g.end() + m.start()) for g in re.finditer(r"\d+", run[0])]
    usual = _printed(groups)
    for i in range(1, len(groups)):
        if groups[i][0] < m.end() and any(_is_card(re.sub(r"\D", "", m.string[groups[i][0]:e])) for e in _printed(groups[i:])):
            return usual
    return usual + [e for _, e in reversed(groups) if e <= m.end() and e not in usual]


def _iban_ends(m: re.Match) -> list[int]:
    """Ends an IBAN may have within a match that may have run into the words behind it: the length of its country first, then
    the longest first."""
    parts = [(w.end() + m.start(), w.end() - len(re.findall(r"\s", m[0][:w.end()]))) for w in re.finditer(r"\S+", m[0])]
    own = _IBAN_LENGTHS.get(m[0][:2])
    return [e for e, n in parts if n == own] + [e for e, n in reversed(parts) if n != own]


#: Kinds whose values may be shorter than what their pattern matches.
_ENDS = {"card": _card_ends, "iban": _iban_ends}


def _in_script(value: str, original: str) -> str:
    """The value's digits in the script of the original's first digit; the original's other characters where they were."""
    first = _OTHER_DIGIT.search(original)
    digit = re.search(r"\d", original)
    if first is None or digit is None or digit.start() != first.start():
        return value
    zero = ord(first[0]) - unicodedata.decimal(first[0])
    return "".join(chr(zero + int(c)) if c in _DIGITS else c for c in value)


def replace(text: str, codec: Codec, forward: bool = True) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many values of each kind it had. Digits of any script count; a value's are written back
    in the script of its first one."""
    found: dict[str, int] = {}
    original = text
    if not text.isascii() and _OTHER_DIGIT.search(text):
        # A digit is one character in any script, so places stay the same.
        text = _OTHER_DIGIT.sub(lambda m: str(unicodedata.decimal(m[0])), text)
    if not _MAYBE.search(text):
        return original, found
    out, done, at = [], 0, 0
    while m := _ANY.search(text, at):
        new = None
        # Where one kind is not valid, the next may be.
        for name, (pattern, swap) in _EACH.items():
            if hit := pattern.match(text, m.start()):
                for end in _ENDS[name](hit) if name in _ENDS else (hit.end(),):
                    part = hit if end == hit.end() else pattern.match(text, m.start(), end)
                    new = swap(codec, part, forward) if part and part.end() == end else None
                    if new is not None:
                        hit = part
                        break
                if new is not None:
                    if text is not original:
                        new = _in_script(new, original[hit.start():hit.end()])
                    out += [original[done:hit.start()], new]
                    done = at = hit.end()
                    found[name] = found.get(name, 0) + 1
                    break
        if new is None:
            # Not a value: go on behind the digits and letters it began with.
            at = m.start() + max(1, len(re.match(r"[A-Za-z0-9]*", text[m.start():m.start() + 64])[0]))
    return "".join(out) + original[done:], found


def pseudonymize(df: DataFrame, key: bytes, keep=None, text: str = "text", forward: bool = True) -> DataFrame:
    """``keep`` (all columns unless given; the text column always) with the text replaced, and ``pii``: how many values of
    each kind it had. ``forward=False`` restores. Without pii to count, drop the column."""
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() != text.lower()]
    fields = StructType([StructField(text, StringType()), StructField("pii", MapType(StringType(), IntegerType()))])

    def work():
        codec = Codec(key)

        def run(texts: pa.Array) -> list[pa.Array]:
            done = [(None, {}) if t is None else replace(t, codec, forward) for t in texts.to_pylist()]
            return [pa.array([d[0] for d in done], pa.string()),
                    pa.array([list(d[1].items()) for d in done], pa.map_(pa.string(), pa.int32()))]
        return run

    return annotate(df, work, fields, keep, text)


def private(df: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The same rows and columns with pseudonyms in the text."""
    names = [f"k{i}" for i in range(len(df.columns))]
    at = names[df.columns.index(text)]
    done = pseudonymize(df.select(*[col(c).alias(n) for c, n in zip(df.columns, names)]), key, None, at)
    return done.select(*[done[n].alias(c) for c, n in zip(df.columns, names)])
