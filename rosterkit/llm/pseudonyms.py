"""Format-preserving pseudonyms for personal data (operator 8).

Numbers and dates that prove valid - payment cards by their check digit,
IBANs by theirs, IPv4 octets, calendar dates, social security areas - and
phone numbers, mail names and secrets are replaced by a keyed permutation
of all values of the same format: a Feistel network over mixed radices,
walked on until it falls into the format again. A value has the same
pseudonym in every document, however it is spaced, so links survive; two
values never share one; who holds the key can turn it back. Check digits
are computed anew, so results validate like originals. Lengths do not
change: spans hold for old and new text.

Digits that do not validate are left alone. Of a card that runs on into
other digits, or an IBAN into other words, the longest part up to a gap
that validates is taken (an IBAN's length is its country's). Its pseudonym
is walked on until the same part is found again in its place, so that it
can be turned back; only beside such digits can it differ from the same
card's elsewhere. Dates keep whether day and month have one digit and
whether the day is above 12, so that every way to write one day has one
pseudonym. A secret is one word after a key like ``token`` (``api_key``,
``client_secret``), quoted or not, of eight or more characters and, if
unquoted and unless the key's ``=`` touches both, with a digit. Secrets
without a key, passphrases with gaps, two-digit years and phone numbers
written without ``+``, ``00``, brackets or 3-3-4 groups are not found.
Overlapping finds: the one that starts first, then the kind listed first.

Defined results: null stays null, an empty text empty, both without
finds; texts are read whole; repeated rows are treated alike; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import string
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from .common import exact_ids, keep, with_text_ids


class Feistel:
    """A keyed permutation of range(n), for any n, and its inverse."""

    def __init__(self, key: bytes, rounds: int = 10):
        self._key, self._rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _f(self, kind: str, n: int, r: int, x: int) -> int:
        said = f"{kind}|{n}|{r}|{x}".encode()
        size = max(16, n.bit_length() // 8 + 9)
        out = b"".join(hashlib.blake2b(said, key=self._key, salt=bytes([k])).digest() for k in range(-(-size // 64)))
        return int.from_bytes(out[:size], "big")

    def _sides(self, n: int) -> tuple[int, int]:
        a = 1
        while a * a < n:                      # at most the root's bits of steps
            a = a << 1
        return a, -(-n // a)

    def _walk(self, kind: str, n: int, x: int, once: Callable[[str, int, int, int, int], int]) -> int:
        if n < 2:
            return x
        a, b = self._sides(n)
        x = once(kind, n, a, b, x)
        while x >= n:
            x = once(kind, n, a, b, x)
        return x

    def _forth(self, kind: str, n: int, a: int, b: int, x: int) -> int:
        left, right = x % a, x // a           # left < a, right < b
        for r in range(self._rounds):
            if r % 2 == 0:
                left = (left + self._f(kind, n, r, right)) % a
            else:
                right = (right + self._f(kind, n, r, left)) % b
        return right * a + left

    def _back(self, kind: str, n: int, a: int, b: int, x: int) -> int:
        left, right = x % a, x // a
        for r in reversed(range(self._rounds)):
            if r % 2 == 0:
                left = (left - self._f(kind, n, r, right)) % a
            else:
                right = (right - self._f(kind, n, r, left)) % b
        return right * a + left

    def encrypt(self, kind: str, n: int, x: int) -> int:
        return self._walk(kind, n, x, self._forth)

    def decrypt(self, kind: str, n: int, x: int) -> int:
        return self._walk(kind, n, x, self._back)


Permute = Callable[[str, int, int], int]      # (kind, n, x) -> x'


# ------------------------------------------------------------------ formats

def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_digits(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body.upper() + country.upper() + "00")
    return f"{98 - int(number) % 97:02d}"


def _refill(shape: str, chars: str) -> str:
    """``shape`` with its letters and digits replaced in order by ``chars``."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _by_alphabet(text: str, kind: str, permute: Permute, hexadecimal: bool = False) -> str:
    """Every ASCII letter or digit becomes one of its own class, or a
    hexadecimal number one of the same length."""
    if hexadecimal and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
        classes = ["0123456789abcdef" if text == text.lower() else "0123456789ABCDEF"] * len(text)
    else:
        classes = [next((a for a in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if c in a), c) for c in text]
    n = x = 1
    x = 0
    for c, a in zip(text, classes):
        x, n = x * len(a) + a.index(c), n * len(a)
    x, out = permute(f"{kind}:{''.join(str(len(a)) + '.' for a in classes)}", n, x), []
    for a in reversed(classes):
        x, k = divmod(x, len(a))
        out.append(a[k])
    return "".join(reversed(out))


Finds = list[tuple[int, int, str]]            # start, end, replacement


def _settle(text: str, spans: list[tuple[int, int]], scan: Callable[[str], list[tuple[int, int]]],
            swap: Callable[[str], str], back: bool) -> Finds:
    """Each span swapped, again and again until ``scan`` finds the same spans;
    to turn back, in reverse."""
    new = text
    for a, b in reversed(spans) if back else spans:
        while True:
            new = new[:a] + swap(new[a:b]) + new[b:]
            if scan(new) == spans:
                break
    return [(a, b, new[a:b]) for a, b in spans]


def _card_shape(groups: list[int]) -> bool:
    return (len(groups) == 1 or tuple(groups) in ((4, 6, 4), (4, 6, 5), (4, 4, 5), (6, 13))
            or groups[:4] == [4] * 4 and (len(groups) == 4 or len(groups) == 5 and groups[4] <= 3))


_Groups = list[tuple[int, int]]
_CARD_DIGITS = 19                             # and so as many groups at most


def _cards(run: Sequence[str], groups: _Groups, i: int, stop: int) -> list[tuple[int, int]]:
    """Valid cards (first and last group) that a scan from group ``i`` finds
    until it reaches ``stop``: from each group the longest that ends with a
    group; any groups from the run's first on, or those that cards have."""
    out = []
    while i < stop:
        ends, total = [], 0
        for j in range(i, len(groups)):
            total += groups[j][1] - groups[j][0]
            if total > _CARD_DIGITS:
                break
            if total >= 13:
                ends.append(j)
        for j in reversed(ends):
            digits = "".join(c for c in run[groups[i][0]:groups[j][1]] if c.isdigit())
            if ((i == 0 and j == ends[-1] or _card_shape([y - x for x, y in groups[i:j + 1]]))
                    and luhn_digit(digits[:-1]) == digits[-1] and len(set(digits)) > 1):
                out.append((i, j))
                i = j
                break
        i += 1
    return out


def _card(m: re.Match, permute: Permute, back: bool) -> Finds:
    """Each card of the run swapped, again and again until a scan finds the
    same cards; to turn back, in reverse. A card's digits matter to no scan
    step but those of the groups that a card from them could reach it."""
    def swap(shape: str) -> str:
        digits = re.sub(r"\D", "", shape)
        n, abroad = 10 ** (len(digits) - 1), digits.startswith("00")      # as phone numbers do
        while True:
            new = f"{permute('card', n, int(digits[:-1])):0{len(digits) - 1}d}"
            digits = new + luhn_digit(new)
            if len(set(digits)) > 1 and digits.startswith("00") == abroad:
                return _refill(shape, digits)

    run, groups = list(m[0]), [(g.start(), g.end()) for g in re.finditer(r"\d+", m[0])]
    cards = _cards(run, groups, 0, len(groups))
    for k in reversed(range(len(cards))) if back else range(len(cards)):
        first, last = cards[k]
        lo = k
        while lo and cards[lo - 1][1] >= first - _CARD_DIGITS:
            lo -= 1
        start = max(cards[lo - 1][1] + 1 if lo else 0, min(cards[lo][0], first - _CARD_DIGITS))
        a, b = groups[first][0], groups[last][1]
        while True:
            run[a:b] = swap("".join(run[a:b]))
            if _cards(run, groups, start, last + 1) == cards[lo:k + 1]:
                break
    spans = [(groups[i][0], groups[j][1]) for i, j in cards]
    return [(m.start() + a, m.start() + b, "".join(run[a:b])) for a, b in spans]


_IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 "
    "GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 "
    "MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 "
    "TN24 TR26 UA29 VA22 VG24 XK20").split()}


def _ibans(run: str) -> list[tuple[int, int]]:
    """The part of the run that is a valid IBAN: of its country's length, else the longest that ends with a group."""
    ends, code = {}, ""
    for i, c in enumerate(run):
        code += c.strip()
        if c != " " and (i + 1 == len(run) or run[i + 1] == " ") and len(code) >= 12:
            ends[len(code)] = i + 1
    for n in sorted(ends, key=lambda n: (n != _IBAN_LENGTHS.get(run[:2]), -n)):
        if iban_digits(code[:2], code[4:n]) == code[2:4]:
            return [(0, ends[n])]
    return []


def _iban(m: re.Match, permute: Permute, back: bool) -> Finds:
    def swap(shape: str) -> str:
        code = shape.replace(" ", "")
        new = _by_alphabet(code[4:], f"iban-{code[:2]}", permute)
        return _refill(shape, code[:2] + iban_digits(code[:2], new) + new)

    return [(m.start() + a, m.start() + b, new) for a, b, new in _settle(m["run"], _ibans(m["run"]), _ibans, swap, back)]


def _ipv4(m: re.Match, permute: Permute) -> str | None:
    parts = m[0].split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    # Within addresses written with as many digits in each part, so that the length stays.
    low = [0 if len(p) == 1 else 10 ** (len(p) - 1) for p in parts]
    size = [min(256, 10 ** len(p)) - a for p, a in zip(parts, low)]
    x = n = 1
    x = 0
    for p, a, s in zip(parts, low, size):
        x, n = x * s + int(p) - a, n * s
    x, out = permute(f"ip:{size}", n, x), []
    for a, s in zip(reversed(low), reversed(size)):
        x, k = divmod(x, s)
        out.append(str(k + a))
    return ".".join(reversed(out))


def _digits(kind: str) -> Callable[[re.Match, Permute], str | None]:
    def swap(m: re.Match, permute: Permute) -> str:
        fixed = m["code"] or m["trunk"] or ""
        shape = m[0][len(fixed):]
        digits = re.sub(r"\D", "", shape)
        return fixed + _refill(shape, f"{permute(f'{kind}{len(digits)}', 10 ** len(digits), int(digits)):0{len(digits)}d}")
    return swap


def _ssn(m: re.Match, permute: Permute) -> str | None:
    area, group, serial = (int(x) for x in m[0].split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    n = 898 * 99 * 9999
    x = permute("ssn", n, ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1)
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    area += 1
    return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


_FIRST, _LAST = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _date(m: re.Match, permute: Permute) -> str | None:
    sep = m["s1"] or m["s2"]
    parts = m[0].split(sep)
    for names in (("y", "m", "d"),) if m["s1"] else (("d", "m", "y"),) if sep == "." else (("m", "d", "y"), ("d", "m", "y")):
        part = dict(zip(names, map(int, parts)))
        try:
            day = dt.date(part["y"], part["m"], part["d"])
            break
        except ValueError:
            continue
    else:
        return None
    if not _FIRST <= day.toordinal() <= _LAST:
        return None
    like = lambda x: (x.day > 9, x.day > 12, x.month > 9)
    new = day
    while True:
        new = dt.date.fromordinal(_FIRST + permute("date", _LAST - _FIRST + 1, new.toordinal() - _FIRST))
        if like(new) == like(day):
            break
    return sep.join(f"{({'y': new.year, 'm': new.month, 'd': new.day}[k]):0{len(p)}d}" for k, p in zip(names, parts))


def _mail(m: re.Match, permute: Permute) -> str:
    plain = "".join(c for c in m["name"] if c in string.ascii_letters + string.digits)
    it = iter(_by_alphabet(plain, f"mail:{m['host'].lower()}", permute))
    return "".join(next(it) if c in string.ascii_letters + string.digits else c for c in m["name"]) + "@" + m["host"]


def _secret(m: re.Match, permute: Permute) -> str | None:
    value = m["quoted"] or m["bare"]
    at = m.start("quoted" if m["quoted"] else "bare") - m.start()
    digit = bool(m["bare"]) and not re.search(r"[^\s=:]=$", m[0][:at])
    plain = re.sub(r"[^0-9A-Za-z]", "", value)
    if not plain or digit and not re.search("[0-9]", plain):
        return None
    while True:
        plain = _by_alphabet(plain, "secret", permute, True)
        if not digit or re.search("[0-9]", plain):
            break
    it = iter(plain)
    return m[0][:at] + re.sub("[0-9A-Za-z]", lambda _: next(it), value) + m[0][at + len(value):]


_KEYS = r"token|secret|password|passwd|passphrase|pwd|(?:api|access|private|auth)[_-]?key"
#: kind, what a text must contain, pattern, replacement
KINDS: tuple[tuple[str, str, re.Pattern, Callable], ...] = (
    ("secret", "=:", re.compile(rf"(?i)(?:{_KEYS})(?:[_-]?(?:access|secret|private|auth|api|key|token|value|string|base64|[0-9]{{1,3}}))*[\"']?\s*(?P<sign>=>|:=|[=:])\s*"
                                r"(?:(?P<q>[\"'])(?P<quoted>[^\s\"']{8,})(?P=q)|(?P<bare>[^\s\"'`<>,;&(){}\[\]=:][^\s\"'`<>,;&(){}\[\]]{7,}+)(?![(\[]))"), _secret),
    ("mail", "@", re.compile(r"(?<![\w.%+-])(?P<name>[\w.%+-]{1,64})@(?P<host>[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24})", re.ASCII), _mail),
    ("iban", "", re.compile(r"(?<![0-9A-Za-z])(?=(?P<run>[A-Z]{2}\d{2}(?: ?[0-9A-Z]){8,30})(?![0-9A-Za-z]))", re.ASCII), _iban),
    ("phone", "+(-. ", re.compile(r"(?<![\w+])\+(?:\d[ .\-/()]{0,2}){6,14}\d(?!\d)|(?<![\w.+-])(?<!\d[ ])(?P<code>00[1-9])(?:[ .\-/()]{0,2}\d){6,14}(?!\d)"
                                  r"|(?<![\w+])\(\d{2,5}\) ?\d{3,4}[ .-]?\d{3,4}(?![ .-]?\d)"
                                  r"|(?<![\w.+-])(?<!\d[ ])(?P<trunk>1[ .-])?\d{3}(?P<s>[ .-])\d{3}(?P=s)\d{4}(?![\w-]|[ .]\d)", re.ASCII), _digits("phone")),
    ("card", "", re.compile(r"(?<![\w.+-])\d+(?:[ -]\d+)*(?!\w)", re.ASCII), _card),
    ("ssn", "-", re.compile(r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII), _ssn),
    ("date", "-/.", re.compile(r"(?<![\w./-])(?:\d{4}(?P<s1>[-/.])\d{1,2}(?P=s1)\d{1,2}|\d{1,2}(?P<s2>[-/.])\d{1,2}(?P=s2)\d{4})(?!T(?!\d\d:)|[^\WT]|[/-]|\.\d)", re.ASCII), _date),
    ("ip", ".", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", re.ASCII), _ipv4),
)
_ANY = re.compile(rf"[0-9@]|(?i:{_KEYS})")


def pseudonymize_text(text: str, permute: Permute, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its finds replaced, and (kind, start, length) of each."""
    if not _ANY.search(text):
        return text, []
    finds = []
    for order, (kind, needs, pattern, swap) in enumerate(KINDS):
        if needs and not any(c in text for c in needs):
            continue
        for m in pattern.finditer(text):
            if kind in ("iban", "card"):
                finds += [(a, order, b, kind, new) for a, b, new in swap(m, permute, back)]
            elif (new := swap(m, permute)) is not None:
                finds.append((m.start(), order, m.end(), kind, new))
    out, spans, at = [], [], 0
    for start, _, end, kind, new in sorted(finds):
        if start >= at:
            out += [text[at:start], new]
            spans.append((kind, start, end - start))
            at = end
    return "".join([*out, text[at:]]), spans


@dataclass(frozen=True)
class PseudonymParams:
    key: bytes = b"replace this key in production"
    inverse: bool = False         # turn pseudonyms back into values


def pseudonymize(docs: DataFrame, params: PseudonymParams = PseudonymParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, n_finds and finds (kind, start, length); no shuffle."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cipher = Feistel(params.key)
        permute = cipher.decrypt if params.inverse else cipher.encrypt
        for pdf in batches:
            got = [pseudonymize_text(t, permute, params.inverse) if isinstance(t, str) else (None, []) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": exact_ids(pdf["doc_id"]), "text": [g[0] for g in got], "n_finds": [len(g[1]) for g in got],
                                "finds": [[{"kind": k, "start": s, "length": n} for k, s, n in g[1]] for g in got]},
                               columns=["doc_id", "text", "n_finds", "finds"])

    return with_text_ids(keep(docs, doc_id=id_col, text=text_col)).mapInPandas(
        run, "doc_id long, text string, n_finds long, finds array<struct<kind:string,start:int,length:int>>")
