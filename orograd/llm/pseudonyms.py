"""Format-preserving pseudonyms of personal data: keyed Feistel permutations within each format."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
import string
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUNDS = 8
MEMO_ENTRIES = 200_000
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
MONTHS = "January February March April May June July August September October November December".split()
KINDS = ("email", "card", "iban", "ssn", "ip", "date", "phone")

PATTERNS = {
    "email": r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<![\w])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "date": r"(?<![\w/-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}|(?:%s) \d{1,2}, \d{4})(?![\w/-]|\.\d)" % "|".join(MONTHS),
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w+(])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\w)",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w]|-\d)",
}
ANY = re.compile("|".join(f"(?P<{k}>{PATTERNS[k]})" for k in ("email", "iban", "ip", "date", "ssn", "phone", "card")))
ONE = {k: re.compile(p) for k, p in PATTERNS.items()}
CARD = re.compile(r"(?<!\w)\d(?:[ -]?\d){12,18}")          # within a row of digit groups a card may follow or precede a hyphen
ROW = re.compile(r"\d(?:[ -]?\d)*")
CARD_SHAPES = {*((n,) for n in range(13, 20)), (4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4)}
IBAN_LENGTHS = {k: int(n) for n, ks in (w.split(":") for w in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL "
    "24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA "
    "30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split()) for k in ks.split(",")}
RUN = re.compile(r"[0-9@]\S*")
BEFORE = 12            # a month's name and its space may stand before the first digit


def places(text: str):
    """(first, last) of the parts of a text that can hold a value: runs without white space that have a digit or @, joined when near."""
    first = last = -1
    for m in RUN.finditer(text):
        a = m.start()
        while a > max(last, 0) and not text[a - 1].isspace():
            a -= 1
        a = max(a - BEFORE, 0)
        if last >= 0 and a <= last:
            last = m.end()
            continue
        if last >= 0:
            yield first, last
        first, last = a, m.end()
    if last >= 0:
        yield first, last


def matches(text: str):
    """Matches in order; `ANY` looks at the whole text around a place, but searches only there."""
    for first, last in places(text):
        yield from ANY.finditer(text, first, min(last + 1, len(text)))


def _rank(kind: str, text: str) -> int:
    """0 for a value whose layout speaks for it too; 2 for one that only its check sum tells."""
    if kind == "card":
        return 0 if tuple(map(len, re.split("[ -]", text))) in CARD_SHAPES and text[0] in "23456" else 2
    if kind == "iban":
        return 0 if len(text.replace(" ", "")) == IBAN_LENGTHS.get(text[:2]) else 2
    return 1


def _readings(text: str, first: int, last: int) -> list[tuple[int, int, str]]:
    """All valid values that begin in a stretch: of cards, IBANs and phones every length that ends with a word."""
    out = []
    for a in range(first, last):
        if a and (text[a - 1].isalnum() or text[a - 1] == "_") or not (text[a].isalnum() or text[a] in "+("):
            continue
        for kind, pattern in ONE.items():
            m = (CARD if kind == "card" else pattern).match(text, a)
            if not m:
                continue
            ends = [m.end()]
            if kind in ("card", "iban", "phone"):
                ends = [e for e in range(m.end(), a, -1) if text[e - 1].isalnum() and not (e < len(text) and (text[e].isalnum() or text[e] == "_"))]
            for e in ends:
                if e != m.end() and not (CARD if kind == "card" else pattern).fullmatch(text, a, e):
                    continue
                if valid(kind, text[a:e]):
                    out.append((a, e, kind))
    return out


def values(text: str):
    """(start, end, kind) of the valid values in order.

    A match that fails its check, or a card or IBAN of an unusual layout, is read anew: every start within it and
    within its row of digits, every length, every kind. Of readings that overlap the better layout stays, then the longer one.
    """
    for first, last in places(text):
        at, end = first, min(last + 1, len(text))
        while m := ANY.search(text, at, end):
            kind, stop = m.lastgroup, m.end()
            if kind == "card":
                stop = ROW.match(text, m.start()).end()
            if valid(kind, m[0]) and (kind not in ("card", "iban") or _rank(kind, m[0]) == 0 and stop == m.end()):
                yield *m.span(), kind
                at = m.end()
                continue
            chosen: list[tuple[int, int, str]] = []
            taken: set[int] = set()
            for a, b, k in sorted(_readings(text, m.start(), stop), key=lambda r: (_rank(r[2], text[r[0]:r[1]]), r[0] - r[1], r[0])):
                if taken.isdisjoint(range(a, b)):
                    taken.update(range(a, b))
                    chosen.append((a, b, k))
            yield from sorted(chosen)
            at = max([stop, *(b for _, b, _ in chosen)])


def _round(key: bytes, tweak: bytes, k: int, value: int, modulus: int) -> int:
    size = (value.bit_length() + 7) // 8
    d = hashlib.blake2b(bytes([k]) + len(tweak).to_bytes(2, "big") + tweak + value.to_bytes(size, "big"), key=key, digest_size=32)
    return int.from_bytes(d.digest(), "big") % modulus


def permute(key: bytes, tweak: str, value: int, size: int) -> int:
    """Keyed permutation of range(size): an alternating Feistel network over two uneven halves, walked until inside."""
    if size < 2:
        return value
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    t = tweak.encode()
    while True:
        left, right = divmod(value, b)
        for k in range(ROUNDS):
            if k % 2 == 0:
                left = (left + _round(key, t, k, right, a)) % a
            else:
                right = (right + _round(key, t, k, left, b)) % b
        value = left * b + right
        if value < size:
            return value


def unpermute(key: bytes, tweak: str, value: int, size: int) -> int:
    """The inverse of `permute`."""
    if size < 2:
        return value
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    t = tweak.encode()
    while True:
        left, right = divmod(value, b)
        for k in reversed(range(ROUNDS)):
            if k % 2 == 0:
                left = (left - _round(key, t, k, right, a)) % a
            else:
                right = (right - _round(key, t, k, left, b)) % b
        value = left * b + right
        if value < size:
            return value


def luhn(digits: str) -> int:
    """Check sum of a card number, 0 when it is valid."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _refill(text: str, new: str, ours) -> str:
    """`text` with its characters that `ours` accepts exchanged, in order, for those of `new`."""
    it = iter(new)
    return "".join(next(it) if ours(c) else c for c in text)


def _number(key: bytes, tweak: str, digits: str) -> str:
    n = len(digits)
    return str(permute(key, f"{tweak}{n}", int(digits), 10 ** n)).zfill(n)


def _letters(key: bytes, tweak: str, text: str) -> str:
    """Letters and digits each permuted within their alphabet as one number; other signs stay."""
    sizes = [26 if c in string.ascii_letters else 10 if c.isdigit() and c.isascii() else 1 for c in text]
    value = size = 0
    for c, s in zip(text, sizes):
        value, size = value * s + (0 if s == 1 else int(c) if s == 10 else ord(c.lower()) - 97), (size or 1) * s
    shape = "".join("a" if s == 26 else "9" if s == 10 else c for c, s in zip(text, sizes))
    value, out = permute(key, tweak + shape, value, size or 1), []
    for c, s in zip(reversed(text), reversed(sizes)):
        value, d = divmod(value, s)
        new = c if s == 1 else str(d) if s == 10 else chr(97 + d)
        out.append(new.upper() if c.isupper() else new)
    return "".join(reversed(out))


def valid(kind: str, text: str) -> bool:
    """Whether a match is what its kind says: check sums, ranges and calendar."""
    digits = re.sub(r"\D", "", text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) == 0 and len(set(digits)) > 1
    if kind == "iban":
        t = text.replace(" ", "")
        return 15 <= len(t) <= 34 and _mod97(t[4:] + t[:4]) == 1
    if kind == "ip":
        return all(int(p) < 256 and (p == "0" or p[0] != "0") for p in text.split("."))
    if kind == "ssn":
        return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
    if kind == "date":
        return _date(text) is not None
    if kind == "phone":
        return 7 <= len(digits) <= 15
    return True


def _date(text: str) -> tuple[str, dt.date] | None:
    """(layout, date); numbers with slashes are month first unless only day first is a date."""
    layouts = {"-": ("%Y-%m-%d",), "/": ("%m/%d/%Y", "%d/%m/%Y"), ".": ("%d.%m.%Y", "%m.%d.%Y")}
    for layout in next((v for k, v in layouts.items() if k in text), ("%B %d, %Y",)):
        try:
            day = dt.datetime.strptime(text, layout).date()
        except ValueError:
            continue
        if FIRST_DAY <= day.toordinal() <= LAST_DAY:
            return layout, day
    return None


def pseudonym(key: bytes, kind: str, text: str) -> str:
    """The value's stand-in: same kind and format, valid again, equal for equal values, and one to one.

    Values that differ in punctuation alone (spaces in a card number, the layout of a date) stay linked too.
    """
    digits = re.sub(r"\D", "", text)
    if kind == "card":
        body = _number(key, "card", digits[:-1])
        check = -luhn(body + "0") % 10
        return _refill(text, body + str(check), str.isdigit)
    if kind == "iban":
        t = text.replace(" ", "")
        body = _letters(key, "iban" + t[:2], t[4:])
        check = 98 - _mod97(body + t[:2] + "00")
        return _refill(text, t[:2] + f"{check:02d}" + body, lambda c: c != " ")
    if kind == "ip":
        a, b, c, d = map(int, text.split("."))
        n = permute(key, "ip", (a << 24) | (b << 16) | (c << 8) | d, 1 << 32)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "ssn":
        n = int(digits)
        while True:  # walk along the permutation to the next valid number
            n = permute(key, "ssn", n, 10 ** 9)
            new = str(n).zfill(9)
            if valid("ssn", new):
                return _refill(text, new, str.isdigit)
    if kind == "date":
        layout, day = _date(text)
        at = permute(key, "date", day.toordinal() - FIRST_DAY, LAST_DAY - FIRST_DAY + 1)
        new = dt.date.fromordinal(FIRST_DAY + at)
        if layout.startswith("%B"):
            return f"{MONTHS[new.month - 1]} {new.day}, {new.year}"
        return layout.replace("%Y", f"{new.year:04d}").replace("%m", f"{new.month:02d}").replace("%d", f"{new.day:02d}")
    if kind == "phone":
        keep = len(re.match(r"\+(\d{1,3})(?=[ .(-])", text)[1]) if re.match(r"\+\d{1,3}[ .(-]", text) else 0  # the country code
        return _refill(text, digits[:keep] + _number(key, "phone" + digits[:keep], digits[keep:]), str.isdigit)
    name, _, host = text.partition("@")
    return f"{_letters(key, 'name@' + host.lower(), name)}@{_letters(key, 'host', host.rpartition('.')[0])}.{host.rpartition('.')[2]}"


def pseudonymise(docs: DataFrame, key: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add `found` to the documents, all columns kept, and exchange personal data in the text.

    `found` is a map from kind (email, card, iban, ssn, ip, date, phone) to the number of values exchanged.
    An older column `found` gives way. Numbers of which no reading passes its check stay as they are. The key decides all pseudonyms, so a value has
    the same one in every document and every run. A NULL text stays NULL with nothing found.
    """
    def run(texts: pd.Series) -> pd.DataFrame:
        memo: dict[tuple[str, str], str] = {}
        out, found = [], []
        for text in texts:
            counts: dict[str, int] = {}

            parts, at = [], 0
            for start, end, kind in values(text) if isinstance(text, str) else ():
                value = text[start:end]
                new = memo.get((kind, value))
                if new is None:
                    if len(memo) > MEMO_ENTRIES:
                        memo.clear()
                    new = memo[kind, value] = pseudonym(key, kind, value)
                counts[kind] = counts.get(kind, 0) + 1
                parts += text[at:start], new
                at = end
            out.append("".join([*parts, text[at:]]) if parts else text)
            found.append(counts)
        return pd.DataFrame({"text": pd.Series(out, dtype=object), "found": pd.Series(found, dtype=object)})

    swapped = F.pandas_udf(run, "text string, found map<string,int>")(F.col(text_col).cast("string"))
    name = fresh(docs, "swapped")
    made = docs.withColumn(name, swapped)
    return made.select(*[F.col(name)["text"].alias(text_col) if c == text_col else F.col(c) for c in docs.columns if c != "found"],
                       F.col(name)["found"].alias("found"))
