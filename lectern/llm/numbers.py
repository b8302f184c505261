"""Numbers given to persons: which plans allow them, and pseudonyms that stay within the plan.

A scheme knows which numbers it allows and which of their digits are free. A pseudonym
permutes the free digits by a keyed Feistel network, walking on along the cycle until
the plan allows the result, and makes check digits anew, so it validates too and the
key undoes it.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from collections.abc import Callable

def _round(key: bytes, n: int, r: int, value: int, width: int) -> int:
    digest = hmac.new(key, f"{n}.{r}.{width}.{value}".encode(), hashlib.sha256).digest()
    return int.from_bytes(digest[:16], "big")


def feistel(digits: str, key: bytes, rounds: int = 10, undo: bool = False) -> str:
    """A keyed permutation of the decimal strings of one length; ``undo`` inverts it.

    Strings of one digit are permuted by a keyed shift.
    """
    n = len(digits)
    if n < 2:
        shift = _round(key, n, 0, 0, 1) % 10
        return str((int(digits) + (-shift if undo else shift)) % 10) if digits else ""
    u = n // 2
    widths = (u, n - u)
    a, b = int(digits[:u]), int(digits[u:])
    # round r changes the left part if r is even, else the right one
    for r in range(rounds - 1, -1, -1) if undo else range(rounds):
        sign = -1 if undo else 1
        if r % 2 == 0:
            a = (a + sign * _round(key, n, r, b, widths[1])) % 10 ** widths[0]
        else:
            b = (b + sign * _round(key, n, r, a, widths[0])) % 10 ** widths[1]
    return f"{a:0{widths[0]}d}{b:0{widths[1]}d}"


def _with_digits(item: str, digits: str) -> str:
    it = iter(digits)
    return re.sub(r"\d", lambda _: next(it), item)


def pseudonym_number(item: str, key: bytes, keep: int = 0, undo: bool = False) -> str:
    """``item`` with its digits after the first ``keep`` permuted and all else in place."""
    digits = re.sub(r"\D", "", item)
    return _with_digits(item, digits[:keep] + feistel(digits[keep:], key, undo=undo))


def pseudonym_date(item: str, key: bytes, undo: bool = False) -> str | None:
    """A valid date in the same format, None for what is no date or lies outside: its day number is permuted within 1900-01-01 + 2^15 days."""
    m = re.fullmatch(r"(\d+)([./-])(\d+)[./-](\d+)", item)
    if not m:
        return None
    iso = len(m.group(1)) == 4
    y, mo, d = (int(m.group(1)), int(m.group(3)), int(m.group(4))) if iso else (int(m.group(4)), int(m.group(3)), int(m.group(1)))
    start, size = datetime.date(1900, 1, 1), 1 << 15
    try:
        n = (datetime.date(y, mo, d) - start).days
    except ValueError:
        return None
    if not 0 <= n < size:
        return None
    while True:  # cycle walking from five digits into the range
        n = int(feistel(f"{n:05d}", key, undo=undo))
        if n < size:
            break
    new = start + datetime.timedelta(days=n)
    parts = (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}")
    return m.group(2).join(parts if iso else parts[::-1])


# ---------------------------------------------------------------- identity numbers

# Check letters by the remainder of 23, leading letters of foreigners' numbers.
_DNI = "TRWAGMYFPDXBNJZSQVHLCKE"
_NIE = "XYZ"
# Groups of taxpayer numbers that begin with 9.
_ITIN_GROUPS = frozenset([*range(50, 66), *range(70, 89), *range(90, 93), *range(94, 100)])


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def mod_11_10(digits: str) -> int:
    """The check digit after ``digits`` by the hybrid system modulo 11 and 10."""
    p = 10
    for c in digits:
        s = (int(c) + p) % 10 or 10
        p = s * 2 % 11
    return (11 - p) % 10


def _ssn(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def _itin(d: str) -> bool:
    return d[0] == "9" and int(d[3:5]) in _ITIN_GROUPS


def _tax_de(d: str) -> bool:
    return d[0] != "0" and len(set(d[:10])) < 10 and int(d[10]) == mod_11_10(d[:10])


def _any(_: str) -> bool:
    return True


class Scheme:
    """A kind of number: its shape, what of its digits are free, and what those may be."""

    def __init__(self, shape: str, free: Callable[[str], str], allowed: Callable[[str], bool], whole: Callable[[str, str], str]):
        self.shape, self.free, self.allowed, self.whole = re.compile(shape), free, allowed, whole

    def fits(self, item: str) -> bool:
        if not self.shape.fullmatch(item):
            return False
        free = self.free(item)
        return self.allowed(free) and self.whole(item, free) == item

    def pseudonym(self, item: str, key: bytes, undo: bool = False) -> str:
        free = self.free(item)
        while True:
            free = feistel(free, key, undo=undo)
            if self.allowed(free):
                return self.whole(item, free)


def _digits(item: str) -> str:
    return re.sub(r"\D", "", item)


def _dni_letter(item: str, free: str) -> str:
    lead = str(_NIE.index(item[0].upper())) if item[0].isalpha() else ""
    letter = _DNI[int(lead + free) % 23]
    return _with_digits(item, free)[:-1] + (letter if item[-1].isupper() else letter.lower())


#: In the order in which a number is tried.
SCHEMES: dict[str, Scheme] = {
    "social security": Scheme(r"\d{3}[- ]?\d{2}[- ]?\d{4}", _digits, _ssn, _with_digits),
    "taxpayer": Scheme(r"9\d{2}[- ]?\d{2}[- ]?\d{4}", _digits, _itin, _with_digits),
    "national identity with letter": Scheme(r"(?:\d{8}|[XYZxyz]-?\d{7})-?[A-Za-z]", _digits, _any, _dni_letter),
    "social security with key": Scheme(r"[12] ?\d{2} ?\d{2} ?\d{2} ?\d{3} ?\d{3} ?\d{2}", lambda s: _digits(s)[:13], lambda d: d[0] in "12" and 1 <= int(d[3:5]) <= 12, lambda s, d: _with_digits(s, f"{d}{97 - int(d) % 97:02d}")),
    "tax with check digit": Scheme(r"\d{2} ?\d{3} ?\d{3} ?\d{3}", lambda s: _digits(s)[:10], lambda d: _tax_de(d + str(mod_11_10(d))), lambda s, d: _with_digits(s, d + str(mod_11_10(d)))),
    "insurance with check digit": Scheme(r"\d{3}[- ]\d{3}[- ]\d{3}", lambda s: _digits(s)[:8], _any, lambda s, d: _with_digits(s, d + str(luhn(d)))),
    "national insurance": Scheme(r"(?![DFIQUV])(?!BG|GB|KN|NK|NT|TN|ZZ)[A-CEGHJ-PR-TW-Z](?![DFIOQUV])[A-Z] ?\d{2} ?\d{2} ?\d{2} ?[A-D]", _digits, _any, _with_digits),
    "tax by office": Scheme(r"\d{2,3}/\d{3}/\d{4,5}", _digits, _any, _with_digits),
    "passport": Scheme(r"[A-Z]{1,2}\d{6,8}|[A-Z]\d{2}[A-Z]{2}\d{5}", _digits, _any, _with_digits),
}


def scheme(item: str) -> str | None:
    """The first scheme that allows ``item``."""
    return next((k for k, s in SCHEMES.items() if s.fits(item)), None)


def pseudonym_id(item: str, key: bytes, undo: bool = False) -> str | None:
    """A number of the same scheme; None for one that no scheme allows.

    Each scheme's numbers are closed under its permutation, and a number belongs to the
    first scheme that allows it; a result that an earlier one would claim is walked past.
    """
    own = scheme(item)
    if own is None:
        return None
    new = item
    while True:
        new = SCHEMES[own].pseudonym(new, key, undo)
        if scheme(new) == own:
            return new


# ---------------------------------------------------------------- telephone numbers

# Country codes of one and two digits; all others have three.
_ONE, _TWO = ("1", "7"), tuple("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _country(digits: str) -> int:
    """Length of the country code at the start."""
    return 1 if digits.startswith(_ONE) else 2 if digits.startswith(_TWO) else 3


def _parted(item: str) -> tuple[str, str, str]:
    """(kept digits, national digits, extension digits) of a telephone number."""
    m = re.match(r"(.*?)(?:[ ]?(?:x|ext\.?|extension)[ ]?(\d{1,6}))?$", item, re.S)
    body, ext = _digits(m.group(1)), m.group(2) or ""
    if item.startswith("+"):
        n = _country(body)
    elif item.startswith("00"):
        n = 2 + _country(body[2:])
    elif re.match(r"1-\d{3}-", item):
        n = 1
    else:
        n = 1 if body.startswith("0") else 0
    return body[:n], body[n:], ext


def phone_plan(item: str) -> bool:
    """Whether the numbering plan allows the number: a country code that may be, at most 15 digits, none too short."""
    kept, rest, _ = _parted(item)
    foreign = item.startswith(("+", "00"))
    if foreign and (kept[2:] if item.startswith("00") else kept)[:1] in ("", "0"):
        return False
    return (4 if foreign else 6) <= len(rest) and len(kept) + len(rest) <= (17 if item.startswith("00") else 15) and len(set(rest)) > 1


def pseudonym_phone(item: str, key: bytes, undo: bool = False) -> str | None:
    """A number of the same country and format; None for what is no telephone number."""
    kept, rest, ext = _parted(item)
    if not phone_plan(item):
        return None
    new = rest
    while True:
        new = feistel(new, key, undo=undo)
        made = _with_digits(item, kept + new + (feistel(ext, key, undo=undo) if ext else ""))
        if phone_plan(made) and _parted(made)[0] == kept:
            return made
