"""Format-preserving pseudonyms of personal data by a keyed Feistel network.

A value that passes its kind's validation is numbered within its format (a card number within
all numbers of its length, a date within two centuries, ...), the number is permuted with a
key, and written back in the same format, valid again. The same value gets the same pseudonym in
every document, different values get different ones, and no value stays what it was.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache, lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.llm.workers import given_back

#: Stands for a secret that a deployment passes instead.
KEY = b"replace this key"
ROUNDS = 8

_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

#: Where a kind may stand. What is found is then validated.
PATTERN = re.compile(
    r"""
    (?P<email> (?<![\w.+%-]) [A-Za-z0-9][A-Za-z0-9._%+-]{0,63} @ (?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+ [A-Za-z]{2,24} (?![A-Za-z0-9-]) )
  | (?P<secret> (?<![A-Za-z0-9]) AKIA[0-9A-Z]{16} (?![A-Za-z0-9])
      | (?P<name> (?i: password | passwd | passphrase | pwd | api[_ -]?key | access[_ -]?key | secret(?:[_ -]?key)? | token ) )
        ["']? [ \t]* (?P<sign> => | := | [:=](?!=) ) [ \t]*
        (?: "(?P<double>[^"\n]{6,})" | '(?P<single>[^'\n]{6,})' | (?P<bare> (?! [.,;:!?)\]}]++(?:\s|\Z) ) (?:
          (?! [&,;]\w+[=:] | (?<![.,;:!?)\]}]) [.,;:!?)\]}]++(?:\s|\Z) | ["'](?!\w) | </?\w ) \S ){6,} ) ) )
  | (?P<iban> (?<![A-Za-z0-9]) [A-Z]{2}[0-9]{2} (?:\ ?[A-Z0-9]{4}){2,7} (?:\ ?[A-Z0-9]{1,3})? (?![A-Za-z0-9]) )
  | (?P<date> (?<![\w./-]) (?: [0-9]{4}-[0-9]{2}-[0-9]{2} | [0-9]{4}/[0-9]{2}/[0-9]{2}
      | [0-9]{2}/[0-9]{2}/[0-9]{4} | [0-9]{2}\.[0-9]{2}\.[0-9]{4} ) (?![\w/-]|\.[0-9]) )
  | (?P<ip> (?<![\w.]) [0-9]{1,3}(?:\.[0-9]{1,3}){3} (?!\w|\.[0-9]) )
  | (?P<ssn> (?<![\w-]) [0-9]{3}-[0-9]{2}-[0-9]{4} (?![\w-]) )
  | (?P<phone> (?<![\w+]) \+1 [ .-]? (?:\([0-9]{3}\)|[0-9]{3}) [ .-]? [0-9]{3} [ .-]? [0-9]{4} (?![0-9])
      | (?<![\w+]) \+[0-9]{1,3} [ .-]? (?:\([0-9]{1,4}\)[ .-]?)? [0-9]{1,4} (?:[ .-]?[0-9]{2,4}){1,5} (?![0-9])
      | (?<![\w(]) \([2-9][0-9]{2}\)[ ]?[0-9]{3}-[0-9]{4} (?!\w)
      | (?<![\w.-]) [2-9][0-9]{2}[.-][2-9][0-9]{2}[.-][0-9]{4} (?![\w-]|\.[0-9]) )
  | (?P<card> (?<![\w.-]) (?: [0-9]{13,19} | [0-9]{4}(?P<gap>[ -])[0-9]{4}(?:(?P=gap)[0-9]{4}){2}
      | [0-9]{4}[ -][0-9]{6}[ -][0-9]{5} ) (?![\w-]) )
    """,
    re.VERBOSE,
)
#: Characters of an IBAN by country.
# fmt: off
_IBAN_LENGTH = {
    "NO": 15,
    "BE": 16,
    "DK": 18, "FI": 18, "FK": 18, "FO": 18, "GL": 18, "NL": 18,
    "MK": 19, "SI": 19,
    "AT": 20, "BA": 20, "EE": 20, "KZ": 20, "LT": 20, "LU": 20, "MN": 20, "XK": 20,
    "CH": 21, "HR": 21, "LI": 21, "LV": 21,
    "BG": 22, "BH": 22, "CR": 22, "DE": 22, "GB": 22, "GE": 22, "IE": 22, "ME": 22, "RS": 22, "VA": 22,
    "AE": 23, "GI": 23, "IL": 23, "IQ": 23, "OM": 23, "SO": 23, "TL": 23,
    "AD": 24, "CZ": 24, "ES": 24, "MD": 24, "PK": 24, "RO": 24, "SA": 24, "SE": 24, "SK": 24, "TN": 24, "VG": 24,
    "LY": 25, "PT": 25, "ST": 25,
    "IS": 26, "TR": 26,
    "BI": 27, "DJ": 27, "FR": 27, "GR": 27, "IT": 27, "MC": 27, "MR": 27, "SM": 27,
    "AL": 28, "AZ": 28, "BY": 28, "CY": 28, "DO": 28, "GT": 28, "HU": 28, "LB": 28, "NI": 28, "PL": 28, "SV": 28,
    "BR": 29, "EG": 29, "PS": 29, "QA": 29, "UA": 29,
    "JO": 30, "KW": 30, "MU": 30, "YE": 30,
    "MT": 31, "SC": 31,
    "LC": 32,
    "RU": 33,
}
# fmt: on
#: Least and most digits behind a country's calling code, where they are nearly fixed.
_NATIONAL = {
    "7": (10, 10), "20": (9, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9), "34": (9, 9), "36": (8, 9),
    "40": (9, 9), "41": (9, 9), "44": (9, 10), "45": (8, 8), "47": (8, 8), "48": (9, 9), "52": (10, 10), "55": (10, 11), "61": (9, 9),
    "65": (8, 8), "66": (8, 9), "81": (9, 10), "82": (8, 10), "84": (9, 10), "86": (10, 11), "90": (10, 10), "91": (10, 10),
    "92": (9, 10), "351": (9, 9), "380": (9, 9), "420": (9, 9), "421": (9, 9), "852": (8, 8), "971": (8, 9), "972": (8, 9),
}
_WORTH = re.compile(r"[0-9@]|(?i:passw|passphrase|pwd|key|secret|token)")
#: Characters of a secret that are permuted together.
_PIECE = 64


class Permutation:
    """Keyed permutations of ``range(n)`` without fixed points, one for each ``(kind, n)``."""

    def __init__(self, key: bytes):
        self.key = key

    def _f(self, tweak: bytes, round_: int, half: int, modulus: int) -> int:
        half_bytes = half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
        size = min(64, (modulus.bit_length() + 7) // 8 + 8)
        digest = hashlib.blake2b(tweak + bytes([round_]) + half_bytes, key=self.key[:64], digest_size=size).digest()
        return int.from_bytes(digest, "big") % modulus

    def _turn(self, x: int, n: int, tweak: bytes, back: bool) -> int:
        """Feistel over a rectangle that holds ``range(n)``; what falls outside is turned again."""
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            for r in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
                sign = -1 if back else 1
                if r % 2:
                    right = (right + sign * self._f(tweak, r, left, b)) % b
                else:
                    left = (left + sign * self._f(tweak, r, right, a)) % a
            x = left * b + right
            if x < n:
                return x

    def __call__(self, x: int, n: int, kind: str) -> int:
        """A shift by a secret step, seen through the network: it moves every number."""
        if n < 2:
            return x
        tweak = f"{kind}/{n}".encode()
        step = 1 + self._f(tweak, 255, 0, n - 1)
        return self._turn((self._turn(x, n, tweak, False) + step) % n, n, tweak, True)

    def until(self, x: int, n: int, kind: str, valid: Callable[[int], bool]) -> int:
        """The same among the valid numbers only: others are passed over."""
        x = self(x, n, kind)
        while not valid(x):
            x = self(x, n, kind)
        return x


def _refill(shape: str, characters: str) -> str:
    """``shape`` with its letters and digits replaced in turn."""
    fresh = iter(characters)
    return "".join(next(fresh) if c.isalnum() else c for c in shape)


def _plain(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


def _by_class(text: str, kind: str, turn: Permutation) -> str:
    """Letters for letters of the same case and digits for digits; other characters stay."""
    classes = [(48, 10) if c.isdigit() else (97, 26) if c.islower() else (65, 26) for c in text if c.isascii() and c.isalnum()]
    x, n = 0, 1
    for c, (low, radix) in zip((c for c in text if c.isascii() and c.isalnum()), classes, strict=True):
        x, n = x * radix + ord(c) - low, n * radix
    shape = "".join("9" if c.isdigit() else "a" if c.islower() else "A" for c in text if c.isascii() and c.isalnum())
    x = turn(x, n, f"{kind}/{shape}")
    out = []
    for low, radix in reversed(classes):
        x, place = divmod(x, radix)
        out.append(chr(low + place))
    fresh = iter(reversed(out))
    return "".join(next(fresh) if c.isascii() and c.isalnum() else c for c in text)


def _email(text: str, turn: Permutation) -> str | None:
    local, _, domain = text.partition("@")
    return f"{_by_class(local, 'email', turn)}@{domain}"


def _secret(text: str, turn: Permutation) -> str | None:
    if text.startswith("AKIA"):
        x = turn(int(text[4:], 36), 36**16, "access key")
        digits = ""
        for _ in range(16):
            x, place = divmod(x, 36)
            digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"[place] + digits
        return "AKIA" + digits
    if re.fullmatch(r"[0-9a-f]+", text) and len(text) <= 16 * _PIECE:
        return f"{turn(int(text, 16), 16 ** len(text), 'hex'):0{len(text)}x}"
    new = "".join(_by_class(text[i : i + _PIECE], "secret", turn) for i in range(0, len(text), _PIECE))
    return new if new != text else None


def _assigned(found: re.Match) -> str | None:
    """The group of a secret's value; null if it is more likely a word of a sentence or of a program."""
    group = next(g for g in ("double", "single", "bare") if found[g] is not None)
    name, value = found["name"].lower(), found[group]
    if name == "token" and len(value) < 16 and not re.search("[0-9]", value):
        return None
    if name in ("secret", "token") and group == "bare" and found["sign"] == ":" and re.fullmatch("[A-Z]?[a-z]+", value):
        return None
    return group


def _check_digit(payload: str) -> str:
    total = 0
    for place, c in enumerate(reversed(payload)):
        d = int(c)
        total += d if place % 2 else (2 * d - 9 if d > 4 else 2 * d)
    return str(-total % 10)


def _card(text: str, turn: Permutation) -> str | None:
    digits = _plain(text)
    if _check_digit(digits[:-1]) != digits[-1] or digits[0] == "0":
        return None
    inner = len(digits) - 2
    payload = digits[0] + f"{turn(int(digits[1:-1]), 10**inner, 'card'):0{inner}d}"
    return _refill(text, payload + _check_digit(payload))


def _iban_rest(code: str) -> int:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97


def _iban(text: str, turn: Permutation) -> str | None:
    code = _plain(text)
    if not 15 <= len(code) <= 34 or _iban_rest(code) != 1:
        return None
    account = _by_class(code[4:], "iban" + code[:2], turn)
    check = 98 - _iban_rest(code[:2] + "00" + account)
    return _refill(text, f"{code[:2]}{check:02d}{account}")


def _ip(text: str, turn: Permutation) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    x = turn(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _ssn(text: str, turn: Permutation) -> str | None:
    def valid(x: int) -> bool:
        area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    x = int(_plain(text))
    return _refill(text, f"{turn.until(x, 10**9, 'ssn', valid):09d}") if valid(x) else None


def _phone(text: str, turn: Permutation) -> str | None:
    digits = _plain(text)
    keep = len(digits) - 10 if not text.startswith("+") or text.startswith("+1") else 2
    if not 7 <= len(digits) <= 15 or keep < 0 or (text.startswith("+1") and len(digits) != 11):
        return None
    body = digits[keep:]

    def national(x: int) -> bool:  # area and exchange codes begin with 2 to 9
        return len(body) == 10 and x // 10**9 > 1 and x // 10**6 % 10 > 1

    was = national(int(body))
    x = turn.until(int(body), 10 ** len(body), "phone", lambda y: national(y) == was)
    return _refill(text, digits[:keep] + f"{x:0{len(body)}d}")


def _date(text: str, turn: Permutation) -> str | None:
    mark = next(c for c in text if not c.isdigit())
    a, b, c = (int(p) for p in text.split(mark))
    if text[4] == mark:
        orders = [("ymd", (a, b, c))]
    elif mark == ".":
        orders = [("dmy", (c, b, a))]
    else:  # month first, unless that is no month
        orders = [("mdy", (c, a, b)), ("dmy", (c, b, a))]
    for order, parts in orders:
        try:
            x = dt.date(*parts).toordinal()
        except ValueError:
            continue
        if not _FIRST_DAY <= x <= _LAST_DAY:
            continue
        first_of_two = mark == "/" and order == "dmy"

        def valid(y: int, late=first_of_two) -> bool:
            return not late or dt.date.fromordinal(y + _FIRST_DAY).day > 12

        day = dt.date.fromordinal(turn.until(x - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1, "date", valid) + _FIRST_DAY)
        written = {"y": f"{day.year:04d}", "m": f"{day.month:02d}", "d": f"{day.day:02d}"}
        return mark.join(written[o] for o in order)
    return None


_KINDS = {
    "email": _email, "secret": _secret, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card,
}


@cache
def _first_digits(n: int) -> re.Pattern:
    return re.compile(rf"(?:\ ?[A-Z0-9]){{{n}}}(?![A-Z0-9])")


def _digits_end(text: str, n: int) -> int:
    """Where the ``n``-th letter or digit of an IBAN's groups ends; -1 unless a group ends there as well."""
    found = _first_digits(n).match(text)
    return found.end() if found else -1


def _ends(kind: str, text: str) -> Iterator[int]:
    """Where a value that was found may end, the likeliest first: a match may have run into what follows it."""
    if kind not in ("iban", "phone"):
        yield len(text)
        return
    country = _IBAN_LENGTH.get(text[:2]) if kind == "iban" else None
    if country:
        if (end := _digits_end(text, country)) > 0:
            yield end
        yield len(text)
        return
    groups = [m.start() for m in re.finditer(r"(?<=[A-Za-z0-9])[ .-]", text)]
    if kind == "iban":
        yield len(text)
        yield from reversed(groups)
        return
    ends = [len(text), *sorted(groups, key=lambda e: (text[e] == " ", e), reverse=True)]  # at blanks first
    if text.startswith("+") and not text.startswith("+1"):
        code = next((text[1 : 1 + n] for n in (1, 2, 3) if text[1 : 1 + n] in _NATIONAL), None)
        # six digits in one group, nine with the code, are a subscriber's whole number
        block = next((m.end() for m in re.finditer(r"\+[0-9]{9,}|[0-9]{6,}", text) if text[m.end() : m.end() + 1] == " "), None)
        if code:
            low, high = _NATIONAL[code]
            yield from (e for e in ends if low <= len(_plain(text[:e].replace("(0)", ""))) - len(code) <= high)
        elif block:
            yield block
    yield from ends


#: Values that a worker remembers; one is a few hundred bytes.
@lru_cache(maxsize=20_000)
def pseudonym(kind: str, text: str, key: bytes) -> str | None:
    """The pseudonym of one value; null if it isn't a valid value of its kind."""
    return _KINDS[kind](text, Permutation(key))


def replace(text: str, key: bytes) -> tuple[str, int]:
    """A text with its values replaced, and how many there were."""
    if not _WORTH.search(text):
        return text, 0
    out, kept, at, count = [], 0, 0, 0
    while found := PATTERN.search(text, at):
        kind = next(k for k, v in found.groupdict().items() if v is not None and k in _KINDS)
        group = _assigned(found) if found["name"] is not None else kind
        if group is None:
            at = found.start() + 1
            continue
        value, start = found[group], found.start(group)
        for end in _ends(kind, value):
            if (new := pseudonym(kind, value[:end], key)) is not None:
                break
        else:  # another value may begin inside
            at = found.start() + 1
            continue
        out += [text[kept:start], new]
        kept = at = start + end
        count += 1
    return "".join([*out, text[kept:]]), count


def pseudonyms(text: Column | str, key: bytes = KEY) -> Column:
    """Struct of the ``text`` with pseudonyms and their number ``n``; a null text stays null with 0."""

    @F.arrow_udf("struct<text: string, n: long>")
    def replaced(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in given_back(batches):
            found = [replace(t, key) if t else (t, 0) for t in batch.to_pylist()]
            texts, counts = pa.array([t for t, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())
            yield pa.StructArray.from_arrays([texts, counts], ["text", "n"])

    return replaced(F.col(text) if isinstance(text, str) else text)


def pseudonymised(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with the personal values of ``text`` replaced; every row and other column as it was.

    A column ``n_chars``, if there, is counted again. Empty, null and very long texts are no
    special case: a text is searched whole.
    """
    out = docs.withColumn("text", pseudonyms("text", key).getField("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = docs.select("doc_id", pseudonyms("text").alias("found"))
    return found.select("doc_id", "found.text", F.col("found.n").alias("n_replaced"))
