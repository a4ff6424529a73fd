"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

A value found in a text (a card number that passes its check digit, an IBAN that passes mod 97, a
telephone number, a social security number, an IPv4 or IPv6 address, a calendar date, the local part of an
e-mail address, an access key, a password, a long hexadecimal secret) is read as an integer below the size of its format's domain,
permuted there under a secret key, and written back in the same format.  The permutation depends on
the key, the kind and the format only, so equal values get equal pseudonyms in all documents, however
they are spaced, and different values never meet.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
import string
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache, lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame

from tillwork.llm.shared import documents, kind_of, numbered, ready, texts

#: Used where the caller passes no key; a production run passes its own.
DEMO_KEY = "tillwork demonstration key"
ROUNDS = 10

# Month names in English, French, German and Spanish; days from 1900-01-01 to 2099-12-31 are the domain of dates.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
MONTHS_ABROAD = (
    ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"),
    ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"),
    ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"),
)
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2099, 12, 31).toordinal() - FIRST_DAY + 1

#: The country codes of one and of two digits; all others have three.  Told by the digits, not by the spacing.
_COUNTRY = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
# All digits of the longest telephone numbers of some countries; those of others have 15 at most.
LONGEST_PHONE = {"1": 11, "7": 11, "31": 11, "33": 11, "34": 11, "41": 11, "44": 12, "45": 10, "47": 10, "48": 11, "61": 11, "86": 13, "91": 12}

_SHORT_MONTHS = tuple(name[:3] for name in MONTHS)
_MONTH = "(?iu:" + "|".join(sorted({*MONTHS, *_SHORT_MONTHS, *(n for names in MONTHS_ABROAD for n in names)}, key=lambda n: (-len(n), n))) + ")"
#: What may be personal data; the kinds are tried in this order at each place.  International telephone numbers
#: have groups of any size; a single digit after a space ends one only if it would be too short without.  What stands
#: behind the word password or its short forms runs to white space or a quote.
CANDIDATE = re.compile(
    rf"""
    (?P<email>(?<!(?u:[\w.%+-]))(?u:[\w.%+-])++@(?u:[\w-])++(?:\.(?u:[\w-])++)+)
  | (?P<iban>\b[A-Z]{{2}}\d{{2}}(?:[A-Z0-9]{{11,30}}|(?:[ ][A-Z0-9]{{4}}){{2,7}}(?:[ ][A-Z0-9]{{1,3}})?)\b)
  | (?P<phone>\+1[ .-]?\(?\d{{3}}\)?[ .-]?\d{{3}}[ .-]?\d{{4}}(?!\d)
      | \+\d(?:[ .-]?\d){{7,14}}(?<![ ]\d)(?!\d) | \+\d(?:[ .-]?\d){{7,14}}(?!\d)
      | \+\d{{1,3}}[ .-]?\(\d{{1,4}}\)[ .-]?\d(?:[ .-]?\d){{3,10}}(?<![ ]\d)(?!\d)
      | (?<!\d)\(\d{{3}}\)[ ]?\d{{3}}[ .-]\d{{4}}(?!\d) | (?<![\d-])\d{{3}}-\d{{3}}-\d{{4}}(?![\d-])
      | (?<![\d.])\d{{3}}\.\d{{3}}\.\d{{4}}(?!\.?\d) | (?<!\d)(?<!\d[ ])\d{{3}}[ ]\d{{3}}[ ]\d{{4}}(?![ ]?\d))
  | (?P<credential>\bA[KS]IA[A-Z0-9]{{16}}\b | \b(?:gh[oprsu]_[A-Za-z0-9]{{20,}}|[rs]k_(?:live|test)_[A-Za-z0-9]{{8,}})\b
      | (?i:password|passwd|pwd)["']?[ \t]*[:=][ \t]*["']?(?P<value>[^\s"']+))
  | (?P<secret>(?<![0-9A-Za-z])(?:(?=[0-9a-f]*\d)[0-9a-f]{{24,}}+|(?=[0-9A-F]*\d)[0-9A-F]{{24,}}+)(?![0-9A-Za-z]))
  | (?P<card>(?<!\d)(?:\d{{13,19}}|\d{{4}}(?P<gap>[ -])\d{{4}}(?P=gap)\d{{4}}(?P=gap)\d{{4}}(?:(?P=gap)\d{{1,3}})?
      |\d{{4}}[ -]\d{{6}}[ -]\d{{5}})(?!\d))
  | (?P<ssn>(?<![\d-])\d{{3}}-\d{{2}}-\d{{4}}(?![\d-]))
  | (?P<date>(?<!\d)(?:\d{{4}}(?P<a>[-/.])\d{{1,2}}(?P=a)\d{{1,2}}|\d{{1,2}}(?P<b>[-/.])\d{{1,2}}(?P=b)\d{{4}})(?!\d)
      | \b\d{{1,2}}(?:\.|er)?[ ](?:de[ ])?{_MONTH}[ ](?:de[ ])?\d{{4}}(?!\d) | \b{_MONTH}[ ]\d{{1,2}},[ ]\d{{4}}(?!\d))
  | (?P<ip>(?<![\d.])\d{{1,3}}(?:\.\d{{1,3}}){{3}}(?!\.?\d)
      | (?<![\w:.])(?=[0-9A-Fa-f:]*::|(?:[0-9A-Fa-f]{{1,4}}:){{7}})[0-9A-Fa-f:]{{4,39}}+(?![\w:]))
    """,
    re.VERBOSE | re.ASCII,
)
#: Holds wherever CANDIDATE can match: all kinds but credentials and some IPv6 addresses need a digit or an "@".
_ANY = re.compile(r"[0-9@]|(?i:password|passwd|pwd)|A[KS]IA|gh[oprsu]_|k_live_|k_test_|::")

FOUND = pa.struct(
    [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())]
)
RESULT = "doc_id long, text string, n_found int, found array<struct<kind:string,start:int,end:int,pseudonym:string>>"


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """The place of ``value`` in a keyed permutation of 0 .. size - 1.

    A balanced Feistel network permutes the next larger power of four; walking along its cycle until the
    domain is met again makes a permutation of the domain itself.
    """
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask, length = (1 << half) - 1, (half + 7) // 8
    name = hashlib.blake2b(tweak.encode(), digest_size=16).digest()
    while True:
        left, right = value >> half, value & mask
        for number in range(ROUNDS):
            told = name + bytes([number]) + right.to_bytes(length, "big")
            mixed = hashlib.blake2b(told, key=key, digest_size=min(64, length + 8)).digest()
            left, right = right, left ^ (int.from_bytes(mixed, "big") & mask)
        value = left << half | right
        if value < size:
            return value


def permute_valid(value: int, size: int, key: bytes, tweak: str, valid: Callable[[int], bool]) -> int:
    """As ``permute``, walking on until ``valid`` holds: a permutation of the valid values."""
    while True:
        value = permute(value, size, key, tweak)
        if valid(value):
            return value


def luhn_digit(payload: str) -> int:
    """The check digit that a card number of these leading digits has."""
    doubled = (int(c) * (2 - i % 2) for i, c in enumerate(reversed(payload)))
    return -sum(d // 10 + d % 10 for d in doubled) % 10


#: Longer values are permuted in pieces of so many characters.
PIECE = 128


@cache
def _letters() -> dict[str, tuple[str, int]]:
    """The alphabet of each letter beyond ASCII, and its place there.

    An alphabet has the letters of one script: those in lower case that have one capital, or all others.
    """
    alphabets: dict[tuple[str, bool], list[str]] = {}
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        if c.isalpha():
            low, capital = c.lower(), c.upper()
            if low != c and len(low) == 1 and low.upper() == c:
                continue  # stands for its lower case
            cased = low == c != capital and len(capital) == 1 and capital.lower() == c
            alphabets.setdefault((unicodedata.name(c, "").split(" ")[0], cased), []).append(c)
    return {c: (told, i) for told in map("".join, alphabets.values()) for i, c in enumerate(told)}


def _place(c: str) -> tuple[str, int, bool] | None:
    """A character's alphabet, its place there, and whether it is a capital; None for marks, which stay."""
    if c.isascii():
        if c.isdigit():
            return string.digits, int(c), False
        return (string.ascii_lowercase, ord(c.lower()) - 97, c.isupper()) if c.isalpha() else None
    known = _letters().get(c)
    if known is None:
        low = c.lower()
        known = _letters().get(low) if len(low) == 1 and low != c else None
        return (*known, True) if known else None
    return (*known, False)


def _respaced(pattern: str, characters: str) -> str:
    """``characters`` in the places of the letters and digits of ``pattern``."""
    new = iter(characters)
    return "".join(next(new) if _place(c) else c for c in pattern)


def _moving(found: str) -> str:
    """The letters and digits of a value."""
    return "".join(filter(_place, found))


def _mixed(characters: str, key: bytes, tweak: str) -> str:
    """Letters permuted among those of their script and digits among digits, as one number of mixed radix.

    A long value is permuted in pieces, each under what stands before it, so that different values stay different.
    """
    if len(characters) > PIECE:
        parts, before = [], hashlib.blake2b(tweak.encode(), digest_size=16)
        for i in range(0, len(characters), PIECE):
            piece = characters[i : i + PIECE]
            parts.append(_mixed(piece, key, f"{tweak}:{before.hexdigest()}"))
            before.update(piece.lower().encode())
        return "".join(parts)
    told = [_place(c) for c in characters]
    value, size = 0, 1
    for alphabet, at, _ in told:
        value, size = value * len(alphabet) + at, size * len(alphabet)
    kinds = {string.digits: "9", string.ascii_lowercase: "a"}
    shape = "".join(kinds.get(alphabet) or f"<{alphabet[0]}>" for alphabet, *_ in told)
    value = permute(value, size, key, tweak + ":" + shape)
    new = []
    for alphabet, _, capital in reversed(told):
        value, at = divmod(value, len(alphabet))
        new.append(alphabet[at].upper() if capital else alphabet[at])
    return "".join(reversed(new))


def _card(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    if luhn_digit(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    size = 10 ** (len(digits) - 2)
    inner = permute(int(digits[1:-1]), size, key, f"card:{digits[0]}:{len(digits)}")
    payload = digits[0] + str(inner).zfill(len(digits) - 2)
    return _respaced(found, payload + str(luhn_digit(payload)))


def _iban_rest(country: str, account: str) -> int:
    """Remainder by 97 of an IBAN with check digits 00."""
    return int("".join(str(int(c, 36)) for c in account + country + "00")) % 97


def _iban(found: str, key: bytes) -> str | None:
    plain = found.replace(" ", "")
    country, digits, account = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or 98 - _iban_rest(country, account) != int(digits):
        return None
    account = _mixed(account, key, "iban:" + country)
    return _respaced(found, f"{country}{98 - _iban_rest(country, account):02d}{account}")


def _phone_end(found: str) -> int:
    """Where a telephone number ends: a group after a space, behind the longest number of its country, is another one."""
    longest = LONGEST_PHONE.get(_COUNTRY.match(re.sub(r"\D", "", found))[0], 15) if found[0] == "+" else 15
    digits = [i for i, c in enumerate(found) if c.isdigit()]
    return digits[longest - 1] + 1 if len(digits) > longest and found[digits[longest - 1] + 1] == " " else len(found)


def _phone(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 8 <= len(digits) <= 15:
        return None
    kept = _COUNTRY.match(digits)[0] if found[0] == "+" else ""
    rest = len(digits) - len(kept)
    value = permute(int(digits[len(kept) :]), 10**rest, key, f"phone:{kept or '1'}:{rest}")
    return _respaced(found, kept + str(value).zfill(rest))


def _ssn(found: str, key: bytes) -> str | None:
    def valid(n: int) -> bool:
        area, group, serial = n // 10**6, n // 10**4 % 100, n % 10**4
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    number = int(found.replace("-", ""))
    if not valid(number):
        return None
    return _respaced(found, str(permute_valid(number, 10**9, key, "ssn", valid)).zfill(9))


def _ip(found: str, key: bytes) -> str | None:
    if ":" in found:
        return _ipv6(found, key)
    parts = found.split(".")
    if any(str(int(p)) != p or int(p) > 255 for p in parts):
        return None
    number = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, number.to_bytes(4, "big")))


def _ipv6(found: str, key: bytes) -> str | None:
    """However zeros are shortened, an address is one number; the result is short where the input is."""
    try:
        number = int(ipaddress.IPv6Address(found))
    except ValueError:
        return None
    if sum(map(bool, found.split(":"))) < 2 or not re.search(r"\d", found):  # the machine itself, or names of a program
        return None
    number = permute(number, 1 << 128, key, "ipv6")
    groups = [f"{number >> shift & 0xFFFF:x}" for shift in range(112, -1, -16)]
    new = ipaddress.IPv6Address(number).compressed if "::" in found else ":".join(groups)
    return new.upper() if found.upper() == found else new


def _moved_day(year: int, month: int, day: int, key: bytes) -> datetime.date | None:
    try:
        number = datetime.date(year, month, day).toordinal() - FIRST_DAY
    except ValueError:
        return None
    if not 0 <= number < DAYS:
        return None
    return datetime.date.fromordinal(FIRST_DAY + permute(number, DAYS, key, "date"))


def _month(name: str, abroad: int | None) -> tuple[tuple[str, ...], int]:
    """The list of names that has this one, and its place; what is a name in several languages is first looked up in the likelier one."""
    likelier = () if abroad is None else (MONTHS_ABROAD[abroad],)
    for names in (*likelier, MONTHS, _SHORT_MONTHS, *MONTHS_ABROAD):
        folded = [n.lower() for n in names]
        if name.lower() in folded:
            return names, folded.index(name.lower())
    raise ValueError(name)


def _cased(name: str, like: str) -> str:
    return name.upper() if like.isupper() else name.lower() if like.islower() else name.capitalize()


def _date(found: str, key: bytes) -> str | None:
    """Dates in figures keep order and padding; a first field over 12 is a day, a second one too, else day first."""
    wordy = _WORDY.search(found)
    if wordy:
        day, year = re.findall(r"\d+", found)
        abroad = 1 if f"{day}." in found else 2 if " de " in found else None
        names, month = _month(wordy[0], abroad)
        new = _moved_day(int(year), month + 1, int(day), key)
        if new is None:
            return None
        shown = iter((_cased(names[new.month - 1], wordy[0]), str(new.day), f"{new.year}"))
        if found[0].isdigit():
            name, number, last = shown
            shown = iter((number, name, last))
        return re.sub(rf"\d+|{_MONTH}", lambda _: next(shown), found)
    parts = re.split(r"([-/.]+)", found)
    a, b, c = parts[0], parts[2], parts[4]
    order = "ymd" if len(a) == 4 else "mdy" if int(b) > 12 else "dmy"
    fields = dict(zip(order, (a, b, c), strict=True))
    new = _moved_day(int(fields["y"]), int(fields["m"]), int(fields["d"]), key)
    if new is None:
        return None
    width = 2 if len(fields["m"]) == len(fields["d"]) == 2 else 1
    if order != "ymd":  # whoever reads the result must find the same order of day and month
        order = "dmy" if order == "dmy" or new.day <= 12 else "mdy"
    value = {"y": f"{new.year}", "m": f"{new.month:0{width}d}", "d": f"{new.day:0{width}d}"}
    shown = [value[x] for x in order]
    return shown[0] + parts[1] + shown[1] + parts[3] + shown[2]


_WORDY = re.compile(_MONTH)


def _email(found: str, key: bytes) -> str | None:
    local, _, domain = found.rpartition("@")
    characters = _moving(local)
    if not characters:
        return None
    shape = _respaced(local, "x" * len(characters))
    return _respaced(local, _mixed(characters, key, f"email:{shape}@{domain.lower()}")) + "@" + domain


_KEPT = re.compile(r"A[KS]IA(?=[A-Z0-9]{16}\Z)|gh[oprsu]_(?=[A-Za-z0-9]{20})|[rs]k_(?:live|test)_(?=[A-Za-z0-9]{8})")


def _credential(found: str, key: bytes) -> str | None:
    """Access keys keep their leading letters, which name their kind; passwords are permuted whole, but for marks."""
    prefix = _KEPT.match(found)
    kept = prefix[0] if prefix else ""
    rest = found[len(kept) :]
    characters = _moving(rest)
    return kept + _respaced(rest, _mixed(characters, key, "credential:" + kept)) if characters else None


def _secret(found: str, key: bytes) -> str | None:
    parts, before = [], hashlib.blake2b(digest_size=16)
    for i in range(0, len(found), PIECE):
        piece = found[i : i + PIECE]
        tweak = f"secret:{len(piece)}" + (f":{before.hexdigest()}" if i else "")
        parts.append(f"{permute(int(piece, 16), 16 ** len(piece), key, tweak):0{len(piece)}x}")
        before.update(piece.lower().encode())
    new = "".join(parts)
    return new.upper() if found.upper() == found else new


_KINDS: dict[str, Callable[[str, bytes], str | None]] = {
    "email": _email, "iban": _iban, "phone": _phone, "credential": _credential,
    "secret": _secret, "card": _card, "ssn": _ssn, "date": _date, "ip": _ip,
}


@lru_cache(maxsize=50_000)
def pseudonym(kind: str, found: str, key: bytes) -> str | None:
    """The pseudonym of one value, or None if it isn't valid for its kind."""
    return _KINDS[kind](found, key)


def replace(text: str, key: bytes) -> tuple[str, list[dict]]:
    """``text`` with its personal data replaced, and the places in the input."""
    if not _ANY.search(text):
        return text, []
    parts, found, done, at = [], [], 0, 0
    while match := CANDIDATE.search(text, at):
        kind = match.lastgroup if match.lastgroup in _KINDS else next(k for k in _KINDS if match[k])
        start, end = match.span("value") if match["value"] is not None else match.span()
        if kind == "phone":
            end = start + _phone_end(match[0])
        new = pseudonym(kind, text[start:end], key)
        if new is None:  # not valid: other kinds may start a little further on
            inner = re.compile(r"\d+|\w").match(text, match.start())
            at = max(match.start() + 1, inner.end() if inner else 0)
            continue
        parts += [text[done:start], new]
        found.append({"kind": kind, "start": start, "end": end, "pseudonym": new})
        done = at = end
    return "".join([*parts, text[done:]]), found


def _replaced(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [(None, []) if t is None else replace(t, key) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([t for t, _ in pairs], pa.string()),
                pa.array([len(f) for _, f in pairs], pa.int32()),
                pa.array([f for _, f in pairs], pa.list_(FOUND)),
            ],
            ["doc_id", "text", "n_found", "found"],
        )


def pseudonymise(
    docs: DataFrame, *, key: str = DEMO_KEY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, text with pseudonyms, n_found, found (kind, start and end in the input, pseudonym).

    Nothing is shuffled.  A null text stays null with nothing found, an empty one stays empty; repeated rows are treated
    alike; an empty table has no rows; numbers that fail their check and impossible dates stay as they are; the domain of an e-mail
    address and a country code stay; values of any length are replaced whole; other columns are ignored.  Not
    looked for: telephone numbers without a country code other than in three groups of 3, 3 and 4 digits, for nothing
    tells them from other numbers.
    """
    ready(docs.sparkSession)
    secret = key.encode()[:64]
    return documents(docs, id_col, text_col).mapInArrow(partial(_replaced, key=secret), RESULT)


def _replaced_rows(batches: Iterator[pa.RecordBatch], text: int, length: int | None, key: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = batch.columns
        new = [None if t is None else replace(t, key)[0] for t in columns[text].to_pylist()]
        columns[text] = pa.array(new, pa.string())
        if length is not None:
            kept = columns[length].to_pylist()
            sizes = [n if n is None or t is None else len(t) for n, t in zip(kept, new, strict=True)]
            columns[length] = pa.array(sizes, columns[length].type)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def pseudonymise_rows(
    docs: DataFrame, *, key: str = DEMO_KEY, text_col: str = "text", length_col: str | None = "n_chars"
) -> DataFrame:
    """The rows of ``docs`` with all their columns, pseudonyms in the text, and the length column, if there is one, made to fit.

    Null texts and their lengths stay as they are, and so do null lengths; see ``pseudonymise``.
    """
    ready(docs.sparkSession)
    flat, names = numbered(docs), docs.columns
    length = names.index(length_col) if length_col in names else None
    replaced = partial(_replaced_rows, text=names.index(text_col), length=length, key=key.encode()[:64])
    return flat.mapInArrow(replaced, kind_of(flat)).toDF(*names)
