"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over each text and stops at anchors: at-signs, digits next to
digits or points, plus signs, schemes and words that announce an identifier. At an anchor a
local parser takes over. It expands to the left and to the right as far as the characters of
its kind go and then validates what it has: labels of a domain, parts of an address, check
digits, number of digits. Parsers never search; what lies between anchors is read once, by the
automaton alone.

Base kinds: ``email``, ``ip`` (four parts of at most 255), ``card`` (13 to 19 digits with a right
Luhn digit) and ``phone`` (a plus sign and 9 to 15 digits). Matches of a kind do not overlap; one
that fails its check is dropped and read past.

Kinds that cues add: ``spelled`` (an address whose at-sign is written out in brackets), ``login``
(a URL with a user before its host), ``ip6``, ``tel`` (7 to 15 digits behind tel: or a word for
phone), ``iban`` (right check digits), ``ssn`` (9 digits in possible groups) and ``account`` (an
identifier with four digits or more behind a word for account, passport or customer).

Null and empty texts have no spans. Texts are read whole. Spans count code points and are listed
by kind in the order above, then start; spans of different kinds may overlap. Repeated rows are
judged each. Only the columns asked for are carried, so other columns do not matter.
"""

from __future__ import annotations

import ipaddress
import re
import string
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import map_batches, whole

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "spelled", "login", "ip6", "tel", "iban", "ssn", "account")

DIGITS = set(string.digits)
WORD = set(string.ascii_letters + string.digits)
LOCAL = WORD | set("._%+-")
HEX = set(string.hexdigits)
IN_SCHEME = WORD | set("+.-")

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)++")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])++")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]++")
POINT = r" ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?"
SPELLED_DOMAIN = re.compile(rf" ?[A-Za-z0-9-]++(?:{POINT}[A-Za-z0-9-]++)++", re.IGNORECASE)
AUTHORITY = re.compile(r"[^\s/?#<>\"'@]++@[A-Za-z0-9.-]++(?::[0-9]++)?")
HEX_GROUPS = re.compile(r"[0-9A-Fa-f:.]++")
#: Between a cue and what it announces.
GAP = re.compile(r"(?:[ \t]*(?:number|num|no|nr|id|is)\b\.?)?[ \t]*[:=#]{0,2}[ \t]*", re.IGNORECASE)
TEL = re.compile(r"\+?[0-9(](?:[ ().-]{0,2}[0-9])++")
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}+")
SSN = re.compile(r"([0-9]{3})([- ]?)([0-9]{2})\2([0-9]{4})(?![0-9A-Za-z])")
IDENTIFIER = re.compile(r"[A-Za-z0-9](?:-?[A-Za-z0-9]){4,33}+(?![A-Za-z0-9])")

#: Words behind which a parser looks for what they announce.
CUES = {
    "tel": ["tel:", "phone", "mobile", "telephone", "telefon", "teléfono", "téléphone", "fax"],
    "iban": ["iban"],
    "ssn": ["ssn", "social security"],
    "account": [
        "account", "acct", "a/c", "konto", "cuenta", "compte", "passport", "pasaporte", "passeport", "customer id",
        "user id", "license plate",
    ],
}

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2]) % 10 == sum(-(2 * d // 10 + 2 * d % 10) for d in values[1::2]) % 10


def expanded(text: str, at: int, kind: set[str], floor: int) -> int:
    """First place of the characters of a kind that end before ``at``, not below ``floor``."""
    while at > floor and text[at - 1] in kind:
        at -= 1
    return at


def alone(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit stands next to the stretch."""
    return not (start and text[start - 1] in WORD) and not (end < len(text) and text[end] in WORD)


def small(part: str) -> bool:
    """A number of at most 255, however many zeros lead it."""
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


# A parser takes text, first and last place of the anchor, and the end of the last match of its
# kind. It gives the spans that are valid and the place up to which the text is used up.
Parsed = tuple[list[Span], int]


def email(text: str, first: int, last: int, floor: int) -> Parsed:
    start = expanded(text, first, LOCAL, floor)
    domain = DOMAIN.match(text, first + 1) if start < first else None
    return ([(start, domain.end())], domain.end()) if domain else ([], floor)


def ip(text: str, first: int, last: int, floor: int) -> Parsed:
    chain = DOTTED.match(text, expanded(text, first, DIGITS, floor))
    parts, spans, at = chain[0].split("."), [], chain.start()
    for four in zip(*(parts[i::4] for i in range(4))):
        end = at + len(".".join(four))
        if all(map(small, four)):
            spans.append((at, end))
        at = end + 1
    return spans, chain.end()


def card(text: str, first: int, last: int, floor: int) -> Parsed:
    chain = NUMBER.match(text, first)
    digits = chain[0].replace(" ", "").replace("-", "")
    return [chain.span()] if 13 <= len(digits) <= 19 and luhn(digits) else [], chain.end()


def phone(text: str, first: int, last: int, floor: int) -> Parsed:
    run = DIALLED.match(text, first)
    dialled = run[0].rstrip(" ().-") if run else ""
    if len(dialled) < 4:  # one more character stands between the first and the last digit
        return [], floor
    end = first + len(dialled)
    return [(first, end)] if 9 <= sum(c in DIGITS for c in dialled) <= 15 else [], end


def spelled(text: str, first: int, last: int, floor: int) -> Parsed:
    local_end = first - (first > floor and text[first - 1] == " ")
    start = expanded(text, local_end, LOCAL, floor)
    domain = SPELLED_DOMAIN.match(text, last + 1) if start < local_end else None
    return ([(start, domain.end())], domain.end()) if domain else ([], floor)


def login(text: str, first: int, last: int, floor: int) -> Parsed:
    start = expanded(text, first, IN_SCHEME, floor)
    authority = AUTHORITY.match(text, last + 1) if start < first else None
    return ([(start, authority.end())], authority.end()) if authority else ([], floor)


def ip6(text: str, first: int, last: int, floor: int) -> Parsed:
    start = expanded(text, first, HEX | {":", "."}, floor)
    end = HEX_GROUPS.match(text, start).end()
    used, address = end, text[start:end].rstrip(".")
    if address.endswith(":") and not address.endswith("::"):
        address = address[:-1]
    end = start + len(address)
    if len(address) < 46 and len(address) > 2 and address.count(":") > 1 and alone(text, start, end):
        try:
            ipaddress.IPv6Address(address)
        except ValueError:
            return [], used
        return [(start, end)], used
    return [], used


def behind(text: str, first: int, last: int, form: re.Pattern) -> re.Match | None:
    """What stands behind a cue that is a word of its own."""
    if first and text[first - 1] in WORD or text[last] in WORD and last + 1 < len(text) and text[last + 1] in WORD:
        return None
    return form.match(text, GAP.match(text, last + 1).end())


def tel(text: str, first: int, last: int, floor: int) -> Parsed:
    found = behind(text, first, last, TEL)
    valid = found and 7 <= sum(c in DIGITS for c in found[0]) <= 15 and alone(text, *found.span())
    return ([found.span()], found.end()) if valid else ([], floor)


def iban(text: str, first: int, last: int, floor: int) -> Parsed:
    found = behind(text, first, last, IBAN)
    if not found:
        return [], floor
    # Words may follow behind a space: the longest stretch with right check digits counts.
    for end in range(found.end(), found.start() + 14, -1):
        if text[end - 1] == " " or not alone(text, found.start(), end):
            continue
        code = text[found.start() : end].replace(" ", "").upper()
        if len(code) >= 15 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return [(found.start(), end)], end
    return [], floor


def ssn(text: str, first: int, last: int, floor: int) -> Parsed:
    found = behind(text, first, last, SSN)
    if not found or found[1] in ("000", "666") or found[1][0] == "9" or found[3] == "00" or found[4] == "0000":
        return [], floor
    return [found.span()], found.end()


def account(text: str, first: int, last: int, floor: int) -> Parsed:
    found = behind(text, first, last, IDENTIFIER)
    valid = found and sum(c in DIGITS for c in found[0]) >= 4
    return ([found.span()], found.end()) if valid else ([], floor)


PARSERS: dict[str, Callable[[str, int, int, int], Parsed]] = {
    "email": email, "ip": ip, "card": card, "phone": phone, "spelled": spelled, "login": login, "ip6": ip6, "tel": tel,
    "iban": iban, "ssn": ssn, "account": account,
}


def anchors() -> Iterator[tuple[str, str]]:
    """Anchor texts, lower-case, and the kinds that they announce."""
    yield "@", "email"
    yield "://", "login"
    yield from ((mark, "spelled") for mark in ("(at)", "[at]", "{at}"))
    yield "::", "ip6"
    for digit in string.digits:
        yield f"+{digit}", "phone"
        for other in string.digits:
            yield f"{digit}.{other}", "ip"
            yield from ((f"{digit}{between}{other}", "card") for between in ("", " ", "-"))
    yield from ((f":{digit}", "ip6") for digit in "0123456789abcdef")
    for kind, cues in CUES.items():
        yield from ((cue, kind) for cue in cues)


@cache
def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for anchor, kind in anchors():
        made.add_word(anchor, (kind, len(anchor)))
    made.make_automaton()
    return made


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of everything found, by kind, then start."""
    # Lower-casing bytes changes ASCII letters alone, so places stay.
    lowered = text.encode().lower().decode()
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    used = dict.fromkeys(KINDS, 0)
    for last, (kind, length) in automaton().iter(lowered):
        first = last - length + 1
        if first >= used[kind]:
            spans, used[kind] = PARSERS[kind](text, first, last, used[kind])
            found[kind] += spans
    return [(kind, *span) for kind in KINDS for span in found[kind]]


SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
])


def masked_text(text: str, spans: Sequence[tuple[str, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of the first."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find(docs: DataFrame, text: str = "text", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The keys and ``spans`` (kind, start, end) of each row."""
    return scanned(docs, text, keys, False)


def mask(docs: DataFrame, text: str = "text", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The keys, ``spans`` and ``masked``, the text with its spans replaced by their kinds."""
    return scanned(docs, text, keys, True)


def scanned(docs: DataFrame, text: str, keys: Sequence[str], masks: bool) -> DataFrame:
    picked = docs.select(*keys, whole(F.col(text).cast("string")).alias("__text"))
    fields = [*picked.schema.fields[:-1], T.StructField("spans", T.ArrayType(SPAN))]
    if masks:
        fields.append(T.StructField("masked", T.StringType()))
    names = [field.name for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts = batch.column(len(keys)).to_pylist()
            spans = [spans_of(value) for value in texts]
            made = [pa.array([[dict(zip(SPAN.names, span)) for span in each] for each in spans], kind)]
            if masks:
                made.append(pa.array([masked_text(*pair) for pair in zip(texts, spans)], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names)

    return map_batches(picked, run, T.StructType(fields))


def listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Numbers of base spans by kind, their hash, and all spans of each row."""
    found = find(docs, text, [key])
    of_kind = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select(
        key, *[of_kind(kind) for kind in BASE_KINDS], F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
