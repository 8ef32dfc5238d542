"""Personal data by anchor expansion: an Aho-Corasick automaton finds anchors, small parsers expand each one to its borders and check it.

Anchors are the at-sign (email), the plus sign (phone), digits (ip, card), ``://`` (login: user and password in an address) and
cue words such as ``IBAN`` or ``account number`` (iban, account). A parser goes from its anchor to the left and right as far as its
characters reach, each kind for itself, from left to right and without overlap inside a kind:

* email: the local part runs back to the last other character or the end of the previous address; the domain is all
  labels that follow, two at least.
* ip: four digit groups joined by single dots, from the first digit of a chain; a chain goes on after each four groups.
* card: the whole chain of digits with at most one blank or hyphen between two of them; 12 to 19 digits, Luhn's checksum.
* phone: a plus sign, then digits, blanks, brackets, dots and hyphens up to the last digit; 9 to 15 digits.
* login: the part ``user:password`` before the at-sign of an address's authority.
* iban: after a cue, two letters, two digits and 11 to 30 letters or digits, single blanks between them allowed, checksum 97.
* account: after a cue, an identifier with 5 to 20 digits, single blanks, hyphens or dots between them allowed.

What fails its check is dropped and its characters are not tried again for that kind. Work is linear in the text. Every
document is a row of its own: nothing is shuffled, the automaton is a constant.

Defined cases: null and empty texts have no spans; repeated rows are rows like any other; an empty table gives an empty result;
only the named columns are read, so other columns may have any names. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

#: Kinds in their order, the first four by the base rules.
KINDS = ("email", "ip", "card", "phone", "login", "iban", "account")
BASE = KINDS[:4]

#: Words that announce an account or identity number.
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "passport", "social security", "ssn")

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = _LOCAL - frozenset("_%")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_DIALLED = re.compile(r"[0-9][ ().0-9-]+")
_AUTHORITY = re.compile(r"[^\s/?#\"<>\\]*")
_BETWEEN = re.compile(r"(?:[\s:#.=-]+|(?:number|no|nr|num|is)\b){0,6}", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_IDENTIFIER = re.compile(r"[A-Z]{0,3}[0-9](?:[ .-]?[0-9])*(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    """Whether the last digit is Luhn's check digit of the others."""
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _back(text: str, at: int, least: int, allowed: frozenset) -> int:
    """The first place from which all characters up to ``at`` are allowed ones, not before ``least``."""
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


@cache
def anchors():
    """The automaton; its values name the parser, and the length of a cue."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for pattern, value in (("@", ("email", 0)), ("+", ("phone", 0)), ("://", ("login", 0)), *((d, ("digit", 0)) for d in "0123456789")):
        found.add_word(pattern, value)
    for cue in CUES:
        for form in (cue, cue.upper(), cue.title(), cue.capitalize()):
            found.add_word(form, ("cue", len(cue)))
    found.make_automaton()
    return found


def _email(text: str, at: int, least: int) -> tuple[int, int] | None:
    start = _back(text, at, least, _LOCAL)
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def _phone(text: str, at: int) -> tuple[int, int] | None:
    dialled = _DIALLED.match(text, at + 1)
    if not dialled:
        return None
    end = dialled.end()
    while not "0" <= text[end - 1] <= "9":
        end -= 1
    return (at, end) if end - at >= 4 else None


def _login(text: str, at: int) -> tuple[int, int] | None:
    """``at``: the colon of ``://``."""
    start = _back(text, at, max(0, at - 32), _SCHEME)
    if start == at or not text[start].isalpha():
        return None
    authority = _AUTHORITY.match(text, at + 3)
    user, sign, host = authority[0].rpartition("@")
    name, colon, password = user.partition(":")
    return (at + 3, at + 3 + len(user)) if sign and host and name and colon and password else None


def _numbered(text: str, start: int, end: int) -> tuple[str, int, int] | None:
    """The number announced by the cue at ``start``..``end``."""
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return None
    at = _BETWEEN.match(text, end).end()
    iban = _IBAN.match(text, at)
    if iban:
        stop = iban.end()
        while stop - at >= 15:  # the characters may run on into the next words
            plain = text[at:stop].replace(" ", "")
            if len(plain) >= 15 and (stop == len(text) or not text[stop].isalnum()) and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                return "iban", at, stop
            stop -= 1
    number = _IDENTIFIER.match(text, at)
    return ("account", at, number.end()) if number and 5 <= len(_only_digits(number[0])) <= 20 else None


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all spans, in this order."""
    out: list[tuple[int, int, int]] = []
    done = dict.fromkeys(KINDS, 0)  # where the kind's search goes on

    def add(kind: str, start: int, end: int) -> None:
        out.append((start, KINDS.index(kind), end))

    for last, (what, size) in anchors().iter(text):
        if what == "digit":
            if last >= done["card"]:
                done["card"] = end = _CHAIN.match(text, last).end()
                if end - last >= 12 and 12 <= len(digits := _only_digits(text[last:end])) <= 19 and luhn(digits):
                    add("card", last, end)
            if last >= done["ip"]:
                quad = _QUAD.match(text, last)
                done["ip"] = (quad or _DIGITS.match(text, last)).end()
                if quad and all(len(x := part.lstrip("0")) <= 3 and int(x or 0) <= 255 for part in quad[0].split(".")):
                    add("ip", last, quad.end())
        elif what == "email":
            if last >= done["email"] and (span := _email(text, last, done["email"])):
                done["email"] = span[1]
                add("email", *span)
        elif what == "phone":
            if last >= done["phone"] and (span := _phone(text, last)):
                done["phone"] = span[1]
                if 9 <= len(_only_digits(text[span[0] : span[1]])) <= 15:
                    add("phone", *span)
        elif what == "login":
            if last - 2 >= done["login"] and (span := _login(text, last - 2)):
                done["login"] = span[1]
                add("login", *span)
        elif (span := _numbered(text, last + 1 - size, last + 1)) and span[1] >= done[span[0]]:
            done[span[0]] = span[2]
            add(*span)
    return sorted(out)


def find_personal_data(docs: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """Id columns and spans: an array of kind, start, end by start and kind."""
    thin = docs.select(*id_cols, text_col)
    schema = StructType([*thin.schema.fields[:-1], StructField("spans", _parse_datatype_string(SPANS))])
    k = len(id_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.array(KINDS)
        for batch in batches:
            offsets, start, kind, end = [0], [], [], []
            for value in batch.column(k):
                for a, b, c in find_spans(value.as_py() or ""):
                    start.append(a)
                    kind.append(b)
                    end.append(c)
                offsets.append(len(start))
            parts = [kinds.take(pa.array(kind, pa.int32())), pa.array(start, pa.int64()), pa.array(end, pa.int64())]
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(parts, ["kind", "start", "end"]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], spans], names=[f.name for f in schema])

    return thin.mapInArrow(run, schema)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
