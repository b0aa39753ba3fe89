"""Personal data in free text by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, URL schemes, identifier cues, and the
digit pairs, digit groups and plus signs by which numbers begin. From each anchor a small deterministic
parser expands to the boundaries of the candidate and validates it. Parsers look only at the characters
around their anchor, and a kind's next candidate starts after its last one, so a text costs linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import pick

# The kinds in the order in which they are listed, base kinds first.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")
SCHEMES = ("mailto:", "http://", "https://", "ftp://")
CUES = ("iban", "ssn", "social security", "account", "acct")

SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

_DIGITS = frozenset("0123456789")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_QUAD = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?+[0-9])++")
_DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL_REST = re.compile(r"[^\s<>\"'`{}|\\^]+")
_USER_INFO = re.compile(r"[^/?#@]+@[A-Za-z0-9.-]+")
_LABEL = re.compile(r"(?:[ ]{0,3}(?:no\.?|nr\.?|number|num\.?|id))?[ ]{0,3}[:=#][ ]{0,3}", re.I | re.A)
_LOOSE_LABEL = re.compile(r"(?:[ ]{0,3}(?:no\.?|nr\.?|number))?[ ]{0,3}[:=#]?[ ]{0,3}", re.I | re.A)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![0-9])")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _iban_end(text: str, at: int) -> int:
    """End of the longest valid IBAN at ``at``, or -1; a following word may have been taken along."""
    m = _IBAN.match(text, at)
    end = m.end() if m else -1
    while end - at >= 15:
        plain = text[at:end].replace(" ", "")
        if int("".join(c if c in _DIGITS else str(ord(c) - 55) for c in plain[4:] + plain[:4])) % 97 == 1:
            return end
        cut = text.rfind(" ", at, end)
        if cut < 0:
            break
        end = cut
    return -1


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    digits = "0123456789"
    anchors = [("@", "email")]
    anchors += [(f".{d}", "ip") for d in digits]
    anchors += [(f"{a}{s}{b}", "card") for a in digits for b in digits for s in ("", " ", "-")]
    anchors += [(f"+{d}", "phone") for d in digits]
    anchors += [(s, "address") for word in SCHEMES for s in (word, word.upper(), word.capitalize())]
    anchors += [(s, "account") for word in CUES for s in (word, word.upper(), word.capitalize(), word.title())]
    for word, kind in anchors:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


class _Parsers:
    """The boundary parsers of one text; ``free[kind]`` is where that kind's next span may start."""

    def __init__(self, text: str):
        self.text = text
        self.free = dict.fromkeys(KINDS, 0)
        self.spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}

    def _take(self, kind: str, start: int, end: int, valid: bool = True) -> None:
        self.free[kind] = end
        if valid:
            self.spans[kind].append((start, end))

    def _back(self, chars: frozenset[str], at: int, stop: int) -> int:
        while at > stop and self.text[at - 1] in chars:
            at -= 1
        return at

    def email(self, at: int, _: int) -> None:
        start = self._back(_LOCAL, at, min(at, self.free["email"]))
        domain = _DOMAIN.match(self.text, at + 1) if start < at else None
        if domain and start >= self.free["email"]:
            self._take("email", start, domain.end())

    def ip(self, at: int, _: int) -> None:
        start = self._back(_DIGITS, at, min(at, self.free["ip"]))
        quad = _QUAD.match(self.text, start) if start < at else None
        if quad and start >= self.free["ip"]:
            self._take("ip", start, quad.end(), all(map(_octet, quad.groups())))

    def card(self, at: int, _: int) -> None:
        if at >= self.free["card"]:
            chain = _DIGIT_CHAIN.match(self.text, at)
            digits = chain.group().replace(" ", "").replace("-", "") if len(chain.group()) < 40 else ""
            self._take("card", at, chain.end(), 13 <= len(digits) <= 19 and _luhn(digits))

    def phone(self, at: int, _: int) -> None:
        number = _DIALLED.match(self.text, at)
        if number:
            n = sum(c in _DIGITS for c in number.group())
            self._take("phone", at, number.end(), 9 <= n <= 15)

    def address(self, at: int, end: int) -> None:
        """A URL that names a person: mail addresses, and user names before the host."""
        if at < self.free["address"] or (at and self.text[at - 1].isalnum()):
            return
        rest = _URL_REST.match(self.text, end)
        if rest is None:
            return
        if self.text[at:end].lower() == "mailto:":
            name_end = self._forward(_LOCAL, end, rest.end())
            domain = _DOMAIN.match(self.text, name_end + 1) if self.text[name_end:name_end + 1] == "@" else None
            self._take("address", at, domain.end() if domain else rest.end(), name_end > end and domain is not None)
        else:
            self._take("address", at, rest.end(), _USER_INFO.match(self.text, end, rest.end()) is not None)

    def _forward(self, chars: frozenset[str], at: int, stop: int) -> int:
        while at < stop and self.text[at] in chars:
            at += 1
        return at

    def account(self, at: int, end: int) -> None:
        """The account or identity number that a cue word announces."""
        if at < self.free["account"] or (at and self.text[at - 1].isalnum()):
            return
        cue = self.text[at:end].lower()
        label = (_LABEL if cue.startswith("acc") else _LOOSE_LABEL).match(self.text, end)
        if label is None:
            return
        value = label.end()
        if cue == "iban":
            stop = _iban_end(self.text, value)
            if stop > 0:
                self._take("account", value, stop)
        elif cue in ("ssn", "social security"):
            m = _SSN.match(self.text, value)
            if m and m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
                self._take("account", value, m.end())
        else:
            m = _ACCOUNT.match(self.text, value)
            if m:
                self._take("account", value, m.end())


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points, end exclusive."""
    parsers = _Parsers(text)
    run = {k: getattr(parsers, k) for k in KINDS}
    for last, (kind, length) in _automaton().iter(text):
        run[kind](last - length + 1, last + 1)
    return [(k, s, e) for k in KINDS for s, e in parsers.spans[k]]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t)] if t else []
                 for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPAN_TYPE)], names=["id", "spans"])


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) for each row of ``df``, with nothing shuffled.

    A NULL text counts as empty and has no spans; a NULL id stays NULL; repeated rows are answered once
    each; an empty table gives an empty table; columns other than the two named are not read.
    """
    rows = pick(df, id=id_col, text=text_col)
    return rows.mapInArrow(_scan, f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}")


def redact_pii(df: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """All columns of ``df``, with each span of ``kinds`` replaced by [KIND]; a NULL text stays NULL."""
    place = df.columns.index(text_col)

    def blank(text: str | None) -> str | None:
        out, at = [], 0
        for kind, start, end in sorted((s for s in spans_of(text or "") if s[0] in kinds), key=lambda s: (s[1], -s[2])):
            if start >= at:
                out += [text[at:start], f"[{kind.upper()}]"]
                at = end
            else:  # overlaps what is gone already
                at = max(at, end)
        return text if not out else "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([blank(t) for t in batch.column(place).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [new if i == place else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
