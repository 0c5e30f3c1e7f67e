"""Personal data with offsets in the source text, disguised or plain.

Plain identifiers are found on the text itself. Then transducers rewrite it: homoglyphs and wide
forms become ASCII, zero-width characters go, runs of spelled digits become digits, and at/dot disguises of addresses become
``@`` and ``.``. Each keeps, for every character it writes, the range of the source it stands for. The same
detectors run on the rewritten text, and what they find is mapped back and added unless a plain span of its kind covers it.

Offsets count code points, ends are exclusive. Null counts as the empty text, a null doc_id is a row like others. The time for a
very long text grows with its length, also where it holds very many identifiers.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import freed

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IP_HINT = re.compile(r"[0-9]\.[0-9]")
DIGIT_HINT = re.compile(r"[0-9]")

# Letters of other scripts that look like ASCII ones, each above its twin.
LOOKS = (
    "АВЕЅІЈКМНОРСТУХԌԚԜаеѕіјорсухһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧονιɡⅼ",
    "ABESIJKMHOPCTYXGQWaesijopcyxhdqwABEZHIKMNOPTYXovigl",
)
# Digits as words, 0 to 9.
SPELLED = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "zéro un deux trois quatre cinq six sept huit neuf",
)
FOLD = dict(zip(map(ord, LOOKS[0]), LOOKS[1])) | {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | {0x3000: " ", 0x2010: "-", 0x2011: "-", 0x2024: "."}
DIGITS = {word: str(k) for words in SPELLED for k, word in enumerate(words.split())} | {"oh": "0", "plus": "+"}
FOLD_HINT = re.compile("[" + "".join(re.escape(chr(c)) for c in FOLD) + "]")
UNSEEN = re.compile("[­​‌‍⁠﻿]+")
WORD = "|".join(sorted(DIGITS, key=len, reverse=True))
RUN = re.compile(rf"(?<!\w)(?:{WORD}|\+?[0-9]+|\+)(?:[\x20\-,.()]++(?:{WORD}|[0-9]+))+(?!\w)", re.I)
PIECE = re.compile(rf"({WORD})|[\x20\-,.()]+|[0-9+]+", re.I)
# Blanks between the pieces of a disguise may be any number; possessive runs keep the search linear.
OPEN, CLOSE = r"\s*+[(\[{<]\s*+", r"\s*+[)\]}>]\s*+"
AT = rf"(?:{OPEN}(?:at|@){CLOSE}|\x20++at\x20++|\x20*+@\x20*+)"
DOT = rf"(?:{OPEN}(?:dot|\.){CLOSE}|\x20++dot\x20++|\.)"
ADDRESS = re.compile(rf"(?<![A-Za-z0-9])[A-Za-z0-9_%+-]{{1,64}}(?:{DOT}[A-Za-z0-9_%+-]{{1,64}}){{0,4}}({AT})[A-Za-z0-9-]{{1,63}}((?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,5}})(?![A-Za-z0-9])", re.I)
RUN_HINT = re.compile(rf"(?<!\w)(?:{WORD})(?:[\x20\-,.()]++|{DOT})(?:{WORD}|[0-9])|[0-9](?:[\x20\-,.()]++|{DOT})(?:{WORD})(?!\w)", re.I)
DIGIT = "|".join(w for w in sorted(DIGITS, key=len, reverse=True) if w != "plus")
PART = rf"(?:{DIGIT}|[0-9]{{1,3}})(?:[\x20\-]++(?:{DIGIT}|[0-9]{{1,2}})){{0,2}}"
QUAD = re.compile(rf"(?<!\w){PART}(?:{DOT}{PART}){{3}}(?!\w)", re.I)
QUAD_PIECE = re.compile(rf"({DIGIT})|({DOT})|[\x20\-]+", re.I)
NUMBERS = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:{DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
SIGN = re.compile(rf"({OPEN}(?:at|@){CLOSE}|\x20+at\x20+|\x20+@\x20*|@\x20+)|({OPEN}(?:dot|\.){CLOSE}|\x20+dot\x20+)", re.I)
SIGN_HINT = re.compile(rf"[(\[{{<]\s*+(?:at|dot|@|\.)\s*+[)\]}}>]|\x20dot\x20|\x20@|@\x20", re.I)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain(text: str) -> list[tuple[str, int, int]]:
    """Identifiers of a text by kind, then start: leftmost and non-overlapping in each kind, those that fail a test left out."""
    out = []
    if "@" in text:
        out += [("email", *m.span()) for m in EMAIL.finditer(text)]
    if DIGIT_HINT.search(text):
        if IP_HINT.search(text):
            for m in IP.finditer(text):
                parts = [p.lstrip("0") for p in m[0].split(".")]
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return out


class Tape:
    """A text rewritten, with the source range of each character."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, list(range(len(text))), list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace ranges (ascending, apart). Each new character stands for the whole range it replaces."""
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            starts += self.starts[at:a] + [self.starts[a]] * len(new)
            ends += self.ends[at:a] + [self.ends[b - 1]] * len(new)
            at = b
        self.text = "".join(text) + self.text[at:]
        self.starts, self.ends = starts + self.starts[at:], ends + self.ends[at:]


def _signs(text: str) -> list[tuple[int, int, str]]:
    """At and dot disguises inside whole addresses. A bare word ``at`` counts only before a disguised dot."""
    edits = []
    for m in ADDRESS.finditer(text):
        bare = m[1].strip().lower() == "at"
        top = re.split(r"[^A-Za-z0-9-]+", m[2])[-1]
        named = bare and re.match(r"(the|a|an|this|that)\b", m[0][m.end(1) - m.start() :], re.I)
        if not named and (not bare or re.search(r"dot|[(\[{<]", m[2], re.I)) and top.isalpha() and len(top) > 1:
            edits += [(m.start() + s.start(), m.start() + s.end(), "@" if s[1] else ".") for s in SIGN.finditer(m[0])]
    taken = {p for a, b, _ in edits for p in range(a, b)}
    for m in NUMBERS.finditer(text):
        edits += [(m.start() + s.start(), m.start() + s.end(), ".") for s in SIGN.finditer(m[0]) if s[2] and m.start() + s.start() not in taken]
    return sorted(edits)


def _quads(text: str) -> list[tuple[int, int, list[tuple[int, int, str]]]]:
    """Addresses of four numbers with digits as words: their range and edits."""
    out = []
    for m in QUAD.finditer(text):
        pieces = list(QUAD_PIECE.finditer(m[0]))
        edits = [(m.start() + p.start(), m.start() + p.end(), DIGITS[p[1].lower()] if p[1] else "." if p[2] else "") for p in pieces]
        if any(p[1] for p in pieces):
            parts = QUAD_PIECE.sub(lambda p: DIGITS[p[1].lower()] if p[1] else "." if p[2] else "", m[0]).split(".")
            if all(int(x) <= 255 for x in parts):
                out.append((*m.span(), edits))
    return out


def _digits(text: str) -> list[tuple[int, int, str]]:
    """Runs of two or more pieces with a digit as a word, outside the addresses of ``_quads``."""
    quads = _quads(text)
    edits = [e for *_, own in quads for e in own]
    for begin, end in zip([0, *(b for _, b, _ in quads)], [*(a for a, *_ in quads), len(text)]):
        for m in RUN.finditer(text, begin, end):
            if any(p[1] for p in PIECE.finditer(m[0])):
                signed = False
                for p in PIECE.finditer(m[0]):
                    gap = not p[1] and not p[0].strip(" -,.()")
                    if p[1] or gap:
                        new = DIGITS[p[1].lower()] if p[1] else ("" if signed else " ")
                        edits.append((m.start() + p.start(), m.start() + p.end(), new))
                    signed = not gap and (p[1] or p[0]).lower() in ("plus", "+")
    return sorted(edits)


def disguised(text: str) -> list[tuple[str, int, int]]:
    """Identifiers found only after rewriting, as ranges of the source."""
    folds, unseen, signs = (h.search(text) is not None for h in (FOLD_HINT, UNSEEN, SIGN_HINT))
    if not (folds or unseen or signs or RUN_HINT.search(text)):
        return []
    tape = Tape(text)
    if folds:
        tape.text = text.translate(FOLD)  # one character for one
    if unseen:
        tape.rewrite([(*m.span(), "") for m in UNSEEN.finditer(tape.text)])
    edits = _digits(tape.text) if RUN_HINT.search(tape.text) else []
    out = []
    # Digits as words are also letters of addresses, so the text is read with them as words, too.
    for runs in ([], edits) if edits else ([],):
        read = Tape(tape.text)
        read.starts, read.ends = tape.starts, tape.ends
        read.rewrite(runs)
        read.rewrite(_signs(read.text))
        if read.text != text:
            out += [(kind, read.starts[a], read.ends[b - 1]) for kind, a, b in plain(read.text)]
    # Ranges inside another one of their kind go: sorted by start, longest first, one is inside if an earlier one reaches as far.
    kept, kind, reach = [], None, -1
    for x in sorted(set(out), key=lambda x: (x[0], x[1], -x[2])):
        if x[0] != kind or x[2] > reach:
            kept.append(x)
            kind, reach = x[0], x[2]
    return kept


def spans(text: str) -> tuple[list[tuple], list[tuple]]:
    """Plain spans, and all spans: added ones are those that no plain span of the kind covers."""
    base = plain(text)
    held = {k: [(a, b) for kind, a, b in base if kind == k] for k in KINDS}  # ascending and apart

    def covered(kind: str, start: int, end: int) -> bool:
        at = bisect.bisect_right(held[kind], start, key=lambda x: x[0])
        return at > 0 and end <= held[kind][at - 1][1]

    extra = [x for x in disguised(text) if not covered(*x)]
    every = sorted([*base, *extra], key=lambda x: (KINDS.index(x[0]), x[1], x[2])) if extra else base
    return base, every


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans``: arrays of (kind, start, end), plain ones and all, for each row of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(text or "") for text in batch.column(1).to_pylist()]
            pack = lambda k: pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x[k]] for x in found], _SPANS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pack(0), pack(1)], ["doc_id", "base", "spans"])

    kind = "array<struct<kind: string, start: bigint, end: bigint>>"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(freed(run), f"doc_id bigint, base {kind}, spans {kind}")


def redacted(text: str) -> str:
    """The text with each found range replaced by its kind; ranges that overlap become one, named by the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans(text)[1], key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with identifiers in ``text`` replaced; null stays null and all other columns stay as they are."""
    place, schema = docs.columns.index(text), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            yield batch.set_column(place, text, pa.array([x and redacted(x) for x in column.to_pylist()], column.type))

    return docs.mapInArrow(freed(run), schema)
