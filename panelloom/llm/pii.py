"""Personal data in texts, disguised or not, at its place in the text as it stands.

Plain identifiers (email, ip, card, phone) are matched first, on the text itself. Then three transducers rewrite the text, each
carrying along which source characters every character came from:

1. *characters*: digits of any script, full-width and other compatibility forms, and letters, dots, dashes and brackets that look like
   ASCII ones become these; invisible format characters go;
2. *letters for digits*: ``O``, ``I`` and ``l`` among the digits of a number become 0 and 1;
3. *spelled digits*: three or more digit words in a row ("four one five", "double seven" as well), also with numerals, ``dot``, ``dash`` and
   ``plus`` between them, become digits without the spaces;
4. *at and dot*: bracketed, underscored, hyphenated and escaped forms always, an ``@`` between blanks where a host name follows; the bare words
   only in a whole address whose dots are spelled too, so that prose with "at" in it stays as it is.

The same matching runs on what they leave, and its spans go back to source characters through the carried places. Spans that a
plain one of the same kind already covers add nothing; all others are added, and the plain ones always stay.

Matching is linear in the text: each pattern starts only where a run of its first characters starts, which finds the same
leftmost non-overlapping matches as trying every place.

Defined results: NULL text is empty text and has no spans; rows with one id, or none, are rows of their own; an empty table
gives no rows; columns other than id and text are not read, so their names cannot clash. A text is handled by one task, in some
dozens of bytes a character if the transducers change it.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.frames import map_batches

KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like a Latin letter, and the letter.
HOMOGLYPHS = dict(
    zip(
        "АВЕКМНОРСТУХавеорсухіјѕԁԛԝһΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυχɑɡıƖ",
        "ABEKMHOPCTYXaBeopcyxijsdqwhABEZHIKMNOPTYXaiKvoptuxagiI",
        strict=True,
    )
)
# Signs that look like a dot, a dash or a bracket.
SIGNS = {**dict.fromkeys("。｡·•∙⋅", "."), **dict.fromkeys("‐‑‒–—―−", "-"), **dict(zip("【】〔〕", "[][]", strict=True))}
# The digits in English, German, French and Spanish, from zero on.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
# Words for "@", for ".", for "+", for "-" and for repeated digits; letters that stand for digits.
AT_WORDS = ("at", "ät", "arroba", "arobase", "klammeraffe")
DOT_WORDS = ("dot", "punkt", "punto", "point")
PLUS_WORDS = ("plus", "más")
DASH_WORDS = ("dash", "hyphen")
TIMES = {"double": 2, "triple": 3}
LETTER_DIGITS = {"O": "0", "o": "0", "I": "1", "l": "1"}

DIGITS = {word: str(d) for line in DIGIT_WORDS for d, word in enumerate(line.split())} | {"oh": "0"}
MIN_DIGIT_WORDS = 3


class Span(NamedTuple):
    """``text[start:end]`` in code points; ``plain`` if it stands there undisguised."""

    kind: str
    start: int
    end: int
    plain: bool


_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` finds, looking back from each ``@``."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1, start):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        # The class of the name has no "@", so the next match may start right behind this one.
        free = found.end() if found else at + 1
        if found:
            yield start, found.end()
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """Identifiers as they stand in ``text``, by kind."""
    found = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    found.append(("phone", *m.span()))
    return found


class Traced:
    """A rewritten text; character ``i`` came from source characters ``starts[i]`` to ``ends[i]`` (exclusive)."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, None, None

    @property
    def changed(self) -> bool:
        return self.starts is not None

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the given stretches, which ascend and do not overlap."""
        if not edits:
            return
        if self.starts is None:
            self.starts = np.arange(len(self.text), dtype=np.int64)
            self.ends = self.starts + 1
        texts, starts, ends, done = [], [], [], 0
        for a, b, new in edits:
            texts += [self.text[done:a], new]
            starts += [self.starts[done:a], np.full(len(new), self.starts[a])]
            ends += [self.ends[done:a], np.full(len(new), self.ends[b - 1])]
            done = b
        texts.append(self.text[done:])
        self.text = "".join(texts)
        self.starts = np.concatenate([*starts, self.starts[done:]])
        self.ends = np.concatenate([*ends, self.ends[done:]])

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


@cache
def plain_character(c: str) -> str:
    """The ASCII character that ``c`` stands for, nothing for an invisible one, or ``c`` itself."""
    if c in HOMOGLYPHS or c in SIGNS:
        return HOMOGLYPHS.get(c) or SIGNS[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    if unicodedata.category(c) == "Cf":
        return ""
    form = unicodedata.normalize("NFKC", c)
    return form if len(form) == 1 and form.isascii() else c


def normalise_characters(t: Traced) -> None:
    if t.text.isascii():
        return
    odd = "".join(c for c in set(t.text) if not c.isascii() and plain_character(c) != c)
    if odd:
        t.rewrite([(*m.span(), plain_character(m.group())) for m in re.finditer(f"[{re.escape(odd)}]", t.text)])


_CHUNK = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl]++(?![A-Za-z0-9])")


def letters_for_digits(t: Traced) -> None:
    """In chunks that hold a digit and letters that look like one: each such letter is a digit."""
    edits = []
    for m in _CHUNK.finditer(t.text):
        chunk = m.group()
        if not chunk.isdigit() and any(c.isdigit() for c in chunk):
            edits += [(m.start() + i, m.start() + i + 1, LETTER_DIGITS[c]) for i, c in enumerate(chunk) if c in LETTER_DIGITS]
    t.rewrite(edits)


def _any(words: Iterable[str]) -> str:
    return "|".join(sorted(words, key=len, reverse=True))


_ONE, _FILL = _any({*DIGITS, *TIMES}), _any({*DOT_WORDS, *DASH_WORDS})
_DIGIT_WORDS = {*DIGITS, *TIMES}
_GAP = r"(?:[ \t]*,[ \t]*|[ \t]+|-)"
_PART = rf"(?:(?:{_ONE}|{_FILL})(?!\w)|[0-9]++(?!\w))"
_SPELLED = re.compile(rf"(?i)(?<!\w)(?:(?:{_any(PLUS_WORDS)}){_GAP})?{_PART}(?:{_GAP}{_PART}){{2,}}")
_WORD = re.compile(r"[^\W\d_]+|[0-9]+")


def spelled_digits(t: Traced) -> None:
    """Each word of a run becomes its digit; the gaps between them go with the word before."""
    # A run has a digit word with gaps on both sides.
    if _DIGIT_WORDS.isdisjoint(t.text.lower().replace("-", " ").replace(",", " ").split()):
        return
    edits = []
    for m in _SPELLED.finditer(t.text):
        words = [(w.group().lower(), *w.span()) for w in _WORD.finditer(t.text, *m.span())]
        # What begins or ends in no digit is prose.
        while words and not (words[-1][0] in DIGITS or words[-1][0].isdigit()):
            words.pop()
        while words and words[0][0] in (*DOT_WORDS, *DASH_WORDS):
            del words[0]
        if sum(w in DIGITS for w, _, _ in words) < MIN_DIGIT_WORDS:
            continue
        times = 1
        for i, (word, a, b) in enumerate(words):
            if i:
                edits.append((words[i - 1][2], a, ""))
            digit = "+" if word in PLUS_WORDS else "." if word in DOT_WORDS else "" if word in DASH_WORDS or word in TIMES else DIGITS.get(word, word) * times
            edits.append((a, b, digit))
            times = TIMES.get(word, 1)
    t.rewrite(edits)


_OPEN, _CLOSE = r"[ \t]*[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
_AT, _DOT = "|".join(AT_WORDS), "|".join(DOT_WORDS)
_HOST = r"[A-Za-z0-9-]+\.[A-Za-z0-9]"
_SURE_AT = (
    rf"{_OPEN}(?:{_AT}|@){_CLOSE}|[(\[]a[)\]]|&#0*64;|&#x0*40;|&commat;|%40|[ \t]*[_*-](?:{_AT})[_*-][ \t]*|[ \t]+@[ \t]*(?={_HOST})|@[ \t]+(?={_HOST})"
)
_SURE_DOT = rf"{_OPEN}(?:{_DOT}|\.){_CLOSE}|&#0*46;|&#x0*2e;|&period;|%2e|[ \t]*[_*-](?:{_DOT})[_*-][ \t]*"
_SURE = re.compile(rf"(?i)(?<=[A-Za-z0-9.%+_-])(?:(?P<at>{_SURE_AT})|(?P<dot>{_SURE_DOT}))(?=[A-Za-z0-9])")
_SURE_SIGNS = re.compile(rf"[\[({{<][ \t]*(?:{_AT}|{_DOT}|[@.])|[(\[]a[)\]]|[_*-](?:{_AT}|{_DOT})[_*-]|&[#cp]|%[42]|[ \t]@|@[ \t]")
# A host name has 127 labels at most, so a chain of spelled dots ends there.
_BARE = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:[ \t]+(?:{_DOT})[ \t]+[A-Za-z0-9_%+-]++){{0,126}}"
    rf"(?:[ \t]+(?:{_AT})[ \t]+|[ \t]*@[ \t]*)[A-Za-z0-9-]++(?:[ \t]+(?:{_DOT})[ \t]+[A-Za-z0-9-]++){{1,126}}"
)
_BARE_WORDS = re.compile(rf"(?i)[ \t]+(?:(?P<dot>{_DOT})|{_AT})[ \t]+|[ \t]*@[ \t]*")


def spelled_signs(t: Traced) -> None:
    if _SURE_SIGNS.search(t.text.lower()):
        t.rewrite([(*m.span(), "@" if m["at"] else ".") for m in _SURE.finditer(t.text)])
    low = t.text.lower()
    if any(word in low for word in DOT_WORDS) and ("@" in low or any(word in low for word in AT_WORDS)):
        edits = []
        for m in _BARE.finditer(t.text):
            edits += [(*w.span(), "." if w["dot"] else "@") for w in _BARE_WORDS.finditer(t.text, *m.span())]
        t.rewrite(edits)


TRANSDUCERS: tuple[Callable[[Traced], None], ...] = (normalise_characters, letters_for_digits, spelled_digits, spelled_signs)


def find(text: str) -> list[Span]:
    """All spans of a text by start, kind and end."""
    plain = plain_spans(text)
    spans = {(k, a, b): True for k, a, b in plain}
    traced = Traced(text)
    for step in TRANSDUCERS:
        step(traced)
    if traced.changed:
        starts = {kind: [a for k, a, _ in plain if k == kind] for kind in KINDS}
        ends = {kind: [b for k, _, b in plain if k == kind] for kind in KINDS}
        for kind, a, b in plain_spans(traced.text):
            a, b = traced.source(a, b)
            # Plain spans of a kind do not overlap: only the last that starts at or before this one can hold it.
            place = bisect_right(starts[kind], a) - 1
            if place < 0 or ends[kind][place] < b:
                spans.setdefault((kind, a, b), False)
    return sorted((Span(*s, plain) for s, plain in spans.items()), key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id, spans array<struct<kind, start, end, plain>>``."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        spans = [[s._asdict() for s in find(str(t))] if t.is_valid else [] for t in batch.column(1)]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], [id_col, "spans"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, f"`{id_col}` bigint, spans array<struct<kind: string, start: bigint, end: bigint, plain: boolean>>")


def mask(text: str) -> str:
    """The text with each identifier replaced by its kind in brackets; overlapping ones by the kind of the first."""
    out, done = [], 0
    for s in find(text):
        if s.start >= done:
            out += [text[done : s.start], f"[{s.kind}]"]
        done = max(done, s.end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with masked texts; NULL stays NULL, other columns and their order stay."""
    row = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    kind = row.schema["row"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        masked = pa.array([mask(str(t)) if t.is_valid else None for t in batch.column(1)], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), masked], ["row", "masked"])

    done = map_batches(row, run, f"row {kind}, masked string")
    return done.select(*(F.col("masked").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
