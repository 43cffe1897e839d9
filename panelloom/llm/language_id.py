"""Language identification by rank-order profiles of character n-grams.

A text is lower-cased, everything but letters and marks becomes one blank, and the grams of one to three characters
inside blank-padded words are counted. A language's profile is its ``PROFILE`` most frequent grams over *all* training
texts; a text gets the language whose profile has the smallest out-of-place distance to the text's own ranking.

Grams are counted inside each task first; the ranking per language keeps at most ``PROFILE`` rows of each task before
rows of a language meet. The profiles are the only thing sent to all tasks: ``PROFILE`` rows per language, and more
than ``MAX_LANGUAGES`` languages are refused rather than sent.

Defined results: NULL text, empty text and text without a letter give ``und`` with score 0, as does every text if no
language was learned; of two languages at equal distance the one whose name sorts first wins, of two grams equally
frequent the one with the smaller code ranks first; long texts are counted in blocks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.arrays import Texts, texts
from panelloom.llm.frames import bounded_batches, map_batches

PROFILE = 300
MAX_LANGUAGES = 8192
UNKNOWN = "und"
_BLOCK = 1 << 20
_KEPT_GRAMS = 1 << 20
_BLANK = np.uint32(0x20)
_table: tuple[np.ndarray, np.ndarray] | None = None


def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its lower case, a blank for what no word contains; and whether it is a letter."""
    global _table
    if _table is None:
        lower, letter = np.full(0x110000, _BLANK, np.uint32), np.zeros(0x110000, bool)
        for point in range(0x110000):
            kind = unicodedata.category(chr(point))[0]
            if kind in "LM":
                small = chr(point).lower()
                lower[point] = ord(small) if len(small) == 1 else point
                letter[point] = kind == "L"
        _table = lower, letter
    return _table


def _sequences(part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised characters with one blank between words, each row's bounds among them, and which rows have a letter.

    Row ``i`` is ``seq[bounds[i]:bounds[i + 1] + 1]`` and has a blank at both ends.
    """
    lower, letter = _characters()
    points = np.frombuffer(part.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lengths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    rows = np.searchsorted(np.append(0, np.cumsum(lengths)), part.offsets)
    letters = np.append(0, np.cumsum(letter[points]))
    seq = np.insert(lower[points], rows, _BLANK)
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] != _BLANK) | (seq[:-1] != _BLANK)
    place = np.cumsum(keep) - 1  # a dropped blank stands at the blank before it
    return seq[keep], place[rows + np.arange(len(rows))], letters[rows[1:]] > letters[rows[:-1]]


def _grams(seq: np.ndarray) -> np.ndarray:
    """Codes of the grams that start anywhere but in the last two characters, inside words only."""
    a = seq.astype(np.int64)
    one = a[:-2][a[:-2] != _BLANK]
    two = (a[:-2] << 21) | a[1:-1]
    three = ((a[:-2] << 42) | (a[1:-1] << 21) | a[2:])[a[1:-1] != _BLANK]
    return np.concatenate([one, two, three])


def _add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, inverse = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return codes, np.bincount(inverse, np.concatenate([a[1], b[1]])).astype(np.int64)


def gram_counts(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes in ascending order, and how often each occurs; memory is bounded by the block and the distinct grams."""
    padded = np.append(seq, [_BLANK, _BLANK])
    total = None
    for start in range(0, len(seq), _BLOCK):
        found = np.unique(_grams(padded[start : start + _BLOCK + 2]), return_counts=True)
        total = found if total is None else _add(total, found)
    return total if total is not None else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _ranking(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return codes[np.argsort(-counts, kind="stable")[:PROFILE]]


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Each language's grams in the order of their rank."""
    bounded_batches(docs.sparkSession)
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (codes, counts) in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])
            total.clear()

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for part in texts(batch.column(0)):
                seq, bounds, _ = _sequences(part)
                here = langs[part.first : part.first + len(bounds) - 1]
                for lang in sorted(set(here)):
                    own = np.concatenate([seq[bounds[i] : bounds[i + 1] + 1] for i in np.flatnonzero(here == lang)])
                    found = gram_counts(own)
                    total[lang] = _add(total[lang], found) if lang in total else found
                if sum(len(codes) for codes, _ in total.values()) > _KEPT_GRAMS:
                    yield from flush()
        yield from flush()

    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    counts = known.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counts.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= PROFILE)
    rows = top.select("lang", "rank", "gram").limit(MAX_LANGUAGES * PROFILE + 1).collect()
    if len(rows) > MAX_LANGUAGES * PROFILE:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the profiles are too large to send to every task")
    profiles: dict[str, list[tuple[int, int]]] = {}
    for lang, rank, gram in rows:
        profiles.setdefault(lang, []).append((rank, gram))
    return {lang: np.array([g for _, g in sorted(profiles[lang])], np.int64) for lang in sorted(profiles)}


def out_of_place(profiles: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All profile grams in ascending order, and the rank of each in each language (``PROFILE`` where it has none)."""
    grams = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.int64)]))
    ranks = np.full((len(grams) + 1, len(profiles)), PROFILE, np.int64)
    for k, profile in enumerate(profiles.values()):
        ranks[np.searchsorted(grams, profile), k] = np.arange(len(profile))
    return grams, ranks


def distances(ranking: np.ndarray, grams: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    at = np.searchsorted(grams, ranking)
    at[(at == len(grams)) | (np.append(grams, -1)[at] != ranking)] = len(grams)
    theirs = ranks[at]
    return np.where(theirs == PROFILE, PROFILE, np.abs(theirs - np.arange(len(ranking))[:, None])).sum(axis=0)


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id, lang_pred, score``; the score is one minus the distance relative to the largest possible."""
    sent = docs.sparkSession.sparkContext.broadcast((list(profiles), *out_of_place(profiles)))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names, grams, ranks = sent.value
        languages, scores = [], []
        for part in texts(batch.column(1)):
            seq, bounds, spelled = _sequences(part)
            for a, b, has in zip(bounds[:-1], bounds[1:], spelled, strict=True):
                if not has or not names:
                    languages.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                ranking = _ranking(*gram_counts(seq[a : b + 1]))
                far = distances(ranking, grams, ranks)
                languages.append(names[int(far.argmin())])
                scores.append(1.0 - float(far.min()) / (PROFILE * len(ranking)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"])

    source = docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).cast("string"))
    return map_batches(source, run, f"`{id_col}` bigint, lang_pred string, score double")
