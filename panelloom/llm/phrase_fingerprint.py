"""Document fingerprints by locally consistent parsing.

Each level turns a row of symbols into a shorter row of phrase names. Runs of one symbol become one symbol; deterministic
coin tossing (the lowest bit in which a symbol differs from the one before it, with that bit's value) reduces the
alphabet to six labels; phrases begin where a label is a local maximum; a phrase's name is the hash of its content.
Labels depend on four neighbours to the left and one to the right, so equal substrings get equal phrases but for
a few at their ends, whatever their offset. Names are hashes of content and agree across documents without a dictionary.

A fingerprint holds, for two levels (phrases of about ten and forty characters), the smallest name per slot of a
hashed partition of the names. Likeness is the share of slots in which two fingerprints agree, empty slots of both apart.

Fingerprinting itself needs no shuffle. Comparing each document with the next one by descending id moves every text once:
ids are cut into ranges of equal size, each range also receives the first document of the range after it, and a
task walks through its sorted rows with one row in hand.

Defined results: NULL text is empty text; equal texts have equal fingerprints and likeness 1, empty ones included; an empty and a
non-empty text have likeness 0; rows of equal id follow each other in text order; rows with a NULL id come last; a
single document is its own next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.arrays import Rolling, mix, texts
from panelloom.llm.frames import bounded_batches, map_batches

SLOTS = 64  # per level
LEVELS = (2, 3)
_EMPTY = np.uint64(2**64 - 1)


def _runs(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of one symbol as one symbol, whose value tells the length of a longer run."""
    first = np.ones(len(symbols), bool)
    first[1:] = (symbols[1:] != symbols[:-1]) | (owner[1:] != owner[:-1])
    if first.all():
        return symbols, owner
    at = np.flatnonzero(first)
    length = np.diff(np.append(at, len(symbols))).astype(np.uint64)
    kept = symbols[at].astype(np.uint64)
    with np.errstate(over="ignore"):
        return np.where(length > 1, mix(kept ^ (length * np.uint64(0x9E3779B97F4A7C15))), kept), owner[at]


def _labels(symbols: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Labels 0 to 5; neighbours differ inside a text."""
    label = symbols
    for _ in range(4):
        one = label.dtype.type(1)
        differ = np.ones_like(label)
        differ[1:] = label[1:] ^ label[:-1]
        differ[start] = one
        lowest = differ & (~differ + one)  # the lowest bit in which the two differ
        place = np.bitwise_count(lowest - one)
        label = (place * np.uint8(2) + ((label & lowest) != 0)).astype(np.uint8)
    return label


def parse(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of one level and the text each belongs to."""
    if not len(symbols):
        return np.zeros(0, np.uint64), owner
    symbols, owner = _runs(symbols, owner)
    start = np.ones(len(symbols), bool)
    start[1:] = owner[1:] != owner[:-1]
    label = _labels(symbols, start)
    peak = start.copy()
    peak[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~start[2:]
    at = np.flatnonzero(peak)
    names = Rolling(mix(symbols.astype(np.uint64))).runs(at, np.append(at[1:], len(symbols)))
    return names, owner[at]


def sketches(column: pa.Array) -> np.ndarray:
    """One row of slots per text: the smallest name of each slot and level, cut to 16 bits; 0 where there is none."""
    out = np.full((len(column), len(LEVELS) * SLOTS), _EMPTY, np.uint64)
    for part in texts(column, 1 << 18):
        points = np.frombuffer(part.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        lengths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        rows = np.searchsorted(np.append(0, np.cumsum(lengths)), part.offsets)
        names, owner = points, np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        for level in range(1, max(LEVELS) + 1):
            names, owner = parse(names, owner)
            if level in LEVELS:
                slot = LEVELS.index(level) * SLOTS + (names % np.uint64(SLOTS)).astype(np.int64)
                np.minimum.at(out, (part.first + owner, slot), names)
    filled = out != _EMPTY
    return np.where(filled, 1 + (mix(out) % np.uint64(65535)), 0).astype(np.uint16)


def text_of(sketch: np.ndarray) -> str:
    return sketch.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    used = (a != 0) | (b != 0)
    return float((a == b)[used].mean()) if used.any() else 1.0


def likeness_of_fingerprints(a: str, b: str) -> float:
    return likeness(*(np.frombuffer(bytes.fromhex(x), ">u2") for x in (a, b)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id, fingerprint``."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [text_of(s) for s in sketches(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [id_col, "fingerprint"])

    return map_batches(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")), run, f"`{id_col}` bigint, fingerprint string")


class _Row(NamedTuple):
    place: int
    id: int | None
    text: str
    copy: bool
    sketch: np.ndarray


def with_next(docs: DataFrame, id_col: str, text_col: str, ranges: int) -> DataFrame:
    """Rows ``place, id, text, copy`` dealt by ``place`` and sorted, each place followed by the first row after it (a copy)."""
    low = np.iinfo(np.int64).min
    source = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(low)).alias("__k"), F.col(id_col).cast("bigint").alias("__id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"),
    )
    cuts = source.select("__k").stat.approxQuantile("__k", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    edges = np.unique(np.array(cuts, float).astype(np.int64)) if cuts else np.zeros(0, np.int64)

    bounds = F.array(*[F.lit(int(e)) for e in edges]) if len(edges) else F.array().cast("array<bigint>")

    def place_of(key: str) -> Column:
        return F.size(F.filter(bounds, lambda e: e < F.col(key)))

    placed = source.withColumn("__place", place_of("__k"))
    # One row per range: small by construction.
    heads = {r["__place"]: r["head"] for r in source.select("__k").withColumn("__place", place_of("__k")).groupBy("__place").agg(F.max("__k").alias("head")).collect()}
    order = sorted(heads, reverse=True)  # as the documents follow each other
    before = {heads[p]: order[i - 1] for i, p in enumerate(order)}  # the first range follows the last
    if not before:
        return placed.select("__place", "__id", "__text", F.lit(False).alias("__copy"))
    targets = F.create_map(*[F.lit(x) for head, target in before.items() for x in (head, target)])
    both = placed.select(
        "__id", "__text", "__k",
        F.explode(F.array_compact(F.array(
            F.struct(F.col("__place").alias("p"), F.lit(False).alias("c")),
            F.when(F.col("__k").isin(list(before)), F.struct(targets[F.col("__k")].alias("p"), F.lit(True).alias("c"))),
        ))).alias("__to"),
    )
    dealt = both.select(F.col("__to.p").alias("__place"), "__id", "__text", F.col("__to.c").alias("__copy"), "__k")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(partitions, "__place").sortWithinPartitions("__place", "__copy", F.desc("__k"), "__text").drop("__k")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Per row: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many of the next document.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    ranges = ranges or min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 2048)
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def results(pairs: list[tuple[_Row, _Row]]) -> pa.RecordBatch:
        edited = [a.text[: len(a.text) - len(a.text) // 2] + b.text[: len(a.text) // 2] for a, b in pairs]
        marks = sketches(pa.array(edited, pa.large_string()))
        rows = [
            (a.id, len(a.text), hashlib.sha256(e.encode()).hexdigest(), text_of(a.sketch), text_of(m), likeness(a.sketch, m), likeness(a.sketch, b.sketch))
            for (a, b), e, m in zip(pairs, edited, marks, strict=True)
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: _Row | None = None
        for batch in batches:
            found = sketches(batch.column(2))
            pairs = []
            for place, doc, text, copy, sketch in zip(*(batch.column(i).to_pylist() for i in range(4)), found, strict=True):
                row = _Row(place, doc, text, copy, sketch)
                # Copies of an id that several rows share follow each other: only the first one is the next document.
                if last is not None and last.place == place and not last.copy:
                    pairs.append((last, row))
                last = row
            if pairs:
                yield results(pairs)

    return with_next(docs, id_col, text_col, ranges).mapInArrow(run, f"`{id_col}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
