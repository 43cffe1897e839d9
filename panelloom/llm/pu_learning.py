"""Non-negative positive-unlabelled learning of a linear classifier over binary text features.

With positives P, unlabelled texts U and the class prior p, the risk minimised is

    p * R_P(+)  +  max(0, R_U(-) - p * R_P(-))

with logistic loss; where the second part would become negative the step goes the other way, so that it cannot
overfit below zero. No text is ever used as a negative example.

Features are hashes: words without the punctuation around them, beginnings of words, endings of words, and bucketed shares of a
text's make-up. Which features enter the model is decided from document frequencies counted by Spark over all positives and all
unlabelled training texts; only the weights are fitted by numpy on a bounded sample of vectors (``max_positive``,
``max_unlabelled`` rows, chosen by a hash of the id). Scoring is one pass over all texts without a shuffle.

The unlabelled texts are those without a label; where every text has one, all of them with their labels ignored, which the risk allows
just as well, as it only asks for texts drawn from the whole.

Defined results: NULL text is empty text; an empty text has only its make-up features; without any positive training
text every score is the class prior; rows with a NULL id or label are never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.arrays import LOWER, SPACE, Spans, Texts, Words, mix, signed, texts, words
from panelloom.llm.frames import bounded_batches, map_batches

PREFIXES = (3, 4, 5, 6, 7, 8)
# Up to so many labelled rows meet the texts by broadcast; beyond, the join is a shuffle with the same result.
BROADCAST_LABELS = 2_000_000
_BITS = 22
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Kind(NamedTuple):
    """Which families of features a classifier looks at."""

    word: bool = True
    beginnings: bool = False
    endings: bool = False
    make_up: bool = False
    most: int = 1  # a feature counts at most so often in one text


def _bucket(rows: int, number: int, share: np.ndarray, steps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """One feature per row: which of ``steps`` equal parts of 0..1 the share falls into, and all lower ones."""
    level = np.clip(np.ceil(np.nan_to_num(share) * steps), 0, steps).astype(np.int64)
    owner = np.repeat(np.arange(rows), level + 1)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(level + 1) - level - 1, level + 1)
    return owner, (np.uint64(0xABCDEF) + np.uint64(number << 12) + inside.astype(np.uint64))


def features(part: Texts, kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature hash of each feature, repeated features included."""
    data = LOWER[part.data]
    w = words(Texts(part.first, data, part.offsets))
    rows = len(part.offsets) - 1
    owner = np.repeat(np.arange(rows), np.diff(w.first))
    spans = Spans(data)
    # Without punctuation at both ends; a word of nothing else stays as it is.
    core = np.append(0, np.cumsum(~_PUNCTUATION[data] & ~SPACE[data]))
    solid = np.flatnonzero(np.diff(core))
    has = core[w.ends] > core[w.starts]
    starts = np.where(has, np.append(solid, 0)[np.minimum(core[w.starts], len(solid))], w.starts)
    ends = np.where(has, np.append(solid, 0)[np.maximum(core[w.ends] - 1, 0)] + 1, w.ends)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    if kind.word:
        out.append((owner, spans.hash(starts, ends)))
    if kind.beginnings:
        for n in PREFIXES:
            long = ends - starts > n
            out.append((owner[long], mix(spans.hash(starts[long], starts[long] + n) + np.uint64(n))))
    if kind.endings:
        for n in (1, 2, 3):
            out.append((owner, mix(spans.hash(np.maximum(w.ends - n, w.starts), w.ends) + np.uint64(100 + n))))
    if kind.make_up:
        out += _make_up(part, w, owner, spans, rows)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([o for o, _ in out]), np.concatenate([h for _, h in out])


def _make_up(part: Texts, w: Words, owner: np.ndarray, spans: Spans, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(mask))
        return (total[part.offsets[1:]] - total[part.offsets[:-1]]).astype(float)

    size, count = np.maximum(np.diff(part.offsets), 1), np.maximum(np.diff(w.first), 1)
    hashes = spans.hash(w.starts, w.ends)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    with np.errstate(over="ignore"):
        pairs = np.unique(hashes + mix(owner.astype(np.uint64)), return_index=True)[1]
    distinct = np.bincount(owner[pairs], minlength=rows)
    lengths = w.ends - w.starts
    shares = (
        per_row(_UPPER[part.data]) / size,
        per_row(_DIGIT[part.data]) / size,
        per_row(_PUNCTUATION[part.data]) / size,
        per_row(part.data == 0x21) / count,
        per_row(part.data == 0x0A) / count,
        np.bincount(owner, again, rows) / count,
        distinct / count,
        np.bincount(owner, lengths, rows) / count / 40,
        np.bincount(owner, lengths == 1, rows) / count,
        np.bincount(owner, _PUNCTUATION[part.data[np.maximum(w.ends - 1, 0)]], rows) / count,
        np.log2(count) / 20,
    )
    return [_bucket(rows, k, share) for k, share in enumerate(shares)]


def _distinct(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


class Model(NamedTuple):
    """Weights of the chosen features (hashes in ascending order), bias, and the prior used where nothing was learned."""

    kind: Kind
    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float
    fitted: bool


class Index:
    """Looks hashes up among chosen ones; a bit table lets almost all others through quickly."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self._maybe = np.zeros(1 << _BITS, bool)
        self._maybe[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, rows: np.ndarray, hashes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row and number of the chosen features each row has, once each, with their values: counts up to ``most``."""
        maybe = self._maybe[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)]
        rows, hashes = rows[maybe], hashes[maybe]
        if not len(self.hashes) or not len(rows):
            return rows[:0], np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes
        pairs, counts = np.unique(rows[hit].astype(np.int64) * len(self.hashes) + at[hit], return_counts=True)
        return pairs // len(self.hashes), pairs % len(self.hashes), np.minimum(counts, most).astype(float)


def _folds(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, positive: np.ndarray, count: int) -> list[tuple[np.ndarray, ...]]:
    """The rows dealt into ``count`` parts with P and U in proportion; one part is the arrays as they are, not a copy."""
    if count == 1:
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        return [(rows, columns, values, positive, rows[first], first)]
    order = np.argsort(~positive, kind="stable")
    part_of, number = np.empty(len(positive), np.int16), np.empty(len(positive), np.int32)
    part_of[order] = np.arange(len(positive)) % count
    out = []
    for k in range(count):
        own = np.flatnonzero(part_of == k)
        number[own] = np.arange(len(own))
        take = part_of[rows] == k
        local = number[rows[take]]
        first = np.flatnonzero(np.diff(local, prepend=-1))
        filled = local[first]
        out.append((local, columns[take], values[take], positive[own], filled, first))
    return out


def fit_weights(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, positive: np.ndarray, width: int, prior: float, steps: int = 1200, decay: float = 3e-3, folds: int = 8) -> tuple[np.ndarray, float]:
    """Minimises the non-negative risk with Adam, one of ``folds`` parts of the rows a step; ``positive`` marks P, the others are U.

    ``rows`` ascend. The step size falls to a hundredth, so the last steps settle where the second part of the risk meets zero.
    """
    parts = _folds(rows, columns, values, positive, max(1, min(folds, len(positive) // 3000)))  # a part must estimate the risk well
    w, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        row, column, value, is_p, filled, starts = parts[step % len(parts)]
        n_p, n_u = int(is_p.sum()), int((~is_p).sum())
        z = np.full(len(is_p), w[-1])
        if len(filled):
            z[filled] += np.add.reduceat(w[column] * value, starts)
        up = 1 / (1 + np.exp(-np.clip(z, -50, 50)))  # slope of the loss as a negative; minus one: as a positive
        loss_neg = np.logaddexp(0, z)
        rest = loss_neg[~is_p].mean() - prior * loss_neg[is_p].mean()
        as_positive = np.where(is_p, prior * (up - 1) / n_p, 0)
        as_negative = np.where(is_p, -prior * up / n_p, up / n_u)
        slope = as_positive + as_negative if rest >= 0 else -as_negative
        gradient = np.append(np.bincount(column, slope[row] * value, width), slope.sum())
        gradient[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        rate = 0.1 * 0.01 ** (step / steps)
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    # Few positives can be told apart by chance, which lifts all of U. Then the bias follows from the class prior.
    z = np.concatenate([np.bincount(row, w[column] * value, len(is_p))[~is_p] for row, column, value, is_p, *_ in parts])
    mean = lambda bias: float((1 / (1 + np.exp(-np.clip(z + bias, -500, 500)))).mean())
    if mean(w[-1]) > prior + 0.25 * (1 - prior):
        low, high = w[-1] - 100.0, w[-1]
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if mean(middle) > prior else (middle, high)
        w[-1] = low
    return w[:-1], float(w[-1])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    kind: Kind,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_positive: int = 20_000,
    max_unlabelled: int = 40_000,
    max_features: int = 8192,
    least: int = 3,
    min_gap: float = 5.0,
    decay: float = 3e-3,
    folds: int = 8,
) -> Model:
    """A model from rows labelled 1 and rows without a label; the prior is the labelled rows' share of 1.

    ``docs`` and ``labels`` hold training rows only. A feature enters if it occurs in at least ``least`` texts of P and U and its
    frequencies in all of P and U differ by at least ``min_gap`` standard errors, the ``max_features`` most different first. Labelled rows other than the positives serve the prior alone.
    """
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("__id")).agg(F.max(label_col).alias("__y"))
    counts = marks.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("__y").cast("bigint")).alias("k")).first()
    prior = (counts["k"] + 1) / (counts["n"] + 2) if counts["n"] else 0.5
    # Which rows take part is settled on ids alone; texts are read for these rows only.
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("__id"))
    by_hash = ids.join(marks, "__id", "left").withColumn("__h", F.xxhash64("__id", F.lit(label_col)))
    sizes = by_hash.agg(F.count(F.when(F.col("__y") == 1, 1)).alias("p"), F.count(F.when(F.col("__y").isNull(), 1)).alias("u"), F.count(F.lit(1)).alias("all")).first()
    as_unlabelled = F.col("__y").isNull() if sizes["u"] else F.lit(True)
    chosen = (
        by_hash.where("__y = 1").orderBy("__h", "__id").limit(max_positive).select("__id", F.lit(True).alias("__p"))
        .unionByName(by_hash.where(as_unlabelled).orderBy("__h", "__id").limit(max_unlabelled).select("__id", F.lit(False).alias("__p")))
    ).toPandas()
    positive_ids = np.sort(chosen.loc[chosen["__p"], "__id"].to_numpy(np.int64))
    other_ids = np.sort(chosen.loc[~chosen["__p"].astype(bool), "__id"].to_numpy(np.int64))
    if not len(positive_ids) or not len(other_ids):
        return Model(kind, np.zeros(0, np.uint64), np.zeros(0), 0.0, float(prior), False)
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast((positive_ids, other_ids))
    source = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))

    def sampled(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
        own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        p, u = (np.flatnonzero(ids[np.minimum(np.searchsorted(ids, own), len(ids) - 1)] == own) for ids in sent.value)
        return batch.take(pa.array(np.append(p, u))), np.repeat([True, False], [len(p), len(u)])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return h, np.bincount(inverse, np.concatenate([p[1] for p in parts])), np.bincount(inverse, np.concatenate([p[2] for p in parts]))

        def table() -> pa.RecordBatch:
            h, p, u = merged()
            return pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(p.astype(np.int64)), pa.array(u.astype(np.int64))], ["h", "p", "u"])

        for batch in batches:
            of_p, of_u = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for part in texts(batch.column(2)):
                owner, hashes = _distinct(*features(part, kind))
                h, inverse = np.unique(hashes, return_inverse=True)
                parts.append((h, np.bincount(inverse, of_p[part.first + owner], len(h)), np.bincount(inverse, of_u[part.first + owner], len(h))))
            if sum(len(p[0]) for p in parts) > 2_000_000:
                parts = [merged()]
                if len(parts[0][0]) > 1_000_000:
                    yield table()
                    parts = []
        if parts:
            yield table()

    mark = F.broadcast(marks) if counts["n"] <= BROADCAST_LABELS else marks
    every = (
        docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).cast("string").alias("__text"))
        .join(mark, "__id", "left").select(F.coalesce(F.col("__y") == 1, F.lit(False)).alias("__p"), as_unlabelled.alias("__u"), "__text").where("__p or __u")
    )
    n_p, n_u = float(sizes["p"]), float(sizes["u"] or sizes["all"])
    p, u, both = F.col("p") / n_p, F.col("u") / n_u, (F.col("p") + F.col("u")) / (n_p + n_u)
    gap = F.abs(p - u) / F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u) + 1e-12)
    top = (
        every.mapInArrow(frequencies, "h bigint, p bigint, u bigint")
        .groupBy("h").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
        .where(F.col("p") + F.col("u") >= least)
        .select("h", gap.alias("gap")).where(F.col("gap") >= min_gap).orderBy(F.desc("gap"), "h").limit(max_features).toPandas()
    )
    hashes = np.sort(top["h"].to_numpy(np.int64).view(np.uint64))
    index = spark.sparkContext.broadcast(hashes)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Index(index.value)
        for batch in batches:
            rows, is_positive = sampled(batch)
            for part in texts(rows.column(1)) if rows.num_rows else ():
                owner, number, value = find.find(*features(part, kind), kind.most)
                n = len(part.offsets) - 1
                bounds = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (number.astype(np.int32), value.astype(np.int16))]
                yield pa.RecordBatch.from_arrays([pa.array(is_positive[part.first : part.first + n]), *lists], ["p", "columns", "values"])

    sample = source.mapInArrow(vectors, "p boolean, columns array<int>, values array<smallint>").toArrow()
    positive = sample.column("p").to_numpy(zero_copy_only=False).astype(bool)
    # Narrow numbers: the driver holds some hundreds of entries for each row of the sample.
    lists = sample.column("columns").combine_chunks()
    columns = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(positive), dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
    values = sample.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    del sample, lists
    weights, bias = fit_weights(rows, columns, values, positive, len(hashes), float(prior), decay=decay, folds=folds)
    return Model(kind, hashes, weights, bias, float(prior), True)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id, score, predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        m = sent.value
        values = score_column(batch.column(1), m)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(values), pa.array((values >= 0.5).astype(np.int32))], [id_col, "score", "predicted"]
        )

    source = docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).cast("string"))
    return map_batches(source, run, f"`{id_col}` bigint, score double, predicted int")


def score_column(column: pa.Array, model: Model) -> np.ndarray:
    """The score of each text."""
    if not model.fitted:
        return np.full(len(column), model.prior)
    index, out = Index(model.hashes), np.zeros(len(column))
    for part in texts(column):
        owner, number, value = index.find(*features(part, model.kind), model.kind.most)
        n = len(part.offsets) - 1
        z = np.bincount(owner, model.weights[number] * value, n) + model.bias
        out[part.first : part.first + n] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return out
