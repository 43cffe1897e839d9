"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, texts without a label the unlabelled ones; the risk is corrected by the class prior.
Words and their beginnings are the features, so inflected forms of a learned word count too. See
:mod:`panelloom.llm.pu_learning` for the risk, the bounds and the defined results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.frames import map_batches
from panelloom.llm.pu_learning import Kind, Model, learn, score, score_column

KIND = Kind(word=True, beginnings=True, most=4)


def learn_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", decay: float = 1e-4, folds: int = 1, **bounds: int) -> Model:
    """Single words decide here, so weights are held back less than where many weak features add up."""
    return learn(docs, labels, label_col, KIND, decay=decay, folds=folds, **bounds)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    return score(docs, model)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns unchanged; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    row = docs.select(F.col(text_col).cast("string").alias("__text"), F.struct("*").alias("__row"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        clean = score_column(batch.column(0), sent.value) < threshold
        yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(clean))], ["__row"])

    kind = row.schema["__row"].dataType.simpleString()
    return map_batches(row, run, f"__row {kind}").select("__row.*")


