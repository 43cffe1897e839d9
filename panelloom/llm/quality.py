"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled good, the unlabelled web text is everything without a label, and the class prior is the
labelled rows' share of good ones. See :mod:`panelloom.llm.pu_learning` for the risk, the bounds and the defined results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelloom.llm.pu_learning import Kind, Model, learn, score

KIND = Kind(word=True, endings=True, make_up=True)


def learn_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", **bounds: int) -> Model:
    return learn(docs, labels, label_col, KIND, **bounds)


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    return score(docs, model)
