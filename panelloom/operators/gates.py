"""Who was led to which block, found from the answers.

A questionnaire shows a block only to some respondents; which ones is rarely written down. Here the rules are read off the data. Every
row becomes a bit vector of the blocks it answered; rows are counted once per combination of that vector and the possible gate
answers (one aggregate with map-side combine, bounded by the vocabularies). Everything else works on those counts:

* an answer *closes* a block if hardly anyone who gave it answered the block, while others did;
* a block *implies* another if hardly anyone answered the first but not the second.

Both come with support (rows behind the rule) and confidence; a rule needs a minimum of each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.scalars import any_answered, quoted, ratio
from panelloom.operators.shares import WEIGHT, count_combinations

_MASK = "__blocks"


def answered_counts(df: DataFrame, gates: Sequence[str], blocks: Mapping[str, Sequence[str]]) -> DataFrame:
    """``gates..., __blocks, __n``: rows per combination of gate answers (as text, NULL for a blank) and answered blocks, one bit each."""
    if len(blocks) > 62:
        raise ValueError("at most 62 blocks fit into one bit vector")
    bits = [F.when(any_answered(list(columns)), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, columns in enumerate(blocks.values())]
    vector = bits[0]
    for bit in bits[1:]:
        vector = vector.bitwiseOR(bit)
    return count_combinations(df.select(*[quoted(g).cast("string").alias(g) for g in gates], vector.alias(_MASK)), [*gates, _MASK])


def _per_block(counts: DataFrame, keep: Sequence[str], blocks: Sequence[str]) -> DataFrame:
    """The counts once per block with ``block`` and ``answered``, whether the row's bit is set."""
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("block"), F.col(_MASK).bitwiseAND(F.lit(1 << i)).cast("boolean").alias("answered")) for i, b in enumerate(blocks)]))
    return counts.select(*keep, _MASK, WEIGHT, each.alias("b")).select(*keep, _MASK, WEIGHT, "b.*")


def gate_rules(counts: DataFrame, gates: Sequence[str], blocks: Sequence[str], min_support: int = 30, min_confidence: float = 0.99) -> DataFrame:
    """``block, gate, value, support, confidence, coverage`` of every answer that closes a block.

    ``confidence`` is the share of the answer's rows that left the block blank, ``coverage`` the share of all blank rows of the block that the
    answer explains. A gate with no open answer is none: the block must be answered by more than ``1 - min_confidence`` of the
    rows with some other answer of it.
    """
    long = _per_block(counts.unpivot([_MASK, WEIGHT], list(gates), "gate", "value"), ["gate", "value"], blocks)
    per_value = long.groupBy("block", "gate", "value").agg(
        F.sum(WEIGHT).alias("support"), F.coalesce(F.sum(F.when(F.col("answered"), F.col(WEIGHT))), F.lit(0)).alias("answered")
    )
    of_gate = Window.partitionBy("block", "gate")
    blank = ratio(F.col("support") - F.col("answered"), F.col("support"))
    found = per_value.withColumns({
        "confidence": blank,
        "coverage": ratio(F.col("support") - F.col("answered"), F.sum(F.col("support") - F.col("answered")).over(of_gate)),
        "open": F.max((F.col("support") >= min_support) & (blank < min_confidence)).over(of_gate),
    })
    return found.where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence) & F.col("open")).select(
        "block", "gate", "value", "support", "confidence", "coverage"
    )


def block_implications(counts: DataFrame, blocks: Sequence[str], min_support: int = 30, min_confidence: float = 0.99) -> DataFrame:
    """``block, implied, support, confidence``: those who answered ``block`` also answered ``implied``."""
    if len(blocks) < 2:
        raise ValueError("an implication needs two blocks")
    masks = counts.groupBy(_MASK).agg(F.sum(WEIGHT).alias(WEIGHT))

    def has(i: int) -> Column:
        return F.col(_MASK).bitwiseAND(F.lit(1 << i)).cast("boolean")

    pairs = F.array(*[
        F.struct(F.lit(a).alias("block"), F.lit(b).alias("implied"), has(i).alias("first"), has(j).alias("also"))
        for i, a in enumerate(blocks) for j, b in enumerate(blocks) if i != j
    ])
    met = masks.select(WEIGHT, F.inline(pairs)).where("first")
    found = met.groupBy("block", "implied").agg(F.sum(WEIGHT).alias("support"), ratio(F.coalesce(F.sum(F.when(F.col("also"), F.col(WEIGHT))), F.lit(0)), F.sum(WEIGHT)).alias("confidence"))
    return found.where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))


def shown(rules: Sequence[tuple[str, str | None]]) -> Column:
    """Whether no rule ``(gate, value)`` closes the block for a row."""
    open_ = F.lit(True)
    for gate, value in rules:
        open_ = open_ & ~quoted(gate).cast("string").eqNullSafe(F.lit(value))
    return open_


def rules_of(rules: DataFrame, block: str) -> list[tuple[str, str | None]]:
    """The rules of one block as plain pairs; there is at most one per gate answer."""
    return sorted(((r["gate"], r["value"]) for r in rules.where(F.col("block") == block).collect()), key=str)
