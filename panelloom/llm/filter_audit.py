"""How filters that run one after the other take each other's work: every order, every step, Shapley shares.

The states of a filter run are the sets of filters applied so far, a lattice from the empty set to all of them; an edge adds
one filter, an order is a path. Every document reduces to the set of filters it fails, so per part of the corpus only the counts
by failure set are kept (2**5 of them), by one aggregate with map-side combine. From them each edge gets its numbers:

* ``removed``: documents that fail the edge's filter and none applied before; ``kept``: documents that fail none up to and with it;
* forward counts say how many orders reach a state, backward counts how many leave it for the end. Their product is the number
  of orders through an edge, the weight of its removals in the Shapley sum. No order is ever run on documents;
* the steps of the orders are read off the same edges.

Copies (filter E) are found by the SHA-256 of the text. Rows of a digest are counted per task before they move, so a digest
with a third of all rows is a few rows per task; the smallest id of a digest is then taken over its distinct
``(part, labels)`` combinations.

Defined results: NULL text is empty text, NULL part the empty string; a NULL id is nobody's smaller id, is itself never a copy
and has no labels; rows with one id are documents of their own, and of equal texts those with the smallest id are all
originals; several label rows of one id count once, 1 if any says 1; a part without documents gives no rows and an empty
table none; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SPACE = r"[\x20\x09-\x0D]+"


class Edge(NamedTuple):
    """Adding ``filter`` (its place) to the set ``state``; ``paths`` orders take this step."""

    state: int
    filter: int
    paths: int


def lattice(n: int) -> list[Edge]:
    """All edges over the subsets of ``n`` filters with the number of orders through each, by forward and backward counts."""
    full = (1 << n) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(1, full + 1):
        forward[state] = sum(forward[state ^ (1 << f)] for f in range(n) if state >> f & 1)
    for state in range(full - 1, -1, -1):
        backward[state] = sum(backward[state | (1 << f)] for f in range(n) if not state >> f & 1)
    return [Edge(s, f, forward[s] * backward[s | 1 << f]) for s in range(full + 1) for f in range(n) if not s >> f & 1]


def text_failures(text: Column) -> dict[str, Column]:
    """Conditions under which a text fails: too short, too repetitive, too many capitals, odd signs."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    n = F.size(words)
    return {
        "A": n < 200,
        "B": F.lit(100) * F.size(F.array_distinct(words)) < F.lit(50) * n,
        "C": F.lit(100) * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > F.lit(2) * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Documents per part and failure set: ``part, fails, n, good, toxic``; bit ``i`` of ``fails`` is filter ``ABCDE[i]``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    seen = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("body"))
    bits = [F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(text_failures(F.col("body")).values())]
    rows = seen.select("id", "part", F.unhex(F.sha2("body", 256)).alias("digest"), sum(bits[1:], bits[0]).alias("fails"))
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("quality").cast("int").alias("q"), F.col("toxic").cast("int").alias("t"))
        .where("id is not null")
        .groupBy("id")
        .agg(F.max((F.col("q") == 1).cast("int")).alias("good"), F.max((F.col("t") == 1).cast("int")).alias("toxic"))
    )
    marked = rows.join(known, "id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    group = ["digest", "part", "fails", "good", "toxic"]
    # Rows of one id first, so that the smallest id's number of rows can be taken along by a plain aggregate.
    per_id = marked.groupBy(*group, "id").agg(F.count(F.lit(1)).alias("n"))
    per_group = per_id.groupBy(*group).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNotNull(), F.col("n"))).alias("with_id"),
        F.min("id").alias("first"),
        F.min_by("n", "id").alias("at_first"),
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    copies = F.coalesce(F.col("with_id") - F.when(F.col("first") == F.col("least"), F.col("at_first")).otherwise(F.lit(0)), F.lit(0))
    copy_bit = 1 << len(bits)
    both = F.array(
        F.struct(F.col("fails").alias("fails"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("fails") + F.lit(copy_bit)).alias("fails"), F.col("copies").alias("n")),
    )
    split = per_group.withColumn("least", least).withColumn("copies", copies).select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return split.groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def edge_counts(counts: DataFrame, n_filters: int) -> DataFrame:
    """Per part and edge: ``kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``; zeros included.

    ``counts`` has at most ``2 ** n_filters`` rows a part; each meets the edges as a constant array, which is no join.
    """
    edges = F.array(*(F.struct(F.lit(e.state).alias("state"), F.lit(e.filter).alias("filter"), F.lit(e.paths).alias("paths")) for e in lattice(n_filters)))
    met = counts.select("*", F.inline(edges))
    fails, state = F.col("fails"), F.col("state")
    bit = F.expr("shiftleft(1, filter)")
    alive = fails.bitwiseAND(state) == 0
    failing = fails.bitwiseAND(bit) != 0

    def total(condition: Column, what: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(F.lit(0)))

    per_edge = met.groupBy("part", "state", "filter", "paths").agg(
        total(alive & ~failing).alias("kept"),
        total(alive & failing).alias("removed"),
        total(~alive & failing).alias("redundant"),
        total(fails == bit).alias("unique_fails"),
        total(alive & failing, "good").alias("good_lost"),
        total(alive & failing, "toxic").alias("toxic_lost"),
    )
    share = F.sum(F.col("paths") * F.col("removed")).over(Window.partitionBy("part", "filter"))
    return per_edge.withColumn("shapley", share).drop("paths")


def steps(edges: DataFrame, filters: Sequence[str]) -> DataFrame:
    """One row per part, order and step, read off the edges; ``filter_order`` names the order."""
    taken = [
        ("".join(filters[f] for f in order), k + 1, sum(1 << f for f in order[:k]), f)
        for order in permutations(range(len(filters)))
        for k, f in enumerate(order)
    ]
    orders = edges.sparkSession.createDataFrame(taken, "filter_order string, step int, state int, filter int")
    return orders.join(edges, ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """The five filters in all 120 orders over ``docs``."""
    filters = "ABCDE"
    return steps(edge_counts(failure_counts(docs, labels, id_col, text_col, part_col), len(filters)), filters)
