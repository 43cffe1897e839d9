"""Labels that mean the same: near pairs of texts, names across editions, advice for unknown values.

Two labels are near when their edit distance is at most ``ratio`` of the longer one. Near pairs come from one equi-join: a
label's two-letter grams are put in order, rarest of the vocabulary first, and only the first ``2 d + 1`` of them take part, ``d`` being the largest
distance the label can have to a partner. An edit spoils at most two grams, so near labels keep one of these in common;
nothing is lost and frequent grams bring nobody together. ``ratio`` must stay below a half for that.

All tables here are vocabularies: the distinct labels, however many rows carry them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.sources.tables import literal_table

# Latin letters with marks and the letters without.
_MARKED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ"
_PLAIN = "aaaaaaeeeeiiiiooooouuuucnyy"

RATIO = 0.15
#: A label that goes on after all words of another is the same option if the shorter one has this many words.
LEADING_WORDS = 3


def label_key(label: Column) -> Column:
    """Lower case, no marks, anything but letters, digits, ``+`` and ``#`` a blank, blanks single: equal keys are one label.

    A text of nothing but punctuation is its own key, so it does not meet every other such text.
    """
    plain = F.translate(F.lower(label), _MARKED, _PLAIN)
    words = F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}+#]+", " "))
    return F.when(words == "", F.trim(plain)).otherwise(words)


def _grams(labels: DataFrame, groups: Sequence[str], ratio: float) -> DataFrame:
    """``groups, key, gram`` of all grams, numbered where a label has one several times, with how many take part."""
    # 0 edits and more for a partner of up to size / (1 - ratio).
    most = F.floor(F.lit(ratio) * F.length("key") / F.lit(1 - ratio) + F.lit(1e-9)).cast("int")
    padded = F.concat(F.lit("\u0002"), F.col("key"))
    pieces = F.transform(F.sequence(F.lit(1), F.length("key")), lambda i: F.substr(padded, i, F.lit(2)))
    each = labels.select(*groups, "key", (2 * most + 1).alias("take"), F.explode(pieces).alias("piece"))
    counted = each.groupBy(*groups, "key", "take", "piece").agg(F.count(F.lit(1)).alias("times"))
    return counted.select(
        *groups, "key", "take", F.explode(F.transform(F.sequence(F.lit(1), F.col("times")), lambda i: F.concat(F.col("piece"), i.cast("string")))).alias("gram")
    )


def near_pairs(left: DataFrame, right: DataFrame, groups: Sequence[str] = (), ratio: float = RATIO) -> DataFrame:
    """``groups, left_key, right_key, distance`` of all near pairs within a group; both sides have ``groups`` and ``key``.

    An empty key is near nothing.
    """
    if not 0 <= ratio < 0.5:
        raise ValueError("ratio must be at least 0 and below 0.5")
    groups = list(groups)
    sides = [side.select(*groups, "key").where(F.length("key") > 0).distinct() for side in (left, right)]
    grams = [_grams(side, groups, ratio) for side in sides]
    often = grams[0].unionByName(grams[1]).groupBy(*groups, "gram").agg(F.count(F.lit(1)).alias("often"))
    rarest = Window.partitionBy(*groups, "key").orderBy("often", "gram")
    first = [
        g.join(often, [*groups, "gram"]).withColumn("place", F.row_number().over(rarest)).where("place <= take").select(*groups, "gram", F.col("key").alias(name))
        for g, name in zip(grams, ("left_key", "right_key"))
    ]
    size = F.greatest(F.length("left_key"), F.length("right_key"))
    limit = F.floor(F.lit(ratio) * size).cast("int")
    close = F.abs(F.length("left_key") - F.length("right_key")) <= limit
    pairs = first[0].join(first[1], [*groups, "gram"]).where(close).select(*groups, "left_key", "right_key").distinct()
    return pairs.withColumn("distance", F.levenshtein("left_key", "right_key")).where(F.col("distance") <= limit)


def _extended(left: DataFrame, right: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Pairs where one label has all words of the other and goes on; found by their leading words."""
    def side(labels: DataFrame, name: str) -> DataFrame:
        words = F.split("key", " ")
        head = F.array_join(F.slice(words, 1, LEADING_WORDS), " ")
        return labels.where(F.size(words) >= LEADING_WORDS).select(*groups, head.alias("head"), F.col("key").alias(name)).distinct()

    longer = F.concat(F.col("left_key"), F.lit(" ")).startswith(F.concat(F.col("right_key"), F.lit(" ")))
    shorter = F.concat(F.col("right_key"), F.lit(" ")).startswith(F.concat(F.col("left_key"), F.lit(" ")))
    pairs = side(left, "left_key").join(side(right, "right_key"), [*groups, "head"]).where((longer | shorter) & (F.col("left_key") != F.col("right_key")))
    return pairs.select(*groups, "left_key", "right_key", F.abs(F.length("left_key") - F.length("right_key")).alias("distance"))


class AmbiguousLabels(ValueError):
    """Labels with more than one equally good partner; ``pairs`` lists them."""

    def __init__(self, pairs: list[tuple]):
        super().__init__(f"labels with several equally near partners (name one in the aliases): {pairs}")
        self.pairs = pairs


def _one_to_one(pairs: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Pairs that are the nearest for both sides, with how many are equally near on either."""
    by_left, by_right = Window.partitionBy(*groups, "left_key"), Window.partitionBy(*groups, "class")
    best = pairs.withColumns({"l": F.min("distance").over(by_left), "r": F.min("distance").over(by_right)})
    mutual = best.where("distance = l and distance = r")
    return mutual.withColumns({"tied": F.greatest(F.count(F.lit(1)).over(by_left), F.count(F.lit(1)).over(by_right))})


def align_labels(
    labels: DataFrame,
    group: str,
    period: str,
    label: str,
    periods: Sequence[str],
    aliases: Mapping[str, str] | None = None,
    ratio: float = RATIO,
) -> DataFrame:
    """One name for each option across editions: ``group, period, label, name``, a row per distinct input label.

    Edition by edition, a label takes the name of an earlier one with the same key; what is left is matched with the options the
    edition has not used yet: one to one, nearest pairs first, by edit distance or because one goes on where the other
    ends. Two equally near partners are an error rather than a guess; an alias (label to the label it stands for) settles it.
    The name of an option is its latest label, the first in order if an edition prints it twice.
    """
    spark = labels.sparkSession
    stands_for = literal_table(spark, (aliases or {"": ""}).items(), "alias string, target string").where("alias <> ''")
    texts = labels.select(F.col(group).alias("g"), F.col(period).alias("p"), F.col(label).alias("text")).where("text is not null").distinct()
    keyed = texts.join(stands_for, texts["text"] == stands_for["alias"], "left").select(
        "g", "p", "text", label_key(F.coalesce("target", "text")).alias("key")
    )
    # The vocabulary is read once per edition below and is small; its rows come back as an inline relation of known size.
    vocabulary = keyed.collect()
    if not vocabulary:
        return labels.select(F.col(group), F.col(period), F.col(label), F.col(label).alias("name")).where("false")
    known: dict[tuple, int] = {}  # (group, key) -> class
    classes = 0
    for edition in periods:
        own = sorted({(r.g, r.key) for r in vocabulary if r.p == edition}, key=str)
        fresh = [k for k in own if k not in known]
        used = {known[k] for k in own if k in known}
        free = [(g, c, key) for (g, key), c in known.items() if c not in used]
        if fresh and free:
            left = literal_table(spark, fresh, "g string, key string")
            right = literal_table(spark, free, "g string, class int, key string")
            near = near_pairs(left, right, ["g"], ratio).unionByName(_extended(left, right, ["g"]))
            owned = near.join(right.withColumnRenamed("key", "right_key"), ["g", "right_key"])
            pairs = owned.groupBy("g", "left_key", "class").agg(F.min("distance").alias("distance"))
            found = _one_to_one(pairs, ["g"]).collect()
            unclear = sorted((r.g, r.left_key, next(k for (g, k), c in known.items() if c == r["class"])) for r in found if r.tied > 1)
            if unclear:
                raise AmbiguousLabels(unclear)
            known.update({(r.g, r.left_key): r["class"] for r in found})
        for k in own:
            if k not in known:
                known[k] = classes = classes + 1
    order = {p: i for i, p in enumerate(periods)}
    outside = sorted({r.p for r in vocabulary if r.p not in order}, key=str)
    if outside:
        raise ValueError(f"labels of editions that are not in the order: {outside}")
    names: dict[int, str] = {}
    for r in sorted(vocabulary, key=lambda r: (-order[r.p], r.text)):
        names.setdefault(known[r.g, r.key], r.text.strip())
    rows = [(r.g, r.p, r.text, names[known[r.g, r.key]]) for r in vocabulary]
    return literal_table(spark, rows, f"`{group}` string, `{period}` string, `{label}` string, name string")


def nearest_known(unknown: DataFrame, known: DataFrame, groups: Sequence[str] = (), top: int = 3, ratio: float = 0.4) -> DataFrame:
    """Advice for values no mapping knows: ``groups, raw_value, suggestion, distance, place``, the ``top`` nearest known values.

    Both sides have ``groups`` and ``raw_value``. Distances are between keys, so case, marks and punctuation cost nothing. Ties are in
    order of the suggestion. A value without anything near has no row.
    """
    groups = list(groups)
    left, right = (
        side.select(*groups, "raw_value", label_key(F.col("raw_value")).alias("key")).where("raw_value is not null").distinct() for side in (unknown, known)
    )
    pairs = near_pairs(left, right, groups, ratio)
    named = pairs.join(left.withColumnRenamed("key", "left_key"), [*groups, "left_key"]).join(
        right.select(*groups, F.col("raw_value").alias("suggestion"), F.col("key").alias("right_key")), [*groups, "right_key"]
    )
    place = F.row_number().over(Window.partitionBy(*groups, "raw_value").orderBy("distance", "suggestion"))
    return named.withColumn("place", place).where(F.col("place") <= top).select(*groups, "raw_value", "suggestion", "distance", "place")
