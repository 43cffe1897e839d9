"""Exact dedup by skew-safe combining.

Texts are equal when identical after lower-casing A-Z. Digests are counted first, 32 bytes a row with a map-side combine: a text whose
digest nobody else has is alone, and stays where it is. Three combining steps run over all other rows, and each
of them groups by the *full normalised text* next to its digest, so equal digests never merge unequal texts:

1. inside each task, before anything moves (Spark's partial aggregate over ``digest, salt, text``);
2. per salted digest group: a group of copies, however large, is spread over ``salts`` tasks and each of them
   receives at most one row per sending task;
3. over the at most ``salts`` salt winners of a digest.

Membership goes back over the digest. The repeated digests are sent to all tasks while they are few, by count; beyond that the
rows meet them in a join whose large side adaptive execution splits where one digest is hot. Built-in functions only, no Python.

Defined results: NULL text counts as empty; the row with the largest id stays, a NULL id being smaller than all; rows
equal in id and text are one document: all of them report ``kept``, and :func:`keep_one` leaves one of them; an empty table gives no rows; columns of the
input other than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.frames import scratch, stored

SALTS = 16
SENT_DIGESTS = 500_000  # repeated digests sent to all tasks, some 50 bytes each; beyond that a join
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _normal(text: Column) -> Column:
    """A-Z in lower case, all else as it is; for a text of ASCII alone that is what ``lower`` does."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _digests(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``__id, __text, __digest`` and further columns."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("__id"), _normal(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("__text"), *more)
    return plain.withColumn("__digest", F.unhex(F.sha2("__text", 256)))


def _sent(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= SENT_DIGESTS else table


def _repeated_digests(rows: DataFrame) -> DataFrame:
    return stored(rows.groupBy("__digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__digest"), "exact-digests")


def _salted(rows: DataFrame, salts: int) -> DataFrame:
    # The salt follows the id, so it is the same again when a task is repeated.
    return rows.withColumn("__salt", F.pmod(F.xxhash64("__id"), F.lit(salts)))


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per normalised text that is there more than once: ``digest, text, keep_id, group_size``."""
    rows = _digests(docs, id_col, text_col)
    copies = _salted(rows.join(_sent(_repeated_digests(rows)), "__digest", "left_semi"), salts)
    per_salt = copies.groupBy("__digest", "__salt", "__text").agg(F.max("__id").alias("__keep"), F.count(F.lit(1)).alias("__n"))
    combined = per_salt.groupBy("__digest", "__text").agg(F.max("__keep").alias("keep_id"), F.sum("__n").alias("group_size"))
    return combined.where("group_size > 1").withColumnsRenamed({"__digest": "digest", "__text": "text"})


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """Per row: ``id, keep_id, group_size, kept, text_sha256``; the ids of dropped rows too."""
    with scratch(docs.sparkSession):
        found = winners(docs, id_col, text_col, salts).select(F.col("digest").alias("__digest"), "keep_id", "group_size")
        groups = stored(found, "exact-groups", keep=True)
    rows = _digests(docs, id_col, text_col).select("__id", "__digest")
    joined = rows.join(_sent(groups), "__digest", "left").select(
        F.col("__id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("__id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.lower(F.hex("__digest")).alias("text_sha256"),
    )
    return joined.select(
        id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged; of rows equal in id and text, one.

    The surviving row travels through the combining steps itself; a text that is alone is not moved while the repeated digests are few.
    """
    rows = _digests(docs, id_col, text_col, F.struct("*").alias("__row"))
    repeated = _sent(_repeated_digests(rows))
    alone = rows.join(repeated, "__digest", "left_anti").select("__row")
    copies = _salted(rows.join(repeated, "__digest", "left_semi"), salts).withColumn("__order", F.struct("__id"))
    per_salt = copies.groupBy("__digest", "__salt", "__text").agg(F.max_by("__row", "__order").alias("__row"), F.max("__order").alias("__order"))
    chosen = per_salt.groupBy("__digest", "__text").agg(F.max_by("__row", "__order").alias("__row")).select("__row")
    return alone.unionByName(chosen).select("__row.*")
