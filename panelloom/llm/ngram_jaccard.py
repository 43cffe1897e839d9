"""N-gram Jaccard join by parity sketches.

A text's set holds its distinct ``k``-word shingles; two texts link when ``100 * shared >= percent * union``. Equal sets are
one class and take part once.

*Sketch.* Every shingle flips one bit of a row, so the Hamming distance of two rows is at most the size of the sets' symmetric
difference. The wide row has a bit for every hash value and is kept as the list of its set bits; the narrow one folds it to
``SKETCH_BITS``, the short one to ``64 * SHORT_WORDS``.
*Pigeonhole.* Sizes fall into bands, and a text at the lower end of one also takes part in the band below, where its smaller partners are. A band
cuts the row into blocks, somewhat more than the largest distance ``d`` of its linked sets, so that a block holds two to four set bits.
Linked sets differ in at most d blocks; so of a set's non-empty blocks all but d are found in the other one, and the first d + 1 of each in any one
order common to both have a block in common. Only these go into the join, one row each: block, parity of its bits, place. Two members of a
block's group are compared only if their sizes and places allow the block to be the first one shared. The order puts blocks first that hold several bits, as
a passage that many texts share seldom fills one alone, and last those whose bits are all frequent in a bounded sample (``SAMPLE`` texts): that steers the
work and cannot lose a link, whatever the sample holds. Small sets have a block per bit; a set that left too many blocks empty,
which hashing makes all but impossible, sends its whole band there as well.
*Hot groups.* A block with more than ``HOT`` members is no good choice. Texts that have such a block among their chosen ones choose
again, single bits this time: these are counted among these very texts, exactly, and put in order from rare to frequent. Linked sets of sizes ``a <= b`` share
``s >= percent * (a + b) / (100 + percent)`` bits, so at most ``a - s`` and ``b - s`` come before the first one they share, and together at most
``a + b - 2 s``. A link between two texts of a hot group is one between two texts that choose again, so hot groups are dropped altogether.
*Groups.* Groups with equal members count once. Each class is first compared with one pivot of its first group. In groups with several
components left, all members outside the largest one are then compared with a few of its members (``FIRST``): a straggler of a large group of near copies is
like most others and need not meet them all. Groups still open go on: small ones compare all that is left, large ones take ``PIVOTS`` of them, then ever
more; a group is finished when its members are connected or all pairs the places allow have been compared. So a large group of near copies costs about
one comparison per member.
Members carry their short sketches: a pair that these tell apart is dropped where the two meet and never becomes a row.
*Verification.* A pair goes on if the Hamming distance of the narrow sketches allows a link; then the sets are compared exactly.

The join's key rows are about a quarter of the shingles, 24 bytes each, in one shuffle; texts are read again only for classes that are
compared. Shingles are compared by 64-bit hashes.

Defined results: NULL text and text without words have an empty set and link with nothing; fewer words than ``k`` are one shingle;
rows with a NULL id belong to their class but never name a component unless all of it has none; repeated rows
share a component; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.arrays import LOWER, Rolling, Texts, mix, signed, span_hash, texts, words
from panelloom.llm.components import components
from panelloom.llm.frames import bounded_batches, map_batches, scratch, stored

K = 5
PERCENT = 80
SAMPLE = 8_000  # texts looked at for frequent shingles
FREQUENT = 200_000  # shingles sent to all tasks, 8 bytes each
SKETCH_BITS = 2048
SHORT_WORDS = 8  # 64-bit words of the sketch that members of a group carry
HOT = 32  # classes that may share a chosen bit; beyond it they choose again
FIRST = (2,)  # members of the largest component that the others of a group meet before any of these meets all
PIVOTS = 4  # members of a large group compared with all others in the first round, and by how much their number grows
SALTS = 64  # tasks over which a bit frequent in the sample is spread
SENT_IDS = 1_000_000  # ids sent to all tasks instead of shuffling texts; beyond that a join
SMALL = 128  # below that size every bit is a block of its own
# Blocks per largest size of a band: few enough to hold several bits, many enough that d + 1 are never empty.
_FEW, _MANY, _LARGE = 0.32, 0.4, 512
# What goes with a key, in one number: size (fewer than 2**26 shingles), place, bits of the block, band, whether it is too empty or common.
_PLACE, _BITS, _BAND, _SHORT, _COMMON = 26, 50, 56, 61, 62


def shingle_sets(part: Texts, k: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each row, ascending."""
    data = LOWER[part.data]
    w = words(Texts(part.first, data, part.offsets))
    roll = Rolling(span_hash(data, w.starts, w.ends))
    windows = roll.windows(k)
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(windows[a : b - k + 1])
        elif b > a:
            yield roll.runs(np.array([a]), np.array([b]))
        else:
            yield windows[:0]


def _xor(values: np.ndarray) -> np.uint64:
    return np.bitwise_xor.reduce(values, initial=np.uint64(0))


def class_of(shingles: np.ndarray) -> np.uint64:
    """One number per set; equal sets have equal ones."""
    return mix(np.array([_xor(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)))], np.uint64) + np.uint64(len(shingles)))[0]


def narrow_sketch(shingles: np.ndarray) -> bytes:
    flips = np.bincount((mix(shingles) % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def short_sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity row folded to a few 64-bit words."""
    bits = 64 * SHORT_WORDS
    flips = np.bincount((mix(shingles) >> np.uint64(32)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def _band_of(n: int) -> int:
    """Number of the size band of ``n``: from ``2**band`` to the next power of two."""
    return n.bit_length() - 1


def band_keys(shingles: np.ndarray, frequent: np.ndarray, percent: int, fine: frozenset[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the chosen blocks in every band the set takes part in, and what goes with them.

    With ``fine`` only these bands, and a block per bit in them.
    """
    n = len(shingles)
    common = np.zeros(n, bool)
    if len(frequent):
        common = frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] == shingles
    keys, infos = [], []
    for band in {_band_of(n), _band_of(-(-n * percent // 100))}:
        if fine is not None and band not in fine:
            continue
        largest = (2 << band) - 1
        # To the largest partner in the band: it has at most n * 100 / percent shingles.
        distance = (n + min(largest, n * 100 // percent)) * (100 - percent) // (100 + percent)
        salted = mix(shingles ^ mix(np.array([band + 1 + (64 if fine else 0)], np.uint64)))
        if largest < SMALL or fine is not None:
            key, held, all_common = salted, np.ones(n, np.int64), common
        else:
            blocks = np.uint64(int((_MANY if largest < _LARGE else _FEW) * (largest + 1)) + 1)
            block = salted % blocks
            order = np.argsort(block, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(block[order]) != 0))
            parity = np.bitwise_xor.reduceat(mix(salted[order]), first)
            held = np.minimum(np.diff(np.append(first, n)), 63)
            key = mix(parity + mix(block[order][first] + np.uint64(band << 32)))
            all_common = np.logical_and.reduceat(common[order], first)
        chosen = np.lexsort((signed(key), -held, all_common))[: distance + 1]  # signed, as Spark compares keys
        place = np.arange(len(chosen), dtype=np.int64)
        keys.append(key[chosen])
        infos.append((all_common[chosen].astype(np.int64) << _COMMON) | (band << _BAND) | (held[chosen] << _BITS) | (place << _PLACE) | n)
        if len(chosen) <= distance:
            keys.append(np.array([band], np.uint64))
            infos.append(np.array([1 << _SHORT], np.int64))
    if not keys:
        return shingles[:0], np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(infos)


def _frequent_shingles(source: DataFrame, k: int, sample: int) -> np.ndarray:
    ids = source.select("__id", F.xxhash64("__id", F.lit(7)).alias("h")).orderBy("h", "__id").limit(sample)
    chosen = np.unique(np.array([r["__id"] for r in ids.collect()], np.int64))
    if not len(chosen):
        return np.zeros(0, np.uint64)
    sent = source.sparkSession.sparkContext.broadcast(chosen)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = batch.column(0).to_numpy(zero_copy_only=False)
        picked = batch.filter(pa.array(sent.value[np.minimum(np.searchsorted(sent.value, own), len(sent.value) - 1)] == own))
        for part in texts(picked.column(1)) if picked.num_rows else ():
            sets = [(s, class_of(s)) for s in shingle_sets(part, k) if len(s)]
            if sets:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate([s for s, _ in sets]))), pa.array(signed(np.repeat(np.array([c for _, c in sets], np.uint64), [len(s) for s, _ in sets])))],
                    ["s", "c"],
                )

    rows = map_batches(source, run, "s bigint, c bigint").groupBy("s", "c").agg(F.lit(1).alias("one"))
    top = rows.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n >= 3").orderBy(F.desc("n"), "s").limit(FREQUENT).select("s").toPandas()
    return np.sort(top["s"].to_numpy(np.int64).view(np.uint64))


_SHORT_SKETCH = [f"s{i}" for i in range(SHORT_WORDS)]


def _sets_of(source: DataFrame, k: int) -> DataFrame:
    """``__id, n, c`` per row."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, classes = [], []
        for part in texts(batch.column(1)):
            for s in shingle_sets(part, k):
                sizes.append(len(s))
                classes.append(class_of(s))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(signed(np.array(classes, np.uint64)))], ["__id", "n", "c"])

    return map_batches(source, run, "__id bigint, n bigint, c bigint")


def _short_sketches(rows: DataFrame, k: int) -> DataFrame:
    """``c`` and the short sketch of some texts' classes, one row a class."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in texts(batch.column(1)):
            sets = [s for s in shingle_sets(part, k) if len(s)]
            if sets:
                words_of = np.stack([short_sketch(s) for s in sets])
                classes = pa.array(signed(np.array([class_of(s) for s in sets], np.uint64)))
                yield pa.RecordBatch.from_arrays([classes, *[pa.array(np.ascontiguousarray(words_of[:, i])) for i in range(SHORT_WORDS)]], ["c", *_SHORT_SKETCH])

    return map_batches(rows, run, "c bigint, " + ", ".join(f"{s} bigint" for s in _SHORT_SKETCH)).groupBy("c").agg(*[F.min(s).alias(s) for s in _SHORT_SKETCH])


def _keys(source: DataFrame, k: int, percent: int, frequent: np.ndarray, fine: frozenset[int] | None = None) -> DataFrame:
    """``key, c, info`` of the chosen blocks; a class met before in the same task is left out."""
    bounded_batches(source.sparkSession)
    sent = source.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in texts(batch.column(1)):
                keys, infos, classes, sizes = [], [], [], []
                for s in shingle_sets(part, k):
                    c = int(class_of(s))
                    if not len(s) or c in seen:
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(c)
                    key, info = band_keys(s, sent.value, percent, fine)
                    keys.append(key)
                    infos.append(info)
                    classes.append(c)
                    sizes.append(len(key))
                if keys:
                    owner = np.repeat(np.array(classes, np.uint64), sizes)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), pa.array(signed(owner)), pa.array(np.concatenate(infos))], ["key", "c", "info"])

    return source.mapInArrow(run, "key bigint, c bigint, info bigint")


def _field(at: int, width: int) -> Column:
    return F.shiftright("info", at).bitwiseAND(F.lit((1 << width) - 1))


def _unpacked(rows: DataFrame) -> DataFrame:
    """``key, c, place, n, single``; ``single`` tells groups of single bits from those of blocks."""
    return rows.select("key", "c", _field(_PLACE, 24).cast("int").alias("place"), _field(0, 26).cast("int").alias("n"), F.lit(False).alias("single"))


def _members(keys: DataFrame) -> DataFrame:
    """Key rows whose block another class has chosen too, each class once; rows of blocks that are frequent in the sample all stay.

    One shuffle of all key rows; the latter are salted in it, and so are the marks of sets with too many empty blocks.
    """
    salted = keys.withColumn("salt", F.when((_field(_COMMON, 1) == 1) | (_field(_SHORT, 1) == 1), F.pmod(F.xxhash64("c"), F.lit(SALTS)) + 1).otherwise(0))
    by_class = Window.partitionBy("key", "salt").orderBy("c")
    after, first = F.lead("c").over(by_class), F.first("c").over(by_class.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last_of_class = after.isNull() | (after != F.col("c"))
    alone = after.isNull() & (first == F.col("c"))
    return salted.withColumns({"last": last_of_class, "alone": alone}).where("last and (not alone or salt > 0)").select("key", "c", "info")


def _distinct_groups(members: DataFrame, order: list[Column], within: list[Column]) -> DataFrame:
    """``key, n`` of the groups with two members or more; of groups with equal members (and ``within``) the first in the common order."""
    counted = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("c").alias("least"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("one"),
        F.bit_xor(F.xxhash64("c", F.lit(2))).alias("two"), F.min(F.struct(*order, "key")).alias("order"), *[F.min(w).alias(f"w{i}") for i, w in enumerate(within)],
    )
    same = ["members", "least", "one", "two", *[f"w{i}" for i in range(len(within))]]
    return counted.where("members > 1").groupBy(*same).agg(F.min("order").alias("order")).select(F.col("order.key").alias("key"), "members")


def _few(df: DataFrame, wanted: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``column`` is wanted (or, anti, is not): by a list sent to all tasks while it is short, else by a join."""
    wanted = stored(wanted.distinct(), "jaccard-wanted")
    return df.join(F.broadcast(wanted) if wanted.count() <= SENT_IDS else wanted, column, how)


def _texts_of(source: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of each wanted class, more where its id is repeated."""
    return _few(source, _few(classes, wanted, "c").select(F.col("first").alias("__id")), "__id")


def _groups(source: DataFrame, classes: DataFrame, k: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """``key, c, place, n, single`` of all groups to be compared."""
    members = stored(_members(_keys(source, k, percent, frequent)), "jaccard-members")
    short = members.where(_field(_SHORT, 1) == 1).select("key").distinct().collect()  # bands, at most 26
    parts = [members.where(_field(_SHORT, 1) == 0)]
    if short:
        fine = frozenset(int(r["key"]) for r in short)
        parts.append(stored(_members(_keys(source, k, percent, frequent, fine)), "jaccard-members"))
    small, hot = [], []
    for part in parts:
        order = [_field(_COMMON, 1).alias("common"), (-_field(_BITS, 6)).alias("bits")]
        kept = stored(_distinct_groups(part, order, [_field(_BAND, 5)]), "jaccard-keys")
        small.append(_unpacked(part.join(kept.where(F.col("members") <= HOT).select("key"), "key")))
        hot.append(part.join(kept.where(F.col("members") > HOT).select("key"), "key").select("c"))
    again = _chosen_again(_texts_of(source, classes, reduce(DataFrame.unionByName, hot)), k, percent)
    return reduce(DataFrame.unionByName, small).unionByName(again)


def _chosen_again(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """The bits these texts choose when they put them from rare to frequent among themselves: ``key, c, place, n, single``.

    Bits nobody else has come first; they are counted, not kept. A text that is there twice counts twice for all, which
    is an order like any other, and has equal bits at equal places.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in texts(batch.column(1)):
            sets = [s for s in shingle_sets(part, k) if len(s)]
            if sets:
                size = [len(s) for s in sets]
                owner = np.repeat(np.array([class_of(s) for s in sets], np.uint64), size)
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(sets))), pa.array(signed(owner)), pa.array(np.repeat(size, size).astype(np.int32))], ["s", "c", "n"])

    bits = stored(map_batches(rows, run, "s bigint, c bigint, n int"), "jaccard-bits")
    often = bits.groupBy("s").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = bits.join(often, "s").withColumn("key", F.xxhash64("s", F.lit(3)))
    in_order = Window.partitionBy("c").orderBy("often", "key")
    ranked = shared.withColumn("rank", F.dense_rank().over(in_order)).withColumn("shared", F.max("rank").over(Window.partitionBy("c")))
    placed = ranked.withColumn("place", F.col("n") - F.col("shared") + F.col("rank") - 1)
    chosen = placed.where(F.col("place") < F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) + 1)
    members = stored(chosen.select("key", "c", "place", "n", "often").distinct(), "jaccard-again")
    kept = _distinct_groups(members, [F.col("often")], [])
    return members.join(kept.select("key"), "key").select("key", "c", "place", "n", F.lit(True).alias("single"))


def _can_link(percent: int) -> Column:
    """Whether two members (``n, place`` and ``pn, pplace``) of a group may be linked and have its block, or its bit, as their first."""
    total = F.col("n").cast("bigint") + F.col("pn")
    share = F.ceil(total * F.lit(percent) / F.lit(100 + percent))
    bits = (F.col("place") <= F.col("n") - share) & (F.col("pplace") <= F.col("pn") - share) & (F.col("place") + F.col("pplace") <= total - 2 * share)
    return (F.least("n", "pn") >= share) & F.when(F.col("single"), bits).otherwise(F.greatest("place", "pplace") <= total - 2 * share)


def _near(percent: int) -> Column:
    """Whether the short sketches of two members allow a link: they differ in no more bits than the sets in shingles."""
    far = reduce(Column.__add__, [F.bit_count(F.col(s).bitwiseXOR(F.col(f"p{s}"))) for s in _SHORT_SKETCH])
    return far * (100 + percent) <= (F.col("n").cast("bigint") + F.col("pn")) * (100 - percent)


def _pairs(members: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """``a, b`` distinct, of members and the pivots of their groups; with roots and short sketches, as far as these allow."""
    carried = {"root": "other", **{s: f"p{s}" for s in _SHORT_SKETCH}} if "root" in pivots.columns else {}
    met = members.join(pivots.select("key", F.col("c").alias("p"), F.col("n").alias("pn"), F.col("place").alias("pplace"), *[F.col(a).alias(b) for a, b in carried.items()]), "key")
    met = met.where("c != p").where(_can_link(percent))
    if carried:
        met = met.where("root != other").where(_near(percent))
    return met.select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()


def _class_sets(rows: DataFrame, k: int) -> DataFrame:
    """``c, n, sketch, shingles`` of some texts; a class may come several times."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in texts(batch.column(1)):
            sets = [s for s in shingle_sets(part, k) if len(s)]
            if sets:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(np.array([class_of(s) for s in sets], np.uint64))), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([narrow_sketch(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["c", "n", "sketch", "shingles"],
                )

    return map_batches(rows, run, "c bigint, n bigint, sketch binary, shingles binary")


def _allowed(percent: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for i in (4, 5))
        far = np.bitwise_count(a ^ b).sum(axis=1).astype(np.int64)
        m, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        fits = (100 * np.minimum(m, n) >= percent * np.maximum(m, n)) & (far <= (m + n) * (100 - percent) // (100 + percent))
        yield batch.select(["a", "b"]).filter(pa.array(fits))

    return run


def _linked(percent: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(a) + len(b) - len(np.union1d(a, b))
            keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, source: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs that are linked. Sets are read from the texts of the compared classes and move only for pairs the sketches allow."""
    ends = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c")))
    sets = stored(_class_sets(_texts_of(source, classes, ends), k), "jaccard-class-sets")
    short = sets.select("c", "n", "sketch")
    one = short.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = short.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    near = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb")
    near = stored(map_batches(near, _allowed(percent), "a bigint, b bigint"), "jaccard-near")
    full = _few(sets.select("c", "shingles"), near.select(F.col("a").alias("c")).unionByName(near.select(F.col("b").alias("c"))), "c")
    both = near.join(full.select(F.col("c").alias("a"), F.col("shingles").alias("x")), "a").join(full.select(F.col("c").alias("b"), F.col("shingles").alias("y")), "b")
    return stored(map_batches(both.select("a", "b", "x", "y"), _linked(percent), "a bigint, b bigint").distinct(), "jaccard-links")


def _first_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Every class with the pivot of its first group: the member that has the group's bit at the smallest place."""
    pivots = groups.groupBy("key").agg(F.min(F.struct("place", F.xxhash64("c").alias("h"), "c", "n")).alias("p")).select("key", "p.c", "p.place", "p.n")
    first = groups.groupBy("c").agg(F.min(F.struct("place", "key", "n", "single")).alias("f")).select("c", "f.key", "f.place", "f.n", "f.single")
    return _pairs(first, pivots, percent)


def _pivots(members: DataFrame, count: int) -> DataFrame:
    """All members of groups of up to ``HOT``; of larger ones up to ``count``, of the smallest components first: they have the fewest partners left."""
    sizes = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    order = Window.partitionBy("key").orderBy("size", "place", F.xxhash64("c"), "c")
    first = members.join(sizes, ["key", "root"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max(count, HOT))
    if count >= HOT:
        return first.select("key", "c", "place", "n", "root", *_SHORT_SKETCH)
    small = members.groupBy("key").agg((F.count(F.lit(1)) <= HOT).alias("small"))
    return first.join(small, "key").where((F.col("rank") <= count) | F.col("small")).select("key", "c", "place", "n", "root", *_SHORT_SKETCH)


def _main_pivots(members: DataFrame, count: int) -> DataFrame:
    """Up to ``count`` members of each group's largest component, those first whose places allow the most pairs."""
    sizes = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("size", "root")).alias("top")).select("key", F.col("top.root").alias("root"))
    order = Window.partitionBy("key").orderBy("place", F.xxhash64("c"), "c")
    chosen = members.join(largest, ["key", "root"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return chosen.select("key", "c", "place", "n", "root", *_SHORT_SKETCH)


def _class_components(groups: DataFrame, source: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """``v, root`` over classes: compares pivots with the other members of each group until nothing is left to compare."""
    done = stored(_first_pairs(groups, percent), "jaccard-pairs")
    roots = components(_verified(done, source, classes, k, percent))
    members, count, first, sketches = groups, PIVOTS, list(FIRST), None
    while True:
        members = members.select("key", "c", "place", "n", "single", *([] if sketches is None else _SHORT_SKETCH)).join(roots.withColumnRenamed("v", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
        open_ = members.groupBy("key").agg((F.min("root") != F.max("root")).alias("open")).where("open").select("key")
        members = stored(members.join(open_, "key"), "jaccard-members")
        if members.limit(1).count() == 0:
            return roots
        if sketches is None:  # read for the classes of open groups alone
            sketches = stored(_short_sketches(_texts_of(source, classes, members.select("c")), k), "jaccard-short")
            members = stored(members.join(sketches, "c"), "jaccard-members")
        main = first.pop(0) if first else 0
        pivots = stored(_main_pivots(members, main) if main else _pivots(members, count), "jaccard-pivots")
        pairs = stored(_pairs(members, pivots, percent).join(done, ["a", "b"], "left_anti"), "jaccard-pairs")
        if pairs.limit(1).count():
            done = done.unionByName(pairs)
            found = _verified(pairs, source, classes, k, percent)
            if found.limit(1).count():
                roots = _merged(roots, found)
        # A pivot has met all members of other components: it need not stay.
        members = members.join(pivots.select("key", "c"), ["key", "c"], "left_anti").drop("root")
        if not main:
            count *= PIVOTS


def _merged(roots: DataFrame, found: DataFrame) -> DataFrame:
    """Components after some more links: those between components are few, so only their roots are joined up."""
    ends = found.select("a").unionByName(found.select(F.col("b").alias("a"))).distinct()
    root = stored(ends.join(roots.withColumnRenamed("v", "a"), "a", "left").withColumn("root", F.coalesce("root", "a")), "jaccard-ends")
    between = found.join(root, "a").select("b", F.col("root").alias("x")).join(root.withColumnRenamed("a", "b"), "b").select(F.col("x").alias("a"), F.col("root").alias("b"))
    joined = components(between).select(F.col("v").alias("root"), F.col("root").alias("top"))
    every = roots.unionByName(root.select(F.col("a").alias("v"), "root")).distinct()
    return stored(every.join(joined, "root", "left").select("v", F.coalesce("top", "root").alias("root")), "jaccard-roots")


def ngram_jaccard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, percent: int = PERCENT, sample: int = SAMPLE) -> DataFrame:
    """Per row: ``id, n_shingles, component_id``."""
    low = -(1 << 63)
    source = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(low)).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    frequent = _frequent_shingles(source, k, sample)
    with scratch(docs.sparkSession):
        rows = stored(_sets_of(source, k), "jaccard-sets")
        classes = stored(
            rows.where("n > 0").groupBy("c").agg(F.min("__id").alias("first"), F.min(F.when(F.col("__id") > low, F.col("__id"))).alias("name")), "jaccard-classes"
        )
        groups = stored(_groups(source, classes, k, percent, frequent), "jaccard-groups")
        roots = _class_components(groups, source, classes, k, percent)
        rooted = classes.join(roots.withColumnRenamed("v", "c"), "c", "left").select("c", F.coalesce("root", "c").alias("root"), "name")
        names = rooted.groupBy("root").agg(F.min("name").alias("component_id"))
        named = rooted.join(names, "root").select("c", "component_id")
        own = F.when(F.col("__id") > low, F.col("__id"))
        found = rows.join(named, "c", "left").select(
            own.alias(id_col), F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(own).alias("component_id"),
        )
        return stored(found, "jaccard-result", keep=True)


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that name their component, all columns unchanged.

    Rows that share an id stay or go together, and stay if one of them names its component; rows with a NULL id stay.
    """
    found = ngram_jaccard(docs, id_col, text_col).where(F.col(id_col).isNotNull())
    named = found.groupBy(F.col(id_col).alias("__id")).agg(F.max((F.col("component_id") == F.col(id_col)).cast("int")).alias("__names"))
    row = docs.select(F.col(id_col).cast("bigint").alias("__id"), F.struct("*").alias("__row"))
    return _few(row, named.where("__names = 0").select("__id"), "__id", "left_anti").select("__row.*")
