"""Substring dedup over words by de Bruijn compaction.

A window of ``k`` words is an edge of the de Bruijn graph (its first and last ``k - 1`` words are the nodes it joins). A
word goes if it is covered by a window whose words also start anywhere else, in the same text or another.

1. *Edges, packed.* The smallest hash among the ``m``-word runs inside a window is its minimizer. Consecutive windows of
   a text with one minimizer form a super-k-mer: a path of edges packed into one row. Equal windows have equal
   minimizers at equal distance, so all their copies meet under one minimizer. There is one row per about a third of
   ``k`` words, and all but the rows of repeated minimizers end after the first aggregate.
2. *Compaction.* Super-k-mers that repeat as a whole are the solid vertices of the packed graph; two that follow each
   other in a text are linked. Where both ends of a link are unambiguous the path does not branch; runs inside one
   text are joined first, then pointer doubling (a join per round) carries every vertex to the head of its path.
3. *Spans.* Occurrences of a path in the texts become spans of source coordinates.
4. *Verification.* Where texts share a minimizer but not the whole super-k-mer (the ends of repeated spans), the windows
   themselves are read at their source coordinates and compared one by one.

A vertex is identified by two independent 64-bit hashes (minimizer, whole content), a window by minimizer and content.
Groups are only ever counted (partial aggregates) or joined with a key's single summary row, so copies of any number never meet in
one task unsplit.

Defined results: NULL text has no words; texts shorter than ``k`` words keep everything; repeated rows are copies of each
other like any two texts; rows with a NULL id take part under one id; only columns named in the call are read, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.arrays import Rolling, mix, ranges, signed, span_hash, texts, words
from panelloom.llm.frames import map_batches, scratch, stored

K = 35
M = 12
SENT_SPANS = 1_000_000  # spans and texts that have some, sent to all tasks instead of moving texts; some 50 bytes each
MARKS = 1 << 20  # words of 64 marks, sent to all tasks to tell which texts need not move; some 32 bytes each
_ROW = ["__id", "__th"]
_VERTEX = ["__h", "__e"]


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value of each run of ``width`` values."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:-step], at[step:]
        at, have = np.where(values[b] < values[a], b, a), have + step
    return at


def _super_kmers(k: int, m: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in texts(batch.column(2)):
            w = words(part)
            if len(w.starts) < k:
                continue
            roll = Rolling(span_hash(part.data, w.starts, w.ends))
            seeds = roll.windows(m)
            at = _smallest(seeds, k - m + 1)
            row = np.searchsorted(w.first, np.arange(len(at)), side="right") - 1
            start = np.flatnonzero(np.arange(len(at)) + k <= w.first[row + 1])
            if not len(start):
                continue
            seed, row = at[start], row[start]
            new = np.ones(len(start), bool)
            new[1:] = (seed[1:] != seed[:-1]) | (row[1:] != row[:-1])
            head = np.flatnonzero(new)
            low, high = start[head], start[np.append(head[1:], len(start)) - 1]
            seed, row = seed[head], row[head]
            with np.errstate(over="ignore"):
                content = mix(roll.runs(low, high + k) ^ ((seed - low).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
            take = pa.array(part.first + row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(seeds[seed])), pa.array(signed(content)), batch.column(0).take(take), batch.column(1).take(take),
                    pa.array((low - w.first[row]).astype(np.int32)), pa.array((high - w.first[row]).astype(np.int32)),
                ],
                ["__h", "__e", "__id", "__th", "__lo", "__hi"],
            )

    return run


def _windows_at(k: int):
    """Hash of every window of the listed super-k-mers, read from the text."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column(3)
        flat, sizes = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
        until = np.append(0, np.cumsum(sizes))
        low, high, weight, seed = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        for part in texts(batch.column(2)):
            n = len(part.offsets) - 1
            w = words(part)
            hashes = Rolling(span_hash(part.data, w.starts, w.ends)).windows(k)
            own = np.arange(until[part.first], until[part.first + n])
            row = np.repeat(np.arange(n), sizes[part.first : part.first + n])
            length = (high[own] - low[own] + 1).astype(np.int64)
            place = ranges(low[own].astype(np.int64), length)
            row = np.repeat(row, length)
            take = pa.array(part.first + row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(seed[own], length)), pa.array(signed(hashes[place + w.first[row]])), batch.column(0).take(take),
                    batch.column(1).take(take), pa.array(place.astype(np.int32)), pa.array(np.repeat(weight[own], length)),
                ],
                ["__h", "__w", "__id", "__th", "__lo", "__weight"],
            )

    return run


def _marked(rows: DataFrame, keys: DataFrame, n: int, how: str) -> DataFrame:
    """``left_semi``: the rows whose text may be among ``n`` keys; ``left_anti``: those whose text is surely not.

    Each key sets one of at least 16 marks a key, up to ``64 * MARKS``; beyond, more rows that are no keys pass for keys.
    """
    words = min(MARKS, 1 << max(4, (n // 4).bit_length()))
    place = F.xxhash64(*_ROW)
    keys = keys.select(F.pmod(place, F.lit(words)).alias("__slot"), F.shiftrightunsigned(place, 58).cast("int").alias("__bit"))
    marks = keys.groupBy("__slot").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__marks"))
    here = (F.pmod(place, F.lit(words)) == F.col("__slot")) & (F.getbit("__marks", F.shiftrightunsigned(place, 58).cast("int")) == 1)
    return rows.join(F.broadcast(marks), here, how)


def _paths(spots: DataFrame) -> DataFrame:
    """Solid vertices on non-branching paths: ``__h, __e``, the path's head ``__ph, __pe`` and the distance ``__rank`` from it."""
    in_text = Window.partitionBy(*_ROW).orderBy("__lo")
    here = F.struct(*_VERTEX)
    before = F.when(F.lag("__hi").over(in_text) + 1 == F.col("__lo"), F.lag(here).over(in_text))
    walks = stored(spots.select(*_ROW, "__lo", here.alias("v"), before.alias("u")), "substring-walks")
    links = walks.where("u is not null and u != v").groupBy("u", "v").agg(F.count(F.lit(1)).alias("n"))
    onward = links.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("v")).where("n = 1").select("u", "v")
    back = links.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("u")).where("n = 1").select("u", "v")
    chain = stored(onward.join(back, ["u", "v"]), "substring-chain")
    # Inside one text a run of such links is walked at once: each vertex learns of one far before it.
    marked = walks.join(chain.withColumn("linked", F.lit(True)), ["u", "v"], "left")
    numbered = marked.withColumn("run", F.sum(F.when(F.col("linked"), 0).otherwise(1)).over(in_text))
    in_run = Window.partitionBy(*_ROW, "run").orderBy("__lo")
    local = numbered.select("v", F.first("v").over(in_run).alias("p"), (F.row_number().over(in_run) - 1).cast("long").alias("d"))
    pointers = stored(local.groupBy("v").agg(F.max_by("p", "d").alias("p"), F.max("d").alias("d")), "substring-pointers")
    open_before = None
    while True:
        # A pointer is at its end when the vertex it names points at itself. Vertices of a cycle never get there;
        # every other path comes nearer to its head in each round, so an unchanged count leaves only cycles.
        target = pointers.select(F.col("v").alias("p"), F.col("p").alias("pp"), F.col("d").alias("dd"))
        pointers = stored(
            pointers.join(target, "p").select("v", F.col("pp").alias("p"), (F.col("d") + F.col("dd")).alias("d"), (F.col("dd") > 0).alias("open")),
            "substring-pointers",
        )
        open_now = pointers.where("open").count()
        if open_now in (0, open_before):
            break
        open_before = open_now
        pointers = pointers.drop("open")
    return pointers.where("not open").select(
        F.col("v.__h").alias("__h"), F.col("v.__e").alias("__e"), F.col("p.__h").alias("__ph"), F.col("p.__e").alias("__pe"), F.col("d").alias("__rank")
    )


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("__id"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("__th"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"),
        F.struct("*").alias("__row"),
    )


def repeated_spans(source: DataFrame, k: int = K, m: int = M) -> DataFrame:
    """Spans of words that repeated windows cover: ``__id, __th, start, end``; they may overlap."""
    rows = source.select("__id", "__th", "__text")
    kmers = map_batches(rows, _super_kmers(k, m), "__h bigint, __e bigint, __id bigint, __th bigint, __lo int, __hi int")
    seeds = kmers.groupBy("__h").agg(F.count(F.lit(1)).alias("n"), (F.min("__e") != F.max("__e")).alias("__mixed")).where("n > 1").drop("n")
    # Stored first, so that both sides of the join are plain exchanges and adaptive execution can split a hot minimizer.
    found = stored(kmers.join(stored(seeds, "substring-seeds"), "__h"), "substring-kmers")
    vertices = found.groupBy(*_VERTEX).agg(
        F.count(F.lit(1)).alias("__n"), F.min(F.struct("__id", "__th", "__lo", "__hi")).alias("__first"), F.first("__mixed").alias("__mixed")
    )
    vertices = stored(vertices, "substring-vertices")
    # Stored as well: what follows joins it by vertex again, and a hot vertex can be split only where an exchange comes first.
    spots = stored(found.join(vertices.where("__n > 1").select(*_VERTEX), _VERTEX), "substring-spots")
    in_text = Window.partitionBy(*_ROW).orderBy("__lo")
    placed = spots.join(_paths(spots), _VERTEX, "left").select(
        *_ROW, "__lo", "__hi", (F.row_number().over(in_text) - F.col("__rank")).alias("__shift"),
        F.when(F.col("__rank").isNull(), F.col("__lo")).alias("__alone"), "__ph", "__pe",
    )
    # A text runs along a path while place and rank advance together and no word is left out.
    joined = F.when(F.lag("__hi").over(in_text) + 1 == F.col("__lo"), 0).otherwise(1)
    spans = placed.withColumn("__gap", joined).withColumn("__run", F.sum("__gap").over(in_text))
    spans = spans.groupBy(*_ROW, "__ph", "__pe", "__shift", "__alone", "__run").agg(F.min("__lo").alias("start"), (F.max("__hi") + k).alias("end"))
    # Both kinds of ends: what is there once, and one source of each content that is there more often.
    once = vertices.where("__mixed and __n = 1").select("__first.*", F.lit(1).alias("__weight"), "__h")
    more = vertices.where("__mixed and __n > 1").select("__first.*", F.lit(2).alias("__weight"), "__h")
    to_read = once.unionByName(more)
    listed = to_read.groupBy(*_ROW).agg(F.collect_list(F.struct("__lo", "__hi", "__weight", "__h")).alias("__list"))
    texts_to_read = to_read.agg(F.approx_count_distinct(F.struct(*_ROW))).first()[0]
    read = _marked(rows, to_read, texts_to_read, "left_semi").join(listed, _ROW).select("__id", "__th", "__text", "__list")
    windows = map_batches(read, _windows_at(k), "__h bigint, __w bigint, __id bigint, __th bigint, __lo int, __weight int")
    windows = stored(windows, "substring-windows")
    same = windows.groupBy("__h", "__w").agg(F.sum("__weight").alias("n"), F.min("__weight").alias("least")).where("n > 1 and least = 1")
    ends = windows.where("__weight = 1").join(same, ["__h", "__w"]).select(*_ROW, F.col("__lo").alias("start"), (F.col("__lo") + k).alias("end"))
    return spans.select(*_ROW, "start", "end").unionByName(ends)


def _removed(kind: str):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column(1)
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        until = np.append(0, np.cumsum(sizes))
        flat = lists.flatten()
        start, end = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
        counts, gone, kept = [], [], []
        for part in texts(batch.column(0)):
            w = words(part)
            body = part.data.tobytes()
            for i in range(len(part.offsets) - 1):
                a, b = int(w.first[i]), int(w.first[i + 1])
                own = slice(until[part.first + i], until[part.first + i + 1])
                depth = np.zeros(b - a + 1, np.int64)
                np.add.at(depth, start[own], 1)
                np.add.at(depth, end[own], -1)
                stay = np.flatnonzero(np.cumsum(depth)[:-1] == 0) + a
                counts.append(b - a)
                gone.append(b - a - len(stay))
                kept.append(b" ".join([body[s:e] for s, e in zip(w.starts[stay].tolist(), w.ends[stay].tolist(), strict=True)]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["__row", "n_words", "n_removed", "kept"],
        )

    return run, f"__row {kind}, n_words bigint, n_removed bigint, kept string"


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, m: int = M) -> DataFrame:
    """Per row: the input row as ``__row``, ``n_words``, ``n_removed`` and ``kept`` (the other words joined by blanks)."""
    source = _source(docs, id_col, text_col)
    with scratch(docs.sparkSession):
        spans = repeated_spans(source, k, m).groupBy(*_ROW).agg(F.collect_list(F.struct("start", "end")).alias("__spans"))
        spans = stored(spans, "substring-spans", keep=True)
    size = spans.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("__spans")).alias("spans")).first()
    small = size["rows"] + (size["spans"] or 0) <= SENT_SPANS
    # Spans go to the texts while they are few; beyond that a text that may have some moves once, inside its row.
    rows = source.select(*_ROW, "__row")
    if small:
        joined = rows.join(F.broadcast(spans), _ROW, "left")
    else:
        moved = _marked(rows, spans, size["rows"], "left_semi").join(spans, _ROW, "left")
        joined = moved.unionByName(_marked(rows, spans, size["rows"], "left_anti").withColumn("__spans", F.lit(None).cast(spans.schema["__spans"].dataType)))
    text = F.coalesce(F.col("__row")[text_col].cast("string"), F.lit(""))
    return map_batches(joined.select(text.alias("__text"), "__spans", "__row"), *_removed(source.schema["__row"].dataType.simpleString()))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, m: int = M) -> DataFrame:
    """``docs`` without the repeated words; rows that lose nothing are unchanged. ``n_chars`` follows the text where there is one."""
    out = substring_dedup(docs, id_col, text_col, k, m)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(f"__row.{text_col}"))
    changed = {text_col: text}
    if "n_chars" in docs.columns and text_col != "n_chars":
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("__row.n_chars"))
    return out.select(*[changed[c].alias(c) if c in changed else F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
