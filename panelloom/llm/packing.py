"""Packing into training sequences as vector bin packing.

An example is a vector of tokens, segments and loss-bearing tokens. A sequence is filled one example at a time: of the
waiting examples that fit, the one with the largest dot product with what is left in the sequence (each dimension
relative to its limit) goes in. When none fits, one is cut at what is left, so a sequence ends full unless its
segment or loss limit is reached. The last sequence of a task is cut into powers of two and needs no padding.

Each task packs the rows of its own input split with a bounded pool of waiting examples, so nothing is shuffled and
nothing passes through one place. Padding is possible only where the segment or loss limit binds.

Token ids come from the given tokenizer. Its pre-tokenizer never joins text across ASCII white space, so words are
encoded once per batch and remembered in a bounded table: lower-cased letters, a trailing full stop or comma apart.

Defined results: NULL and empty text is the end id alone; a text longer than a sequence is cut; repeated rows are
packed as often as they occur; no rows give no sequences.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from panelloom.llm.arrays import CHUNK_BYTES, LOWER, Memo, Texts, cut, ranges, span_hash, texts, words
from panelloom.llm.frames import bounded_batches

KEPT_WORDS = 300_000
TEXT_BYTES = CHUNK_BYTES // 2  # of text encoded at once; its words take some 100 times as much
PIECES = 250  # sent back at once, at most 4 MB of ids
POOL = 128
SCHEMA = "start bigint, length bigint, ids binary, loss_tokens bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_tokenizers: dict[str, WordTokenizer] = {}

# Bytes a simple word consists of: a-z, and the two-byte letters U+00DF to U+00FF without the division sign.
_FIRST, _SECOND = np.zeros(256, bool), np.zeros(256, bool)
_FIRST[97:123] = True
_SECOND[0x9F:0xC0] = True
_SECOND[0xB7] = False


class WordTokenizer:
    """The ids of words under a tokenizer whose pre-tokenizer drops white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._whole = Tokenizer.from_file(path)
        # Special tokens printed in a text are taken out before words are cut; a word that only looks like one in lower case is none.
        self._whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        special = {t["content"].encode("utf-8"): t["id"] for t in config["added_tokens"] if t["content"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in config["added_tokens"]):
            raise ValueError("added tokens that take white space, need word ends or a normalized text are not supported")
        self._special = {content: np.array([i], np.uint32) for content, i in special.items()}
        self._printed = re.compile(b"|".join(re.escape(c) for c in sorted(special, key=len, reverse=True))) if special else None
        # For words of lower-case letters the normalizer and the pattern do nothing: skip them. The model is held once.
        self._letters = Tokenizer(self._whole.model)
        self._letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)]
        )
        self.mark = {c: self._ids(c.decode()) for c in (b".", b",")}
        self.kept = Memo(KEPT_WORDS)
        suffix = config["model"]["end_of_word_suffix"]
        vocabulary = self._whole.get_vocab()
        self._ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn_letters(self, hashes: np.ndarray, strings: list[bytes]) -> None:
        lines = [b" ".join(strings[i : i + 500]).decode("utf-8") for i in range(0, len(strings), 500)]
        done = self._letters.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.array([i for line in done for i in line.ids], np.int64)
        last = np.flatnonzero(self._ends_word[ids])
        self.kept.add(hashes, ids, np.diff(np.append(-1, last)))

    def _learn_other(self, hashes: np.ndarray, strings: list[bytes]) -> None:
        done = [x.ids for x in self._whole.encode_batch_fast([w.decode("utf-8") for w in strings], add_special_tokens=False)]
        self.kept.add(hashes, np.array([i for ids in done for i in ids], np.int32), np.array([len(ids) for ids in done]))

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, simple: np.ndarray) -> None:
        new = self.kept.missing(hashes)
        for chosen, learn in ((new & simple, self._learn_letters), (new & ~simple, self._learn_other)):
            at = np.flatnonzero(chosen)
            for i in range(0, len(at), 20_000):
                part = at[i : i + 20_000]
                learn(hashes[part], cut(data, starts[part], ends[part]))

    def column(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each row of a text column, in bounded memory."""
        for part in texts(column, TEXT_BYTES):
            yield from self.rows(part)

    def rows(self, part: Texts) -> Iterator[np.ndarray]:
        """The ids of each row, special tokens included where the text has them in print."""
        body = part.data.tobytes()
        if self._printed is None or not any(content in body for content in self._special):
            yield from self._plain_rows(part)
            return
        pieces, specials, first = [], [], [0]
        for a, b in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), strict=True):
            text, done = body[a:b], 0
            for m in self._printed.finditer(text):
                pieces.append(text[done : m.start()])
                specials.append(self._special[m.group()])
                done = m.end()
            pieces.append(text[done:])
            specials.append(np.zeros(0, np.uint32))
            first.append(len(pieces))
        offsets = np.cumsum([0, *map(len, pieces)])
        ids = self._plain_rows(Texts(0, np.frombuffer(b"".join(pieces), np.uint8), offsets))
        for a, b in zip(first[:-1], first[1:], strict=True):
            yield np.concatenate([x for i in range(a, b) for x in (next(ids), specials[i])])

    def _plain_rows(self, part: Texts) -> Iterator[np.ndarray]:
        data = LOWER[part.data]
        w = words(Texts(part.first, data, part.offsets))
        letter = _FIRST[data]
        pair = np.zeros(len(data), bool)
        pair[:-1] = (data[:-1] == 0xC3) & _SECOND[data[1:]]
        letter |= pair
        letter[1:] |= pair[:-1]
        bad = np.append(0, np.cumsum(~letter))
        last = np.maximum(w.ends - 1, 0)
        marked = np.isin(data[last], [0x2E, 0x2C]) & (w.ends - w.starts > 1) & (bad[last] == bad[w.starts])
        ends = w.ends - marked
        simple = bad[ends] == bad[w.starts]
        hashes, sample, inverse = np.unique(span_hash(data, w.starts, ends), return_index=True, return_inverse=True)
        self._learn(hashes, data, w.starts[sample], ends[sample], simple[sample])
        place, sizes = self.kept.find(hashes)
        flat = np.concatenate([self.mark[b"."], self.mark[b","], self.kept.ids.view(np.uint32)])
        dot, comma = len(self.mark[b"."]), len(self.mark[b","])
        place = np.concatenate([place + dot + comma, [0, dot, 0]])
        sizes = np.concatenate([sizes, [dot, comma, 0]])
        # Word and mark take turns; a word without a mark is followed by the empty entry.
        turns = np.empty(2 * len(inverse), np.int64)
        turns[::2] = inverse
        turns[1::2] = np.where(marked, np.where(data[last] == 0x2E, len(hashes), len(hashes) + 1), len(hashes) + 2)
        ids = flat[ranges(place[turns], sizes[turns])] if len(turns) else flat[:0]
        until = np.append(0, np.cumsum(sizes[turns]))[2 * w.first]
        for a, b in zip(until[:-1], until[1:], strict=True):
            yield ids[a:b]


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


class Packer:
    """Sequences from a stream of examples, with at most ``POOL`` examples waiting."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, first_id: int):
        self.limits = np.array([max_tokens, max_segments, max_loss], float)
        self.next_id = first_id
        self.items: list[tuple] = []  # id, start, ids, loss tokens at its end, tokens of its document
        self.sizes = np.zeros((0, 3))

    def add(self, doc: int | None, ids: np.ndarray, loss: int) -> Iterator[tuple]:
        self._wait((doc, 0, ids, min(loss, len(ids)), len(ids)))
        while len(self.items) >= POOL or (self.items and self.sizes[:, 0].sum() > POOL * self.limits[0]):
            yield from self._sequence()

    def finish(self) -> Iterator[tuple]:
        while self.items:
            yield from self._sequence()

    def _wait(self, item: tuple) -> None:
        self.items.append(item)
        self.sizes = np.vstack([self.sizes, [len(item[2]), 1, item[3]]])

    def _take(self, i: int) -> tuple:
        item = self.items[i]
        self.items[i] = self.items[-1]
        self.items.pop()
        self.sizes[i] = self.sizes[-1]
        self.sizes = self.sizes[:-1]
        return item

    def _head(self, item: tuple, left: np.ndarray) -> int:
        """How many ids of the item's start fit into what is left."""
        free = len(item[2]) - item[3]  # ids before the loss-bearing ones
        return int(min(left[0], free + left[2], len(item[2])))

    def _sequence(self) -> Iterator[tuple]:
        left, chosen = self.limits.copy(), []
        while self.items and left[0] >= 1 and left[1] >= 1:
            fits = (self.sizes <= left).all(axis=1)
            gain = (self.sizes / self.limits) @ (left / self.limits)
            if fits.any():
                item = self._take(int(np.where(fits, gain, -1).argmax()))
            else:
                order = np.argsort(-gain, kind="stable")
                cut = next(((i, n) for i in order.tolist() if (n := self._head(self.items[i], left)) > 0), None)
                if cut is None:
                    break
                doc, start, ids, loss, total = self._take(cut[0])
                n = cut[1]
                rest = min(loss, len(ids) - n)
                item = (doc, start, ids[:n], loss - rest, total)
                self._wait((doc, start + n, ids[n:], rest, total))
            chosen.append(item)
            left -= [len(item[2]), 1, item[3]]
        # At the end of the stream: powers of two instead of padding.
        filled = int(self.limits[0] - left[0])
        parts = [filled] if self.items or filled == int(self.limits[0]) else [1 << b for b in range(filled.bit_length() - 1, -1, -1) if filled >> b & 1]
        offset = 0
        for doc, start, ids, loss, total in chosen:
            while len(ids):
                n = min(len(ids), parts[0] - offset)
                rest = min(loss, len(ids) - n)
                yield doc, start, n, ids[:n].astype("<u4").tobytes(), loss - rest, total, self.next_id, offset
                start, ids, loss, offset = start + n, ids[n:], rest, offset + n
                if offset == parts[0]:
                    parts, offset, self.next_id = parts[1:], 0, self.next_id + 1
        if offset:
            self.next_id += 1


def pack(
    docs: DataFrame,
    path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_col: str | None = None,
    max_tokens: int = 4096,
    max_segments: int = 1024,
    max_loss: int | None = None,
) -> DataFrame:
    """Pieces of documents placed in sequences; ``ids`` are little-endian unsigned 32-bit numbers.

    ``loss_col`` tells how many tokens at a document's end bear loss (NULL or no column: all of them).
    """
    bounded_batches(docs.sparkSession)
    loss = F.col(loss_col).cast("bigint") if loss_col else F.lit(None).cast("bigint")
    source = docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).cast("string"), loss.alias("__loss"))
    names = [id_col, *[c.split()[0] for c in SCHEMA.split(", ")]]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(max_tokens, max_segments, max_loss or max_tokens, TaskContext.get().partitionId() << 33)
        words_of = tokenizer(path)
        out: list[tuple] = []
        for batch in batches:
            id_list, loss_list = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, ids in enumerate(words_of.column(batch.column(1))):
                ids = np.append(ids, np.uint32(end_id))
                out += packer.add(id_list[i], ids, len(ids) if loss_list[i] is None else max(0, loss_list[i]))
                if len(out) >= PIECES:
                    yield batch_of(out)
                    out = []
        out += packer.finish()
        if out:
            yield batch_of(out)

    return source.mapInArrow(run, f"`{id_col}` bigint, {SCHEMA}")


def padding(pieces: DataFrame, max_tokens: int = 4096) -> DataFrame:
    """Tokens and padding over all sequences; a power of two is not padded."""
    filled = pieces.groupBy("sequence_id").agg(F.sum("length").alias("filled"))
    power = F.bit_count(F.col("filled")) == 1
    return filled.agg(
        F.count(F.lit(1)).alias("sequences"), F.sum("filled").alias("tokens"),
        F.sum(F.when(power, 0).otherwise(max_tokens - F.col("filled"))).alias("padding"),
    )


