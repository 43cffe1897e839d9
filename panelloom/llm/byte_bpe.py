"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is cut into pieces by the public pattern and each piece is encoded by itself. A piece longer than a leaf is
halved, the halves are encoded, and two encodings are joined by re-encoding a window around the seam. A token row is
the encoding of its bytes exactly when every two neighbours encode to themselves, so the seam is done as soon as the
tokens left and right of the window are stable against the window's first and last token; until then the window
doubles. Leaves are merged many at a time with numpy. Decoding concatenates up the same tree.

Work is per text and needs no shuffle. Equal pieces of a batch are encoded once, and each worker keeps a bounded table
of pieces it has met, which only saves time.

Defined results: NULL and empty text give no ids and empty bytes; the longest texts are handled in one piece list, in
memory of a few dozen bytes a character; repeated rows repeat their result.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.arrays import CHUNK_BYTES, Memo, Texts, cut, ranges, span_hash, texts
from panelloom.llm.frames import map_batches

LEAF_BYTES = 64
KEPT_PIECES = 1_000_000
_NONE = np.int64(1 << 40)
_LETTER, _NUMBER, _OTHER, _SPACE = 0, 1, 2, 3
_classes: np.ndarray | None = None
_vocabularies: dict[str, Vocabulary] = {}


class Vocabulary:
    """Merge ranks, with every pair of tokens that joins to a token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            rank = {base64.b64decode(token): int(number) for token, number in map(bytes.split, lines)}
        self.tokens = [b""] * (max(rank.values()) + 1)
        for token, number in rank.items():
            self.tokens[number] = token
        self.byte_ids = np.array([rank[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            (rank[left], rank[right], number)
            for token, number in rank.items()
            for cut in range(1, len(token))
            if (left := token[:cut]) in rank and (right := token[cut:]) in rank
        ]
        table = np.array(pairs, np.int64).reshape(-1, 3)
        keys = (table[:, 0] << 32) | table[:, 1]
        order = np.argsort(keys)
        self._keys, self._ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(table[order, 2], _NONE)
        self._stable: dict[tuple[int, int], bool] = {}
        self.pieces = Memo(KEPT_PIECES)

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        at = np.searchsorted(self._keys, keys)
        return np.where(self._keys[at] == keys, self._ranks[at], _NONE)

    def leaves(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encodings of many short byte strings, one after the other, and their lengths.

        In each step every string makes its first best merge.
        """
        owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        token = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = self._ranks_within(owner, token)
        done_owner, done_token = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(token):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(first, len(token)))
            # Rank and place in one number: the smallest is the leftmost pair of the best rank.
            best = np.minimum.reduceat((rank << 22) | (np.arange(len(token)) - np.repeat(first, sizes)), first)
            open_ = (best >> 22) < _NONE
            keep = np.repeat(open_, sizes)
            if not open_.all():
                done_owner.append(owner[~keep])
                done_token.append(token[~keep])
            at = first[open_] + (best[open_] & ((1 << 22) - 1))
            token[at] = best[open_] >> 22
            keep[at + 1] = False
            # Only the pairs left and right of a merge have new ranks.
            new = np.cumsum(keep)[at] - 1
            owner, token, rank = owner[keep], token[keep], rank[keep]
            for spot in (new, new[new > 0] - 1):
                ahead = np.minimum(spot + 1, len(token) - 1)
                same = (spot + 1 < len(token)) & (owner[ahead] == owner[spot])
                rank[spot] = np.where(same, self._pair_ranks(token[spot], token[ahead]), _NONE)
        owner, token = np.concatenate(done_owner), np.concatenate(done_token)
        order = np.argsort(owner, kind="stable")
        return token[order], np.bincount(owner, minlength=len(pieces))

    def _ranks_within(self, owner: np.ndarray, token: np.ndarray) -> np.ndarray:
        rank = np.full(len(token), _NONE)
        rank[:-1] = np.where(owner[1:] == owner[:-1], self._pair_ranks(token[:-1], token[1:]), _NONE)
        return rank

    def stable(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side encode to themselves."""
        known = self._stable.get((left, right))
        if known is None:
            known = self.encode(self.tokens[left] + self.tokens[right], whole=True) == (left, right)
            if len(self._stable) < KEPT_PIECES:
                self._stable[left, right] = known
        return known

    def encode(self, piece: bytes, whole: bool = False) -> tuple[int, ...]:
        if whole or len(piece) <= LEAF_BYTES:
            return tuple(self.leaves([piece])[0].tolist())
        middle = len(piece) // 2
        return self.join(self.encode(piece[:middle]), self.encode(piece[middle:]))

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the bytes of both, from the encodings of each."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        width = 2
        while True:
            a, b = left[-width:], right[:width]
            window = self.encode(self.decode(a) + self.decode(b), whole=True)
            rest, tail = left[: len(left) - len(a)], right[len(b) :]
            if (not rest or self.stable(rest[-1], window[0])) and (not tail or self.stable(window[-1], tail[0])):
                return rest + window + tail
            width *= 2

    def learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Keeps each new piece's ids: short ones together as leaves, long ones up the tree."""
        new, short = self.pieces.missing(hashes), ends - starts <= LEAF_BYTES
        at = np.flatnonzero(new & short)
        for i in range(0, len(at), 20_000):
            part = at[i : i + 20_000]
            self.pieces.add(hashes[part], *self.leaves(cut(data, starts[part], ends[part])))
        at = np.flatnonzero(new & ~short)
        for i, piece in zip(at.tolist(), cut(data, starts[at], ends[at]), strict=True):
            ids = np.array(self.encode(piece), np.int32)
            self.pieces.add(hashes[i : i + 1], ids, np.array([len(ids)]))

    def decode(self, ids: Sequence[int]) -> bytes:
        if len(ids) <= 4096:
            return b"".join([self.tokens[i] for i in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _class_table() -> np.ndarray:
    """The pattern's class of every code point: letter, number, white space or other."""
    global _classes
    if _classes is None:
        points = [*range(0xD800), *range(0xE000, 0x110000)]
        everything = "".join(map(chr, points))
        table = np.full(0x110000, _OTHER, np.uint8)
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for m in regex.finditer(pattern, everything):
                table[np.array(points[m.start() : m.end()])] = kind
        _classes = table
    return _classes


def piece_bounds(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where pieces of the public pattern begin, and each row's first piece.

    A piece is a run of letters, of numbers or of other characters with one blank before it if there is one; a run of
    white space without its last character if something follows; or a contraction after an apostrophe.
    """
    points = np.frombuffer(part.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lengths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    at_byte = np.append(0, np.cumsum(lengths))
    rows = np.searchsorted(at_byte, part.offsets)  # in characters
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(part.offsets), np.int64)
    kind = _class_table()[points]
    edge = np.zeros(n + 1, bool)
    edge[1:n] = kind[1:] != kind[:-1]
    edge[rows] = True
    row_edge = np.zeros(n + 1, bool)
    row_edge[rows] = True
    blank = kind == _SPACE
    # The last character of a white-space run that something follows begins a piece of its own ...
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~row_edge[1:n])
    starts = edge.copy()
    starts[last] = True
    # ... which goes on into the run behind it if it is a plain blank.
    joined = last[points[last] == 0x20] + 1
    starts[joined] = False
    # Contractions: a lone apostrophe, nothing joined before it, then letters of the same row.
    lone = np.flatnonzero((points == 0x27) & starts[:n])
    lone = lone[(lone + 1 < n)]
    lone = lone[(kind[lone + 1] == _LETTER) & ~row_edge[lone + 1]]
    if len(lone):
        ahead = np.append(points, [0, 0])
        first, second = ahead[lone + 1], np.where(row_edge[np.minimum(lone + 2, n)], 0, ahead[lone + 2])
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = np.zeros(len(lone), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (first == ord(a)) & (second == ord(b))
        short = lone[one | two]
        starts[short + 1] = False
        after = np.where(one, lone + 2, lone + 3)[one | two]
        starts[after] = True
    begin = np.flatnonzero(starts[:n])
    return at_byte[begin], np.searchsorted(begin, rows)


def encode_rows(column: pa.Array, path: str) -> Iterator[list[int]]:
    """The ids of each row of a text column."""
    vocab = vocabulary(path)
    for part in texts(column, 2 * CHUNK_BYTES):
        begin, first = piece_bounds(part)
        end = np.append(begin[1:], len(part.data))[: len(begin)]
        hashes, sample, inverse = np.unique(span_hash(part.data, begin, end), return_index=True, return_inverse=True)
        vocab.learn(hashes, part.data, begin[sample], end[sample])
        place, sizes = vocab.pieces.find(hashes)
        ids = vocab.pieces.ids[ranges(place[inverse], sizes[inverse])]
        until = np.append(0, np.cumsum(sizes[inverse]))[first]
        for a, b in zip(until[:-1], until[1:], strict=True):
            yield ids[a:b].tolist()


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    finish: Callable[[int, list[int], bytes], tuple] | None = None,
    finish_schema: str = "",
) -> DataFrame:
    """``id, ids array<int>, decoded binary`` of each text.

    ``finish(id, ids, decoded)`` may turn them into other columns inside the same task, so that long id lists need not
    travel; ``finish_schema`` is then the schema behind the id.
    """
    schema = f"`{id_col}` bigint, " + (finish_schema or "ids array<int>, decoded binary")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        rows = []
        for doc, ids in zip(batch.column(0).to_pylist(), encode_rows(batch.column(1), path), strict=True):
            decoded = vocab.decode(ids)
            rows.append((doc, *finish(doc, ids, decoded)) if finish else (doc, ids, decoded))
        columns = list(zip(*rows, strict=True))
        if finish:
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *map(pa.array, columns[1:])], names)
        else:
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    names = [id_col, "ids", "decoded"] if not finish else [id_col, *[c.split()[0] for c in finish_schema.split(",")]]
    return map_batches(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")), run, schema)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, decoded binary`` of rows of ids; NULL is no ids."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        out = [vocab.decode(ids or []) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [id_col, "decoded"])

    return map_batches(df.select(id_col, F.col(ids_col).cast("array<int>")), run, f"`{id_col}` {dict(df.dtypes)[id_col]}, decoded binary")
