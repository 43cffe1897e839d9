"""An edition's raw files by header, so that columns are found by question code in every single file.

Files of one edition may print their columns in another order, may have more of them, or may word a label anew. The index reads
the header of each file (its first record, nothing else), groups the files by header and says which column of a group is
which column of the edition. Each group is then one scan under its own header, and the groups are united by name.
"""

from __future__ import annotations

import csv
import hashlib
import io
from collections.abc import Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import SparkSession

from panelloom.functions.headers import questions

_FIRST_READ = 1 << 16
_READERS = 16


class Group(NamedTuple):
    """Files that share one header, and for each of its columns the column of the edition (same length and order)."""

    files: tuple[str, ...]
    header: tuple[str, ...]
    names: tuple[str, ...]


class HeaderIndex(NamedTuple):
    """``columns`` of the edition in order of first appearance, and the groups of files they come from."""

    columns: tuple[str, ...]
    groups: tuple[Group, ...]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """All data files below ``path`` or the file itself, sorted by name."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    if system.getFileStatus(root).isFile():
        return [system.getFileStatus(root).getPath().toString()]
    walk = system.listFiles(root, True)
    while walk.hasNext():
        status = walk.next()
        if status.getLen() and not any(part.startswith(("_", ".")) for part in status.getPath().toString()[len(str(root)) :].split("/")):
            found.append(status.getPath().toString())
    return sorted(found)


def files_state(spark: SparkSession, path: str) -> str:
    """A text that changes with the names, lengths or times of the files below ``path``."""
    conf = spark._jsc.hadoopConfiguration()
    digest = hashlib.sha256()
    for file in list_files(spark, path):
        place = spark._jvm.org.apache.hadoop.fs.Path(file)
        status = place.getFileSystem(conf).getFileStatus(place)
        digest.update(f"{file}\0{status.getLen()}\0{status.getModificationTime()}\n".encode())
    return digest.hexdigest()


def read_header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The first record of a CSV file as it is printed; only as many bytes as it has are read. Compressed files are unpacked."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        data = b""
        while True:
            more = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, _FIRST_READ)))
            data += more
            record = _first_record(data, complete=not more)
            if record is not None:
                return record
    finally:
        stream.close()


def _first_record(data: bytes, complete: bool) -> tuple[str, ...] | None:
    """None while the record may go on behind what was read."""
    text = data.decode("utf-8", errors="ignore").removeprefix("﻿")
    rows = csv.reader(io.StringIO(text, newline=""), doublequote=True)
    first = next(rows, None)
    if complete:
        return tuple(first or ())
    return tuple(first) if first is not None and next(rows, None) is not None else None


def headers_of(spark: SparkSession, files: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Header of each file, read side by side: one small read per file and no job."""
    with ThreadPoolExecutor(_READERS) as pool:
        return dict(zip(files, pool.map(lambda f: read_header(spark, f), files), strict=True))


def index_headers(headers: dict[str, tuple[str, ...]], dialect: str | None = None, known: Collection[str] | None = None) -> HeaderIndex:
    """Which column of the edition each column of each file is.

    A column is one of the edition's by its printed text or, where both sides have its question code just once, by that code,
    however its label is worded. Any other column extends the edition; with ``known`` (question codes, and block prefixes
    ending in ``_`` or ``.``) its code must be among these, so a code nobody knows fails instead of passing as an answer. A column that
    is no question at all fails as well when a ``dialect`` is given. A header that repeats a column fails.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in headers.items():
        groups.setdefault(header, []).append(file)
    columns: list[str] = []
    out = []
    for header, files in groups.items():
        repeated = sorted({c for c in header if header.count(c) > 1})
        if repeated or not header:
            raise ValueError(f"{files[0]}: {'columns appear twice: ' + str(repeated) if repeated else 'no header'}")
        by_code = _unique_codes(columns, dialect)
        own = _unique_codes(header, dialect)
        code_of = {c: code for code, c in own.items()}
        printed = {q.column: q.code for q in questions(header, dialect)} if dialect else {}
        first = not columns
        names = []
        for column in header:
            name = column if column in columns else by_code.get(code_of.get(column, ""))
            if name is None:
                if not first:
                    _require_known(files[0], column, printed.get(column), dialect, known)
                name = column
            names.append(name)
        columns += [n for n in names if n not in columns]
        out.append(Group(tuple(files), header, tuple(names)))
    return HeaderIndex(tuple(columns), tuple(out))


def _unique_codes(columns: Sequence[str], dialect: str | None) -> dict[str, str]:
    """Code to column for codes that head one column only."""
    found: dict[str, list[str]] = {}
    for q in questions(columns, dialect) if dialect else ():
        found.setdefault(q.code, []).append(q.column)
    return {code: c[0] for code, c in found.items() if len(c) == 1}


def _require_known(file: str, column: str, code: str | None, dialect: str | None, known: Collection[str] | None) -> None:
    if dialect and code is None:
        raise ValueError(f"{file}: column {column!r} is no question of this edition")
    if known is not None:
        text = code if code is not None else column
        if not any(text == k or (k.endswith(("_", ".")) and text.startswith(k)) for k in known):
            raise ValueError(f"{file}: unknown question code {text!r} (column {column!r})")


def index_files(spark: SparkSession, path: str, dialect: str | None = None, known: Collection[str] | None = None) -> HeaderIndex:
    files = list_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no files below {path}")
    return index_headers(headers_of(spark, files), dialect, known)
