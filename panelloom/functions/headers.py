"""Resolve columns by question code.

Headers come in two dialects. ``tuple`` headers are the text of a pair, ``('P2_h ', 'label')``;
``dot`` headers start with the code, ``2.h_label`` or ``4.j.1 label``. Codes are compared
without surrounding blanks, and neither the position nor the label of a column is ever used
to find it. These helpers run on the header only, once per edition, before any plan exists.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Iterable, Mapping
from typing import NamedTuple


class Question(NamedTuple):
    column: str
    code: str
    label: str


# The label of some exported headers holds an unescaped quote, which a literal parse refuses.
_PAIR = re.compile(r"""^\(\s*(['"])(?P<code>.*?)\1\s*,\s*['"](?P<label>.*?)['"]?\)$""", re.DOTALL)
_DOTTED = re.compile(r"^(?P<code>\d+\.[^\W\d_]+(?:\.\d+)?)(?:[_ ](?P<label>.*))?$", re.DOTALL)
_CHILD_INDEX = re.compile(r"^\d+[_ ]?")


def parse_header(column: str, dialect: str) -> Question | None:
    """Code and label of one header, or None where the column is not a question."""
    if dialect == "tuple":
        try:
            code, label = ast.literal_eval(column)
            return Question(column, str(code).strip(), str(label))
        except (ValueError, SyntaxError, TypeError):
            match = _PAIR.match(column)
            return Question(column, match["code"].strip(), match["label"]) if match else None
    if dialect == "dot":
        match = _DOTTED.match(column)
        return Question(column, match["code"], match["label"] or "") if match else None
    raise ValueError(f"unknown header dialect {dialect!r}")


def questions(columns: Iterable[str], dialect: str) -> list[Question]:
    return [q for q in (parse_header(c, dialect) for c in columns) if q is not None]


def resolve_column(columns: Iterable[str], code: str | None, dialect: str) -> str | None:
    """The one column that carries ``code``; a full header name is accepted as its own code.

    No code means the edition did not ask the question. A missing or an ambiguous code fails.
    """
    if code is None:
        return None
    columns = list(columns)
    if code in columns:
        return code
    matches = [q.column for q in questions(columns, dialect) if q.code == code.strip()]
    if not matches:
        raise KeyError(f"question code {code!r} not found in the header")
    if len(matches) > 1:
        raise ValueError(f"question code {code!r} is ambiguous: {matches}")
    return matches[0]


def resolve_fields(columns: Iterable[str], codes: Mapping[str, str | None], dialect: str) -> dict[str, str | None]:
    """Canonical field to column, for every field of an edition."""
    columns = list(columns)
    return {field: resolve_column(columns, code, dialect) for field, code in codes.items()}


def option_block(columns: Iterable[str], prefix: str, dialect: str) -> list[tuple[str, str]]:
    """``(column, option label)`` of a multi-select block, without its umbrella column."""
    if dialect == "tuple":
        umbrella = prefix.strip().rstrip("_")
        return [
            (q.column, q.label)
            for q in questions(columns, dialect)
            if q.code.startswith(prefix.strip()) and q.code not in (prefix.strip(), umbrella)
        ]
    return [(c, _CHILD_INDEX.sub("", c[len(prefix):])) for c in columns if c.startswith(prefix)]


def name_options(block: Iterable[tuple[str, str]], names: Mapping[str, str], strict: bool = True) -> dict[str, str]:
    """Column to canonical option name through a label dictionary.

    With ``strict`` a label without an entry fails; otherwise the column is left out.
    """
    block = list(block)
    unknown = [label for _, label in block if label.strip() not in names and label not in names]
    if unknown and strict:
        raise ValueError(f"unmapped option labels (add them to the mapping): {sorted(unknown)}")
    return {c: names.get(label, names.get(label.strip())) for c, label in block if label not in unknown}
