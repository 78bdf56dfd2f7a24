"""SQL text: identifiers, literals, escapes.  Column versions are built-in expressions and stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# MySQL's escape letters and what they stand for.
ESCAPES = {"0": "\0", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a"}

_ESCAPE = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    """Backslash escapes decoded; an unknown one stands for its character."""
    return _ESCAPE.sub(lambda m: ESCAPES.get(m[1], m[1]), text) if "\\" in text else text


def identifier(name: str) -> str:
    """A name in backticks, with its own doubled."""
    return "`" + name.replace("`", "``") + "`"


def table_name(schema: str, table: str) -> str:
    return f"{identifier(schema)}.{identifier(table)}"


def string_literal(text: str, backslash_escapes: bool = True) -> str:
    text = text.replace("'", "''") if not backslash_escapes else "".join(_ESCAPED.get(c, c) for c in text)
    return f"'{text}'"


_ESCAPED = {v: "\\" + k for k, v in ESCAPES.items()} | {"\\": "\\\\", "'": "''"}


def literal(column: Column, kind: str, backslash_escapes: bool = True) -> Column:
    """A column's values as SQL literals.  kind: its Spark type, as in DataFrame.dtypes."""
    if kind == "binary":
        out = F.concat(F.lit("x'"), F.hex(column), F.lit("'"))
    elif kind.startswith(("tinyint", "smallint", "int", "bigint", "decimal", "float", "double")):
        out = column.cast("string")
    elif kind == "boolean":
        out = column.cast("int").cast("string")
    else:
        text = column.cast("string")
        for raw, escaped in [("\\", "\\\\"), *((r, e) for r, e in _ESCAPED.items() if r not in "\\'")] if backslash_escapes else []:
            text = F.replace(text, F.lit(raw), F.lit(escaped))
        out = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.coalesce(out, F.lit("NULL"))


def tuple_literal(columns: list[tuple[str, str]], backslash_escapes: bool = True) -> Column:
    """(name, type) columns as one row constructor: ``(1,'a',NULL)``."""
    return F.concat(F.lit("("), F.concat_ws(",", *[literal(F.col(identifier(n)), t, backslash_escapes) for n, t in columns]), F.lit(")"))
