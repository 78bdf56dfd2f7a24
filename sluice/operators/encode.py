"""Rows of a source as rows of a target table: column order, casts, NULLs, ids, defaults, generated columns, as one projection."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import cast, not_null
from ..functions.sqltext import unescape
from ..plans.ddl import ColumnSpec, TableSpec

ROW_ID = "_row_id"
HIDDEN_ID = re.compile(r"_[a-z]+_rowid")  # names under which dumps carry the hidden row id


def permutation(source: Iterable[str] | None, table: TableSpec, ignored: Iterable[str] = ()) -> list[int]:
    """For every target column, and last the hidden row id, its place in the source or -1.  No source names: places as they are."""
    if source is None:
        return [*range(len(table.columns)), -1]
    at = {name.lower(): k for k, name in enumerate(source)}
    hidden = next((k for n, k in at.items() if HIDDEN_ID.fullmatch(n)), -1)
    known = {c.name.lower() for c in table.columns} | {x.lower() for x in ignored}
    if unknown := [n for n in at if n not in known and not HIDDEN_ID.fullmatch(n)]:
        raise ValueError(f"unknown columns in header {unknown}")
    return [*(at.get(c.name.lower(), -1) for c in table.columns), hidden]


def random_header(chunk: Column, bits: int) -> Column:
    """The random bits of auto-random ids: the same for all rows of a chunk, and again for it on a resumed load."""
    return F.pmod(F.xxhash64(chunk), F.lit(1 << bits))


def auto_random(chunk: Column, row_id: Column, spec: ColumnSpec) -> Column:
    low = spec.bits() - spec.auto_random - (0 if spec.unsigned else 1)
    return F.shiftleft(random_header(chunk, spec.auto_random), low).bitwiseOR(row_id.cast("long"))


def default_value(spec: ColumnSpec, task_time: str) -> Column:
    text = spec.default
    if text is None or text.upper() == "NULL":
        return F.lit(None)
    if re.match(r"(?i)(current_timestamp|now|localtime|localtimestamp)\b", text):
        return F.lit(task_time).cast("timestamp")
    if text[0] in "'\"":
        return F.lit(unescape(text[1:-1].replace(text[0] * 2, text[0])))
    return F.lit(text)


def generated_expression(sql: str) -> Column:
    """A MySQL expression in Spark's words, for the functions that differ in name."""
    sql = re.sub(r"(?i)\bjson_array\s*\(", "array(", sql)
    sql = re.sub(r"(?i)\bcast\s*\((.*)\bas\s+char(\s*\(\s*\d+\s*\))?\s*\)", r"cast(\1 as string)", sql)
    return F.expr(sql)


def encode(source: DataFrame, table: TableSpec, *, strict: bool = True, source_columns: Iterable[str] | None = None, ignored: Iterable[str] = (), task_time: str = "1970-01-01 00:00:00", chunk: str | None = None) -> DataFrame:
    """source as the columns of table, and ROW_ID.

    source has ROW_ID and its data columns in order, named or not (source_columns None: as many as the table has, by place).
    chunk: a column that names the chunk of a row, the seed of auto-random ids.  task_time: what CURRENT_TIMESTAMP defaults give, so that
    a resumed load gives it again.
    """
    data = [c for c in source.columns if c not in (ROW_ID, chunk)]
    names = list(source_columns) if source_columns is not None else None
    if names is None and len(data) > len(table.columns) + 1:
        raise ValueError(f"column count mismatch: {len(data)} in the data, {len(table.columns)} in {table.name}")
    place = permutation(names, table, ignored)
    if names is None:
        place = [k if k < len(data) else -1 for k in place]
    row_id = F.col(ROW_ID)
    if place[-1] >= 0:
        row_id = F.coalesce(F.col(f"`{data[place[-1]]}`").cast("long"), row_id)
    out, later = [], []
    for spec, k in zip(table.columns, place):
        if spec.generated:
            later.append(spec)
            continue
        if k >= 0:
            value = cast(F.col(f"`{data[k]}`"), spec, strict)
        elif spec.auto_increment:
            value = cast(row_id, spec, strict)
        elif spec.auto_random:
            value = auto_random(F.col(chunk) if chunk else F.lit(table.name), row_id, spec).cast(spec.spark_type())
        else:
            value = cast(default_value(spec, task_time), spec, strict) if spec.default is not None else not_null(F.lit(None).cast(spec.spark_type()), spec, strict)
        out.append(value.alias(spec.name))
    rows = source.select(row_id.alias(ROW_ID), *out)
    for spec in later:  # each sees those before it
        rows = rows.withColumn(spec.name, cast(generated_expression(spec.generated), spec, strict))
    return rows.select(ROW_ID, *[f"`{c.name}`" for c in table.columns])


def next_ids(rows: DataFrame, table: TableSpec) -> DataFrame:
    """One row: the largest row id and, for an id column, the largest id (without random bits), from which ids go on."""
    wanted = [F.max(ROW_ID).alias("max_row_id")]
    for c in table.columns:
        if c.auto_increment:
            wanted.append(F.max(f"`{c.name}`").cast("decimal(20,0)").alias("max_auto_increment"))
        if c.auto_random:
            low = c.bits() - c.auto_random - (0 if c.unsigned else 1)
            wanted.append(F.max(F.col(f"`{c.name}`").cast("long").bitwiseAND(F.lit((1 << low) - 1))).alias("max_auto_random"))
    return rows.agg(*wanted)
