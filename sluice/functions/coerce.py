"""Casts to a declared SQL column type, strict or lenient.

Strict: what does not fit is an error (ANSI cast, raise_error).  Lenient: numbers are clamped to the type's range, text is cut
to its length, what cannot be read becomes the type's zero value, NULL in a NOT NULL column becomes it too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.ddl import ColumnSpec

ZERO_TIME = "0000-00-00 00:00:00"  # not a timestamp in Spark: kept as NULL unless zero_dates is "text"


def _number(column: Column, spec: ColumnSpec, strict: bool) -> Column:
    low, high = spec.bounds()
    kind = spec.spark_type()
    if strict:
        wide = column.cast("decimal(38,0)") if kind != "decimal(38,0)" else column
        text = F.concat(F.lit(f"failed to cast value as {spec.sql_type} for column `{spec.name}`: "), column.cast("string"))
        return F.when(column.isNull(), None).when(wide.between(F.lit(str(low)).cast("decimal(38,0)"), F.lit(str(high)).cast("decimal(38,0)")), wide).otherwise(F.raise_error(text).cast("decimal(38,0)")).cast(kind)
    text = F.trim(column.cast("string"))
    lead = F.regexp_extract(text, r"^[+-]?\d*\.?\d*(?:[eE][+-]?\d+)?", 0)
    exact = F.round(lead.try_cast("decimal(38,6)"), 0)
    rough = F.when(lead.try_cast("double") > 0, F.lit(str(high))).otherwise(F.lit(str(low))).cast("decimal(38,0)")
    value = F.coalesce(exact.cast("decimal(38,0)"), F.when(lead.try_cast("double").isNotNull(), rough), F.lit(0).cast("decimal(38,0)"))
    return F.when(column.isNull(), None).otherwise(F.greatest(F.lit(str(low)).cast("decimal(38,0)"), F.least(F.lit(str(high)).cast("decimal(38,0)"), value))).cast(kind)


def _real(column: Column, spec: ColumnSpec, strict: bool) -> Column:
    kind = spec.spark_type()
    if strict:
        return column.cast(kind)
    lead = F.regexp_extract(F.trim(column.cast("string")), r"^[+-]?\d*\.?\d*(?:[eE][+-]?\d+)?", 0)
    if kind.startswith("decimal"):
        p, s = spec.precision, spec.scale
        top = ("9" * (p - s) or "0") + ("." + "9" * s if s else "")
        value = F.coalesce(F.round(lead.try_cast(f"decimal(38,{min(s + 2, 38)})"), s), F.when(lead.try_cast("double") > 0, F.lit(top)).when(lead.try_cast("double") < 0, F.lit("-" + top)).otherwise(F.lit("0")).cast("decimal(38,6)"))
        value = F.greatest(F.lit("-" + top).cast("decimal(38,6)"), F.least(F.lit(top).cast("decimal(38,6)"), value.cast("decimal(38,6)"))) if s <= 6 else value
        return F.when(column.isNull(), None).otherwise(value.try_cast(kind))
    return F.when(column.isNull(), None).otherwise(F.coalesce(lead.try_cast(kind), F.lit(0).cast(kind)))


def _text(column: Column, spec: ColumnSpec, strict: bool) -> Column:
    text = column.cast("string")
    if spec.base == "char":
        text = F.rtrim(text)
    if spec.length is None:
        return text
    if strict:
        return F.when(F.length(text) <= spec.length, text).when(text.isNull(), None).otherwise(F.raise_error(F.concat(F.lit(f"data too long for column `{spec.name}`: "), text)).cast("string"))
    return F.substring(text, 1, spec.length)


def _binary(column: Column, spec: ColumnSpec, strict: bool) -> Column:
    value = column.cast("binary")
    if spec.length is None:
        return value
    cut = F.substring(value, 1, spec.length)
    if strict:
        cut = F.when(F.octet_length(value) > spec.length, F.raise_error(F.lit(f"data too long for column `{spec.name}`")).cast("binary")).otherwise(value)
    return F.rpad(cut, spec.length, F.lit(b"\0")) if spec.base == "binary" else cut


def _moment(column: Column, spec: ColumnSpec, strict: bool) -> Column:
    kind = spec.spark_type()
    return column.cast(kind) if strict else column.cast("string").try_cast(kind)


def _members(column: Column, spec: ColumnSpec, strict: bool) -> Column:
    text, names = column.cast("string"), F.array(*[F.lit(m) for m in spec.members])
    number = text.try_cast("decimal(20,0)")
    bad = F.raise_error(F.concat(F.lit(f"invalid member for column `{spec.name}`: "), text)).cast("string") if strict else F.lit("")
    if spec.base == "enum":
        by_name = F.try_element_at(F.filter(names, lambda m: F.lower(m) == F.lower(text)), F.lit(1))
        by_number = F.try_element_at(names, F.when((number > 0) & (number <= len(spec.members)), number).cast("int"))
        return F.when(text.isNull(), None).otherwise(F.coalesce(by_name, by_number, bad))
    asked = F.transform(F.split(text, ","), lambda m: F.lower(m))
    known = F.filter(names, lambda m: F.array_contains(asked, F.lower(m)))
    bits = F.array_join(F.filter(names, lambda m, i: (F.floor(number / F.pow(F.lit(2.0), i)) % 2) == 1), ",")
    whole = F.size(known) == F.size(F.array_distinct(asked))
    in_range = number.isNotNull() & (number >= 0) & (number < F.lit(str(2 ** len(spec.members))).cast("decimal(38,0)"))
    return F.when(text.isNull(), None).when(text == "", "").when(in_range & (F.size(known) == 0), bits).when(whole, F.array_join(known, ",")).otherwise(bad if strict else F.array_join(known, ","))


def cast(column: Column, spec: ColumnSpec, strict: bool) -> Column:
    """column as spec's type, by the mode; NOT NULL is applied too."""
    by = {"integer": _number, "real": _real, "text": _text, "binary": _binary, "moment": _moment, "members": _members}
    return not_null(by[spec.family()](column, spec, strict), spec, strict, column)


def not_null(value: Column, spec: ColumnSpec, strict: bool, source: Column | None = None) -> Column:
    if spec.nullable:
        return value
    if strict:
        return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"column `{spec.name}` cannot be null")).cast(spec.spark_type()))
    zero = spec.zero()
    return value if zero is None else F.coalesce(value, F.lit(zero).cast(spec.spark_type()))
