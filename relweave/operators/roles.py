"""Semantic annotations of columns, kept in Spark column metadata."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs

JOIN_KEY, TIME_STAMP, NUMERICAL, CATEGORICAL = "join_key", "time_stamp", "numerical", "categorical"
TEXT, TARGET, UNUSED_FLOAT, UNUSED_STRING = "text", "target", "unused_float", "unused_string"
ROLES = (JOIN_KEY, TIME_STAMP, NUMERICAL, CATEGORICAL, TEXT, TARGET, UNUSED_FLOAT, UNUSED_STRING)


def _list(cols: str | Iterable[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _annotate(df: DataFrame, cols: list[str], **entries) -> DataFrame:
    for c in cols:
        df = df.withMetadata(c, {**df.schema[c].metadata, **entries})
    return df


def _convert(df: DataFrame, name: str, role: str, time_formats: list[str] | None) -> Column:
    col, dtype = F.col(f"`{name}`"), df.schema[name].dataType
    if role in (NUMERICAL, TARGET, UNUSED_FLOAT):
        return exprs.null_if_missing(col.try_cast("double"))
    if role in (CATEGORICAL, TEXT, UNUSED_STRING):
        text = col.cast("string")
        return F.when(~text.isin("NULL", ""), text)
    if role == TIME_STAMP:
        if time_formats:
            return exprs.as_ts(col, time_formats)
        if isinstance(dtype, T.NumericType):
            return F.timestamp_seconds(col)
        return col if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)) else col.try_cast("timestamp")
    return col


def set_role(df: DataFrame, cols, role: str, time_formats: list[str] | None = None) -> DataFrame:
    """Give columns a role and the physical type that goes with it."""
    if role not in ROLES:
        raise ValueError(f"unknown role {role}")
    names = _list(cols)
    known = {c: df.schema[c].metadata for c in names}
    df = df.withColumns({c: _convert(df, c, role, time_formats) for c in names})
    for c in names:
        df = df.withMetadata(c, {**known[c], "role": role})
    return df


def set_unit(df: DataFrame, cols, unit: str) -> DataFrame:
    """Columns that share a unit may be compared; preprocessors can address the unit."""
    return _annotate(df, _list(cols), unit=unit)


def set_subroles(df: DataFrame, cols, subroles) -> DataFrame:
    return _annotate(df, _list(cols), subroles=_list(subroles))


def role_of(field: T.StructField) -> str:
    known = (field.metadata or {}).get("role")
    if known:
        return known
    return UNUSED_FLOAT if isinstance(field.dataType, T.NumericType) else UNUSED_STRING


def roles(df: DataFrame) -> dict[str, list[str]]:
    """Role -> columns, plus `unused` = both unused roles together."""
    out: dict[str, list[str]] = {r: [] for r in ROLES}
    for field in df.schema.fields:
        out[role_of(field)].append(field.name)
    out["unused"] = out[UNUSED_FLOAT] + out[UNUSED_STRING]
    return out


def units(df: DataFrame) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for field in df.schema.fields:
        unit = (field.metadata or {}).get("unit")
        if unit:
            out.setdefault(unit, []).append(field.name)
    return out


def subroles(field: T.StructField) -> list[str]:
    return list((field.metadata or {}).get("subroles", []))


def make_target_columns(df: DataFrame, col: str) -> DataFrame:
    """One 0/1 target per class, in one projection. The classes are columns, so their names pass through the driver."""
    labels = sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())
    new = {f"{col}={v}": (F.col(col) == F.lit(v)).cast("double") for v in labels}
    return _annotate(df.withColumns(new).drop(col), list(new), role=TARGET)


LOGICAL_TYPES = {
    "Integer": "int",
    "IntegerNullable": "bigint",
    "Double": "double",
    "Categorical": "string",
    "Datetime": "timestamp",
}


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Coerce columns to declared logical types in one projection; what does not fit becomes null."""
    cols = [F.col(c).try_cast(LOGICAL_TYPES[types[c]]).alias(c) if c in types else F.col(c) for c in df.columns]
    return df.select(*cols)
