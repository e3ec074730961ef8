"""Column expressions: thin names over Spark's built-ins, all inside code generation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: strftime directives and the date patterns that stand for them
STRFTIME = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%n": "M",
    "%d": "dd",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%b": "MMM",
    "%B": "MMMM",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_pattern(fmt: str) -> str:
    """strftime format -> Spark date pattern; other letters are quoted."""
    out, i = "", 0
    while i < len(fmt):
        if fmt[i] == "%":
            out += STRFTIME[fmt[i : i + 2]]
            i += 2
        else:
            out += f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i]
            i += 1
    return out


def is_nan(c: Column | str) -> Column:
    """Missing: null or not-a-number."""
    return _col(c).isNull() | F.isnan(_col(c))


def null_if_missing(c: Column | str) -> Column:
    return F.when(~F.isnan(_col(c)), _col(c))


def update(c: Column | str, cond: Column, value) -> Column:
    """Overwrite where `cond` holds; chain calls, the last write wins."""
    new = value if isinstance(value, Column) else F.lit(value)
    return F.when(cond, new).otherwise(_col(c))


def equals_target(c: Column | str, value) -> Column:
    return (_col(c) == F.lit(value)).cast("double")


def as_ts(c: Column | str, formats: list[str]) -> Column:
    """Parse with the formats in turn; null when none fits."""
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(java_pattern(f))) for f in formats])


def make_ts(year, month, day, hour=None, minute=None, second=None) -> Column:
    part = [F.lit(0) if p is None else _col(p) for p in (hour, minute, second)]
    return F.make_timestamp_ntz(_col(year), _col(month), _col(day), *part)


def normalise_date(c: Column | str) -> Column:
    """'3/7/2011 8:26' -> '03-07-2011 8:26': dashes, and each date part two digits wide."""
    day_time = F.split(_col(c), " ")
    padded = F.transform(F.split(day_time[0], "/"), lambda p: F.when(F.length(p) == 1, F.concat(F.lit("0"), p)).otherwise(p))
    return F.concat_ws(" ", F.array_join(padded, "-"), day_time[1])


def regex_extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(_col(c), pattern, group)


def suffix_int(c: Column | str, start: int) -> Column:
    """The number after the first `start` characters ('word12' -> 12 for 4)."""
    return F.substring(_col(c), start + 1, 1_000_000).cast("int")


def remap(c: Column | str, mapping: Mapping, default: Column | None = None) -> Column:
    """Value replacement by dictionary; values not listed stay."""
    table = F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])
    return F.coalesce(F.try_element_at(table, _col(c)), _col(c) if default is None else default)


def fill_non_finite(c: Column | str, value: float = 0.0) -> Column:
    x = _col(c)
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(value)).otherwise(x)


def coalesce_cols(*cols: Column | str) -> Column:
    return F.coalesce(*[_col(c) for c in cols])


def concat_cols(*cols: Column | str, sep: str = "") -> Column:
    return F.concat_ws(sep, *[_col(c).cast("string") for c in cols])


def hash_unit(*cols: Column | str, seed: int = 0) -> Column:
    """Repeatable pseudo-random number in [0, 1) of a row's key.

    Unlike rand(), it does not depend on partitions, so a recomputed task or another
    cluster gives the same rows. Only integer arithmetic; a key part that is no whole
    number counts with the checksum of its text, a missing one as 0.
    """
    h = F.lit(seed % 2147483647).cast("long")
    for c in cols:
        text = _col(c).cast("string")
        part = F.coalesce(text.try_cast("long"), F.crc32(text.cast("binary")), F.lit(0).cast("long"))
        h = F.pmod(h * 48271 + F.pmod(part, F.lit(2147483647)) * 16807 + 11, F.lit(2147483647))
        h = F.pmod(h * 69621 + 7, F.lit(2147483647))
    return h / F.lit(2147483647.0)


def random_row(seed: int | None = None) -> Column:
    return F.rand(seed) if seed is not None else F.rand()
