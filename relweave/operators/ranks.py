"""Row numbers without a single-partition window.

Rows are cut into ordered pieces at constants learnt once (whole rows of the order
columns, taken from a sample), numbered inside each piece, and shifted by the piece's
offset. The pieces depend on values only, so a recomputed task numbers its rows the same.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint, plan_bytes
from . import skew

PIECE_BYTES = 64 * 2**20
PIECE_ROWS = 2**16
MIN_PIECES = 8
WIDTH = 1024
PER_PIECE = 64


def _below(cuts: Column, row: Column, size: int) -> Column:
    """How many of the sorted cuts lie below a row, by bisection."""
    turns = F.sequence(F.lit(1), F.lit(max(1, size.bit_length())))
    start = F.struct(F.lit(0).alias("lo"), F.coalesce(F.array_size(cuts), F.lit(0)).alias("hi"))

    def halve(s: Column, _turn: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        open_ = s["lo"] < s["hi"]
        below = F.coalesce(open_ & (F.get(cuts, mid) < row), F.lit(False))
        lo = F.when(below, mid + 1).otherwise(s["lo"])
        hi = F.when(open_ & ~below, mid).otherwise(s["hi"])
        return F.struct(lo.alias("lo"), hi.alias("hi"))

    return F.aggregate(turns, start, halve, lambda s: s["lo"])


def _spaced(rows: Column, n: int) -> Column:
    """n - 1 evenly spaced elements of a sorted array, without repeats."""
    size = F.array_size(rows)
    picks = F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get(rows, F.floor(i * size / n).cast("int")))
    return F.array_distinct(F.filter(picks, lambda c: c.isNotNull()))


def _constant(df: DataFrame) -> DataFrame:
    """The rows of a small result as a table of constants."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _other_place(n: int) -> Column:
    """A second, independent place of a sampled row."""
    return F.pmod(F.xxhash64(*[F.col(f"__row.f{i}") for i in range(n)], F.lit("head")), F.lit(2**31))


def ordered_pieces(df: DataFrame, order: list[str], pieces: int | None = None, width: int = WIDTH) -> DataFrame:
    """Add `__p0`: piece numbers that sort like the order columns (ascending, nulls first).

    Cuts are whole tuples of the order columns, so equal first columns, equal beginnings
    of texts and nulls are cut like everything else. The number of pieces follows the
    size of the input, which the plan only bounds: a piece has `PIECE_ROWS` rows or more
    on average. Beyond `width` pieces each piece is cut once more; at most
    width + width * width cuts of one sample of `PER_PIECE` rows a piece are broadcast.
    """
    rows = df.count()
    n = max(MIN_PIECES, min(plan_bytes(df) // PIECE_BYTES, rows // PIECE_ROWS)) if pieces is None else pieces
    n = max(2, min(n, width * width))
    first, second = min(n, width), ceil(n / width) if n > width else 1
    row = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(order)])
    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in order]), F.lit(2**31))
    share = min(1.0, PER_PIECE * n / max(1, rows))
    sample = df.where(place < F.lit(ceil(share * 2**31))).select(row.alias("__row"))

    def cuts(rows: DataFrame, parts: int, name: str, *keys: str) -> DataFrame:
        listed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("__row")).alias("__rows"))
        return listed.select(*keys, _spaced(F.col("__rows"), parts).alias(name))

    head = sample.where(_other_place(len(order)) < F.lit(ceil(2**31 / second))) if second > 1 else sample
    upper = _constant(cuts(head, first, "__cuts"))
    columns = [F.col(f"`{c}`") for c in df.columns]
    out = df.crossJoin(F.broadcast(upper)).select(*columns, _below(F.col("__cuts"), row, first).alias("__p0"))
    if second == 1:
        return out
    placed = sample.crossJoin(F.broadcast(upper)).select("__row", _below(F.col("__cuts"), F.col("__row"), first).alias("__p0"))
    lower = _constant(cuts(placed, second, "__more", "__p0")).withColumnRenamed("__p0", "__up")
    joined = out.join(F.broadcast(lower), F.col("__p0") == F.col("__up"), "left")
    piece = F.col("__p0").cast("long") * second + _below(F.col("__more"), row, second)
    return joined.select(*columns, piece.alias("__p0"))


def running_total(df: DataFrame, order: list[str], weight: str | None, name: str) -> DataFrame:
    """Add the sum of `weight` (None: one a row) over all rows before a row in the order (ascending; nulls first).

    The columns must order the rows completely. The counts of the pieces form the only
    global window.
    """
    pieces = ordered_pieces(df, order)
    unit = F.lit(1).cast("long") if weight is None else F.col(f"`{weight}`").cast("long")
    sizes = pieces.groupBy("__p0").agg(F.sum(unit).alias("__n"))
    before = Window.orderBy("__p0").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__p0", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local = Window.partitionBy("__p0").orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order])
    inside = F.row_number().over(local) - 1 if weight is None else F.coalesce(F.sum(unit).over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = pieces.withColumn("__rn", inside).join(offsets, ["__p0"])
    return out.withColumn(name, F.col("__off") + F.col("__rn")).drop("__p0", "__off", "__rn")


def with_row_id(df: DataFrame, order: list[str], name: str = "rowid", descending: bool = False) -> DataFrame:
    """Number rows 0, 1, 2, ... in the order of the columns (ascending; nulls first)."""
    out = running_total(df, order, None, name)
    if descending:
        total = df.count()
        out = out.withColumn(name, F.lit(total - 1) - F.col(name))
    return out


def slice_rows(df: DataFrame, order: list[str], start: int = 0, stop: int | None = None) -> DataFrame:
    """Rows start..stop-1 of the ordered table; short heads are a distributed top-n."""
    if start == 0 and stop is not None and stop <= 100_000:
        return df.orderBy(*order).limit(stop)
    numbered = with_row_id(df, order, "__row")
    if start < 0:
        start += df.count()
    keep = F.col("__row") >= start
    if stop is not None:
        keep = keep & (F.col("__row") < stop)
    return numbered.where(keep).drop("__row")


def group_row_number(df: DataFrame, keys: list[str], order: list[str], name: str = "rn") -> DataFrame:
    """row_number per group from 1; hot groups are numbered in segments.

    `order` starts with a time stamp or integer and must be complete within a group.
    """
    from ..functions.timecols import order_sql

    keyed = df.withColumn("__o", F.expr(order_sql(df, order[0])))
    bounds = skew.segment_bounds(keyed.select(*keys, "__o"), keys, "__o")
    seg = skew.with_segment(keyed, bounds, keys, "__o")
    local = Window.partitionBy(*keys, "__seg").orderBy(*order)
    out = seg.withColumn(name, F.row_number().over(local).cast("long"))
    if bounds is not None:
        hot = seg.join(F.broadcast(bounds.select(*keys)), keys, "left_semi")
        counts = hot.groupBy(*keys, "__seg").agg(F.count(F.lit(1)).alias("__n"))
        before = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(*keys, "__seg", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
        out = out.join(F.broadcast(offsets), [*keys, "__seg"], "left")
        out = out.withColumn(name, F.col(name) + F.coalesce("__off", F.lit(0))).drop("__off")
    return out.drop("__seg", "__o")


def encode_category(df: DataFrame, col: str, code: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Dense codes 0, 1, ... in the order of the labels; returns (coded rows, code table).

    The labels are read several times, the rows may be costly: labels are counted once and kept.
    """
    code = code or f"{col}_enc"
    labels = checkpoint(df.select(col).dropna().groupBy(col).agg(F.count(F.lit(1)).alias("__n")))
    table = with_row_id(labels.select(col), [col], code)
    return skew.skew_join(df, table, [col], "left", sizes=labels), table
