"""Time-bounded join with aggregation: one output row per left row.

A left row at time t sees the right rows of its key in ``(t - h - m, t - h]``
(h = horizon, m = memory; without a memory everything up to ``t - h``).

Spark has no such join, and key join + filter would emit every pair. A sliding
window frame re-reads its whole frame for each row. For mergeable aggregates we use
neither: time is cut into blocks of length m, so a window always is the *tail* of
one block plus the *head* of the next. Right rows enter the shuffle once; each left
row enters as two markers (at ``t - h`` and at ``t - h - m``). Running aggregates in
ascending and descending order give head and tail in linear time, and the two halves
merge by row id. Work per partition is bounded by one key and one memory length; a
block that is still too large is cut into segments whose totals are carried over.

Quantiles, modes and distinct counts do not merge. If a column has few distinct values, their
counts do; otherwise quantiles are refined over ranges of values, and windows without a
memory use running numbers per value (see holistic.py). What is left, and everything when the
data show that windows are short, is gathered by a sliding frame in (key, block)
partitions, where right rows also visit the next block; it needs one shuffle only.

The statements are plain Spark SQL, so the same text can be saved as a script.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import COUNT_LIKE, HOLISTIC, MERGEABLE, REBASE, REBASE_NEEDS, STABLE, STATES, Agg
from ..functions.timecols import order_sql, ticks_per_unit
from ..session import checkpoint
from . import skew, value_counts


class NotDecomposable(ValueError):
    """One sliding frame cannot hold an unbounded window."""


@dataclass(frozen=True)
class IntervalJoin:
    """Everything the SQL text needs to know; expressions are over `left` / `right`."""

    left_keys: tuple[str, ...]
    right_keys: tuple[str, ...]
    left_order: str
    right_order: str
    row_id: tuple[str, ...]
    aggs: tuple[Agg, ...]
    horizon: int = 0
    memory: int | None = None
    unit: int = 1_000_000
    centers: dict[str, float] = field(default_factory=dict)
    origin: int = 0
    span: float = 0.0  # units between the first and the last row a window may hold

    def __post_init__(self):
        if self.memory is not None and self.memory <= 0:
            raise ValueError("memory must be positive")


def _keys(n: int, prefix: str = "") -> str:
    return "".join(f"{prefix}k{i}, " for i in range(n))


def _inputs(join: IntervalJoin, aggs) -> dict[str, str]:
    """Distinct masked values, each under a short name."""
    out: dict[str, str] = {}
    for agg in aggs:
        out.setdefault(agg.value_sql, f"x{len(out)}")
    return out


def _source_ctes(join: IntervalJoin, inputs: dict[str, str], numeric: set[str]) -> str:
    keys_r = "".join(f"{k} AS k{i}, " for i, k in enumerate(join.right_keys))
    keys_l = "".join(f"{k} AS k{i}, " for i, k in enumerate(join.left_keys))
    ids = ", ".join(f"{c} AS r{i}" for i, c in enumerate(join.row_id))
    values = "".join(
        f", CAST({sql} AS DOUBLE) AS {x}" if x in numeric else f", {sql} AS {x}" for sql, x in inputs.items()
    )
    present = " AND ".join([f"{k} IS NOT NULL" for k in join.right_keys] + [f"{join.right_order} IS NOT NULL"])
    sides = "explode(array(1, 2))" if join.memory is not None else "1"
    return (
        f"r AS (SELECT {keys_r}{join.right_order} AS o{values} FROM right_rows WHERE {present}),\n"
        f"l AS (SELECT {keys_l}{join.left_order} - {join.horizon} AS o, {ids}, {sides} AS side FROM left_rows)"
    )


def _block(join: IntervalJoin, order: str = "o") -> str:
    """Block number; exact integer division, also below zero."""
    if join.memory is None:
        return "0L"
    return f"(({order}) - pmod({order}, {join.memory}L)) div {join.memory}L"


def _marker_block(join: IntervalJoin, order: str) -> str:
    """Left rows without key or time match nothing; spread them instead of piling up."""
    missing = " OR ".join([f"k{i} IS NULL" for i in range(len(join.left_keys))] + ["o IS NULL"])
    return f"CASE WHEN {missing} THEN pmod(xxhash64({_rids(join)}), 4096L) ELSE {_block(join, order)} END"


def _rids(join: IntervalJoin, prefix: str = "") -> str:
    return ", ".join(f"{prefix}r{i}" for i in range(len(join.row_id)))


def _numeric_inputs(aggs, inputs) -> set[str]:
    out = set()
    for agg in aggs:
        spec = MERGEABLE.get(agg.func)
        if (spec and spec.numeric) or agg.func in ("QUANTILE", "MEDIAN"):
            out.add(inputs[agg.value_sql])
    return out


class _States:
    """States shared between aggregates, with their running and merged forms."""

    def __init__(self, join: IntervalJoin, aggs, inputs):
        self.join, self.inputs = join, inputs
        self.columns: dict[tuple, str] = {}
        self.rebase_needs: dict[str, list] = {}
        for agg in aggs:
            for state in MERGEABLE[agg.func].states:
                self._add(agg, state)

    def _key(self, agg: Agg, state: str) -> tuple:
        return (state, self.inputs[agg.value_sql], agg.param if state in ("ex", "ew") else None)

    def _add(self, agg: Agg, state: str) -> None:
        for needed in REBASE_NEEDS.get(state, []):
            self._add(agg, needed)
        self.columns.setdefault(self._key(agg, state), f"s{len(self.columns)}")

    def center(self, x: str) -> float:
        sql = next(s for s, name in self.inputs.items() if name == x)
        return self.join.centers.get(sql, 0.0)

    def rows_sql(self, key: tuple, distance: str) -> str:
        state, x, param = key
        return STATES[state][0].format(x=x, t="o", d=distance, c=f"{self.center(x)!r}D", p=_num(param))

    def merge(self, key: tuple) -> str:
        return STATES[key[0]][1]

    def rebase_sql(self, key: tuple, distance: str) -> str:
        state, x, param = key
        name = self.columns[key]
        if state not in REBASE:
            return name
        names = {s: self.columns[(s, x, None)] for s in REBASE_NEEDS[state]}
        names[state] = name
        return REBASE[state].format(r=distance, p=_num(param), **names)

    def final_sql(self, agg: Agg, now: str) -> str:
        names = {s: self.columns[self._key(agg, s)] for s in MERGEABLE[agg.func].states}
        return MERGEABLE[agg.func].final.format(
            c=f"{self.center(self.inputs[agg.value_sql])!r}D", u=f"{self.join.unit}D", now=now, **names
        )


def _num(param) -> str:
    return "" if param is None else f"{float(param)!r}D"


_MERGE2 = {
    "sum": "CASE WHEN {a} IS NULL THEN {b} WHEN {b} IS NULL THEN {a} ELSE {a} + {b} END",
    "min": "least({a}, {b})",
    "max": "greatest({a}, {b})",
}


def _segment_sql(join: IntervalJoin) -> str:
    """CTE text that numbers the segments of hot blocks, from a view `hot_cuts`."""
    nkeys = len(join.left_keys)
    match = " AND ".join([f"u.k{i} <=> c.k{i}" for i in range(nkeys)] + ["u.blk <=> c.blk"])
    return (
        "v AS (SELECT /*+ BROADCAST(c) */ u.*, coalesce(array_size(filter(c.__cuts, b -> b < u.o)), 0) AS seg,"
        f" c.__cuts IS NOT NULL AS hot FROM u LEFT JOIN hot_cuts c ON {match})"
    )


def markers_sql(join: IntervalJoin) -> str:
    """Right rows and left markers under one schema, for counting group sizes."""
    nkeys = len(join.left_keys)
    ctes = _source_ctes(join, {}, set())
    present = " AND ".join([f"k{i} IS NOT NULL" for i in range(nkeys)] + ["o IS NOT NULL"])
    at = _marker_order(join)
    return (
        f"WITH {ctes}\nSELECT {_keys(nkeys)}{_block(join)} AS blk, o FROM r\nUNION ALL "
        f"SELECT {_keys(nkeys)}{_block(join, at)} AS blk, {at} AS o FROM l WHERE {present}"
    )


def _marker_order(join: IntervalJoin) -> str:
    """Where a left row enters: at the end (side 1) and just before the start (side 2) of its window."""
    return "o" if join.memory is None else f"(CASE side WHEN 2 THEN o - {join.memory}L ELSE o END)"


def mergeable_sql(join: IntervalJoin, aggs, hot: bool) -> str:
    nkeys = len(join.left_keys)
    inputs = _inputs(join, aggs)
    states = _States(join, aggs, inputs)
    xs = "".join(f", {x}" for x in inputs.values())
    nulls = "".join(f", NULL AS {x}" for x in inputs.values())
    rid_nulls = ", ".join(f"NULL AS r{i}" for i in range(len(join.row_id)))
    bounded = join.memory is not None
    ctes = [_source_ctes(join, inputs, _numeric_inputs(aggs, inputs))]
    at = _marker_order(join)
    parts = [
        f"SELECT {_keys(nkeys)}{_block(join)} AS blk, o, 0 AS side, {rid_nulls}{xs} FROM r",
        f"SELECT {_keys(nkeys)}{_marker_block(join, at)} AS blk, {at} AS o, side, {_rids(join)}{nulls} FROM l",
    ]
    ctes.append("u AS (\n  " + "\n  UNION ALL ".join(parts) + ")")
    source, part = "u", f"{_keys(nkeys)}blk"
    if hot:
        ctes.append(_segment_sql(join))
        source, part = "v", f"{_keys(nkeys)}blk, seg"
    # distance of a row from the start of its block, in units
    ref = f"blk * {join.memory}L" if bounded else f"{join.origin}L"
    distance = f"((o - {ref}) / {join.unit}D)"
    running = []
    for key, name in states.columns.items():
        rows = states.rows_sql(key, distance)
        if bounded:
            running.append(f"CASE side WHEN 1 THEN {rows} OVER head WHEN 2 THEN {rows} OVER tail END AS {name}")
        else:
            running.append(f"{rows} OVER head AS {name}")
    carry_cols = f"{part}, hot, " if hot else ""
    windows = f"head AS (PARTITION BY {part} ORDER BY o, side ROWS UNBOUNDED PRECEDING)"
    if bounded:
        windows += f",\n    tail AS (PARTITION BY {part} ORDER BY o DESC, side DESC ROWS UNBOUNDED PRECEDING)"
    ctes.append(
        f"w AS (SELECT {carry_cols}{_rids(join)}, blk AS b, o, side, {', '.join(running)}\n  FROM {source} WINDOW {windows})"
    )
    last = "w"
    if hot:
        ctes.append(_carry_sql(join, states, part, distance))
        last = "wc"
    # markers only; distances are re-expressed relative to the left row
    now = f"(o + {join.memory}L)" if bounded else "o"
    if bounded:
        now = f"(CASE side WHEN 2 THEN o + {join.memory}L ELSE o END)"
    ref_b = f"b * {join.memory}L" if bounded else f"{join.origin}L"
    rel = f"(({now} - {ref_b}) / {join.unit}D)"
    rebased = ", ".join(f"{states.rebase_sql(k, rel)} AS {n}" for k, n in states.columns.items())
    ctes.append(f"m AS (SELECT {_rids(join)}, {now} AS now, {rebased} FROM {last} WHERE side > 0)")
    merged = "m"
    if bounded:
        both = ", ".join(f"{states.merge(k)}({n}) AS {n}" for k, n in states.columns.items())
        ctes.append(f"g AS (SELECT {_rids(join)}, max(now) AS now, {both} FROM m GROUP BY {_rids(join)})")
        merged = "g"
    final = ", ".join(f"{states.final_sql(a, f'(now + {join.horizon}L)')} AS `{a.alias}`" for a in aggs)
    ids = ", ".join(f"r{i} AS {c}" for i, c in enumerate(join.row_id))
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {ids}, {final} FROM {merged}"


def _carry_sql(join: IntervalJoin, states: _States, part: str, distance: str) -> str:
    """Totals of the other segments of a hot block, merged into the running states.

    At most 8192 segments exist (see skew.segment_bounds), so the totals are broadcast.
    """
    nkeys = len(join.left_keys)
    group = f"{_keys(nkeys)}blk"
    totals = ", ".join(f"{states.rows_sql(k, distance)} AS {n}" for k, n in states.columns.items())
    before, after = [], []
    for k, n in states.columns.items():
        before.append(f"{states.merge(k)}({n}) OVER lo AS a_{n}")
        after.append(f"{states.merge(k)}({n}) OVER hi AS z_{n}")
    match = " AND ".join([f"w.k{i} <=> c.k{i}" for i in range(nkeys)] + ["w.blk = c.blk", "w.seg = c.seg"])
    merged = []
    for k, n in states.columns.items():
        op = _MERGE2[states.merge(k)]
        merged.append(
            f"CASE WHEN side = 1 THEN {op.format(a=f'w.{n}', b=f'c.a_{n}')}"
            f" WHEN side = 2 THEN {op.format(a=f'w.{n}', b=f'c.z_{n}')} END AS {n}"
        )
    rids = _rids(join, "w.")
    return (
        f"tot AS (SELECT {part}, {totals} FROM v WHERE hot GROUP BY {part}),\n"
        f"car AS (SELECT {part}, {', '.join(before + after)} FROM tot WINDOW\n"
        f"    lo AS (PARTITION BY {group} ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),\n"
        f"    hi AS (PARTITION BY {group} ORDER BY seg ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),\n"
        f"wc AS (SELECT /*+ BROADCAST(c) */ {rids}, w.b, w.o, w.side, {', '.join(merged)}\n"
        f"  FROM (SELECT * FROM w WHERE side > 0) w LEFT JOIN car c ON {match})"
    )


HALF_LIVES = 900  # a double holds weights up to 2^1023


def too_long(agg: Agg, join: IntervalJoin) -> bool:
    """Whether weights relative to the start of a block could overflow."""
    return agg.func == "EWMA" and join.span / agg.param > HALF_LIVES


def _bound(ticks: int) -> str:
    return f"{ticks} PRECEDING" if ticks >= 0 else f"{-ticks} FOLLOWING"


def sliding_sql(join: IntervalJoin, aggs, self_join: bool = False, factor: int = 1) -> str:
    """Sliding frames inside (key, wide block); right rows also visit the next block if a window reaches back to them.

    A table joined to itself needs no markers: its rows are both sides, and the frame
    itself is shifted by the horizon.
    """
    if join.memory is None:
        bad = ", ".join(a.func for a in aggs)
        raise NotDecomposable(f"{bad}: an exact value over an unbounded window needs a memory")
    nkeys = len(join.left_keys)
    stable = [a for a in aggs if a.func in STABLE]
    mergeable, holistic = [a for a in aggs if a.mergeable and a not in stable], [a for a in aggs if not a.mergeable]
    inputs = _inputs(join, aggs)
    states = _States(join, mergeable, inputs)
    h, m = join.horizon, join.memory
    if self_join:
        width = factor * (m + abs(h))
        first, last = f"least({_wide('o', width)}, {_wide(f'o + {h}L', width)})", _wide(f"o + {h + m - 1}L", width)
        present = " AND ".join([f"{k} IS NOT NULL" for k in join.right_keys] + [f"{join.right_order} IS NOT NULL"])
        keys = "".join(f"{k} AS k{i}, " for i, k in enumerate(join.right_keys))
        ids = ", ".join(f"{c} AS r{i}" for i, c in enumerate(join.row_id))
        numeric = _numeric_inputs(aggs, inputs)
        # a row without key or time takes part in no window: its values are masked
        values = "".join(
            f", CASE WHEN {present} THEN {f'CAST({sql} AS DOUBLE)' if x in numeric else sql} END AS {x}" for sql, x in inputs.items()
        )
        ctes = [
            f"s AS (SELECT {keys}{join.right_order} AS o, {ids}{values}, {present} AS present FROM right_rows)",
            f"u AS (SELECT *, explode(CASE WHEN present THEN sequence({first}, greatest({_wide('o', width)}, {last}))"
            f" ELSE array(pmod(xxhash64({_rids(join)}), 4096L)) END) AS blk FROM s)",
        ]
        home = f"(NOT present OR blk = {_wide('o', width)})"
        frame, now = f"RANGE BETWEEN {_bound(h + m - 1)} AND {_bound(h)}", f"(o - {h}L)"
    else:
        width = factor * m
        xs, nulls = "".join(f", {x}" for x in inputs.values()), "".join(f", NULL AS {x}" for x in inputs.values())
        rid_nulls = ", ".join(f"NULL AS r{i}" for i in range(len(join.row_id)))
        missing = " OR ".join([f"k{i} IS NULL" for i in range(nkeys)] + ["o IS NULL"])
        ctes = [_source_ctes(join, inputs, _numeric_inputs(aggs, inputs))]
        ctes.append(
            f"u AS (SELECT {_keys(nkeys)}explode(sequence({_wide('o', width)}, {_wide(f'o + {m - 1}L', width)})) AS blk,"
            f" o, false AS home, {rid_nulls}{xs} FROM r\n"
            f"  UNION ALL SELECT {_keys(nkeys)}CASE WHEN {missing} THEN pmod(xxhash64({_rids(join)}), 4096L)"
            f" ELSE {_wide('o', width)} END AS blk, o, true AS home, {_rids(join)}{nulls} FROM l WHERE side = 1)"
        )
        home, now = "home", "o"
        frame = f"RANGE BETWEEN {m - 1} PRECEDING AND CURRENT ROW"
    distance, rel = f"((o - blk * {width}L) / {join.unit}D)", f"(({now} - blk * {width}L) / {join.unit}D)"
    cols = [f"{states.rows_sql(k, distance)} OVER f AS {n}" for k, n in states.columns.items()]
    cols += [f"{MERGEABLE[a.func].grouped.format(x=inputs[a.value_sql])} OVER f AS d{i}" for i, a in enumerate(stable)]
    arrays = list(dict.fromkeys(inputs[a.value_sql] for a in holistic))
    cols += [f"collect_list({x}) OVER f AS a_{x}" for x in arrays]
    cols += [f"mode({inputs[v]}, true) OVER f AS mode_{inputs[v]}" for v in dict.fromkeys(a.value_sql for a in holistic if a.func == "MODE")]
    around = dict.fromkeys(a.value_sql for a in holistic if a.func in ("COUNT_ABOVE_MEAN", "COUNT_BELOW_MEAN"))
    cols += [f"avg({inputs[v]}) OVER f AS m_{inputs[v]}" for v in around]
    ctes.append(
        f"w AS (SELECT {_rids(join)}, {now} AS now, {rel} AS rel, {home} AS home, {', '.join(cols)}\n"
        f"  FROM u WINDOW f AS (PARTITION BY {_keys(nkeys)}blk ORDER BY o {frame}))"
    )
    kept = [f"{states.rebase_sql(k, 'rel')} AS {n}" for k, n in states.columns.items()]
    kept += [f"d{i}" for i in range(len(stable))]
    kept += [f"array_sort(a_{x}) AS a_{x}" for x in arrays]
    kept += [f"mode_{inputs[v]}" for v in dict.fromkeys(a.value_sql for a in holistic if a.func == "MODE")]
    kept += [f"m_{inputs[v]}" for v in around]
    ctes.append(f"g AS (SELECT {_rids(join)}, now, {', '.join(kept)} FROM w WHERE home)")
    final = []
    for a in aggs:
        if a in stable:
            final.append(f"d{stable.index(a)} AS `{a.alias}`")
            continue
        if a.mergeable:
            final.append(f"{states.final_sql(a, f'(now + {h}L)')} AS `{a.alias}`")
            continue
        x = inputs[a.value_sql]
        func, param = ("QUANTILE", 0.5) if a.func == "MEDIAN" else (a.func, a.param)
        text = HOLISTIC[func].format(a=f"a_{x}", n=f"size(a_{x})", m=f"m_{x}", mode=f"mode_{x}", p=_num(param))
        final.append(f"CAST({text} AS BIGINT) AS `{a.alias}`" if a.func in COUNT_LIKE else f"{text} AS `{a.alias}`")
    ids = ", ".join(f"r{i} AS {c}" for i, c in enumerate(join.row_id))
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {ids}, {', '.join(final)} FROM g"


def _wide(order: str, width: int) -> str:
    return f"(({order}) - pmod({order}, {width}L)) div {width}L"


@dataclass(frozen=True)
class Profile:
    """Sizes of the (key, memory block) groups: largest, and as met by an average row."""

    largest: int
    typical: float
    rows: int = 0


SMALL_WINDOW = Profile(2048, 96.0)
SMALL_HISTORY = Profile(2048, 512.0)
WIDE_FACTOR = 8


def profile(left: DataFrame, right: DataFrame, join: IntervalJoin) -> Profile:
    """One partial aggregation over key and time; its result decides the form of the join."""
    cols = [f"k{i}" for i in range(len(join.left_keys))] + ["blk"]
    counts = _run(right.sparkSession, markers_sql(join), {"left_rows": left, "right_rows": right}).groupBy(*cols).count()
    row = counts.agg(F.max("count"), F.sum(F.col("count").cast("double") * F.col("count")) / F.sum("count"), F.sum("count")).first()
    return Profile(row[0] or 0, row[1] or 0.0, row[2] or 0)


def is_small(p: Profile, join: IntervalJoin, aggs) -> bool:
    """Sliding frames re-read their rows: good for short windows, with one shuffle instead of two."""
    reach = (join.memory + abs(join.horizon)) * WIDE_FACTOR / join.unit
    if any(a.func == "EWMA" and reach / a.param > HALF_LIVES for a in aggs):
        return False
    return p.largest <= SMALL_WINDOW.largest and p.typical <= SMALL_WINDOW.typical


def whole_history(left: DataFrame, right: DataFrame, join: IntervalJoin) -> IntervalJoin | None:
    """The join with a memory that reaches back to the first right row, if the rows of a key are few enough to be sorted for each window.

    A quantile refined over ranges of values costs several joins of all rows, which pays for long windows only.
    """
    last = left.agg(F.expr(f"max({join.left_order})")).first()[0]
    first = right.agg(F.expr(f"min({join.right_order})")).first()[0]
    if last is None or first is None or not 0 <= last - join.horizon - first < 2**58:
        return None
    whole = replace(join, memory=last - join.horizon - first + 1)
    found = profile(left, right, whole)
    return whole if found.largest <= SMALL_HISTORY.largest and found.typical <= SMALL_HISTORY.typical else None


def hot_cuts(left: DataFrame, right: DataFrame, join: IntervalJoin) -> DataFrame | None:
    """Cut points for (key, block) groups that hold too many right rows."""
    spark = right.sparkSession
    cols = [f"k{i}" for i in range(len(join.left_keys))] + ["blk"]
    groups = _run(spark, markers_sql(join), {"left_rows": left, "right_rows": right})
    return skew.segment_bounds(groups, cols, "o")


def interval_aggregate(left: DataFrame, right: DataFrame, join: IntervalJoin, form: str | None = None, told_apart: bool = False) -> DataFrame:
    """Row id and one column per aggregate; left rows without partner get NULL, counts 0.

    `form` is "sliding" or "blocks"; by default the profile of the data decides. Rows that share a
    row id, or have none, are rows of their own in both; `told_apart` says that there are none.
    """
    from . import holistic as ordered

    spark = left.sparkSession
    faded = [a for a in join.aggs if too_long(a, join)]
    mergeable = [a for a in join.aggs if a.mergeable and a not in faded]
    holistic = [a for a in join.aggs if not a.mergeable]
    both = {"left_rows": left, "right_rows": right}
    self_join = _same_side(left, right, join)
    largest = None
    if join.memory is not None and form is None and not faded:
        found = profile(left, right, join)
        largest = found.largest
        form = "sliding" if is_small(found, join, join.aggs) else "blocks"
    elif join.memory is None and form is None and {a.func for a in join.aggs} <= {"MEDIAN", "QUANTILE"}:
        whole = whole_history(left, right, join)
        if whole is not None:
            join, form = whole, "sliding"
    if form == "sliding":
        sql = sliding_sql(join, join.aggs, self_join, WIDE_FACTOR)
        return _run(spark, sql, {"right_rows": right} if self_join else both)
    if not told_apart and not unique_ids(left, join.row_id):
        held = with_handle(left)
        ids = [c.strip("`") for c in join.row_id]
        found = interval_aggregate(held, right, replace(join, row_id=(f"`{HANDLE}`",)), form, True)
        return held.select(HANDLE, *[F.col(f"`{c}`") for c in ids]).join(found, HANDLE).select(*[F.col(f"`{c}`") for c in ids], *[F.col(f"`{a.alias}`") for a in join.aggs])
    # holistic aggregates of columns with few values become counts, which merge
    known: dict[str, tuple[list, list[Agg]]] = {}
    for value in dict.fromkeys(a.value_sql for a in holistic):
        values = value_counts.few_values(right, value)
        if values is not None:
            known[value] = (values, value_counts.count_aggs(value, values, f"v{len(known)}"))
    counted = [a for a in holistic if a.value_sql in known]
    holistic = [a for a in holistic if a.value_sql not in known]
    running = [*mergeable, *[c for _, aggs in known.values() for c in aggs]]
    parts = [ordered.decayed(left, right, join, a) for a in faded]
    if running:
        fits = largest is not None and largest <= skew.hot_rows(spark)
        cuts = None if fits else hot_cuts(left, right, join)
        sql = mergeable_sql(join, running, cuts is not None)
        part = _run(spark, sql, both if cuts is None else {**both, "hot_cuts": cuts})
        derived = []
        for a in counted:
            values, aggs = known[a.value_sql]
            derived.append(value_counts.final(a, values, [F.col(c.alias) for c in aggs]).alias(a.alias))
        ids = [F.col(c) for c in join.row_id]
        parts.append(part.select(*ids, *[F.col(f"`{a.alias}`") for a in mergeable], *derived))
    elif counted:  # no value at all on the right side
        derived = [value_counts.final(a, [], []).alias(a.alias) for a in counted]
        parts.append(left.select(*[F.col(c) for c in join.row_id], *derived))
    refined = [a for a in holistic if ordered.splits(a, join)]
    holistic = [a for a in holistic if a not in refined]
    parts += ordered.aggregate(left, right, join, refined)
    if holistic:
        parts.append(_run(spark, sliding_sql(join, holistic, self_join), {"right_rows": right} if self_join else both))
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, [c.strip("`") for c in join.row_id], "inner")
    return out.select(*join.row_id, *[F.col(f"`{a.alias}`") for a in join.aggs])


HANDLE = "__handle"


def unique_ids(df: DataFrame, ids) -> bool:
    """Whether the columns tell all rows of `df` apart and are never null: one narrow aggregate, once a frame."""
    key = tuple(c.strip("`") for c in ids)
    known = df.__dict__.setdefault("_unique_ids", {})
    if key not in known:
        missing = F.lit(False)
        for c in key:
            missing = missing | F.col(f"`{c}`").isNull()
        counts = df.groupBy(*[F.col(f"`{c}`").alias(f"i{i}") for i, c in enumerate(key)]).agg(F.count(F.lit(1)).alias("n"), F.max(missing).alias("missing"))
        row = counts.agg(F.max("n"), F.max("missing")).first()
        known[key] = not row[0] or (row[0] == 1 and not row[1])
    return known[key]


def with_handle(df: DataFrame) -> DataFrame:
    """The rows with a number each, written down, so that a task that runs again finds the same."""
    out = checkpoint(df.withColumn(HANDLE, F.monotonically_increasing_id()))
    for f in df.schema.fields:
        if f.metadata:
            out = out.withMetadata(f.name, f.metadata)
    return out


def _same_side(left: DataFrame, right: DataFrame, join: IntervalJoin) -> bool:
    if join.left_keys != join.right_keys or join.left_order != join.right_order:
        return False
    return left is right or left.sameSemantics(right)


_VIEWS = re.compile(r"\b(left_rows|right_rows|hot_cuts)\b")


def _run(spark, sql: str, args: dict) -> DataFrame:
    """Run the text with DataFrames in the place of its views."""
    text = _VIEWS.sub(r"{\1}", sql.replace("{", "{{").replace("}", "}}"))
    return spark.sql(text, **args)


_CENTERED = {"s1", "s2", "s3", "s4", "sdx"}


def plan_interval(
    left: DataFrame,
    right: DataFrame,
    aggs: list[Agg],
    *,
    on: list[tuple[str, str]],
    times: tuple[str, str],
    row_id: list[str],
    horizon: int = 0,
    memory: int | None = None,
) -> IntervalJoin:
    """Resolve columns and the few constants (column means, time origin) of a join."""
    left_time, right_time = times
    unit = ticks_per_unit(right, right_time)
    right_order = order_sql(right, right_time)
    powers = {
        a.value_sql for a in aggs if a.mergeable and _CENTERED & set(MERGEABLE[a.func].states) and a.func not in ("AVG", "SUM")
    }
    moving = any(a.mergeable and MERGEABLE[a.func].needs_now for a in aggs)
    origin, centers, span = 0, {}, (memory or 0) / unit
    if powers or (moving and memory is None):
        exprs = [F.expr(f"avg(CAST({x} AS DOUBLE))") for x in powers]
        row = right.agg(F.expr(f"min({right_order})"), F.expr(f"max({right_order})"), *exprs).first()
        origin = row[0] or 0
        centers = {x: round(v, 6) for x, v in zip(powers, row[2:]) if v is not None and v == v and abs(v) < 1e300}
        if memory is None:
            span = ((row[1] or 0) - origin) / unit
    # both sums use the same centre wherever they share a column
    return IntervalJoin(
        left_keys=tuple(f"`{k}`" for k, _ in on),
        right_keys=tuple(f"`{k}`" for _, k in on),
        left_order=order_sql(left, left_time),
        right_order=right_order,
        row_id=tuple(f"`{c}`" for c in row_id),
        aggs=tuple(aggs),
        horizon=horizon,
        memory=memory,
        unit=unit,
        centers=centers,
        origin=origin,
        span=span,
    )


def range_aggregate(left: DataFrame, right: DataFrame, aggs: list[Agg], **bounds) -> DataFrame:
    """`plan_interval` + `interval_aggregate`."""
    return interval_aggregate(left, right, plan_interval(left, right, aggs, **bounds))
