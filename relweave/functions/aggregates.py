"""Aggregates as mergeable states plus a final expression, in Spark SQL text.

Every *mergeable* aggregate is a set of states that combine by sum, min or max.
One definition therefore serves a plain GROUP BY (partial aggregation on the map
side), a running window, and the merge of two window halves. *Holistic* aggregates
(quantiles, mode, distinct counts ...) need all values; they are computed from the
value histogram of a group, or over a sliding frame.

Placeholders: {x} value, {t} order number of the row, {d} its distance in units
from the reference point of its block, {c} a constant near the column's mean (power
sums of x - c do not cancel), {now} the order number of the left row, {u} ticks per unit.
Variance and standard deviation are those of the population.
"""

from __future__ import annotations

from dataclasses import dataclass

# state: (aggregate over rows, how two partial values merge)
STATES = {
    "n": ("count({x})", "sum"),
    "s1": ("sum({x} - {c})", "sum"),
    "s2": ("sum(({x} - {c}) * ({x} - {c}))", "sum"),
    "s3": ("sum(({x} - {c}) * ({x} - {c}) * ({x} - {c}))", "sum"),
    "s4": ("sum(({x} - {c}) * ({x} - {c}) * ({x} - {c}) * ({x} - {c}))", "sum"),
    "sq": ("sum(({x}) * ({x}))", "sum"),
    "mn": ("min({x})", "min"),
    "mx": ("max({x})", "max"),
    "amx": ("max(abs({x}))", "max"),
    "t0": ("min(CASE WHEN {x} IS NOT NULL THEN {t} END)", "min"),
    "t1": ("max(CASE WHEN {x} IS NOT NULL THEN {t} END)", "max"),
    "first": ("min(CASE WHEN {x} IS NOT NULL THEN struct({t} AS o, {x} AS v) END)", "min"),
    "last": ("max(CASE WHEN {x} IS NOT NULL THEN struct({t} AS o, {x} AS v) END)", "max"),
    "fmx": ("max(CASE WHEN {x} IS NOT NULL THEN struct({x} AS v, -({t}) AS o) END)", "max"),
    "lmx": ("max(CASE WHEN {x} IS NOT NULL THEN struct({x} AS v, {t} AS o) END)", "max"),
    "fmn": ("min(CASE WHEN {x} IS NOT NULL THEN struct({x} AS v, {t} AS o) END)", "min"),
    "lmn": ("min(CASE WHEN {x} IS NOT NULL THEN struct({x} AS v, -({t}) AS o) END)", "min"),
    "sd": ("sum(CASE WHEN {x} IS NOT NULL THEN {d} END)", "sum"),
    "sdd": ("sum(CASE WHEN {x} IS NOT NULL THEN {d} * {d} END)", "sum"),
    "sdx": ("sum(({x} - {c}) * {d})", "sum"),
    "ex": ("sum({x} * power(2D, {d} / {p}))", "sum"),
    "ew": ("sum(CASE WHEN {x} IS NOT NULL THEN power(2D, {d} / {p}) END)", "sum"),
}

# distance states re-expressed relative to the left row; {r} = distance of the left row
REBASE = {
    "sd": "{sd} - {n} * {r}",
    "sdd": "{sdd} - 2 * {r} * {sd} + {n} * {r} * {r}",
    "sdx": "{sdx} - {r} * {s1}",
    "ex": "{ex} * power(2D, -({r}) / {p})",
    "ew": "{ew} * power(2D, -({r}) / {p})",
}
REBASE_NEEDS = {"sd": ["n"], "sdd": ["sd", "n"], "sdx": ["s1"], "ex": [], "ew": []}

_VAR = "CASE WHEN {mn} = {mx} THEN 0D ELSE greatest({s2} / {n} - ({s1} / {n}) * ({s1} / {n}), 0D) END"
_M3 = "({s3} / {n} - 3 * ({s1} / {n}) * ({s2} / {n}) + 2 * power({s1} / {n}, 3))"
_M4 = (
    "({s4} / {n} - 4 * ({s1} / {n}) * ({s3} / {n}) + 6 * power({s1} / {n}, 2) * ({s2} / {n})"
    " - 3 * power({s1} / {n}, 4))"
)
_SLOPE = "(({n} * {sdx} - {sd} * {s1}) / nullif({n} * {sdd} - {sd} * {sd}, 0D))"


@dataclass(frozen=True)
class Mergeable:
    states: tuple[str, ...]
    final: str
    grouped: str | None = None  # built-in used by a plain GROUP BY
    needs_time: bool = False  # {t} of the right row
    needs_now: bool = False  # {t} of the left row
    numeric: bool = True


MERGEABLE = {
    "COUNT": Mergeable(("n",), "coalesce({n}, 0)", numeric=False),
    "SUM": Mergeable(("n", "s1"), "CASE WHEN {n} > 0 THEN {s1} + {n} * {c} END", "sum({x})"),
    "AVG": Mergeable(("n", "s1"), "CASE WHEN {n} > 0 THEN {s1} / {n} + {c} END", "avg({x})"),
    "MIN": Mergeable(("mn",), "{mn}"),
    "MAX": Mergeable(("mx",), "{mx}"),
    "ABS_MAX": Mergeable(("amx",), "{amx}"),
    "RMS": Mergeable(("n", "sq"), "CASE WHEN {n} > 0 THEN sqrt({sq} / {n}) END"),
    "VAR": Mergeable(("n", "s1", "s2", "mn", "mx"), f"CASE WHEN {{n}} > 0 THEN {_VAR} END", "var_pop({x})"),
    "STDDEV": Mergeable(("n", "s1", "s2", "mn", "mx"), f"CASE WHEN {{n}} > 0 THEN sqrt({_VAR}) END", "stddev_pop({x})"),
    "VARIATION_COEFFICIENT": Mergeable(
        ("n", "s1", "s2", "mn", "mx"),
        f"CASE WHEN {{n}} > 0 THEN sqrt({_VAR}) / nullif({{s1}} / {{n}} + {{c}}, 0D) END",
        "stddev_pop({x}) / nullif(avg({x}), 0D)",
    ),
    "SKEW": Mergeable(
        ("n", "s1", "s2", "s3", "mn", "mx"),
        f"CASE WHEN {{mn}} < {{mx}} THEN {_M3} / power(nullif({_VAR}, 0D), 1.5D) END",
        "skewness({x})",
    ),
    "KURTOSIS": Mergeable(
        ("n", "s1", "s2", "s3", "s4", "mn", "mx"),
        f"CASE WHEN {{mn}} < {{mx}} THEN {_M4} / power(nullif({_VAR}, 0D), 2) - 3 END",
        "kurtosis({x})",
    ),
    "FIRST": Mergeable(("first",), "{first}.v", needs_time=True, numeric=False),
    "LAST": Mergeable(("last",), "{last}.v", needs_time=True, numeric=False),
    "AVG_TIME_BETWEEN": Mergeable(
        ("n", "t0", "t1"),
        "CASE WHEN {n} > 1 THEN ({t1} - {t0}) / {u} / ({n} - 1) END",
        needs_time=True,
        numeric=False,
    ),
    "TREND": Mergeable(
        ("n", "s1", "sd", "sdd", "sdx", "t0", "t1"),
        f"CASE WHEN {{t0}} < {{t1}} THEN ({{s1}} - {_SLOPE} * {{sd}}) / {{n}} + {{c}} END",
        needs_time=True,
        needs_now=True,
    ),
    "EWMA": Mergeable(("ex", "ew"), "{ex} / nullif({ew}, 0D)", needs_time=True, needs_now=True),
    "TIME_SINCE_FIRST": Mergeable(("t0",), "({now} - {t0}) / {u}", needs_time=True, needs_now=True, numeric=False),
    "TIME_SINCE_LAST": Mergeable(("t1",), "({now} - {t1}) / {u}", needs_time=True, needs_now=True, numeric=False),
    "TIME_SINCE_FIRST_MAX": Mergeable(("fmx",), "({now} + {fmx}.o) / {u}", needs_time=True, needs_now=True),
    "TIME_SINCE_LAST_MAX": Mergeable(("lmx",), "({now} - {lmx}.o) / {u}", needs_time=True, needs_now=True),
    "TIME_SINCE_FIRST_MIN": Mergeable(("fmn",), "({now} - {fmn}.o) / {u}", needs_time=True, needs_now=True),
    "TIME_SINCE_LAST_MIN": Mergeable(("lmn",), "({now} + {lmn}.o) / {u}", needs_time=True, needs_now=True),
}

# Forms over the sorted array {a} of the values in a sliding frame; {n} its size, {m} the mean.
HOLISTIC = {
    "QUANTILE": (
        "CASE WHEN {n} > 0 THEN {a}[int(floor({p} * ({n} - 1)))] + ({p} * ({n} - 1) - floor({p} * ({n} - 1)))"
        " * ({a}[int(ceil({p} * ({n} - 1)))] - {a}[int(floor({p} * ({n} - 1)))]) END"
    ),
    "MODE": "{mode}",
    "COUNT_DISTINCT": "size(array_distinct({a}))",
    "COUNT_MINUS_DISTINCT": "{n} - size(array_distinct({a}))",
    "PERCENT_UNIQUE": "CASE WHEN {n} > 0 THEN size(array_distinct({a})) / {n} END",
    "NUM_MAX": "size(filter({a}, v -> v = array_max({a})))",
    "NUM_MIN": "size(filter({a}, v -> v = array_min({a})))",
    "COUNT_ABOVE_MEAN": "size(filter({a}, v -> v > {m}))",
    "COUNT_BELOW_MEAN": "size(filter({a}, v -> v < {m}))",
    "ENTROPY": (
        "CASE WHEN {n} > 0 THEN greatest(ln({n}) - aggregate(array_distinct({a}), 0D, (s, d) -> s +"
        " size(filter({a}, v -> v = d)) * ln(size(filter({a}, v -> v = d)))) / {n}, 0D) END"
    ),
}

# Forms over the histogram (__v, __k) of a group: distinct value and its count.
HISTOGRAM = {
    "COUNT_DISTINCT": "count(__v)",
    "COUNT_MINUS_DISTINCT": "sum(__k) - count(__v)",
    "PERCENT_UNIQUE": "count(__v) / sum(__k)",
    "MODE": "min(struct(-__k AS k, __v AS v)).v",
    "NUM_MAX": "max(struct(__v AS v, __k AS k)).k",
    "NUM_MIN": "min(struct(__v AS v, __k AS k)).k",
    "ENTROPY": "greatest(ln(sum(__k)) - sum(__k * ln(__k)) / sum(__k), 0D)",
    "COUNT_ABOVE_MEAN": None,
    "COUNT_BELOW_MEAN": None,
    "MEDIAN": None,
    "QUANTILE": None,
}
# Built-ins that lose fewer digits than power sums; used wherever the values themselves are at hand.
STABLE = ("SKEW", "KURTOSIS")
COUNT_LIKE = {"COUNT", "COUNT_DISTINCT", "COUNT_MINUS_DISTINCT", "NUM_MAX", "NUM_MIN", "COUNT_ABOVE_MEAN", "COUNT_BELOW_MEAN"}

# The three named sets of aggregates for numeric columns.
MINIMAL = ("AVG", "COUNT", "MAX", "MIN", "SUM")
DEFAULT = (
    "AVG", "COUNT", "FIRST", "LAST", "MAX", "MIN", "SKEW", "STDDEV", "SUM", "TREND",
    "AVG_TIME_BETWEEN", "TIME_SINCE_FIRST_MAX", "TIME_SINCE_LAST",
)
ALL = (
    *MERGEABLE,
    "MEDIAN", "MODE", "COUNT_DISTINCT", "COUNT_MINUS_DISTINCT", "PERCENT_UNIQUE",
    "NUM_MAX", "NUM_MIN", "COUNT_ABOVE_MEAN", "COUNT_BELOW_MEAN", "ENTROPY",
)
QUANTILES = (0.01, 0.05, 0.10, 0.25, 0.75, 0.90, 0.95, 0.99)
CATEGORICAL = ("COUNT_DISTINCT", "COUNT_MINUS_DISTINCT", "PERCENT_UNIQUE", "ENTROPY")


@dataclass(frozen=True)
class Agg:
    """One aggregate of a right-hand column (SQL text), with an optional condition.

    `param` is the half-life of EWMA (in units: seconds or rows) or the share of QUANTILE.
    """

    func: str
    column: str | None = None
    condition: str | None = None
    name: str | None = None
    param: float | None = None

    def __post_init__(self):
        if self.func not in MERGEABLE and self.func not in HISTOGRAM:
            raise ValueError(f"unknown aggregate {self.func}")
        if self.func in ("EWMA", "QUANTILE") and self.param is None:
            raise ValueError(f"{self.func} needs a parameter")

    @property
    def mergeable(self) -> bool:
        return self.func in MERGEABLE

    @property
    def alias(self) -> str:
        if self.name:
            return self.name
        part = (self.column or "rows").strip("`")
        tail = "" if self.param is None else f"_{self.param:g}".replace(".", "_")
        return f"{self.func.lower()}{tail}__{part}"

    @property
    def value_sql(self) -> str:
        """The masked value: null where the condition does not hold."""
        value = self.column or "1"
        return f"CASE WHEN {self.condition} THEN {value} END" if self.condition else f"({value})"

    def describe(self) -> str:
        arg = self.column or "*"
        param = "" if self.param is None else f", {self.param:g}"
        where = f" WHERE {self.condition}" if self.condition else ""
        return f"{self.func}({arg}{param}){where}"
