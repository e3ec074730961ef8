"""Abstract join graph (placeholders) and the concrete tables behind it (container)."""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MANY_TO_MANY, MANY_TO_ONE, ONE_TO_ONE = "many_to_many", "many_to_one", "one_to_one"
PROPOSITIONALIZATION = "propositionalization"
RELATIONSHIPS = (MANY_TO_MANY, MANY_TO_ONE, ONE_TO_ONE, PROPOSITIONALIZATION)


def _pairs(on) -> tuple[tuple[str, str], ...]:
    """'k' | ('a', 'b') | ['k', ('a', 'b')] -> pairs of left and right key."""
    if on is None:
        return ()
    if isinstance(on, str):
        return ((on, on),)
    if isinstance(on, tuple):
        return ((on[0], on[1]),)
    return tuple(p for item in on for p in _pairs(item))


@dataclass(frozen=True)
class Join:
    right: Placeholder
    on: tuple[tuple[str, str], ...]
    time_stamps: tuple[str, str] | None = None
    relationship: str = MANY_TO_MANY
    horizon: int = 0
    memory: int | None = None
    lagged_targets: bool = False

    @property
    def is_lookup(self) -> bool:
        return self.relationship in (MANY_TO_ONE, ONE_TO_ONE)


@dataclass(frozen=True, eq=False)
class Placeholder:
    """A table's place in the graph. One table may take several places."""

    name: str
    row_id: tuple[str, ...] = ()
    joins: list[Join] = field(default_factory=list)

    def join(
        self,
        right: Placeholder,
        on=None,
        time_stamps=None,
        relationship: str = MANY_TO_MANY,
        horizon: int = 0,
        memory: int | None = None,
        lagged_targets: bool = False,
    ) -> Placeholder:
        if relationship not in RELATIONSHIPS:
            raise ValueError(f"unknown relationship {relationship}")
        if isinstance(time_stamps, str):
            time_stamps = (time_stamps, time_stamps)
        if time_stamps is None and (horizon or memory):
            raise ValueError("horizon and memory need time stamps")
        if lagged_targets and horizon <= 0:
            raise ValueError("lagged targets need a horizon above 0, else a row sees its own target")
        pairs = _pairs(on)
        if not pairs and time_stamps is None:
            raise ValueError("a join needs keys or time stamps")
        if time_stamps is not None and not self.row_id:
            raise ValueError(f"{self.name}: a time-bounded join needs the row id of its left table")
        self.joins.append(Join(right, pairs, time_stamps, relationship, horizon, memory, lagged_targets))
        return self


class DataModel:
    """Population placeholder plus named placeholders; `add` makes them attributes."""

    def __init__(self, population: Placeholder):
        self.population = population
        self._places: dict[str, Placeholder] = {}

    def add(self, *names: str, **places: Placeholder | list[Placeholder]) -> DataModel:
        for name in names:
            self._places[name] = Placeholder(name)
        self._places.update(places)
        return self

    def __getattr__(self, name: str):
        try:
            return self.__dict__["_places"][name]
        except KeyError:
            raise AttributeError(name) from None


class Container:
    """Concrete tables. Only the population is split; peripheral tables stay whole."""

    def __init__(self, population: DataFrame | None = None, split: Column | None = None, **subsets: DataFrame):
        self._split, self._population, self._subsets = split, population, subsets
        self._peripheral: dict[str, DataFrame] = {}
        self._frozen = False
        if population is None and not subsets:
            raise ValueError("give a population (with a split) or separate subsets")

    def add(self, **tables: DataFrame) -> Container:
        if self._frozen:
            raise ValueError("the container is frozen")
        self._peripheral.update(tables)
        return self

    def freeze(self) -> Container:
        self._frozen = True
        return self

    @property
    def peripheral(self) -> MappingProxyType:
        return MappingProxyType(self._peripheral)

    def subset(self, name: str) -> View:
        if name in self._subsets:
            rows = self._subsets[name]
        elif self._split is not None:
            rows = self._population.where(self._split == F.lit(name))
        else:
            raise KeyError(f"no subset {name}")
        return View(rows, dict(self._peripheral))

    @property
    def full(self) -> View:
        return View(self._population, dict(self._peripheral))

    train = property(lambda self: self.subset("train"))
    validation = property(lambda self: self.subset("validation"))
    test = property(lambda self: self.subset("test"))


@dataclass(frozen=True)
class View:
    """One subset of the population together with the peripheral tables."""

    population: DataFrame
    peripheral: dict[str, DataFrame]


class StarSchema(DataModel):
    """Data model and container in one, with joins on the population only."""

    def __init__(self, population: DataFrame | None = None, row_id=(), split: Column | None = None, **subsets: DataFrame):
        super().__init__(Placeholder("population", tuple(row_id)))
        self.container = Container(population, split, **subsets)

    def join(self, table: DataFrame, name: str, **spec) -> StarSchema:
        place = self._places.setdefault(name, Placeholder(name))
        self.population.join(place, **spec)
        self.container.add(**{name: table})
        return self

    train = property(lambda self: self.container.train)
    validation = property(lambda self: self.container.validation)
    test = property(lambda self: self.container.test)
    full = property(lambda self: self.container.full)


class TimeSeries(StarSchema):
    """A table joined to itself over time, with or without keys.

    The whole table serves as the right side, so test rows may look back at
    training rows, as far as the horizon allows.
    """

    def __init__(
        self, population: DataFrame, time_stamps: str, row_id, on=None, horizon: int = 0, memory: int | None = None,
        lagged_targets: bool = False, split: Column | None = None,
    ):
        super().__init__(population, row_id, split)
        self.join(
            population, "population_history", on=on, time_stamps=time_stamps, horizon=horizon, memory=memory,
            lagged_targets=lagged_targets,
        )
