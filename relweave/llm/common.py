"""Helpers of the corpus operators: tables, row streams to Python, small models."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shipped

GROUP_CHARS = 500_000
BATCH_ROWS, BATCH_BYTES = 2000, 8 * 2**20

_kept: dict[str, object] = {}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def groups(texts: list[str | None], chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Cut a batch into runs of about `chars` characters, so that numpy's work space stays small.

    A longer text is a run of its own. Yields the position of the first text of each run.
    """
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if held and size + len(text) > chars:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def kept(name: str, build: Callable[[], object]) -> object:
    """What a Python worker holds on to for its next tasks: one object, that of the latest operator."""
    if name not in _kept:
        let_go()
        _kept[name] = build()
    return _kept[name]


def let_go() -> None:
    """Drop what the worker holds, and give the memory back to the machine where the C library can."""
    if _kept:
        _kept.clear()
        trim()


def trim() -> None:
    """Give memory that is no longer used back to the machine, where the C library can."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def streamed(df: DataFrame) -> DataFrame:
    """`df`, ready to go through Python: the package is there, and batches are small.

    Texts can be long, so a batch of Spark's usual 10,000 rows may be too much for a worker.
    """
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(re.sub("[a-z]", "", conf.get(key))) <= most:
            conf.set(key, str(most))
    return shipped(df)


def map_texts(docs: DataFrame, keep: list[str | Column], schema: str, work: Callable[[], Callable[[pa.RecordBatch, list[str]], list[pa.Array]]], text: str = "text", lasting: bool = False) -> DataFrame:
    """The columns `keep` of every row and new ones computed from its text, in Arrow batches.

    `work()` is called once per task and returns a function that gets a bounded run of
    rows and their texts (null: empty) and returns the arrays of the new columns, which
    `schema` names. Internal names are positions, so names of `docs` cannot clash. `lasting`
    says that `work` uses what the worker has kept; otherwise that is let go.
    """
    named = [isinstance(c, str) for c in keep]
    columns = [F.col(f"`{c}`") if n else c for c, n in zip(keep, named, strict=True)]
    at = keep.index(text) if text in [c for c, n in zip(keep, named, strict=True) if n] else len(keep)
    sent = docs.select(*[c.alias(f"c{i}") for i, c in enumerate([*columns, F.col(f"`{text}`")][: max(len(keep), at + 1)])])
    kinds = [f.dataType.simpleString() for f in sent.schema.fields[: len(keep)]]
    width = len(keep)
    names = [*[f"c{i}" for i in range(width)], *[f"n{i}" for i in range(len(schema.split(", ")))]]

    def run(batches):
        if not lasting:
            let_go()
        step = work()
        for batch in batches:
            for first, texts in groups(batch.column(at).to_pylist()):
                rows = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([*rows.columns[:width], *step(rows, texts)], names=names)

    new = [x.split(" ", 1) for x in schema.split(", ")]
    out = streamed(sent).mapInArrow(run, ", ".join([*[f"c{i} {k}" for i, k in enumerate(kinds)], *[f"n{i} {k}" for i, (_, k) in enumerate(new)]]))
    return out.toDF(*[c if n else f"c{i}" for i, (c, n) in enumerate(zip(keep, named, strict=True))], *[n for n, _ in new])


def ranges(starts, lengths):
    """Concatenated ranges start, start + 1, ... of the given lengths, as one index array."""
    import numpy as np

    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)
