"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are the presence of lower-cased character 4- and 5-grams, hashed to 2^20 places.
Each place is scaled by log((toxic texts with it + a) / (toxic texts + 2a)) minus the same of clean
texts; a logistic regression learns the weights of the places whose ratio is best supported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .common import groups, map_texts, streamed, trim

BITS = 20
SIZES = (4, 5)
SAMPLE = 12_000
PLACES = 6_000


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the text and the place of every n-gram; blanks stand before and after a text."""
    pad = " " * (max(SIZES) - 1)
    lowered = [f" {t.lower()}{pad}" for t in texts]
    lengths = np.array([len(t) for t in lowered], dtype=np.int64)
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    codes[(codes >= 9) & (codes <= 13)] = 32
    whose = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    last = np.cumsum(lengths) - len(pad)
    inside = np.ones(len(codes), dtype=bool)
    for k in range(len(pad)):
        inside[last + k] = False
    value = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(SIZES) + 1):
        value = value[: len(codes) - n + 1] * np.uint64(1_000_003) + codes[n - 1 :]
        if n in SIZES:
            place = ((value + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
            here = inside[: len(place)]
            yield whose[: len(place)][here], place[here].astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Bias and weight of each place (ratio times learnt weight); most places have none."""

    bias: float
    places: np.ndarray
    weights: np.ndarray

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        used, weight = np.zeros(1 << BITS, dtype=bool), np.zeros(1 << BITS)
        used[self.places] = True
        weight[self.places] = self.weights
        return used, weight

    def scores(self, texts: list[str], table) -> np.ndarray:
        used, weight = table
        total = np.full(len(texts), self.bias)
        rows, places = [], []
        for whose, place in grams(texts):
            hit = used[place]
            rows.append(whose[hit])
            places.append(place[hit])
        both = np.unique(np.concatenate(rows).astype(np.int64) << BITS | np.concatenate(places))
        total += np.bincount(both >> BITS, weights=weight[both & ((1 << BITS) - 1)], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def log_odds(share: float) -> float:
    return float(np.log(share / (1 - share)))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(toxic, t): texts of at most `sample` labelled documents outside the held-out fold.

    The fold is crc32 of the id as text, modulo 5; which documents are taken is decided
    by a hash of the id. Labels without an id or mark are left out; where an id has
    several marks, the highest holds. Of rows that share an id the one whose text has the
    smallest hash is taken, so a repeated id adds no rows.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    known = known.where(F.crc32(F.col("id").cast("string")) % 5 != 0).groupBy("id").agg(F.max("toxic").alias("toxic"))
    few = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("t")).join(F.broadcast(few), "id")
    first = F.min(F.struct(F.xxhash64("t").alias("order"), "t"))
    return texts.groupBy("id").agg(F.max("toxic").alias("toxic"), first.alias("first")).select("toxic", "first.t")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, places: int = PLACES, smooth: float = 0.5) -> Model:
    """Fit on the labelled sample; ids, languages and sources are not looked at.

    Counts of each place are summed in Spark. The driver gets the `places` best ones and,
    for each sampled text, which of them it holds. Without toxic examples every score is
    near 0, without clean ones near 1.
    """
    rows = checkpoint(labelled(docs, labels, sample))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model(10.0 if toxic else -10.0, np.empty(0, np.int64), np.empty(0))

    def count(batches):
        found = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            marks = np.array(batch.column(0).to_pylist(), dtype=np.int64)
            for first, texts in groups(batch.column(1).to_pylist()):
                for whose, place in grams(texts):
                    both = np.unique(whose.astype(np.int64) << BITS | place)
                    mark = marks[first + (both >> BITS)]
                    for k in (0, 1):
                        found[k] += np.bincount(both[mark == k] & ((1 << BITS) - 1), minlength=1 << BITS)
        some = np.flatnonzero(found.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[1][some]), pa.array(found[0][some])], names=["place", "toxic", "clean"])

    counts = streamed(rows).mapInArrow(count, "place long, toxic long, clean long").groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = F.log((F.col("toxic") + smooth) / (toxic + 2 * smooth)) - F.log((F.col("clean") + smooth) / (clean + 2 * smooth))
    merit = F.abs(ratio) * F.sqrt(F.when(ratio > 0, F.col("toxic") / toxic).otherwise(F.col("clean") / clean))
    best = counts.select("place", ratio.alias("ratio"), merit.alias("merit")).orderBy(F.desc("merit"), "place").limit(places).collect()
    chosen = np.array([r["place"] for r in best], dtype=np.int64)
    ratios = np.array([r["ratio"] for r in best])
    index = np.full(1 << BITS, -1, dtype=np.int32)
    index[chosen] = np.arange(len(chosen))

    def present(batches):
        for batch in batches:
            marks = batch.column(0).to_pylist()
            for first, texts in groups(batch.column(1).to_pylist()):
                parts = []
                for whose, place in grams(texts):
                    at = index[place]
                    parts.append(whose[at >= 0].astype(np.int64) << 32 | at[at >= 0])
                both = np.unique(np.concatenate(parts))
                ends = np.cumsum(np.bincount(both >> 32, minlength=len(texts)))
                held = np.split((both & 0xFFFFFFFF).astype(np.int32), ends[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(marks[first : first + len(texts)], pa.int32()), pa.array(list(held), pa.list_(pa.int32()))], names=["toxic", "held"])

    # as flat arrays: lists of Python numbers would take many times the room
    found = streamed(rows).mapInArrow(present, "toxic int, held array<int>").orderBy("toxic", "held").toArrow().combine_chunks()
    lists = found.column("held").combine_chunks()
    target = found.column("toxic").to_numpy().astype(float)
    model = fit(target, np.diff(lists.offsets.to_numpy()).astype(np.int64), lists.flatten().to_numpy().astype(np.int64), chosen, ratios)
    del found, lists
    trim()
    return model


def fit(target: np.ndarray, lengths: np.ndarray, held: np.ndarray, chosen: np.ndarray, ratios: np.ndarray, rounds: int = 150, decay: float = 1e-4) -> Model:
    """Logistic regression on the scaled places, started at equal weights, by Adam on all rows at once."""
    rows = np.repeat(np.arange(len(target)), lengths)
    scaled = ratios[held]
    balance = np.where(target > 0, 0.5 / max(target.mean(), 1e-9), 0.5 / max(1 - target.mean(), 1e-9)) / len(target)
    w, b = np.full(len(chosen), 0.1), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        margin = np.bincount(rows, weights=scaled * w[held], minlength=len(target)) + b
        error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - target) * balance
        gw = np.bincount(held, weights=scaled * error[rows], minlength=len(chosen)) + decay * w
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.99**t
        w = w - 0.05 * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b = b - 0.05 * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return Model(float(b), chosen, ratios * w)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The columns `keep` and a score from 0 to 1 of every row; null texts count as empty."""

    def work():
        table = model.table()
        return lambda rows, texts: [pa.array(model.scores(texts, table))]

    return map_texts(docs, keep, f"{name} double", work, text)
