"""Importance resampling towards a target corpus by hashed word n-grams.

Both corpora are counted into buckets of features, every document gets the sum of its
features' log gains as an array lookup, and a Gumbel draw on top of it turns the best
scores into a sample without replacement. The cut-off is found by bisection with exact
counts over the written scores; only the drawn rows are sorted, by range, for their ranks.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .common import streamed

BUCKETS, LONGEST, LEAST_WORDS = 10_000, 3, 20
PERCENT, SEED = 5, 42
PIECE = 1 << 20
WAYS = 16
ROWS_A_RANGE = 250_000

_blank = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


# ---- features


def runs(text: bytes, longest: int = LONGEST) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each piece of a text: its words, and the crc32 of all runs of 1, 2, ... words that end in it.

    Letters, digits and everything beyond ASCII make words; A-Z are lower-cased. The
    checksum of a run goes on from that of its beginning, so no run is put together.
    Pieces bound the work space of a long text; their last words are carried over.
    """
    before: list[bytes] = []
    first = 0
    while first < len(text):
        last = first + PIECE
        tail = b""
        while last < len(text):  # a piece ends at a separator
            tail = text[last : last + 4096].lower().translate(_blank)
            cut = tail.find(b" ")
            if cut >= 0:
                last += cut
                break
            last += 4096
        words = text[first:last].lower().translate(_blank).split()
        first = last
        held, n = len(before), len(words)
        words = before + words
        spaced = [b" " + w for w in words]
        chain = list(map(crc32, words))
        out = [np.array(chain[held:], dtype=np.int64)]
        for k in range(1, longest):
            chain = list(map(crc32, spaced[k:], chain))
            out.append(np.array(chain[max(0, held - k) :], dtype=np.int64))
        yield n, out
        before = words[len(words) - min(len(words), longest - 1) :]


def counted(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How often each bucket is met in all texts; a task sends at most one row a bucket."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                for _, found in runs(value or b"", longest):
                    for codes in found:
                        total += np.bincount(codes % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    sent = streamed(texts).select(F.col(f"`{text}`").cast("binary").alias("t"))
    rows = sent.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the source) for each bucket."""
    n = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = LONGEST) -> DataFrame:
    """(key, n_words, n_features, weight) of every row of `docs`."""
    kind, buckets = docs.schema[key].dataType.simpleString(), len(gain)

    def run(batches):
        for batch in batches:
            out = np.zeros((3, batch.num_rows), dtype=np.int64)
            for i, value in enumerate(batch.column(1).to_pylist()):
                for n, found in runs(value or b"", longest):
                    out[:, i] += (n, sum(map(len, found)), sum(int(gain[codes % buckets].sum()) for codes in found))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x) for x in out]], names=["key", "n_words", "n_features", "weight"])

    sent = streamed(docs).select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("t"))
    return sent.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long")


# ---- the draw


def nth_largest(rows: DataFrame, column: str, n: int) -> tuple[int, int]:
    """The n-th largest value of a column of whole numbers, and how many rows are above it.

    Every job counts the rows above each of a few evenly spaced numbers exactly, so the
    open interval shrinks by that factor; no row leaves its place.
    """
    low, high = (int(v) for v in rows.agg(F.min(column), F.max(column)).first())
    above = 0  # rows over `high`
    while low < high:  # the value lies in low..high
        marks = sorted({low + (high - low) * i // WAYS for i in range(1, WAYS)} | {high - 1} - {low - 1})
        inside = rows.where(F.col(column).between(low, high))
        counts = inside.agg(*[F.count(F.when(F.col(column) > F.lit(m), 1)) for m in marks]).first()
        start, over = low, above
        for mark, count in reversed(list(zip(marks, counts, strict=True))):
            if above + count >= n:
                start = mark + 1
                break
            high, over = mark, above + count
        low, above = start, over
    return high, above


def cut_off(rows: DataFrame, order: list[str], n: int) -> Column:
    """Whether a row is one of the n largest by the columns in turn, for 0 < n < rows; the last column has no ties."""
    equal, larger, left = F.lit(True), F.lit(False), n
    for name in order:
        value, above = nth_largest(rows.where(equal), name, left)
        larger = larger | equal & (F.col(name) > F.lit(value))
        equal = equal & (F.col(name) == F.lit(value))
        left -= above
        if name == order[-1] or rows.where(equal).count() == left:
            break
    return larger | equal


def noise(key: Column, seed: int = SEED) -> Column:
    """floor(1000 times a Gumbel variable) that depends on the key and the seed alone."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    u = (F.conv(head, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def ranked(drawn: DataFrame, order: list[str], n: int) -> DataFrame:
    """`drawn` with `rank` 1, 2, ... by falling columns: sorted by range, then moved by the sizes of the ranges before."""
    ranges = max(8, -(-n // ROWS_A_RANGE))
    by = [F.desc(c) for c in order]
    placed = checkpoint(drawn.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()))
    piece = F.shiftright("at", 33)
    sizes = sorted((int(p), int(c)) for p, c in placed.groupBy(piece.alias("p")).count().collect())
    offsets, before = [], 0
    for p, count in sizes:
        offsets.append((p, before))
        before += count
    if not offsets:
        return placed.drop("at").withColumn("rank", F.lit(None).cast("long"))
    known = drawn.sparkSession.createDataFrame(offsets, "p long, before long")
    found = placed.withColumn("p", piece).join(F.broadcast(known), "p")  # one row a range
    return found.withColumn("rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("p", "at", "before")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(key, n_features, weight, score, rank) of every row of `docs`; rank is null for those not drawn.

    Of the rows with at least `least_words` words, `percent` in a hundred (rounded down)
    are drawn by score: weight plus noise of the key. Ties go to the smaller key, null keys
    last, then to the row with more features; rows equal in all of that are told apart by
    a number given once. Repeated rows are drawn one by one. Null and empty texts have no
    features and weight 0; an empty `target` gives every bucket the smoothed share. Texts
    of any length go through in pieces. An empty table gives an empty one. Keys are whole
    numbers; other columns of `docs` do not matter, whatever their names.
    """
    gain = gains(counted(docs, text, buckets), counted(target, target_text, buckets))
    rows = weighed(docs, gain, key, text).withColumn("score", F.col("weight") + noise(F.col("key"), seed))
    smaller_first = F.coalesce(F.bitwise_not(F.col("key").cast("long")), F.lit(-(1 << 63)))
    rows = checkpoint(rows.withColumn("down", smaller_first).withColumn("handle", F.monotonically_increasing_id()))
    fit = F.col("n_words") >= least_words
    n = rows.where(fit).count()
    take = percent * n // 100
    order = ["score", "down", "n_features", "handle"]
    chosen = F.lit(False) if not take else fit if take >= n else fit & cut_off(rows.where(fit), order, take)
    names = [F.col("key").alias(key), "n_features", "weight", "score", "rank"]
    rest = rows.where(~chosen).withColumn("rank", F.lit(None).cast("long")).select(*names)
    return ranked(rows.where(chosen), order, take).select(*names).unionByName(rest)
