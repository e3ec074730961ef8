"""Compression of vectors to one code a part, by product quantisation in whole numbers.

Codebooks are improved in rounds: every task finds the nearest entry of each of its parts
and sends one sum an entry. The search is the equal-average one: entries are sorted by the
sum of their components, and since (sum of x - sum of c)^2 / dimension never exceeds the
squared distance, a search that goes outward from the part's own sum can stop early.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import SALTS
from ..session import checkpoint
from .common import streamed

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
MOST = 1 << 20
RUN, BLOCK, LOT = 512, 32, 16_384


class Codebook:
    """Entries of one part position, sorted by the sum of their components."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        sums = entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums, self.sorted = sums[self.order], entries[self.order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each part's nearest entry (ties: the lower) and the squared distance.

        Parts are taken in runs of similar sums; a run goes outward over blocks of sorted
        entries on both sides while any of its parts may still find a nearer entry there.
        """
        n, width = parts.shape
        best, found = np.full(n, np.iinfo(np.int64).max), np.zeros(n, dtype=np.int64)
        own = parts.sum(axis=1)
        most = max(int(np.abs(parts).max(initial=0)), int(np.abs(self.sorted).max(initial=0)))
        exact = np.float64 if 4 * most * most * max(1, width) < 2**53 else np.int64  # where every product is exact, doubles are faster
        points, entries = parts.astype(exact), self.sorted.astype(exact)
        point_norms, entry_norms = (points * points).sum(axis=1), (entries * entries).sum(axis=1)
        k = len(entries)
        by_sum = np.argsort(own, kind="stable")
        for first in range(0, n, RUN):
            run = by_sum[first : first + RUN]
            sums, x, norms = own[run], points[run], point_norms[run]
            near, at = best[run], found[run]
            right = int(np.searchsorted(self.sums, sums[len(sums) // 2]))
            left = right - 1
            go_right, go_left = True, True

            def gap(i: int) -> np.ndarray:
                return (self.sums[i] - sums).astype(np.float64) ** 2 * (1 - 1e-9)  # rounding never stops a search early

            def compare(a: int, b: int) -> None:
                block = np.arange(a, b)
                block = block[np.argsort(self.order[a:b], kind="stable")]  # so that the first minimum has the lowest index
                far = norms[:, None] + entry_norms[block] - 2 * (x @ entries[block].T)
                least = far.argmin(axis=1)
                d, i = far[np.arange(len(x)), least].astype(np.int64), self.order[block[least]]
                better = (d < near) | (d == near) & (i < at)
                near[better], at[better] = d[better], i[better]

            while go_right or go_left:
                if go_right:
                    go_right = right < k and bool(((self.sums[right] <= sums) | (gap(right) <= near * float(width))).any())
                    if go_right:
                        compare(right, min(k, right + BLOCK))
                        right += BLOCK
                if go_left:
                    go_left = left >= 0 and bool(((self.sums[left] >= sums) | (gap(left) <= near * float(width))).any())
                    if go_left:
                        compare(max(0, left + 1 - BLOCK), left + 1)
                        left -= BLOCK
            best[run], found[run] = near, at
        return found, best


# ---- vectors


def usable(vectors: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(key, label, x): x holds floor(scale * component); unusable vectors are left out."""
    own = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.transform(F.col(f"`{vector}`"), lambda v: v.cast("double")).alias("x"))
    own = own.where(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    whole = lambda v: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(v * scale))).cast("int")
    return own.withColumn("x", F.transform("x", whole))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of `width` numbers, shorter ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to about `LOT` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= LOT:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def assigned(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (row, part) and squared distances of the rows' parts."""
    parts, _, width = books.shape
    found = [Codebook(books[p]).nearest(x[:, p * width : (p + 1) * width]) for p in range(parts)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def improved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of the mean of its parts; unused entries stay."""
    parts, k, width = books.shape

    def run(batches):
        sums, counts = np.zeros((parts, k, width), dtype=np.int64), np.zeros((parts, k), dtype=np.int64)
        for table in lots(batches):
            x = matrix(table.column("x").combine_chunks(), parts * width)
            codes, _ = assigned(x, books)
            for p in range(parts):
                order = np.argsort(codes[:, p], kind="stable")
                used, starts = np.unique(codes[order, p], return_index=True)
                sums[p, used] += np.add.reduceat(x[order, p * width : (p + 1) * width], starts, axis=0)
                counts[p, used] += np.diff([*starts, len(x)])
        flat = np.concatenate([counts[:, :, None], sums], axis=2).ravel()
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(flat[some], pa.int64())], names=["slot", "total"])

    totals = np.zeros(parts * k * (width + 1), dtype=np.int64)
    # at most one row for each component of the codebooks
    for slot, total in rows.select("x").mapInArrow(run, "slot long, total long").groupBy("slot").agg(F.sum("total").alias("total")).collect():
        totals[slot] = total
    totals = totals.reshape(parts, k, width + 1)
    counts = totals[:, :, :1]
    return np.where(counts > 0, totals[:, :, 1:] // np.maximum(counts, 1), books)


def trained(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, component) of (key, x) rows; None without rows.

    They start as the parts of the rows with the smallest keys (nulls last, equal keys by
    their vectors) and see all rows in every round.
    """
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if dims is None:
        return None
    first = [r[0] for r in rows.select("key", "x").orderBy(F.col("key").asc_nulls_last(), "x").limit(entries).select("x").collect()]
    width = -(-dims // parts)
    books = matrix(pa.array(first, pa.list_(pa.int64())), parts * width).reshape(len(first), parts, width).transpose(1, 0, 2)
    for _ in range(rounds):
        books = improved(rows, books)
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(key, label, code, error, label_error, codebooks_sha256) of every usable vector.

    `code` has two hex digits a part (entries up to 256), `error` is the squared distance to
    the coded vector, `label_error` its sum over the rows of that label, nulls together.
    Vectors that are null or hold null or non-finite components are left out; repeated rows
    and keys stay, and so do null keys. Vectors of unequal length, or of one that `parts`
    does not divide, are filled up with zeros at the end, an empty one too. Components beyond
    2^20 after scaling count as 2^20, so that all distances are exact. An empty table gives an
    empty one. Further columns do not matter, whatever their names.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has two hex digits")
    rows = streamed(usable(vectors, key, vector, label, scale))
    books = trained(rows, parts, entries, rounds)
    kinds = [vectors.schema[c].dataType.simpleString() for c in (key, label)]

    def run(batches):
        for table in lots(batches):
            codes, errors = assigned(matrix(table.column("x").combine_chunks(), books.shape[0] * books.shape[2]), books)
            text = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            for batch in pa.table([table.column("key"), table.column("label"), pa.array(text, pa.string()), pa.array(errors.sum(axis=1))], names=["key", "label", "code", "error"]).to_batches():
                yield batch

    if books is None:
        rows = rows.select("key", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        rows = rows.mapInArrow(run, f"key {kinds[0]}, label {kinds[1]}, code string, error long")
    rows = checkpoint(rows)
    # a label may hold most rows, and there may be many labels: rows are spread over salts, sums repeated for each
    salt = F.pmod(F.xxhash64("key", "code"), F.lit(SALTS))
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("own"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("place"))
    salted = rows.withColumn("salt", salt)
    found = salted.join(sums, F.col("label").eqNullSafe(F.col("own")) & (F.col("salt") == F.col("place")))
    sha = digest(books) if books is not None else ""
    return found.select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
