"""Near duplicates by SimHash fingerprints, found through the anchor points of covering codes.

The 64 bits are cut into blocks with allowances that add up so that two fingerprints
within the threshold agree within the allowance in at least one block. The anchors of a
block are the words of a code that covers it: each fingerprint has a home anchor within
the covering radius, and visits every anchor within radius plus allowance. Whatever is
near a fingerprint in the block therefore visits its home, where the two are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .common import map_texts, streamed
from .components import components

SHINGLE = 4
THRESHOLD = 4
HOMES = 2048
PAIRS = 1 << 20


# ---- fingerprints


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of a text's word shingles as a signed 64-bit number; no words: zero.

    A-Z are lower-cased; words are separated by the ASCII white space characters only.
    """
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        spans = zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
        hashes = [xxh64_intdigest(joined[a:b], 42) for a, b in spans]
    bits = np.zeros(64, dtype=np.int64)
    values = np.array(hashes, dtype="<u8")
    for first in range(0, len(values), 1 << 15):
        part = np.unpackbits(values[first : first + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, text_hash, fingerprint) of every row; null texts count as empty, null keys stay null."""

    def work():
        return lambda rows, texts: [pa.array([fingerprint(t, shingle) for t in texts], pa.int64())]

    keys = [F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))]
    return map_texts(docs, keys, "fingerprint long", work, text).toDF("key", "text_hash", "fingerprint")


# ---- covering codes


class Block:
    """Some bits of a fingerprint, with a Hamming code on the first 15 or the trivial code (radius 0).

    The Hamming code of length 15 covers its space with radius 1; bits beyond it are
    free, so they belong to the anchor as they are.
    """

    def __init__(self, shift: int, bits: int, allowance: int, hamming: bool):
        self.shift, self.bits, self.allowance, self.hamming = shift, bits, allowance, hamming
        self.radius = 1 if hamming else 0
        self.checks = [sum(1 << (p - 1) for p in range(1, 16) if p >> c & 1) for c in range(4)] if hamming else []
        self.moves = self._moves()

    def syndrome(self, word: int) -> int:
        return sum(((word & m).bit_count() & 1) << c for c, m in enumerate(self.checks))

    def _moves(self) -> list[list[int]]:
        """For each syndrome, the differences that lead to an anchor within radius plus allowance."""
        reach = self.radius + self.allowance
        found: list[list[int]] = [[] for _ in range(1 << len(self.checks))]
        near = [(0, -1)]
        for _ in range(reach + 1):
            for word, _last in near:
                found[self.syndrome(word)].append(word)
            near = [(word | 1 << b, b) for word, last in near for b in range(last + 1, self.bits)]
        return found

    def home(self, word: np.ndarray) -> np.ndarray:
        """The anchor within the covering radius."""
        if not self.hamming:
            return word
        s = self.syndromes(word)
        return np.where(s > 0, word ^ (1 << np.maximum(s - 1, 0)), word)

    def syndromes(self, word: np.ndarray) -> np.ndarray:
        out = np.zeros(len(word), dtype=np.int64)
        for c, m in enumerate(self.checks):
            out |= (np.bitwise_count(word & m).astype(np.int64) & 1) << c
        return out

    def visits(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and anchor of every visit."""
        s, rows, anchors = self.syndromes(word), [], []
        for value, moves in enumerate(self.moves):
            at = np.flatnonzero(s == value)
            if len(at) and moves:
                rows.append(np.repeat(at, len(moves)))
                anchors.append((word[at][:, None] ^ np.array(moves, dtype=np.int64)).ravel())
        return np.concatenate(rows), np.concatenate(anchors)


def cover(threshold: int = THRESHOLD) -> list[Block]:
    """Three blocks; allowances of which one holds for any two fingerprints within the threshold."""
    share, rest = divmod(threshold + 1 - 3, 3) if threshold >= 2 else (-1, threshold + 1)
    allowances = [share + (i < rest) for i in range(3)]
    bits = [22, 22, 20]
    blocks, shift = [], 0
    for n, a in zip(bits, allowances, strict=True):
        if a >= 0:
            blocks.append(Block(shift, n, a, hamming=a > 0))
        shift += n
    return blocks


def anchored(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(anchor, visit, fingerprint): one home row (visit 0) per block and one row (visit 1) per visit."""
    blocks = cover(threshold)

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 1 << 14):
                value = batch.column(0).slice(first, 1 << 14).to_numpy(zero_copy_only=False)
                for n, block in enumerate(blocks):
                    word = (value >> block.shift) & ((1 << block.bits) - 1)
                    rows, anchors = block.visits(word)
                    homes = block.home(word)
                    anchor = np.concatenate([homes, anchors]) | n << 40
                    visit = np.concatenate([np.zeros(len(homes), np.int8), np.ones(len(rows), np.int8)])
                    yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(visit), pa.array(np.concatenate([value, value[rows]]))], names=["anchor", "visit", "fingerprint"])

    return streamed(prints).select("fingerprint").mapInArrow(run, "anchor long, visit byte, fingerprint long")


# ---- comparison


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the links a-b: every node but the smallest, with the smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    rest = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[rest], nodes[label[rest]]


def compare(batches, threshold: int):
    """Links among rows sorted by (place, visit): visitors of a place against its homes.

    A place's homes are held, its visitors pass by; only a star per set of connected
    fingerprints is given out, so a place of many near copies yields as many rows as it
    has fingerprints, never their pairs.
    """
    held_place, held = None, np.empty(0, dtype=np.int64)
    for batch in batches:
        place, visit, value = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(place):
            continue
        if held_place is not None and len(held):
            place = np.concatenate([np.full(len(held), held_place), place])
            visit = np.concatenate([np.zeros(len(held), visit.dtype), visit])
            value = np.concatenate([held, value])
        starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        group = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [len(place)]])))
        homes = np.bincount(group[visit == 0], minlength=len(starts))
        guests = np.flatnonzero(visit == 1)
        counts = homes[group[guests]]
        guests, counts = guests[counts > 0], counts[counts > 0]
        cuts = np.searchsorted(np.cumsum(counts), np.arange(PAIRS, counts.sum() + PAIRS, PAIRS), side="left") + 1
        left, right = [], []
        for part in np.split(np.arange(len(guests)), np.unique(np.minimum(cuts, len(guests)))):
            if not len(part):
                continue
            n, g = counts[part], guests[part]
            first = starts[group[g]]
            ends = np.cumsum(n)
            h = np.repeat(first - (ends - n), n) + np.arange(ends[-1])
            a, b = np.repeat(value[g], n), value[h]
            near = (np.bitwise_count((a ^ b).view(np.uint64)) <= threshold) & (a != b)
            if near.any():
                u, v = contract(a[near], b[near])
                left.append(u)
                right.append(v)
        if left:
            u, v = contract(np.concatenate(left), np.concatenate(right))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        held_place = place[-1]
        held = value[starts[-1] :][visit[starts[-1] :] == 0]


def links(prints: DataFrame, threshold: int = THRESHOLD, homes: int = HOMES) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints within the threshold, and no others.

    An anchor with more than `homes` home rows is cut into places that hold a share of
    them each; its visitors go to all its places.
    """
    rows = anchored(prints, threshold)
    crowded = rows.where("visit = 0").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > homes)
    crowded = crowded.select("anchor", F.ceil(F.col("n") / homes).cast("int").alias("parts"))
    rows = rows.join(crowded, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    part = F.explode(F.when(F.col("visit") == 0, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = rows.select("anchor", "visit", "fingerprint", part.alias("part")).select((F.col("anchor") * 65536 + F.col("part")).alias("place"), "visit", "fingerprint")
    dealt = placed.repartition("place").sortWithinPartitions("place", "visit")
    return streamed(dealt).mapInArrow(lambda batches: compare(batches, threshold), "u long, v long")


def classes(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(fingerprint, root): the class of every distinct fingerprint, connected through links."""
    roots = components(links(prints, threshold)).select(F.col("node").alias("fingerprint"), "root")
    return prints.select("fingerprint").join(roots, "fingerprint", "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(key, text_hash, fingerprint, component) of every row.

    The component is the smallest key that can be reached through fingerprints of at
    most `threshold` differing bits; equal fingerprints are always together, so repeated
    rows and empty or null texts (fingerprint zero) are too. Rows with a null key are
    linked like others; a component without any other key has a null component. Empty
    tables give an empty table.
    """
    rows = checkpoint(fingerprints(docs, key, text))
    prints = checkpoint(rows.groupBy("fingerprint").agg(F.min("key").alias("least")))
    named = classes(prints, threshold)
    least = named.join(prints, "fingerprint").groupBy("root").agg(F.min("least").alias("component"))
    members = named.join(least, "root").select("fingerprint", "component")
    return rows.join(members, "fingerprint").select("key", "text_hash", "fingerprint", "component")


def rows_of(docs: DataFrame, rows: DataFrame, chosen: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` named by `chosen` (first: key and text_hash), one for each; `rows` has key and text_hash of all."""
    repeats = rows.groupBy("key", "text_hash").agg(F.count(F.lit(1)).alias("repeats"))
    chosen = chosen.select(F.col("first.key").alias("key"), F.col("first.text_hash").alias("text_hash"))
    chosen = chosen.join(repeats, chosen.key.eqNullSafe(repeats.key) & (chosen.text_hash == repeats.text_hash)).select(
        F.struct(chosen.key.alias("key"), chosen.text_hash.alias("text_hash"), "repeats").alias("chosen")
    )
    own = docs.select(F.struct("*").alias("doc"))
    kept = own.join(
        checkpoint(chosen).hint("shuffle_hash"),
        F.col(f"doc.`{key}`").eqNullSafe(F.col("chosen.key")) & (F.xxhash64(F.col(f"doc.`{text}`")) == F.col("chosen.text_hash")),
    )
    single = kept.where("chosen.repeats = 1").select("doc.*")
    several = kept.where("chosen.repeats > 1").select("doc.*").dropDuplicates([key, text])
    return single.unionByName(several)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The rows of `docs` with one row of each component: that of the smallest key.

    Where several rows share that key, the one whose text has the smallest hash stays;
    of rows equal in key and text one stays. Null keys come last.
    """
    rows = checkpoint(fingerprints(docs, key, text))
    order = F.struct(F.col("key").isNull().alias("absent"), "key", "text_hash")
    prints = checkpoint(rows.groupBy("fingerprint").agg(F.min(order).alias("first")))
    named = classes(prints, threshold)
    chosen = named.join(prints, "fingerprint").groupBy("root").agg(F.min("first").alias("first"))
    return rows_of(docs, rows, chosen, key, text)
