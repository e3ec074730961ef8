"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

A row's key falls on a place of the ring and belongs to the next virtual node clockwise.
Each shard takes rows up to its bound; what overflows goes on clockwise to the next node
whose shard has room. Bounds differ by one row at most and add up to all rows, so every
shard is exactly full. Only counts per piece of an arc of the ring reach the driver, a few bytes
for a million rows; the rows are ranked within their arc by window functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..session import checkpoint

SHARDS = 40
NODES = 32
PLACES = 1 << 13
SALTS = 8
PIECE = 1_000_000


def ring(shards: int, nodes: int = NODES, places: int = PLACES) -> tuple[list[int], list[int]]:
    """Owner shard of each virtual node in ring order, and the node that each place belongs to.

    A place taken already goes to the next free one clockwise.
    """
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(nodes):
            place = xxh64_intdigest(f"{shard}/{node}", 42) % places
            while place in taken:
                place = (place + 1) % places
            taken[place] = shard
    order = sorted(taken)
    belongs, at = [], 0
    for place in range(places):
        while at < len(order) and order[at] < place:
            at += 1
        belongs.append(at % len(order))
    return [taken[p] for p in order], belongs


def allot(counts: dict[tuple[int, int], int], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges of ranks (arc, salt, first, end, shard, slot of the first) for the rows counted per arc and salt.

    Rows go home while there is room, arc by arc; then the overflow moves on in the same order.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    out, over = [], []

    def give(arc, salt, first, n, shard):
        taken = min(n, room[shard] - used[shard])
        if taken:
            out.append((arc, salt, first, first + taken, shard, used[shard]))
            used[shard] += taken
        return taken

    for (arc, salt), n in sorted(counts.items()):
        taken = give(arc, salt, 0, n, owners[arc])
        if taken < n:
            over.append((arc, salt, taken, n - taken))
    after = [(i + 1) % len(owners) for i in range(len(owners))]

    def next_free(arc: int) -> int:
        path = []
        while used[owners[arc]] >= room[owners[arc]]:
            path.append(arc)
            arc = after[arc]
        for p in path:
            after[p] = arc
        return arc

    for arc, salt, first, n in over:
        while n:
            taken = give(arc, salt, first, n, owners[next_free(arc)])
            first, n = first + taken, n - taken
    return out


def literal_table(df: DataFrame, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of whole numbers, made of one text constant."""
    text = ";".join(",".join(map(str, r)) for r in rows)
    cells = F.split(F.col("r"), ",")
    one = df.sparkSession.range(1).select(F.explode(F.split(F.lit(text), ";")).alias("r")).where("r != ''")
    return one.select(*[cells[i].cast("long").alias(n) for i, n in enumerate(names)])


def assign(docs: DataFrame, shards: int = SHARDS, nodes: int = NODES, piece: int = PIECE) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard) of every row, by the law `rows`.

    `size` is the text's bytes plus 16, a null text has none. Counts of shards are at most
    one apart and slots run from 0 without gaps. The ring knows nothing of texts, so equal
    texts are not kept together; rows with a null id fall on a place of their own. Rows
    that share an id share an arc, which is cut by input partition into pieces of about
    `piece` rows, `SALTS` at least, so that a hot id is ranked in as many pieces as it
    needs; among equal rows it does not matter which one moves on. An empty table gives
    an empty table.
    """
    owners, belongs = ring(shards, nodes)
    key = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(PLACES)).cast("int").alias("place")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size")
    crc = F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32")
    rows = checkpoint(docs.select("doc_id", size, crc, key, F.spark_partition_id().alias("part")))
    sizes = [0] * len(owners)
    for r in rows.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect():  # at most PLACES rows
        sizes[belongs[r["place"]]] += r["n"]
    pieces = [max(SALTS, -(-n // piece)) for n in sizes]
    places = literal_table(rows, [(p, arc, pieces[arc]) for p, arc in enumerate(belongs)], ["place", "arc", "pieces"])
    salt = F.pmod(F.xxhash64("part"), F.col("pieces")).cast("int")
    on_arc = rows.join(F.broadcast(places), "place").withColumn("salt", salt)
    found = on_arc.groupBy("arc", "salt").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a piece
    parts = allot({(r["arc"], r["salt"]): r["n"] for r in found}, owners, shards)
    ranges = literal_table(rows, [(*p, owners[p[0]]) for p in parts], ["arc", "salt", "first", "end", "shard", "slot0", "home_shard"])
    order = Window.partitionBy("arc", "salt").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = on_arc.withColumn("rank", F.row_number().over(order) - 1)
    placed = ranked.join(F.broadcast(ranges), ["arc", "salt"]).where("rank >= first AND rank < end")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"), (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("home_shard").cast("int"),
    )
