"""Graphs as node and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint
from . import ranks, skew


def index_edges(nodes: DataFrame, edges: DataFrame, node: str, src: str, dst: str, order: list[str] | None = None):
    """Dense node numbers, and edges re-keyed to them by two lookups."""
    indexed = ranks.with_row_id(nodes, order or [node], "node_index")
    out = edges
    for col, name in ((src, "src_index"), (dst, "dst_index")):
        table = indexed.select(F.col(node).alias(col), F.col("node_index").alias(name))
        out = skew.skew_join(out, table, [col], "left")
    return indexed, out


def symmetrise(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Every edge in both directions; one scan."""
    both = F.array(F.struct(F.col(src).alias("s"), F.col(dst).alias("d")), F.struct(F.col(dst).alias("s"), F.col(src).alias("d")))
    return edges.select(F.inline(both)).select(F.col("s").alias(src), F.col("d").alias(dst))


def bag_of_words(content: DataFrame, node: str, word_index: str) -> DataFrame:
    """Multi-hot word vector per node as the sorted list of its set positions.

    Pairs are gathered as sets, so a list is never longer than the vocabulary, however
    often a node repeats its words.
    """
    pairs = content.select(node, word_index).dropna()
    return pairs.groupBy(node).agg(F.sort_array(F.collect_set(word_index)).alias("word_positions"))


def to_dense(positions: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.array_contains(positions, i).cast("int"))


def degrees(edges: DataFrame, src: str) -> DataFrame:
    return edges.groupBy(F.col(src).alias("node")).agg(F.count(F.lit(1)).alias("degree"))


def graph_stats(nodes: DataFrame, edges: DataFrame, node: str, src: str, dst: str) -> DataFrame:
    """One row: sizes, mean degree over directed edges, isolated nodes, self loops, undirected or not."""
    ends = edges.select(F.explode(F.array(src, dst)).alias(node)).distinct()
    isolated = nodes.select(node).join(ends, node, "left_anti")
    n = nodes.agg(F.count(F.lit(1)).alias("nodes"))
    e = edges.agg(
        F.count(F.lit(1)).alias("edges"), F.coalesce(F.sum((F.col(src) == F.col(dst)).cast("long")), F.lit(0)).alias("self_loops")
    )
    i = isolated.agg(F.count(F.lit(1)).alias("isolated_nodes"))
    pairs = edges.select(src, dst).distinct()
    back = pairs.select(F.col(dst).alias(src), F.col(src).alias(dst))
    one_way = pairs.join(back, [src, dst], "left_anti").agg(F.count(F.lit(1)).alias("one_way"))
    row = n.join(F.broadcast(e)).join(F.broadcast(i)).join(F.broadcast(one_way))  # one row each
    return row.select(
        "nodes",
        "edges",
        F.try_divide(F.col("edges"), F.col("nodes")).alias("mean_degree"),
        "isolated_nodes",
        "self_loops",
        (F.col("one_way") == 0).cast("int").alias("undirected"),
    )


def label_connectivity(nodes: DataFrame, edges: DataFrame, node: str, label: str, src: str, dst: str) -> DataFrame:
    """(src_label, dst_label, share): edges between classes, rows summing to 1."""
    both = edges
    for col, name in ((src, "src_label"), (dst, "dst_label")):
        both = skew.skew_join(both, nodes.select(F.col(node).alias(col), F.col(label).alias(name)), [col], "inner")
    counts = both.groupBy("src_label", "dst_label").agg(F.count(F.lit(1)).alias("n"))
    row = Window.partitionBy("src_label")
    return counts.select("src_label", "dst_label", (F.col("n") / F.sum("n").over(row)).alias("share"))


def propagate(nodes: DataFrame, edges: DataFrame, node: str, src: str, dst: str, columns: list[str]) -> DataFrame:
    """D^-1/2 (A + I) D^-1/2 X for undirected edges given in both directions.

    Rows are scaled once per node, so an edge carries ready values; sums into a hub
    are combined on the map side, and edges out of a hub are salted by the join.
    """
    deg = edges.groupBy(F.col(src).alias(node)).agg(F.count(F.lit(1)).alias("__deg"))
    scale = F.sqrt(F.coalesce("__deg", F.lit(0)) + 1)
    scaled = nodes.select(node, *columns).join(deg, node, "left").withColumn("__s", scale)
    scaled = scaled.select(node, "__s", *[(F.coalesce(F.col(c), F.lit(0.0)) / F.col("__s")).alias(c) for c in columns])
    sent = skew.skew_join(edges.select(src, dst), scaled.drop("__s").withColumnRenamed(node, src), [src], "inner")
    got = sent.groupBy(F.col(dst).alias(node)).agg(*[F.sum(c).alias(f"__g_{c}") for c in columns])
    out = scaled.join(got, node, "left")
    return out.select(node, *[((F.col(c) + F.coalesce(f"__g_{c}", F.lit(0.0))) / F.col("__s")).alias(c) for c in columns])


def gap_pattern(positions: DataFrame, key: str, position: str) -> DataFrame:
    """Differences of neighbouring positions per key; a shift of all positions keeps them."""
    lists = bag_of_words(positions, key, position).withColumnRenamed("word_positions", "p")
    gaps = F.zip_with(
        F.slice("p", F.lit(2), F.size("p")), F.slice("p", F.lit(1), F.size("p") - 1), lambda b, a: b - a
    )
    return lists.select(key, gaps.alias("pattern"))


def match_by_gaps(a: DataFrame, b: DataFrame, a_key: str, b_key: str, position: str) -> DataFrame:
    """Each key of `a` with the smallest key of `b` that has the same gap pattern.

    Patterns are as long as the texts, so their SHA-256 digests are compared; these are kept, as they are read several times.
    """
    digest = F.sha2(F.array_join(F.col("pattern").cast("array<string>"), ","), 256)
    left, right = [checkpoint(gap_pattern(rows, key, position).select(key, digest.alias("pattern"))) for rows, key in ((a, a_key), (b, b_key))]
    first = right.groupBy("pattern").agg(F.min(b_key).alias(b_key))
    return skew.skew_join(left, first, ["pattern"], "inner").select(a_key, b_key)
