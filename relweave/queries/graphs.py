"""G: graph preparation. Customers are the nodes; an order links its customer to the one its number points to."""

from pyspark.sql import functions as F

from ..operators import graph, prep, ranks, splits
from ..plans.predict import MultinomialRegression
from .registry import query, rounded, rounded_sql, table

EDGES = "SELECT o_custkey AS src, o_orderkey % (SELECT count(*) FROM customer) AS dst FROM orders"


def edges(spark, d):
    n = table(spark, d, "customer").agg(F.count(F.lit(1)).alias("n"))
    rows = table(spark, d, "orders").join(F.broadcast(n))
    return rows.select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") % F.col("n")).alias("dst"))


def nodes(spark, d):
    return table(spark, d, "customer").withColumnRenamed("c_custkey", "id")


@query(
    "g1_index_edges",
    f"""WITH n AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS i FROM customer), e AS ({EDGES})
    SELECT src, dst, a.i AS src_index, b.i AS dst_index FROM e LEFT JOIN n a ON a.c_custkey = src LEFT JOIN n b ON b.c_custkey = dst""",
)
def _(spark, d):
    return graph.index_edges(nodes(spark, d), edges(spark, d), "id", "src", "dst", ["c_acctbal", "id"])[1]


@query("g2_symmetrise", f"WITH e AS ({EDGES}) SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e")
def _(spark, d):
    return graph.symmetrise(edges(spark, d), "src", "dst")


WORDS = """SELECT DISTINCT doc_id, word FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word
FROM documents) AS q WHERE word <> ''"""
CODES = f"""WITH w AS ({WORDS}), v AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS code FROM (SELECT DISTINCT word FROM w) AS q),
p AS (SELECT doc_id, code FROM w JOIN v USING (word))"""


def word_codes(spark, d):
    words = table(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(prep.words("text"))).alias("word"))
    return ranks.encode_category(words, "word", "code")[0].select("doc_id", "code")


@query(
    "g3_bag_of_words",
    f"""{CODES} SELECT doc_id, count(*) AS n, md5(string_agg(CAST(code AS VARCHAR), ',' ORDER BY code)) AS positions FROM p GROUP BY doc_id""",
)
def _(spark, d):
    bags = graph.bag_of_words(word_codes(spark, d), "doc_id", "code")
    listed = F.array_join(F.col("word_positions").cast("array<string>"), ",")
    return bags.select("doc_id", F.size("word_positions").cast("bigint").alias("n"), F.md5(listed).alias("positions"))


@query(
    "g4_graph_stats",
    f"""WITH e AS ({EDGES}), n AS (SELECT count(*) AS nodes FROM customer)
    SELECT nodes, (SELECT count(*) FROM e) AS edges, (SELECT count(*) FROM e) / nodes AS mean_degree,
    (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT src FROM e) AND c_custkey NOT IN (SELECT dst FROM e)) AS isolated_nodes,
    (SELECT count(*) FROM e WHERE src = dst) AS self_loops,
    CAST(NOT EXISTS (SELECT src, dst FROM e EXCEPT SELECT dst, src FROM e) AS INTEGER) AS undirected FROM n""",
)
def _(spark, d):
    return graph.graph_stats(nodes(spark, d), edges(spark, d), "id", "src", "dst")


@query(
    "g4_label_rate",
    """SELECT avg(CASE WHEN r <= cut THEN 1.0::DOUBLE ELSE 0 END) AS train_rate FROM
    (SELECT row_number() OVER (ORDER BY c_custkey) AS r, CAST(floor((SELECT count(*) FROM customer) * 0.7) AS BIGINT) AS cut FROM customer) AS q""",
)
def _(spark, d):
    rows = splits.split_head(nodes(spark, d), ["id"], 0.7)
    return rows.agg(F.avg((F.col("split") == "train").cast("double")).alias("train_rate"))


@query(
    "g5_label_connectivity",
    rounded_sql(
        f"""WITH e AS ({EDGES}), k AS (SELECT a.c_mktsegment AS src_label, b.c_mktsegment AS dst_label, count(*) AS n FROM e
        JOIN customer a ON a.c_custkey = src JOIN customer b ON b.c_custkey = dst GROUP BY 1, 2)
        SELECT src_label, dst_label, n / sum(n) OVER (PARTITION BY src_label) AS share FROM k""",
        "src_label dst_label",
        "share",
    ),
)
def _(spark, d):
    return rounded(graph.label_connectivity(nodes(spark, d), edges(spark, d), "id", "c_mktsegment", "src", "dst"))


PROPAGATED = f"""WITH e AS ({EDGES}), s AS (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e),
g AS (SELECT src AS id, count(*) AS deg FROM s GROUP BY src),
x AS (SELECT c_custkey AS id, sqrt(coalesce(deg, 0) + 1) AS r, c_acctbal, CAST(c_nationkey AS DOUBLE) AS c_nationkey
  FROM customer LEFT JOIN g ON g.id = c_custkey),
m AS (SELECT dst AS id, sum(c_acctbal / r) AS a, sum(c_nationkey / r) AS b FROM s JOIN x ON x.id = s.src GROUP BY dst)
SELECT id, (c_acctbal / r + coalesce(a, 0)) / r AS c_acctbal, (c_nationkey / r + coalesce(b, 0)) / r AS c_nationkey
FROM x LEFT JOIN m USING (id)"""


def propagated(spark, d):
    n = nodes(spark, d).select("id", "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nationkey"))
    both = graph.symmetrise(edges(spark, d), "src", "dst")
    return graph.propagate(n, both, "id", "src", "dst", ["c_acctbal", "c_nationkey"])


@query("g6_propagation", rounded_sql(PROPAGATED, "id", "c_acctbal c_nationkey"))
def _(spark, d):
    return rounded(propagated(spark, d))


@query("g6_graph_classifier")
def _(spark, d):
    labels, _ = ranks.encode_category(nodes(spark, d).select("id", "c_mktsegment"), "c_mktsegment", "label")
    rows = propagated(spark, d).join(labels, "id")
    return MultinomialRegression(0.01).fit(rows, ["c_acctbal", "c_nationkey"], "label").predict(rows).select("id", "label", "prediction")


@query(
    "g7_match_by_gaps",
    f"""{CODES}, g AS (SELECT doc_id, code, code - lag(code) OVER (PARTITION BY doc_id ORDER BY code) AS gap FROM p),
    t AS (SELECT doc_id, coalesce(string_agg(CAST(gap AS VARCHAR), ',' ORDER BY code), '') AS pattern FROM g GROUP BY doc_id)
    SELECT a.doc_id, min(b.doc_id) + 1000000 AS other_id FROM t a JOIN t b USING (pattern) GROUP BY a.doc_id""",
)
def _(spark, d):
    # the other source numbers its words from 17 and its documents from a million
    mine = word_codes(spark, d)
    other = mine.select((F.col("doc_id") + 1000000).alias("other_id"), (F.col("code") + 17).alias("code"))
    return graph.match_by_gaps(mine, other, "doc_id", "other_id", "code")
