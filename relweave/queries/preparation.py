"""M: splits, containers, checks; R: preprocessors."""

from pyspark.sql import functions as F

from ..functions import timecols
from ..operators import prep, splits
from ..operators import roles as R
from ..plans.features import Propositionalizer
from ..plans.flow import Pipeline
from ..plans.model import MANY_TO_ONE, Container, DataModel, Join, Placeholder, StarSchema, View
from ..plans.predict import IncludeCategorical
from ..sources.tables import load_dataset
from .expressions import HASH
from .registry import query, rounded, rounded_sql, table

U = HASH.format(k="o_orderkey")
SPLIT = f"CASE WHEN {U} < 0.6 THEN 'train' WHEN {U} < 0.8 THEN 'validation' ELSE 'test' END"


def random_split():
    return splits.split_random(["o_orderkey"], train=0.6, validation=0.2, test=0.2, seed=7)


@query("m1_random_split", f"SELECT o_orderkey, {SPLIT} AS split FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", random_split().alias("split"))


@query(
    "m2_time_split",
    """SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-06-01' THEN 'test'
    WHEN o_orderdate >= TIMESTAMP '1999-06-01' THEN 'validation' ELSE 'train' END AS split FROM orders""",
)
def _(spark, d):
    test, validation = (F.expr(timecols.datetime_literal(y, 6, 1)) for y in (2000, 1999))
    return table(spark, d, "orders").select("o_orderkey", splits.split_time("o_orderdate", test, validation).alias("split"))


@query(
    "m3_split_from_tables",
    "SELECT event_id, CASE WHEN event_type = 'view' THEN 'test' ELSE 'train' END AS split FROM events",
)
def _(spark, d):
    events = table(spark, d, "events")
    both = splits.concat(train=events.where("event_type <> 'view'"), test=events.where("event_type = 'view'"))
    return both.select("event_id", "split")


@query(
    "m4_split_by_column",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'test' END AS split FROM orders",
)
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", splits.split_by("o_orderstatus", {"F": "train", "O": "test"}).alias("split"))


@query(
    "m5_head_split",
    """SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= CAST(floor((SELECT count(*) FROM events) * 0.7) AS BIGINT)
    THEN 'train' ELSE 'test' END AS split FROM events""",
)
def _(spark, d):
    return splits.split_head(table(spark, d, "events"), ["ts", "event_id"], 0.7).select("event_id", "split")


STAR = """SELECT o_orderkey, count(l_orderkey) AS lineitem__count, avg(l_quantity) AS lineitem__avg__l_quantity
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey {where} GROUP BY o_orderkey"""
STAR_COLS = ("o_orderkey lineitem__count", "lineitem__avg__l_quantity")


@query("m6_data_model", rounded_sql(STAR.format(where=""), *STAR_COLS))
def _(spark, d):
    data = load_dataset(spark, d, ["orders", "lineitem"])
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("lineitem")
    dm.population.join(dm.lineitem, on=("o_orderkey", "l_orderkey"))
    view = View(data["orders"], {"lineitem": data["lineitem"].select("l_orderkey", "l_quantity")})
    return rounded(Propositionalizer(("COUNT", "AVG")).fit(dm, view).transform(dm, view))


@query("m7_star_schema", rounded_sql(STAR.format(where=f"WHERE {SPLIT} = 'test'"), *STAR_COLS))
def _(spark, d):
    data = load_dataset(spark, d, ["orders", "lineitem"])
    star = StarSchema(data["orders"], ["o_orderkey"], random_split())
    star.join(data["lineitem"].select("l_orderkey", "l_quantity"), "lineitem", on=("o_orderkey", "l_orderkey"))
    learner = Propositionalizer(("COUNT", "AVG")).fit(star, star.train)
    return rounded(learner.transform(star, star.test))


@query("m8_container_views", f"SELECT {SPLIT} AS split, count(*) AS n, (SELECT count(*) FROM lineitem) AS peripheral FROM orders GROUP BY 1")
def _(spark, d):
    container = Container(table(spark, d, "orders"), random_split()).add(lineitem=table(spark, d, "lineitem")).freeze()
    peripheral = container.peripheral["lineitem"].agg(F.count(F.lit(1)).alias("peripheral"))
    counts = [
        getattr(container, s).population.agg(F.lit(s).alias("split"), F.count(F.lit(1)).alias("n"))
        for s in ("train", "validation", "test")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).join(F.broadcast(peripheral))


@query(
    "m9_check",
    """SELECT 'keys without partner' AS kind, 'labels' AS place, ((SELECT count(*) FROM documents WHERE doc_id NOT IN
    (SELECT doc_id FROM labels)) / (SELECT count(*) FROM documents)) AS value
    UNION ALL SELECT 'lookup keys not unique', 'lineitem', (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1) AS q)::DOUBLE
    UNION ALL SELECT 'column is always null', 'labels.empty', 1.0::DOUBLE""",
)
def _(spark, d):
    labels = table(spark, d, "labels").withColumn("empty", F.lit(None).cast("string"))
    items = table(spark, d, "lineitem").withColumn("doc_id", F.col("l_orderkey"))
    keys = (("doc_id", "doc_id"),)
    joins = [Join(Placeholder("labels"), keys)]
    warnings = prep.check(table(spark, d, "documents"), {"labels": labels}, joins)
    orders = table(spark, d, "orders").withColumn("doc_id", F.col("o_orderkey"))
    lookup = [Join(Placeholder("lineitem"), keys, relationship=MANY_TO_ONE)]
    more = prep.check(orders, {"lineitem": items}, lookup)
    rows = warnings + [w for w in more if w[0] == "lookup keys not unique"]
    return spark.createDataFrame(rows, "kind string, place string, value double")


MEANS = """WITH p AS (SELECT o_custkey, o_orderkey, o_totalprice AS price, length(o_orderpriority) AS words, {split} AS split FROM orders),
    seen AS (SELECT l_returnflag, price, words FROM p JOIN lineitem ON l_orderkey = o_orderkey WHERE split = 'train'),
    brands AS (SELECT p_brand, avg(price) AS m FROM p JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE split = 'train' GROUP BY p_brand HAVING count(*) >= 20),
    flags AS (SELECT l_returnflag, avg(price) AS a, avg(words) AS b FROM seen GROUP BY l_returnflag)
    SELECT o_orderkey, avg(a) AS flag_price, avg(b) AS flag_words, avg(brand) AS brand_price FROM p JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN flags USING (l_returnflag)
    LEFT JOIN (SELECT p_partkey, avg(m) AS brand FROM part LEFT JOIN brands USING (p_brand) GROUP BY p_partkey) ON p_partkey = l_partkey GROUP BY o_orderkey"""


@query("r2_mapping_below", rounded_sql(MEANS.format(split=SPLIT), "o_orderkey", "flag_price flag_words brand_price"))
def _(spark, d):
    # two targets; categories one and two joins below the population, learnt from its training rows
    data = load_dataset(spark, d, ["orders", "lineitem", "part"])
    rows = data["orders"].select("o_orderkey", F.col("o_totalprice").alias("price"), F.length("o_orderpriority").cast("double").alias("words"))
    rows = R.set_role(rows, ["price", "words"], R.TARGET)
    items, parts = data["lineitem"].select("l_orderkey", "l_partkey", "l_returnflag"), R.set_role(data["part"].select("p_partkey", "p_brand"), "p_brand", R.CATEGORICAL)
    dm = DataModel(Placeholder("population", ("o_orderkey",))).add("lineitem", "part")
    dm.population.join(dm.lineitem, on=("o_orderkey", "l_orderkey"))
    dm.lineitem.join(dm.part, on=("l_partkey", "p_partkey"))
    tables, split = {"lineitem": items, "part": parts}, random_split()
    pipe = Pipeline(dm, preprocessors=[prep.Mapping(min_freq=20)], feature_learners=[Propositionalizer(("AVG",), compare_units=False)])
    pipe.fit(View(rows.where(split == "train"), tables), ["price", "words"])
    found = pipe.transform(View(rows, tables)).where("lineitem__avg__l_returnflag__mean_target__for_price IS NOT NULL")
    name = "lineitem__avg__{}__for_price"
    columns = {"flag_price": "l_returnflag__mean_target", "flag_words": "l_returnflag__mean_target__words", "brand_price": "lineitem__part__avg__p_brand__mean_target"}
    return rounded(found.select("o_orderkey", *[F.col(name.format(c)).alias(n) for n, c in columns.items()]))


@query(
    "m9_check_levels",
    """SELECT 'row id missing' AS kind, 'population' AS place, (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT')::DOUBLE AS value
    UNION ALL SELECT 'row ids not unique', 'population', (SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1 HAVING count(*) > 1))::DOUBLE
    UNION ALL SELECT 'keys without partner', 'lineitem.part', (SELECT avg(CAST(p_partkey IS NULL AS INT)) FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey)
    UNION ALL SELECT 'lookup keys not unique', 'lineitem.part.customer', (SELECT count(*) FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1))::DOUBLE""",
)
def _(spark, d):
    # findings about the row id and two levels below the population
    orders = table(spark, d, "orders").withColumn("id", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")))
    parts = table(spark, d, "part").where("p_size > 10").withColumn("home", F.lit(1))
    part, customer, lines = Placeholder("part"), Placeholder("customer"), Placeholder("lineitem")
    part.join(customer, on=("home", "c_nationkey"), relationship=MANY_TO_ONE)
    lines.join(part, on=("l_partkey", "p_partkey"))
    tables = {"lineitem": table(spark, d, "lineitem"), "part": parts, "customer": table(spark, d, "customer")}
    found = prep.check(orders, tables, [Join(lines, (("o_orderkey", "l_orderkey"),))], ["id"])
    wanted = [w for w in found if w[1] in ("population", "lineitem.part") or w[0] == "lookup keys not unique"]
    return spark.createDataFrame(wanted, "kind string, place string, value double")


@query(
    "r1_seasonal",
    """SELECT event_id, CAST(year(ts) AS VARCHAR) AS year__ts, CAST(month(ts) AS VARCHAR) AS month__ts,
    CAST(isodow(ts) - 1 AS VARCHAR) AS weekday__ts, CAST(hour(ts) AS VARCHAR) AS hour__ts, CAST(minute(ts) AS VARCHAR) AS minute__ts FROM events""",
)
def _(spark, d):
    events = load_dataset(spark, d, ["events"])["events"]
    out = prep.Seasonal().fit(events).transform(events)
    return out.select("event_id", *[f"{p}__ts" for p in ("year", "month", "weekday", "hour", "minute")])


@query(
    "r2_mapping",
    rounded_sql(
        f"""WITH m AS (SELECT o_orderpriority, avg(o_totalprice) AS mt, count(*) AS k FROM orders WHERE {SPLIT} = 'train' GROUP BY 1)
        SELECT o_orderkey, mt AS o_orderpriority__mean_target FROM orders LEFT JOIN m ON m.o_orderpriority = orders.o_orderpriority AND k >= 10""",
        "o_orderkey",
        "o_orderpriority__mean_target",
    ),
)
def _(spark, d):
    orders = load_dataset(spark, d, ["orders"])["orders"]
    train = orders.where(random_split() == "train")
    step = prep.Mapping(min_freq=10).fit(train, "o_totalprice", ["o_orderpriority"])
    return rounded(step.transform(orders).select("o_orderkey", "o_orderpriority__mean_target"))


@query(
    "r2_mapping_across",
    rounded_sql(
        f"""WITH m AS (SELECT l_returnflag, avg(o_totalprice) AS mt FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE {SPLIT} = 'train' GROUP BY 1) SELECT l_orderkey, l_linenumber, mt AS l_returnflag__mean_target FROM lineitem JOIN m USING (l_returnflag)""",
        "l_orderkey l_linenumber",
        "l_returnflag__mean_target",
    ),
)
def _(spark, d):
    data = load_dataset(spark, d, ["orders", "lineitem"])
    train = data["orders"].where(random_split() == "train")
    step = prep.Mapping().fit_across(data["lineitem"], train, [("o_orderkey", "l_orderkey")], "o_totalprice", ["l_returnflag"])
    return rounded(step.transform(data["lineitem"]).select("l_orderkey", "l_linenumber", "l_returnflag__mean_target"))


@query("r3_substring", "SELECT p_partkey, substr(p_type, 1, 3) AS p_type__0_3 FROM part")
def _(spark, d):
    part = load_dataset(spark, d, ["part"])["part"]
    return prep.Substring(0, 3, unit="code").fit(part).transform(part).select("p_partkey", "p_type__0_3")


@query(
    "r4_text_splitter",
    """SELECT word, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id,
    unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents) AS q WHERE word <> '' GROUP BY word""",
)
def _(spark, d):
    documents = load_dataset(spark, d, ["documents"])["documents"]
    words = prep.TextFieldSplitter(["doc_id"]).fit(documents).transform(documents)["text"]
    # per document first: a frequent word then brings one row per document
    per_doc = words.groupBy("word", "doc_id").agg(F.count(F.lit(1)).alias("k"))
    return per_doc.groupBy("word").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("docs"))


@query(
    "r4_pipeline_words",
    """WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents),
    k AS (SELECT doc_id, count(*) AS n, count(DISTINCT word) AS n_distinct FROM w WHERE word <> '' GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS words, CAST(coalesce(n_distinct, 0) AS BIGINT) AS n_distinct FROM documents LEFT JOIN k USING (doc_id)""",
)
def _(spark, d):
    # the word table is joined back to its rows and aggregated by the learner
    documents = load_dataset(spark, d, ["documents"])["documents"].select("doc_id", "text", "n_chars")
    documents = documents.withMetadata("text", {"role": R.TEXT}).withMetadata("n_chars", {"role": R.TARGET})
    pipe = Pipeline(
        DataModel(Placeholder("population", ("doc_id",))), preprocessors=[prep.TextFieldSplitter(["doc_id"])],
        feature_learners=[Propositionalizer(("COUNT", "COUNT_DISTINCT"))],
    )
    view = View(documents, {})
    flat = pipe.fit(view, ["n_chars"]).transform(view)
    return flat.select("doc_id", F.col("words_of_text__count").cast("long").alias("words"), F.col("words_of_text__count_distinct__word").cast("long").alias("n_distinct"))


@query(
    "r5_imputation",
    rounded_sql(
        f"""WITH v AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS x, {SPLIT} AS s FROM orders)
        SELECT o_orderkey, coalesce(x, (SELECT avg(x) FROM v WHERE s = 'train')) AS x, CAST(x IS NULL AS DOUBLE) AS x__missing FROM v""",
        "o_orderkey x__missing",
        "x",
    ),
)
def _(spark, d):
    orders = table(spark, d, "orders").withColumn("x", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    step = prep.Imputation().fit(orders.where(random_split() == "train"), ["x"])
    return rounded(step.transform(orders).select("o_orderkey", "x", "x__missing"))


@query(
    "r6_include_categorical",
    "SELECT o_orderkey, "
    + ", ".join(
        f"CAST(o_orderstatus = (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1 OFFSET {i}) AS DOUBLE) AS o_orderstatus__is{i}"
        for i in range(3)
    )
    + " FROM orders",
)
def _(spark, d):
    orders = R.set_role(table(spark, d, "orders"), "o_orderstatus", R.CATEGORICAL)
    out, names = IncludeCategorical(["o_orderstatus"]).fit(orders).transform(orders)
    return out.select("o_orderkey", *names)
