"""One query per corpus operator, over its whole table, and SQL where DuckDB can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path as tokenizer

from . import bpe, chat, licenses, packing, pii, quality, resample, sharding, simhash, topk, toxicity, vector_codes, warc
from .common import read


def op1_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    found = bpe.decode(bpe.encode(read(spark, folder, "documents"), path, ["doc_id"]), path)
    digest = lambda c: F.sha2(c, 256)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(ids.cast("binary")).alias("ids_sha256"), digest(F.col("decoded").cast("binary")).alias("decoded_sha256"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings"))


OP3_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = toxicity.train(docs, read(spark, folder, "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = toxicity.score(docs, model, ["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(read(spark, folder, "documents"))


def spelt(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in pii.KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.spans(read(spark, folder, "documents"), ["doc_id"])
    counts = [F.expr(f"size(filter(base, s -> s.kind = {k}))").cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(spelt("base").cast("binary"), 256).alias("base_sha256"), spelt("spans").alias("spans"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    found = packing.pack(read(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step")


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verdicts(read(spark, folder, "documents"))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read(spark, folder, "documents"))


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")) for i, r in enumerate(("user", "assistant"))])
    more = spark.range(1).select(F.explode(control).alias("c")).select("c.*")
    found = chat.format_chats(rows.unionByName(more))
    both = found.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.learnt_text(F.col("formatted"), F.col("loss")).alias("learnt"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return both.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP10_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, CASE WHEN lag(role) OVER w = role THEN 0 ELSE 1 END AS opens,
      length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?s>|</?SYS>>)', '\1\\\2\3', 'g')) AS n
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + 13 + opens * (7 + length(role))) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id"""


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(read(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP11_SQL = """
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(h, CAST(1 + 5 * i AS INT), 5) AS BIGINT)) AS five,
      row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url DESC) AS place, first_value(page_id) OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url DESC) AS keeper FROM p)
SELECT page_id, payload_bytes, list_reduce(list_transform(five, lambda v: list_reduce(list_transform([32768, 1024, 32, 1], lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // d % 32 + 1 AS INT), 1)),
    lambda a, c: a || c)), lambda a, c: a || c) AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN keeper END AS refers_to FROM b"""


def op12_resample(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


OP12_SQL = r"""
WITH steps AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) AS r(i))),
w AS MATERIALIZED (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark)),
f AS MATERIALIZED (SELECT side, id, unnest(flatten(list_transform(range(1, 4), lambda k: list_transform(range(len(w) - k + 1), lambda i: array_to_string(w[i + 1:i + k], ' '))))) AS f FROM w),
b AS MATERIALIZED (SELECT f, xor(4294967295, list_reduce(list_transform(range(octet_length(encode(f))), lambda i: CAST('0x' || substr(hex(encode(f)), CAST(2 * i + 1 AS INT), 2) AS BIGINT)),
      lambda c, x: xor(c >> 8, t[CAST(xor(c & 255, x) + 1 AS INT)]), 4294967295)) % 10000 AS bucket FROM (SELECT DISTINCT f FROM f), steps),
c AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN b USING (f) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM c),
d AS (SELECT id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN b USING (f) JOIN g USING (bucket) WHERE side = 0 GROUP BY id),
a AS (SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, CAST('0x' || substr(sha256('42:' || w.id), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN d USING (id) WHERE side = 0),
e AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM a),
r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM e)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM r"""


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_codes.compressed(read(spark, folder, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_sql(rounds: int = 4) -> str:
    """Every round is two tables: the nearest entry of each part, and the entries that follow from it."""
    out = ["""
WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, x[len(x) // 4 * part + 1:len(x) // 4 * (part + 1)] AS v FROM k, range(4) AS r(part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS e FROM p QUALIFY entry < 256)"""]
    near = """
a{r} AS MATERIALIZED (SELECT vec_id, part, any_value(v) AS v, min(CAST(list_sum(list_transform(list_zip(v, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 256 + entry) AS best
      FROM p JOIN b{r} USING (part) GROUP BY vec_id, part)"""
    mean = """
b{n} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM b{r} b LEFT JOIN (SELECT part, entry, list(c ORDER BY i) AS e
      FROM (SELECT part, entry, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS c FROM (SELECT part, best % 256 AS entry, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{r}) GROUP BY part, entry, i)
      GROUP BY part, entry) m USING (part, entry))"""
    for r in range(rounds):
        out += [near.format(r=r), mean.format(r=r, n=r + 1)]
    out.append(near.format(r=rounds))
    return ",".join(out) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM (SELECT vec_id, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id) JOIN k USING (vec_id)"""


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, folder)


QUERIES = {f.__name__: f for f in (op1_bpe_round_trip, op2_simhash, op3_top_k, op4_toxicity, op5_ring_shards, op6_personal_data, op7_packing, op8_quality, op9_licenses, op10_chat, op11_warc, op12_resample, op13_vector_codes, pipeline)}
ORACLES = {"op3_top_k": OP3_SQL, "op9_licenses": licenses.oracle(), "op10_chat": OP10_SQL, "op11_warc": OP11_SQL, "op12_resample": OP12_SQL, "op13_vector_codes": op13_sql()}
