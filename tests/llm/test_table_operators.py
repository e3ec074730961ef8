"""Top-k search, shards, licences, chats and the pipeline next to plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from check import TABLES, rows_of

from relweave.llm import chat, licenses, sharding, topk
from relweave.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, db, name):
    df = QUERIES[name](spark, folder)
    got = df.collect()
    cur = db.execute(ORACLES[name])
    assert rows_of(df.columns, got) == rows_of([d[0] for d in cur.description], cur.fetchall())


# ---- search


def plain_top(rows, k, every):
    fine = {(i, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for i, v in fine:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in fine if j != i and len(w) == len(v))[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    return out


@pytest.mark.parametrize("shard,block", [(16, 2), (4096, 2048)])
def test_top_k(spark, shard, block):
    rng = random.Random(shard)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(150 + i, [1.0] * 6) for i in range(40)]
    rows += [(300, None), (None, [1.0] * 6), (301, []), (302, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (303, [float("nan")] * 6), (304, [float("inf")] * 6), (310, [2.0, 3.0]), (311, [4.0, 1.0]), (400, [0.5])]
    rows += [rows[0], rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as kind", "2 as id")
    found = topk.top_k(df, every=10, shard=shard, block=block).collect()
    assert {tuple(r) for r in found} == plain_top(rows, 5, 10) and len(found) == len({tuple(r) for r in found})
    assert topk.top_k(df.limit(0)).count() == 0


def test_large_components(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**-8, 3.0]), (2, [2.0**-7, 2.0])]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {tuple(r) for r in found} == plain_top(rows, 5, 50)


def test_search_skips_boxes():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-5, 5, (500, 3)), rng.integers(900, 1000, (40, 3))])
    tree = topk.Tree(points, np.arange(len(points)), leaf=16)
    query = np.array([1, 2, 3])
    bounds = tree.bounds(query[None])[0]
    scores = sorted(((int(s), -i) for i, s in enumerate(points @ query)), reverse=True)
    assert tree.search(query, -1, bounds, 5, topk.NOTHING) == scores[:5]
    for node, rows in enumerate(tree.rows):
        if rows is not None and bounds[node] < scores[4][0]:
            tree.rows[node] = None  # a visit would fail
    assert tree.search(query, -1, bounds, 5, topk.NOTHING) == scores[:5]


# ---- shards


def shards_of(rows):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    return [len(by.get(i, ())) for i in range(40)]


def test_op5(spark, folder):
    rows = QUERIES["op5_ring_shards"](spark, folder).collect()
    sizes = shards_of(rows)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert max(sizes) - min(sizes) <= 1 and sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)


@pytest.mark.parametrize("piece", [sharding.PIECE, 7])
def test_shards_of_hot_and_odd_rows(spark, piece):
    rows = [(i, f"t{i}") for i in range(1000)] + [(7, "same")] * 700 + [(None, None)] * 300 + [(5, "")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as slot", "3 as place").repartition(6)
    found = sharding.assign(df, piece=piece).collect()
    sizes = shards_of(found)
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert Counter((r.doc_id, r.text_crc32) for r in found) == Counter((i, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sharding.assign(df.limit(0)).count() == 0


def test_ring_moves_little(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text")
    at = {n: {r.doc_id: (r.shard, r.home_shard) for r in sharding.assign(df, shards=n).collect()} for n in (40, 41)}
    home_moved = sum(a[1] != at[41][i][1] for i, a in at[40].items())
    assert home_moved < 2 * 20_000 / 41 and all(at[41][i][1] in (a[1], 40) for i, a in at[40].items())
    assert sum(a[0] != at[41][i][0] for i, a in at[40].items()) < 0.5 * 20_000
    assert sum(s == h for s, h in at[40].values()) > 0.8 * 20_000


def test_allotment_fills_clockwise():
    parts = sharding.allot({(0, 0): 10, (1, 0): 1, (2, 0): 1}, [0, 1, 2], 3)
    assert parts == [(0, 0, 0, 4, 0, 0), (1, 0, 0, 1, 1, 0), (2, 0, 0, 1, 2, 0), (0, 0, 4, 7, 1, 1), (0, 0, 7, 10, 2, 1)]


# ---- licences


def test_every_known_sentence_is_read(spark):
    stopped = {n: w if w[-1] in ".:;" else w + "." for n, w in licenses.SENTENCES.items()}
    rows = [(i, " ".join(stopped[n] for n in names)) for i, (_, names) in enumerate(licenses.RULES)]
    rows += [(100 + i, "\n".join(["Some prose"] + [licenses.SENTENCES[n] for n in names] + ["and more"])) for i, (_, names) in enumerate(licenses.RULES)]
    rows += [(200, licenses.SENTENCES["MitGrant"].replace(" ", "\n", 20)), (201, "permission warranty"), (None, None), (202, ""), (203, licenses.SENTENCES["MitShort"] + " " + licenses.SENTENCES["CcBy"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as sentences", "2 as low")
    found = {r.doc_id: r for r in licenses.scan(df).collect()}
    for i, (licence, _) in enumerate(licenses.RULES):
        assert found[i].licenses == found[100 + i].licenses == licence and found[i].left_over == 0
    assert found[200].licenses == "" and found[200].left_over == 1
    assert found[203].licenses == "MIT,CC-BY-4.0"
    assert all(found[i].sentences == "" and found[i].licenses == "" for i in (201, None, 202))
    assert all(any(w in text.lower() for w in licenses.WORDS) for text in licenses.SENTENCES.values())
    assert licenses.scan(df.limit(0)).count() == 0


# ---- chats


def test_formatting_is_reversible(spark):
    rng = random.Random(4)
    parts = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[", "<", "\\", "/", "]", ">", "s>", "INST]", "ok", " ", "\n", "é", "$1", "[\\INST]", "<\\\\s>"]
    roles = ["user", "assistant", "system", None, "<s>[INST]", ""]
    rows = [(c, t, rng.choice(roles), rng.choice([None, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))])) for c in range(200) for t in range(rng.randint(1, 7))]
    rows += [(None, 0, "user", "x"), (500, None, "user", "first"), (500, 0, "user", "second"), (501, 1, "assistant", "twice"), (501, 1, "assistant", "twice")]
    rows += [(600, i, "assistant" if i % 3 else "user", f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as blocks", "2 as turns")
    done = chat.format_chats(df)
    found = done.select("conv_id", "formatted", "loss", chat.read_back(done.formatted).alias("turns"), chat.learnt_text(done.formatted, done.loss).alias("learnt")).collect()
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in found} == want
    for r in found:
        assert r.learnt == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        blocks = sum(i == 0 or want[r.conv_id][i - 1][0] != role for i, (role, _) in enumerate(want[r.conv_id]))
        assert r.formatted.count("</s>") == r.formatted.count("<s>") == blocks
        assert len(r.loss) == sum(role == "assistant" for role, _ in want[r.conv_id])
    assert chat.format_chats(df.limit(0)).count() == 0


def test_op10_control_conversation(spark, folder):
    row = next(r for r in QUERIES["op10_chat"](spark, folder).collect() if r.conv_id == -1)
    text = "</s>[INST] ok [/INST]"
    assert (row.n_turns, row.loss_chars) == (2, len(text))
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


# ---- the pipeline


def test_pipeline_stages(spark, folder):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(None, None), (900_000, ""), (900_001, None)], "doc_id long, text string").selectExpr("doc_id", "text", "'en' as lang", "cast(null as string) as source", "0L as n_chars")
    docs = docs.unionByName(odd).unionByName(docs.where("doc_id < 3")).selectExpr("*", "'x' as score", "1 as c0", "2 as component", "3 as base_failed")
    rows = docs.count()
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        assert stage(spark, docs.limit(0), folder).count() == 0
        kept = out.collect()
        assert (len(kept) == rows) if name == "personal_data" else (0 < len(kept) < rows), name
        docs, rows = spark.createDataFrame(kept, docs.schema), len(kept)
        if name == "near_duplicates":
            assert len({r.doc_id for r in kept}) == len(kept)
    packed = cp.pack_windows(spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept}


def test_pipeline_run(spark, folder):
    found = QUERIES["pipeline"](spark, folder)
    totals = {}
    for r in found.collect():
        totals.setdefault(r.doc_id, [r.doc_tokens, 0])[1] += r.length
    assert totals and all(a == b for a, b in totals.values())
