"""WARC archives, importance resampling and vector codes next to plain versions."""

import base64
import gzip
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from relweave.llm import resample, vector_codes, warc

# ---- archives

PAGES = "page_id long, url string, html string, payload string, archive int, record string"


def plain_records(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) of every page; of wholly equal pages any one is the response."""
    body = [(r[2] or "").encode() for r in rows]
    out = []
    order = lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] is not None, rows[i][1] or "")
    for i, data in enumerate(body):
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        equal = [j for j in range(len(rows)) if body[j] == data]
        best = max(equal, key=lambda j: (order(j), -j))
        if len(data) < least or i == best:
            out.append((rows[i][0], len(data), digest, "response", None))
        else:
            out.append((rows[i][0], len(data), digest, "revisit", rows[best][0]))
    return out


def some_pages():
    rows = [(i, f"http://h{i % 3}/p {i}\r\né", f"<p>page {i % 17}</p>" if i % 4 else f"only {i}", "x", 1, "y") for i in range(120)]
    rows += [(200, None, None, "x", 1, "y"), (201, "u", "", "x", 1, "y"), (None, "v", "only here", None, None, None), (None, None, "<p>page 3</p>", "x", 1, "y")]
    rows += [(7, "a", "<p>page 7</p>", "x", 1, "y"), (300, "same", "twice", "x", 1, "y"), (300, "same", "twice", "z", 2, "y"), (300, "other", "twice", "x", 1, "y"), (400, "long", "lang é " * 300_000, "x", 1, "y")]
    return rows


@pytest.mark.parametrize("least,most", [(0, 1 << 30), (9, 600)])
def test_archives(spark, tmp_path, least, most):
    rows = some_pages()
    pages = spark.createDataFrame(rows, PAGES).repartition(5)
    folder = str(tmp_path / "out")
    index = warc.write(pages, folder, least=least, most=most)
    found = warc.read_back(index, folder, payload=True, gap=10, most=1000).collect()
    told = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(told, key=key) == sorted(plain_records(rows, least), key=key)
    assert len({r.record for r in found}) == len(rows)
    texts = {(r[2] or "").encode() for r in rows}
    assert {bytes(r.payload) for r in found if r.record_type == "response"} == texts

    entries = index.collect()
    assert sorted((e.url or "") for e in entries) == sorted((r[1] or "") for r in rows)
    names = {e.archive for e in entries}
    assert names == {n for n in os.listdir(folder) if n.endswith(".warc.gz")} and (most > 600 or len(names) > 5)
    for name in names:  # a whole archive is a gzip file of records in a row
        data = open(f"{folder}/{name}", "rb").read()
        assert len(re.findall(rb"WARC/1\.1\r\n", gzip.decompress(data))) == 1 + sum(e.archive == name for e in entries)
        assert sorted(e.offset + e.length for e in entries if e.archive == name)[-1] == len(data)

    some = warc.read_back(index.where("record_type = 'revisit' AND page_id > 50"), folder).collect()
    assert len(some) == sum(r[3] == "revisit" and (r[0] or 0) > 50 for r in plain_records(rows, least))


def test_no_pages(spark, tmp_path):
    assert warc.round_trip(spark.createDataFrame([], PAGES), str(tmp_path / "none")).count() == 0


def test_damage_is_seen(spark, tmp_path):
    folder = str(tmp_path / "out")
    index = warc.write(spark.createDataFrame([(1, "u", "text", "", 0, "")], PAGES), folder)
    row = index.first()
    damaged = index.withColumn("offset", index["offset"] + 1)
    assert row.length > 0
    with pytest.raises(Exception, match="Error|incorrect"):
        warc.read_back(damaged, folder).collect()


def test_reads_are_put_together():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 90, 5), ("b", 95, 5), ("b", 100, 300), ("b", 400, 5)]
    assert list(warc.ranges(iter(rows), gap=5, most=100)) == [
        ("a", 0, 30, [(0, 10), (10, 10), (25, 5)]), ("a", 90, 95, [(90, 5)]), ("b", 95, 100, [(95, 5)]), ("b", 100, 400, [(100, 300)]), ("b", 400, 405, [(400, 5)]),
    ]
    assert list(warc.ranges(iter([]))) == []


# ---- the draw


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_draw(docs, target, percent, least, buckets):
    code = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = np.zeros(buckets), np.zeros(buckets)
    for texts, into in (([d[1] for d in docs], s), (target, t)):
        for x in texts:
            for f in features(x)[1]:
                into[code(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)]
    out = []
    for key, text in docs:
        words, found = features(text)
        weight = sum(gain[code(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("percent", [5, 37, 100])
def test_resampling(spark, monkeypatch, percent):
    monkeypatch.setattr(resample, "ROWS_A_RANGE", 7)
    rng = random.Random(percent)
    words = ["Alpha", "be-ta", "gamma9", "é", "Ünder", "x\x00y", "　z", "7", "d'e", "İ", "end."]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(150)]
    docs += [(1000, "same text " * 20)] * 30 + [(None, "no key here " * 9)] * 3 + [(5, "a b c"), (2000, None), (2001, ""), (2002, " \t!"), (-3, "below zero " * 15)]
    docs += [(3000, "w" * 9000 + " é" * 40), (3001, "long " * 400_000 + "x" * 1_500_000 + " tail of it")]
    target = ["alpha beta gamma9", None, "", "tail of it é é é"]
    table = spark.createDataFrame([(k, t, 1, 2) for k, t in docs], "doc_id long, text string, score int, weight int").repartition(6)
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, rank int")
    found = [tuple(r) for r in resample.resample(table, goal, percent=percent, buckets=97).collect()]
    order = lambda r: tuple((x is not None, x) for x in r)
    want = plain_draw(docs, target, percent, 20, 97)
    assert sorted(found, key=order) == sorted(want, key=order)


def test_resampling_empty_tables(spark):
    docs = spark.createDataFrame([(i, "some words " * 15) for i in range(40)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(none, docs).count() == 0
    ranks = sorted(r.rank for r in resample.resample(docs, none).collect() if r.rank)
    assert ranks == [1, 2]


def test_pieces_of_a_long_text(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("ab C-\né7") for _ in range(5000)).encode()
    whole = [np.concatenate(x) for x in zip(*[found for _, found in resample.runs(text)], strict=True)]
    monkeypatch.setattr(resample, "PIECE", 50)
    parts = list(resample.runs(text))
    assert len(parts) > 20 and sum(n for n, _ in parts) == len(whole[0])
    for k in range(3):
        assert np.concatenate([found[k] for _, found in parts]).tolist() == whole[k].tolist()


def test_nth_largest(spark):
    values = [3, 3, -(1 << 62), 1 << 62, 0, 7, 7, 7, -1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    falling = sorted(values, reverse=True)
    for n in range(1, len(values) + 1):
        assert resample.nth_largest(df, "v", n) == (falling[n - 1], sum(v > falling[n - 1] for v in values))


# ---- vector codes


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(k, lab, [math.floor(scale * float(x)) for x in v]) for k, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, _, v in kept) // parts)
    kept = [(k, lab, np.array(v + [0] * (width * parts - len(v)), dtype=np.int64).reshape(parts, width)) for k, lab, v in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2].ravel().tolist()))[:entries]
    books = [np.array([r[2][p] for r in first]) for p in range(parts)]
    assign = lambda p: [((books[p] - r[2][p]) ** 2).sum(axis=1) for r in kept]
    for _ in range(rounds):
        for p in range(parts):
            at = [int(d.argmin()) for d in assign(p)]
            new = books[p].copy()
            for e in set(at):
                new[e] = sum(kept[i][2][p] for i in range(len(kept)) if at[i] == e) // at.count(e)
            books[p] = new
    found = [assign(p) for p in range(parts)]
    sha = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    out = [(r[0], r[1], "".join(f"{int(found[p][i].argmin()):02x}" for p in range(parts)), sum(int(found[p][i].min()) for p in range(parts))) for i, r in enumerate(kept)]
    return [(k, lab, code, error, sum(o[3] for o in out if o[1] == lab), sha) for k, lab, code, error in out]


@pytest.mark.parametrize("dims,entries", [(16, 256), (10, 7), (4, 40)])
def test_vector_codes(spark, dims, entries):
    rng = random.Random(dims)
    rows = [(i * 3, [round(rng.gauss(0, 1), 1) for _ in range(dims)], rng.choice([1, 2, None])) for i in range(300)]
    rows += [(2000 + i, [0.5] * dims, 7) for i in range(120)] + [rows[0], rows[1], (None, [0.25] * dims, 3), (1, [], 3), (5000, [1.0], None)]
    rows += [(6000, None, 1), (6001, [None] * dims, 1), (6002, [float("nan")] * dims, 1), (6003, [float("inf")] * dims, 1)]
    table = spark.createDataFrame([(*r, "c", 0) for r in rows], "vec_id long, embedding array<float>, label int, code string, error int").repartition(4)
    rows = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for k, v, lab in rows]
    found = [tuple(r) for r in vector_codes.compressed(table, entries=entries).collect()]
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(found, key=order) == sorted(plain_codes(rows, entries=entries), key=order)


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compressed(none).count() == 0
    assert vector_codes.compressed(spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")).count() == 0


def test_search_stops_early():
    rng = np.random.default_rng(2)
    entries = np.concatenate([rng.integers(-5, 5, (100, 4)), rng.integers(9000, 9100, (100, 4))])
    book = vector_codes.Codebook(entries)
    parts = rng.integers(-6, 6, (2000, 4))
    far = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (book.nearest(parts)[0] == far.argmin(axis=1)).all() and (book.nearest(parts)[1] == far.min(axis=1)).all()
    book.sorted = book.sorted.copy()
    book.sorted[100 + vector_codes.BLOCK :] = 0  # entries that a search must not reach
    assert (book.nearest(parts)[0] == far.argmin(axis=1)).all()


def test_large_components_stay_exact():
    rng = np.random.default_rng(4)
    entries, parts = rng.integers(-(1 << 20), 1 << 20, (50, 8192)), rng.integers(-(1 << 20), 1 << 20, (20, 8192))
    far = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (vector_codes.Codebook(entries).nearest(parts)[1] == far.min(axis=1)).all()
