"""Quality rules: text statistics, and lines that many documents of a host share.

Lines are normalised and hashed with their host; distinct texts per (host, line) are
counted over the whole corpus. Lines above the limit of their host are removed, and a
document that consists mostly of such lines is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .common import map_texts, text_or_empty

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """A line is common above both limits; a document is depleted above `lost` percent of its words.

    As they stand, one number of distinct texts decides, whatever the size of the host.
    """

    documents: int = 10
    percent_of_host: float = 0.0
    lost: int = 80


# ---- statistics of one text


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three that occur twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[at] > 1
    inside = np.zeros(len(words), dtype=bool)
    for k in range(3):
        inside[k : len(words) - 2 + k] |= twice
    return int(inside.sum())


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    data = text.encode()
    words = data.split()
    blank = len(data) - len(data.translate(None, BLANKS))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = data.split(b"\n")
    repeated = 0
    if len(lines) > 1:
        lines = [x for x in lines if x.strip()]
        repeated = len(lines) - len(set(lines))
    return len(words), len(text) - blank, symbols, repeated, repeated_words(words)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, keep: list[str | Column]) -> DataFrame:
    """The columns `keep`, the statistics of the text, and base_failed."""

    def work():
        def step(rows, texts):
            found = np.array([statistics(t) for t in texts], dtype=np.int64).reshape(len(texts), 5)
            return [pa.array(found[:, i]) for i in range(5)]

        return step

    found = map_texts(docs, keep, ", ".join(f"{n} long" for n in NAMES), work)
    n = len(keep)
    names = [*found.columns[:n], *NAMES]
    failed = (F.col("s0") < 50) | (100 * F.col("s4") > 50 * F.col("s0"))
    return found.toDF(*[f"k{i}" for i in range(n)], *[f"s{i}" for i in range(5)]).withColumn("base_failed", failed).toDF(*names, "base_failed")


# ---- lines across documents


def normalised(line: Column) -> Column:
    """Lower case, runs of blanks as one, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def line_hash(line: Column, host: Column) -> Column:
    return F.xxhash64(host, normalised(line))


def line_words(line: Column) -> Column:
    """Words of a normalised line, told by its blanks."""
    return F.when(line == "", 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def text_lines(docs: DataFrame) -> DataFrame:
    """(host, text_hash, line, words, times): the distinct lines with a word of every distinct (host, text).

    Host, text and line are hashes, the last two with the source in them; `times` counts
    a line over all rows of that text.
    """
    lines = F.transform(F.split(text_or_empty("text"), "\n"), normalised)
    told = F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.struct(F.xxhash64(F.col("source"), x).alias("line"), line_words(x).alias("words")))
    each = docs.select(F.xxhash64("source").alias("host"), F.xxhash64("source", "text").alias("text_hash"), F.explode(told).alias("x"))
    return each.select("host", "text_hash", "x.*").groupBy("host", "text_hash", "line").agg(F.max("words").alias("words"), F.count(F.lit(1)).alias("times"))


def shared_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(text_hash, removed, removed_lines): words and lines to take out of each distinct (host, text).

    A line goes if more distinct texts of its host hold it than the limits allow. Equal
    texts of a host count once, so copies of a document do not condemn its lines; rows
    without a source are a host of their own. Texts that lose nothing have no row.
    """
    lines = checkpoint(text_lines(docs))
    texts = checkpoint(docs.groupBy(F.xxhash64("source").alias("host"), F.xxhash64("source", "text").alias("text_hash")).agg(F.count(F.lit(1)).alias("rows")))
    hosts = texts.groupBy("host").agg(F.greatest(F.lit(float(limits.documents)), F.count(F.lit(1)) * limits.percent_of_host / 100).alias("most"))
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limits.documents)
    common = counts.join(hosts, "host").where(F.col("n") > F.col("most")).select("line")
    hit = lines.join(common, "line").join(texts.select("text_hash", "rows"), "text_hash")
    return hit.groupBy("text_hash").agg(F.sum(F.expr("words * times div rows")).cast("long").alias("removed"), F.collect_list("line").alias("removed_lines"))


def verdicts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(doc_id, statistics, base_failed, removed_words, kept) of every row.

    Null texts have no words and fail; repeated rows get the same verdict each. A
    document is kept if the base rules pass and at most `lost` percent of its words are
    in common lines. An empty table gives an empty table.
    """
    removed = checkpoint(shared_lines(docs, limits).select("text_hash", "removed"))
    rows = measured(docs, ["doc_id", F.xxhash64("source", "text").alias("text_hash")]).withColumnRenamed("c1", "text_hash")
    out = rows.join(removed, "text_hash", "left").withColumn("removed_words", F.coalesce("removed", F.lit(0)).cast("long"))
    depleted = 100 * F.col("removed_words") > limits.lost * F.col("n_words")
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted).select("doc_id", *NAMES, "base_failed", "removed_words", "kept")


def cleaned(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The kept rows of `docs` with common lines taken out of their texts.

    All columns stay; n_chars, where there is one, follows a changed text.
    """
    removed = checkpoint(shared_lines(docs, limits)).select("text_hash", F.struct("removed", "removed_lines").alias("r"))
    whole = measured(docs, docs.columns).toDF(*[f"k{i}" for i in range(len(docs.columns))], *NAMES, "base_failed")
    own = F.struct(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
    found = whole.select(own.alias("d"), "base_failed", "n_words").withColumn("text_hash", F.xxhash64("d.source", "d.text")).join(removed, "text_hash", "left")
    depleted = 100 * F.coalesce("r.removed", F.lit(0)) > limits.lost * F.col("n_words")
    found = found.where(~F.col("base_failed") & ~depleted)
    host, lines = F.col("d.source"), F.col("r.removed_lines")
    rest = F.array_join(F.filter(F.split(F.col("d.text"), "\n"), lambda x: ~F.array_contains(lines, F.xxhash64(host, normalised(x)))), "\n")
    text = F.when(F.col("r").isNull(), F.col("d.text")).otherwise(rest)
    out = [F.col(f"d.`{c}`").alias(c) for c in docs.columns]
    out[docs.columns.index("text")] = text.alias("text")
    if "n_chars" in docs.columns:
        size = F.when(F.col("r").isNull(), F.col("d.n_chars")).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType))
        out[docs.columns.index("n_chars")] = size.alias("n_chars")
    return found.select(*out)
