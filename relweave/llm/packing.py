"""Hierarchical packing: documents go to context-size tiers, each tier is packed, gaps are filled from below.

Every task packs the documents it reads: a document gives full windows of the longest
size while it can, and what is left goes to the smallest tier that holds it. Tiers are
packed from the longest down; the gap behind a document is filled with the longest
shorter ones that fit, the last of them cut to size, so windows are full. What a task has
left at its end goes into windows of falling powers of two. Windows of a tier are dealt to
step groups of equal numbers of tokens, so that the attention cost of the groups is even.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right, insort
from itertools import chain, compress
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Store
from .common import groups, kept, ranges, streamed

TIERS = (512, 1024, 2048, 4096)
STEP = 32_768
HELD = 1_000_000
END = 2
CHUNKS = 400_000
MARKS = ".,;:!?"


class Tokens:
    """Ids of whole texts by the tokenizer library, asked once for each word met.

    The vocabulary drops white space, so the ids of a text are those of its chunks between
    blanks in a row. Lines of Latin letters and single marks are lower-cased and taken
    apart here, word by word; other lines give chunks between blanks. Chunks of letters go to the
    library many at a time, told apart afterwards by the ids that end a word; all others go
    through the library's own steps.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.words_only = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for t in (self.whole, self.words_only):
            t.no_truncation()
            t.no_padding()
        self.words_only.normalizer = normalizers.Sequence([])
        self.words_only.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.whole.model.end_of_word_suffix
        vocab = self.whole.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends_word[[i for w, i in vocab.items() if suffix and w.endswith(suffix)]] = True
        self.other = re.compile(f"[^a-zß-öø-ÿœ \t-\r{MARKS}]|[{MARKS}][{MARKS}]").search
        self.odd = re.compile("[\x1c-\x1f]").search
        self.blanks = re.compile("[\t\n\x0b\x0c\r ]+").split
        self.chunks = Store(CHUNKS)

    def split(self, text: str) -> list[str]:
        """Chunks whose ids in a row are those of the text."""
        low = text.lower()
        if not self.other(low):
            return apart(low)
        out: list[str] = []
        for line in text.split("\n"):
            low = line.lower()
            if not self.other(low):
                out += apart(low)
            elif self.odd(line):
                out += [w for w in self.blanks(line) if w]
            else:
                out += line.split()
        return out

    def plain(self, chunk: str) -> bool:
        """Whether a chunk is one word of letters."""
        return chunk.isalpha() and (chunk.isascii() or chunk.lower().isalpha() and "\u03a3" not in chunk and is_normalized("NFC", chunk))

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known = np.fromiter(map(self.plain, chunks), dtype=bool, count=len(chunks))
        ids, counts = self.encode_words([c.lower() for c in compress(chunks, known)])
        rest = [e.ids for e in self.whole.encode_batch_fast(list(compress(chunks, ~known)), add_special_tokens=False)]
        lengths = np.empty(len(chunks), dtype=np.int64)
        lengths[known], lengths[~known] = counts, [len(x) for x in rest]
        starts = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), dtype=np.int64)
        out[ranges(starts[known], lengths[known])] = ids
        out[ranges(starts[~known], lengths[~known])] = [i for x in rest for i in x]
        return out, lengths

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lots = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
        ids = np.array([x for e in self.words_only.encode_batch_fast(lots, add_special_tokens=False) for x in e.ids], dtype=np.int64)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("words cannot be told apart in this vocabulary")
        return ids, np.diff(np.concatenate([[0], ends]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, with the end id after them."""
        per_text = [self.split(t) for t in texts]
        flat = list(chain.from_iterable(per_text))
        ids, counts = self.chunks.look_up(flat, self.encode_chunks) if flat else (np.empty(0, np.int32), np.empty(0, np.int64))
        bounds = np.cumsum([len(ws) for ws in per_text])
        ends = np.concatenate([[0], np.cumsum(counts)])[bounds]
        stop = np.array([END], dtype=np.int32)
        return [np.concatenate([x, stop]) for x in np.split(ids, ends[:-1])]


def apart(low: str) -> list[str]:
    """Words and marks of lower-case text in which no two marks touch."""
    for mark in MARKS:
        if mark in low:
            low = low.replace(mark, f" {mark} ")
    return low.split()


class Packer:
    """Windows of one task. A piece is (document, start, length); a window is a list of pieces."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, step: int = STEP, held: int = HELD):
        self.tiers, self.step, self.held = sorted(tiers), step, held
        self.rest: list[tuple[int, int, int]] = []  # (length, document, start), ascending
        self.size = 0
        self.waiting: dict[int, list[list[tuple[int, int, int]]]] = {}
        self.steps = 0
        self.docs = 0

    def add(self, length: int) -> list[tuple[int, int, list]]:
        """Take the next document; returns the windows that are ready."""
        doc, start, top = self.docs, 0, self.tiers[-1]
        self.docs += 1
        while length - start >= top:
            self.put(top, [(doc, start, top)])
            start += top
        if start < length:
            insort(self.rest, (length - start, doc, start))
            self.size += length - start
        if self.size < self.held:
            return self.ready(False) if len(self.waiting.get(top, ())) * top >= self.held else []
        self.pack(False)
        return self.ready(False)

    def end(self) -> list[tuple[int, int, list]]:
        self.pack(True)
        return self.ready(True)

    def put(self, size: int, window: list) -> None:
        self.waiting.setdefault(size, []).append(window)

    def fill(self, size: int) -> list:
        """A full window from the waiting documents: the longest that fits first, the last one cut."""
        window, gap = [], size
        while gap:
            at = bisect_right(self.rest, (gap, 1 << 62, 0)) - 1
            length, doc, start = self.rest.pop(max(at, 0))
            taken = min(length, gap)
            window.append((doc, start, taken))
            if taken < length:
                insort(self.rest, (length - taken, doc, start + taken))
            gap -= taken
        self.size -= size
        return window

    def pack(self, last: bool) -> None:
        """Pack tier by tier from the longest; each tier's documents open its windows."""
        for i in range(len(self.tiers) - 1, -1, -1):
            size, below = self.tiers[i], self.tiers[i - 1] if i else 0
            while self.size >= size and self.rest and self.rest[-1][0] > below:
                self.put(size, self.fill(size))
        if last:
            size = 1 << max(0, self.size.bit_length() - 1)
            while self.size:
                size = min(size, self.tiers[-1])
                if size <= self.size:
                    self.put(size, self.fill(size))
                else:
                    size //= 2

    def ready(self, last: bool) -> list[tuple[int, int, list]]:
        """(tier, step, window): windows of a tier in groups of equal tokens, the costliest dealt out first, to and fro."""
        out = []
        for size, windows in self.waiting.items():
            per = max(1, self.step // size)
            n = len(windows) // per
            if last and len(windows) % per:
                n += 1
            if not n:
                continue
            chosen, self.waiting[size] = (windows, []) if last else (windows[: n * per], windows[n * per :])
            chosen = sorted(chosen, key=lambda w: -sum(x[2] ** 2 for x in w))
            for i, w in enumerate(chosen):
                lap, k = divmod(i, n)
                out.append((size, self.steps + (k if lap % 2 == 0 else n - 1 - k), w))
            self.steps += n
        return out


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", tiers: tuple[int, ...] = TIERS, step: int = STEP, held: int = HELD) -> DataFrame:
    """Pieces of all documents: (key, start, length, ids, doc_tokens, sequence_id, offset, tier, step).

    `ids` are the piece's ids as little-endian unsigned 32-bit numbers. Every row of
    `docs` is a document, repeated ones too; a null or empty text is the end id alone;
    keys may be null. Windows hold exactly `tier` ids. Sequences and steps are numbered
    within the task, whose number is in their high bits, so a task run again gives the
    same rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step"]

    def run(batches):
        coder, packer = kept(f"tokens {path}", lambda: Tokens(path)), Packer(tiers, step, held)
        high = TaskContext.get().partitionId() << 40
        known: dict[int, list] = {}  # document -> key, ids, ids not yet given out
        count = 0

        def rows(windows):
            nonlocal count
            out: list[list] = [[] for _ in names]
            for tier, number, window in windows:
                offset = 0
                for doc, start, length in window:
                    entry = known[doc]
                    values = (entry[0], start, length, entry[1][start : start + length].astype("<u4").tobytes(), len(entry[1]), high | count, offset, tier, high | number)
                    for c, v in zip(out, values, strict=True):
                        c.append(v)
                    offset += length
                    entry[2] -= length
                    if not entry[2]:
                        del known[doc]
                count += 1
            types = [key_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            for first in range(0, len(out[0]), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c[first : first + 4096], t) for c, t in zip(out, types, strict=True)], names=names)

        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            keys = batch.column(0).to_pylist()
            for first, texts in groups(batch.column(1).to_pylist()):
                for k, ids in zip(keys[first:], coder.encode(texts), strict=False):
                    known[packer.docs] = [k, ids, len(ids)]
                    yield from rows(packer.add(len(ids)))
        if key_type is not None:
            yield from rows(packer.end())

    out = streamed(docs).select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).mapInArrow(
        run, f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier long, step long"
    )
    return out.withColumnRenamed("key", key)
