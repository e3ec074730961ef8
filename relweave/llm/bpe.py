"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs.

Each node of a word's tree holds the smallest (rank, position) below it. The root is
therefore the leftmost pair of lowest rank; merging it changes three leaves, whose paths
to the root are recomputed, until no pair of the word can be merged. Many words of one
length class go through the same steps as numpy rows; long words use a tree of their own.
"""

from __future__ import annotations

import json
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import kept, map_texts, ranges, streamed

NONE = np.iinfo(np.int64).max
WIDEST = 64
ROWS = 8192
CACHED = 250_000
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = [], 256
    for b in range(256):
        if b in shown:
            letters.append(chr(b))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


class Vocabulary:
    """Ids, merges and bytes of a byte-level vocabulary file in JSON."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.first = np.array([ids[c] for c in letters], dtype=np.int64)
        self.size = max([*ids.values(), *self.special.values()]) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        self.rank_of = dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))
        self.bytes_of = [b""] * self.size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 for a pair that does not merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], -1)


def merge_many(vocab: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Merge the words in the rows of `symbols` (padded with -1); returns them with -1 at consumed places."""
    words, width = symbols.shape
    leaves = max(2, 1 << (width - 2).bit_length()) if width > 2 else 2
    token = np.full((words, leaves + 2), -1, dtype=np.int64)
    token[:, :width] = symbols
    after = np.broadcast_to(np.arange(1, leaves + 3), (words, leaves + 2)).copy()
    before = np.broadcast_to(np.arange(-1, leaves + 1), (words, leaves + 2)).copy()
    rank = vocab.rank(token[:, :leaves], token[:, 1 : leaves + 1])
    tree = np.full((words, 2 * leaves), NONE, dtype=np.int64)
    tree[:, leaves:] = np.where(rank >= 0, rank * leaves + np.arange(leaves), NONE)
    level = leaves
    while level > 1:
        level //= 2
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
    rows = np.flatnonzero(tree[:, 1] != NONE)
    while len(rows):
        best = tree[rows, 1]
        i, made = best % leaves, vocab.made[best // leaves]
        j = after[rows, i]
        k, h = after[rows, j], before[rows, i]
        token[rows, i], token[rows, j] = made, -1
        after[rows, i] = k
        before[rows, np.minimum(k, leaves + 1)] = i
        right = np.where(k < lengths[rows], token[rows, np.minimum(k, leaves + 1)], -1)
        rank = vocab.rank(made, right)
        tree[rows, leaves + i] = np.where(rank >= 0, rank * leaves + i, NONE)
        inner = j < leaves
        tree[rows[inner], leaves + j[inner]] = NONE
        some = h >= 0
        left = np.where(some, token[rows, np.maximum(h, 0)], -1)
        rank = vocab.rank(left, made)
        tree[rows[some], leaves + h[some]] = np.where(rank >= 0, rank * leaves + h, NONE)[some]
        paths = [leaves + i, leaves + np.minimum(j, leaves - 1), leaves + np.maximum(h, 0)]
        while paths[0][0] > 1:
            paths = [p >> 1 for p in paths]
            for p in paths:
                tree[rows, p] = np.minimum(tree[rows, 2 * p], tree[rows, 2 * p + 1])
        rows = rows[tree[rows, 1] != NONE]
    return token[:, :width]


def merge_one(vocab: Vocabulary, symbols: list[int]) -> list[int]:
    """The same steps for one word of any length."""
    n = len(symbols)
    leaves = 1 << max(1, (n - 1).bit_length())
    rank_of, size, made_of = vocab.rank_of, vocab.size, vocab.made.tolist()
    token, after, before = [*symbols, -1], list(range(1, n + 2)), list(range(-1, n))
    tree = [NONE] * (2 * leaves)

    def leaf(i: int, left: int, right: int) -> None:
        rank = rank_of.get(left * size + right) if left >= 0 and right >= 0 else None
        tree[leaves + i] = NONE if rank is None else rank * leaves + i

    def climb(i: int) -> None:
        p = (leaves + i) >> 1
        while p:
            a, b = tree[2 * p], tree[2 * p + 1]
            tree[p] = a if a < b else b
            p >>= 1

    for i in range(n - 1):
        leaf(i, token[i], token[i + 1])
    for p in range(leaves - 1, 0, -1):
        tree[p] = min(tree[2 * p], tree[2 * p + 1])
    while tree[1] != NONE:
        i = tree[1] % leaves
        made = made_of[tree[1] // leaves]
        j = after[i]
        k, h = after[j], before[i]
        token[i], token[j], after[i] = made, -1, k
        if k < n:
            before[k] = i
        leaf(i, made, token[k] if k < n else -1)
        tree[leaves + j] = NONE
        climb(i)
        climb(j)
        if h >= 0:
            leaf(h, token[h], made)
            climb(h)
    return [t for t in token if t >= 0]


def merge_words(vocab: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and the number of ids of each."""
    raw = [w.encode() for w in words]
    sizes = np.array([len(b) for b in raw], dtype=np.int64)
    counts = np.zeros(len(raw), dtype=np.int64)
    found, whose = [], []
    classes = np.where(sizes <= WIDEST, np.maximum(4, 1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)), 0)
    for width in np.unique(classes).tolist():
        members = np.flatnonzero(classes == width)
        if not width:
            for i in members.tolist():
                ids = merge_one(vocab, vocab.first[list(raw[i])].tolist())
                counts[i] = len(ids)
                found.append(np.array(ids, dtype=np.int64))
                whose.append(np.full(len(ids), i))
            continue
        for some in np.split(members, range(ROWS, len(members), ROWS)):
            lengths = sizes[some]
            symbols = np.full((len(some), width), -1, dtype=np.int64)
            flat = vocab.first[np.frombuffer(b"".join([raw[i] for i in some.tolist()]), dtype=np.uint8)]
            symbols[np.repeat(np.arange(len(some)), lengths), ranges(np.zeros(len(some), np.int64), lengths)] = flat
            merged = merge_many(vocab, symbols, lengths)
            keep = merged >= 0
            counts[some] = keep.sum(axis=1)
            found.append(merged[keep])
            whose.append(np.repeat(some, counts[some]))
    ids = np.concatenate(found)
    return ids[np.argsort(np.concatenate(whose), kind="stable")], counts


class Store:
    """Ids of the pieces met so far, in flat arrays; when full, pieces met only once are forgotten."""

    def __init__(self, limit: int = CACHED):
        self.limit = limit
        self.slot: dict[str, int] = {}
        self.flat = np.empty(1 << 20, dtype=np.int32)
        self.ends = np.zeros(limit + 1, dtype=np.int64)
        self.hits = np.zeros(limit, dtype=np.int32)
        self.used = 0

    def forget(self) -> None:
        n = len(self.slot)
        kept = np.flatnonzero(self.hits[:n] > 1)
        if len(kept) > self.limit // 2:
            kept = kept[np.argsort(-self.hits[kept], kind="stable")[: self.limit // 2]]
            kept.sort()
        lengths = self.ends[kept + 1] - self.ends[kept]
        flat = self.flat[ranges(self.ends[kept], lengths)]
        pieces = list(self.slot)
        self.slot = {pieces[k]: i for i, k in enumerate(kept.tolist())}
        self.used = len(flat)
        self.flat[: self.used] = flat
        self.ends[1 : len(kept) + 1] = np.cumsum(lengths)
        self.hits[:] = 0

    def add(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, k = len(ids), len(self.slot)
        while self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while k + len(pieces) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.hits = np.concatenate([self.hits, np.zeros_like(self.hits)])
        self.flat[self.used : self.used + n] = ids
        self.ends[k + 1 : k + 1 + len(pieces)] = self.used + np.cumsum(lengths)
        self.slot.update(zip(pieces, range(k, k + len(pieces)), strict=True))
        self.used += n

    def look_up(self, pieces: list[str], encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has; `encode(new)` gives both for new ones."""
        if len(self.slot) > self.limit:
            self.forget()
        at = np.array(list(map(self.slot.get, pieces, repeat(-1))), dtype=np.int64)
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            new = list({pieces[i] for i in missing})
            self.add(new, *encode(new))
            at[missing] = [self.slot[pieces[i]] for i in missing]
        self.hits[: len(self.slot)] += np.bincount(at, minlength=len(self.slot)).astype(np.int32)
        starts = self.ends[at]
        lengths = self.ends[at + 1] - starts
        return self.flat[ranges(starts, lengths)], lengths


class Encoder:
    """Whole texts to ids, through the pieces between white space.

    A blank before a visible character always begins a new word of the vocabulary's own
    splitting, so the text between two such places is encoded once and remembered. Texts
    with other white space, or with the two marks used here, go word by word.
    """

    RAW, SPECIAL = "\x01", "\x02"

    def __init__(self, path: str):
        import regex

        self.vocab = Vocabulary(path)
        self.split = regex.compile(PIECES).findall
        self.odd = re.compile("[\x01\x02\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
        self.special = regex.compile("|".join(map(regex.escape, self.vocab.special))) if self.vocab.special else None
        self.words, self.store = Store(), Store()

    def pieces(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self.plain(text[at : m.start()])
            out.append(self.SPECIAL + m[0])
            at = m.end()
        return out + self.plain(text[at:])

    def plain(self, text: str) -> list[str]:
        if not text:
            return []
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or self.odd(text):
            return [self.RAW + w for w in self.split(text)]
        first, *rest = text.replace("\n", " \n").split(" ")
        return [self.RAW + first, *rest] if first else rest

    def split_piece(self, piece: str) -> list[str]:
        """Words of one piece; letters with or without one mark after them are the common case."""
        if piece.isalpha():
            return [" " + piece]
        if piece[:-1].isalpha() and piece[-1] in ".,;:!?)":
            return [" " + piece[:-1], piece[-1]]
        return self.split(piece[1:] if piece[:1] == self.RAW else piece if piece[:1] == "\n" else " " + piece)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [[p] if p[:1] == self.SPECIAL else self.split_piece(p) for p in pieces]
        ids, counts = self.words.look_up([w for ws in words for w in ws], self.encode_words)
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum([len(ws) for ws in words])])])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        special = [i for i, w in enumerate(words) if w[:1] == self.SPECIAL and w[1:] in self.vocab.special]
        if not special:
            return merge_words(self.vocab, words)
        each = [[self.vocab.special[w[1:]]] if w[:1] == self.SPECIAL and w[1:] in self.vocab.special else merge_words(self.vocab, [w])[0].tolist() for w in words]
        return np.array([x for w in each for x in w], dtype=np.int64), np.array([len(w) for w in each], dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        per_text = [self.pieces(t) for t in texts]
        flat = [p for ps in per_text for p in ps]
        if not flat:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        ids, counts = self.store.look_up(flat, self.encode_pieces)
        bounds = np.concatenate([[0], np.cumsum([len(ps) for ps in per_text])])
        ends = np.concatenate([[0], np.cumsum(counts)])[bounds]
        return ids, np.diff(ends)


def decode_ids(vocab: Vocabulary, ids: list[int]) -> str:
    """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(vocab.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` and `ids` (array of int) of every row; a null text counts as empty.

    Special tokens inside a text become their own id. Rows stay as they are, repeated
    ones too; an empty table gives an empty table.
    """

    def work():
        this = kept(f"encoder {path}", lambda: Encoder(path))

        def step(rows, texts):
            ids, counts = this.encode(texts)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))]

        return step

    return map_texts(docs, keep, "ids array<int>", work, text, lasting=True)


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text of the ids to every row; a null list stays null."""
    fields = encoded.schema.fields
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)], "t string"])
    at = [f.name for f in fields].index(ids)

    def run(batches):
        vocab = Vocabulary(path)
        for batch in batches:
            lists = batch.column(at)
            for first in range(0, len(lists), 256):
                part = batch.slice(first, 256)
                texts = [None if x is None else decode_ids(vocab, x) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*[f"c{i}" for i in range(len(fields))], "t"])

    out = streamed(encoded).toDF(*[f"c{i}" for i in range(len(fields))]).mapInArrow(run, schema)
    return out.toDF(*[f.name for f in fields], name)
