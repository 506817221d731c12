"""Benchmark decontamination: SimHash fingerprints of item-sized windows, multi-index Hamming search, exact verification.

Each benchmark item and each window of a document that is as long (in words) has a 64-bit SimHash over its weighted
shingles; a document shorter than the item is its own and only window. The fingerprints are cut into 8 blocks of 8 bits; two fingerprints within RADIUS = 23 agree up to 2 bits in one
of them, so a table of block values (each item under all values within 2 bits) gives every item within the radius. Those
candidates are decided by the weighted Jaccard similarity of the real shingles. At a similarity of 0.8 the expected
distance is 10 bits of 64, its deviation 3, so the radius lies more than four deviations out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillscore.llm.common import WordHashes, chunks, mix, shingle_hashes, tidy

RADIUS, BLOCKS = 23, 8
#: Characters of items that go to the tasks at once, about.
BLOCK_CHARS = 32 << 20
WORD = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def bag(words: list[str], k: int) -> Counter:
    return Counter(zip(*(words[i:] for i in range(k)), strict=False))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: a shingle weighs its characters times its occurrences."""
    weight = lambda s: sum(map(len, s))
    common = sum(weight(s) * min(n, b[s]) for s, n in a.items() if s in b)
    return common / (sum(weight(s) * n for c in (a, b) for s, n in c.items()) - common)


def signed(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A row of 64 signed weights per shingle."""
    bits = np.unpackbits(mix(shingles, 9).view(np.uint8).reshape(-1, 8), axis=1)
    return (bits.astype(np.float64) * 2 - 1) * weights[:, None]


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1)  # n x 8 bytes: the blocks


@dataclass
class Group:
    """Items of one length: fingerprints (8 bytes each), and which items lie within 2 bits of each value of each block."""

    ids: list
    bags: list[Counter]
    shingles: np.ndarray  # sorted
    prints: np.ndarray  # items x 8
    near: np.ndarray  # BLOCKS x 256 x items, bool


@dataclass
class ItemIndex:
    k: int
    shingles: np.ndarray  # sorted hashes of all items' shingles
    groups: dict[int, Group]
    short: dict[int, dict[tuple, list]]  # items of fewer than k words, by length: words -> ids

    @classmethod
    def build(cls, items: list[tuple], k: int) -> ItemIndex:
        known, by_length, short = TokenHashes(), {}, {}
        values = np.arange(256, dtype=np.uint8)
        within = np.bitwise_count(values[:, None] ^ values[None, :]) <= RADIUS // BLOCKS
        for item, text in items:
            if len(ws := tokens(text)) >= k:
                by_length.setdefault(len(ws), []).append((item, ws))
            elif ws:
                short.setdefault(len(ws), {}).setdefault(tuple(ws), []).append(item)
        groups = {}
        for n, members in by_length.items():
            each = [hashes(ws, k, known) for _, ws in members]
            prints = np.stack([fingerprints(signed(s, weights(ws, k)).sum(0)[None, :])[0] for s, (_, ws) in zip(each, members, strict=True)])
            groups[n] = Group([m[0] for m in members], [bag(ws, k) for _, ws in members], np.unique(np.concatenate(each)), prints, np.stack([within[:, prints[:, b]] for b in range(BLOCKS)]))
        return cls(k, np.unique(np.concatenate([g.shingles for g in groups.values()])) if groups else np.zeros(0, np.uint64), groups, short)

    def found(self, text: str | None, known: TokenHashes, least: float) -> list[tuple]:
        """(item, similarity, first word of the window) of the most similar window of each item that is at least so similar."""
        ws = tokens(text)
        exact = self.occurrences(ws)
        if len(ws) < self.k or not len(self.shingles):
            return exact
        s = hashes(ws, self.k, known)
        at = np.minimum(np.searchsorted(self.shingles, s), len(self.shingles) - 1)
        hits = np.flatnonzero(self.shingles[at] == s)
        if not len(hits):
            return exact  # a window without any shingle of an item has similarity 0 with all of them
        w, out = weights(ws, self.k), {}
        for n, g in self.groups.items():
            width = min(n, len(ws))  # a text shorter than the item is its only window
            m = width - self.k + 1  # shingles of a window
            last = len(s) - m
            own = hits[np.isin(s[hits], g.shingles)]
            if not len(own):
                continue
            # Starts of windows that hold a shingle of the group's items, in pieces of bounded size.
            mark = np.zeros(last + 2, np.int32)
            np.add.at(mark, np.clip(own - m + 1, 0, last + 1), 1)
            np.add.at(mark, np.minimum(own, last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(mark)[: last + 1] > 0)
            size = max(1, min(8192, (4 << 20) // len(g.ids)))
            for piece in np.split(starts, np.flatnonzero((np.diff(starts) > m) | (np.diff(starts // size) > 0)) + 1):
                if not len(piece):
                    continue
                a, z = piece[0], piece[-1] + m
                sums = np.concatenate([np.zeros((1, 64)), np.cumsum(signed(s[a:z], w[a:z]), axis=0)])
                fp = fingerprints(sums[piece - a + m] - sums[piece - a])
                candidate = g.near[0][fp[:, 0]]
                for b in range(1, BLOCKS):
                    candidate |= g.near[b][fp[:, b]]
                win, item = np.nonzero(candidate)
                inside = np.bitwise_count(fp[win] ^ g.prints[item]).sum(1) <= RADIUS
                for p, i in zip(piece[win[inside]].tolist(), item[inside].tolist(), strict=True):
                    sim = similarity(bag(ws[p : p + width], self.k), g.bags[i])
                    if sim >= least and sim > out.get(g.ids[i], (0.0,))[0]:
                        out[g.ids[i]] = (sim, p)
        return _once(exact + [(i, sim, p) for i, (sim, p) in out.items()]) if exact else [(i, sim, p) for i, (sim, p) in out.items()]

    def occurrences(self, ws: list[str]) -> list[tuple]:
        """The first window of each item of fewer than k words: such an item is one shingle, so its similarity is 1 or 0."""
        out = []
        for n, items in self.short.items():
            first = {}
            for p, window in enumerate(zip(*(ws[i:] for i in range(n)), strict=False)):
                if window in items:
                    first.setdefault(window, p)
            out += [(i, 1.0, p) for window, p in first.items() for i in items[window]]
        return _once(out)


def _once(rows: list[tuple]) -> list[tuple]:
    """The most similar row of each item, the first of equals."""
    best = {}
    for i, sim, p in rows:
        if i not in best or (-sim, p) < (-best[i][0], best[i][1]):
            best[i] = (sim, p)
    return [(i, sim, p) for i, (sim, p) in best.items()]


class TokenHashes(WordHashes):
    """The same for words as strings."""

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def hashes(ws: list[str], k: int, known: TokenHashes) -> np.ndarray:
    return shingle_hashes(np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws)), k)


def weights(ws: list[str], k: int) -> np.ndarray:
    """Characters of each k-word shingle."""
    c = np.concatenate([[0], np.cumsum([len(x) for x in ws])])
    return (c[k:] - c[:-k]).astype(np.float64)


def find_benchmark(docs: DataFrame, benchmark: DataFrame, k: int = 5, least: float = 0.8, items_at_once: int = 20_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, similarity, first_word): documents with a window that is at least `least` similar to an item.

    Words are runs of letters, digits and underscores, lower-cased, so case, punctuation and white space do not matter. One row per input row and item, with the item's most similar window (the first of equals).
    A window is as long as the item; a text of at least k words but fewer than the item is one window as a whole.
    An item of fewer than k words is one shingle, found where its words occur in a row; null and empty texts hold and are
    nothing; repeated rows are answered each; empty tables give an empty table. The items go to the tasks in blocks of
    items_at_once, or fewer long ones (a pass over the documents each), so what is broadcast is bounded however many items there are. A task
    works on one document at a time and on stretches of bounded length around shared shingles; nothing is shuffled.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    kinds = [x.schema[0].dataType.simpleString() for x in (src, items)]
    out = None
    for index in _indexes(items, k, items_at_once):
        part = _search(src, index, least, kinds)
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id", id_col)


def _indexes(items: DataFrame, k: int, at_once: int) -> Iterator:
    """Broadcast indexes over blocks of about at_once items (item_id, text); one empty index without items."""
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / at_once), math.ceil(size / BLOCK_CHARS))
    for b in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        yield items.sparkSession.sparkContext.broadcast(ItemIndex.build([(r.item_id, r.text) for r in some], k))


def _search(src: DataFrame, index, least: float, kinds: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenHashes()
        for b in chunks(batches, "text"):
            at, rows = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                got = index.value.found(t, known, least)
                at += [i] * len(got)
                rows += got
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_pydict({"id": b.column(0).take(pa.array(at, pa.int64())), "item_id": pa.array(cols[0]), "similarity": pa.array(cols[1], pa.float64()), "first_word": pa.array(cols[2], pa.int64())})

    return src.mapInArrow(tidy(run), f"id {kinds[0]}, item_id {kinds[1]}, similarity double, first_word long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = 5, least: float = 0.8, items_at_once: int = 20_000, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text holds no item: rows are judged one by one in a narrow pass, ids play no part."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    for index in _indexes(items, k, items_at_once):

        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            known = TokenHashes()
            for b in chunks(batches, text_col):
                yield b.filter(pa.array([not index.value.found(t, known, least) for t in b.column(text_col).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(tidy(clean), docs.schema)
    return docs
