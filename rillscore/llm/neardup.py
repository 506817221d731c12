"""Exact n-gram Jaccard join by partitioning the universe of shingles (pigeonhole), without pairs of copies.

Two sets of sizes s <= l with Jaccard >= num/den differ in at most H = (den-num)/(den+num) * (s+l) elements. The universe
is hashed into m segments by size band. At least m - H segments of two linked sets are equal, so a set may leave out the
m - H - 1 segments that come last in an order of contents that both sets share: of the equal segments the best one stays
in both. Hence:

* a set writes a key for each of its H + 1 best segments: those with the most shingles, so that few unrelated sets have
  them too. H is the bound for the set's own size. How many segments to cut the universe into is a matter of cost: more
  segments leave more of them out, but hold fewer shingles each (`segments_for`).
* bands of small sets where H = 1: one segment, and keys are the set and its one-deletion neighbourhood.

A set writes keys for its own band and, where a larger partner may be in it, for the next one. Sets that are equal are one
node from the start (a task writes the keys of equal sets once). A key that two nodes share gives that pair; of the nodes
of other keys only the pairs with a pivot are verified, and with a second pivot what the first one leaves. Where a key then
still has nodes of several components, those nodes are joined once more on their rarest shingles: of the shingles of a set
of n, in the order of how many of these nodes have them, two linked sets share one of the first n - ceil(n * num / den) + 1
(fewer of the smaller set). Edited copies of one text have shingles of their own there and meet nobody. No link between components is lost, no group
is expanded into all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillscore.llm.common import WordHashes, chunks, drop_path, mix, release, shingle_hashes, table, tidy, words_of
from rillscore.llm.components import connected_components

U64 = np.uint64


def most_apart(size_sum: int, num: int, den: int) -> int:
    """Largest symmetric difference of two sets of that total size whose Jaccard similarity is at least num/den."""
    return (den - num) * size_sum // (den + num)


def segments_for(low: int, h: int) -> int:
    """Segments that make the h + 1 best ones of a set of `low` shingles cheapest.

    The cost of a key is how many unrelated sets have it too: many if it is empty, some with one shingle, few with more.
    The expected number of listed segments with at most c shingles follows from how many segments hold more than c.
    """
    best, want = (math.inf, h + 1), h + 1
    for m in sorted({want + max(1, want * i // 16) for i in range(1, 33)} | {want + i for i in range(12)}):
        cost, at_most, p = 0.0, 0.0, math.exp(-low / m)
        for c, price in enumerate((1.0, 1e-2, 1e-4)):
            at_most += p
            p *= low / m / (c + 1)
            more = max(0.0, 1 - at_most)
            if m <= 64:
                short = sum((want - i) * math.comb(m, i) * more**i * at_most ** (m - i) for i in range(want))
            else:
                mean, dev = m * more, math.sqrt(m * more * at_most) + 1e-9
                d = (want - mean) / dev
                short = dev * (math.exp(-d * d / 2) / math.sqrt(2 * math.pi) + d * (1 + math.erf(d / math.sqrt(2))) / 2)
            cost += price * short
        best = min(best, (cost + 1e-6 * m, m))
    return best[1]


@lru_cache(maxsize=8)
def band_plan(num: int, den: int, most: int = 1 << 31) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bands of set sizes: largest size, segments, whether deletions are indexed.

    Band 0 holds the sizes where only equal sets can be linked; it needs no keys.
    """
    u = 0
    while most_apart(2 * (u + 1), num, den) == 0:
        u += 1
    upper, segments, delete = [u], [0], [False]
    while u < most:
        u = max(u + 1, u * den // num)
        h = most_apart(2 * u, num, den)
        upper.append(u)
        delete.append(h == 1)
        segments.append(1 if h == 1 else segments_for(max(1, u * num // den), h))
    return np.array(upper, np.int64), np.array(segments, np.int64), np.array(delete)


def bands_of(n: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """For sets of sizes n: (set, band) of all keys to write: the own band, and the next one if a partner can be in it."""
    upper = band_plan(num, den)[0]
    own = np.searchsorted(upper, n)
    which = np.arange(len(n))
    reach = (n * den // num > upper[own]) & (n > 0)
    return np.concatenate([which[own > 0], which[reach]]), np.concatenate([own[own > 0], own[reach] + 1])


def key_counts(n: np.ndarray, band: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys that sets of sizes n write for a band: with deletions all, else one more than they can differ from a partner there."""
    upper, _, delete = band_plan(num, den)
    return np.where(delete[band], n + 1, (den - num) * (n + np.minimum(upper[band], n * den // num)) // (den + num) + 1)


def sets_of(texts: list[str | None], k: int, known: WordHashes) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, sorted."""
    split = [words_of(t) for t in texts]
    flat = np.fromiter((known[w] for ws in split for w in ws), U64, sum(map(len, split)))
    out, a = [], 0
    for ws in split:
        out.append(np.unique(shingle_hashes(flat[a : a + len(ws)], k)))
        a += len(ws)
    return out


def identity(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each set: a 64-bit identity, and the size."""
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, U64)
    total = np.zeros(len(sets), U64)
    np.add.at(total, np.repeat(np.arange(len(sets)), n), mix(flat, 3))
    return mix(total ^ mix(n.astype(U64), 5), 6), n


def parities(sets: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each set, a bit for each residue of its shingles' hashes: whether an odd number of them falls on it; and the same folded in half.

    A shingle that only one of two sets has flips one bit, so two sets differ at least as much as these bits do. There are
    at least 1,024 bits and as many as shingles, so that sets with little in common differ in more bits than a link allows;
    sets whose numbers of bits differ are compared on the folded half.
    """
    n = np.array([len(s) for s in sets], np.int64)
    words = 2 ** np.maximum(4, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64) - 6)
    ends = np.cumsum(words)
    out = np.zeros(int(words.sum()), U64)
    flat = mix(np.concatenate(sets), 4) if sets else np.zeros(0, U64)
    at = np.repeat(np.arange(len(sets)), n)
    word = ((flat >> U64(6)) & (words[at] - 1).astype(U64)).astype(np.int64)
    np.bitwise_xor.at(out, (ends - words)[at] + word, U64(1) << (flat & U64(63)))
    whole = [out[z - m : z].view(np.int64) for m, z in zip(words.tolist(), ends.tolist(), strict=True)]
    return whole, [w[: len(w) // 2] ^ w[len(w) // 2 :] for w in whole]


def keys_of(sets: list[np.ndarray], n: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) of all segment keys."""
    _, segments, delete = band_plan(num, den)
    which, band = bands_of(n, num, den)
    if not len(which):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    m = segments[band]
    first = np.cumsum(m) - m
    lens = n[which]
    flat = np.concatenate([sets[i] for i in which])
    job = np.repeat(np.arange(len(which)), lens)
    seg = first[job] + (((flat >> U64(32)) * m[job].astype(U64)) >> U64(32)).astype(np.int64)
    value = mix(flat, 1)
    content = np.zeros(int(m.sum()), U64)
    np.add.at(content, seg, value)
    size = np.bincount(seg, minlength=len(content))
    seg_job = np.repeat(np.arange(len(which)), m)
    place = mix((band[seg_job].astype(U64) << U64(40)) + (np.arange(len(content)) - first[seg_job]).astype(U64), 2)
    key = mix(content ^ place)
    # The common order of contents: most shingles first, then by key; equal keys of a set keep the order of their places.
    order = np.lexsort((key, -size, seg_job))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order)) - first[seg_job[order]]
    lists = (rank < key_counts(lens, band, num, den)[seg_job]) | delete[band][seg_job]
    out_set, out_key = [which[seg_job[lists]]], [key[lists]]
    if (less := delete[band][job]).any():
        out_set.append(which[job[less]])
        out_key.append(mix((content[seg[less]] - value[less]) ^ place[seg[less]]))
    return np.concatenate(out_set), np.concatenate(out_key)


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U64).view(np.int64), pa.int64())


def _sets_table(src: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """id, node (identity of the shingle set), n, n_keys: one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in chunks(batches, "text"):
            node, n = identity(sets_of(b.column(1).to_pylist(), k, known))
            which, band = bands_of(n, num, den)
            cost = np.bincount(which, weights=key_counts(n[which], band, num, den), minlength=len(n)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), _as_long(node), pa.array(n), pa.array(cost)], ["id", "node", "n", "n_keys"])

    return src.mapInArrow(tidy(run), f"id {src.schema['id'].dataType.simpleString()}, node long, n long, n_keys long")


BLOCK = "part long, keys binary, nodes binary, hot boolean"


def _blocks(part: np.ndarray, key: np.ndarray, node: np.ndarray, hot: bool) -> pa.RecordBatch:
    order = np.argsort(part, kind="stable")
    part, key, node = part[order], key[order], node[order]
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
    cells = [pa.array([x[a:z].tobytes() for a, z in zip(cuts, cuts[1:], strict=False)], pa.binary()) for x in (key, node)]
    return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]], pa.int64()), *cells, pa.array([hot] * (len(cuts) - 1))], ["part", "keys", "nodes", "hot"])


def _dealt(key: np.ndarray, node: np.ndarray, parts: int, kind: type, hot: int = 8) -> Iterator[pa.RecordBatch]:
    """Blocks of (key, node) for `parts` groups by the key's upper half; a block holds the keys as `kind` (cut off) and the nodes.

    A key that `hot` nodes of one piece of text have is known to be shared: its nodes go to other groups, dealt by node,
    and only one of them, marked, meets the key's other nodes. So a key of very many near copies does not fill a group.
    """
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    times = np.diff(np.append(starts, len(key)))
    part, low = (((key >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64), key.astype(kind)
    many = np.repeat(times >= hot, times)
    if many.any():
        whole = key[many] if kind == U64 else (part[many].astype(U64) << U64(32)) | low[many].astype(U64)
        yield _blocks(parts + (mix(node[many], 7) % U64(parts)).astype(np.int64), whole, node[many], False)
        one = starts[times >= hot]
        yield _blocks(part[one], low[one], node[one], True)
    if not many.all():
        yield _blocks(part[~many], low[~many], node[~many], False)


def _gathered(group: pa.Table, parts: int, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a group's blocks: the distinct (key, node) in order, and of each key how many nodes are here and whether there are more."""
    part = group.column("part")[0].as_py()
    if part % 8 == 0:
        release()  # of the groups before, now and then
    kind = U64 if part >= parts else kind
    keys, nodes = ([np.frombuffer(x, t) for x in group.column(c).to_pylist()] for c, t in (("keys", kind), ("nodes", U64)))
    flag = np.repeat(group.column("hot").to_numpy(), list(map(len, keys)))
    key, node = np.concatenate(keys).astype(U64), np.concatenate(nodes)
    order = np.lexsort((node, key))
    key, node, flag = key[order], node[order], flag[order]
    fresh = np.append(True, key[1:] != key[:-1])
    keep = fresh | np.append(True, node[1:] != node[:-1])
    starts = np.flatnonzero(fresh)
    many = np.maximum.reduceat(flag, starts) | (part >= parts)
    nth = np.cumsum(keep)
    times = np.diff(np.append(nth[starts] - 1, nth[-1]))
    return key[keep] | (U64(0) if kind == U64 else U64(part) << U64(32)), node[keep], times, many


def _shared_keys(src: DataFrame, k: int, num: int, den: int, parts: int) -> DataFrame:
    """(key, x, y): the nodes x of all keys that several nodes have, y null; of a key with two nodes the pair, key null.

    A key's part and its lower half tell it from nearly all others (a group holds about a million keys); where two keys
    agree in both, there is a comparison more.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = WordHashes(), set()
        for b in chunks(batches, "text"):
            sets = sets_of(b.column(1).to_pylist(), k, known)
            node, n = identity(sets)
            if len(seen) > 1_000_000:
                seen.clear()
            new = []
            for i, x in enumerate(node.tolist()):
                if x not in seen:
                    seen.add(x)
                    new.append(i)
            which, key = keys_of([sets[i] for i in new], n[new], num, den)
            yield from _dealt(key, node[new][which], parts, np.uint32)

    def shared(group: pa.Table) -> pa.Table:
        key, node, times, many = _gathered(group, parts, np.uint32)
        first = (np.cumsum(times) - times)[(times == 2) & ~many]
        member = np.repeat(many | (times > 2), times)
        x, y = _pairs(node[first], node[first + 1])
        none = lambda n: pa.nulls(n, pa.int64())
        return pa.table([pa.concat_arrays([none(len(x)), _as_long(key[member])]), _as_long(np.concatenate([x, node[member]])), pa.concat_arrays([_as_long(y), none(member.sum())])], ["key", "x", "y"])

    return src.mapInArrow(tidy(write), BLOCK).groupBy("part").applyInArrow(shared, "key long, x long, y long")


def _frequencies(texts: DataFrame, k: int, parts: int) -> DataFrame:
    """Of the sets of texts(node, text): (node, alone) with alone the number of shingles that no other of them has, in parts
    to be summed, and (node, shingle, times) of the others, times the number of sets that have it (very many: 2^31)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in chunks(batches, "text"):
            sets = sets_of(b.column(1).to_pylist(), k, known)
            node = np.repeat(b.column(0).to_numpy().view(U64), [len(x) for x in sets])
            yield from _dealt(np.concatenate(sets), node, parts, U64)

    def count(group: pa.Table) -> pa.Table:
        key, node, times, many = _gathered(group, parts, U64)
        of = np.repeat(np.where(many, 1 << 31, times), times)
        one, alone = np.unique(node[of == 1], return_counts=True)
        more = of > 1
        none = lambda n: pa.nulls(n, pa.int64())
        return pa.table([_as_long(np.concatenate([one, node[more]])), pa.concat_arrays([pa.array(alone, pa.int64()), none(more.sum())]), pa.concat_arrays([none(len(one)), _as_long(key[more])]), pa.concat_arrays([none(len(one)), pa.array(of[more], pa.int64())])], ["node", "alone", "shingle", "times"])

    return texts.mapInArrow(tidy(write), BLOCK).groupBy("part").applyInArrow(count, "node long, alone long, shingle long, times long")


def _pairs(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones of the pairs."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    keep = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])) if len(x) else np.zeros(0, bool)
    return x[keep], y[keep]


def _shingles(text: str, k: int) -> set:
    ws = words_of(text)
    return set(zip(*(ws[i:] for i in range(k)), strict=False)) if len(ws) >= k else {tuple(ws)} if ws else set()


def _verify(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(x, y) -> x, y, common, either: sizes of intersection and union of the two real shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for b in batches:
            common, either = [], []
            for y, s, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if y != last:
                    last, last_set = y, _shingles(t, k)
                one = _shingles(s, k)
                common.append(len(one & last_set))
                either.append(len(one) + len(last_set) - common[-1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(common, pa.int64()), pa.array(either, pa.int64())], ["x", "y", "common", "either"])

    with_x = pairs.join(texts.select(F.col("node").alias("x"), F.col("text").alias("text_x")), "x")
    both = with_x.join(texts.select(F.col("node").alias("y"), F.col("text").alias("text_y")), "y").select("x", "y", "text_x", "text_y")
    return both.mapInArrow(tidy(run), "x long, y long, common long, either long")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = 16 << 20) -> DataFrame:
    """Groups of near duplicates over k-word shingles at Jaccard >= num/den, exactly.

    Returns one row per input row: id, n_shingles, component_id (the smallest id reachable by links, itself included) and
    n_links_seen (links with its set that were verified: at least one for a member of a group of different texts; links
    inside a known group are not looked for, so this is a lower bound). Words are `[^\\x20\\x09-\\x0D]+` after lower-casing
    A-Z; a text of fewer than k words is one shingle; null texts and texts without words have no shingles and no links
    (component_id is their own id). Rows that repeat an id are one vertex and each get a row. A row whose id is null links
    others only through its equal copies and gets their component, or null. An empty table gives an empty table. Equal sets
    are recognised by a 64-bit sum of their shingle hashes; candidates are compared on the shingles themselves.
    """
    if not den <= 2 * num <= 2 * den:
        raise ValueError("the similarity must lie between 0.5 and 1")
    temporary: list[str] = []
    keep = lambda df, name: table(df, name, temporary)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = table(_sets_table(src, k, num, den), "sets")
    keys = sets.agg(F.sum("n_keys")).first()[0] or 0
    shared = keep(_shared_keys(src, k, num, den, max(240, keys * 12 // part_bytes)), "shared")
    pairs, members = shared.where("key IS NULL").select("x", "y"), shared.where("key IS NOT NULL").select("key", F.col("x").alias("node"))
    classes = sets.where("n > 0").groupBy("node").agg(F.min("id").alias("rep"), F.max("n").alias("n"), F.count("*").alias("copies"))
    degrees = members.groupBy("node").agg(F.count("*").alias("degree")).unionByName(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct().withColumn("degree", F.lit(0).cast("long")))
    info = keep(degrees.groupBy("node").agg(F.sum("degree").alias("degree")).join(classes.where("rep IS NOT NULL").drop("copies"), "node"), "info")
    texts = keep(_texts(src, info.select(F.col("rep").alias("id"), "node"), k), "texts")

    apart = F.expr(f"{den - num} * (n_x + n_y) div {den + num}")
    alike_sizes = F.least("n_x", "n_y") * den >= F.greatest("n_x", "n_y") * num
    short = lambda a, b: F.when(F.size(f"bits_{a}") <= F.size(f"bits_{b}"), F.col(f"bits_{a}")).otherwise(F.col(f"half_{a}"))
    differ = F.aggregate(F.zip_with(short("x", "y"), short("y", "x"), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, c: s + c)
    of = lambda df, c, *names: df.select(F.col("node").alias(c), *[F.col(f).alias(f"{f}_{c}") for f in names])

    def verify(some: DataFrame, name: str) -> DataFrame:
        """(x, y, link) of the pairs that sizes and then parity bits leave open, on their real shingles."""
        some = some.where("x <> y").select("x", "y").distinct().join(of(info, "x", "n"), "x").join(of(info, "y", "n"), "y").where(alike_sizes)
        some = some.join(of(texts, "x", "bits", "half"), "x").join(of(texts, "y", "bits", "half"), "y").where(differ <= apart).select("x", "y")
        out = _verify(keep(some, f"{name}-pairs"), texts, k)
        out = out.select("x", "y", (F.col("common") * den >= F.col("either") * num).alias("link"))
        return keep(out.dropDuplicates(["x", "y"]), name)

    def stars(some: DataFrame) -> DataFrame:
        """(key, x, y): each member of a key with the key's pivot, the node that shares most keys (an original more than its copies)."""
        pivots = some.join(info.select("node", "degree"), "node").groupBy("key").agg(F.max(F.struct("degree", "node")).alias("p"))
        return some.join(pivots, "key").select("key", F.col("node").alias("x"), F.col("p.node").alias("y"))

    first = keep(stars(members), "stars")
    seen = verify(first.select("x", "y").unionByName(pairs), "verified")
    # What the pivot doesn't link: a second pivot among those, then a join on rare shingles.
    told = first.join(seen, ["x", "y"], "left").select("key", F.col("x").alias("node"), (F.coalesce("link", F.lit(False)) | (F.col("x") == F.col("y"))).alias("near"))
    told = keep(told, "told")
    away = told.where("NOT near")
    if away.limit(1).count():
        second = verify(stars(away.select("key", "node")), "verified2")
        seen = seen.unionByName(second)
        comp = connected_components(seen.where("link").select(F.col("x").alias("a"), F.col("y").alias("b")), "first", temporary).withColumnRenamed("label", "comp")
        sized = keep(info.select("node", "n").join(comp, "node", "left").select("node", "n", F.coalesce("comp", "node").alias("comp")), "sized")
        # Members of keys that hold several components: linked ones share one of the rarest shingles among these nodes.
        undecided = told.select("key", "node").join(sized, "node").groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key")
        undecided = keep(told.join(undecided.join(away.select("key").distinct(), "key"), "key", "left_semi").select("node").distinct().join(sized, "node"), "undecided")
        amount = undecided.agg(F.sum("n")).first()[0] or 0
        counted = keep(_frequencies(texts.join(undecided.select("node"), "node", "left_semi").select("node", "text"), k, max(240, amount * 16 // part_bytes)), "frequencies")
        alone = counted.where("shingle IS NULL").groupBy("node").agg(F.sum("alone").alias("alone"))
        # Two linked sets have at least ceil(num * n / den) shingles of either in common, and 2 * num / (num + den) of the smaller one's.
        rest = undecided.join(alone, "node", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
        rest = rest.withColumn("first", F.expr(f"n + 1 - div(n * {num} + {den - 1}, {den})")).withColumn("fewer", F.expr(f"n + 1 - div(2 * n * {num} + {den + num - 1}, {den + num})")).where("alone < first")
        place = F.row_number().over(Window.partitionBy("node").orderBy("times", "shingle")) - 1 + F.col("alone")
        listed = counted.where("shingle IS NOT NULL").select("node", "shingle", "times").join(rest, "node").withColumn("at", place).where("at < first")
        listed = keep(listed.select("node", "shingle", "n", "comp", "at", (F.col("at") < F.col("fewer")).alias("fewer")), "rarest")
        end = lambda df, c: df.select("shingle", F.col("node").alias(c), *[F.col(f).alias(f"{f}_{c}") for f in ("n", "comp", "at")])
        # What stands behind a pair's first common shingle bounds what they have in common.
        enough = F.expr(f"least(n_x - at_x, n_y - at_y) * {num + den} >= (n_x + n_y) * {num}")
        open_pairs = end(listed, "x").join(end(listed.where("fewer"), "y"), "shingle").where("x <> y AND n_y <= n_x AND comp_x <> comp_y").where(alike_sizes & enough)
        open_pairs = open_pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        done = seen.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        seen = seen.unionByName(verify(keep(open_pairs.distinct(), "open").join(done, ["x", "y"], "left_anti"), "verified3"))

    reps = info.select("node", "rep")
    links = seen.where("link").select("x", "y")
    edges = links.join(reps.withColumnsRenamed({"node": "x", "rep": "a"}), "x").join(reps.withColumnsRenamed({"node": "y", "rep": "b"}), "y").select("a", "b")
    # Rows of one id with several texts are one vertex.
    twice = sets.where("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.min("node").alias("p"), F.max("node").alias("q"), F.count_distinct("node").alias("c")).where("c > 1")
    alike = sets.join(twice.select("id"), "id", "left_semi").select("id", "node").join(classes.select("node", "rep"), "node").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    comp = connected_components(edges.unionByName(alike), "links", temporary).withColumnsRenamed({"node": "rep", "label": "component"})
    n_links = links.select(F.explode(F.array("x", "y")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    of_node = classes.join(comp, "rep", "left").where("copies > 1 OR component IS NOT NULL").select("node", F.coalesce("component", "rep").alias("component")).join(n_links, "node", "left")
    of_node = table(of_node, "of-node")
    for path in temporary:  # the result reads sets and of_node only
        drop_path(docs.sparkSession, path)
    return sets.join(of_node, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links_seen")
    )


def _texts(src: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """(node, text, bits, half) of the nodes in reps(id, node): of equal sets one text. The documents are shuffled once, by id.

    An id may have several texts, hence the comparison of sets. A task keeps one row for each node of an id; an id that
    occurs in very many rows may come from several tasks, with equal rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at, done = WordHashes(), None, set()
        for b in chunks(batches, "text"):
            sets = sets_of(b.column(2).to_pylist(), k, known)
            right = identity(sets)[0].view(np.int64).tolist()
            keep = []
            for i, (x, want, got) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), right, strict=True)):
                if x != at:
                    at, done = x, set()
                if want == got and got not in done:
                    done.add(got)
                    keep.append(i)
            whole, half = parities([sets[i] for i in keep])
            rows = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), *(pa.array(x, pa.list_(pa.int64())) for x in (whole, half))], ["node", "text", "bits", "half"])

    return src.join(reps.hint("merge"), "id").select("id", "node", "text").mapInArrow(tidy(run), "node long, text string, bits array<long>, half array<long>")
