"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The top of the tree is fitted on a bounded sample (`sample` vectors) and every vector is put into a leaf. Leaves that hold
too many rows are split where their rows are, each on a bounded sample of its own, so that leaves do not grow with the
input before there are about `most_leaves` of them. For the search every vector is put into its nearest `copies` leaves
and written there in packed chunks. A query ranks leaves by the inner products with their centres, raised by a share of
what the leaves' radius could add, and visits those above a cut of its own. How far the cut goes down is calibrated: for
some of the queries the exact neighbours among all rows are found, and cuts are lowered until the leaves hold the wanted
share of them. A task takes a block of queries and reads the chunks one after another; the queries that visit a leaf meet
it in one matrix product, whose rough scores are held against the queries' kth best so far. Neither queries nor pairs are
shuffled. A query that is short of rows in the end visits the other leaves too.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rillscore.llm.common import bounded_sample, drop_path, hash_cut, table, tidy


#: How much of a bin's radius counts for it; the whole radius would be an upper bound that hardly any vector reaches.
REACH = 0.25
#: A full leaf is split on about this many of its rows.
SPLIT_SAMPLE = 2000
#: Leaves are ranked against this many of them to set a query's cut.
CUT_LEAVES = 4096
#: Scores of a product that is looked at in one piece; hits that are kept before they are merged into the best.
TILE, HITS = 1 << 18, 1 << 20
QUERIES = {t: pa.schema([("vec_id", pa.int64()), ("v", pa.list_(a))]) for t, a in ((np.float32, pa.float32()), (np.float64, pa.float64()))}


@dataclass
class KMeansTree:
    """Inner nodes hold their children's centres and radii (root mean square); children are node numbers, leaves are ~number of the leaf."""

    centers: list[np.ndarray]
    radii: list[np.ndarray]
    children: list[list[int]]
    leaves: int

    @classmethod
    def fit(cls, x: np.ndarray, branch: int, leaf_rows: int, seed: int = 11) -> KMeansTree:
        rng = np.random.default_rng(seed)
        tree = cls([], [], [], 0)

        def grow(rows: np.ndarray) -> int:
            part = x[rows]
            distinct = len(np.unique(part[: 4 * branch], axis=0)) if len(part) else 0
            if len(rows) <= leaf_rows or distinct < 2:
                tree.leaves += 1
                return ~(tree.leaves - 1)
            c, to = kmeans(part, min(branch, distinct, max(2, len(rows) // max(1, leaf_rows // 2))), rng)
            used = np.unique(to)
            if len(used) < 2:
                tree.leaves += 1
                return ~(tree.leaves - 1)
            me = len(tree.centers)
            tree.centers.append(c[used])
            tree.radii.append(np.array([np.sqrt(((part[to == u] - c[u]) ** 2).sum(1).mean()) for u in used]))
            tree.children.append([])
            tree.children[me] = [grow(rows[to == u]) for u in used]
            return me

        grow(np.arange(len(x)))
        return tree

    def grafted(self, grown: dict[int, KMeansTree]) -> KMeansTree:
        """The tree with a tree in place of some leaves; their first leaves and all other leaves keep the numbers."""
        out = KMeansTree([*self.centers], [*self.radii], [[*c] for c in self.children], self.leaves)
        place = {~c: (node, i) for node, cs in enumerate(self.children) for i, c in enumerate(cs) if c < 0}
        for x, sub in grown.items():
            node, leaf = len(out.centers), [x, *range(out.leaves, out.leaves + sub.leaves - 1)]
            out.centers += sub.centers
            out.radii += sub.radii
            out.children += [[node + c if c >= 0 else ~leaf[~c] for c in cs] for cs in sub.children]
            out.leaves += sub.leaves - 1
            if x in place:
                out.children[place[x][0]][place[x][1]] = node
        return out

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: down the tree to the nearest centre."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))] if self.centers else []
        while todo:
            node, rows = todo.pop()
            to = nearest(x[rows], self.centers[node])
            for i, child in enumerate(self.children[node]):
                some = rows[to == i]
                if child < 0:
                    out[some] = ~child
                elif len(some):
                    todo.append((child, some))
        return out

    def visit(self, q: np.ndarray, most: int, rows: np.ndarray | None = None, least: int = 0) -> list[int]:
        """`most` leaves, best bin first, and more until they hold `least` rows (rows: how many each leaf has)."""
        if not self.centers:
            return [0]
        found, heap, held, reach = [], [(0.0, 0)], 0, REACH * float(np.sqrt(q @ q))
        while heap and (len(found) < most or held < least):
            _, node = heapq.heappop(heap)
            if node < 0:
                found.append(~node)
                held += 0 if rows is None else int(rows[~node])
                continue
            for near, child in zip((self.centers[node] @ q + reach * self.radii[node]).tolist(), self.children[node], strict=True):
                heapq.heappush(heap, (-near, child))
        return found


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1)[None, :] - 2 * (x @ c.T), axis=1)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        to = nearest(x, c)
        n = np.bincount(to, minlength=k)
        for j in np.flatnonzero(n):
            c[j] = x[to == j].mean(0)
    return c, nearest(x, c)


class Leaves:
    """The leaves of a tree as one list of centres, in groups of near ones, so that whole batches are ranked by matrix products."""

    def __init__(self, tree: KMeansTree, dim: int, kind: type):
        self.centers, self.radii = np.zeros((tree.leaves, dim), kind), np.zeros(tree.leaves, kind)
        for c, r, children in zip(tree.centers, tree.radii, tree.children, strict=True):
            at = [i for i, child in enumerate(children) if child < 0]
            to = [~children[i] for i in at]
            self.centers[to], self.radii[to] = c[at], r[at]
        self.ranks = np.concatenate([self.centers, self.radii[:, None]], axis=1)
        rng = np.random.default_rng(11)
        self.groups, to = kmeans(self.centers, min(tree.leaves, math.ceil(math.sqrt(tree.leaves))), rng)
        self.members = [np.flatnonzero(to == g) for g in range(len(self.groups))]
        self.some = np.sort(rng.choice(tree.leaves, min(tree.leaves, CUT_LEAVES), replace=False))

    def spread(self, x: np.ndarray, copies: int, beam: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of each row's `copies` nearest leaves, looked for in its nearest groups; a row has one leaf at least."""
        near = x @ self.groups.T - (self.groups * self.groups).sum(1) / 2
        if len(self.groups) > beam:
            near = np.argpartition(-near, beam - 1, axis=1)[:, :beam]
        else:
            near = np.tile(np.arange(len(self.groups)), (len(x), 1))
        by = np.argsort(near.ravel(), kind="stable")
        ends = np.searchsorted(near.ravel()[by], np.arange(len(self.groups) + 1))
        score, leaf = np.full((len(x), copies), -np.inf, x.dtype), np.full((len(x), copies), -1, np.int32)
        for g, of in enumerate(self.members):
            rows = by[ends[g] : ends[g + 1]] // near.shape[1]
            if not len(rows) or not len(of):
                continue
            c = self.centers[of]
            s = x[rows] @ c.T - (c * c).sum(1) / 2
            best_s, best_l, line = score[rows], leaf[rows], np.arange(len(rows))
            for _ in range(min(copies, len(of))):
                top = s.argmax(1)
                value, worst = s[line, top], best_s.argmin(1)
                better = value > best_s[line, worst]
                best_s[line[better], worst[better]], best_l[line[better], worst[better]] = value[better], of[top[better]]
                s[line, top] = -np.inf
            score[rows], leaf[rows] = best_s, best_l
        row, j = np.nonzero(leaf >= 0)
        return row, leaf[row, j]

    def asking(self, q: np.ndarray) -> np.ndarray:
        """The queries with the share of a leaf's radius that counts for them as one more component."""
        return np.concatenate([q, REACH * np.sqrt((q * q).sum(1))[:, None]], axis=1)

    def bounds(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(leaf, query): what the queries, as `asking` gives them, rank the leaves `at` by."""
        return self.ranks[at] @ q.T

    def cuts(self, q: np.ndarray, share: float) -> np.ndarray:
        """The bound from which on a query has this share of the leaves, told by some of them."""
        if share >= 1:
            return np.full(len(q), -np.inf, q.dtype)
        last = min(len(self.some), max(1, math.ceil(share * len(self.some))))
        out = np.empty(len(q), q.dtype)
        for a in range(0, len(q), 1024):
            out[a : a + 1024] = -np.partition(-self.bounds(q[a : a + 1024], self.some).T, last - 1, axis=1)[:, last - 1]
        return out - 1e-5 * np.abs(out)  # products of another shape are rounded otherwise


def matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    flat = column.flatten()
    return np.asarray(flat.to_numpy(zero_copy_only=False), kind).reshape(len(column), -1)


def best(q: np.ndarray, x: np.ndarray, qid: np.ndarray, xid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's k best rows other than itself, ties to the smaller id.

    Scores that decide are computed alike for every block (products summed row by row), whatever the shape of the block.
    """
    out_q, out_x, out_s = [], [], []
    for a in range(0, len(q), 256):
        rough = q[a : a + 256] @ x.T
        rough[qid[a : a + 256, None] == xid[None, :]] = -np.inf
        kth = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(rough), -np.inf)
        for i, row in enumerate(rough):
            at = np.flatnonzero((row >= kth[i] - 1e-9 * max(1.0, abs(kth[i]) if np.isfinite(kth[i]) else 1.0)) & (row > -np.inf))
            score = (x[at] * q[a + i]).sum(1)
            order = np.lexsort((xid[at], -score))[:k]
            out_q.append(np.full(len(order), qid[a + i]))
            out_x.append(xid[at][order])
            out_s.append(score[order])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(out_q), np.concatenate(out_x), np.concatenate(out_s)) if out_q else (empty, empty, np.zeros(0))


def _top(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _rows(indexed: DataFrame) -> dict[int, int]:
    return {r.leaf: r.n for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}


def _joined(batches: Iterator[pa.RecordBatch], most: int = 65_536) -> Iterator[pa.RecordBatch]:
    """Batches of about `most` rows: what a walk through all nodes costs is the same for any number of rows."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= most:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _assigned(src: DataFrame, tree: KMeansTree) -> DataFrame:
    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _joined(batches):
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.assign(matrix(b.column(2))), pa.int32())], ["vec_id", "is_query", "v", "leaf"])

    return src.mapInArrow(tidy(leaf), StructType([*src.schema.fields, StructField("leaf", IntegerType())]))


def _split(indexed: DataFrame, full: dict[int, int], branch: int, leaf_rows: int) -> dict[int, KMeansTree]:
    """Trees for the leaves in `full` (leaf: its rows), of leaves of about leaf_rows rows; leaves of equal vectors get none.

    Each is fitted in a task on the rows with the smallest hashes; equal rows count once, so that a group is bounded.
    """
    cuts = indexed.sparkSession.createDataFrame([(x, n, hash_cut(SPLIT_SAMPLE, n)) for x, n in full.items()], "leaf int, n long, cut long")
    some = indexed.join(F.broadcast(cuts), "leaf").withColumn("h", F.xxhash64("vec_id", "v")).where("h <= cut").dropDuplicates(["leaf", "h"])  # a row per leaf

    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("h").slice(0, SPLIT_SAMPLE)
        sub = KMeansTree.fit(matrix(rows.column("v").combine_chunks()), branch, max(8, round(leaf_rows * rows.num_rows / rows.column("n")[0].as_py())))
        return pa.table([rows.column("leaf").slice(0, 1), pa.array([pickle.dumps(sub)], pa.binary())], ["leaf", "tree"])

    grown = {r.leaf: pickle.loads(r.tree) for r in some.select("leaf", "n", "h", "v").groupBy("leaf").applyInArrow(fit, "leaf int, tree binary").collect()}
    return {x: sub for x, sub in grown.items() if sub.centers}


def index(src: DataFrame, sample: int = 20_000, branch: int = 8, leaf_rows: int = 100, most_leaves: int = 50_000) -> tuple[KMeansTree, DataFrame, np.ndarray]:
    """(tree, src(vec_id, is_query, v) with each row's leaf, rows of each leaf).

    Leaves of more than 2 * leaf_rows rows are split, or of more than that many that most_leaves of them would hold all
    rows: the tree that the driver and the tasks keep is bounded by a few times most_leaves centres. Where a leaf's sample was too
    small for the leaves it needs, they are split once or twice more.
    """
    tree = KMeansTree.fit(np.array([r.v for r in bounded_sample(src, "vec_id", sample, "v")], np.float64), branch, leaf_rows)
    written: list[str] = []
    indexed = table(_assigned(src, tree), "indexed", written)
    counts = _rows(indexed)
    target = max(leaf_rows, math.ceil(sum(counts.values()) / most_leaves))
    for most in (2 * target, 16 * target, 16 * target):
        full = {x: n for x, n in counts.items() if n > most}
        grown = _split(indexed, full, branch, target) if full else {}
        if not grown:
            break
        tree = tree.grafted(grown)
        indexed = table(_assigned(indexed.drop("leaf"), tree), "indexed", written)
        drop_path(src.sparkSession, written.pop(0))
        counts = _rows(indexed)
    return tree, indexed, np.array([counts.get(x, 0) for x in range(tree.leaves)], np.int64)


def _packed(indexed: DataFrame, leaves: Leaves, rows: np.ndarray, kind: type, copies: int, keep: int, block: int) -> DataFrame:
    """Chunks of the leaves: leaf, and the ids, row numbers and vectors of some of its rows as bytes.

    Of equal vectors in a chunk only the `keep` smallest ids are kept: ties go to the smaller id, so no query takes more.
    """
    blocks = np.maximum(1, -(-copies * rows // block))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _joined(batches, 32_768):
            if b.num_rows:
                row, leaf = leaves.spread(matrix(b.column(2), kind), copies)
                number = b.column(1).to_numpy()[row]
                yield pa.RecordBatch.from_arrays([*b.take(pa.array(row)).columns, pa.array(leaf, pa.int32()), pa.array((number % blocks[leaf]).astype(np.int32))], ["vec_id", "number", "v", "leaf", "part"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, number, x, leaf = b.column(0).to_numpy(), b.column(1).to_numpy(), matrix(b.column(2), kind), b.column(3).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
            out = []
            for a, z in zip(edges, edges[1:], strict=False):
                at = np.arange(a, z)
                if z - a > keep and np.unique(x[a:z, 0], return_counts=True)[1].max() > keep:
                    at = a + np.sort(_few_equal(x[a:z], ids[a:z], keep))
                out.append((int(leaf[a]), ids[at].tobytes(), number[at].tobytes(), x[at].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["leaf", "ids", "numbers", "v"])

    total = copies * int(rows.sum())
    parts = max(indexed.sparkSession.sparkContext.defaultParallelism, math.ceil(total * len(leaves.centers[0]) * np.dtype(kind).itemsize / (16 << 20)))
    src = indexed.select("vec_id", F.monotonically_increasing_id().alias("number"), "v")
    out = src.mapInArrow(tidy(spread), StructType([*src.schema.fields, StructField("leaf", IntegerType()), StructField("part", IntegerType())])).repartition(parts, "leaf", "part")
    return out.sortWithinPartitions("leaf", "part", "vec_id").mapInArrow(tidy(pack), "leaf int, ids binary, numbers binary, v binary")


def _few_equal(x: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """The rows whose id is among the `keep` smallest of its equal vectors."""
    same = np.unique(x, axis=0, return_inverse=True)[1].ravel()
    order = np.lexsort((ids, same))
    first = np.searchsorted(same[order], same[order])
    return order[np.arange(len(order)) - first < keep]


def _chunks(files: list[str], kind: type, dim: int) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
    """Some leaves at a time, and the ids, row numbers and vectors of each, read from the shared folder."""
    for f in files:
        fs, path = pyarrow.fs.FileSystem.from_uri(f)
        with fs.open_input_file(path) as source:
            for b in pq.ParquetFile(source).iter_batches(batch_size=64, use_threads=False):
                parts = [[np.frombuffer(x.as_buffer(), t) for x in b.column(c)] for c, t in (("ids", np.int64), ("numbers", np.int64), ("v", kind))]
                yield b.column("leaf").to_numpy(), [(i, n, v.reshape(-1, dim)) for i, n, v in zip(*parts, strict=True)]


class Best:
    """The k best rows of each query of a block so far; thr: the score that a row must reach to be among them."""

    def __init__(self, q: np.ndarray, qid: np.ndarray, k: int, keep: int, kind: type):
        self.q, self.qid, self.k, self.keep = q, qid, k, keep
        self.rough, self.norm = q.astype(kind), np.sqrt((q * q).sum(1))
        self.thr = np.full(len(q), -np.inf)
        self.error = 2 * q.shape[1] * float(np.finfo(kind).eps)
        self.hits: list[tuple[np.ndarray, ...]] = []
        self.n = 0
        self.best = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    def meet(self, who: np.ndarray, ids: np.ndarray, numbers: np.ndarray, x: np.ndarray) -> None:
        """The queries `who` see the rows x: products in the vectors' precision pick, the score of a pick is computed in double."""
        longest = math.sqrt(float((x * x).sum(1).max()))
        step = max(16, TILE // len(x))
        for a in range(0, len(who), step):
            some = who[a : a + step]
            s = self.rough[some] @ x.T
            slack = self.error * self.norm[some] * longest + 1e-36  # of rounding: what may reach the bound is a hit
            thr = self.thr[some]
            if len(x) >= self.keep and (new := np.flatnonzero(thr == -np.inf)).size:
                thr[new] = np.partition(s[new], -self.keep, axis=1)[:, -self.keep] - slack[new]
                self.thr[some[new]] = thr[new]
            low = thr - slack
            full = np.flatnonzero(s.max(axis=1) >= low)
            if not len(full):
                continue
            i, j = np.nonzero(s[full] >= low[full, None])
            i = some[full[i]]
            other = ids[j] != self.qid[i]
            i, j = i[other], j[other]
            self.hits.append((i.astype(np.int32), numbers[j], ids[j], (x[j] * self.q[i]).sum(1)))
            self.n += len(i)
            if self.n >= HITS:
                self.merge()

    def merge(self) -> None:
        i, number, ids, score = (np.concatenate(c) for c in zip(self.best, *self.hits, strict=True))
        good = score >= self.thr[i]
        i, number, ids, score = i[good], number[good], ids[good], score[good]
        order = np.lexsort((number, ids, -score, i))
        i, number, ids, score = i[order], number[order], ids[order], score[order]
        new = np.ones(len(i), bool)
        new[1:] = (i[1:] != i[:-1]) | (number[1:] != number[:-1])  # a row has copies in several leaves
        i, number, ids, score = i[new], number[new], ids[new], score[new]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        top = rank < self.k
        self.best, self.hits, self.n = (i[top], number[top], ids[top], score[top]), [], 0
        last = rank == self.k - 1
        self.thr[i[last]] = np.maximum(self.thr[i[last]], score[last])

    def short(self) -> np.ndarray:
        """The queries with fewer than k rows."""
        self.merge()
        return np.flatnonzero(np.bincount(self.best[0], minlength=len(self.q)) < self.k)


def search(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.95, sample: int = 20_000, calibrate: int = 128, branch: int = 8, leaf_rows: int = 100, most_leaves: int = 50_000, block: int = 8192, id_col: str = "vec_id", vec_col: str = "embedding", copies: int = 2, most_queries: int = 32_768) -> DataFrame:
    """Each query's k nearest rows by inner product: query_id, rank (from 1), vec_id, score (double, on the vectors given).

    Queries are the rows where is_query holds, candidates all rows but those of the query's own id. Vectors that are null,
    zero, of another length than most, or hold null or non-finite components take no part, as queries or as candidates.
    Ties go to the smaller id; with fewer than k candidates all are returned; repeated rows are candidates each; no rows
    give none. Every vector is indexed, in `copies` leaves. Blocks of about `most_queries` queries read the leaves from the
    shared folder, in chunks of bounded size (a leaf with very many equal vectors becomes many chunks).
    """
    spark = vectors.sparkSession
    of = vectors.schema[vec_col].dataType.elementType.typeName()
    vec = F.col(vec_col) if of == "float" else F.transform(F.col(vec_col), lambda v: v.cast("double"))
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), is_query.alias("is_query"), vec.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    src = src.where("vec_id IS NOT NULL AND v IS NOT NULL").where(fine)
    sizes = src.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("count"), F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("most")).orderBy(F.desc("count"), "dim").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = sizes[0]["dim"]
    # Products are in single precision only where nothing is lost: vectors given so, whose products stay in its range.
    kind = np.float32 if of == "float" and 1e-10 < sizes[0]["most"] < 1e15 else np.float64
    src = src.where(F.size("v") == dim)
    tree, indexed, rows = index(src, sample, branch, leaf_rows, most_leaves)
    leaves = Leaves(tree, dim, kind)
    queries = indexed.where("is_query").select("vec_id", "v")
    ids = queries.groupBy("vec_id").count().agg(F.sum("count"), F.max("count")).first()
    n_queries, repeats = ids[0] or 0, ids[1]  # a query's own rows are no candidates
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    keep = k + repeats
    packed = table(_packed(indexed, leaves, rows, kind, copies, keep, block), "packed")
    files = sorted(packed.inputFiles())

    # Calibration: exact neighbours of some queries among all rows, and the leaves that hold them.
    some = bounded_sample(queries, "vec_id", calibrate, "vec_id", "v")
    q, qid = np.array([r.v for r in some], np.float64), np.array([r.vec_id for r in some], np.int64)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, where = Best(q, qid, k, keep, kind), {}
            for at, chunks in _chunks(b.column(0).to_pylist(), kind, dim):
                for leaf, chunk in zip(at.tolist(), chunks, strict=True):
                    found.meet(np.arange(len(q)), *chunk)
                    for number in {n for h in found.hits for n in h[1].tolist()}:
                        where.setdefault(number, set()).add(leaf)
                    found.merge()
            pairs = [(qid[i], n, x, s, leaf) for i, n, x, s in zip(*found.best, strict=True) for leaf in sorted(where[n])]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in map(np.array, zip(*pairs, strict=True))], ["query_id", "number", "vec_id", "score", "leaf"])

    read = spark.createDataFrame([(f,) for f in files], "file string").repartition(min(len(files), 4 * spark.sparkContext.defaultParallelism))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id", "number")  # a row is there once for each of its leaves
    truth = read.mapInArrow(tidy(exact), "query_id long, number long, vec_id long, score double, leaf long").withColumn("rank", F.dense_rank().over(w)).where(F.col("rank") <= k)
    held: dict[tuple[int, int], list[int]] = {}
    for r in truth.select("query_id", "number", "leaf").collect():
        held.setdefault((r.query_id, r.number), []).append(r.leaf)
    ranked = {i: (v[None, :], np.sort(leaves.bounds(v[None, :], leaves.some)[:, 0])) for i, v in zip(qid.tolist(), leaves.asking(q.astype(kind)), strict=True)}
    needed = np.sort([len(leaves.some) - np.searchsorted(ranked[i][1], leaves.bounds(ranked[i][0], np.array(at)).max(), "right") + 1 for (i, _), at in held.items()])
    share = float(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) / len(leaves.some) if len(needed) else 1.0

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_of = pa.Table.from_batches([b for b in batches if b.num_rows] or [], QUERIES[kind])
        for a in range(0, all_of.num_rows, most_queries):
            part = all_of.slice(a, most_queries).combine_chunks()
            found = Best(matrix(part.column("v").combine_chunks()), part.column("vec_id").to_numpy(), k, keep, kind)
            asking = leaves.asking(found.rough)
            cut = leaves.cuts(asking, share)
            todo, more = np.arange(len(cut)), False
            while len(todo):
                for at, chunks in _chunks(files, kind, dim):
                    bounds = leaves.bounds(asking if len(todo) == len(asking) else asking[todo], at)
                    meets = bounds < cut[todo] if more else bounds >= cut[todo]
                    for chunk, who in zip(chunks, meets, strict=True):
                        if (who := np.flatnonzero(who)).size:
                            found.meet(todo[who], *chunk)
                found.merge()
                todo, more = (found.short(), True) if not more else ([], True)  # who is short of rows meets the other leaves too
            i, _, x, s = found.best
            rank = np.arange(len(i)) - np.searchsorted(i, i) + 1
            yield pa.RecordBatch.from_arrays([pa.array(found.qid[i]), pa.array(rank.astype(np.int32)), pa.array(x), pa.array(s)], ["query_id", "rank", "vec_id", "score"])

    # Whole rounds of tasks, of blocks of equal size; a task reads all chunks, so blocks are as large as memory allows.
    cores = spark.sparkContext.defaultParallelism
    blocks = cores * math.ceil(n_queries / most_queries / cores)
    out = queries.repartition(blocks, "vec_id").mapInArrow(tidy(answer), "query_id long, rank int, vec_id long, score double")
    return _top(out.drop("rank"), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score") if repeats > 1 else out
