"""What the operators share: scratch tables in the folder that all executors see, and byte-exact word splitting."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_own: dict[str, str] = {}


def scratch_base(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only where that is unset on one machine (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        base = _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="rillscore-"))
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{scratch_base(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str, temporary: list[str] | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors, computes once.

    The path is added to `temporary`, if given, for the caller to drop when nothing reads the table any more.
    """
    path = scratch_path(df.sparkSession, name)
    if temporary is not None:
        temporary.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Spark's own file system layer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, as UTF-8: bytes.lower and bytes.split do exactly that."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def bounded_sample(df: DataFrame, key: str, most: int, *columns: str, groups: tuple[str, dict] | None = None) -> list:
    """About `most` rows, at most, with the smallest hashes of the key and the columns, in that order: reruns agree.

    The hash's cut is set from the count, so that tasks send what is kept and not their own best `most` rows each. Equal
    rows count once. groups = (column, rows of each value): each of these values gets an equal part of `most`, or all its
    rows. What comes back is bounded in rows; callers bound the columns.
    """
    h = F.xxhash64(key, *columns)
    rows = df.select(*columns, h.alias("_h"))
    if groups:
        each = max(1, most // max(1, len(groups[1])))
        cut = F.coalesce(*[F.when(F.col(groups[0]) == g, F.lit(hash_cut(each, n))) for g, n in groups[1].items()], F.lit(-(2**63)))
    else:
        cut = F.lit(hash_cut(most, df.count()))
    some = rows.where(F.col("_h") <= cut).dropDuplicates(["_h"]).limit(2 * most + 100 * (1 + len(groups[1]) if groups else 1)).collect()
    some.sort(key=lambda r: r["_h"])
    if not groups:
        return some[:most]
    left = dict.fromkeys(groups[1], each)
    out = []
    for r in some:
        if left[r[groups[0]]] > 0:
            left[r[groups[0]]] -= 1
            out.append(r)
    return out


def hash_cut(most: int, n: int) -> int:
    """Hashes up to this one are those of most * 1.3 + 30 of n rows, about."""
    share = min(1.0, (1.3 * most + 30) / max(1, n))
    return int(min(2**63 - 1, -(2**63) + share * 2**64))


def tidy(fn: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of a mapInArrow, with freed memory given back at the end of a task: workers live on for other tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release()

    return run


def release() -> None:
    """Give freed memory back to the system: what a fit or a task needed for a moment would else count until the process ends."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def per_text(df: DataFrame, text_col: str, carry: list[str], fields: str, fn: Callable[[list[str | None]], list[pa.Array]]) -> DataFrame:
    """The columns `carry` of df and new ones that fn makes of the texts, in one narrow pass; a carried column may not have a new one's name."""
    if clash := {c.lower() for c in carry} & {f.split()[0] for f in fields.split(", ")}:
        raise ValueError(f"columns {sorted(clash)} can't be carried: the result has columns of these names")
    src = df.select(*carry) if text_col in carry else df.select(*carry, text_col)
    at, n = src.columns.index(text_col), len(carry)
    schema = StructType([*src.schema.fields[:n], *StructType.fromDDL(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, text_col):
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *fn(b.column(at).to_pylist())], schema.names)

    return src.mapInArrow(tidy(run), schema)


class WordHashes(dict):
    """64-bit hashes of words, kept while there are at most `most` of them."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The finalizer of splitmix64 over uint64."""
    x = (x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of a word-hash sequence, in order; fewer words make one shingle, none make none."""
    if len(h) == 0:
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out + h[j : j + n]) * np.uint64(0x9FB21C651E98DF25) + np.uint64(j + 1)
        out ^= out >> np.uint64(29)
    return mix(out, k)


def chunks(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about `most` bytes of text (one very long text stands alone)."""
    for b in batches:
        lengths = np.array(pc.binary_length(b.column(text).cast(pa.large_string())).fill_null(0), np.int64)
        part = np.cumsum(lengths) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(lengths)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if z > a:
                yield b.slice(a, z - a)
