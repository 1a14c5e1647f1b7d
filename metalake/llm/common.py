"""Helpers shared by the training-data operators: shared storage, materialising, hashing, salted joins, components."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
M_MMAP_THRESHOLD, M_TRIM_THRESHOLD = -3, -1  # of mallopt


# ---------------------------------------------------------------- storage
def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, one of this process's own if the executors are in it, else an error."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _own_dir()


@functools.cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="metalake-")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and returns a reader of it: lineage is cut and lost executors cost no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Deletes the files behind a materialised frame that nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        jvm = spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if folder.toString().split(":", 1)[-1].startswith(shared_dir(spark).split(":", 1)[-1]):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def collect_garbage(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of finished steps."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, in a worker that keeps no freed memory: workers live on between tasks, beside the executor's heap."""

    def kept_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        libc = ctypes.CDLL(None)
        if hasattr(libc, "mallopt"):
            libc.mallopt(M_MMAP_THRESHOLD, 8 << 20)
            libc.mallopt(M_TRIM_THRESHOLD, 64 << 20)  # else the heap's top goes and comes with each array
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return kept_small


def open_fs(uri: str):
    """(pyarrow file system, path) of a shared URI; works on executors without a JVM."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as make it none of df's columns."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n += "_"
        out.append(n)
        have.add(n.lower())
    return out


def set_aside(df: DataFrame, *used: str) -> DataFrame:
    """df with its columns but the used ones renamed by their place, so that none is named like one that an operator makes."""
    return df.toDF(*[n if n in used else f"own{i}__" for i, n in enumerate(df.columns)])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- hashing
def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs, equal outputs; any bit changes about half of the output's."""
    x = np.array(x, dtype=U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers, each a function of its position and the seed alone."""
    step = np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)
    return mix64(step) | U64(1)


SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(texts: list[bytes], seed: int = 7, breaks: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of the texts, with A-Z lower-cased, and each text's first word (one more at the end).

    breaks: for each byte, whether it separates words; blanks must.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    solid = ~breaks[data]
    before = np.empty_like(solid)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & ~before)
    if not len(starts):
        return np.empty(0, U64), np.zeros(len(texts) + 1, np.int64)
    stops = np.flatnonzero(~solid & before)
    lens = stops - starts
    offs = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=offs[1:])
    at = np.arange(int(offs[-1] + lens[-1]), dtype=np.int64) - np.repeat(offs, lens)
    vals = (_LOWER[data[solid]].astype(U64) + U64(1)) * multipliers(int(lens.max()), seed)[at]
    words = mix64(np.add.reduceat(vals, offs) + lens.astype(U64))
    first = np.searchsorted(starts, np.concatenate(([0], ends)))
    return words, first


def chunks(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about limit in all; a larger item stands alone."""
    start, total, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if i >= start:
        yield start, i + 1


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The column's texts as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


# ---------------------------------------------------------------- packed shuffles
def pack(arrays: list[np.ndarray]) -> bytes:
    """Equally long arrays in one compressed block; see unpack."""
    import zstandard

    raw = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(arrays[0]).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(block: bytes, dtypes: list[str]) -> list[np.ndarray]:
    import zstandard

    n = int.from_bytes(block[:8], "little")
    raw = zstandard.ZstdDecompressor().decompress(block[8:], max_output_size=1 << 40) if n else b""
    out, at = [], 0
    for d in map(np.dtype, dtypes):
        out.append(np.frombuffer(raw, dtype=d, count=n, offset=at))
        at += n * d.itemsize
    return out


def by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, indices) of each shard that has keys; the shard is a hash of the key."""
    if not len(keys):
        return
    shard = (mix64(keys ^ U64(0x5DEECE66D)) % U64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    edges = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for i, j in zip(edges, np.append(edges[1:], len(order)), strict=True):
        yield int(shard[order[i]]), order[i:j]


# ---------------------------------------------------------------- salted joins
def attach_minimum(df: DataFrame, small: DataFrame, keys: list[str], spread: str, salts: int = 16) -> DataFrame:
    """df left-joined with small (one row for each key), the rows of a hot key dealt over `salts` tasks by the column `spread`."""
    salt = unused(df.select(*df.columns, *[F.lit(0).alias(c) for c in small.columns if c not in df.columns]), "_salt")[0]
    left = df.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts).cast("long")))
    right = small.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right, [*keys, salt], "left").drop(salt)


# ---------------------------------------------------------------- components
def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of links (a, b): component is the smallest node reachable.

    Each round sends every node's label to its neighbours and then to whatever pointed at the old label, so labels
    spread at doubling distance; a round costs a join and a sum-like aggregation and is written to the shared folder.
    Null ends are ignored; an empty table gives an empty result.
    """
    links = links.where("a is not null and b is not null")
    both = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), name)
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), name)
    while True:
        told = both.join(labels.select(F.col("node").alias("a"), "label"), "a").select(F.col("b").alias("node"), "label")
        spread = labels.union(told).groupBy("node").agg(F.min("label").alias("label"))
        jump = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        new = spread.join(jump, spread.label == jump._n, "left").select("node", F.least("label", F.coalesce("_l", "label")).alias("label"))
        new = materialize(new, name)
        changed = new.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").limit(1).count()
        release(labels)
        labels = new
        if not changed:
            release(both)
            return labels.select("node", F.col("label").alias("component"))
