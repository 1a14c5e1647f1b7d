"""Approximate nearest neighbours by additive quantisation.

A vector is the sum of one codeword from each of `BOOKS` full-dimensional codebooks, fitted one after another to what
the earlier ones leave. Encoding is a beam search over partial sums. The index has a block of up to `VECTORS` different vectors' codes
and the norms of their sums, and no vector. A block of queries scores a block of codes from lookup tables of
the queries' products with all codewords: |sum|^2 - 2 <query, sum>. Each query keeps one shortlist, the `SHORT` different vectors
that score best in all the index, and these alone are fetched and ranked by exact distance in double precision.

Equal vectors are one entry of the index, which stands for the k + 1 of them with the smallest vec_id: no query's result can hold more of
them. So a vector that a third of the rows hold neither fills a block nor a shortlist.

Codebooks are fitted on a bounded sample of about `SAMPLE` different vectors; every vector is indexed. Query blocks meet index blocks in
`groups` of the index, so neither side is ever whole in one task; an index block's group is a hash of its number. No join here may be
broadcast: Spark judges a side by its compressed files and doesn't count that each group has all queries, so what it takes for small doesn't fit the driver.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do null ids. Distances are between vectors of one
length: each length has codebooks and blocks of its own. A row is never its own neighbour; another row with the same vec_id is a candidate
like any other, and a query row that comes twice has its result twice. Ties go to the smaller vec_id. Further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, materialize, mix64, partitions, release, thrifty

BOOKS, WORDS, BEAM = 32, 256, 4
SAMPLE, ROUNDS = 4096, 5
VECTORS, QUERIES = 8192, 512  # in a block
SHORT = 256


def extend(left: np.ndarray, codes: np.ndarray, book: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """What the `beam` best partial sums with one more codeword leave of each vector, best first, and their codes."""
    cost = (left**2).sum(axis=2)[:, :, None] - 2 * left @ book.T + (book**2).sum(axis=1)[None, None, :]
    flat = cost.reshape(len(left), -1)
    k = min(beam, flat.shape[1])
    best = np.argpartition(flat, k - 1, axis=1)[:, :k]
    best = np.take_along_axis(best, np.argsort(np.take_along_axis(flat, best, 1), axis=1, kind="stable"), 1)
    parent, word = best // len(book), best % len(book)
    left = np.take_along_axis(left, parent[:, :, None], 1) - book[word]
    return left, np.concatenate((np.take_along_axis(codes, parent[:, :, None], 1), word[:, :, None].astype(np.uint8)), axis=2)


@dataclass
class Quantizer:
    books: np.ndarray  # BOOKS x WORDS x dimensions

    def encode(self, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Codes of vectors, by a search that keeps the `beam` best partial sums."""
        left, codes = x[:, None, :].astype(np.float32), np.zeros((len(x), 1, 0), dtype=np.uint8)
        for book in self.books:
            left, codes = extend(left, codes, book, beam)
        return codes[:, 0, :]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(book[codes[:, m]] for m, book in enumerate(self.books))


def train(x: np.ndarray, books: int = BOOKS, words: int = WORDS, seed: int = 1) -> Quantizer:
    """Codebooks by k-means on what the beam search leaves with the earlier ones."""
    rng = np.random.default_rng(seed)
    left, codes, made = x[:, None, :].astype(np.float32), np.zeros((len(x), 1, 0), dtype=np.uint8), []
    for _ in range(books):
        rest, k = left[:, 0], min(words, len(x))
        book = rest[rng.choice(len(x), k, replace=False)].copy()
        for _ in range(ROUNDS):
            near = np.argmin((book**2).sum(axis=1)[None, :] - 2 * rest @ book.T, axis=1)
            order = np.argsort(near, kind="stable")
            got, at = np.unique(near[order], return_index=True)
            book[got] = np.add.reduceat(rest[order], at, axis=0) / np.bincount(near, minlength=k)[got][:, None]
        made.append(np.concatenate((book, np.zeros((words - k, x.shape[1]), np.float32))))
        left, codes = extend(left, codes, made[-1], BEAM)
    return Quantizer(np.array(made))


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part; a zero's sign doesn't tell vectors apart."""
    v = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null").where(fine)


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """(c, v, ids) of the different vectors: a hash for a number, and the k + 1 smallest ids, repeated rows' as often as they come."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))  # cut off where rows are read, so a frequent vector's rows don't meet
    return vectors.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def group_of(block: np.ndarray, groups: int) -> np.ndarray:
    """The groups that index blocks of these numbers go to."""
    return (mix64(np.asarray(block).astype(U64) + U64(0x9E3779B97F4A7C15)) % U64(groups)).astype(np.int32)


def build(found: DataFrame, quantizers: dict[int, Quantizer], groups: int) -> DataFrame:
    """Index blocks (d, g, block, least, codes, norms) of numbered different vectors (c, v, ids); least: their smallest vec_ids."""
    schema = "d int, g int, c binary, least binary, codes binary, norms binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 24, {}

        def flush(d: int) -> pa.RecordBatch:
            nonlocal block
            c, least, codes, norms = (np.concatenate(x) for x in zip(*held.pop(d), strict=True))
            block += 1
            g = int(group_of(np.array([block]), groups)[0])
            return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([g], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in (c, least, codes, norms))], ["d", "g", "c", "least", "codes", "norms"])

        for b in batches:
            c, least, size = (b.column(n).to_numpy() for n in ("c", "least", "d"))
            for d in np.unique(size).tolist():
                mine = np.flatnonzero(size == d)
                x = _matrix(b.column("v").take(pa.array(mine)), d)
                for at in range(0, len(mine), 1024):
                    codes = quantizers[d].encode(x[at : at + 1024])
                    norms = (quantizers[d].decode(codes).astype(np.float64) ** 2).sum(axis=1)
                    held.setdefault(d, []).append((c[mine[at : at + 1024]], least[mine[at : at + 1024]], codes, norms))
                    if sum(len(x[0]) for x in held[d]) >= VECTORS:
                        yield flush(d)
        for d in list(held):
            yield flush(d)

    return found.select("c", F.col("ids")[0].alias("least"), F.size("v").alias("d"), "v").mapInArrow(thrifty(run), schema)


def query_blocks(queries: DataFrame) -> DataFrame:
    """(d, block, q, x): up to QUERIES numbered queries (q, v) of one length in a block."""
    schema = "d int, block long, q binary, x binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 24, {}

        def flush(d: int) -> pa.RecordBatch:
            nonlocal block
            q, x = (np.concatenate(a) for a in zip(*held.pop(d), strict=True))
            block += 1
            return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([block], pa.int64()), pa.array([q.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], ["d", "block", "q", "x"])

        for b in batches:
            q, size = b.column("q").to_numpy(), b.column("d").to_numpy()
            for d in np.unique(size).tolist():
                mine = np.flatnonzero(size == d)
                x = _matrix(b.column("v").take(pa.array(mine)), d)
                for at in range(0, len(mine), QUERIES):
                    held.setdefault(d, []).append((q[mine[at : at + QUERIES]], x[at : at + QUERIES]))
                    if sum(len(y[0]) for y in held[d]) >= QUERIES:
                        yield flush(d)
        for d in list(held):
            yield flush(d)

    return queries.select("q", F.size("v").alias("d"), "v").mapInArrow(thrifty(run), schema)


def best(score: np.ndarray, least: np.ndarray, c: np.ndarray, short: int) -> np.ndarray:
    """Places of the `short` best scores of each row, ties to the smaller least id and number; all in a row of fewer."""
    if score.shape[1] <= short:
        return np.lexsort((np.broadcast_to(c, score.shape), np.broadcast_to(least, score.shape), score), axis=1)
    out = np.empty((len(score), short), np.int64)
    limit = np.partition(score, short - 1, axis=1)[:, short - 1]
    for r in range(len(score)):
        near = np.flatnonzero(score[r] <= limit[r])
        out[r] = near[np.lexsort((c[near], least[near], score[r][near]))[:short]]
    return out


def score_block(quantizer: Quantizer, x: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Scores of a block of codes (columns) for queries (rows), smaller being nearer."""
    tables = np.einsum("mwd,qd->mwq", quantizer.books, x.astype(np.float32), optimize=True)
    dots = np.zeros((len(codes), len(x)), dtype=np.float32)
    for m in range(len(tables)):
        dots += tables[m][codes[:, m]]
    return (norms[:, None] - 2.0 * dots).T.astype(np.float32)


def shortlists(index: DataFrame, blocks: DataFrame, quantizers: dict[int, Quantizer], groups: int, short: int = SHORT) -> DataFrame:
    """(q, c): each query's `short` best numbers in all the index."""
    held = index.sparkSession.sparkContext.broadcast(quantizers)  # a bounded table for each length
    spread = blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    met = index.repartition(groups, "g").hint("merge").join(spread.repartition(groups, "g").hint("merge"), ["g", "d"])
    schema = "block long, q binary, c binary, least binary, score binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A list for each pair of blocks."""
        for b in batches:
            for r in range(b.num_rows):
                get = lambda name, kind: np.frombuffer(b.column(name)[r].as_py(), dtype=kind)  # noqa: B023, E731
                d, c, least, q = b.column("d")[r].as_py(), get("c", np.int64), get("least", np.int64), get("q", np.int64)
                score = score_block(held.value[d], get("x", np.float64).reshape(-1, d), get("codes", np.uint8).reshape(len(c), -1), get("norms", np.float64))
                top = best(score, least, c, short)
                cols = [c[top], least[top], np.take_along_axis(score, top, 1)]
                yield pa.RecordBatch.from_arrays([b.column("block").slice(r, 1), pa.array([q.tobytes()], pa.binary()), *(pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in cols)], ["block", "q", "c", "least", "score"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One list for each query: those of its block's pairs come one after another and are merged two by two."""
        now, own = None, None

        def flush() -> pa.RecordBatch:
            q, c = own[0], own[1]
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(q, c.shape[1])), pa.array(c.ravel())], ["q", "c"])

        for b in batches:
            for r in range(b.num_rows):
                q = np.frombuffer(b.column("q")[r].as_py(), np.int64)
                c, least, score = (np.frombuffer(b.column(n)[r].as_py(), t).reshape(len(q), -1) for n, t in (("c", np.int64), ("least", np.int64), ("score", np.float32)))
                block = b.column("block")[r].as_py()
                if block != now:
                    if own is not None:
                        yield flush()
                    now, own = block, (q, c, least, score)
                    continue
                c, least, score = (np.concatenate(x, axis=1) for x in zip(own[1:], (c, least, score), strict=True))
                order = np.lexsort((c, least, score), axis=1)[:, :short]
                own = (q, *(np.take_along_axis(x, order, 1) for x in (c, least, score)))
        if own is not None:
            yield flush()

    lists = met.select("d", "c", "least", "codes", "norms", "block", "q", "x").mapInArrow(thrifty(run), schema)
    return lists.repartition(groups, "block").sortWithinPartitions("block").mapInArrow(thrifty(merge), "q long, c long")


def search(rows: DataFrame, chosen: Column, k: int = 10, short: int = SHORT) -> DataFrame:
    """Each chosen vector's k nearest of rows (vec_id, embedding): (query_id, rank, vec_id, score)."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = usable(rows)
    number = F.monotonically_increasing_id()
    found = materialize(classes(vectors, k).withColumn("c", number), "ann-vectors")
    queries = materialize(vectors.where(chosen).withColumn("q", number), "ann-queries")
    sizes = {r["d"]: r["n"] for r in found.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}  # a row for each length
    if not sizes:
        return empty
    quantizers = {}
    for d, n in sorted(sizes.items()):
        same = found.where(F.size("v") == d).select("v")
        drawn = same.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < min(1 << 30, (SAMPLE << 30) // n)).collect() or same.limit(SAMPLE).collect()
        quantizers[d] = train(np.array([r["v"] for r in drawn]))
    groups = partitions(spark)
    index = materialize(build(found, quantizers, groups), "ann-index")
    lists = materialize(shortlists(index, query_blocks(queries), quantizers, groups, short), "ann-lists")
    release(index)
    near = found.hint("merge").join(lists.hint("merge"), "c").select("q", "ids", F.col("v").alias("w")).hint("merge").join(queries.hint("merge"), "q")
    apart = F.sqrt(F.aggregate(F.zip_with("v", "w", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    # of the rows that equal the query's, one is its own
    others = F.when((F.col("v") == F.col("w")) & F.array_contains("ids", F.col("vec_id")), F.expr("filter(ids, (x, i) -> i != array_position(ids, vec_id) - 1)")).otherwise(F.col("ids"))
    pairs = near.withColumn("score", apart).select("q", F.col("vec_id").alias("query_id"), "score", F.explode(others).alias("vec_id"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
