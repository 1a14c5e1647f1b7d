"""Exact n-gram Jaccard join by a token-group matrix, and the components of its links.

A document's set holds the hashes of its distinct 5-word shingles (fewer words: the whole sequence as one). Documents with
equal sets are one class. Two classes link when 100 * intersection >= 80 * union.

1. *Prefixes.* Tokens have one global order: rare ones by hash, then the most frequent ones by count (a bounded table, which only
   shapes the order). Of a set of n, the first p = n - ceil(4n/5) + 1 + n // 10 are posted. Of two linked sets, let x's prefix end
   first: at most n // 5 of x's tokens are outside the other set and every common token of x's prefix is in the other's prefix, so they share
   at least p - n // 5 posted tokens. Tokens that one class alone has posted are dropped at once.
2. *Groups.* A class is compared with a leader: of the most central classes under its tokens (those that have most frequent tokens),
   that which it meets most often, if it meets it often enough. Verified links make components; a component joins the cluster of the
   other component that its classes' leaders meet most, linked or not. A cluster is cut into groups of bounded size.
3. *Matrix.* For each posted token the groups that have it: a class's count of posted tokens in a group's union bounds its
   overlap with every member. Either may have the prefix that ends first, so a group is opened only if that reaches p - n // 5 of the smallest
   size that can link with the class. Of two groups the one of the smaller cluster asks the other; a group asks itself unless
   its members are connected already.
4. *Opening.* The class's whole set is compared with the group's union of whole sets, then, by the members under each token, with all of
   them at once. Of the links only those are kept that connect something more.

Nothing is sampled and no candidate is dropped but by these bounds. 64-bit hashes stand for shingles and for sets.

Null and empty texts, and those of white space, have empty sets and link with nothing. A doc_id that repeats counts once, with
the largest set's size; its links are those of all its rows. Rows without a doc_id take no part. Further columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, attach_minimum, by_shard, chunks, collect_garbage, components, materialize, mix64, multipliers, pack, partitions, release, thrifty, unpack, utf8, word_hashes

WORDS = 5
AT_ONCE = 2 << 20
HEAVY, HEAVY_LOCAL = 300_000, 2  # size of the table of frequent tokens; documents of a chunk that make a token a candidate for it
GROUP = 1 << 17  # shingles of a group's chunk


def shingles(texts: list[bytes], width: int = WORDS) -> list[np.ndarray]:
    """Each text's set, as a sorted array of distinct hashes."""
    words, first = word_hashes(texts)
    c = multipliers(width, 23)
    n = max(0, len(words) - width + 1)
    rolled = np.zeros(n, U64)
    for k in range(width):
        rolled += words[k : k + n] * c[k]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            s = np.sort(rolled[a : b - width + 1])
            if len(s) > 1:
                s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            s = mix64(np.array([(words[a:b] * c[: b - a]).sum(dtype=U64) ^ U64((b - a) * 0x9E37)], U64))
        else:
            s = np.empty(0, U64)
        out.append(s)
    return out


def identity(s: np.ndarray) -> int:
    """A set's 64-bit hash, as a signed long."""
    x = mix64(mix64(s).sum(dtype=U64, keepdims=True) ^ U64(len(s)))
    return int(x.view(np.int64)[0])


def prefix_size(n):
    return n - (4 * n + 4) // 5 + 1 + n // 10


def need(n):
    """Posted tokens that a set of n shares at least with a linked one whose prefix doesn't end before its own."""
    return prefix_size(n) - n // 5


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    if 5 * min(len(x), len(y)) < 4 * max(len(x), len(y)):
        return False
    both = overlap(x, y)
    return both > 0 and 100 * both >= 80 * (len(x) + len(y) - both)


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int(np.count_nonzero(y[at] == x))


def _each(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], int, int]]:
    for b in batches:
        texts = utf8(b.column(column))
        for i, j in chunks(map(len, texts), AT_ONCE):
            yield b, shingles(texts[i:j]), i, j


def measure(docs: DataFrame) -> DataFrame:
    """(kind, key, n, fp): for kind 0 a document, its set's size and hash; for kind 1 a token with the documents that have it, where a chunk has many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, sets, i, j in _each(batches, 1):
            n = np.array([len(s) for s in sets], np.int64)
            fp = np.array([identity(s) for s in sets], np.int64)
            yield _long(kind=np.zeros(j - i, np.int64), key=b.column(0)[i:j].to_numpy(), n=n, fp=fp)
            tokens, df = np.unique(np.concatenate(list({int(f): s for f, s in zip(fp, sets, strict=True)}.values())), return_counts=True)
            many = df >= HEAVY_LOCAL
            if many.any():
                yield _long(kind=np.ones(int(many.sum()), np.int64), key=tokens[many].view(np.int64), n=df[many].astype(np.int64), fp=np.zeros(int(many.sum()), np.int64))

    return docs.mapInArrow(thrifty(run), "kind long, key long, n long, fp long")


def _long(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in columns.values()], list(columns))


def prefix(s: np.ndarray, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The posted tokens of a set, given the sorted frequent tokens and their places in the order of counts."""
    p = prefix_size(len(s))
    if not len(heavy):
        return s[:p]
    at = np.searchsorted(heavy, s)
    at[at == len(heavy)] = 0
    common = heavy[at] == s
    light = s[~common]
    if len(light) >= p:
        return light[:p]
    rest = s[common]
    return np.concatenate((light, rest[np.argsort(rank[at[common]], kind="stable")][: p - len(light)]))


def centrality(s: np.ndarray, heavy: np.ndarray, weight: np.ndarray) -> int:
    """How much of a set is frequent, from 0 to 65535: of a group of near copies, the text that all derive from has the most.

    It chooses leaders only, so it may be coarse.
    """
    if not len(heavy):
        return 0
    at = np.searchsorted(heavy, s)
    at[at == len(heavy)] = 0
    return int(weight[at[heavy[at] == s]].sum() / len(s) * 2000)


def post(docs: DataFrame, heavy: np.ndarray, rank: np.ndarray, weight: np.ndarray, shards: int) -> DataFrame:
    """(shard, block): posted tokens with their sets' hashes and centralities, packed by a hash of the token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        tokens, owners, central, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            t, o, c = np.concatenate(tokens), np.concatenate(owners), np.concatenate(central)
            rows = [(k, pack([t[ix], o[ix], c[ix]])) for k, ix in by_shard(t, shards)]
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["shard", "block"])

        for _, sets, _, _ in _each(batches):
            for s in sets:
                if not len(s) or (f := identity(s)) in seen:
                    continue
                seen.add(f)
                t = prefix(s, heavy, rank)
                tokens.append(t)
                owners.append(np.full(len(t), f, np.int64))
                central.append(np.full(len(t), centrality(s, heavy, weight), np.uint16))
                held += len(t)
            if held >= 2_000_000:
                yield flush()
                tokens, owners, central, held = [], [], [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(thrifty(run), "shard int, block binary")


def shared(posted: DataFrame) -> DataFrame:
    """Of each shard: (kind 0, fp, n: its posted tokens that another class has too), (kind 1, a: leader, b: class, n: tokens under which they
    meet), (kind 2, block of shared tokens and their classes)."""
    schema = "kind long, a long, b long, n long, block binary"

    def finish(blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        t, f, c = (np.concatenate(x) for x in zip(*(unpack(x, ["u8", "i8", "u2"]) for x in blocks), strict=True))
        order = np.lexsort((f, 65535 - c, t))  # the most central first: it leads
        t, f = t[order], f[order]
        new = np.concatenate(([True], (t[1:] != t[:-1]) | (f[1:] != f[:-1])))
        t, f = t[new], f[new]
        starts = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        sizes = np.diff(np.append(starts, len(t)))
        many = np.repeat(sizes > 1, sizes)
        if not many.any():
            return
        leader = np.repeat(f[starts], sizes)[many]
        t, f = t[many], f[many]
        who, n = np.unique(f, return_counts=True)
        yield rows(0, who, who, n)
        pair = np.unique(np.stack((leader, f), axis=1)[leader != f], axis=0, return_counts=True)
        yield rows(1, pair[0][:, 0], pair[0][:, 1], pair[1])
        yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in (2, 0, 0, len(t))), pa.array([pack([t, f])], pa.binary())], ["kind", "a", "b", "n", "block"])

    def rows(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind), pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n.astype(np.int64)), pa.nulls(len(a), pa.binary())], ["kind", "a", "b", "n", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks = None, []
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != now and blocks:
                    yield from finish(blocks)
                    blocks = []
                now = k
                blocks.append(x)
        if blocks:
            yield from finish(blocks)

    return posted.repartition(partitions(posted.sparkSession), "shard").sortWithinPartitions("shard").mapInArrow(thrifty(run), schema)


def links_with(docs: DataFrame, classes: DataFrame, asked: DataFrame, members: DataFrame, each: int) -> DataFrame:
    """Links (a, b) that connect each asked (q, g)'s class q with all members of group g that it links with; members: (g, fp).

    Links that connect nothing more in one place are left out, so their number keeps to that of questions and members.

    The sets are made where a class's text is, and go to their groups once. A group with more than `each` questions is
    copied, so that none is asked more often than that in one place.
    """
    parts = asked.groupBy("g").agg(F.ceil(F.count("*") / each).alias("parts"))
    inside = members.join(parts, "g").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    outside = asked.join(parts, "g").select("g", F.col("q").alias("fp"), F.pmod(F.xxhash64("q"), F.col("parts")).alias("part"))
    role = lambda df, k: df.select("fp", F.struct(F.xxhash64("g", "part").alias("key"), F.lit(k).alias("role")).alias("role"))
    roles = role(inside, 0).union(role(outside, 1)).groupBy("fp").agg(F.collect_list("role").alias("roles")).join(classes.select("fp", "doc_id"), "fp")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, sets, i, j in _each(batches, 0):
            rows: list[list] = [[], [], [], []]
            for s, fp, roles in zip(sets, b.column(1)[i:j].to_pylist(), b.column(2)[i:j].to_pylist(), strict=True):
                if identity(s) == fp:  # else another text of that doc_id
                    raw = s.tobytes()
                    for r in roles:
                        for c, x in zip(rows, (r["key"], r["role"], fp, raw), strict=True):
                            c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["key", "role", "fp", "tokens"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []
        matrix: tuple | None = None
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        for b in batches:
            out: list[list] = [[], []]
            for k, r, f, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != now:
                    now, group, matrix, parent = k, [], None, {}
                x = np.frombuffer(x, U64)
                if r == 0:
                    group.append((f, x))
                    continue
                if not group:
                    continue
                if matrix is None:  # the union's tokens, each with the members that have it
                    sizes = np.array([len(m) for _, m in group], np.int64)
                    tokens, owner = np.concatenate([m for _, m in group]), np.repeat(np.arange(len(group)), sizes)
                    order = np.argsort(tokens, kind="stable")
                    matrix = tokens[order], owner[order], sizes, [m for m, _ in group]
                tokens, owner, sizes, names = matrix
                lo = np.searchsorted(tokens, x, "left")
                m = np.searchsorted(tokens, x, "right") - lo
                if 5 * np.count_nonzero(m) < 4 * len(x):
                    continue
                to = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m - lo, m)
                both = np.bincount(owner[to], minlength=len(sizes))
                for i in np.flatnonzero((both > 0) & (100 * both >= 80 * (len(x) + sizes - both))).tolist():
                    if (u := root(f)) != (v := root(names[i])):
                        parent[u] = v
                        out[0].append(f)
                        out[1].append(names[i])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b"])

    sets = docs.join(roles, "doc_id").select("text", "fp", "roles").mapInArrow(thrifty(make), "key long, role int, fp long, tokens binary")
    return sets.repartition(partitions(docs.sparkSession), "key").sortWithinPartitions("key", "role").mapInArrow(thrifty(verify), "a long, b long")


def meetings(blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """(q, g): classes and groups, their own and those of larger clusters (of equal ones, later ones), whose posted tokens they share at least `need` of.

    groups: (fp, component, classes, g, pure, need): the number of classes of its cluster; pure, the component of all members of g, if
    they have one; need null for a class that shares too few posted tokens with all others together.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                t, f = unpack(x, ["u8", "i8"])
                yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(f)], ["t", "fp"])

    def finish(t: np.ndarray, f: np.ndarray, c: np.ndarray, z: np.ndarray, g: np.ndarray, p: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((g, z, t))
        t, f, c, g, p, n = (a[order] for a in (t, f, c, g, p, n))
        token = np.concatenate(([True], t[1:] != t[:-1]))
        group = token | np.concatenate(([True], g[1:] != g[:-1]))
        at, groups, whole = np.cumsum(group), g[group], p[group]
        after, end = at - 1, at[np.append(np.flatnonzero(token)[1:], len(at)) - 1][np.cumsum(token) - 1]  # its own group, its token's last one
        after = after + (p == c)
        asks = np.flatnonzero((n >= 0) & (end > after))
        for i, j in chunks((end - after)[asks].tolist(), 1_000_000):
            k = asks[i:j]
            m = end[k] - after[k]
            to = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m - after[k], m)
            q, own = np.repeat(f[k], m), np.repeat(c[k], m)
            apart = whole[to] != own
            pair, met = np.unique(np.stack((q[apart], groups[to][apart]), axis=1), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(met.astype(np.int64))], ["q", "g", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for b in batches:
            rows = [np.asarray(x.fill_null(-1).to_numpy(zero_copy_only=False), np.int64) for x in b.columns]
            if not len(rows[0]):
                continue
            held.append(rows)
            if sum(len(x[0]) for x in held) >= 500_000 and held[0][0][0] != rows[0][-1]:
                rows = [np.concatenate(x) for x in zip(*held, strict=True)]
                cut = int(np.flatnonzero(rows[0] != rows[0][-1])[-1]) + 1  # the last token may go on
                yield from finish(*(x[:cut] for x in rows))
                held = [[x[cut:] for x in rows]]
        if held:
            yield from finish(*(np.concatenate(x) for x in zip(*held, strict=True)))

    known = blocks.select("block").mapInArrow(thrifty(rows), "t long, fp long").join(groups, "fp").select("t", "fp", "component", "classes", "g", "pure", "need")
    dealt = known.repartition(partitions(blocks.sparkSession), "t").sortWithinPartitions("t")
    met = dealt.mapInArrow(thrifty(run), "q long, g long, n long").groupBy("q", "g").agg(F.sum("n").alias("n"))
    return met.join(groups.select(F.col("fp").alias("q"), "need"), "q").where("n >= need").select("q", "g")


def link_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of docs (doc_id, text)."""
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    first = materialize(measure(docs), "jaccard-sets")
    each = first.where("kind = 0").select(F.col("key").alias("doc_id"), "n", "fp")
    classes = each.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    top = first.where("kind = 1").groupBy("key").agg(F.sum("n").alias("df")).orderBy(F.desc("df"), "key").limit(HEAVY).collect()
    heavy = np.array([r["key"] for r in top], np.int64).view(U64)
    order = np.argsort(heavy)
    df = np.array([r["df"] for r in top], np.int64)[order]
    heavy, rank, weight = heavy[order], np.argsort(np.argsort(df, kind="stable"), kind="stable"), np.minimum(np.log2(df), 32)

    found = materialize(shared(post(docs, heavy, rank, weight, 4 * partitions(spark))), "jaccard-shared")
    collect_garbage(spark)
    meet = found.where("kind = 0").groupBy(F.col("a").alias("fp")).agg(F.sum("n").alias("met"))
    wanted = materialize(meet.join(classes, "fp").select("fp", "doc_id", "n", "met"), "jaccard-classes")
    n = F.col("n")
    least = F.expr("(4 * n + 4) div 5 div 10 + 1")  # need() of the smallest set that can link with one of n
    # the leader that a class meets most often; few meetings promise no link, and what links all the same is found below
    pairs = found.where("kind = 1").groupBy("a", "b").agg(F.sum("n").alias("n")).groupBy("b").agg(F.max(F.struct("n", "a")).alias("x"))
    pairs = pairs.join(wanted.select(F.col("fp").alias("b"), least.alias("need")), "b").where("2 * x.n >= need").select(F.col("b").alias("q"), F.col("x.a").alias("g"), F.col("x.n").alias("n"))
    pairs = materialize(pairs, "jaccard-leaders")
    links = materialize(links_with(docs, wanted, pairs, pairs.select("g", F.col("g").alias("fp")).distinct(), 1024), "jaccard-links")
    collect_garbage(spark)
    near = components(links, "jaccard-components")

    named = wanted.join(near.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = materialize(named, "jaccard-named")
    where = named.select("fp", "component")
    toward = attach_minimum(pairs.select("q", "n", F.col("g").alias("fp")), where, ["fp"], "q").select("q", "n", F.col("component").alias("other"))
    toward = toward.join(where.withColumnRenamed("fp", "q"), "q").where("component <> other").groupBy("component").agg(F.max(F.struct("n", "other")).alias("x"))
    named = named.join(toward.select("component", F.col("x.other").alias("other")), "component", "left").withColumn("cluster", F.coalesce("other", "component"))
    sizes = named.groupBy("cluster").agg(F.sum("n").alias("total"), F.count("*").alias("classes"))
    groups = attach_minimum(named, sizes, ["cluster"], "fp").select(
        "fp", "component", "classes",
        F.xxhash64("cluster", F.pmod(F.xxhash64("fp"), F.ceil(F.col("total") / GROUP))).alias("g"),
        F.when(F.col("met") >= least, least).alias("need"),
    )
    groups = materialize(groups, "jaccard-dealt")
    whole_groups = groups.groupBy("g").agg(F.min("component").alias("pure"), F.max("component").alias("last")).select("g", F.expr("if(pure = last, pure, null)").alias("pure"))
    groups = attach_minimum(groups, whole_groups, ["g"], "fp")
    groups = materialize(groups, "jaccard-groups")
    met = materialize(meetings(found.where("kind = 2"), groups), "jaccard-met")
    members = groups.select("g", "fp").join(met.select("g").distinct(), "g", "left_semi")
    more = materialize(links_with(docs, wanted, met, members, 1024), "jaccard-more")
    collect_garbage(spark)
    whole = components(links.union(more), "jaccard-whole")

    # classes to documents: the smallest doc_id of each component, then each document's smallest over its rows
    label = each.join(whole.withColumnRenamed("node", "fp"), "fp", "left").select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("component", "fp")).alias("c"))
    least_id = label.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("least"))
    out = label.join(least_id, "c", "left").select("doc_id", "n", F.coalesce("least", "doc_id").alias("least"))
    release(found)
    return out.groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.min("least").alias("component_id"))
