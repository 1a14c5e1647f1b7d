"""Suffix-array dedup: bytes covered by a 100-byte string that also starts earlier go, by a logarithmic family of suffix arrays.

*Anchors.* Every 100-byte window has one anchor, the 24-byte gram in it with the least hash (the first of equals), so equal
windows have equal anchors. Neighbouring windows with one anchor form a run. Runs are dealt by a hash of their anchor's gram. A gram with one
run can't match; all other runs go with their bytes to the suffix arrays of their gram's shard. Hashes only deal and leave out: what
goes is what a suffix array has found equal byte by byte.

*Suffix arrays.* In each shard runs come in batches. A batch's suffixes (all windows of its runs) are sorted by their first 100 bytes, the
depth at which matches count; the sorted batch is merge-scanned against each level for equal strings; those that are new make a level of
their own, and levels of equal size merge, so n batches leave about log2(n) levels. A level is text, positions in it and the
earliest place of each string; of a string's other places it keeps nothing, so what a shard holds grows with its different strings alone. Batches may come in any order:
where an earlier place turns up, the one it displaces goes.

*Many copies.* Runs that a task meets again in the same few MB go through suffix arrays there, and only the first is dealt, so a string is dealt once for each
`FLUSH` bytes at most.

*Hot grams.* The runs of a gram that has many different ones (a frequent line with other text around it) aren't gathered: each of
their windows goes with its bytes to the suffix arrays of a shard dealt by the window's hash.

Strings are judged on the input; overlaps count; matches never cross documents. The earlier of two places is that with the
smaller doc_id, then start.

Null texts are empty. Texts under 100 bytes stay. Rows without a doc_id take no part and stay whole. A doc_id names one document: rows that
repeat it with the same text get the same result, since neither starts earlier; should their texts differ, what is found in any of them is
removed from all. Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, by_shard, chunks, collect_garbage, materialize, mix64, multipliers, pack, partitions, thrifty, unpack, unused, utf8

DEPTH, GRAM = 100, 24
AT_ONCE = 1 << 17  # bytes hashed at once, so few that their hashes stay in the processor's cache
HOT_CHUNK, HOT = 64, 1024  # different runs under a gram, in a chunk or in all, from which its windows are dealt one by one
FLUSH = 4 << 20  # bytes of text whose runs are combined before they are dealt
SHARD_TEXT = 2 << 20  # bytes of text for which there is a shard
BATCH = 1 << 16  # suffixes of a batch; their strings stay under the size from which arrays are mapped anew each time
SPARE = 8  # bytes of text a suffix that a level keeps unlooked at
SCAN = 1 << 14  # suffixes of a level that are read at once
C = multipliers(16, 41)


def _double(h: np.ndarray, by: int, k: int) -> np.ndarray:
    """Hashes of strings longer by `by`, from those of their starts and of what begins `by` further on."""
    x = h[:-by] * C[k] + (h[by:] ^ (h[by:] >> U64(29))) * C[k + 1]
    return x ^ (x >> U64(32))


def window_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the 24-byte and of the 100-byte strings at each place that has one."""
    h = (data.astype(U64) + U64(1)) * C[0]
    h = h ^ (h >> U64(31))
    for k, by in enumerate((1, 2, 4)):
        h = _double(h, by, k)  # 2, 4, 8 bytes
    h16 = _double(h, 8, 3)
    h24 = h16[:-8] * C[5] + (h[16:] ^ (h[16:] >> U64(29))) * C[6]
    gram = mix64(h24)
    h32 = _double(h16, 16, 7)
    h64 = _double(h32, 32, 8)
    h100 = h64[: len(data) - 99] * C[10] + (h64[36:] ^ (h64[36:] >> U64(29))) * C[11]
    return gram, mix64(h100)


def runs(texts: list[bytes]) -> dict[str, np.ndarray] | None:
    """The runs of the texts: text index, gram hash, anchor, first and last window start (in the text), a hash of the run's bytes.

    Also `base` (each text's start) and `data` (the joined texts).
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.concatenate(([0], np.cumsum(sizes)))
    n = int(base[-1])
    if n < DEPTH:
        return None
    data = np.frombuffer(b"".join(texts), np.uint8)
    gram, window = window_hashes(data)
    last = n - DEPTH
    text = np.repeat(np.arange(len(texts)), sizes)[: last + 1]
    fits = np.arange(DEPTH, last + DEPTH + 1) <= np.repeat(base[1:], sizes)[: last + 1]
    grams, step = DEPTH - GRAM + 1, 1 << 20
    place = np.arange(min(len(gram), step + grams), dtype=U64)
    out: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, last + 1, step):  # positions within a step, and the windows that reach on, have 21 bits
        stop = min(last + 1, at + step)
        key = (gram[at : stop + grams - 1] & ~U64((1 << 21) - 1)) | place[: stop + grams - 1 - at]
        low, size = key, 1
        while size * 2 <= grams:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < grams:
            low = np.minimum(low[: len(key) - grams + 1], low[grams - size : len(key) - size + 1])
        anchor = (low[: stop - at] & U64((1 << 21) - 1)).astype(np.int64) + at
        ok = fits[at:stop]
        t = text[at:stop]
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (t[1:] != t[:-1]) | (ok[1:] != ok[:-1])))
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(new))
        good = ok[begin]
        out[0].append(anchor[begin[good]])
        out[1].append(begin[good] + at)
        out[2].append(end[good] - 1 + at)
    anchor, first, final = (np.concatenate(x) for x in out)
    if not len(anchor):
        return None
    doc = text[first]
    # a run's bytes are those of its first and last windows, between which no byte lies (a run has at most 77 windows)
    shape = ((anchor - first) * 128 + (final - first)).astype(U64)
    same = mix64(window[first] * C[12] + (window[final] ^ (window[final] >> U64(31))) * C[13] + shape)
    return {"doc": doc, "gram": gram[anchor], "anchor": anchor - base[doc], "first": first - base[doc], "last": final - base[doc], "same": same, "base": base, "data": data}


STEP = "kind int, shard int, doc long, gram long, first int, info int, block binary"


def _batch(kind: int, n: int, **columns) -> pa.RecordBatch:
    kinds = {"shard": pa.int32(), "doc": pa.int64(), "gram": pa.int64(), "first": pa.int32(), "info": pa.int32(), "block": pa.binary()}
    arrays = [pa.array(np.full(n, kind, np.int32))] + [pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, ["kind", *kinds])


RUNS, SPANS, DIFFER, TEXTS = range(4)
_RUN = ["u8", "u8", "i8", "i4", "u2"]  # gram, hash of the run, document, first (-1: the gram is hot), (anchor - first) * 128 + last - first
HOT_BIT = 14  # of a DIFFER row's info: the gram is hot


def _by_place(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The order by document and start, by one number for both where 63 bits hold them."""
    if not len(doc):
        return np.empty(0, np.int64)
    low, bits = int(doc.min()), int(start.max()).bit_length()
    if (int(doc.max()) - low).bit_length() + bits > 63:
        return np.lexsort((start, doc))
    return np.argsort(((doc - low) << bits) | start)


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Span rows, those of a document that touch made one."""
    if not len(doc):
        return
    order = _by_place(doc, start)
    doc, start, end = doc[order], start[order].astype(np.int64), end[order].astype(np.int64)
    # ends made to rise over documents, so that one running maximum serves all
    group = np.cumsum(np.concatenate(([0], (doc[1:] != doc[:-1]).astype(np.int64))))
    lift = group * (int(end.max()) + 1)
    top = np.maximum.accumulate(end + lift)
    new = np.concatenate(([True], (start + lift)[1:] > top[:-1]))
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    yield _batch(SPANS, len(at), doc=doc[at], first=start[at].astype(np.int32), info=(top[last] - lift[last]).astype(np.int32), shard=(doc[at] % 1009).astype(np.int32))


# ---------------------------------------------------------------- suffix arrays
def _strings(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first DEPTH bytes of the suffixes of data at these places."""
    if not len(at):
        return np.empty(0, f"S{DEPTH}")
    return np.ndarray(len(data) - DEPTH + 1, f"S{DEPTH}", np.ascontiguousarray(data), strides=(1,))[at]  # overlapping items, each copied at once


def _sorted(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, strings) of the suffixes of data at these places by their first DEPTH bytes, equal ones as they come.

    Numbers made of the first bytes and the item's number are sorted first, which is quick; what the byte sort then finds is nearly in order.
    """
    low = U64((1 << len(at).bit_length()) - 1)
    head = np.ndarray(len(data) - 7, ">u8", np.ascontiguousarray(data), strides=(1,))[at].astype(U64)
    near = (np.sort((head & ~low) | np.arange(len(at), dtype=U64)) & low).astype(np.int64)
    strings = _strings(data, at[near])
    array = np.argsort(strings, kind="stable")
    return near[array], strings[array]


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which strings of a and b are equal, by four bytes at once."""
    a, b = (np.ascontiguousarray(x).view(np.uint32).reshape(-1, DEPTH // 4) for x in (a, b))
    return ~(a != b).any(1)


def _earlier(doc: np.ndarray, start: np.ndarray, than_doc: np.ndarray, than_start: np.ndarray) -> np.ndarray:
    return (doc < than_doc) | ((doc == than_doc) & (start < than_start))


class Level:
    """A suffix array of different strings: text, places in it in the order of their strings, and each string's earliest document and start."""

    def __init__(self, data: np.ndarray, at: np.ndarray, doc: np.ndarray, start: np.ndarray):
        self.data, self.at, self.doc, self.start = data, at, doc, start

    def scan(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where each of the sorted strings stands or would stand, whether it is there), by a merge scan: both sides are read in order, and each once."""
        spot, hit = np.zeros(len(strings), np.int64), np.zeros(len(strings), bool)
        heads = _strings(self.data, self.at[::SCAN])
        edges = np.append(np.searchsorted(strings, heads), len(strings))
        for c, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
            if i < j:
                mine = _strings(self.data, self.at[c * SCAN : (c + 1) * SCAN])
                k = np.searchsorted(mine, strings[i:j])
                spot[i:j] = k + c * SCAN
                hit[i:j] = _same(mine[np.minimum(k, len(mine) - 1)], strings[i:j])
        return spot, hit

    def merge(self, other: Level, spot: np.ndarray | None = None) -> Level:
        """Both in one; they have no string in common. spot: where other's strings would stand in this one, if that is known."""
        if spot is None:
            spot = np.concatenate([self.scan(_strings(other.data, other.at[i : i + SCAN]))[0] for i in range(0, len(other.at), SCAN)])
        theirs = spot + np.arange(len(spot))
        mine = np.ones(len(self.at) + len(spot), bool)
        mine[theirs] = False
        mine = np.flatnonzero(mine)

        def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            out = np.empty(len(a) + len(b), np.int64)
            out[mine], out[theirs] = a, b
            return out

        pairs = ((self.at, other.at + len(self.data)), (self.doc, other.doc), (self.start, other.start))
        return Level(np.concatenate((self.data, other.data)), *(both(a, b) for a, b in pairs))

    def trimmed(self) -> Level:
        """Without the text that is in none of the strings, where there is much text."""
        if len(self.data) <= SPARE * len(self.at):
            return self
        order = np.argsort(self.at)
        low = self.at[order]
        size = np.append(np.minimum(np.diff(low), DEPTH), DEPTH)  # of each string, the bytes before the next
        begin = np.cumsum(size) - size
        at = np.empty_like(self.at)
        at[order] = begin
        return Level(self.data[_expand(low, size)[1]], at, self.doc, self.start)


class SuffixLevels:
    """Suffix arrays of the batches so far, in sizes that fall about geometrically; no string is in two of them."""

    def __init__(self):
        self.levels: list[Level] = []

    def add(self, data: np.ndarray, at: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, start) of the windows that turn out to have an equal one earlier, among the new (at in data) and those before."""
        if not len(at):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        sorted_ = np.all(_earlier(doc[:-1], start[:-1], doc[1:], start[1:]))
        order = np.arange(len(at)) if sorted_ else _by_place(doc, start)
        array, strings = _sorted(data, at[order])  # the batch's suffix array; equal strings by place
        order = order[array]
        new = np.concatenate(([True], ~_same(strings[1:], strings[:-1])))
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        at, doc, start = at[order], doc[order], start[order]
        late = _earlier(doc[head], start[head], doc, start)
        gone = [(doc[late], start[late])]
        strings, at, doc, start = strings[new], at[new], doc[new], start[new]
        spot = None
        for level in self.levels:
            spot, hit = level.scan(strings)
            k, d, f = spot[hit], doc[hit], start[hit]
            before, after = _earlier(d, f, level.doc[k], level.start[k]), _earlier(level.doc[k], level.start[k], d, f)
            gone += [(d[after], f[after]), (level.doc[k[before]], level.start[k[before]])]
            level.doc[k[before]], level.start[k[before]] = d[before], f[before]
            spot, strings, at, doc, start = (x[~hit] for x in (spot, strings, at, doc, start))
        if len(at):
            self.levels.append(Level(data, at, doc, start).trimmed())
            while len(self.levels) > 1 and len(self.levels[-1].at) * 2 > len(self.levels[-2].at):
                b, a = self.levels.pop(), self.levels.pop()
                self.levels.append(a.merge(b, spot))  # the last scan was of the last level
                spot = None
        return tuple(np.concatenate(x) for x in zip(*gone, strict=True))


def _expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, window start) of each window of runs that begin at first and have count windows."""
    run = np.repeat(np.arange(len(first)), count)
    begin = np.cumsum(count) - count
    return run, first[run] + np.arange(len(run)) - begin[run]


def _texts(key: np.ndarray, doc: np.ndarray, first: np.ndarray, count: np.ndarray, data: np.ndarray, begin: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """Runs of count windows with their bytes (from begin in data), by shard of their key."""
    rows, size = [], count.astype(np.int64) + DEPTH - 1
    for s, i in by_shard(key, shards):
        at = _expand(begin[i], size[i])[1]
        head = pack([doc[i], first[i].astype(np.int32), count[i].astype(np.uint8)])
        rows.append((s, len(head).to_bytes(8, "little") + head + pack([data[at]])))
    yield _batch(TEXTS, len(rows), shard=[s for s, _ in rows], block=[x for _, x in rows])


# ---------------------------------------------------------------- steps
def _again(gram: np.ndarray, same: np.ndarray, doc: np.ndarray, first: np.ndarray, count: np.ndarray, data: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether each run has nothing but windows with an equal one earlier in another run, documents and starts of such windows).

    Runs with equal hashes are looked at; suffix arrays tell.
    """
    both = gram * C[14] ^ same
    order = np.argsort(both)
    equal = both[order[1:]] == both[order[:-1]]
    some = np.zeros(len(order), bool)
    some[order[1:][equal]] = some[order[:-1][equal]] = True
    out, some = np.zeros(len(order), bool), np.flatnonzero(some)
    some = some[_by_place(doc[some], first[some])]
    levels, found = SuffixLevels(), [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for i, j in chunks(count[some].tolist(), BATCH):
        run, at = _expand(place[some[i:j]], count[some[i:j]])
        mine = some[i:j][run]
        found.append(levels.add(data, at, doc[mine], first[mine] + at - place[mine]))
    d, f = (np.concatenate(x) for x in zip(*found, strict=True))
    if len(d):
        # a run goes if each of its places is among the found; each document's places are marked in a stretch of their own
        docs, number = np.unique(doc[some], return_inverse=True)
        longest = np.zeros(len(docs), np.int64)
        np.maximum.at(longest, number, first[some] + count[some])
        base = np.cumsum(longest) - longest
        mark = np.zeros(int(longest.sum()) + 1, np.int64)
        mark[base[np.searchsorted(docs, d)] + f + 1] = 1
        marked = np.cumsum(mark)
        low = base[number] + first[some]
        out[some] = marked[low + count[some]] - marked[low] == count[some]
    return out, d, f


def deal(docs: DataFrame, shards: int) -> DataFrame:
    """The runs of docs (doc_id, text) by shard of their gram, those that come again within FLUSH bytes left out; runs of hot grams; spans found on the way."""

    def flush(held: list[tuple[dict, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        lifts = np.cumsum([0, *(len(r["data"]) for r, _ in held)])
        get = lambda name: np.concatenate([r[name] for r, _ in held])
        doc = np.concatenate([ids[r["doc"]] for r, ids in held])
        place = np.concatenate([r["base"][r["doc"]] + r["first"] + lift for (r, _), lift in zip(held, lifts, strict=False)])
        gram, same, first, last, anchor = map(get, ("gram", "same", "first", "last", "anchor"))
        again, d, f = _again(gram, same, doc, first, last - first + 1, get("data"), place)
        yield from _spans(d, f, f + DEPTH)
        k = np.flatnonzero(~again)
        k = k[np.argsort(gram[k], kind="stable")]
        gram, same, doc, first, last, anchor = (x[k] for x in (gram, same, doc, first, last, anchor))
        begin = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        size = np.diff(np.append(begin, len(gram)))
        hot = np.repeat(size >= HOT_CHUNK, size)
        info = (anchor - first) * 128 + (last - first)
        yield from _differ(gram[hot], doc[hot], first[hot], info[hot], np.ones(int(hot.sum()), bool))
        marks = gram[begin[size >= HOT_CHUNK]]
        zero = np.zeros(len(marks), np.int64)
        cold = ~hot
        cols = [np.concatenate(x) for x in ((gram[cold], marks), (same[cold], zero.astype(U64)), (doc[cold], zero), (first[cold], zero - 1), (info[cold], zero))]
        cols = [c.astype(t) for c, t in zip(cols, _RUN, strict=True)]
        rows = [(s, pack([c[i] for c in cols])) for s, i in by_shard(cols[0], shards)]
        yield _batch(RUNS, len(rows), shard=[s for s, _ in rows], block=[x for _, x in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            ids, texts = b.column(0).to_numpy(), utf8(b.column(1))
            for i, j in chunks(map(len, texts), AT_ONCE):
                if (r := runs(texts[i:j])) is not None:
                    held.append((r, ids[i:j]))
                    size += int(r["base"][-1])
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return docs.mapInArrow(thrifty(run), STEP)


def _differ(gram: np.ndarray, doc: np.ndarray, first: np.ndarray, info: np.ndarray, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of runs whose bytes are to be compared."""
    if len(doc):
        yield _batch(DIFFER, len(doc), doc=doc, gram=gram.view(np.int64), first=first.astype(np.int32), info=info.astype(np.int32) | (hot.astype(np.int32) << HOT_BIT), shard=(doc % 1009).astype(np.int32))


def _by_shard(steps: DataFrame) -> DataFrame:
    return steps.repartition(partitions(steps.sparkSession), "shard").sortWithinPartitions("shard")


def compare(dealt: DataFrame) -> DataFrame:
    """The runs whose gram has others (kind DIFFER), spans and hot runs as they come."""

    def finish(blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        gram, same, doc, first, info = (np.concatenate(x) for x in zip(*(unpack(x, _RUN) for x in blocks), strict=True))
        marked = np.unique(gram[first < 0])
        k = np.flatnonzero(first >= 0)
        k = k[np.lexsort((first[k], doc[k], same[k], gram[k]))]
        gram, same, doc, first, info = (x[k] for x in (gram, same, doc, first, info))
        if not len(gram):
            return
        step = lambda *xs: np.concatenate(([True], np.any([x[1:] != x[:-1] for x in xs], axis=0)))
        kind, once = step(gram, same), step(gram, same, doc, first)  # a repeated row brings its runs again
        begin = np.flatnonzero(step(gram))
        hot = np.isin(gram[begin], marked) | (np.add.reduceat(kind.astype(np.int64), begin) >= HOT)
        size = np.diff(np.append(begin, len(gram)))
        left = np.repeat((np.add.reduceat(once.astype(np.int64), begin) > 1) | hot, size) & once
        yield from _differ(gram[left], doc[left], first[left], info[left], np.repeat(hot, size)[left])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks = None, []
        for b in batches:
            kind = b.column("kind").to_numpy()
            if (kind != RUNS).any():
                yield b.filter(pa.array(kind != RUNS))
            rest = b.filter(pa.array(kind == RUNS))
            for s, x in zip(rest.column("shard").to_pylist(), rest.column("block").to_pylist(), strict=True):
                if s != now and blocks:
                    yield from finish(blocks)
                    blocks = []
                now = s
                blocks.append(x)
        if blocks:
            yield from finish(blocks)

    return _by_shard(dealt).mapInArrow(thrifty(run), STEP)


def with_texts(docs: DataFrame, differ: DataFrame, shards: int) -> DataFrame:
    """The runs with their bytes, by shard of their gram; those of hot grams window by window, by shard of its hash."""
    mine = differ.groupBy("doc").agg(F.collect_list("first").alias("first"), F.collect_list("gram").alias("gram"), F.collect_list("info").alias("info"))

    def flush(cols: list[list[np.ndarray]], parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        gram, doc, first, count, hot = (np.concatenate(c) for c in cols)
        data = np.frombuffer(b"".join(parts), np.uint8)
        size = count.astype(np.int64) + DEPTH - 1
        begin = np.cumsum(size) - size
        cold = ~hot
        yield from _texts(gram[cold], doc[cold], first[cold], count[cold], data, begin[cold], shards)
        if not hot.any():
            return
        levels = SuffixLevels()
        hot = np.flatnonzero(hot)
        for i, j in chunks(count[hot].tolist(), BATCH):
            run, at = _expand(begin[hot[i:j]], count[hot[i:j]])
            run = hot[i:j][run]
            d, f = levels.add(data, at, doc[run], first[run] + at - begin[run])
            yield from _spans(d, f, f + DEPTH)
        for level in levels.levels:
            key = window_hashes(level.data)[1][level.at]
            yield from _texts(key, level.doc, level.start, np.ones(len(key), np.int64), level.data, level.at, shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = lambda: ([[], [], [], [], []], [], 0)
        cols, parts, size = new()
        for b in batches:
            texts = utf8(b.column(1))
            for r, text in enumerate(texts):
                doc = b.column(0)[r].as_py()
                first, gram, info = (b.column(c)[r].values.to_numpy() for c in (2, 3, 4))
                count = (info & 127).astype(np.int64) + 1
                inside = np.flatnonzero(first + count + DEPTH - 1 <= len(text))  # all, unless a doc_id names different texts
                first, gram, count, hot = first[inside].astype(np.int64), gram[inside], count[inside], info[inside] >> HOT_BIT > 0
                for c, x in zip(cols, (gram.view(U64), np.full(len(first), doc, np.int64), first, count, hot), strict=True):
                    c.append(x)
                own = [text[f : f + c + DEPTH - 1] for f, c in zip(first.tolist(), count.tolist(), strict=True)]
                parts += own
                size += sum(map(len, own))
                if size >= 16 << 20:
                    yield from flush(cols, parts)
                    cols, parts, size = new()
        if parts:
            yield from flush(cols, parts)

    return docs.join(mine, docs.doc_id == mine.doc).select("doc_id", "text", "first", "gram", "info").mapInArrow(thrifty(run), STEP)


def settle(steps: DataFrame) -> DataFrame:
    """Spans from the suffix arrays of each shard; spans pass."""

    def batch(levels: SuffixLevels, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        heads, texts = [], []
        for x in blocks:
            n = int.from_bytes(x[:8], "little")
            heads.append(unpack(x[8 : 8 + n], ["i8", "i4", "u1"]))
            texts.append(unpack(x[8 + n :], ["u1"])[0])
        doc, first, count = (np.concatenate(x) for x in zip(*heads, strict=True))
        data, size = np.concatenate(texts), count.astype(np.int64) + DEPTH - 1
        begin = np.cumsum(size) - size
        order = _by_place(doc, first)
        doc, first, count, begin = doc[order], first[order].astype(np.int64), count[order].astype(np.int64), begin[order]
        for i, j in chunks(count.tolist(), BATCH):
            run, at = _expand(begin[i:j], count[i:j])
            mine = data if j - i == len(order) else data[_expand(begin[i:j], count[i:j] + DEPTH - 1)[1]]
            own = begin[i:j] if mine is data else np.cumsum(count[i:j] + DEPTH - 1) - count[i:j] - DEPTH + 1
            d, f = levels.add(mine, own[run] + at - begin[i:j][run], doc[i:j][run], first[i:j][run] + at - begin[i:j][run])
            yield from _spans(d, f, f + DEPTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, levels, blocks, size = None, SuffixLevels(), [], 0
        for b in batches:
            kind = b.column("kind").to_numpy()
            if (kind == SPANS).any():
                yield b.filter(pa.array(kind == SPANS))
            rest = b.filter(pa.array(kind == TEXTS))
            for s, x in zip(rest.column("shard").to_pylist(), rest.column("block").to_pylist(), strict=True):
                if blocks and (s != now or size >= BATCH):
                    yield from batch(levels, blocks)
                    blocks, size = [], 0
                if s != now:
                    now, levels = s, SuffixLevels()
                blocks.append(x)
                size += _windows_in(x)
        if blocks:
            yield from batch(levels, blocks)

    return _by_shard(steps).mapInArrow(thrifty(run), STEP)


def _windows_in(block: bytes) -> int:
    """How many windows the runs of a TEXTS block have."""
    n = int.from_bytes(block[:8], "little")
    runs, text = (int.from_bytes(block[i : i + 8], "little") for i in (8, 8 + n))
    return text - (DEPTH - 1) * runs


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, spans array<struct<start, end>>) of what goes from docs (doc_id, text), for the documents that lose anything.

    Spans are in bytes; those of a document may overlap.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and octet_length(text) >= 100")
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = size // SHARD_TEXT + 1
    one = materialize(compare(deal(docs, shards)), "dedup-runs")
    collect_garbage(spark)
    two = materialize(settle(with_texts(docs, one.where(F.col("kind") == DIFFER), shards)), "dedup-spans")
    collect_garbage(spark)
    spans = one.union(two).where(F.col("kind") == SPANS)
    return spans.groupBy("doc").agg(F.collect_list(F.struct(F.col("first").alias("start"), F.col("info").alias("end"))).alias("spans"))


def _merged(spans: list[dict] | None, size: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["start"], min(x["end"], size)) for x in spans or ()):
        if b <= a:
            continue
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of docs (doc_id, text)."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, t, s in zip(b.column(0).to_pylist(), utf8(b.column(1)), b.column(2).to_pylist(), strict=True):
                m = _merged(s, len(t))
                out.append((i, len(t), sum(y - x for x, y in m), len(m), hashlib.sha256(_kept(t, m)).hexdigest()))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 4 else pa.int64()) for k, c in enumerate(cols)], [x.split()[0] for x in schema.split(", ")])

    both, spans = _joined(docs.select("doc_id", "text"))
    return both.select(F.col("doc_id").cast("long").alias("doc_id"), "text", spans).mapInArrow(thrifty(run), schema)


def _joined(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with their spans, in a column of the name that comes with it."""
    doc, spans = unused(docs, "doc", "spans")
    found = repeated_spans(docs).select(F.col("doc").alias(doc), F.col("spans").alias(spans))
    return docs.join(found, F.col("doc_id").cast("long") == F.col(doc), "left").drop(doc), spans


def strip(docs: DataFrame) -> DataFrame:
    """docs with the repeated bytes taken out of text (characters cut in two go whole), n_chars, if there, set anew, and without the documents of which nothing but white space is left."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = utf8(b.column(at))
            texts = [t if not s else _kept(t, _merged(s, len(t))) for t, s in zip(raw, b.column(b.num_columns - 1).to_pylist(), strict=True)]
            new = pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string())
            columns = [*b.columns[:at], new, *b.columns[at + 1 : -1]]
            yield pa.RecordBatch.from_arrays(columns, b.schema.names[:-1])

    both, spans = _joined(docs)
    out = both.select(*docs.columns, spans).mapInArrow(thrifty(run), docs.schema).where(F.length(F.regexp_replace("text", r"\s+", "")) > 0)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
