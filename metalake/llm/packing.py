"""Lexical retrieval packing: every window is seeded by a document and filled up with its nearest documents by BM25 that
aren't used yet, from a sharded inverted index.

A document is its token ids and the separator id. A window takes its seed's ids, then those of the seed's best unused neighbours
in the seed's shard, and, where no unused document there shares a term, of the next unused document. The document that reaches the
window's end is cut there and seeds the next window. What is in the last window when a shard's documents run out is cut into sequences
whose lengths are powers of two, which need no padding.

*Statistics* (number of documents, mean length, documents with each term) are the whole corpus'. All ids of a document are its terms, in
the index as in the queries. *Shards* are runs of documents in an order in which lexical neighbours are near each other: a document's
place is given by the three of up to `PIVOTS` sampled documents that BM25 ranks first for it. The order is cut into shards of at most
`BLOCK_IDS` ids or `BLOCK_DOCS` documents (or one document), so a shard fits a task whatever the input. Every document is
in one shard's index, and every seed is scored against all documents of its shard, exactly. A seed doesn't see other shards: the
neighbours are those that the order brings together. README has the measured share of the best score in all the corpus.

*Copies.* Texts equal to one that a window holds are taken into it only if nothing else is left in the shard. Copies of texts that make up
more than 1 / `HOT` of all rows, of which there are fewer than `HOT`, go to places drawn by a hash, so no shard is filled with them.

Equal scores go to the document that comes first in the shard (by place, hash of the text, doc_id). Null texts are empty and hold the separator alone. Repeated rows are packed
as often as they occur; rows with a null id too. Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, chunks, materialize, mix64, partitions, release, thrifty

WINDOW, SEPARATOR = 1024, 0
PIVOTS, HOT = 1024, 4096
SPARSE = 8  # at most one text in so many is a pivot
BLOCK_IDS, BLOCK_DOCS = 2 << 20, 4096
COMMON = 16  # terms that more than 1 / COMMON of a shard's documents hold are scored by a matrix product, others by their postings
K1, B = 1.2, 0.75
LONG = 1 << 20  # characters that are encoded at a time


# ---------------------------------------------------------------- tokens
def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """Ids of the byte-level BPE in a tokenizers file, as unsigned 32-bit values; strings of added tokens are these tokens, as for that library.

    The splitting pattern looks ahead for one thing only: of a run of blanks before other text, the last is left to what follows. Texts with
    such runs are cut there, so a pattern that looks nowhere ahead does for all, which its engine runs faster.
    """

    _ahead = r"|\s+(?!\S)"
    _blanks = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # fixed values: the characters with the Unicode property White_Space
    _runs = re.compile(f"[{_blanks}][{_blanks}]")
    _single = re.compile(f"(?<=[^{_blanks}]) (?=[^{_blanks}])")
    _before_last = re.compile(f"([{_blanks}]+(?=[{_blanks}][^{_blanks}]))")

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        byte = _byte_of()
        model = json.load(open(path, encoding="utf-8"))
        self._added = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        if any(t.get(k) for t in model.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that take in what stands beside them aren't supported")
        if public_tokenizers.PATTERN.count(self._ahead) != 1:
            raise ValueError("a splitting pattern that treats runs of blanks otherwise isn't supported")
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) + ")") if self._added else None
        ranks = {bytes(byte[c] for c in k): v for k, v in model["model"]["vocab"].items() if v not in self._added.values()}
        self.top = max([*ranks.values(), *self._added.values()])
        plain = public_tokenizers.PATTERN.replace(self._ahead, "")
        self._encoding = tiktoken.Encoding("file", pat_str=plain, mergeable_ranks=ranks, special_tokens=self._added)

    def ids(self, text: str) -> np.ndarray:
        """All ids of a text."""
        parts = self._cut.split(text) if any(x in text for x in self._added) else [text]  # every other one is an added token
        found = [a for i, x in enumerate(parts) for a in ([np.array([self._added[x]], np.uint32)] if i % 2 else self._plain(x))]
        return np.concatenate(found) if len(found) > 1 else found[0]

    def _plain(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a text without added tokens, a bounded part of it at a time where it has single blanks: no piece reaches across one."""
        at = 0
        while len(text) - at > LONG and (blank := self._single.search(text, at + LONG)):
            yield self._some(text[at : blank.start()])
            at = blank.start()
        yield self._some(text[at:])

    def _some(self, text: str) -> np.ndarray:
        if not self._runs.search(text):
            return self._encode(text)
        return np.concatenate([np.empty(0, np.uint32), *(self._encode(x) for x in self._before_last.split(text) if x)])

    def _encode(self, text: str) -> np.ndarray:
        return self._encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=())


_tokens: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


# ---------------------------------------------------------------- BM25
Terms = tuple[np.ndarray, np.ndarray]  # distinct ids, ascending, and how often each occurs


def count_terms(ids: np.ndarray) -> Terms:
    return np.unique(ids, return_counts=True)


class Stats:
    """The whole corpus' number of documents, mean length and document frequency of each term."""

    def __init__(self, n: int, mean: float, df: np.ndarray):
        self.n, self.mean, self.df = n, max(1.0, mean), df
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5))

    def weights(self, terms: Terms) -> np.ndarray:
        """BM25 weights of a document's terms."""
        t, tf = terms
        return self.idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * int(tf.sum()) / self.mean))


class Index:
    """A BM25 inverted index over documents, given by their terms."""

    def __init__(self, stats: Stats, docs: list[Terms]):
        self.size = len(docs)
        sizes = np.fromiter((len(t) for t, _ in docs), np.int64, self.size)
        term = np.concatenate([np.empty(0, np.int64), *(t for t, _ in docs)]).astype(np.int64)
        weight = np.concatenate([np.empty(0), *(stats.weights(d) for d in docs)])
        doc = np.repeat(np.arange(self.size), sizes)
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.at = np.searchsorted(term[order], np.arange(len(stats.df) + 1))
        self.common = np.flatnonzero(np.diff(self.at) * COMMON > self.size)
        self.place = np.full(len(stats.df), -1)
        self.place[self.common] = np.arange(len(self.common))
        self.dense = np.zeros((len(self.common), self.size), np.float32)
        dense = self.place[term] >= 0
        self.dense[self.place[term[dense]], doc[dense]] = weight[dense]

    def scores(self, queries: list[Terms]) -> np.ndarray:
        """The score of every document (columns) for each query (rows), each term of which counts once."""
        own = np.fromiter((len(t) for t, _ in queries), np.int64, len(queries))
        who, term = np.repeat(np.arange(len(queries)), own), np.concatenate([np.empty(0, np.int64), *(t for t, _ in queries)]).astype(np.int64)
        at = self.place[term]
        asked = np.zeros((len(queries), len(self.common)), np.float32)
        asked[who[at >= 0], at[at >= 0]] = 1
        return asked @ self.dense + self._postings(who[at < 0], term[at < 0], len(queries)).astype(np.float32)

    def _postings(self, who: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Sums over the postings of (query, term) pairs, a bounded number of postings at a time."""
        out = np.zeros(n * self.size)
        size = self.at[term + 1] - self.at[term]
        for i, j in chunks(size.tolist(), 4 << 20):
            n_ = size[i:j]
            spot = np.repeat(self.at[term[i:j]] - np.cumsum(n_) + n_, n_) + np.arange(int(n_.sum()))
            low, high = int(who[i]) * self.size, (int(who[j - 1]) + 1) * self.size
            out[low:high] += np.bincount(np.repeat(who[i:j], n_) * self.size + self.doc[spot] - low, weights=self.weight[spot], minlength=high - low)
        return out.reshape(n, self.size)


class Router:
    """Places of documents in the order: their three best pivots, in one number.

    Rare terms count for more here than in the windows (the cube of their idf): they tell which neighbours stand out.
    """

    def __init__(self, stats: Stats, pivots: list[Terms], hot: list[int]):
        told = Stats(stats.n, stats.mean, stats.df)
        told.idf = stats.idf**3
        self.index = Index(told, pivots)
        self.hot = np.array(sorted(hot), np.int64)
        self.places = np.sort(self._best(pivots)) if pivots else np.zeros(1, np.int64)

    def _best(self, docs: list[Terms]) -> np.ndarray:
        score = self.index.scores(docs)
        top = np.full((len(docs), 3), PIVOTS, np.int64)
        for k in range(min(3, self.index.size)):
            best = score.argmax(axis=1)
            some = score[np.arange(len(docs)), best] > 0
            top[some, k] = best[some]
            score[np.arange(len(docs)), best] = 0
        return (top[:, 0] << 40) | (top[:, 1] << 20) | top[:, 2]

    def places_of(self, docs: list[Terms], keys: np.ndarray, draws: np.ndarray) -> np.ndarray:
        out = self._best(docs) if self.index.size else np.zeros(len(docs), np.int64)
        hot = np.isin(keys, self.hot)
        out[hot] = self.places[(draws[hot] % U64(len(self.places))).astype(np.int64)]
        return out


# ---------------------------------------------------------------- windows
def fill(lengths: np.ndarray, keys: np.ndarray, scores: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a shard's documents; scores[i] are those of all for the seed i."""
    n = len(lengths)
    pieces: list[tuple[int, int, int, int, int]] = []
    used = np.zeros(n, dtype=bool)
    _, group = np.unique(keys, return_inverse=True)
    members = np.split(np.argsort(group, kind="stable"), np.cumsum(np.bincount(group))[:-1])
    following, sequence, room = 0, -1, 0  # the next that may be unused, the window, the ids that it still takes
    seed, row, held = -1, None, []
    for _ in range(n):
        while used[following]:
            following += 1
        d = following
        if room:
            if row is None:
                row = np.where(used, -1.0, scores[seed])
                row[members[held[0]]] = -1.0
            d = int(row.argmax())
            if row[d] <= 0:  # nothing shares a term: the next one, of another text if there is one
                other = ~used
                for g in held:
                    other[members[g]] = False
                d = int(other.argmax()) if other.any() else following
        used[d] = True
        start, size, opened = 0, int(lengths[d]), False
        while start < size:
            if not room:
                sequence, room, opened = sequence + 1, window, True
            k = min(size - start, room)
            pieces.append((d, start, k, sequence, window - room))
            start, room = start + k, room - k
        if opened:
            seed, row, held = d, None, [group[d]]
        else:
            held.append(group[d])
            if row is not None:
                row[members[group[d]]] = -1.0
    return _cut_last(pieces, sequence) if room else pieces


def _cut_last(pieces: list[tuple[int, int, int, int, int]], last: int) -> list[tuple[int, int, int, int, int]]:
    """The last, open window cut into sequences whose lengths are powers of two."""
    out = [p for p in pieces if p[3] != last]
    total = sum(p[2] for p in pieces if p[3] == last)
    sequence, room, at = last - 1, 0, 0
    for d, start, n, q, _ in pieces:
        while q == last and n:
            if room == at:
                sequence, at, room = sequence + 1, 0, 1 << (total.bit_length() - 1)
                total -= room
            k = min(n, room - at)
            out.append((d, start, k, sequence, at))
            start, n, at = start + k, n - k, at + k
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _batch(schema: str, cols: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields, strict=True)], [n for n, _ in fields])


def _ids(column: pa.Array, kind: str) -> list[np.ndarray]:
    """Views of the column's ids; a document's last is the separator."""
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) and column.buffers()[2] is not None else np.empty(0, np.uint8)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else [0]
    return [data[a:b].view(kind) for a, b in zip(at, at[1:], strict=False)]


def _tokenise(docs: DataFrame, tokenizer: str, kind: str) -> DataFrame:
    """(doc_id, key, ids) of each document, key being a hash of its text; and each task's counts of documents by term (df), all else null."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    schema = "doc_id long, key long, n int, ids binary, df binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokens(tokenizer), np.array([SEPARATOR], np.uint32)
        df = np.zeros(encoder.top + 1, np.uint32)
        for b in batches:
            out, n = [], []
            for t in b.column(2).to_pylist():
                d = np.concatenate((encoder.ids(t), end))
                df[count_terms(d[:-1])[0]] += 1
                out.append(d.astype(kind).tobytes())
                n.append(len(d))
            yield _batch(schema, [b.column(0), b.column(1), n, out, pa.nulls(len(out), pa.binary())])
        if df.any():
            yield _batch(schema, [[None], [None], [None], [None], [df.tobytes()]])

    return materialize(rows.mapInArrow(thrifty(run), schema), "packing-ids")


def _statistics(held: DataFrame, kind: str) -> Stats:
    wide = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                new = np.frombuffer(x, np.uint32)
                df = np.concatenate((df, np.zeros(max(0, len(new) - len(df)), np.int64)))
                df[: len(new)] += new
        found = np.flatnonzero(df)
        yield _batch("term long, n long", [found, df[found]])

    total = held.agg(F.count("n").alias("n"), F.sum(F.col("n") - 1).alias("ids")).first()
    got = dict(map(tuple, held.where("df is not null").select("df").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()))  # a row for each id of the vocabulary at most
    df = np.zeros(1 << (8 * wide) if wide < 4 else max(got, default=0) + 1, np.int64)
    df[list(got)] = list(got.values())
    return Stats(total["n"], (total["ids"] or 0) / max(1, total["n"]), df)


def _router(held: DataFrame, stats: Stats, kind: str) -> Router:
    """A router with pivots drawn by a hash of the text among the different texts."""
    documents = held.where("n is not null")
    hot = [r["key"] for r in documents.groupBy("key").count().where(F.col("count") > max(16.0, stats.n / HOT)).select("key").collect()]  # fewer than HOT
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [count_terms(d[:-1]) for d in _ids(b.column(1), kind)]
            yield _batch("key long, terms binary, tf binary", [b.column(0).to_pylist(), [t.astype("<u4").tobytes() for t, _ in found], [c.astype("<u4").tobytes() for _, c in found]])

    taken = documents.where(draw < min((1 << 30) // SPARSE, (PIVOTS << 30) // max(1, stats.n))).select("key", "ids")
    rows = taken.mapInArrow(run, "key long, terms binary, tf binary").dropDuplicates(["key"]).collect()  # about PIVOTS rows at most
    pivots = [(np.frombuffer(r["terms"], "<u4"), np.frombuffer(r["tf"], "<u4")) for r in sorted(rows, key=lambda r: r["key"])]
    return Router(stats, pivots, hot)


def _route(held: DataFrame, router: Router, kind: str) -> DataFrame:
    state = held.sparkSession.sparkContext.broadcast(router)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for b in batches:
            for i, j in ((i, min(i + 512, b.num_rows)) for i in range(0, b.num_rows, 512)):
                c = b.slice(i, j - i)
                draws = mix64(np.arange(row, row + j - i).astype(U64) + U64(0x9E3779B97F4A7C15))
                row += j - i
                place = state.value.places_of([count_terms(d[:-1]) for d in _ids(c.column(2), kind)], c.column(1).to_numpy(), draws)
                yield pa.RecordBatch.from_arrays([*c.columns, pa.array(place)], ["doc_id", "key", "ids", "place"])

    return held.where("n is not null").select("doc_id", "key", "ids").mapInArrow(thrifty(run), "doc_id long, key long, ids binary, place long")


def shard_scores(stats: Stats, terms: list[Terms]) -> np.ndarray:
    """All documents' scores for each; no document is its own neighbour."""
    scores = Index(stats, terms).scores(terms)
    np.fill_diagonal(scores, 0)
    return scores


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """The pieces of docs (doc_id, text) in sequences of at most `window` ids; window is a power of two."""
    spark = docs.sparkSession
    kind = "<u2" if tokens(tokenizer).top < 1 << 16 else "<u4"
    held = _tokenise(docs, tokenizer, kind)
    stats = _statistics(held, kind)
    routed = materialize(_route(held, _router(held, stats, kind), kind), "packing-places")
    release(held)
    state = spark.sparkContext.broadcast(stats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 40
        block, size = ([], [], []), 0
        for b in batches:
            for i, k, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _ids(b.column(2), kind), strict=True):
                if block[0] and (size + len(d) > BLOCK_IDS or len(block[0]) == BLOCK_DOCS):
                    out, sequence = _pieces(*block, state.value, window, sequence)
                    yield out
                    block, size = ([], [], []), 0
                for x, y in zip(block, (i, k, d), strict=True):
                    x.append(y)
                size += len(d)
        if block[0]:
            yield _pieces(*block, state.value, window, sequence)[0]

    order = ["place", "key", "doc_id"]
    parts = min(2 * partitions(spark), 4 * int(stats.mean * stats.n) // BLOCK_IDS + 1)  # few texts aren't dealt thin
    dealt = routed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "key", "ids")
    return dealt.mapInArrow(thrifty(run), SCHEMA)


def _pieces(doc_ids: list, keys: list, ids: list[np.ndarray], stats: Stats, window: int, base: int) -> tuple[pa.RecordBatch, int]:
    """The rows of a shard's documents, sequences numbered from base, and the next number."""
    found = fill(np.array([len(d) for d in ids]), np.array(keys), shard_scores(stats, [count_terms(d[:-1]) for d in ids]), window)
    rows = [(doc_ids[d], x, n, zlib.crc32(ids[d][x : x + n].astype("<u4").tobytes()), len(ids[d]), base + q, o) for d, x, n, q, o in found]
    return _batch(SCHEMA, list(zip(*rows, strict=True))), base + 1 + max(p[3] for p in found)
