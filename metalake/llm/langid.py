"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed against it from left to right into phrases, each the
longest match in the labelled text from where the phrase begins; a letter that the labelled text lacks is a phrase of its own. The language whose
parse is the shortest in bits a character wins: phrases x (log2 of the labelled text's length + `EACH`) / characters. `EACH` is what a
phrase's length costs; without it, short labelled texts, whose phrases cost few bits and hold few letters, would win every text.

Texts are lower-cased, letters kept, every run of other characters made one blank. The alphabet has every letter of the labelled texts.
The whole of every text is parsed. It is cut into segments so that many walk through an automaton at once; a walk that
comes from an earlier segment then replaces the beginning of the next one's, up to where both begin a phrase at one place, so phrases are
those of one walk through the whole text.

The labelled text is a bounded sample of rows: about `TRAIN_DOCS` documents a language, drawn by a hash of their ids, and of each a
passage of `PASSAGE` characters (more where a language has few documents) that begins anywhere in the text. Every language that occurs
is learned. A language takes about 4 MB in each Python worker.

Null texts and texts without letters get `und` and score 0. Ties go to the language that sorts first. Without any
labelled text all are `und`. Repeated rows, null ids (never labelled text unless they are) and further columns change
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, thrifty

TRAIN_DOCS, PASSAGE = 64, 1000
EACH = 4.0
SEGMENT, AT_ONCE = 512, 4 << 20
FEW = 64  # walks from which on they go side by side
UNKNOWN, BLANK = 0, 1
ROOT = 0
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)
    return _letters


def code_table(alphabet: str) -> np.ndarray:
    """The code of each character: UNKNOWN letters, BLANK for what is no letter, from 2 on the alphabet's."""
    table = np.where(_is_letter(), np.int32(UNKNOWN), np.int32(BLANK))
    table[[ord(ch) for ch in alphabet]] = np.arange(2, len(alphabet) + 2)
    return table


def encode(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts in one array, blanks collapsed and leading ones dropped, and each text's start (one more at the end)."""
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = table[points]
    starts = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) for t in low], out=starts[1:])
    blank = codes == BLANK
    before = np.ones_like(blank)
    before[1:] = blank[:-1]
    before[starts[:-1][starts[:-1] < len(codes)]] = True
    keep = ~(blank & before)
    kept = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return codes[keep], kept[starts]


# ---------------------------------------------------------------- automata
def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """The transitions of each state of the codes' suffix automaton; state 0 is the root."""
    rows: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(length)
        length.append(length[last] + 1)
        link.append(0)
        rows.append({})
        p = last
        while p != -1 and c not in rows[p]:
            rows[p][c] = cur
            p = link[p]
        if p != -1:
            q = rows[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                rows.append(rows[q].copy())
                link.append(link[q])
                while p != -1 and rows[p].get(c) == q:
                    rows[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return rows


class Automaton:
    """An automaton whose states' sparse rows share one array: state s goes by code c to target[base[s] + c], if owner[base[s] + c] is s.

    Rows are laid out widest first, each where its codes hit free slots. The root's row, whose codes begin phrases, stands apart.
    """

    def __init__(self, rows: list[dict[int, int]], width: int):
        self.first = np.zeros(width, np.int32)  # the state after a phrase's first letter; ROOT: no such letter
        for c, t in rows[ROOT].items():
            self.first[c] = t
        room = 2 * sum(map(len, rows[1:])) + 2 * width
        self.base = np.zeros(len(rows), np.int32)
        self.owner, self.target = np.full(room + width, -1, np.int32), np.zeros(room + width, np.int32)
        used, rng = np.zeros(room, dtype=bool), np.random.default_rng(7)
        wide = [s for s in range(1, len(rows)) if len(rows[s]) > 1]
        for s in sorted(wide, key=lambda s: -len(rows[s])):
            codes, misses = np.fromiter(rows[s], np.int64, len(rows[s])), 0
            while True:
                tries = rng.integers(0, len(used) - width, 32)
                if (fits := ~used[tries[:, None] + codes].any(axis=1)).any():
                    break
                if (misses := misses + 1) % 64 == 0:  # crowded
                    used, self.owner, self.target = np.append(used, np.zeros(room, bool)), np.append(self.owner, np.full(room, -1, np.int32)), np.append(self.target, np.zeros(room, np.int32))
            at = self.base[s] = tries[fits.argmax()]
            used[at + codes] = True
            self.owner[at + codes], self.target[at + codes] = s, list(rows[s].values())
        single = [s for s in range(1, len(rows)) if len(rows[s]) == 1]
        free = np.flatnonzero(~used[width:])[: len(single)] + width  # as many as there are edges, at least
        self.base[single] = free - np.fromiter((c for s in single for c in rows[s]), np.int64, len(single))
        self.owner[free], self.target[free] = single, [t for s in single for t in rows[s].values()]

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after the codes, and whether a phrase begins with the code, as the state can't go on."""
        at = self.base[state] + code
        begins = (self.owner[at] != state) | (state == ROOT)
        return np.where(begins, self.first[code], self.target[at]), begins


def build(codes: list[int], width: int) -> Automaton:
    return Automaton(suffix_automaton(codes), width)


def phrases(codes: np.ndarray, starts: np.ndarray, automaton: Automaton, segment: int = SEGMENT) -> np.ndarray:
    """The number of phrases of each text."""
    segs = -(-np.diff(starts) // segment)
    text = np.repeat(np.arange(len(segs)), segs)
    if not len(text):
        return np.zeros(len(segs), np.int64)
    number = np.arange(len(text)) - np.repeat(np.cumsum(segs) - segs, segs)
    begin, stop = starts[text] + number * segment, starts[text + 1]
    end = np.minimum(begin + segment, stop)
    mark = np.zeros(len(codes) + 1, dtype=bool)  # where the segments' own walks begin phrases
    own_leave = _walk(codes, automaton, begin, end, stop, mark)
    upto = np.concatenate(([0], np.cumsum(mark)))
    count, enter, leave = upto[end] - upto[begin], begin.copy(), own_leave.copy()
    todo = np.flatnonzero(number > 0)
    while len(todo := todo[enter[todo] != leave[todo - 1]]):
        enter[todo] = leave[todo - 1]
        fresh, met, out = _rewalk(codes, automaton, enter[todo], end[todo], stop[todo], mark)
        count[todo] = fresh + np.where(met >= 0, upto[end[todo]] - upto[met], 0)
        leave[todo] = np.where(met >= 0, own_leave[todo], out)
        todo = todo + 1
        todo = todo[todo < len(text)]
        todo = todo[number[todo] > 0]
    return np.bincount(text, weights=count, minlength=len(segs)).astype(np.int64)


def _walk(codes: np.ndarray, automaton: Automaton, begin: np.ndarray, end: np.ndarray, stop: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Marks the phrases that walks from begin to end begin; returns where each begins its first phrase beyond (or its text's stop)."""
    order = np.argsort(begin - end, kind="stable")  # longest first
    at, size = begin[order], (end - begin)[order]
    active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")  # segments longer than t
    state = np.zeros(len(at), np.int32)
    for t, k in enumerate(active.tolist()):
        place = at[:k] + t
        state[:k], begins = automaton.step(state[:k], codes[place])
        mark[place[begins]] = True
    leave = end.copy()
    some = np.flatnonzero(end[order] < stop[order])
    who, state, place = order[some], state[some], end[order[some]]
    while len(who):
        state, begins = automaton.step(state, codes[place])
        leave[who[begins]] = place[begins]
        place += 1
        leave[who[~begins]] = place[~begins]
        on = ~begins & (place < stop[who])
        who, state, place = who[on], state[on], place[on]
    return leave


def _rewalk(codes: np.ndarray, automaton: Automaton, enter: np.ndarray, end: np.ndarray, stop: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For walks from enter: the phrases before they meet a marked one in their segment, where they do (-1: nowhere), and where they leave."""
    fresh, met, out = np.zeros(len(enter), np.int64), np.full(len(enter), -1, np.int64), enter.copy()
    who = np.flatnonzero(enter < end)
    state, place = np.zeros(len(who), np.int32), enter[who]
    while len(who) > FEW:
        state, begins = automaton.step(state, codes[place])
        inside = place < end[who]
        meets = begins & inside & mark[place]
        met[who[meets]] = place[meets]
        fresh[who[begins & inside & ~meets]] += 1
        out[who] = place
        on = ~meets & ~(begins & ~inside)
        who, state, place = who[on], state[on], place[on] + 1
        out[who] = place
        on = place < stop[who]
        who, state, place = who[on], state[on], place[on]
    first, base, owner, target, code, marked = map(memoryview, (automaton.first, automaton.base, automaton.owner, automaton.target, codes, mark))
    for w, s, p in zip(who.tolist(), state.tolist(), place.tolist(), strict=True):  # one after the other, where arrays don't pay
        last, final = int(end[w]), int(stop[w])
        while p < final:
            at = base[s] + code[p]
            if s == ROOT or owner[at] != s:
                if p >= last:
                    break
                if marked[p]:
                    met[w] = p
                    break
                fresh[w] += 1
                s = first[code[p]]
            else:
                s = target[at]
            p += 1
        out[w] = p
    return fresh, met, out


# ---------------------------------------------------------------- the model
class Model:
    """Languages with their automata, over one alphabet."""

    def __init__(self, alphabet: str = "", languages: list[str] | None = None, automata: list[Automaton] | None = None, sizes: list[int] | None = None):
        self.alphabet, self.languages, self.automata = alphabet, languages or [], automata or []
        self.bits = np.log2(np.maximum(2, np.array(sizes or [], dtype=float))) + EACH
        self._table: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None}

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        if self._table is None:
            self._table = code_table(self.alphabet)
        for i, j in chunks((len(t or "") for t in texts), AT_ONCE):
            codes, starts = encode(texts[i:j], self._table)
            if not len(codes):
                continue
            n = np.diff(starts)
            letters = np.zeros(len(codes) + 1, np.int64)
            np.cumsum(codes != BLANK, out=letters[1:])
            lettered = np.diff(letters[starts]) > 0
            rate = np.stack([phrases(codes, starts, a) for a in self.automata], axis=1) * self.bits / np.maximum(n, 1)[:, None]
            best = rate.argmin(axis=1)
            low = rate[np.arange(len(n)), best]
            share = 1 / np.exp2(-8 * (rate - low[:, None])).sum(axis=1)
            for k in np.flatnonzero(lettered):
                names[i + k], scores[i + k] = self.languages[best[k]], float(share[k])
        return names, scores


def learn(spark: SparkSession, texts: dict[str, str]) -> Model:
    """A model of each language's labelled text; a task builds an automaton."""
    alphabet = "".join(sorted({ch for t in texts.values() for ch in t.lower() if ch.isalpha()}))
    table = code_table(alphabet)
    names = [name for name in sorted(texts) if (encode([texts[name]], table)[0] != BLANK).any()]
    if not names:
        return Model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                codes = encode([t], code_table(alphabet))[0].tolist()
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([len(codes)], pa.int64()), pa.array([pickle.dumps(build(codes, len(alphabet) + 2))], pa.binary())], ["i", "n", "automaton"])

    import pickle

    rows = spark.createDataFrame([(i, texts[name]) for i, name in enumerate(names)], "i int, text string").repartition(len(names), "i")
    made = sorted(rows.mapInArrow(thrifty(run), "i int, n long, automaton binary").collect())
    return Model(alphabet, names, [pickle.loads(r["automaton"]) for r in made], [r["n"] for r in made])


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(3).cast("long"))


def fit(labelled: DataFrame) -> Model:
    """A model from labelled (doc_id, text, lang): a bounded sample that depends on ids and labels alone."""
    rows = labelled.where("lang is not null and text is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.length("text") > 0)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not sizes:
        return Model()
    spark = labelled.sparkSession
    bounds = [(k, min(1 << 30, (TRAIN_DOCS << 30) // n), max(PASSAGE, PASSAGE * TRAIN_DOCS // n)) for k, n in sizes.items()]
    bound = F.broadcast(spark.createDataFrame(bounds, "lang string, most long, size int"))
    taken = rows.withColumn("draw", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))).join(bound, "lang").where("draw < most")
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.lit(1), F.length("text") - F.col("size") + 1)).cast("int") + 1
    # a row that comes again and again gives one passage
    passages = taken.select("lang", "draw", F.col("text").substr(place, F.col("size")).alias("text")).distinct().collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(passages, key=lambda r: (r["lang"], r["draw"], r["text"])):
        texts.setdefault(r["lang"], []).append(r["text"])
    return learn(spark, {k: " ".join(v) for k, v in texts.items()})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of docs (doc_id, text); nothing but the text is looked at."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, scores = held.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(thrifty(run), "doc_id long, lang_pred string, score double")


def held_out(docs: DataFrame) -> DataFrame:
    """Learns from the folds other than 1 and predicts every document: (doc_id, held_out, lang_pred, score)."""
    model = fit(docs.where(F.coalesce(fold(F.col("doc_id")), F.lit(1).cast("long")) != 1))
    return identify(docs, model).select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
