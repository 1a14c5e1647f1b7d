import functools
import hashlib
import io
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from metalake.llm import ann, chat, jaccard, langid, mixing, ogg, packing, quality, suffix_dedup, warc
from metalake.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component int, tokens int, rate string, keep string, g int"


def text(seed, n, words=400):
    r = random.Random(seed)
    vocab = [f"w{i}x" for i in range(words)]
    return " ".join(r.choice(vocab) for _ in range(n))


@functools.cache
def corpus():
    """Nulls, empty and long texts, exact and near copies, shared passages, a frequent line, repeated rows and clashing columns."""
    base, passage, line = text(1, 200), text(2, 60), "the very same line of text that comes again in document after document of them"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "short one"), (5, base), (6, base), (7, base.replace(" w7x ", " zz ", 2)), (7, base.replace(" w7x ", " zz ", 2)), (None, base), (None, "alone and without id"), (8, "a" * 500), (9, "ab" * 400), (10, text(3, 30000))]
    rows += [(20 + i, text(100 + i, 80, 4000) + " " + passage + " " + text(200 + i, 70, 4000)) for i in range(12)]
    rows += [(100 + i, f"{line}. {text(300 + i, 25, 5000)}\n{line} {text(400 + i, 25, 5000)}") for i in range(90)]
    words = text(9, 300, 5000).split()
    for i in range(15):  # a chain of near copies
        rows.append((300 + i, " ".join(words)))
        words[20 * i : 20 * i + 6] = [f"n{i}m{k}" for k in range(6)]
    rows += [(400, "Élan\x00vital " * 30), (401, "x Élan\x00vital " * 30), (402, "one two three four five"), (403, "ONE two\x0bthree four Five")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", None, 0, 1, 2, "r", "k", 3) for i, t in corpus()], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_ogg(docs, empty):
    for n in (0, 1, 191, 192, 193, 3840, 3841, 70_000, 300_000):
        raw = random.Random(n).randbytes(n)
        payload, size, seconds, streams = ogg.decode(m := ogg.encode(raw))
        assert payload[:n] == raw and size == n and len(payload) % 192 == 0 and seconds == len(payload) / ogg.RATE and set(streams) == {1, 2}
        broken = bytearray(m)
        broken[len(m) // 2] ^= 1
        with pytest.raises(ValueError):
            ogg.decode(bytes(broken))
    lone = ogg.paginate([(b"x" * 200_000, 5), (b"", 6), (b"y" * 255, 7)], 9)
    assert ogg.read(b"".join(lone))[9].packets == [b"x" * 200_000, b"", b"y" * 255]
    crc = 0
    for byte in b"OggS page":  # bit by bit
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ (0x04C11DB7 if crc >> 31 else 0)) & 0xFFFFFFFF
    assert ogg.page_checksum(b"OggS page") == crc
    got = ogg.describe(ogg.to_media(docs)).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"]) for r in got) == sorted((i or -1, len((t or "").encode())) for i, t in corpus())
    assert all(r["payload_bytes"] > 0 and r["payload_bytes"] % 192 == 0 for r in got)
    assert ogg.describe(ogg.to_media(empty)).count() == 0


def test_warc(spark):
    big = "<p>é</p>" * 40
    rows = [(5, "u", big), (3, None, big), (3, "v", big), (9, "u", None), (10, "u", ""), (11, "u", "x" * 99), (12, "u", "x" * 99), (13, "a\r\nb", "x" * 100), (14, "u", "x" * 100), (None, "u", big)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.round_trip(spark, pages, payloads=True).collect()
    kinds = sorted((r["page_id"] is None, r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in got)
    assert kinds == sorted([(False, 3, "response", None), (False, 3, "revisit", 3), (False, 5, "revisit", 3), (False, 9, "response", None), (False, 10, "response", None), (False, 11, "response", None), (False, 12, "response", None), (False, 13, "response", None), (False, 14, "revisit", 13), (True, 0, "revisit", 3)], key=str) or len(got) == len(rows)
    for r in got:
        want = {hashlib.sha256((h or "").encode()).hexdigest(): len((h or "").encode()) for _, _, h in rows}
        assert want[r["payload_digest"]] == r["payload_bytes"]
    assert [(r["record_type"], r["refers_to"]) for r in got if r["page_id"] is None] == [("revisit", 3)]
    assert sorted((r["record_type"], r["refers_to"]) for r in got if r["page_id"] == 3) == [("response", None), ("revisit", 3)]
    assert warc.round_trip(spark, pages.where("false")).count() == 0


def test_zip64():
    for wide in (False, True):
        out = io.BytesIO()
        z = warc.ZipWriter(out, zip64=wide)
        for name, data in (("a", b"abc" * 100), ("b/ü", b""), ("c", b"0123456789")):
            z.begin(name)
            z.write(data)
            z.end()
        z.close()
        raw = out.getvalue()
        a = warc.ZipArchive(io.BytesIO(raw), len(raw))
        assert a.read("a") == b"abc" * 100 and a.read("b/ü") == b"" and a.read("c", 3, 4) == b"3456"
        import zipfile

        assert zipfile.ZipFile(io.BytesIO(raw)).read("c") == b"0123456789"
        with pytest.raises(ValueError):
            a.read("c", 5, 9)
        with pytest.raises(ValueError):
            warc.ZipArchive(io.BytesIO(raw[:-5]), len(raw) - 5)


def remove(rows):
    seen, out = set(), {}
    for i, t in sorted({(i, t) for i, t in rows if i is not None}, key=lambda r: r[0]):
        raw = (t or "").encode()
        mark = bytearray(len(raw))
        for s in range(len(raw) - 99):
            w = raw[s : s + 100]
            if w in seen:
                mark[s : s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, m in zip(raw, mark, strict=True) if not m)
        out[i] = (len(raw), sum(mark), sum(1 for k in range(len(mark)) if mark[k] and (k == 0 or not mark[k - 1])), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(docs, empty):
    want = remove(corpus())
    got = suffix_dedup.digest(docs).collect()
    assert len(got) == len(corpus())
    for r in got:
        if r["doc_id"] is not None:
            assert tuple(r)[1:] == want[r["doc_id"]], r["doc_id"]
        else:
            assert r["n_removed"] == 0
    assert suffix_dedup.digest(empty).count() == 0
    left = suffix_dedup.strip(docs)
    assert left.columns == docs.columns and left.where("trim(text) = ''").count() == 0


def test_suffix_dedup_hot_grams(spark):
    """More than 1,024 different runs under one gram, and many copies of one text, in several partitions: only suffix arrays find what goes."""
    line = "this is the one line that stands in the midst of every text."
    rows = [(i, text(1000 + i, 12, 50) + " " + line + " " + text(5000 + i % 1300, 12, 50)) for i in range(1500)]
    rows += [(9000 + i, text(77, 60)) for i in range(40)]
    grams = defaultdict(set)
    for _, t in rows:
        r = suffix_dedup.runs([t.encode()])
        for g, s in zip(r["gram"].tolist(), r["same"].tolist(), strict=True):
            grams[g].add(s)
    assert max(map(len, grams.values())) >= 1024
    want = remove(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.digest(df).collect()} == want
    assert suffix_dedup.digest(df.coalesce(1)).where("n_removed > 0").count() == sum(1 for w in want.values() if w[1])


def test_suffix_dedup_hashes_only_deal(monkeypatch):
    """With hashes that tell hardly anything apart, the result is the same: bytes decide."""
    rows = [(i, t) for i, t in corpus() if i is not None and len(t or "") < 3000][:60]
    rows += [(1000 + i, t) for i, t in rows[:20]]
    plain = suffix_dedup.window_hashes
    places = lambda doc, s, e: [(int(d), p) for d, a, b in zip(doc, s, e, strict=True) for p in range(a, b)]
    want = remove([(i, t) for i, t in rows])
    texts = [(i, (t or "").encode()) for i, t in sorted(rows)]
    for weak in (lambda d: plain(d), lambda d: tuple(h % np.uint64(3) for h in plain(d))):
        monkeypatch.setattr(suffix_dedup, "window_hashes", weak)
        r = suffix_dedup.runs([t for _, t in texts])
        ids = np.array([i for i, _ in texts])[r["doc"]]
        place = r["base"][r["doc"]] + r["first"]
        count = r["last"] - r["first"] + 1
        again, d, f = suffix_dedup._again(r["gram"], r["same"], ids, r["first"], count, r["data"], place)
        left = np.flatnonzero(~again)
        run, at = suffix_dedup._expand(place[left], count[left])
        more = suffix_dedup.SuffixLevels().add(r["data"], at, ids[left][run], r["first"][left][run] + at - place[left][run])
        gone = defaultdict(set)
        for i, p in places(np.concatenate((d, more[0])), np.concatenate((f, more[1])), np.concatenate((f, more[1])) + 100):
            gone[i].add(p)
        assert all(len(gone[i]) == want[i][1] for i, _ in rows)


def test_suffix_hashes():
    r = random.Random(4)
    data = np.frombuffer(bytes(r.choice(b"ab") for _ in range(400)) * 2, np.uint8)
    gram, window = suffix_dedup.window_hashes(data)
    for size, h in ((24, gram), (100, window)):
        assert len(h) == len(data) - size + 1
        strings = defaultdict(set)
        for i, x in enumerate(h.tolist()):
            strings[data[i : i + size].tobytes()].add(x)
        assert all(len(x) == 1 for x in strings.values()) and len(set.union(*strings.values())) == len(strings)


@pytest.mark.parametrize("mixed", [False, True])
def test_suffix_levels(mixed, monkeypatch):
    """Batches in order and in any order: a window goes if and only if an equal one stands earlier; repeated places are one."""
    monkeypatch.setattr(suffix_dedup, "SCAN", 50)
    r = random.Random(5)
    text = bytes(r.choice(b"ab\0") for _ in range(3000)) * 2
    data = np.frombuffer(text, np.uint8)
    spots = [np.arange(i, min(i + 257, len(text) - 99)) for i in range(0, len(text) - 99, 257)]
    spots += spots[3:6]
    if mixed:
        r.shuffle(spots)
    levels, gone = suffix_dedup.SuffixLevels(), set()
    for at in spots:
        d, f = levels.add(data[at[0] : at[-1] + 100], at - at[0], at // 1000, at % 1000)
        gone |= set(zip(d.tolist(), f.tolist(), strict=True))
    seen, want = set(), set()
    for i in range(len(text) - 99):
        if text[i : i + 100] in seen:
            want.add((i // 1000, i % 1000))
        seen.add(text[i : i + 100])
    assert gone == want
    assert len(levels.levels) < 8 and sum(len(x.at) for x in levels.levels) == len(seen)
    for x in levels.levels:
        s = suffix_dedup._strings(x.data, x.at)
        assert np.all(s[1:] > s[:-1])


@pytest.mark.parametrize("n", [1, 2, 255, 256, 5000])
def test_suffix_sort(n):
    """Few first bytes tell the strings apart, many are equal: the order is that of a plain stable sort of the bytes."""
    r = random.Random(n)
    data = np.frombuffer(bytes(r.choice(b"a\0\xff") for _ in range(150)) * 9 + b"a" * 400 + bytes(r.randrange(256) for _ in range(3000)), np.uint8)
    at = np.array([r.randrange(len(data) - 99) for _ in range(n - 1)] + [len(data) - 100])
    order, strings = suffix_dedup._sorted(data, at)
    whole = [data[i : i + 100].tobytes() for i in at]
    assert order.tolist() == sorted(range(n), key=whole.__getitem__)
    assert [data[i : i + 100].tobytes() for i in at[order]] == [s.ljust(100, b"\0") for s in strings.tolist()]
    same = [whole[i] == whole[j] for i, j in itertools.pairwise(order)]
    assert suffix_dedup._same(strings[1:], strings[:-1]).tolist() == same


def test_suffix_places():
    """Places that 63 bits hold and those that they don't: by document, then start."""
    r = random.Random(6)
    for ids in ([5], range(-3, 40), [-(1 << 63), -1, 0, (1 << 63) - 1], [(1 << 63) - 9, (1 << 63) - 1], [-(1 << 62), (1 << 62) - 1]):
        for most in (0, 1, 1 << 20, (1 << 31) - 1):
            rows = [(r.choice(ids), r.randint(0, most)) for _ in range(300)]
            for kind in (np.int32, np.int64):
                doc, start = np.array([d for d, _ in rows], np.int64), np.array([f for _, f in rows], kind)
                order = suffix_dedup._by_place(doc, start)
                assert [rows[i] for i in order] == sorted(rows)
    assert not len(suffix_dedup._by_place(doc[:0], start[:0]))


def test_suffix_levels_scan_once(monkeypatch):
    """A batch that merges with the level it was looked up in isn't looked up there again."""
    scans, plain = [], suffix_dedup.Level.scan
    monkeypatch.setattr(suffix_dedup.Level, "scan", lambda self, strings: scans.append(len(strings)) or plain(self, strings))
    r = random.Random(8)
    data = np.frombuffer(bytes(r.choice(b"abc") for _ in range(1000)), np.uint8)
    levels, doc = suffix_dedup.SuffixLevels(), np.zeros(450, np.int64)
    for i in (0, 450):
        levels.add(data[i : i + 549], np.arange(450), doc, np.arange(i, i + 450))
    assert len(levels.levels) == 1 and len(levels.levels[0].at) == 900 and scans == [450]
    s = suffix_dedup._strings(levels.levels[0].data, levels.levels[0].at)
    assert np.all(s[1:] > s[:-1])
    assert levels.levels[0].start.tolist() == sorted(range(900), key=lambda i: data[i : i + 100].tobytes())


def brute(rows):
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
            sets[i].append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset())
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (max(map(len, s)), find(i)) for i, s in sets.items()}


def test_jaccard(docs, empty):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(docs).collect()}
    assert got == brute(corpus())
    assert len({got[300 + i][1] for i in range(15)}) < 15
    assert jaccard.link_documents(empty).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (None, 3), (7, 8)], "a long, b long")
    got = dict(components(links).collect())
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(1, 50))
    assert components(links.where("false")).count() == 0


def check_tiling(pieces, window=1024):
    """Each id of each document lies in one piece, and each sequence is full or a power of two, without a gap."""
    by, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p["doc_id"]].append((p["start"], p["length"], p["doc_tokens"]))
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
    for s in seqs.values():
        total = sum(n for _, n in s)
        assert total <= window and total & (total - 1) == 0
        at = 0
        for o, n in sorted(s):
            assert o == at and n > 0
            at += n
    return by


def test_packing(docs, empty, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, ref = packing.Tokens(path), Tokenizer.from_file(path)
    r = random.Random(3)
    odd = ["".join(r.choice([*" \n\t abé,.'s1²½  \x1c\x85中ß<|>", "<|endoftext|>", "<|endoftext", "endoftext|>"]) for _ in range(r.randrange(60))) for _ in range(800)] + [t or "" for _, t in corpus()]
    assert all(own.ids(t).tolist() == ref.encode(t, add_special_tokens=False).ids for t in odd)
    assert own.ids("a <|endoftext|> b").tolist().count(50256) == 1
    blanks = ["".join(r.choice([*" \n\t\x85\xa0\u1680\u2003\u2028\u202f\u3000\u180e\u200b\x1c\x1fa1'é.", "  ", "\n\n"]) for _ in range(r.randrange(16))) for _ in range(2000)]
    monkeypatch.setattr(packing, "LONG", 5)  # texts are encoded in parts, and these are the same
    assert all(own.ids(t).tolist() == ref.encode(t, add_special_tokens=False).ids for t in odd + blanks)
    pieces = packing.pack(docs, path).collect()
    by = check_tiling(pieces)
    for i, found in by.items():  # repeated rows tile as often as they come
        rows = sorted(len(own.ids(t or "")) + 1 for d, t in corpus() if d == i)
        assert sorted(n for s, _, n in found if s == 0) == rows
        for n in set(rows):
            covered = np.zeros(n, int)
            for s, k, m in found:
                if m == n:
                    covered[s : s + k] += 1
            assert (covered == rows.count(n)).all()
    assert set(by) == {i for i, _ in corpus()}
    for p in pieces:
        if p["doc_id"] in (5, 10):
            ids = np.append(own.ids(dict(corpus())[p["doc_id"]]), 0).astype("<u4")
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
    assert packing.pack(empty, path).count() == 0


def bm25(stats, docs, q, d):
    """The score of document d for the query's distinct terms, by the formula."""
    tf = dict(zip(docs[d][0].tolist(), docs[d][1].tolist(), strict=True))
    long = sum(tf.values())
    return sum(np.log(1 + (stats.n - stats.df[t] + 0.5) / (stats.df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * long / stats.mean)) for t in docs[q][0].tolist() if t in tf)


def test_packing_scores(monkeypatch):
    r = random.Random(6)
    docs = [packing.count_terms(np.array([int(300 * r.random() ** 3) for _ in range(r.randrange(0, 80))], np.uint16)) for _ in range(120)]
    stats = packing.Stats(120, float(np.mean([c.sum() for _, c in docs])), np.bincount(np.concatenate([t for t, _ in docs]), minlength=400))
    for common in (0, 2, 16, 10**6):  # by postings alone, by both ways, by the product alone
        monkeypatch.setattr(packing, "COMMON", common)
        got = packing.shard_scores(stats, docs)
        assert all(abs(got[q, d] - (bm25(stats, docs, q, d) if q != d else 0)) < 1e-3 for q in range(120) for d in range(120))


def greedy(lengths, keys, scores, window):
    """The windows by a plainer way: lists of documents in the order of placing, the cut one in both."""
    unused, out, room, seed = set(range(len(lengths))), [], 0, None
    while unused:
        if not room:
            d = min(unused)
        else:
            free = [x for x in unused if keys[x] not in {keys[y] for y in out[-1]}]
            best = max(free, key=lambda x: (scores[seed][x], -x), default=min(unused))
            d = best if not free or scores[seed][best] > 0 else min(free)
        unused.remove(d)
        left = lengths[d]
        while left:
            if not room:
                out.append([])
                room, seed = window, d
            out[-1].append(d)
            k = min(left, room)
            left, room = left - k, room - k
    return out


def test_packing_fills_windows_greedily():
    r = np.random.default_rng(4)
    for trial in range(40):
        n = int(r.integers(1, 60))
        lengths, keys = r.integers(1, 50, n), r.integers(0, max(1, n // 2), n)
        scores = np.where(r.random((n, n)) < 0.4, 0, r.integers(0, 9, (n, n))).astype(np.float32)
        got = packing.fill(lengths, keys, scores, 32)
        want = greedy(lengths.tolist(), keys.tolist(), scores.tolist(), 32)
        total = int(lengths.sum())
        for q in range(total // 32):
            assert [p[0] for p in got if p[3] == q] == want[q]
        rest = [sum(p[2] for p in got if p[3] == q) for q in sorted({p[3] for p in got}) if q >= total // 32]
        assert sum(rest) == total % 32 and all(x & (x - 1) == 0 for x in rest)


def twins():
    """Texts of which 2 i and 2 i + 1 share rare words with each other alone."""
    r = random.Random(5)
    words = sorted({"".join(r.choice("bcdfgklmnprstv") + r.choice("aeiou") for _ in range(4)) for _ in range(900)})
    return [(i, " ".join(r.choice(words[5 * (i // 2) : 5 * (i // 2) + 5]) for _ in range(60))) for i in range(300)]


def test_packing_order_brings_neighbours_together():
    """Of twins dealt to 14 shards by the order, most are in one."""
    import public_tokenizers

    own = packing.Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    docs = [packing.count_terms(d) for d in (own.ids(t) for _, t in twins())]
    stats = packing.Stats(300, float(np.mean([c.sum() for _, c in docs])), np.bincount(np.concatenate([t for t, _ in docs]), minlength=50257))
    router = packing.Router(stats, docs[::8], [])
    shard = np.empty(300, int)
    shard[np.argsort(router.places_of(docs, np.arange(300), np.zeros(300, np.uint64)), kind="stable")] = np.arange(300) * 14 // 300
    assert sum(shard[::2] == shard[1::2]) >= 105  # dealt by a hash: about 11


def test_packing_finds_neighbours(spark):
    """Whatever the partitions, twins meet. Copies of one text don't, though they are a third of all rows, until nothing else is left."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    frame = spark.createDataFrame(twins(), "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for parts in (2, 7, 3):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            seen.append(sorted(map(tuple, packing.pack(frame, path).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]
    where = defaultdict(set)
    for p in seen[0]:
        where[p[0]].add(p[5])
    assert sum(bool(where[i] & where[i + 1]) for i in range(0, 300, 2)) >= 100
    rows = [(i, twins()[i % 60][1]) for i in range(300)] + [(1000 + i, "a third of all rows " * 12) for i in range(150)]
    seqs = defaultdict(set)
    for p in packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), path).collect():
        seqs[p["sequence_id"]].add((dict(rows)[p["doc_id"]], p["doc_id"]))
    again = [q for q, s in sorted(seqs.items()) if len(s) != len({t for t, _ in s})]  # more copies than windows: the last windows have to repeat
    assert len(again) <= len(seqs) / 4 and again[0] >= sorted(seqs)[-len(again) - 2]


def test_chat(spark):
    e = spark.createDataFrame([
        (1, 0, "message", "user", "hi :\\ ### </turn>", None), (1, 1, "message", "assistant", "", None), (1, 2, "delta", None, "a", None), (1, 3, "delta", None, "b", None), (1, 4, "regenerate", None, None, None),
        (1, 5, "delta", None, "c#", None), (1, 6, "delta", None, "###\n", None), (1, 7, "message", "user", "x", None), (1, 9, "edit", None, "y</turn>\n", 7), (2, 1, "delta", "user", "lost", None), (None, 1, "message", None, None, None), (3, 1, "message", "Assistant: x", "é", None), (3, 1, "message", "Assistant: x", "é", None),
    ], "conv_id long, seq long, op string, role string, text string, target long")
    folded = chat.fold(e)
    turns = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in folded.collect()}
    assert turns == {1: [("user", "hi :\\ ### </turn>"), ("assistant", "c####\n"), ("user", "y</turn>\n")], 2: [], None: [("", "")], 3: [("Assistant: x", "é")] * 2}
    shown = chat.render(folded)
    back = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in shown.select("conv_id", chat.parse(F.col("formatted")).alias("turns")).collect()}
    assert back == turns
    got = {r["conv_id"]: r for r in chat.read_back(shown).collect()}
    assert got[1]["loss_chars"] == 6 and got[1]["loss_sha256"] == hashlib.sha256(b"c####\n").hexdigest() and got[2]["n_turns"] == 0
    assert chat.read_back(chat.render(chat.fold(e.where("false")))).count() == 0


def test_langid(spark, docs, empty):
    r = random.Random(1)
    make = lambda letters, n: " ".join("".join(r.choice(letters) for _ in range(r.randrange(3, 8))) for _ in range(n))
    rows = [(i, make("abcde" if i % 2 else "defgh", 60), "aa" if i % 2 else "dd", "s") for i in range(120)] + [(500, None, "aa", "s"), (501, "12 !", "aa", "s"), (None, "abc cab", "aa", "s"), (502, "abba cab", None, "s")]
    got = langid.held_out(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")).collect()
    by = {x["doc_id"]: x for x in got}
    assert sum(by[i]["lang_pred"] == ("aa" if i % 2 else "dd") for i in range(120)) == 120
    assert by[500]["lang_pred"] == by[501]["lang_pred"] == "und" and by[502]["lang_pred"] == "aa" and all(0 <= x["score"] <= 1 for x in got)
    assert by[3]["held_out"] == (zlib.crc32(b"3") % 3 == 1)
    assert langid.held_out(empty).count() == 0


def count_phrases(s, t):
    n = i = 0
    while i < len(s):
        k = i + 1
        while k < len(s) and s[i : k + 1] in t:
            k += 1
        n, i = n + 1, k
    return n


@pytest.mark.parametrize("few", [0, 64])
def test_langid_parses_whole_texts(monkeypatch, few):
    """Phrases are exactly those of one walk through the text, wherever it is cut for the arrays' sake."""
    monkeypatch.setattr(langid, "FEW", few)
    r = random.Random(3)
    table = langid.code_table("abcdefghij")
    for trial in range(24):
        letters = "abc" if trial % 2 else "abcdefgh"
        t = "".join(r.choice(letters[:-1]) for _ in range(r.randrange(1, 300)))
        automaton = langid.build(langid.encode([t], table)[0].tolist(), 12)
        texts = ["".join(r.choice(letters + "j") for _ in range(r.randrange(0, 200))) for _ in range(12)] + ["a" * 100, "ab" * 70, t + "j" + t]
        codes, starts = langid.encode(texts, table)
        for segment in (1, 2, 7, 512):
            assert langid.phrases(codes, starts, automaton, segment).tolist() == [count_phrases(s, t) for s in texts]


def test_langid_many_scripts_and_languages(spark):
    """Two languages with 3000 ideographs, Cyrillic, Latin with accents, and 80 languages of one alphabet: 0.95 of each one's held-out texts."""
    r = random.Random(8)
    han = [chr(0x4E00 + i) for i in range(3000)]
    scripts = {"zh": han, "ja": han[1000:] + [chr(0x3041 + i) for i in range(80)], "ru": [chr(0x430 + i) for i in range(32)], "la": list("abcdefghijklmnopqrstuvwxyzàâçéèêëîï")}
    scripts |= {f"x{i:02}": list("abcdefghijklmnopqrstuvwxyz") for i in range(80)}
    rows = []
    for name, letters in scripts.items():
        words = ["".join(r.choice(letters) for _ in range(r.randrange(2, 3 if len(letters) > 99 else 8))) for _ in range(300)]
        rows += [(name, " ".join(words[int(300 * r.random() ** 2)] for _ in range(60))) for _ in range(40)]
    rows = [(i, t, name) for i, (name, t) in enumerate(rows)]
    got = langid.held_out(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)).where("held_out").collect()
    right, seen = defaultdict(int), defaultdict(int)
    for x in got:
        name = rows[x["doc_id"]][2]
        seen[name] += 1
        right[name] += x["lang_pred"] == name
    assert len(seen) == 84 and all(right[name] >= 0.95 * seen[name] for name in seen)


def test_langid_uneven_samples(spark):
    """A language with one short labelled text doesn't win the others' texts."""
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 8))) for _ in range(200)]
    model = langid.learn(spark, {"big": " ".join(r.choice(words) for _ in range(5000)), "tiny": "abcdefghijklmnop", "none": " 12 "})
    assert model.languages == ["big", "tiny"]
    names, scores = model.predict([" ".join(r.choice(words) for _ in range(40)) for _ in range(50)] + [None, "", "1 2", "é"])
    assert names[:50] == ["big"] * 50 and names[50:53] == ["und"] * 3 and scores[50:53] == [0.0] * 3 and all(0 <= x <= 1 for x in scores)


def test_quality(spark, docs, empty):
    r = random.Random(2)
    rows = []
    for i in range(900):
        words = [f"w{r.randrange(300)}" for _ in range(60)]
        words = ["".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words]
        grade = i % 3
        if grade == 0:
            words[5:9] = ["vile", "awful", "vile", "nasty"]
        if grade == 1:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words), 1 if grade == 2 else 0, 1 if grade == 0 else 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    model = quality.fit(df.select("doc_id", "text"), df.select("doc_id", "quality", "toxic"))
    got = {x["doc_id"]: x for x in quality.grade(df.select("doc_id", "text"), model).collect()}
    assert sum(got[i]["keep"] for i in range(0, 900, 3)) < 10 and sum(got[i]["keep"] for i in range(2, 900, 3)) > 285 and sum(got[i]["keep"] for i in range(1, 900, 3)) < 30
    assert all(model.thresholds[0] < model.thresholds[1] and g["p_at_least_low"] >= g["p_good"] for g in got.values())
    odd = quality.grade(docs, model)
    assert odd.count() == len(corpus()) and quality.grade(empty, model).count() == 0
    assert quality.fit(docs, df.select("doc_id", "quality", "toxic").where("false")) is None and quality.grade(docs, None).where("keep").count() == len(corpus())


def test_quality_gradient():
    r = np.random.default_rng(3)
    starts = np.concatenate(([0], np.cumsum(r.integers(0, 6, 40))))
    slots, x, grades, weight = r.integers(0, 9, int(starts[-1])), r.normal(size=(40, 3)), r.integers(0, 3, 40), r.random(40)
    p = np.concatenate((r.normal(size=12) / 2, [-0.7, 0.2]))
    value, grad = quality.loss(p, slots, starts, x, grades, weight)
    z = np.array([p[slots[a:b]].sum() for a, b in itertools.pairwise(starts)]) + x @ p[9:12]
    s0, s1 = 1 / (1 + np.exp(z - p[12])), 1 / (1 + np.exp(z - p[12] - np.exp(p[13])))
    by_hand = -sum(w * np.log([a, b - a, 1 - b][g]) for w, a, b, g in zip(weight, s0, s1, grades, strict=True)) + quality.RIDGE * (p[:12] ** 2).sum() / 20
    assert abs(value - by_hand) < 1e-9
    for k in range(len(p)):
        step = np.zeros(len(p))
        step[k] = 1e-6
        up, down = (quality.loss(p + s, slots, starts, x, grades, weight)[0] for s in (step, -step))
        assert abs((up - down) / 2e-6 - grad[k]) < 1e-5


def test_quality_repeated_rows(spark):
    """A document that comes 400 times counts once."""
    r = random.Random(7)
    rows = [(i, " ".join(r.choice(["good", "words", "here", "again"] if i % 2 else ["%%", "bad", "stuff", "here"]) for _ in range(30)), i % 2, 0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    labels = df.select("doc_id", "quality", "toxic")
    once = quality.fit(df, labels)
    often = quality.fit(df.union(spark.createDataFrame([rows[3]] * 400, df.schema)), labels.union(labels))
    assert np.array_equal(once.thresholds, often.thresholds) and np.array_equal(once.weights, often.weights) and once.least == often.least


def test_mixing_against_numpy(spark):
    """Posteriors and rates are those of naive Bayes and projected gradient descent written anew."""
    r = random.Random(12)
    rows = [(i, " ".join(r.choice(["ab", "cd", "ef"] if i % 3 else ["ab", "xy", "zw"]) for _ in range(r.randrange(0, 30))), "p" if i % 3 else "q") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = df.where("doc_id % 2 = 0").select("doc_id", F.col("lang").alias("domain"))
    again = labelled.union(labelled.where("doc_id < 10"))
    names, priors, logs = mixing.classifier(df.union(df.where("doc_id = 4")), again)
    assert (names, priors, logs) == mixing.classifier(df, labelled)
    slot = {w: (x - 1) for w, x in spark.createDataFrame([(w,) for w in ("ab", "cd", "ef", "xy", "zw")], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(1 << mixing.BITS).cast("long")) + 1).collect()}
    count = np.full((2, 1 << mixing.BITS), mixing.SMOOTH)
    for i, t, lang in rows[::2]:
        for w in t.split():
            count[names.index(lang), slot[w]] += 1
    assert np.allclose(np.log(count / count.sum(axis=1, keepdims=True)), logs)
    words = np.array([len(t.split()) for _, t, _ in rows], float)
    mean = np.array([[sum(round(logs[k][slot[w]], 5) for w in t.split()) / max(1, len(t.split())) for k in (0, 1)] for _, t, _ in rows])
    odds = np.exp(np.array(priors) + mixing.SHARP * mean)
    post = odds / odds.sum(axis=1, keepdims=True)
    targets, rate = np.array([0.3, 0.7]) * words.sum(), np.ones(150)
    overlap = (post * words[:, None]).T @ post / words.sum() + 1e-6 * np.eye(2)
    for _ in range(mixing.STEPS):
        off = (post.T @ (words * rate) - targets) / words.sum()
        if np.abs(off).max() < mixing.CLOSE:
            break
        rate = np.maximum(0, rate - post @ np.linalg.solve(overlap, off))
    got = {x["doc_id"]: x for x in mixing.mix(df, labelled, {"p": 3.0, "q": 7.0}).collect()}
    assert all(np.allclose(got[i]["posterior"], post[i], atol=1e-6) and abs(got[i]["rate"] - rate[i]) < 1e-5 for i in range(150))
    assert min(rate) < 1 < max(rate)


def test_columns_that_clash(spark):
    names = ["doc", "_spans", "spans", "_id", "_key", "key", "_copy", "copy", "_salt", "n", "q", "c"]
    df = spark.createDataFrame([(1, "some text of words " * 20, *["x"] * 12), (2, "some text of words " * 20, *["y"] * 12), (3, None, *[None] * 12)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    left = suffix_dedup.strip(df)
    assert left.columns == df.columns and left.count() == 1
    mixed = mixing.repeat(mixing.mix(df, df.select("doc_id", F.lit("a").alias("domain")), "even", least=1.0))
    assert mixed.columns == df.columns and mixed.count() == 3


def test_mixing(spark, docs, empty):
    r = random.Random(4)
    make = lambda p, n: " ".join(f"{p}{r.randrange(50)}" for _ in range(n))
    rows = [(i, make("a", 40) if i % 4 else make("b", 40), "en" if i % 4 else "fr", 1, "clash") for i in range(400)] + [(900, None, None, 1, "x"), (901, "", "en", 1, "x"), (None, make("a", 5), None, 1, "x"), (None, make("a", 5), None, 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, words int, rate string")
    labelled = df.select("doc_id", F.col("lang").alias("domain"))
    got = mixing.mix(df, labelled, "even").collect()
    assert len(got) == len(rows)
    total = sum(x["words"] for x in got)
    for k in (0, 1):
        assert abs(sum(x["words"] * x["rate"] * x["posterior"][k] for x in got) / total - 0.5) < 0.01
    assert all(x["rate"] >= 0 and x["copies"] >= 0 for x in got)
    more = mixing.mix(df, labelled, "even", least=1.0)
    assert more.agg(F.min("rate")).first()[0] >= 1 and mixing.repeat(more).columns == ["doc_id", "text", "lang"]
    assert mixing.mix(empty, empty.select("doc_id", F.col("lang").alias("domain")), "even").count() == 0
    assert mixing.mix(docs, labelled.where("false"), {"all": 1.0}).count() == len(corpus())


def test_mixing_knows_every_domain(spark):
    rows = [(i, " ".join(f"d{i % 40}w{k}" for k in range(20)), f"d{i % 40:02}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = df.select("doc_id", F.col("lang").alias("domain"))
    assert mixing.classifier(df, labelled)[0] == [f"d{i:02}" for i in range(40)]
    got = mixing.mix(df, labelled, {"d39": 1.0, "d00": 1.0}).collect()
    total = sum(x["words"] for x in got)
    assert all(abs(sum(x["words"] * x["rate"] * x["posterior"][k] for x in got) / total - want) < 0.01 for k, want in ((0, 0.5), (39, 0.5), (20, 0.0)))
    with pytest.raises(ValueError):
        mixing.mix(df, labelled, {"none such": 1.0})


def test_pipeline_near_copies(spark):
    import corpus_pipeline

    shared = text(11, 60)
    rows = [(1, text(12, 60)), (1, text(13, 60)), (2, shared), (3, shared), (4, text(14, 60)), (4, text(14, 60)), (None, shared)]
    got = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[i] for i in (0, 1, 2, 4, 6)], key=str)


def stage_rows():
    """Documents with labels; copies, near copies, a shared passage, repeated rows, nulls, and columns named like those that the stages make."""
    r = random.Random(21)
    vocab = {"en": [f"e{i}w" for i in range(300)], "fr": [f"f{i}m" for i in range(300)]}
    prose = lambda lang, n: " ".join(r.choice(vocab[lang]) for _ in range(n))
    passage = prose("en", 70)
    rows = [(i, prose("en" if i % 4 else "fr", 60), "en" if i % 4 else "fr") for i in range(240)]
    rows += [(300 + i, "%% spam || " + prose("en", 3) + " @@##" * 30, "en") for i in range(80)]
    rows += [(400 + i, prose("en", 40) + " " + passage + " " + prose("en", 40), "en") for i in range(6)]
    rows += [(500, rows[1][1], "en"), (501, rows[1][1] + " tail", "en"), (2, rows[2][1], "en"), (2, prose("en", 60), "en"), (600, None, "en"), (601, "", None), (None, rows[3][1], "en"), (None, prose("en", 50), None)]
    return rows


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """(documents, folder of a labels table)"""
    at = str(tmp_path_factory.mktemp("stages"))
    marks = [(i, 0 if 300 <= (i or 0) < 400 else 1, 0) for i, _, _ in stage_rows() if i is not None and i < 400] + [(None, 1, 0), (5, None, 0), (9999, 1, 1)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{at}/labels.parquet")
    schema = "doc_id long, text string, lang string, n_chars long, keep string, rate string, component_id int, spans string, copy string"
    docs = spark.createDataFrame([(i, t, lang, len(t or ""), "k", "r", 1, "s", "c") for i, t, lang in stage_rows()], schema)
    docs.coalesce(2).write.parquet(f"{at}/documents.parquet")
    return docs, at


def test_stages(spark, staged):
    import corpus_pipeline as pipeline

    docs, at = staged
    (_, grade), (_, near), (_, cut), (_, mix), (_, pack) = pipeline.STAGES
    rows = [(i, t) for i, t, _ in stage_rows()]
    # quality: junk goes, clean documents stay, and the model's keep decides
    kept = grade(spark, docs, at)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not [i for i in ids if i is not None and 300 <= i < 400] and sum(i is not None and i < 240 for i in ids) >= 230
    model = quality.fit(docs, spark.read.parquet(f"{at}/labels.parquet"))
    tails = model.probabilities([(t or "").encode() for _, t in rows])
    assert len(ids) == sum(bool(a >= model.least[0] and b >= model.least[1]) for a, b in tails)
    # near copies: by brute force
    first = {i for i, (_, c) in brute(rows).items() if i == c}
    want = {(i, t) for i, t in rows if i in first} | {(i, t) for i, t in rows if i is None}
    got = near(spark, docs, at)
    assert got.columns == docs.columns and sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(want, key=str)
    # passages: by brute force, over rows with one text an id
    plain = docs.where("doc_id is null or doc_id <> 2")
    want = remove([(i, t) for i, t in rows if i != 2])
    got = cut(spark, plain, at)
    assert got.columns == docs.columns
    for r in got.collect():
        assert r["n_chars"] == len(r["text"])
        if r["doc_id"] is not None:
            assert len(r["text"].encode()) == want[r["doc_id"]][0] - want[r["doc_id"]][1]
    assert {r["doc_id"] for r in got.collect()} == {i for i, t in rows if (t or "").strip() and i != 2 and (i is None or want[i][0] > want[i][1])}
    # mixture: whole rows, as often as their rates say; the words of the languages near the square roots of their shares
    got = mix(spark, docs, at)
    assert got.columns == docs.columns
    labelled = docs.select("doc_id", F.col("lang").alias("domain")).join(spark.read.parquet(f"{at}/labels.parquet").select("doc_id"), "doc_id", "left_semi")
    rated = mixing.mix(docs, labelled, "root").collect()
    assert got.count() == sum(r["copies"] for r in rated) and min(r["rate"] for r in rated) < 1 < max(r["rate"] for r in rated)
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in rated) and {tuple(r) for r in got.collect()} <= {tuple(r) for r in docs.collect()}
    # packing: every id of every row in one piece
    by = check_tiling(pack(spark, docs, at).collect())
    own = packing.Tokens(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    assert {i: sum(n for _, n, _ in x) for i, x in by.items()} == {i: sum(len(own.ids(t or "")) + 1 for j, t in rows if j == i) for i in {i for i, _ in rows}}


def test_pipeline(spark, staged):
    """run() is its stages, one on the rows of another; empty tables go through."""
    import corpus_pipeline as pipeline

    docs, at = staged
    left = docs
    for _, stage in pipeline.STAGES:
        before, left = left, stage(spark, left, at).persist()
    sizes = lambda frame: sorted(((r["doc_id"], r["doc_tokens"]) for r in frame.where("start = 0").collect()), key=str)
    assert sizes(pipeline.run(spark, at)) == sizes(left) and left.where("start = 0").count() == before.count()
    empty = docs.where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, at).count() == 0


def nearest(rows, chosen, k=10):
    """Each chosen row's k nearest rows by brute force: {(query, copy): [(vec_id, distance)]}."""
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out, copies = {}, defaultdict(int)
    for at, (i, v) in enumerate(rows):
        if chosen(i):
            d = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for other, (j, w) in enumerate(rows) if other != at and len(w) == len(v))
            out[i, copies[i]] = [(j, x) for x, j in d[:k]]
            copies[i] += 1
    return out


def test_ann(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(1500, 16)).astype(np.float32)
    x[700:1200] = x[700]  # a third are the same
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] * 16), (2300, [None] * 16), (2400, [1.0]), (2500, [2.0]), (2401, [-0.0, 1.0]), (2600, [0.0, 1.0]), (None, [1.0] * 16)]
    rows += [(300, x[300].tolist()), (300, x[300].tolist()), (400, x[5].tolist()), (401, x[400].tolist())]  # repeated ids, with the same vector or another
    frame = spark.createDataFrame([(i, v, "q", 1) for i, v in rows], "vec_id long, embedding array<float>, rank string, c int").repartition(5)
    got = defaultdict(list)
    for a in ann.search(frame, F.col("vec_id") % 100 == 0, short=150).collect():
        got[a["query_id"]].append((a["rank"], a["vec_id"], a["score"]))
    want = nearest(rows, lambda i: i % 100 == 0)
    assert set(got) == {i for i, _ in want} and len(got[2400]) == 1 and got[2600] == [(1, 2401, 0.0)]
    hit = total = 0
    for i in got:
        lists = [w for (q, _), w in want.items() if q == i]
        assert len(got[i]) == sum(map(len, lists))
        exact = sorted((rank, j, s) for w in lists for rank, (j, s) in enumerate(w, 1))
        near = sorted(got[i])
        hit += sum(a[:2] == b[:2] for a, b in zip(near, exact, strict=True))
        total += len(exact)
        if 700 <= i < 1200 or i in (300, 2400, 2500, 2600):
            assert [a[:2] for a in near] == [b[:2] for b in exact] and all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(near, exact, strict=True))
    assert hit / total >= 0.9  # a shortlist of 150 of about 1000 different vectors, in all the index
    assert ann.search(frame.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    assert ann.search(frame, F.col("vec_id") < 0).count() == 0


def test_ann_broadcasts_no_join(spark, monkeypatch):
    """a side that looks small in its files goes whole through the driver where a join is broadcast."""
    plans, write = [], ann.materialize
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(ann, "materialize", lambda df, name: plans.append(plan(df)) or write(df, name))
    frame = spark.createDataFrame([(i, [float(i % 7), float(i), 1.0]) for i in range(400)], "vec_id long, embedding array<float>")
    found = ann.search(frame, F.col("vec_id") % 100 == 0)
    assert found.count() == 40
    assert sum(p.count("SortMergeJoin") for p in [*plans, plan(found)]) == 3 and not any("Broadcast" in p for p in [*plans, plan(found)])


def test_ann_blocks_spread():
    for groups in (8, 12, 64):
        for blocks in (np.arange(1, 2049), np.arange(1, 2049) << 24):
            dealt = np.bincount(ann.group_of(blocks, groups), minlength=groups)
            assert dealt.max() < 2 * 2048 / groups and dealt.min() > 0.4 * 2048 / groups


def test_ann_shortlist_is_the_best_of_all_blocks():
    r = np.random.default_rng(2)
    score, least, c = r.integers(0, 9, (20, 300)).astype(np.float32), r.integers(0, 40, 300), np.arange(300)
    for short in (1, 10, 299, 300, 400):
        got = ann.best(score, least, c, short)
        for row, s in zip(got, score, strict=True):
            assert row.tolist() == sorted(range(300), key=lambda i: (s[i], least[i], i))[:short]
