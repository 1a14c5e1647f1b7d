"""Mixing sources to target weights by soft membership, in DataFrame functions alone.

A naive Bayes classifier over hashed words, fitted on a labelled table, gives each document's posterior over the
domains. Rates are then found for all documents by projected gradient descent on least squares: with n_i a document's
words and p_id its posterior, sum_i r_i n_i p_id is to be each domain's target. A step is one aggregation over
(n, p), whose few sums go to the driver; there they are scaled by the inverse of the domains' overlap matrix, and every
document's rate moves by them along its own posterior and is cut at the least rate (0 unless given).

The classifier is fitted on a bounded sample of about `SAMPLE` labelled documents, in full, and knows every labelled domain; its tables have 2^`BITS` entries a domain. Posteriors are softened: the mean log likelihood of a word times `SHARP`.

Null and empty texts have no words: their posterior is the prior, their rate weighs nothing, and copies is the rate's as of
any other. Labels that are null are left out; without labels there is one domain, `all`. A domain without a target
has target 0, a target over 0 without a domain is an error. Targets that aren't met after `STEPS` steps, as no rates may meet them, are logged
as a warning with what is missing. Repeated rows each get the same rate, and count once where the classifier is fitted; of several texts of one doc_id, the least counts there. Further columns are kept, but for those named like the
new ones, which are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import logging
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, set_aside, unused

BITS, SAMPLE = 12, 6000
SHARP, SMOOTH = 12.0, 0.5
STEPS, CLOSE = 24, 1e-4
log = logging.getLogger(__name__)
NEW = ("posterior", "words", "rate", "copies")


def _words(docs: DataFrame, *keep: str) -> DataFrame:
    """A row for each blank-separated word of each text: the kept columns, its position and slot (null for nothing between blanks)."""
    parts = F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(" "))
    cut = docs.select(*keep, F.posexplode(parts).alias("pos", "word"))
    return cut.select(*keep, "pos", F.when(F.col("word") != "", F.pmod(F.xxhash64("word"), F.lit(1 << BITS).cast("long")).cast("int") + 1).alias("slot"))


def classifier(docs: DataFrame, labelled: DataFrame) -> tuple[list[str], list[float], list[list[float]]]:
    """Domains, log priors and, for each domain, log likelihoods by slot, from labelled (doc_id, domain) of docs (doc_id, text)."""
    rows = labelled.where("doc_id is not null and domain is not null").select("doc_id", F.col("domain").cast("string").alias("domain")).distinct()
    count = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not count:
        return ["all"], [0.0], [[0.0] * (1 << BITS)]
    total, domains = sum(count.values()), sorted(count)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30).cast("long")) < min(1 << 30, (SAMPLE << 30) // total)
    sample = rows.where(draw).where(F.col("domain").isin(domains)).dropDuplicates(["doc_id"])  # about SAMPLE rows at most
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "domain").agg(F.min("text").alias("text"))  # one row each, however often it comes
    words = _words(texts, "domain").where("slot is not null")
    seen = {d: [SMOOTH] * (1 << BITS) for d in domains}
    for r in words.groupBy("domain", "slot").count().collect():  # 2^BITS rows a domain at most
        seen[r["domain"]][r["slot"] - 1] += r["count"]
    logs = []
    for d in domains:
        whole = math.log(sum(seen[d]))
        logs.append([math.log(x) - whole for x in seen[d]])
    return domains, [math.log(count[d] / total) for d in domains], logs


def posteriors(docs: DataFrame, model: tuple[list[str], list[float], list[list[float]]]) -> DataFrame:
    """(doc_id, text_key, times, words, posterior) of docs (doc_id, text): equal rows are one, `times` how many they are.

    A text's words are summed up where it is read, so the shuffle has a row for each document.
    """
    domains, priors, logs = model
    d = range(len(domains))
    table = [F.from_json(F.lit(json.dumps([round(v, 5) for v in x])), "array<double>") for x in logs]
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    sums = _words(keyed, "doc_id", "text_key").groupBy("doc_id", "text_key").agg(
        *[F.sum(F.element_at(table[k], F.col("slot"))).alias(f"s{k}") for k in d], F.count("slot").alias("n"), F.sum((F.col("pos") == 0).cast("long")).alias("times")
    )
    logs_ = sums.select("doc_id", "text_key", "times", (F.col("n") / F.col("times")).cast("long").alias("words"), *[(F.lit(priors[k]) + F.lit(SHARP) * F.coalesce(f"s{k}", F.lit(0.0)) / F.greatest("n", F.lit(1))).alias(f"s{k}") for k in d])
    top = F.greatest(*[F.col(f"s{k}") for k in d]) if len(d) > 1 else F.col("s0")
    raised = logs_.select("doc_id", "text_key", "times", "words", *[F.exp(F.col(f"s{k}") - top).alias(f"s{k}") for k in d])
    return raised.select("doc_id", "text_key", "times", "words", F.array(*[F.col(f"s{k}") / sum((F.col(f"s{j}") for j in d), F.lit(0.0)) for k in d]).alias("posterior"))


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    """x with a x = b, by elimination; a is small, symmetric and positive."""
    n = len(b)
    m = [[*a[i], b[i]] for i in range(n)]
    for i in range(n):
        k = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[k] = m[k], m[i]
        for r in range(n):
            if r != i and m[i][i]:
                f = m[r][i] / m[i][i]
                m[r] = [x - f * y for x, y in zip(m[r], m[i], strict=True)]
    return [m[i][n] / m[i][i] if m[i][i] else 0.0 for i in range(n)]


def fit_rates(scored: DataFrame, targets: list[float], least: float = 0.0) -> Column:
    """The rate of each row of scored (times, words, posterior), as an expression: nonnegative, with expected totals near the targets (in words).

    scored is read once a step, and should be a written table.
    """
    d = len(targets)
    p = [F.element_at("posterior", k + 1) for k in range(d)]
    n = (F.col("words") * F.col("times")).cast("double")
    first = scored.agg(F.sum(n).alias("n"), *[F.sum(n * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(d) for j in range(i, d)]).first()
    total = first["n"] or 0.0
    rate: Column = F.lit(max(1.0, least))
    if not total:
        return rate
    overlap = [[first[f"m{min(i, j)}_{max(i, j)}"] / total + (1e-6 if i == j else 0.0) for j in range(d)] for i in range(d)]
    for _ in range(STEPS):
        got = scored.agg(*[F.sum(n * rate * p[k]).alias(f"s{k}") for k in range(d)]).first()
        off = [(got[f"s{k}"] - targets[k]) / total for k in range(d)]
        if max(map(abs, off)) < CLOSE * max(1e-9, sum(targets) / total):
            break
        step = _solve(overlap, off)
        rate = F.greatest(F.lit(least), rate - sum((F.lit(s) * p[k] for k, s in enumerate(step)), F.lit(0.0)))
    else:
        log.warning("the targets were not met in %d steps: shares off by %s; no rates may meet them", STEPS, [round(x, 5) for x in off])
    return rate


def copies(rate: Column, key: Column) -> Column:
    """A whole number of copies with the rate as its mean: the part over is drawn by a hash of the key."""
    part = F.pmod(F.xxhash64(key), F.lit(1 << 30).cast("long")) / F.lit(float(1 << 30))
    return (F.floor(rate) + (part < rate - F.floor(rate)).cast("long")).cast("long")


def rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | str, total: float | None = None, least: float = 0.0) -> DataFrame:
    """(doc_id, text_key, times, words, posterior, rate, copies) for the different rows of docs (doc_id, text).

    weights: each domain's share of the words, or `even`, or `root` (the square root of the share it has). total: words of the
    mixture, as a multiple of the documents'; None: 1, or, where the least rate is 1 or more, what the scarcest domain needs.
    """
    model = classifier(docs, labelled)
    if isinstance(weights, dict) and (unknown := sorted(x for x, w in weights.items() if w > 0 and x not in model[0])):
        raise ValueError(f"no labelled document of these domains: {', '.join(unknown)}")
    scored = materialize(posteriors(docs, model), "mixing")
    d = len(model[0])
    has = scored.agg(*[F.sum(F.col("words") * F.col("times") * F.element_at("posterior", k + 1)).alias(f"s{k}") for k in range(d)]).first()
    has = [has[f"s{k}"] or 0.0 for k in range(d)]
    if weights == "even":
        share = [1.0] * d
    elif weights == "root":
        share = [math.sqrt(h) for h in has]
    else:
        share = [max(0.0, weights.get(x, 0.0)) for x in model[0]]
    share = [s / (sum(share) or 1.0) for s in share]
    if total is None and least >= 1:
        whole = max([h / s for h, s in zip(has, share, strict=True) if s > 0], default=sum(has))
    else:
        whole = sum(has) * (1.0 if total is None else total)
    rate = fit_rates(scored, [s * whole for s in share], least)
    return scored.withColumn("rate", rate).withColumn("copies", copies(F.col("rate"), F.col("doc_id")))


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | str, total: float | None = None, least: float = 0.0) -> DataFrame:
    """docs with words, posterior, rate and copies; see rates."""
    own = docs.drop(*NEW)
    doc, key = unused(own, "doc", "key")
    found = rates(docs.select("doc_id", "text"), labelled, weights, total, least).select(F.col("doc_id").alias(doc), F.col("text_key").alias(key), *NEW)
    return own.join(found, own.doc_id.eqNullSafe(F.col(doc)) & (F.xxhash64(F.coalesce(own.text, F.lit(""))) == F.col(key))).drop(doc, key)


def repeat(mixed: DataFrame) -> DataFrame:
    """Each row as often as its copies say, without the columns of the mixing."""
    copy = unused(mixed, "copy")[0]
    return mixed.where("copies > 0").withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop(copy, *NEW)


def mixture(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | str, total: float | None = None, least: float = 0.0) -> DataFrame:
    """The rows of docs as often as their copies say, with docs' own columns."""
    own = set_aside(docs, "doc_id", "text")
    return repeat(mix(own, labelled, weights, total, least)).select(*own.columns).toDF(*docs.columns)
