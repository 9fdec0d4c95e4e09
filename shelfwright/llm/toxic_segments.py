"""Toxicity by maximum-scoring segments.

Every word carries its log-odds between toxic and clean documents under an informative Dirichlet
prior; a word never seen stands in for by its first letters. A linear-time scan finds all
maximal-scoring segments of a text. A segment's score is judged by extreme-value statistics: in
clean text the best of n words exceeds S with a chance of about K n exp(-lambda S). The
significant segments of a document are added up and calibrated to a probability.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.common import id_hash, packed, query, table, unpacked
from shelfwright.session import ship_package

#: Labelled documents that the classifier is fitted on, about, where there are more; drawn by a hash of the id.
FIT_DOCS = 100_000
#: Features it keeps, at most; documents that must hold one; least z-score of its log-odds.
FEATURES, LEAST_DOCS, LEAST_Z = 50_000, 3, 2.5
#: Least log-odds that count as evidence: weaker ones would add up over the common words of a long text.
LEAST_ODDS = 3.0
#: Weight of the prior in documents, shared out by how common a feature is; the least a feature gets.
PRIOR, LEAST_PRIOR = 10.0, 0.5
#: What every word without evidence costs: ends a segment.
DRIFT = -0.05
#: Lengths of the word beginnings that stand for rare words.
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.3

_EDGE = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of anything but ASCII white space, without punctuation at their ends."""
    return [w.strip(_EDGE) for w in (text or "").encode().lower().split()]


def features_of(word: bytes) -> list[bytes]:
    """The word, and its first letters, marked as such. Letters are whole code points."""
    if len(word) < STEMS[0]:
        return [word] if word else []
    letters = word.decode(errors="ignore")
    return [word] + [letters[:n].encode() + b"*" for n in STEMS if len(letters) >= n]


def _counted(batches):
    """Documents per feature and class of a task; (feature, toxic, clean), null feature for the documents themselves."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush():
        keys = list(counts[0].keys() | counts[1].keys())
        cols = [pa.array(keys, pa.binary()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(cols, ["feature", "toxic", "clean"])

    seen: dict[bytes, list[bytes]] = {}
    for b in batches:
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            found: set = {None}
            for w in set(words_of(text)):
                f = seen.get(w)
                if f is None:
                    f = seen[w] = features_of(w)
                found.update(f)
            counts[0 if toxic else 1].update(found)
        if len(seen) > 300_000:
            seen.clear()
        if len(counts[0]) + len(counts[1]) > 400_000:
            yield flush()
    yield flush()


def log_odds(counts: DataFrame, toxic_docs: int, clean_docs: int) -> dict[bytes, float]:
    """{feature: log-odds} of the toxic features that stand out, ``FEATURES`` at most.

    The prior of a feature follows its share of all documents, ``PRIOR`` documents in all.
    """
    a, b = F.col("toxic"), F.col("clean")
    rate = (a + b) / float(toxic_docs + clean_docs)
    prior = F.greatest(PRIOR * rate, F.lit(LEAST_PRIOR))
    ta, tb = a + prior, b + prior
    ra, rb = toxic_docs - a + LEAST_PRIOR, clean_docs - b + LEAST_PRIOR
    value = F.log(ta / ra) - F.log(tb / rb)
    z = value / F.sqrt(1 / ta + 1 / tb)
    kept = counts.where((a + b >= LEAST_DOCS) & F.col("feature").isNotNull())
    kept = kept.select("feature", value.alias("value"), z.alias("z")).where((F.col("z") >= LEAST_Z) & (F.col("value") >= LEAST_ODDS))
    rows = kept.orderBy(F.desc("z"), "feature").limit(FEATURES).collect()
    return {bytes(r.feature): r.value for r in rows}


def word_weight(odds: dict[bytes, float], word: bytes) -> float:
    """The log-odds of the strongest of its features, else the drift."""
    return max((odds[f] for f in features_of(word) if f in odds), key=abs, default=DRIFT) if word else DRIFT


def segments(weights: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score), disjoint and in order, in linear time.

    One scan keeps the candidates with the sums before and at their ends. A new positive run is
    joined with earlier ones back to the nearest that starts lower, as long as the sum there had
    not risen as high.
    """
    held: list[list] = []  # start, end, sum before, sum at end, index of the nearest earlier one that starts lower
    total = 0.0
    for i, w in enumerate(weights):
        before, total = total, total + w
        if w <= 0:
            continue
        new = [i, i + 1, before, total, -1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= new[2]:
                j = held[j][4]
            if j < 0 or held[j][3] >= new[3]:
                new[4] = j
                held.append(new)
                break
            new = [held[j][0], new[1], held[j][2], new[3], -1]
            del held[j:]
    return [(s, e, high - low) for s, e, low, high, _ in held]


def _compressed(weights: np.ndarray) -> tuple[list[float], np.ndarray]:
    """Runs of one sign as single steps, and where each begins: the same maximal segments on fewer steps."""
    sign = weights > 0
    starts = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
    return np.add.reduceat(weights, starts).tolist(), np.append(starts, len(weights))


class Scorer:
    """Word weights and the extreme-value constants of clean text."""

    def __init__(self, odds: dict[bytes, float], rate: float = 1.0, scale: float = 1.0):
        self.odds, self.rate, self.scale = odds, rate, scale
        self.known: dict[bytes, float] = {}

    def weights(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        known, odds = self.known, self.odds
        new = [w for w in set(words) if w not in known]
        if len(known) + len(new) > 300_000:
            known.clear()
            new = list(set(words))
        for w in new:
            known[w] = word_weight(odds, w)
        out = np.fromiter(map(known.__getitem__, words), float, len(words))
        times: Counter = Counter()
        for i in np.flatnonzero(out > 0):  # a word repeated says half as much each time
            out[i] /= 1 << min(times[words[i]], 60)
            times[words[i]] += 1
        return out

    def significant(self, text: str | None, chance: float = 0.05) -> list[tuple[int, int, float]]:
        """(first word, end word, bits) of every passage that clean text of this length holds with at most that chance."""
        w = self.weights(text)
        if not len(w):
            return []
        steps, starts = _compressed(w)
        floor = math.log(max(1, len(w)) * self.scale / chance) / self.rate
        return [
            (int(starts[s]), int(starts[e]), score * self.rate - math.log(len(w) * self.scale))
            for s, e, score in segments(steps)
            if score >= floor
        ]

    def evidence(self, text: str | None) -> tuple[float, float]:
        """Extreme-value statistic of the best passage, and the sum over the significant ones beyond chance."""
        w = self.weights(text)
        if not len(w):
            return 0.0, 0.0
        steps, _ = _compressed(w)
        found = [s for _, _, s in segments(steps)]
        size = math.log(max(1.0, len(w) * self.scale))
        best = max(found, default=0.0) * self.rate - size
        more = sum(max(0.0, s * self.rate - size) for s in found)
        return max(best, -20.0), math.log1p(more)


def karlin_rate(weights: np.ndarray) -> float:
    """The positive lambda with mean(exp(lambda w)) = 1; 1 where the drift is not negative or nothing is positive."""
    if not len(weights) or weights.mean() >= 0 or weights.max() <= 0:
        return 1.0
    low, high = 0.0, 1.0
    while np.exp(high * weights).mean() < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if np.exp(mid * weights).mean() < 1 else (low, mid)
    return high


def _weight_counts(odds: dict[bytes, float]):
    """How often each weight occurs in clean documents, rounded: (weight, words)."""

    def run(batches):
        scorer, counts = Scorer(odds), Counter()
        for b in batches:
            for text in b.column("text").to_pylist():
                values, n = np.unique(np.round(scorer.weights(text), 2), return_counts=True)
                for v, k in zip(values.tolist(), n.tolist()):
                    counts[v] += k
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.float64()), pa.array(list(counts.values()), pa.int64())], ["weight", "words"]
        )

    return run


def _evidence(odds: dict[bytes, float], rate: float, keep: list[str]):
    def run(batches):
        scorer = Scorer(odds, rate)
        for b in batches:
            found = [scorer.evidence(t) for t in b.column("text").to_pylist()]
            cols = [b.column(c) for c in keep]
            cols += [pa.array([f[i] for f in found], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(cols, [*keep, "best", "more"])

    return run


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients of a logistic curve over the columns of ``x`` and a constant, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return beta


class Model:
    """What a fit leaves: weights of features, the rate of the extreme-value law, the calibration."""

    def __init__(self, odds: dict[bytes, float], rate: float, beta: np.ndarray):
        self.odds, self.rate, self.beta = odds, rate, beta


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, id: str = "doc_id", text: str = "text") -> Model:
    """Learn from the texts of ``labels`` (id, toxic), about ``fit_docs`` of them where there are more.

    Ids labelled both ways count as toxic; null labels and null ids are left out. Without both
    kinds among the documents the model says the share of toxic labels for every text (0 for none).
    The labels taken are a bounded set and are broadcast; texts are never shuffled. The driver
    gets at most ``FEATURES`` weights and two numbers per fitted document, binned.
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = labels.select(F.col(f"`{id}`").alias("id"), "toxic").where("id is not null and toxic is not null")
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > fit_docs:  # ids by a hash, so that no task sorts or holds more of them than its share
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 31)) < (fit_docs << 31) // n)
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    texts = texts.join(F.broadcast(known), "id").select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))

    counts = texts.mapInArrow(_counted, "feature binary, toxic bigint, clean bigint")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = counts.where((F.col("toxic") + F.col("clean") >= LEAST_DOCS) | F.col("feature").isNull())
    counts = counts.persist()
    try:
        n = counts.where("feature is null").first()
        toxic, clean = (n.toxic, n.clean) if n else (0, 0)
        if not toxic or not clean:
            share = min(max(toxic / (toxic + clean) if toxic + clean else 0.0, 1e-6), 1 - 1e-6)
            return Model({}, 1.0, np.array([0.0, 0.0, math.log(share / (1 - share))]))
        odds = log_odds(counts, toxic, clean)
    finally:
        counts.unpersist()
    tally = texts.where("toxic = 0").mapInArrow(_weight_counts(odds), "weight double, words bigint")
    tally = tally.groupBy("weight").agg(F.sum("words").alias("words")).collect()
    values = np.repeat([r.weight for r in tally], [max(1, round(1e5 * r.words / sum(x.words for x in tally))) for r in tally])
    rate = karlin_rate(values)
    seen = texts.mapInArrow(_evidence(odds, rate, ["toxic"]), "toxic int, best double, more double")
    binned = seen.groupBy("toxic", F.round("best", 1).alias("best"), F.round("more", 1).alias("more")).count().collect()
    x = np.array([[r.best, r.more] for r in binned])
    y, w = np.array([r.toxic for r in binned], float), np.array([r["count"] for r in binned], float)
    return Model(odds, rate, calibrate(x, y, w))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1, empty and null texts too) and predicted. One pass, no shuffle, every row kept.

    Columns named like the new ones are replaced.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    ship_package(docs.sparkSession)
    frame = docs.select(packed(docs))
    frame = frame.select("__row", F.col(f"__row.`{text}`").alias("text"))
    numbers = [StructField("best", DoubleType()), StructField("more", DoubleType())]
    kind = StructType([frame.schema["__row"], *numbers])
    out = frame.mapInArrow(_evidence(model.odds, model.rate, ["__row"]), kind)
    a, b, c = map(float, model.beta)
    p: Column = 1 / (1 + F.exp(-(F.col("best") * a + F.col("more") * b + c)))
    out = out.withColumn("p", F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
    new = {"score": F.col("p"), "predicted": (F.col("p") >= threshold).cast("int")}
    return out.select(*unpacked(docs.columns, new))


def held_out(id: Column) -> Column:
    return id_hash(id, 4) == 2


@query("op10_toxicity")
def op10_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(~held_out(F.col("doc_id")))
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
