"""Language identification by hierarchical discrimination.

A text is a vector of hashed runs of one to four characters. Languages whose profiles are more
alike than the average pair are joined into families. A text's family is predicted first, by the
likelihood of its character runs in each; inside the family one linear support vector machine per
pair of languages votes, which separates close relatives by what differs between those two alone.

The languages learned are the values found. Texts that are null or hold no letter are ``und`` with
score 0, and teach nothing; so do rows without a language. Without any labelled text every text is
``und``; with one language every text with letters is of that language. Ties go to the larger sum
of margins, then to the smaller name. Every row of the input is kept, repeated rows and null ids
too; columns named like the new ones are replaced. Texts are read whole, long ones piece by piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from shelfwright.llm.common import id_hash, packed, query, table, unpacked
from shelfwright.session import settle, ship_package

#: Documents of a language that the classifiers are fitted on, about, where there are more; drawn by a hash.
FIT_DOCS = 2000
#: Longest run of characters; the vector's length as a power of two.
GRAM, BITS = 4, 16
SIZE = 1 << BITS
#: Characters of a text that are hashed at a time.
PIECE = 1 << 20
#: Smoothing of the family likelihoods; cost and passes of the support vector machines; slope from margin to score.
SMOOTH, COST, PASSES, SLOPE = 0.1, 1.0, 12, 3.0
UNKNOWN = "und"

_GAP = re.compile(r"[\W\d_]+")
_MULTIPLIER, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places of the text's character runs, and how often each is hit. All but letters is one space."""
    spaced = f" {_GAP.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(spaced.encode("utf-32-le", "replace"), "<u4")
    total = np.zeros(SIZE, np.int64)
    for start in range(0, len(codes), PIECE):
        # a piece takes in the letters that the runs starting in it reach into
        piece = codes[start : start + PIECE + GRAM - 1].astype(np.uint64)
        hashed, places = np.zeros(len(piece), np.uint64), []
        for n in range(1, GRAM + 1):
            if len(piece) < n:
                break
            hashed = hashed[: len(piece) - n + 1] * _MULTIPLIER + piece[n - 1 :] + np.uint64(n)
            places.append((hashed[:PIECE] * _SPREAD >> np.uint64(64 - BITS)).astype(np.int64))
        total += np.bincount(np.concatenate(places), minlength=SIZE)
    at = np.flatnonzero(total)
    return at, total[at]


def weighted(times: np.ndarray) -> np.ndarray:
    """Logarithms of the counts, as a vector of length one."""
    v = np.log1p(times).astype(np.float32)
    return v / np.sqrt((v * v).sum())


def _vectors(batches) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep, places, times = [], [], []
        for i, text in enumerate(b.column("text").to_pylist()):
            if has_letter(text):
                at, n = grams(text)
                keep.append(i)
                places.append(at.astype(np.int32))
                times.append(n)
        rows = b.select(["lang", "draw"]).take(pa.array(keep, pa.int64()))
        cols = [*rows.columns, pa.array(places, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(cols, ["lang", "draw", "at", "times"])


def _profile(data: pa.Table) -> pa.Table:
    """Counts of one language's runs, and its mean vector."""
    counts, mean = np.zeros(SIZE), np.zeros(SIZE)
    for at, times in zip(data.column("at"), data.column("times")):
        i, n = at.values.to_numpy(), times.values.to_numpy()
        counts[i] += n
        mean[i] += weighted(n)
    cols = {"lang": [data.column("lang")[0].as_py()], "counts": [counts.tobytes()], "mean": [mean.tobytes()]}
    return pa.table(cols)


def families(names: list[str], means: np.ndarray) -> list[list[str]]:
    """Languages joined while the two most alike groups are at least as alike as the average pair of languages."""
    groups = [[i] for i in range(len(names))]
    if len(names) < 2:
        return [list(names)] if names else []
    # what all languages share says nothing about kinship
    own = means / np.linalg.norm(means, axis=1, keepdims=True)
    like = own @ own.T
    average = np.mean([like[i, j] for i, j in combinations(range(len(names)), 2)])
    while len(groups) > 1:
        score, i, j = max(
            (np.mean([like[x, y] for x in groups[i] for y in groups[j]]), -i, -j)
            for i, j in combinations(range(len(groups)), 2)
        )
        if score < average - 1e-12:
            break
        groups[-i] += groups.pop(-j)
    return [sorted(names[i] for i in g) for g in groups]


def machine(vectors: list[tuple[np.ndarray, np.ndarray]], side: np.ndarray, passes: int = PASSES, seed: int = 1) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss, by dual coordinate descent; last the bias.

    Each side weighs the same in total, however many texts it has.
    """
    weights, bias = np.zeros(SIZE), 0.0
    alpha, order = np.zeros(len(side)), np.random.default_rng(seed)
    share = {s: len(side) / (2 * max(1, (side == s).sum())) for s in (-1, 1)}
    soft = np.array([1 / (2 * COST * share[s]) for s in side.tolist()])
    for _ in range(passes):
        for k in order.permutation(len(side)):
            at, v = vectors[k]
            y = side[k]
            slope = y * (weights[at] @ v + bias) - 1 + alpha[k] * soft[k]
            new = max(0.0, alpha[k] - slope / (2.0 + soft[k]))  # a vector has length one, the bias another
            if new != alpha[k]:
                step = (new - alpha[k]) * y
                weights[at] += step * v
                bias += step
                alpha[k] = new
    return np.append(weights, bias)


def _machine(data: pa.Table) -> pa.Table:
    data = data.sort_by([("draw", "ascending"), ("lang", "ascending")])
    first, second = data.column("first")[0].as_py(), data.column("second")[0].as_py()
    vectors = [(a.values.to_numpy(), weighted(t.values.to_numpy())) for a, t in zip(data.column("at"), data.column("times"))]
    side = np.array([1 if x == first else -1 for x in data.column("lang").to_pylist()])
    w = machine(vectors, side).astype(np.float32)
    return pa.table({"first": [first], "second": [second], "weights": [w.tobytes()]})


class Model:
    """Families with the log-likelihoods of their runs, and one machine per pair of languages inside a family."""

    def __init__(self, groups: list[list[str]], likelihood: np.ndarray, machines: dict[tuple[str, str], np.ndarray]):
        self.groups, self.likelihood = groups, likelihood
        self.pairs = [list(combinations(g, 2)) for g in groups]
        self.machines = [np.column_stack([machines[p] for p in pairs]) if pairs else None for pairs in self.pairs]

    def family(self, at: np.ndarray, times: np.ndarray) -> tuple[int, float]:
        """The likeliest family and its share, runs that overlap taken as one piece of evidence."""
        said = times @ self.likelihood[at]
        said = (said - said.max()) / np.sqrt(times.sum())
        share = np.exp(said)
        best = int(said.argmax())
        return best, float(share[best] / share.sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.groups or not has_letter(text):
            return UNKNOWN, 0.0
        at, times = grams(text)
        family, share = self.family(at, times)
        names, pairs = self.groups[family], self.pairs[family]
        if not pairs:
            return names[0], share
        w = self.machines[family]
        margins = weighted(times) @ w[at] + w[-1]
        least = dict.fromkeys(names, np.inf)
        won: dict[str, list] = {n: [0, 0.0] for n in names}
        for (a, b), m in zip(pairs, margins.tolist()):
            for name, own in ((a, m), (b, -m)):
                won[name][0] += own > 0
                won[name][1] += own
                least[name] = min(least[name], own)
        best = max(sorted(names, reverse=True), key=lambda n: won[n])
        return best, share / (1 + np.exp(-SLOPE * least[best]))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, text: str = "text", lang: str = "lang") -> Model:
    """Learn from the texts of ``docs`` and their languages, about ``fit_docs`` of each language.

    The vectors drawn are written once; one task sums up a language's, one trains a pair's, each
    over at most that many documents or twice as many. The driver gets one vector per language and
    per pair of relatives.
    """
    ship_package(docs.sparkSession)
    id = F.col("`doc_id`") if "doc_id" in docs.columns else F.lit(0)
    labelled = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), id.alias("id"))
    labelled = labelled.where("text is not null and lang is not null")
    # the id only spreads exact copies over the draw; rows equal in both count once
    labelled = labelled.withColumn("draw", F.pmod(F.xxhash64("text", "id"), F.lit(1 << 31))).drop("id")
    counts = {r.lang: r["count"] for r in labelled.select("lang", "draw").distinct().groupBy("lang").count().collect()}
    below = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1 << 31, (fit_docs << 31) // n))])
    drawn = labelled.where(F.col("draw") < below[F.col("lang")]) if counts else labelled
    drawn = drawn.dropDuplicates(["lang", "draw"])
    schema = "lang string, draw bigint, at array<int>, times array<bigint>"
    vectors = settle(drawn.select("text", "lang", "draw").mapInArrow(_vectors, schema))
    profiles = vectors.groupBy("lang").applyInArrow(_profile, "lang string, counts binary, mean binary")
    found = sorted(profiles.collect(), key=lambda r: r.lang)
    names = [r.lang for r in found]
    groups = families(names, np.array([np.frombuffer(r["mean"]) for r in found]))
    seen = {r.lang: np.frombuffer(r["counts"]) for r in found}
    rows = []
    for g in groups:  # every language of a family counts alike
        shares = [(seen[x] + SMOOTH) / (seen[x] + SMOOTH).sum() for x in g]
        rows.append(np.log(np.mean(shares, axis=0)))
    likelihood = np.array(rows).T.astype(np.float32) if rows else np.zeros((SIZE, 0), np.float32)
    pairs = [p for g in groups for p in combinations(g, 2)]
    machines: dict[tuple[str, str], np.ndarray] = {}
    if pairs:
        wanted = docs.sparkSession.createDataFrame(pairs, "first string, second string")
        either = (F.col("lang") == F.col("first")) | (F.col("lang") == F.col("second"))
        each = vectors.join(F.broadcast(wanted), either)
        trained = each.groupBy("first", "second").applyInArrow(_machine, "first string, second string, weights binary")
        machines = {(r.first, r.second): np.frombuffer(r.weights, np.float32) for r in trained.collect()}
    return Model(groups, likelihood, machines)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score. One pass, no shuffle, every row kept."""
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)
    frame = docs.select(packed(docs))
    frame = frame.select("__row", F.col(f"__row.`{text}`").alias("text"))

    def run(batches):
        for b in batches:
            found = [sent.value.predict(t) for t in b.column("text").to_pylist()]
            cols = [b.column("__row"), pa.array([f[0] for f in found], pa.string())]
            cols.append(pa.array([float(f[1]) for f in found], pa.float64()))
            yield pa.RecordBatch.from_arrays(cols, ["__row", "lang_pred", "score"])

    kind = StructType([frame.schema["__row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    out = frame.mapInArrow(run, kind)
    return out.select(*unpacked(docs.columns, {"lang_pred": F.col("lang_pred"), "score": F.col("score")}))


def held_out(id: Column) -> Column:
    return id_hash(id, 4) == 2


@query("op13_language_id")
def op13_language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    scored = predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
