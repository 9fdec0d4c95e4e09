"""Language-model scores by a log-bilinear model trained with noise-contrastive estimation.

The two words before a token predict a vector, the sum of their representations scaled per
position; a token's score is that vector times its own vector plus its bias. Tokens are classes:
the most frequent words one each, all others by the last letters of the word; inside a class of
rare words a word has its smoothed unigram share. The number of classes follows the cube root of
the counted vocabulary, so that the matrix products over all contexts and classes grow no faster
than the input. Documents are dealt by a hash into streams of about equal length, however the input
is partitioned; each stream trains against shared noise, and after each round the parameters of all
streams are averaged. Normalisers of all contexts come out of batched matrix products, once, so that
scoring is exact and cheap.

Probabilities are over all known words and one unseen word per class, and sum to one.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.common import hash_pair, id_hash, query, table
from shelfwright.session import settle, ship_package

#: Times the cube root of the counted vocabulary: words that are a class of their own, and classes of all other words.
PER_ROOT = 6
#: Most classes of both kinds together: their table of normalisers, 150 MB, is sent to every task.
MOST_CLASSES = 6144
#: Length of the vectors; last bytes of a word that its class goes by, unless it has its own.
SIZE, LAST = 24, 3
#: Word counts sent to every task; all rarer words meet their counts in a join.
COUNTS = 1 << 17
#: Rounds of training, each over its own third of the training documents; positions in a step; noise in a step.
ROUNDS, STEP, NOISE = 3, 2048, 64
RATE = 0.15
SMOOTH = 0.1
#: Tokens of a training stream in a round, about.
STREAM = 1 << 19
#: Texts that a scoring task holds as words at a time.
AT_ONCE = 256
#: Tasks that add up the streams' parameters before the driver sees them.
ADDERS = 8

END_WORD = b"\n"  # no word holds white space, so this stands for the end


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of anything but ASCII white space."""
    return (text or "").encode().lower().split()


class Layout(NamedTuple):
    """Classes: words from 0, endings after them, then the end of a text; a context may also be the start."""

    words: int
    endings: int

    @classmethod
    def of(cls, vocabulary: int, words: int) -> "Layout":
        """For so many counted words, ``words`` of which the driver knows."""
        n = min(int(PER_ROOT * vocabulary ** (1 / 3)), MOST_CLASSES // 2)
        return cls(min(n, words), max(n, 1))

    @property
    def end(self) -> int:
        return self.words + self.endings

    @property
    def start(self) -> int:
        return self.end + 1

    @property
    def shapes(self) -> tuple[tuple[int, ...], ...]:
        return (self.end + 2, SIZE), (2, SIZE), (self.end + 1, SIZE), (self.end + 1,)

    def ending(self, word: bytes) -> int:
        """The class of a word that is not frequent."""
        return self.words + zlib.crc32(word.strip(b".,;:!?")[-LAST:]) % self.endings


class Classes(dict):
    """Word to class; classes of words that are not frequent are worked out when first asked for."""

    def __init__(self, frequent: list[bytes], layout: Layout):
        self.own, self.layout = {w: i for i, w in enumerate(frequent)}, layout
        super().__init__(self.own)

    def __missing__(self, word: bytes) -> int:
        c = self[word] = self.layout.ending(word)
        return c

    def encode(self, words: list[bytes]) -> np.ndarray:
        """Classes of a text: start, start, its words, end."""
        if len(self) > 200_000:
            self.clear()
            self.update(self.own)
        out = np.empty(len(words) + 3, np.int32)
        out[:2], out[-1] = self.layout.start, self.layout.end
        out[2:-1] = list(map(self.__getitem__, words))
        return out


def _counted(batches):
    """Words and how often a task saw them; the end of text under ``END_WORD``."""
    counts: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )
        counts.clear()
        return out

    for b in batches:
        for text in b.column("text").to_pylist():
            counts.update(words_of(text))
            counts[END_WORD] += 1
            if len(counts) > 200_000:
                yield flush()
    yield flush()


class Parameters:
    """Context vectors r, position scales c, target vectors q, biases b."""

    def __init__(self, arrays: list[np.ndarray]):
        self.r, self.c, self.q, self.b = arrays

    @classmethod
    def start(cls, share: np.ndarray, layout: Layout) -> "Parameters":
        g = np.random.default_rng(5)
        r, q = (g.normal(0, 0.1, s) for s in (layout.shapes[0], layout.shapes[2]))
        return cls([r, np.ones((2, SIZE)), q, np.log(share)])

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (self.r, self.c, self.q, self.b)])

    @classmethod
    def of(cls, flat: np.ndarray, layout: Layout) -> "Parameters":
        cuts = np.cumsum([math.prod(s) for s in layout.shapes])[:-1]
        return cls([a.reshape(s).copy() for a, s in zip(np.split(flat, cuts), layout.shapes)])

    def predict(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The vectors that the contexts (one before, two before) predict."""
        return self.r[one] * self.c[0] + self.r[two] * self.c[1]

    def log_normalisers(self, block: int = 256) -> np.ndarray:
        """log of the sum over all classes, for every pair of contexts: [one before, two before].

        A class's weight is the product of what either context gives it, so the sums of all pairs
        are one matrix product.
        """
        n = len(self.r)
        second = ((self.r * self.c[1]) @ self.q.T).astype(np.float32)
        top = second.max(1)
        second = np.exp(second - top[:, None]).T
        out = np.empty((n, n), np.float32)
        for i in range(0, n, block):
            first = (self.r[i : i + block] * self.c[0]) @ self.q.T + self.b
            most = first.max(1)[:, None]
            out[i : i + block] = np.log(np.exp(first - most).astype(np.float32) @ second) + most + top
        return out


def _row_sums(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` that belong to each of ``n`` rows."""
    return np.stack([np.bincount(rows, v, n) for v in values.T.astype(float, order="C")], 1)


def _touched(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct of ``rows`` out of ``n``, ascending, and which of them each is."""
    own = np.flatnonzero(np.bincount(rows, minlength=n))
    place = np.zeros(n, np.int64)
    place[own] = np.arange(len(own))
    return own, place[rows]


class Trainer:
    """Noise-contrastive steps with per-parameter rates, in single precision."""

    def __init__(self, p: Parameters, share: np.ndarray, seed: list[int]):
        self.p, self.g = Parameters([a.astype(np.float32) for a in (p.r, p.c, p.q, p.b)]), np.random.default_rng(seed)
        self.upto, self.log_noise = np.cumsum(share), np.log(share * NOISE).astype(np.float32)
        self.steepness = [np.full(a.shape, 1e-3) for a in (p.r, p.c, p.q, p.b)]
        self.tokens = 0

    def step(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        p, n = self.p, len(target)
        r1, r2, qt = p.r.take(one, 0), p.r.take(two, 0), p.q.take(target, 0)
        h = r1 * p.c[0] + r2 * p.c[1]
        contexts, classes = len(p.r), len(p.b)
        noise = np.minimum(self.upto.searchsorted(self.g.random(NOISE), "right"), classes - 1)
        above, qn = p.b - self.log_noise, p.q[noise]
        good = np.einsum("nd,nd->n", h, qt) + above[target]
        up = 1 / (1 + np.exp(np.clip(good, -30, 30)))  # how far the word is from certain
        down = h @ -qn.T  # becomes minus how far each noise word is from ruled out
        down -= above[noise]
        np.exp(np.clip(down, -30, 30, out=down), out=down)
        down += 1
        np.divide(-1, down, out=down)
        dh = down @ qn
        dh += up[:, None] * qt
        # only rows that occur have a gradient, and only they move
        words, at = _touched(np.concatenate([target, noise]), classes)
        gq = _row_sums(at, np.concatenate([up[:, None] * h, down.T @ h]), len(words))
        gb = np.bincount(at, np.concatenate([up, down.sum(0)]), len(words))
        before, at = _touched(np.concatenate([one, two]), contexts)
        gr = _row_sums(at, np.concatenate([dh * p.c[0], dh * p.c[1]]), len(before))
        gc = np.stack([np.einsum("nd,nd->d", dh, r) for r in (r1, r2)])
        rows = (before, slice(None), words, words)
        for a, g, s, k in zip((p.r, p.c, p.q, p.b), (gr, gc, gq, gb), self.steepness, rows):
            g /= n
            s[k] += g * g
            a[k] += RATE * g / np.sqrt(s[k])
        self.tokens += n


def _trained(flat: np.ndarray, share: np.ndarray, frequent: list[bytes], layout: Layout, turn: int):
    """One pass over each stream of a task, from the common parameters: (tokens, parameters times tokens) per stream."""

    def learn(trainer: Trainer, held: list[np.ndarray]) -> None:
        c = np.concatenate(held)
        at = trainer.g.permutation(np.flatnonzero(c != layout.start))  # every position but the starts
        for i in range(0, len(at), STEP):
            k = at[i : i + STEP]
            trainer.step(c[k - 1], c[k - 2], c[k])

    def run(batches):
        classes = Classes(frequent, layout)
        now = trainer = None
        held: list[np.ndarray] = []
        size = 0
        rows = (zip(b.column("stream").to_pylist(), b.column("text").to_pylist()) for b in batches)
        for stream, text in chain(chain.from_iterable(rows), [(None, None)]):
            if held and (stream != now or size > 200_000):
                learn(trainer, held)
                held, size = [], 0
            if stream != now:
                if trainer:
                    yield _sum_batch(trainer.tokens, trainer.p.flat().astype(float) * trainer.tokens)
                now, trainer = stream, Trainer(Parameters.of(flat, layout), share, [turn, stream or 0])
            if stream is not None:
                held.append(classes.encode(words_of(text)))
                size += len(held[-1])

    return run


def _sum_batch(tokens: int, weighted: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([weighted.tobytes()], pa.binary())], ["tokens", "sums"])


def _added(batches):
    tokens, sums = 0, 0
    for b in batches:
        for n, s in zip(b.column("tokens").to_pylist(), b.column("sums").to_pylist()):
            tokens, sums = tokens + n, sums + np.frombuffer(s)
    if tokens:
        yield _sum_batch(tokens, sums)


class Model:
    """Everything that scoring needs: bounded by the module's parameters."""

    def __init__(
        self, p: Parameters, layout: Layout, frequent: list[bytes], counts: dict[bytes, int], total: int, vocabulary: int, mass: np.ndarray
    ):
        self.p, self.layout, self.frequent, self.counts = p, layout, frequent, counts
        self.total, self.vocabulary, self.mass = total, vocabulary, mass
        self.normalisers = p.log_normalisers()

    @property
    def unit(self) -> float:
        """One over the denominator of the smoothed unigram share."""
        return 1 / (self.total + SMOOTH * (self.vocabulary + 1)) if self.total else 1.0

    def texts_scored(self, c: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Natural-log probability of the classes of each text, end included; ``c`` has two starts before each."""
        p, at = self.p, np.flatnonzero(c != self.layout.start)
        out = np.empty(len(at))
        for i in range(0, len(at), 1 << 13):
            k = at[i : i + (1 << 13)]
            one, two, target = c[k - 1], c[k - 2], c[k]
            value = np.einsum("nd,nd->n", p.predict(one, two), p.q.take(target, 0))
            out[i : i + len(k)] = value + p.b[target] - self.normalisers[one, two]
        return np.add.reduceat(out, np.cumsum(tokens) - tokens)


class Numbers(dict):
    """Word to number: the words of the broadcast counts first, rarer ones after them as they are met."""

    def __init__(self, model: Model):
        self.kept = {w: i for i, w in enumerate(model.counts)}
        self.known = len(self.kept)
        super().__init__(self.kept)
        self.layout = model.layout
        classes = Classes(model.frequent, self.layout)
        self.class_of = np.fromiter(map(classes.__getitem__, self.kept), np.int32, self.known)
        self.class_of = np.concatenate([self.class_of, np.zeros(1 << 16, np.int32)])
        self.rarer: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        i = self[word] = self.known + len(self.rarer)
        self.rarer.append(word)
        if i >= len(self.class_of):
            self.class_of = np.concatenate([self.class_of, np.zeros_like(self.class_of)])
        self.class_of[i] = self.layout.ending(word)
        return i

    def trim(self) -> None:
        if len(self.rarer) > 100_000:
            self.clear()
            self.update(self.kept)
            self.rarer = []


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, n, class) of every word of the documents, the end of text among them."""
    counts = docs.select("text").mapInArrow(_counted, "word binary, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def _ending(word: Column, endings: int) -> Column:
    """The class of a rare word among the endings, as ``Classes`` gives it."""
    bare = F.encode(F.btrim(word.cast("string"), F.lit(".,;:!?")), "UTF-8")
    start = F.greatest(F.lit(1), F.octet_length(bare) - (LAST - 1))
    return (F.crc32(bare.substr(start, F.lit(LAST))) % endings).cast("int")


def train(docs: DataFrame, part: Column, key: Column | None = None) -> tuple[Model, DataFrame]:
    """Fit on all of ``docs`` (text); ``part`` is a whole number that deals them into rounds. Also returns all word counts.

    ``key``, a 64-bit hash (of the text unless given), deals documents into streams and orders
    them there, so the model does not depend on the input's partitions. Documents of one key are
    read one after another by one task. Counts cover every word of every document. The driver
    keeps the ``COUNTS`` most frequent words, one sum per class and the parameters; the streams'
    parameters are added up by ``ADDERS`` tasks before they reach it.
    """
    spark = docs.sparkSession
    ship_package(spark)
    counts = settle(_word_counts(docs))
    end = F.col("word") == F.lit(END_WORD)
    total, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    room, least = COUNTS, None  # the least count of which all words still fit; found without sending words
    for r in counts.where(~end).groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(COUNTS).collect():
        room -= r.words
        if room < 0:
            break
        least = r.n
    top = sorted(counts.where(~end & (F.col("n") >= least)).collect(), key=lambda r: (-r.n, r.word)) if least else []
    layout = Layout.of(vocabulary, len(top))
    frequent = [bytes(r.word) for r in top[: layout.words]]
    known = {bytes(r.word): r.n for r in top}
    ends = counts.where(end).first()
    if ends:
        known[END_WORD] = ends.n
    rare = counts.where(~end)
    if frequent:
        rare = rare.where(~F.col("word").isin(frequent))
    rare = rare.groupBy(_ending(F.col("word"), layout.endings).alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    seen, kinds = np.zeros(layout.end + 1), np.zeros(layout.end + 1)
    for r in rare.collect():
        seen[layout.words + r.ending], kinds[layout.words + r.ending] = r.n, r.words
    for i, w in enumerate(frequent):
        seen[i], kinds[i] = known[w], 1
    seen[layout.end], kinds[layout.end] = known.get(END_WORD, 0), 1
    # the mass of a class: its known words, and one unseen word in a class of rare ones
    kinds[layout.words : layout.end] += 1
    mass = seen + SMOOTH * kinds
    share = mass + 1e-9
    share /= share.sum()
    p = Parameters.start(share, layout)
    key = F.xxhash64("text") if key is None else key
    streams = max(1, math.ceil(total / ROUNDS / STREAM))
    for turn in range(ROUNDS):
        mine = docs.where(F.pmod(part, F.lit(ROUNDS)) == turn)
        mine = mine.select(F.pmod(key, F.lit(streams)).cast("bigint").alias("stream"), key.alias("key"), "text")
        mine = mine.repartition(streams, "stream").sortWithinPartitions("stream", "key", F.xxhash64("text"))
        mine = mine.select("stream", "text")
        sent = mine.mapInArrow(_trained(p.flat(), share, frequent, layout, turn), "tokens bigint, sums binary")
        parts = sent.repartition(ADDERS).mapInArrow(_added, "tokens bigint, sums binary").collect()
        tokens = sum(r.tokens for r in parts)
        if tokens:
            p = Parameters.of(sum(np.frombuffer(r.sums) for r in parts) / tokens, layout)
    return Model(p, layout, frequent, known, total, vocabulary, mass), counts


def _scored(shared):
    """Per text a row with what the broadcast counts know, and a row for each rarer word."""

    def run(batches):
        model: Model = shared.value
        numbers, unit = Numbers(model), model.unit
        known = numbers.known
        classes = numbers.class_of[:known]
        within = np.log10(model.mass * unit)
        base = np.log10((np.fromiter(model.counts.values(), float, known) + SMOOTH) * unit)
        # log share of a word in its class: none for a frequent word, which is all of its class
        share = np.where(classes < model.layout.words, 0.0, base - within[classes])
        base, share = np.append(base, 0.0), np.append(share, 0.0)  # a rarer word meets its count in the join
        end_base = base[numbers.kept[END_WORD]] if END_WORD in model.counts else math.log10(SMOOTH * unit)
        for b in (b.slice(i, AT_ONCE) for b in batches for i in range(0, b.num_rows, AT_ONCE)):
            texts = [words_of(t) for t in b.column("text").to_pylist()]
            numbers.trim()
            n = np.array([len(w) for w in texts])
            of = np.repeat(np.arange(len(n)), n)
            number = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, len(of))
            code, low = numbers.class_of[number], np.minimum(number, known)
            rare = low == known
            c = np.full(len(of) + 3 * len(n), model.layout.start, np.int32)
            c[np.arange(len(of)) + 3 * of + 2] = code
            c[np.cumsum(n + 3) - 1] = model.layout.end
            inner = np.bincount(of, np.where(rare, -within[code], share[low]), len(n))  # whole numbers if all are empty
            inner = inner + model.texts_scored(c, n + 1) / math.log(10)
            pair, times = np.unique(of[rare] * (known + len(numbers.rarer)) + number[rare], return_counts=True)
            text, word = np.divmod(pair, known + len(numbers.rarer))
            # the key of a text's own row is no word: it holds a space, and it spreads the rows
            r = np.column_stack([b.column(x).to_numpy() for x in ("r1", "r2")])
            keys = [numbers.rarer[i] for i in (word - known).tolist()] + [b" " + x.tobytes() for x in r]
            none = np.zeros(len(pair), np.int64)
            own = np.concatenate([none, n + 1])
            cols = [pa.array(keys, pa.binary())]
            cols += [pa.array(np.concatenate([x[text], x])) for x in r.T]
            cols.append(pa.array(np.concatenate([times, n * 0]), pa.int64(), mask=own > 0))
            seen = n - np.bincount(of[rare], minlength=len(n)) + (END_WORD in model.counts)
            cols += [pa.array(own), pa.array(np.concatenate([none, seen]))]
            cols += [pa.array(np.concatenate([none * 0.0, x])) for x in (np.bincount(of, base[low], len(n)) + end_base, inner)]
            yield pa.RecordBatch.from_arrays(cols, ["word", "r1", "r2", "times", "tokens", "known", "base", "model"])

    return run


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """(r1, r2, copies, n_tokens, n_known, base_score, score) per distinct row hash of ``docs`` (r1, r2, text).

    Words beyond the broadcast counts go, once per text, to a join with all counts; they are rare
    by definition, and what only unseen text repeats is split by the skew join.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = "word binary, r1 bigint, r2 bigint, times bigint, tokens bigint, known bigint, base double, model double"
    rows = docs.select("r1", "r2", "text").mapInArrow(_scored(shared), schema)
    rows = rows.join(counts, "word", "left")
    seen = F.coalesce(F.col("n"), F.lit(0))
    value = F.log10((seen + F.lit(SMOOTH)) * F.lit(model.unit)) * F.col("times")
    is_text = F.col("times").isNull()
    per = rows.groupBy("r1", "r2").agg(
        F.count_if(is_text).alias("copies"),
        F.sum("tokens").alias("tokens"),
        F.sum(F.when(is_text, F.col("known")).when(seen > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.when(is_text, F.col("base")).otherwise(value)).alias("base"),
        F.sum(F.when(is_text, F.col("model")).otherwise(value)).alias("model"),
    )
    each = {c: F.col(c) / F.col("copies") for c in ("tokens", "known", "base", "model")}
    return per.select(
        "r1", "r2", "copies",
        each["tokens"].cast("bigint").alias("n_tokens"), each["known"].cast("bigint").alias("n_known"),
        each["base"].alias("base_score"), each["model"].alias("score"),
    )


def held_out(id: Column) -> Column:
    return id_hash(id, 10) == 0


def train_and_score(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every row of ``docs``, learning from those that are not held out.

    A null text is empty: one token, the end. Repeated rows have equal results, one row each;
    null ids count as the empty text for the fold. Without training documents every word is
    unseen and the model is uniform over its classes.
    """
    r1, r2 = hash_pair(F.col(f"`{id}`"), F.col(f"`{text}`"))
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), r1.alias("r1"), r2.alias("r2"))
    model, counts = train(rows.where(~held_out(F.col("id"))), id_hash(F.col("id"), 10), F.col("r1"))
    scored = score(rows, model, counts).drop("copies")
    out = rows.select("id", "r1", "r2").join(scored, ["r1", "r2"])
    return out.select(
        F.col("id").alias(id),
        held_out(F.col("id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


@query("op5_lm_scoring")
def op5_lm_scoring(spark, folder):
    return train_and_score(table(spark, folder, "documents").select("doc_id", "text"))
