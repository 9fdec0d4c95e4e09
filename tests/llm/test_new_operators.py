"""Manifest, token alignment and language identification on small odd tables, against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwright.llm import language_id, merkle_manifest, token_alignment
from shelfwright.llm.merkle_manifest import manifest

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "No Id here at all today", None, "b", 1)]
    rows += [(3, long, "en", "a", 1), (4, "Same words", "en", None, 1), (4, "Same words", "en", None, 1)]
    rows += [(5, "Same words", "en", "b", 1), (5, "Other words", "en", "b", 1), (6, " \n\t\n ", "en", "", 1)]
    rows += [(10 + i, f"Row {i}", "de", "big", i) for i in range(300)] + [(None, "none", None, "big", 0)] * 20
    return spark.createDataFrame(rows, DOCS)


# ---- manifest ---------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(level):
    """Every member's way up as (before, after), and the root."""
    ways, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        runs = [level[i : i + 16] for i in range(0, len(level), 16)]
        for way, place in zip(ways, at):
            run = runs[place // 16]
            way.append(("".join(run[: place % 16]), "".join(run[place % 16 + 1 :])))
        at, level = [p // 16 for p in at], [sha("".join(r)) for r in runs]
    return ways, level[0]


def plain_manifest(rows):
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    out, roots = [], []
    for s in sources:
        mine = [(r, leaf(r, r.text)) for r in rows if r.source == s]
        mine.sort(key=lambda m: (m[0].doc_id is not None, m[0].doc_id or 0, m[1]))
        ways, root = tree([m[1] for m in mine])
        roots.append(root)
        out.append((mine, ways))
    tops, top = tree(roots) if roots else ([], None)
    found = []
    for (mine, ways), onward, root in zip(out, tops, roots):
        for (r, own), way in zip(mine, ways):
            id = r.doc_id
            d = leaf(r, lower(r.text)) if id is not None and zlib.crc32(str(id).encode()) % 5 == 0 else own
            for before, after in way + onward:
                d = sha(before + d + after)
            proof = sha("".join(b + a for b, a in way + onward))
            found.append((id, own, root, top, proof, d, d == top))
    return sorted(found, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_manifest_of_odd_rows(spark):
    docs = odd_docs(spark)
    assert rows_of(manifest(docs)) == plain_manifest(docs.collect())


@pytest.mark.parametrize("n, sources", [(1, 1), (17, 1), (900, 300)])
def test_manifest_of_any_shape(spark, n, sources):
    rows = [(i, f"Text {i}", None, f"s{i % sources}", i) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    assert rows_of(manifest(docs)) == plain_manifest(docs.collect())


def test_manifest_split_over_ranges_and_shuffled_jumps(spark, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "FEW", 50)
    monkeypatch.setattr(merkle_manifest, "POINTED_BYTES", 0)
    docs = odd_docs(spark)
    assert rows_of(manifest(docs)) == plain_manifest(docs.collect())


def test_manifest_empty_and_clashing(spark):
    assert manifest(spark.createDataFrame([], DOCS)).count() == 0
    docs = odd_docs(spark)
    clash = docs.withColumns({c: F.lit("x") for c in ("src", "leaf", "row", "idx", "n", "tree", "path", "root")})
    assert rows_of(manifest(clash)) == rows_of(manifest(docs))


def test_manifest_sees_every_change(spark):
    docs = odd_docs(spark)
    root = manifest(docs).first().root
    for change in ({"lang": F.lit("x")}, {"n_chars": F.col("n_chars") + 1}, {"source": F.lit("one")}):
        assert manifest(docs.withColumns(change)).first().root != root
    assert manifest(docs.orderBy(F.rand(3))).first().root == root


# ---- alignment --------------------------------------------------------------------------


def plain_alignment(rows):
    from tokenizers import Tokenizer

    pair = token_alignment.Pair.load(token_alignment.FIRST, token_alignment.SECOND)
    first = Tokenizer.from_file(token_alignment.vocabulary_file(token_alignment.FIRST))
    first.encode_special_tokens = True
    docs, links = [], Counter()
    for r in rows:
        whole = (" " + r.text).encode() if r.text else b""
        sides = []
        if whole:
            ids = first.encode(" " + r.text, add_special_tokens=False).ids, pair.b.model.encode(r.text)
            for v, side in zip((pair.a, pair.b), ids):
                at, ends = 0, []
                for i in side:
                    at += len(v.entries[i])
                    ends.append((at, i))
                if b"".join(v.entries[i] for i in side) == whole:
                    sides.append(ends)
        if len(sides) < 2:
            docs.append((r.doc_id, 0, 0, [], ""))
            continue
        cuts = sorted({e for e, _ in sides[0]} & {e for e, _ in sides[1]})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for e, i in s if low < e <= high) for s in sides))
        mine = [(a, b) for e, a in sides[0] for f, b in sides[1] if e == f] if len(cuts) < 2000 else None
        if mine is None:
            ends = dict(sides[1])
            mine = [(a, ends[e]) for e, a in sides[0] if e in ends]
        links.update(mine)
        docs.append((r.doc_id, len(sides[0]), len(sides[1]), mine, sha(";".join(groups))))
    most = Counter()
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    return sorted(
        (
            (id, a, b, len(m), len(m), sum(links[x] == most[x[1]] for x in m), sum(links[x] for x in m), h)
            for id, a, b, m, h in docs
        ),
        key=repr,
    )


def alignment_docs(spark):
    texts = [None, "", " ", "two  spaces ", "Hello  <|endoftext|> <s> world </s>", "\n\t é ü 日本語 🎉", "x" * 700]
    texts += ["a b c"] * 30 + ["the same words again and again " * 40, "é ﬁ ½    x"]
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)] + [(7, "a b c")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    some = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").where("length(text) < 1500").limit(60)
    return docs.unionByName(some)


@pytest.mark.parametrize("size, merged", [(1 << 20, 64), (300, 2)])
def test_alignment(spark, size, merged):
    docs = alignment_docs(spark)
    assert rows_of(token_alignment.align(docs, size=size, merged=merged)) == plain_alignment(docs.collect())


def test_alignment_empty_and_clashing(spark):
    assert token_alignment.align(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = alignment_docs(spark).where("length(text) < 40")
    clash = docs.withColumns({c: F.lit("x") for c in ("doc", "place", "spill", "part", "blocks", "pair", "n_a")})
    assert rows_of(token_alignment.align(clash)) == rows_of(token_alignment.align(docs))


def test_runs_merge_to_plain_counts(monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK", 7)
    rnd = random.Random(5)
    runs, counts = [], Counter()
    for _ in range(9):
        n = rnd.randrange(1, 120)
        doc, a = np.array([rnd.randrange(4) for _ in range(n)]), np.array([rnd.randrange(6) for _ in range(n)])
        b = np.array([token_alignment.RADIX * rnd.randrange(3) for _ in range(n)])
        counts.update((b * 6 + a).tolist())
        [(part, blocks)] = token_alignment.spilled(6, doc, a, b)
        assert part == 0 and len(blocks) >= 1
        runs.append(blocks)
    pieces = list(token_alignment.merged_counts(runs))
    keys = np.concatenate([k for k, _ in pieces]).tolist()
    assert keys == sorted(set(keys)) and dict(zip(keys, np.concatenate([n for _, n in pieces]).tolist())) == counts


def test_sums_are_exact():
    value = np.array([2**61 + 1, 2**61 + 3, -5], np.int64)
    assert token_alignment.summed(np.array([0, 0, 1]), value, 3).tolist() == [2**62 + 4, -5, 0]


# ---- language ---------------------------------------------------------------------------

SPOKEN = {
    "aa": "the cat sat on the mat and the dog ran with the cat",
    "ab": "de kat zat op de mat en de hond liep met de kat",
    "ba": "el gato se sienta en la casa y el perro corre con el gato",
    "bb": "o gato senta na casa e o cão corre com o gato da casa",
}


def spoken(spark, per=40):
    rnd, rows = random.Random(2), []
    for lang, said in SPOKEN.items():
        for _ in range(per):
            words = said.split()
            rnd.shuffle(words)
            rows.append((len(rows), " ".join(words[: rnd.randrange(3, 12)]), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_of_odd_rows(spark):
    model = language_id.fit(spoken(spark))
    assert sorted(sum(model.groups, [])) == sorted(SPOKEN)
    rows = [(1, None), (2, ""), (None, "123 !?"), (4, "the dog sat with the cat 12"), (5, "o cão senta na casa")]
    rows += [(6, "de hond liep " * 50_000), (7, "²Ⅷ"), (4, "the dog sat with the cat 12")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("x"), "lang_pred": F.lit(1), "at": F.lit(2)})
    out = language_id.predict(docs, model)
    assert out.columns == ["doc_id", "text", "score", "lang_pred", "at"] and out.count() == len(rows)
    found = [(r.doc_id, r.lang_pred) for r in out.collect()]
    assert found == [(1, "und"), (2, "und"), (None, "und"), (4, "aa"), (5, "bb"), (6, "ab"), (7, "und"), (4, "aa")]
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in out.collect())


def test_language_without_labels_or_with_one(spark):
    docs = spoken(spark, 3)
    none = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    one = language_id.fit(docs.where("lang = 'ab'"))
    assert {(r.lang_pred, r.score) for r in language_id.predict(docs, one).collect()} == {("ab", 1.0)}
    assert language_id.predict(docs.limit(0), one).count() == 0


def test_copies_teach_once(spark):
    docs = spoken(spark, 20)
    copies = spark.createDataFrame([(None, "the same text", "cc")] * 300, "doc_id long, text string, lang string")
    model = language_id.fit(docs.unionByName(copies), fit_docs=10)
    assert sorted(sum(model.groups, [])) == sorted([*SPOKEN, "cc"])


def test_grams_by_pieces_equal_those_at_once(monkeypatch):
    text = "Straße 12 und Übermut, dann Ärger! " * 9
    whole = language_id.grams(text)
    monkeypatch.setattr(language_id, "PIECE", 11)
    assert all(np.array_equal(a, b) for a, b in zip(whole, language_id.grams(text)))


def test_machine_equals_a_plain_minimum():
    rnd = np.random.default_rng(3)
    dense = rnd.normal(size=(30, 4))
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    side = np.where(dense[:, 0] + 0.2 * rnd.normal(size=30) > 0, 1, -1)
    w = language_id.machine([(np.arange(4), v) for v in dense], side, 400)
    cost = {s: len(side) / (2 * (side == s).sum()) for s in (-1, 1)}

    def loss(w, b):
        miss = np.maximum(0, 1 - side * (dense @ w + b))
        return 0.5 * (w @ w + b * b) + language_id.COST * sum(cost[s] * m * m for s, m in zip(side, miss))

    best = loss(w[:4], w[-1])
    for _ in range(300):
        step = rnd.normal(size=5) * 0.02
        assert loss(w[:4] + step[:4], w[-1] + step[4]) > best - 1e-6


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.op13_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = out.where("held_out").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.97
