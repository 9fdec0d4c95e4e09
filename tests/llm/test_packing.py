"""Packing against a plain encoding of every text, and the plan against its own rules."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwright.llm.packing import Encoder, fill, pack, plan, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
ODD = ["", " ", "a  b", "a\n b", " lead", "trail ", "it's  \t x", "<|endoftext|> x", "é b c", "x  y", "日本 語", "a 's b"]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_path())


def plainly(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_remembered_words_give_the_ids_of_the_whole_text(spark, encoder):
    texts = ODD + [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == plainly(encoder, t), t[:80]


@settings(deadline=None)
@given(st.lists(st.sampled_from([" ", "\n", "a", "é", "1", "'s", ".", " ", "word"]), max_size=12).map("".join))
def test_encoder_on_any_mixture(text):
    e = _ENCODER[0] if _ENCODER else _ENCODER.append(Encoder(tokenizer_path())) or _ENCODER[0]
    assert np.frombuffer(e.encode(text), "<u4").tolist() == plainly(e, text)


_ENCODER = []


def check(rows, texts, encoder, window):
    ids = {d: plainly(encoder, t or "") + [0] for d, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
    assert set(by_doc) == set(ids)
    for d, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(ids[d])
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    assert sorted(by_seq) == list(range(len(by_seq)))
    return len(by_seq) - -(-sum(len(v) for v in ids.values()) // window)


def test_whole_table(spark, encoder):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pack(docs, tokenizer_path()).collect()
    assert check(rows, texts, encoder, 1024) <= 2  # sequences above the least possible


def test_nulls_repeats_empty_and_clashing_columns(spark, encoder):
    rows = [(1, None, 5, "x"), (2, "", 5, None), (3, "a b " * 3000, 5, "y"), (None, "one", 1, "z"), (4, "same", 1, ""), (4, "same", 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, sequence_id string")
    out = pack(docs, tokenizer_path()).collect()
    assert Counter(r.doc_id for r in out if r.start == 0) == {1: 1, 2: 1, 3: 1, None: 1, 4: 2}
    assert [r.length for r in out if r.doc_id == 1] == [1]
    assert pack(docs.limit(0), tokenizer_path()).count() == 0


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1, max_size=12))
def test_plan_places_every_piece_once(histogram):
    window, used = 40, defaultdict(list)
    fullness = Counter()
    for length, first, last, seq, copies, _ in plan(histogram, window):
        used[length].append((first, last))
        for s in range(seq, seq + (last - first) // copies):
            fullness[s] += copies * length
    for length, n in histogram.items():
        at = 0
        for first, last in sorted(used[length]):
            assert first == at
            at = last
        assert at == n
    assert max(fullness.values()) <= window


@given(st.dictionaries(st.integers(1, 25), st.integers(1, 4), min_size=1, max_size=6))
def test_fill_is_closest(left):
    window, longest = 25, max(left)
    sums = {longest}
    for length, n in left.items():
        sums = {s + k * length for s in sums for k in range(n - (length == longest) + 1) if s + k * length <= window}
    chosen = fill(left, window)
    assert all(left[k] >= c for k, c in chosen.items())
    assert sum(k * c for k, c in chosen.items()) == max(sums)
