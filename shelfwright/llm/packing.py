"""Packing token sequences by minimum bin slack.

Documents are cut into pieces of a window and a remainder. Which remainders share a window is
planned on the histogram of piece lengths alone: a bitset subset-sum program over the lengths
still there picks the multiset that fills a window closest to its capacity, that choice is used
as often as the counts allow, and so on until nothing is left. A plan has at most as many
choices as there are lengths, whatever the number of documents. Every piece then finds its place
from its rank among the pieces of its length.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwright.llm.common import query, table
from shelfwright.session import settle, ship_package

WINDOW = 1024
#: Ranks among the pieces of one length are counted in so many groups at least, of about that many pieces.
GROUPS, GROUP = 16, 1 << 16
#: Words whose ids a Python worker remembers.
REMEMBERED = 500_000

# Fixed value: how byte-level vocabularies of this kind split text
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space next to other white space, or marks that may be a special token: encode such a text as a whole.
WHOLE = re.compile(r"\s | \s|^\s|\s$|<\|")
_ENCODERS: dict[str, "Encoder"] = {}


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if it prints, else the next free above 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class _Words(dict):
    """Ids of a word with the space before it, encoded when it is first asked for."""

    def __init__(self, vocabulary: dict[str, int]):
        import tiktoken

        byte_of = _byte_of()
        ranks = {bytes(map(byte_of.__getitem__, w)): i for w, i in vocabulary.items()}
        self.encode = tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = array("I", self.encode(" " + word)).tobytes()
        return ids


class Encoder:
    """Token ids of a byte-level vocabulary as little-endian 32-bit bytes.

    Its splitting never joins what stands before a single space with what stands after it, so the
    ids of a text are those of its words, each with its space. Words are encoded once and
    remembered, by the merges of the same vocabulary; all else goes to the tokenizer as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.words = _Words({w: i for w, i in vocabulary.items() if w not in special})

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if WHOLE.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        if len(self.words) > REMEMBERED:
            self.words.clear()
        return array("I", self.words.encode(first)).tobytes() + b"".join(map(self.words.__getitem__, rest))


def _pieces(path: str, window: int):
    def run(batches):
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))
        end = np.array([0], "<u4").tobytes()
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for row, (doc, text) in enumerate(zip(b.column("doc").to_pylist(), b.column("text").to_pylist())):
                ids = encoder.encode(text or "") + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    length = min(window, n - start)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    for c, v in zip(cols, (doc, start, length, crc, n, row)):
                        c.append(v)
            kinds = [b.schema.field("doc").type, pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return run


def fill(left: dict[int, int], window: int) -> dict[int, int]:
    """The multiset {length: copies} out of ``left`` that fills ``window`` closest, the longest piece always in it."""
    longest = max(left)
    reach, steps = 1 << longest, []
    mask = (1 << (window + 1)) - 1
    for length in sorted(left, reverse=True):
        copies = min(left[length] - (length == longest), (window - longest) // length)
        steps.append((length, copies, reach))
        unit = 1
        while copies > 0:
            take = min(unit, copies)
            reach |= (reach << (length * take)) & mask
            copies -= take
            unit *= 2
        if reach >> window & 1:
            break
    at = reach.bit_length() - 1
    chosen = {longest: 1}
    for length, copies, before in reversed(steps):
        k = 0
        while not before >> (at - k * length) & 1:
            k += 1
        if k:
            chosen[length] = chosen.get(length, 0) + k
            at -= k * length
    return chosen


def plan(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, copies in a sequence, offset) for all pieces."""
    left = {k: v for k, v in histogram.items() if v}
    used: dict[int, int] = {}
    out, sequence = [], 0
    while left:
        chosen = fill(left, window)
        times = min(left[k] // c for k, c in chosen.items())
        offset = 0
        for length, c in chosen.items():
            at = used.get(length, 0)
            out.append((length, at, at + c * times, sequence, c, offset))
            used[length] = at + c * times
            offset += c * length
            left[length] -= c * times
            if not left[length]:
                del left[length]
        sequence += times
    return out


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents with their places: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and one id 0; a null text is empty, so it still has that id.
    Every row is a document of its own; repeated rows are packed each, null ids are carried.
    The texts are encoded once, into a narrow table in the shared folder; the driver sees one
    count per length.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(f"`{id}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    pieces = settle(rows.mapInArrow(_pieces(tokenizer, window), schema))
    order = ["doc", "start", "ids_crc32", "doc_tokens"]
    groups = max(GROUPS, -(-pieces.count() // GROUP))
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64(*order), F.lit(groups)))
    counts = settle(grouped.groupBy("length", "group").count())
    histogram = {r.length: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "group").orderBy(*order)) - 1
    ranked = grouped.withColumn("rank", rank).join(counts, ["length", "group"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    fields = "length bigint, first bigint, last bigint, sequence bigint, copies bigint, place bigint"
    places = spark.createDataFrame(plan(histogram, window), fields)
    inside = (ranked["length"] == places["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    placed = ranked.join(F.broadcast(places), inside).drop(places["length"])
    nth = F.col("rank") - F.col("first")
    return placed.select(
        F.col("doc").alias(id),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("sequence") + F.floor(nth / F.col("copies"))).alias("sequence_id"),
        (F.col("place") + nth % F.col("copies") * F.col("length")).alias("offset"),
    )


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op7_packing")
def op7_packing(spark, folder):
    return pack(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path())
