"""Alignment of two tokenizers over a corpus by external spill counting.

Every text is encoded by both vocabularies. Byte offsets where a token of each ends cut the text
into groups and link the two tokens. How often an id pair is linked in the whole corpus is counted
outside of memory: tasks gather (pair, document) records, sort them once a buffer is full, and
spill them, radix-partitioned by the second side's id, as zstd runs. Runs of one partition are
merged through a heap, bounded numbers of them at a time, which counts every pair; the counts
are summed over the merges, and in the order of the second side each of its ids finds its highest.
Then every run is read again next to the counts of its own merge, and what its pairs give to
each document streams back to the documents of the spill it came from.

Nothing is grouped by pair and document but inside a spill, so a pair found in every document
costs no task more than its share.

Null and empty texts, and texts that either side does not give back byte for byte, have no tokens:
zeros and an empty digest. Ids may be null or repeated, every row is a document of its own; other
columns, whatever their names, take no part. Ties for the highest count all count as best. An
empty table gives no rows. Texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.common import query, table
from shelfwright.llm.packing import SPLIT, _byte_of
from shelfwright.session import settle, ship_package

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Links a task holds before it spills them; documents of one spill at most; records of one block of a run.
SPILL, SPILL_DOCS, BLOCK = 1 << 20, 1 << 16, 1 << 16
#: Partitions of a spill; runs that are merged at a time, about.
RADIX, MERGED = 16, 64
#: Characters that are encoded at a time; a longer text alone.
CHUNK = 1 << 20

_LOADED: dict[tuple[str, str], "Pair"] = {}


def vocabulary_file(name: str) -> str:
    """A path as it is, else the public file of that name; found where it is asked for, in the worker."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteLevel:
    """A byte-level vocabulary: ``encode`` gives ids, ``entries`` the bytes of each. Special tokens are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        byte_of = _byte_of()
        words = {w: i for w, i in tokenizer.get_vocab(with_added_tokens=True).items() if w not in special}
        ranks = {bytes(map(byte_of.__getitem__, w)): i for w, i in words.items()}
        self.entries = [b""] * (max(ranks.values()) + 1)
        for entry, i in ranks.items():
            self.entries[i] = entry
        merges = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.one = merges.encode_ordinary

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.one(" " + t) for t in texts]


class Pieces:
    """A piece vocabulary that adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = [self._entry(i) for i in range(self.model.get_piece_size())]

    def _entry(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Pair:
    """Both vocabularies in one worker, the lengths of their tokens, and how ids are written in a digest."""

    def __init__(self, first: str, second: str):
        self.a, self.b = ByteLevel(vocabulary_file(first)), Pieces(vocabulary_file(second))
        self.lengths = [np.array([len(e) for e in v.entries], np.int64) for v in (self.a, self.b)]
        self.width = len(self.a.entries)
        # id * 2, + 1 for the last of its group; the second side's ids after the first's
        ends = ((",", "|"), (",", ";"))
        self.written = [f"{i}{end}".encode() for v, e in zip((self.a, self.b), ends) for i in range(len(v.entries)) for end in e]

    @classmethod
    def load(cls, first: str, second: str) -> "Pair":
        return _LOADED.get((first, second)) or _LOADED.setdefault((first, second), cls(first, second))

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where one of them does not give the text back."""
        sides = self.a.encode(texts), self.b.encode(texts)
        out: tuple[list, list] = ([], [])
        for text, a, b in zip(texts, *sides):
            whole = (" " + text).encode()
            same = all(
                b"".join(map(v.entries.__getitem__, ids)) == whole for v, ids in ((self.a, a), (self.b, b))
            )
            out[0].append(a if same and text else [])
            out[1].append(b if same and text else [])
        return out


def align_texts(pair: Pair, texts: list[str]):
    """Per text n_a, n_b, n_groups and its digest; per link its document, first and second id.

    Tokens hold a byte at least, so of each side one token ends at an offset, and the groups are
    the links.
    """
    sides = pair.tokens(texts)
    counts = [np.fromiter(map(len, s), np.int64, len(s)) for s in sides]
    ids = [np.fromiter((i for s in side for i in s), np.int64, int(n.sum())) for side, n in zip(sides, counts)]
    ends = [np.cumsum(lengths[i]) for lengths, i in zip(pair.lengths, ids)]
    # both sides spell the same bytes, so offsets through all texts agree
    _, at_a, at_b = np.intersect1d(*ends, assume_unique=True, return_indices=True)
    doc = np.searchsorted(np.cumsum(counts[0]), at_a, side="right")
    groups = np.bincount(doc, minlength=len(texts))

    last = [np.zeros(len(i), np.int64) for i in ids]
    for flag, at in zip(last, (at_a, at_b)):
        flag[at] = 1
    group = [np.cumsum(flag) - flag for flag in last]
    before_b = np.concatenate([[0], at_b + 1])
    place = np.arange(len(ids[0])) + before_b[group[0]], np.arange(len(ids[1])) + at_a[group[1]] + 1
    codes = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    codes[place[0]] = ids[0] * 2 + last[0]
    codes[place[1]] = (ids[1] + pair.width) * 2 + last[1]
    digests, start, written = [], 0, pair.written.__getitem__
    for n in (counts[0] + counts[1]).tolist():
        spelled = b"".join(map(written, codes[start : start + n].tolist()))
        digests.append(hashlib.sha256(spelled[:-1]).hexdigest() if n else "")
        start += n
    return counts[0], counts[1], groups, digests, doc, ids[0][at_a], ids[1][at_b]


# ---- runs -------------------------------------------------------------------------------


def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=1)


def packed_block(key: np.ndarray, doc: np.ndarray, times: np.ndarray) -> bytes:
    """Records sorted by key, then document, as one zstd frame: distinct keys, then the documents of each."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    keys = key[first]
    parts = [
        np.array([len(keys), len(key)], "<i8"),
        np.diff(keys, prepend=0).astype("<i8"),
        np.diff(first, append=len(key)).astype("<i4"),
        doc.astype("<u2"),
        times.astype("<i4"),
    ]
    return _zstd().compress(b"".join(p.tobytes() for p in parts))


def read_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, documents of each key, and the documents and times of the records."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(block)
    n, records = np.frombuffer(raw, "<i8", 2).tolist()
    at, out = 16, []
    for kind, size in (("<i8", n), ("<i4", n), ("<u2", records), ("<i4", records)):
        out.append(np.frombuffer(raw, kind, size, at))
        at += out[-1].nbytes
    return np.cumsum(out[0]), out[1].astype(np.int64), out[2].astype(np.int64), out[3].astype(np.int64)


def spilled(pair_width: int, doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """(partition, blocks) of one buffer: by the second id's last digits, sorted side-major."""
    key = b * pair_width + a
    for part in range(RADIX):
        mine = np.flatnonzero(b % RADIX == part)
        if not len(mine):
            continue
        record, times = np.unique(key[mine] * SPILL_DOCS + doc[mine], return_counts=True)
        keys, docs = np.divmod(record, SPILL_DOCS)
        cuts = range(0, len(record), BLOCK)
        yield part, [packed_block(*(x[i : i + BLOCK] for x in (keys, docs, times))) for i in cuts]


def merged_counts(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct keys and their links over all runs, piece by piece; one block of a run is held at a time.

    The heap says which run's block ends first: up to that key all blocks held are complete, so
    that much of each is taken out and counted together.
    """
    rest = [iter(r) for r in runs]
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def load(run: int) -> None:
        block = next(rest[run], None)
        if block is not None:
            keys, docs, _, times = read_block(block)
            links = np.add.reduceat(times, np.concatenate([[0], np.cumsum(docs)[:-1]]))
            held[run] = keys, links
            heapq.heappush(heap, (int(keys[-1]), run))

    for run in range(len(runs)):
        load(run)
    tail_key, tail_links = None, 0
    while heap:
        limit = heap[0][0]
        taken = []
        for run, (keys, links) in held.items():
            cut = int(np.searchsorted(keys, limit, side="right"))
            if cut:
                taken.append((keys[:cut], links[:cut]))
                held[run] = keys[cut:], links[cut:]
        done = []
        while heap and heap[0][0] <= limit:
            done.append(heapq.heappop(heap)[1])
        for run in done:
            del held[run]
            load(run)
        keys, links = (np.concatenate(x) for x in zip(*taken))
        keys, where = np.unique(keys, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, where, links)
        # a run's next block may go on with the key this one ended with
        if tail_key is not None:
            if keys[0] == tail_key:
                total[0] += tail_links
            else:
                yield np.array([tail_key]), np.array([tail_links])
        tail_key, tail_links = int(keys[-1]), int(total[-1])
        if len(keys) > 1:
            yield keys[:-1], total[:-1]
    if tail_key is not None:
        yield np.array([tail_key]), np.array([tail_links])


def summed(place: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of 64-bit values by place."""
    high, low = value >> 32, value & 0xFFFFFFFF
    parts = [np.bincount(place, weights=v, minlength=size).astype(np.int64) for v in (high, low)]
    return (parts[0] << 32) + parts[1]


# ---- Spark ------------------------------------------------------------------------------

_SPILL = "spill bigint, place int, doc {}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, part int, blocks array<binary>"


def _spill(first: str, second: str, size: int):
    def run(batches):
        from pyspark import TaskContext

        pair = Pair.load(first, second)
        number = TaskContext.get().partitionId() << 32
        links: list[tuple] = []
        held = docs = 0

        def rows(kind, spill, place, doc, numbers, digests, part, blocks):
            n = len(place)
            none = pa.nulls(n, pa.int64())
            cols = [pa.array(np.full(n, spill), pa.int64()), pa.array(place, pa.int32())]
            cols += [doc if doc is not None else pa.nulls(n, kind)]
            cols += [pa.array(x, pa.int64()) for x in numbers] if numbers else [none] * 3
            cols += [pa.array(digests, pa.string()), pa.array(part, pa.int32()), pa.array(blocks, pa.list_(pa.binary()))]
            names = "spill place doc n_a n_b n_groups groups_sha256 part blocks".split()
            return pa.RecordBatch.from_arrays(cols, names)

        def flush(kind):
            nonlocal number, held, docs
            if links:
                parts = list(spilled(pair.width, *(np.concatenate(x) for x in zip(*links))))
                for part, blocks in parts:
                    yield rows(kind, number, [None], None, None, [None], [part], [blocks])
            links.clear()
            number, held, docs = number + 1, 0, 0

        kind = None
        for b in batches:
            kind = b.schema.field("doc").type
            texts = [t or "" for t in b.column("text").to_pylist()]
            start = 0
            while start < len(texts):
                end, chars = start, 0
                while end < len(texts) and (end == start or chars + len(texts[end]) <= CHUNK) and end - start < SPILL_DOCS:
                    chars += len(texts[end])
                    end += 1
                n = end - start
                if held and (held >= size or docs + n > SPILL_DOCS):
                    yield from flush(kind)
                elif docs + n > SPILL_DOCS:
                    number, docs = number + 1, 0
                *numbers, digests, doc, a, c = align_texts(pair, texts[start:end])
                none = [None] * n
                place = np.arange(docs, docs + n, dtype=np.int32)
                yield rows(kind, number, place, b.column("doc").slice(start, n), numbers, digests, none, none)
                if len(doc):
                    links.append((doc + docs, a, c))
                held, docs, start = held + len(doc), docs + n, end
        if held:
            yield from flush(kind)

    return run


def _counted(data: pa.Table) -> pa.Table:
    runs = data.column("blocks").to_pylist()
    pieces = list(merged_counts(runs))
    key, n = (np.concatenate(x) for x in zip(*pieces))
    return pa.table(
        {
            "part": pa.array(np.full(len(key), data.column("part")[0].as_py()), pa.int32()),
            "merge": pa.array(np.full(len(key), data.column("merge")[0].as_py()), pa.int64()),
            "pair": pa.array(key, pa.int64()),
            "n": pa.array(n, pa.int64()),
        }
    )


def _streamed(runs: pa.Table, counts: pa.Table) -> pa.Table:
    """What every run's pairs give to the documents of its spill."""
    out: list[list] = [[], [], [], []]
    if len(runs):
        counts = counts.sort_by("pair")
        key, total, best = (counts.column(c).to_numpy() for c in ("pair", "total", "best"))
        for spill, blocks in zip(runs.column("spill").to_pylist(), runs.column("blocks")):
            sums: dict[str, np.ndarray] = {}
            for block in blocks:
                keys, docs, doc, times = read_block(block.as_py())
                at = np.repeat(np.searchsorted(key, keys), docs)
                size = int(doc.max()) + 1
                for name, value in (("best", times * best[at]), ("sum", times * total[at])):
                    new, old = summed(doc, value, size), sums.get(name)
                    if old is not None and len(old) > len(new):
                        new, old = old, new
                    if old is not None:
                        new[: len(old)] += old
                    sums[name] = new
            there = np.flatnonzero(sums["sum"])
            for col, v in zip(out, (spill, there, sums["best"][there], sums["sum"][there])):
                col.append(v)
    kinds = pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())
    names = "spill", "places", "best", "sums"
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, out, kinds)})


def _returned(docs: pa.Table, given: pa.Table) -> pa.Table:
    place = docs.column("place").to_numpy()
    size = int(place.max()) + 1 if len(place) else 0
    sums = np.zeros((2, size), np.int64)
    for there, best, total in zip(*(given.column(c) for c in ("places", "best", "sums"))):
        at = there.values.to_numpy()
        sums[0][at] += best.values.to_numpy()
        sums[1][at] += total.values.to_numpy()
    kept = docs.drop_columns(["spill", "place"])
    return kept.append_column("n_best", pa.array(sums[0][place])).append_column("count_sum", pa.array(sums[1][place]))


def spill(docs: DataFrame, first: str, second: str, size: int = SPILL, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode once and write: rows of documents (``part`` null) and rows of runs (``part`` set), by spill."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return settle(rows.mapInArrow(_spill(first, second, size), _SPILL.format(kind)))


def pair_counts(written: DataFrame, merged: int = MERGED) -> tuple[DataFrame, DataFrame]:
    """The runs of ``written``, dealt into merges of bounded size, and (part, merge, pair, n), what each merge counted."""
    runs = written.where("part is not null").select("spill", "part", "blocks")
    merges = 1 + written.where("part is not null").count() // (RADIX * merged)
    runs = runs.withColumn("merge", F.pmod(F.xxhash64("spill"), F.lit(merges)))
    counts = runs.groupBy("part", "merge").applyInArrow(_counted, "part int, merge bigint, pair bigint, n bigint")
    return runs, settle(counts)


def highest(counts: DataFrame, width: int) -> DataFrame:
    """(pair, total, best) over the corpus; best is 1 if no other pair of the second id has a higher total.

    An id has at most as many pairs as the first side has ids, each counted before it gets here.
    """
    totals = settle(counts.groupBy("pair").agg(F.sum("n").alias("total")))
    side = F.floor(F.col("pair") / width)
    most = totals.groupBy(side.alias("b")).agg(F.max("total").alias("most"))
    both = totals.withColumn("b", side).join(most, "b")
    return both.select("pair", "total", (F.col("total") == F.col("most")).cast("bigint").alias("best"))


def align(
    docs: DataFrame,
    first: str = FIRST,
    second: str = SECOND,
    id: str = "doc_id",
    text: str = "text",
    size: int = SPILL,
    merged: int = MERGED,
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``."""
    written = spill(docs, first, second, size, id, text)
    runs, counts = pair_counts(written, merged)
    width = len(Pair.load(first, second).a.entries)
    known = counts.select("part", "merge", "pair").join(highest(counts, width), "pair")
    schema = "spill bigint, places array<int>, best array<bigint>, sums array<bigint>"
    given = runs.groupBy("part", "merge").cogroup(known.groupBy("part", "merge")).applyInArrow(_streamed, schema)
    rows = written.where("part is null").drop("part", "blocks")
    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_best bigint, count_sum bigint"
    out = rows.groupBy("spill").cogroup(given.groupBy("spill")).applyInArrow(_returned, schema)
    return out.select(
        F.col("doc").alias(id),
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        "n_best",
        "count_sum",
        "groups_sha256",
    )


@query("op12_token_alignment")
def op12_token_alignment(spark, folder):
    return align(table(spark, folder, "documents").select("doc_id", "text"))
