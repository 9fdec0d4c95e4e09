"""Embedding and exact nearest neighbours by squared Euclidean distance."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfwright.functions.encoders import HashedCounts
from shelfwright.schemas import CANDIDATE_TYPE
from shelfwright.session import settle, ship_package, use_all_cores

TOP_K = 10
_CANDIDATES = f"array<{CANDIDATE_TYPE.simpleString()}>"
_ATTRS = ["id", "name", "path", "numeric_path"]

#: Candidates of a tile, queries compared at once, numbers of the pairs whose distances are computed at once.
TILE, AT_ONCE, PAIRS = 1024, 1024, 1 << 22
#: Bytes of a block of either side, and of the candidate blocks one task holds, where both sides are cut.
BLOCK_BYTES, SIDE_BYTES = 1 << 20, 128 << 20
#: Candidates beyond which the queries are dealt into more parts than there are cores.
DEAL = 16_384
#: The position of no row.
NOWHERE = np.iinfo(np.int64).max


def embed(
    df: DataFrame, text: str, encoder: Callable = HashedCounts, out: str = "embedding"
) -> DataFrame:
    """Add a vector column. ``encoder`` is called once per Python worker to load the model."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = encoder()
        for batch in batches:
            vecs = np.ascontiguousarray(model.encode(batch.to_pylist()), dtype=np.float32)
            n, dim = vecs.shape
            offsets = np.arange(0, n * dim + 1, dim, dtype=np.int32)
            yield pa.ListArray.from_arrays(offsets, vecs.ravel())

    fn = F.arrow_udf(run, "array<float>").asNondeterministic()
    return use_all_cores(df).withColumn(out, fn(F.col(text)))


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    flat = flat.astype(np.float32 if flat.dtype == np.float32 else np.float64, copy=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


class Tiles:
    """Candidate vectors in tiles of at most ``TILE`` rows that lie near each other.

    The rows are halved at the median of their widest component until a tile is left. Per tile
    the centre and the radius are kept: no row of it is nearer to a query than the distance of the
    centre less the radius. ``pos`` has each row's place in the order that equal distances go by.
    """

    def __init__(self, vecs: np.ndarray, pos: np.ndarray | None = None):
        todo, parts = [np.arange(len(vecs))], []
        while todo:
            idx = todo.pop()
            if len(idx) <= TILE:
                parts.append(np.sort(idx))
                continue
            part = vecs[idx]
            wide = part[:, np.argmax(part.max(0) - part.min(0))]
            half = len(idx) // 2
            near = np.argpartition(wide, half)
            todo += [idx[near[half:]], idx[near[:half]]]
        order = np.concatenate(parts)
        self.vecs = np.ascontiguousarray(vecs[order])
        self.pos = order if pos is None else pos[order]
        self.cuts = np.cumsum([0, *map(len, parts)])
        tiles = [self.tile(t) for t in range(len(parts))]
        self.centres = np.stack([t.mean(0) for t in tiles])
        self.radii = np.array([np.sqrt(((t - c) ** 2).sum(1).max(initial=0)) for t, c in zip(tiles, self.centres)])
        self.squares = np.concatenate([np.einsum("ij,ij->i", t, t) for t in tiles])
        self.largest = self.squares.max(where=np.isfinite(self.squares), initial=0)

    def tile(self, t: int) -> np.ndarray:
        return self.vecs[self.cuts[t] : self.cuts[t + 1]].astype(np.float64)


class Best:
    """The k nearest rows so far of each of some queries, by distance, then position.

    A matrix product finds the contenders, every pair within rounding of the k-th distance
    included; only their distances are computed, term by term. So the result depends neither on
    how rows were batched nor on the order in which tiles come. Distances that are no number go last.
    """

    def __init__(self, queries: np.ndarray, k: int):
        self.q, self.k = queries.astype(np.float64), k
        self.sq = np.einsum("ij,ij->i", self.q, self.q)
        self.dist = np.full((len(queries), k), np.nan)
        self.pos = np.full((len(queries), k), NOWHERE)

    def meet(self, tiles: Tiles) -> None:
        """Take the rows of ``tiles`` in: the tile with the nearest centre first, then those still in reach."""
        slack = 1e-9 * (self.sq + tiles.largest + 1.0)
        centres = tiles.centres
        far = self.sq[:, None] - 2.0 * (self.q @ centres.T) + np.einsum("ij,ij->i", centres, centres)
        home = np.argmin(far, axis=1)
        least = np.maximum(np.sqrt(np.maximum(far, 0.0)) - tiles.radii, 0.0) ** 2
        for first in (True, False):
            for t in range(len(centres)):
                if first:
                    rows = np.nonzero(home == t)[0]
                else:
                    rows = np.nonzero((home != t) & ~(least[:, t] > self.dist[:, -1] + slack))[0]
                if len(rows):
                    self._meet_tile(rows, tiles, t, slack)

    def _meet_tile(self, rows: np.ndarray, tiles: Tiles, t: int, slack: np.ndarray) -> None:
        vecs, at = tiles.tile(t), tiles.cuts[t]
        gap = (-2.0 * self.q[rows]) @ vecs.T
        gap += tiles.squares[at : at + len(vecs)]
        bound = self.dist[rows, -1] - self.sq[rows]
        new = np.isnan(bound)
        if len(vecs) > self.k and new.any():
            bound[new] = np.partition(gap[new], self.k - 1, axis=1)[:, self.k - 1]
        out = gap > (bound + slack[rows])[:, None]
        hits = np.flatnonzero(np.logical_not(out, out=out))
        if not len(hits):
            return
        r, c = np.divmod(hits, len(vecs))
        # queries or candidates that hold no number leave no bound: at most so many pairs at once
        most = max(1, PAIRS // max(1, vecs.shape[1]))
        dist = np.concatenate(
            [((vecs[c[i : i + most]] - self.q[rows[r[i : i + most]]]) ** 2).sum(axis=1) for i in range(0, len(r), most)]
        )
        hit = np.unique(r)
        own = rows[hit]
        row = np.concatenate([np.repeat(hit, self.k), r])
        dist = np.concatenate([self.dist[own].ravel(), dist])
        pos = np.concatenate([self.pos[own].ravel(), tiles.pos[at + c]])
        order = np.lexsort((pos, dist, row))
        row = row[order]
        starts = np.searchsorted(row, hit)
        best = order[(starts[:, None] + np.arange(self.k)).ravel()].reshape(-1, self.k)
        self.dist[own], self.pos[own] = dist[best], pos[best]


def top_k(queries: np.ndarray, cands: np.ndarray | Tiles, k: int):
    """Positions and squared distances of the k nearest rows of ``cands``; equal distances go by position."""
    tiles = cands if isinstance(cands, Tiles) else Tiles(cands)
    k = min(k, len(tiles.pos))
    pos = np.empty((len(queries), k), dtype=np.int64)
    dist = np.empty((len(queries), k))
    for at in range(0, len(queries), AT_ONCE):
        best = Best(queries[at : at + AT_ONCE], k)
        best.meet(tiles)
        pos[at : at + AT_ONCE], dist[at : at + AT_ONCE] = best.pos, best.dist
    return pos, dist


def _as_lists(pos: np.ndarray, dist: np.ndarray, attrs: pa.Table, extra=()) -> pa.ListArray:
    """One list of candidate structs per query row."""
    n, k = pos.shape
    take = pa.array(pos.ravel())
    ranks = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n))
    cols = {"rank": ranks}
    for a in (*_ATTRS, *extra):
        cols[a] = attrs.column(a).take(take).combine_chunks()
    cols["distance"] = pa.array(dist.ravel())
    names = [f.name for f in CANDIDATE_TYPE.fields] + list(extra)
    arrays = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (cols[x] for x in names)]
    struct = pa.StructArray.from_arrays(arrays, names=names)
    return pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), struct)


def _ordered(candidates: DataFrame, vec: str, order: str, k: int) -> DataFrame:
    """Candidates that have a vector. Of equal vectors the first k by ``order`` stay: no other can be among k nearest."""
    cols = [F.col(a) if a in candidates.columns else F.lit(None).cast("string").alias(a) for a in _ATTRS]
    known = candidates.where(F.col(vec).isNotNull()).select(F.col(order).alias("_ord"), *cols, F.col(vec).alias("_vec"))
    equal = Window.partitionBy(F.xxhash64("_vec"), "_vec").orderBy("_ord")
    return known.withColumn("_nth", F.row_number().over(equal)).where(F.col("_nth") <= k).drop("_nth")


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = TOP_K,
    key: str = "query_id",
    vec: str = "embedding",
    order: str = "id",
    out: str = "candidates",
    max_bytes: int = 256 << 20,
) -> DataFrame:
    """Add the k nearest candidates of each row as a ranked list, exact, ties by ``order``.

    Rows are told apart by themselves, never by ``key``. Candidates without a vector are left
    out; vectors of different length are an error. ``candidates`` has ``id``, the vector, and optionally ``name``, ``path``,
    ``numeric_path``. It is evaluated once, into a table, without what equal vectors hide. If its counted size
    fits ``max_bytes`` it is broadcast and no row is shuffled; otherwise both sides are cut into blocks. Fewer
    candidates than k give a shorter list.
    """
    ship_package(queries.sparkSession)
    cands = settle(_ordered(candidates, vec, order, k))
    text = sum((F.coalesce(F.octet_length(a), F.lit(0)) for a in ("name", "path", "numeric_path")), F.lit(64))
    n, least, dim, words = cands.agg(
        F.count("*"), F.min(F.size("_vec")), F.max(F.size("_vec")), F.sum(text)
    ).first()
    if n == 0:
        return queries.withColumn(out, F.array().cast(_CANDIDATES))
    if least != dim:
        raise ValueError(f"candidate vectors of {least} and {dim} components")
    size = n * dim * 8 + words
    if size <= max_bytes:
        return _by_broadcast(queries, cands, k, vec, out)
    if queries.isStreaming:
        raise ValueError(f"{size} bytes of candidates are more than a stream may broadcast ({max_bytes})")
    return _by_blocks(queries, cands, k, vec, out, size, dim)


def _by_broadcast(queries, cands, k, vec, out):
    table = cands.orderBy("_ord").toArrow()
    vecs = _matrix(table.column("_vec").combine_chunks())
    sent = queries.sparkSession.sparkContext.broadcast((Tiles(vecs), table.select(_ATTRS).combine_chunks()))

    def search(vectors: pa.Array) -> pa.Array:
        tiles, attrs = sent.value
        known = vectors.drop_null()
        lists = _as_lists(*top_k(_matrix(known), tiles, k), attrs) if len(known) else None
        if vectors.null_count == 0 and lists is not None:
            return lists
        if lists is None:
            return pa.nulls(len(vectors), to_arrow_type(_candidates_type()))
        place = np.cumsum(vectors.is_valid().to_numpy(zero_copy_only=False)) - 1
        return lists.take(pa.array(place, mask=vectors.is_null().to_numpy(zero_copy_only=False)))

    fn = F.arrow_udf(search, _CANDIDATES).asNondeterministic()
    return _dealt(queries, len(vecs)).withColumn(out, fn(F.col(vec)))


def _dealt(queries: DataFrame, candidates: int) -> DataFrame:
    """Queries in so many more parts as there are more candidates, so that a task's work grows with the queries alone."""
    if queries.isStreaming or candidates <= DEAL:
        return use_all_cores(queries)
    return queries.repartition(queries.sparkSession.sparkContext.defaultParallelism * math.ceil(candidates / DEAL))


def _candidates_type():
    from pyspark.sql.types import ArrayType

    return ArrayType(CANDIDATE_TYPE)


def _by_blocks(queries, cands, k, vec, out, size, dim):
    """Both sides in blocks of about ``BLOCK_BYTES``; every block of queries meets every block of candidates.

    The queries are written once, each row under an id of its own, so that repeated and null
    keys stay apart and nothing upstream runs twice. The blocks are written as well, each once, and
    paired by a cross join that reads the candidates' again for each part of the queries: nothing is
    repeated in a shuffle or on disk. A task keeps the k best rows of one block of queries while the
    candidates of its part, ``SIDE_BYTES`` at most, go by; those lists are merged per row.
    """
    key = "_row_id"
    spark = queries.sparkSession
    queries = settle(queries.withColumn(key, F.monotonically_increasing_id()))
    cands = settle(cands.orderBy("_ord").withColumn("_pos", F.monotonically_increasing_id()))
    c_blocks = math.ceil(size / BLOCK_BYTES)
    q_blocks = math.ceil(queries.count() * dim * 8 / BLOCK_BYTES) or 1

    def blocks(rows, by, count, cols, name, parts):
        rows = rows.groupBy(F.pmod(F.xxhash64(by), F.lit(count)).alias(f"{name}b"))
        rows = settle(rows.agg(F.collect_list(F.struct(*cols)).alias(name)))
        return rows.repartitionByRange(parts, f"{name}b")

    parts = min(q_blocks, 2 * spark.sparkContext.defaultParallelism + q_blocks // 16)
    q = queries.where(F.col(vec).isNotNull()).select(F.col(key).alias("_key"), F.col(vec).alias("_vec"))
    q = blocks(q, "_key", q_blocks, ["_key", "_vec"], "_q", parts)
    c = blocks(cands, "_pos", c_blocks, ["_pos", *_ATTRS, "_vec"], "_c", math.ceil(size / SIDE_BYTES))
    item = CANDIDATE_TYPE.simpleString()[:-1] + ",_pos:bigint>"
    best = q.hint("shuffle_replicate_nl").crossJoin(c).mapInArrow(_search_blocks(k), f"_key bigint, _best array<{item}>")
    merged = best.groupBy("_key").agg(F.flatten(F.collect_list("_best")).alias("_all"))
    by_distance = F.array_sort(
        F.transform("_all", lambda x: F.struct(x["distance"], x["_pos"], x.alias("item")))
    )
    ranked = F.transform(
        F.slice(by_distance, 1, k),
        lambda x, i: F.struct(
            (i + 1).cast("int").alias("rank"),
            *[x["item"][a].alias(a) for a in _ATTRS],
            x["item"]["distance"].alias("distance"),
        ),
    )
    merged = merged.select(F.col("_key").alias(key), ranked.cast(_CANDIDATES).alias(out))
    return queries.join(merged, key, "left").drop(key)


def _search_blocks(k: int):
    """Pairs of blocks to one list per query and run of pairs with the same queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, best = None, None, None
        held: dict[int, tuple[Tiles, pa.Table]] = {}

        def flush():
            attrs = pa.concat_tables([held[b][1] for b in met]).combine_chunks()
            attrs = attrs.take(pa.array(np.argsort(attrs.column("_pos").to_numpy())))
            found = best.pos != NOWHERE
            at = np.searchsorted(attrs.column("_pos").to_numpy(), best.pos[found])
            some = np.cumsum([0, *found.sum(1)]).astype(np.int32)
            flat = _as_lists(at[None, :], best.dist[found][None, :], attrs, ("_pos",)).flatten()
            return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(some, flat)], ["_key", "_best"])

        met: list[int] = []
        for batch in batches:
            for i in range(len(batch)):
                q_block, c_block = batch.column("_qb")[i].as_py(), batch.column("_cb")[i].as_py()
                if q_block != now:
                    if best:
                        yield flush()
                    rows = batch.column("_q").slice(i, 1).flatten()
                    now, keys, met = q_block, rows.field("_key"), []
                    best = Best(_matrix(rows.field("_vec")), k)
                if c_block not in held:
                    rows = batch.column("_c").slice(i, 1).flatten()
                    # copied: a slice would keep the whole batch
                    table = pa.table({a: rows.field(a).take(pa.array(np.arange(len(rows)))) for a in ("_pos", *_ATTRS)})
                    held[c_block] = Tiles(_matrix(rows.field("_vec")), table.column("_pos").to_numpy()), table
                met.append(c_block)
                best.meet(held[c_block][0])
        if best:
            yield flush()

    return run


def knn(queries: DataFrame, candidates: DataFrame, k: int = TOP_K, key: str = "query_id", **opts) -> DataFrame:
    """One row per (query, candidate): key, rank, id, name, path, numeric_path, distance."""
    found = nearest(queries, candidates, k, key, out="_found", **opts)
    return found.select(key, F.inline("_found"))
