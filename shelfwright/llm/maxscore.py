"""Exact top-k inner products by MaxScore over sharded postings.

A term is a component; its posting list in a shard holds that component of every row, with the
largest and the smallest value as bounds. Per query the terms are ordered by what they can still
add. Those whose sum of bounds stays below the query's current k-th score are non-essential: they
alone bring no row into the result. The essential postings are traversed for all rows; the
others are probed only for rows whose bound still competes. Shards are merged by running top-k
per task and a last ranking of k rows per query and task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwright.llm.common import query, table
from shelfwright.session import settle, ship_package

#: Rows of a shard, queries of a block, queries scored at once, tasks that share one block's shards.
SHARD, BLOCK, AT_ONCE, SHARE = 8192, 1024, 128, 8


def _narrow(m: np.ndarray) -> tuple[bytes, str]:
    for kind in (np.int8, np.int16, np.int32):
        if m.size == 0 or (np.iinfo(kind).min <= m.min() and m.max() <= np.iinfo(kind).max):
            return m.astype(kind).tobytes(), np.dtype(kind).str
    return m.astype(np.int64).tobytes(), np.dtype(np.int64).str


def _blocks(size: int):
    """Rows (id, terms) of one length at a time, packed into blocks of at most ``size`` rows."""

    def run(batches):
        from pyspark import TaskContext

        task, seq = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def block(d):
            nonlocal seq
            ids, terms = zip(*held.pop(d))
            data, kind = _narrow(np.array(terms, np.int64).reshape(len(ids), d))
            seq += 1
            row = [(task << 33) + seq - 1, d, np.array(ids, np.int64).tobytes(), data, kind]
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], NAMES)

        for b in batches:
            for i, t in zip(b.column("id").to_pylist(), b.column("terms").to_pylist()):
                rows = held.setdefault(len(t), [])
                rows.append((i, t))
                if len(rows) == size:
                    yield block(len(t))
        for d in list(held):
            yield block(d)

    return run


NAMES = ["block", "d", "ids", "data", "kind"]
BLOCK_SCHEMA = "block bigint, d int, ids binary, data binary, kind string"


class _Best:
    """The k best rows of each query of a block so far."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.rows = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def add(self, i: int, rows: np.ndarray, scores: np.ndarray) -> None:
        own = rows != self.ids[i]
        r, s = np.concatenate([self.rows[i][0], rows[own]]), np.concatenate([self.rows[i][1], scores[own]])
        best = np.lexsort((r, -s))[: self.k]
        self.rows[i] = r[best], s[best]
        if len(best) == self.k:
            low = s[best[-1]]
            # a double may stand above a whole number this large
            self.floor[i] = low if abs(int(low)) < 2**53 else np.nextafter(float(low), -np.inf)


def score_shard(best: _Best, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    """Merge one shard (``rows``: one row each) into ``best``."""
    # no sum of bounds is above this; whole numbers are exact in doubles up to 2^53
    most = 2 * _largest(queries) * _largest(rows) * max(1, rows.shape[1])
    kind = np.float64 if most < 2**53 else np.int64 if most < 2**63 else object
    postings = np.ascontiguousarray(rows.T.astype(kind))
    high, low = rows.max(0).astype(kind), rows.min(0).astype(kind)
    for at in range(0, len(queries), AT_ONCE):
        q = queries[at : at + AT_ONCE].astype(kind)
        floor = best.floor[at : at + AT_ONCE]
        top, bottom = np.maximum(q * high, q * low), np.minimum(q * high, q * low)
        # queries to which nothing of this shard can matter any more pass it by
        alive = np.flatnonzero(top.sum(1) >= floor)
        if not len(alive):
            continue
        q, floor, top, bottom = q[alive], floor[alive], top[alive], bottom[alive]
        order = np.argsort(top - bottom, axis=1, kind="stable")
        reach = bottom.sum(1)[:, None] + np.cumsum(np.take_along_axis(top - bottom, order, 1), axis=1)
        essential = np.empty(q.shape, bool)
        np.put_along_axis(essential, order, reach >= floor[:, None], axis=1)
        # only postings that are essential to some query of the block are traversed
        read = np.flatnonzero(essential.any(0))
        partial = (q[:, read] * essential[:, read]) @ postings[read]
        rest = np.where(essential, 0, top).sum(1)
        who, where = np.nonzero(partial + rest[:, None] >= floor[:, None])
        cuts = np.searchsorted(who, np.arange(len(q) + 1))
        for i in range(len(q)):
            found = where[cuts[i] : cuts[i + 1]]
            if len(found):
                own = at + int(alive[i])
                probe = ~essential[i]
                scores = partial[i, found] + (q[i, probe] @ postings[probe][:, found] if probe.any() else 0)
                if len(scores) > 4 * best.k + 1:  # one more than k: the query's own row may be among them
                    cut = np.partition(scores, len(scores) - best.k - 1)[len(scores) - best.k - 1]
                    if (ids[found] == best.ids[own]).sum() <= 1:
                        found, scores = found[scores >= cut], scores[scores >= cut]
                best.add(own, ids[found], scores.astype(np.int64))


def _largest(x: np.ndarray) -> int:
    """The largest absolute value, 1 at least, as a number that does not overflow."""
    return max(1, int(x.max(initial=0)), -int(x.min(initial=0)))


def _search(k: int):
    def run(batches):
        now, best, queries = None, None, None

        def flush():
            n = [len(r) for r, _ in best.rows]
            cols = [np.repeat(best.ids, n), *(np.concatenate([x[j] for x in best.rows]) for j in (0, 1))]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

        for b in batches:
            for r in b.to_pylist():
                if r["block"] != now:
                    if best:
                        yield flush()
                    now, best = r["block"], _Best(np.frombuffer(r["ids"], np.int64), k)
                    queries = np.frombuffer(r["data"], r["kind"]).reshape(len(best.ids), r["d"]).astype(np.int64)
                ids = np.frombuffer(r["s_ids"], np.int64)
                rows = np.frombuffer(r["s_data"], r["s_kind"]).reshape(len(ids), r["d"]).astype(np.int64)
                score_shard(best, queries, ids, rows)
        if best:
            yield flush()

    return run


def top_k(rows: DataFrame, is_query, k: int = 20, id: str = "id", terms: str = "terms") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row where ``is_query`` holds, its k best other rows.

    ``terms`` is an array of bigints; the score is their inner product, exact while it fits a
    bigint. Ties go to the smaller id; fewer candidates than k give fewer rows. Rows with a null
    id, null terms or a null among them take no part; vectors of different length do not meet.
    Rows that share the query's id are its own and left out; a repeated query id gets one ranking
    over all its rows.

    Queries and rows travel in blocks: every block of queries meets every shard once, the
    shards of one block shared by ``SHARE`` tasks; a task holds one block and one shard.
    """
    ship_package(rows.sparkSession)
    sound = F.col(f"`{id}`").isNotNull() & F.forall(f"`{terms}`", lambda x: x.isNotNull())
    rows = rows.where(F.coalesce(sound, F.lit(False)))
    flat = [F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{terms}`").cast("array<bigint>").alias("terms")]
    shards = settle(rows.select(*flat).mapInArrow(_blocks(SHARD), BLOCK_SCHEMA))
    asked = rows.where(is_query).select(*flat)
    tasks = max(1, -(-asked.count() // BLOCK))
    queries = settle(asked.repartition(tasks, F.xxhash64("id")).mapInArrow(_blocks(BLOCK), BLOCK_SCHEMA))
    share = F.pmod(F.xxhash64("block"), F.lit(SHARE)).alias("share")
    seat = F.row_number().over(Window.partitionBy("d").orderBy("block")).alias("seat")
    numbered = queries.join(queries.select("block", "d", seat), ["block", "d"])
    copies = numbered.withColumn("share", F.explode(F.expr(f"sequence(0L, {SHARE - 1}L)")))
    seats = queries.groupBy("d").agg(F.count("*").alias("seats"))
    meets = shards.join(F.broadcast(seats), "d").select(
        "d", share, F.explode(F.sequence(F.lit(1), F.col("seats").cast("int"))).alias("seat"),
        *[F.col(c).alias(f"s_{c}") for c in ("ids", "data", "kind")],
    )
    pairs = copies.join(meets, ["d", "seat", "share"]).sortWithinPartitions("block")
    best = pairs.drop("seat", "share").mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


@query(
    "op3_maxscore_top_k",
    """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) t FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id query_id, c.vec_id, list_sum(list_transform(list_zip(q.t, c.t), lambda z: z[1] * z[2]))::BIGINT score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.t) = len(q.t) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT "rank" FROM s)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 20
""",
)
def op3_maxscore_top_k(spark, folder):
    """Components as whole numbers, floor(64 * x); a vector with a non-finite component takes no part."""
    e = table(spark, folder, "embeddings")
    x64 = F.col("embedding").cast("array<double>")
    finite = F.forall(x64, lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = e.where(finite).select("vec_id", F.transform(x64, lambda x: F.floor(x * 64)).alias("terms"))
    return top_k(rows, F.col("vec_id") % 20 == 0, 20, "vec_id")
