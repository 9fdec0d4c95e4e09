"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows lie in parts by a hash. How many rows each part sends to each shard is drawn as it would come
out of one permutation of all rows: a multivariate hypergeometric law with fixed row and column
sums. Each part is permuted and cut by its row of the matrix, the pieces are exchanged, and each
shard is permuted again. The rows see DataFrame operations only; the driver draws one number per
part and shard and sees no row.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwright.llm.common import hash_pair, query, table
from shelfwright.session import settle

#: Rows that one task permutes, about; parts and sub-parts of a shard at the least.
PART, PARTS, SUBPARTS = 1 << 18, 64, 16


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good + bad`` are good: inversion outwards from the mode, exact to rounding."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    u = rng.random() - at
    up, down, p, q = mode, mode, at, at
    while u > 0 and (up < high or down > low):
        if up < high:
            p *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p
            if u <= 0:
                return up
        if down > low:
            q *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= q
            if u <= 0:
                return down
        if p + q < 1e-300:  # what rounding has left over
            break
    return mode


def communication_matrix(parts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows sent from each part to each shard: row sums are ``parts``, column sums differ by at most one."""
    rng = random.Random(seed)
    n = sum(parts)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    out = []
    for rows in parts:
        row, left, free = [], rows, sum(room)
        for s in range(shards):
            free -= room[s]
            x = hypergeometric(rng, room[s], free, left)
            row.append(x)
            left -= x
        room = [a - b for a, b in zip(room, row)]
        out.append(row)
    return out


def _constant(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few rows as a frame."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(parsed))


def shuffle_into_shards(
    df: DataFrame, shards: int, by: list[str], seed: int = 17, shard: str = "shard", slot: str = "slot"
) -> DataFrame:
    """``df`` with ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in its shard).

    Shard sizes differ by at most one; which rows meet in a shard and in which order is a uniform
    shuffle fixed by ``seed`` and the columns ``by``, which should tell rows apart: rows equal in
    ``by`` share a part. Nulls are values like others. Fewer rows than shards leave shards empty;
    an empty table gives none. Columns named like the new ones are replaced.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c not in (shard, slot)]
    h1, h2 = hash_pair(F.lit(seed), *[F.col(f"`{c}`") for c in by])
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"), h1.alias("h1"), h2.alias("h2"))
    n = df.count()
    parts = max(PARTS, -(-n // PART))
    row = row.withColumn("part", F.pmod("h1", F.lit(parts)))
    counts = {r.part: r["count"] for r in row.groupBy("part").count().collect()}
    sizes = [counts.get(p, 0) for p in range(parts)]
    matrix = communication_matrix(sizes, shards, seed)
    cuts = []
    for p, sent in enumerate(matrix):
        total, upto = 0, []
        for x in sent:
            total += x
            upto.append(total)
        cuts.append({"part": p, "upto": upto})
    cuts = _constant(spark, cuts, "part:bigint,upto:array<bigint>")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("h2", "h1")) - 1
    sent = row.withColumn("rank", rank).join(F.broadcast(cuts), "part")
    sent = sent.withColumn("shard", F.size(F.filter("upto", lambda c: c <= F.col("rank"))))
    subparts = max(SUBPARTS, -(-n // (shards * PART)))
    sent = sent.withColumn("h3", F.xxhash64(F.lit(~seed), "h1", "h2"))
    moved = settle(sent.select("__row", "h1", "h3", "shard", F.pmod("h3", F.lit(subparts)).alias("sub")))
    held = {(r.shard, r["sub"]): r["count"] for r in moved.groupBy("shard", "sub").count().collect()}
    starts = []
    for s in range(shards):
        total = 0
        for b in range(subparts):
            starts.append({"shard": s, "sub": b, "start": total})
            total += held.get((s, b), 0)
    starts = _constant(spark, starts, "shard:int,sub:bigint,start:bigint")
    again = F.row_number().over(Window.partitionBy("shard", "sub").orderBy("h3", "h1")) - 1
    out = moved.withColumn("again", again).join(F.broadcast(starts), ["shard", "sub"])
    new = [F.col("shard").alias(shard), (F.col("start") + F.col("again")).alias(slot)]
    return out.select(*[F.col(f"__row.`{c}`").alias(c) for c in columns], *new)


@query("op8_sharding")
def op8_sharding(spark, folder):
    """Law ``rows``: counts of the 24 shards at most one apart."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    dealt = shuffle_into_shards(docs, 24, ["doc_id", "size", "text_crc32"])
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
