"""Merkle manifest of a dataset, with a proof for every row by pointer jumping. DataFrame operations only.

Every row is a leaf. The leaves of a source, numbered in ascending order, are hashed in runs of 16
until one node is left, the source's subroot; the subroots, numbered in the order of the sources,
are hashed the same way up to the root. The proofs do not walk that tree: every inner node points
at an ancestor and holds the sibling segments on the way there, at first one step; a self-join
with the nodes pointed at doubles the distance and joins the segments, until all point at the
root. The rows then meet the path of their own run once.

A null value is the sign ``-``, so rows with nulls in any column are leaves like others; rows
without a source come first. Equal ids are ordered by their leaves, rows equal in both have places
of their own. A table without rows has no leaves, no root and gives no rows; other columns,
whatever their names, take no part. Texts are hashed where they are read and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwright.llm.common import BROADCAST_ROWS, LOWER, UPPER, ascii_lower, query, table
from shelfwright.session import settle

RUN = 16
#: What makes a leaf, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows that are sorted and numbered in one task: about the second figure at most, the first if tasks are to spare.
FEW, MANY = 1 << 14, 1 << 20
#: Nodes pointed at are broadcast up to so many bytes of segments; beyond that the join is shuffled.
POINTED_BYTES = 16 << 20
TOP = -1

_HOP = "array<struct<left:binary,right:binary>>"


def encoded(c: Column) -> Column:
    """Byte count, colon, value; ``-`` for null."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(text: Column) -> Column:
    """32 bytes. Digests are hashed as lowercase hex, but kept and moved as bytes."""
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def hexed(c: Column) -> Column:
    return F.lower(F.hex(c))


def tampered(id: Column) -> Column:
    """Whether a row's text is tampered with; never without an id."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(src, doc_id, leaf, altered): src sorts as the sources do; altered is the tampered leaf or null. Written once."""
    parts = [encoded(F.col(c)) for c in LEAF_COLUMNS[:-1]]
    text = F.col("text")
    altered = digest(F.concat(*parts, encoded(ascii_lower(text))))
    return settle(
        docs.select(
            F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")).alias("src"),
            "doc_id",
            digest(F.concat(*parts, encoded(text))).alias("leaf"),
            F.when(tampered(F.col("doc_id")), altered).alias("altered"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``idx``, each row's place among those of its group from 0, and ``n``, how many they are.

    Rows are sorted over ranges of (group, order), which must tell all of them apart, so a group of
    any size is split; each range is numbered by itself and starts where the ranges before it end.
    """
    rows = df.count()
    spare = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = 1 + max(rows // MANY, min(spare, rows // FEW))
    ranged = df.repartitionByRange(parts, group, *order) if parts > 1 else df.coalesce(1)
    ranged = settle(ranged.withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part", group).count()
    by_part = Window.partitionBy(group).orderBy("_part")
    before = F.sum("count").over(by_part.rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        "_part",
        group,
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.sum("count").over(Window.partitionBy(group)).alias("n"),
    )
    place = F.row_number().over(Window.partitionBy("_part", group).orderBy(*order)) - 1
    out = ranged.withColumn("_place", place).join(counts, ["_part", group])
    return out.withColumn("idx", F.col("_before") + F.col("_place")).drop("_part", "_before", "_place")


def _joined(digests: Column) -> Column:
    """The digests as one text, in order."""
    return F.array_join(F.transform(digests, hexed), "")


def _runs(nodes: DataFrame) -> DataFrame:
    """The next level: nodes (tree, idx, n, digest) to (tree, idx, n, digest, kids), their run as one node."""
    kids = F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda k: k["digest"])
    runs = nodes.groupBy("tree", F.floor(F.col("idx") / RUN).alias("idx"), "n").agg(kids.alias("kids"))
    return runs.select(
        "tree", "idx", F.ceil(F.col("n") / RUN).alias("n"), digest(_joined(F.col("kids"))).alias("digest"), "kids"
    )


def _binary(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(b""), lambda a, b: F.concat(a, b))


def hop(kids: Column, at: Column) -> Column:
    """One step up: the run's members before and after place ``at``, as bytes side by side."""
    left, right = F.slice(kids, 1, at), F.slice(kids, at + 2, F.lit(RUN))
    return F.struct(_binary(left).alias("left"), _binary(right).alias("right"))


def _steps(run_level: DataFrame, tree: Column, level: int) -> DataFrame:
    """(tree, level, idx, up level, up idx, path) of every member of the runs, one step up."""
    kids = run_level.select("tree", "idx", "digest", "kids", F.posexplode("kids").alias("at", "own"))
    return kids.select(
        tree.alias("tree"),
        F.lit(level).alias("level"),
        (F.col("idx") * RUN + F.col("at")).alias("idx"),
        F.col("tree").alias("up_tree"),
        F.lit(level + 1).alias("up_level"),
        F.col("idx").alias("up_idx"),
        F.array(hop(F.col("kids"), F.col("at"))).cast(_HOP).alias("path"),
    )


def _climb(nodes: DataFrame, most: int, level: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels above ``nodes`` as steps, and the last node of every tree (tree, digest, level)."""
    steps, ends = [], [nodes.where("n = 1").select("tree", "digest", F.lit(level).alias("level"))]
    while most > 1:
        nodes = settle(_runs(nodes.where("n > 1")))
        steps.append(_steps(nodes, F.col("tree"), level))
        nodes, most, level = nodes.drop("kids"), -(-most // RUN), level + 1
        ends.append(nodes.where("n = 1").select("tree", "digest", F.lit(level).alias("level")))
    last = ends[0]
    for e in ends[1:]:
        last = last.unionByName(e)
    return steps, last


def _jump(nodes: DataFrame, height: int, step_bytes: int) -> DataFrame:
    """Nodes with the whole path to the root: each round doubles the distance to the ancestor pointed at.

    An ancestor 2^k steps up is at least so high, so ever fewer nodes are pointed at: by at most
    16^(2^k) others each, which a shuffled join bears while they are many, and few enough to be
    broadcast, counted, once their followers are many.
    """
    distance = 1
    while distance < height:
        pointed = nodes.where((F.col("level") > distance) | (F.col("tree") == TOP)).select(
            F.col("tree").alias("up_tree"),
            F.col("level").alias("up_level"),
            F.col("idx").alias("up_idx"),
            F.col("path").alias("more"),
            F.col("sub").alias("up_sub"),
            F.struct("up_tree", "up_level", "up_idx").alias("next"),
        )
        most = POINTED_BYTES // (distance * step_bytes)
        if pointed.limit(most + 1).count() <= most:
            pointed = F.broadcast(pointed)
        met = nodes.join(pointed, ["up_tree", "up_level", "up_idx"], "left")
        nodes = settle(
            met.select(
                "tree",
                "level",
                "idx",
                *[F.col(f"next.{c}").alias(c) for c in ("up_tree", "up_level", "up_idx")],
                F.concat("path", F.coalesce("more", F.array().cast(_HOP))).alias("path"),
                F.coalesce("sub", "up_sub").alias("sub"),
            )
        )
        distance *= 2
    return nodes


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``.

    The proof is the row's siblings, level by level up to the root; ``folded_root`` is folded up
    along it from the tampered leaf where the row is tampered with, else from its own. Written to
    the shared folder on the way: leaves, one table per level, one per round of jumps. The driver
    sees counts and the root.
    """
    rows = leaves(docs)
    placed = numbered(rows, "src", ["doc_id", "leaf", "row"])
    sources = numbered(
        placed.groupBy("src").agg(F.first("n").alias("members")).withColumn("one", F.lit(1)), "one", ["src"]
    ).select("src", "members", F.col("idx").alias("tree"), F.col("n").alias("trees"))
    sources = settle(sources)
    top = sources.agg(F.max("members").alias("members"), F.max("trees").alias("trees")).first()
    small = top.trees is None or top.trees <= BROADCAST_ROWS
    placed = placed.join(F.broadcast(sources) if small else sources, "src")

    # runs of leaves: what the rows are kept in until they meet their path
    member = F.struct("idx", "doc_id", "leaf", "altered")
    first = placed.groupBy("tree", F.floor(F.col("idx") / RUN).alias("idx"), "n").agg(
        F.array_sort(F.collect_list(member)).alias("rows")
    )
    kids = F.transform("rows", lambda r: r["leaf"])
    alone = F.col("n") == 1
    first = settle(
        first.select(
            "tree",
            "idx",
            F.ceil(F.col("n") / RUN).alias("n"),
            F.when(alone, F.col("rows")[0]["leaf"]).otherwise(digest(_joined(kids))).alias("digest"),
            alone.alias("alone"),
            "rows",
        )
    )
    runs = first.select("tree", "idx", "n", "digest")
    steps, subroots = _climb(runs, -(-(top.members or 0) // RUN), 1)
    subroots = settle(subroots)
    trees = top.trees or 0
    tops = subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.lit(trees).cast("bigint").alias("n"), "digest")
    top_steps, root = _climb(tops, trees, 0)
    found = root.select("digest").first()
    root_hex = F.lit(bytes(found[0]).hex() if found else None).cast("string")

    # a subroot is the member of the top tree with its source's number: it goes on there
    key = ["up_tree", "up_level", "up_idx"]
    up = [F.lit(None).cast(t).alias(c) for c, t in zip(key, ("bigint", "int", "bigint"))]
    names = ["tree", "level", "idx", *key, "path"]
    onward = [s.where("level = 0").select(F.col("idx").alias("tree"), *key, "path") for s in top_steps[:1]]
    ends = subroots.select("tree", "level", F.lit(0).cast("bigint").alias("idx"), F.col("digest").alias("sub"))
    if onward:
        ends = ends.join(F.broadcast(onward[0]) if small else onward[0], "tree")
    else:
        ends = ends.select("*", *up, F.array().cast(_HOP).alias("path"))
    nodes = ends.select(*names, "sub")
    for s in (*steps, *top_steps[1:]):
        nodes = nodes.unionByName(s.select(*names).withColumn("sub", F.lit(None).cast("binary")))
    nodes = settle(nodes)
    height = len(steps) + len(top_steps) + 1  # one more, to learn the subroot where it is the root
    paths = _jump(nodes, height, RUN * 32).where(f"level = 1 and tree <> {TOP}").select("tree", "idx", "path", "sub")

    met = first.join(paths, ["tree", "idx"])
    each = met.select("path", "sub", "alone", kids.alias("kids"), F.posexplode("rows").alias("at", "r"))
    own = F.when(F.col("alone"), F.array().cast(_HOP)).otherwise(F.array(hop(F.col("kids"), F.col("at"))).cast(_HOP))
    each = each.select("r", "sub", F.transform(F.concat(own, "path"), lambda h: F.struct(
        hexed(h["left"]).alias("left"), hexed(h["right"]).alias("right"))).alias("path"))
    proof = F.array_join(F.transform("path", lambda h: F.concat(h["left"], h["right"])), "")
    start = hexed(F.coalesce("r.altered", "r.leaf"))
    folded = F.aggregate("path", start, lambda d, h: F.sha2(F.concat(h["left"], d, h["right"]).cast("binary"), 256))
    out = each.select(
        F.col("r.doc_id").alias("doc_id"),
        hexed(F.col("r.leaf")).alias("leaf"),
        hexed(F.col("sub")).alias("subroot"),
        root_hex.alias("root"),
        F.sha2(proof.cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


# ---- the same in SQL --------------------------------------------------------------------

_ENC = "coalesce(strlen({0}::varchar) || ':' || {0}::varchar, '-')"
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(doc_id::varchar) + 1),
  lambda p: ascii(substr(doc_id::varchar, p::INT, 1))::BIGINT)), lambda c, b: list_reduce(
  list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x // 2, 3988292384 * (x & 1)))), 4294967295)"""


def sql(levels: int = 6, tops: int = 4) -> str:
    """The same tables level by level, for up to 16^levels rows a source and 16^tops sources."""
    body = "||".join(_ENC.format(c) for c in LEAF_COLUMNS[:-1])
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    out = [
        f"""d AS (SELECT *, sha256({body} || {_ENC.format("text")}) leaf,
  CASE WHEN {_CRC} % 5 = 0 THEN sha256({body} || {_ENC.format(lowered)}) END altered FROM documents)""",
        """n0 AS (SELECT *, coalesce('s' || source, '-') src, row_number() OVER (PARTITION BY source ORDER BY doc_id
  NULLS FIRST, leaf) - 1 i, count(*) OVER (PARTITION BY source) n FROM d)""",
        "a0 AS (SELECT src, i, n, leaf h FROM n0)",
        "f0 AS (SELECT doc_id, leaf, src, i j, coalesce(altered, leaf) x, '' p, NULL::varchar sub FROM n0)",
    ]

    def level(k: int, next: int) -> None:
        out.append(
            f"""r{next} AS (SELECT src, i // {RUN} i, any_value(n) n, list(h ORDER BY i) kids
  FROM a{k} GROUP BY src, i // {RUN})"""
        )
        out.append(
            f"""a{next} AS (SELECT src, i, (n + {RUN - 1}) // {RUN} n,
  CASE WHEN n > 1 THEN sha256(array_to_string(kids, '')) ELSE kids[1] END h FROM r{next})"""
        )
        out.append(
            f"""f{next} AS (SELECT doc_id, leaf, src, j // {RUN} j, CASE WHEN n > 1 THEN sha256(l || x || r) ELSE x END x,
  CASE WHEN n > 1 THEN p || l || r ELSE p END p, sub FROM (SELECT f.*, r.n,
  array_to_string(r.kids[1 : (f.j % {RUN})], '') l, array_to_string(r.kids[(f.j % {RUN}) + 2 :], '') r
  FROM f{k} f JOIN r{next} r ON f.src = r.src AND f.j // {RUN} = r.i) f)"""
        )

    for k in range(levels):
        level(k, k + 1)
    top = levels + 1
    out.append(
        f"""a{top} AS (SELECT 'top' src, row_number() OVER (ORDER BY src) - 1 i, count(*) OVER () n, h, src s FROM a{levels})"""
    )
    out.append(
        f"""f{top} AS (SELECT f.doc_id, f.leaf, 'top' src, a.i j, f.x, f.p, a.h sub
  FROM f{levels} f JOIN a{top} a ON f.src = a.s)"""
    )
    for k in range(top, top + tops):
        level(k, k + 1)
    last = top + tops
    return (
        "WITH "
        + ",\n".join(out)
        + f"""
SELECT doc_id, leaf, sub subroot, a.h root, sha256(p) proof_sha256, x folded_root, x = a.h verified
FROM f{last} f JOIN a{last} a ON f.src = a.src"""
    )


@query("op11_merkle_manifest", sql())
def op11_merkle_manifest(spark, folder):
    return manifest(table(spark, folder, "documents").select(*LEAF_COLUMNS))
