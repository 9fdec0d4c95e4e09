"""Embedding near-dedup by epsilon grid order.

Unit vectors are laid on a grid of cell width epsilon over their leading principal directions and
sorted by cell. Intervals of that sequence are the leaves of a tree, each with the box its
vectors fill; the join walks the tree from the top, level by level, and goes on only where two
boxes are at most epsilon apart. Leaf pairs are settled by one matrix product each.

Cosine >= c is Euclidean distance <= sqrt(2 - 2c) between unit vectors, and a projection never
lengthens a distance: a skipped pair of intervals holds no link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwright.llm.common import components, hash_pair, query, table
from shelfwright.session import settle, ship_package

#: Vectors in a leaf interval, children of a tree node, principal directions that carry the grid.
LEAF, FANOUT, DIRECTIONS = 1024, 16, 6


def _unit(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    """The vectors of a batch, scaled to length one."""
    col = batch.column(column)
    flat, cuts = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        v = flat[a:b] / np.abs(flat[a:b]).max()
        out.append(v / np.sqrt(v @ v))
    return out


def _moments(batches):
    """Per vector length, the sum of outer products of a task's vectors."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        by: dict[int, list] = {}
        for v in _unit(b, "vec"):
            by.setdefault(len(v), []).append(v)
        for d, vs in by.items():
            m = np.stack(vs)
            sums[d] = sums.get(d, 0) + m.T @ m
    for d, m in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([m.tobytes()], pa.binary())], ["d", "m"])


def _added(batches):
    """The same sums, one per vector length and task."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for d, m in zip(b.column("d").to_pylist(), b.column("m").to_pylist()):
            sums[d] = sums.get(d, 0) + np.frombuffer(m).reshape(d, d)
    for d, m in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([m.tobytes()], pa.binary())], ["d", "m"])


def principal_directions(vectors: DataFrame, directions: int = DIRECTIONS) -> dict[int, np.ndarray]:
    """Leading eigenvectors of all vectors' second moments, per vector length.

    Every vector counts. The driver gets 16 matrices of length x length at most, however many
    tasks there were.
    """
    parts = vectors.select("vec").mapInArrow(_moments, "d int, m binary").repartition(16)
    sums: dict[int, np.ndarray] = {}
    for r in parts.mapInArrow(_added, "d int, m binary").collect():
        sums[r.d] = sums.get(r.d, 0) + np.frombuffer(r.m).reshape(r.d, r.d)
    return {d: np.linalg.eigh(m)[1][:, ::-1][:, :directions] for d, m in sums.items()}


def _grid(basis: dict[int, np.ndarray], eps: float, directions: int):
    def run(batches):
        for b in batches:
            cells, places, packed = [], [], []
            for v in _unit(b, "vec"):
                p = v @ basis[len(v)]
                p = np.pad(p, (0, directions - len(p)))
                cells.append(np.floor(p / eps).astype(np.int32))
                places.append(p)
                packed.append(v.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("node"),
                    b.column("label"),
                    b.column("copies"),
                    pa.array([len(x) // 8 for x in packed], pa.int32()),
                    pa.array(cells, pa.list_(pa.int32())),
                    pa.array(places, pa.list_(pa.float64())),
                    pa.array(packed, pa.binary()),
                ],
                ["node", "label", "copies", "d", "cell", "place", "vec"],
            )

    return run


def _intervals(leaf: int):
    """Cut a sorted partition into intervals of one label and vector length."""
    names = ["task", "seq", "label", "d", "lo", "hi", "nodes", "copies", "vecs"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    types += [pa.binary()] * 3

    def run(batches):
        from pyspark import TaskContext

        task, seq = TaskContext.get().partitionId(), 0
        group, rows = None, []

        def flush():
            nonlocal seq
            places = np.array([r[1] for r in rows])
            out = [task, seq, group[0], group[1], places.min(0), places.max(0)]
            out += [np.array([r[i] for r in rows], np.int64).tobytes() for i in (0, 2)]
            out.append(b"".join(r[3] for r in rows))
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(out, types)], names)

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("label", "d", "node", "place", "copies", "vec")]
            for label, d, *row in zip(*cols):
                if rows and ((label, d) != group or len(rows) == leaf):
                    yield flush()
                    rows = []
                group = (label, d)
                rows.append(row)
        if rows:
            yield flush()

    return run


def _matches(threshold: float):
    """Per leaf pair: how many vectors each vector links with, and a forest that spans the links."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                a = np.frombuffer(r["nodes_a"], np.int64)
                c = np.frombuffer(r["nodes_b"], np.int64)
                va = np.frombuffer(r["vecs_a"]).reshape(len(a), -1)
                vb = np.frombuffer(r["vecs_b"]).reshape(len(c), -1)
                hit = va @ vb.T >= threshold
                same = r["a"] == r["b"]
                if same:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                na = hit @ np.frombuffer(r["copies_b"], np.int64)
                nb = np.zeros(len(c), np.int64) if same else np.frombuffer(r["copies_a"], np.int64) @ hit
                # smallest node reached within this pair, by passing minima to and fro
                top = np.iinfo(np.int64).max
                la, lb = a.copy(), c.copy()
                while True:
                    ma = np.minimum(la, np.where(hit, lb[None, :], top).min(1))
                    mb = np.minimum(lb, np.where(hit, ma[:, None], top).min(0))
                    if same:
                        ma = mb = np.minimum(ma, mb)
                    if (ma == la).all() and (mb == lb).all():
                        break
                    la, lb = ma, mb
                nodes, links, roots = np.concatenate([a, c]), np.concatenate([na, nb]), np.concatenate([la, lb])
                keep = (links > 0) | (roots != nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[keep], pa.int64()) for x in (nodes, links, roots)], ["node", "links", "root"]
                )

    return run


def _apart(a: str, b: str):
    """Squared distance of two boxes."""

    def side(lo, hi):
        return F.zip_with(lo, hi, lambda x, y: F.greatest(x - y, F.lit(0.0)))

    gaps = F.zip_with(
        side(F.col(f"{b}.lo"), F.col(f"{a}.hi")),
        side(F.col(f"{a}.lo"), F.col(f"{b}.hi")),
        lambda x, y: (x + y) * (x + y),
    )
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x)


def _walk(leaves: DataFrame, eps: float, directions: int) -> DataFrame:
    """Pairs (a, b) of leaf intervals, a <= b, whose boxes are at most ``eps`` apart."""
    seat = F.row_number().over(Window.partitionBy("label", "d").orderBy("task", "seq")) - 1
    boxes = settle(leaves.select("leaf", "label", "d", "lo", "hi", seat.cast("bigint").alias("pos")))
    levels = [boxes]
    while levels[-1].agg(F.max("pos")).first()[0]:
        up = [F.min(F.col("lo")[i]).alias(f"lo{i}") for i in range(directions)]
        up += [F.max(F.col("hi")[i]).alias(f"hi{i}") for i in range(directions)]
        parent = (F.col("pos") / FANOUT).cast("bigint").alias("pos")
        higher = levels[-1].groupBy("label", "d", parent).agg(*up)
        lo, hi = (F.array(*[F.col(f"{s}{i}") for i in range(directions)]).alias(s) for s in ("lo", "hi"))
        levels.append(settle(higher.select("label", "d", "pos", lo, hi)))
    pairs = levels[-1].select("label", "d", F.col("pos").alias("pa"), F.col("pos").alias("pb"))
    near = eps * eps * (1 + 1e-9) + 1e-12
    for level in reversed(levels[:-1]):
        child = level.withColumn("up", (F.col("pos") / FANOUT).cast("bigint"))
        one = child.select("label", "d", F.col("up").alias("pa"), F.col("pos").alias("ca"), F.struct("lo", "hi").alias("A"))
        two = child.select("label", "d", F.col("up").alias("pb"), F.col("pos").alias("cb"), F.struct("lo", "hi").alias("B"))
        pairs = pairs.join(one, ["label", "d", "pa"]).join(two, ["label", "d", "pb"])
        pairs = pairs.where((F.col("ca") <= F.col("cb")) & (_apart("A", "B") <= near))
        pairs = settle(pairs.select("label", "d", F.col("ca").alias("pa"), F.col("cb").alias("pb")))
    ends = boxes.select("label", "d", "leaf", "pos")
    pairs = pairs.join(ends.select("label", "d", F.col("pos").alias("pa"), F.col("leaf").alias("a")), ["label", "d", "pa"])
    pairs = pairs.join(ends.select("label", "d", F.col("pos").alias("pb"), F.col("leaf").alias("b")), ["label", "d", "pb"])
    return pairs.select("a", "b")


def near_duplicates(
    df: DataFrame,
    threshold: float = 0.93,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    leaf: int = LEAF,
) -> DataFrame:
    """One row per row of ``df``: id, n_links, component_id, kept.

    Two rows link if their labels are equal and not null, their vectors equally long and their
    cosine, in double precision, is at least ``threshold``. Null, empty and zero vectors, and
    those that hold a null or non-finite component, link with nothing: they are their own
    component. Rows without id link like all others but name no component; a component of such
    rows only has a null id, and all of them are kept. Rows that repeat an id stay apart.

    Equal vectors of a label are one class, joined once; their links among each other are counted.
    Memory: a task holds two leaves. Nothing that grows with the rows is broadcast or collected.
    """
    spark = df.sparkSession
    ship_package(spark)
    vec = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"), vec.alias("vec")
    )
    inf = F.lit(float("inf"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    usable = F.col("label").isNotNull() & sound & F.exists("vec", lambda x: x != 0)
    h1, h2 = hash_pair(F.col("label"), F.col("vec"))
    rows = rows.withColumns({"ok": F.coalesce(usable, F.lit(False)), "h1": h1, "h2": h2})
    classes = rows.where("ok").groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("id").alias("id")
    )
    classes = settle(classes.withColumn("node", F.monotonically_increasing_id()))

    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    basis = principal_directions(classes)
    grid = classes.select("node", "label", "copies", "vec").mapInArrow(
        _grid(basis, max(eps, 1e-6), DIRECTIONS),
        "node bigint, label bigint, copies bigint, d int, cell array<int>, place array<double>, vec binary",
    )
    order = ["label", "d", *[F.col("cell")[i] for i in range(DIRECTIONS)], "node"]
    pieces = max(1, -(-classes.count() // (8 * leaf)))
    cut = grid.repartitionByRange(pieces, *order).sortWithinPartitions(*order).mapInArrow(
        _intervals(leaf),
        "task int, seq bigint, label bigint, d int, lo array<double>, hi array<double>, "
        "nodes binary, copies binary, vecs binary",
    )
    leaves = settle(cut.withColumn("leaf", F.shiftleft(F.col("task").cast("bigint"), 33) + F.col("seq")))
    pairs = _walk(leaves, eps, DIRECTIONS)
    load = ["nodes", "copies", "vecs"]
    for s in "ab":
        pairs = pairs.join(leaves.select(F.col("leaf").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in load]), s)
    found = settle(pairs.mapInArrow(_matches(threshold), "node bigint, links bigint, root bigint"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    member = classes.select("h1", "h2", "node", "copies", "id").join(links, "node", "left").join(roots, "node", "left")
    member = member.withColumn("root", F.coalesce("root", "node"))
    smallest = member.groupBy("root").agg(F.min("id").alias("component_id"))
    member = member.join(smallest, "root").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", F.lit(True).alias("ok")
    )
    out = rows.select("id", "ok", "h1", "h2").join(member, ["ok", "h1", "h2"], "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


@query(
    "op2_embedding_near_dedup",
    """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id u, b.vec_id w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id u, vec_id w FROM embeddings UNION SELECT r.u, p.w FROM r JOIN p ON r.w = p.u)
SELECT r.u vec_id, coalesce(any_value(n.n), 0)::BIGINT n_links, min(r.w) component_id, r.u = min(r.w) kept
FROM r LEFT JOIN (SELECT u, count(*) n FROM p GROUP BY u) n USING (u) GROUP BY r.u
""",
)
def op2_embedding_near_dedup(spark, folder):
    return near_duplicates(table(spark, folder, "embeddings"))
