"""MinHash near-dedup by an inverted join over signature coordinates.

A document is posted under its coordinate-value pairs. Two documents with at least ``MATCHES``
equal coordinates out of ``COORDINATES`` share one among the ``COORDINATES - MATCHES + 1`` rarest
pairs of either, in one common order of all pairs: only this prefix is joined, the long lists of
common pairs are skipped and only counted in. Pairs of documents whose collisions reach the
match threshold are confirmed on their full sets of word shingles.

Of documents with Jaccard similarity 0.75 or more, at least 10 of 32 coordinates collide except
with a chance below 4e-8 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.common import components, counted_broadcast, hash_pair, packed, query, table, unpacked
from shelfwright.session import settle, ship_package

SHINGLE, SIMILARITY = 5, 75
COORDINATES, MATCHES = 32, 10
PREFIX = COORDINATES - MATCHES + 1
#: Classes and shingles in a block of a herd; columns of shared shingles counted at once.
BLOCK, WEIGHT, COLUMNS = 256, 1 << 18, 8192
#: A herd's list of so many postings is joined in pairs; the members of longer ones meet in blocks.
SHORT = 32

_U = np.uint64
_WORD_SEED, _MIX1, _MIX2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_KEYS = np.random.default_rng(20).integers(1, 1 << 63, (2, COORDINATES), dtype=np.uint64) | _U(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


class Shingler:
    """64-bit hashes of a text's distinct shingles: lower-cased (A-Z) runs of non-space, in windows of five."""

    def __init__(self):
        import xxhash

        self.hash = xxhash.xxh3_64_intdigest
        self.words: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known, digest = self.words, self.hash
        if len(known) > 300_000:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = digest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(SHINGLE, len(words))
        n = len(h) - size + 1
        out = np.full(n, size, np.uint64)
        for i in range(size):
            out = _mixed(out * _WORD_SEED + h[i : i + n])
        return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Per coordinate, the least of its own hash over all shingles."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None]
        least = np.minimum(least, _mixed(part * _KEYS[0] + _KEYS[1]).min(0))
    return least


def _signed(batches):
    shingler = Shingler()
    for b in batches:
        n, s1, s2, sig = [], [], [], []
        for text in b.column("text").to_pylist():
            s = shingler.shingles(text)
            n.append(len(s))
            s1.append(int(_mixed(s).sum(dtype=np.uint64).astype(np.int64)))
            s2.append(int(_mixed(s ^ _MIX1).sum(dtype=np.uint64).astype(np.int64)))
            sig.append(signature(s).astype(np.int64) if len(s) else None)
        cols = [b.column(c) for c in ("id", "r1", "r2")]
        cols += [pa.array(x, pa.int64()) for x in (n, s1, s2)] + [pa.array(sig, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(cols, ["id", "r1", "r2", "n", "s1", "s2", "sig"])


def _sets(batches):
    shingler = Shingler()
    for b in batches:
        found = [shingler.shingles(t).astype(np.int64) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])


def _linked(batches):
    """Pairs of blocks: a forest (u, v) that spans the links between them, found on full sets."""
    for batch in batches:
        for r in batch.to_pylist():
            a, b = np.array(r["nodes_a"]), np.array(r["nodes_b"])
            sets_a, sets_b = ([np.array(x, np.int64) for x in r[c]] for c in ("sets_a", "sets_b"))
            na, nb = np.array([len(x) for x in sets_a]), np.array([len(x) for x in sets_b])
            all_a, all_b = np.concatenate(sets_a), np.concatenate(sets_b)
            shared = np.intersect1d(all_a, all_b)
            both = np.zeros((len(a), len(b)), np.float32)
            rows_a, rows_b = np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)
            for at in range(0, len(shared), COLUMNS):
                part = shared[at : at + COLUMNS]
                has = []
                for values, rows, n in ((all_a, rows_a, len(a)), (all_b, rows_b, len(b))):
                    where = np.searchsorted(part, values)
                    ok = np.flatnonzero(part[np.minimum(where, len(part) - 1)] == values)
                    m = np.zeros((n, len(part)), np.float32)
                    m[rows[ok], where[ok]] = 1
                    has.append(m)
                both += has[0] @ has[1].T
            hit = both * 100 >= SIMILARITY * (na[:, None] + nb[None, :] - both)
            top = np.iinfo(np.int64).max
            la, lb = a.copy(), b.copy()
            while True:  # the smallest node reached within these blocks, by passing minima to and fro
                ma = np.minimum(la, np.where(hit, lb[None, :], top).min(1))
                mb = np.minimum(lb, np.where(hit, ma[:, None], top).min(0))
                if (ma == la).all() and (mb == lb).all():
                    break
                la, lb = ma, mb
            nodes, least = np.concatenate([a, b]), np.concatenate([la, lb])
            out = nodes != least
            yield pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(least[out])], ["u", "v"])


def sets_of(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, shingles) of the given classes, from the text of one document of each."""
    wanted = settle(classes.select("node", "r1", "r2").join(nodes, "node"))
    texts = docs.join(counted_broadcast(wanted), ["r1", "r2"]).select("node", "text")
    return settle(texts.mapInArrow(_sets, "node bigint, shingles array<bigint>").dropDuplicates(["node"]))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the candidate pairs (u, v) those whose full sets of shingles are similar enough."""
    for s in "uv":
        pairs = pairs.join(sets.select(F.col("node").alias(s), F.col("shingles").alias(f"s{s}")), s)
    both = F.size(F.array_intersect("su", "sv"))
    either = F.size("su") + F.size("sv") - both
    return settle(pairs.where(both * 100 >= either * SIMILARITY).select("u", "v"))


def herd_links(herds: DataFrame, roots: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Links inside each herd (node, root as herd) beyond those that made ``roots``, enough to span them.

    A herd's largest component is never compared with itself. The others' shingles are counted,
    rare ones go first, and a set is posted under as many as two similar sets must share one of: a
    family that shares only what is frequent in it posts nothing that meets. Members of a list are
    compared with its pivot; of lists that are still in several components, short ones are
    joined, and the members of long ones meet in blocks.
    """
    found = herds.select("node", F.col("root").alias("herd")).join(roots, "node", "left")
    found = settle(found.withColumn("root", F.coalesce("root", "node")))
    found = _outside_main(found)
    if found.isEmpty():
        return found.selectExpr("node AS u", "node AS v")
    info = settle(found.join(classes.select("node", "n", "sig"), "node"))
    posted = _rare_postings(info, sets)

    lists = _open_lists(posted)
    stars = posted.join(lists, "key").where(F.col("node") != F.col("pivot"))
    stars = stars.select(F.least("node", "pivot").alias("u"), F.greatest("node", "pivot").alias("v")).distinct()
    linked = confirmed(*_promising(stars, info, sets))
    if not linked.isEmpty():
        ends = info.select("node", "root")
        roots = linked.join(ends.toDF("u", "ru"), "u").join(ends.toDF("v", "rv"), "v").select(F.col("ru").alias("u"), F.col("rv").alias("v"))
        joined = components(roots).toDF("root", "into")
        info = settle(info.join(joined, "root", "left").withColumn("root", F.coalesce("into", "root")).drop("into"))
        posted = settle(posted.drop("root").join(info.select("node", "root"), "node"))
    lists = _open_lists(posted)
    rows = settle(posted.join(lists.select("key", "long"), "key"))
    few = rows.where(F.col("long") <= SHORT)
    x, y = few.alias("x"), few.alias("y")
    meet = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    pairs = x.join(y, meet & _similar_size("x.n", "y.n")).select(F.col("x.node").alias("u"), F.col("y.node").alias("v")).distinct()
    linked = linked.unionByName(confirmed(*_promising(pairs, info, sets)))
    dense = _outside_main(rows.where(F.col("long") > SHORT).select("herd", "node", "root").distinct())
    return linked if dense.isEmpty() else linked.unionByName(_block_links(dense.join(info.select("node", "n"), "node"), sets))


def _outside_main(found: DataFrame) -> DataFrame:
    """(herd, rest, node, root) of the herds in several components; rest is 0 in the herd's largest."""
    parts = found.groupBy("herd", "root").count()
    main = parts.groupBy("herd").agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.count("*").alias("parts"))
    found = found.join(main.where("parts > 1"), "herd").withColumn("rest", (F.col("root") != F.col("main")).cast("int"))
    return settle(found.select("herd", "rest", "node", "root"))


def _rare_postings(info: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, node, n, herd, rest, root): each set under the shingles that come first, by their count outside the main component.

    Sets of n and more with similarity 0.75 share at least 75% of n, so one of the first n - 75% + 1 of either.
    """
    members = counted_broadcast(info.select("node", "herd", "rest"))
    flat = sets.join(members, "node").select(
        "node", "rest", F.explode(F.transform("shingles", lambda x: F.xxhash64("herd", x))).alias("key")
    )
    often = settle(flat.where("rest = 1").groupBy("key").agg(F.count("*").alias("often")))
    known = flat.join(counted_broadcast(often), "key").groupBy("node").agg(F.collect_list(F.struct("often", "key")).alias("known"))
    first = F.col("n") - F.ceil(F.col("n") * SIMILARITY / 100) + 1
    # shingles that no set outside the main component has come before all others and need no posting
    rare = F.slice(F.array_sort("known"), 1, F.greatest(F.lit(0), (first - F.col("n") + F.size("known")).cast("int")))
    per = known.join(info.drop("sig"), "node").select("node", "n", "herd", "rest", "root", rare.alias("rare"))
    return settle(per.select("node", "n", "herd", "rest", "root", F.explode("rare.key").alias("key")))


def _open_lists(posted: DataFrame) -> DataFrame:
    """Lists whose members are in several components, with their length and pivot, of the main component if possible."""
    per = posted.groupBy("key").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.count("*").alias("long"),
        F.min(F.struct("rest", "node"))["node"].alias("pivot"),
    )
    return per.where("low <> high").select("key", "long", "pivot")


def _promising(pairs: DataFrame, info: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of different components, like sizes and enough collisions, and the sets of their ends."""
    for s in "uv":
        pairs = pairs.join(info.select(*[F.col(c).alias(f"{s}_{c}") for c in ("root", "n", "sig")], F.col("node").alias(s)), s)
    pairs = pairs.where((F.col("u_root") != F.col("v_root")) & _similar_size("u_n", "v_n"))
    pairs = settle(pairs.where(_collisions("u_sig", "v_sig") >= MATCHES).select("u", "v"))
    return pairs, sets.join(counted_broadcast(settle(_ends(pairs))), "node")


def _block_links(found: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the members of each herd, except inside its main component, as forests; all blocks meet.

    A block holds ``BLOCK`` sets or ``WEIGHT`` shingles on average, whichever is less.
    """
    many = found.groupBy("herd", "rest").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / WEIGHT)).alias("blocks")
    )
    dealt = found.join(many, ["herd", "rest"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")) * 2 + F.col("rest"))
    dealt = counted_broadcast(settle(dealt.select("herd", "rest", "block", "node")))
    blocks = sets.join(dealt, "node").groupBy("herd", "rest", "block").agg(
        F.collect_list(F.struct("node", "shingles")).alias("members")
    )
    blocks = settle(blocks)
    ends = blocks.select("herd", "rest", "block")
    a, b = ends.alias("a"), ends.alias("b")
    meet = (F.col("a.herd") == F.col("b.herd")) & (F.col("a.block") <= F.col("b.block"))
    meet &= (F.col("a.rest") == 1) | (F.col("b.rest") == 1)
    pairs = a.join(b, meet).select(F.col("a.herd").alias("herd"), F.col("a.block").alias("a"), F.col("b.block").alias("b"))
    for s in "ab":
        load = [F.col("members.node").alias(f"nodes_{s}"), F.col("members.shingles").alias(f"sets_{s}")]
        pairs = pairs.join(blocks.select("herd", F.col("block").alias(s), *load), ["herd", s])
    return settle(pairs.select("nodes_a", "sets_a", "nodes_b", "sets_b").mapInArrow(_linked, "u bigint, v bigint"))


def _similar_size(a: str, b: str) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * SIMILARITY


def _collisions(a: str, b: str) -> Column:
    return F.size(F.array_intersect(a, b))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept, r1 and r2, the hash of its id and text, and root.

    Two documents link if their sets of distinct 5-word shingles have Jaccard similarity 0.75 or
    more; with fewer words the whole sequence is the one shingle; null texts and texts without
    words link with nothing and are their own component. component_id is the smallest id
    reachable. Rows without id link like all others but name no component; a component of such
    rows only has a null id, and all of them are kept. Repeated rows have equal results. root numbers
    the components, null where a text has no words.

    Documents with equal sets are one class, joined once. Classes that collide enough with the
    pivot of a list they share form herds; what the pivots have not linked in a herd meets by the
    rarest shingles of its sets, and only members of long lists of those in blocks. Classes of different herds
    meet in pairs, in the join and under its filters. No list is capped and no pair is left out. Texts are not shuffled unless more than
    ``BROADCAST_ROWS`` of them have candidates.
    """
    spark = docs.sparkSession
    ship_package(spark)
    body = F.col(f"`{text}`")
    r1, r2 = hash_pair(F.col(f"`{id}`"), body)
    rows = docs.select(F.col(f"`{id}`").alias("id"), body.alias("text"), r1.alias("r1"), r2.alias("r2"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, r1 bigint, r2 bigint, n bigint, s1 bigint, s2 bigint, sig array<bigint>"
    signed = settle(rows.mapInArrow(_signed, schema))
    per_set = signed.where("n > 0").groupBy("n", "s1", "s2").agg(
        F.min("id").alias("id"), F.min_by(F.struct("r1", "r2"), "r1").alias("r"), F.first("sig").alias("sig")
    )
    classes = per_set.select("n", "s1", "s2", "id", "r.r1", "r.r2", "sig")
    classes = settle(classes.withColumn("node", F.monotonically_increasing_id()))

    posted = classes.select("node", F.explode("sig").alias("key"))
    lists = posted.groupBy("key").agg(F.count("*").alias("long"), F.min("node").alias("pivot")).where("long > 1")
    shared = posted.join(lists, "key").groupBy("node").agg(F.collect_list(F.struct("long", "key", "pivot")).alias("keys"))
    rare = F.slice(F.array_sort("keys"), 1, F.greatest(F.lit(0), PREFIX - COORDINATES + F.size("keys")))
    prefixes = shared.select("node", rare.alias("rare")).where(F.size("rare") > 0)
    bare = classes.select("node", "n", "sig")
    prefixes = settle(prefixes.join(bare, "node"))

    flat = prefixes.select("node", "n", "sig", F.explode("rare").alias("at"))
    stars = flat.select("node", "n", "sig", F.col("at.pivot").alias("v")).where(F.col("node") != F.col("v"))
    other = bare.select(F.col("node").alias("v"), F.col("n").alias("vn"), F.col("sig").alias("vsig"))
    stars = stars.dropDuplicates(["node", "v"]).join(other, "v").where(_collisions("sig", "vsig") >= MATCHES)
    stars = settle(stars.select(F.least("node", "v").alias("u"), F.greatest("node", "v").alias("v")).distinct())
    herds = components(stars)
    sets = sets_of(herds.select("node"), rows, classes)
    edges = confirmed(stars, sets)
    edges = edges.unionByName(herd_links(herds, components(edges), sets, classes))

    flat = settle(_apart(prefixes.select("node", "n", "sig", "rare", F.explode("rare").alias("at")), herds))
    flat = flat.withColumn("rare", F.transform("rare", lambda x: x["key"]))
    a, b = flat.alias("a"), flat.alias("b")
    meet = (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.root") != F.col("b.root"))
    meet &= _similar_size("a.n", "b.n") & (_collisions("a.sig", "b.sig") >= MATCHES)
    first = F.array_min(F.array_intersect("a.rare", "b.rare")) == F.col("a.key")
    pairs = settle(a.join(b, meet & first).select(F.col("a.node").alias("u"), F.col("b.node").alias("v")))
    if not pairs.isEmpty():
        edges = edges.unionByName(confirmed(pairs, sets_of(_ends(pairs), rows, classes)))
    roots = components(edges)
    member = classes.select("n", "s1", "s2", "node", "id")
    member = member.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = member.groupBy("root").agg(F.min("id").alias("component_id"))
    member = member.join(smallest, "root").select("n", "s1", "s2", "component_id", "root")
    out = signed.select("id", "n", "s1", "s2", "r1", "r2").join(member, ["n", "s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
        "r1",
        "r2",
        "root",
    )


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``near_duplicates``, and every row without words; all columns as they are.

    The row with the smallest id stays; rows without id come after all others, equal ids are told
    apart by the hash of the text, and of rows equal in id and text the smallest whole row stays.
    """
    found = near_duplicates(docs, id, text).select(F.col(f"`{id}`").alias("id"), "r1", "r2", "root").where("root IS NOT NULL")
    per = settle(found.groupBy("root", "r1", "r2").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "r1", "r2")
    best = per.groupBy("root").agg(F.min(order).alias("best"), F.sum("copies").alias("rows")).where("rows > 1").drop("rows")
    per = per.join(best, "root").withColumn("first", (F.col("r1") == F.col("best.r1")) & (F.col("r2") == F.col("best.r2")))
    gone = settle(per.where("NOT first OR copies > 1").select("r1", "r2", "first"))
    r1, r2 = hash_pair(F.col(f"__row.`{id}`"), F.col(f"__row.`{text}`"))
    rows = docs.select(packed(docs)).withColumns({"r1": r1, "r2": r2})
    kept = rows.join(counted_broadcast(gone.drop("first")), ["r1", "r2"], "left_anti").select("__row")
    repeated = gone.where("first").drop("first")
    if not repeated.isEmpty():
        again = rows.join(counted_broadcast(repeated), ["r1", "r2"], "left_semi")
        kept = kept.union(again.groupBy("r1", "r2").agg(F.min("__row").alias("__row")).select("__row"))
    return kept.select(*unpacked(docs.columns, {}))


def _apart(flat: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings of the lists whose members are still in more than one component, with their component."""
    flat = flat.withColumn("key", F.col("at.key")).drop("at")
    flat = flat.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_lists = flat.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return flat.join(open_lists.select("key"), "key")


SQL_SHINGLES = """
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') ws FROM {docs}),
sh AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) s FROM w),
f AS (SELECT doc_id, len(s) n, unnest(s) x FROM sh),
c AS (SELECT a.doc_id u, b.doc_id v, any_value(a.n) na, any_value(b.n) nb, count(*) k
      FROM f a JOIN f b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) GROUP BY 1, 2),
p AS (SELECT u, v FROM c WHERE 100 * k >= 75 * (na + nb - k)),
r AS (SELECT doc_id u, doc_id v FROM sh UNION SELECT r.u, p.v FROM r JOIN p ON r.v = p.u),
g AS (SELECT u doc_id, min(v) component_id FROM r GROUP BY u)
"""


@query(
    "op9_minhash_near_dedup",
    f"""WITH RECURSIVE {SQL_SHINGLES.format(docs="documents")}
SELECT doc_id, len(s)::BIGINT n_shingles, component_id, doc_id = component_id kept FROM sh JOIN g USING (doc_id)""",
)
def op9_minhash_near_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
