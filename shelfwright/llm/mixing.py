"""Mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame operations only.

Every document draws an exponential key, -ln(u) / quality weight; small keys come first. A
source's target is met by as many complete epochs of the source as it holds, then by the documents
with the smallest keys until their sizes fill the rest. The prefix sums run in two steps, over
the totals of key buckets and then inside the one bucket where the budget ends, so that a source
of any size is never sorted in one task; what comes out is one cut key per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwright.llm.common import WORD, counted_broadcast, packed, query, table, unpacked
from shelfwright.session import settle

#: Buckets of equal key probability in each source.
BUCKETS = 1 << 16
SYMBOLS = "#$%&*+/<=>@[]^_`{|}~"


def word_count(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def readable(text: Column) -> Column:
    """Quality of a text between 0 and 1: full marks without symbols, none where they are a fifth of it; 0.5 if empty."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.when(F.length(text) > 0, F.greatest(F.lit(0.0), 1 - 5.0 * symbols / F.length(text))).otherwise(0.5)


def uniform(id: Column, text: Column) -> Column:
    """In (0, 1), from 52 bits of the md5 of the id as text, of the text itself without an id: the same in every run."""
    digits = F.substring(F.md5(F.coalesce(id.cast("string"), text, F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def _targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(src, source_size, target): ``share`` of all sizes dealt by weight, no source above ``most`` times its size.

    What a source cannot take is dealt again to the others by weight, until none is above.
    """
    seat = F.row_number().over(Window.orderBy("src")) - 1  # one narrow row per source
    weight = F.array(*map(F.lit, weights))[seat % len(weights)]
    src = settle(sizes.withColumn("weight", weight.cast("double")))
    total, heft = src.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = share * (total or 0)
    level, full = budget / heft if heft else 0.0, 0
    while True:
        over = F.col("weight") * level > most * F.col("source_size")
        n, taken, left = src.agg(
            F.count_if(over), F.sum(F.when(over, F.col("source_size"))), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n == full or not left:
            break
        full, level = n, (budget - most * taken) / left
    target = F.least(F.col("weight") * level, most * F.col("source_size"))
    return src.select("src", "source_size", target.alias("target"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows numbered from 1 in each source, as ``seat``: counted by part first, then inside each part.

    The rows are written with their parts, so a task run again numbers them alike.
    """
    rows = settle(rows.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    before = F.sum("n").over(Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.groupBy("src", "part").agg(F.count("*").alias("n"))
    parts = settle(parts.select("src", "part", F.coalesce(before, F.lit(0)).alias("ahead")))
    seat = F.col("ahead") + F.row_number().over(Window.partitionBy("src", "part").orderBy("at"))
    return rows.join(counted_broadcast(parts), ["src", "part"]).withColumn("seat", seat).drop("part", "at", "ahead")


def mix(
    docs: DataFrame,
    quality: Column | None = None,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    labels: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken = copies * size.

    Sources by code point, null last as a source of its own, weigh ``weights`` in turn. A key's
    weight is 1 plus the mean quality that ``labels`` (id, quality; any number of rows per id) gives
    the document, or else ``quality``, both between 0 and 1; by default that is taken from the text.
    ``copies`` is how often the mix takes the document: the complete epochs, plus one if its key is
    not above the source's cut. The document on which the budget ends is taken if that comes nearer to the target. Rows without words are never drawn;
    a row without an id draws by its text. Rows equal in id and text share a key, and where the cut
    lies among them as many are taken as bring the source nearest to its target. No row is dropped;
    an empty table stays empty, and of the caller's columns only those named like the new ones are replaced.

    Nothing wide is shuffled: sums per source and bucket, then one cut per source, broadcast if
    counted to be few; only rows among which a cut lies are written, to be numbered. Labels are averaged first and broadcast likewise; more labelled documents
    than that cost one shuffle of the rows.
    """
    row = docs.select(packed(docs))
    field = {c: F.col(f"__row.`{c}`") for c in (id, text, source)}
    src = F.concat(F.when(field[source].isNull(), "1").otherwise("0"), F.coalesce(field[source], F.lit("")))
    row = row.withColumns({"src": src, "size": word_count(field[text]), "u": uniform(field[id], field[text]), "id": field[id]})
    row = row.withColumn("grade", readable(field[text]) if quality is None else F.coalesce(quality, F.lit(0.5)))
    row = row.withColumn("tie", F.xxhash64("id", field[text]))
    if labels is not None:
        mean = labels.groupBy("id").agg(F.avg("quality").alias("labelled")).where("labelled IS NOT NULL")
        row = row.join(counted_broadcast(settle(mean)), "id", "left").withColumn("grade", F.coalesce("labelled", "grade"))
    row = row.withColumn("key", -F.log("u") / (F.col("grade") + 1))
    row = row.withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * BUCKETS))

    narrow = settle(row.select("src", "size", "key", "tie", "bucket"))
    sums = settle(narrow.groupBy("src", "bucket").agg(F.sum("size").alias("size")))
    targets = _targets(sums.groupBy("src").agg(F.sum("size").alias("source_size")), weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = settle(
        targets.withColumn("epochs", epochs.cast("int")).withColumn(
            "rest", F.col("target") - F.col("epochs") * F.col("source_size")
        )
    )
    few = counted_broadcast(targets)
    before = F.coalesce(F.sum("size").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = sums.withColumn("before", before).join(few, "src")
    # the bucket in which the budget ends; every earlier one is taken whole
    at = at.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("size") > F.col("rest")))
    last = settle(at.select("src", "bucket", "before", "rest"))
    inside = narrow.join(counted_broadcast(last), ["src", "bucket"]).where(F.col("size") > 0)
    # rows of one key are alike and of one size; the last key of which any is taken is the cut
    alike = inside.groupBy("src", "before", "rest", "key", "tie").agg(F.min("size").alias("size"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("src").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("before") - F.coalesce(F.sum(F.col("size") * F.col("rows")).over(earlier), F.lit(0))
    alike = alike.withColumn("some", F.least("rows", F.floor(left / F.col("size") + 0.5))).where("some > 0")
    cut = alike.groupBy("src").agg(F.max(F.struct("key", "tie", "some", "rows")).alias("cut"))
    cuts = settle(
        targets.join(last.select("src", F.col("bucket").alias("last")), "src", "left").join(cut, "src", "left")
    )
    cuts = cuts.select("*", F.struct("cut.key", "cut.tie").alias("upto"), (F.col("cut.some") < F.col("cut.rows")).alias("partly"))
    out = row.join(counted_broadcast(cuts), "src")
    drawn = (F.col("bucket") < F.col("last")) | (
        (F.col("bucket") == F.col("last")) & F.coalesce(F.struct("key", "tie") <= F.col("upto"), F.lit(False))
    )
    out = out.withColumn("drawn", drawn)
    if not cuts.where("partly").isEmpty():
        parted = F.coalesce(F.col("partly") & (F.struct("key", "tie") == F.col("upto")) & (F.col("size") > 0), F.lit(False))
        out = out.where(~parted).unionByName(_numbered(out.where(parted)).withColumn("drawn", F.col("seat") <= F.col("cut.some")).drop("seat"))
    drawn = F.coalesce("drawn", F.lit(False)) & (F.col("size") > 0) & (F.col("rest") > 0)
    copies = F.when(F.col("size") > 0, F.col("epochs") + drawn.cast("int")).otherwise(0)
    new = {
        "size": F.col("size"),
        "source_size": F.col("source_size"),
        "target": F.col("target"),
        "copies": copies.cast("int"),
        "taken": copies * F.col("size"),
    }
    return out.select(*unpacked(docs.columns, new))


def quality_labels(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").alias("id"), "quality")


SQL_MIX = """
g AS (SELECT doc_id, avg(quality)::DOUBLE labelled FROM labels GROUP BY doc_id),
z AS (SELECT doc_id, source, "text" body, CASE WHEN labelled IS NOT NULL THEN labelled WHEN length("text") > 0 THEN greatest(0.0::DOUBLE,
             1 - 5.0::DOUBLE * (length("text") - length(translate("text", '#$%&*+/<=>@[]^_`{{|}}~', ''))) / length("text")) ELSE 0.5::DOUBLE END q, len(regexp_extract_all(coalesce("text", ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT size FROM {docs} LEFT JOIN g USING (doc_id)),
k AS (SELECT z.*, -ln((('0x' || substr(md5(coalesce(z.doc_id::VARCHAR, z.body, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
             / (q + 1) "key" FROM z),
s AS (SELECT source, sum(size)::BIGINT source_size, list_extract([5, 2, 1], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT) w
      FROM z GROUP BY source),
lv AS (SELECT 2 * a.source_size / a.w::DOUBLE r,
              (1.5 * (SELECT sum(source_size) FROM s) - 2 * coalesce(sum(b.source_size) FILTER (WHERE 2 * b.source_size / b.w::DOUBLE < 2 * a.source_size / a.w::DOUBLE), 0))::DOUBLE
              / sum(b.w) FILTER (WHERE 2 * b.source_size / b.w::DOUBLE >= 2 * a.source_size / a.w::DOUBLE) lam
       FROM s a, s b GROUP BY a.source, a.source_size, a.w),
lam AS (SELECT arg_min(lam, r) lam FROM lv WHERE lam <= r),
t AS (SELECT source, source_size, least(w * lam, 2.0::DOUBLE * source_size)::DOUBLE target FROM s, lam),
e AS (SELECT t.*, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END epochs FROM t),
m AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size rest,
             sum(k.size) OVER (PARTITION BY k.source ORDER BY "key", k.doc_id ROWS UNBOUNDED PRECEDING) - k.size / 2 mid
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source),
mixed AS (SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE epochs + CASE WHEN rest > 0 AND mid <= rest THEN 1 ELSE 0 END END::BIGINT copies FROM m)
"""


@query(
    "op6_mixing",
    f"WITH {SQL_MIX.format(docs='documents')} SELECT doc_id, size, source_size, target, copies * size taken FROM mixed",
)
def op6_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    labels = quality_labels(table(spark, folder, "labels"))
    return mix(docs, labels=labels).select("doc_id", "size", "source_size", "target", "taken")
