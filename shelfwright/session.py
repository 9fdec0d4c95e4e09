"""Session settings, the checkpoint folder, and joins whose small side is size-checked."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_ROWS = 200_000


def build_session(app: str = "shelfwright", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for. AQE sizes the shuffles."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # rules are long expressions: do not record a call site for each of their nodes
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # wide page rows: small Arrow batches keep the Python workers' memory flat
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where it is unset, and only on a one-machine master, a temporary folder stands in.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwright-"))
    return spark._jsc.sc().getCheckpointDir().get()


def settle(df: DataFrame) -> DataFrame:
    """Write the result to a new table in the shared folder and read it back.

    Cuts lineage: whatever executors are lost later, this is not computed again.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/settled/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_shelfwright_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="shelfwright-"), "shelfwright.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(home):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(home)))
    sc.addPyFile(target)
    sc._shelfwright_shipped = True


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of the result. Runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def use_all_cores(df: DataFrame, per_core: int = 16 << 20) -> DataFrame:
    """Deal rows out over the cores if the input is too small to have a partition for each.

    Meant before per-row Python work. Anything larger than ``per_core`` bytes per core keeps
    the partitions of its scan, so nothing large is ever shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or estimated_bytes(df) > cores * per_core:
        return df
    return df.repartition(cores)


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS, count_up_to: int = 4 << 30) -> bool:
    """True if ``df`` has at most ``max_rows`` rows; counts no further than that.

    A result the optimizer puts above ``count_up_to`` bytes is taken as large uncounted.
    """
    if max_rows <= 0 or estimated_bytes(df) > count_up_to:
        return False
    return df.limit(max_rows + 1).count() <= max_rows


def heavy_keys(df: DataFrame, key: str, share: float) -> list:
    """Keys that hold about ``share`` of the rows or more, null aside: at most a few times 1 / ``share``.

    One pass with a frequent-items sketch, merged from all partitions; no row is shuffled. A key
    near the bound may be on either side of it, one well above it is never missed.
    """
    most = round(1 / share)
    sketch = F.expr(f"approx_top_k(`{key}`, {2 * most}, {16 * most})").alias("top")
    top, rows = df.where(F.col(key).isNotNull()).agg(sketch, F.count("*")).first()
    return [t["item"] for t in top or () if t["count"] >= share * rows]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column,
    max_rows: int = SMALL_ROWS,
    salts: int = 32,
    share: float = 0.001,
) -> DataFrame:
    """Left join to a side that is unique on ``key``, safe when one key holds much of ``left``.

    ``right`` is evaluated once, into a table. If that is counted small, it is broadcast. Otherwise
    keys that hold ``share`` of ``left`` or more are looked for: only their rows of ``right``, no
    more than a few times 1 / ``share``, are repeated once per salt, and only their rows of ``left``
    get one, taken from ``spread_by`` (a hash, so a re-run task salts alike). All other keys meet
    plainly. Rows without a key match nothing and are spread over many tasks.
    """
    right = settle(right)
    if is_small(right, max_rows):
        return left.join(F.broadcast(right), key, "left")
    hot = F.col(key).isin(heavy_keys(left, key, share))
    h = F.xxhash64(spread_by)
    none, one = F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")
    salt = F.when(F.col(key).isNull(), F.pmod(h, F.lit(1 << 20))).when(hot, F.pmod(h, F.lit(salts))).otherwise(none)
    copies = right.withColumn("_salt", F.explode(F.sequence(none, F.when(hot, one).otherwise(none))))
    return left.withColumn("_salt", salt).join(copies, [key, "_salt"], "left").drop("_salt")
