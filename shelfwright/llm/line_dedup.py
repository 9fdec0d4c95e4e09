"""Line dedup over levelled sorted runs of line hashes. DataFrame operations only.

A run is a table (hash, documents that hold it), hash-partitioned and sorted by hash. Each new
batch of documents is reduced to its own distinct line hashes, which are merge-anti-joined with
the lines the runs have already settled as frequent; the rest becomes a run of level 0. As soon
as a level has ``fanout`` runs they are merged into one of the next level. A line is settled
when some run holds it in ``min_docs`` documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.common import (
    SPACE,
    ascii_lower,
    file_batches,
    hash_pair,
    packed,
    query,
    table,
    unpacked,
)
from shelfwright.session import settle

BATCHES, FANOUT = 4, 2
#: At most this many lines are treated as heavy: each holds over 1/HEAVY of all frequent occurrences.
HEAVY = 1000


def lines_of(text: Column) -> Column:
    """The lines of a text, split at \\n. A null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


class LineRuns:
    """The runs so far. ``add`` takes one batch, ``frequent`` answers over all batches."""

    def __init__(self, min_docs: int = 10, min_chars: int = 1, fanout: int = FANOUT):
        self.min_docs, self.min_chars, self.fanout = min_docs, min_chars, fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def add(self, batch: DataFrame, text: str = "text") -> None:
        """Count the batch's lines, one per document, without those already settled. Every row is a document."""
        keys = batch.select(F.explode(F.array_distinct(F.transform(lines_of(F.col(text)), line_key))).alias("k"))
        h1, h2 = hash_pair(F.col("k"))
        own = keys.where(F.length("k") >= self.min_chars).select(h1.alias("h1"), h2.alias("h2"))
        run = own.groupBy("h1", "h2").agg(F.count("*").alias("docs"))
        for known in self.settled:
            run = run.join(known.hint("merge"), ["h1", "h2"], "left_anti")
        self._keep(run, 0)

    def _keep(self, run: DataFrame, level: int) -> None:
        written = settle(run.sortWithinPartitions("h1", "h2"))
        self.settled.append(written.where(F.col("docs") >= self.min_docs).select("h1", "h2", "docs"))
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(written.where(F.col("docs") < self.min_docs))
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._keep(_merged(runs), level + 1)

    def frequent(self) -> DataFrame:
        """(h1, h2, docs) of every line in at least ``min_docs`` documents; docs is a lower bound."""
        runs = self.settled + [r for level in self.levels for r in level]
        return settle(_merged(runs).where(F.col("docs") >= self.min_docs))


def _merged(runs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, runs).groupBy("h1", "h2").agg(F.sum("docs").alias("docs"))


def drop_lines(
    docs: DataFrame, frequent: DataFrame, min_chars: int = 1, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """``docs`` with the frequent lines cut out of ``text``, and n_lines, n_dropped.

    Only (row hash, position, line hash) is shuffled to the line join. Lines so frequent that
    they would fill a task, at most ``HEAVY``, are met by a broadcast; all others hold less than
    a thousandth of the matches each. The positions to drop then meet the text once. Rows are
    told apart by a hash of id and text, so null and repeated ids do no harm; rows equal in both
    have equal results. No row is lost: a text that loses all lines is empty.
    """
    row = docs.select(packed(docs))
    body = F.col(f"__row.`{text}`")
    r1, r2 = hash_pair(F.col(f"__row.`{id}`"), body)
    row = row.withColumns({"r1": r1, "r2": r2})
    lines = row.select("r1", "r2", F.posexplode(lines_of(body)).alias("pos", "line"))
    lines = lines.select("r1", "r2", "pos", line_key(F.col("line")).alias("k")).where(F.length("k") >= min_chars)
    h1, h2 = hash_pair(F.col("k"))
    lines = lines.select("r1", "r2", "pos", h1.alias("h1"), h2.alias("h2"))
    total = frequent.agg(F.sum("docs")).first()[0] or 0
    heavy = frequent.where(F.col("docs") * HEAVY >= total).select("h1", "h2", F.lit(True).alias("heavy"))
    lines = lines.join(F.broadcast(heavy), ["h1", "h2"], "left")
    # a heavy line is settled: spread it by its row instead of its hash
    spread = {c: F.when(F.col("heavy"), F.col(r)).otherwise(F.col(c)) for c, r in (("h1", "r1"), ("h2", "r2"))}
    light = frequent.select("h1", "h2", F.lit(True).alias("hit"))
    hits = lines.withColumns(spread).join(light, ["h1", "h2"], "left").where("heavy or hit")
    drop = hits.groupBy("r1", "r2").agg(F.collect_set("pos").alias("drop"))
    out = row.join(drop, ["r1", "r2"], "left").withColumn("lines", lines_of(body))
    n = F.size("lines")
    none = F.array().cast("array<int>")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.coalesce("drop", none))
    out = out.withColumn("kept", kept)
    new = {
        text: F.array_join(F.transform("kept", lambda i: F.col("lines")[i]), "\n"),
        "n_lines": n.cast("bigint"),
        "n_dropped": (n - F.size("kept")).cast("bigint"),
    }
    return out.select(*unpacked(docs.columns, new))


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    arrivals: list[DataFrame] | None = None,
    text: str = "text",
) -> DataFrame:
    """Take in ``docs`` arrival by arrival, then drop every frequent line everywhere.

    ``arrivals`` are the same rows as ``docs``; if they are not given, a plain scan arrives in
    ``BATCHES`` groups of whole files, so that each file is read once for the runs.
    """
    runs = LineRuns(min_docs, min_chars)
    for batch in arrivals or file_batches(docs, BATCHES):
        runs.add(batch, text)
    return drop_lines(docs, runs.frequent(), min_chars, text)


SQL_LINES = """
l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) pos FROM {docs}),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
"""


@query(
    "op1_line_dedup",
    f"""
WITH {SQL_LINES.format(docs="documents")}
SELECT doc_id, count(*) n_lines, count(*) FILTER (WHERE f.key IS NOT NULL) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY doc_id
""",
)
def op1_line_dedup(spark, folder):
    docs = table(spark, folder, "documents")
    out = dedup_lines(docs.select("doc_id", "text"), arrivals=file_batches(docs, BATCHES))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
