import datetime
import os

import pytest
from pyspark.sql import functions as F

from shelfwright.operators import audit as A
from shelfwright.operators import rows as R
from shelfwright.schemas import PROBE_SCHEMA, PRODUCT_COLUMNS, RECORD_SCHEMA
from shelfwright.session import heavy_keys, is_small, lookup_join
from shelfwright.sources import sinks as K
from shelfwright.sources import tables as S
from shelfwright.streaming import items as ST
from shelfwright.operators.audit import probe_outcome
from shelfwright.operators.knn import nearest
from shelfwright.plans.catalogue import extract_a, products_from_pages
from shelfwright.plans.site_profiles import SITE_A


def test_taxonomy_file(spark, tmp_path):
    f = tmp_path / "tree.csv"
    f.write_text('id,parent_id,name,path\n1,NULL,"Plant, tool",1\n2,1,"The ""big"" one",1.2\n')
    rows = S.read_taxonomy(spark, str(f)).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, "Plant, tool", "1"), (2, 1, 'The "big" one', "1.2")]


def test_product_file_there_and_back(spark, tmp_path):
    row = {c: None for c in PRODUCT_COLUMNS} | {
        "brand": "B",
        "product_name": 'A "quoted", name',
        "technical_specs": '{"a": "1 \\"x\\"", "ü": "²"}',
        "type_id": 7,
        "source_url": "http://x/y",
        "scraped_timestamp": datetime.datetime(2025, 1, 2, 3, 4, 5, 678),
    }
    df = spark.createDataFrame([tuple(row[f.name] for f in RECORD_SCHEMA.fields)], RECORD_SCHEMA)
    out = str(tmp_path / "p.csv")
    assert K.write_products(df, out)
    header = next(open(os.path.join(out, n), encoding="utf-8").readline() for n in os.listdir(out) if n.endswith(".csv"))
    assert header.strip().split(",") == PRODUCT_COLUMNS
    back = S.read_products(spark, out).first().asDict()
    assert back == {k: v for k, v in row.items() if k != "scraped_timestamp"}
    full = str(tmp_path / "full.csv")
    K.write_products(df, full, schema=RECORD_SCHEMA)
    assert S.read_products(spark, full).first()["scraped_timestamp"] == "2025-01-02T03:04:05.000678"


def test_cells_that_stand_for_nothing(spark, tmp_path):
    f = tmp_path / "p.csv"
    f.write_text('product_name,category,type_id\nNA,n/a,5\n"Drill, big",None,\nNAN,"",7\n')
    rows = [tuple(r) for r in S.read_products(spark, str(f)).collect()]
    assert rows == [(None, None, 5), ("Drill, big", None, None), ("NAN", None, 7)]


def test_no_file_for_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], RECORD_SCHEMA)
    assert K.write_products(empty, str(tmp_path / "none.csv")) is False
    assert not (tmp_path / "none.csv").exists()
    assert K.write_products(empty, str(tmp_path / "some.csv"), store_empty=True) is True


def test_row_positions_over_split_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    n = 0
    for part in range(3):
        lines = ["product_name,pos"] + [f"name {i},{i}" for i in range(n, n + 400 + part)]
        n += 400 + part
        (folder / f"part-{part}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = S.read_products(spark, str(folder), row_idx=True)
        assert df.rdd.getNumPartitions() > 6
        rows = df.select("pos", "row_idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r["row_idx"] for r in rows) == list(range(n))
    assert all(int(r["pos"]) == r["row_idx"] for r in rows)


def test_output_name():
    assert K.classified_path("a/b/items.csv") == "a/b/items_classified.csv"
    assert K.classified_path("items") == "items_classified.csv"


def test_materialize_builds_once(spark, tmp_path):
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "t")
    for rebuild in (False, False, True):
        assert K.materialize(spark, make, path, rebuild).count() == 3
    assert len(calls) == 2


def test_required_columns(spark):
    df = spark.range(1)
    assert R.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="product_image_url"):
        R.require_columns(df, ["id", "product_image_url"])


@pytest.mark.parametrize(
    "args,expect",
    [
        (dict(start=2, end=4), [14, 21]),
        (dict(start=8, limit=5), [56, 63]),
        (dict(limit=2), [0, 7]),
        (dict(start=7), [49, 56, 63]),
        (dict(), list(range(0, 70, 7))),
        (dict(start=10), []),
        (dict(start=4, end=4), []),
        (dict(start=1, end=3, limit=1), [7, 14]),
    ],
)
def test_row_ranges(spark, args, expect):
    df = spark.range(10).select((F.col("id") * 7).alias("k"))
    assert sorted(r["k"] for r in R.slice_rows(df, "k", **args).collect()) == expect


def test_row_ranges_narrow_large_uneven_keys(spark, monkeypatch):
    monkeypatch.setattr(R, "_SORTABLE_ROWS", 10)
    keys = sorted({i**3 for i in range(300)} | {10**15 + i for i in range(50)} | {-5, -1})
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for start, end in ((0, 3), (100, 140), (299, 310), (345, 400)):
        got = sorted(r["k"] for r in R.slice_rows(df, "k", start, end).collect())
        assert got == keys[start:end]


def test_lookup_join_with_one_hot_key_and_many_nulls(spark):
    left = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id")).alias("k")
    )
    right = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = left.join(right, "k", "left")
    for rows in (200_000, 0):
        got = lookup_join(left, right, "k", F.col("id"), rows)
        assert got.count() == 6000
        assert got.select("id", "k", "v").exceptAll(plain.select("id", "k", "v")).isEmpty()
    salted = lookup_join(left, right, "k", F.col("id"), 0, salts=8)
    assert salted.columns == ["k", "id", "v"]


def test_only_heavy_keys_are_repeated(spark, monkeypatch):
    from shelfwright import session

    left = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    assert heavy_keys(left, "k", 0.001) == [7] and heavy_keys(left.limit(0), "k", 0.001) == []
    times = []
    right = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    monkeypatch.setattr(session, "settle", lambda df: times.append(1) or df)
    got = lookup_join(left, right, "k", F.col("id"), 0)
    assert len(times) == 1 and got.where("v = 14").count() == 20_001 and got.count() == 60_000
    assert got.where("v IS NOT NULL AND k <> 7").count() == left.where("k < 1000 AND k <> 7").count()


def test_is_small_counts_no_further_than_needed(spark):
    assert is_small(spark.range(10), 10) and not is_small(spark.range(11), 10)
    assert not is_small(spark.range(1), 0)


def test_columns_first_adds_missing(spark):
    df = spark.createDataFrame([(1, "a")], "x int, brand string")
    out = R.columns_first(df, ["brand", "confidence_score"])
    assert out.columns == ["brand", "confidence_score", "x"]


PROBES = [
    ("http://ok", "HEAD", 200, None),
    ("http://gone", "HEAD", 404, None),
    ("http://retry", "HEAD", 405, None),
    ("http://retry", "GET", 200, None),
    ("http://no", "HEAD", 405, None),
    ("http://no", "GET", 403, None),
    ("http://err", "HEAD", None, "timed out"),
    (None, "HEAD", 200, None),
]


def test_audit_verdicts(spark):
    urls = ["http://ok", "http://gone", "http://retry", "http://no", "http://err", None, "", "http://new"]
    df = spark.createDataFrame(
        [(i, f"p{i}", u) for i, u in enumerate(urls)], "row_idx int, product_name string, product_image_url string"
    )
    log = spark.createDataFrame(PROBES, PROBE_SCHEMA)
    for rows in (200_000, 0):
        out = A.with_verdict(df, log, "row_idx", max_rows=rows)
        got = [(r["image_valid"], r["image_status"]) for r in out.orderBy("row_idx").collect()]
        assert got == [
            (True, "OK"), (False, "Status 404"), (True, "OK"), (False, "Status 403"), (False, "timed out"),
            (False, "Missing URL"), (False, "Missing URL"), (False, "Not probed"),
        ]
    assert tuple(A.audit_summary(out).first()) == (2, 6, 25.0)
    assert [r["product_name"] for r in A.invalid_sample(out, "row_idx", 2).collect()] == ["p1", "p3"]
    assert tuple(A.audit_summary(out.limit(0)).first()) == (0, 0, None)


# ---- streams ----------------------------------------------------------------------------


def _snapshot(spark, folder, ids):
    rows = [(i, f"https://www.flex-tools.com/en/products/saws/s-{i}", f"<h1>Saw {i}</h1>") for i in ids]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.mode("append").parquet(folder)


def test_stream_equals_batch_and_goes_on_after_a_stop(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    _snapshot(spark, src, range(5))

    def run():
        items = ST.item_stream(ST.page_stream(spark, src)).select("page_id", "product_name", "source_url")
        q = ST.run_stream(items, out, state)
        q.awaitTermination()
        return spark.read.parquet(out)

    assert run().count() == 5
    _snapshot(spark, src, range(3, 8))  # 3 and 4 again
    got = run()
    assert sorted(r["page_id"] for r in got.collect()) == list(range(8))
    batch = extract_a(spark.read.parquet(src).dropDuplicates(["url"])).select("page_id", "product_name", "source_url")
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()


def test_bounded_dedupe_forgets_after_the_delay(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    rows = [("a", datetime.datetime(2024, 1, 1)), ("a", datetime.datetime(2024, 1, 2)), ("b", datetime.datetime(2024, 1, 1))]
    spark.createDataFrame(rows, "url string, ts timestamp").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("url string, ts timestamp").parquet(src)
    q = ST.run_stream(ST.once_per_url(stream, "url", "ts", "7 days"), out, state)
    q.awaitTermination()
    assert sorted(r["url"] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_stream_keeps_to_its_host_like_the_batch_job(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = [(1, "https://elsewhere.example.org/en/products/saws/s-1", "<h1>No</h1>"), (2, "https://www.flex-tools.com/en/products/saws/s-2", "<h1>Yes</h1>")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(src)
    batch = products_from_pages(spark.read.parquet(src), SITE_A)
    items = ST.item_stream(ST.page_stream(spark, src)).select("page_id", "product_name")
    q = ST.run_stream(items, str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [r.page_id for r in got] == [r.page_id for r in batch.collect()] == [2]


def test_row_range_on_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (None,)], "k bigint")
    with pytest.raises(ValueError, match="repeated"):
        R.slice_rows(df, "k", start=1, limit=2)
    assert [r.k for r in R.slice_rows(df, "k", start=3).collect()] == [2, 3]
    assert R.slice_rows(df, "k").count() == 5


def test_candidates_do_not_depend_on_size_or_key(spark):
    queries = spark.createDataFrame([(1, [0.0, 0.0]), (1, [9.0, 9.0]), (None, [0.0, 0.0]), (2, None)], "key bigint, v array<double>")
    cands = spark.createDataFrame([(i, [float(i), float(i)]) for i in range(10)] + [(77, None)], "id bigint, v array<double>")
    for most in (1 << 28, 200):
        out = nearest(queries, cands, 2, "key", "v", max_bytes=most).collect()
        got = sorted((str(r.key), str(r.v), [c.id for c in r.candidates] if r.candidates else None) for r in out)
        assert got == [("1", "[0.0, 0.0]", [0, 1]), ("1", "[9.0, 9.0]", [9, 8]), ("2", "None", None), ("None", "[0.0, 0.0]", [0, 1])]
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id bigint, v array<double>")
    with pytest.raises(ValueError, match="components"):
        nearest(queries, mixed, 2, "key", "v")


def test_latest_probe_is_one_probe(spark):
    log = [("u", "HEAD", 503, None, 1), ("u", "HEAD", 200, None, 2), ("w", "HEAD", None, "timeout", 1), ("w", "HEAD", 200, None, 2)]
    probes = spark.createDataFrame(log, "url string, method string, status int, error string, probe_order int")
    got = {r.url: (r.head_status, r.head_error) for r in probe_outcome(probes).collect()}
    assert got == {"u": (200, None), "w": (200, None)}


def test_wide_rows_stay_where_they_are(spark):
    pages = spark.createDataFrame([(1, "u", "x"), (2, "u", "y"), (3, None, "z"), (4, None, "z")], "page_id bigint, url string, html string")
    kept = R.first_per_url(pages)
    assert sorted(r.page_id for r in kept.collect()) == [1, 3]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and "html" in line for line in plan.splitlines())
