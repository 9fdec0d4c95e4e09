import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwright.functions.encoders import HashedCounts
from shelfwright.operators import decisions as D
from shelfwright.operators import taxonomy as T
from shelfwright.operators.knn import embed, knn, nearest, top_k
from shelfwright.plans.catalogue import classify_products, leaf_candidates
from shelfwright.schemas import CANDIDATE_TYPE, CLASSIFIED_FIRST, DECISION_SCHEMA, TAXONOMY_SCHEMA

TREE = [
    (1, None, "Tools, all", "1"),
    (2, None, "Paint", "2"),
    (10, 1, "Drills", "1.10"),
    (11, 2, "Rollers", "2.11"),
    (100, 10, "Hammer drill", "1.10.100"),
    (101, 10, "Other", "1.10.101"),
    (102, 11, "Other", "2.11.102"),
    (103, 11, "Strange", "2.77.x.103"),
    (104, 11, "Pathless", None),
]


@pytest.fixture(scope="module")
def tree(spark):
    return spark.createDataFrame(TREE, TAXONOMY_SCHEMA)


def test_leaves_and_labels(tree):
    assert {r["id"] for r in T.leaves(tree).collect()} == {100, 101, 102, 103, 104}
    flags = {r["id"]: r["is_leaf"] for r in T.with_is_leaf(tree).collect()}
    assert flags == {i: i >= 100 for i, *_ in TREE}
    for rows in (200_000, 0):
        labels = {r["id"]: r["rich_text"] for r in T.resolve_paths(tree, tree, rows).collect()}
        assert labels[100] == "Tools, all > Drills > Hammer drill"
        assert labels[103] == "Paint > Unknown(77) > Invalid(x) > Strange"
        assert labels[104] == ""
    assert {r["id"] for r in T.flatten_taxonomy(tree).collect()} == {100, 101, 102, 103}


def test_a_label_has_as_many_parts_as_its_path(tree):
    rows = T.resolve_paths(tree.where("path IS NOT NULL"), tree).collect()
    assert all(len(r["rich_text"].split(" > ")) == len(r["path"].split(".")) for r in rows)


def test_repeated_nodes_and_map_columns_keep_their_label(spark, tree):
    nodes = tree.unionByName(tree).withColumn("extra", F.create_map(F.lit("a"), "name"))
    for rows in (200_000, 0):
        got = T.resolve_paths(nodes, tree.unionByName(tree), rows)
        assert got.count() == nodes.count() and got.columns == [*nodes.columns, "rich_text"]
        assert {r.rich_text for r in got.where("id = 100").collect()} == {"Tools, all > Drills > Hammer drill"}


# ---- nearest neighbours -----------------------------------------------------------------


def brute(q, c, k):
    d = ((q[:, None, :] - c[None, :, :]) ** 2).sum(-1)
    return np.argsort(d, axis=1, kind="stable")[:, :k]


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10_000), st.integers(1, 40), st.integers(1, 12), st.booleans())
def test_top_k_equals_brute_force(seed, m, k, whole):
    rng = np.random.default_rng(seed)
    # whole numbers give many exact ties
    draw = (lambda n: rng.integers(-1, 2, (n, 4)).astype(float)) if whole else (lambda n: rng.normal(size=(n, 4)))
    q, c = draw(25), draw(m)
    pos, dist = top_k(q, c, k)
    assert (pos == brute(q, c, min(k, m))).all()
    assert (np.diff(dist, axis=1) >= 0).all()


def _vectors(spark, name, n, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6)]) for i in range(n)]
    return spark.createDataFrame(rows, f"{name} bigint, embedding array<float>"), np.array([r[1] for r in rows])


def test_broadcast_and_block_search_agree_with_brute_force(spark):
    q, qm = _vectors(spark, "query_id", 60, 1)
    c, cm = _vectors(spark, "id", 45, 2)
    expect = brute(qm, cm, 7)
    for limit in (1 << 28, 4000):
        rows = knn(q, c, 7, max_bytes=limit).collect()
        assert len(rows) == 60 * 7
        assert all(expect[r["query_id"], r["rank"] - 1] == r["id"] for r in rows)


@pytest.mark.parametrize("limit", [1 << 28, 300])
def test_few_candidates_no_candidates_and_no_vector(spark, limit):
    q, _ = _vectors(spark, "query_id", 3, 1)
    q = q.union(spark.createDataFrame([(99, None)], q.schema))
    c, _ = _vectors(spark, "id", 2, 2)
    got = {r["query_id"]: r["candidates"] for r in nearest(q, c, 10, max_bytes=limit).collect()}
    assert [x["rank"] for x in got[0]] == [1, 2]
    assert got[99] is None
    none = nearest(q, c.where("id < 0"), 10, max_bytes=limit).collect()
    assert all(r["candidates"] == [] for r in none)


def test_block_search_writes_no_pair_of_blocks(spark, monkeypatch):
    from shelfwright.operators import knn as K

    q, qm = _vectors(spark, "query_id", 300, 3)
    c, cm = _vectors(spark, "id", 200, 4)
    monkeypatch.setattr(K, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(K, "SIDE_BYTES", 6000)
    found = knn(q, c, 7, max_bytes=1000)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan.lower() and "Join Cross" in plan
    expect = brute(qm, cm, 7)
    rows = found.collect()
    assert len(rows) == 300 * 7
    assert all(expect[r["query_id"], r["rank"] - 1] == r["id"] for r in rows)


def test_equal_vectors_cost_no_more_than_k(spark):
    from shelfwright.operators.knn import _ordered

    rows = [(i, [float(i % 3), 1.0]) for i in range(300)] + [(900, None)]
    c = spark.createDataFrame(rows, "id bigint, embedding array<float>")
    assert sorted(r["id"] for r in _ordered(c, "embedding", "id", 4).collect()) == list(range(12))
    q = spark.createDataFrame([(1, [2.0, 1.0])], "query_id bigint, embedding array<float>")
    for limit in (1 << 28, 100):
        got = sorted((r["rank"], r["id"], r["distance"]) for r in knn(q, c, 5, max_bytes=limit).collect())
        assert got == [(n + 1, 2 + 3 * n, 0.0) for n in range(5)]


def test_far_tiles_are_passed_by(monkeypatch):
    from shelfwright.operators import knn as K

    rng = np.random.default_rng(5)
    c = np.repeat(rng.normal(size=(40, 4)) * 100, 50, axis=0) + rng.normal(size=(2000, 4))
    q = c[::10] + 0.1
    monkeypatch.setattr(K, "TILE", 50)
    met = []
    own = K.Best._meet_tile
    monkeypatch.setattr(K.Best, "_meet_tile", lambda self, rows, *a: (met.append(len(rows)), own(self, rows, *a))[1])
    pos, _ = top_k(q, c, 5)
    assert (pos == brute(q, c, 5)).all()
    assert sum(met) < len(q) * 5  # of 40 tiles and more


def test_sent_candidates_keep_their_width():
    import pickle

    from shelfwright.operators.knn import Tiles

    c = np.random.default_rng(6).normal(size=(5000, 64)).astype(np.float32)
    assert len(pickle.dumps(Tiles(c))) < 1.2 * c.nbytes
    odd = np.array([[0.0], [np.nan], [1.0], [np.nan]])
    pos, dist = top_k(np.array([[0.9], [np.nan]]), odd, 3)
    assert pos.tolist() == [[2, 0, 1], [0, 1, 2]] and np.isnan(dist[:, 2]).all()


def test_many_candidates_deal_the_queries_out(spark, monkeypatch):
    from shelfwright.operators import knn as K

    q, _ = _vectors(spark, "query_id", 60, 1)
    c, _ = _vectors(spark, "id", 45, 2)
    monkeypatch.setattr(K, "DEAL", 10)
    parts = nearest(q, c, 3).rdd.getNumPartitions()
    assert parts == 5 * spark.sparkContext.defaultParallelism


def test_encoder_is_stable_and_unit(spark):
    a, b = HashedCounts().encode(["Hot gear", "hot GEAR"])
    assert (a == b).all() and abs(np.linalg.norm(a) - 1) < 1e-6
    assert HashedCounts(unit=False).encode(["x x y"]).sum() == 3
    df = spark.createDataFrame([(1, "hot gear"), (2, None)], "id int, t string")
    rows = embed(df, "t").orderBy("id").collect()
    assert np.allclose(rows[0]["embedding"], a) and sum(rows[1]["embedding"]) == 0


# ---- decisions --------------------------------------------------------------------------

CANDS = [(1, 7, "Seven", "A > Seven", "1.7", 0.1), (2, 8, "Eight", "A > Eight", "1.8", 0.2)]
FOUND = f"query_id bigint, candidates array<{CANDIDATE_TYPE.simpleString()}>"


def reconciled(spark, response, error=None, cands=CANDS):
    found = spark.createDataFrame([(1, cands)], FOUND)
    answers = spark.createDataFrame([(1, response, error)], DECISION_SCHEMA)
    return D.reconcile(found, answers).first()


@pytest.mark.parametrize(
    "response,error,type_id,confidence,status",
    [
        ('{"selected_type_id": 8, "confidence_score": 0.3}', None, 8, 0.3, "chosen"),
        ('```json\n{"selected_type_id": 8}\n```', None, 8, 0.8, "chosen"),
        ('```\n{"selected_type_id": 8.0}\n```', None, 8, 0.8, "chosen"),
        ('{"selected_type_id": 8, "confidence_score": null}', None, 8, None, "chosen"),
        ('{"selected_type_id": "8"}', None, 7, None, "unknown_id"),
        ('{"selected_type_id": 9}', None, 7, None, "unknown_id"),
        ('{"selected_type_id": 8', None, 7, None, "bad_json"),
        ('{"selected_type_id": 8} thanks', None, 7, None, "bad_json"),
        ("[8]", None, 7, None, "bad_json"),
        (None, "Error 429", 7, None, "failed_quota"),
        (None, "timeout", 7, None, "failed_other"),
        (None, None, 7, None, "no_response"),
    ],
)
def test_reconcile(spark, response, error, type_id, confidence, status):
    r = reconciled(spark, response, error)
    assert (r["type_id"], r["confidence_score"], r["status"]) == (type_id, confidence, status)
    assert r["classification_path"] == f"1.{type_id}"
    assert r["classification_reasoning"] == ""


def test_repeated_answers_do_not_repeat_products(spark):
    found = spark.createDataFrame([(1, CANDS)], FOUND)
    rows = [(1, None, "timeout"), (1, '{"selected_type_id": 8}', None), (1, None, "Error 429"), (1, '{"selected_type_id": 8}', None)]
    (r,) = D.reconcile(found, spark.createDataFrame(rows, DECISION_SCHEMA)).collect()
    assert (r["type_id"], r["status"]) == (8, "chosen")


def test_reconcile_paths_and_missing_candidates(spark):
    bare = [(1, 7, "Seven", None, None, 0.1)]
    assert reconciled(spark, '{"selected_type_id": 7, "classification_path": "3.7"}', cands=bare)["classification_path"] == "3.7"
    assert reconciled(spark, '{"selected_type_id": 7, "classification_path": "A > B"}', cands=bare)["classification_path"] == "7"
    r = reconciled(spark, '{"selected_type_id": 7}', cands=[])
    assert (r["type_id"], r["classification_path"], r["status"]) == (None, "", "no_candidates")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.integers(0, 12).map(lambda i: f'{{"selected_type_id": {i}}}')), min_size=40, max_size=40))
def test_reconcile_always_gives_a_candidate(spark, responses):
    found = spark.createDataFrame([(i, CANDS) for i in range(len(responses))], FOUND)
    answers = spark.createDataFrame([(i, r, None) for i, r in enumerate(responses)], DECISION_SCHEMA)
    rows = D.reconcile(found, answers).collect()
    assert len(rows) == len(responses) and {r["type_id"] for r in rows} <= {7, 8}


def test_vector_only(spark):
    found = spark.createDataFrame([(1, CANDS), (2, [])], FOUND)
    a, b = D.decide_by_vector(found).orderBy("query_id").collect()
    assert (a["type_id"], a["classification_path"], a["confidence_score"]) == (7, "", 0.5)
    assert (b["type_id"], b["confidence_score"], b["status"]) == (None, None, "no_candidates")
    assert D.decide_by_vector(found, fill_path=True).orderBy("query_id").first()["classification_path"] == "1.7"


def test_attach_leaves_unclassified_records_alone(spark):
    items = spark.createDataFrame([(1, "old", 5), (2, "old", 6)], "query_id bigint, category string, type_id bigint")
    decided = D.decide_by_vector(spark.createDataFrame([(1, CANDS)], FOUND))
    a, b = D.attach_to_items(items, decided, "query_id").orderBy("query_id").collect()
    assert (a["category"], a["type_id"], b["category"], b["type_id"]) == ("Seven", 7, "old", 6)
    rows = D.attach_to_rows(items, decided, "query_id").orderBy("query_id").collect()
    assert [(r["category"], r["type_id"], r["classification_path"]) for r in rows] == [("old", 7, ""), ("old", None, "")]


def test_whole_job_selects_rows_and_orders_columns(spark, tree):
    products = spark.createDataFrame(
        [(i, "Flex", n, "Drills") for i, n in enumerate(["Hammer drill", "Roller other", "Drill", "x"])],
        "row_idx bigint, brand string, product_name string, category string",
    )
    cands = leaf_candidates(tree)
    out = classify_products(products, cands, "row_idx", start=0, limit=2)
    assert out.columns[: len(CLASSIFIED_FIRST)] == CLASSIFIED_FIRST
    rows = out.orderBy("row_idx").collect()
    assert [r["row_idx"] for r in rows] == [0, 1]
    assert rows[0]["type_id"] == 100 and rows[0]["category"] == "Drills"
    answers = spark.createDataFrame([(0, '{"selected_type_id": 101, "confidence_score": 0.9}', None)], "row_idx bigint, response_text string, error string")
    again = classify_products(products, cands, "row_idx", decisions=answers).orderBy("row_idx").collect()
    assert (again[0]["type_id"], again[0]["confidence_score"], again[1]["confidence_score"]) == (101, 0.9, None)
    assert again[0]["classification_path"] == "1.10.101"


def test_file_jobs(spark, tmp_path):
    from shelfwright.plans import jobs as J
    from shelfwright.sources.tables import read_products
    from shelfwright.schemas import PROBE_SCHEMA

    tree_file = tmp_path / "tree.csv"
    rows = [",".join("NULL" if v is None else f'"{v}"' for v in r) for r in TREE[:7]]
    tree_file.write_text("\n".join(["id,parent_id,name,path", *rows]) + "\n")
    cands = J.load_candidates(spark, str(tree_file), str(tmp_path / "cache"))
    assert cands.count() == 3 and (tmp_path / "cache" / "_SUCCESS").exists()

    src = tmp_path / "items.csv"
    names = ["Hammer drill", "Rollers", "Drill hammer", ""]
    src.write_text("product_name,category,product_image_url\n" + "".join(f"{n},Old,http://i/{i}\n" for i, n in enumerate(names)))
    out = J.reclassify_file(spark, str(src), cands, start=1, end=3, fill_path=True)
    assert out == str(tmp_path / "items_classified.csv")
    got = read_products(spark, out)
    assert got.columns[:7] == CLASSIFIED_FIRST and got.columns[7:] == ["category", "product_image_url"]
    assert [(r["product_name"], r["type_id"], r["category"]) for r in got.collect()] == [("Rollers", 102, "Old"), ("Drill hammer", 100, "Old")]

    prompts = J.review_prompts(read_products(spark, str(src), row_idx=True), cands, k=2).orderBy("row_idx").collect()
    assert len(prompts) == 4 and "Product Name: Hammer drill" in prompts[0]["prompt"]
    assert prompts[0]["candidates_json"].count('"rank"') == 2

    log = spark.createDataFrame([("http://i/0", "HEAD", 200, None), ("http://i/1", "HEAD", 500, None)], PROBE_SCHEMA)
    assert tuple(J.audit_file(spark, str(src), log, str(tmp_path / "a.csv")).first()) == (1, 3, 25.0)
    audited = read_products(spark, str(tmp_path / "a.csv")).collect()
    assert [r["image_status"] for r in audited] == ["OK", "Status 500", "Not probed", "Not probed"]
    with pytest.raises(ValueError):
        J.audit_file(spark, str(tree_file), log)


def test_an_answer_that_names_an_id_goes_before_a_greater_text(spark):
    from shelfwright.operators.decisions import one_answer

    rows = [(1, '{bad', None), (1, '{"selected_type_id": 2}', None), (2, '{"x": 1}', None), (2, "~ no answer", None)]
    rows += [(3, '{"selected_type_id": 9}', "429 quota"), (3, '{"selected_type_id": 4}', None), (4, None, "down"), (4, "some text", None)]
    rows += [(5, '{"selected_type_id": 1}', None), (5, '{"selected_type_id": 3}', None), (6, None, "b"), (6, None, "a")]
    answers = spark.createDataFrame(rows, "query_id long, response_text string, error string")
    assert sorted(map(tuple, one_answer(answers).collect())) == [
        (1, '{"selected_type_id": 2}', None),
        (2, '{"x": 1}', None),
        (3, '{"selected_type_id": 4}', None),
        (4, "some text", None),
        (5, '{"selected_type_id": 3}', None),
        (6, None, "b"),
    ]
