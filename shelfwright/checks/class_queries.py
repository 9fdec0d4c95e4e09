"""Taxonomy, nearest categories, decisions.

The tree is region > nation > supplier with ids offset per level. A supplier leaf's vector
is the one of the same number in the embeddings table.
"""

from pyspark.sql import functions as F

from shelfwright.checks import sqltext as S
from shelfwright.checks.registry import query, table
from shelfwright.functions.encoders import HashedCounts
from shelfwright.operators import decisions as D
from shelfwright.operators import taxonomy as T
from shelfwright.operators.knn import knn, nearest
from shelfwright.plans.catalogue import classify_products, leaf_candidates

# ---- the tree ---------------------------------------------------------------------------

_REGION, _NATION, _LEAF = "r_regionkey + 1", "n_nationkey + 100", "s_suppkey + 1000"


def _level(id_, parent, name, path, tables):
    return (
        f"SELECT CAST({id_} AS BIGINT) AS id, CAST({parent} AS BIGINT) AS parent_id, {name} AS name, "
        f"{path} AS path FROM {tables}"
    )


def _tree_sql(region="region", nation="nation", supplier="supplier"):
    up = f"{supplier} JOIN {nation} ON s_nationkey = n_nationkey"
    return " UNION ALL ".join(
        [
            _level(_REGION, "NULL", "r_name", f"concat({_REGION})", region),
            _level(_NATION, "n_regionkey + 1", "n_name", f"concat(n_regionkey + 1, '.', {_NATION})", nation),
            _level(_LEAF, "s_nationkey + 100", "s_name", f"concat(n_regionkey + 1, '.', {_NATION}, '.', {_LEAF})", up),
        ]
    )


_TREE = f"({_tree_sql()})"
LABELS = (
    "(SELECT id, name, path, CASE WHEN n.n_name IS NULL THEN r.r_name WHEN t.id < 1000 THEN r.r_name || ' > ' || n.n_name "
    "ELSE r.r_name || ' > ' || n.n_name || ' > ' || t.name END AS rich_text, t.parent_id FROM "
    f"{_TREE} t JOIN region r ON CAST(split_part(path, '.', 1) AS INT) = r_regionkey + 1 "
    "LEFT JOIN nation n ON TRY_CAST(split_part(path, '.', 2) AS INT) = n_nationkey + 100)"
)
_IS_LEAF = "id NOT IN (SELECT s_nationkey + 100 FROM supplier UNION ALL SELECT n_regionkey + 1 FROM nation)"


def tree(spark, d):
    def src(name):
        return f"parquet.`{d}/{name}.parquet`"

    return spark.sql(_tree_sql(src("region"), src("nation"), src("supplier")))


@query("tax_is_leaf", f"SELECT id, {_IS_LEAF} AS is_leaf FROM {_TREE}")
def tax_is_leaf(spark, d):
    return T.with_is_leaf(tree(spark, d)).select("id", "is_leaf")


@query("tax_leaves", f"SELECT id, parent_id, name, path FROM {_TREE} WHERE {_IS_LEAF}")
def tax_leaves(spark, d):
    return T.leaves(tree(spark, d)).select("id", "parent_id", "name", "path")


@query("tax_path_names", f"SELECT id, rich_text FROM {LABELS}")
def tax_path_names(spark, d):
    nodes = tree(spark, d)
    return T.resolve_paths(nodes, nodes).select("id", "rich_text")


@query("tax_path_names_salted", f"SELECT id, rich_text FROM {LABELS}")
def tax_path_names_salted(spark, d):
    """The way a name table too large to broadcast goes."""
    nodes = tree(spark, d)
    return T.resolve_paths(nodes, nodes, max_rows=0).select("id", "rich_text")


@query("tax_flatten", f"SELECT id, parent_id, name, path, rich_text, true AS is_leaf FROM {LABELS} WHERE {_IS_LEAF}")
def tax_flatten(spark, d):
    return T.flatten_taxonomy(tree(spark, d)).select("id", "parent_id", "name", "path", "rich_text", "is_leaf")


# ---- nearest neighbours -----------------------------------------------------------------


def ranked(queries, cands, k=10):
    """Exact k nearest in SQL; distances in double precision."""
    return (
        "(SELECT query_id, id, name, path, numeric_path, distance, rank FROM ("
        "SELECT q.query_id, c.id, c.name, c.path, c.numeric_path, list_sum(list_transform(list_zip(q.v, c.v), "
        "lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance, "
        "row_number() OVER (PARTITION BY q.query_id ORDER BY list_sum(list_transform(list_zip(q.v, c.v), "
        "lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.id) AS rank "
        f"FROM {queries} q, {cands} c) WHERE rank <= {k})"
    )


_Q = "(SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
_SELF = "(SELECT vec_id AS id, NULL AS name, NULL AS path, NULL AS numeric_path, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
_CANDS = (
    "(SELECT id, name, rich_text AS path, path AS numeric_path, CAST(embedding AS DOUBLE[]) AS v "
    f"FROM {LABELS} JOIN embeddings ON vec_id + 1000 = id WHERE id >= 1000)"
)
_NEAR = ranked(_Q, _CANDS)
_SELF_NEAR = f"SELECT query_id, id, CAST(rank AS INT) AS rank, round(distance, 4) AS distance FROM {ranked(_Q, _SELF)}"


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")


def _cands(spark, d):
    flat = T.as_candidates(T.flatten_taxonomy(tree(spark, d)))
    vecs = table(spark, d, "embeddings").select((F.col("vec_id") + 1000).alias("id"), "embedding")
    return flat.join(vecs, "id")


def _found(spark, d):
    return nearest(_vectors(spark, d), _cands(spark, d))


@query("knn_topk", _SELF_NEAR)
def knn_topk(spark, d):
    q = _vectors(spark, d)
    out = knn(q, q.withColumnRenamed("query_id", "id"))
    return out.select("query_id", "id", "rank", F.round("distance", 4).alias("distance"))


@query("knn_topk_blocks", _SELF_NEAR)
def knn_topk_blocks(spark, d):
    """The way a candidate set too large to broadcast goes."""
    q = _vectors(spark, d)
    out = knn(q, q.withColumnRenamed("query_id", "id"), max_bytes=1 << 18)
    return out.select("query_id", "id", "rank", F.round("distance", 4).alias("distance"))


@query(
    "knn_candidates",
    f"SELECT query_id, CAST(rank AS INT) AS rank, id, name, path, numeric_path, round(distance, 4) AS distance FROM {_NEAR}",
)
def knn_candidates(spark, d):
    out = knn(_vectors(spark, d), _cands(spark, d))
    return out.withColumn("distance", F.round("distance", 4))


_DECIDED = (
    "SELECT query_id, id AS type_id, '' AS classification_path, name AS classification_name, "
    f"'' AS classification_reasoning, 0.5 AS confidence_score FROM {_NEAR} WHERE rank = 1"
)


def _decided(spark, d):
    return D.decide_by_vector(_found(spark, d)).drop("embedding")


@query("classify_vector", _DECIDED)
def classify_vector(spark, d):
    return _decided(spark, d).drop("chosen_rank", "status")


@query(
    "classify_per_class",
    f"SELECT type_id, classification_name, count(*) AS products FROM ({_DECIDED}) GROUP BY ALL",
)
def classify_per_class(spark, d):
    return (
        _decided(spark, d).groupBy("type_id", "classification_name").agg(F.count("*").alias("products"))
    )


# ---- texts and prompts ------------------------------------------------------------------

def _doc_products(spark, d):
    return table(spark, d, "documents").selectExpr(
        "doc_id AS query_id",
        "concat(' <b>', source, '</b> ') AS product_name",
        "lang AS category",
        "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE concat('sub ', lang) END AS subcategory",
        "text AS short_description",
        "concat(text, ' <p>', text) AS long_description",
        "concat('{\"n\": \"', n_chars, '\"}') AS technical_specs",
    )


_SUB = "CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat('sub ', lang) END"
_C = {c: S.clean_tags_space(c) for c in ("source", "text")}


@query(
    "query_text",
    f"SELECT doc_id AS query_id, concat({_C['source']}, ' ', lang, ' ', {_SUB}, ' ', {_C['text']}) AS query_text FROM documents",
)
def query_text(spark, d):
    return D.query_text(_doc_products(spark, d)).select("query_id", "query_text")


_LONG = S.clean_tags_space("concat(text, ' <p>', text)")


@query(
    "describe_product",
    f"SELECT doc_id AS query_id, concat('Product Name: ', {_C['source']}, chr(10), 'Category/Subcategory: ', lang, ' / ', "
    f"{_SUB}, chr(10), 'Short Description: ', {_C['text']}, chr(10), 'Long Description: ', substr({_LONG}, 1, 500), "
    f"CASE WHEN length({_LONG}) > 500 THEN '...' ELSE '' END, chr(10), 'Technical Specs: ', "
    "concat('{\"n\": \"', n_chars, '\"}')) AS description FROM documents",
)
def describe_product(spark, d):
    return D.describe_product(_doc_products(spark, d)).select("query_id", "description")


@query(
    "prompt_candidates",
    "SELECT query_id, CAST(rank AS INT) AS rank, id, name, path, numeric_path, round(distance, 4) AS distance, "
    f"true AS has_description, true AS has_candidates FROM {_NEAR}",
)
def prompt_candidates(spark, d):
    """Prompts, read back: the candidates written into each of them."""
    described = _found(spark, d).withColumn("description", F.concat(F.lit("Product Name: item "), "query_id"))
    prompts = D.build_prompts(described)
    kind = "array<struct<rank:int,id:bigint,name:string,path:string,numeric_path:string,distance:double>>"
    return prompts.select(
        "query_id",
        F.inline(F.from_json("candidates_json", kind)),
        F.col("prompt").contains(F.concat(F.lit("Product Name: item "), "query_id")).alias("has_description"),
        F.col("prompt").contains(F.col("candidates_json")).alias("has_candidates"),
    ).withColumn("distance", F.round("distance", 4))


# ---- answers ----------------------------------------------------------------------------

_ANSWER = (
    "CASE event_id % 12 WHEN 0 THEN concat('{\"selected_type_id\": ', event_id, ', \"reasoning\": \"', event_type, "
    "'\", \"confidence_score\": 0.25, \"classification_path\": \"1.2.', user_id, '\"}') "
    "WHEN 1 THEN concat('```json', chr(10), '{\"selected_type_id\": ', event_id, '}', chr(10), '```') "
    "WHEN 2 THEN concat('  ```{\"selected_type_id\": ', event_id, ', \"confidence_score\": null}``` trailing ') "
    "WHEN 3 THEN concat('{\"selected_type_id\": \"', event_id, '\", \"confidence_score\": 1}') "
    "WHEN 4 THEN concat('{\"selected_type_id\": ', event_id, '.0, \"reasoning\": null}') "
    "WHEN 5 THEN concat('{\"selected_type_id\": ', event_id, '.5}') "
    "WHEN 6 THEN concat('I pick ', event_id) WHEN 7 THEN concat('[', event_id, ']') "
    "WHEN 8 THEN concat('{\"selected_type_id\": ', event_id) WHEN 9 THEN '{}' WHEN 10 THEN '' END"
)
_KIND = "event_id % 12"


@query(
    "unfence",
    "SELECT event_id, CASE event_id % 12 WHEN 1 THEN concat('{\"selected_type_id\": ', event_id, '}') "
    "WHEN 2 THEN concat('{\"selected_type_id\": ', event_id, ', \"confidence_score\": null}') "
    f"ELSE {_ANSWER} END AS body FROM events",
)
def unfence(spark, d):
    return table(spark, d, "events").select("event_id", D.unfence(F.expr(_ANSWER)).alias("body"))


@query(
    "parse_decision",
    f"SELECT event_id, CASE WHEN {_KIND} <> 11 THEN {_KIND} IN (0, 1, 2, 3, 4, 5, 9) END AS parsed, "
    f"CASE WHEN {_KIND} IN (0, 1, 2, 4) THEN event_id END AS selected_id, "
    f"CASE WHEN {_KIND} = 0 THEN concat('1.2.', user_id) END AS given_path, "
    f"CASE {_KIND} WHEN 0 THEN event_type WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN '' WHEN 5 THEN '' WHEN 9 THEN '' END AS reasoning, "
    f"CASE {_KIND} WHEN 0 THEN 0.25 WHEN 1 THEN 0.8 WHEN 3 THEN 1.0 WHEN 4 THEN 0.8 WHEN 5 THEN 0.8 WHEN 9 THEN 0.8 END AS confidence "
    "FROM events",
)
def parse_decision(spark, d):
    e = table(spark, d, "events").select("event_id", F.expr(_ANSWER).alias("response_text"))
    return D.parse_decision(e).drop("response_text")


def _message(event_type):
    return (
        f"CASE {event_type} WHEN 'click' THEN concat('HTTP 429 for ', user_id) WHEN 'view' THEN 'Quota exceeded' "
        "WHEN 'error' THEN 'failed to generate' WHEN 'purchase' THEN concat('timeout ', user_id) END"
    )


@query(
    "failure_kind",
    "SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'error') THEN 'quota' "
    "WHEN event_type = 'purchase' THEN CASE WHEN contains(concat(user_id), '429') THEN 'quota' ELSE 'other' END END AS kind FROM events",
)
def failure_kind(spark, d):
    return table(spark, d, "events").select("event_id", D.failure_kind(F.expr(_message("event_type"))).alias("kind"))


# Answers of a reviewer who picks candidate (query_id % 5) + 1, with faults by query_id % 8.
_FAULT = "query_id % 8"


def _responses(found):
    picked = found.withColumn("pick", F.get("candidates", (F.col("query_id") % 5).cast("int"))["id"])
    text = (
        "CASE query_id % 8 WHEN 1 THEN concat('```json {\"selected_type_id\": ', pick, ', \"confidence_score\": 0.9}```') "
        "WHEN 2 THEN concat('{\"selected_type_id\": ', pick + 1000000, '}') WHEN 3 THEN concat('{\"selected_type_id\": ', pick) "
        "WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE concat('{\"selected_type_id\": ', pick, ', \"reasoning\": \"fits ', query_id, "
        "'\", \"classification_path\": \"somewhere\"}') END AS response_text"
    )
    return picked.selectExpr("query_id", text, "CASE query_id % 8 WHEN 4 THEN 'Rate limit' END AS error")


_CHOSEN = f"{_FAULT} IN (0, 1, 6, 7)"
_RECONCILED = (
    f"SELECT query_id, id AS type_id, CAST(rank AS INT) AS chosen_rank, numeric_path AS classification_path, "
    f"name AS classification_name, CASE WHEN {_FAULT} IN (0, 6, 7) THEN concat('fits ', query_id) ELSE '' END "
    f"AS classification_reasoning, CASE WHEN {_FAULT} = 1 THEN 0.9 WHEN {_CHOSEN} THEN 0.8 END AS confidence_score, "
    f"CASE WHEN {_CHOSEN} THEN 'chosen' WHEN {_FAULT} = 2 THEN 'unknown_id' WHEN {_FAULT} = 3 THEN 'bad_json' "
    f"WHEN {_FAULT} = 4 THEN 'failed_quota' ELSE 'no_response' END AS status FROM {_NEAR} "
    f"WHERE rank = CASE WHEN {_CHOSEN} THEN query_id % 5 + 1 ELSE 1 END"
)


def _reconciled(spark, d):
    found = _found(spark, d).drop("embedding")
    return D.reconcile(found, _responses(found))


@query("reconcile", _RECONCILED)
def reconcile(spark, d):
    return _reconciled(spark, d)


@query(
    "reconcile_fallback",
    f"SELECT status, count(*) AS products, count(DISTINCT type_id) AS classes, count(confidence_score) AS rated "
    f"FROM ({_RECONCILED}) WHERE status <> 'chosen' GROUP BY status",
)
def reconcile_fallback(spark, d):
    r = _reconciled(spark, d).where("status <> 'chosen'")
    return r.groupBy("status").agg(
        F.count("*").alias("products"),
        F.count_distinct("type_id").alias("classes"),
        F.count("confidence_score").alias("rated"),
    )


# ---- attaching and whole jobs -----------------------------------------------------------


def _part_rows(spark, d):
    return table(spark, d, "part").selectExpr(
        "p_partkey AS query_id", "p_name AS product_name", "p_type AS category", "CAST(NULL AS BIGINT) AS type_id"
    )


@query(
    "attach_items",
    "SELECT p_partkey AS query_id, p_name AS product_name, coalesce(classification_name, p_type) AS category, type_id, "
    f"classification_path FROM part LEFT JOIN ({_DECIDED}) ON query_id = p_partkey",
)
def attach_items(spark, d):
    out = D.attach_to_items(_part_rows(spark, d), _decided(spark, d), "query_id")
    return out.select("query_id", "product_name", "category", "type_id", "classification_path")


@query(
    "attach_rows",
    "SELECT p_partkey AS query_id, p_name AS product_name, p_type AS category, type_id, coalesce(classification_path, '') "
    "AS classification_path, classification_name, classification_reasoning, confidence_score "
    f"FROM part LEFT JOIN ({_RECONCILED}) ON query_id = p_partkey",
)
def attach_rows(spark, d):
    return D.attach_to_rows(_part_rows(spark, d), _reconciled(spark, d), "query_id")


def counts(texts):
    """Word counts in 32 hash buckets as a dense vector, in SQL."""
    word = "regexp_extract_all(lower(t), '[\\p{L}\\p{N}_]+')"
    bucket = "CAST(concat('0x', substr(md5(w), 1, 8)) AS UBIGINT) % 32"
    return (
        f"(SELECT *, list_transform(range(32), lambda b: CAST(len(list_filter(list_transform({word}, "
        f"lambda w: {bucket}), lambda x: x = b)) AS DOUBLE)) AS v FROM {texts})"
    )


_PART_TEXT = "concat(p_name, ' NATION_', p_partkey % 25, ' ', p_type, ' ', p_brand)"
_PART_Q = counts(f"(SELECT p_partkey AS query_id, {_PART_TEXT} AS t FROM part)")
PART_C = counts(
    f"(SELECT id, name, rich_text AS path, path AS numeric_path, rich_text AS t FROM {LABELS} WHERE {_IS_LEAF})"
)
_E2E = (
    "SELECT p_partkey AS query_id, p_name AS product_name, concat('NATION_', p_partkey % 25) AS category, "
    "p_type AS subcategory, p_brand AS short_description, NULL AS brand, id AS type_id, numeric_path AS classification_path, "
    "name AS classification_name, '' AS classification_reasoning, 0.5 AS confidence_score "
    f"FROM part JOIN {ranked(_PART_Q, PART_C, 1)} ON query_id = p_partkey"
)


def whole_counts():
    return HashedCounts(dim=32, unit=False)


def _e2e(spark, d):
    products = table(spark, d, "part").selectExpr(
        "p_partkey AS query_id",
        "p_name AS product_name",
        "concat('NATION_', p_partkey % 25) AS category",
        "p_type AS subcategory",
        "p_brand AS short_description",
    )
    cands = leaf_candidates(tree(spark, d), whole_counts)
    return classify_products(products, cands, "query_id", whole_counts, fill_path=True)


@query("classify_end_to_end", _E2E)
def classify_end_to_end(spark, d):
    return _e2e(spark, d)


@query(
    "classify_counts",
    f"SELECT count(*) AS products, count(type_id) AS classified, count(DISTINCT type_id) AS classes FROM ({_E2E})",
)
def classify_counts(spark, d):
    return _e2e(spark, d).agg(
        F.count("*").alias("products"),
        F.count("type_id").alias("classified"),
        F.count_distinct("type_id").alias("classes"),
    )


@query(
    "embed_text",
    "SELECT doc_id, bucket, CAST(count(*) AS DOUBLE) AS weight FROM (SELECT doc_id, CAST(concat('0x', substr(md5(w), 1, 8)) "
    "AS UBIGINT) % 64 AS bucket FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS w "
    "FROM documents)) GROUP BY ALL",
)
def embed_text(spark, d):
    from shelfwright.operators.knn import embed

    docs = embed(table(spark, d, "documents").select("doc_id", "text"), "text", lambda: HashedCounts(64, unit=False))
    cells = docs.select("doc_id", F.posexplode("embedding").alias("bucket", "weight"))
    return cells.where("weight > 0").withColumn("weight", F.col("weight").cast("double"))
