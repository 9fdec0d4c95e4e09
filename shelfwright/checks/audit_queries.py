"""URL audit: products from parts, the probe log from events."""

from shelfwright.checks.registry import query, table
from shelfwright.operators import audit as A

# One image address is shared by a third of the products, some are missing or blank.
_IMAGE = (
    "CASE WHEN p_partkey % 3 = 0 THEN 'http://img.example.com/0.png' WHEN p_partkey % 11 = 0 THEN NULL "
    "WHEN p_partkey % 11 = 1 THEN '' ELSE concat('http://img.example.com/', p_partkey % 170, '.png') END"
)
_PROBE = [
    "concat('http://img.example.com/', user_id, '.png') AS url",
    "CASE WHEN event_type = 'signup' THEN 'GET' ELSE 'HEAD' END AS method",
    "CASE WHEN event_type = 'signup' THEN CASE WHEN user_id % 2 = 0 THEN 200 ELSE 403 END "
    "ELSE CASE user_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 405 WHEN 3 THEN 405 END END AS status",
    "CASE WHEN event_type <> 'signup' AND user_id % 5 = 4 THEN concat('timeout of ', user_id) END AS error",
]
_N = "CAST(split_part(split_part(image, 'com/', 2), '.', 1) AS INT)"
_SEEN = "(SELECT max(user_id) FROM events)"
_STATUS = (
    f"CASE WHEN image IS NULL OR image = '' THEN 'Missing URL' WHEN {_N} > {_SEEN} THEN 'Not probed' "
    f"WHEN {_N} % 5 = 0 THEN 'OK' WHEN {_N} % 5 = 1 THEN 'Status 404' WHEN {_N} % 5 = 4 THEN concat('timeout of ', {_N}) "
    f"WHEN {_N} % 2 = 0 THEN 'OK' ELSE 'Status 403' END"
)
_AUDIT = (
    "SELECT row_idx, product_name, product_image_url, image_status = 'OK' AS image_valid, image_status FROM ("
    f"SELECT p_partkey AS row_idx, p_name AS product_name, image AS product_image_url, {_STATUS} AS image_status "
    f"FROM (SELECT *, {_IMAGE} AS image FROM part))"
)


def _audited(spark, d, max_rows=200_000):
    products = table(spark, d, "part").selectExpr(
        "p_partkey AS row_idx", "p_name AS product_name", f"{_IMAGE} AS product_image_url"
    )
    probes = table(spark, d, "events").selectExpr(*_PROBE)
    return A.with_verdict(products, probes, "row_idx", max_rows=max_rows)


@query("url_audit", _AUDIT)
def url_audit(spark, d):
    return _audited(spark, d)


@query("url_audit_salted", _AUDIT)
def url_audit_salted(spark, d):
    """The way a probe log too large to broadcast goes."""
    return _audited(spark, d, max_rows=0)


@query(
    "url_audit_summary",
    "SELECT count(*) FILTER (WHERE image_valid) AS valid, count(*) FILTER (WHERE NOT image_valid) AS invalid, "
    f"round(100.0 * count(*) FILTER (WHERE image_valid) / count(*), 1) AS success_rate FROM ({_AUDIT})",
)
def url_audit_summary(spark, d):
    return A.audit_summary(_audited(spark, d))


@query(
    "url_audit_sample",
    f"SELECT product_name, product_image_url, image_status FROM ({_AUDIT}) WHERE NOT image_valid ORDER BY row_idx LIMIT 5",
)
def url_audit_sample(spark, d):
    return A.invalid_sample(_audited(spark, d), "row_idx")
