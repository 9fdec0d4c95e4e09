"""Query texts, review prompts, and reconciling the reviewer's answers with the candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.functions.text import blank, clean_tags_space, ellipsize, strip

# Confidence without a reviewer, and where the reviewer names none.
VECTOR_ONLY_CONFIDENCE = 0.5
DEFAULT_CONFIDENCE = 0.8


def _text(df: DataFrame, name: str) -> Column:
    return clean_tags_space(F.col(name)) if name in df.columns else F.lit("")


def query_text(df: DataFrame, out: str = "query_text") -> DataFrame:
    """Name, category, subcategory and short description; blank parts keep their space."""
    parts = [_text(df, c) for c in ("product_name", "category", "subcategory", "short_description")]
    return df.withColumn(out, F.concat_ws(" ", *parts))


def describe_product(df: DataFrame, out: str = "description", n: int = 500) -> DataFrame:
    """The block of text a reviewer sees for a product; long parts are cut at ``n``."""
    t = {
        c: _text(df, c)
        for c in (
            "product_name",
            "category",
            "subcategory",
            "short_description",
            "long_description",
            "technical_specs",
        )
    }
    return df.withColumn(
        out,
        F.concat(
            F.lit("Product Name: "),
            t["product_name"],
            F.lit("\nCategory/Subcategory: "),
            t["category"],
            F.lit(" / "),
            t["subcategory"],
            F.lit("\nShort Description: "),
            t["short_description"],
            F.lit("\nLong Description: "),
            ellipsize(t["long_description"], n),
            F.lit("\nTechnical Specs: "),
            ellipsize(t["technical_specs"], n),
        ),
    )


def build_prompts(described: DataFrame, key: str = "query_id") -> DataFrame:
    """One prompt per product from ``description`` and the ranked ``candidates`` list.

    The candidates travel as a bounded list in the product's row, so nothing is shuffled.
    """
    as_json = F.to_json("candidates")
    prompt = F.concat(
        F.lit("Choose the one leaf category that fits this product best.\n\nPRODUCT:\n"),
        F.col("description"),
        F.lit("\n\nCANDIDATES (JSON, nearest first):\n"),
        as_json,
        F.lit(
            "\n\nAnswer with one JSON object and nothing else. Keys: selected_type_id (number, "
            "an id from the candidates), classification_path (its numeric_path), reasoning "
            "(one sentence), confidence_score (0.0 to 1.0)."
        ),
    )
    return described.select(key, as_json.alias("candidates_json"), prompt.alias("prompt"))


def unfence(c: Column) -> Column:
    """The answer without surrounding blanks, code fence and language tag."""
    text = strip(c)
    inner = F.split_part(text, F.lit("```"), F.lit(2))
    inner = strip(F.when(inner.startswith("json"), F.substring(inner, 5, 1 << 30)).otherwise(inner))
    return F.when(text.startswith("```"), inner).otherwise(text)


def parse_decision(df: DataFrame, text: str = "response_text") -> DataFrame:
    """Add selected_id, given_path, reasoning, confidence and ``parsed``.

    An id written as text is no id; a whole number written 7.0 is 7. A missing confidence
    becomes 0.8, an explicit null stays null. Anything but a JSON object is not parsed; without
    any text ``parsed`` is NULL.
    """
    body = unfence(F.col(text))
    df = df.withColumn("_body", F.when(body.rlike(r"(?s)^\{.*\}$"), body)).withColumn("_v", F.try_parse_json("_body"))

    def sub(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "variant")

    def as_text(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "string")

    number = F.try_variant_get("_v", "$.selected_type_id", "double")
    numeric = F.schema_of_variant(sub("selected_type_id")).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    whole = F.when(numeric & (number == F.floor(number)), number.cast("bigint"))
    confidence = F.when(sub("confidence_score").isNull(), F.lit(DEFAULT_CONFIDENCE)).otherwise(
        F.try_variant_get("_v", "$.confidence_score", "double")
    )
    parsed = F.when(F.col(text).isNotNull(), F.col("_v").isNotNull())
    missing = sub("reasoning").isNull()
    return df.select(
        *[c for c in df.columns if c not in ("_v", "_body")],
        parsed.alias("parsed"),
        F.when(parsed, whole).alias("selected_id"),
        F.when(parsed, as_text("classification_path")).alias("given_path"),
        F.when(parsed, F.when(missing, F.lit("")).otherwise(as_text("reasoning"))).alias("reasoning"),
        F.when(parsed, confidence).alias("confidence"),
    )


def failure_kind(message: Column) -> Column:
    """'quota' if the message tells of a rate or quota limit, else 'other'; NULL without one."""
    low = F.lower(message)
    quota = message.contains("429") | low.contains("quota") | low.contains("rate")
    return F.when(message.isNull(), None).when(quota, "quota").otherwise("other")


def one_answer(decisions: DataFrame, key: str = "query_id") -> DataFrame:
    """One answer per product where a call was repeated: one without error that names an id goes
    before one that only parses, that before any other text, and a text before none. Among equals
    it is the greatest text, so the pick does not depend on the order of arrival. Repeats
    collapse map-side, and the join that follows needs the same partitioning."""
    answers = parse_decision(decisions.select(key, "response_text", "error"))
    fine = F.col("error").isNull() & F.coalesce("parsed", F.lit(False))
    text = F.col("response_text").isNotNull()
    order = F.struct(fine & F.col("selected_id").isNotNull(), fine, text, "response_text", "error")
    best = F.max_by(F.struct("response_text", "error"), order).alias("_best")
    return answers.groupBy(key).agg(best).select(key, "_best.response_text", "_best.error")


def reconcile(found: DataFrame, decisions: DataFrame, key: str = "query_id") -> DataFrame:
    """The class of every product: the reviewer's pick if it is a candidate, else rank 1.

    ``found`` has one row per product with its ``candidates``. Both sides are unique on
    ``key``, so the join has no hot key.
    """
    answers = parse_decision(one_answer(decisions, key)).select(
        key, "parsed", "selected_id", "given_path", "reasoning", "confidence", "error"
    )
    df = found.join(answers, key, "left")
    picked = F.get(F.filter("candidates", lambda c: c["id"] == F.col("selected_id")), 0)
    df = df.withColumn("_pick", F.when(F.col("error").isNull(), picked))
    df = df.withColumn("_used", F.coalesce("_pick", F.get("candidates", 0)))
    ok, none = F.col("_pick").isNotNull(), F.col("_used").isNull()
    given = F.when(F.col("given_path").rlike("^[0-9.]+$"), F.col("given_path"))
    own = F.coalesce("_used.numeric_path", F.when(ok, given), F.col("_used.id").cast("string"))
    status = (
        F.when(none, "no_candidates")
        .when(ok, "chosen")
        .when(F.col("error").isNotNull(), F.concat(F.lit("failed_"), failure_kind(F.col("error"))))
        .when(F.col("parsed").isNull(), "no_response")
        .when(~F.col("parsed"), "bad_json")
        .otherwise("unknown_id")
    )
    gone = ("parsed", "selected_id", "given_path", "reasoning", "confidence", "error", "_pick", "_used", "candidates")
    return df.select(
        *[c for c in df.columns if c not in gone],
        F.col("_used.id").alias("type_id"),
        F.col("_used.rank").alias("chosen_rank"),
        blank(own).alias("classification_path"),
        F.col("_used.name").alias("classification_name"),
        F.when(none, None).when(ok, F.col("reasoning")).otherwise("").alias("classification_reasoning"),
        F.when(ok, F.col("confidence")).alias("confidence_score"),
        status.alias("status"),
    )


def decide_by_vector(found: DataFrame, fill_path: bool = False) -> DataFrame:
    """Rank 1 with confidence 0.5. The path stays '' unless ``fill_path`` asks for it."""
    top = F.get("candidates", 0)
    got = top.isNotNull()
    path = blank(top["numeric_path"]) if fill_path else F.lit("")
    return found.select(
        *[c for c in found.columns if c != "candidates"],
        top["id"].alias("type_id"),
        top["rank"].alias("chosen_rank"),
        path.alias("classification_path"),
        top["name"].alias("classification_name"),
        F.when(got, "").alias("classification_reasoning"),
        F.when(got, F.lit(VECTOR_ONLY_CONFIDENCE)).alias("confidence_score"),
        F.when(got, "vector_only").otherwise("no_candidates").alias("status"),
    )


_DECIDED = ("type_id", "classification_path", "classification_name", "classification_reasoning", "confidence_score")


def _with_decided(df: DataFrame, decided: DataFrame, key: str) -> DataFrame:
    d = decided.select(key, *[F.col(c).alias(f"_{c}") for c in _DECIDED])
    return df.join(d, key, "left")


def attach_to_items(items: DataFrame, decided: DataFrame, key: str) -> DataFrame:
    """Id and path onto the record, the class name as its category; no class, no change."""
    df = _with_decided(items, decided, key)
    hit = F.col("_type_id").isNotNull()

    def was(name, kind):
        return F.col(name) if name in items.columns else F.lit(None).cast(kind)

    new = {
        "type_id": F.when(hit, F.col("_type_id")).otherwise(was("type_id", "bigint")),
        "classification_path": F.when(hit, F.col("_classification_path")).otherwise(
            was("classification_path", "string")
        ),
        "category": F.when(hit, F.col("_classification_name")).otherwise(was("category", "string")),
    }
    return df.withColumns(new).drop(*[f"_{c}" for c in _DECIDED])


def attach_to_rows(rows: DataFrame, decided: DataFrame, key: str) -> DataFrame:
    """The five class columns onto a product row; ``category`` stays as it was."""
    df = _with_decided(rows, decided, key)
    new = {c: F.col(f"_{c}") for c in _DECIDED}
    new["classification_path"] = blank(F.col("_classification_path"))
    return df.withColumns(new).drop(*[f"_{c}" for c in _DECIDED])
