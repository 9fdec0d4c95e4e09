"""Operators of a training-data pipeline. Nothing else in the package imports this one."""


def all_queries():
    """The queries ``opN_<name>`` and their SQL twins where SQL can say it."""
    from importlib import import_module

    from shelfwright.llm.common import QUERIES, SQL

    for m in MODULES:
        import_module(f"shelfwright.llm.{m}")
    return QUERIES, SQL


MODULES = [
    "line_dedup",
    "embedding_join",
    "maxscore",
    "main_text",
    "log_bilinear",
    "mixing",
    "packing",
    "sharding",
    "minhash_join",
    "toxic_segments",
    "merkle_manifest",
    "token_alignment",
    "language_id",
]
