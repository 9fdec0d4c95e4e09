"""Every operator as a runnable query, most with an independent SQL twin."""


def all_queries():
    from importlib import import_module

    from shelfwright.checks.registry import QUERIES, SQL

    for m in MODULES:
        import_module(f"shelfwright.checks.{m}")
    return QUERIES, SQL


MODULES = ["tables_and_text", "link_queries", "page_queries", "class_queries", "audit_queries", "stream_queries"]
