"""Product catalogues from web-page snapshots, as Spark DataFrame operators."""
