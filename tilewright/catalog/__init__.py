"""Catalogue of runnable queries over the given tables."""


def all_queries() -> dict:
    """Name -> (callable of session and folder, DuckDB text or None)."""
    from tilewright.catalog import imaging, ingest, metadata, reporting, streams

    groups = [ingest.QUERIES, imaging.QUERIES, reporting.QUERIES, streams.QUERIES, metadata.QUERIES]
    return {name: pair for group in groups for name, pair in group.items()}
