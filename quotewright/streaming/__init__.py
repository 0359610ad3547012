from quotewright.streaming.ingest import ingest_available, load_quotes  # noqa: F401
