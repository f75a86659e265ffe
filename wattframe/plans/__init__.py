"""Query plans: reporting views, geography and incremental ingest."""
