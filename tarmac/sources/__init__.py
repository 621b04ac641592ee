"""Sources: CSV ingestion, catalog tables and the test-data mapping."""
