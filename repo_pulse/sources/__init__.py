"""Landing files, raw tables, ingestion cursors and test-table adapters."""
