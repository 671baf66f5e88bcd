"""Readers and writers: CSV, Parquet, archive, exports, test-table adapter."""
