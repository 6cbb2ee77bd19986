"""Readers and writers: CSV files, stored rows, result files, Parquet tables."""
