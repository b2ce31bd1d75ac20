"""Scans: raw JSON documents, header/row result sets, Parquet tables."""
