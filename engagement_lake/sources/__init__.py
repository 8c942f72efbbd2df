"""Raw JSON, Parquet tables, media configuration, catalog and session."""
