"""Readers: parquet tables, the reference-shaped views derived from them, text logs, JDBC and Kafka."""
