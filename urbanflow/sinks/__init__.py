"""Writers: partitioned Parquet, JSON layouts, Kafka encoding."""
