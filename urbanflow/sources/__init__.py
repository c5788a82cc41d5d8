"""Readers: Kafka (and Kafka-shaped file streams), delimited files, dimensions, spines."""
