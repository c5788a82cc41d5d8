"""urbanflow: Spark-native ingestion and analytics for urban sensor and mobility feeds.

Everything is a DataFrame -> DataFrame function composed with ``.transform``;
streaming and batch share the same column logic.
"""

__version__ = "0.1.0"
