"""sluice: a Spark-native bulk ingestion and verification engine."""
