"""Spark-native clinical risk analytics: ingest, repair, check, profile, cluster and score patient tables."""
