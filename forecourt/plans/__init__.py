"""The jobs: ingestion, features, training, promotion, scoring and monitoring."""
