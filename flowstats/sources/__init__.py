"""Record sources: stored tables, JSON files, Kafka."""
