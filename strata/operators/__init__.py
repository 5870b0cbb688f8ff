"""DataFrame -> DataFrame operators: dedup, conform, enrich, aggregate, ingest, quality, generation."""
