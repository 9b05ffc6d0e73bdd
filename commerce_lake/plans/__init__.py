"""What a user calls: Bronze ingestion, the Gold star schema, the event stream, the daily run."""
