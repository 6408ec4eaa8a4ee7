"""Click-stream analytics on Spark: visitor flags, channel metrics, keyed cells, change records."""
