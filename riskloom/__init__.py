"""Transaction-risk analytics on Spark: ingest, point-in-time features, models, drift, monitoring, streams."""
