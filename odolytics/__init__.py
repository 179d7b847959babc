"""Trip telemetry analytics on Spark: cleaning, motion features, statistics, models, streams."""
