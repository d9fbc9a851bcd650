"""seisloom: seismic-network analytics as Spark DataFrame and Structured Streaming jobs."""
