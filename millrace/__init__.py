"""Order, message, lookup and log pipelines as Spark jobs."""
