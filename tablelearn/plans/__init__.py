"""Model plans (Spark ML pipelines, the sequence model) and the registered query set."""
