"""Training-data operators for large language models, on Spark."""
