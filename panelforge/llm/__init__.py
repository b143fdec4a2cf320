"""Training-data operators (tokens, duplicates, filters, mixtures) on Spark.

Nothing else in the library imports this subpackage."""
