"""DataFrame operators and ``pyspark.ml`` stages, one module per concern."""
