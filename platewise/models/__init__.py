"""Model jobs on pyspark.ml."""
