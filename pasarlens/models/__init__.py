"""Training tasks on pyspark.ml."""
