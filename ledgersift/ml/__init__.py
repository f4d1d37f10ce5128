"""Training, selection and use of fraud models on pyspark.ml."""
