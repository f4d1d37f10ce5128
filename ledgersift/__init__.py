"""Payment-transaction analytics and fraud detection on PySpark DataFrames."""
