"""Data-quality checks and explainable risk scores for payment transactions, on Spark."""
