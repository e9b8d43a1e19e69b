"""Recommendation, sentiment and churn models as Spark jobs."""
