"""Loan datamart, credit-risk analytics, scoring and drift monitoring on Spark."""
