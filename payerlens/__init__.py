"""Payer metrics over health-insurance claims, written as Spark DataFrame jobs."""
