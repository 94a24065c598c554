"""Retail data quality and analytics on Spark: rules, silver/quarantine split, reports and gold marts."""
