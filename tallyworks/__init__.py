"""Tallyworks: a retail, subscription and product-event warehouse as Spark DataFrame jobs."""
