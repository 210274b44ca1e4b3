"""Commodity price-quote reconciliation as lazy Spark DataFrame transformations."""
