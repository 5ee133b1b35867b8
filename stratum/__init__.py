"""Layered (bronze, silver, gold) order and customer analytics on Spark."""
