"""Tallyweave: reconciliation, warehouse loading, change feeds, domain objects and keyed aggregates on Spark."""
