"""Layered batch analytics on Spark: landed files -> typed, merged tables -> decision table."""
