"""Declarative batch analytics on Spark: recipes and dataflow scripts over one DataFrame core."""
