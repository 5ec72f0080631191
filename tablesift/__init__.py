"""Spark-first analytics for positioned table text: typed cells, data-quality rules, gates and roll-ups."""
