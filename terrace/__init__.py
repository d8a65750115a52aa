"""terrace: a PySpark lakehouse toolkit.

Stamped CSV drops flow through an append-only raw zone, a typed and merged
trusted zone, and a refined star schema with sales marts.  Every operator is
a DataFrame -> DataFrame function; only ``terrace.plans.batch`` writes.
"""

__all__ = ["operators", "sources", "functions", "plans", "streaming", "session"]
