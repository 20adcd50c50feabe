"""Attaching dimension attributes to facts.

Plain equi-joins: the optimizer picks broadcast or shuffle from the sizes it
knows, AQE re-plans from the sizes it meets and splits hot keys. The product
table grows with the data (TPC-H ``part``), so no side carries a broadcast
hint, and no job runs while a plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach_dimension(facts: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``facts`` joined with ``dim`` on ``key``; per raw event, per aggregate row
    (after a group-by the fact side is days x products rows), or per
    micro-batch of a stream against a static ``dim``."""
    return facts.join(dim, key, how)
