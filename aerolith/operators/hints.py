"""Join-strategy helpers.

Broadcasts in this package rest on a proven size bound, in one of three ways:

* ``literal_broadcast`` for tables built from literal lists in ``constants.py``
  (their size is fixed in code);
* file-backed tables (driver tables, written layers, dimensions and statistics
  tables) are left to the planner, which sizes them from file statistics and
  broadcasts under ``spark.sql.autoBroadcastJoinThreshold``, else shuffles;
* a single-row parameter table whose array length is checked before planning and
  asserted at run time; above the bound the work is split into bounded blocks
  (see ``retrieval.cosine_top_k``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def literal_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a DataFrame built from a literal list in this package (size fixed in code)."""
    return F.broadcast(df)
