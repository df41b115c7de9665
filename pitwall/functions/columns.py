"""References to columns by their exact names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(column: str) -> Column:
    """A column by its exact name: headers and compound names may hold dots,
    spaces and backticks."""
    return F.col("`" + column.replace("`", "``") + "`")
