"""Dealers: the primary sites of the network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Mark of a primary site.
PRIMARY = "P"


def dealers(extract: DataFrame) -> DataFrame:
    """Primary dealers with a trimmed sector code, without repetitions."""
    primary = extract.filter(F.col("rank") == PRIMARY)
    return primary.withColumn("sector_code", F.trim("sector_code")).distinct()
