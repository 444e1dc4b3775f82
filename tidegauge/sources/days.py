"""Tables in folders by day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import subfolders


def read_days(
    spark: SparkSession,
    root: str,
    schema: StructType,
    column: str,
    first: date | None = None,
    last: date | None = None,
    below: str = "",
) -> DataFrame:
    """The table at `root`, of which only the folders of the days `first` to `last` are opened.

    Spark lists all folders of a table before it prunes any. Here the names of the days, which
    lie right in `root` or in its folder `below`, are listed first, and Spark gets the folders
    of the range. Days that have no folder yet are not seen later on, as with any file scan.
    """
    reader = spark.read.schema(schema)
    if first is None and last is None and not below:
        return reader.parquet(root)
    home = f"{root.rstrip('/')}/{below}".rstrip("/")
    low, high = f"{column}={first or ''}", f"{column}={last or '9999-12-31'}"
    days = [name for name in subfolders(spark, home) if name.startswith(f"{column}=") and low <= name <= high]
    if not days:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", root).parquet(*(f"{home}/{name}" for name in days))
