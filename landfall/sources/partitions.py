"""Which days a dataset holds, from the catalog or from folder names. No file is opened for it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def catalog_days(spark: SparkSession, table: str) -> DataFrame:
    """Days of a partitioned catalog table, as the catalog lists them."""
    return spark.sql(f"SHOW PARTITIONS {table}").select(_day("partition", "^").alias("dt")).distinct()


def folder_days(spark: SparkSession, root: str, suffix: str = "parquet") -> DataFrame:
    """Days with a file of the given suffix under ``<root>/dt=…``; only names are listed, none if the root is missing."""
    listing = files(spark, f"{root}/dt=*", suffix)
    if listing is None:
        return spark.createDataFrame([], "dt string")
    return listing.select(_day("path", "/").alias("dt")).where("dt <> ''").distinct()


def files(spark: SparkSession, root: str, suffix: str = "parquet", columns: tuple[str, ...] = ("path",)) -> DataFrame | None:
    """``path`` of every file of a suffix below a root, or None if the root does not exist.

    The listing is distributed over folders; without the column ``content`` the files themselves are not opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{suffix}")
    try:
        return reader.load(root).select(*columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _day(column: str, before: str):
    """The value of the partition folder ``dt=``, with what folder names escape restored."""
    return F.url_decode(F.replace(F.regexp_extract(column, f"{before}dt=([^/]*)", 1), F.lit("+"), F.lit("%2B")))
