"""Read and write source contracts and marts as Parquet.

``load_sources`` returns a lazy mapping name -> DataFrame over a folder of
``<name>/`` Parquet datasets (the layout ``write_sources`` produces), so a
materialised copy of the sources can replace the driver adapter.
Optional JDBC sources can be passed in the same mapping by the caller
(``spark.read.jdbc(..., column=, lowerBound=, upperBound=, numPartitions=)``
for a partitioned read); no connector is bundled.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.contracts import CONTRACT_TABLES
from tessera.sources.schemas import COLUMNS, differences, readable
from tessera.sources.snapshots import Files


class ParquetSources:
    """Contracts under ``path``, read with their declared schemas.  Files are listed anew for every frame, so rows that
    were appended since are seen; their schema is compared with the declared one first."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._files = spark, path.rstrip("/"), Files(spark, path)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in COLUMNS:
            raise KeyError(f"{name} is no contract")
        at = f"{self.path}/{name}"
        return self.spark.read.schema(readable(name, self.spark.read.parquet(at).schema)).parquet(at)

    def __contains__(self, name: str) -> bool:
        return name in COLUMNS and bool(self._files.names(f"{self.path}/{name}"))

    def check(self) -> list[str]:
        """Every difference of the contracts that are there from what is declared; nothing is read but footers."""
        return [d for name in COLUMNS if name in self for d in differences(name, self.spark.read.parquet(f"{self.path}/{name}").schema)]


def load_sources(spark: SparkSession, path: str) -> ParquetSources:
    return ParquetSources(spark, path)


def write_sources(src, path: str, tables=CONTRACT_TABLES, mode: str = "overwrite") -> list[str]:
    written = []
    for name in tables:
        src[name].write.mode(mode).parquet(os.path.join(path, name))
        written.append(name)
    return written


# marts written partitioned by creation month (partition pruning for
# period slicers; the month column is low-cardinality)
PARTITION_COLUMNS = {"vw_glpi_tickets": "created_year_month", "vw_fact_tickets": "created_ym"}


def write_mart(df: DataFrame, path: str, name: str, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    part = PARTITION_COLUMNS.get(name)
    if part and part in df.columns:
        w = w.partitionBy(part)
    w.parquet(os.path.join(path, name))
