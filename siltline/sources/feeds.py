"""Bronze feeds: catalog tables or Parquet folders, as batch or streaming DataFrames."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from siltline.plans.spec import EntitySpec


@dataclass(frozen=True)
class FeedNames:
    """Where an entity's feeds live: ``catalog.bronze.<pattern>``; empty parts are left out."""

    bronze: str
    catalog: str = ""
    main_pattern: str = "{entity}_py"
    recon_pattern: str = "{entity}_recon"

    def _qualified(self, table: str) -> str:
        return ".".join(p for p in (self.catalog, self.bronze, table) if p)

    def main(self, spec: EntitySpec) -> str:
        return self._qualified(self.main_pattern.format(entity=spec.name))

    def recon(self, spec: EntitySpec) -> str:
        return self._qualified(self.recon_pattern.format(entity=spec.name))


def table_feed(spark: SparkSession, name: str, *, stream: bool = True, **options) -> DataFrame:
    """A feed kept as a catalog table; streaming reads are incremental."""
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).table(name)


def folder_feed(
    spark: SparkSession,
    path: str,
    *,
    schema: StructType | str | None = None,
    stream: bool = True,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A feed kept as a folder of Parquet files. A stream without a schema takes it from the files there."""
    if not stream:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)

