"""Sessions, Parquet tables, the flat encounter CSV and named result sets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def session(app: str, **conf: str) -> SparkSession:
    """A session with what the jobs rely on: UTC, and run-time splitting of skewed partitions."""
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **{name.replace("__", "."): value for name, value in conf.items()},
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def read_table(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{lake}/{name}")


def write_table(table: DataFrame, lake: str, name: str) -> None:
    table.write.mode("overwrite").parquet(f"{lake}/{name}")


def kept(table: DataFrame, path: str, name: str) -> DataFrame:
    """A shared intermediate as a table of its own: computed once, and there after a lost executor."""
    write_table(table, path, name)
    return read_table(table.sparkSession, path, name)


def write_bucketed(table: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """A table of the session's catalogue in sorted buckets of a key, one file each: groupings by the key and
    joins with tables in as many buckets of it need no shuffle."""
    spread = table.repartition(buckets, key)
    spread.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
    return table.sparkSession.table(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; unset, one inside the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_kept"


def read_encounter_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Header and types from the file. With a `schema` the pass that infers types is left out."""
    if schema:
        return spark.read.schema(schema).csv(path, header=True)
    return spark.read.csv(path, header=True, inferSchema=True)


def write_results(results: Mapping[str, DataFrame], path: str) -> None:
    """Every named result as its own Parquet directory."""
    for name, result in results.items():
        write_table(result, path, name)
