"""Bundle documents in, one row per resource out."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from carelake.schemas import BUNDLE, RESOURCE_FIELDS

TYPE_COLUMN = "resource_type"
#: Text of a document that is not well-formed, and the directory of such documents among staged entries.
CORRUPT, REJECTED = "corrupt", "rejected"


def read_bundles(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """One row per file. Small files are packed into splits by the reader; `partitions` rebalances
    further when a few files are much larger than the rest. A malformed file keeps its text in
    `corrupt` beside what could be read of it, and every file its path."""
    schema = f"{BUNDLE}, {CORRUPT} string"
    bundles = spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    bundles = bundles.select("entry", CORRUPT, F.col("_metadata.file_path").alias("path"))
    return bundles.repartition(partitions) if partitions else bundles


def read_resources(spark: SparkSession, path: str) -> DataFrame:
    """As `read_bundles`, for files with one resource a line. Lines of one file go to as many tasks as its size
    needs (`spark.sql.files.maxPartitionBytes`), where a bundle is one row of one task, however large it is.
    A malformed line keeps its text in `corrupt`."""
    fields = ", ".join(f"`{n}` {t}" for n, t in RESOURCE_FIELDS.items())
    lines = spark.read.schema(f"{fields}, {CORRUPT} string").json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    resource = F.struct(F.struct(*(F.col(f"`{n}`") for n in RESOURCE_FIELDS)).alias("resource"))
    entry = F.when(F.col(CORRUPT).isNull(), F.array(resource))
    return lines.select(entry.alias("entry"), CORRUPT, F.col("_metadata.file_path").alias("path"))


def parse_bundles(documents: DataFrame, text: Column) -> DataFrame:
    """Same as `read_bundles` for documents that are a text column already."""
    return documents.select(F.from_json(text, BUNDLE).alias("bundle")).select("bundle.entry")


def entries(bundles: DataFrame) -> DataFrame:
    """One row per entry. The outer form with a filter behind it gives the rows of `explode`; the plain
    form makes the optimizer test `size(entry)` before it, for which a document is parsed again."""
    return bundles.select(F.explode_outer("entry").alias("entry")).filter("entry is not null")


def resource_texts(documents: DataFrame, text: Column) -> DataFrame:
    """`resource`, the JSON text of every resource in bundle documents given as text, whatever its fields."""
    bundle = F.from_json(text, "entry array<struct<resource: string>>")
    texts = documents.select(F.explode_outer(bundle["entry"]["resource"]).alias("resource"))
    return texts.filter("resource is not null")


def cached_entries(bundles: DataFrame) -> DataFrame:
    """Entries kept by the executors for several tables. The caller unpersists. Parsing is repeated
    for blocks that are lost; `stage_entries` is the form to use on a large lake."""
    return entries(bundles).persist(StorageLevel.MEMORY_AND_DISK)


def stage_entries(bundles: DataFrame, path: str) -> DataFrame:
    """Write the entries once, in one directory per resource type, and read them back.

    Each table then scans its own directory and, Parquet being columnar, only the nested fields it
    projects; the documents are parsed once however many tables are made of them. The rebalance is one
    shuffle, for files of even size: without it every task writes a file per type, and a task with a
    very large document writes most of a type alone. Malformed documents of `read_bundles` are written
    in the same pass (see `rejected`).
    """
    kind = F.col("entry.resource.resourceType")
    if CORRUPT in bundles.columns:
        note = F.struct("path", F.col(CORRUPT).alias("text"))
        each = F.transform("entry", lambda e: F.struct(e.alias("entry"), F.lit(None).cast("struct<path:string,text:string>").alias(REJECTED)))
        lost = F.struct(F.lit(None).cast(bundles.schema["entry"].dataType.elementType).alias("entry"), note.alias(REJECTED))
        both = F.concat(F.coalesce(each, F.array().cast(_pairs(bundles))), F.when(F.col(CORRUPT).isNotNull(), F.array(lost)).otherwise(F.array().cast(_pairs(bundles))))
        rows = bundles.select(F.explode(both).alias("row")).select("row.*").filter(f"entry is not null or {REJECTED} is not null")
        rows = rows.select("entry", REJECTED, F.when(F.col(REJECTED).isNotNull(), REJECTED).otherwise(kind).alias(TYPE_COLUMN))
    else:
        rows = entries(bundles).select("entry", kind.alias(TYPE_COLUMN))
    (
        rows
        .hint("rebalance", TYPE_COLUMN)
        .write.mode("overwrite")
        .partitionBy(TYPE_COLUMN)
        .parquet(path)
    )
    return bundles.sparkSession.read.parquet(path)


def _pairs(bundles: DataFrame) -> str:
    """Type of an array of an entry and a rejected document."""
    entry = bundles.schema["entry"].dataType.elementType.simpleString()
    return f"array<struct<entry:{entry},{REJECTED}:struct<path:string,text:string>>>"


def rejected(staged: DataFrame) -> DataFrame:
    """path and text of the malformed documents among staged entries."""
    return staged.filter(F.col(TYPE_COLUMN) == REJECTED).select(f"{REJECTED}.*")


def resources(entries: DataFrame, kind: str) -> DataFrame:
    """Resources of one type. On staged entries the filter selects the directory."""
    staged = TYPE_COLUMN in entries.columns
    wanted = F.col(TYPE_COLUMN if staged else "entry.resource.resourceType") == kind
    return entries.filter(wanted).select("entry.resource.*")
