"""Sinks: Parquet datasets, catalog tables, CSV exports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  mode: str = "overwrite", skip_empty: bool = True) -> bool:
    """Write a Parquet dataset (optionally partitioned); empty frames leave none.

    The frame is evaluated once: its rows are counted while they are written.
    Returns whether anything was written. Partitioning the yearly facts by
    year lets later year filters prune whole directories.
    """
    observed = Observation()
    w = df.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if observed.get["rows"] or not skip_empty:
        return True
    remove_dataset(df.sparkSession, path)
    return False


def remove_dataset(spark: SparkSession, path: str) -> None:
    """Delete a dataset that this library has written itself, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the path was committed: its marker is the last file a job leaves."""
    return _exists(spark, f"{path}/_SUCCESS")


def write_if_absent(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> bool:
    """Skip the write when the target is complete; what a job left half-written is written anew. Whether it was written."""
    if is_complete(df.sparkSession, path):
        return False
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return True


def _digests(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """(value, rows, digest) of each partition's rows, whatever their order."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(38,0)")
    return df.groupBy(F.col(by).alias("value")).agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("digest"))


def refresh_partitions(df: DataFrame, path: str, by: str) -> tuple[list, list]:
    """Bring a dataset partitioned by one column up to date, writing only the partitions whose rows changed.

    Partitions are compared by their number of rows and the sum of the rows'
    hashes; the changed ones are replaced by dynamic partition overwrite (each
    task's files are staged and moved when the job commits), those without rows any more are
    removed, and the files of the others stay as they are. Returns (values written, values removed).
    """
    spark = df.sparkSession
    if not is_complete(spark, path):
        df.write.mode("overwrite").partitionBy(by).parquet(path)
        return sorted(r.value for r in df.select(F.col(by).alias("value")).distinct().collect()), []
    columns = [c for c in df.columns if c != by]
    old = _digests(spark.read.schema(df.schema).parquet(path), by, columns).select(
        F.col("value").alias("o_value"), F.struct("rows", "digest").alias("before"))
    new = _digests(df, by, columns).select("value", F.struct("rows", "digest").alias("after"))
    both = new.join(old, F.col("value").eqNullSafe(F.col("o_value")), "full").where(~F.col("before").eqNullSafe(F.col("after")))
    found = both.select(F.col("after").isNotNull().alias("here"), F.coalesce("value", "o_value").alias("value")).collect()  # one row a partition
    written, gone = sorted(r.value for r in found if r.here), sorted(r.value for r in found if not r.here)
    if written:
        changed = df.where(F.col(by).isin(written))
        changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    for value in gone:
        remove_dataset(spark, f"{path}/{by}={value}")
    return written, gone


def swap_table(df: DataFrame, name: str, folder: str) -> str:
    """Create or replace a catalog table by writing a new version beside the old one and moving the table to it.

    Readers see the old rows until the one catalog call that moves the table, and the new ones
    afterwards; a failed write leaves the table as it was. The version before the last is removed. Returns the new version's path.
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{name.replace('.', '/')}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if spark.catalog.tableExists(name) and spark.table(name).schema.simpleString() == df.schema.simpleString():
        kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('terrarank.current' = '{path}', 'terrarank.previous' = '{kept.get('terrarank.current', '')}')")
        if kept.get("terrarank.previous"):
            remove_dataset(spark, kept["terrarank.previous"])
    else:  # a new table, or one whose columns changed
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=path, source="parquet")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('terrarank.current' = '{path}')")
    spark.catalog.refreshTable(name)
    return path


def register_dataset(spark: SparkSession, name: str, path: str) -> None:
    """A catalog table over the files of a Parquet dataset, with its partitions; one that lies there already is brought up to date."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    if spark.catalog.listColumns(name) and any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def save_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
               options: Mapping[str, str] | None = None, temp_view: bool = False) -> None:
    """Create or replace a catalog table with the frame's rows.

    ``options={"path": ...}`` makes it an external table at that location;
    ``temp_view=True`` only registers the (lazy) frame under ``name``."""
    if temp_view:
        df.createOrReplaceTempView(name)
        return
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.saveAsTable(name)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header (e.g. the current top-N view).

    ``single_file`` coalesces to one partition — only for small, bounded
    results such as a top-N export.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
