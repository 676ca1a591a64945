"""Keep the (key, year) composition panel current as class extracts land.

The panel's totals and group areas are sums, so they are kept in streaming
state (``groupBy(key, year)`` with the state store, checkpointed for
recovery) and the shares are derived on output. New files in the landing
folder are picked up by the file source.

Two output modes:

* ``update`` (default, for large panels): each micro-batch appends only the
  (key, year) groups it changed, with their full current sums and the batch
  id; ``read_panel`` takes the latest version of each group (``max_by`` in a
  hash aggregate). Work per batch grows with the batch, not the panel.
* ``complete``: each micro-batch rewrites the whole panel snapshot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from terrarank.functions import in_group, safe_div


def panel_sums(df: DataFrame, key: str, year: str, class_col: str, measure: str,
               groups: Mapping[str, Sequence]) -> DataFrame:
    """Additive part of the composition: total and per-group sums per (key, year)."""
    m = F.coalesce(F.col(measure).cast("double"), F.lit(0.0))
    aggs = [F.sum(m).alias("total_area")]
    aggs += [F.sum(F.when(in_group(class_col, c), m).otherwise(F.lit(0.0))).alias(f"{g}_area")
             for g, c in groups.items()]
    return df.groupBy(key, year).agg(*aggs)


def shares_from_sums(sums: DataFrame, groups: Mapping[str, Sequence]) -> DataFrame:
    return sums.select("*", *[(safe_div(F.col(f"{g}_area"), F.col("total_area")) * 100).alias(f"pct_{g}")
                              for g in groups])


def start_panel_stream(
    spark: SparkSession,
    landing_dir: str,
    schema: StructType | str,
    out_dir: str,
    checkpoint_location: str,
    groups: Mapping[str, Sequence],
    key: str = "entity_key",
    year: str = "year",
    class_col: str = "class_code",
    measure: str = "area",
    available_now: bool = False,
    processing_time: str | None = None,
    mode: str = "update",
) -> StreamingQuery:
    """Start the incremental panel. ``checkpoint_location`` must be on shared
    storage on a cluster; it holds the offsets and the aggregation state."""
    src = spark.readStream.schema(schema).parquet(landing_dir)
    sums = panel_sums(src, key, year, class_col, measure, groups)

    def write_snapshot(batch: DataFrame, _epoch: int) -> None:
        shares_from_sums(batch, groups).write.mode("overwrite").parquet(out_dir)

    def append_changes(batch: DataFrame, epoch: int) -> None:
        # idempotent per epoch: a replayed batch overwrites its own folder
        batch.withColumn("batch_id", F.lit(epoch)).write.mode("overwrite").parquet(f"{out_dir}/batch={epoch}")

    if mode not in ("update", "complete"):
        raise ValueError(mode)
    sink = append_changes if mode == "update" else write_snapshot
    w = sums.writeStream.outputMode(mode).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.foreachBatch(sink).start()


def read_panel(spark: SparkSession, out_dir: str, groups: Mapping[str, Sequence], key: str = "entity_key",
               year: str = "year") -> DataFrame:
    """Current panel from an ``update``-mode output: latest version per group."""
    changes = spark.read.parquet(out_dir)
    value_cols = ["total_area", *[f"{g}_area" for g in groups]]
    latest = changes.groupBy(key, year).agg(
        F.max_by(F.struct(*[F.col(c) for c in value_cols]), F.col("batch_id")).alias("_v"))
    return shares_from_sums(latest.select(key, year, *[F.col(f"_v.{c}").alias(c) for c in value_cols]), groups)
