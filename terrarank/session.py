"""Session construction and shared execution settings."""

from __future__ import annotations

import tempfile
from threading import get_ident

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE re-plans joins and coalesces partitions at
# runtime, skew-join splits hot keys, UTC keeps year() stable across engines.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    # Call-site capture for error messages costs several JVM round trips per
    # Column function call while plans are built; error messages stay
    # informative without it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "terrarank",
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    On a cluster ``master`` comes from spark-submit; pass ``master=None`` to
    leave it untouched.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins. Only in local mode with the setting unset
    (tests) a scratch folder is created and registered; on a cluster an
    unset setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not (sc.master or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's object store)")
    local = tempfile.mkdtemp(prefix="terrarank-ckpt-")  # local mode only (tests, laptops)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_KEPT: list[tuple[int, DataFrame]] = []  # with the thread that keeps it


def keep(df: DataFrame) -> DataFrame:
    """Persist a frame that several jobs of one operator read; ``release`` frees it.

    Persisted blocks are only a cache: a lost executor's part is recomputed.
    """
    df = df.persist()
    _KEPT.append((get_ident(), df))
    return df


def release() -> None:
    """Unpersist what ``keep`` has persisted so far in this thread; call it when the results have been written."""
    mine = [entry for entry in _KEPT if entry[0] == get_ident()]
    for entry in mine:
        _KEPT.remove(entry)
        entry[1].unpersist()
