"""Readers for landed extracts (Parquet, CSV, JSON) and source bookkeeping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from terrarank.config import SOURCE_ALIASES, SOURCE_SCHEMAS, STUB_ROW_THRESHOLD
from terrarank.sources.harmonize import empty_like, harmonize_columns


def read_parquet_or_empty(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """Parquet at ``path`` with its own columns; a typed empty frame (or None without schema) if it is absent.

    Only a path that does not exist counts as absent; every other error is raised.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_like(spark, schema) if schema is not None else None


def load_sources(
    spark: SparkSession,
    paths: Mapping[str, str],
    schemas: Mapping[str, StructType | str] | None = None,
) -> dict[str, DataFrame]:
    """Read every named Parquet source under its canonical column names.

    A source that is absent becomes an empty frame of its declared schema
    (``schemas``, else ``config.SOURCE_SCHEMAS``); one without a declared schema is left out.
    """
    schemas = {**SOURCE_SCHEMAS, **(schemas or {})}
    out = {}
    for name, path in paths.items():
        df = read_parquet_or_empty(spark, path, schemas.get(name))
        if df is not None:
            out[name] = harmonize_columns(df, SOURCE_ALIASES[name]) if name in SOURCE_ALIASES else df
    return out


def source_status(frames: Mapping[str, DataFrame], threshold: int = STUB_ROW_THRESHOLD) -> DataFrame:
    """(source, rows, status) for a bundle of frames, in ONE job.

    Each frame contributes a one-row global count; the counts are unioned,
    so all sources are counted by a single Spark job. Status is REAL when the
    source has more than ``threshold`` rows, else STUB.
    """
    parts = [f.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("source"), "rows")
             for n, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = F.when(F.col("rows") > threshold, F.lit("REAL")).otherwise(F.lit("STUB"))
    return out.select("source", "rows", status.alias("status"))


def read_csv_extract(spark: SparkSession, path: str, schema: StructType | str | None = None,
                     sep: str = ",") -> DataFrame:
    """CSV with header; a declared schema avoids an inference pass over the data."""
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_flat_json(spark: SparkSession, path: str,
                   code_cols: Sequence[str] = ("D1C", "D2C", "D3C", "V")) -> DataFrame:
    """Row-per-record JSON array extracts, all files of a directory at once.

    Each file's first record repeats the column titles: it has words in every
    one of the code columns, where a data record has a number in one at least.
    Only such records are dropped. All fields are read as strings, like the untyped source.
    """
    df = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    present = [F.col(c) for c in code_cols if c in df.columns]
    if not present:
        return df
    titles = F.lit(True)
    for c in present:
        titles = titles & F.coalesce(F.trim(c).rlike(r"\p{L}") & ~F.trim(c).rlike(r"^[0-9]"), F.lit(False))
    return df.where(~titles)


def flatten_json_dimension(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Nested JSON records → flat columns via dotted paths (``{out: "a.b.c"}``)."""
    cols = []
    for out, path in fields.items():
        parts = path.split(".")
        expr = F.col(f"`{parts[0]}`")
        for p in parts[1:]:
            expr = expr.getField(p)
        cols.append(expr.alias(out))
    return df.select(*cols)


def parse_json_column(df: DataFrame, col: str, schema: StructType | str, prefix: str = "") -> DataFrame:
    """Parse a JSON string column with a declared schema and flatten its fields."""
    parsed = F.from_json(F.col(col), schema)
    tmp = df.withColumn("_json", parsed)
    names = tmp.schema["_json"].dataType.names
    return tmp.select(*[c for c in df.columns if c != col],
                      *[F.col(f"_json.{n}").alias(prefix + n) for n in names])


def unwrap_items(df: DataFrame, col: str, item_schema: StructType | str) -> DataFrame:
    """JSON payloads that are either a list of records or ``{"items": [...]}``.

    An object is a wrapper if it has the key ``items``, wherever it stands; a
    lone object without it is treated as a one-record list. An empty list, and NULL, give no row.
    """
    as_list = F.from_json(F.col(col), f"array<{_ddl(item_schema)}>")
    as_wrapped = F.from_json(F.col(col), f"struct<items: array<{_ddl(item_schema)}>>").getField("items")
    as_single = F.array(F.from_json(F.col(col), item_schema))
    trimmed = F.ltrim(F.col(col))
    items = (F.when(trimmed.startswith("["), as_list)
             .when(F.array_contains(F.json_object_keys(F.col(col)), "items"), as_wrapped)
             .when(F.col(col).isNotNull(), as_single))
    exploded = df.select(*[c for c in df.columns if c != col], F.explode(items).alias("_item"))
    names = exploded.schema["_item"].dataType.names
    return exploded.select(*[c for c in df.columns if c != col], *[F.col(f"_item.{n}").alias(n) for n in names])


def _ddl(schema: StructType | str) -> str:
    if isinstance(schema, StructType):
        return "struct<" + ",".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema.fields) + ">"
    s = schema.strip()
    return s if s.startswith("struct<") else f"struct<{s}>"


def first_nonempty(candidates: Sequence) -> DataFrame | None:
    """Ordered fallback: the first candidate frame that has at least one row.

    Candidates may be frames or zero-argument callables producing frames (so a
    later source is not even planned when an earlier one has data). Each check
    is ``isEmpty()``, which reads at most one row.
    """
    for c in candidates:
        df = c() if callable(c) else c
        if df is not None and not df.isEmpty():
            return df
    return None


def detect_key_column(
    df: DataFrame,
    order_col: str,
    sample_size: int = 20,
    pattern: str = r"^[0-9]{6,7}$",
) -> DataFrame:
    """Which string columns look like entity keys?

    For every string column, take its first ``sample_size`` non-null values in
    ``order_col`` order and test whether any is an all-digit string of 6 or 7
    characters. The per-column row limit is a window-group limit, which Spark
    applies before the shuffle, so only ``sample_size`` rows per column per
    partition move. Returns (column, position, is_key).
    """
    str_cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name != order_col]
    if not str_cols:
        return df.sparkSession.createDataFrame([], "column string, position int, is_key boolean")
    rows = [x for i, c in enumerate(str_cols) for x in (F.lit(c), F.lit(i), F.col(f"`{c}`"))]
    stacked = df.select(
        F.col(order_col).alias("_ord"),
        F.stack(F.lit(len(str_cols)), *rows).alias("column", "position", "v"),
    ).where(F.col("v").isNotNull())
    from pyspark.sql import Window
    w = Window.partitionBy("column").orderBy("_ord")
    head = stacked.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= sample_size)
    return head.groupBy("column", "position").agg(F.bool_or(F.col("v").rlike(pattern)).alias("is_key"))
