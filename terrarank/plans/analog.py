"""Stand-in inputs built from the driver's TPC-H-like tables.

These functions only reshape the test tables into the schemas the jobs
expect (an entity dimension, flat yearly extracts, a long class table); all
the work of the jobs happens in the operators.

Mapping: entity = customer (``c_custkey``), name = ``c_name``, state = nation
name, macro-region = region name, area_km2 = ``abs(c_acctbal)``;
class = ``o_orderpriority``; year = order year; measure (area) =
``l_quantity`` of the order's lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrarank.operators.boosting import Boosting
from terrarank.session import keep

KEY = "entity_key"
YEAR = "year"
CLASS = "class_code"
AREA = "area"

# Class groups of the analogue (priorities play the land-cover classes).
ANALOG_GROUPS = {
    "native": ["1-URGENT", "2-HIGH"],
    "forest": ["1-URGENT"],
    "agro": ["4-NOT SPECIFIED", "5-LOW"],
    "urban": ["3-MEDIUM"],
}
REF_YEAR = 2000
CHANGE_START = 1996
GATE_MIN_ROWS = 8000
CHANGE_END = 2000
ASOF_REF_YEAR = 2003  # absent from the data: resolves to the latest earlier year
# A multi-select state filter for the KPI view (a user selection of six states).
KPI_STATES = ["NATION_1", "NATION_3", "NATION_5", "NATION_8", "NATION_13", "NATION_21"]

ABSENT_INDICATOR = "pressure_index"  # left out by the query on a table that lacks one

# One boosted tree on given bins: the cuts of each feature, and how the tree grows.
TREE_CUTS = {
    "pct_native": [10, 20, 30, 40, 50, 60, 70, 80, 90],
    "pct_agro": [10, 25, 40, 55, 70, 85],
    "gdp_per_capita": [1000000, 5000000, 10000000, 20000000, 40000000],
    "pop_density": [0.001, 0.002, 0.005, 0.01, 0.05],
}
LEAF_WISE_SMALL = Boosting(rounds=1, max_leaves=6, min_rows=20)
SECOND_ORDER_SMALL = Boosting(rounds=1, max_leaves=4, max_depth=2, min_rows=1, l2=1.0)


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named Parquet table, one DataFrame per (session, path).

    Resolving a Parquet relation lists the file and reads its footer on the
    driver; reusing the resolved frame avoids repeating that per reference.
    """
    path = f"{sf_dir}/{name}.parquet"
    hit = _TABLES.get(path)
    # the cached frame holds its session, so "is" cannot match a recycled id
    if hit is None or hit.sparkSession is not spark:
        hit = _TABLES[path] = spark.read.parquet(path)
    return hit


def _in_years(df: DataFrame, col: str, years: Sequence[int] | None) -> DataFrame:
    """Rows dated within the years' span: bounds on the column itself, which reach the Parquet scan."""
    if not years:
        return df
    start, end = (F.lit(f"{y}-01-01").cast(df.schema[col].dataType) for y in (min(years), max(years) + 1))
    return df.where((F.col(col) >= start) & (F.col(col) < end))


def landuse(spark: SparkSession, sf_dir: str, years: Sequence[int] | None = None) -> DataFrame:
    """Long class table: (entity_key, class_code, year, area) — one row per line item.

    ``years``: only rows of orders within the span of these years are wanted."""
    o = _in_years(table(spark, sf_dir, "orders"), "o_orderdate", years).select(
        "o_orderkey", F.col("o_custkey").alias(KEY), F.col("o_orderpriority").alias(CLASS),
        F.year("o_orderdate").alias(YEAR))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").alias(AREA))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(KEY, CLASS, YEAR, AREA)


def entity_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_key, name, state, region, area_km2)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("c_custkey").alias(KEY), F.col("c_name").alias("name"),
                    F.col("n_name").alias("state"), F.col("r_name").alias("region"),
                    F.abs("c_acctbal").alias("area_km2")))


def order_activity(spark: SparkSession, sf_dir: str, years: Sequence[int] | None = None) -> DataFrame:
    """Value and number of orders per customer and order year: the GDP and herd extracts share this one read, persisted.

    Money is summed as DECIMAL, so the total is exact whatever the order."""
    o = _in_years(table(spark, sf_dir, "orders"), "o_orderdate", years)
    return keep(o.groupBy(F.col("o_custkey").alias(KEY), F.year("o_orderdate").alias(YEAR)).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("gdp_k"),
        F.count(F.lit(1)).cast("double").alias("herd_total")))


def gdp_extract(spark: SparkSession, sf_dir: str, years: Sequence[int] | None = None) -> DataFrame:
    """(entity_key, year, gdp_k): order value per customer and order year.

    Money is summed as DECIMAL, so the total is exact whatever the order."""
    o = _in_years(table(spark, sf_dir, "orders"), "o_orderdate", years)
    return (o.groupBy(F.col("o_custkey").alias(KEY), F.year("o_orderdate").alias(YEAR))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("gdp_k")))


def population_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_key, year, population): line items shipped per customer and ship year."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return (j.groupBy(F.col("o_custkey").alias(KEY), F.year("l_shipdate").alias(YEAR))
            .agg(F.count(F.lit(1)).cast("double").alias("population")))


def herd_extract(spark: SparkSession, sf_dir: str, years: Sequence[int] | None = None) -> DataFrame:
    """(entity_key, year, herd_total): orders per customer and order year."""
    o = _in_years(table(spark, sf_dir, "orders"), "o_orderdate", years)
    return (o.groupBy(F.col("o_custkey").alias(KEY), F.year("o_orderdate").alias(YEAR))
            .agg(F.count(F.lit(1)).cast("double").alias("herd_total")))


def crop_long_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long crop extract (entity_key, year, var_code, value): three variables per
    line item — 214 quantity, 215 extended price, 216 discounted quantity."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity",
                                                 "l_extendedprice", "l_discount")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    three = F.stack(F.lit(3),
                    F.lit(214), F.col("l_quantity"),
                    F.lit(215), F.col("l_extendedprice"),
                    F.lit(216), F.col("l_quantity") * (1 - F.col("l_discount"))).alias("var_code", "value")
    return j.select(F.col("o_custkey").alias(KEY), F.year("l_shipdate").alias(YEAR), three)


def shipped_landuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class table by the year of shipment instead of the order's."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias(KEY), F.col("o_orderpriority").alias(CLASS))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.year("l_shipdate").alias(YEAR), F.col("l_quantity").alias(AREA))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(KEY, CLASS, YEAR, AREA)


def as_of_year(spark: SparkSession, sf_dir: str, ref_year: int) -> int:
    """The year of orders that stands for ``ref_year``: itself, else the latest before it, else the first."""
    year = F.year("o_orderdate")
    r = table(spark, sf_dir, "orders").agg(F.max(F.when(year <= ref_year, year)), F.min(year)).first()
    return r[0] if r[0] is not None else r[1] or ref_year


LINES_A_TASK = 750_000


def _parts(spark: SparkSession, lines: int) -> int | None:
    """Parts of ``LINES_A_TASK`` lines; None if the session's own number of shuffle partitions is enough."""
    parts = -(-lines // LINES_A_TASK)
    return parts if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def activity(spark: SparkSession, sf_dir: str, order_years: Sequence[int] | None = None,
             ship_years: Sequence[int] | None = None) -> DataFrame:
    """Lines of one (entity, class, order year, shipment year): the extracts below share this one join of the
    largest tables, persisted.

    With years given, only lines ordered or shipped in one of them are summed up."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias(KEY), F.col("o_orderpriority").alias(CLASS),
        F.year("o_orderdate").alias("order_year"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.year("l_shipdate").alias("ship_year"), "l_quantity", "l_extendedprice", "l_discount")
    parts = _parts(spark, li.count())
    if parts:
        o, li = o.repartition(parts, "o_orderkey"), li.repartition(parts, "l_orderkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    if order_years is not None and ship_years is not None:
        j = j.where(F.col("order_year").isin(list(order_years)) | F.col("ship_year").isin(list(ship_years)))
    if parts:  # what leaves the join is summed up by key in as many parts, so that no task's share grows with the tables
        j = j.repartition(parts, KEY)
    return keep(j.groupBy(KEY, CLASS, "order_year", "ship_year").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"),
        F.sum(F.col("l_quantity") * (1 - F.col("l_discount"))).alias("discounted")))


def landuse_of(act: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    act = act if years is None else act.where(F.col("order_year").isin(list(years)))
    return act.select(KEY, CLASS, F.col("order_year").alias(YEAR), F.col("quantity").alias(AREA))


def population_of(act: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    act = act if years is None else act.where(F.col("ship_year").isin(list(years)))
    return (act.groupBy(KEY, F.col("ship_year").alias(YEAR))
            .agg(F.sum("lines").cast("double").alias("population")))


def crops_of(act: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    act = act if years is None else act.where(F.col("ship_year").isin(list(years)))
    three = F.stack(F.lit(3), F.lit(214), F.col("quantity"), F.lit(215), F.col("price"),
                    F.lit(216), F.col("discounted")).alias("var_code", "value")
    return act.select(KEY, F.col("ship_year").alias(YEAR), three)


def events_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a class table: (entity_key=user_id, class_code=event_type, year, area=value)."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias(KEY), F.col("event_type").alias(CLASS),
                    F.year("ts").alias(YEAR), F.col("value").alias(AREA))


EVENT_GROUPS = {
    "native": ["view", "click"],
    "forest": ["view"],
    "agro": ["purchase", "signup"],
    "urban": ["error"],
}
