"""Schema negotiation: alias maps, typed empty frames, schema unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def harmonize_columns(df: DataFrame, targets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename whichever source columns exist to their canonical names.

    ``targets`` maps canonical name → aliases in priority order. When several
    aliases are present the first non-null one wins (``coalesce``); absent
    canonicals are simply not produced. Other columns pass through.
    Resolution happens on ``df.columns`` at plan time: no job runs.
    """
    used: set[str] = set()
    produced = []
    for canonical, aliases in targets.items():
        present = [a for a in (canonical, *aliases) if a in df.columns]
        present = list(dict.fromkeys(present))
        if not present:
            continue
        used.update(present)
        expr = F.col(f"`{present[0]}`") if len(present) == 1 else F.coalesce(*[F.col(f"`{a}`") for a in present])
        produced.append(expr.alias(canonical))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in used and c not in targets]
    return df.select(*produced, *rest)


def empty_like(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """Typed empty frame standing in for a source without data."""
    return spark.createDataFrame([], schema)


def union_extracts(
    frames: Sequence[DataFrame],
    tag_col: str | None = None,
    tags: Sequence | None = None,
) -> DataFrame:
    """UNION ALL by column name, missing columns filled with NULL.

    With ``tag_col``, each frame first gets its literal tag (year, biome, ...).
    """
    if not frames:
        raise ValueError("nothing to union")
    tagged = []
    for i, f in enumerate(frames):
        if tag_col is not None:
            f = f.withColumn(tag_col, F.lit(tags[i]))
        tagged.append(f)
    out = tagged[0]
    for f in tagged[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def tag_from_path(df: DataFrame, tag_col: str, pattern: str, group: int = 1, cast: str | None = "int") -> DataFrame:
    """Tag rows with a value parsed from their source file path.

    One read over a directory of per-year (or per-region) files replaces a
    driver loop of reads; the file path comes from the ``_metadata`` column.
    """
    tag = F.regexp_extract(F.col("_metadata.file_path"), pattern, group)
    tag = F.nullif(tag, F.lit(""))
    if cast:
        tag = tag.try_cast(cast)
    return df.select("*", tag.alias(tag_col))
