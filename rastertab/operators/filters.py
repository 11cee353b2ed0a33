"""Image selection filters (FLT-1..3, FLT-6, FLT-7, JN-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_list(text: str | None) -> list[str]:
    """Comma list -> names (empty / None -> no list)."""
    return [t for t in (text or "").split(",") if t != ""]


def include_exclude(images: DataFrame, name: Column, include: str | None = None,
                    exclude: str | None = None) -> DataFrame:
    """FLT-1/FLT-2: keep images named in ``include`` (when given), then drop
    those named in ``exclude``; exact matches on comma lists."""
    inc, exc = split_list(include), split_list(exclude)
    out = images
    if inc:
        out = out.where(name.isin(inc))
    if exc:
        out = out.where(~name.isin(exc))
    return out


def pending(selection: DataFrame, outputs: DataFrame, key: str | list[str], overwrite: bool = False) -> DataFrame:
    """FLT-3/JN-2: work whose output does not exist yet (or is empty).

    ``outputs`` is a listing with ``length``; zero-length outputs count as
    missing.  A left-anti join: a shuffle-free broadcast when the listing is
    small, a sort-merge join otherwise (the planner decides from sizes).
    ``overwrite=True`` selects everything.
    """
    if overwrite:
        return selection
    # no distinct: duplicates on the listing side do not change an anti join
    ready = outputs.where(F.col("length") > 0).select(*([key] if isinstance(key, str) else key))
    return selection.join(ready, on=key, how="left_anti")


def require(value, name: str):
    """FLT-7: required job parameter."""
    if value is None or value == "" or value == []:
        raise ValueError(f"{name} is required")
    return value


def require_input(spark, path: str) -> None:
    """FLT-6: a missing (or empty) input is an error; one wildcard is allowed."""
    from rastertab.sources.catalog import object_ready, single_wildcard
    single_wildcard(path)
    if not object_ready(spark, path):
        raise FileNotFoundError(f"{path} does not exist or is empty")


def plan_exports(selection: DataFrame, rasters: DataFrame, outputs: DataFrame, key: str = "name",
                 overwrite: bool = False) -> DataFrame:
    """FLT-3 with both checks: per selected image, ``needs_download`` (no
    non-empty raster yet) and ``needs_convert`` (no non-empty output yet);
    ``overwrite`` forces both.  Images needing neither are dropped.  The two
    listings are joined on the image name (left outer; sides are listings, one
    row per object, so the planner may broadcast them when small)."""
    def present(listing: DataFrame, flag: str) -> DataFrame:
        return (listing.where(F.col("length") > 0).select(key).dropDuplicates([key])
                .withColumn(flag, F.lit(True)))

    out = (selection.join(present(rasters, "_has_raster"), key, "left")
           .join(present(outputs, "_has_output"), key, "left"))
    force = F.lit(bool(overwrite))
    out = (out.withColumn("needs_download", force | F.col("_has_raster").isNull())
           .withColumn("needs_convert", force | F.col("_has_output").isNull())
           .drop("_has_raster", "_has_output"))
    return out.where(F.col("needs_download") | F.col("needs_convert"))
