from datetime import datetime

import numpy as np

from pyspark.sql import functions as F

from rastertab.operators.nest import (FORECAST_FIELDS, deaccumulate, forecast_time_consistent, nest_forecast,
                                      stage_projection, unnest)
from rastertab.sources.schemas import conform, declared


def _staging(spark):
    rows = []
    for ct in (datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 6)):
        for cell in ("POINT(1 1)", "POINT(2 2)"):
            for h in (6, 0, 3):
                ft = ct.replace(hour=ct.hour + h)
                hours = None if (h == 3 and cell == "POINT(2 2)") else h
                rows.append((cell, "POLYGON ((1 1, 1 2, 0 2, 0 1, 1 1))", ct, hours, ft, float(h), float(10 * h)))
    df = spark.createDataFrame(rows, "geography string, geography_polygon string, creation_time timestamp, "
                                     "forecast_hours bigint, forecast_time timestamp, "
                                     "temperature_2m_above_ground double, total_precipitation_surface double")
    return conform(df, declared("gfs"))


def test_nest_orders_hours_and_recovers_null_hour(spark):
    nested = nest_forecast(stage_projection(_staging(spark)))
    rows = nested.collect()
    assert len(rows) == 4
    for r in rows:
        assert [e.hours for e in r.forecast] == [0, 3, 6]
        assert [e.temperature_2m_above_ground for e in r.forecast] == [0.0, 3.0, 6.0]
        assert r.forecast[0].downward_shortwave_radiation_flux is None
    assert dict(nested.dtypes)["creation_time"] == "timestamp_ntz"
    assert nested.schema["forecast"].dataType.elementType.fieldNames() == ["hours", "time", *FORECAST_FIELDS]


def test_unnest_roundtrip_is_input_multiset(spark):
    proj = stage_projection(_staging(spark))
    back = unnest(nest_forecast(proj), "forecast").select(
        "creation_time", "geography", F.col("hours").alias("forecast_hours"), "temperature_2m_above_ground")
    orig = proj.select("creation_time", "geography", "forecast_hours", "temperature_2m_above_ground")
    assert sorted(back.collect()) == sorted(orig.collect())


def test_deaccumulate_and_consistency(spark):
    nested = deaccumulate(nest_forecast(stage_projection(_staging(spark))))
    steps = [e.total_precipitation_surface_step for e in nested.first().forecast]
    assert steps == [0.0, 30.0, 30.0]
    proj = stage_projection(_staging(spark))
    ok = proj.where(forecast_time_consistent(F.col("creation_time"), F.col("forecast_hours"),
                                             F.col("forecast_time"))).count()
    assert ok == proj.count()


def test_chunked_nest_splits_hot_key_in_order(spark):
    from rastertab.operators.nest import ordered_nest_chunked
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                   (F.col("id") * 7 % 1000).alias("h"), F.col("id").alias("v"))
    c = ordered_nest_chunked(df, ["k"], ["h"], ["v"], "arr", num_partitions=6)
    hot = c.where("k = 0").orderBy("chunk").collect()
    assert len(hot) > 1
    flat = [(e.h, e.v) for r in hot for e in r.arr]
    assert len(flat) == 10000 and flat == sorted(flat)
    assert c.where("k <> 0").count() == 20000
    assert [r.chunk for r in hot] == list(range(len(hot)))  # 0, 1, 2, ... of each key
    assert [r["first"] for r in hot] == np.cumsum([0, *[len(r.arr) for r in hot]])[:-1].tolist()
    assert c.where("k <> 0 AND (chunk <> 0 OR first <> 0)").count() == 0


def test_chunks_give_every_element_its_place(spark):
    from pyspark.sql import Window
    from rastertab.operators.nest import ordered_nest_chunked, unnest_chunks
    df = spark.range(5000).select(F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 3).alias("k"),
                                  F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") * 7 % 50).alias("h"), (F.col("id") % 90).alias("v"))
    got = unnest_chunks(ordered_nest_chunked(df, ["k"], ["h"], ["v"], "arr", num_partitions=7), ["k"], "arr")
    want = df.select("k", (F.row_number().over(Window.partitionBy("k").orderBy("h", "v")) - 1).alias("pos"), "h", "v")
    assert sorted(map(str, map(tuple, got.select("k", "pos", "h", "v").collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_a_cell_may_hold_any_number_of_elements(spark):
    from rastertab.operators.nest import duplicate_elements, ordered_nest
    df = spark.range(3000).select(F.lit("cell").alias("k"), (F.col("id") % 2500).alias("h"), F.col("id").alias("v"))
    assert ordered_nest(df, ["k"], ["h"], ["v"], "arr").select(F.size("arr")).first()[0] == 3000
    assert duplicate_elements(df, ["k"], ["h"]).count() == 500


def test_deaccumulate_without_precipitation_at_hour_zero(spark):
    rows = [("POINT(1 1)", "POLYGON ((1 1, 1 2, 0 2, 0 1, 1 1))", datetime(2024, 1, 1), h, datetime(2024, 1, 1, h), v)
            for h, v in ((0, None), (3, 30.0), (6, 60.0))]
    df = spark.createDataFrame(rows, "geography string, geography_polygon string, creation_time timestamp, "
                                     "forecast_hours bigint, forecast_time timestamp, total_precipitation_surface double")
    nested = deaccumulate(nest_forecast(stage_projection(conform(df, declared("gfs")))))
    assert [e.total_precipitation_surface_step for e in nested.first().forecast] == [None, 30.0, 30.0]


def test_nest_of_staged_text_equals_text_grouping(spark):
    from rastertab.plans.forecast import nest_staged
    staged = _staging(spark)
    odd = staged.limit(2).withColumn("geography", F.lit("POINT(-0 1.5)")).withColumn(
        "geography_polygon", F.lit("POLYGON ((0.25 1.25, 0.25 1.75, -0 1.75, -0 1.25, 0.25 1.25))"))
    staged = staged.unionByName(odd)
    assert sorted(map(repr, nest_staged(staged).collect())) == sorted(map(repr, nest_forecast(stage_projection(staged)).collect()))
    import pytest
    with pytest.raises(Exception, match="invalid WKT"):
        nest_staged(staged.withColumn("geography_polygon", F.lit("POLYGON ((1 1, 2 2, 3 3, 1 1))"))).collect()


def test_format_late_nest_keeps_negative_zero_and_equals_text_path(spark):
    import numpy as np
    from rastertab.plans.forecast import forecast_layout, forecast_nested, forecast_nested_late
    from raster_fixtures import tiles_from_arrays
    # origin 0 and an inexact pixel size: the west edge of column 0 rounds to -0
    gt = (-1e-17, 0.000833333333, 0.0, 0.0004, 0.0, -0.000833333333)
    images = []
    for h in (0, 3):
        meta = {"creation_time": "1704067200000", "forecast_hours": str(h),
                "forecast_time": str(1704067200000 + h * 3600000)}
        images.append({"image_id": f"h{h}", "data": np.ones((8, 2, 3)), "gt": gt,
                       "band_names": list(forecast_layout().band_names), "band_type": "Float32", "meta": meta})
    tiles = tiles_from_arrays(spark, images)
    late = sorted((r.geography, r.geography_polygon, len(r.forecast)) for r in forecast_nested_late(tiles).collect())
    text = sorted((r.geography, r.geography_polygon, len(r.forecast)) for r in forecast_nested(tiles).collect())
    assert late == text and len(late) == 6
    assert any(", -0 " in p for _, p, _ in late)


def test_deaccumulate_only_after_cutoff(spark):
    from datetime import datetime as dt
    rows = []
    for year in (2019, 2020):
        for h in (0, 3):
            rows.append(("POINT(1 1)", "POLYGON ((1 1, 1 2, 0 2, 0 1, 1 1))", dt(year, 1, 1), h, dt(year, 1, 1, h),
                         float(h * 10 + 5)))
    df = spark.createDataFrame(rows, "geography string, geography_polygon string, creation_time timestamp, "
                                     "forecast_hours bigint, forecast_time timestamp, total_precipitation_surface double")
    nested = deaccumulate(nest_forecast(stage_projection(conform(df, declared("gfs")))))
    steps = {r.creation_time.year: [e.total_precipitation_surface_step for e in r.forecast] for r in nested.collect()}
    assert steps == {2019: [5.0, 35.0], 2020: [5.0, 30.0]}
