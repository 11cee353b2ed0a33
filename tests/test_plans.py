"""Plan-shape checks: the scale properties the design relies on."""
import numpy as np

from rastertab.operators.attributes import PixelLayout
from rastertab.operators.pixels import expand_pixels
from rastertab.plans.forecast import forecast_layout, forecast_nested_late
from raster_fixtures import tiles_from_arrays


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tiles(spark, path):
    data = np.ones((8, 2, 3))
    images = [{"image_id": f"h{h}", "data": data, "gt": (0.0, 1.0, 0.0, 0.0, 0.0, -1.0),
               "band_names": list(forecast_layout().band_names), "band_type": "Float32",
               "meta": {"creation_time": "0", "forecast_hours": str(h), "forecast_time": str(h * 3600000)}}
              for h in range(3)]
    tiles_from_arrays(spark, images).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_pixel_expansion_has_no_exchange(spark, tmp_dir):
    tiles = _tiles(spark, f"{tmp_dir}/t")
    plan = _plan(expand_pixels(tiles, forecast_layout()))
    assert "Exchange" not in plan and "Generate" in plan
    # whole-stage codegen covers the explode and the text assembly
    assert "*(" in plan.split("Generate")[0].splitlines()[-1] or "WholeStageCodegen" in plan


def test_format_late_nest_has_one_row_exchange(spark, tmp_dir):
    tiles = _tiles(spark, f"{tmp_dir}/t")
    plan = _plan(forecast_nested_late(tiles))
    # one exchange, on the numeric cell key
    assert plan.count("Exchange") == 1
    assert "hashpartitioning(creation_time" in plan and "geography" not in plan.split("Exchange hashpartitioning")[1].split(")")[0]


def test_catalog_predicate_and_projection_reach_scan(spark, tmp_dir):
    from rastertab.sources.catalog import select_country_year
    spark.createDataFrame([("a", "NZL", 2020, 1.0)], "image_id string, country string, year int, x double") \
        .write.mode("overwrite").parquet(f"{tmp_dir}/c")
    plan = _plan(select_country_year(spark.read.parquet(f"{tmp_dir}/c"), "NZL", 2020).select("image_id"))
    assert "EqualTo(country,NZL)" in plan and "EqualTo(year,2020)" in plan
    assert "ReadSchema: struct<image_id:string,country:string,year:int>" in plan


def test_clustering_never_range_partitions_on_partition_keys_alone(spark):
    from pyspark.sql import functions as F
    from rastertab.sinks.tables import clustered
    df = spark.range(4000).selectExpr("id", "'2024-01-01' AS day")
    plan = _plan(clustered(df, ("day",), num_partitions=4))
    assert "rangepartitioning(" in plan and "xxhash64" in plan
    sizes = clustered(df, ("day",), num_partitions=4).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000  # one day spread over tasks
    assert "Exchange rangepartitioning(" in _plan(clustered(df, ("day",), ("id",), num_partitions=4))


def test_slice_read_prunes_partitions(spark):
    import __spark_entry__ as entry
    from conftest import SF_SMALL
    df = entry.queries()["slice_read"](spark, SF_SMALL)
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_staged_nest_scans_once_and_shuffles_no_text(spark, tmp_dir):
    from rastertab.plans.forecast import forecast_staging, nest_staged
    forecast_staging(_tiles(spark, f"{tmp_dir}/t")).write.parquet(f"{tmp_dir}/s")
    plan = _plan(nest_staged(spark.read.parquet(f"{tmp_dir}/s")))
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    nested = nest_staged(spark.read.parquet(f"{tmp_dir}/s"))
    text = spark._jvm.PythonSQLUtils.explainString(nested._jdf.queryExecution(), "formatted")
    moved = text.split(") Exchange\nInput")[1].split("\n")[0]  # the columns that cross the shuffle
    assert "gx#" in moved and "geography" not in moved and "_t_" not in moved


def test_slice_filter_reaches_the_scan_below_the_required_check(spark, tmp_dir):
    from rastertab.plans.jobs import population_rows
    spark.createDataFrame([("P", "Q", "NZL", 2020, 1.0)], "geography string, geography_polygon string, country string, year bigint, "
                          "population double").write.parquet(f"{tmp_dir}/p")
    plan = _plan(population_rows(spark, f"{tmp_dir}/p", ["NZL"], 2020))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(year,2020)" in pushed and "EqualTo(country,NZL)" in pushed


def test_reprojection_shuffles_blocks_only(spark, tmp_dir):
    from rastertab.operators.reproject import reproject_tiles
    spark.createDataFrame([([0.0, 5e4, 0.0, 0.0, 0.0, -5e4], 0, 0, 20, 10, {}, [[0.0] * 200])],
                          "gt array<double>, ix int, iy int, xblock int, yblock int, meta map<string,string>, bands array<array<double>>") \
        .write.parquet(f"{tmp_dir}/t")
    out = reproject_tiles(spark.read.parquet(f"{tmp_dir}/t"), PixelLayout(("v",), "Float32"), (0.0, 5e4, 0.0, 0.0, 0.0, -5e4), 20, 10,
                          (0.0, 0.5, 0.0, 0.0, 0.0, -0.5), 18, 9)
    plan = _plan(out)
    assert "Exchange" not in plan.split("MapInArrow")[0]  # pixels appear above the last block step only
    assert plan.index("Generate") < plan.index("MapInArrow")


def test_stream_batch_lists_touched_slices_only(spark, tmp_dir):
    """The files that the second batch lists and reads do not depend on how
    many other slices were landed before."""
    from pyspark.sql import types as T
    from rastertab.streaming.incremental import land, touched_slices
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.StringType())])
    listed = {}
    for older in (1, 30):
        landing = f"{tmp_dir}/l{older}"
        days = [(i, f"2024-02-{i + 1:02d}") for i in range(older)] + [(100, "2024-01-01"), (101, None)]
        assert len(land(spark.createDataFrame(days, schema), landing, ["day"], 0)) == older + 2
        touched = land(spark.createDataFrame([(3, "2024-01-01"), (4, None)], schema), landing, ["day"], 1)
        df = touched_slices(spark, landing, schema, touched)
        listed[older] = len(df.inputFiles())
        assert sorted((r.id, r.day) for r in df.collect()) == [(3, "2024-01-01"), (4, None), (100, "2024-01-01"), (101, None)]
        # a replayed batch takes its own folders' place
        assert land(spark.createDataFrame([(3, "2024-01-01"), (4, None)], schema), landing, ["day"], 1) == touched
        assert touched_slices(spark, landing, schema, touched).count() == 4
    assert listed[1] == listed[30] == 4
