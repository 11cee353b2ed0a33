"""rastertab: gridded rasters to analysis-ready tables, expressed as Spark DataFrame jobs.

Sub-packages:
  sources    tile tables, declared schemas, image catalogs, file listings
  operators  tiling, pixel expansion, attribute typing, nesting, reprojection, filters
  functions  column-level helpers (number text, WKT, time, path text)
  sinks      CSV text lines, typed Parquet, slice-replace table writers
  plans      end-to-end slice jobs and the registered query set
  streaming  incremental file loads with per-slice replace
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value so Python workers on any
    executor run the UDF / mapInPandas bodies without installing the package."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
