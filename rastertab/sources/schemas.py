"""Declared table schemas (SCH-1, SCH-5, SCH-6, SCH-7).

A declared schema is a list of ``{name, type, mode, description, fields}``
objects.  ``to_struct`` turns it into a Spark ``StructType`` (REPEATED ->
array, RECORD -> struct, REQUIRED -> not null, description -> comment).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type name -> Spark type.  GEOGRAPHY is WKT text in this engine.
TYPE_MAP = {
    "STRING": T.StringType(),
    "GEOGRAPHY": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATETIME": T.TimestampNTZType(),
    "DATE": T.DateType(),
    "BYTES": T.BinaryType(),
}
RECORD_TYPES = ("RECORD", "STRUCT")
DEFAULT_TYPE = "STRING"
DEFAULT_MODE = "NULLABLE"


def _field(name, type_, mode="REQUIRED", fields=None, description=None):
    d = {"name": name, "type": type_, "mode": mode}
    if fields:
        d["fields"] = fields
    if description or name in _DESCRIPTIONS:
        d["description"] = description or _DESCRIPTIONS[name]
    return d


# Column comments of the created tables.
_DESCRIPTIONS = {
    "geography": "cell centre, WGS84 point",
    "geography_polygon": "cell box, WGS84 polygon",
    "creation_time": "start of the forecast cycle, UTC",
    "forecast_hours": "hours from cycle start to forecast time",
    "forecast_time": "time the forecast is for, UTC",
    "hours": "hours from cycle start to forecast time",
    "time": "time the forecast is for, UTC",
    "forecast": "forecasts of the cell, ordered by hours",
    "temperature_2m_above_ground": "air temperature 2 m above ground",
    "specific_humidity_2m_above_ground": "specific humidity 2 m above ground",
    "relative_humidity_2m_above_ground": "relative humidity 2 m above ground",
    "u_component_of_wind_10m_above_ground": "eastward wind 10 m above ground",
    "v_component_of_wind_10m_above_ground": "northward wind 10 m above ground",
    "total_precipitation_surface": "precipitation; only for forecast hours above 0",
    "precipitable_water_entire_atmosphere": "water in the whole air column",
    "total_cloud_cover_entire_atmosphere": "cloud cover; only for forecast hours above 0",
    "downward_shortwave_radiation_flux": "radiation flux; only for forecast hours above 0",
    "country": "three-letter country code",
    "year": "calendar year",
    "population": "people in the cell",
    "npp": "net primary productivity, to be scaled by 0.0001",
    "npp_qc": "quality of npp, 0 to 100",
}


# The declared load schemas (names, types and modes in table order).
FORECAST_FIELDS = (
    "temperature_2m_above_ground", "specific_humidity_2m_above_ground", "relative_humidity_2m_above_ground",
    "u_component_of_wind_10m_above_ground", "v_component_of_wind_10m_above_ground", "total_precipitation_surface",
    "precipitable_water_entire_atmosphere", "total_cloud_cover_entire_atmosphere", "downward_shortwave_radiation_flux",
)
FORECAST_STAGING = [
    _field("geography", "GEOGRAPHY"), _field("geography_polygon", "GEOGRAPHY"),
    _field("creation_time", "TIMESTAMP"), _field("forecast_hours", "INTEGER", "NULLABLE"),
    _field("forecast_time", "TIMESTAMP"),
    *[_field(n, "FLOAT", "NULLABLE") for n in FORECAST_FIELDS],
]
FORECAST_GROUPED = [
    _field("creation_time", "DATETIME"), _field("geography", "GEOGRAPHY"), _field("geography_polygon", "GEOGRAPHY"),
    _field("forecast", "RECORD", "REPEATED", [
        _field("hours", "INTEGER"), _field("time", "DATETIME"),
        *[_field(n, "FLOAT") for n in FORECAST_FIELDS],
    ]),
]
POPULATION = [
    _field("geography", "GEOGRAPHY"), _field("geography_polygon", "GEOGRAPHY"),
    _field("country", "STRING"), _field("year", "INTEGER"), _field("population", "FLOAT"),
]
PRODUCTIVITY = [
    _field("geography", "GEOGRAPHY"), _field("geography_polygon", "GEOGRAPHY"),
    _field("year", "INTEGER"), _field("npp", "INTEGER"), _field("npp_qc", "INTEGER"),
]
DECLARED = {"gfs": FORECAST_STAGING, "gfs_group": FORECAST_GROUPED, "world_pop": POPULATION,
            "annual_npp": PRODUCTIVITY}


def read_schema_json(text_or_path: str) -> list[dict]:
    """Load a declared schema from JSON text or a file path."""
    s = text_or_path.strip()
    if not s.startswith("["):
        with open(text_or_path) as fh:
            s = fh.read()
    return json.loads(s)


def to_struct(fields: list[dict]) -> T.StructType:
    """SCH-1: declared schema -> StructType, recursively.

    Defaults: type STRING, mode NULLABLE; an unknown type name raises.  A field nests only when its type is
    RECORD (any case) *and* it has a non-empty ``fields`` list.
    """
    out = []
    for f in fields:
        type_name = (f.get("type") or DEFAULT_TYPE).upper()
        mode = (f.get("mode") or DEFAULT_MODE).upper()
        if type_name in RECORD_TYPES and f.get("fields"):
            dtype: T.DataType = to_struct(f["fields"])
        else:
            if type_name not in TYPE_MAP and type_name not in RECORD_TYPES:
                raise ValueError(f"field {f['name']}: unknown type {type_name}")
            dtype = TYPE_MAP.get(type_name, T.StringType())  # a record without fields does not nest
        if mode == "REPEATED":
            dtype = T.ArrayType(dtype, containsNull=False)
        meta = {"comment": f["description"]} if f.get("description") else {}
        out.append(T.StructField(f["name"], dtype, nullable=(mode != "REQUIRED"), metadata=meta))
    return T.StructType(out)


def declared(name: str) -> T.StructType:
    return to_struct(DECLARED[name])


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SCH-5: project ``df`` onto a declared schema by name (case-insensitive):
    unknown columns are dropped, missing ones become typed nulls."""
    present = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = present.get(f.name.lower())
        c: Column = F.col(f"`{src}`").cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_declared(spark, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """SRC-3/4/5: scan files with a declared schema.  Spark relaxes NOT NULL on
    file reads, so pair this with :func:`required_violations` or
    :func:`enforce_required`."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
    return spark.read.schema(nullable).format(fmt).load(path)


def _null_elements(array: Column, field: str) -> Column:
    """Elements of the array whose ``field`` is null (0 for a null array)."""
    n = F.size(F.filter(array, lambda e: e[field].isNull()))
    return F.when(array.isNull(), F.lit(0)).otherwise(n).cast("long")


def _required_checks(schema: T.StructType, columns) -> list[tuple[str, Column, Column]]:
    """(name, column is null, nulls in the row) of every REQUIRED field: top
    level, in a record, and in the elements of a repeated record."""
    present = {c.lower(): c for c in columns}
    out = []
    for f in schema.fields:
        if f.name.lower() not in present:
            continue
        col = F.col(f"`{present[f.name.lower()]}`")
        if not f.nullable:
            out.append((f.name, f.name, col.isNull().cast("long")))
        if isinstance(f.dataType, T.StructType):
            out += [(f"{f.name}_{g.name}", f.name, (col.isNotNull() & col[g.name].isNull()).cast("long"))
                    for g in f.dataType.fields if not g.nullable]
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            for g in f.dataType.elementType.fields:
                if not g.nullable:
                    out.append((f"{f.name}_{g.name}", f.name, _null_elements(col, g.name)))
    return out


def required_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SCH-6 report: one row with the null count of every REQUIRED field, nested
    ones included (``null_record_field``), by one aggregate pass."""
    checks = _required_checks(schema, df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(n).alias(f"null_{name}") for name, _, n in checks])


def enforce_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SCH-6 enforcement inside the plan: the first null in a REQUIRED field
    fails the job (no extra pass).  Select the wanted rows *before* this: a
    filter on a checked column cannot move below the check to the scan."""
    by_column: dict[str, list[tuple[str, Column]]] = {}
    for name, column, nulls in _required_checks(schema, df.columns):
        by_column.setdefault(column.lower(), []).append((name, nulls))
    cols = []
    for c in df.columns:
        out = F.col(f"`{c}`")
        for name, nulls in by_column.get(c.lower(), []):
            out = F.when(nulls == 0, out).otherwise(F.raise_error(F.lit(f"REQUIRED column {name} is null")))
        cols.append(out.alias(c))
    return df.select(*cols)
