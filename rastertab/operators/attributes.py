"""Typing rules of the converters: band type (SCH-3), metadata attributes
(SCH-4), the printed schema string (SCH-2) and the pixel-table layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the converters' rules.
INTEGER_BAND_TYPES = ("Byte", "Int16", "UInt16", "Int32", "UInt32")
DROPPED_META_KEY = "AREA_OR_POINT"
COUNTRY_KEY = "country"
TIME_MARK = "_time"
INTEGER_MARKS = ("hours", "year")
GEOGRAPHY_FIELDS = ("geography", "geography_polygon")

# Attribute kinds -> (schema type printed by the converter, Spark type)
ATTRIBUTE_TYPES = {
    "string": ("STRING", "string"),
    "datetime": ("DATETIME", "timestamp"),
    "integer": ("INTEGER", "int"),
}


def attribute_kind(key: str) -> str | None:
    """``country`` -> string; contains ``_time`` -> datetime (wins over the
    integer marks); contains ``hours``/``year`` -> integer; other keys dropped."""
    if key == DROPPED_META_KEY:
        return None
    if key == COUNTRY_KEY:
        return "string"
    if TIME_MARK in key:
        return "datetime"
    if any(m in key for m in INTEGER_MARKS):
        return "integer"
    return None


def attribute_kind_col(key: Column) -> Column:
    """Same rule as :func:`attribute_kind`, as a SQL expression (null = dropped)."""
    return (
        F.when(key == F.lit(DROPPED_META_KEY), F.lit(None).cast("string"))
        .when(key == F.lit(COUNTRY_KEY), F.lit("string"))
        .when(key.contains(TIME_MARK), F.lit("datetime"))
        .when(key.contains(INTEGER_MARKS[0]) | key.contains(INTEGER_MARKS[1]), F.lit("integer"))
    )


def band_kind(band_type: str) -> str:
    """Band 1's data type decides for all bands: integer or float."""
    return "integer" if band_type in INTEGER_BAND_TYPES else "float"


def band_kind_col(band_type: Column) -> Column:
    return F.when(band_type.isin(*INTEGER_BAND_TYPES), F.lit("integer")).otherwise(F.lit("float"))


def band_spark_type(band_type: str) -> str:
    """Spark type of band columns.  UInt32 gets 64 bits: the converter's 32-bit
    integer overflows above 2^31 (a known defect that is not reproduced)."""
    if band_type == "UInt32":
        return "bigint"
    return "int" if band_kind(band_type) == "integer" else "double"


def band_spark_type_col(band_type: Column) -> Column:
    return (F.when(band_type == F.lit("UInt32"), F.lit("bigint"))
            .when(band_type.isin(*INTEGER_BAND_TYPES), F.lit("int"))
            .otherwise(F.lit("double")))


def band_schema_type_col(band_type: Column) -> Column:
    return F.when(band_type.isin(*INTEGER_BAND_TYPES), F.lit("INTEGER")).otherwise(F.lit("FLOAT"))


def typed_attribute(meta: Column, key: str, kind: str) -> Column:
    """Typed value of one metadata key (missing key -> null).  Integer text is
    parsed with an ANSI cast, so bad text fails like the converter."""
    raw = meta.getItem(key)
    if kind == "string":
        return raw
    if kind == "datetime":
        return F.timestamp_millis(raw.cast("bigint"))
    return raw.cast("int")


def schema_string_col(band_names: Column, band_type: Column, meta: Column) -> Column:
    """The converter's printed schema ``name:TYPE,...`` for each image row."""
    keys = F.filter(F.map_keys(meta), lambda k: attribute_kind_col(k).isNotNull())
    attrs = F.transform(keys, lambda k: F.concat(
        k, F.lit(":"),
        F.when(attribute_kind_col(k) == "string", F.lit("STRING"))
        .when(attribute_kind_col(k) == "datetime", F.lit("DATETIME"))
        .otherwise(F.lit("INTEGER"))))
    bands = F.transform(band_names, lambda b: F.concat(b, F.lit(":"), band_schema_type_col(band_type)))
    fixed = F.array(*[F.lit(f"{g}:GEOGRAPHY") for g in GEOGRAPHY_FIELDS])
    return F.array_join(F.concat(fixed, attrs, bands), ",")


@dataclass(frozen=True)
class PixelLayout:
    """Columns of a pixel table: typed attributes then one column per band.
    ``column_types`` are the bands' Spark types where they are not all that of
    ``band_type`` (layouts put together)."""

    band_names: tuple[str, ...]
    band_type: str
    attributes: tuple[tuple[str, str], ...] = field(default_factory=tuple)
    column_types: tuple[str, ...] = ()

    def band_columns(self) -> tuple[str, ...]:
        return self.column_types or (band_spark_type(self.band_type),) * len(self.band_names)

    @staticmethod
    def from_meta(band_names, band_type: str, meta_keys) -> "PixelLayout":
        attrs = tuple((k, attribute_kind(k)) for k in meta_keys if attribute_kind(k))
        return PixelLayout(tuple(band_names), band_type, attrs)

    def schema_string(self) -> str:
        parts = [f"{g}:GEOGRAPHY" for g in GEOGRAPHY_FIELDS]
        parts += [f"{k}:{ATTRIBUTE_TYPES[kind][0]}" for k, kind in self.attributes]
        btype = "INTEGER" if band_kind(self.band_type) == "integer" else "FLOAT"
        parts += [f"{b}:{btype}" for b in self.band_names]
        return ",".join(parts)

    def ddl(self) -> str:
        cols = [f"`{g}` string" for g in GEOGRAPHY_FIELDS]
        cols += [f"`{k}` {ATTRIBUTE_TYPES[kind][1]}" for k, kind in self.attributes]
        cols += [f"`{b}` {t}" for b, t in zip(self.band_names, self.band_columns())]
        return ", ".join(cols)


def _layout_columns() -> list[Column]:
    """What makes a layout: band names, band type, typed metadata keys in any
    order.  An image without metadata has no keys."""
    none = F.create_map().cast("map<string,string>")
    keys = F.filter(F.map_keys(F.coalesce("meta", none)), lambda k: attribute_kind_col(k).isNotNull())
    return [F.coalesce("band_names", F.array().cast("array<string>")).alias("_names"), F.col("band_type").alias("_type"),
            F.array_sort(keys).alias("_keys")]


def infer_layouts(images: DataFrame) -> list[PixelLayout]:
    """Distinct layouts of a tile table (or of image headers, where pixels cost
    a decode), in a stable order.  One row per layout reaches the driver: as
    many as the input has schemas, whatever its size."""
    rows = images.select(*_layout_columns()).distinct().collect()
    return [PixelLayout.from_meta(r["_names"], r["_type"], r["_keys"])
            for r in sorted(rows, key=lambda r: (list(r["_names"]), str(r["_type"]), list(r["_keys"])))]


def of_layout(tiles: DataFrame, layout: PixelLayout) -> DataFrame:
    """The tiles that have this layout."""
    wanted = F.struct(F.array(*[F.lit(n) for n in layout.band_names]).cast("array<string>").alias("_names"), F.lit(layout.band_type).alias("_type"),
                      F.array(*[F.lit(k) for k, _ in layout.attributes]).cast("array<string>").alias("_keys"))
    return tiles.where(F.struct(*_layout_columns()).eqNullSafe(wanted))


# Fixed order: of two band types the later holds the values of both.
WIDER = ("int", "bigint", "double")


def joint_layout(layouts: list[PixelLayout]) -> PixelLayout:
    """One layout with the columns of all: attributes by name, bands by name in
    order of first appearance, a band of several types with the widest."""
    attributes = {k: kind for one in layouts for k, kind in one.attributes}
    types: dict[str, str] = {}
    for one in layouts:
        for name, kind in zip(one.band_names, one.band_columns()):
            types[name] = max(types.get(name, kind), kind, key=WIDER.index)
    return PixelLayout(tuple(types), layouts[0].band_type, tuple(sorted(attributes.items())), tuple(types.values()))


def aligned_bands(tiles: DataFrame, layout: PixelLayout) -> DataFrame:
    """Tiles whose ``bands`` stand in the order of a joint layout; a band that
    an image lacks is an empty list, which the expansion fills with nulls."""
    empty = F.array().cast("array<double>")

    def band(name: str) -> Column:
        at = F.array_position("band_names", F.lit(name))
        return F.coalesce(F.get("bands", F.when(at > 0, at - 1).cast("int")), empty)

    return tiles.withColumn("bands", F.array(*[band(n) for n in layout.band_names]).cast("array<array<double>>"))


def infer_layout(tiles: DataFrame) -> PixelLayout:
    """The one layout of ``tiles``; raises when there are several (see
    ``plans.jobs.convert_tiles`` for folders with several)."""
    layouts = infer_layouts(tiles)
    if len(layouts) != 1:
        raise ValueError(f"expected one raster layout, found {len(layouts)}; pass a layout explicitly")
    return layouts[0]
