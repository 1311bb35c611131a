"""Star catalogues: Parquet folders of HEALPix pixels, and one derived from the driver's orders table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import IDENTIFIER_FIELDS, INTEGER_FIELDS, UNKNOWN_TEFF

REQUIRED = ("x_icrs_pc", "y_icrs_pc", "z_icrs_pc", "mag_abs")
DERIVED = ("morton_code", "render", "level")
CELL_COLUMNS = ("render", "level", "morton_code", "mag_abs", "source", "source_id")


def require(df: DataFrame, columns: tuple[str, ...], what: str) -> DataFrame:
    """df, if it has the columns; the missing ones are named before any data is read."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks column(s): {', '.join(missing)}")
    return df


def signed(df: DataFrame) -> DataFrame:
    """Unsigned 64-bit columns, which Spark reads as decimal(20,0), as longs."""
    wide = [f.name for f in df.schema.fields if f.dataType == T.DecimalType(20, 0)]
    return df.withColumns({c: F.col(c).cast("long") for c in wide}) if wide else df


def read_pixels(spark: SparkSession, root: str) -> DataFrame:
    """All Parquet files of {root}/{pixel}/, with the folder's name as column pixel. Extra columns pass through."""
    df = signed(spark.read.parquet(f"{root.rstrip('/')}/*/"))
    return require(df.withColumn("pixel", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)), REQUIRED, "The catalogue")


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """Enriched stars below a folder, at any depth, whose file names fit; /**/ in a pattern stands for any folders.

    What follows /**/ is a pattern of file names alone (x*.parquet); a pattern without /**/ is Hadoop's.
    """
    root, deep, names = path.partition("/**")
    names = names.strip("/") or "*.parquet"
    if "/" in names:
        raise ValueError(f"Only a pattern of file names may follow /**/: {path}")
    reader = spark.read.option("pathGlobFilter", names if deep else "*.parquet")
    df = signed((reader if not deep and any(c in root for c in "*?[{") else reader.option("recursiveFileLookup", "true")).parquet(root))
    return require(df, CELL_COLUMNS, "The enriched catalogue")


def default_teff(df: DataFrame) -> DataFrame:
    """df with a temperature column: the default where the catalogue has none."""
    return df if "teff" in df.columns else df.withColumn("teff", F.lit(UNKNOWN_TEFF))


def read_identifiers(spark: SparkSession, path: str, fields: tuple[str, ...] | None = None) -> DataFrame:
    """The identifier map, in file and row order (column row), with the asked fields only."""
    unknown = sorted(set(fields or ()) - set(IDENTIFIER_FIELDS))
    if unknown:
        raise ValueError(f"Unknown identifier field(s): {', '.join(unknown)}")
    df = require(signed(spark.read.parquet(path)), ("source", "source_id"), "The identifier map")
    kept = [c for c in IDENTIFIER_FIELDS if c in (IDENTIFIER_FIELDS if fields is None else fields) and c in df.columns]
    order = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("row")
    return df.select(F.col("source").cast("string"), F.col("source_id").cast("string"), *kept, order)


def derive_stars(orders: DataFrame) -> DataFrame:
    """A catalogue made from order keys by integer arithmetic and division by powers of two, alike on every engine."""
    n = "o_orderkey"
    axis = lambda by, mod, off: f"cast(({n} * {by}) % {mod} - {off} as double) / cast(shiftleft(1L, cast({n} % 12 as int)) as double)"
    return orders.selectExpr(
        f"case {n} % 10 when 0 then 'hip' when 1 then 'manual' else 'gaia' end as source",
        f"cast({n} as string) as source_id",
        f"{axis(7919, 20011, 10005)} as x_icrs_pc",
        f"{axis(104729, 20021, 10010)} as y_icrs_pc",
        f"{axis(1299709, 20023, 10011)} as z_icrs_pc",
        f"case when {n} % 97 = 0 then null else cast(({n} * 48271) % 2801 - 1600 as double) / 100D end as mag_abs",
        f"case when {n} % 17 = 0 then null else cast(1500 + ({n} * 69621) % 52000 as double) end as teff",
    )


def derive_identifiers(orders: DataFrame) -> DataFrame:
    """An identifier map for a third of the derived stars; some proper names are blank."""
    n = "o_orderkey"
    return orders.where(f"{n} % 3 = 0").selectExpr(
        f"case {n} % 10 when 0 then 'hip' when 1 then 'manual' else 'gaia' end as source",
        f"cast({n} as string) as source_id",
        "cast(null as bigint) as gaia_source_id",
        f"case when {n} % 10 = 0 then {n} end as hip_id",
        f"case when {n} % 6 = 0 then {n} + 100000 end as hd",
        "cast(null as string) as bayer",
        "cast(null as bigint) as flamsteed",
        "o_orderpriority as constellation",
        f"case when {n} % 30 = 0 then concat('Star ', cast({n} as string)) when {n} % 15 = 0 then '  ' end as proper_name",
        f"{n} as row",
    )


__all__ = ["CELL_COLUMNS", "DERIVED", "INTEGER_FIELDS", "REQUIRED", "default_teff", "derive_identifiers", "derive_stars", "read_enriched", "read_identifiers", "read_pixels", "require", "signed"]
