"""Labels and numbers as the statistics report prints them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def kilobytes(size: Column) -> Column:
    return F.concat(F.format_number(F.rint(size / F.lit(1024.0)), 0), F.lit(" KB"))


def megabytes(size: Column) -> Column:
    return F.format_string("%.1f MB", size / F.lit(1048576.0))


def quartiles(*values: Column) -> Column:
    unknown = F.lit(False)
    for v in values:
        unknown = unknown | v.isNull() | F.isnan(v)
    return F.when(unknown, "-").otherwise(F.format_string("%.1f/%.1f/%.1f/%.1f/%.1f", *values))


def kelvin(teff: Column) -> Column:
    return F.when(teff.isNull() | F.isnan(teff), "n/a").otherwise(F.concat(F.format_number(F.rint(teff), 0), F.lit(" K")))


def identifier_label(identifiers: Column) -> Column:
    """What to call a star, from a struct of its identifiers; - without any."""
    field = lambda name: identifiers[name]
    numbered = lambda prefix, name: F.when(field(name).isNotNull(), F.concat(F.lit(f"{prefix} "), field(name).cast("string")))
    place = (
        F.when(field("bayer").isNotNull(), F.concat_ws(" ", field("bayer"), field("constellation")))
        .when(field("flamsteed").isNotNull(), F.concat_ws(" ", field("flamsteed").cast("string"), field("constellation")))
        .otherwise(field("constellation"))
    )
    proper = F.when(F.trim(field("proper_name")) != "", F.trim(field("proper_name")))
    known = F.concat_ws(" | ", proper, numbered("HIP", "hip_id"), numbered("HD", "hd"), numbered("Gaia", "gaia_source_id"), place)
    source, number = F.lower(F.trim(field("source"))), F.trim(field("source_id"))
    plain = F.when(source == "gaia", F.concat(F.lit("Gaia "), number)).when(source == "hip", F.concat(F.lit("HIP "), number)).otherwise(F.concat(source, F.lit(":"), number))
    return F.when(known != "", known).otherwise(F.coalesce(plain, F.lit("-")))
