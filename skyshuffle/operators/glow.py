"""Diffuse light of cells: an extension that the format's documents only specify.

Luminosities are bolometric, by the polynomials of Torres (2010) in the logarithm of temperature; colours are those of
Helland's approximation of a black body, in linear light; masses come from surface gravity where a star has one, else
from a mass-luminosity power law by regime. Sums are additive, so parents are sums over descendants.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import UNKNOWN_TEFF
from ..functions.levels import finite
from ..functions.morton import shift_right
from .cells import KEY

SUN_MAG = 4.74
SUMS = ("n", "lum", "lum_r", "lum_g", "lum_b", "mass", "lum_teff")

#: Bolometric corrections of Torres (2010) by least log10 of temperature, constant term first.
CORRECTIONS = (
    (3.9, (-0.118115450538963e06, 0.137145973583929e06, -0.636233812100225e05, 0.147412923562646e05, -0.170587278406872e04, 0.788731721804990e02)),
    (3.7, (-0.370510203809015e05, 0.385672629965804e05, -0.150651486316025e05, 0.261724637119416e04, -0.170623810323864e03)),
    (0.0, (-0.190537291496456e05, 0.155144866764412e05, -0.421278819301717e04, 0.381476328422343e03)),
)
#: Temperatures that the corrections were fitted to; others are taken for the nearer end.
CORRECTED = (2900.0, 52_000.0)
#: Fixed values of Helland's colours, in hundreds of kelvin: scale and offset of logarithms, scale and power of powers.
GREEN_LOG, BLUE_LOG = (99.4708025861, 161.1195681661), (138.5177312231, 305.0447927307)
RED_POWER, GREEN_POWER = (329.698727446, -0.1332047592), (288.1221695283, -0.0755148492)
#: Upper ends of luminosity with the exponent of mass below them; above the last, mass is luminosity.
REGIMES = ((0.033, 2.3), (16.0, 4.0), (1e5, 3.5))
#: Sun's luminosity (erg/s), Stefan-Boltzmann constant and Sun's gravitational parameter in CGS units.
SUN_LUMINOSITY, STEFAN_BOLTZMANN, SUN_GRAVITY = 3.828e33, 5.670374419e-5, 1.3271244e26
LEAST_MASS, MOST_MASS = 0.08, 150.0


def bolometric_correction(teff: Column) -> Column:
    log = F.log10(F.least(F.greatest(teff, F.lit(CORRECTED[0])), F.lit(CORRECTED[1])))
    out = None
    for start, terms in reversed(CORRECTIONS):
        value = reduce(lambda total, term: total * log + F.lit(term), reversed(terms[:-1]), F.lit(terms[-1]))
        out = value if out is None else F.when(log >= start, value).otherwise(out)
    return out


def luminosity(mag: Column, teff: Column) -> Column:
    return F.pow(F.lit(10.0), (F.lit(SUN_MAG) - (mag + bolometric_correction(teff))) / F.lit(2.5))


def mass(lum: Column, teff: Column, log_g: Column | None = None) -> Column:
    """Solar masses from solar luminosities, or where log_g is within 0 and 9 from it; clamped to what stars have."""
    m = lum
    for end, exponent in reversed(REGIMES):
        m = F.when(lum < end, F.pow(lum, F.lit(1 / exponent))).otherwise(m)
    if log_g is not None:
        square = lum * F.lit(SUN_LUMINOSITY / (4 * 3.141592653589793 * STEFAN_BOLTZMANN)) / F.pow(teff, F.lit(4.0))
        m = F.when((log_g >= 0) & (log_g <= 9), F.pow(F.lit(10.0), log_g) * square / F.lit(SUN_GRAVITY)).otherwise(m)
    return F.least(F.greatest(m, F.lit(LEAST_MASS)), F.lit(MOST_MASS))


def linear_rgb(teff: Column) -> list[Column]:
    """Linear red, green and blue, 0 to 1, of a black body."""
    t = teff / F.lit(100.0)
    cool, log, power = t <= 66, lambda k, x: F.lit(k[0]) * F.ln(x) - F.lit(k[1]), lambda k: F.lit(k[0]) * F.pow(t - 60.0, F.lit(k[1]))
    red = F.when(cool, 255.0).otherwise(power(RED_POWER))
    green = F.when(cool, log(GREEN_LOG, t)).otherwise(power(GREEN_POWER))
    blue = F.when(t >= 66, 255.0).when(t <= 19, 0.0).otherwise(log(BLUE_LOG, t - 10.0))
    return [F.pow(F.least(F.greatest(c, F.lit(0.0)), F.lit(255.0)) / F.lit(255.0), F.lit(2.2)) for c in (red, green, blue)]


def glow_leaves(rows: DataFrame) -> DataFrame:
    """Sums of each cell's stars. Stars without a finite magnitude give no light; log_g is used if rows have it."""
    shines = F.abs(F.col("mag_abs")) < float("inf")  # not true of nan, which is above all numbers
    lit = rows.where(shines).withColumn("__t", finite(F.col("teff"), UNKNOWN_TEFF))
    lit = lit.withColumn("__l", luminosity(F.col("mag_abs"), F.col("__t")))
    r, g, b = linear_rgb(F.col("__t"))
    grams = mass(F.col("__l"), F.col("__t"), F.col("log_g") if "log_g" in rows.columns else None)
    terms = {"lum": F.col("__l"), "lum_r": F.col("__l") * r, "lum_g": F.col("__l") * g, "lum_b": F.col("__l") * b, "mass": grams, "lum_teff": F.col("__l") * F.col("__t")}
    return lit.groupBy(*KEY).agg(F.count("*").alias("n"), *(F.sum(v).alias(k) for k, v in terms.items()))


def glow_rollup(leaves: DataFrame) -> DataFrame:
    """Sums of every node: its own cell's and all descendants'. One explode, one aggregation with partial sums."""
    at = F.explode(F.sequence(F.lit(0), F.col("level"))).alias("at")
    up = leaves.select("*", at).withColumns({"node_id": shift_right(F.col("node_id"), (F.col("level") - F.col("at")) * 3)}).drop("level").withColumnRenamed("at", "level")
    return up.groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in SUMS))


def glow_means(nodes: DataFrame) -> DataFrame:
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return nodes.select(*KEY, "n", *(ratio(f"lum_{c}", "lum").alias(f"mean_{c}") for c in "rgb"), ratio("lum_teff", "lum").alias("mean_teff"), ratio("mass", "n").alias("mean_mass"))
