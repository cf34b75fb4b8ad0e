"""Scalar column functions (JVM-side expressions, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# S1 -------------------------------------------------------------------------
# The wire format of telemetry messages.
TELEMETRY_SCHEMA = StructType([
    StructField("timestamp", LongType(), False),
    StructField("id", StringType(), False),
    StructField("antenna_id", StringType(), False),
    StructField("bytes", LongType(), False),
    StructField("app", StringType(), False),
])


def parse_json_value(value: ColumnOrName, schema: StructType = TELEMETRY_SCHEMA) -> Column:
    """binary/string Kafka value -> struct; junk gives a struct of nulls."""
    return F.from_json(_c(value).cast("string"), schema)


# S2 -------------------------------------------------------------------------
def epoch_to_timestamp(col: ColumnOrName) -> Column:
    return F.timestamp_seconds(_c(col))


# S3 -------------------------------------------------------------------------
def partition_fields(ts: ColumnOrName) -> list[Column]:
    t = _c(ts)
    return [F.year(t).alias("year"), F.month(t).alias("month"),
            F.dayofmonth(t).alias("day"), F.hour(t).alias("hour")]


# S4 -------------------------------------------------------------------------
def years_until(col: ColumnOrName, year: int = 2020) -> Column:
    """``year - year(yyyy-MM-dd)``; unparsable text gives null (ANSI-safe)."""
    return F.lit(year) - F.year(F.try_to_timestamp(_c(col), F.lit("yyyy-MM-dd")))


# S5 -------------------------------------------------------------------------
def list_size(col: ColumnOrName, null_as: int = 0, sep: str = ",") -> Column:
    """Items in a separated list; a null list counts ``null_as`` (0 for
    amenities / verifications, 1 for features: ``str(nan)`` has no comma)."""
    return F.coalesce(F.size(F.split(_c(col), sep)), F.lit(null_as))


# S7 -------------------------------------------------------------------------
# Postcode repairs of the listing data (missing or doubled digit).
POSTCODE_FIXES = {"2804": "28004", "2805": "28005", "2815": "28015", "280013": "28013"}
POSTCODE_FIXES_VARIANT = {**POSTCODE_FIXES, "2015": "28015"}


def clean_postcode(col: ColumnOrName, fixes: dict | None = None) -> Column:
    """First line, digits only, known repairs, then keep ``28ddd`` else null."""
    fixes = POSTCODE_FIXES if fixes is None else fixes
    first = F.substring_index(_c(col), "\n", 1)
    digits = F.regexp_replace(first, "[^0-9]", "")
    fixed = digits
    if fixes:
        expr = None
        for bad, good in fixes.items():
            expr = (F.when(digits == bad, F.lit(good)) if expr is None
                    else expr.when(digits == bad, F.lit(good)))
        fixed = expr.otherwise(digits)
    return F.when(fixed.rlike("^28[0-9]{3}$"), fixed)


# S8 -------------------------------------------------------------------------
def round2(col: ColumnOrName) -> Column:
    return F.round(_c(col), 2)


# S21 ------------------------------------------------------------------------
def sentiment_label(stars: ColumnOrName, cut: float = 3) -> Column:
    """stars < 3 -> 0 else 1; a missing rating stays null."""
    s = _c(stars)
    return F.when(s < cut, F.lit(0)).when(s.isNotNull(), F.lit(1))


# S22 ------------------------------------------------------------------------
def price_band(price: ColumnOrName, edges=(30.0, 75.0),
               labels=("cheap", "affordable", "expensive")) -> Column:
    """Contiguous bands: x <= e1 -> labels[0], e1 < x <= e2 -> labels[1], ..."""
    p = _c(price)
    expr = F.when(p <= edges[0], F.lit(labels[0]))
    for e, lab in zip(edges[1:], labels[1:-1]):
        expr = expr.when(p <= e, F.lit(lab))
    return expr.when(p.isNotNull(), F.lit(labels[-1]))


# S23 ------------------------------------------------------------------------
def poisson_pmf(k: ColumnOrName, lam: ColumnOrName) -> Column:
    kk, ll = _c(k), _c(lam)
    return F.exp(-ll) * F.pow(ll, kk) / F.factorial(kk.cast("int"))


# S24 ------------------------------------------------------------------------
def dot(u: ColumnOrName, v: ColumnOrName) -> Column:
    return F.aggregate(F.zip_with(_c(u), _c(v), lambda a, b: a * b),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(u: ColumnOrName) -> Column:
    return F.sqrt(dot(u, u))


def cosine(u: ColumnOrName, v: ColumnOrName) -> Column:
    return dot(u, v) / (norm(u) * norm(v))


def sq_distance(u: ColumnOrName, v: ColumnOrName) -> Column:
    return F.aggregate(F.zip_with(_c(u), _c(v), lambda a, b: (a - b) * (a - b)),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)
