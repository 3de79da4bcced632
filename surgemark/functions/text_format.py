"""Human-readable numbers and labels used by the report views."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels and unit steps shown to users.
SEVERITY_LABELS = {"critical": "CRITICAL", "warn": "WARNING", "info": "INFO"}
DIM_LABELS = {
    "domain": "wiki",
    "lang": "language",
    "kind": "type",
    "namespace": "namespace",
    "user_type": "actor",
}
BYTE_UNITS = ("B", "KB", "MB", "GB")
MISSING = "—"


def fixed(c: Column, digits: int) -> Column:
    """Plain decimal text with a fixed number of places, no thousands separator.

    Halves round away from zero on the decimal text of the double.
    """
    return c.cast(f"decimal(38,{max(digits, 0) + 8})").cast(f"decimal(30,{digits})").cast("string")


def compact(c: Column, digits: int = 1) -> Column:
    a = F.abs(c)
    bad = c.isNull() | F.isnan(c) | (a == F.lit(float("inf")))
    return (
        F.when(bad, F.lit(MISSING))
        .when(a >= 1_000_000, F.concat(fixed(c / 1_000_000, digits), F.lit("M")))
        .when(a >= 1_000, F.concat(fixed(c / 1_000, digits), F.lit("k")))
        .when(a >= 10, fixed(c, 0))
        .otherwise(fixed(c, digits))
    )


def integer(c: Column) -> Column:
    return F.format_number(F.floor(c + F.lit(0.5)), 0)


def pct(c: Column, digits: int = 0) -> Column:
    return F.concat(fixed(c * 100, digits), F.lit("%"))


def byte_rate(c: Column) -> Column:
    a = F.abs(c)
    step = (
        F.when(a < 1024.0, 0).when(a < 1024.0 ** 2, 1).when(a < 1024.0 ** 3, 2).otherwise(3)
    )
    v = a / F.pow(F.lit(1024.0), step)
    number = F.when((v < 10) & (step > 0), fixed(v, 1)).otherwise(fixed(v, 0))
    unit = F.element_at(F.array(*[F.lit(u) for u in BYTE_UNITS]), step + 1)
    return F.concat(number, F.lit(" "), unit, F.lit("/s"))


def clock(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(F.floor(seconds)), "HH:mm:ss")


def age(seconds: Column, now: Column) -> Column:
    s = F.greatest(F.lit(0), F.floor(now - seconds + F.lit(0.5))).cast("long")
    return (
        F.when(s < 60, F.concat(s.cast("string"), F.lit("s ago")))
        .when(s < 3600, F.concat(F.floor(s / 60).cast("string"), F.lit("m ago")))
        .otherwise(F.concat(F.floor(s / 3600).cast("string"), F.lit("h ago")))
    )


def severity_label(c: Column) -> Column:
    return (
        F.when(c == "critical", SEVERITY_LABELS["critical"])
        .when(c == "warn", SEVERITY_LABELS["warn"])
        .otherwise(SEVERITY_LABELS["info"])
    )


def dim_label(c: Column) -> Column:
    out = c
    for dim, label in DIM_LABELS.items():
        out = F.when(c == dim, F.lit(label)).otherwise(out)
    return out
