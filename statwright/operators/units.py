"""Table-driven unit conversion and measurement text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sizes import broadcast_if_small

# Name, short name, scale to base, offset to base, other labels.
LENGTH_UNITS = [
    ("meters", "m", 1.0, 0.0, "meter"),
    ("feet", "ft", 0.30478512648, 0.0, "foot"),
    ("inches", "in", 0.02539876054, 0.0, "inch"),
    ("kilometers", "km", 1000.0, 0.0, "kilometer"),
]
UNIT_SCHEMA = "name string, shorthand string, scale double, offset double, aliases string"


def length_units(spark) -> DataFrame:
    return spark.createDataFrame(LENGTH_UNITS, UNIT_SCHEMA)


def unit_labels(units: DataFrame) -> DataFrame:
    """One row per label a unit answers to."""
    more = F.transform(F.split(F.coalesce("aliases", F.lit("")), ";"), lambda a: F.trim(a))
    labels = F.array_distinct(F.concat(F.array("name", "shorthand"), F.filter(more, lambda a: a != "")))
    return units.select(F.explode(labels).alias("label"), "shorthand", "scale", "offset")


def to_base(value: Column, scale: Column, offset: Column) -> Column:
    return scale * value + offset


def from_base(value: Column, scale: Column, offset: Column) -> Column:
    return F.try_divide(F.lit(1.0), scale) * value - offset


def convert(df: DataFrame, value: str, unit: str, target: str, units: DataFrame,
            output: str = "converted") -> DataFrame:
    """Convert ``value`` (measured in the unit named by column ``unit``) to the
    unit ``target``; an unknown unit gives NULL."""
    labels = broadcast_if_small(unit_labels(units))
    goal = units.sparkSession.createDataFrame([(target,)], "label string")
    found = unit_labels(units).join(goal, "label").first()
    if found is None:
        raise ValueError(f"unknown unit {target}")
    base = to_base(F.col(value), F.col("scale"), F.col("offset"))
    return (df.join(labels, df[unit] == labels["label"], "left")
              .withColumn(output, from_base(base, F.lit(found.scale), F.lit(found.offset)))
              .drop("label", "shorthand", "scale", "offset"))


def parse_measurement(cell: Column) -> Column:
    """Struct (value, unit) of ``"730.3 ft"``; NULL unless it has two parts."""
    part = F.split(F.trim(cell), r"\s+")
    good = F.size(part) == 2
    return F.struct(F.when(good, F.get(part, F.lit(0)).try_cast("double")).alias("value"),
                    F.when(good, F.get(part, F.lit(1))).alias("unit"))


def add_measurements(df: DataFrame, left: str, right: str, units: DataFrame, sign: int = 1,
                     output: str = "total") -> DataFrame:
    """Text of left + right (``sign`` -1: difference) in the base unit, which is
    the first of the table."""
    labels = broadcast_if_small(unit_labels(units))
    base = units.first().shorthand
    out = df.withColumns({"_l": parse_measurement(F.col(left)), "_r": parse_measurement(F.col(right))})
    for side in ("_l", "_r"):
        known = labels.select(F.col("label").alias(f"{side}_label"), F.col("scale").alias(f"{side}_s"),
                              F.col("offset").alias(f"{side}_o"))
        out = out.join(broadcast_if_small(known), F.col(f"{side}.unit") == F.col(f"{side}_label"), "left")
    amount = (to_base(F.col("_l.value"), F.col("_l_s"), F.col("_l_o"))
              + sign * to_base(F.col("_r.value"), F.col("_r_s"), F.col("_r_o")))
    return out.select(*df.columns, amount.alias(output), F.lit(base).alias("unit"))
