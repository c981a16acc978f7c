"""Column expressions shared by the jobs; all stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarcube.schemas import MONEY


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def pick(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select ``names`` in order, each renamed to its value."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


# --- dates -------------------------------------------------------------------


def date_key(day: Column) -> Column:
    """Integer key yyyymmdd; NULL for a NULL date."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def key_year(key: Column) -> Column:
    return F.floor(key / 10000).cast("int")


def key_month(key: Column) -> Column:
    return F.floor(F.pmod(key, F.lit(10000)) / 100).cast("int")


def key_day(key: Column) -> Column:
    return F.pmod(key, F.lit(100)).cast("int")


def key_date(key: Column) -> Column:
    return F.make_date(key_year(key), key_month(key), key_day(key))


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def lenient_date(value: Column) -> Column:
    """The date in ``value``, or NULL where it cannot be read as one."""
    return value.try_cast("date")


# --- business rules ----------------------------------------------------------

# The customer type labels.
BOTH, TRAVEL, POSTAL, UNCLASSIFIED = "Ca hai", "Du lich", "Buu dien", "Khong phan loai"


def customer_type(guide: Column, address: Column) -> Column:
    """A subtype counts only when its attribute value is present."""
    travels, by_post = guide.isNotNull(), address.isNotNull()
    return (
        F.when(travels & by_post, BOTH).when(travels, TRAVEL).when(by_post, POSTAL).otherwise(UNCLASSIFIED)
    )


def line_revenue(quantity: Column, price: Column) -> Column:
    return (quantity * price.cast(MONEY)).cast(MONEY)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.withColumns({name: F.nanvl(F.col(name), F.lit(None).cast("double")) for name in floats})
