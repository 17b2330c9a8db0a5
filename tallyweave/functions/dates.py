"""Year and month of a review, from ISO date strings or from dates and timestamps."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def year_text(df: DataFrame, name: str = "date") -> Column:
    """Four-digit year as text."""
    return F.substring(name, 1, 4) if _is_text(df, name) else F.date_format(name, "yyyy")


def month_text(df: DataFrame, name: str = "date") -> Column:
    """Two-digit month as text, so months of different years merge."""
    return F.substring(name, 6, 2) if _is_text(df, name) else F.date_format(name, "MM")


def year_number(df: DataFrame, name: str = "date") -> Column:
    """Year as int; null where a text date does not start with a number."""
    return year_text(df, name).try_cast("int") if _is_text(df, name) else F.year(name)
