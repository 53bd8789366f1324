"""Holiday calendar and its join to sale lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import strip

# Sales country -> calendar country.
COUNTRY_ALIASES = {
    "Czech Republic": "Czech",
    "EIRE": "Ireland",
    "RSA": "South Africa",
    "USA": "United States",
}
NO_HOLIDAY = "Non-holiday"
UNKNOWN_HOLIDAY = "Unknown Holiday"


def normalize_names(df: DataFrame, underscore: bool = False) -> DataFrame:
    names = [c.lower().strip() for c in df.columns]
    return df.toDF(*[n.replace(" ", "_") for n in names] if underscore else names)


def title_case(col: Column | str) -> Column:
    """Each run of letters with its first letter in upper case, the rest lower."""
    pieces = F.regexp_extract_all(F.lower(strip(col)), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(pieces, F.initcap), "")


def _calendar_flags(days: DataFrame) -> DataFrame:
    d = F.col("date")
    return days.withColumns({
        "day_of_week": F.weekday(d),
        "month": F.month(d),
        "is_weekend": F.weekday(d) >= 5,
        "month_end": F.last_day(d) == F.to_date(d),
        "month_start": F.dayofmonth(d) == 1,
    })


def holiday_calendar(holidays: DataFrame) -> DataFrame:
    """One row per (date, country) with weekday, month and month-edge flags."""
    days = (
        normalize_names(holidays)
        .dropna(subset=["date", "countryorregion"])
        .groupBy("date", "countryorregion")
        .agg(F.min("holidayname").alias("holidayname"))
    )
    return _calendar_flags(days).select(
        F.to_date("date").alias("date"),
        "countryorregion",
        strip(F.coalesce("holidayname", F.lit(UNKNOWN_HOLIDAY))).alias("holidayname"),
        "day_of_week", "month", "is_weekend", "month_end", "month_start",
        F.lit(1).alias("isholiday"),
    )


def holiday_calendar_by_name(holidays: DataFrame) -> DataFrame:
    """Variant that keeps every name of a day, in title case; a nameless day is no holiday."""
    days = (
        normalize_names(holidays, underscore=True)
        .select("date", "countryorregion", "holidayname")
        .dropna(subset=["date", "countryorregion"])
        .distinct()
    )
    return _calendar_flags(days).select(
        F.to_date("date").alias("date"),
        title_case("countryorregion").alias("countryorregion"),
        title_case("holidayname").alias("holidayname"),
        "day_of_week", "month", "is_weekend", "month_end", "month_start",
        F.col("holidayname").isNotNull().cast("int").alias("isholiday"),
    )


def alias_country(col: Column | str, aliases: Mapping[str, str] = COUNTRY_ALIASES) -> Column:
    name = strip(col)
    if not aliases:
        return name
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(aliases.items())])
    return F.coalesce(F.try_element_at(lookup, name), name)


def repeated_keys(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise unless ``keys`` identify a row, which makes a join on them many-to-one."""
    if not repeated_keys(df, keys).isEmpty():
        raise ValueError(f"join keys are not unique: {', '.join(keys)}")
    return df


def add_holidays(
    sales: DataFrame,
    calendar: DataFrame,
    aliases: Mapping[str, str] = COUNTRY_ALIASES,
    validate: bool = True,
) -> DataFrame:
    """Left join on (date, aliased country); fill gaps; add the quantity sold on holidays.

    No join hint: a calendar that is small is broadcast by its measured size, a
    large one is sort-merged with skewed dates split.
    """
    if validate:
        require_unique(calendar, ["date", "countryorregion"])
    days = calendar.select(
        F.col("date").alias("holiday_date"), F.col("countryorregion").alias("holiday_country"), "holidayname", "isholiday"
    )
    dated = sales.withColumn("InvoiceDate", F.to_date("InvoiceDate"))
    joined = dated.join(
        days,
        (F.col("InvoiceDate") == F.col("holiday_date")) & (alias_country("Country", aliases) == F.col("holiday_country")),
        "left",
    ).drop("holiday_date", "holiday_country")
    joined = joined.fillna({"isholiday": 0, "holidayname": NO_HOLIDAY})
    sold = F.when(F.col("isholiday") == 1, F.col("Quantity")).otherwise(F.lit(0)).cast(
        sales.schema["Quantity"].dataType
    )
    return joined.withColumn("HolidayQuantity", sold)
