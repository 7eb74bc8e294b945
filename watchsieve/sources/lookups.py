"""Lookup tables: from files or tables where a path or frame is given, else the built-in values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tables


def entity_types(spark: SparkSession, rows: Iterable[tuple[str, str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame(list(rows or tables.ENTITY_TYPES), "Abbreviation string, ExpandedForm string, Position string")


def abbreviations(spark: SparkSession, path: str | None = None) -> list[tuple[str, str, int]]:
    """Address abbreviations from a CSV file with the columns Address_Part_Abbreviation, Address_Part and Skip_At_Beginning; always with # for Number."""
    if path is None:
        return list(tables.ADDRESS_ABBREVIATIONS)
    rows = spark.read.csv(path, header=True).select("Address_Part_Abbreviation", "Address_Part", F.col("Skip_At_Beginning").cast("int")).orderBy("Skip_At_Beginning").limit(10_000).collect()
    return [("#", "Number", 0), *((r[0], r[1], r[2] or 0) for r in rows if r[0] != "#")]


def weights(spark: SparkSession, df: DataFrame | None = None) -> dict[str, float]:
    """The built-in weights, with what a table (Weight_Key, Weight_Value) says instead."""
    given = {} if df is None else {r.Weight_Key: float(r.Weight_Value) for r in df.limit(1000).collect() if r.Weight_Value is not None}
    return {k: float(given.get(k, v)) for k, v in tables.WEIGHTS.items()}


def weights_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in tables.WEIGHTS.items()], "Weight_Key string, Weight_Value double").withColumn("Weight_Value", F.col("Weight_Value").cast("decimal(7,2)"))


def street_types(spark: SparkSession) -> DataFrame:
    rows = [(tables.FIRST_STREET_ID + k, "JaroWinkler", " + ".join(f"Address{i}" for i in order)) for k, order in enumerate(tables.STREET_ORDERS)]
    return spark.createDataFrame([*rows, (tables.NO_STREET_ID, "JaroWinkler", "No Match")], "ID smallint, Method string, StreetAddressMatchType string")


def dates(spark: SparkSession, first: str = "1700-01-01", last: str = "2075-12-31") -> DataFrame:
    """A row for each day. Weeks begin on Sunday, and the first has January 1."""
    d = F.col("Date")
    leap = (F.year(d) % 400 == 0) | ((F.year(d) % 4 == 0) & (F.year(d) % 100 != 0))
    year = F.trunc(d, "year")
    days = spark.range(1).select(F.explode(F.expr(f"sequence(date'{first}', date'{last}', interval 1 day)")).alias("Date"))
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("DateKey"), d, F.year(d).alias("Year"), F.month(d).alias("Month"), F.day(d).alias("Day"), F.quarter(d).alias("Quarter"), F.date_format(d, "MMMM").alias("Month_Name"), F.date_format(d, "EEEE").alias("Day_Name"),
        F.dayofyear(d).alias("Day_Of_Year"), (F.floor((F.dayofyear(d) + F.dayofweek(year) - 2) / 7) + 1).cast("int").alias("Week_Of_Year"), F.dayofweek(d).isin(1, 7).cast("int").alias("Is_Weekend"), leap.cast("int").alias("Is_Leap_Year"),
        F.date_format(d, "yyyyMM").alias("YYYYMM"), F.trunc(d, "month").alias("First_Of_Month"), F.last_day(d).alias("Last_Of_Month"), F.trunc(d, "quarter").alias("First_Of_Quarter"), year.alias("First_Of_Year"),
    )


def jurisdictions(spark: SparkSession, children: DataFrame | None = None) -> DataFrame:
    """Countries by the JVM's list of ISO codes, and below them states, provinces and territories (or children: Jurisdiction, Abbreviation, Juris_Type, Parent, FIPS), with the parent's id."""
    locale = spark.sparkContext._jvm.java.util.Locale
    codes = list(locale.getISOCountries())
    top = spark.createDataFrame([(locale("", c).getDisplayCountry(locale.ENGLISH), c, "Country", c) for c in codes], "Jurisdiction string, Abbreviation string, Juris_Type string, ISO2 string")
    if children is None:
        children = spark.createDataFrame(tables.child_jurisdictions(), "Jurisdiction string, Abbreviation string, Juris_Type string, Parent string, FIPS string")
    from pyspark.sql import Window

    top = top.withColumn("ID", F.row_number().over(Window.orderBy("Jurisdiction")))  # some 250 rows
    n = len(codes)
    low = children.join(F.broadcast(top.select(F.col("Jurisdiction").alias("Parent"), F.col("ID").alias("Parent_ID"))), "Parent", "left").withColumn("ID", F.lit(n) + F.row_number().over(Window.orderBy("Parent", "Jurisdiction")))
    columns = ["ID", "Jurisdiction", "Abbreviation", "Juris_Type", "Parent_ID", "ISO2", "FIPS"]
    return top.withColumn("Parent_ID", F.lit(None).cast("int")).withColumn("FIPS", F.lit(None).cast("string")).select(*columns).unionByName(low.withColumn("ISO2", F.lit(None).cast("string")).select(*columns))


def add_missing(seed: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The rows of seed whose key table does not have: what an idempotent load appends."""
    return seed.join(table.select(key), key, "left_anti")
