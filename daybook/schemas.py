"""Explicit schemas of the reference's datasets and stage outputs."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampType)

CASE_RECORD = StructType([
    StructField("report_time", StringType()),
    StructField("state", StringType()),
    StructField("confirmed_india", LongType()),
    StructField("confirmed_foreign", LongType()),
    StructField("cured", LongType()),
    StructField("death", LongType()),
    StructField("confirmed", LongType()),
])

REGION_CODES = StructType([
    StructField("Subdivision category", StringType()),
    StructField("3166-2 code", StringType()),
    StructField("Subdivision name", StringType()),
])

CITY_REGION = StructType([
    StructField("Name of City", StringType()),
    StructField("State", StringType()),
])

AIR_QUALITY = StructType([
    StructField("location", StringType()),
    StructField("city", StringType()),
    StructField("country", StringType()),
    StructField("pollutant", StringType()),
    StructField("value", DoubleType()),
    StructField("timestamp", TimestampType()),
    StructField("unit", StringType()),
    StructField("source_name", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("averaged_over_in_hours", DoubleType()),
    StructField("location_geom", StringType()),
])

INDEX_CLOSES = StructType([
    StructField("Date", StringType()),
    StructField("Open", StringType()),
    StructField("High", StringType()),
    StructField("Low", StringType()),
    StructField("Close", StringType()),
])

REPORT_CELLS = StructType([
    StructField("file_name", StringType()),
    StructField("doc_index", IntegerType()),
    StructField("table_index", IntegerType()),
    StructField("row_index", IntegerType()),
    StructField("cells", ArrayType(StringType())),
])

#: The eight dose measures of the vaccination table, in output order.
DOSE_MEASURES = [
    "dose_1", "dose_2", "15_18_years_dose_1", "15_18_years_dose_2",
    "12_14_years_dose_1", "12_14_years_dose_2", "precaution_dose", "total_doses",
]

#: The six pollutants, in output order.
POLLUTANTS = ["co", "no2", "o3", "pm10", "pm25", "so2"]

#: The case measures carried into the region table.
CASE_MEASURES = ["cured", "death", "confirmed"]

VACCINATION_REGION = StructType(
    [StructField("day", DateType()), StructField("region", StringType())]
    + [StructField(m, LongType()) for m in DOSE_MEASURES])
