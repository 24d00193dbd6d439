"""Column names, schemas and other fixed values of the readings and of the results."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and formats that files and results must carry exactly.

# Readings, by name in Parquet and in this order in CSV.
TIME = "datetime_utc"
ZONE = "zone_id"
CI = "carbon_intensity_gco2eq_per_kwh_direct"
CFE = "carbon_free_energy_percentage_cfe"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
MONTH_FORMAT = "yyyy-MM"

# Results.
COUNTRY = "country"
YEAR = "year"
MONTH = "month"
YEAR_MONTH = "year_month"
DAY_OF_YEAR = "day_of_year"
AVG_CI = "avg_carbon_intensity_gco2eq_per_kwh_direct"
AVG_CFE = "avg_carbon_free_energy_percentage_cfe"
HOME_ZONE = "IT"
TOP_K = 5

# Time-series points.
RESULT_MEASUREMENT = "result"
RUN_TIME_MEASUREMENT = "time"
RUN_TIME_FIELD = "duration"
APP_TAG = "app"
FIELD_NAMES = {
    "avg_carbon_intensity_gco2eq_per_kwh_direct": "avg_ci_gco2eq_per_kwh",
    "min_carbon_intensity_gco2eq_per_kwh_direct": "min_ci_gco2eq_per_kwh",
    "max_carbon_intensity_gco2eq_per_kwh_direct": "max_ci_gco2eq_per_kwh",
    "avg_carbon_free_energy_percentage_cfe": "avg_cfe_percentage",
    "min_carbon_free_energy_percentage_cfe": "min_cfe_percentage",
    "max_carbon_free_energy_percentage_cfe": "max_cfe_percentage",
}

# Folders of the monthly report, one per ranking beside the averages.
AVERAGES_FOLDER = "plot.csv"
RANKING_FOLDERS = {
    "ci_desc": "top-ci-desc.csv",
    "ci_asc": "top-ci-asc.csv",
    "cfe_desc": "top-cfe-desc.csv",
    "cfe_asc": "top-cfe-asc.csv",
}

# End of the fixed values.

METRICS = (CI, CFE)
READING_COLUMNS = (TIME, ZONE, CI, CFE)

READINGS = T.StructType(
    [
        T.StructField(TIME, T.StringType()),
        T.StructField(ZONE, T.StringType()),
        T.StructField(CI, T.DoubleType()),
        T.StructField(CFE, T.DoubleType()),
    ]
)

POINTS = T.StructType(
    [
        T.StructField("measurement", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("fields", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("int_fields", T.MapType(T.StringType(), T.LongType())),
        T.StructField("time_ms", T.LongType()),
    ]
)
