"""Registered queries and the SQL they are checked against.

The tables hold no energy readings, so a fixed mapping makes them: a line item is a reading, the
nation of its supplier the zone, the price the carbon intensity, the discount the carbon-free share.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from functools import reduce
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import gridstats as gs
from gridstats.schema import (
    AVERAGES_FOLDER,
    CFE,
    CI,
    METRICS,
    RANKING_FOLDERS,
    READINGS,
    TIME,
    YEAR_MONTH,
    ZONE,
)
from gridstats.shared import new_folder

HOME = "NATION_15"
APP = "gridstats"
AVG_CI, AVG_CFE = f"avg_{CI}", f"avg_{CFE}"

LINES = ("l_suppkey", "l_shipdate", "l_extendedprice", "l_discount")


def optional(name: str) -> ModuleType | None:
    """A module of this repository that may have been taken out."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if not any(missing.name == gone or (missing.name or "").startswith(f"{gone}.") for gone in (name, "gridstats.llm")):
            raise
        return None


llm = optional("gridstats.llm.queries")
pipeline = optional("corpus_pipeline")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No broadcast hint: suppliers grow with the data, so Spark decides by size. Supplier first: Spark
    # takes the product of both sizes for a join, and would rather broadcast the line items than that.
    lineitem = gs.read_readings(spark, f"{sf_dir}/lineitem.parquet", columns=LINES)
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    supplied = lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
    return supplied.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("l_shipdate").cast("string").alias(TIME),
        F.col("n_name").alias(ZONE),
        F.col("l_extendedprice").alias(CI),
        (F.col("l_discount") * 100).alias(CFE),
    )


def csv_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings written as headerless CSV and read through the source."""
    path = new_folder(spark, "readings")
    gs.write_csv(readings(spark, sf_dir), path, header=False)
    return gs.read_readings(spark, path, "csv")


def steady(df: DataFrame, prefix: str = "avg_", digits: int = 8) -> DataFrame:
    """Averages without their last bits, which depend on the order of summation: equal averages become
    equal values and an exact half stays one."""
    return df.select(
        *[F.round(c, digits).alias(c) if c.startswith(prefix) else F.col(c) for c in df.columns]
    )


def rounded(df: DataFrame) -> DataFrame:
    return steady(steady(df), digits=6)


def averages(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return steady(gs.monthly_averages(readings(spark, sf_dir), HOME, **options))


def scan_parquet_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir)


def scan_csv_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_readings(spark, sf_dir)


def zone_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gs.filter_zone(readings(spark, sf_dir), HOME)


def period_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One group per month start; its parts and its label are made from that.
    starts = gs.with_period(readings(spark, sf_dir), "month_start")
    months = starts.groupBy("month_start").agg(F.count("*").alias("n_rows"))
    months = gs.with_period(months, ["year_month_parts", "month"], time="month_start")
    return months.select("year", "month", YEAR_MONTH, "n_rows")


def zone_year_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.zone_year_stats(readings(spark, sf_dir)))


def zone_year_stats_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = gs.register(gs.with_period(readings(spark, sf_dir), "year"), "energy_by_year")
    return rounded(gs.zone_year_stats_sql(spark, view))


def zone_year_stats_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.zone_year_stats_merged(csv_readings(spark, sf_dir)))


def zone_year_stats_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.zone_year_stats_joined(readings(spark, sf_dir)))


def zone_year_stats_joined_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.zone_year_stats_joined(csv_readings(spark, sf_dir)))


def zone_year_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = gs.zone_year_keyed(readings(spark, sf_dir))
    return steady(gs.period_sums(keyed, ["country", "year"]), "sum_", 3)


def partials_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per zone and month, merged to zone and year."""
    months = gs.with_period(readings(spark, sf_dir), "year_month_parts")
    fine = gs.period_sums(months, [ZONE, "year", "month"])
    merged = gs.merge_partials(fine, [ZONE, "year"])
    return rounded(gs.finish_averages(merged))


def monthly_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(averages(spark, sf_dir))


def monthly_averages_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = gs.register(gs.with_period(readings(spark, sf_dir), "month_start"), "energy_by_month")
    return rounded(gs.monthly_averages_sql(spark, view, HOME))


def monthly_averages_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.monthly_averages_merged(csv_readings(spark, sf_dir), HOME))


def top(by: str, ascending: bool) -> Callable[[SparkSession, str], DataFrame]:
    def one(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(gs.top_k(averages(spark, sf_dir), by, ascending=ascending))

    return one


def top_sql(by: str, ascending: bool) -> Callable[[SparkSession, str], DataFrame]:
    def one(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = gs.register(averages(spark, sf_dir), "monthly_energy")
        return rounded(gs.top_k_sql(spark, view, by, ascending=ascending))

    return one


def monthly_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.monthly_extremes(averages(spark, sf_dir), label="ranking"))


def monthly_rankings_sql_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL averages as a view, and the four SQL lists over it."""
    view = gs.register(gs.with_period(readings(spark, sf_dir), "month_start"), "energy_by_month")
    months = steady(gs.monthly_averages_sql(spark, view, HOME))
    lists = gs.monthly_rankings_sql(spark, gs.register(months, "monthly_of_home"))
    named = [rows.select(F.lit(name).alias("ranking"), "*") for name, rows in lists.items()]
    return rounded(reduce(DataFrame.unionByName, named))


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).options(header=True, escape='"').csv(path)


def read_monthly_report(spark: SparkSession, path: str) -> DataFrame:
    """All five folders under each other; the lists have a zone if the averages had one."""
    averages_schema = f"{YEAR_MONTH} string, {AVG_CI} double, {AVG_CFE} double"
    list_schema = f"{YEAR_MONTH} string, {ZONE} string, {AVG_CI} double, {AVG_CFE} double"
    parts = [read_csv(spark, f"{path}/{AVERAGES_FOLDER}", averages_schema).withColumn(ZONE, F.lit(None).cast("string"))]
    parts += [read_csv(spark, f"{path}/{folder}", list_schema) for folder in RANKING_FOLDERS.values()]
    names = ["averages", *RANKING_FOLDERS]
    named = [rows.select(F.lit(name).alias("ranking"), "*") for name, rows in zip(names, parts)]
    return rounded(reduce(DataFrame.unionByName, named))


def monthly_report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    gs.save_monthly_report(averages(spark, sf_dir, keep_zone=True), path)
    return read_monthly_report(spark, path)


def zone_year_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    stats = steady(gs.zone_year_stats(readings(spark, sf_dir)))
    gs.save_zone_year_report(stats, path)
    return rounded(read_csv(spark, path, stats.schema))


def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone names with blanks at both ends, quotes, commas and backslashes, through a headerless file."""
    path = new_folder(spark)
    odd = F.concat(F.lit(' "'), F.col(ZONE), F.lit('", \\'), F.col(ZONE), F.lit("\\ "))
    gs.write_csv(readings(spark, sf_dir).withColumn(ZONE, odd), path, header=False)
    return gs.read_readings(spark, path, "csv").groupBy(ZONE).agg(F.count("*").alias("n_rows"))


def result_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = gs.monthly_report(averages(spark, sf_dir))
    return gs.result_sizes({"averages": report.averages, **report.rankings})


def monthly_report_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest of a published report says of each folder, beside the rows that are in it."""
    path = new_folder(spark)
    gs.save_monthly_report(averages(spark, sf_dir), path, manifest=True)
    folders = {"averages": AVERAGES_FOLDER, **RANKING_FOLDERS}
    names = F.create_map(*[F.lit(x) for name, folder in folders.items() for x in (folder, name)])
    said = gs.read_manifest(spark, path).select(F.element_at(names, F.col("folder")).alias("ranking"), "n_rows")
    read = read_monthly_report(spark, path).groupBy(F.col("ranking").alias("of")).agg(F.count("*").alias("n_read"))
    return said.join(read, said.ranking == read.of).select("ranking", "n_rows", "n_read")


def report_sizes_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each result, counted as they were written."""
    sizes = gs.save_monthly_report(averages(spark, sf_dir), new_folder(spark))
    return spark.createDataFrame(list(sizes.items()), "name string, n_rows long")


def zone_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gs.zone_extremes(readings(spark, sf_dir), digits=8))


def stored_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of all months, those of one year delivered wrong first and then again."""
    path = new_folder(spark, "months")
    own = readings(spark, sf_dir)
    wrong = F.col(TIME).startswith("1995")
    gs.store_days(own.withColumn(CI, F.when(wrong, F.col(CI) * 2).otherwise(F.col(CI))), path, unit="month")
    gs.store_days(own.where(wrong), path, unit="month")
    return gs.read_days(spark, path)


def zone_year_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(steady(gs.zone_year_from_store(stored_months(spark, sf_dir))))


def monthly_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(steady(gs.monthly_from_store(stored_months(spark, sf_dir), HOME)))


def damaged_readings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Readings from a file in which some lines are bad, told by their share: whole ones and bad lines."""
    share = F.round(F.col(CFE)).cast("int")
    time = F.when(share == 7, F.translate(TIME, "-", "/")).otherwise(F.col(TIME))
    price = F.when(share == 3, "n/a").otherwise(F.col(CI).cast("string"))
    discount = F.when(share == 9, F.concat(F.col(CFE).cast("string"), F.lit("%"))).otherwise(F.col(CFE).cast("string"))
    line = F.when(share == 5, F.concat_ws(",", time, ZONE, price)).otherwise(F.concat_ws(",", time, ZONE, price, discount))
    path = new_folder(spark, "damaged")
    readings(spark, sf_dir).select(line.alias("line")).write.text(path)
    return gs.split_readings(spark, path)


def split_good_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_readings(spark, sf_dir)[0]


def split_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = damaged_readings(spark, sf_dir)[1]
    zone = F.split("line", ",")[1].alias(ZONE)
    return bad.groupBy("reason", zone).agg(F.count("*").alias("n_rows"))


def period_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = gs.time_column(readings(spark, sf_dir)).cast("date")
    days = readings(spark, sf_dir).groupBy(day.alias("day")).agg(F.count("*").alias("n_rows"))
    days = gs.with_period(days, ["year_day_parts", "month"], time="day")
    for unit in ("year", "month", "day"):
        days = gs.period_start_ms(days, unit, f"{unit}_ms")
    return days.select("year_ms", "month_ms", "day_ms", "n_rows")


def zone_year_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = steady(gs.zone_year_stats(readings(spark, sf_dir), sort=False))
    points = gs.zone_year_points(stats, APP)
    return points.select(
        "measurement",
        F.col("tags")["country"].alias("country"),
        F.col("tags")["app"].alias("app"),
        F.explode("fields").alias("field", "value"),
        "time_ms",
    ).withColumn("value", F.round("value", 6))


def monthly_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = gs.monthly_points(averages(spark, sf_dir, sort=False), APP)
    return points.select(
        "measurement",
        F.col("tags")["app"].alias("app"),
        F.explode("fields").alias("field", "value"),
        "time_ms",
    ).withColumn("value", F.round("value", 6))


def custom_metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of metrics other than the two fixed ones: every statistic is a field."""
    renamed = readings(spark, sf_dir).withColumnsRenamed({CI: "price", CFE: "discount"})
    stats = steady(gs.zone_year_stats(renamed, sort=False, metrics=["price", "discount"]))
    points = gs.zone_year_points(stats, APP)
    return points.select(
        F.col("tags")["country"].alias("country"),
        F.explode("fields").alias("field", "value"),
        "time_ms",
    ).withColumn("value", F.round("value", 6))


def monthly_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per month: it starts with the month and takes as many milliseconds as there are readings."""
    starts = gs.with_period(readings(spark, sf_dir), "month_start")
    months = starts.groupBy("month_start").agg(F.count("*").alias("duration_ms"))
    months = gs.with_period(months, "month", time="month_start")
    return gs.period_start_ms(months, "month", "start_ms").select("start_ms", "duration_ms")


def run_time_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = gs.run_time_points(monthly_runs(spark, sf_dir), APP)
    return points.select(
        "measurement",
        F.col("tags")["app"].alias("app"),
        F.explode("int_fields").alias("field", "value"),
        "time_ms",
    )


def run_time_point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gs.points_to_lines(gs.run_time_points(monthly_runs(spark, sf_dir), APP))


def extreme_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum and maximum of each zone-year in whole numbers, which every engine prints alike."""
    stats = gs.zone_year_stats(readings(spark, sf_dir), sort=False)
    whole = [F.round(f"{s}_{m}").alias(f"{s}_{m}") for m in METRICS for s in ("min", "max")]
    return gs.zone_year_points(stats.select("country", "year", *whole), APP)


def zone_year_point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gs.points_to_lines(extreme_points(spark, sf_dir))


def point_line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    gs.write_point_lines(extreme_points(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# Schemes of Hadoop file systems and what the client in the tasks calls them.
CLIENT_SCHEMES = {"s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "file": "file", "": "file"}


def client_uri(path: str) -> str:
    """``path`` as the file client names it; an unknown scheme is refused before any job starts."""
    scheme, slash, rest = path.partition(":/")
    if not slash:
        scheme, rest = "", path.removeprefix("/")
    if scheme not in CLIENT_SCHEMES:
        raise ValueError(f"no client for {scheme}: paths")
    return f"{CLIENT_SCHEMES[scheme]}:///{rest.lstrip('/')}" if scheme in ("", "file") else f"{CLIENT_SCHEMES[scheme]}:/{rest}"


def file_writer(path: str):
    """A writer factory that keeps points in files, as JSON."""
    uri = client_uri(path)

    def open_writer():
        import json

        from pyarrow import fs
        from pyspark import TaskContext

        class FileWriter:
            def __init__(self):
                store, folder = fs.FileSystem.from_uri(uri)
                store.create_dir(folder)
                # Named by the partition, so that a task that runs again replaces its file.
                name = f"{folder}/{TaskContext.get().partitionId()}.json"
                self.out = store.open_output_stream(name)

            def write(self, points):
                for p in points:
                    self.out.write((json.dumps(p.asDict()) + "\n").encode())

            def close(self):
                self.out.close()

        return FileWriter()

    return open_writer


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(gs.schema.POINTS).json(path)


def point_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points sent by the tasks to a writer, here one that keeps them in files, and read back."""
    path = new_folder(spark)
    gs.write_points(extreme_points(spark, sf_dir), file_writer(path), batch_size=64)
    return read_points(spark, path).select(
        "measurement",
        F.col("tags")["country"].alias("country"),
        F.col("tags")["app"].alias("app"),
        F.explode("fields").alias("field", "value"),
        "time_ms",
    )


def point_source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points written through the data source, and the lines that its commit left."""
    path = new_folder(spark, "points")
    gs.save_points(extreme_points(spark, sf_dir), path)
    return gs.read_lines(spark, path)


def point_source_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points that the commits of two jobs count, one to files and one through a writer in the tasks."""
    path, sent = new_folder(spark, "points"), new_folder(spark, "sent")
    points = extreme_points(spark, sf_dir)
    gs.save_points(points, path)
    gs.save_points(points, path, file_writer(sent), batch_size=64)
    jobs = gs.read_commits(spark, path).groupBy("job").agg(F.sum("n_points").alias("committed"))
    n_sent = read_points(spark, sent).agg(F.count("*")).first()[0]
    return jobs.select("committed", F.lit(n_sent).cast("bigint").alias("sent"))


def zone_year_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report, CSV and points: the rows of the file beside the fields of the points."""
    path, points_path = new_folder(spark), new_folder(spark, "points")
    stats = steady(gs.zone_year_stats(readings(spark, sf_dir)))
    gs.save_zone_year_report(stats, path, file_writer(points_path), APP)
    long = read_csv(spark, path, stats.schema).unpivot(
        ["country", "year"], stats.columns[2:], "field", "value"
    )
    of_file = long.select(
        F.lit("csv").alias("kind"), "country", F.col("year").cast("bigint").alias("at"), "field", "value"
    )
    of_points = read_points(spark, points_path).select(
        F.lit("points").alias("kind"),
        F.col("tags")["country"].alias("country"),
        F.col("time_ms").alias("at"),
        F.explode("fields").alias("field", "value"),
    )
    return of_file.unionByName(of_points).withColumn("value", F.round("value", 6))


def monthly_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report, five folders and points, under each other."""
    path, points_path = new_folder(spark), new_folder(spark, "points")
    gs.save_monthly_report(averages(spark, sf_dir, keep_zone=True), path, file_writer(points_path), APP)
    month = F.date_format(F.timestamp_millis("time_ms"), "yyyy-MM")
    of_points = read_points(spark, points_path).select(
        F.lit("points").alias("ranking"),
        month.alias(YEAR_MONTH),
        F.col("tags")[ZONE].alias(ZONE),
        F.col("fields")["avg_ci_gco2eq_per_kwh"].alias(AVG_CI),
        F.col("fields")["avg_cfe_percentage"].alias(AVG_CFE),
    )
    return read_monthly_report(spark, path).unionByName(rounded(of_points))


def entry(spark: SparkSession) -> DataFrame:
    return zone_year_stats(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_parquet_readings": scan_parquet_readings,
        "scan_csv_readings": scan_csv_readings,
        "zone_filter": zone_filter,
        "period_columns": period_columns,
        "zone_year_stats": zone_year_stats,
        "zone_year_stats_sql": zone_year_stats_sql,
        "zone_year_stats_merged": zone_year_stats_merged,
        "zone_year_stats_joined": zone_year_stats_joined,
        "zone_year_stats_joined_csv": zone_year_stats_joined_csv,
        "zone_year_sums": zone_year_sums,
        "partials_merged": partials_merged,
        "monthly_averages": monthly_averages,
        "monthly_averages_sql": monthly_averages_sql,
        "monthly_averages_csv": monthly_averages_csv,
        "top_ci_desc": top(AVG_CI, False),
        "top_ci_asc": top(AVG_CI, True),
        "top_cfe_desc": top(AVG_CFE, False),
        "top_cfe_asc": top(AVG_CFE, True),
        "top_ci_desc_sql": top_sql(AVG_CI, False),
        "top_cfe_asc_sql": top_sql(AVG_CFE, True),
        "monthly_extremes": monthly_extremes,
        "monthly_rankings_sql_chain": monthly_rankings_sql_chain,
        "monthly_report_roundtrip": monthly_report_roundtrip,
        "zone_year_csv_roundtrip": zone_year_csv_roundtrip,
        "csv_text_roundtrip": csv_text_roundtrip,
        "result_sizes": result_sizes,
        "period_starts": period_starts,
        "zone_year_points": zone_year_points,
        "monthly_points": monthly_points,
        "zone_year_point_lines": zone_year_point_lines,
        "point_line_files": point_line_files,
        "point_writer": point_writer,
        "point_source_lines": point_source_lines,
        "point_source_commits": point_source_commits,
        "monthly_report_published": monthly_report_published,
        "report_sizes_observed": report_sizes_observed,
        "zone_extremes": zone_extremes,
        "zone_year_from_store": zone_year_from_store,
        "monthly_from_store": monthly_from_store,
        "split_good_readings": split_good_readings,
        "split_bad_lines": split_bad_lines,
        "custom_metric_points": custom_metric_points,
        "run_time_points": run_time_points,
        "run_time_point_lines": run_time_point_lines,
        "zone_year_delivery": zone_year_delivery,
        "monthly_delivery": monthly_delivery,
        **(llm.QUERIES if llm else {}),
        **({"pipeline": pipeline.run} if pipeline else {}),
    }


R = f"""
readings AS (
  SELECT l_shipdate AS t, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS {TIME}, n_name AS {ZONE},
         l_extendedprice AS {CI}, l_discount * 100 AS {CFE}
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""

SCAN = f"WITH {R} SELECT {', '.join(READINGS.names)} FROM readings"

STATS = f"""
stats AS (
  SELECT {ZONE} AS country, CAST(year(t) AS INTEGER) AS year,
         round(avg({CI}), 8) AS {AVG_CI}, min({CI}) AS min_{CI}, max({CI}) AS max_{CI},
         round(avg({CFE}), 8) AS {AVG_CFE}, min({CFE}) AS min_{CFE}, max({CFE}) AS max_{CFE}
  FROM readings GROUP BY ALL
)"""

ZONE_YEAR = f"""WITH {R}, {STATS}
SELECT country, year, round({AVG_CI}, 6) AS {AVG_CI}, min_{CI}, max_{CI},
       round({AVG_CFE}, 6) AS {AVG_CFE}, min_{CFE}, max_{CFE}
FROM stats ORDER BY country, year"""

MONTHS = f"""
months AS (
  SELECT strftime(t, '%Y-%m') AS {YEAR_MONTH}, round(avg({CI}), 8) AS {AVG_CI},
         round(avg({CFE}), 8) AS {AVG_CFE}
  FROM readings WHERE {ZONE} = '{HOME}' GROUP BY ALL
)"""

ROUNDED = f"{YEAR_MONTH}, round({AVG_CI}, 6) AS {AVG_CI}, round({AVG_CFE}, 6) AS {AVG_CFE}"

MONTHLY = f"WITH {R}, {MONTHS} SELECT {ROUNDED} FROM months ORDER BY {YEAR_MONTH}"


def _top(by: str, ascending: bool) -> str:
    order = "ASC NULLS FIRST" if ascending else "DESC NULLS LAST"
    return f"SELECT * FROM months ORDER BY {by} {order}, {YEAR_MONTH} LIMIT 5"


def _ranked(by: str, ascending: bool) -> str:
    return f"WITH {R}, {MONTHS} SELECT {ROUNDED} FROM ({_top(by, ascending)})"


def _points(fields: dict[str, str], columns: str, tags: str, start: str, source: str) -> str:
    """A SELECT per field, under each other."""
    one = "SELECT 'result' AS measurement, {tags}, '{f}' AS field, {e} AS value, {start} AS time_ms FROM {s}"
    parts = [one.format(tags=tags, f=f, e=e, start=start, s=source) for f, e in fields.items()]
    return f"WITH {R}, {columns} " + " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    year_ms = "epoch_ms(make_timestamp(year, 1, 1, 0, 0, 0))"
    month_ms = f"epoch_ms(strptime({YEAR_MONTH} || '-01', '%Y-%m-%d'))"
    tags = f"country, '{APP}' AS app"
    stat_fields = {
        f"{s}_{short}": f"round({s}_{m}, 6)"
        for s in ("avg", "min", "max")
        for m, short in ((CI, "ci_gco2eq_per_kwh"), (CFE, "cfe_percentage"))
    }
    whole_fields = {f: e.replace(", 6", "") for f, e in stat_fields.items() if f[:3] != "avg"}
    month_fields = {
        "avg_ci_gco2eq_per_kwh": f"round({AVG_CI}, 6)",
        "avg_cfe_percentage": f"round({AVG_CFE}, 6)",
    }
    lines = f"""WITH {R}, {STATS}
        SELECT 'result,app={APP},country=' || country
               || ' max_cfe_percentage=' || CAST(round(max_{CFE}) AS VARCHAR)
               || ',max_ci_gco2eq_per_kwh=' || CAST(round(max_{CI}) AS VARCHAR)
               || ',min_cfe_percentage=' || CAST(round(min_{CFE}) AS VARCHAR)
               || ',min_ci_gco2eq_per_kwh=' || CAST(round(min_{CI}) AS VARCHAR)
               || ' ' || CAST({year_ms} AS VARCHAR) AS line
        FROM stats"""
    lists = {
        "ci_desc": (AVG_CI, False),
        "ci_asc": (AVG_CI, True),
        "cfe_desc": (AVG_CFE, False),
        "cfe_asc": (AVG_CFE, True),
    }
    union = " UNION ALL ".join(
        f"SELECT '{name}' AS ranking, {ROUNDED} FROM ({_top(*list_)})"
        for name, list_ in lists.items()
    )
    sizes = " UNION ALL ".join(
        [
            "SELECT 'averages' AS name, count(*) AS n_rows FROM months",
            *[
                f"SELECT '{name}' AS name, count(*) AS n_rows FROM ({_top(*list_)})"
                for name, list_ in lists.items()
            ],
        ]
    )
    with_zone = f"'{HOME}' AS {ZONE}"
    no_zone = f"CAST(NULL AS VARCHAR) AS {ZONE}"
    report = " UNION ALL ".join(
        [
            f"SELECT 'averages' AS ranking, {no_zone}, {ROUNDED} FROM months",
            *[
                f"SELECT '{name}' AS ranking, {with_zone}, {ROUNDED} FROM ({_top(*list_)})"
                for name, list_ in lists.items()
            ],
        ]
    )
    columns = {f"{s}_{m}": f"round({s}_{m}, 6)" for s in ("avg", "min", "max") for m in METRICS}
    delivered = [
        *[
            f"SELECT 'csv' AS kind, country, CAST(year AS BIGINT) AS at, '{f}' AS field, {e} AS value FROM stats"
            for f, e in columns.items()
        ],
        *[
            f"SELECT 'points' AS kind, country, {year_ms} AS at, '{f}' AS field, {e} AS value FROM stats"
            for f, e in stat_fields.items()
        ],
    ]
    custom = [
        f"SELECT country, '{f.replace(CI, 'price').replace(CFE, 'discount')}' AS field, {e} AS value,"
        f" {year_ms} AS time_ms FROM stats"
        for f, e in columns.items()
    ]
    zone_months = f"""zone_months AS (
        SELECT {ZONE}, strftime(t, '%Y-%m') AS {YEAR_MONTH}, round(avg({CI}), 8) AS {AVG_CI},
               round(avg({CFE}), 8) AS {AVG_CFE}
        FROM readings GROUP BY ALL)"""
    zone_lists = " UNION ALL ".join(
        f"""SELECT {ZONE}, '{m}_{way}' AS ranking, {ROUNDED}, CAST(row_number() OVER (PARTITION BY {ZONE}
            ORDER BY avg_{m} {order}, {YEAR_MONTH}) AS INTEGER) AS place FROM zone_months"""
        for m in METRICS
        for way, order in (("desc", "DESC NULLS LAST"), ("asc", "ASC NULLS FIRST"))
    )
    share = f"CAST(round({CFE}) AS INTEGER)"
    runs = """runs AS (
        SELECT epoch_ms(date_trunc('month', t)) AS start_ms, count(*) AS duration_ms
        FROM readings GROUP BY ALL)"""
    return {
        "scan_parquet_readings": SCAN,
        "scan_csv_readings": SCAN,
        "zone_filter": f"{SCAN} WHERE {ZONE} = '{HOME}'",
        "period_columns": f"""WITH {R}
            SELECT CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month,
                   strftime(t, '%Y-%m') AS {YEAR_MONTH}, count(*) AS n_rows
            FROM readings GROUP BY ALL""",
        "zone_year_stats": ZONE_YEAR,
        "zone_year_stats_sql": ZONE_YEAR,
        "zone_year_stats_merged": ZONE_YEAR,
        "zone_year_stats_joined": ZONE_YEAR,
        "zone_year_stats_joined_csv": ZONE_YEAR,
        "zone_year_sums": f"""WITH {R}
            SELECT {ZONE} AS country, CAST(year(t) AS INTEGER) AS year,
                   round(sum({CI}), 3) AS sum_{CI}, count({CI}) AS count_{CI},
                   round(sum({CFE}), 3) AS sum_{CFE}, count({CFE}) AS count_{CFE}
            FROM readings GROUP BY ALL""",
        "partials_merged": f"""WITH {R}, {STATS}
            SELECT country AS {ZONE}, year, round({AVG_CI}, 6) AS {AVG_CI},
                   round({AVG_CFE}, 6) AS {AVG_CFE}
            FROM stats""",
        "monthly_averages": MONTHLY,
        "monthly_averages_sql": f"""WITH {R}, {MONTHS}
            SELECT {YEAR_MONTH}, '{HOME}' AS {ZONE}, round({AVG_CI}, 6) AS {AVG_CI},
                   round({AVG_CFE}, 6) AS {AVG_CFE}
            FROM months ORDER BY {YEAR_MONTH}""",
        "monthly_averages_csv": MONTHLY,
        "top_ci_desc": _ranked(AVG_CI, False),
        "top_ci_asc": _ranked(AVG_CI, True),
        "top_cfe_desc": _ranked(AVG_CFE, False),
        "top_cfe_asc": _ranked(AVG_CFE, True),
        "top_ci_desc_sql": _ranked(AVG_CI, False),
        "top_cfe_asc_sql": _ranked(AVG_CFE, True),
        "monthly_extremes": f"WITH {R}, {MONTHS} {union}",
        "monthly_rankings_sql_chain": f"""WITH {R}, {MONTHS}
            SELECT *, '{HOME}' AS {ZONE} FROM ({union})""",
        "monthly_report_roundtrip": f"WITH {R}, {MONTHS} {report}",
        "monthly_delivery": f"""WITH {R}, {MONTHS} {report} UNION ALL
            SELECT 'points' AS ranking, {with_zone}, {ROUNDED} FROM months""",
        "zone_year_delivery": f"WITH {R}, {STATS} " + " UNION ALL ".join(delivered),
        "custom_metric_points": f"WITH {R}, {STATS} " + " UNION ALL ".join(custom),
        "run_time_points": f"""WITH {R}, {runs}
            SELECT 'time' AS measurement, '{APP}' AS app, 'duration' AS field, duration_ms AS value,
                   start_ms AS time_ms FROM runs""",
        "run_time_point_lines": f"""WITH {R}, {runs}
            SELECT 'time,app={APP} duration=' || CAST(duration_ms AS VARCHAR) || 'i '
                   || CAST(start_ms AS VARCHAR) AS line FROM runs""",
        "csv_text_roundtrip": f"""WITH {R}
            SELECT ' "' || {ZONE} || '", \\' || {ZONE} || '\\ ' AS {ZONE}, count(*) AS n_rows
            FROM readings GROUP BY ALL""",
        "zone_year_csv_roundtrip": ZONE_YEAR,
        "result_sizes": f"WITH {R}, {MONTHS} {sizes}",
        "period_starts": f"""WITH {R}
            SELECT epoch_ms(date_trunc('year', t)) AS year_ms,
                   epoch_ms(date_trunc('month', t)) AS month_ms,
                   epoch_ms(date_trunc('day', t)) AS day_ms, count(*) AS n_rows
            FROM readings GROUP BY ALL""",
        "zone_year_points": _points(stat_fields, STATS, tags, year_ms, "stats"),
        "monthly_points": _points(month_fields, MONTHS, f"'{APP}' AS app", month_ms, "months"),
        "zone_year_point_lines": lines,
        "point_line_files": lines,
        "point_writer": _points(whole_fields, STATS, tags, year_ms, "stats"),
        "point_source_lines": lines,
        "point_source_commits": f"""WITH {R}, {STATS}
            SELECT count(*) AS committed, count(*) AS sent FROM stats
            UNION ALL SELECT count(*), count(*) FROM stats""",
        "monthly_report_published": f"""WITH {R}, {MONTHS}
            SELECT name AS ranking, n_rows, n_rows AS n_read FROM ({sizes})""",
        "report_sizes_observed": f"WITH {R}, {MONTHS} {sizes}",
        "zone_extremes": f"WITH {R}, {zone_months} SELECT * FROM ({zone_lists}) WHERE place <= 5",
        "zone_year_from_store": ZONE_YEAR,
        "monthly_from_store": MONTHLY,
        "split_good_readings": f"{SCAN} WHERE {share} NOT IN (3, 5, 7, 9)",
        "split_bad_lines": f"""WITH {R}
            SELECT CASE {share} WHEN 3 THEN '{CI}' WHEN 5 THEN 'fields' WHEN 7 THEN '{TIME}' ELSE '{CFE}' END AS reason,
                   {ZONE}, count(*) AS n_rows
            FROM readings WHERE {share} IN (3, 5, 7, 9) GROUP BY ALL""",
        **(llm.SQL if llm else {}),
        **({"pipeline": pipeline.ORACLE_SQL} if pipeline and pipeline.ORACLE_SQL else {}),
    }
