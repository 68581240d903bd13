"""The roles the test tables play: case files, areas, station observations, requests.

For each role there is a DataFrame and the same rows as an SQL common table expression.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from areacast.fixed import CASE_SOURCES, UNKNOWN
from areacast.operators.clean import parse_measures
from areacast.operators.schema import harmonized_union
from areacast.plans.spec import BaseSpec
from areacast.plans.training_base import (
    cleaned_cases,
    enriched_cases,
    prepare_cases,
    training_base,
)

SPEC = BaseSpec(
    area="area",
    week="week",
    onset="onset",
    source="source",
    label="cases",
    kind="kind",
    dim_area="dim_area",
    station="station",
    population="population",
    obs_station="obs_station",
    obs_date="obs_date",
    measures=("temp_max", "temp_min", "temp_mean"),
    stations={
        "AFRICA": "st_africa",
        "AMERICA": "st_america",
        "ASIA": "st_asia",
        "EUROPE": "st_europe",
        "MIDDLE_EAST": "st_middle_east",
        UNKNOWN: "st_unknown",
    },
    aliases={"MIDDLE EAST": "MIDDLE_EAST"},
    station_encoding="count",
)
SHARE_SPEC = replace(SPEC, station_encoding="share")
OBS_MEASURES = ["rain", *SPEC.measures]
STATUS_OF = {"dengue": "F", "chikungunya": "O", "zika": "P"}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is taken from the file once and declared from then on."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def rounded(df: DataFrame, *names: str, digits: int = 8) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def iso_day(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


# --- cases -----------------------------------------------------------------------------

CASES_SQL = """
cases AS (
  SELECT o_orderkey AS case_id,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN n_name END AS area,
         CAST(extract(isoyear FROM o_orderdate) * 100 + extract(week FROM o_orderdate)
              AS INTEGER) AS week,
         CAST(o_orderdate AS DATE) AS onset,
         CASE o_orderstatus WHEN 'F' THEN 'DENGUE' WHEN 'O' THEN 'CHIKUNGUNYA'
              ELSE 'ZIKA' END AS source,
         CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS zika,
         CAST(extract(year FROM o_orderdate) AS INTEGER) AS notificacao_ano,
         CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS priority,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS cost
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def case_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three files of orders by status; columns, names and date formats differ."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    week = (F.extract(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)).cast("int")
    common = [F.col("o_orderkey").alias("case_id"), F.col("o_custkey"), week.alias("week")]
    year = F.year(day)

    def of(source: str) -> DataFrame:
        return orders.filter(F.col("o_orderstatus") == STATUS_OF[source])

    return {
        "dengue": of("dengue").select(
            *common,
            F.date_format(day, CASE_SOURCES["dengue"]["date_format"]).alias("onset"),
            year.alias("notificacao_ano"),
            F.col("o_orderpriority").alias("priority"),
        ),
        "chikungunya": of("chikungunya").select(
            *common,
            F.date_format(day, CASE_SOURCES["chikungunya"]["date_format"]).alias("onset"),
            year.alias("notificacao_ano"),
        ),
        "zika": of("zika").select(
            *common,
            day.alias("onset"),
            year.cast("bigint").alias("ano_notificacao"),
            F.col("o_totalprice").alias("cost"),
        ),
    }


def prepared_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        name: prepare_cases(
            df, name, CASE_SOURCES[name]["date_format"], SPEC, zika=CASE_SOURCES[name]["zika"]
        )
        for name, df in case_files(spark, sf_dir).items()
    }


def with_area(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area of a case is the nation of its customer; households do not tell it."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = rows.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    area = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("n_name"))
    return joined.select(*[c for c in rows.columns if c != "o_custkey"], area.alias("area"))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three files in one table."""
    united = harmonized_union(
        list(prepared_files(spark, sf_dir).values()), {"notificacao_ano": "int"}
    )
    return with_area(united, spark, sf_dir)


# --- areas -----------------------------------------------------------------------------

AREAS_SQL = """
areas AS (
  SELECT n_name AS dim_area,
         CAST(CASE WHEN n_regionkey <> 4 THEN 1000 + 137 * n_nationkey END AS DOUBLE)
           AS population,
         r_name AS station
  FROM nation JOIN region ON r_regionkey = n_regionkey
  UNION ALL
  SELECT n_name, CAST(CASE WHEN n_regionkey <> 4 THEN 1000 + 137 * n_nationkey END AS DOUBLE),
         r_name
  FROM nation JOIN region ON r_regionkey = (n_regionkey + 1) % 5
  WHERE n_nationkey <= 2
)"""


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with the region as station; the first three lie at two stations."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    second = nation.filter("n_nationkey <= 2").withColumn(
        "n_regionkey2", (F.col("n_regionkey") + 1) % 5
    )
    rows = nation.withColumn("n_regionkey2", F.col("n_regionkey")).unionByName(second)
    return rows.join(region, F.col("n_regionkey2") == F.col("r_regionkey")).select(
        F.col("n_name").alias("dim_area"),
        F.when(F.col("n_regionkey") != 4, 1000 + 137 * F.col("n_nationkey"))
        .cast("double")
        .alias("population"),
        F.col("r_name").alias("station"),
    )


# --- station observations --------------------------------------------------------------

OBS_TEXT_SQL = """
daily AS (
  SELECT n_regionkey AS regionkey, CAST(l_shipdate AS DATE) AS d, count(*) AS n,
         CAST(max(l_quantity) AS INTEGER) AS q_max, CAST(min(l_quantity) AS INTEGER) AS q_min,
         CAST(sum(l_quantity) AS BIGINT) AS q_sum,
         CAST(round(max(l_discount) * 100) AS INTEGER) AS d_max,
         CAST(round(min(l_tax) * 100) AS INTEGER) AS t_min
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2
),
obs_text AS (
  SELECT r_name AS obs_station, strftime(d, '%d/%m/%Y') AS obs_date,
         CASE WHEN t_min = 0 THEN n || ',' || lpad(CAST(d_max AS VARCHAR), 2, '0')
              ELSE 'n/d' END AS rain,
         q_max || ',' || lpad(CAST(d_max AS VARCHAR), 2, '0') AS temp_max,
         CASE WHEN n > 1 THEN q_min || ',' || lpad(CAST(t_min AS VARCHAR), 2, '0') END
           AS temp_min,
         (q_sum // n) || ',5' AS temp_mean
  FROM daily JOIN region ON regionkey = r_regionkey
)"""
OBS_SQL = OBS_TEXT_SQL + """,
obs AS (
  SELECT obs_station, CAST(strptime(obs_date, '%d/%m/%Y') AS DATE) AS obs_date,
         TRY_CAST(replace(rain, ',', '.') AS DOUBLE) AS rain,
         TRY_CAST(replace(temp_max, ',', '.') AS DOUBLE) AS temp_max,
         TRY_CAST(replace(temp_min, ',', '.') AS DOUBLE) AS temp_min,
         TRY_CAST(replace(temp_mean, ',', '.') AS DOUBLE) AS temp_mean
  FROM obs_text
)"""


def obs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per region and ship date as a weather file holds it: all columns text."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    region = table(spark, sf_dir, "region")
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax"
    )
    daily = (
        lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_regionkey", F.col("l_shipdate").cast("date").alias("d"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("l_quantity").cast("int").alias("q_max"),
            F.min("l_quantity").cast("int").alias("q_min"),
            F.sum("l_quantity").cast("bigint").alias("q_sum"),
            F.round(F.max("l_discount") * 100).cast("int").alias("d_max"),
            F.round(F.min("l_tax") * 100).cast("int").alias("t_min"),
        )
    )

    def two(name: str) -> Column:
        return F.lpad(F.col(name).cast("string"), 2, "0")

    def joined(*parts) -> Column:
        return F.concat(*[p.cast("string") for p in parts])

    return daily.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("obs_station"),
        F.date_format("d", "dd/MM/yyyy").alias("obs_date"),
        F.when(F.col("t_min") == 0, joined(F.col("n"), F.lit(","), two("d_max")))
        .otherwise("n/d")
        .alias("rain"),
        joined(F.col("q_max"), F.lit(","), two("d_max")).alias("temp_max"),
        F.when(F.col("n") > 1, joined(F.col("q_min"), F.lit(","), two("t_min"))).alias("temp_min"),
        joined(F.expr("q_sum div n"), F.lit(",5")).alias("temp_mean"),
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations with a date and numbers."""
    text = obs_text(spark, sf_dir)
    dated = text.withColumn("obs_date", F.to_date("obs_date", "dd/MM/yyyy"))
    return parse_measures(dated, OBS_MEASURES)


# --- the base --------------------------------------------------------------------------

ENRICHED_SQL = f"""{CASES_SQL},{AREAS_SQL},{OBS_SQL},
enriched AS (
  SELECT c.case_id, c.area, c.week, c.onset, c.source, a.station, a.population,
         o.temp_max, o.temp_min, o.temp_mean
  FROM cases c
  LEFT JOIN areas a ON c.area = a.dim_area
  LEFT JOIN obs o ON a.station = o.obs_station AND c.onset = o.obs_date
)"""
CLEANED_SQL = f"""{ENRICHED_SQL},
cleaned AS (
  SELECT case_id, upper(coalesce(area, 'SEM_INFORMACAO')) AS area, week, onset, source,
         upper(coalesce(CASE WHEN station = 'MIDDLE EAST' THEN 'MIDDLE_EAST' ELSE station END,
                        'SEM_INFORMACAO')) AS station,
         coalesce(population, (SELECT avg(population) FROM enriched)) AS population,
         coalesce(temp_max, (SELECT avg(temp_max) FROM enriched)) AS temp_max,
         coalesce(temp_min, (SELECT avg(temp_min) FROM enriched)) AS temp_min,
         coalesce(temp_mean, (SELECT avg(temp_mean) FROM enriched)) AS temp_mean
  FROM enriched
)"""
STATION_COUNTS_SQL = ",\n         ".join(
    f"CAST(count(*) FILTER (WHERE station = '{value}') AS DOUBLE) AS {name}"
    for value, name in SPEC.stations.items()
)
BASE_SQL = f"""{CLEANED_SQL},
base AS (
  SELECT b.area, b.week, b.cases, b.population, b.temp_max, b.temp_min, b.temp_mean,
         {", ".join(f"s.{n}" for n in SPEC.stations.values())}, 'original' AS kind
  FROM (SELECT area, week, count(*) AS cases, avg(population) AS population,
               avg(temp_max) AS temp_max, avg(temp_min) AS temp_min, avg(temp_mean) AS temp_mean
        FROM cleaned GROUP BY area, week) b
  LEFT JOIN (SELECT area, {STATION_COUNTS_SQL} FROM cleaned GROUP BY area) s ON b.area = s.area
)"""
# A fixed predictor stands in for the model where results have to be known exactly.
MERGED_SQL = f"""{BASE_SQL},
predicted AS (
  SELECT area, week, cases * 0.75 + (week % 100) * 0.125 AS prediction, population, temp_max,
         temp_min, temp_mean, {", ".join(SPEC.stations.values())}
  FROM base
),
merged AS (
  SELECT area, CAST(week AS VARCHAR) AS week, CAST(cases AS DOUBLE) AS cases, population,
         temp_max, temp_min, temp_mean, {", ".join(SPEC.stations.values())}, kind
  FROM base
  UNION
  SELECT area, CAST(week AS VARCHAR), CAST(prediction AS DOUBLE), population, temp_max, temp_min,
         temp_mean, {", ".join(SPEC.stations.values())}, 'previsto'
  FROM predicted
)"""
ROUNDED_BASE_SQL = (
    "area, week, cases, "
    + ", ".join(f"round({c}, 8) AS {c}" for c in SPEC.means)
    + ", "
    + ", ".join(SPEC.stations.values())
    + ", kind"
)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_cases(
        cases(spark, sf_dir), areas(spark, sf_dir), obs(spark, sf_dir), SPEC
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_cases(enriched(spark, sf_dir), SPEC)


def base(spark: SparkSession, sf_dir: str, spec: BaseSpec = SPEC) -> DataFrame:
    return training_base(
        cases(spark, sf_dir), areas(spark, sf_dir), obs(spark, sf_dir), spec
    )


def fixed_prediction() -> Column:
    return F.col("cases") * 0.75 + (F.col("week") % 100) * 0.125


# --- score requests --------------------------------------------------------------------

FORM_SQL = """
form AS (
  SELECT l_orderkey, l_linenumber, n_name || ' - ' || r_name AS label,
         1000 + 137 * n_nationkey AS population, CAST(l_shipdate AS DATE) AS day,
         l_discount AS rain, l_quantity AS temp_max, l_tax * 100 AS temp_min,
         (l_quantity + 1) / 2 AS temp_mean
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as one submitted form."""
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        F.concat("n_name", F.lit(" - "), "r_name").alias("bairro_estacao"),
        (1000 + 137 * F.col("n_nationkey")).alias("populacao"),
        F.col("l_shipdate").cast("date").alias("data"),
        F.col("l_discount").alias("precipitacao"),
        F.col("l_quantity").alias("temp_maxima"),
        (F.col("l_tax") * 100).alias("temp_minima"),
        ((F.col("l_quantity") + 1) / 2).alias("temp_comp_media"),
    )
