"""The streaming forms on the events table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from areacast.bindings import roles
from areacast.bindings.roles import SPEC, iso_day, rounded, table
from areacast.fixed import PREDICTED
from areacast.functions import to_decimal_comma
from areacast.operators import learn
from areacast.operators.clean import parse_dates, parse_measures
from areacast.plans import score
from areacast.plans.training_base import training_means
from areacast.session import scratch_path
from areacast.sources import delimited, tables
from areacast.streaming import arrivals, rollup

QUERIES = {}
ORACLES = {}
FILE_SCHEMA = "obs_station string, obs_date string, " + ", ".join(
    f"{m} string" for m in SPEC.measures
)


def _station_of_user(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (
        table(spark, sf_dir, "events")
        .join(customer, F.col("user_id") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def stream_score_batches(spark, sf_dir):
    """Events dropped as weather files, cleaned and expanded by a stream, then summed up."""
    drop = scratch_path(spark, "arrivals")
    events = _station_of_user(spark, sf_dir).select(
        F.col("r_name").alias("obs_station"),
        F.date_format("ts", "dd/MM/yyyy").alias("obs_date"),
        to_decimal_comma(F.col("value")).alias("temp_max"),
        F.when(F.col("event_type") != "error", to_decimal_comma(F.col("value"))).alias("temp_min"),
        to_decimal_comma(F.col("value")).alias("temp_mean"),
    )
    delimited.write_delimited(events, drop, sep=";")

    stream = delimited.read_delimited(spark.readStream, drop, FILE_SCHEMA, sep=";")
    weather = parse_measures(
        parse_dates(stream, {"obs_date": "dd/MM/yyyy"}), list(SPEC.measures)
    )
    means = training_means(roles.enriched(spark, sf_dir), SPEC).first().asDict()
    rows = arrivals.arrival_rows(weather, roles.areas(spark, sf_dir), means, SPEC)
    scored = rows.withColumn("prediction", F.col("temp_max") * 0.5 + F.col("st_asia"))

    out, checkpoint = scratch_path(spark, "scored"), scratch_path(spark, "progress")
    arrivals.to_folder(scored, out, checkpoint)
    stored = spark.read.schema(scored.schema).parquet(out)
    summed = stored.groupBy("area", "week").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(m).alias(m) for m in SPEC.means],
        *[F.sum(s).alias(s) for s in SPEC.stations.values()],
        F.avg("prediction").alias("prediction"),
    )
    return rounded(summed, *SPEC.means, "prediction")


QUERIES["stream_score_batches"] = stream_score_batches
ORACLES["stream_score_batches"] = f"""WITH {roles.ENRICHED_SQL},
arrived AS (
  SELECT r_name AS obs_station, CAST(ts AS DATE) AS obs_date, value AS temp_max,
         CASE WHEN event_type <> 'error' THEN value END AS temp_min, value AS temp_mean
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
),
rows_scored AS (
  SELECT upper(coalesce(dim_area, 'SEM_INFORMACAO')) AS area,
         CAST(extract(isoyear FROM obs_date) * 100 + extract(week FROM obs_date) AS INTEGER)
           AS week,
         replace(obs_station, 'MIDDLE EAST', 'MIDDLE_EAST') AS station,
         coalesce(a.population, (SELECT avg(population) FROM enriched)) AS population,
         {", ".join(f"coalesce(w.{m}, (SELECT avg({m}) FROM enriched)) AS {m}"
                    for m in SPEC.measures)}
  FROM arrived w LEFT JOIN areas a ON w.obs_station = a.station
)
SELECT area, week, count(*) AS n_rows,
       {", ".join(f"round(avg({m}), 8) AS {m}" for m in SPEC.means)},
       {", ".join(f"CAST(count(*) FILTER (WHERE station = '{v}') AS DOUBLE) AS {n}"
                  for v, n in SPEC.stations.items())},
       round(avg(temp_max * 0.5 + CASE WHEN station = 'ASIA' THEN 1 ELSE 0 END), 8) AS prediction
FROM rows_scored GROUP BY area, week"""


def _published(spark, sf_dir, spec):
    """Events that arrive in two parts, scored by area and week and published: rows equal to the batch's."""
    drop, path = scratch_path(spark, "arrivals"), scratch_path(spark, "published")
    kept, progress = scratch_path(spark, "state"), scratch_path(spark, "progress")
    areas = roles.areas(spark, sf_dir)
    base = tables.written(roles.base(spark, sf_dir, spec), "base")
    score.store(base, path, spec)
    rows = learn.training_rows(base, spec.features, spec.label)
    model = learn.fit(rows, spec.features, learn.boosting(spec.label, maxIter=5, maxDepth=3))
    means = training_means(roles.enriched(spark, sf_dir), spec).first().asDict()
    events = _station_of_user(spark, sf_dir).select(
        "event_id", F.col("r_name").alias("obs_station"), F.col("ts").cast("date").alias("obs_date"),
        *[F.col("value").alias(m) for m in spec.measures],
    )
    events = tables.written(events, "events")
    weather = events.drop("event_id")
    for part in (0, 1):
        events.where(F.pmod("event_id", F.lit(2)) == part).drop("event_id").write.mode(
            "append"
        ).parquet(drop)
        stream = spark.readStream.schema(weather.schema).parquet(drop)
        arrivals.publish_arrivals(stream, areas, model, means, kept, path, progress, spec)
    stored = tables.read_folder(spark, path, score.base_schema(spec)).where(
        F.col(spec.kind) == PREDICTED
    )
    batch = score.score(weather, areas, model, spec, means)
    same = [spec.label, *spec.features]
    batch = batch.select(
        "area", F.col("week").cast("string").alias("week"),
        *[F.col(c).alias(f"expected_{c}") for c in same],
    )
    both = stored.join(batch, ["area", "week"], "full")
    equal = reduce(and_, [F.abs(F.col(c) - F.col(f"expected_{c}")) < 1e-6 for c in same])
    return both.groupBy("area").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(equal).alias("n_equal")
    )


def stream_publish(spark, sf_dir):
    """Arrivals with the stations as shares of the week: touched weeks are scored again."""
    return _published(spark, sf_dir, roles.SHARE_SPEC)


def stream_publish_counts(spark, sf_dir):
    """The same with the stations as counts over the period: each batch changes all weeks."""
    return _published(spark, sf_dir, SPEC)


QUERIES["stream_publish"] = stream_publish
QUERIES["stream_publish_counts"] = stream_publish_counts
ORACLES["stream_publish"] = f"""WITH {roles.AREAS_SQL},
arrived AS (
  SELECT r_name AS obs_station, CAST(ts AS DATE) AS obs_date
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
),
weeks AS (
  SELECT upper(coalesce(dim_area, 'SEM_INFORMACAO')) AS area,
         extract(isoyear FROM obs_date) * 100 + extract(week FROM obs_date) AS week
  FROM arrived w LEFT JOIN areas a ON w.obs_station = a.station
)
SELECT area, count(DISTINCT week) AS n_rows, count(DISTINCT week) AS n_equal
FROM weeks GROUP BY area"""
ORACLES["stream_publish_counts"] = ORACLES["stream_publish"]


def stream_weekly_rollup(spark, sf_dir):
    """Weeks that the watermark has closed, per type of event."""
    schema = table(spark, sf_dir, "events").schema
    # The braces make it a pattern: a stream takes a single file by pattern only.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.{{parquet}}")
    weekly = rollup.weekly_rollup(stream, "ts", ["event_type"], ["value"], "1 day")
    out, checkpoint = scratch_path(spark, "weekly"), scratch_path(spark, "progress")
    arrivals.to_folder(weekly, out, checkpoint)
    stored = spark.read.schema(weekly.schema).parquet(out)
    return rounded(stored.withColumn("week_start", iso_day("week_start")), "value")


QUERIES["stream_weekly_rollup"] = stream_weekly_rollup
ORACLES["stream_weekly_rollup"] = """
WITH weekly AS (
  SELECT date_trunc('week', ts) AS monday, event_type, count(*) AS n_observations,
         round(avg(value), 8) AS value
  FROM events GROUP BY 1, 2
)
SELECT strftime(monday, '%Y-%m-%d') AS week_start, event_type, n_observations, value
FROM weekly
WHERE monday + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""


def weekly_rollup(spark, sf_dir):
    """The same aggregate over the table at once: all weeks."""
    weekly = rollup.weekly_rollup(table(spark, sf_dir, "events"), "ts", ["event_type"], ["value"])
    return rounded(weekly.withColumn("week_start", iso_day("week_start")), "value")


QUERIES["weekly_rollup"] = weekly_rollup
ORACLES["weekly_rollup"] = """
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start, event_type,
       count(*) AS n_observations, round(avg(value), 8) AS value
FROM events GROUP BY 1, 2"""
