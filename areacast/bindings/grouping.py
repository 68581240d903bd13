"""Joins, grouping, merging and reports on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from areacast.bindings import roles
from areacast.bindings.roles import SPEC, fixed_prediction, iso_day, rounded
from areacast.operators import aggregate, joins, merge, report, schema
from areacast.plans.score import base_schema, stored_rows
from areacast.plans.training_base import ROWS
from areacast.session import scratch_path
from areacast.sources import tables

QUERIES = {}
ORACLES = {}
STATION_COLUMNS = list(SPEC.stations.values())
FIRST_WEEK, LAST_WEEK = 199801, 199808


def enrich_area_left(spark, sf_dir):
    joined = joins.enrich_area(
        roles.cases(spark, sf_dir), roles.areas(spark, sf_dir), "area", "dim_area"
    )
    return joined.select("case_id", "area", "station", "population")


QUERIES["enrich_area_left"] = enrich_area_left
ORACLES["enrich_area_left"] = f"""WITH {roles.CASES_SQL},{roles.AREAS_SQL}
SELECT case_id, area, station, population FROM cases LEFT JOIN areas ON area = dim_area"""


def enrich_area_first(spark, sf_dir):
    joined = joins.enrich_area(
        roles.cases(spark, sf_dir), roles.areas(spark, sf_dir), "area", "dim_area",
        fanout="first", prefer=["station"],
    )
    return joined.select("case_id", "area", "station", "population")


QUERIES["enrich_area_first"] = enrich_area_first
ORACLES["enrich_area_first"] = f"""WITH {roles.CASES_SQL},{roles.AREAS_SQL}
SELECT case_id, area, station, population
FROM cases LEFT JOIN (
  SELECT dim_area, min(station) AS station, min(population) AS population FROM areas GROUP BY 1
) ON area = dim_area"""


def enrich_area_split(spark, sf_dir):
    """The same join with every key spread over eight partitions by case."""
    joined = joins.enrich_area(
        roles.cases(spark, sf_dir), roles.areas(spark, sf_dir), "area", "dim_area",
        hot_splits=8, split_by=["case_id"],
    )
    return joined.select("case_id", "area", "station", "population")


QUERIES["enrich_area_split"] = enrich_area_split
ORACLES["enrich_area_split"] = ORACLES["enrich_area_left"]


def enrich_weather_left(spark, sf_dir):
    with_area = joins.enrich_area(
        roles.cases(spark, sf_dir), roles.areas(spark, sf_dir), "area", "dim_area"
    )
    joined = joins.enrich_weather(
        with_area, roles.obs(spark, sf_dir), "station", "onset", "obs_station", "obs_date"
    )
    return joined.select(
        "case_id", "station", iso_day("onset").alias("onset"), "temp_max", "temp_min", "temp_mean"
    )


QUERIES["enrich_weather_left"] = enrich_weather_left
ORACLES["enrich_weather_left"] = f"""WITH {roles.ENRICHED_SQL}
SELECT case_id, station, strftime(onset, '%Y-%m-%d') AS onset, temp_max, temp_min, temp_mean
FROM enriched"""


def expand_station_to_areas(spark, sf_dir):
    expanded = joins.expand_to_areas(
        roles.obs(spark, sf_dir), roles.areas(spark, sf_dir), "obs_station", "station"
    )
    return expanded.select(
        "obs_station", iso_day("obs_date").alias("obs_date"), "dim_area", "population", "temp_max"
    )


QUERIES["expand_station_to_areas"] = expand_station_to_areas
ORACLES["expand_station_to_areas"] = f"""WITH {roles.AREAS_SQL},{roles.OBS_SQL}
SELECT obs_station, strftime(obs_date, '%Y-%m-%d') AS obs_date, dim_area, population, temp_max
FROM obs LEFT JOIN areas ON obs_station = station"""


def join_fanout_audit(spark, sf_dir):
    """Keys of both dimensions that would multiply rows: area names, customer nations."""
    area = joins.fanout_audit(roles.areas(spark, sf_dir), ["dim_area"])
    nation = joins.fanout_audit(roles.table(spark, sf_dir, "customer"), ["c_nationkey"])
    return schema.harmonized_union([
        area.select(F.lit("area").alias("dim"), F.col("dim_area").alias("key"), "n_rows"),
        nation.select(
            F.lit("customer").alias("dim"), F.col("c_nationkey").cast("string").alias("key"),
            "n_rows",
        ),
    ])


QUERIES["join_fanout_audit"] = join_fanout_audit
ORACLES["join_fanout_audit"] = f"""WITH {roles.AREAS_SQL}
SELECT 'area' AS dim, dim_area AS key, count(*) AS n_rows FROM areas
GROUP BY dim_area HAVING count(*) > 1
UNION ALL
SELECT 'customer', CAST(c_nationkey AS VARCHAR), count(*) FROM customer
GROUP BY c_nationkey HAVING count(*) > 1"""


def area_week_base(spark, sf_dir):
    grouped = aggregate.area_week_base(
        roles.cleaned(spark, sf_dir), "area", "week", SPEC.means, "cases", ROWS
    )
    return rounded(grouped, *SPEC.means)


QUERIES["area_week_base"] = area_week_base
ORACLES["area_week_base"] = f"""WITH {roles.CLEANED_SQL}
SELECT area, week, count(*) AS cases,
       {", ".join(f"round(avg({m}), 8) AS {m}" for m in SPEC.means)}
FROM cleaned GROUP BY area, week"""


def area_station_count(spark, sf_dir):
    return aggregate.area_station_count(
        roles.cleaned(spark, sf_dir), "area", "station", "qtd", ROWS
    )


QUERIES["area_station_count"] = area_station_count
ORACLES["area_station_count"] = f"""WITH {roles.CLEANED_SQL}
SELECT area, station, CAST(count(*) AS INTEGER) AS qtd FROM cleaned GROUP BY area, station"""


def _pivot(spark, sf_dir):
    counts = area_station_count(spark, sf_dir)
    return aggregate.station_pivot(counts, "area", "station", "qtd", SPEC.stations)


QUERIES["station_pivot"] = _pivot
ORACLES["station_pivot"] = f"""WITH {roles.CLEANED_SQL}
SELECT area, {", ".join(
    f"CAST(nullif(count(*) FILTER (WHERE station = '{v}'), 0) AS DOUBLE) AS {n}"
    for v, n in SPEC.stations.items())}
FROM cleaned GROUP BY area"""


def attach_station_counts(spark, sf_dir):
    base = aggregate.area_week_base(
        roles.cleaned(spark, sf_dir), "area", "week", SPEC.means, "cases", ROWS
    )
    attached = aggregate.attach_station_counts(
        base, _pivot(spark, sf_dir), "area", STATION_COLUMNS
    )
    return rounded(attached.withColumn("kind", F.lit("original")), *SPEC.means)


QUERIES["attach_station_counts"] = attach_station_counts
ORACLES["attach_station_counts"] = f"""WITH {roles.BASE_SQL}
SELECT {roles.ROUNDED_BASE_SQL} FROM base"""


def model_base(spark, sf_dir):
    return rounded(roles.base(spark, sf_dir), *SPEC.means)


QUERIES["model_base"] = model_base
ORACLES["model_base"] = ORACLES["attach_station_counts"]


def station_share(spark, sf_dir):
    shares = aggregate.station_share(
        roles.cleaned(spark, sf_dir), "area", "week", "station", SPEC.stations, ROWS
    )
    return rounded(shares, *STATION_COLUMNS)


QUERIES["station_share"] = station_share
ORACLES["station_share"] = f"""WITH {roles.CLEANED_SQL}
SELECT area, week, {", ".join(
    f"round(avg(CASE WHEN station = '{v}' THEN 1.0 ELSE 0.0 END), 8) AS {n}"
    for v, n in SPEC.stations.items())}
FROM cleaned GROUP BY area, week"""


def cases_per_week(spark, sf_dir):
    return aggregate.cases_per_week(roles.base(spark, sf_dir), "week", "cases")


QUERIES["cases_per_week"] = cases_per_week
ORACLES["cases_per_week"] = f"""WITH {roles.CLEANED_SQL}
SELECT week, count(*) AS cases FROM cleaned GROUP BY week ORDER BY week"""


def cases_per_area(spark, sf_dir):
    return aggregate.cases_per_area(roles.base(spark, sf_dir), "area", "cases")


QUERIES["cases_per_area"] = cases_per_area
ORACLES["cases_per_area"] = f"""WITH {roles.CLEANED_SQL}
SELECT area, count(*) AS cases FROM cleaned GROUP BY area ORDER BY cases DESC, area"""


def cases_by_source(spark, sf_dir):
    return report.cases_by_source(
        roles.cases(spark, sf_dir), ["source", "area", "week"], "cases"
    )


QUERIES["cases_by_source"] = cases_by_source
ORACLES["cases_by_source"] = f"""WITH {roles.CASES_SQL}
SELECT source, area, week, count(*) AS cases FROM cases GROUP BY source, area, week"""


def _history_and_predictions(spark, sf_dir):
    base = tables.written(roles.base(spark, sf_dir), "base")
    scored = base.withColumn("prediction", fixed_prediction())
    return base, merge.as_base_rows(scored, SPEC.base_columns, "cases", kind="kind")


def _merged(spark, sf_dir, mode="union_distinct"):
    base, predicted = _history_and_predictions(spark, sf_dir)
    return merge.merge_predictions(
        base, predicted, ["area", "week"], mode, "week", "cases", "kind"
    )


def merge_predictions(spark, sf_dir):
    return rounded(_merged(spark, sf_dir), *SPEC.means)


QUERIES["merge_predictions"] = merge_predictions
ORACLES["merge_predictions"] = f"""WITH {roles.MERGED_SQL}
SELECT {roles.ROUNDED_BASE_SQL} FROM merged"""


def merge_replace_by_key(spark, sf_dir):
    """Predictions for every key, then other ones for the weeks of 1998 only."""
    merged = _merged(spark, sf_dir)
    again = merged.filter("kind = 'previsto' AND week LIKE '1998%'").withColumn(
        "cases", F.col("cases") + 1
    )
    replaced = merge.merge_predictions(
        merged, again, ["area", "week"], "replace_by_key", "week", "cases", "kind"
    )
    return rounded(replaced, *SPEC.means)


QUERIES["merge_replace_by_key"] = merge_replace_by_key
ORACLES["merge_replace_by_key"] = f"""WITH {roles.MERGED_SQL},
replaced AS (
  SELECT * REPLACE (CASE WHEN kind = 'previsto' AND week LIKE '1998%' THEN cases + 1
                         ELSE cases END AS cases)
  FROM merged
)
SELECT {roles.ROUNDED_BASE_SQL} FROM replaced"""


def table_overwrite(spark, sf_dir):
    """A partitioned folder: history written once, the predictions replaced by later ones."""
    base, predicted = _history_and_predictions(spark, sf_dir)
    path = scratch_path(spark, "base-table")
    tables.overwrite_folder(stored_rows(base, SPEC), path, ["kind"])
    first = predicted.withColumn("cases", F.lit(0.0))
    for predictions in (first, predicted):
        tables.overwrite_partitions(stored_rows(predictions, SPEC), path, ["kind"])
    declared = stored_rows(predicted, SPEC).schema
    return rounded(tables.read_folder(spark, path, declared), *SPEC.means)


QUERIES["table_overwrite"] = table_overwrite
ORACLES["table_overwrite"] = ORACLES["merge_predictions"]


def catalog_overwrite(spark, sf_dir):
    """A catalog table made once if absent, its predictions replaced by later ones, read by name."""
    base, predicted = _history_and_predictions(spark, sf_dir)
    name = f"areacast_base_{uuid.uuid4().hex}"
    where = tables.CatalogTable(name, scratch_path(spark, "catalog"))
    for history in (base, base.limit(0)):
        tables.create_table(stored_rows(history, SPEC), name, ["kind"], path=where.path)
    for predictions in (predicted.withColumn("cases", F.lit(0.0)), predicted):
        where.replace_partitions(stored_rows(predictions, SPEC), ["kind"])
    stored = where.read(spark, base_schema(SPEC)).select(*SPEC.base_columns)
    return rounded(stored, *SPEC.means)


QUERIES["catalog_overwrite"] = catalog_overwrite
ORACLES["catalog_overwrite"] = ORACLES["merge_predictions"]


def enrich_weather_bucketed(spark, sf_dir):
    """Cases and weather stored in buckets by station and day, joined without a shuffle."""
    with_area = joins.enrich_area(
        roles.cases(spark, sf_dir), roles.areas(spark, sf_dir), "area", "dim_area"
    )
    stored = {}
    for role, rows, keys in (
        ("cases", with_area, ["station", "onset"]), ("weather", roles.obs(spark, sf_dir), ["obs_station", "obs_date"]),
    ):
        stored[role] = f"areacast_{role}_{uuid.uuid4().hex}"
        tables.create_table(
            rows, stored[role], bucket_by=keys, buckets=8, path=scratch_path(spark, role)
        )
    joined = joins.enrich_weather(
        tables.read_table(spark, stored["cases"]), tables.read_table(spark, stored["weather"]),
        "station", "onset", "obs_station", "obs_date",
    )
    return joined.select(
        "case_id", "station", iso_day("onset").alias("onset"), "temp_max", "temp_min", "temp_mean"
    )


QUERIES["enrich_weather_bucketed"] = enrich_weather_bucketed
ORACLES["enrich_weather_bucketed"] = ORACLES["enrich_weather_left"]


def actual_vs_predicted(spark, sf_dir):
    compared = report.actual_vs_predicted(
        _merged(spark, sf_dir), "area", "week", "cases", "kind"
    )
    return rounded(compared, "delta_pct")


QUERIES["actual_vs_predicted"] = actual_vs_predicted
ORACLES["actual_vs_predicted"] = f"""WITH {roles.MERGED_SQL},
compared AS (
  SELECT area, CAST(week AS INTEGER) % 100 AS week_number,
         sum(cases) FILTER (WHERE kind = 'original') AS actual,
         sum(cases) FILTER (WHERE kind = 'previsto') AS predicted
  FROM merged GROUP BY 1, 2
)
SELECT area, week_number, actual, predicted, predicted - actual AS delta,
       round(CASE WHEN actual <> 0 THEN (predicted - actual) / actual * 100 END, 8) AS delta_pct
FROM compared"""


def _ranking(top):
    def query(spark, sf_dir):
        ranked = report.campaign_ranking(
            _merged(spark, sf_dir), FIRST_WEEK, LAST_WEEK, top, "area", "week", "cases", "kind"
        )
        return rounded(ranked, "cumulative_share")

    return query


_RANKED_SQL = f"""WITH {roles.MERGED_SQL},
totals AS (
  SELECT area, sum(cases) AS predicted FROM merged
  WHERE kind = 'previsto' AND CAST(week AS INTEGER) BETWEEN {FIRST_WEEK} AND {LAST_WEEK}
  GROUP BY area
),
ranked AS (
  SELECT area, predicted, row_number() OVER (ORDER BY predicted DESC, area) AS rank,
         round(sum(predicted) OVER (ORDER BY predicted DESC, area ROWS UNBOUNDED PRECEDING)
               / sum(predicted) OVER (), 8) AS cumulative_share
  FROM totals
)
SELECT area, predicted, rank, cumulative_share FROM ranked"""
QUERIES["campaign_ranking"] = _ranking(None)
ORACLES["campaign_ranking"] = _RANKED_SQL
QUERIES["campaign_top"] = _ranking(10)
ORACLES["campaign_top"] = f"{_RANKED_SQL} WHERE rank <= 10"


def model_base_share(spark, sf_dir):
    """The model base with the stations as shares of the area's rows of the week."""
    base = roles.base(spark, sf_dir, roles.SHARE_SPEC)
    return rounded(base, *SPEC.means, *STATION_COLUMNS)


QUERIES["model_base_share"] = model_base_share
ORACLES["model_base_share"] = f"""WITH {roles.CLEANED_SQL}
SELECT area, week, count(*) AS cases,
       {", ".join(f"round(avg({m}), 8) AS {m}" for m in SPEC.means)},
       {", ".join(f"round(avg(CASE WHEN station = '{v}' THEN 1.0 ELSE 0.0 END), 8) AS {n}"
                  for v, n in SPEC.stations.items())},
       'original' AS kind
FROM cleaned GROUP BY area, week"""


def undeclared_stations(spark, sf_dir):
    """Case rows of stations without a column, when only two are declared."""
    declared = {"ASIA": "st_asia", "EUROPE": "st_europe"}
    return aggregate.undeclared_stations(
        roles.cleaned(spark, sf_dir), "station", declared, weight=ROWS
    )


QUERIES["undeclared_stations"] = undeclared_stations
ORACLES["undeclared_stations"] = f"""WITH {roles.CLEANED_SQL}
SELECT station, count(*) AS n_rows FROM cleaned
WHERE station NOT IN ('ASIA', 'EUROPE') GROUP BY station"""
