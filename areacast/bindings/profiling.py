"""Profiles of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from areacast.bindings import roles
from areacast.bindings.roles import SPEC, rounded, table
from areacast.fixed import DAY_FIRST_SLASH
from areacast.functions import is_reject
from areacast.operators import aggregate, profile
from areacast.operators.audit import StageAudit
from areacast.operators.clean import parse_dates, parse_measures
from areacast.operators.schema import harmonized_union
from areacast.plans.training_base import base_of, cleaned_cases, enriched_cases
from areacast.sources.tables import written

QUERIES = {}
ORACLES = {}
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PART_NAMES = ["p_name", "p_brand", "p_type"]
CASE_TYPES = {
    "case_id": "bigint",
    "week": "int",
    "onset": "date",
    "notificacao_ano": "int",
    "priority": "string",
    "source": "string",
    "zika": "int",
    "cost": "double",
    "area": "string",
}
CORRELATED = ["cases", "population", "temp_max", "temp_min", "temp_mean", "st_africa", "st_asia"]


def _union_sql(parts):
    return "\nUNION ALL ".join(parts)


def null_inventory(spark, sf_dir):
    return profile.null_inventory(roles.cases(spark, sf_dir))


QUERIES["null_inventory"] = null_inventory
ORACLES["null_inventory"] = f"""WITH {roles.CASES_SQL},
counts AS (
  {_union_sql(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls FROM cases"
              for c in CASE_TYPES)}
)
SELECT column_name, n_nulls FROM counts WHERE n_nulls > 0"""


def null_inventory_after(spark, sf_dir):
    """Null counts of the cleaned rows, checked to be none while they are read."""
    names = ["area", "station", *SPEC.means]
    checked = profile.assert_no_nulls(roles.cleaned(spark, sf_dir), names)
    return profile.null_counts(checked, names)


QUERIES["null_inventory_after"] = null_inventory_after
ORACLES["null_inventory_after"] = f"""WITH {roles.CLEANED_SQL}
{_union_sql(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls FROM cleaned"
            for c in ["area", "station", *SPEC.means])}"""


def column_info(spark, sf_dir):
    return profile.column_info(roles.cases(spark, sf_dir).select(*CASE_TYPES))


QUERIES["column_info"] = column_info
ORACLES["column_info"] = f"WITH {roles.CASES_SQL}\n" + _union_sql(
    f"SELECT '{c}' AS column_name, count({c}) AS n_non_null, '{t}' AS data_type FROM cases"
    for c, t in CASE_TYPES.items()
)


def stage_audit(spark, sf_dir):
    """Rows and columns of all stages of the base, counted by the writes that make it."""
    audit = StageAudit()
    files = {name: audit.watch(name, df) for name, df in roles.prepared_files(spark, sf_dir).items()}
    cases = audit.watch("union", roles.with_area(
        harmonized_union(list(files.values()), {"notificacao_ano": "int"}), spark, sf_dir
    ))
    areas = audit.watch("areas", roles.areas(spark, sf_dir))
    weather = audit.watch("weather", roles.obs(spark, sf_dir))
    enriched = written(enriched_cases(cases, areas, weather, SPEC), "enriched")
    written(audit.watch("base", base_of(cleaned_cases(enriched, SPEC), SPEC)), "base")
    return audit.stages(spark)


def audit_rejects(spark, sf_dir):
    """Values that the parse of the weather could not read, per column, counted by the one write."""
    raw = roles.obs_text(spark, sf_dir)
    names = ["obs_date", *roles.OBS_MEASURES]
    kept = raw.withColumns({f"_raw_{n}": F.col(n) for n in names})
    parsed = parse_measures(parse_dates(kept, {"obs_date": DAY_FIRST_SLASH}), roles.OBS_MEASURES)
    audit = StageAudit()
    counts = {n: is_reject(F.col(f"_raw_{n}"), F.col(n)) for n in names}
    written(audit.watch("weather", parsed, counts), "weather")
    return audit.counts(spark)


QUERIES["audit_rejects"] = audit_rejects
ORACLES["audit_rejects"] = f"""WITH {roles.OBS_TEXT_SQL},
n AS (SELECT count(*) FILTER (WHERE rain = 'n/d') AS rain FROM obs_text)
SELECT 'weather' AS stage, c AS counted,
       CASE WHEN c = 'rain' THEN (SELECT rain FROM n) ELSE CAST(0 AS BIGINT) END AS n_rows
FROM (VALUES ('obs_date'), ('rain'), ('temp_max'), ('temp_min'), ('temp_mean')) v(c)"""


QUERIES["stage_audit"] = stage_audit
ORACLES["stage_audit"] = f"""WITH {roles.BASE_SQL}
SELECT 'dengue' AS stage, count(*) AS n_rows, 8 AS n_columns FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'chikungunya', count(*), 7 FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'zika', count(*), 8 FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'areas', count(*), 3 FROM areas
UNION ALL SELECT 'weather', count(*), 6 FROM obs
UNION ALL SELECT 'union', count(*), 9 FROM cases
UNION ALL SELECT 'base', count(*), {len(SPEC.base_columns)} FROM base"""


def value_counts(spark, sf_dir):
    return aggregate.value_counts(table(spark, sf_dir, "part"), "p_brand")


QUERIES["value_counts"] = value_counts
ORACLES["value_counts"] = """
SELECT p_brand, count(*) AS count FROM part WHERE p_brand IS NOT NULL
GROUP BY p_brand ORDER BY count DESC, p_brand"""


def describe_numeric(spark, sf_dir):
    described = profile.describe_numeric(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)
    return rounded(described, "mean", "std", "q25", "q50", "q75", digits=7)


QUERIES["describe_numeric"] = describe_numeric
ORACLES["describe_numeric"] = _union_sql(
    f"""SELECT '{c}' AS column_name, count({c}) AS n_values, round(avg({c}), 7) AS mean,
       round(stddev_samp({c}), 7) AS std, min({c}) AS min_value, max({c}) AS max_value,
       round(quantile_cont({c}, 0.25), 7) AS q25, round(quantile_cont({c}, 0.5), 7) AS q50,
       round(quantile_cont({c}, 0.75), 7) AS q75 FROM lineitem"""
    for c in LINE_NUMBERS
)


def describe_categorical(spark, sf_dir):
    return profile.describe_categorical(table(spark, sf_dir, "part"), PART_NAMES)


QUERIES["describe_categorical"] = describe_categorical
ORACLES["describe_categorical"] = _union_sql(
    f"""SELECT '{c}' AS column_name, count({c}) AS n_values, count(DISTINCT {c}) AS n_unique,
       (SELECT {c} FROM part GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
       (SELECT count(*) FROM part GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq FROM part"""
    for c in PART_NAMES
)


def headline_facts(spark, sf_dir):
    base = written(roles.base(spark, sf_dir), "base")
    facts = profile.headline_facts(
        base, "area", "week", "cases", "population", ["temp_max", "temp_min"]
    )
    figures = [c for c in facts.columns if c.startswith(("mean_", "std_"))]
    return rounded(facts, *figures, digits=6)


QUERIES["headline_facts"] = headline_facts
ORACLES["headline_facts"] = f"""WITH {roles.BASE_SQL},
weekly AS (SELECT week, CAST(sum(cases) AS BIGINT) AS total FROM base GROUP BY week)
SELECT count(*) AS n_rows, count(DISTINCT week) AS n_weeks, count(DISTINCT area) AS n_areas,
       max(cases) AS max_cases, round(avg(population), 6) AS mean_population,
       round(avg(temp_max), 6) AS mean_temp_max, round(avg(temp_min), 6) AS mean_temp_min,
       round(stddev_samp(temp_max), 6) AS std_temp_max,
       round(stddev_samp(temp_min), 6) AS std_temp_min,
       (SELECT week FROM weekly ORDER BY total DESC, week LIMIT 1) AS peak_week,
       (SELECT max(total) FROM weekly) AS peak_week_cases
FROM base"""


def correlation_matrix(spark, sf_dir):
    matrix = profile.correlation_matrix(roles.base(spark, sf_dir), CORRELATED)
    return rounded(matrix, "correlation", digits=6)


QUERIES["correlation_matrix"] = correlation_matrix
ORACLES["correlation_matrix"] = f"WITH {roles.BASE_SQL}\n" + _union_sql(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), 6) AS correlation FROM base"
    for a in CORRELATED
    for b in CORRELATED
)


def correlation_pairs(spark, sf_dir):
    pairs = profile.correlation_pairs(roles.base(spark, sf_dir), CORRELATED, above=0.05)
    return rounded(pairs, "correlation", digits=6)


QUERIES["correlation_pairs"] = correlation_pairs
_PAIRS_SQL = _union_sql(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, abs(corr({a}, {b})) AS r FROM base"
    for i, a in enumerate(CORRELATED)
    for b in CORRELATED[i + 1 :]
)
ORACLES["correlation_pairs"] = f"""WITH {roles.BASE_SQL},
pairs AS ({_PAIRS_SQL})
SELECT feature_1, feature_2, round(r, 6) AS correlation FROM pairs WHERE r > 0.05 AND r <> 1.0"""
