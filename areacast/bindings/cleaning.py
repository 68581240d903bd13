"""Sources, schema and cleaning operators on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from areacast.bindings import roles
from areacast.bindings.roles import iso_day, rounded, table
from areacast.fixed import REQUEST_BOUNDS, WEATHER_HEADERS
from areacast.functions import (
    compose_label,
    concat_key,
    date_key,
    decimal_comma,
    fold_accents,
    label_area,
    label_station,
    parse_date,
    to_decimal_comma,
    week_key_calendar,
    week_key_iso,
)
from areacast.operators import clean, schema
from areacast.session import scratch_path
from areacast.sources import delimited, rejects, requests, tables

QUERIES = {}
ORACLES = {}


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "weather")
    delimited.write_delimited(roles.obs_text(spark, sf_dir), path, sep=";")
    declared = "obs_station string, obs_date string, " + ", ".join(
        f"{m} string" for m in roles.OBS_MEASURES
    )
    read = delimited.read_delimited(spark.read, path, declared, sep=";")
    parsed = clean.parse_measures(
        clean.parse_dates(read, {"obs_date": "dd/MM/yyyy"}), roles.OBS_MEASURES
    )
    return parsed.withColumn("obs_date", iso_day("obs_date"))


QUERIES["csv_roundtrip"] = csv_roundtrip
ORACLES["csv_roundtrip"] = f"""WITH {roles.OBS_SQL}
SELECT obs_station, strftime(obs_date, '%Y-%m-%d') AS obs_date, rain, temp_max, temp_min, temp_mean
FROM obs"""


def score_request_rows(spark, sf_dir):
    form = roles.form(spark, sf_dir)
    area = requests.area_rows(form).select(
        F.lit("areas").alias("file"), "bairro", "populacao", "estacao"
    )
    weather = requests.weather_rows(form).withColumnRenamed("nome_estacao", "estacao")
    both = area.unionByName(
        weather.withColumn("file", F.lit("weather")), allowMissingColumns=True
    )
    return both.withColumn("populacao", F.col("populacao").cast("double"))


QUERIES["score_request_rows"] = score_request_rows
ORACLES["score_request_rows"] = f"""WITH {roles.FORM_SQL},
texts AS (
  SELECT split_part(label, ' - ', 1) AS bairro, split_part(label, ' - ', 2) AS estacao,
         CAST(population AS DOUBLE) AS populacao, strftime(day, '%d/%m/%Y') AS data,
         replace(CAST(CAST(rain AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') AS precipitacao,
         replace(CAST(CAST(temp_max AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') AS temp_maxima,
         replace(CAST(CAST(temp_min AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') AS temp_minima,
         replace(CAST(CAST(temp_mean AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') AS temp_comp_media
  FROM form
)
SELECT 'areas' AS file, bairro, populacao, estacao, CAST(NULL AS VARCHAR) AS codigo_estacao,
       CAST(NULL AS VARCHAR) AS data, CAST(NULL AS VARCHAR) AS precipitacao,
       CAST(NULL AS VARCHAR) AS temp_maxima, CAST(NULL AS VARCHAR) AS temp_minima,
       CAST(NULL AS VARCHAR) AS temp_comp_media
FROM texts
UNION ALL
SELECT 'weather', NULL, NULL, estacao, '0', data, precipitacao, temp_maxima, temp_minima,
       temp_comp_media
FROM texts"""


def preview_first_n(spark, sf_dir):
    first = tables.preview(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 100)
    return first.select("o_orderkey", "o_custkey", iso_day("o_orderdate").alias("day"))


QUERIES["preview_first_n"] = preview_first_n
ORACLES["preview_first_n"] = """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day
FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100"""


def normalize_headers(spark, sf_dir):
    weather = roles.obs_text(spark, sf_dir).select(
        F.upper("obs_station").alias("Código da estação"),
        F.col("obs_station").alias("Nome da estação"),
        F.col("obs_date").alias("Data"),
        F.col("rain").alias("Precipitação"),
        F.col("temp_max").alias("Temp. Máxima"),
        F.col("temp_min").alias("Temp. Mínima"),
        F.col("temp_mean").alias("Temp. Comp. Média"),
    )
    return schema.normalize_headers(weather, WEATHER_HEADERS)


QUERIES["normalize_headers"] = normalize_headers
ORACLES["normalize_headers"] = f"""WITH {roles.OBS_TEXT_SQL}
SELECT upper(obs_station) AS codigo_estacao, obs_station AS "Nome_estacao", obs_date AS "Data",
       rain AS "Precipitacao", temp_max AS temp_maxima, temp_min AS temp_minima,
       temp_mean AS temp_comp_media
FROM obs_text"""


def tag_source(spark, sf_dir):
    united = roles.harmonized_union(
        list(roles.prepared_files(spark, sf_dir).values()), {"notificacao_ano": "int"}
    )
    return united.select("case_id", "source", "zika")


QUERIES["tag_source"] = tag_source
ORACLES["tag_source"] = f"WITH {roles.CASES_SQL} SELECT case_id, source, zika FROM cases"


def drop_columns(spark, sf_dir):
    names = ["l_shipdate", "l_returnflag", "l_linestatus", "l_tax", "l_discount", "no_such_column"]
    return schema.drop_columns(table(spark, sf_dir, "lineitem"), names)


QUERIES["drop_columns"] = drop_columns
ORACLES["drop_columns"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem"""


def conform_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return schema.conform_columns(rows, ["c_acctbal", "st_africa", "st_asia"])


QUERIES["conform_columns"] = conform_columns
ORACLES["conform_columns"] = """
SELECT c_custkey, c_acctbal, 0 AS st_africa, 0 AS st_asia FROM customer"""


def concat_keys(spark, sf_dir):
    return roles.obs_text(spark, sf_dir).select(
        concat_key(F.col("obs_station"), F.col("obs_date")).alias("obs_key"),
        concat_key(F.col("obs_station"), F.col("obs_date"), separator="|").alias("obs_key_bar"),
        concat_key(F.col("obs_station"), F.col("temp_min")).alias("key_or_null"),
    )


QUERIES["concat_key"] = concat_keys
ORACLES["concat_key"] = f"""WITH {roles.OBS_TEXT_SQL}
SELECT obs_station || obs_date AS obs_key, obs_station || '|' || obs_date AS obs_key_bar,
       obs_station || temp_min AS key_or_null
FROM obs_text"""


def decimal_commas(spark, sf_dir):
    text = F.when(F.col("l_tax") == 0, None).when(F.col("l_discount") == 0, "x")
    text = text.otherwise(to_decimal_comma(F.col("l_extendedprice")))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", decimal_comma(text).alias("value")
    )


QUERIES["decimal_comma"] = decimal_commas
ORACLES["decimal_comma"] = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_tax = 0 OR l_discount = 0 THEN NULL ELSE l_extendedprice END AS value
FROM lineitem"""


def parse_rejects(spark, sf_dir):
    text = roles.obs_text(spark, sf_dir)
    wrong = "yyyy-MM-dd"
    return clean.count_rejects(text, {
        "rain": decimal_comma(F.col("rain")),
        "temp_min": decimal_comma(F.col("temp_min")),
        "obs_date": parse_date(F.col("obs_date"), wrong),
    })


QUERIES["parse_rejects"] = parse_rejects
ORACLES["parse_rejects"] = f"""WITH {roles.OBS_TEXT_SQL}
SELECT 'rain' AS column_name, count(*) FILTER (WHERE rain = 'n/d') AS n_rejects FROM obs_text
UNION ALL SELECT 'temp_min', 0
UNION ALL SELECT 'obs_date', count(*) FROM obs_text"""


def parse_dates(spark, sf_dir):
    files = roles.case_files(spark, sf_dir)
    parsed = [
        clean.parse_dates(files["dengue"], {"onset": "dd-MM-yyyy"}),
        clean.parse_dates(files["chikungunya"], {"onset": "yyyy-MM-dd"}),
        clean.parse_dates(files["zika"], {"onset": "yyyy-MM-dd"}),
    ]
    misread = clean.parse_dates(files["dengue"], {"onset": "yyyy-MM-dd"})
    rows = schema.harmonized_union([
        df.select("case_id", iso_day("onset").alias("onset"), F.lit(note).alias("format"))
        for df, note in [*[(p, "right") for p in parsed], (misread, "wrong")]
    ])
    return rows


QUERIES["parse_dates"] = parse_dates
ORACLES["parse_dates"] = """
SELECT o_orderkey AS case_id, strftime(o_orderdate, '%Y-%m-%d') AS onset, 'right' AS format
FROM orders
UNION ALL SELECT o_orderkey, NULL, 'wrong' FROM orders WHERE o_orderstatus = 'F'"""


def date_key_string(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", date_key(F.col("o_orderdate").cast("date")).alias("date_key")
    )


QUERIES["date_key_string"] = date_key_string
ORACLES["date_key_string"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d 00:00:00') AS date_key FROM orders"""


def _week_keys(key):
    def query(spark, sf_dir):
        day = F.col("o_orderdate").cast("date")
        return table(spark, sf_dir, "orders").select(
            "o_orderkey", key(day).alias("week"), key(day, as_text=True).alias("week_text")
        )

    return query


QUERIES["week_key_calendar"] = _week_keys(week_key_calendar)
QUERIES["week_key_iso"] = _week_keys(week_key_iso)
for _name, _year in (("week_key_calendar", "year"), ("week_key_iso", "isoyear")):
    ORACLES[_name] = f"""
SELECT o_orderkey,
       CAST(extract({_year} FROM o_orderdate) * 100 + extract(week FROM o_orderdate) AS INTEGER)
         AS week,
       extract({_year} FROM o_orderdate) || lpad(CAST(extract(week FROM o_orderdate) AS VARCHAR),
         2, '0') AS week_text
FROM orders"""


def impute_mean(spark, sf_dir):
    filled = clean.impute_mean(roles.obs(spark, sf_dir), roles.OBS_MEASURES)
    return rounded(filled, *roles.OBS_MEASURES).withColumn("obs_date", iso_day("obs_date"))


QUERIES["impute_mean"] = impute_mean
ORACLES["impute_mean"] = f"""WITH {roles.OBS_SQL}
SELECT obs_station, strftime(obs_date, '%Y-%m-%d') AS obs_date,
       {", ".join(f"round(coalesce({m}, (SELECT avg({m}) FROM obs)), 8) AS {m}"
                  for m in roles.OBS_MEASURES)}
FROM obs"""


def sentinel_fill(spark, sf_dir):
    named = roles.cases(spark, sf_dir).select("case_id", "area", "priority")
    return clean.sentinel_fill(named, ["area", "priority"])


QUERIES["sentinel_fill"] = sentinel_fill
ORACLES["sentinel_fill"] = f"""WITH {roles.CASES_SQL}
SELECT case_id, upper(coalesce(area, 'SEM_INFORMACAO')) AS area,
       upper(coalesce(priority, 'SEM_INFORMACAO')) AS priority
FROM cases"""


def alias_values(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    renamed = clean.alias_values(customer, ["c_mktsegment"], {"HOUSEHOLD": "CABROBÓ"})
    return renamed.withColumn("folded", fold_accents(F.col("c_mktsegment")))


QUERIES["alias_values"] = alias_values
ORACLES["alias_values"] = """
SELECT c_custkey, replace(c_mktsegment, 'HOUSEHOLD', 'CABROBÓ') AS c_mktsegment,
       replace(c_mktsegment, 'HOUSEHOLD', 'CABROBO') AS folded
FROM customer"""


def compose_split_label(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", compose_label(F.col("p_brand"), F.concat("p_type", F.lit(" - "), "p_name"))
        .alias("label")
    )
    label = F.col("label")
    return rows.withColumns({
        "area": label_area(label),
        "station": label_station(label),
        "without_separator": label_station(F.lit("none")),
    })


QUERIES["compose_split_label"] = compose_split_label
ORACLES["compose_split_label"] = """
SELECT p_partkey, p_brand || ' - ' || p_type || ' - ' || p_name AS label, p_brand AS area,
       p_type || ' - ' || p_name AS station, CAST(NULL AS VARCHAR) AS without_separator
FROM part"""


def validate_requests(spark, sf_dir):
    checked = requests.check_requests(roles.form(spark, sf_dir), REQUEST_BOUNDS)
    return checked.select("l_orderkey", "l_linenumber", "reject_reasons")


QUERIES["validate_requests"] = validate_requests
ORACLES["validate_requests"] = f"""WITH {roles.FORM_SQL}
SELECT l_orderkey, l_linenumber, concat_ws(',',
         CASE WHEN population NOT BETWEEN 1 AND 1000000 THEN 'populacao' END,
         CASE WHEN rain NOT BETWEEN 0.01 AND 100 THEN 'precipitacao' END,
         CASE WHEN temp_max NOT BETWEEN 1 AND 50 THEN 'temp_maxima' END,
         CASE WHEN temp_min NOT BETWEEN 1 AND 50 THEN 'temp_minima' END,
         CASE WHEN temp_mean NOT BETWEEN 1 AND 50 THEN 'temp_comp_media' END,
         CASE WHEN temp_min > temp_max THEN 'temp_minima>temp_maxima' END) AS reject_reasons
FROM form"""


REJECT_BOUNDS = {m: (1, 50) for m in ("temp_max", "temp_min", "temp_mean")}
FILE_COLUMNS = ["obs_station", "obs_date", *roles.OBS_MEASURES]


def _weather_lines(spark, sf_dir):
    """A weather file of which some lines have a field too many, a day that does not exist or no station."""
    day = F.substring("obs_date", 1, 2)
    text = roles.obs_text(spark, sf_dir).withColumns({
        "obs_station": F.when(day != "07", F.col("obs_station")),
        "obs_date": F.when(day == "17", F.concat(F.lit("31/02/"), F.substring("obs_date", 7, 4)))
        .otherwise(F.col("obs_date")),
        "more": F.when(day == "13", F.lit(";x")),
    })
    line = F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in FILE_COLUMNS])
    path = scratch_path(spark, "lines")
    text.select(F.concat(line, F.coalesce("more", F.lit("")))).write.text(path)
    return path


def _checked(source, path):
    lines = rejects.read_lines(source, path, FILE_COLUMNS, header=False)
    return rejects.check_weather(
        lines, roles.OBS_MEASURES, "obs_date", "obs_station", REJECT_BOUNDS, ("temp_min", "temp_max")
    )


def _verdicts(checked, out):
    """Accepted rows, and rejected ones by reason."""
    kept = rejects.sorted_rows(checked, out, rejects.ACCEPTED)
    counts = rejects.reason_counts(rejects.sorted_rows(checked, out, rejects.REJECTED))
    return counts.unionByName(kept.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("reason", F.lit("")))


def file_rejects(spark, sf_dir):
    """A weather file sorted into accepted and rejected rows."""
    checked = _checked(spark.read, _weather_lines(spark, sf_dir))
    out = scratch_path(spark, "sorted")
    rejects.sort_out(checked, out)
    return _verdicts(checked, out)


def stream_file_rejects(spark, sf_dir):
    """The same as the files arrive."""
    checked = _checked(spark.readStream, _weather_lines(spark, sf_dir))
    out = scratch_path(spark, "sorted")
    rejects.sort_out_stream(checked, out, scratch_path(spark, "progress"))
    return _verdicts(checked, out)


QUERIES["file_rejects"] = file_rejects
QUERIES["stream_file_rejects"] = stream_file_rejects
ORACLES["file_rejects"] = f"""WITH {roles.OBS_TEXT_SQL},
numbers AS (
  SELECT substr(obs_date, 1, 2) AS day, rain,
         CAST(replace(temp_max, ',', '.') AS DOUBLE) AS temp_max,
         CAST(replace(temp_min, ',', '.') AS DOUBLE) AS temp_min,
         CAST(replace(temp_mean, ',', '.') AS DOUBLE) AS temp_mean
  FROM obs_text
),
reasons AS (
  SELECT CASE WHEN day = '13' THEN ['line'] ELSE list_filter([
    CASE WHEN day = '07' THEN 'obs_station' END, CASE WHEN day = '17' THEN 'obs_date' END,
    CASE WHEN rain = 'n/d' THEN 'rain' END,
    {", ".join(f"CASE WHEN {m} NOT BETWEEN 1 AND 50 THEN '{m}' END" for m in REJECT_BOUNDS)},
    CASE WHEN temp_min > temp_max THEN 'temp_min>temp_max' END], lambda r: r IS NOT NULL) END AS found
  FROM numbers
)
SELECT reason, count(*) AS n_rows FROM (SELECT unnest(found) AS reason FROM reasons) GROUP BY reason
UNION ALL SELECT '', count(*) FROM reasons WHERE len(found) = 0"""
ORACLES["stream_file_rejects"] = ORACLES["file_rejects"]


def csv_latin1(spark, sf_dir):
    """Names with accents written and read in another encoding."""
    path = scratch_path(spark, "latin1")
    names = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit("ÁGUA ç "), "s_name").alias("name")
    )
    delimited.write_delimited(names, path, ";", encoding="ISO-8859-1")
    read = delimited.read_by_header(spark, path, ";", "ISO-8859-1")
    return delimited.typed(read, {"id": "bigint", "name": "string"})


QUERIES["csv_latin1"] = csv_latin1
ORACLES["csv_latin1"] = "SELECT s_suppkey AS id, 'ÁGUA ç ' || s_name AS name FROM supplier"


def harmonized_union(spark, sf_dir):
    rows = roles.cases(spark, sf_dir)
    return rows.withColumns({
        "onset": iso_day("onset"), "notificacao_ano": F.col("notificacao_ano").cast("int")
    })


QUERIES["harmonized_union"] = harmonized_union
ORACLES["harmonized_union"] = f"""WITH {roles.CASES_SQL}
SELECT case_id, area, week, strftime(onset, '%Y-%m-%d') AS onset, source, zika, notificacao_ano,
       priority, cost
FROM cases"""
