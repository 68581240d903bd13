"""The jobs: ``build-base``, ``train``, ``score``, ``forms``, ``features``, ``arrivals`` and ``check-files``. Also runs under spark-submit.

    python -m areacast.jobs build-base \\
        --cases dengue=/data/dengue.csv --cases zika=/data/zika.csv \\
        --encoding dengue=ISO-8859-1 --areas /data/areas.csv --weather /data/stations.csv \\
        --base /data/base --means /data/means

A base is a folder (``--base``) or a table of the catalog (``--base-table``).
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import ImputerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.fixed import AREA_HEADERS, CASE_SOURCES, DAY_FIRST_SLASH
from areacast.functions import is_reject
from areacast.operators import learn
from areacast.operators.aggregate import undeclared_stations
from areacast.operators.audit import StageAudit
from areacast.operators.joins import fanout_audit
from areacast.operators.schema import normalize_headers
from areacast.plans import score as scoring
from areacast.plans import train as training
from areacast.plans import training_base as building
from areacast.plans.spec import BaseSpec
from areacast.session import build_session
from areacast.sources import delimited, rejects, requests, tables
from areacast.streaming import arrivals


def read_areas(spark: SparkSession, path: str, sep: str, spec: BaseSpec) -> DataFrame:
    named = normalize_headers(delimited.read_by_header(spark, path, sep), AREA_HEADERS)
    types = {spec.dim_area: "string", spec.population: "double", spec.station: "string"}
    return building.prepare_areas(delimited.typed(named, types), spec)


def read_weather(
    spark: SparkSession, path: str, sep: str, spec: BaseSpec, date_format: str = DAY_FIRST_SLASH
) -> DataFrame:
    return building.prepare_weather(delimited.read_by_header(spark, path, sep), spec, date_format)


def build_base(
    spark: SparkSession,
    case_paths: dict[str, str],
    areas_path: str,
    weather_path: str,
    base_path: str | tables.Place,
    means_path: str,
    encodings: Mapping[str, str] | None = None,
    fanout: str = "keep",
    unified_path: str | tables.Place | None = None,
    spec: BaseSpec = BaseSpec(),
    weather_fanout: str = "keep",
    date_formats: Mapping[str, str] | None = None,
    separators: Mapping[str, str] | None = None,
    audit_path: str | None = None,
) -> dict[str, int]:
    """Write the base, partitioned by kind of row and week, and the means; give the audit counts.

    The cases are read once. Every stage is counted on the way, see :class:`StageAudit`; with ``audit_path`` its rows and its rejects are
    written as delimited files. Date formats and separators go by the name of the source, ``areas`` and ``weather`` included; a case file
    of a source without a fixed format has to name it.
    """
    formats, separators = dict(date_formats or {}), dict(separators or {})
    audit = StageAudit()
    prepared = {}
    for source, path in case_paths.items():
        encoding = (encodings or {}).get(source, "UTF-8")
        raw = delimited.read_by_header(spark, path, separators.get(source, ";"), encoding)
        known = CASE_SOURCES.get(source, {"zika": 0})
        if source not in formats and "date_format" not in known:
            raise ValueError(f"the date format of {source} is not known")
        day = "_raw_onset"
        raw = raw.withColumn(day, F.col(spec.onset))
        rows = building.prepare_cases(
            raw, source, formats.get(source) or known["date_format"], spec, zika=known["zika"]
        )
        rows = audit.watch(source, rows, {spec.onset: is_reject(F.col(day), F.col(spec.onset))})
        prepared[source] = rows.drop(day)
    cases = building.unified_cases(prepared)
    if unified_path:
        unified = tables.place(unified_path)
        unified.replace(cases, [])
        cases = unified.read(spark, cases.schema)
    cases = audit.watch("union", cases.withColumn(spec.week, F.col(spec.week).try_cast("int")), {
        "without_area": F.col(spec.area).isNull(),
        "without_day": F.col(spec.onset).isNull(),
        "without_week": F.col(spec.week).isNull(),
    })
    # The dimensions are written once: they are joined, and looked through for repeated keys.
    areas = tables.written(
        audit.watch("areas", read_areas(spark, areas_path, separators.get("areas", "|"), spec)), "areas"
    )
    lines = delimited.read_by_header(spark, weather_path, separators.get("weather", "|"))
    weather = tables.written(
        building.audited_weather(lines, audit, spec, formats.get("weather", DAY_FIRST_SLASH)), "weather"
    )
    enriched = building.enriched_cases(cases, areas, weather, spec, fanout, weather_fanout)
    enriched = tables.written(audit.watch("enriched", enriched), "enriched")
    means = building.training_means(enriched, spec)
    means.write.mode("overwrite").parquet(means_path)
    # The stored means fill the gaps: base and means agree, and the rows are not read again for them.
    means = spark.read.schema(means.schema).parquet(means_path)
    cleaned = building.cleaned_cases(enriched, spec, means)
    scoring.store(audit.watch("base", building.base_of(cleaned, spec)), base_path, spec)
    undeclared = undeclared_stations(cleaned, spec.station, spec.stations, weight=building.ROWS)
    unnamed = undeclared.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")).first()["n"]
    repeated = {
        "n_repeated_areas": fanout_audit(areas, [spec.dim_area]).count(),
        "n_repeated_weather": fanout_audit(weather, [spec.obs_station, spec.obs_date]).count(),
    }
    stages = audit.stages(spark)
    if audit_path:
        delimited.write_delimited(stages, f"{audit_path}/stages", mode="overwrite")
        delimited.write_delimited(audit.counts(spark), f"{audit_path}/counts", mode="overwrite")
    rows = {r["stage"]: r["n_rows"] for r in stages.collect()}
    gaps = {f"n_{r['counted']}": r["n_rows"] for r in audit.counts(spark).where("stage = 'union'").collect()}
    return {
        "n_cases": rows["union"], **gaps, "n_base_rows": rows["base"], **repeated,
        "n_undeclared_station": unnamed,
    }


def train(
    spark: SparkSession, base_path: str | tables.Place, model_path: str, report_path: str | None = None,
    spec: BaseSpec = BaseSpec(), means_path: str | None = None, **options,
) -> training.Trained:
    """Search, fit and save a model; with the means of the base it fills gaps by itself later."""
    base = tables.place(base_path).read(spark, scoring.base_schema(spec))
    trained = training.train(base, spec, **options)
    imputer = learn.fit_imputer(spark.read.parquet(means_path), spec.means) if means_path else None
    learn.save_model(trained.model, model_path, spec.station_encoding, imputer)
    if report_path:
        for name in ("report", "metrics", "importance"):
            delimited.write_delimited(
                getattr(trained, name), f"{report_path}/{name}", mode="overwrite"
            )
    return trained


def filling(
    spark: SparkSession, model_path: str, means_path: str | None, spec: BaseSpec
) -> ImputerModel | DataFrame | None:
    """What fills gaps: the model's own imputer unless means are named; None, the request itself, for ``request`` or a model without."""
    if means_path == "request":
        return None
    if means_path:
        return spark.read.parquet(means_path)
    return learn.load_imputer(model_path, spec.means)


def score(
    spark: SparkSession,
    areas_path: str,
    weather_path: str,
    model_path: str,
    base_path: str | tables.Place,
    means_path: str | None = None,
    mode: str = "replace_by_key",
    week_rule: str = "iso",
    spec: BaseSpec = BaseSpec(),
) -> None:
    """Score request files and publish the predictions into the base."""
    areas = read_areas(spark, areas_path, ";", spec)
    weather = read_weather(spark, weather_path, ";", spec)
    model = learn.load_model(model_path, spec.features, spec.station_encoding)
    means = filling(spark, model_path, means_path, spec)
    predicted = scoring.score(weather, areas, model, spec, means, week_rule)
    scoring.publish(predicted, base_path, spec, mode)


def forms(
    spark: SparkSession,
    forms_path: str,
    model_path: str,
    base_path: str | tables.Place,
    rejects_path: str | None = None,
    means_path: str | None = None,
    week_rule: str = "iso",
    spec: BaseSpec = BaseSpec(),
) -> None:
    """Score submitted forms, a delimited file with one form per line, and publish them; rejected ones are written with reasons."""
    submitted = delimited.read_delimited(spark.read, forms_path, requests.FORM)
    checked = tables.written(requests.check_requests(submitted), "forms")
    if rejects_path:
        delimited.write_delimited(requests.rejected(checked), rejects_path, ";", mode="overwrite")
    model = learn.load_model(model_path, spec.features, spec.station_encoding)
    means = filling(spark, model_path, means_path, spec)
    predicted = scoring.score_forms(checked.drop("reject_reasons"), model, spec, means, week_rule)
    scoring.publish(predicted, base_path, spec)


def features(
    spark: SparkSession, rows_path: str, model_path: str, out_path: str, keep: Sequence[str] = (),
    spec: BaseSpec = BaseSpec(), sep: str = ",",
) -> None:
    """Score a file that holds the features already, in any column order and without a label."""
    rows = delimited.read_by_header(spark, rows_path, sep)
    types = {**{k: "string" for k in keep}, **{f: "double" for f in spec.features}}
    model = learn.load_model(model_path, spec.features, spec.station_encoding)
    scored = scoring.score_features(delimited.typed(rows, types), model, spec.features, keep)
    delimited.write_delimited(scored, out_path, sep, mode="overwrite")


def arrive(
    spark: SparkSession,
    drop_path: str,
    areas_path: str,
    model_path: str,
    base_path: str | tables.Place,
    work_path: str,
    means_path: str | None = None,
    week_rule: str = "iso",
    spec: BaseSpec = BaseSpec(),
    columns: Sequence[str] = requests.WEATHER_COLUMNS,
) -> None:
    """Score the weather files that were dropped since the last run and publish them.

    ``work_path`` keeps the progress, the partials of all weeks and the rejected lines.
    """
    areas = read_areas(spark, areas_path, ";", spec)
    model = learn.load_model(model_path, spec.features, spec.station_encoding)
    means = filling(spark, model_path, means_path, spec)
    if means is None:
        raise ValueError("a stream has no means of its own: train with means, or name them")
    if isinstance(means, DataFrame):
        means = means.first().asDict()
    lines = rejects.read_lines(spark.readStream, drop_path, columns)
    checked = rejects.check_weather(lines, spec.measures, spec.obs_date, spec.obs_station)
    arrivals.publish_arrivals(
        checked, areas, model, means, f"{work_path}/state", base_path, f"{work_path}/progress", spec,
        week_rule, rejects_path=f"{work_path}/rejected",
    )


def check_files(
    spark: SparkSession,
    weather_path: str,
    out_path: str,
    progress_path: str | None = None,
    sep: str = ";",
    encoding: str = "UTF-8",
    spec: BaseSpec = BaseSpec(),
    columns: Sequence[str] = requests.WEATHER_COLUMNS,
) -> dict[str, int]:
    """Sort the lines of weather files into accepted and rejected ones; with a progress folder only new files.

    Gives the number of rejected rows of each reason.
    """
    source = spark.readStream if progress_path else spark.read
    lines = rejects.read_lines(source, weather_path, columns, sep, encoding)
    checked = rejects.check_weather(lines, spec.measures, spec.obs_date, spec.obs_station)
    if progress_path:
        rejects.sort_out_stream(checked, out_path, progress_path)
    else:
        rejects.sort_out(checked, out_path, "overwrite")
    counts = rejects.reason_counts(rejects.sorted_rows(checked, out_path, rejects.REJECTED))
    return {r["reason"]: r["n_rows"] for r in counts.collect()}


def _pairs(values: Sequence[str]) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="areacast")
    jobs = parser.add_subparsers(dest="job", required=True)
    build, learned, scored, formed, featured, arriving, checking = (
        jobs.add_parser(name) for name in
        ("build-base", "train", "score", "forms", "features", "arrivals", "check-files")
    )
    build.add_argument("--cases", action="append", required=True, metavar="SOURCE=PATH")
    build.add_argument("--encoding", action="append", default=[], metavar="SOURCE=NAME")
    build.add_argument("--date-format", action="append", default=[], metavar="SOURCE=FORMAT")
    build.add_argument("--separator", action="append", default=[], metavar="SOURCE=CHARACTER")
    build.add_argument("--fanout", choices=("keep", "first", "error"), default="keep")
    build.add_argument("--weather-fanout", choices=("keep", "first", "error"), default="keep")
    build.add_argument("--unified")
    build.add_argument("--unified-table")
    build.add_argument("--audit", help="folder for the counts of all stages")
    build.add_argument("--means", required=True)
    learned.add_argument("--report")
    learned.add_argument("--folds", type=int)
    learned.add_argument("--grid", choices=tuple(learn.GRIDS), default="default")
    learned.add_argument("--means", help="means that the model fills gaps with")
    scored.add_argument("--mode", choices=("replace_by_key", "union_distinct"),
                        default="replace_by_key")
    formed.add_argument("--forms", required=True)
    formed.add_argument("--rejects")
    featured.add_argument("--rows", required=True)
    featured.add_argument("--keep", action="append", default=[])
    arriving.add_argument("--drop", required=True, help="folder that files arrive in")
    arriving.add_argument("--work", required=True, help="progress, state and rejected lines")
    checking.add_argument("--progress", help="check new files only")
    for job in (featured, checking):
        job.add_argument("--out", required=True)
    for job in (scored, formed, arriving):
        job.add_argument("--week-rule", choices=("iso", "calendar"), default="iso")
        job.add_argument("--means", help="a folder of means, or 'request'; the model's own by default")
    for job in (build, scored, arriving):
        job.add_argument("--areas", required=True)
    for job in (build, scored, checking):
        job.add_argument("--weather", required=True)
    for job in (learned, scored, formed, featured, arriving):
        job.add_argument("--model", required=True)
    for job in (build, learned, scored, formed, arriving):
        where = job.add_mutually_exclusive_group(required=True)
        where.add_argument("--base")
        where.add_argument("--base-table")
    for job in (build, learned, scored, formed, featured, arriving, checking):
        job.add_argument("--stations", choices=("share", "count"), default="share",
                         help="how the station columns are encoded")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"areacast-{args.job}")
    spec = BaseSpec(station_encoding=args.stations)
    base = None
    if "base" in args:
        base = tables.CatalogTable(args.base_table) if args.base_table else tables.Folder(args.base)
    if args.job == "build-base":
        unified = tables.CatalogTable(args.unified_table) if args.unified_table else args.unified
        print(json.dumps(build_base(
            spark, _pairs(args.cases), args.areas, args.weather, base, args.means,
            _pairs(args.encoding), args.fanout, unified, spec, args.weather_fanout,
            _pairs(args.date_format), _pairs(args.separator), args.audit,
        )))
    elif args.job == "train":
        train(
            spark, base, args.model, args.report, spec, args.means,
            folds=args.folds or learn.FOLDS[args.grid], grid=learn.GRIDS[args.grid],
        )
    elif args.job == "score":
        score(spark, args.areas, args.weather, args.model, base, args.means, args.mode, args.week_rule, spec)
    elif args.job == "forms":
        forms(spark, args.forms, args.model, base, args.rejects, args.means, args.week_rule, spec)
    elif args.job == "features":
        features(spark, args.rows, args.model, args.out, args.keep, spec)
    elif args.job == "arrivals":
        arrive(spark, args.drop, args.areas, args.model, base, args.work, args.means, args.week_rule, spec)
    else:
        print(json.dumps(check_files(spark, args.weather, args.out, args.progress, spec=spec)))


if __name__ == "__main__":
    main()
