from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from areacast import jobs
from areacast.operators import learn
from areacast.plans import score
from areacast.plans.spec import BaseSpec
from areacast.plans.training_base import enriched_cases, prepare_weather
from areacast.sources import delimited, requests, tables
from areacast.streaming import arrivals, rollup
from tests.conftest import rows

SPEC = BaseSpec()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Case, area and weather files as they arrive, and the base built from them."""
    root = tmp_path_factory.mktemp("files")
    (root / "areas.csv").write_text(
        "Bairro|População|Estação\nCOHAB||CABROBÓ\nCOHAB|67283|RECIFE\nAFLITOS|5773|RECIFE\n"
    )
    days = range(1, 29)
    weather = ["Código da estação|Nome da estação|Data|Key|Precipitação|Temp. Máxima|"
               "Temp. Mínima|Temp. Comp. Média"]
    weather += [f"1|{name}|{d:02}/02/2016|k|0,1|{30 + d % 5},5|2{d % 3},0|{25 + d % 2},0"
                for d in days for name in ("RECIFE", "CABROBÓ")]
    (root / "weather.csv").write_text("\n".join(weather) + "\n")
    dengue = ["nu_notificacao;no_bairro_residencia;ds_semana_notificacao;dt_diagnostico_sintoma;febre"]
    dengue += [f"{i};{['COHAB', 'AFLITOS'][i % 2]};{201605 + i % 20};{d:02}-02-2016;1"
               for i, d in enumerate(list(days) * 3)]
    dengue += ["999;ÁGUA FRIA;201605;31-02-2016;1"]
    (root / "dengue.csv").write_bytes(("\n".join(dengue) + "\n").encode("latin-1"))
    (root / "zika.csv").write_text(
        "no_bairro_residencia;ds_semana_notificacao;dt_diagnostico_sintoma;ano_notificacao\n"
        ";201606;2016-02-10;2016\nCOHAB;201606;2016-02-11;2016\n"
    )
    counts = jobs.build_base(
        spark,
        {"dengue": str(root / "dengue.csv"), "zika": str(root / "zika.csv")},
        str(root / "areas.csv"), str(root / "weather.csv"),
        str(root / "base"), str(root / "means"),
        encodings={"dengue": "ISO-8859-1"}, unified_path=str(root / "unified"),
    )
    return root, counts


def base_of(spark, root):
    return tables.read_folder(spark, str(root / "base"), score.base_schema(SPEC))


def base_of_counts(spark, root):
    """The same base with the stations as counts."""
    count = BaseSpec(station_encoding="count")
    jobs.build_base(
        spark, {"dengue": str(root / "dengue.csv"), "zika": str(root / "zika.csv")},
        str(root / "areas.csv"), str(root / "weather.csv"), str(root / "counted"), str(root / "means2"),
        encodings={"dengue": "ISO-8859-1"}, spec=count,
    )
    return tables.read_folder(spark, str(root / "counted"), score.base_schema(count))


def test_build_job(spark, folder):
    root, counts = folder
    assert counts == {
        "n_cases": 87, "n_without_area": 1, "n_without_day": 1, "n_without_week": 0,
        "n_base_rows": 23, "n_repeated_areas": 1, "n_repeated_weather": 0,
        "n_undeclared_station": 0,
    }
    base = base_of(spark, root)
    # 42 COHAB cases and one of zika fan out over two stations
    per_area = {r[SPEC.area]: r.n for r in base.groupBy(SPEC.area).agg(
        F.sum(SPEC.label).alias("n")).collect()}
    assert per_area == {"COHAB": 86, "AFLITOS": 42, "ÁGUA FRIA": 1, "SEM_INFORMACAO": 1}
    assert base.filter(F.col(SPEC.area) == "COHAB").select("estacao_cabrobo").first()[0] == 0.5
    counted = base_of_counts(spark, root)
    assert counted.filter(F.col(SPEC.area) == "COHAB").select("estacao_cabrobo").first()[0] == 43
    unified = spark.read.parquet(str(root / "unified"))
    assert unified.count() == 87
    assert {"nu_notificacao", "febre", "notificacao_ano", "zika"} <= set(unified.columns)


def request_files(root, name, high="33,0"):
    request = root / name
    request.mkdir()
    (request / "areas.csv").write_text(
        '"";"Bairro";"População";"Estação"\n"1";"COHAB";1000;"RECIFE"\n'
    )
    (request / "weather.csv").write_text(
        '"";"codigo_estacao";"Nome_estacao";"Data";"Precipitacao";"temp_maxima";"temp_minima";'
        f'"temp_comp_media"\n"1";"0";"RECIFE";"01/03/2017";1;{high};21,5;27,0\n'
        f'"2";"0";"RECIFE";"02/03/2017";1;;21,5;27,0\n'
    )
    return request


def test_train_and_score_jobs(spark, folder):
    root, _ = folder
    base_path, model_path = str(root / "base"), str(root / "model")
    jobs.train(
        spark, base_path, model_path, str(root / "report"), folds=2,
        grid={"maxDepth": [2], "maxIter": [2]},
    )
    assert (root / "report" / "importance").exists()
    observed = rows(base_of(spark, root).filter("ds_tipo_base = 'original'"))
    for name, high in (("first", "33,0"), ("second", "35,0")):
        request = request_files(root, name, high)
        jobs.score(
            spark, str(request / "areas.csv"), str(request / "weather.csv"), model_path,
            base_path, str(root / "means") if name == "second" else None,
        )
    stored = base_of(spark, root)
    assert rows(stored.filter("ds_tipo_base = 'original'")) == observed
    (predicted,) = stored.filter("ds_tipo_base = 'previsto'").collect()
    assert (predicted[SPEC.area], predicted[SPEC.week]) == ("COHAB", "201709")
    assert predicted.estacao_recife == 1
    means = spark.read.parquet(str(root / "means")).first()
    assert predicted.temp_maxima == pytest.approx((35 + means.temp_maxima) / 2)


def test_request_means_and_week_rules(spark):
    areas = spark.createDataFrame(
        [("A", 10.0, "RECIFE"), ("B", None, "RECIFE"), ("C", 30.0, "RECIFE")],
        "bairro string, populacao double, estacao string",
    )
    weather = spark.createDataFrame(
        [("RECIFE", date(2016, 1, 1), 30.0, 20.0, 25.0), ("NONE", date(2016, 1, 4), None, 22.0, 26.0)],
        "nome_estacao string, data date, temp_maxima double, temp_minima double, "
        "temp_comp_media double",
    )
    found = {r[SPEC.area]: r for r in score.request_base(weather, areas, SPEC).collect()}
    assert set(found) == {"A", "B", "C", "SEM_INFORMACAO"}
    assert found["B"].populacao == 20
    assert found["SEM_INFORMACAO"].populacao == 20
    assert found["SEM_INFORMACAO"].temp_maxima == 30
    assert found["A"][SPEC.week] == 201553
    calendar = score.request_base(weather, areas, SPEC, week_rule="calendar").collect()
    assert {r[SPEC.week] for r in calendar} == {201653, 201601}


def test_a_form_scores_as_its_files(spark):
    base = spark.createDataFrame(
        [(f"A{i}", "201601", float(i % 7), 100.0 * i, 30.0 + i % 4, 20.0, 25.0,
          *[float(i % 2)] * 8, "original") for i in range(60)],
        score.base_schema(SPEC),
    )
    model = learn.fit(
        learn.training_rows(base, SPEC.features, SPEC.label), SPEC.features,
        learn.boosting(SPEC.label, maxIter=2, maxDepth=2),
    )
    form = spark.createDataFrame(
        [("COHAB - RECIFE", 1000, date(2017, 3, 1), 1.0, 33.0, 18.0, 28.0)], requests.FORM
    )
    bad = form.withColumn("temp_minima", F.lit(60.0))
    from_form = score.score_forms(form.union(bad), model, SPEC)
    from_files = score.score(
        prepare_weather(requests.weather_rows(form), SPEC), requests.area_rows(form), model, SPEC
    )
    assert rows(from_form) == rows(from_files)
    (row,) = from_form.collect()
    assert (row[SPEC.area], row[SPEC.week], row.estacao_recife) == ("COHAB", 201709, 1.0)


def test_arrivals_are_scored_once_and_as_in_batch(spark, tmp_path):
    areas = spark.createDataFrame(
        [("A", 10.0, "RECIFE"), ("B", 30.0, "RECIFE"), ("C", 5.0, "CABROBÓ")],
        "bairro string, populacao double, estacao string",
    )
    base = spark.createDataFrame(
        [(f"A{i}", "201601", float(i % 7), 10.0 * i, 30.0 + i % 4, 20.0, 25.0,
          *[float(i % 2)] * 8, "original") for i in range(60)],
        score.base_schema(SPEC),
    )
    model = learn.fit(
        learn.training_rows(base, SPEC.features, SPEC.label), SPEC.features,
        learn.boosting(SPEC.label, maxIter=2, maxDepth=2),
    )
    means = {"populacao": 20.0, "temp_maxima": 31.0, "temp_minima": 20.0, "temp_comp_media": 25.0}
    schema = "nome_estacao string, data string, temp_maxima string, temp_minima string, " \
             "temp_comp_media string"
    drop, out, progress = (str(tmp_path / n) for n in ("drop", "out", "progress"))

    def arrive(data):
        delimited.write_delimited(
            spark.createDataFrame(data, schema), drop, sep=";", mode="append"
        )
        stream = delimited.read_delimited(spark.readStream, drop, schema, sep=";")
        scored = arrivals.preview_scores(prepare_weather(stream, SPEC), areas, model, means, SPEC)
        arrivals.to_folder(scored, out, progress)
        return spark.read.schema(scored.schema).parquet(out)

    columns = [SPEC.area, SPEC.week, "temp_maxima", "estacao_cabrobo", "prediction"]
    first = [("RECIFE", "01/03/2017", "33,5", "21,0", "27,0")]
    assert arrive(first).count() == 2
    second = [("CABROBÓ", "02/03/2017", None, "21,0", "27,0")]
    stored = arrive(second)
    batch = prepare_weather(spark.createDataFrame(first + second, schema), SPEC)
    expected = arrivals.preview_scores(batch, areas, model, means, SPEC)
    assert rows(stored.select(columns)) == rows(expected.select(columns))
    assert stored.filter("estacao_cabrobo = 1").select("temp_maxima").first()[0] == 31.0


def test_a_week_in_two_batches_is_published_as_in_batch(spark, tmp_path):
    areas = spark.createDataFrame(
        [("A", 10.0, "RECIFE"), ("B", 30.0, "RECIFE"), ("A", 10.0, "CABROBÓ")],
        "bairro string, populacao double, estacao string",
    )
    base = spark.createDataFrame(
        [(f"A{i}", "201601", float(i % 7), 10.0 * i, 30.0 + i % 4, 20.0, 25.0,
          *[float(i % 2)] * 8, "original") for i in range(60)],
        score.base_schema(SPEC),
    )
    path, kept, drop, progress = (str(tmp_path / n) for n in ("base", "rows", "drop", "progress"))
    score.store(base, path, SPEC)
    model = learn.fit(
        learn.training_rows(base, SPEC.features, SPEC.label), SPEC.features,
        learn.boosting(SPEC.label, maxIter=2, maxDepth=2),
    )
    means = {"populacao": 20.0, "temp_maxima": 31.0, "temp_minima": 20.0, "temp_comp_media": 25.0}
    schema = "nome_estacao string, data date, temp_maxima double, temp_minima double, " \
             "temp_comp_media double"
    parts = [
        [("RECIFE", date(2017, 2, 27), 33.5, 21.0, 27.0)],
        [("RECIFE", date(2017, 3, 1), None, 22.0, 28.0), ("CABROBÓ", date(2017, 3, 2), 35.0, 20.0, 26.0)],
        [("CABROBÓ", date(2017, 3, 9), 36.0, 20.0, 26.0)],
    ]
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(drop)
        stream = spark.readStream.schema(schema).parquet(drop)
        arrivals.publish_arrivals(stream, areas, model, means, kept, path, progress, SPEC)
    untouched = sorted(p.stat().st_mtime_ns for p in (tmp_path / "base").rglob("*original*/**/*.parquet"))
    stored = tables.read_folder(spark, path, score.base_schema(SPEC)).filter(
        f"{SPEC.kind} = 'previsto'"
    )
    everything = spark.createDataFrame([r for part in parts for r in part], schema)
    expected = score.stored_rows(score.score(everything, areas, model, SPEC, means), SPEC)
    assert rows(stored.select(*SPEC.base_columns)) == rows(expected)
    # The same weeks again leave the same rows and other weeks' files alone.
    again = everything.filter("data < '2017-03-05'")
    other = {p: p.stat().st_mtime_ns for p in (tmp_path / "base").rglob("*.parquet") if "201710" in str(p)}
    score.publish(score.score(again, areas, model, SPEC, means), path, SPEC)
    assert other == {p: p.stat().st_mtime_ns for p in other}
    assert untouched


def test_the_encoding_is_saved_with_the_model(spark, tmp_path):
    base = spark.createDataFrame(
        [(f"A{i}", "201601", float(i % 7), 10.0 * i, 30.0, 20.0, 25.0, *[0.0] * 8, "original")
         for i in range(20)],
        score.base_schema(SPEC),
    )
    model = learn.fit(
        learn.training_rows(base, SPEC.features, SPEC.label), SPEC.features,
        learn.boosting(SPEC.label, maxIter=1, maxDepth=1),
    )
    path = str(tmp_path / "model")
    learn.save_model(model, path, "share")
    learn.load_model(path, SPEC.features, "share")
    with pytest.raises(ValueError, match="share"):
        learn.load_model(path, SPEC.features, "count")


def test_weather_rows_that_multiply_cases_are_an_error_on_request(spark):
    cases = spark.createDataFrame(
        [("A", 201601, date(2016, 1, 3))],
        f"{SPEC.area} string, {SPEC.week} int, {SPEC.onset} date",
    )
    areas = spark.createDataFrame([("A", 1.0, "RECIFE")], "bairro string, populacao double, estacao string")
    weather = spark.createDataFrame(
        [("RECIFE", date(2016, 1, 3), t, 20.0, 25.0) for t in (30.0, 31.0)],
        "nome_estacao string, data date, temp_maxima double, temp_minima double, temp_comp_media double",
    )
    assert enriched_cases(cases, areas, weather, SPEC).count() == 2
    assert enriched_cases(cases, areas, weather, SPEC, weather_fanout="first").count() == 1
    with pytest.raises(Exception, match="RECIFE"):
        enriched_cases(cases, areas, weather, SPEC, weather_fanout="error").collect()


def test_closed_weeks_of_a_stream_equal_the_batch(spark, tmp_path):
    data = [("x" if i % 3 else "y", datetime(2024, 1, 1 + i % 24, 12), float(i)) for i in range(240)]
    df = spark.createDataFrame(data, "k string, ts timestamp, v double")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df.repartition(4).write.parquet(source)
    weekly = rollup.weekly_rollup(
        spark.readStream.schema(df.schema).parquet(source), "ts", ["k"], ["v"], "1 day"
    )
    arrivals.to_folder(weekly, out, str(tmp_path / "progress"))
    closed = spark.read.schema(weekly.schema).parquet(out)
    batch = rollup.weekly_rollup(df, "ts", ["k"], ["v"])
    assert rows(closed) == rows(batch.filter("week_start < '2024-01-22'"))
    assert {r.week_start for r in batch.collect()} == {
        date(2024, 1, d) for d in (1, 8, 15, 22)
    }


@pytest.fixture(scope="module")
def trained(spark, folder):
    """A model that carries the means of the base, and a base in the catalog."""
    root, _ = folder
    where = tables.CatalogTable("areacast_jobs", str(root / "catalog"))
    base = base_of(spark, root).filter("ds_tipo_base = 'original'")
    score.store(base, where, SPEC)
    model = str(root / "with_means")
    jobs.train(
        spark, where, model, means_path=str(root / "means"), folds=2, grid={"maxDepth": [2], "maxIter": [2]}
    )
    yield root, where, model
    spark.sql("DROP TABLE areacast_jobs")


def predictions(spark, where):
    return {
        (r[SPEC.area], r[SPEC.week]): r
        for r in where.read(spark, "").filter("ds_tipo_base = 'previsto'").collect()
    }


def test_scoring_takes_the_means_of_the_model(spark, trained):
    root, where, model = trained
    request = request_files(root, "third", "35,0")
    jobs.score(spark, str(request / "areas.csv"), str(request / "weather.csv"), model, where)
    means = spark.read.parquet(str(root / "means")).first()
    found = predictions(spark, where)
    assert found[("COHAB", "201709")].temp_maxima == pytest.approx((35 + means.temp_maxima) / 2)
    jobs.score(spark, str(request / "areas.csv"), str(request / "weather.csv"), model, where, "request")
    assert predictions(spark, where)[("COHAB", "201709")].temp_maxima == pytest.approx(35)


def test_forms_job(spark, trained):
    root, where, model = trained
    path = root / "forms.csv"
    path.write_text(
        "bairro_estacao;populacao;data;precipitacao;temp_maxima;temp_minima;temp_comp_media\n"
        "AFLITOS - RECIFE;1000;2018-03-01;1.0;33.0;18.0;28.0\nX - RECIFE;1000;2018-03-01;1.0;33.0;48.0;28.0\n"
    )
    jobs.forms(spark, str(path), model, where, str(root / "rejected_forms"))
    assert ("AFLITOS", "201809") in predictions(spark, where)
    assert not any(area == "X" for area, _ in predictions(spark, where))
    rejected = delimited.read_by_header(spark, str(root / "rejected_forms")).collect()
    assert [r.reject_reasons for r in rejected] == ["temp_minima>temp_maxima"]


def test_features_job(spark, trained):
    root, _, model = trained
    rows_ = root / "features.csv"
    names = [*reversed(SPEC.features), "id"]
    rows_.write_text("\n".join([",".join(names), ",".join([*["1.5"] * len(SPEC.features), "k"]), ""]))
    jobs.features(spark, str(rows_), model, str(root / "scored_features"), ["id"])
    (found,) = delimited.read_by_header(spark, str(root / "scored_features"), ",").collect()
    assert found.id == "k" and float(found.prediction) >= 0


def test_arrivals_job(spark, trained):
    root, where, model = trained
    drop, work = root / "dropped", str(root / "work")
    drop.mkdir()
    request = request_files(root, "fourth")
    header = ";".join(requests.WEATHER_COLUMNS)
    parts = [["0;RECIFE;03/06/2019;1,0;33,0;21,0;27,0", "0;RECIFE;xx;1,0;33,0;21,0;27,0"],
             ["0;RECIFE;05/06/2019;1,0;;23,0;27,0"]]
    for i, part in enumerate(parts):
        (drop / f"{i}.csv").write_text("\n".join([header, *part, ""]))
        jobs.arrive(spark, str(drop), str(request / "areas.csv"), model, where, work)
    means = spark.read.parquet(str(root / "means")).first()
    found = predictions(spark, where)[("COHAB", "201923")]
    assert found.temp_maxima == pytest.approx((33 + means.temp_maxima) / 2) and found.temp_minima == 22
    rejected = spark.read.parquet(f"{work}/rejected")
    assert [(r.reject_reasons, r.raw_data) for r in rejected.collect()] == [("data", "xx")]
    with pytest.raises(ValueError, match="means"):
        jobs.arrive(spark, str(drop), str(request / "areas.csv"), model, where, work, "request")


def test_check_files_job(spark, folder, tmp_path):
    path = tmp_path / "w.csv"
    header = ";".join(requests.WEATHER_COLUMNS)
    path.write_text("\n".join([header, "0;RECIFE;03/06/2019;1,0;33,0;21,0;27,0", "0;;03/06/2019;1,0;33,0;99,0;27,0", "bad", ""]))
    expected = {"nome_estacao": 1, "temp_minima": 1, "temp_minima>temp_maxima": 1, "line": 1}
    assert jobs.check_files(spark, str(path), str(tmp_path / "out")) == expected
    assert jobs.check_files(spark, str(tmp_path / "*.csv"), str(tmp_path / "new"), str(tmp_path / "progress")) == expected


def test_audit_of_the_build_job(spark, folder, tmp_path):
    root, _ = folder
    jobs.build_base(
        spark, {"dengue": str(root / "dengue.csv"), "other": str(root / "zika.csv")},
        str(root / "areas.csv"), str(root / "weather.csv"), str(tmp_path / "base"), str(tmp_path / "means"),
        encodings={"dengue": "ISO-8859-1"}, date_formats={"other": "yyyy-MM-dd"}, audit_path=str(tmp_path / "audit"),
    )
    stages = {r.stage: (int(r.n_rows), int(r.n_columns)) for r in delimited.read_by_header(spark, str(tmp_path / "audit/stages"), ",").collect()}
    assert {s: n for s, (n, _) in stages.items()} == {
        "dengue": 85, "other": 2, "union": 87, "areas": 3, "weather": 56, "enriched": stages["enriched"][0], "base": 23,
    }
    assert stages["areas"][1] == 3 and stages["weather"][1] == 5
    counts = {(r.stage, r.counted): int(r.n_rows) for r in delimited.read_by_header(spark, str(tmp_path / "audit/counts"), ",").collect()}
    assert counts[("dengue", SPEC.onset)] == 1 and counts[("other", SPEC.onset)] == 0
    assert counts[("union", "without_area")] == 1 and counts[("weather", "temp_maxima")] == 0
    with pytest.raises(ValueError, match="other"):
        jobs.build_base(
            spark, {"other": str(root / "zika.csv")}, str(root / "areas.csv"), str(root / "weather.csv"),
            str(tmp_path / "base"), str(tmp_path / "means"),
        )
