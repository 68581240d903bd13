"""The worked example: three case files, four areas, two stations, by hand."""

import pytest

from areacast.operators.aggregate import (
    area_station_count,
    area_week_base,
    attach_station_counts,
    station_pivot,
    station_share,
)
from areacast.plans.spec import BaseSpec
from areacast.plans.training_base import (
    base_of,
    cleaned_cases,
    enriched_cases,
    prepare_areas,
    prepare_cases,
    prepare_weather,
    training_base,
    training_means,
    unified_cases,
)

SPEC = BaseSpec(station_encoding="count")


@pytest.fixture(scope="module")
def inputs(spark):
    areas = spark.createDataFrame(
        [
            ("COHAB", None, "CABROBÓ"),
            ("COHAB", None, "OURICURI"),
            ("COHAB", 67283, "RECIFE"),
            ("AFLITOS", 5773, "RECIFE"),
        ],
        "`Bairro` string, `População` int, `Estação` string",
    )
    weather = spark.createDataFrame(
        [
            ("1", "RECIFE", "03/01/2016", "k", "0,5", "31,0", "24,0", "27,0"),
            ("2", "CABROBÓ", "03/01/2016", "k", None, "35,0", "22,0", "28,0"),
        ],
        "`Código da estação` string, `Nome da estação` string, `Data` string, `Key` string, "
        "`Precipitação` string, `Temp. Máxima` string, `Temp. Mínima` string, "
        "`Temp. Comp. Média` string",
    )
    dengue = spark.createDataFrame(
        [("COHAB", 201601, "03-01-2016", 2016, "x")],
        "no_bairro_residencia string, ds_semana_notificacao int, dt_diagnostico_sintoma string, "
        "notificacao_ano int, febre string",
    )
    chikungunya = spark.createDataFrame(
        [("AFLITOS", 201601, "2016-01-03", 2016)],
        "no_bairro_residencia string, ds_semana_notificacao int, dt_diagnostico_sintoma string, "
        "notificacao_ano int",
    )
    zika = spark.createDataFrame(
        [(None, 201602, "2016-01-10", 2016)],
        "no_bairro_residencia string, ds_semana_notificacao int, dt_diagnostico_sintoma string, "
        "ano_notificacao int",
    )
    cases = unified_cases({
        "dengue": prepare_cases(dengue, "dengue", "dd-MM-yyyy", SPEC, zika=0),
        "chikungunya": prepare_cases(chikungunya, "chikungunya", "yyyy-MM-dd", SPEC, zika=0),
        "zika": prepare_cases(zika, "zika", "yyyy-MM-dd", SPEC, zika=1),
    })
    return cases, prepare_areas(areas, SPEC), prepare_weather(weather, SPEC)


def by_key(df):
    return {(r[SPEC.area], r[SPEC.week]): r.asDict() for r in df.collect()}


def test_unified_cases(inputs):
    cases = inputs[0]
    assert cases.columns == [
        "no_bairro_residencia", "ds_semana_notificacao", "dt_diagnostico_sintoma",
        "notificacao_ano", "febre", "source_dados", "zika",
    ]
    found = {r.source_dados: (r.zika, r.notificacao_ano, r.febre) for r in cases.collect()}
    assert found == {
        "DENGUE": (0, 2016, "x"), "CHIKUNGUNYA": (0, 2016, None), "ZIKA": (1, 2016, None)
    }


def test_means_are_weighted_by_case_rows(inputs):
    means = training_means(enriched_cases(*inputs, SPEC), SPEC).first()
    assert means.populacao == pytest.approx(36528)
    assert means.temp_maxima == pytest.approx(97 / 3)
    assert means.temp_minima == pytest.approx(70 / 3)
    assert means.temp_comp_media == pytest.approx(82 / 3)


def test_base(inputs):
    base = by_key(training_base(*inputs, SPEC))
    expected = {
        ("AFLITOS", 201601): (1, 5773, 31, 24, 27, {"recife": 1}),
        ("COHAB", 201601): (
            3, 46779.6667, 32.7778, 23.1111, 27.4444, {"cabrobo": 1, "ouricuri": 1, "recife": 1}
        ),
        ("SEM_INFORMACAO", 201602): (1, 36528, 32.3333, 23.3333, 27.3333, {"seminfo": 1}),
    }
    assert base.keys() == expected.keys()
    for key, (n, population, high, low, mean, stations) in expected.items():
        row = base[key]
        assert row["resposta"] == n
        assert row["populacao"] == pytest.approx(population, abs=1e-4)
        assert row["temp_maxima"] == pytest.approx(high, abs=1e-4)
        assert row["temp_minima"] == pytest.approx(low, abs=1e-4)
        assert row["temp_comp_media"] == pytest.approx(mean, abs=1e-4)
        assert row["ds_tipo_base"] == "original"
        for column in SPEC.stations.values():
            assert row[column] == stations.get(column.removeprefix("estacao_"), 0)


def test_base_equals_single_operators(inputs):
    cleaned = cleaned_cases(enriched_cases(*inputs, SPEC), SPEC)
    counts = area_station_count(cleaned, SPEC.area, SPEC.station, "qtd", "n_rows")
    pivot = station_pivot(counts, SPEC.area, SPEC.station)
    base = area_week_base(
        cleaned, SPEC.area, SPEC.week, SPEC.means, SPEC.label, weight="n_rows"
    )
    columns = list(SPEC.stations.values())
    attached = by_key(attach_station_counts(base, pivot, SPEC.area, columns))
    for key, row in by_key(base_of(cleaned, SPEC)).items():
        assert attached[key] == {c: v for c, v in row.items() if c != SPEC.kind}


def test_shares(inputs):
    cleaned = cleaned_cases(enriched_cases(*inputs, SPEC), SPEC)
    shares = by_key(station_share(cleaned, SPEC.area, SPEC.week, SPEC.station, weight="n_rows"))
    cohab = shares["COHAB", 201601]
    for name in ("cabrobo", "ouricuri", "recife"):
        assert cohab[f"estacao_{name}"] == pytest.approx(1 / 3)
    assert cohab["estacao_surubim"] == 0


def test_fanout_error_names_the_key(inputs):
    with pytest.raises(Exception, match="COHAB"):
        training_base(*inputs, SPEC, fanout="error").collect()


def test_fanout_first_keeps_the_number_of_cases(inputs):
    base = training_base(*inputs, SPEC, fanout="first")
    assert sum(r.resposta for r in base.collect()) == 3
