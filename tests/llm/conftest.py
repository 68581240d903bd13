import random

import pytest

from tests.llm import brute

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
}


def _vectors():
    draw = random.Random(4)
    rows = [[draw.gauss(0, 1) for _ in range(24)] for _ in range(60)]
    for base in list(rows[:10]):
        rows += [base, [2 * x for x in base]]
        rows += [[x + draw.gauss(0, s) for x in base] for s in (0.1, 0.3, 0.45, 0.5, 0.6)]
    rows += [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23]
    rows += [[1.0, 2.0], [2.0, 4.0], [3.0]]
    return [{"vec_id": 500 - i, "embedding": v, "label": i % 3} for i, v in enumerate(rows)]


URLS = [
    None, "", "no scheme", "http://", "https://EN.Example.NET/en/a?x=1#y", "https://example.net/de/a",
    "https://notexample.com/de/", "http://a.example.com/de/page1?id=3", "http://example.com/en/",
    "ftp://w.org/fr/x", "ftp://w.org/de/x", "http://x.net?q=/en/", "http://example.net#/en/", "x://y://z.net/",
    "https://shop.io/ads/1", "https://shop.io/ads/2", "https://shop.io/about",
] * 3


@pytest.fixture(scope="session")
def data():
    docs, benchmark, labels = brute.corpus()
    return {
        "documents": docs, "benchmark": benchmark, "labels": labels, "embeddings": _vectors(),
        "pages": [{"page_id": i, "url": u, "html": None} for i, u in enumerate(URLS)],
    }


def _written(spark, folder, tables):
    for name, schema in SCHEMAS.items():
        fields = [c.split()[0] for c in schema.split(", ")]
        rows = [tuple(r[f] for f in fields) for r in tables[name]]
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def folder(spark, data, tmp_path_factory):
    return _written(spark, tmp_path_factory.mktemp("corpus"), data)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return _written(spark, tmp_path_factory.mktemp("empty"), {name: [] for name in SCHEMAS})
