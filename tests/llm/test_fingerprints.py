"""Fingerprints, edited texts and the near-duplicates that they find, against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from areacast.llm import fingerprints, queries
from tests.llm import brute


def ordered(spark, docs):
    """(id, text) in the order of the operator; the hash of a text comes from Spark."""
    texts = sorted({d["text"] or "" for d in docs})
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    rank = {r["text"]: r["h"] for r in frame.withColumn("h", F.xxhash64("text")).collect()}
    rows = [(d["doc_id"], d["text"] or "") for d in docs]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, rank[r[1]]))


def likeness(one, two):
    values = [[f[i : i + 4] for i in range(0, len(f), 4)] for f in (one, two)]
    if not all(values):
        return float(one == two)
    return sum(a == b for a, b in zip(*values)) / len(values[0])


def test_minima_are_those_of_the_functions():
    hasher = fingerprints.Hasher(values=8)
    found = hasher.shingles(b"one two three four five six seven eight")
    assert len(found) == 4
    for i, value in enumerate(hasher.minima(found).tolist()):
        a, b = int(hasher.a[i, 0]), int(hasher.b[i, 0])
        least = min((a * ((int(x) >> 33) % fingerprints.PRIME) + b) % fingerprints.PRIME or fingerprints.PRIME for x in found)
        assert value == least & 0xFFFF
    assert len(hasher.minima(hasher.shingles(b" "))) == 0


def test_edited_fingerprints(spark, folder, data):
    docs = data["documents"]
    rows = queries.op11_fingerprints(spark, folder).collect()
    order = ordered(spark, docs)
    plain = {}
    texts = spark.createDataFrame([(i, t) for i, t in enumerate({t for _, t in order})], "id int, text string")
    of_id = {r["id"]: r["text"] for r in texts.collect()}
    for r in fingerprints.fingerprints(texts, "id").collect():
        plain[of_id[r["id"]]] = r["fingerprint"]
        assert r["n_shingles"] == len(brute.shingles(of_id[r["id"]], 5))
    expected = []
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain[text],
            likeness(plain[text], plain[following]),
        ))
        assert edited not in plain or edited == text or not edited
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["near_next"]) for r in rows]
    assert Counter(got) == Counter(expected)
    for r in rows:
        assert r["near_edited"] == likeness(r["fingerprint"], r["edited_fingerprint"])


def test_likeness_is_near_the_similarity(spark, data):
    docs = [d for d in data["documents"] if d["text"] and brute.shingles(d["text"], 5)][:60]
    frame = spark.createDataFrame([(i, d["text"]) for i, d in enumerate(docs)], "id int, text string")
    found = {r["id"]: r["fingerprint"] for r in fingerprints.fingerprints(frame, "id").collect()}
    sets = [brute.shingles(d["text"], 5) for d in docs]
    for i in range(len(docs)):
        for j in range(i):
            similarity = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            assert abs(likeness(found[i], found[j]) - similarity) < 0.25


@pytest.mark.parametrize("rows, expected", [
    ([(1, "alone")], [("aloal", 0.0, 1.0)]),
    ([(1, None)], [("", 1.0, 1.0)]),
    ([(1, "abcd"), (2, "")], [("ab", 0.0, 0.0), ("", 1.0, 0.0)]),
    ([(2, "x"), (1, "abcd"), (None, "uvw")], [("abx", 0.0, 0.0), ("x", 1.0, 0.0), ("uva", 0.0, 0.0)]),
    ([(1, "same text")] * 3, [("same same", 0.0, 1.0)] * 3),
])
def test_edits_of_few_rows(spark, rows, expected):
    docs = spark.createDataFrame(rows, "id int, text string").withColumn("fingerprint", F.lit("old"))
    found = fingerprints.edited_fingerprints(docs, "id").orderBy(F.col("id").asc_nulls_last()).collect()
    assert [(r["edited_sha256"], r["near_edited"], r["near_next"]) for r in found] == [
        (hashlib.sha256(e.encode()).hexdigest(), a, b) for e, a, b in expected
    ]


def test_near_duplicates(spark, folder, data):
    docs = data["documents"]
    sizes, least = brute.near_classes(docs, 5)
    found = fingerprints.near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id").collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == Counter(
        (d["doc_id"], n, c) for d, n, c in zip(docs, sizes, least)
    )
    # A class without words aside, rows with different texts leave one.
    kept = {(r["component_id"], r["text_hash"]) for r in found if r["kept"] and r["n_shingles"]}
    assert len({c for c, _ in kept}) == len(kept) == len({c for n, c in zip(sizes, least) if n})


def test_large_bucket_of_drifting_copies(spark, monkeypatch):
    # One passage under all, some words of their own: links near and beyond the threshold in the same buckets.
    draw = random.Random(8)
    base = [f"w{draw.randrange(500)}" for _ in range(120)]
    docs = []
    for i in range(150):
        own = [f"v{i}x{j}" for j in range(draw.choice((0, 3, 8, 12, 14, 20, 40)))]
        docs.append({"doc_id": 1000 - i, "text": " ".join(base + own)})
    monkeypatch.setattr(fingerprints, "BLOCK", 16)
    frame = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id int, text string")
    _, least = brute.near_classes(docs, 5)
    found = {r["doc_id"]: r["component_id"] for r in fingerprints.near_duplicates(frame, "doc_id").collect()}
    assert found == {d["doc_id"]: c for d, c in zip(docs, least)}
    assert 1 < len(set(least)) < 150


def test_rows_without_ids_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (None, text + " and"), (3, "other words"), (3, "more"), (None, None), (None, " ")]
    docs = spark.createDataFrame(rows, "id int, text string").withColumn("node", F.lit("old"))
    found = fingerprints.near_duplicates(docs, "id").collect()
    assert sum(r["kept"] for r in found if r["n_shingles"] > 50) == 1
    assert all(r["kept"] for r in found if r["n_shingles"] <= 50) and len(found) == 6
    assert fingerprints.near_duplicates(docs.limit(0), "id").count() == 0
    assert fingerprints.fingerprints(docs.limit(0), "id").count() == 0
