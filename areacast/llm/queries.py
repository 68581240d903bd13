"""The operators of this subpackage on the given tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.llm import (
    clusters,
    decontaminate,
    fingerprints,
    licenses,
    lines,
    mixing,
    neardup,
    secrets,
    shards,
    toxicity,
    urls,
    vectors,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# The smallest id that links (a, b) reach.
_REACH = """
    SELECT a AS id, a AS r FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        _table(spark, sf_dir, "documents"), "doc_id", _table(spark, sf_dir, "benchmark"), "item_id"
    )
    names = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["start"])
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.size("near_items").cast("bigint").alias("n_near"),
    )


QUERIES["op1_decontamination"] = op1_decontamination
ORACLES["op1_decontamination"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), b AS (
    SELECT item_id, coalesce(regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM benchmark
), starts AS (
    SELECT item_id, w, least(10, len(w)) AS width, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
    FROM b WHERE len(w) > 0
), phrases AS (
    SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS phrase FROM starts
), widths AS (
    SELECT DISTINCT width FROM phrases
), places AS (
    SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
    FROM d JOIN widths ON len(w) >= width
), hits AS (
    SELECT p.doc_id, p.i, p.width, q.item_id
    FROM places p JOIN phrases q
    ON p.width = q.width AND array_to_string(p.w[p.i:p.i + p.width - 1], ' ') = q.phrase
), words AS (
    SELECT doc_id, count(DISTINCT spot) AS n
    FROM (SELECT doc_id, unnest(range(i, i + width)) AS spot FROM hits) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
), tokens AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS spot FROM d
), terms AS (
    SELECT item_id, phrase, width, unnest(string_split(phrase, ' ')) AS word, unnest(range(width)) AS place FROM phrases
), shifted AS (
    SELECT doc_id, item_id, phrase, width, place, spot - place + unnest(range(-2, 3)) AS start
    FROM tokens JOIN terms USING (word)
), near AS (
    SELECT doc_id, count(DISTINCT item_id) AS n FROM (
        SELECT doc_id, item_id, phrase, start FROM shifted
        GROUP BY doc_id, item_id, phrase, width, start HAVING count(DISTINCT place) = width
    ) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
    sha256(coalesce(items.names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated,
    coalesce(near.n, 0) AS n_near
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
""" % ((_LOWER,) * 2)


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(_table(spark, sf_dir, "documents"), "doc_id", percent=80)


QUERIES["op2_lines"] = op2_lines


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", threshold=0.9)


QUERIES["op3_embeddings"] = op3_embeddings
ORACLES["op3_embeddings"] = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT one.vec_id AS a, two.vec_id AS b FROM v one JOIN v two
    ON one.vec_id <> two.vec_id AND len(one.e) = len(two.e) AND list_cosine_similarity(one.e, two.e) >= 0.9
), reach AS ({_REACH}), found AS (
    SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
        coalesce((SELECT min(r) FROM reach WHERE id = vec_id), vec_id) AS component_id
    FROM embeddings
)
SELECT *, vec_id = component_id AS kept FROM found
"""


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs)
    return found.select(
        "doc_id",
        F.size("licenses").cast("bigint").alias("n_licenses"),
        F.array_join(F.transform("licenses", lambda x: x["license"]), ",").alias("licenses"),
        F.array_join(F.transform("licenses", lambda x: x["at"].cast("string")), ",").alias("words"),
    )


QUERIES["op4_licenses"] = op4_licenses


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(_table(spark, sf_dir, "documents"), "doc_id", n=4, percent=80)
    return found.drop("text_hash")


QUERIES["op5_minhash"] = op5_minhash
ORACLES["op5_minhash"] = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), cut AS (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 0) + 2)) AS i FROM d WHERE len(w) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g FROM cut
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT one.doc_id AS a, two.doc_id AS b, count(*) AS k
    FROM shingles one JOIN shingles two ON one.g = two.g AND one.doc_id <> two.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS ({_REACH}), least AS (
    SELECT id, min(r) AS component_id FROM reach GROUP BY id
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
    d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON id = d.doc_id
"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # A row without an id is not held out: no label can name it.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    labels = _table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.score(docs, toxicity.train(docs, labels, "doc_id", "toxic"))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


QUERIES["op6_toxicity"] = op6_toxicity


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = shards.shuffled(docs, "doc_id", shards=8)
    return placed.select(
        "doc_id",
        shards.record_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        shards.shard_of("doc_id", 9).alias("grown_shard"),
    )


QUERIES["op7_sharding"] = op7_sharding


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, "doc_id").select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).cast("bigint").alias("taken"),
    )


QUERIES["op8_mixing"] = op8_mixing


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs)
    base = F.filter("secret_spans", lambda s: s["rank"] < len(secrets.BASE))

    def number(kind):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("bigint")

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    return found.select(
        "doc_id",
        *[number(rule.kind).alias(f"n_{rule.kind}") for rule in secrets.BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secret_spans")).alias("spans"),
    )


QUERIES["op9_secrets"] = op9_secrets

# The given rules (fixed values).
URL_RULES = (
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
)


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


QUERIES["op10_urls"] = op10_urls


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"), "doc_id")


QUERIES["op11_fingerprints"] = op11_fingerprints


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.cluster(_table(spark, sf_dir, "embeddings"), "vec_id", count=8, rounds=10, dims=64)
    components = F.array_join(F.transform("centroid", lambda c: c.cast("string")), ",")
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(components.cast("binary"), 256).alias("centroid_sha256"),
    )


def _clusters_sql(rounds: int) -> str:
    """The rounds written out one after the other; // cuts towards zero, so the floor is taken by the remainder."""
    nearest = """
{after} AS MATERIALIZED (
    SELECT id, vec_id, x, cluster, distance FROM (
        SELECT v.id, v.vec_id, v.x, c.cluster,
            list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS distance
        FROM kept v CROSS JOIN {before} c
    ) QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, cluster) = 1
)"""
    moved = """
{after} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.x, c.x) AS x FROM {before} c LEFT JOIN (
        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
            SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n
            FROM {assigned}, (SELECT unnest(range(1, 65)) AS i) GROUP BY cluster, i
        ) GROUP BY cluster
    ) m USING (cluster)
)"""
    steps = []
    for i in range(rounds + 1):
        steps.append(nearest.format(after=f"a{i}", before=f"c{i}"))
        if i < rounds:
            steps.append(moved.format(after=f"c{i + 1}", before=f"c{i}", assigned=f"a{i}"))
    return """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS id, vec_id,
        list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x
    FROM (SELECT x, sha256('3:' || vec_id::VARCHAR) AS h FROM kept ORDER BY h, x LIMIT 8)
), %s, sums AS (
    SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM a%d GROUP BY cluster
)
SELECT a.vec_id, a.cluster::INT AS cluster, a.distance, sums.cluster_inertia,
    (SELECT sum(cluster_inertia)::BIGINT FROM sums) AS inertia,
    sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a%d a JOIN c%d c USING (cluster) JOIN sums USING (cluster)
""" % (",".join(steps), rounds, rounds, rounds)


QUERIES["op12_clusters"] = op12_clusters
ORACLES["op12_clusters"] = _clusters_sql(10)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"), "vec_id", keep=4)
    each = found.select(
        "vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("place", "whitened")
    )
    return each.select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened",
        F.col("explained")[F.col("place")].alias("explained"), "identity_error",
    )


QUERIES["op13_whitening"] = op13_whitening
