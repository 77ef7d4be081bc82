"""The thin contract queries opN_<name> over the whole tables, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import bin_packing, centroids, decontamination, html_extraction, lattice_lm, license_scan, minhash, quality_classifier, quality_rules, sharding, simhash, token_align, token_store
from tracewright.plans.materialize import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted target: documents that ``labels`` marks as good."""
    return _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality(_table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr_score")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard_rows(_table(spark, sf_dir, "documents"), shards=8)
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extraction.main_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", F.col("__main").alias("text"), F.length("__main").cast("long").alias("n_chars"))


#: Score from which a document is predicted good.
GOOD = 0.3


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (quality_classifier.remainder("doc_id", 5) == 0).alias("held_out"), quality_classifier.score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def token_counts(docs: DataFrame) -> DataFrame:
    """(id, tokens) of every document: its ids by the vocabulary of operator 7, and one end."""
    return token_store.token_counts(docs, vocabulary("word_bpe_49k.json"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_packing.pack(token_counts(_table(spark, sf_dir, "documents")), F.col("tokens"), "id").withColumnRenamed("id", "doc_id")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-store-{uuid.uuid4().hex}"
    token_store.write_store(_table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end=2)
    return token_store.verified(spark, path)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    named = F.sha2(F.array_join("items", ","), 256)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), named.alias("items_sha256"), "contaminated")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = quality_classifier.remainder("doc_id", 10) == 0
    got = lattice_lm.score(docs, held_out, vocabulary("piece_bpe_32k.model"))
    # The model that has learned from the training texts is the score; that of the vocabulary's own scores stands beside it.
    return got.withColumnsRenamed({"id": "doc_id", "score": "lattice_score", "mixed_score": "score"})


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = vocabulary("piece_bpe_32k.model")
    made = token_align.aligned(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), pieces)
    named = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    made = made.select("id", "n_a", "n_b", "n_groups", named.alias("groups_sha256"), "pairs", "times")
    return token_align.scored(made, token_align.pieces_in(pieces)).withColumnRenamed("id", "doc_id")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.lloyd(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_sharding, op3_license_scan, op4_html_extraction, op5_quality_classifier, op6_best_fit_packing, op7_token_store, op8_simhash_near_dedup, op9_decontamination, op10_lm_scoring, op11_minhash_near_dedup, op12_token_alignment, op13_centroid_clustering)}

_WORDS9 = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP9_SQL = f"""
WITH items AS (SELECT item_id, {_WORDS9} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM items WHERE len(w) > 0)
),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS9} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM wins),
spans AS (
  SELECT r, n, s, array_to_string(w[s : s + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, sizes WHERE len(w) >= n)
),
hits AS (SELECT r, s, n, item_id FROM spans JOIN wins USING (n, win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""



def _op3_sql() -> str:
    q = lambda x: "'" + x.replace("'", "''") + "'"
    most = max(len(s.split(" ")) for s in license_scan.known_sentences())  # each fragment has a word
    known = ", ".join(f"({q(s)}, {q(n)})" for s, n in license_scan.known_sentences().items())
    steps = ["f0 AS (SELECT r, names, ',' || replace(names, ',', ',,') || ',' AS l, CAST([] AS VARCHAR[]) AS got FROM seqs)"]
    for i, (name, ids) in enumerate(license_scan.RULES):
        want = q("," + ",,".join(ids) + ",")
        steps.append(f"f{i + 1} AS (SELECT r, names, replace(l, {want}, '') AS l, CASE WHEN contains(l, {want}) THEN list_append(got, {q(name)}) ELSE got END AS got FROM f{i})")
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH known(s, name) AS (VALUES {known}),
docs AS (SELECT row_number() OVER () AS r, doc_id, list_filter(list_transform(regexp_split_to_array({lower}, '{license_scan.BREAKS}'), lambda x: trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '') AS p FROM documents),
starts AS (SELECT DISTINCT r, p, i FROM (SELECT r, p, unnest(range(1, len(p) + 1)) AS i FROM docs) JOIN known ON starts_with(s || ' ', p[i] || ' ')),
runs AS (SELECT r, i, n, array_to_string(p[i : i + n - 1], ' ') AS s FROM starts, range(1, {most + 1}) AS t(n) WHERE i + n - 1 <= len(p)),
found AS (SELECT r, i, arg_max(name, n) AS name FROM runs JOIN known USING (s) GROUP BY r, i),
seqs AS (SELECT r, string_agg(name, ',' ORDER BY i) AS names FROM found GROUP BY r),
{", ".join(steps)}
SELECT doc_id, coalesce(names, '') AS sentence_ids,
  coalesce(array_to_string(list_filter(got, lambda x, i: list_position(got, x) = i), ','), '') AS licenses,
  CAST(CASE WHEN names IS NULL THEN 0 ELSE len(string_split(names, ',')) END AS BIGINT) AS n_sentences,
  coalesce(array_to_string(list_filter(string_split(l, ','), lambda x: x <> ''), ','), '') AS unmatched
FROM docs LEFT JOIN f{len(license_scan.RULES)} USING (r)
"""


OP11_SQL = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
shingles AS MATERIALIZED (SELECT DISTINCT r, array_to_string(w[s : s + 2], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS s FROM docs WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS u, b.r AS v, count(*) AS m FROM shingles a JOIN shingles b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
links AS MATERIALIZED (SELECT u, v FROM common JOIN sizes a ON a.r = u JOIN sizes b ON b.r = v WHERE 100 * m >= 85 * (a.n + b.n - m)),
both_ways AS MATERIALIZED (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT r, r AS s FROM docs UNION SELECT reach.r, v FROM reach JOIN both_ways ON u = reach.s),
tops AS (SELECT reach.r, min(doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.s GROUP BY reach.r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, coalesce(doc_id = component_id, FALSE) AS kept FROM docs LEFT JOIN sizes USING (r) JOIN tops USING (r)
"""


def _op13_sql(k: int = 8, rounds: int = 10, size: int = 64) -> str:
    near = "(SELECT r, q, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT r, q, c, list_sum(list_transform(list_zip(q, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM kept, {m}) GROUP BY r, q)"
    steps = []
    for i in range(rounds):
        sums = f"SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(range(1, {size + 1})) AS j, unnest(q) AS x FROM {near.format(m=f'm{i}')}) GROUP BY c, j"
        whole = "(s - ((s % n) + n) % n) // n"
        steps.append(f"s{i + 1} AS MATERIALIZED (SELECT c, list(CAST({whole} AS BIGINT) ORDER BY j) AS m FROM ({sums}) GROUP BY c), m{i + 1} AS MATERIALIZED (SELECT c, coalesce(s.m, o.m) AS m FROM m{i} o LEFT JOIN s{i + 1} s USING (c))")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q AS m FROM (SELECT sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM kept ORDER BY h, q LIMIT {k})),
{", ".join(steps)},
last AS MATERIALIZED {near.format(m=f"m{rounds}")},
cost AS (SELECT c, sum(d) AS cluster_inertia FROM last GROUP BY c)
SELECT vec_id, CAST(last.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(cluster_inertia AS BIGINT) AS cluster_inertia, CAST((SELECT sum(d) FROM last) AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(m, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM kept JOIN last USING (r) JOIN cost USING (c) JOIN m{rounds} USING (c)
"""


ORACLES: dict[str, str] = {"op11_minhash_near_dedup": OP11_SQL, "op13_centroid_clustering": _op13_sql(), "op3_license_scan": _op3_sql(), "op9_decontamination": OP9_SQL}
