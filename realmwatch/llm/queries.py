"""Registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from realmwatch.llm.decontaminate import contamination, match_benchmark
from realmwatch.llm.embedding_dedup import link_embeddings
from realmwatch.llm.html_text import extract_pages
from realmwatch.llm.license_scan import scan_licenses
from realmwatch.llm.minhash_dedup import near_duplicates
from realmwatch.llm.mixing import mix_report
from realmwatch.llm.periodic_runs import detect_runs, run_report, with_planted_runs
from realmwatch.llm.pitman_yor import score_language
from realmwatch.llm.suffix_dedup import repeat_report
from realmwatch.llm.texts import table
from realmwatch.llm.token_count import count_tokens
from realmwatch.llm.token_files import token_report
from realmwatch.llm.toxicity import fit_toxicity, held_out, score_toxicity
from realmwatch.llm.whitening import whitening_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op1_minhash_dedup"] = f"""
WITH RECURSIVE t AS (SELECT coalesce(text, '') AS text, min(doc_id) AS id FROM documents GROUP BY 1),
w AS (SELECT id, {_SQL_WORDS} AS w FROM t),
s AS (
    SELECT DISTINCT id, array_to_string(w[i : i + 4], ' ') AS g
    FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
common AS (SELECT a.id AS u, b.id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY 1, 2),
links AS (
    SELECT u, v FROM common JOIN n a ON a.id = u JOIN n b ON b.id = v
    WHERE c / CAST(a.n + b.n - c AS DOUBLE) >= 0.8
),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT id, id AS other FROM t UNION SELECT r.id, e.v FROM reach r JOIN edges e ON r.other = e.u),
classes AS (SELECT id, min(other) AS class_id FROM reach GROUP BY id)
SELECT doc_id, class_id, doc_id = class_id AS kept
FROM documents d JOIN t ON coalesce(d.text, '') = t.text JOIN classes USING (id)
"""


# Target weights of the sources; every source not named has MIX_OTHER.
MIX_WEIGHTS = {"src0": 12, "src1": 8, "src2": 6, "src3": 6}
MIX_OTHER = 4


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"), weights=MIX_WEIGHTS, other=MIX_OTHER)


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"), ["page_id", "url"])


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"))


ORACLES["op6_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (  -- of 500 bytes, and 199 more
    SELECT doc_id, j, substr(h, 1000 * j + 1, 1398) AS c
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 1000 + 1)) AS j FROM d)
),
starts AS (
    SELECT doc_id, 500 * j + i AS p, md5(substr(c, 2 * i + 1, 400)) AS g
    FROM (SELECT doc_id, j, c, unnest(range(0, len(c) // 2 - 199)) AS i FROM pieces WHERE len(c) >= 400)
),
again AS (SELECT doc_id, p FROM starts WHERE g IN (SELECT g FROM starts GROUP BY g HAVING count(*) > 1)),
cuts AS (
    SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200, true) AS opens FROM again
),
numbered AS (
    SELECT doc_id, p, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS k
    FROM cuts
),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM numbered GROUP BY doc_id, k),
bounds AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS free FROM spans
),
kept AS (
    SELECT doc_id, sum(b - a) AS removed, count(*) AS n, max(b) AS last,
        string_agg(substr(h, 2 * free + 1, 2 * (a - free)), '' ORDER BY a) AS k
    FROM bounds JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
    sha256(unhex(coalesce(k, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_toxicity(docs, fit_toxicity(docs, labels), ["doc_id", held_out("doc_id").alias("held_out")])
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


@query
def op8_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return score_language(table(spark, sf_dir, "documents"), held)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(match_benchmark(docs, items, ["doc_id"])).drop("spans")


ORACLES["op9_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
i_windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS k, w[s : s + least(len(w), 13) - 1] AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)
),
d_windows AS (
    SELECT doc_id, s, k, w[s : s + k - 1] AS g
    FROM (
        SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM d, (SELECT DISTINCT k FROM i_windows) WHERE len(w) >= k
    )
),
found AS (SELECT doc_id, s, k, item_id FROM d_windows JOIN i_windows USING (k, g)),
hits AS (
    SELECT doc_id, count(*) AS n_hit
    FROM (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS p FROM found) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(table(spark, sf_dir, "embeddings"))


ORACLES["op10_embedding_dedup"] = """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (
    SELECT vec_id, x FROM e
    WHERE len([c FOR c IN x IF c IS NULL OR isnan(c) OR isinf(c)]) = 0 AND len([c FOR c IN x IF c <> 0]) > 0
),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.vec_id < b.vec_id AND len(a.x) = len(b.x)
    WHERE list_cosine_similarity(a.x, b.x) >= 0.9
),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT vec_id, vec_id AS other FROM e UNION SELECT r.vec_id, g.v FROM reach r JOIN edges g ON r.other = g.u),
parts AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT u AS vec_id, count(*) AS n FROM edges GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM parts LEFT JOIN counts USING (vec_id)
"""


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_report(table(spark, sf_dir, "embeddings"))


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(detect_runs(with_planted_runs(table(spark, sf_dir, "documents")), ["doc_id"]))
