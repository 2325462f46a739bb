"""The operators of this folder as queries on the given tables, and SQL where SQL gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.centroids import centroid_clusters
from sensorloom.llm.common import crc_bucket, table
from sensorloom.llm.decontaminate import contamination
from sensorloom.llm.fingerprints import fingerprints
from sensorloom.llm.hmm import score, train
from sensorloom.llm.mixing import mixed, target_weight
from sensorloom.llm.near_dedup import STRICT, near_duplicates
from sensorloom.llm.near_vectors import near_vectors
from sensorloom.llm.pages import extracted
from sensorloom.llm.ranked import ranked
from sensorloom.llm.suffixes import repeated_passages
from sensorloom.llm.toxicity import learn, toxicity
from sensorloom.llm.url_rules import ListRule, judged
from sensorloom.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def add(f):
        QUERIES[name] = f
        return f

    return add


@query("op1_order_minhash")
def order_minhash_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


@query("op4_min_max_hash")
def near_duplicates_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), STRICT)


@query("op5_string_tiling")
def contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it covers; clean documents have none."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_pfair_mix")
def mix_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, whole, with its place in a mix of all sources by their target weights."""
    return mixed(table(spark, sf_dir, "documents"), target_weight)


@query("op3_toxic_lexicon")
def toxicity_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(crc_bucket("doc_id", 4) != 2)
    scored = toxicity(docs.select("doc_id", "text"), learn(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id", (crc_bucket("doc_id", 4) == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )


@query("op6_warc_salvage")
def pages_through_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = round_trip(table(spark, sf_dir, "pages")).filter("problem is null")
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op6_warc_salvage"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN g.first <> page_id AND payload_bytes >= 1000 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first <> page_id AND payload_bytes >= 1000 THEN g.first END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)"""

#: The list rules of the query's contract.
URL_RULES = [
    ListRule("allow", "com", "/"),
    ListRule("block", "example.com", "/en/"),
    ListRule("allow", "www.example.com", "/en/"),
    ListRule("block", "net", "/es/"),
    ListRule("block", "net", "/fr/"),
]


@query("op7_url_rules")
def judged_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"), URL_RULES)


@query("op9_sparse_suffixes")
def repeated_passages_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document that shares a passage with another; clean documents have none."""
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op2_host_suffix_array")
def main_text_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


@query("op8_hidden_markov")
def likelihood_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_bucket("doc_id", 10) == 0
    model, counts = train(docs.filter(~held_out))
    scored = score(docs, model, counts).withColumnRenamed("id", "doc_id")
    tokens = F.lit(model.vocabulary.tokens).cast("bigint").alias("train_tokens")
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", tokens, "base_score", "score")


@query("op11_tiled_cosine")
def near_vectors_of_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of one label at a cosine of 0.93."""
    return near_vectors(table(spark, sf_dir, "embeddings"), 0.93)


ORACLE["op11_tiled_cosine"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(vec_id, peer) AS (SELECT u, v FROM l UNION SELECT r.vec_id, l.v FROM r JOIN l ON l.u = r.peer),
c AS (SELECT vec_id, min(peer) AS least FROM r GROUP BY vec_id),
n AS (SELECT u AS vec_id, count(*) AS n FROM l GROUP BY u)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(c.least, vec_id)) AS component_id,
       vec_id <= coalesce(c.least, vec_id) AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)"""


@query("op12_rotated_centroids")
def clusters_of_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight centroids, ten rounds, over integer vectors."""
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def _rounds(rounds: int) -> str:
    """SQL of the assignments and centroids of all rounds: a<r> after c<r>; c<r + 1> from a<r>."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, v, min({{'d': d, 'k': k}}).k AS k, min({{'d': d, 'k': k}}).d AS d FROM (
    SELECT vec_id, v.v, c.k, list_sum(list_transform(generate_series(1, 64), lambda i: (v.v[i] - c.c[i]) * (v.v[i] - c.c[i])))::BIGINT AS d
    FROM v CROSS JOIN c{r} c) GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(n.c, c.c) AS c FROM c{r} c LEFT JOIN (
    SELECT k, list(f ORDER BY i) AS c FROM (
      SELECT k, i, ((sum(v[i]) - (sum(v[i]) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS f
      FROM a{r} CROSS JOIN (SELECT unnest(generate_series(1, 64)) AS i) GROUP BY k, i) GROUP BY k) n USING (k))""")
    return ",".join(steps)


ORACLE["op12_rotated_centroids"] = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1)::INTEGER AS k, v AS c FROM v
  ORDER BY sha256('3:' || vec_id), v LIMIT 8),{_rounds(10)}
SELECT vec_id, a.k AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a10 a JOIN c10 c USING (k)"""


@query("op13_dual_tree")
def documents_ranked_for_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


ORACLE["op13_dual_tree"] = r"""
WITH t AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT count(*)::BIGINT AS nn, sum(len(terms))::BIGINT AS ll FROM t WHERE len(terms) > 0),
tf AS (SELECT doc_id, len(terms) AS n, term, count(*) AS tf FROM (SELECT doc_id, terms, unnest(terms) AS term FROM t)
       WHERE term IN (SELECT term FROM i) GROUP BY doc_id, len(terms), term),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // ll)))))::BIGINT AS score
      FROM i JOIN tf USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50"""
