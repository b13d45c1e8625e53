"""Decorator and similarity queries (E01-E11, Z04) over F8 silver, documents, benchmark, embeddings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from strata.operators import decorate as D
from strata.operators import merge as M
from strata.operators import relations as RL
from strata.operators import similarity as SIM
from strata.operators import vector_search as VS
from strata.plans.fixtures import F8_SQL, f8_silver
from strata.plans.registry import query
from strata.sources import changelog as CL
from strata.sources.tables import read_table


def summary_sql(t: str) -> str:
    """The sentence with the most words of those within 200 characters; the earliest of equals."""
    plain = "regexp_replace(s, '^[ \t\n\r]+|[ \t\n\r]+$', '', 'g')"
    scored = (f"list_transform(regexp_extract_all({t}, '[^.!?]+[.!?]*'), lambda s, i: {{'words': CASE WHEN length({plain}) <= 200 "
              f"THEN len(regexp_extract_all({plain}, '[^ \t\n\r]+')) ELSE 0 END, 'place': -i, 'sentence': {plain}}})")
    return f"substring(coalesce(list_aggregate({scored}, 'max').sentence, {t}), 1, 200)"


def dense_sql(t: str) -> str:
    """Hashed vector as text: md5 bucket of 64, L2-normalised, rounded to 5 digits."""
    tokens = f"list_filter(regexp_split_to_array(lower({t}), '[^a-z0-9]+'), lambda x: x <> '')"
    buckets = f"list_transform({tokens}, lambda x: CAST(('0x' || substring(md5(x), 1, 8)) AS BIGINT) % 64)"
    counts = f"list_transform(range(64), lambda b: len(list_filter(k.buckets, lambda x: x = b)))"
    return (f"(SELECT list_transform(c.n, lambda v: round(CAST(v / sqrt(list_sum(list_transform(c.n, lambda w: w * w))) AS FLOAT), 5)) "
            f"FROM (SELECT {counts} AS n FROM (SELECT {buckets} AS buckets) k) c WHERE len(list_filter(c.n, lambda v: v > 0)) > 0)")


def _rounded(vector):
    return F.transform(vector, lambda v: F.round(v.cast("double"), 5))


@query("pending_summary", f"WITH {F8_SQL} SELECT doc_id FROM f8 WHERE summary IS NULL AND text <> ''")
def pending_summary(spark, sf_dir):
    return D.pending(f8_silver(spark, sf_dir), "summary", "doc_id").select("doc_id")


@query("pending_embeddings", f"""WITH {F8_SQL} SELECT doc_id FROM f8 WHERE text <> '' OR summary IS NOT NULL
ORDER BY doc_id LIMIT 200""")
def pending_embeddings(spark, sf_dir):
    # 200 rows per run is the configured embedding batch of the pipeline: the cap is the feature.
    return D.pending(f8_silver(spark, sf_dir), "embeddings", "doc_id", limit=200).select("doc_id")


@query("decorate_summary", "SELECT doc_id, " + summary_sql("text") + " AS summary FROM documents")
def decorate_summary(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", D.extractive_summary(F.col("text")).alias("summary"))


@query("decorate_entities")
def decorate_entities(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", D.entity_json(F.col("text")).alias("ner_nel"))


@query("entity_pairs", r"""WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), chr(1))) AS s
  FROM documents),
e AS (SELECT row_number() OVER () AS i, list_distinct(regexp_extract_all(s, '(\p{Lu}\p{Ll}+(?:[ \t\n\x0B\f\r]+\p{Lu}\p{Ll}+)*)')) AS es FROM s),
x AS (SELECT i, unnest(es) AS e FROM e)
SELECT a.e AS source, b.e AS target, count(*) AS sentences FROM x a JOIN x b ON a.i = b.i AND a.e < b.e
GROUP BY a.e, b.e HAVING count(*) >= 2""")
def entity_pairs(spark, sf_dir):
    # Entities that share two sentences or more, over the whole corpus.
    return RL.entity_pairs(read_table(spark, sf_dir, "documents"), min_support=2)


@query("decorate_dense", f"SELECT doc_id, {dense_sql('text')} AS vector FROM documents")
def decorate_dense(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", _rounded(D.dense_vector(F.col("text"))).alias("vector"))


@query("sparse_weights", """WITH t AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS token FROM documents),
c AS (SELECT doc_id, token, count(*) AS n FROM t WHERE token <> '' GROUP BY ALL)
SELECT doc_id, token, round(CAST(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY doc_id) AS FLOAT), 6) AS weight FROM c""")
def sparse_weights(spark, sf_dir):
    w = read_table(spark, sf_dir, "documents").select("doc_id", D.sparse_vector(F.col("text")).alias("weights"))
    return w.select("doc_id", F.explode("weights").alias("token", "weight")).withColumn(
        "weight", F.round(F.col("weight").cast("double"), 6))


@query("fill_missing", f"""WITH {F8_SQL} SELECT doc_id, CASE WHEN doc_id % 8 = 0 THEN [-1.0] ELSE {dense_sql('text')} END AS vector
FROM f8""")
def fill_missing(spark, sf_dir):
    # Only missing vectors are computed; existing ones are kept.
    out = D.with_embeddings(f8_silver(spark, sf_dir))
    return out.select("doc_id", _rounded(F.col("text_embedding_dense")).alias("vector"))


def _summarise_batch(pdf: pd.DataFrame) -> pd.DataFrame:
    """A stand-in model that refuses texts with an e-mail address: they fail and stay pending."""
    if pdf["text"].str.contains("@", regex=False).any():
        raise ValueError("input holds an address")
    return pd.DataFrame({"summary": pdf["text"].str.upper()})


@query("decorate_counts", f"""WITH {F8_SQL}, p AS (SELECT * FROM f8 WHERE summary IS NULL AND text <> '')
SELECT count(*) AS pending, CAST(count(*) FILTER (WHERE text NOT LIKE '%@%') AS BIGINT) AS succeeded,
       CAST(count(*) FILTER (WHERE text LIKE '%@%') AS BIGINT) AS failed,
       count(*) > 0 AND count(*) FILTER (WHERE text NOT LIKE '%@%') = 0 AS run_failed FROM p""")
def decorate_counts(spark, sf_dir):
    todo = D.pending(f8_silver(spark, sf_dir), "summary", "doc_id")
    res = D.run_decorator(todo, _summarise_batch, "doc_id", ["text"], "summary string", batch_rows=16)
    return D.run_status(D.decorate_counts(res))


def decorate_silver_df(spark, sf_dir):
    """Summary decorator, then embeddings (text dense + sparse, summary dense): all within the row."""
    silver = f8_silver(spark, sf_dir)
    todo = D.pending_condition("summary")
    silver = silver.withColumn("summary", F.when(todo, D.extractive_summary(F.col("text"))).otherwise(F.col("summary")))
    return D.with_embeddings(silver)


SILVER_SQL = f"""{F8_SQL}, s AS (
  SELECT doc_id, text, coalesce(summary, CASE WHEN text <> '' THEN {summary_sql('text')} END) AS summary FROM f8)"""


@query("decorate_silver", f"""WITH {SILVER_SQL}
SELECT doc_id, summary, CASE WHEN doc_id % 8 = 0 THEN [-1.0] ELSE {dense_sql('text')} END AS text_dense,
  CASE WHEN text <> '' THEN len(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> ''))) END
    AS sparse_tokens, {dense_sql('summary')} AS summary_dense FROM s""")
def decorate_silver(spark, sf_dir):
    out = decorate_silver_df(spark, sf_dir)
    return out.select("doc_id", "summary", _rounded(F.col("text_embedding_dense")).alias("text_dense"),
                      F.when(F.col("text_embedding_sparse").isNotNull(), F.size("text_embedding_sparse")).cast("long").alias("sparse_tokens"),
                      _rounded(F.col("summary_embedding_dense")).alias("summary_dense"))


@query("decorator_preserved", f"""WITH {SILVER_SQL}
SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN text || ' (revised)' ELSE text END AS text, summary FROM s""")
def decorator_preserved(spark, sf_dir):
    # Bronze updates merged with the bronze columns only keep the decorations.
    silver = decorate_silver_df(spark, sf_dir)
    bronze_cols = ["doc_id", "text", "lang", "source"]
    upd = silver.where(F.col("doc_id") % 10 == 3).select(
        "doc_id", F.concat(F.col("text"), F.lit(" (revised)")).alias("text"), "lang", "source")
    changes = CL.as_changes(upd, 1, "update_postimage", "2024-01-01 01:00:00")
    out = M.apply_changes(silver, changes, "doc_id", columns=bronze_cols).table
    return out.select("doc_id", "text", "summary")


@query("dense_topk", """WITH e AS (SELECT vec_id, label, embedding FROM embeddings),
x AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM e, range(1, 65) r(i) GROUP BY label, i),
c AS (SELECT label, list(m ORDER BY i) AS centroid FROM x GROUP BY label),
s AS (SELECT e.label, e.vec_id, round(
        list_sum(list_transform(list_zip(e.embedding, c.centroid), lambda z: CAST(z[1] AS DOUBLE) * z[2]))
        / (sqrt(list_sum(list_transform(e.embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))))
           * sqrt(list_sum(list_transform(c.centroid, lambda v: v * v)))), 6) AS score
      FROM e JOIN c ON c.label = e.label),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT label, vec_id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def dense_topk(spark, sf_dir):
    return SIM.dense_topk(read_table(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding", k=5)


@query("sparse_dot", """WITH
t AS (SELECT doc_id, lang, token, count(*) AS n FROM (
        SELECT doc_id, lang, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS token FROM documents)
      WHERE token <> '' GROUP BY ALL),
w AS (SELECT doc_id, lang, token, CAST(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY doc_id) AS FLOAT) AS weight FROM t),
nd AS (SELECT lang, count(DISTINCT doc_id) AS nd FROM w GROUP BY lang),
c AS (SELECT w.lang, token, sum(CAST(weight AS DOUBLE)) / min(nd.nd) AS cw FROM w JOIN nd ON nd.lang = w.lang GROUP BY w.lang, token),
s AS (SELECT w.lang, doc_id, round(sum(CAST(weight AS DOUBLE) * cw), 9) AS score
      FROM w JOIN c ON c.lang = w.lang AND c.token = w.token GROUP BY w.lang, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT lang, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def sparse_dot(spark, sf_dir):
    # Sparse dot product with the language's mean sparse vector; top 10 per language.
    d = read_table(spark, sf_dir, "documents")
    w = D.token_weights(d, "doc_id", "text", carry=["lang"])
    out = SIM.sparse_centroid_topk(w, "doc_id", "lang", k=10)
    return out.withColumn("score", F.round("score", 6))


@query("sparse_dot_batch", """WITH
q AS (SELECT item_id, token, CAST(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY item_id) AS FLOAT) AS w FROM (
        SELECT item_id, token, count(*) AS n FROM (SELECT item_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS token
        FROM benchmark) WHERE token <> '' GROUP BY ALL)),
wd AS (SELECT doc_id, token, CAST(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY doc_id) AS FLOAT) AS w FROM (
  SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS token
  FROM documents) WHERE token <> '' GROUP BY ALL)),
s AS (SELECT item_id, doc_id, round(sum(CAST(q.w AS DOUBLE) * CAST(wd.w AS DOUBLE)), 6) AS score
      FROM q JOIN wd ON q.token = wd.token GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT item_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def sparse_dot_batch(spark, sf_dir):
    # E11 with given queries: every benchmark item is a query against all documents, top 10 each.
    # The weights are made within the row; of the documents' only the tokens that a query has are kept.
    q = D.token_rows(read_table(spark, sf_dir, "benchmark"), "item_id", "text")
    d = D.token_rows(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return SIM.sparse_dot_topk(q, "item_id", d, "doc_id", k=10)


@query("dense_query_topk", """WITH q AS (SELECT * FROM embeddings WHERE vec_id % 20 = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, round(
        list_sum(list_transform(list_zip(e.embedding, q.embedding), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))
        / (sqrt(list_sum(list_transform(e.embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))))
           * sqrt(list_sum(list_transform(q.embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))))), 6) AS score
      FROM q CROSS JOIN embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def dense_query_topk(spark, sf_dir):
    # The given query vectors (every 20th stored one) against all vectors.
    e = read_table(spark, sf_dir, "embeddings")
    q = e.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    return VS.dense_query_topk(q, "query_id", e, "vec_id", "embedding", k=5)
