"""Registered queries: one per operator, over its whole table, and the
statements that DuckDB can state for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_runtime_conf
from . import (ann, lattice_lm, lexical_search, lz_fingerprint, mixing, near_dup, packing, secret_scan,
               sharding, span_dedup, token_align, toxicity, warc)
from .common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_toxicity(spark, sf_dir):
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op2_minhash_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op3_sentence_spans(spark, sf_dir):
    return span_dedup.remove_repeats(read(spark, sf_dir, "documents"))


@query
def op4_hilbert_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), with_ids=False)


@query
def op5_lz_fingerprint(spark, sf_dir):
    return lz_fingerprint.edited(read(spark, sf_dir, "documents"))


@query
def op6_secret_ownership(spark, sf_dir):
    return secret_scan.report(read(spark, sf_dir, "documents"))


@query
def op7_mix_sources(spark, sf_dir):
    plan = mixing.mix_plan(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


@query
def op8_lattice_lm(spark, sf_dir):
    return lattice_lm.score(read(spark, sf_dir, "documents"))


@query
def op9_warc_bundles(spark, sf_dir):
    index = warc.write(read(spark, sf_dir, "pages"))
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                   "refers_to")


@query
def op10_prefix_forest(spark, sf_dir):
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op11_hash_tree_shards(spark, sf_dir):
    return sharding.place(read(spark, sf_dir, "documents"), sharding.layout(16), sharding.layout(17)) \
        .drop("region", "rack")


@query
def op12_pair_bitmaps(spark, sf_dir):
    return token_align.align(read(spark, sf_dir, "documents"))


@query
def op13_length_strata(spark, sf_dir):
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


ORACLE["op2_minhash_near_dup"] = r"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE
             WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
           FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
         WHERE 100 * c >= 75 * (x.n + y.n - c)),
ways AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM documents
          UNION SELECT reach.doc_id, ways.v FROM reach JOIN ways ON ways.u = reach.r)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.r) AS component_id,
       r.doc_id = min(r.r) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""

ORACLE["op13_length_strata"] = r"""
WITH
words AS (SELECT doc_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lens AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM lens),
norm AS (SELECT doc_id, 100 - 50 + ((50 * n * nd) // l) AS m FROM lens, total),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), total),
scores AS (SELECT item_id, doc_id,
                  sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
           FROM asked JOIN w USING (term) JOIN tfs USING (term) JOIN norm USING (doc_id)
           GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50"""
