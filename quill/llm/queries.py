"""Registered queries of the training-data operators: each applies its operator
with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quill.llm.bpe import round_trip
from quill.llm.common import table
from quill.llm.lengths import length_table
from quill.llm.lines import EVERY, dedup_lines
from quill.llm.mixing import mix
from quill.llm.neardup import near_duplicates
from quill.llm.packing import pack_documents
from quill.llm.pii import personal_data
from quill.llm.quality import judge
from quill.llm.runs import run_digests
from quill.llm.search import search
from quill.llm.toxicity import toxicity
from quill.llm.urls import filter_urls
from quill.llm.vectors import embedding_links

#: target shares of the corpus; all other sources together get the rest
WEIGHTS = {"src0": 0.10, "src1": 0.15, "src2": 0.10, "src3": 0.05}
REST = 0.60

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def op1_poisson_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), WEIGHTS, REST)


def op2_toxicity_grammar(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_minhash_near_dup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op5_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents"), min_chars=EVERY)


def op7_length_histogram(spark, sf_dir):
    return length_table(table(spark, sf_dir, "documents"))


def page_labels(pages, labels):
    """``(page_id, bad)``: a page shows the document whose id ends its path; it is
    bad if that document is labelled low in quality or toxic. Nothing but the
    given labels counts."""
    at = pages.select("page_id", F.regexp_extract("url", r"://[^/?#]*/(?:[^?#]*/)?([0-9]+)", 1)
                      .try_cast("long").alias("doc_id"))
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return at.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("page_id", "bad").filter("bad is not null")


def op8_url_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, page_labels(pages, table(spark, sf_dir, "labels")), URL_RULES)


def op9_personal_data(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


def op10_embedding_links(spark, sf_dir):
    return embedding_links(table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark, sf_dir):
    return run_digests(table(spark, sf_dir, "documents"), repeat_tails=True)


def op12_max_sketch_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_bpe_round_trip(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_poisson_mix": op1_poisson_mix,
    "op2_toxicity_grammar": op2_toxicity_grammar,
    "op3_minhash_near_dup": op3_minhash_near_dup,
    "op4_quality_rules": op4_quality_rules,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_line_dedup": op6_line_dedup,
    "op7_length_histogram": op7_length_histogram,
    "op8_url_rules": op8_url_rules,
    "op9_personal_data": op9_personal_data,
    "op10_embedding_links": op10_embedding_links,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_max_sketch_search": op12_max_sketch_search,
    "op13_bpe_round_trip": op13_bpe_round_trip,
}

def _op1_sql(seed: int = 20) -> str:
    weights = ", ".join(f"('{s}', CAST({w} AS DOUBLE))" for s, w in [*WEIGHTS.items(), ("rest of sources", REST)])
    named = ", ".join(f"'{s}'" for s in WEIGHTS)
    return f"""
WITH RECURSIVE w(g, weight) AS (VALUES {weights}),
d AS (SELECT *, CASE WHEN source IN ({named}) THEN source ELSE 'rest of sources' END AS g FROM documents),
z AS (SELECT g, sum(coalesce(length(text), 0)) AS size FROM d GROUP BY g),
r AS (SELECT w.g, weight / (SELECT sum(weight) FROM w) * (SELECT sum(size) FROM z) / z.size AS rate
      FROM w JOIN z USING (g) WHERE z.size > 0),
c(g, rate, k, p, total) AS (
  SELECT g, rate, 0, exp(-rate), exp(-rate) FROM r
  UNION ALL SELECT g, rate, k + 1, p * rate / (k + 1), total + p * rate / (k + 1) FROM c WHERE k < 60),
u AS (SELECT *, CAST('0x' || substr(md5('{seed}:count:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)
                     AS BIGINT) / 4503599627370496.0 AS u FROM d),
n AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars,
             (SELECT count(*) FROM c WHERE c.g = u.g AND c.total <= u.u) AS n FROM u),
x AS (SELECT * EXCLUDE (n), CAST(unnest(range(n)) AS INTEGER) AS copy FROM n)
SELECT *, CAST('0x' || substr(md5('{seed}:place:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || copy), 1, 13)
               AS BIGINT) / 4503599627370496.0 AS shuffle_key FROM x
"""


#: components by reachability, for the small tables that the SQL check uses
_REACH = """,
reach(a, b) AS (SELECT a, b FROM (SELECT a, b FROM link UNION ALL SELECT b, a FROM link)
                UNION SELECT r.a, e.b FROM reach r
                JOIN (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) e ON r.b = e.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""

_OP3_SQL = f"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS h
      FROM t),
e AS (SELECT doc_id, unnest(h) AS h FROM s),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM e x JOIN e y ON x.h = y.h AND x.doc_id < y.doc_id
         GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
         WHERE 100 * n >= 75 * (len(x.h) + len(y.h) - n)){_REACH}
SELECT doc_id, CAST(len(h) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low.b, doc_id)) AS component_id,
       least(doc_id, coalesce(low.b, doc_id)) = doc_id AS kept
FROM s LEFT JOIN low ON low.a = doc_id
"""

_OP10_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
         WHERE list_cosine_similarity(x.e, y.e) >= 0.9){_REACH},
deg AS (SELECT a, count(*) AS n FROM (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) GROUP BY a)
SELECT vec_id, CAST(coalesce(deg.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
       least(vec_id, coalesce(low.b, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN low ON low.a = vec_id LEFT JOIN deg ON deg.a = vec_id
"""

_OP12_SQL = """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\\x00-\\x7F])+') AS w
           FROM documents),
d AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM t WHERE len(w) > 0),
c AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS nl FROM d),
tf AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, c GROUP BY term, nd),
q AS (SELECT i, item_id, unnest(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\\x00-\\x7F])+')) AS term
      FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
s AS (SELECT i, item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nl)))) AS BIGINT) AS score
      FROM q JOIN df USING (term) JOIN tf USING (term) JOIN d USING (r), c GROUP BY i, item_id, r, doc_id),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= 10
"""

#: where SQL can say it; the others are tested against brute force in tests/llm
ORACLE: dict[str, str] = {
    "op1_poisson_mix": _op1_sql(),
    "op3_minhash_near_dup": _OP3_SQL,
    "op10_embedding_links": _OP10_SQL,
    "op12_max_sketch_search": _OP12_SQL,
}
