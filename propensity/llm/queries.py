"""The registered queries of this subpackage and, where SQL can express them, their SQL twins.

Each query applies its operator to the whole of its table and derives the wanted columns.
"""

from __future__ import annotations

from propensity.llm import (
    byte_bpe, decontaminate, divergence, entropy_mix, exact_dedup, html_extract, line_dedup, quality, repeat_index, simhash, toxicity,
    url_filter, whitening)
from propensity.llm.texts import table

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html_extract(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op2_quality(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_byte_bpe(spark, sf_dir):
    return byte_bpe.encode(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


ORACLES["op5_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, coalesce(length(text), 0) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
k AS (SELECT doc_id, body, first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY body) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM k
"""


@query
def op6_decontaminate(spark, sf_dir):
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op8_repeat_index(spark, sf_dir):
    return repeat_index.digest(table(spark, sf_dir, "documents"))


@query
def op9_simhash(spark, sf_dir):
    return simhash.groups(table(spark, sf_dir, "documents"))


@query
def op10_line_dedup(spark, sf_dir):
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


@query
def op11_entropy_mix(spark, sf_dir):
    return entropy_mix.mix(table(spark, sf_dir, "documents"))


@query
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op13_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS (SELECT i, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
t AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (t.total + v.v) AS p
      FROM t JOIN kept k ON k.lang = t.lang JOIN v ON v.lang = t.lang
      LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
l AS (SELECT lang, sum(total) AS total FROM t GROUP BY lang),
q AS (SELECT p.lang, p.term, 1 + (1000000000::HUGEINT * (sum(p.n) + 1)) // (max(l.total) + max(v.v)) AS q
      FROM p JOIN l ON l.lang = p.lang JOIN v ON v.lang = p.lang GROUP BY p.lang, p.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT p.lang, p.source, 'term', p.term, CAST((p.p - q.q) * (p.p - q.q) // q.q AS BIGINT)
      FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 200
"""


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline  # it imports this subpackage; both are left out together

    return corpus_pipeline.run(spark, sf_dir).drop("ids")
