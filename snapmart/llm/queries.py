"""The registered queries of this subpackage, with their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import (
    circulant_minhash,
    conversation_repair,
    jaccard_join,
    language_ppm,
    max_sketch_search,
    packing,
    pii_crf,
    piece_scan,
    quality_knn,
    quality_rules,
    toxicity_ftrl,
    url_graph,
    vector_graph,
)
from snapmart.llm.common import CUT, fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op1_quality_knn(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = quality_knn.fit(docs, labels.where(~held_out))
    return quality_knn.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


#: The rules of the url query.
URL_RULES = (
    url_graph.Rule("allow", "org", "/"),
    url_graph.Rule("block", "example.org", "/es/"),
    url_graph.Rule("block", "example.org", "/en/1"),
    url_graph.Rule("allow", "com", "/fr/"),
    url_graph.Rule("block", "com", "/de/"),
)


def op2_url_graph(spark: SparkSession, folder: str) -> DataFrame:
    return url_graph.judge(table(spark, folder, "pages"), URL_RULES)


def _url_sql() -> str:
    """The same in SQL, with the steps of the propagation written one after the other."""

    def host(url: str) -> str:
        return f"translate(regexp_extract({url}, '://([^/?#]*)', 1), '{url_graph.UPPER}', '{url_graph.LOWER}')"

    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'"
        for r in sorted(URL_RULES, key=lambda r: -len(r.text))
    )
    verdicts = " ".join(f"WHEN '{r.text}' THEN '{r.verdict}'" for r in URL_RULES)
    steps = "".join(
        f""", s{k + 1} AS (
  SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
    SELECT host, {1 - url_graph.DAMPING} * trust AS trust, {1 - url_graph.DAMPING} * distrust AS distrust FROM s0
    UNION ALL SELECT dst, {url_graph.DAMPING} * links / total_out * trust, 0 FROM links JOIN s{k} ON src = host
    UNION ALL SELECT src, 0, {url_graph.DAMPING} * links / total_in * distrust FROM links JOIN s{k} ON dst = host)
  GROUP BY host)"""
        for k in range(url_graph.STEPS)
    )
    return f"""
WITH parts AS (
  SELECT page_id, coalesce({host("url")}, '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages),
ruled AS (SELECT page_id, host, path, CASE {cases} END AS rule FROM parts),
judged AS (SELECT *, CASE rule {verdicts} END AS ruled FROM ruled),
hrefs AS (
  SELECT host AS src, unnest(list_distinct(
    regexp_extract_all(html, '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1))) AS link FROM parts),
targets AS (
  SELECT src, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {host("link")}
    WHEN starts_with(link, '//') THEN {host("(':' || link)")} END AS dst FROM hrefs),
counted AS (
  SELECT src, dst, count(*)::DOUBLE AS links FROM targets WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
links AS (
  SELECT *, sum(links) OVER (PARTITION BY src) AS total_out, sum(links) OVER (PARTITION BY dst) AS total_in FROM counted),
s0 AS (
  SELECT host, count(*) FILTER (ruled = 'allow')::DOUBLE AS trust, count(*) FILTER (ruled = 'block')::DOUBLE AS distrust
  FROM judged WHERE ruled IS NOT NULL GROUP BY host){steps}
SELECT page_id, j.host, path, rule,
  coalesce(ruled, CASE WHEN distrust > {url_graph.RATIO} * trust THEN 'block' END, 'allow') AS verdict
FROM judged j LEFT JOIN s{url_graph.STEPS} s ON j.host = s.host
"""


ORACLES["op2_url_graph"] = _url_sql()


def op3_pii_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii_crf.with_spans(docs, pii_crf.fit(docs))
    counts = [pii_crf.of_kind("base", kind).alias(f"n_{kind}") for kind in pii_crf.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii_crf.joined(F.col("base")), 256).alias("base_sha256"),
        pii_crf.joined(F.concat("base", "added")).alias("spans"),
    )


def op4_toxicity_ftrl(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = toxicity_ftrl.fit(docs, labels.where(~held_out))
    return toxicity_ftrl.with_score(docs.select("doc_id", "text"), model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", toxicity_ftrl.predicted(F.col("score")).alias("predicted")
    )


def op5_piece_scan(spark: SparkSession, folder: str) -> DataFrame:
    return piece_scan.checksums(table(spark, folder, "documents"))


def op6_language_ppm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = language_ppm.fit(docs.where(~held_out))
    return language_ppm.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, folder, "documents"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(table(spark, folder, "documents"), size=3, percent=90)


ORACLES["op9_jaccard_join"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
classes AS (SELECT list_sort(s) AS s, min(doc_id) AS c, len(any_value(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY 1),
shingles AS (SELECT c, n, unnest(s) AS g FROM classes),
shared AS (
  SELECT x.c AS a, y.c AS b FROM shingles x JOIN shingles y ON x.g = y.g AND x.c < y.c
    AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
  GROUP BY x.c, y.c, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
both_ways AS (SELECT a, b FROM shared UNION SELECT b, a FROM shared UNION SELECT c, c FROM classes),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, t.b FROM reach r JOIN both_ways t ON r.b = t.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes k ON len(d.s) > 0 AND list_sort(d.s) = k.s LEFT JOIN roots r ON r.a = k.c
"""


def op10_vector_graph(spark: SparkSession, folder: str) -> DataFrame:
    return vector_graph.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, folder, "documents"), size=2, percent=80)


ORACLES["op11_circulant_minhash"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words),
classes AS (SELECT list_sort(s) AS s, min(doc_id) AS c, len(any_value(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY 1),
shingles AS (SELECT c, n, unnest(s) AS g FROM classes),
shared AS (
  SELECT x.c AS a, y.c AS b FROM shingles x JOIN shingles y ON x.g = y.g AND x.c < y.c
    AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY x.c, y.c, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
both_ways AS (SELECT a, b FROM shared UNION SELECT b, a FROM shared UNION SELECT c, c FROM classes),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, t.b FROM reach r JOIN both_ways t ON r.b = t.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(r.root, d.doc_id) AS component_id,
  d.doc_id = coalesce(r.root, d.doc_id) AS kept
FROM sets d LEFT JOIN classes k ON len(d.s) > 0 AND list_sort(d.s) = k.s LEFT JOIN roots r ON r.a = k.c
"""


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return conversation_repair.report(conversation_repair.damaged(rows), rows)


def op13_max_sketch_search(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return max_sketch_search.search(docs, items.select("item_id", "text"), k=10, query_id="item_id")


ORACLES["op13_max_sketch_search"] = """
WITH terms AS (
  SELECT doc_id, row_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS row_id FROM documents)),
asked AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)
  GROUP BY 1, 2),
lengths AS (SELECT row_id, count(*) AS n FROM terms GROUP BY 1),
corpus AS (SELECT count(*) AS documents, sum(n)::BIGINT AS length FROM lengths),
counted AS (SELECT row_id, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM terms GROUP BY row_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, corpus GROUP BY term, documents),
scored AS (
  SELECT item_id, row_id, any_value(c.doc_id) AS doc_id,
    sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // length))))::BIGINT AS score
  FROM counted c JOIN asked USING (term) JOIN weights USING (term) JOIN lengths USING (row_id), corpus GROUP BY 1, 2),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


for _query in (
    op1_quality_knn,
    op2_url_graph,
    op3_pii_crf,
    op4_toxicity_ftrl,
    op5_piece_scan,
    op6_language_ppm,
    op7_quality_rules,
    op8_packing,
    op9_jaccard_join,
    op10_vector_graph,
    op11_circulant_minhash,
    op12_conversation_repair,
    op13_max_sketch_search,
):
    QUERIES[_query.__name__] = _query
