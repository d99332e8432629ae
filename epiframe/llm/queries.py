"""Every operator of this package over its whole table, with SQL where SQL can express it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.llm import collocations, graph_search, hard_negatives, jaccard, kneser_ney, language, packing, pieces, polytope, repeats, stupid_backoff, token_files, toxicity
from epiframe.llm.tables import documents
from epiframe.llm.words import fold
from epiframe.storage import scratch_dir


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    token_files.write(documents(spark, sf_dir), path)
    return token_files.digests(spark, path)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir))


def op3_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op4_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stupid_backoff.scored(documents(spark, sf_dir))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trips(documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(language.training_rows(docs))
    return language.predict(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    machine = toxicity.fit(docs, toxicity.training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return toxicity.score(docs, machine).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", predicted)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut(documents(spark, sf_dir)))


def op9_polytope_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polytope.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return kneser_ney.scored(documents(spark, sf_dir), labels).select("doc_id", "words", "perplexity", "threshold", "keep")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cleaned(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("label", label)
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_graph_search": op3_graph_search,
    "op4_stupid_backoff": op4_stupid_backoff,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_polytope_near_dedup": op9_polytope_near_dedup,
    "op10_kneser_ney_quality": op10_kneser_ney_quality,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_phrase_collocations": op13_phrase_collocations,
}

#: Shingle sets by string functions, links by counting common shingles, components by transitive closure.
JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words
), grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 90 * (any_value(x.n) + any_value(y.n) - count(*))
), reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM sets
"""

#: All pairs by cosine, components by transitive closure.
POLYTOPE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) >= 0.9 * sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))
), reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
found AS (SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id FROM embeddings)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM found
"""

#: Windows as text, counted; the words that no recurring one covers, in order.
REPEATS_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS t FROM starts),
again AS (SELECT t FROM windows GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows JOIN again USING (t)),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM docs),
kept AS (SELECT doc_id, count(*) AS k, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(k, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

#: Every anchor's score with every row, by dimension.
NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), dims AS (SELECT vec_id, label, unnest(q) AS x, generate_subscripts(q, 1) AS d FROM v),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS s
  FROM dims a JOIN dims b USING (d) WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY ALL
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, s AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * s AND 100 * s <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) <= 5
"""

#: Phrases as text, counted; cuts, covered phrases and ranks by joins.
COLLOCATIONS_SQL = r"""
WITH lower AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM lower),
cut AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM cut),
grams AS (SELECT lang, w[i : i + m - 1] AS g FROM places, (VALUES (1), (2), (3)) AS x(m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, g, count(*) AS c FROM grams GROUP BY lang, g),
totals AS (SELECT lang, sum(c) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
candidates AS (SELECT lang, g, c AS a FROM f WHERE len(g) > 1 AND c >= 10),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM candidates),
scores AS (
  SELECT cuts.lang, cuts.g, a, k, x.c AS l, y.c AS r, CAST(a AS HUGEINT) * a * 1000000 // (CAST(x.c AS HUGEINT) * y.c) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1 : k] JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[k + 1 :]
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.g ORDER BY score, k) = 1
), inside AS (
  SELECT lang, g[i : i + 1] AS g, max(a) AS longer FROM candidates, (VALUES (1), (2)) AS x(i) WHERE len(g) = 3 GROUP BY ALL
), best AS (
  SELECT scores.lang, row_number() OVER (PARTITION BY scores.lang ORDER BY score DESC, a DESC, array_to_string(scores.g, ' ')) AS rank, array_to_string(scores.g, ' ') AS phrase, a, l, r, score
  FROM scores LEFT JOIN inside ON inside.lang = scores.lang AND inside.g = scores.g WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM best JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL: dict[str, str] = {
    "op2_jaccard_join": JACCARD_SQL,
    "op9_polytope_near_dedup": POLYTOPE_SQL,
    "op11_substring_dedup": REPEATS_SQL,
    "op12_hard_negatives": NEGATIVES_SQL,
    "op13_phrase_collocations": COLLOCATIONS_SQL,
}
