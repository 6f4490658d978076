"""The registered queries of this subpackage and the SQL each is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from millrace.llm import (
    alignment,
    bpe,
    frames,
    hamming,
    infill,
    language,
    licenses,
    neardup,
    neighbours,
    packing,
    recurrent,
    secrets,
    sharding,
    substrings,
)

from millrace.llm.license_rules import CONFIDENCE, all_rules


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(
        documents(spark, sf_dir), results=("n_words", "n_removed", "kept_sha256"), carry=("doc_id",)
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir), carry=("doc_id",))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(documents(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.by_equal_texts(documents(spark, sf_dir))


def op5_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent.scores(documents(spark, sf_dir))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(documents(spark, sf_dir))


def op7_quantised_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.near_vectors(embeddings(spark, sf_dir))


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(embeddings(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(documents(spark, sf_dir), carry=("doc_id",))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return licenses.scan(documents(spark, sf_dir), results=results, carry=("doc_id",))


def _license_sql() -> str:
    """The rules as a table; each document beside those it has the words for, matches pair by pair."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def row(rule: dict) -> str:
        needs = ", ".join("[" + ", ".join(map(quoted, need)) + "]" for need in rule["needs"])
        facts = (str(rule["rule"]), quoted(rule["label"]), str(rule["level"]), f"[{needs}]")
        return f"({', '.join(facts)}, {quoted(licenses.pattern(rule['regex']))}, {CONFIDENCE[rule['level']]})"

    rules = ",\n".join(map(row, all_rules()))
    return rf"""WITH rules(rule, label, level, needs, pattern, sure) AS (VALUES
{rules}),
t AS (
  SELECT row_number() OVER () AS r, doc_id, trim(regexp_replace(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g')) AS s
  FROM documents),
w AS (SELECT r, doc_id, s, CASE WHEN s = '' THEN [] ELSE string_split(s, '  ') END AS words FROM t),
m AS (
  SELECT r, rule, label, level, sure, string_split(trim(
    regexp_replace(' ' || s || ' ', pattern, ' ' || chr(1) || '\1' || chr(2) || ' ', 'g')), '  ') AS marked
  FROM w JOIN rules ON len(list_filter(needs, lambda n: NOT list_has_any(n, words))) = 0
    AND regexp_matches(' ' || s || ' ', pattern)),
p AS (
  SELECT r, rule, label, level, sure,
    list_filter(range(len(marked)), lambda i: contains(marked[i + 1], chr(1))) AS first,
    list_filter(range(len(marked)), lambda i: contains(marked[i + 1], chr(2))) AS last FROM m),
d AS (SELECT r, rule, label, level, sure, unnest(first) AS first, unnest(last) AS last FROM p),
base AS (
  SELECT r, count(*) AS n, min(first) AS low, max(first) AS high, list_sort(list(DISTINCT label)) AS labels
  FROM d WHERE level = 0 GROUP BY r),
kept AS (
  SELECT r, label, sure FROM d WHERE label <> '' AND (level = 0 OR NOT EXISTS (
    SELECT 1 FROM d o WHERE o.r = d.r AND o.first <= d.first AND o.last >= d.last AND (o.level < d.level
      OR (o.level = d.level AND (o.last - o.first > d.last - d.first
        OR (o.last - o.first = d.last - d.first AND o.rule < d.rule))))))),
shown AS (SELECT r, list_sort(list(DISTINCT label)) AS labels, max(sure) AS score FROM kept GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
  CAST(low AS BIGINT) AS first_word, CAST(high AS BIGINT) AS last_word,
  coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  coalesce(array_to_string(shown.labels, ','), '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN shown USING (r)"""


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return alignment.aligned(documents(spark, sf_dir), results, carry=("doc_id",))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = frames.framed(documents(spark, sf_dir), carry=("doc_id",))
    return infill.infilled(
        framed,
        results=("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"),
    )


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_bpe": op3_bpe,
    "op4_sharding": op4_sharding,
    "op5_recurrent_scores": op5_recurrent_scores,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_quantised_dedup": op7_quantised_dedup,
    "op8_packing": op8_packing,
    "op9_language": op9_language,
    "op10_nn_descent": op10_nn_descent,
    "op11_license_scan": op11_license_scan,
    "op12_token_alignment": op12_token_alignment,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": corpus_pipeline.run,
}
#: The other results rest on token ids, learnt models or moves drawn by hash, which SQL cannot give.
SQL = {
    "op1_substring_dedup": r"""WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
f AS (SELECT run, min(doc_id) AS first FROM g GROUP BY run),
gone AS (
  SELECT doc_id, list(DISTINCT i + k) AS places
  FROM g JOIN f USING (run), range(13) AS r(k) WHERE first < doc_id GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(coalesce(places, []), i)), ' '))
    AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)""",
    "op7_quantised_dedup": """WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings
  WHERE label IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
    AND list_bool_or([x <> 0 FOR x IN embedding])),
links AS (
  SELECT one.vec_id AS a, other.vec_id AS b
  FROM good one JOIN good other ON one.label = other.label AND one.vec_id <> other.vec_id
    AND list_cosine_similarity(one.e, other.e) >= 0.98),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT vec_id, b FROM reached JOIN links ON other = a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(other) AS component_id,
  min(other) = vec_id AS kept
FROM reached LEFT JOIN counted USING (vec_id) GROUP BY vec_id""",
    "op11_license_scan": _license_sql(),
    "op13_fill_in_middle": r"""WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS told,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
h AS (
  SELECT doc_id, text, units, len(units) AS n,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || told[i:i + 7] AS BIGINT)) AS h FROM u),
f AS (
  SELECT doc_id, text, units, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS low,
    greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= 50 THEN 'plain'
      WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(units[1:low], ''), '') AS prefix,
    coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
    coalesce(array_to_string(units[high + 1:n], ''), '') AS suffix FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p""",
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
