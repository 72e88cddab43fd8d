"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path() -> str:
    """The vocabulary file of the packing query: TOKENIZER_FILE, or the installed one."""
    import public_tokenizers

    return os.environ.get("TOKENIZER_FILE") or public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""


@query("op2_jaccard_join", rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n m ON m.doc_id = x.doc_id JOIN n k ON k.doc_id = y.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(m.n) + any_value(k.n) - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.least AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) r ON r.a = d.doc_id
""")
def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, folder, "documents"))


@query("op5_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.packing import pack

    return pack(table(spark, folder, "documents"), tokenizer_path())


@query("op7_spaced_seeds")
def spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.spaced_seeds import overlaps

    return overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op10_toxicity")
def toxic(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.toxicity import toxicity

    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_language_filters")
def language_filters(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.language_id import identify

    return identify(table(spark, folder, "documents"))


@query("op1_importance_resampling")
def importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.resampling import resample

    return resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op9_suffix_blocks")
def suffix_blocks(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.suffix_blocks import remove_repeats

    return remove_repeats(table(spark, folder, "documents"))


@query("op6_collinear_chaining")
def collinear_chaining(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.chaining import passages

    return passages(table(spark, folder, "documents"))


@query("op3_log_frequency_filter")
def log_frequency_filter(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.language_model import score

    return score(table(spark, folder, "documents"))


@query("op4_nn_descent")
def nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.neighbours import near_duplicates

    return near_duplicates(table(spark, folder, "embeddings"))


@query("op12_sibling_joins", r"""
WITH RECURSIVE bits AS (
  SELECT k, k AS c, 0 AS i FROM range(256) t(k)
  UNION ALL SELECT k, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8),
crc AS (SELECT list(c ORDER BY k) AS t FROM bits WHERE i = 8),
d AS (
  SELECT doc_id, source, concat(
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head,
    text, replace(text, chr(10), '') AS cut,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 2 = 0 AS tampered
  FROM documents, crc),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || CASE WHEN tampered THEN coalesce(strlen(cut) || ':' || cut, '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS given
  FROM d),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS m,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM leaves),
tree AS (
  SELECT s, 0 AS lvl, idx, m, leaf AS h FROM numbered
  UNION ALL
  SELECT s, lvl + 1, idx // 3, (any_value(m) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE m > 1 GROUP BY s, lvl, idx // 3),
subroots AS (SELECT s, lvl AS top, h FROM tree WHERE m = 1),
upper AS (
  SELECT 0 AS lvl, s AS idx, (SELECT count(*) FROM subroots) AS m, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, (any_value(m) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM upper WHERE m > 1 GROUP BY lvl, idx // 3),
nodes AS (
  SELECT s, lvl, idx, m, h FROM tree WHERE m > 1
  UNION ALL SELECT NULL, lvl, idx, m, h FROM upper WHERE m > 1),
steps AS (
  SELECT a.s, a.lvl, a.idx, string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx) AS l, string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx) AS r
  FROM nodes a JOIN nodes b ON a.s IS NOT DISTINCT FROM b.s AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3 GROUP BY ALL),
depth AS (SELECT max(lvl) AS d, any_value(h) FILTER (m = 1) AS root FROM upper),
fold AS (
  SELECT n.doc_id, n.leaf, n.s, n.idx, 0 AS lvl, top, n.given AS h, '' AS proof FROM numbered n JOIN subroots USING (s)
  UNION ALL
  SELECT f.doc_id, f.leaf, f.s, f.idx, f.lvl + 1, top, sha256(concat(p.l, f.h, p.r)), concat(f.proof, p.l, p.r)
  FROM fold f JOIN steps p
    ON p.s IS NOT DISTINCT FROM CASE WHEN f.lvl < top THEN f.s END AND p.lvl = CASE WHEN f.lvl < top THEN f.lvl ELSE f.lvl - top END
    AND p.idx = CASE WHEN f.lvl < top THEN f.idx // (3 ** f.lvl)::BIGINT ELSE f.s // (3 ** (f.lvl - top))::BIGINT END)
SELECT f.doc_id, f.leaf, b.h AS subroot, root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM fold f JOIN subroots b ON b.s = f.s, depth WHERE f.lvl = b.top + d
""")
def sibling_joins(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.merkle import manifest

    return manifest(table(spark, folder, "documents"))


@query("op11_jacobi_davidson")
def jacobi_davidson(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.whitening import whiten

    return whiten(table(spark, folder, "embeddings"))


@query("op13_suffix_repetition")
def suffix_repetition(spark: SparkSession, folder: str) -> DataFrame:
    from tecframe.llm.repetition import quality

    return quality(table(spark, folder, "documents"))
