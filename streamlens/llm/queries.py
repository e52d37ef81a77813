"""The registered queries of the training-data operators, over whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.llm import bpe, decontaminate, divergence, html_text, lm, manifest, mixing, ngram_join, pii, quality, rules, shard, substrings
from streamlens.llm.labelled import remainder
from streamlens.session import prepare

PII_KEY = "replace-me"  # a secret of the user; fixed here so that the query gives the same rows each time

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    scored = quality.score(docs, model, with_text=False)
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(table(spark, folder, "documents"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages, html_text.fit(pages))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    learned = rules.fit(docs, table(spark, folder, "labels"))
    return rules.apply(docs, learned).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), ids=False)


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.replace(table(spark, folder, "documents").select("doc_id", "text"), PII_KEY)


def op8_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 7) == 2
    scored = lm.score(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard.shard(table(spark, folder, "documents"), 24)


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents")).drop("kept")


def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.Mix(table(spark, folder, "documents")).taken()
    return mixed.withColumnRenamed("key", "doc_id").drop("source")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The untrusted copy has the letters A to Z of every third text in lower case."""
    docs = table(spark, folder, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.col("doc_id").isNotNull() & (remainder("doc_id", 3) == 0)
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.when(hit, lower).otherwise(F.col("text"))
    return manifest.manifest(docs, "doc_id", "lang", [*head, F.col("text")], [*head, changed]).drop("lang")


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.Audit(table(spark, folder, "documents")).report()


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_ngram_join, op3_decontamination, op4_html_text, op5_quality_rules, op6_bpe, op7_pii,
        op8_lm_score, op9_sharding, op10_substring_dedup, op11_mixing, op12_merkle_manifest,
        op13_divergence,
    )
}

SQL: dict[str, str] = {
    "op2_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS grams FROM g GROUP BY doc_id),
overlap AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM overlap JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 5 * shared >= 4 * (p.grams + q.grams - shared)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other),
class AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id),
links AS (SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a)
SELECT d.doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(grams, 0) AS n_ngrams
FROM documents d JOIN class USING (doc_id) LEFT JOIN links USING (doc_id) LEFT JOIN n USING (doc_id)
""",
    "op10_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS holder FROM x) WHERE holder < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM hit),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS text
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE hit AS (
  SELECT DISTINCT doc_id, xor(list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384::BIGINT * (xor(c, x) & 1))), 4294967295::BIGINT) % 3 = 0 AS hit
  FROM documents WHERE doc_id IS NOT NULL),
d AS (
  SELECT doc_id, lang, CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS body,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || CASE WHEN hit
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END END AS copy,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head
  FROM documents LEFT JOIN hit USING (doc_id)),
leaf AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS g, sha256(head || body) AS leaf, sha256(head || copy) AS bad,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(head || body)) - 1 AS pos
  FROM d),
node(g, lvl, i, h, n) AS (
  SELECT g, 0, pos, leaf, count(*) OVER (PARTITION BY g) FROM leaf
  UNION ALL
  SELECT g, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8)
  FROM node WHERE n > 1 GROUP BY g, lvl, i // 8),
sub AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS ord, count(*) OVER () AS gs FROM node WHERE n = 1),
above(lvl, i, h, n) AS (
  SELECT 0, ord, subroot, gs FROM sub
  UNION ALL
  SELECT lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8)
  FROM above WHERE n > 1 GROUP BY lvl, i // 8),
side AS (
  SELECT g, lvl, i,
    coalesce(string_agg(h, '') OVER (PARTITION BY g, lvl, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY g, lvl, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT g, lvl, i, h FROM node WHERE n > 1 UNION ALL SELECT '', lvl, i, h FROM above WHERE n > 1)),
climb(doc_id, g, pos, lvl, x, proof, up) AS (
  SELECT doc_id, g, pos, 0, bad, '', 0 FROM leaf
  UNION ALL
  SELECT * FROM (
    SELECT c.doc_id, c.g, c.pos, c.lvl + 1, sha256(l || x || r), proof || l || r, up
    FROM climb c JOIN side s ON s.g = c.g AND s.lvl = c.lvl AND s.i = c.pos // (8 ** c.lvl)::BIGINT WHERE up = 0
    UNION ALL
    SELECT c.doc_id, c.g, c.pos, 0, x, proof, 1
    FROM climb c JOIN node t ON t.g = c.g AND t.lvl = c.lvl AND t.n = 1 WHERE up = 0
    UNION ALL
    SELECT c.doc_id, c.g, c.pos, c.lvl + 1, sha256(l || x || r), proof || l || r, up
    FROM climb c JOIN sub USING (g) JOIN side s ON s.g = '' AND s.lvl = c.lvl AND s.i = ord // (8 ** c.lvl)::BIGINT WHERE up = 1)),
done AS (
  SELECT g, pos, x, proof FROM climb
  WHERE up = 1 AND lvl = (SELECT max(lvl) FROM above))
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = root.h AS verified
FROM leaf JOIN done USING (g, pos) JOIN sub USING (g), (SELECT h FROM above WHERE n = 1) root
""",
    "op13_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS c FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 3),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY ALL) USING (lang, source)),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + 1000000000 * (coalesce(c.c, 0) + 1) // (g.n + l.v) AS p,
    1 + 1000000000 * (k.c + 1) // (l.n + l.v) AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
sums AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN sums s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
told AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM told) QUALIFY part = 'pair' OR rank <= 200
""",
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
