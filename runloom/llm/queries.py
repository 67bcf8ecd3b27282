"""The operators applied to their whole tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, codes, fim, fingerprint, mixing, packing, pii, quality, repeats, simhash, token_count, toxicity, urls
from .common import table


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edits(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.digests(chat.format_chat(rows.unionByName(more)))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_spans(table(spark, sf_dir, "documents")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.cluster(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexed(F.col("f")).alias("fingerprint"), "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix, op2_fingerprints, op3_chat, op4_token_counts, op5_url_filter, op6_pii, op7_simhash, op8_toxicity, op9_quality, op10_pack,
        op11_fim, op12_repeats, op13_codes,
    )
}

OP3_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(6 + 5 + CASE WHEN role = 'assistant' THEN 7 ELSE 6 END
    + 2 * length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), '[', ''))
    + 2 * length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '[', ''))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

OP5_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), copies AS (
  SELECT host, html IS NOT NULL AS known, md5(string_split(string_split(html, '<article>')[-1], '</article>')[1]) AS article FROM pages JOIN parts ON pages.page_id = parts.page_id WHERE host <> ''
), wide AS (SELECT article FROM copies WHERE known GROUP BY article HAVING count(DISTINCT host) >= 3
), copying AS (
  SELECT host FROM copies LEFT JOIN wide ON copies.article = wide.article GROUP BY host HAVING count(*) >= 3 AND 2 * count(wide.article) >= count(*)
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN path LIKE '/%' AND regexp_matches(host, '(^|[.])(spam-farm|cheap-pills|casino-win|ads-track|free-bets)([.]|$)') THEN 'block'
  WHEN path LIKE '/%' AND EXISTS (SELECT 1 FROM copying WHERE copying.host = ruled.host OR ends_with(ruled.host, '.' || copying.host)) THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled
"""


def _op9_sql() -> str:
    known = ", ".join(f"'{x}'" for w in quality.STOP_WORDS.split() for x in dict.fromkeys((w, w.capitalize())))
    words = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    lines = r"list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {words} AS w, {lines} AS l FROM documents),
wins AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t) x),
reps AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM wins) y WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM reps, (SELECT unnest(range(0, 3)) AS k) z GROUP BY doc_id),
c AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: x IN ({known}))) AS n_stop, length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) AS n_upper, len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•‣]'))) AS n_bullets, len(list_filter(l, lambda x: regexp_matches(x, '([.][.][.]|…)\s*$'))) AS n_ellipses
  FROM t LEFT JOIN covered ON t.doc_id = covered.doc_id
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 14.0 * n_words AND n_symbols <= 0.1 * n_words AND 20 * n_stop >= n_words
  AND n_upper <= 0.4 * word_chars AND n_dup_lines <= 0.5 * n_lines AND n_bullets <= 0.9 * n_lines AND n_ellipses <= 0.3 * n_lines AS kept
FROM b
"""


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t
), c AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM u
), p AS (
  SELECT doc_id, text, form, n, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

OP12_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (SELECT row, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT row, w, unnest(range(1, len(w) - 33)) AS i FROM t) x
), again AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY h) AS n FROM starts) y WHERE n > 1
), gone AS (SELECT DISTINCT row, i + k AS i FROM again, (SELECT unnest(range(0, 35)) AS k) z
), lists AS (SELECT row, list(i) AS gone FROM gone GROUP BY row
), words AS (SELECT row, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM t
), kept AS (
  SELECT words.row, string_agg(x, ' ' ORDER BY words.i) AS kept FROM words LEFT JOIN gone ON words.row = gone.row AND words.i = gone.i WHERE gone.i IS NULL GROUP BY words.row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN lists ON t.row = lists.row LEFT JOIN kept ON t.row = kept.row
"""


def _op13_sql(size: int = 64) -> str:
    """For vectors of `size` components, as those of the tables."""
    d = size // 16
    comps = [f"c{i}" for i in range(d)]
    cells = ", ".join(f"v[{d} * p + {i + 1}] AS c{i}" for i in range(d))
    apart = " + ".join(f"(x.{c} - e.{c}) * (x.{c} - e.{c})" for c in comps)
    text = f"""
WITH vecs AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (SELECT vec_id, p, {cells} FROM vecs, (SELECT unnest(range(0, 16)) AS p) z
), book0 AS (
  SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS BIGINT) AS e, {", ".join(comps)} FROM parts WHERE vec_id IN (SELECT vec_id FROM vecs ORDER BY vec_id LIMIT 64)
)"""
    for k in range(3):
        text += f""", near{k} AS (
  SELECT x.vec_id, x.p, min(({apart}) * 64 + e.e) AS m FROM parts x JOIN book{k} e ON x.p = e.p GROUP BY x.vec_id, x.p
)"""
        if k < 2:
            means = ", ".join(f"CAST(floor(CAST(sum(x.{c}) AS DOUBLE) / count(*)) AS BIGINT) AS {c}" for c in comps)
            text += f""", mean{k} AS (
  SELECT x.p, near{k}.m % 64 AS e, {means} FROM parts x JOIN near{k} ON x.vec_id = near{k}.vec_id AND x.p = near{k}.p GROUP BY x.p, near{k}.m % 64
), book{k + 1} AS (
  SELECT b.p, b.e, {", ".join(f"coalesce(m.{c}, b.{c}) AS {c}" for c in comps)} FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e
)"""
    listed = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in comps)
    return f"""{text}, coded AS (
  SELECT vec_id, string_agg(format('{{:02x}}', m % 64), '' ORDER BY p) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM near2 GROUP BY vec_id
), digest AS (SELECT sha256(string_agg({listed}, ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vecs.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM vecs JOIN coded ON vecs.vec_id = coded.vec_id, digest
"""


ORACLES = {"op3_chat": OP3_SQL, "op5_url_filter": OP5_SQL, "op9_quality": _op9_sql(), "op11_fim": OP11_SQL, "op12_repeats": OP12_SQL, "op13_codes": _op13_sql()}
