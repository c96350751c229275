"""The registered queries of this subpackage and their SQL twins.

Queries without a twin need XXH64 fingerprints, a tokenizer, a page parser, trained models
or approximate search; tests hold them against brute force or held-out rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.llm import (
    conversation_trie,
    decontamination,
    embeddings,
    fill_middle,
    html_text,
    language_id,
    licenses,
    mixing,
    quality,
    simhash,
    token_counts,
    toxicity,
    url_filter,
)
from sievelake.llm.common import LOWER, UPPER

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), simhash.exact_search(4, 4))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    file = path or public_tokenizers.path(TOKENIZER)
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), file, public_tokenizers.PATTERN)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.rearranged(_table(spark, sf_dir, "documents")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(_table(spark, sf_dir, "conversations"), family=5, shared=9)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_simhash": op2_simhash,
    "op3_license_scan": op3_license_scan,
    "op4_token_counts": op4_token_counts,
    "op5_html_text": op5_html_text,
    "op6_toxicity": op6_toxicity,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_source_mix": op8_source_mix,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_language_id": op11_language_id,
    "op12_fill_middle": op12_fill_middle,
    "op13_conversation_trie": op13_conversation_trie,
}


def _lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_RULE_CASES = ", ".join(
    f"CASE WHEN contains(padded, ',{','.join(ids)},') THEN '{name}' END" for name, ids in licenses.RULES
)
_SENTENCE_MAP = (
    "MAP {" + ", ".join(f"'{text}': '{name}'" for name, text in licenses.SENTENCES.items()) + "}"
)

ORACLE: dict[str, str] = {
    "op1_url_filter": rf"""
        WITH cut AS (
          SELECT page_id,
                 {_lowered(r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
                 coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
          FROM pages),
        urls AS (SELECT DISTINCT host, path FROM cut),
        rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
        best AS (
          SELECT host, path, rule_host || rule_path AS rule, verdict FROM urls, rules
          WHERE (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
          QUALIFY row_number() OVER (PARTITION BY host, path
            ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM cut LEFT JOIN best USING (host, path)
    """,
    "op3_license_scan": rf"""
        WITH cut AS (
          SELECT doc_id, list_filter(list_transform(list_filter(list_transform(
              regexp_split_to_array({_lowered("coalesce(text, '')")}, '{licenses.BREAK}'),
              lambda s: trim(regexp_replace(s, '{licenses.NOT_WORD}', ' ', 'g'))), lambda s: s <> ''),
              lambda s: {_SENTENCE_MAP}[s]), lambda s: s IS NOT NULL) AS ids
          FROM documents),
        padded AS (SELECT *, ',' || array_to_string(ids, ',') || ',' AS padded FROM cut)
        SELECT doc_id, len(ids) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
               array_to_string(list_sort(list_distinct([{_RULE_CASES}])), ',') AS licenses
        FROM padded
    """,
    "op8_source_mix": rf"""
        WITH sized AS (
          SELECT doc_id, source, coalesce('=' || source, 'null') AS source_name,
                 substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16) AS place,
                 len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}'))::BIGINT AS size
          FROM documents),
        totals AS (
          SELECT source, source_name, sum(size)::BIGINT AS source_size,
                 ([5.0, 2.0, 1.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
          FROM sized GROUP BY source, source_name),
        levels AS (
          SELECT *, 2 * source_size AS cap, 2 * source_size / weight AS ratio,
                 ((sum(source_size) OVER ()) * 1.5::DOUBLE
                   - coalesce(sum(2 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM totals WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST)),
        goals AS (
          SELECT source_name, source_size,
                 coalesce(least(cap::DOUBLE, weight * max(CASE WHEN ratio > level THEN level END) OVER ()), cap::DOUBLE) AS target
          FROM levels),
        queued AS (
          SELECT row_number() OVER () AS row_id, s.*, source_size, target,
                 sum(size) OVER (PARTITION BY source_name ORDER BY place, doc_id, size
                   ROWS UNBOUNDED PRECEDING) AS upto
          FROM sized s JOIN goals USING (source_name)),
        copies AS (
          SELECT *, (upto + copy * source_size) / nullif(target, 0) AS finish
          FROM queued, (VALUES (0), (1)) c(copy) WHERE size > 0),
        cut AS (
          SELECT row_id, size, sum(size) OVER (ORDER BY finish, source_name, place, coalesce(doc_id, 0), size
                   ROWS UNBOUNDED PRECEDING) AS words,
                 (SELECT sum(size) FROM sized) * 1.5::DOUBLE AS budget
          FROM copies),
        taken AS (SELECT row_id, sum(size) AS taken FROM cut WHERE words <= budget GROUP BY row_id)
        SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
        FROM queued LEFT JOIN taken USING (row_id)
    """,
    "op9_decontamination": rf"""
        WITH docs AS (
          SELECT row_number() OVER () AS row_id, doc_id, list_filter(regexp_split_to_array(
            {_lowered("coalesce(text, '')")}, '{decontamination.NOT_WORD}'), lambda x: x <> '') AS w
          FROM documents),
        items AS (
          SELECT item_id, list_filter(regexp_split_to_array(
            {_lowered("coalesce(text, '')")}, '{decontamination.NOT_WORD}'), lambda x: x <> '') AS w
          FROM benchmark),
        grams AS (
          SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS gram
          FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
        seen AS (
          SELECT row_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
          FROM (SELECT row_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                FROM docs, (SELECT DISTINCT n FROM grams) s WHERE len(w) >= n)),
        hits AS (SELECT row_id, i, n, item_id FROM seen JOIN grams USING (gram, n)),
        covered AS (
          SELECT row_id, count(DISTINCT p) AS n_hit
          FROM (SELECT row_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY row_id),
        named AS (
          SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT row_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN covered USING (row_id) LEFT JOIN named USING (row_id)
    """,
    "op12_fill_middle": r"""
        WITH cut AS (
          SELECT doc_id, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
                 sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest
          FROM documents),
        drawn AS (
          SELECT *, len(w) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || digest[i:i + 7])::BIGINT) AS h FROM cut),
        ranked AS (
          SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                        OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
          FROM drawn),
        parts AS (
          SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle,
                 array_to_string(w[b + 1:], '') AS suffix
          FROM ranked)
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                 WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                 ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    # CRC-32 is spelled out: its table, then the decimal digits byte by byte.
    "op13_conversation_trie": """
        WITH turns AS (
          SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
                 md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key
          FROM conversations WHERE conv_id IS NOT NULL),
        whole AS (
          SELECT conv_id, list(key ORDER BY turn NULLS FIRST, key) AS keys, list(bytes ORDER BY turn NULLS FIRST, key) AS sizes
          FROM turns GROUP BY conv_id),
        crc_steps AS (
          SELECT list(list_reduce(range(8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i)
                   ORDER BY i) AS steps FROM range(256) r(i)),
        drawn AS (
          SELECT w.*, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                   lambda v, c: xor(steps[(xor(v, c) & 255) + 1], v >> 8), 4294967295), 4294967295) % 9 AS h
          FROM whole w, crc_steps),
        made AS (
          SELECT d.conv_id, coalesce(b.keys[1:h], []) || d.keys[h + 1:] AS keys,
                 coalesce(b.sizes[1:h], []) || d.sizes[h + 1:] AS sizes
          FROM drawn d LEFT JOIN whole b ON b.conv_id = d.conv_id - d.conv_id % 5),
        members AS (
          SELECT conv_id, keys[1:d] AS path, coalesce(sizes[d], 0) AS bytes, d AS depth, d = len(keys) AS ends
          FROM (SELECT *, unnest(range(0, len(keys) + 1)) AS d FROM made)),
        nodes AS (
          SELECT path, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(bytes) AS bytes,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
          FROM members GROUP BY path),
        kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        known AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (path)),
        subtrees AS (
          SELECT path[1:k] AS path, count(*) FILTER (n_children = 0) AS n_leaves,
                 sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
          FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM known) GROUP BY 1)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
        FROM known n JOIN subtrees USING (path)
        LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
    """,
}
