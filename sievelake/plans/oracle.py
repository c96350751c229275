"""The registered queries once more, as plain SQL over the same tables.

Rules are spelled out step by step here, whereas the Spark side uses single expressions,
so that the two check each other.
"""

from __future__ import annotations

WS = (
    r"[ \t\n\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
RULE = (
    r"^[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
    r"(?:\.[a-z0-9-]{0,62}[a-z0-9])*\.[a-z]{2,}$"
)
REJECTED = "('localhost', 'local', 'localdomain', 'test', 'example', 'invalid', 'onion', 'i2p')"
AS_OF = "2024-02-01 00:00:00.000000"
TIME = "'%Y-%m-%d %H:%M:%S.%f'"
HOST = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def valid(x: str) -> str:
    """Validity of an already stripped lower-case name."""
    return (
        f"(length({x}) BETWEEN 4 AND 253 AND split_part({x}, '.', -1) NOT IN {REJECTED} "
        f"AND regexp_matches({x}, '{RULE}'))"
    )


def cleaned(relation: str, column: str = "domain") -> str:
    """The relation with ``cleaned`` added, one rule after the other."""
    return f"""
    SELECT * EXCLUDE (c1, c2, c3, c4, c5, c6), CASE WHEN {valid('c6')} THEN c6 END AS cleaned
    FROM (SELECT *, {strip("rtrim(c5, '.')")} AS c6
    FROM (SELECT *, CASE WHEN length(c4) - length(replace(c4, ':', '')) = 1
                         THEN split_part(c4, ':', 1) ELSE c4 END AS c5
    FROM (SELECT *, regexp_replace(c3, '(?s)[/?#].*$', '') AS c4
    FROM (SELECT *, regexp_replace(c2, '^(www\\.)+', '') AS c3
    FROM (SELECT *, regexp_replace(c1, '^(https://)?(http://)?(ftp://)?(//)?', '') AS c2
    FROM (SELECT *, lower({strip(column)}) AS c1 FROM {relation}))))))"""


def judged(relation: str) -> str:
    """The relation with ``valid`` added: the domain as it is, not cleaned."""
    return f"""
    SELECT * EXCLUDE (s), {valid('s')} AS valid
    FROM (SELECT *, lower({strip('domain')}) AS s FROM {relation})"""


EVENTS = """
    SELECT 'd' || user_id || '.example.org' AS domain,
           CASE WHEN event_type = 'error' THEN 'malware' ELSE 'ads_trackers' END AS category,
           event_type AS source, 'hosts' AS source_format,
           '0.0.0.0 d' || user_id || '.example.org' AS raw_entry, ts,
           json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS page, event_id AS off
    FROM events"""

PAGES = """
    SELECT url AS domain,
           CASE WHEN page_id % 3 = 0 THEN 'malware' ELSE 'ads_trackers' END AS category,
           split_part(url, ':', 1) AS source, 'adblock' AS source_format,
           '||' || url || '^' AS raw_entry,
           TIMESTAMP '2024-01-01' + to_minutes(page_id % 43200) AS ts,
           NULL::VARCHAR AS k, page_id::VARCHAR AS page, page_id AS off
    FROM pages"""

SIGHTINGS = f"SELECT * FROM ({EVENTS}) UNION ALL SELECT * FROM ({PAGES})"

SPELLINGS = {
    "url": "url",
    "upper": "upper(url)",
    "padded": "' ' || chr(9) || url || ' ' || chr(10)",
    "port": "host || ':8080'",
    "two_ports": "host || ':1:2'",
    "schemes": "'https://http://' || host",
    "schemes_turned": "'http://https://' || host",
    "no_scheme": "'//' || host || '?q=1'",
    "www": "'www.www.' || host",
    "dots": "host || '..'",
    "space_dot": "host || ' ./p'",
    "dot_space": "host || '. /p'",
    "hyphen": "'-' || host",
    "underscore": "'_' || host",
    "inner_hyphen": "'a.-' || host",
    "wildcard": "'*.' || host",
    "reserved": "host || '.test'",
    "local": "host || '.localdomain'",
    "long_label": "repeat('a', 64) || '.' || host",
    "long_name": "repeat('ab.', 90) || host",
    "query": "host || '?a=b#c'",
    "host": "host",
    "address": "'192.168.1.1'",
    "empty": "''",
}
DIRTY = " UNION ALL ".join(
    f"SELECT * EXCLUDE (url, host), '{kind}' AS kind, {name} AS domain "
    f"FROM (SELECT * EXCLUDE (domain), domain AS url, "
    f"regexp_extract(domain, '^[a-z]+://([^/?#]+)', 1) AS host FROM ({PAGES}))"
    for kind, name in SPELLINGS.items()
)

DOCUMENTS = f"""
    SELECT ['hosts-a', 'hosts-b', 'rules-a', 'rules-b'][page_id % 4 + 1] AS source,
           page_id,
           CASE WHEN page_id % 4 < 2 THEN array_to_string(
                  ['# list ' || page_id, '', '127.0.0.1 localhost']
                  || list_transform(words, lambda w: '0.0.0.0 ' || w || '.' || host)
                  || ['0.0.0.0 ' || host || ' # note'], chr(10))
                ELSE array_to_string(
                  ['[Adblock Plus 2.0]', '! list ' || page_id, '']
                  || list_transform(words, lambda w: '||' || w || '.' || host || '^')
                  || ['||' || host || '^$third-party', '##.banner', '||' || host || '/ads^'],
                  chr(10))
           END AS content
    FROM (SELECT page_id, {HOST} AS host,
                 regexp_extract_all(html, '[A-Za-z0-9.-]+') AS words FROM pages)"""

FAULTY = f"""
    SELECT source, page_id, content FROM ({DOCUMENTS})
    UNION ALL SELECT 'hosts-b', page_id, '' FROM pages WHERE page_id % 25 = 7
    UNION ALL SELECT 'other', page_id, '||' || url || '^' FROM pages WHERE page_id % 5 = 4
    UNION ALL SELECT 'stray', page_id, '||' || url || '^' FROM pages WHERE page_id % 10 = 3"""

REGISTRY = """
    (VALUES ('hosts-a', 'hosts', 'malware'), ('hosts-b', 'hosts', 'ads_trackers'),
            ('rules-a', 'adblock', 'malware'), ('rules-b', 'adblock', 'ads_trackers'),
            ('other', 'csv', 'ads_trackers')) AS r(source, format, category)"""


def numbered(relation: str, key: str, text: str) -> str:
    """Lines with numbers; a line feed at the very end opens no further line."""
    return f"""
    SELECT * EXCLUDE (parts), unnest(parts) AS line,
           unnest(range(1, len(parts) + 1)) AS line_number
    FROM (SELECT {key}, string_split(regexp_replace({text}, '\\n$', ''), chr(10)) AS parts
          FROM {relation} WHERE {text} <> '')"""


ENTRIES = f"""
    SELECT lower(name) AS domain, category, source, format AS source_format,
           stripped AS raw_entry, page_id, line_number
    FROM (
      SELECT *, CASE format
        WHEN 'hosts' THEN regexp_extract(stripped,
             '^(?:0\\.0\\.0\\.0|127\\.0\\.0\\.1)\\s+([a-zA-Z0-9.-]+)$', 1)
        WHEN 'adblock' THEN regexp_extract(stripped,
             '^\\|\\|([a-zA-Z0-9.-]+)\\^(?:\\$.*)?$', 1)
        ELSE '' END AS name
      FROM (SELECT *, {strip('line')} AS stripped
            FROM ({numbered(f'({DOCUMENTS})', 'source, page_id', 'content')})
            JOIN {REGISTRY} USING (source))
      WHERE stripped <> '' AND NOT starts_with(stripped, '#')
        AND NOT (format = 'adblock' AND (starts_with(stripped, '!') OR starts_with(stripped, '['))))
    WHERE {valid('lower(name)')}"""


def parsed(source_format: str) -> str:
    return f"""
    SELECT domain, category, source, source_format, raw_entry,
           '2024-01-31 12:00:00.000000' AS ingestion_timestamp, page_id, line_number,
           CASE WHEN page_id % 2 = 1 THEN 'fetched' ELSE line_number::VARCHAR END
             AS metadata_line,
           '200' AS http_status
    FROM ({ENTRIES}) WHERE source_format = '{source_format}'"""


DEDUPED = f"""
    SELECT source, cleaned AS domain, raw_entry, page_id, line_number, category
    FROM ({cleaned(f'({ENTRIES})')}) WHERE cleaned IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY source, cleaned ORDER BY page_id, line_number) = 1"""

FAILURES = f"""
    SELECT source, page_id,
           CASE WHEN format IS NULL THEN 'Unknown source'
                WHEN format NOT IN ('hosts', 'adblock') THEN 'Unknown format type: ' || format
                ELSE 'Empty content received from source' END AS reason
    FROM ({FAULTY}) LEFT JOIN {REGISTRY} USING (source)
    WHERE format IS NULL OR format NOT IN ('hosts', 'adblock') OR content = ''
    UNION ALL
    SELECT source, NULL, 'No document fetched' FROM {REGISTRY}
    WHERE source NOT IN (SELECT source FROM ({FAULTY}))"""


def statistics(mode: str, ok: str, total: str, invalid: str, lost: str, relation: str) -> str:
    return f"""
    SELECT '{mode}' AS mode, {total}::BIGINT AS total,
           count(DISTINCT (source, d)) FILTER (WHERE {ok}) AS valid,
           {invalid}::BIGINT AS invalid,
           (count(*) FILTER (WHERE {ok})
             - count(DISTINCT (source, d)) FILTER (WHERE {ok}))::BIGINT AS duplicates,
           {lost}::BIGINT AS uncleanable
    FROM ({relation})"""


def gold(relation: str, as_of: str = AS_OF) -> str:
    """Per-domain table of a relation with ``cleaned``, valid rows only."""
    return f"""
    SELECT cleaned AS domain,
           CASE WHEN bool_or(category = 'malware') THEN 'malware' ELSE 'ads_trackers' END
             AS category,
           '[' || string_agg(DISTINCT '"' || source || '"', ',' ORDER BY '"' || source || '"')
             || ']' AS source_list,
           count(DISTINCT source) AS source_count,
           min(ts) AS first_seen, max(ts) AS last_seen,
           TIMESTAMP '{as_of}' AS last_updated,
           CASE WHEN max(ts) >= TIMESTAMP '{as_of}' - INTERVAL 7 DAY THEN 'true' ELSE 'false'
             END AS is_active,
           arg_min(coalesce(k, '~'), (ts, source, off, coalesce(k, page))) AS k,
           arg_min(coalesce(page, '~'), (ts, source, off, coalesce(k, page))) AS page
    FROM ({relation}) WHERE cleaned IS NOT NULL GROUP BY cleaned"""


def published(relation: str) -> str:
    return f"""
    SELECT domain, category, source_list, source_count,
           strftime(first_seen, {TIME}) AS first_seen, strftime(last_seen, {TIME}) AS last_seen,
           strftime(last_updated, {TIME}) AS last_updated, is_active,
           nullif(k, '~') AS k, nullif(page, '~') AS page
    FROM ({relation})"""


GOLD = published(gold(cleaned(f"({SIGHTINGS})")))

# The constants of Murmur3 for 32 bits, in the order they are used.
C1, C2, C3, C4, C5 = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35


def times(x: str, factor: int) -> str:
    """Product of 32-bit numbers, cut to 32 bits."""
    return f"((({x}) * {factor}::UBIGINT) & 4294967295::UBIGINT)"


def turned(x: str, bits: int) -> str:
    return f"(((({x}) << {bits}) & 4294967295::UBIGINT) | (({x}) >> {32 - bits}))"


def hashed(relation: str) -> str:
    """Signed 32-bit Murmur3 (seed 42) of ASCII names: words of four bytes, then single bytes."""
    byte = "ascii(substr(domain, {}, 1))::UBIGINT"
    word = " | ".join(f"({byte.format(f'(4 * i + {n + 1})::BIGINT')} << {8 * n})" for n in range(4))
    mixed = f"({times(turned('xor(h, k)', 13), 5)} + {C3}::UBIGINT) & 4294967295::UBIGINT"
    return f"""
    SELECT domain, CASE WHEN f >= 2147483648 THEN f::BIGINT - 4294967296 ELSE f::BIGINT END AS domain_hash
    FROM (SELECT domain, xor(e, e >> 16) AS f
    FROM (SELECT domain, {times('xor(d, d >> 13)', C5)} AS e
    FROM (SELECT domain, {times('xor(c, c >> 16)', C4)} AS d
    FROM (SELECT domain, xor(list_reduce([42::UBIGINT] || ks, lambda h, k: {mixed}), length(domain)::UBIGINT) AS c
    FROM (SELECT domain, list_transform(list_transform(list_transform(ws,
             lambda k: {times('k', C1)}), lambda k: {turned('k', 15)}), lambda k: {times('k', C2)}) AS ks
    FROM (SELECT domain, list_transform(range(length(domain) // 4), lambda i: {word})
                 || list_transform(range(length(domain) // 4 * 4, length(domain)),
                                   lambda i: {byte.format('i + 1')}) AS ws
          FROM ({relation})))))))"""


MERGED = f"""
    WITH sighted AS ({cleaned(f'({SIGHTINGS})')}),
    o AS ({gold("SELECT * FROM sighted WHERE ts < TIMESTAMP '2024-01-15'",
                '2024-01-15 00:00:00')}),
    n AS ({gold("SELECT * FROM sighted WHERE ts >= TIMESTAMP '2024-01-15'")}),
    lists AS (
      SELECT domain, '[' || string_agg(DISTINCT '"' || s || '"', ',' ORDER BY '"' || s || '"')
               || ']' AS source_list, count(DISTINCT s) AS source_count
      FROM (SELECT domain, unnest(source_list::JSON::VARCHAR[]) AS s
            FROM (SELECT domain, source_list FROM o UNION ALL SELECT domain, source_list FROM n))
      GROUP BY domain)
    SELECT domain,
           CASE WHEN n.domain IS NULL THEN o.category
                WHEN 'malware' IN (n.category, o.category) THEN 'malware'
                ELSE 'ads_trackers' END AS category,
           lists.source_list, lists.source_count,
           least(o.first_seen, n.first_seen) AS first_seen,
           greatest(o.last_seen, n.last_seen) AS last_seen,
           CASE WHEN n.domain IS NULL THEN o.last_updated ELSE TIMESTAMP '{AS_OF}' END
             AS last_updated,
           CASE WHEN n.domain IS NULL THEN o.is_active
                WHEN o.domain IS NULL THEN 'true'
                WHEN greatest(o.last_seen, n.last_seen) >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
                THEN 'true' ELSE 'false' END AS is_active,
           CASE WHEN n.domain IS NULL THEN o.k ELSE n.k END AS k,
           CASE WHEN n.domain IS NULL THEN o.page ELSE n.page END AS page
    FROM o FULL OUTER JOIN n USING (domain) JOIN lists USING (domain)"""

ORACLE = {
    "clean_domains": f"""
    SELECT off AS page_id, kind, cleaned AS domain FROM ({cleaned(f'({DIRTY})')})""",
    "valid_domains": f"""
    SELECT off AS page_id, kind, valid FROM ({judged(f'({DIRTY})')})""",
    "sql_functions": f"""
    SELECT kind, count(cleaned) AS cleaned, count(*) FILTER (WHERE valid) AS valid
    FROM ({cleaned(f'({judged(f"({DIRTY})")})')}) GROUP BY kind""",
    "clean_words": f"""
    SELECT cleaned AS domain, count(*) AS mentions
    FROM ({cleaned("(SELECT unnest(string_split_regex(text, '[^A-Za-z0-9.-]+')) AS domain FROM documents)")})
    WHERE cleaned IS NOT NULL GROUP BY cleaned""",
    "silver_flags": f"""
    SELECT cleaned AS domain, category, source, source_format, raw_entry,
           strftime(ts, {TIME}) AS ingestion_timestamp,
           '{AS_OF}' AS bronze_timestamp, '{AS_OF}' AS silver_timestamp, page,
           CASE WHEN cleaned IS NULL THEN 'false' ELSE 'true' END AS is_valid,
           CASE WHEN cleaned IS NULL THEN 'Invalid domain format' END AS validation_errors,
           strftime(ts, '%Y-%m-%d') AS ingestion_date, off AS bronze_offset
    FROM ({cleaned(f'({DIRTY})')})""",
    "bronze_parse": f"""
    SELECT CASE WHEN off % 50 > 0 THEN domain END AS domain,
           CASE WHEN off % 50 > 0 THEN category END AS category,
           CASE WHEN off % 50 > 0 THEN source END AS source,
           CASE WHEN off % 50 > 0 THEN source_format END AS source_format,
           CASE WHEN off % 50 > 0 THEN raw_entry END AS raw_entry,
           CASE WHEN off % 50 > 1 THEN strftime(ts, {TIME}) END AS ingestion_timestamp,
           CASE WHEN off % 50 > 0 THEN k END AS k,
           category || '_domains' AS kafka_topic,
           0::BIGINT AS kafka_partition, off AS kafka_offset,
           strftime(ts, {TIME}) AS kafka_timestamp, '{AS_OF}' AS bronze_timestamp,
           CASE WHEN off % 50 > 1 THEN strftime(ts, '%Y-%m-%d') END AS ingestion_date
    FROM (SELECT * REPLACE (CASE category WHEN 'malware' THEN 'malware' ELSE 'ads_trackers' END
          AS category) FROM ({EVENTS}))""",
    "list_lines": numbered("documents", "doc_id", "text"),
    "hosts_parse": parsed("hosts"),
    "adblock_parse": parsed("adblock"),
    "parse_failures": FAILURES,
    "dedupe_first": f"""
    SELECT source, domain, raw_entry, page_id, line_number FROM ({DEDUPED})""",
    "dedupe_lenient": f"""
    SELECT domain, source, off AS page_id, kind FROM ({judged(f'({DIRTY})')}) WHERE valid
    QUALIFY row_number() OVER (PARTITION BY source, domain ORDER BY off, kind) = 1""",
    "dedupe_strict": f"""
    SELECT source, category, count(*) AS domains, sum(line_number)::BIGINT AS line_numbers
    FROM ({DEDUPED}) GROUP BY source, category""",
    "validation_stats": statistics(
        "clean", "d IS NOT NULL", "count(d)", "0", "(count(*) - count(d))",
        f"SELECT source, cleaned AS d FROM ({cleaned(f'({DIRTY})')})",
    )
    + " UNION ALL "
    + statistics(
        "as_is", "valid", "count(*)", "count(*) FILTER (WHERE NOT valid)", "0",
        f"SELECT source, domain AS d, valid FROM ({judged(f'({DIRTY})')})",
    ),
    "run_stats": f"""
    SELECT (SELECT count(DISTINCT source) FROM ({ENTRIES})) AS sources_processed,
           (SELECT count(DISTINCT source) FROM ({FAILURES})) AS sources_failed,
           (SELECT count(*) FROM ({ENTRIES})) AS domains_fetched,
           (SELECT count(*) FROM ({DEDUPED})) AS domains_validated,
           (SELECT count(*) FROM ({DEDUPED}) WHERE category IN ('malware', 'ads_trackers'))
             AS domains_published""",
    "ingest_run": f"""
    WITH t AS (SELECT category, source, count(*) AS n FROM ({DEDUPED}) GROUP BY ALL),
    p AS (SELECT coalesce(sum(n) FILTER (WHERE category = 'malware'), 0)::BIGINT AS malware,
                 coalesce(sum(n) FILTER (WHERE category = 'ads_trackers'), 0)::BIGINT AS ads,
                 sum(n)::BIGINT AS n FROM t),
    e AS (SELECT count(*) AS n, count(DISTINCT source) AS s FROM ({ENTRIES}))
    SELECT 'sent' AS part, category || '_domains' AS measure, sum(n)::BIGINT AS value
    FROM t GROUP BY category
    UNION ALL SELECT 'published', 'malware', malware FROM p
    UNION ALL SELECT 'published', 'ads_trackers', ads FROM p
    UNION ALL SELECT 'published', 'total', n FROM p
    UNION ALL SELECT 'published', 'failed', 0 FROM p
    UNION ALL SELECT 'validation', 'total', n FROM e
    UNION ALL SELECT 'validation', 'valid', n FROM p
    UNION ALL SELECT 'validation', 'invalid', 0 FROM p
    UNION ALL SELECT 'validation', 'duplicates', e.n - p.n FROM e, p
    UNION ALL SELECT 'validation', 'uncleanable', 0 FROM p
    UNION ALL SELECT 'run', 'sources_processed', s FROM e
    UNION ALL SELECT 'run', 'sources_failed', count(DISTINCT source) FROM ({FAULTY})
              WHERE source IN ('other', 'stray')
    UNION ALL SELECT 'run', 'domains_fetched', n FROM e
    UNION ALL SELECT 'run', 'domains_validated', n FROM p
    UNION ALL SELECT 'run', 'domains_published', n FROM p""",
    "list_stream": f"""
    SELECT category || '_domains' AS topic, count(*) AS entries
    FROM (SELECT DISTINCT category, source, domain FROM ({DEDUPED})) GROUP BY category""",
    "list_files": f"""
    WITH l AS (SELECT source, count(*) AS lines
               FROM ({numbered(f'({DOCUMENTS})', 'source, page_id', 'content')}) GROUP BY source),
    e AS (SELECT source, count(*) AS entries, count(DISTINCT domain) AS domains
          FROM ({ENTRIES}) GROUP BY source)
    SELECT source, lines, lines AS line_numbers, entries, domains
    FROM l LEFT JOIN e USING (source)""",
    "to_messages": f"""
    SELECT domain AS key, category || '_domains' AS topic, off AS "offset", domain, category,
           source, source_format, raw_entry,
           CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS ingestion_timestamp, k
    FROM ({EVENTS})""",
    "publish_stats": f"""
    WITH c AS (SELECT source, CASE WHEN source = 'signup' THEN 'unclassified' ELSE category END
                      AS category FROM ({SIGHTINGS})),
    s AS (SELECT source, count(*) FILTER (WHERE category = 'malware') AS malware,
                 count(*) FILTER (WHERE category = 'ads_trackers') AS ads_trackers,
                 count(*) FILTER (WHERE category IN ('malware', 'ads_trackers')) AS total,
                 count(*) FILTER (WHERE category NOT IN ('malware', 'ads_trackers')) AS failed
          FROM c GROUP BY source)
    SELECT 'source' AS level, * FROM s
    UNION ALL
    SELECT 'overall', NULL, sum(malware)::BIGINT, sum(ads_trackers)::BIGINT,
           sum(total)::BIGINT, sum(failed)::BIGINT FROM s""",
    "publish_topics": f"""
    SELECT category || '_domains' AS topic, count(*) AS messages,
           sum(off)::BIGINT AS offsets, min(domain) AS first_key
    FROM ({SIGHTINGS}) WHERE source <> 'signup' GROUP BY category""",
    "category_counts": f"""
    SELECT category, count(*) AS domains FROM ({SIGHTINGS}) GROUP BY category""",
    "row_count": f"SELECT count(*) AS n FROM ({SIGHTINGS})",
    "sample_day": f"""
    SELECT domain, category, source, off AS kafka_offset,
           strftime(ts, '%Y-%m-%d') AS ingestion_date
    FROM ({EVENTS}) WHERE ts::DATE = DATE '2024-01-10' ORDER BY off LIMIT 10""",
    "gold_domains": GOLD,
    "gold_domain_hash": hashed(f"SELECT domain FROM ({GOLD})"),
    "gold_merge": published(MERGED),
    "gold_stream": GOLD,
    "stream_recovery": GOLD,
    "stream_counts": f"""
    WITH t AS ({cleaned(f'({SIGHTINGS} UNION ALL BY NAME SELECT * EXCLUDE (kind) FROM ({DIRTY}))')})
    SELECT 'bronze' AS layer, 'rows' AS measure, count(*) AS n FROM t
    UNION ALL SELECT 'bronze', 'unreadable', count(*) FILTER (WHERE domain IS NULL) FROM t
    UNION ALL SELECT 'silver', 'rows', count(*) FROM t
    UNION ALL SELECT 'silver', 'valid', count(cleaned) FROM t
    UNION ALL SELECT 'silver', 'invalid', count(*) - count(cleaned) FROM t""",
    "stream_files": f"SELECT count(*) AS n, true AS several, 0 AS with_spare_files FROM ({SIGHTINGS})",
    "layer_views": f"""
    SELECT 'bronze' AS layer, source AS what, count(*) AS n FROM ({SIGHTINGS})
    WHERE ts::DATE = DATE '2024-01-10' GROUP BY source
    UNION ALL SELECT 'silver', source, count(*) FROM ({cleaned(f'({SIGHTINGS})')})
    WHERE ts::DATE = DATE '2024-01-10' AND cleaned IS NOT NULL GROUP BY source
    UNION ALL SELECT 'gold', category, count(*) FROM ({gold(cleaned(f'({SIGHTINGS})'))}) GROUP BY category""",
    "gold_compacted": GOLD,
    "gold_lookup": f"""
    SELECT * FROM ({GOLD}) WHERE domain IN ('d1.example.org', 'd7.example.org', 'd42.example.org',
      'nowhere.example.org', 'd1.example.net')""",
    "gold_curve": f"""
    SELECT c AS "column", true AS cheap, count(*) AS n, sum(source_count)::BIGINT AS sources,
           sum(epoch(date_trunc('second', last_seen)))::BIGINT AS last_seen
    FROM ({gold(cleaned(f'({SIGHTINGS})'))}), (VALUES ('domain'), ('last_seen')) v(c) GROUP BY c""",
    "gold_clustered": GOLD,
    "catalog_gold": GOLD,
    "silver_compacted": f"""
    SELECT strftime(ts, '%Y-%m-%d') AS ingestion_date, source, count(*) AS n,
           sum(off)::BIGINT AS offsets
    FROM ({SIGHTINGS}) GROUP BY ALL""",
    "live_compaction": f"""
    SELECT layer, strftime(ts, '%Y-%m-%d') AS ingestion_date, source, count(*) AS n,
           sum(off)::BIGINT AS offsets, true AS fewer_files
    FROM ({SIGHTINGS}), (VALUES ('bronze'), ('silver')) v(layer) GROUP BY ALL""",
    "table_stats": f"""
    SELECT count(*) AS row_count, NULL::VARCHAR AS error FROM ({SIGHTINGS})""",
    "freshness": f"""
    SELECT layer, strftime(latest, {TIME}) AS latest,
           latest >= TIMESTAMP '2024-01-31 00:20:00' - to_minutes(age) AS fresh
    FROM (
      SELECT 'bronze' AS layer, max(ts) AS latest, 30 AS age FROM ({SIGHTINGS})
      UNION ALL SELECT 'silver', max(ts), 60 FROM ({cleaned(f'({SIGHTINGS})')})
      WHERE cleaned IS NOT NULL
      UNION ALL SELECT 'gold', max(last_seen), 120 FROM ({gold(cleaned(f'({SIGHTINGS})'))}))""",
    "health": f"""
    SELECT coalesce(bool_and(healthy), false) AS all_healthy,
           count(*) FILTER (WHERE NOT healthy) AS failed_count,
           '[' || coalesce(string_agg('"' || component || '"', ',' ORDER BY component)
                  FILTER (WHERE NOT healthy), '') || ']' AS failed
    FROM (SELECT source AS component,
                 max(ts) >= TIMESTAMP '2024-01-31 00:20:00' - INTERVAL 30 MINUTE AS healthy
          FROM ({EVENTS}) GROUP BY source)""",
    "not_null": f"""
    UNPIVOT (
      SELECT count(*) FILTER (WHERE cleaned IS NULL) AS domain, 0::BIGINT AS category,
             0::BIGINT AS source, 0::BIGINT AS source_format, 0::BIGINT AS raw_entry,
             0::BIGINT AS ingestion_timestamp, 0::BIGINT AS bronze_timestamp,
             0::BIGINT AS silver_timestamp, 0::BIGINT AS is_valid, 0::BIGINT AS ingestion_date,
             0::BIGINT AS bronze_offset
      FROM ({cleaned(f'({DIRTY})')}))
    ON * INTO NAME column_name VALUE nulls""",
}
