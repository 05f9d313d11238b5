r"""DuckDB twins of the queries.

They take their own road where there is one: patterns instead of word sets for
detection, self-contained SQL windows instead of the operators.  DuckDB's
``\b`` knows ASCII only, so boundaries are spelled out as neighbouring
characters.
"""

from __future__ import annotations

import re

from risewatch.catalog.feeds import PAGE_TAXONOMY, PART_TAXONOMY, STOP_WORDS, TITLE_TAILS
from risewatch.catalog.queries import (
    AUDIT_CAP,
    FEW_NAMES,
    NOUNS,
    STORED_BEFORE,
)
from risewatch.operators.reports import STORY_LINK
from risewatch.sources.windows import WINDOW_HOURS
from risewatch.taxonomy import DEFAULT, Taxonomy

W = r"[\p{L}\p{N}_]"
NOT_W = r"[^\p{L}\p{N}_]"
START, END = rf"(?:^|{NOT_W})", rf"(?:$|{NOT_W})"

FEED = """
feed AS (
  SELECT l_orderkey * 10 + l_linenumber AS story_id, p_name AS title, CAST(NULL AS VARCHAR) AS url,
         CAST(floor(l_quantity) AS INTEGER) AS score,
         CAST(floor(l_tax * 100) AS INTEGER) AS num_comments, l_shipdate AS created_at,
         strftime(l_shipdate, '%Y-W%W') AS iso_week,
         l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

FIRST = (
    "row_number() OVER (PARTITION BY story_id ORDER BY created_at, l_partkey, l_suppkey, "
    "l_quantity, l_extendedprice, num_comments) AS rn"
)

STORIES = (
    FEED
    + f""",
stories AS (
  SELECT story_id, title, url, score, num_comments, created_at, iso_week
  FROM (SELECT *, {FIRST} FROM feed) WHERE rn = 1)"""
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _name_pattern(name: str) -> str:
    before = START if re.match(r"\w", name[0]) else W
    after = END if re.match(r"\w", name[-1]) else W
    return f"(?i){before}{re.escape(name).replace(chr(92) + ' ', ' ')}{after}"


def _taxonomy(taxonomy: Taxonomy, name: str = "tax") -> str:
    rows = ", ".join(f"({_quoted(k)}, {_quoted(c)})" for k, c in taxonomy.category_of().items())
    return f"{name}(keyword, category) AS (VALUES {rows})"


def _matches(taxonomy: Taxonomy, name: str = "matched", tax: str = "tax", of: str = "stories") -> str:
    """One scan per name, so that every pattern is a constant."""
    scans = "\n  UNION ALL ".join(
        f"SELECT *, {_quoted(k)} AS keyword FROM {of} WHERE regexp_matches(title, {_quoted(_name_pattern(k))})"
        for k in taxonomy.category_of()
        if k not in taxonomy.patterns
    )
    return f"""
{_taxonomy(taxonomy, tax)},
{name}_names AS ({scans}),
{name} AS (SELECT m.*, t.category FROM {name}_names m JOIN {tax} t USING (keyword))"""


ROLLUP = """count(*) AS mention_count, CAST(sum(score) AS DOUBLE) / count(*) AS weighted_score,
         avg(num_comments) AS avg_comments"""


def _norm(metric: str, source: str = "") -> str:
    low = f"min({metric}) OVER (PARTITION BY iso_week)"
    high = f"max({metric}) OVER (PARTITION BY iso_week)"
    return f"CASE WHEN {high} = {low} THEN 50.0 ELSE ({metric} - {low}) / ({high} - {low}) * 100 END"


def _round(value: str, decimals: int = 4) -> str:
    """Half up on the value to nine decimals."""
    return f"CAST(round(CAST({value} AS DECIMAL(28, 9)), {decimals}) AS DOUBLE)"


HYPE = _round(
    f"0.5 * ({_norm('CAST(mention_count AS DOUBLE)')}) + 0.3 * ({_norm('weighted_score')})"
    f" + 0.2 * ({_norm('avg_comments')})"
)

_SCORED = f"""
rolled AS (SELECT keyword, iso_week, {ROLLUP} FROM matched GROUP BY keyword, iso_week),
mentions AS (SELECT *, {HYPE} AS hype_score FROM rolled)"""

_CHANGE = """CASE WHEN prev_score IS NULL OR prev_score = 0 THEN 0.0
                    ELSE (hype_score - prev_score) / prev_score * 100 END"""
_ROLLING_AVG = "CASE WHEN history >= 2 THEN mean_before ELSE hype_score END"

_VELOCITY = f"""
rolling AS (
  SELECT *, lag(hype_score) OVER ordered AS prev_score,
         count(hype_score) OVER before AS history,
         avg(hype_score) OVER before AS mean_before,
         stddev_samp(hype_score) OVER before AS std_before
  FROM mentions
  WINDOW ordered AS (PARTITION BY keyword ORDER BY iso_week),
         before AS (PARTITION BY keyword ORDER BY iso_week ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
zed AS (
  SELECT *, CASE WHEN history < 2 THEN 0.0
                 WHEN std_before > 1e-9 THEN (hype_score - mean_before) / std_before
                 WHEN mean_before > 0 THEN (hype_score - mean_before) / mean_before * 4.0
                 ELSE 0.0 END AS z
  FROM rolling),
velocity AS (
  SELECT keyword, iso_week,
         {_round(_CHANGE)} AS velocity, {_round(_ROLLING_AVG)} AS rolling_avg,
         {_round("z")} AS z_score, z > 2.0 AS is_trending, z < -2.0 AS is_crashing
  FROM zed)"""

MATCHED = f"WITH {STORIES}, {_matches(PART_TAXONOMY)}"
MENTIONS = f"{MATCHED}, {_SCORED}"
VELOCITY = f"{MENTIONS}, {_VELOCITY}"
TRENDING = f"""{VELOCITY},
trending AS (
  SELECT keyword, velocity, z_score, is_trending, is_crashing, hype_score, mention_count
  FROM velocity JOIN mentions USING (keyword, iso_week)
  WHERE iso_week = (SELECT max(iso_week) FROM mentions))"""
FEED_WEEK = f"""{VELOCITY},
anomalies AS (
  SELECT v.keyword, z_score, velocity, story_id, title, score
  FROM velocity v JOIN matched m ON m.keyword = v.keyword AND m.iso_week = v.iso_week
  WHERE is_trending AND v.iso_week = (SELECT max(iso_week) FROM velocity WHERE is_trending)
  ORDER BY z_score DESC, score DESC, v.keyword, story_id LIMIT 20)"""
TOP_STORIES = """
  SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY z_score DESC, score DESC, story_id) AS rn
  FROM anomalies"""
VELOCITY_COLUMNS = "keyword, iso_week, velocity, rolling_avg, z_score, is_trending, is_crashing"

HITS = """
hits AS (
  SELECT event_id // 100 AS page_no, event_id,
         CASE WHEN event_id % 7 = 3 THEN NULL WHEN event_id % 11 = 5 THEN 'x' || event_id
              ELSE CAST(event_id AS VARCHAR) END AS object_id,
         CASE WHEN event_id % 13 = 4 THEN NULL WHEN event_id % 17 = 6 THEN ''
              ELSE event_type || ' ' || props END AS title,
         date_trunc('milliseconds', ts) AS created_at,
         event_id % 5 <> 0 AND (event_id % 23 = 8 OR event_id % 29 = 9) AS odd_points,
         CASE WHEN event_id % 5 = 0 THEN 0 ELSE CAST(floor(value) AS INTEGER) END AS score,
         CAST(user_id % 50 AS INTEGER) AS num_comments,
         'https://example.com/u/' || user_id AS url, ts
  FROM events)"""

PARSED = f"""{HITS},
parsed AS (
  SELECT TRY_CAST(object_id AS BIGINT) AS story_id, title, url, score, num_comments, created_at,
         strftime(created_at, '%Y-W%W') AS iso_week
  FROM hits WHERE TRY_CAST(object_id AS BIGINT) IS NOT NULL AND length(title) > 0 AND NOT odd_points)"""

# copies: how often a page's hits, a stray thing on every 4th page, and a page cut off come in
REJECTED = f"""{HITS}
SELECT reason, count(*) * copies AS n_hits FROM (
  SELECT CASE WHEN object_id IS NULL THEN 'missing id'
              WHEN coalesce(length(title), 0) = 0 THEN 'missing title'
              WHEN TRY_CAST(object_id AS BIGINT) IS NULL THEN 'id is not an integer'
              WHEN odd_points THEN 'unreadable points' END AS reason
  FROM hits), times WHERE reason IS NOT NULL GROUP BY reason, copies
UNION ALL SELECT 'hit is not an object', 3 * copies * count(DISTINCT page_no) FROM hits, times WHERE page_no % 4 = 1 GROUP BY copies
UNION ALL SELECT 'unreadable page', count(DISTINCT page_no) FROM hits WHERE page_no % 10 = 3"""

BOUNDS = """
bounds AS (SELECT epoch(date_trunc('second', min(ts)))::BIGINT AS s, epoch(date_trunc('second', max(ts)))::BIGINT AS e FROM events)"""

PLAN = f"""{BOUNDS},
plan AS (
  SELECT b AS bucket, to_timestamp(s + b * 43200)::TIMESTAMPTZ AT TIME ZONE 'UTC' AS window_start,
         to_timestamp(least(s + (b + 1) * 43200, e))::TIMESTAMPTZ AT TIME ZONE 'UTC' AS window_end
  FROM bounds, unnest(range(0, CAST(ceil((e - s) / {WINDOW_HOURS * 3600}.0) AS BIGINT))) AS u(b))"""

URL_TEXT = (
    r"translate(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?', 1) || ' ' ||"
    r" regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1),"
    r" ';[^/]*$', ''), '-_./', '    ')"
)
LINKS = rf"""
links AS (
  SELECT story_id, page_title || ' ' || {URL_TEXT} AS title
  FROM (SELECT page_id AS story_id, url,
               regexp_extract(html, '<title>(.*?)</title>', 1) AS page_title FROM pages))"""

# RE2 has no look-ahead: take the word with what may follow it, and ask whether
# any occurrence comes without (la) or with (en) a follower.
_LA = rf"(?i){START}la(?:\s+(?:de|que|éo)|{END})"
_EN = rf"(?i){START}en(?:\s+(?:el|la|un)|\s*$)"
LINK_MATCHES = rf"""{LINKS},
{_matches(PAGE_TAXONOMY, of="links")},
found AS (
  SELECT story_id, keyword FROM matched
  UNION ALL
  SELECT story_id, 'la' FROM links
  WHERE len(list_filter(regexp_extract_all(regexp_replace(title, '\s', ' ', 'g'),
        '(?i)(?:^|{NOT_W})la(?:\s+(?:de|que|éo)|{NOT_W}|$)'),
        lambda x: NOT regexp_matches(x, '(?i)la\s+(?:de|que|éo)$'))) > 0
  UNION ALL
  SELECT story_id, 'en' FROM links WHERE regexp_matches(title, '{_EN}'))"""

DEFAULT_MATCHES = f"""
{_matches(DEFAULT, of="texts")},
found AS (
  SELECT story_id, keyword, category FROM matched
  UNION ALL
  SELECT story_id, 'Go', 'Languages' FROM texts
  WHERE len(list_filter(regexp_extract_all(title,
    '(?i)\\bGo\\b(?:\\s+(?:to|ahead|back|through|away|home|on|off|up|down|out|in|over|under))?'),
    lambda x: lower(x) = 'go')) > 0
  UNION ALL
  SELECT story_id, 'R', 'Languages' FROM texts
  WHERE regexp_matches(title,
    '(?i){START}R(?:\\s+(?:language|programming|package|cran|tidyverse|\\d)|\\s*$)'))"""

_NAMES = "[" + ", ".join(_quoted(name) for name in DEFAULT.category_of()) + "]"
_TAILS = "[" + ", ".join(map(_quoted, TITLE_TAILS)) + "]"
TITLES = f"""
numbered AS (
  SELECT l_orderkey * 10 + l_linenumber AS story_id, l_orderkey * 7 + l_linenumber AS n, p_name,
         list_extract({_NAMES}, CAST((l_orderkey * 7 + l_linenumber) % {len(DEFAULT)} + 1 AS INTEGER)) AS name,
         list_extract({_TAILS}, CAST(l_partkey % {len(TITLE_TAILS)} + 1 AS INTEGER)) AS tail
  FROM lineitem JOIN part ON l_partkey = p_partkey),
texts AS (
  SELECT story_id, CASE WHEN n % 10 = 3 THEN NULL WHEN n % 3 = 0 THEN name || tail
                        WHEN n % 3 = 1 THEN p_name || ' ' || name || tail
                        ELSE p_name || ' ' || name END AS title
  FROM numbered)"""

STOP_LIST = "[" + ", ".join(map(_quoted, STOP_WORDS)) + "]"
# letters and numbers beyond ASCII become underscores, word characters that no
# term contains, so that the ASCII \b of the engine is the right boundary
TOKENS = rf"""
tokens AS (
  SELECT doc_id, source, list_filter(regexp_extract_all(
           regexp_replace(lower(text), '[^\P{{L}}\x00-\x7F]|[^\P{{N}}\x00-\x7F]', '_', 'g'),
           '\b[a-z][a-z0-9.+#\-]+\b'), lambda t: NOT list_contains({STOP_LIST}, t)) AS tokens
  FROM documents),
terms AS (
  SELECT doc_id, source, tokens, list_concat(tokens,
           [tokens[i] || ' ' || tokens[i + 1] for i in range(1, len(tokens))]) AS terms
  FROM tokens)"""


def _tfidf(group: str) -> str:
    return f"""
counts AS (SELECT {group}, doc_id, term, count(*) AS tf
           FROM (SELECT {group}, doc_id, unnest(terms) AS term FROM terms) GROUP BY ALL),
sizes AS (SELECT {group}, count(*) AS n FROM terms GROUP BY ALL),
frequent AS (SELECT {group}, term, count(*) AS df FROM counts GROUP BY ALL HAVING count(*) >= 5),
idf AS (SELECT {group}, term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM frequent JOIN sizes USING ({group})),
weights AS (SELECT {group}, doc_id, term, tf * idf AS w FROM counts JOIN idf USING ({group}, term)),
lengths AS (SELECT {group}, doc_id, sqrt(sum(w * w)) AS len FROM weights GROUP BY ALL),
scores AS (SELECT {group}, term, sum(w / len) AS tfidf_score
           FROM weights JOIN lengths USING ({group}, doc_id) GROUP BY ALL)"""


def _top(group: str, taxonomy: Taxonomy) -> str:
    known = ", ".join(sorted(_quoted(k.lower()) for k in taxonomy.category_of()))
    return f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY {group}
                                        ORDER BY round(tfidf_score, 8) DESC, term) AS rn
           FROM scores WHERE term NOT IN ({known})),
top AS (SELECT term, {group}, round(tfidf_score, 6) AS tfidf_score FROM ranked WHERE rn <= 20)"""


def _title_terms(title: str) -> str:
    return f"""{STORIES},
titled AS (SELECT story_id, iso_week, {title} AS title FROM stories),
tokens AS (SELECT story_id AS doc_id, iso_week, string_split(title, ' ') AS tokens FROM titled WHERE title IS NOT NULL),
terms AS (SELECT doc_id, iso_week, list_concat(tokens,
            [tokens[i] || ' ' || tokens[i + 1] for i in range(1, len(tokens))]) AS terms FROM tokens),
{_tfidf("iso_week")}, {_top("iso_week", PART_TAXONOMY)}"""


TITLE_TERMS = _title_terms("title")
SOURCE_TERMS = f"{TOKENS}, {_tfidf('source')}"

KEYWORDS_4 = "('gizmo', 'ring', 'blue', 'old')"


def _history(keywords: str, n: int) -> str:
    return f"""
history AS (
  SELECT keyword, iso_week, hype_score, mention_count
  FROM (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY iso_week DESC) AS rn
        FROM mentions WHERE keyword IN {keywords}) WHERE rn <= {n})"""


def _value(keyword: str) -> str:
    return f"max(hype_score) FILTER (WHERE keyword = '{keyword}')"


def _mover(order: str, sign: str) -> str:
    return f"""{TRENDING}
SELECT keyword, velocity, hype_score, format('{{:.1f}}', hype_score) AS score_text,
       '{sign}' || format('{{:.1f}}', velocity) || '% WoW' AS change_text
FROM trending ORDER BY velocity {order}, keyword LIMIT 5"""


def all_sql() -> dict[str, str]:
    week = "strftime(o_orderdate, '%Y-W%W')"
    return {
        "week_label": f"SELECT o_orderkey, {week} AS iso_week FROM orders",
        "parse_hits": f"WITH {PARSED} SELECT * FROM parsed",
        "rejected_hits": f"WITH times AS (SELECT 1 AS copies), {REJECTED}",
        "stream_rejects": f"WITH times AS (SELECT 2 AS copies), {REJECTED}",
        "total_hits": "SELECT count(*) AS nb_hits FROM events",
        "total_hits_by_window": """
WITH sized AS (SELECT event_id // 100 AS page_no, CAST(min(ts) AS DATE) AS day, count(*) AS n
               FROM events GROUP BY 1)
SELECT day, CAST(sum(n) AS BIGINT) AS nb_hits FROM sized GROUP BY day""",
        "insert_first_copy": f"WITH {PARSED} SELECT story_id, score FROM parsed",
        "time_range_filter": """
SELECT event_id, 'neither' AS closed FROM events
WHERE floor(epoch(ts)) > 1704672000 AND floor(epoch(ts)) < 1705276800
UNION ALL
SELECT event_id, 'left' AS closed FROM events
WHERE floor(epoch(ts)) >= 1704672000 AND floor(epoch(ts)) < 1705276800""",
        "window_plan": f"WITH {PLAN} SELECT * FROM plan",
        "coverage_audit": f"""WITH {PLAN},
counts AS (SELECT (floor(epoch(ts))::BIGINT - s) // 43200 AS bucket, count(*) AS n
           FROM events, bounds GROUP BY ALL)
SELECT bucket, window_start, window_end, coalesce(n, 0) AS n_stories,
       coalesce(n, 0) >= {AUDIT_CAP} AS maybe_truncated, coalesce(n, 0) = 0 AS is_empty
FROM plan LEFT JOIN counts USING (bucket)""",
        "page_audit": f"""
WITH sized AS (SELECT event_id // 100 AS page_no, CAST(min(ts) AS DATE) AS day, count(*) AS n
               FROM events GROUP BY 1)
SELECT day, CAST(sum(n) AS BIGINT) AS n_stories, sum(n) >= {2 * AUDIT_CAP} AS maybe_truncated,
       sum(n) = 0 AS is_empty FROM sized GROUP BY day""",
        "high_water_mark": """
SELECT CAST(epoch(max(l_shipdate)) AS BIGINT) AS since_ts FROM lineitem JOIN part ON l_partkey = p_partkey""",
        "insert_ignore_dedup": f"""WITH {STORIES}
SELECT * FROM stories WHERE story_id NOT IN (
  SELECT story_id FROM feed WHERE created_at < TIMESTAMP '{STORED_BEFORE}')""",
        "merge_replace": f"""WITH {STORIES},
old_stories AS (SELECT * FROM stories WHERE score < 40),
new_stories AS (SELECT * FROM stories WHERE iso_week >= '1998-W00'),
{_matches(PART_TAXONOMY, "old_matched", "old_tax", "old_stories")},
{_matches(NOUNS, "new_matched", "new_tax", "new_stories")},
old_rolled AS (SELECT keyword, iso_week, {ROLLUP} FROM old_matched GROUP BY ALL),
o AS (SELECT *, {HYPE} AS hype_score FROM old_rolled),
n AS (SELECT keyword, iso_week, {ROLLUP} FROM new_matched GROUP BY ALL)
SELECT n.*, o.hype_score FROM n LEFT JOIN o USING (keyword, iso_week)
UNION ALL
SELECT o.* FROM o ANTI JOIN n USING (keyword, iso_week)""",
        "row_counts": f"""{VELOCITY}
SELECT 'raw_stories' AS table_name, count(*) AS n_rows FROM stories
UNION ALL SELECT 'keyword_events', count(*) FROM matched
UNION ALL SELECT 'weekly_mentions', count(*) FROM mentions
UNION ALL SELECT 'keyword_velocity', count(*) FROM velocity""",
        "url_text": f"SELECT page_id, {URL_TEXT} AS url_text FROM pages",
        "match_text": f"WITH {LINKS} SELECT story_id, title AS match_text FROM links",
        "detect_keywords": f"""WITH {LINK_MATCHES}
SELECT story_id, coalesce(string_agg(keyword, '|' ORDER BY keyword), '') AS keywords
FROM links LEFT JOIN found USING (story_id) GROUP BY story_id""",
        "detect_by_word_join": f"WITH {LINK_MATCHES} SELECT story_id, keyword FROM found",
        "detect_documents": f"""
WITH texts AS (SELECT doc_id AS story_id, text AS title FROM documents),
{DEFAULT_MATCHES}
SELECT story_id, keyword, category FROM found""",
        "detect_default_taxonomy": f"""
WITH {TITLES}, {DEFAULT_MATCHES}
SELECT keyword, count(*) AS n_stories, CAST(sum(story_id) AS BIGINT) AS id_sum FROM found GROUP BY keyword""",
        "detection_totals": f"""WITH {STORIES}, {_matches(NOUNS)}
SELECT (SELECT count(*) FROM stories) AS stories_processed, count(*) AS hits_written,
       count(DISTINCT story_id) AS stories_with_hits FROM matched""",
        "keyword_events": f"""{MATCHED}
SELECT story_id, keyword, category, score, created_at, iso_week FROM matched""",
        "category_lookup": f"""{MATCHED}
SELECT keyword, count(*) AS n_events,
       CASE WHEN category = 'Noun' THEN 'Noun' ELSE 'Unknown' END AS category
FROM matched GROUP BY ALL""",
        "unprocessed_stories": f"""WITH {STORIES}, {_matches(FEW_NAMES)}
SELECT story_id, title FROM stories WHERE story_id NOT IN (SELECT story_id FROM matched)""",
        "weekly_mentions": f"""{MATCHED}
SELECT keyword, iso_week, {ROLLUP} FROM matched GROUP BY ALL""",
        "distinct_weeks": f"{MATCHED} SELECT DISTINCT iso_week FROM matched ORDER BY 1",
        "available_keywords": f"{MATCHED} SELECT DISTINCT keyword FROM matched ORDER BY 1",
        "latest_week": f"{MATCHED} SELECT max(iso_week) AS iso_week FROM matched",
        "load_metadata": f"""WITH {STORIES}
SELECT max(created_at + to_days(num_comments)) AS last_run, count(*) AS total_stories FROM stories""",
        "minmax_norm": f"""{MENTIONS}
SELECT keyword, iso_week, {_round(_norm("CAST(mention_count AS DOUBLE)"), 6)} AS norm_mention_count,
       {_round(_norm("weighted_score"), 6)} AS norm_weighted_score,
       {_round(_norm("avg_comments"), 6)} AS norm_avg_comments FROM mentions""",
        "flat_histories": f"""{MATCHED},
rolled AS (SELECT keyword, iso_week, {ROLLUP} FROM matched GROUP BY keyword, iso_week),
mentions AS (SELECT keyword, iso_week, CASE WHEN q = 0 THEN 0.0::DOUBLE ELSE 20.0 + q * 15 END AS hype_score
             FROM (SELECT *, CAST(substr(iso_week, 7, 2) AS INTEGER) // 13 AS q FROM rolled)),
{_VELOCITY}
SELECT {VELOCITY_COLUMNS} FROM velocity""",
        "hype_scores": f"{MENTIONS} SELECT keyword, iso_week, hype_score FROM mentions",
        "wow_velocity": f"{VELOCITY} SELECT keyword, iso_week, velocity FROM velocity",
        "rolling_stats": f"""{VELOCITY}
SELECT keyword, iso_week, prev_score, history, {_round("mean_before", 6)} AS mean_before,
       {_round("std_before", 6)} AS std_before FROM rolling""",
        "keyword_velocity": f"{VELOCITY} SELECT {VELOCITY_COLUMNS} FROM velocity",
        "trending_keywords": f"{TRENDING} SELECT * FROM trending ORDER BY velocity DESC, keyword",
        "category_trending": f"""{TRENDING}
SELECT trending.* FROM trending JOIN tax USING (keyword) WHERE category = 'Noun'""",
        "risers": _mover("DESC", "+"),
        "fallers": _mover("ASC", ""),
        "anomaly_feed": f"{FEED_WEEK} SELECT * FROM anomalies",
        "anomaly_top_story": f"""{FEED_WEEK}
SELECT keyword, story_id, format('{{:.2f}}', z_score) AS z_text, substr(title, 1, 80) AS title,
       '{STORY_LINK}' || story_id AS link, score
FROM ({TOP_STORIES}) WHERE rn = 1""",
        "top_trending_all": f"""{VELOCITY}
SELECT keyword, iso_week, z_score FROM velocity WHERE is_trending
ORDER BY z_score DESC, keyword, iso_week LIMIT 10""",
        "hype_cycle": f"""{MENTIONS}, {_history("('gizmo')", 52)}
SELECT iso_week, hype_score, mention_count FROM history ORDER BY iso_week""",
        "hype_cycles": f"{MENTIONS}, {_history(KEYWORDS_4, 26)} SELECT * FROM history",
        "hype_pivot": f"""{MENTIONS}, {_history(KEYWORDS_4, 52)}
SELECT iso_week, {_value("gizmo")} AS gizmo, {_value("ring")} AS ring,
       {_value("blue")} AS blue, {_value("old")} AS old FROM history GROUP BY iso_week""",
        "compare_keywords": f"""{MENTIONS}, {_history("('gizmo', 'blue')", 52)}
SELECT iso_week, round({_value("gizmo")} - {_value("blue")}, 4) AS difference
FROM history GROUP BY iso_week""",
        "default_selection": f"""{MATCHED}
SELECT position, keyword FROM (VALUES (0, 'Python'), (1, 'ring'), (2, 'Go'), (3, 'blue')) w(position, keyword)
WHERE keyword IN (SELECT keyword FROM matched)""",
        "default_selection_fallback": f"""{MATCHED}
SELECT CAST(row_number() OVER (ORDER BY keyword) - 1 AS INTEGER) AS position, keyword
FROM (SELECT DISTINCT keyword FROM matched) ORDER BY keyword LIMIT 4""",
        "tokens_ngrams": f"""WITH {TOKENS}
SELECT doc_id, len(tokens) AS n_tokens, len(terms) AS n_terms,
       array_to_string(tokens, ' ') AS tokens, terms[-1] AS last_term FROM terms""",
        "term_frequencies": f"""WITH {SOURCE_TERMS}
SELECT source, doc_id, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_occurrences, max(tf) AS max_tf
FROM counts GROUP BY ALL""",
        "document_frequencies": f"""WITH {SOURCE_TERMS}
SELECT source, term, df, round(idf, 6) AS idf FROM idf""",
        "tfidf_scores": f"""WITH {SOURCE_TERMS}
SELECT source, term, round(tfidf_score, 6) AS tfidf_score FROM scores""",
        "emerging_by_source": f"""WITH {SOURCE_TERMS}, {_top("source", DEFAULT)}
SELECT * FROM top""",
        "emerging_terms": f"WITH {TITLE_TERMS} SELECT * FROM top",
        "emerging_without_titles": f"""
WITH {_title_terms("CASE WHEN story_id % 4 <> 1 THEN title END")} SELECT * FROM top""",
        "emerging_view": f"""WITH {TITLE_TERMS}
SELECT term, iso_week, round(tfidf_score, 4) AS tfidf_score FROM top
WHERE iso_week = (SELECT max(iso_week) FROM top)""",
        "quality_checks": f"""{MENTIONS}
SELECT 'new_stories' AS check_name, count(*) > 0 AS passed, CAST(count(*) AS DOUBLE) AS observed,
       1.0::DOUBLE AS threshold FROM stories WHERE created_at > TIMESTAMP '{STORED_BEFORE}'
UNION ALL SELECT 'keyword_events', count(*) > 0, count(*), 1 FROM matched
UNION ALL SELECT 'freshness', age <= 26, round(age, 4), 26 FROM (
  SELECT (epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(created_at)))) / 3600.0 AS age FROM stories)
UNION ALL SELECT 'freshness_events', age <= 26, round(age, 4), 26 FROM (
  SELECT (epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(ts)))) / 3600.0 AS age FROM events)
UNION ALL SELECT 'unique_weekly_mentions', count(*) = 0, count(*), 0 FROM (
  SELECT 1 FROM mentions GROUP BY keyword, iso_week HAVING count(*) > 1)
UNION ALL SELECT 'unique_raw_feed', count(*) = 0, count(*), 0 FROM (
  SELECT 1 FROM feed GROUP BY story_id HAVING count(*) > 1)""",
        "recent_weeks": f"""
SELECT DISTINCT {week} AS iso_week FROM orders
UNION SELECT DISTINCT strftime(o_orderdate - INTERVAL 7 DAY, '%Y-W%W') FROM orders""",
        "rebuild_tables": f"""{VELOCITY}
SELECT keyword, iso_week, mention_count, hype_score, velocity, z_score
FROM mentions JOIN velocity USING (keyword, iso_week)""",
        "refresh_tables": f"{VELOCITY} SELECT {VELOCITY_COLUMNS} FROM velocity",
        "trending_view": f"""{VELOCITY},
week AS (SELECT max(iso_week) AS w FROM velocity WHERE is_trending),
shown AS (SELECT keyword, velocity, hype_score, mention_count, z_score
          FROM velocity JOIN mentions USING (keyword, iso_week) JOIN tax USING (keyword)
          WHERE category = 'Noun' AND iso_week = (SELECT w FROM week)),
anomalies AS (
  SELECT v.keyword, z_score, score, story_id FROM velocity v
  JOIN matched m ON m.keyword = v.keyword AND m.iso_week = v.iso_week
  WHERE is_trending AND v.iso_week = (SELECT w FROM week)
  ORDER BY z_score DESC, score DESC, v.keyword, story_id LIMIT 20)
SELECT 'trending' AS part, keyword, hype_score, velocity, mention_count AS story_id,
       format('{{:.2f}}', z_score) AS shown FROM shown
UNION ALL (SELECT 'risers', keyword, hype_score, velocity, NULL, '+' || format('{{:.1f}}', velocity) || '% WoW'
           FROM shown ORDER BY velocity DESC, keyword LIMIT 5)
UNION ALL (SELECT 'fallers', keyword, hype_score, velocity, NULL, format('{{:.1f}}', velocity) || '% WoW'
           FROM shown ORDER BY velocity, keyword LIMIT 5)
UNION ALL
SELECT 'anomalies', keyword, CAST(score AS DOUBLE), NULL, story_id,
       format('{{:.2f}}', z_score) || '{STORY_LINK}' || story_id
FROM ({TOP_STORIES}) WHERE rn = 1""",
        "hype_cycle_view": f"""{MENTIONS}, {_history("('gizmo', 'blue')", 52)}
SELECT iso_week, {_value("gizmo")} AS gizmo, {_value("blue")} AS blue,
       round({_value("gizmo")} - {_value("blue")}, 4) AS difference FROM history GROUP BY iso_week""",
        "table_states": f"""{MATCHED},
names(table_name) AS (VALUES ('raw_stories'), ('keyword_events'), ('weekly_mentions'), ('keyword_velocity'), ('emerging_terms'))
SELECT state, table_name, 0 AS n_rows FROM names, (VALUES ('missing'), ('created')) s(state)
UNION ALL SELECT 'filled', 'raw_stories', count(*) FROM stories
UNION ALL SELECT 'filled', 'keyword_events', count(*) FROM matched""",
        "stream_ingest": f"WITH {PARSED} SELECT * FROM parsed",
        "stream_distinct": f"WITH {PARSED} SELECT * FROM parsed",
        "stream_refresh": f"""WITH {PARSED},
names(keyword) AS (VALUES ('click'), ('view'), ('signup'), ('purchase'), ('error')),
matched AS (SELECT p.*, keyword FROM parsed p JOIN names ON regexp_matches(title, '\\b' || keyword || '\\b')),
{_SCORED}, {_VELOCITY}
SELECT {VELOCITY_COLUMNS} FROM velocity""",
        "stream_state_refresh": f"""WITH {PARSED},
names(keyword) AS (VALUES ('click'), ('view'), ('signup'), ('purchase'), ('error')),
matched AS (SELECT p.*, keyword FROM parsed p JOIN names ON regexp_matches(title, '\\b' || keyword || '\\b')),
{_SCORED}, {_VELOCITY}
SELECT {VELOCITY_COLUMNS} FROM velocity""",
    }
