"""The registered queries in DuckDB SQL, over the same tables."""

from __future__ import annotations

from .. import refdata
from .catalog import (
    CLASS_RULES, DRILL_KEYS, MANY_PHRASES, MICRO_WORDS, QUESTION_PHRASES, QUESTION_TAGS, STORY_WORDS,
)

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
MONTH_AGO = "TIMESTAMP '2024-01-01 00:00:00'"
WEEK_AGO = "TIMESTAMP '2024-01-24 00:00:00'"
CUTOFF = "TIMESTAMP '2024-01-20 00:00:00'"


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(map(_q, values)) + "]"


def _pick(values, index: str) -> str:
    return f"{_list(values)}[CAST({index} AS BIGINT) + 1]"


def _join(value: str) -> str:
    return f"array_to_string({value}, '|')"


_TOPICS = ["OCR", "IDP", "NLP", "ADE", "RPA"]
_SPELLINGS = [
    "Reddit", "HN", "StackOverflow", "twitter", "bsky", "AWS", "mastodon", "ade",
    "re:Post thread", "hacker news",
]

RAW = f"""
raw0 AS (
  SELECT *, event_id AS n,
    CASE WHEN event_id % 5 = 0 AND event_id >= 5 THEN event_id - 3 ELSE event_id END AS pk
  FROM events),
posts_raw AS (
  SELECT n AS seq, ts,
    {_pick(_SPELLINGS, '(n * 3 + user_id) % 10')} AS platform,
    CASE WHEN n % 53 = 0 THEN 'javascript:alert(1)' ELSE
      'https://site' || (pk % 7) || '.example/' || CASE WHEN pk % 2 = 0
        THEN 'item?id=' || pk || {_pick(['', '&ref=x', '#top', '&utm_source=feed'], 'n % 4')}
        ELSE 'p/' || pk || {_pick(['', '/', '#top', '?utm_source=feed'], 'n % 4')} END END AS post_url,
    CASE WHEN n % 41 = 0 THEN '  ' WHEN n % 17 = 0 THEN 'Привет OCR' ELSE 'Post ' || n END AS post_title,
    CASE WHEN n % 9 = 0 THEN NULL ELSE '  u' || user_id || ' ' END AS author_handle,
    CASE n % 6 WHEN 0 THEN '3 days ago' WHEN 2 THEN
        strftime(ts - to_days(CAST(n % 30 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') || 'Z'
      WHEN 3 THEN strftime(ts - to_days(CAST(n % 30 AS INTEGER)), '%Y-%m-%dT%H:%M:%S')
      WHEN 4 THEN '2024-01'
      WHEN 5 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' END AS posted_at,
    CASE WHEN n % 43 = 0 THEN NULL ELSE 'summary ' || n END AS summary,
    CASE WHEN n % 9 = 0 THEN NULL ELSE ' idea ' || user_id || ' ' END AS opportunity,
    CASE WHEN n % 3 = 0 THEN ['bogus']
      ELSE ['OCR', 'bogus', {_pick(_TOPICS, 'user_id % 5')}] END AS categories,
    CASE n % 4 WHEN 0 THEN [' reducto', 'UIPATH', 'Reducto'] WHEN 1 THEN ['nobody']
      ELSE CAST([] AS VARCHAR[]) END AS competitors
  FROM raw0)"""

_INSTANT = """CASE WHEN posted_at LIKE '____-__-__T%' THEN
      CAST(left(posted_at, 19) AS TIMESTAMP)
      - CASE WHEN posted_at LIKE '%+02:00' THEN INTERVAL 2 HOURS ELSE INTERVAL 0 HOURS END END"""

_PLATFORM = f"""CASE
      WHEN contains(lower(trim(platform)), 'reddit') THEN 'reddit'
      WHEN contains(lower(trim(platform)), 'hacker') OR lower(trim(platform)) = 'hn' THEN 'hackernews'
      WHEN contains(lower(trim(platform)), 'stack') OR lower(trim(platform)) = 'so' THEN 'stackoverflow'
      WHEN lower(trim(platform)) IN ('twitter', 'x.com', 'x') THEN 'x'
      WHEN lower(trim(platform)) IN ('bsky', 'bluesky') THEN 'bluesky'
      WHEN regexp_matches(lower(trim(platform)), 'vendor|repost|re:post')
        OR list_contains({_list(refdata.VENDOR_ALIASES)}, lower(trim(platform))) THEN 'vendor-forum'
      WHEN list_contains({_list(refdata.PLATFORMS)}, lower(trim(platform))) THEN lower(trim(platform))
      ELSE 'other' END"""

# The URLs of posts_raw carry id, ref and utm_source only.
_RAW_URL = """regexp_replace(regexp_replace(regexp_replace(post_url, '#.*$', ''),
      '[?&](ref|utm_source)=[a-z]+', ''), '(/p/[0-9]+)/$', '\\1')"""

_CATEGORIES = f"list_filter(categories, lambda c: list_contains({_list(refdata.CATEGORIES)}, c))"
# Distinct names by first mention.
_COMPETITORS = f"""list_transform(list_sort(list_transform(list_filter({_list(refdata.COMPETITORS)},
      lambda k: list_contains(list_transform(competitors, lambda c: lower(trim(c))), lower(k))),
      lambda k: {{'p': list_position(list_transform(competitors, lambda c: lower(trim(c))), lower(k)),
        'k': k}})), lambda s: s.k)"""


def _not_latin(value: str) -> str:
    letters = f"regexp_replace({value}, '[^\\p{{L}}]', '', 'g')"
    beyond = f"regexp_replace({letters}, '[\\x{{0}}-\\x{{24F}}]', '', 'g')"
    return f"(length({letters}) > 0 AND length({beyond}) * 1.0 / greatest(length({letters}), 1) >= 0.2)"


JUDGED = f"""{RAW},
canonical AS (
  SELECT seq, ts, {_PLATFORM} AS platform, {_RAW_URL} AS post_url, trim(post_title) AS post_title,
    nullif(trim(author_handle), '') AS author_handle, {_INSTANT} AS instant,
    CASE WHEN {_INSTANT} IS NOT NULL THEN posted_at END AS posted_at,
    coalesce(trim(summary), '') AS summary, coalesce(trim(opportunity), '') AS opportunity,
    {_CATEGORIES} AS categories, {_COMPETITORS} AS competitors
  FROM posts_raw),
judged AS (
  SELECT *, CASE
      WHEN NOT (starts_with(post_url, 'https://') OR starts_with(post_url, 'http://')) THEN 'bad_url'
      WHEN len(categories) = 0 AND len(competitors) = 0 AND platform <> 'ade' THEN 'untagged'
      WHEN post_title = '' THEN 'no_title'
      WHEN {_not_latin('post_title')} THEN 'not_latin'
      WHEN summary = '' THEN 'no_summary'
      WHEN platform = 'vendor-forum' AND instant < {AS_OF} - INTERVAL 14 DAYS THEN 'stale_vendor'
    END AS reject_reason
  FROM canonical),
good AS (SELECT * FROM judged WHERE reject_reason IS NULL)"""

BATCH = f"""{JUDGED},
mentions AS (
  SELECT post_url, list(name ORDER BY moment) AS names FROM (
    SELECT post_url, name, min({{'s': seq, 'p': pos}}) AS moment FROM (
      SELECT post_url, seq, unnest(competitors) AS name, generate_subscripts(competitors, 1) AS pos
      FROM good) GROUP BY ALL) GROUP BY post_url),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY post_url ORDER BY seq) AS rn,
    bool_or(platform = 'ade') OVER (PARTITION BY post_url) AS raised
  FROM good),
batch AS (
  SELECT f.seq, f.ts, CASE WHEN raised THEN 'ade' ELSE f.platform END AS platform, f.post_url,
    f.post_title, f.author_handle, f.posted_at, f.instant, f.summary, f.opportunity, f.categories,
    coalesce(m.names, []) AS competitors
  FROM firsts f LEFT JOIN mentions m USING (post_url) WHERE rn = 1)"""

STORED = f"""{BATCH},
stored AS (
  SELECT 's' || seq AS id, platform, post_url, post_title, author_handle, instant AS posted_at,
    summary, nullif(opportunity, '') AS opportunity, categories,
    CASE seq % 3 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN ['UiPath', 'Reducto']
      ELSE ['LlamaIndex'] END AS competitors,
    ts AS discovered_at
  FROM batch WHERE ts < {CUTOFF})"""

MERGED = f"""{STORED},
fresh AS (
  SELECT s.post_url, list_filter(b.competitors, lambda c: NOT list_contains(s.competitors, c)) AS names
  FROM stored s JOIN batch b USING (post_url)),
merged AS (
  SELECT s.* EXCLUDE (competitors), len(coalesce(f.names, [])) > 0 AS changed,
    CASE WHEN len(coalesce(f.names, [])) > 0
      THEN list_sort(list_distinct(list_concat(s.competitors, f.names)))
      ELSE s.competitors END AS competitors
  FROM stored s LEFT JOIN fresh f USING (post_url))"""

POSTS = f"""
posts AS (
  SELECT CAST(event_id AS VARCHAR) AS id, {_pick(refdata.PLATFORMS, 'user_id % 8')} AS platform,
    'https://site' || (event_id % 7) || '.example/s/' || event_id AS post_url,
    'Post ' || event_id AS post_title, 'u' || user_id AS author_handle,
    CASE WHEN event_id % 7 <> 0 THEN ts - to_days(CAST(event_id % 30 AS INTEGER)) END AS posted_at,
    'summary ' || event_id AS summary,
    CASE WHEN event_id % 9 <> 0 THEN 'idea ' || user_id END AS opportunity,
    CASE WHEN event_id % 3 = 0 THEN CAST([] AS VARCHAR[])
      ELSE ['OCR', {_pick(_TOPICS, 'user_id % 5')}] END AS categories,
    CASE WHEN event_id % 4 = 0 THEN ['Reducto', 'UiPath'] ELSE CAST([] AS VARCHAR[]) END AS competitors,
    {_pick(refdata.STATUSES, 'event_id % 5')} AS status,
    ts AS discovered_at,
    CASE WHEN event_id % 5 <> 0 AND event_id % 11 <> 0
      THEN ts + to_hours(CAST(event_id % 72 AS INTEGER)) END AS status_changed_at
  FROM events)"""

WINDOW = f"{POSTS}, win AS (SELECT * FROM posts WHERE discovered_at >= {MONTH_AGO})"


def _label(column: str, labels: dict[str, str]) -> str:
    rules = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in labels.items())
    return f"CASE {column} {rules} ELSE {column} END"


def _counts(column: str, labels: dict[str, str]) -> str:
    return f"""WITH {WINDOW},
c AS (SELECT {column}, count(*) AS n, max(discovered_at) AS newest FROM win GROUP BY {column})
SELECT {column}, n, newest, {_label(column, labels)} AS label,
  CAST(floor(100.0 * n / sum(n) OVER () + 0.5) AS BIGINT) AS share,
  row_number() OVER (ORDER BY n DESC, newest DESC, {column}) AS rank
FROM c"""


def _topics(source: str, k: int) -> str:
    """Ties in the order in which newest-first rows show the categories."""
    return f"""SELECT row_number() OVER (ORDER BY n DESC, seen) AS rank, category, n FROM (
    SELECT category, count(*) AS n,
      min({{'a': -epoch_us(discovered_at), 'i': id, 'p': pos}}) AS seen
    FROM (SELECT discovered_at, id, unnest(categories) AS category,
      generate_subscripts(categories, 1) AS pos FROM {source}) GROUP BY category)
  QUALIFY rank <= {k}"""


_DRILLS = {
    "total": "true", "competitors": "len(competitors) > 0",
    **{s: f"status = '{s}'" for s in ("completed", "replied", "archived", "deleted")},
}


def _drill(key: str) -> str:
    if key in _DRILLS:
        return _DRILLS[key]
    field, value = key.split(":")
    if field == "category":
        return f"list_contains(categories, '{value}')"
    return f"{field} = '{value}'"


_FINGERPRINT = """left(regexp_replace(base64(encode(coalesce(message, '') || '|'
    || coalesce(string_split(stack, chr(10))[2], ''))), '[^A-Za-z0-9]', '', 'g'), 64)"""
_STACK = "'Error' || chr(10) || '    at f' || (user_id % 5) || ' (a.js:1:2)' || chr(10) || '    at g'"

REPORTS = f"""
sent AS (
  SELECT event_id AS seq, user_id AS session, ts AS occurred_at,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE 'Boom ' || event_type END AS message,
    CASE WHEN event_id % 10 <> 0 THEN {_STACK} END AS stack
  FROM events),
fingered AS (SELECT *, {_FINGERPRINT} AS fingerprint FROM sent)"""

CLIENT = f"""
client0 AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts AS occurred_at, 'Boom ' || (user_id % 5) AS message,
    {_STACK} AS stack,
    CASE WHEN event_id % 8 <> 0 THEN 'https://site.example/page/' || event_id END AS page_url,
    CASE WHEN event_id % 6 <> 0 THEN 'agent ' || user_id END AS user_agent,
    CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 15 MINUTES END AS alerted_at
  FROM events WHERE event_type = 'error'),
client AS (SELECT *, {_FINGERPRINT} AS fingerprint FROM client0),
waiting AS (SELECT * FROM client WHERE alerted_at IS NULL),
digest AS (
  SELECT fingerprint, count(*) AS occurrences, min(occurred_at) AS first_seen,
    arg_min(id, {{'t': occurred_at, 'i': id}}) AS first_id,
    arg_min(message, {{'t': occurred_at, 'i': id}}) AS message,
    arg_min(stack, {{'t': occurred_at, 'i': id}}) AS stack,
    arg_min(coalesce(page_url, '(no url)'), {{'t': occurred_at, 'i': id}}) AS page_url,
    arg_min(coalesce(user_agent, '(no user agent)'), {{'t': occurred_at, 'i': id}}) AS user_agent
  FROM waiting GROUP BY fingerprint)"""


def _greedy(name: str, source: str, key: str, at: str, order: str, cap: int, seconds: int) -> str:
    """Accepted-only rate limit: one step per row of the key, with the last
    accepted times as state."""
    fits = f"len(list_filter(w.st, lambda x: x > e.t - {seconds * 1_000_000})) < {cap}"
    return f"""
{name}_e AS (
  SELECT {key} AS k, {order} AS id, epoch_us({at}) AS t,
    row_number() OVER (PARTITION BY {key} ORDER BY {at}, {order}) AS rn FROM {source}),
{name}(k, rn, id, ok, st) AS (
  SELECT k, rn, id, true, [t] FROM {name}_e WHERE rn = 1
  UNION ALL
  SELECT e.k, e.rn, e.id, {fits},
    CASE WHEN {fits} THEN list_append(w.st, e.t)[-{cap}:] ELSE w.st END
  FROM {name} w JOIN {name}_e e ON e.k = w.k AND e.rn = w.rn + 1)"""


_RUN = "CAST(event_id // 10 AS BIGINT)"
STEPS = f"""
step_events AS (
  SELECT CAST({_RUN} AS VARCHAR) AS run_id,
    {_pick(['fetch', 'classify', 'clean', 'insert'], 'event_id % 4')} AS name,
    {_pick(['running', 'success', 'failed', 'skipped', 'running', 'success', 'running'], 'event_id % 7')} AS status,
    CASE WHEN event_id % 3 <> 0 THEN event_id % 100 END AS cnt,
    CASE WHEN event_id % 5 = 0 THEN 'note ' || event_id END AS note,
    CASE WHEN event_id % 6 = 0 THEN event_id % 9 END AS sequence, ts AS moment, event_id AS seq
  FROM events),
steps0 AS (
  SELECT run_id, name, min(seq) AS first_seq, min(moment) AS started_at,
    max(moment) FILTER (status <> 'running') AS ended_at, arg_max(status, seq) AS status,
    arg_max(cnt, seq) FILTER (cnt IS NOT NULL) AS cnt,
    arg_max(note, seq) FILTER (note IS NOT NULL) AS note,
    list(sequence ORDER BY seq)[1] AS sequence
  FROM step_events GROUP BY run_id, name),
steps AS (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY first_seq) AS position FROM steps0)"""

ERROR_LOG = f"""
error_log AS (
  SELECT 'e' || event_id AS id, ts AS occurred_at, {_pick(['P1', 'P2', 'P3'], f'{_RUN} % 3')} AS product,
    'job_' || ({_RUN} % 4) AS script, CASE WHEN event_id % 4 <> 0 THEN 'discover' END AS mode,
    left(coalesce(CASE WHEN event_id % 7 <> 0 THEN repeat('failure ' || event_id || ' ', 60) END, ''), 500) AS message,
    CASE WHEN event_id % 2 = 0 THEN 'Traceback ' || event_id END AS traceback,
    CASE WHEN event_id % 6 <> 0 THEN CAST({_RUN} AS VARCHAR) END AS run_id, event_id AS seq
  FROM events WHERE event_type = 'error'),
resolving AS (
  SELECT 'e' || (event_id - 1) AS id,
    CASE WHEN event_id % 2 = 0 THEN 'user' || user_id ELSE 'frontend' END AS resolved_by, ts AS resolved_at
  FROM events WHERE event_type = 'signup'),
resolved AS (
  SELECT e.*, r.id IS NOT NULL AS resolved, r.resolved_at, r.resolved_by
  FROM error_log e LEFT JOIN resolving r USING (id))"""

RUNS = f"""{STEPS}, {ERROR_LOG},
starts AS (
  SELECT {_RUN} AS run, min(ts) AS started_at FROM events GROUP BY ALL),
ends AS (
  SELECT CAST({_RUN} AS VARCHAR) AS run_id, {_pick(['success', 'partial'], 'event_id % 2')} AS status,
    CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) END AS stats,
    CASE WHEN event_id % 4 = 0 THEN 'e' || event_id END AS error_id, ts AS moment, event_id AS seq
  FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT run_id, 'failed', NULL, id, occurred_at, seq FROM error_log WHERE run_id IS NOT NULL),
ended AS (
  SELECT run_id, arg_max(status, seq) AS status, max(moment) AS ended_at,
    arg_max(stats, seq) FILTER (stats IS NOT NULL) AS stats,
    arg_max(error_id, seq) FILTER (error_id IS NOT NULL) AS error_id
  FROM ends GROUP BY run_id),
step_lines AS (
  SELECT run_id, string_agg(name || ':' || status, '|' ORDER BY position) AS steps
  FROM steps GROUP BY run_id),
runs AS (
  SELECT CAST(s.run AS VARCHAR) AS id, {_pick(['P1', 'P2', 'P3'], 's.run % 3')} AS product,
    'job_' || (s.run % 4) AS script,
    CASE WHEN s.run % 5 <> 0 THEN {_pick(['discover', 'archive'], 's.run % 2')} END AS mode,
    s.started_at, e.ended_at, coalesce(e.status, 'running') AS status,
    coalesce(l.steps, '') AS steps, e.stats, k.id AS error_id
  FROM starts s LEFT JOIN ended e ON e.run_id = CAST(s.run AS VARCHAR)
  LEFT JOIN step_lines l ON l.run_id = CAST(s.run AS VARCHAR)
  LEFT JOIN error_log k ON k.id = e.error_id)"""

LOG = f"""
log_lines AS (
  SELECT CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 10 = 0 THEN '2024-13-45 '
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S ') END
    || {_pick(['INFO', 'ERROR', 'info error', 'BROKEN'], 'event_id % 4')} || ' line ' || event_id AS value
  FROM events),
log_hits AS (
  SELECT value, regexp_extract(value, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS day FROM log_lines
  WHERE (contains(value, 'ERROR') OR contains(value, 'BROKEN'))
    AND (try_cast(regexp_extract(value, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS DATE) IS NULL
      OR try_cast(regexp_extract(value, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS DATE)
        >= {AS_OF} - INTERVAL 8 DAYS))"""


def _findings(runaway: int, expected: list[str]) -> str:
    return f"""{POSTS}, {CLIENT}, {LOG},
week AS (SELECT * FROM posts WHERE discovered_at >= {AS_OF} - INTERVAL 7 DAYS),
per_day AS (SELECT CAST(discovered_at AS DATE) AS day, count(*) AS n FROM week GROUP BY ALL),
spine AS (
  SELECT CAST(d AS DATE) AS day
  FROM generate_series(DATE '2024-01-24', DATE '2024-01-30', INTERVAL 1 DAY) AS g(d)
  WHERE isodow(d) <> 7),
found AS (
  SELECT 'zero_volume_days' AS "check", string_agg(CAST(day AS VARCHAR), ', ' ORDER BY day) AS detail
  FROM spine WHERE day NOT IN (SELECT day FROM per_day)
  UNION ALL
  SELECT 'runaway_days', string_agg(day || ':' || n, ', ' ORDER BY day) FROM per_day WHERE n > {runaway}
  UNION ALL
  SELECT 'silent_platforms', string_agg(p, ', ' ORDER BY p) FROM (SELECT unnest({_list(expected)}) AS p)
  WHERE p NOT IN (SELECT platform FROM week)
  UNION ALL
  SELECT 'competitor_mentions', CASE WHEN count(*) FILTER (len(competitors) > 0) = 0
    THEN 'none in 7 days' END FROM week
  UNION ALL
  SELECT 'error_volume', CASE WHEN count(*) > 50 THEN CAST(count(*) AS VARCHAR) END
  FROM client WHERE occurred_at >= {AS_OF} - INTERVAL 7 DAYS
  UNION ALL
  SELECT 'log_lines', CASE WHEN count(*) > 0 THEN CAST(count(*) AS VARCHAR) END FROM log_hits),
findings AS (
  SELECT "check", 'NEEDS_ATTENTION' AS severity, detail FROM found WHERE detail IS NOT NULL)"""


def _phrases(words: list[str]) -> str:
    rows = ", ".join(f"(CAST({i} AS BIGINT), {_q(w)})" for i, w in enumerate(words))
    return f"(VALUES {rows}) AS kw(query, keyword)"


_SPACE = "[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _snippet(value: str) -> str:
    bare = f"regexp_replace({value}, '<[^>]+>', ' ', 'g')"
    return f"left(trim(regexp_replace({bare}, '{_SPACE}+', ' ', 'g')), 500)"


STORIES = f"""
hits AS (
  SELECT *, CASE WHEN doc_id % 11 = 0 THEN '' ELSE ' Story ' || doc_id || '' END AS title,
    CASE WHEN doc_id % 22 <> 0 THEN 'Told ' || doc_id END AS story_title,
    {AS_OF} - to_seconds((doc_id + 1) * 3600) AS moment
  FROM documents),
matched AS (
  SELECT hits.*, kw.query,
    row_number() OVER (PARTITION BY kw.query ORDER BY moment DESC, CAST(doc_id AS VARCHAR)) AS rank
  FROM hits JOIN {_phrases(STORY_WORDS)}
    ON contains(lower(concat_ws(chr(10), title, story_title, text)), lower(kw.keyword))
  QUALIFY rank <= 20),
stories AS (
  SELECT query, rank, 'hackernews' AS platform,
    'https://news.ycombinator.com/item?id=' || doc_id AS post_url,
    trim(coalesce(nullif(title, ''), nullif(story_title, ''), '')) AS post_title,
    CASE WHEN doc_id % 7 <> 0 THEN 'by ' || source END AS author_handle,
    strftime(moment, '%Y-%m-%dT%H:%M:%SZ') AS posted_at,
    nullif({_snippet('text')}, '') AS body
  FROM matched QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY query, rank) = 1),
story_pool AS (SELECT * FROM stories WHERE post_title <> '')"""

QUESTIONS = f"""
items AS (
  SELECT event_id, user_id, date_trunc('second', ts) AS moment,
    'https://qa.example/q/' || (event_id - event_id % 4) AS link,
    CASE WHEN event_id % 19 = 0 THEN '  '
      WHEN event_id % 2 = 0 THEN 'How does ' || event_type || ' work? ' || event_id
      ELSE 'Question ' || event_id END AS title,
    [event_type, 'k' || regexp_extract(props, '[0-9]+')] AS tags
  FROM events WHERE date_trunc('second', ts) >= {AS_OF} - INTERVAL 744 HOURS),
asked AS (
  SELECT kw.query, link, moment FROM items
    JOIN {_phrases(QUESTION_TAGS)} ON list_contains(tags, kw.keyword)
  UNION ALL
  SELECT kw.query + {len(QUESTION_TAGS)}, link, moment FROM items
    JOIN {_phrases(QUESTION_PHRASES)} ON contains(lower(title), lower(kw.keyword))),
ranked AS (
  SELECT query, link, max(moment) AS moment,
    row_number() OVER (PARTITION BY query ORDER BY max(moment) DESC, link) AS rank
  FROM asked GROUP BY query, link QUALIFY rank <= 30),
questions AS (
  SELECT r.query, r.rank, 'stackoverflow' AS platform, link AS post_url, trim(title) AS post_title,
    CASE WHEN event_id % 5 <> 0 THEN 'u' || user_id END AS author_handle,
    strftime(moment, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS posted_at,
    'Tags: ' || array_to_string(tags, ', ') AS body
  FROM ranked r JOIN items USING (link, moment)
  QUALIFY row_number() OVER (PARTITION BY link ORDER BY r.query, r.rank) = 1),
question_pool AS (SELECT * FROM questions WHERE post_title <> '')"""

MICRO = f"""
micro AS (
  SELECT event_id, user_id, date_trunc('second', ts) AS moment,
    CASE WHEN event_id % 29 <> 0 THEN 'at://did/app/post/' || event_id END AS uri,
    CASE WHEN event_id % 31 <> 0 THEN 'u' || user_id END AS handle,
    CASE WHEN event_id % 37 = 0 THEN ' ' ELSE ' a ' || event_type || ' with ' || props END AS text
  FROM events WHERE date_trunc('second', ts) >= {AS_OF} - INTERVAL 744 HOURS),
asked_micro AS (
  SELECT query, uri, max(moment) AS moment,
    row_number() OVER (PARTITION BY query ORDER BY max(moment) DESC, uri NULLS FIRST) AS rank
  FROM micro JOIN {_phrases(MICRO_WORDS)} ON contains(lower(text), lower(kw.keyword))
  GROUP BY query, uri QUALIFY rank <= 40),
micro_pool AS (
  SELECT query, rank, 'bluesky' AS platform,
    'https://bsky.app/profile/' || handle || '/post/' || event_id AS post_url,
    trim(text) AS post_title, '@' || handle AS author_handle,
    strftime(moment, '%Y-%m-%dT%H:%M:%SZ') AS posted_at
  FROM asked_micro JOIN micro USING (uri, moment)
  WHERE user_id % 10 <> 0 AND handle IS NOT NULL AND trim(text) <> ''
  QUALIFY row_number() OVER (PARTITION BY handle, event_id ORDER BY query, rank) = 1)"""


# What each response of the fixture holds: readable ones have three records, the
# last always without a URL, the middle one faulty in most shapes.
MODEL = """
responses AS (
  SELECT event_id AS response_id, CASE
      WHEN event_id % 23 = 0 THEN 'no_text'
      WHEN event_id % 13 = 0 THEN NULL
      WHEN event_id % 17 = 0 AND event_id % 4 = 2 THEN 'no_json'
      WHEN event_id % 17 = 0 THEN 'no_object'
      WHEN event_id % 19 = 0 THEN 'no_json' END AS fault
  FROM events)"""


def _keyword_category(text: str) -> str:
    cases = ", ".join(
        f"CASE WHEN {' OR '.join(f'contains({text}, {_q(w)})' for w in words)} THEN {_q(name)} END"
        for name, words in CLASS_RULES.items()
    )
    return f"list_filter([{cases}], lambda c: c IS NOT NULL)"


_PAGE_URLS = """
cut AS (SELECT page_id, string_split(regexp_replace(url, '#.*$', ''), '?') AS p FROM pages),
parts AS (
  SELECT page_id, lower(regexp_extract(p[1], '^[^:]+')) || regexp_extract(p[1], '^[^:]+(:.*)$', 1) AS base,
    list_filter(string_split(coalesce(p[2], ''), '&'),
      lambda s: s <> '' AND lower(string_split(s, '=')[1]) NOT IN ('ref', 'utm_source')) AS kept
  FROM cut),
built AS (
  SELECT page_id, regexp_replace(base, '^([a-z]+://[^/]*/.+)/$', '\\1')
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url FROM parts)"""


def oracle_sql() -> dict[str, str]:
    queries = {
        "strip_html_snippet": f"""SELECT page_id, {_snippet('html')} AS snippet,
  left(trim(CASE WHEN page_id % 4 = 0 THEN url ELSE 'Page ' || page_id END), 500) AS title FROM pages""",
        "url_canonical": f"""WITH {_PAGE_URLS}
SELECT page_id, url, regexp_matches(url, '^https?://') AS is_web FROM built""",
        "url_dedup": f"""WITH {_PAGE_URLS} SELECT url, min(page_id) AS page_id FROM built GROUP BY url""",
        "platform_canonical": f"WITH {RAW} SELECT seq, {_PLATFORM} AS platform FROM posts_raw",
        "language_guard": f"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN translate(text, 'aeos', 'аеоѕ')
    ELSE translate(text, 'z', 'ж') END AS t FROM documents)
SELECT doc_id, NOT {_not_latin('t')} AS is_latin FROM d""",
        "posted_at_valid": f"""WITH {JUDGED} SELECT seq, posted_at, instant FROM canonical""",
        "epoch_times": """SELECT event_id,
  CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS "at" FROM events""",
        "taxonomy_and_competitors": f"""WITH {RAW} SELECT seq, {_join(_CATEGORIES)} AS categories,
  {_join(_COMPETITORS)} AS competitors FROM posts_raw""",
        "clean_posts": f"""WITH {JUDGED} SELECT seq, platform, post_url, post_title, author_handle,
  posted_at, summary, opportunity, {_join('categories')} AS categories,
  {_join('competitors')} AS competitors FROM good""",
        "clean_rejects": f"""WITH {JUDGED} SELECT seq, reject_reason FROM judged
WHERE reject_reason IS NOT NULL""",
        "dedup_merge": f"""WITH {BATCH} SELECT seq, platform, post_url, post_title, author_handle,
  posted_at, summary, opportunity, {_join('categories')} AS categories,
  {_join('competitors')} AS competitors FROM batch""",
        "new_vs_existing": f"""WITH {STORED} SELECT post_url,
  CASE WHEN post_url IN (SELECT post_url FROM stored) THEN 'stored' ELSE 'new' END AS found
FROM batch""",
        "competitor_merge": f"""WITH {MERGED}
SELECT post_url, {_join('competitors')} AS competitors, changed FROM merged""",
        "upsert_snapshot": f"""WITH {MERGED}
SELECT platform, post_url, post_title, author_handle, posted_at, summary, opportunity,
  {_join('categories')} AS categories, {_join('competitors')} AS competitors, 'new' AS status,
  discovered_at FROM merged
UNION ALL
SELECT platform, post_url, post_title, author_handle, instant, summary, nullif(opportunity, ''),
  {_join('categories')}, {_join('competitors')}, 'new', {AS_OF}
FROM batch WHERE post_url NOT IN (SELECT post_url FROM stored)""",
        "upsert_ids": f"""WITH {STORED},
h AS (SELECT b.post_url, s.id, sha256(b.post_url) AS x FROM batch b LEFT JOIN stored s USING (post_url))
SELECT post_url, CAST(1 AS BIGINT) AS n, coalesce(id, concat_ws('-', substr(x, 1, 8), substr(x, 9, 4),
  substr(x, 13, 4), substr(x, 17, 4), substr(x, 21, 12))) AS id FROM h""",
        "archive_sweep": f"""WITH {POSTS}, s AS (
  SELECT *, CASE WHEN status = 'new' AND discovered_at < {AS_OF} - INTERVAL 4 DAYS THEN 'age'
    WHEN status = 'new' AND platform = 'vendor-forum' AND posted_at < {AS_OF} - INTERVAL 14 DAYS
      THEN 'stale_vendor' END AS archived_for FROM posts)
SELECT id, CASE WHEN archived_for IS NULL THEN status ELSE 'archived' END AS status,
  CASE WHEN archived_for IS NULL THEN status_changed_at ELSE {AS_OF} END AS status_changed_at,
  archived_for FROM s""",
        "archive_counts": f"""WITH {POSTS}
SELECT count(*) FILTER (discovered_at < {AS_OF} - INTERVAL 4 DAYS) AS by_age,
  count(*) FILTER (discovered_at >= {AS_OF} - INTERVAL 4 DAYS AND platform = 'vendor-forum'
    AND posted_at < {AS_OF} - INTERVAL 14 DAYS) AS by_post_date,
  count(*) FILTER (discovered_at < {AS_OF} - INTERVAL 4 DAYS OR (platform = 'vendor-forum'
    AND posted_at < {AS_OF} - INTERVAL 14 DAYS)) AS archived
FROM posts WHERE status = 'new'""",
        "apply_status_actions": f"""WITH {POSTS},
a AS (
  SELECT CASE WHEN event_id % 13 = 0 THEN 'no-' || event_id
      ELSE CAST(event_id - event_id % 3 AS VARCHAR) END AS id,
    {_pick([*refdata.STATUSES, 'gone'], '(event_id + user_id) % 6')} AS status,
    CASE WHEN event_id % 10 <> 0 THEN 'user' || user_id END AS usr, ts AS moment, event_id AS seq
  FROM events),
l AS (SELECT * FROM a WHERE status <> 'gone'
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY moment DESC, seq DESC) = 1)
SELECT p.id, coalesce(l.status, p.status) AS status, coalesce(l.moment, p.status_changed_at) AS status_changed_at,
  l.usr AS actioned_by, l.moment AS actioned_at FROM posts p LEFT JOIN l ON l.id = p.id""",
        "refused_actions": """SELECT event_id AS seq, CASE WHEN event_id % 13 = 0 THEN 'no-' || event_id
  ELSE CAST(event_id - event_id % 3 AS VARCHAR) END AS id, 'gone' AS status
FROM events WHERE (event_id + user_id) % 6 = 5""",
        "row_count": "SELECT count(*) AS n FROM events",
        "active_queue": f"""WITH {POSTS} SELECT id, platform, post_url, discovered_at FROM posts
WHERE status = 'new' ORDER BY discovered_at DESC, id LIMIT 500""",
        "archive_view": f"""WITH {POSTS} SELECT id, status, status_changed_at FROM posts
WHERE status IN ('archived', 'completed', 'replied')
ORDER BY status_changed_at DESC NULLS LAST, id LIMIT 500""",
        "archive_view_since": f"""WITH {POSTS} SELECT id, status, status_changed_at FROM posts
WHERE status IN ('archived', 'completed', 'replied') AND status_changed_at >= {WEEK_AGO}
ORDER BY status_changed_at DESC, id LIMIT 500""",
        "report_window": f"""WITH {WINDOW} SELECT id, platform, status, {_join('categories')} AS categories,
  {_join('competitors')} AS competitors, discovered_at FROM win
ORDER BY discovered_at DESC, id LIMIT 10000""",
        "posts_window": f"""WITH {POSTS} SELECT id, platform, post_url, post_title, summary, opportunity,
  {_join('categories')} AS categories, status, posted_at, discovered_at FROM posts
WHERE discovered_at >= {AS_OF} - INTERVAL 168 HOURS""",
        "top_topics": f"WITH {WINDOW} {_topics('win', 10)}",
        "platform_counts": _counts("platform", refdata.PLATFORM_LABELS),
        "status_counts": _counts("status", refdata.STATUS_LABELS),
        "stat_cards": f"""WITH {WINDOW} SELECT count(*) AS total,
  {', '.join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ('completed', 'replied', 'archived', 'deleted'))},
  count(*) FILTER (len(competitors) > 0) AS competitors FROM win""",
        "action_timeline": f"""WITH {WINDOW} SELECT CAST(CAST(status_changed_at AS DATE) AS VARCHAR) AS day,
  {', '.join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ('replied', 'deleted', 'archived', 'completed'))}
FROM win WHERE status <> 'new' AND status_changed_at IS NOT NULL GROUP BY ALL""",
        "posts_per_day": f"""WITH {POSTS} SELECT CAST(CAST(discovered_at AS DATE) AS VARCHAR) AS day, count(*) AS n
FROM posts GROUP BY ALL""",
        "drill_in": f"WITH {POSTS} "
        + "\nUNION ALL\n".join(
            f"SELECT '{key}' AS drill_key, id FROM posts WHERE {_drill(key)}" for key in DRILL_KEYS
        ),
        "daily_summary": f"""WITH {POSTS},
d AS (SELECT * FROM posts WHERE discovered_at >= {AS_OF} - INTERVAL 24 HOURS),
pl AS (SELECT platform, count(*) AS n, max(discovered_at) AS newest FROM d GROUP BY platform),
tp AS ({_topics('d', 5)})
SELECT 'total' AS section, CAST(1 AS BIGINT) AS rank, 'posts' AS key, CAST(count(*) AS VARCHAR) AS value
FROM d HAVING count(*) > 0
UNION ALL
SELECT 'platform', row_number() OVER (ORDER BY n DESC, newest DESC, platform),
  {_label('platform', refdata.SUMMARY_LABELS)}, CAST(n AS VARCHAR) FROM pl
UNION ALL
SELECT 'topic', rank, category, CAST(n AS VARCHAR) FROM tp
UNION ALL
SELECT 'pick', r, post_title, {_label('platform', refdata.SUMMARY_LABELS)} || ' ' || post_url
FROM (SELECT *, row_number() OVER (ORDER BY discovered_at DESC, id) AS r FROM d) WHERE r <= 5""",
        "fingerprint_errors": f"WITH {REPORTS} SELECT seq, fingerprint FROM fingered",
        "ttl_dedup": f"""WITH RECURSIVE {_greedy('w', 'events', 'event_type', 'ts', 'event_id', 1, 3600)}
SELECT id AS event_id, k AS event_type FROM w WHERE ok""",
        "rate_limit": f"""WITH RECURSIVE {_greedy('w', 'events', 'event_type', 'ts', 'event_id', 2, 3600)}
SELECT id AS event_id, k AS event_type FROM w WHERE ok""",
        "rate_limit_hot": f"""WITH RECURSIVE {_greedy('w', 'events', "'all'", 'ts', 'event_id', 2, 3600)}
SELECT id AS event_id FROM w WHERE ok""",
        "error_intake": f"""WITH RECURSIVE {REPORTS},
{_greedy('page', 'fingered', "session || ':' || fingerprint", 'occurred_at', 'seq', 1, 60)},
passed AS (SELECT f.* FROM fingered f JOIN page p ON p.id = f.seq AND p.ok
  WHERE length(message) > 0 AND length(fingerprint) > 0),
{_greedy('hour', 'passed', 'fingerprint', 'occurred_at', 'seq', 3, 3600)}
SELECT seq, message, fingerprint FROM passed JOIN hour h ON h.id = seq AND h.ok""",
        "error_digest": f"WITH {CLIENT} SELECT * FROM digest",
        "mark_alerted": f"""WITH {CLIENT}
SELECT c.id, c.fingerprint, CASE WHEN w.id IS NOT NULL AND g.message <> 'Boom 3' THEN {AS_OF}
  ELSE c.alerted_at END AS alerted_at
FROM client c LEFT JOIN waiting w ON w.id = c.id LEFT JOIN digest g ON g.fingerprint = c.fingerprint""",
        "fold_steps": f"""WITH {STEPS}
SELECT run_id, position, name, started_at, ended_at, status, CAST(cnt AS VARCHAR) AS count, note,
  coalesce(sequence, position) AS sequence FROM steps""",
        "fold_runs": f"WITH {RUNS} SELECT * FROM runs",
        "runs_list": f"""WITH {RUNS} SELECT id, script, started_at, ended_at, error_id FROM runs
WHERE started_at > {AS_OF} - INTERVAL 20 DAYS AND product = 'P2' AND status = 'failed'
ORDER BY started_at DESC, id LIMIT 500""",
        "errors_list": f"""WITH {ERROR_LOG} SELECT id, occurred_at, product, script, mode, message,
  traceback, CAST(resolved AS VARCHAR) AS resolved, resolved_at, run_id FROM resolved
WHERE occurred_at > {AS_OF} - INTERVAL 30 DAYS AND NOT resolved
ORDER BY occurred_at DESC, id LIMIT 100""",
        "resolve_errors": f"""WITH {ERROR_LOG}
SELECT id, message, CAST(resolved AS VARCHAR) AS resolved, resolved_at, resolved_by FROM resolved""",
        "run_errors": f"""WITH {RUNS} SELECT r.id, r.error_id, left(e.message, 20) AS message,
  CASE WHEN e.id IS NOT NULL THEN 'false' END AS resolved
FROM runs r LEFT JOIN error_log e ON e.id = r.error_id""",
        "zero_volume_days": f"""WITH {POSTS},
own AS (SELECT DISTINCT author_handle FROM posts)
SELECT author_handle, CAST(CAST(d AS DATE) AS VARCHAR) AS day
FROM own, generate_series(DATE '2024-01-24', DATE '2024-01-30', INTERVAL 1 DAY) AS g(d)
WHERE isodow(d) <> 7 AND NOT EXISTS (SELECT 1 FROM posts p WHERE CAST(p.discovered_at AS DATE) = CAST(d AS DATE)
  AND p.author_handle IS NOT DISTINCT FROM own.author_handle)""",
        "health_findings": f"""WITH {_findings(340, [*refdata.EXPECTED_PLATFORMS, 'newsgroup'])}
SELECT * FROM findings""",
        "health_verdict": f"""WITH {_findings(100, refdata.EXPECTED_PLATFORMS)}
SELECT CASE WHEN count(*) > 0 THEN 'NEEDS_ATTENTION' ELSE 'HEALTHY' END AS verdict,
  count(*) AS findings FROM findings""",
        "log_scan": f"WITH {LOG} SELECT value FROM log_hits",
        "log_tail": f"WITH {LOG} SELECT value FROM log_hits ORDER BY day DESC, value DESC LIMIT 15",
        "log_tail_landed": f"""WITH {LOG} SELECT value FROM log_hits
ORDER BY CAST(regexp_extract(value, 'line ([0-9]+)', 1) AS BIGINT) DESC LIMIT 15""",
        "phrase_index": f"""WITH phrases AS (SELECT {_list(MANY_PHRASES)} AS p),
each AS (SELECT i - 1 AS query, lower(p[i]) AS phrase FROM phrases, range(1, len(p) + 1) r(i))
SELECT query, count(*) AS n_docs, CAST(sum(doc_id) AS BIGINT) AS ids
FROM (SELECT doc_id, lower(text) AS low FROM documents), each WHERE contains(low, phrase) GROUP BY query""",
        "error_volume": f"""WITH {CLIENT} SELECT count(*) AS n FROM client
WHERE occurred_at >= {AS_OF} - INTERVAL 7 DAYS""",
        "harvest_keyword_topk": f"""WITH {STORIES} SELECT query, rank, post_url, post_title,
  author_handle, posted_at, body FROM story_pool""",
        "harvest_tag_topk": f"""WITH {QUESTIONS} SELECT query, rank, post_url, post_title,
  author_handle, posted_at, body FROM question_pool""",
        "harvest_nested_bot_filter": f"""WITH {MICRO} SELECT query, rank, post_url, post_title,
  author_handle, posted_at FROM micro_pool""",
        "harvest_pool": f"""WITH {STORIES}, {QUESTIONS}, {MICRO}
SELECT query * 1000000 + rank AS seq, platform, post_url FROM story_pool
UNION ALL SELECT 1000000000000 + query * 1000000 + rank, platform, post_url FROM question_pool
UNION ALL SELECT 2000000000000 + query * 1000000 + rank, platform, post_url FROM micro_pool""",
        "model_batch_faults": f"""WITH {MODEL} SELECT response_id, fault FROM responses
WHERE fault IS NOT NULL""",
        "model_batch_summaries": f"""WITH {MODEL} SELECT response_id,
  CASE WHEN response_id % 13 = 0 THEN 'none' ELSE 'batch ' || response_id END AS summary
FROM responses WHERE fault IS NULL""",
        "model_batch_parse": f"""WITH {MODEL},
r AS (SELECT response_id, response_id AS n, unnest([0, 1, 2]) AS pos FROM responses
  WHERE fault IS NULL AND response_id % 13 <> 0)
SELECT response_id, CAST(pos AS BIGINT) AS pos,
  CASE pos WHEN 0 THEN NULL WHEN 2 THEN 'post_url' ELSE
    [NULL, 'categories', 'opportunity', 'categories', NULL, 'posted_at'][n % 6 + 1] END AS fault,
  'x' AS platform,
  CASE WHEN pos < 2 THEN 'https://m.example/' || n END AS post_url,
  CASE WHEN pos < 2 THEN 'T ' || n END AS post_title,
  CASE WHEN pos < 2 THEN 'S' END AS summary, CAST(NULL AS VARCHAR) AS author_handle,
  CASE WHEN pos = 1 AND n % 6 = 5 THEN '5' END AS posted_at, '' AS opportunity,
  CASE WHEN pos = 0 THEN 'OCR' WHEN pos = 1 AND n % 6 = 3 THEN 'OCR|1' ELSE '' END AS categories,
  CASE WHEN pos = 0 THEN 'UiPath' ELSE '' END AS competitors
FROM r""",
        "classify_hook": f"""WITH {STORIES},
c AS (SELECT post_url, {_keyword_category("lower(post_title || chr(10) || coalesce(body, ''))")} AS categories
  FROM story_pool)
SELECT post_url, 'Matched ' || array_to_string(categories, ', ') AS summary,
  {_join('categories')} AS categories FROM c WHERE len(categories) > 0""",
        "classify_faults": f"""WITH c AS (
  SELECT doc_id AS seq, contains(coalesce(text, ''), 'AKIA') AS refused,
    {_keyword_category("lower(chr(10) || coalesce(text, ''))")} AS categories FROM documents)
SELECT seq, CASE WHEN NOT refused THEN {_join('categories')} END AS categories,
  CASE WHEN refused THEN 'ValueError: refused' END AS fault
FROM c WHERE refused OR len(categories) > 0""",
        "schema_evolution": f"""WITH {POSTS} SELECT id, platform,
  CASE WHEN discovered_at < {CUTOFF} THEN '' ELSE {_join('competitors')} END AS competitors FROM posts""",
        "priority_pool": f"""WITH {BATCH},
u AS (SELECT post_url, platform, {{'p': 0, 's': seq}} AS place FROM posts_raw
  UNION ALL SELECT post_url, 'ade', {{'p': 1, 's': seq}} FROM batch)
SELECT post_url, CASE WHEN bool_or(platform = 'ade') THEN 'ade' ELSE arg_min(platform, place) END AS platform
FROM u GROUP BY post_url""",
        "model_landed": f"""WITH {MODEL},
r AS (SELECT response_id AS n, unnest([0, 1]) AS pos FROM responses WHERE fault IS NULL AND response_id % 13 <> 0)
SELECT 'x' AS platform, 'https://m.example/' || n AS post_url, 'T ' || n AS post_title
FROM r WHERE pos = 0 OR n % 6 IN (0, 4)""",
        "subset_guard": f"""WITH {BATCH} SELECT seq, post_url FROM posts_raw
WHERE post_url IN (SELECT post_url FROM batch)""",
        "snippet_lookup": f"""WITH {BATCH},
l AS (SELECT post_url, arg_max(summary, seq) AS body FROM posts_raw WHERE summary IS NOT NULL GROUP BY post_url)
SELECT post_url, body FROM batch LEFT JOIN l USING (post_url)""",
        "stage_counters": f"""WITH {STORED}
SELECT 'clean' AS stage, coalesce(reject_reason, 'kept') AS key, count(*) AS n FROM judged GROUP BY ALL
UNION ALL SELECT 'distinct', 'all', count(DISTINCT post_url) FROM good
UNION ALL SELECT 'stored', 'all', count(*) FROM stored
UNION ALL SELECT 'new', platform, count(*) FROM batch
  WHERE post_url NOT IN (SELECT post_url FROM stored) GROUP BY ALL""",
        "platform_breakdown": f"""WITH {STORED},
c AS (SELECT platform, count(*) AS n, min(seq) AS first FROM batch
  WHERE post_url NOT IN (SELECT post_url FROM stored) GROUP BY platform)
SELECT coalesce(string_agg(n || ' ' || platform, ', ' ORDER BY n DESC, first), 'none') AS by_platform FROM c""",
        "stream_ingest": f"""WITH {JUDGED},
phased AS (SELECT *, ts >= {CUTOFF} AS late FROM good),
named AS (
  SELECT post_url, late, list(name ORDER BY moment) AS names FROM (
    SELECT post_url, late, name, min({{'s': seq, 'p': pos}}) AS moment FROM (
      SELECT post_url, late, seq, unnest(competitors) AS name,
        generate_subscripts(competitors, 1) AS pos FROM phased) GROUP BY ALL) GROUP BY ALL),
landed AS (
  SELECT p.late, p.post_url, p.post_title, p.categories, coalesce(n.names, []) AS competitors,
    CASE WHEN bool_or(platform = 'ade') OVER (PARTITION BY p.post_url, p.late)
      THEN 'ade' ELSE platform END AS platform
  FROM phased p LEFT JOIN named n ON n.post_url = p.post_url AND n.late = p.late
  QUALIFY row_number() OVER (PARTITION BY p.post_url, p.late ORDER BY seq) = 1),
first AS (SELECT * FROM landed WHERE NOT late),
second AS (SELECT * FROM landed WHERE late)
SELECT f.platform, f.post_url, f.post_title, {_join('f.categories')} AS categories,
  {_join("""CASE WHEN len(list_filter(coalesce(s.competitors, []),
      lambda c: NOT list_contains(f.competitors, c))) > 0
    THEN list_sort(list_distinct(list_concat(f.competitors, s.competitors))) ELSE f.competitors END""")} AS competitors
FROM first f LEFT JOIN second s USING (post_url)
UNION ALL
SELECT platform, post_url, post_title, {_join('categories')}, {_join('competitors')}
FROM second WHERE post_url NOT IN (SELECT post_url FROM first)""",
        "stream_rate_limit": f"""WITH RECURSIVE {_greedy('w', 'events', 'event_type', 'ts', 'event_id', 2, 3600)}
SELECT id AS event_id, k AS event_type FROM w WHERE ok""",
        "stream_ttl_dedup": f"""WITH RECURSIVE {_greedy('w', 'events', 'event_type', 'ts', 'event_id', 1, 3600)}
SELECT id AS event_id, k AS event_type FROM w WHERE ok""",
        "stream_digest": f"""WITH {CLIENT}
SELECT CAST(occurred_at >= {CUTOFF} AS BIGINT) AS batch, fingerprint,
  count(*) AS occurrences, min(occurred_at) AS first_seen,
  arg_min(id, {{'t': occurred_at, 'i': id}}) AS first_id
FROM client WHERE alerted_at IS NULL GROUP BY ALL""",
    }
    # the same results by way of kept tables, landed files and streams
    for name, same in (
        ("harvest_landed", "harvest_pool"), ("summary_job", "daily_summary"), ("health_job", "health_findings"),
        ("stream_digest_marks", "mark_alerted"), ("stream_fold_steps", "fold_steps"),
        ("stream_fold_runs", "fold_runs"), ("stream_harvest", "harvest_pool"),
    ):
        queries[name] = queries[same]
    return queries
