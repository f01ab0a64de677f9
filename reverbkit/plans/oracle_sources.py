"""DuckDB oracle SQL for the page, record and engagement queries."""

from __future__ import annotations

from reverbkit.plans.oracle import r2, r6



def _plain(text: str) -> str:
    """The entities that pages hold, one replacement after the other."""
    for name, char in (("&#39;", "''"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{char}')"
    return f"trim({text})"


_TAGS = f"""list_transform(string_split(regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1), '</a>'),
                          lambda t: ltrim({_plain("regexp_replace(regexp_extract(t, '(?s)<a[^>]*>(.*)', 1), '<[^>]*>', '', 'g')")}, '#'))[:-2]"""

ORACLE_SOURCES: dict[str, str] = {}

ORACLE_SOURCES["page_fields"] = f"""
WITH p AS (SELECT page_id, url, html, {_TAGS} AS tg FROM pages),
q AS (SELECT *, CASE WHEN len(tg) > 0 THEN tg ELSE ['No tags found'] END AS tags2 FROM p)
SELECT page_id, url,
  nullif({_plain("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")}, '') AS title,
  nullif(regexp_extract(html, '<html[^>]*\\slang="([^"]*)"', 1), '') AS lang,
  array_to_string(tags2, '|') AS tags, CAST(len(tags2) AS INTEGER) AS n_tags
FROM q
"""

_REC = """
WITH o AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
         CAST(floor(o_totalprice) AS BIGINT) AS price, CAST(floor(o_totalprice * 10) AS BIGINT) AS p10
  FROM orders),
r AS (
  SELECT o_orderkey AS record_id,
    (CASE WHEN o_orderkey % 10 = 9 THEN '1.5' ELSE format('{:,}', price) END) || ' views ' ||
    (CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%-d %b %Y') ELSE strftime(o_orderdate, '%b %-d, %Y') END) AS info,
    format('{:,}', o_custkey) || ' Comments' AS comment_text,
    'like this video along with ' || format('{:,}', o_custkey * 37) || ' other people' AS like_label,
    '  ' || (CASE WHEN p10 >= 1000000 THEN CAST(p10 // 1000000 AS VARCHAR) || '.' || lpad(CAST((p10 // 10000) % 100 AS VARCHAR), 2, '0') || 'M subscribers'
                  WHEN p10 >= 1000 THEN CAST(p10 // 1000 AS VARCHAR) || '.' || CAST((p10 // 100) % 10 AS VARCHAR) || 'K subscribers'
                  ELSE CAST(p10 AS VARCHAR) || ' subscribers' END) || ' ' AS subscriber_text,
    ' Channel ' || CAST(o_custkey AS VARCHAR) || ' ' AS channel_text
  FROM o),
s AS (
  SELECT *,
    replace(regexp_extract(info, '([0-9,.]+)\\sviews', 1), ',', '') AS v_txt,
    nullif(regexp_extract(info, '([0-9]{1,2}\\s[A-Za-z0-9_]+\\s[0-9]{4}|[A-Za-z0-9_]+\\s[0-9]{1,2},\\s[0-9]{4})', 1), '') AS d_txt,
    replace(regexp_extract(like_label, '([0-9,.]+)', 1), ',', '') AS l_txt,
    regexp_replace(comment_text, '[^0-9]', '', 'g') AS c_txt,
    trim(replace(trim(subscriber_text), 'subscribers', '')) AS s_txt
  FROM r)
"""


def _strict(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[0-9]+') THEN TRY_CAST({x} AS BIGINT) END"


ORACLE_SOURCES["parse_counts"] = _REC + f"""
SELECT record_id,
  {_strict('v_txt')} AS views,
  d_txt AS upload_date,
  CAST(coalesce(try_strptime(d_txt, '%d %b %Y'), try_strptime(d_txt, '%b %d, %Y')) AS DATE) AS upload_dt,
  {_strict('l_txt')} AS likes,
  {_strict('c_txt')} AS comment_count,
  trim(channel_text) AS channel_name,
  CASE WHEN contains(s_txt, 'K') THEN CAST(TRY_CAST(replace(s_txt, 'K', '') AS DECIMAL(20,4)) * 1000 AS BIGINT)
       WHEN contains(s_txt, 'M') THEN CAST(TRY_CAST(replace(s_txt, 'M', '') AS DECIMAL(20,4)) * 1000000 AS BIGINT)
       ELSE {_strict("replace(s_txt, ',', '')")} END AS subscriber_count
FROM s
"""

ORACLE_SOURCES["top_comments"] = """
SELECT video_id, event_id, value, rank FROM (
  SELECT user_id AS video_id, event_id, value,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS INTEGER) AS rank
  FROM events)
WHERE rank <= 20
"""

_ENG = """
WITH c AS (
  SELECT user_id AS video_id,
    CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
    CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS likes,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS comment_count,
    CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS subscriber_count
  FROM events GROUP BY user_id),
m AS (
  SELECT *,
    CASE WHEN views = 0 THEN CAST(0.0 AS DOUBLE) ELSE """ + r2("(CAST(likes AS DOUBLE) / CAST(views AS DOUBLE)) * 100.0") + """ END AS likes_to_views_perc,
    CASE WHEN views = 0 THEN CAST(0.0 AS DOUBLE) ELSE """ + r2("(CAST(comment_count AS DOUBLE) / CAST(views AS DOUBLE)) * 100.0") + """ END AS comments_to_views_perc,
    CASE WHEN subscriber_count = 0 THEN CAST(0.0 AS DOUBLE) ELSE """ + r2("(CAST(views AS DOUBLE) / CAST(subscriber_count AS DOUBLE)) * 100.0") + """ END AS views_to_subs_perc
  FROM c)
"""

ORACLE_SOURCES["engagement_metrics"] = _ENG + """
SELECT * FROM m
"""

ORACLE_SOURCES["engagement_bands"] = _ENG + """,
b AS (
  SELECT video_id, 'likes_to_views_perc' AS metric, likes_to_views_perc AS value, 1.0 AS benchmark, 1.0 AS lo, 5.0 AS hi FROM m
  UNION ALL SELECT video_id, 'comments_to_views_perc', comments_to_views_perc, 0.5, 0.5, 0.5 FROM m
  UNION ALL SELECT video_id, 'views_to_subs_perc', views_to_subs_perc, 10.0, 10.0, 20.0 FROM m)
SELECT video_id, metric, CAST(value AS DOUBLE) AS value, CAST(benchmark AS DOUBLE) AS benchmark,
  CASE WHEN value < lo THEN 'under' WHEN value > hi THEN 'over' ELSE 'good' END AS band,
  """ + r6("CAST(value AS DOUBLE) - CAST(benchmark AS DOUBLE)") + """ AS gap
FROM b
"""

ORACLE_SOURCES["token_lengths"] = """
WITH t AS (SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS INTEGER) AS n FROM documents)
SELECT doc_id, n AS n_tokens, CAST(least(n, 64) AS INTEGER) AS kept_64, CAST(least(n, 128) AS INTEGER) AS kept_128,
       n > 64 AS truncated_64 FROM t
"""
