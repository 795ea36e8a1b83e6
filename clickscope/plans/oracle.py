"""Independent DuckDB SQL for each registered query (the correctness oracle).

Parameters match :class:`clickscope.plans.catalogue.Params`: range
2024-01-05..2024-01-07, path 1..7, threshold 3, top 10/10/3, every 97th
ad-log line cut short. Stream and sink queries reuse the batch oracle of
the result they must reproduce.
"""

from __future__ import annotations

UVA = """WITH e AS (SELECT *, CAST(json_extract_string(props,'$.k') AS INTEGER) k FROM events),
uva AS (SELECT event_id, strftime(ts,'%Y-%m-%d') AS "date", user_id,
  CAST(user_id AS VARCHAR)||'-'||strftime(ts,'%Y%m%d') AS session_id,
  CAST(k%10+1 AS BIGINT) page_id, strftime(ts,'%Y-%m-%d %H:%M:%S') action_time,
  CASE WHEN event_type='view' THEN 'kw'||CAST(k%6 AS VARCHAR) END search_keyword,
  CAST(CASE WHEN event_type='click' THEN k%20+1 ELSE -1 END AS BIGINT) click_category_id,
  CAST(CASE WHEN event_type='click' THEN k+1 ELSE -1 END AS BIGINT) click_product_id,
  CASE WHEN event_type='signup' THEN CAST(k%20+1 AS VARCHAR)||','||CAST((k*7)%20+1 AS VARCHAR)||','||CAST((k*3)%20+1 AS VARCHAR) END order_category_ids,
  CASE WHEN event_type='purchase' THEN CAST(k%20+1 AS VARCHAR)||','||CAST((k*11)%20+1 AS VARCHAR) END pay_category_ids,
  user_id%26+1 city_id FROM e)
"""

FACTS = UVA + """, facts AS (
  SELECT CAST(click_category_id AS VARCHAR) category_id, 1 c, 0 o, 0 p FROM uva WHERE click_category_id<>-1
  UNION ALL SELECT unnest(string_split(order_category_ids,',')),0,1,0 FROM uva WHERE click_category_id=-1 AND order_category_ids IS NOT NULL
  UNION ALL SELECT unnest(string_split(pay_category_ids,',')),0,0,1 FROM uva WHERE click_category_id=-1 AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL),
counts AS (SELECT category_id, CAST(sum(c) AS BIGINT) click_count, CAST(sum(o) AS BIGINT) order_count, CAST(sum(p) AS BIGINT) pay_count FROM facts GROUP BY 1),
top10 AS (SELECT * FROM counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)
"""

ADS = """WITH ads AS (SELECT e.event_id, epoch_ms(e.ts) ts_ms, strftime(make_timestamp(epoch_ms(e.ts)*1000),'%Y-%m-%d') dt,
  replace(r.r_name,' ','-') province, n.n_name city, CAST(e.user_id AS VARCHAR) userid,
  CAST(CAST(json_extract_string(e.props,'$.k') AS INTEGER)%6+1 AS VARCHAR) adid
  FROM events e JOIN nation n ON n.n_nationkey=e.user_id%25 JOIN region r ON r.r_regionkey=n.n_regionkey)
"""

RAW = ADS + """, raw AS (SELECT CAST(ts_ms AS VARCHAR)||' '||province||' '||city||' '||userid||CASE WHEN event_id%97=0 THEN '' ELSE ' '||adid END line FROM ads)
"""

_BODIES = {
    "visits_conformed": (UVA, "SELECT * FROM uva"),
    "visits_in_range": (UVA, "SELECT * FROM uva WHERE action_time >= '2024-01-05' AND action_time <= '2024-01-07'"),
    "category_action_facts": (FACTS, """SELECT category_id, CASE WHEN c=1 THEN 'click' WHEN o=1 THEN 'order' ELSE 'pay' END AS "action" FROM facts"""),
    "category_counts": (FACTS, "SELECT * FROM counts"),
    "category_top10": (FACTS, "SELECT * FROM top10"),
    "category_top10_run": (FACTS, "SELECT 'run-1' AS task_id, * FROM top10"),
    "visits_quarantine": (UVA, """SELECT event_id, "date", CASE WHEN event_id%50=1 THEN 'unknown' ELSE CAST(user_id AS VARCHAR) END user_id,
  session_id, CASE WHEN event_id%50<>0 THEN CAST(page_id AS VARCHAR) END page_id, CASE WHEN event_id%50<>2 THEN action_time END action_time,
  search_keyword, click_category_id, click_product_id, order_category_ids, pay_category_ids, city_id FROM uva WHERE event_id%50 IN (0,1,2)"""),
    "category_clicks_in_top10": (FACTS, """SELECT CAST(click_category_id AS VARCHAR) category_id, session_id FROM uva
  WHERE click_category_id<>-1 AND CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top10)"""),
    "category_session_clicks": (UVA, """SELECT CAST(click_category_id AS VARCHAR) category_id, session_id, count(*) click_count FROM uva WHERE click_category_id<>-1 GROUP BY 1,2"""),
    "category_session_top10": (FACTS, """, s AS (SELECT CAST(click_category_id AS VARCHAR) category_id, session_id, count(*) click_count FROM uva
  WHERE click_category_id<>-1 AND CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top10) GROUP BY 1,2)
SELECT category_id, session_id, click_count, rn FROM (SELECT *, CAST(row_number() OVER
  (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS INTEGER) rn FROM s) WHERE rn<=10"""),
    "page_views_in_flow": (UVA, "SELECT page_id, count(*) page_views FROM uva WHERE page_id IN (1,2,3,4,5,6,7) GROUP BY 1"),
    "page_transitions": (UVA, """, pr AS (SELECT session_id, page_id a, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) b FROM uva)
SELECT session_id, a, b FROM pr WHERE b IS NOT NULL"""),
    "page_transition_counts": (UVA, """, pr AS (SELECT page_id a, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) b FROM uva)
SELECT a, b, count(*) jumps FROM pr WHERE b = a+1 AND a BETWEEN 1 AND 6 GROUP BY 1,2"""),
    "page_flow_rate": (UVA, """, flow AS (SELECT * FROM (VALUES (1,2),(2,3),(3,4),(4,5),(5,6),(6,7)) t(a,b)),
den AS (SELECT page_id, count(*) n FROM uva WHERE page_id IN (1,2,3,4,5,6,7) GROUP BY 1),
pr AS (SELECT page_id a, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) b FROM uva),
num AS (SELECT a,b,count(*) jumps FROM pr JOIN flow USING(a,b) GROUP BY 1,2)
SELECT CAST(a AS VARCHAR)||'-'||CAST(b AS VARCHAR) page_flow, jumps, n AS page_views, CAST(jumps AS DOUBLE)/n AS rate
  FROM num JOIN den ON den.page_id=a"""),
    "page_flow_rate_no_tie": (UVA, """, flow AS (SELECT * FROM (VALUES (1,2),(2,3),(3,4),(4,5),(5,6),(6,7)) t(a,b)),
den AS (SELECT page_id, count(*) n FROM uva WHERE page_id IN (1,2,3,4,5,6,7) GROUP BY 1),
pr AS (SELECT page_id a, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, page_id) b FROM uva),
num AS (SELECT a,b,count(*) jumps FROM pr JOIN flow USING(a,b) GROUP BY 1,2)
SELECT CAST(a AS VARCHAR)||'-'||CAST(b AS VARCHAR) page_flow, jumps, n AS page_views, CAST(jumps AS DOUBLE)/n AS rate
  FROM num JOIN den ON den.page_id=a"""),
    "ad_click_times": (ADS, "SELECT event_id, ts_ms, strftime(make_timestamp(ts_ms*1000),'%Y-%m-%d %H:%M:%S') click_time FROM ads"),
    "ad_log_parse": (RAW, """SELECT CAST(f[1] AS BIGINT) ts_ms, f[2] province, f[3] city, f[4] userid, f[5] adid FROM (SELECT string_split(line,' ') f FROM raw) WHERE len(f)>=5"""),
    "ad_log_rejects": (RAW, "SELECT line FROM raw WHERE len(string_split(line,' '))<5"),
    "ad_user_day_clicks": (ADS, "SELECT dt, adid, userid, count(*) clicks FROM ads GROUP BY 1,2,3"),
    "ad_blacklist": (ADS, "SELECT DISTINCT userid FROM (SELECT userid FROM ads GROUP BY dt,adid,userid HAVING count(*)>=3)"),
    "ad_log_filtered": (ADS, "SELECT * FROM ads WHERE userid NOT IN (SELECT userid FROM ads GROUP BY dt,adid,userid HAVING count(*)>=3)"),
    "ad_admitted_clicks": (ADS, """, r AS (SELECT *, row_number() OVER (PARTITION BY dt,adid,userid ORDER BY ts_ms,event_id) rn FROM ads),
cut AS (SELECT userid, min(struct_pack(t:=ts_ms,e:=event_id)) m FROM r WHERE rn=3 GROUP BY 1)
SELECT r.dt, r.adid, r.userid, count(*) clicks FROM r LEFT JOIN cut USING(userid)
  WHERE m IS NULL OR ts_ms<m.t OR (ts_ms=m.t AND event_id<=m.e) GROUP BY 1,2,3"""),
    "ad_area_city_clicks": (ADS, "SELECT dt,province,city,adid,count(*) clicks FROM ads GROUP BY 1,2,3,4"),
    "ad_area_clicks": (ADS, "SELECT dt,province,adid,count(*) clicks FROM ads GROUP BY 1,2,3"),
    "ad_area_top3": (ADS, """SELECT dt,province,adid,clicks,rn FROM (SELECT *, CAST(row_number() OVER (PARTITION BY dt,province ORDER BY clicks DESC, adid) AS INTEGER) rn
  FROM (SELECT dt,province,adid,count(*) clicks FROM ads GROUP BY 1,2,3)) WHERE rn<=3"""),
    "ad_area_top3_json": (ADS, """, t AS (SELECT dt,province,adid,clicks,rn FROM (SELECT *, row_number() OVER (PARTITION BY dt,province ORDER BY clicks DESC, adid) rn
  FROM (SELECT dt,province,adid,count(*) clicks FROM ads GROUP BY 1,2,3)) WHERE rn<=3)
SELECT 'top3_ads_per_day:'||dt AS "key", province AS field,
  '{'||string_agg('"'||adid||'":'||CAST(clicks AS VARCHAR), ',' ORDER BY rn)||'}' AS value_json FROM t GROUP BY 1,2"""),
}

# Stream and sink queries must reproduce these batch results.
_SAME_AS = {
    "table_overwrite_roundtrip": "category_top10",
    "visits_clustered_in_range": "visits_in_range",
    "category_top10_appended": "category_top10_run",
    "stream_ad_segments_city_clicks": "ad_area_city_clicks",
    "stream_ad_log_parse": "ad_log_parse",
    "stream_ad_log_rejects": "ad_log_rejects",
    "stream_ad_blacklist": "ad_blacklist",
    "stream_ad_area_city_clicks": "ad_area_city_clicks",
    "stream_ad_area_city_clicks_incr": "ad_area_city_clicks",
    "stream_ad_area_top3": "ad_area_top3",
    "stream_ad_area_top3_json": "ad_area_top3_json",
}


def oracle_sql(keys=None) -> dict[str, str]:
    out = {k: prefix + body for k, (prefix, body) in _BODIES.items()}
    for k, base in _SAME_AS.items():
        out[k] = out[base]
    if keys is not None:
        out = {k: v for k, v in out.items() if k in keys}
    return out
