"""The registered queries as DuckDB SQL on the test tables, written apart from the Spark code."""

from __future__ import annotations

# The agents of the view.
_AGENTS = """[
  'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.124 Safari/537.36',
  'Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/14.1.1 Mobile/15E148 Safari/604.1',
  'Mozilla/5.0 (Windows NT 10.0; Trident/7.0; rv:11.0) like Gecko',
  'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/14.1 Safari/605.1.15',
  'Mozilla/5.0 (X11; Linux x86_64; rv:89.0) Gecko/20100101 Firefox/89.0',
  'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.124 Safari/537.36 Edg/91.0.864.59',
  'Mozilla/5.0 (Linux; Android 11; SM-G991B) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.120 Mobile Safari/537.36',
  'invalid-user-agent',
  'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.124 Safari/537.36 OPR/77.0.4054.172',
  'Mozilla/5.0 (Linux; Android 11; SM-G991B) AppleWebKit/537.36 (KHTML, like Gecko) SamsungBrowser/14.2 Chrome/87.0.4280.141 Mobile Safari/537.36',
  'Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) FxiOS/34.0 Mobile/15E148 Safari/605.1.15',
  'Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/91.0.4472.80 Mobile/15E148 Safari/604.1',
  'Mozilla/5.0 (Android 11; Mobile; rv:89.0) Gecko/89.0 Firefox/89.0',
  'Mozilla/5.0 (Linux; U; Android 10; en-US; RMX1825) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/78.0.3904.108 UCBrowser/13.4.0.1306 Mobile Safari/537.36',
  'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.4430.212 YaBrowser/21.5.3 Yowser/2.5 Safari/537.36',
  'Opera/9.80 (Android; Opera Mini/36.2.2254/119.132; U; en) Presto/2.12.423 Version/12.16',
  'Mozilla/5.0 (Linux; U; Android 4.0.3; en-us; GT-P5100) AppleWebKit/534.30 (KHTML, like Gecko) Version/4.0 Safari/534.30',
  'Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)',
  'Mozilla/5.0 (compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm)',
  'Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 [FBAN/FBIOS;FBAV/323.0.0.43.119]',
  'Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 Instagram 192.0.0.37.119',
  'Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148',
  'Mozilla/5.0 (Linux; Android 11; Pixel 4; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/91.0.4472.120 Mobile Safari/537.36',
  'Mozilla/5.0 (X11; CrOS x86_64 13904.55.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.147 Safari/537.36',
  'Mozilla/5.0 (Mobile; Windows Phone 8.1; Android 4.0; ARM; Trident/7.0; Touch; rv:11.0; IEMobile/11.0; NOKIA; Lumia 520) like iPhone OS 7_0_3 Mac OS X AppleWebKit/537 (KHTML, like Gecko) Mobile Safari/537',
  'Mozilla/5.0 (X11; Ubuntu; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.114 Safari/537.36 Vivaldi/4.0',
  'Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:89.0) Gecko/20100101 Firefox/89.0',
  'Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/87.0.4280.66 QQBrowser/10.7 Safari/537.36',
  NULL]"""

# Agents with versions, and the device that each was made for.
_VERSIONED_AGENTS = """(VALUES
  (0, 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/{v}.{w}.0.0 Safari/537.36', 'Chrome', '{v}.{w}', 'Windows', '10.0'),
  (1, 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_{w}) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/{v}.{w}.0.0 Safari/537.36', 'Chrome', '{v}.{w}', 'Mac OS X', '10.{w}'),
  (2, 'Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/{v}.{w}.0.0 Mobile Safari/537.36', 'Chrome Mobile', '{v}.{w}', 'Android', '1{w}'),
  (3, 'Mozilla/5.0 (Linux; Android 1{w}; Pixel 7; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/{v}.{w}.0.0 Mobile Safari/537.36', 'Chrome Mobile WebView', '{v}.{w}', 'Android', '1{w}'),
  (4, 'Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/{v}.{w}.0 Mobile/15E148 Safari/604.1', 'Chrome Mobile iOS', '{v}.{w}', 'iOS', '{v}.{w}'),
  (5, 'Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/{v}.{w} Mobile/15E148 Safari/604.1', 'Mobile Safari', '{v}.{w}', 'iOS', '{v}.{w}'),
  (6, 'Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148', 'Mobile Safari UI/WKWebView', NULL, 'iOS', '{v}.{w}'),
  (7, 'Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) FxiOS/{v}.{w} Mobile/15E148 Safari/605.1.15', 'Firefox iOS', '{v}.{w}', 'iOS', '{v}.{w}'),
  (8, 'Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) EdgiOS/{v}.{w}.0 Version/15.0 Mobile/15E148 Safari/604.1', 'Edge Mobile', '{v}.{w}', 'iOS', '{v}.{w}'),
  (9, 'Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) GSA/{v}.{w}.1 Mobile/15E148 Safari/604.1', 'Google', '{v}.{w}', 'iOS', '{v}.{w}'),
  (10, 'Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 Instagram {v}.{w}.0.1', 'Instagram', '{v}.{w}', 'iOS', '{v}.{w}'),
  (11, 'Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 [FBAN/FBIOS;FBAV/{v}.{w}.0.1]', 'Facebook', '{v}.{w}', 'iOS', '{v}.{w}'),
  (12, 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_{w}) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/{v}.{w} Safari/605.1.15', 'Safari', '{v}.{w}', 'Mac OS X', '10.{w}'),
  (13, 'Mozilla/5.0 (X11; Linux x86_64; rv:{v}.{w}) Gecko/20100101 Firefox/{v}.{w}', 'Firefox', '{v}.{w}', 'Linux', NULL),
  (14, 'Mozilla/5.0 (X11; Fedora; Linux x86_64; rv:{v}.{w}) Gecko/20100101 Firefox/{v}.{w}', 'Firefox', '{v}.{w}', 'Fedora', NULL),
  (15, 'Mozilla/5.0 (Android 1{w}; Mobile; rv:{v}.{w}) Gecko/{v}.{w} Firefox/{v}.{w}', 'Firefox Mobile', '{v}.{w}', 'Android', '1{w}'),
  (16, 'Mozilla/5.0 (Windows NT 6.1; rv:52.9) Gecko/20100101 PaleMoon/{v}.{w}.0', 'PaleMoon', '{v}.{w}', 'Windows', '6.1'),
  (17, 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 Safari/537.36 Edg/{v}.{w}.864.59', 'Edge', '{v}.{w}', 'Windows', '10.0'),
  (18, 'Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 Mobile Safari/537.36 EdgA/{v}.{w}.1', 'Edge Mobile', '{v}.{w}', 'Android', '1{w}'),
  (19, 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 Safari/537.36 OPR/{v}.{w}.4054.172', 'Opera', '{v}.{w}', 'Windows', '10.0'),
  (20, 'Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 Mobile Safari/537.36 OPR/{v}.{w}.1', 'Opera Mobile', '{v}.{w}', 'Android', '1{w}'),
  (21, 'Opera/9.80 (Android; Opera Mini/{v}.{w}.2254/119.132; U; en) Presto/2.12.423 Version/12.16', 'Opera Mini', '{v}.{w}', 'Android', NULL),
  (22, 'Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) SamsungBrowser/{v}.{w} Chrome/87.0.1.1 Mobile Safari/537.36', 'Samsung Internet', '{v}.{w}', 'Android', '1{w}'),
  (23, 'Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/78.0.1.1 UCBrowser/{v}.{w}.0.1306 Mobile Safari/537.36', 'UC Browser', '{v}.{w}', 'Android', '1{w}'),
  (24, 'Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/78.0.1.1 MiuiBrowser/{v}.{w}.1 Mobile Safari/537.36', 'MiuiBrowser', '{v}.{w}', 'Android', '1{w}'),
  (25, 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 YaBrowser/{v}.{w}.3 Safari/537.36', 'Yandex Browser', '{v}.{w}', 'Windows', '10.0'),
  (26, 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 Safari/537.36 Vivaldi/{v}.{w}', 'Vivaldi', '{v}.{w}', 'Windows', '10.0'),
  (27, 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/87.0.1.1 QQBrowser/{v}.{w} Safari/537.36', 'QQ Browser', '{v}.{w}', 'Windows', '10.0'),
  (28, 'Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) HeadlessChrome/{v}.{w}.1.1 Safari/537.36', 'HeadlessChrome', '{v}.{w}', 'Linux', NULL),
  (29, 'Mozilla/5.0 (X11; CrOS x86_64 {v}.{w}.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.1.1 Safari/537.36', 'Chrome', '91.0', 'Chrome OS', '{v}.{w}'),
  (30, 'Mozilla/5.0 (Windows NT 10.0; Trident/7.0; rv:{v}.{w}) like Gecko', 'IE', '{v}.{w}', 'Windows', '10.0'),
  (31, 'Mozilla/4.0 (compatible; MSIE {v}.{w}; Windows NT 5.1)', 'IE', '{v}.{w}', 'Windows', '5.1'),
  (32, 'Mozilla/5.0 (Mobile; Windows Phone 8.{w}; Android 4.0; Trident/7.0; IEMobile/{v}.{w}) like iPhone Gecko', 'IE Mobile', '{v}.{w}', 'Windows Phone', '8.{w}'),
  (33, 'Mozilla/5.0 (Linux; U; Android 4.{w}; en-us; GT-P5100) AppleWebKit/534.30 (KHTML, like Gecko) Version/4.0 Safari/534.30', 'Android', '4.{w}', 'Android', '4.{w}'),
  (34, 'Mozilla/5.0 (Mobile; Nokia 8110; rv:48.0) Gecko/48.0 Firefox/{v}.{w} KAIOS/2.{w}', 'Firefox Mobile', '{v}.{w}', 'KaiOS', '2.{w}'),
  (35, 'Mozilla/5.0 (SMART-TV; LINUX; Tizen {v}.{w}) AppleWebKit/537.36 (KHTML, like Gecko) Version/{v}.{w} TV Safari/537.36', 'Safari', '{v}.{w}', 'Tizen', '{v}.{w}'),
  (36, 'Mozilla/5.0 (compatible; Googlebot/{v}.{w}; +http://www.google.com/bot.html)', 'Googlebot', '{v}.{w}', 'Unknown', NULL),
  (37, 'Mozilla/5.0 (compatible; bingbot/{v}.{w}; +http://www.bing.com/bingbot.htm)', 'bingbot', '{v}.{w}', 'Unknown', NULL),
  (38, 'Googlebot-Image/{v}.{w}', 'Googlebot', '{v}.{w}', 'Unknown', NULL),
  (39, 'curl/{v}.{w}.0', 'curl', '{v}.{w}', 'Unknown', NULL),
  (40, 'python-requests/{v}.{w}.1', 'python-requests', '{v}.{w}', 'Unknown', NULL),
  (41, 'device {v} of no kind', 'Unknown', NULL, 'Unknown', NULL)
) t(n, agent, browser, browser_version, os, os_version)"""

_RAW_EVENTS = f"""
SELECT concat('evt-', CAST(e.event_id AS VARCHAR)) AS id,
  CASE e.event_type
    WHEN 'view' THEN 'view_product_detail'
    WHEN 'click' THEN CASE WHEN e.event_id % 2 = 0 THEN 'select_product_option'
      ELSE 'select_product_option_quality' END
    WHEN 'purchase' THEN CASE e.event_id % 3 WHEN 0 THEN 'product_detail_recommendation_visible'
      WHEN 1 THEN 'product_detail_recommendation_noticed'
      ELSE 'product_detail_recommendation_clicked' END
    WHEN 'signup' THEN 'checkout' END AS collection,
  e.time_stamp,
  CASE WHEN e.event_id % 50 = 0 THEN NULL WHEN e.event_id % 77 = 0 THEN 'n/a'
    ELSE CAST(pt.p_partkey AS VARCHAR) END AS product_id,
  CASE WHEN e.event_type = 'purchase' AND e.event_id % 4 <> 0
    THEN CAST(e.event_id * 17 % (SELECT count(*) FROM part) AS VARCHAR) END AS viewing_product_id,
  CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE CAST(e.user_id % 12 AS VARCHAR) END AS store_id,
  CASE WHEN e.event_id % 101 = 0 THEN '0.0.0.0' WHEN e.event_id % 103 = 0 THEN 'unknown'
    WHEN e.event_id % 107 = 0 THEN '' WHEN e.event_id % 109 = 0 THEN '999.1.2.3'
    ELSE concat_ws('.', CAST(1 + e.user_id * 37 % 223 AS VARCHAR),
      CAST(e.user_id * 91 % 256 AS VARCHAR), CAST(e.event_id % 256 AS VARCHAR), '7') END AS ip,
  CASE WHEN e.event_id % 89 <> 0 THEN {_AGENTS}[e.user_id % 29 + 1] END AS user_agent,
  CASE WHEN e.event_id % 10 = 0 THEN NULL ELSE p.url END AS referrer_url,
  concat('https://www.shop.',
    CASE e.user_id % 8 WHEN 0 THEN 'fr' WHEN 1 THEN 'de' WHEN 2 THEN 'es' WHEN 3 THEN 'co.uk'
      WHEN 4 THEN 'com' WHEN 5 THEN 'it' WHEN 6 THEN 'cl' ELSE 'com.au' END,
    CASE e.event_id % 5
      WHEN 0 THEN concat('/brand-', replace(lower(pt.p_name), ' ', '-'), '-sku', CAST(pt.p_partkey AS VARCHAR), '.html?alloy=white-375')
      WHEN 1 THEN concat('/', replace(lower(pt.p_name), ' ', '-'), '.html')
      WHEN 2 THEN concat('/', replace(lower(pt.p_name), ' ', '-'))
      WHEN 3 THEN concat('/', replace(lower(pt.p_name), ' ', '-'), '/')
      ELSE concat('/ring-18k?stone2=diamond-', CAST(e.event_id % 7 AS VARCHAR)) END) AS current_url
FROM (SELECT *, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS time_stamp FROM events
      UNION ALL
      SELECT *, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS time_stamp FROM events
      WHERE event_id % 20 = 0) e
JOIN part pt ON pt.p_partkey = e.event_id * 31 % (SELECT count(*) FROM part)
LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
"""

_GEO_RANGES = """
SELECT CAST(t.b * 1048576 + (t.b % 7) * 1000 AS BIGINT) AS ip_from,
  CAST((t.b + 1) * 1048576 - 1 AS BIGINT) AS ip_to,
  n.n_name AS country, r.r_name AS region, concat('city_', CAST(t.b % 101 AS VARCHAR)) AS city
FROM (SELECT range AS b FROM range(0, 4096)) t
JOIN nation n ON n.n_nationkey = t.b % 25
JOIN region r ON r.r_regionkey = n.n_regionkey
WHERE t.b % 16 <> 0
"""

_ALLOWED = """
('view_product_detail', 'select_product_option', 'select_product_option_quality',
 'product_detail_recommendation_visible', 'product_detail_recommendation_noticed',
 'product_detail_recommendation_clicked')
"""

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP_NUMBER = f"""
CASE WHEN regexp_full_match(ip, '{_OCTET}(\\.{_OCTET}){{3}}') THEN
  CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
  + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) END
"""

_EFFECTIVE = """
TRY_CAST(CASE WHEN starts_with(collection, 'product_detail_recommendation')
  THEN coalesce(viewing_product_id, product_id) ELSE product_id END AS INTEGER)
"""

# Families of browsers and systems, and the order in which they are told.
_BROWSER = """
CASE WHEN regexp_matches(user_agent, 'Googlebot') THEN 'Googlebot'
  WHEN regexp_matches(user_agent, '[bB]ingbot') THEN 'bingbot'
  WHEN regexp_matches(user_agent, 'FB(AN|AV)/') THEN 'Facebook'
  WHEN regexp_matches(user_agent, 'Instagram') THEN 'Instagram'
  WHEN regexp_matches(user_agent, 'Edg(e|A|iOS)?/') THEN 'Edge'
  WHEN regexp_matches(user_agent, 'IEMobile/') THEN 'IE Mobile'
  WHEN regexp_matches(user_agent, 'Trident/|MSIE ') THEN 'IE'
  WHEN regexp_matches(user_agent, 'Opera Mini/') THEN 'Opera Mini'
  WHEN regexp_matches(user_agent, 'OPR/|Opera/') THEN 'Opera'
  WHEN regexp_matches(user_agent, 'SamsungBrowser/') THEN 'Samsung Internet'
  WHEN regexp_matches(user_agent, 'UCBrowser/') THEN 'UC Browser'
  WHEN regexp_matches(user_agent, 'YaBrowser/') THEN 'Yandex Browser'
  WHEN regexp_matches(user_agent, 'Vivaldi/') THEN 'Vivaldi'
  WHEN regexp_matches(user_agent, 'QQBrowser/') THEN 'QQ Browser'
  WHEN regexp_matches(user_agent, 'FxiOS/') THEN 'Firefox iOS'
  WHEN regexp_matches(user_agent, 'Mobile;.*Firefox/|Tablet;.*Firefox/') THEN 'Firefox Mobile'
  WHEN regexp_matches(user_agent, 'Firefox/') THEN 'Firefox'
  WHEN regexp_matches(user_agent, 'CriOS/') THEN 'Chrome Mobile iOS'
  WHEN regexp_matches(user_agent, '; wv\\).*Chrome/') THEN 'Chrome Mobile WebView'
  WHEN regexp_matches(user_agent, 'Chrome/.*Mobile') THEN 'Chrome Mobile'
  WHEN regexp_matches(user_agent, 'Chrome/') THEN 'Chrome'
  WHEN regexp_matches(user_agent, 'Android.*Safari/') THEN 'Android'
  WHEN regexp_matches(user_agent, '(iPhone|iPad|iPod).*Safari/') THEN 'Mobile Safari'
  WHEN regexp_matches(user_agent, '(iPhone|iPad|iPod).*AppleWebKit/')
    THEN 'Mobile Safari UI/WKWebView'
  WHEN regexp_matches(user_agent, 'Safari/') THEN 'Safari' ELSE 'Unknown' END
"""

_OS = """
CASE WHEN regexp_matches(user_agent, 'Windows Phone') THEN 'Windows Phone'
  WHEN regexp_matches(user_agent, 'Windows') THEN 'Windows'
  WHEN regexp_matches(user_agent, 'iPhone|iPad|iPod') THEN 'iOS'
  WHEN regexp_matches(user_agent, 'Android') THEN 'Android'
  WHEN regexp_matches(user_agent, 'CrOS') THEN 'Chrome OS'
  WHEN regexp_matches(user_agent, 'Mac OS X') THEN 'Mac OS X'
  WHEN regexp_matches(user_agent, 'Ubuntu') THEN 'Ubuntu'
  WHEN regexp_matches(user_agent, 'Linux') THEN 'Linux' ELSE 'Unknown' END
"""

# Fixed value: what a product name is cut from.
_RUNS = "([\\p{Lu}\\p{Ll}\\p{Lt}]+|[^\\p{Lu}\\p{Ll}\\p{Lt}]+)"
_PART = "regexp_extract(current_url, '(?:brand-)?([^/?]+?)(?:-sku|\\.html|$)', 1)"
_PRODUCT_NAME = f"""
CASE WHEN coalesce({_PART}, '') = '' THEN 'Unknown' ELSE
  array_to_string(list_transform(regexp_extract_all(replace({_PART}, '-', ' '), '{_RUNS}', 1),
    lambda v: upper(v[1]) || lower(v[2:])), '') END
"""

_TLD = "regexp_extract(current_url, '^https?://([^/]+)', 1)"
_DOMAIN = f"nullif(regexp_extract({_TLD}, '\\.([a-z][a-z])$', 1), '')"

_HOUR = "date_trunc('hour', make_timestamp(time_stamp * 1000000))"
_TIME_ID = f"CAST(strftime({_HOUR}, '%Y%m%d%H') AS BIGINT)"

_TIME_COLUMNS = """
  CAST(extract('hour' FROM h) AS INTEGER) AS hour,
  CAST(dayofweek(h) + 1 AS INTEGER) AS day_of_week,
  dayofweek(h) IN (0, 6) AS is_weekend,
  CAST(day(h) AS INTEGER) AS day_of_month,
  CAST(dayofyear(h) AS INTEGER) AS day_of_year,
  CAST(ceil(day(h) / 7.0) AS INTEGER) AS week_of_month,
  CAST(weekofyear(h) AS INTEGER) AS week_of_year,
  CAST(month(h) AS INTEGER) AS month_of_year,
  CAST(quarter(h) AS INTEGER) AS quarter,
  CAST(year(h) AS INTEGER) AS year
"""

# Views in order; each may use those before it.
_VIEWS: dict[str, str] = {
    "raw_events": _RAW_EVENTS,
    "geo_ranges": _GEO_RANGES,
    # An address is made from its parts, and the range that holds them known by number.
    "mixed_addresses": """
        SELECT 'evt-' || event_id AS event_id, CASE WHEN event_id % 101 = 0 THEN '2a00:1:2'
            WHEN event_id % 103 = 0 THEN '2a00::1::2'
            WHEN way = 0 THEN upper(head || '::' || own) WHEN way = 1 THEN
              lpad(a, 4, '0') || ':' || lpad(b, 4, '0') || ':' || lpad(c, 4, '0') || ':0000:0000:0000:0000:' || lpad(own, 4, '0')
            WHEN way = 2 THEN head || '::' || own || '%eth0' WHEN way = 3 THEN head || '::1.2.3.' || event_id % 256
            WHEN way = 4 THEN head || '::' || own WHEN way = 5 THEN '::ffff:' || dotted ELSE dotted END AS ip,
          CASE WHEN event_id % 101 <> 0 AND event_id % 103 <> 0 AND way > 4 THEN four END AS four,
          CASE WHEN event_id % 101 <> 0 AND event_id % 103 <> 0 AND way < 5 THEN CASE block % 4
            WHEN 0 THEN block * 1024
            WHEN 1 THEN CASE WHEN second // 4096 % 5 <> 4 THEN block * 1024 + second // 4096 END
            WHEN 2 THEN CASE WHEN second // 256 % 7 <> 6 THEN block * 1024 + second // 256 END
            ELSE CASE WHEN event_id % 16 % 4 <> 3 THEN block * 1024 + second * 16 + event_id % 16 END
            END END AS number
        FROM (SELECT *, a || ':' || b || ':' || c AS head FROM (
          SELECT event_id, event_id % 10 AS way, user_id % 64 AS block, second, lower(hex(user_id % 64 + 10752)) AS a,
            lower(hex(second)) AS b, lower(hex(event_id % 16)) AS c, lower(hex(event_id % 65536)) AS own,
            concat_ws('.', user_id * 37 % 223 + 1, user_id * 91 % 256, event_id % 256, 7) AS dotted,
            (user_id * 37 % 223 + 1) * 16777216 + user_id * 91 % 256 * 65536 + event_id % 256 * 256 + 7 AS four
          FROM (SELECT *, CASE WHEN user_id % 4 = 3 THEN user_id * 37 % 64 ELSE user_id * 37 % 65536 END AS second
            FROM events)))""",
    "accepted": f"SELECT * FROM raw_events WHERE collection IN {_ALLOWED} AND id IS NOT NULL",
    "numbered": f"SELECT *, CASE WHEN ip NOT IN ('', 'unknown', '0.0.0.0') THEN {_IP_NUMBER} END AS ip_num FROM accepted",
    "located": """
        SELECT a.*, coalesce(g.city, 'Unknown') AS city, coalesce(g.region, 'Unknown') AS region,
          coalesce(g.country, 'Unknown') AS country
        FROM numbered a LEFT JOIN geo_ranges g ON a.ip_num BETWEEN g.ip_from AND g.ip_to""",
    "enriched": f"""
        SELECT id AS event_id, collection AS event_type, time_stamp, {_HOUR} AS hour_start,
          CAST({_HOUR} AS DATE) AS event_date, {_TIME_ID} AS time_id,
          {_EFFECTIVE} AS effective_product_id, current_url, {_DOMAIN} AS domain_country,
          TRY_CAST(store_id AS INTEGER) AS store_id, 'store_' || store_id AS store_name,
          city, region, country, md5(city || region || country) AS location_id,
          referrer_url, md5(referrer_url) AS referrer_url_id,
          {_BROWSER} AS browser, md5({_BROWSER}) AS browser_id, {_OS} AS os, md5({_OS}) AS os_id
        FROM located""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY time_stamp NULLS LAST,
          event_type, effective_product_id, store_id, location_id, referrer_url_id) AS copy
        FROM enriched""",
    "fact": """
        SELECT event_id, event_type, time_id, effective_product_id AS product_id, store_id,
          location_id, referrer_url_id, browser_id, os_id, event_date, domain_country,
          browser, os, country
        FROM ranked WHERE copy = 1""",
    "dim_time": f"""
        SELECT DISTINCT {_TIME_ID} AS time_id, {_HOUR} AS "timestamp", {_TIME_COLUMNS}
        FROM (SELECT *, {_HOUR} AS h FROM accepted) WHERE time_stamp IS NOT NULL""",
    "dim_product": f"""
        SELECT product_id, {_PRODUCT_NAME} AS product_name
        FROM (SELECT effective_product_id AS product_id, current_url,
            row_number() OVER (PARTITION BY effective_product_id
              ORDER BY time_stamp NULLS LAST, event_id, current_url) AS n FROM enriched
          WHERE effective_product_id IS NOT NULL)
        WHERE n = 1""",
    "dim_location": "SELECT DISTINCT location_id, city, region, country FROM enriched",
    "dim_store": """
        SELECT store_id, store_name
        FROM (SELECT store_id, store_name, row_number() OVER (PARTITION BY store_id
            ORDER BY time_stamp NULLS LAST, store_name) AS n FROM enriched
          WHERE store_id IS NOT NULL)
        WHERE n = 1""",
    "dim_referrer_url": """
        SELECT DISTINCT referrer_url_id, referrer_url FROM enriched
        WHERE referrer_url IS NOT NULL""",
    "dim_browser": "SELECT DISTINCT browser_id, browser FROM enriched",
    "dim_os": "SELECT DISTINCT os_id, os FROM enriched",
    "message_log": """
        SELECT event_type AS topic, CAST(user_id % 3 AS INT) AS partition_id,
          CAST(row_number() OVER (PARTITION BY event_type, user_id % 3 ORDER BY ts, event_id) - 1
            AS BIGINT) AS log_offset,
          CAST(1704067200 + floor((epoch_us(ts) - 1704067200000000) / 720000000) AS BIGINT) AS ts_sec
        FROM events""",
    "group_commits": """
        SELECT g.group_id, m.topic, m.partition_id, m.log_offset + 1 AS committed_offset,
          m.ts_sec + 5 AS commit_sec
        FROM message_log m
        JOIN (SELECT 'g0' AS group_id, 99 AS skip UNION ALL SELECT 'g1', 2) g
          ON m.partition_id <> g.skip
        WHERE m.log_offset % 10 = 9""",
    "metric_samples": """
        SELECT s.event_id AS sample_id, 'worker' AS job, CAST(s.user_id % 4 AS VARCHAR) AS instance,
          m.metric, CASE WHEN s.event_id % 2 = 0 THEN 'heap' ELSE 'nonheap' END AS area, s.ts_sec,
          s.ts_sec - s.ts_sec % 60 AS minute_start,
          CAST(CASE m.metric WHEN 'cpu_halfseconds_total' THEN s.rn % 200
            WHEN 'memory_used' THEN round(s.value * 100) ELSE 30000 END AS BIGINT) AS value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) AS rn,
            CAST(1704067200 + floor((epoch_us(ts) - 1704067200000000) / 720000000) AS BIGINT) AS ts_sec
          FROM events) s
        CROSS JOIN (SELECT 'cpu_halfseconds_total' AS metric UNION ALL SELECT 'memory_used'
          UNION ALL SELECT 'memory_max') m""",
    "gauges": """
        SELECT job, metric, minute_start, CAST(sum(value) AS BIGINT) AS total
        FROM (SELECT *, row_number() OVER (PARTITION BY job, instance, metric, area, minute_start
            ORDER BY ts_sec DESC, sample_id DESC) AS n FROM metric_samples)
        WHERE n = 1 GROUP BY job, metric, minute_start""",
    "canary_sent": """
        SELECT concat('m-', CAST(event_id AS VARCHAR)) AS message_id,
          CAST(epoch_us(ts) // 1000000 AS BIGINT) AS sent_sec
        FROM events WHERE event_type = 'signup'""",
    "canary_received": """
        SELECT concat(CASE WHEN event_type = 'signup' THEN 'm-' ELSE 'x-' END,
            CAST(event_id AS VARCHAR)) AS message_id,
          CAST(epoch_us(ts) // 1000000 AS BIGINT) + event_id % 15 AS recv_sec
        FROM events WHERE event_type IN ('signup', 'error') AND event_id % 13 <> 0""",
}

_FACT_COLUMNS = """event_id, event_type, time_id, product_id, store_id, location_id,
  referrer_url_id, browser_id, os_id"""
_EVENT_COLUMNS = """id, collection, time_stamp, product_id, viewing_product_id, store_id, ip,
  user_agent, referrer_url, current_url"""
_DAY = "event_date = DATE '2024-01-15'"


def _table_rows(table: str, key: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, 'rows' AS check_name, count(*) AS n FROM {table}
        UNION ALL SELECT '{table}', 'null_keys', count(*) - count({key}) FROM {table}
        UNION ALL SELECT '{table}', 'duplicate_keys', count({key}) - count(DISTINCT {key}) FROM {table}"""


def _orphans(dim: str, key: str) -> str:
    return f"""
        SELECT 'fact_view_event' AS table_name, 'orphan_{key}' AS check_name, count(*) AS n
        FROM fact f WHERE f.{key} IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})"""


_DIM_KEYS = {
    "dim_time": "time_id",
    "dim_product": "product_id",
    "dim_location": "location_id",
    "dim_store": "store_id",
    "dim_referrer_url": "referrer_url_id",
    "dim_browser": "browser_id",
    "dim_os": "os_id",
}

_AUDIT = " UNION ALL ".join(
    [_table_rows(dim, key) for dim, key in _DIM_KEYS.items()]
    + [_table_rows("fact", "event_id").replace("'fact'", "'fact_view_event'")]
    + [_orphans(dim, key) for dim, key in _DIM_KEYS.items()]
)

_STORED_COLUMNS = {
    "dim_time": "time_id:bigint,timestamp:timestamp_ntz,hour:int,day_of_week:int,is_weekend:boolean,day_of_month:int,day_of_year:int,week_of_month:int,week_of_year:int,month_of_year:int,quarter:int,year:int",
    "dim_product": "product_id:int,product_name:string",
    "dim_location": "location_id:string,city:string,region:string,country:string",
    "dim_store": "store_id:int,store_name:string",
    "dim_referrer_url": "referrer_url_id:string,referrer_url:string",
    "dim_browser": "browser_id:string,browser:string",
    "dim_os": "os_id:string,os:string",
    "fact_view_event": "event_id:string,event_type:string,time_id:bigint,product_id:int,store_id:int,location_id:string,referrer_url_id:string,browser_id:string,os_id:string",
}

_SCHEMA_ROWS = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{columns}' AS columns, count(*) AS n_rows"
    f" FROM {'fact' if table == 'fact_view_event' else table}"
    for table, columns in _STORED_COLUMNS.items()
)

_DIM_ROWS = " UNION ALL ".join(
    f"SELECT '{dim}' AS table_name, CAST({key} AS VARCHAR) AS key, {label} AS label FROM {dim}"
    for dim, key, label in [
        ("dim_time", "time_id", "strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S')"),
        ("dim_product", "product_id", "product_name"),
        ("dim_location", "location_id", "concat_ws('/', country, region, city)"),
        ("dim_store", "store_id", "store_name"),
        ("dim_referrer_url", "referrer_url_id", "referrer_url"),
        ("dim_browser", "browser_id", "browser"),
        ("dim_os", "os_id", "os"),
    ]
)

_ROLLUP_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS rollup, time_id, {keys} AS keys, count(*) AS views FROM fact GROUP BY 1, 2, 3"
    for name, keys in {
        "product": "coalesce(CAST(product_id AS VARCHAR), '-')",
        "place_store": "location_id || '/' || coalesce(CAST(store_id AS VARCHAR), '-')",
        "referrer": "coalesce(referrer_url_id, '-')",
        "device": "browser_id || '/' || os_id",
        "domain_store": "coalesce(domain_country, '-') || '/' || coalesce(CAST(store_id AS VARCHAR), '-')",
    }.items()
)

_SELECTS: dict[str, str] = {
    # Sources and sinks
    "src_stream_json": f"SELECT {_EVENT_COLUMNS} FROM raw_events",
    "parse_events": f"SELECT {_EVENT_COLUMNS} FROM raw_events",
    "intake_counts": f"""
        SELECT CASE WHEN collection IS NULL THEN 'no_collection'
            WHEN collection NOT IN {_ALLOWED} THEN 'not_allowed' ELSE 'accepted' END AS fate,
          count(*) AS messages
        FROM raw_events GROUP BY 1
        UNION ALL SELECT 'canary', count(*) FROM canary_sent HAVING count(*) > 0""",
    "canary_messages": """
        SELECT message_id, 'heartbeat' AS message, make_timestamp(sent_sec * 1000000) AS "timestamp",
          'canary' AS type
        FROM canary_sent""",
    "relay_stream": f"SELECT {_EVENT_COLUMNS} FROM raw_events",
    "stream_star_fact": f"SELECT {_FACT_COLUMNS} FROM fact",
    "stream_star_dims": _DIM_ROWS,
    "stream_star_merged": f"SELECT {_FACT_COLUMNS} FROM fact",
    "stream_rollups": _ROLLUP_ROWS,
    "stream_resume": f"SELECT {_FACT_COLUMNS} FROM fact",
    "stream_dedup_events": "SELECT event_id, event_type, time_id FROM fact",
    "stream_hourly_counts": """
        SELECT time_id, browser, os, count(*) AS views FROM fact GROUP BY time_id, browser, os""",
    "stream_product_counts": """
        SELECT time_id, product_id, count(*) AS views FROM fact GROUP BY time_id, product_id""",
    "sink_insert_if_absent": "SELECT store_id, store_name FROM dim_store",
    "warehouse_schema": _SCHEMA_ROWS,
    "geo_ranges": """
        SELECT g.ip_from, g.ip_to, g.country, g.region, g.city, count(a.id) AS views
        FROM geo_ranges g LEFT JOIN numbered a ON a.ip_num BETWEEN g.ip_from AND g.ip_to
        GROUP BY ALL""",
    # Projections and predicates
    "filter_allowed": f"SELECT id, collection FROM raw_events WHERE collection IN {_ALLOWED}",
    "split_recommendation": """
        SELECT id, starts_with(collection, 'product_detail_recommendation') AS is_recommendation
        FROM raw_events""",
    "harmonize_columns": """
        SELECT id, product_id, viewing_product_id, CAST(NULL AS VARCHAR) AS email FROM raw_events""",
    "cast_ids": """
        SELECT id, TRY_CAST(product_id AS INTEGER) AS product_id,
          TRY_CAST(store_id AS INTEGER) AS store_id FROM raw_events""",
    "effective_product_id": f"SELECT id AS event_id, {_EFFECTIVE} AS product_id FROM raw_events",
    "union_branches": f"""
        SELECT id AS event_id, collection AS event_type, {_EFFECTIVE} AS product_id FROM accepted""",
    # Scalars
    "time_parts": f"""
        SELECT id AS event_id, {_TIME_ID} AS time_id, h AS "timestamp", {_TIME_COLUMNS}
        FROM (SELECT *, {_HOUR} AS h FROM accepted)""",
    "hash_keys": """
        SELECT event_id, location_id, referrer_url_id, browser_id, os_id FROM enriched""",
    "product_name": f"SELECT id AS event_id, {_PRODUCT_NAME} AS product_name FROM raw_events",
    "browser_family": f"SELECT id AS event_id, {_BROWSER} AS browser FROM raw_events",
    "os_family": f"SELECT id AS event_id, {_OS} AS os FROM raw_events",
    "device_families": f"""
        SELECT concat('evt-', CAST(e.event_id AS VARCHAR)) AS event_id,
          coalesce(t.browser, 'Unknown') AS browser,
          replace(replace(t.browser_version, '{{v}}', e.v), '{{w}}', e.w) AS browser_version,
          coalesce(t.os, 'Unknown') AS os,
          replace(replace(t.os_version, '{{v}}', e.v), '{{w}}', e.w) AS os_version
        FROM (SELECT *, CAST(user_id % 60 + 40 AS VARCHAR) AS v, CAST(event_id % 10 AS VARCHAR) AS w
          FROM events) e
        LEFT JOIN {_VERSIONED_AGENTS} ON t.n = e.event_id % 42 AND e.event_id % 41 <> 0""",
    "domain_suffixes": """
        SELECT 'evt-' || event_id AS event_id, 'https://shop' || user_id || '.' || suffix || '/a.b/c.fr' AS url,
          code AS domain_country, name AS country
        FROM events JOIN (VALUES (0, 'fr', 'fr', 'France'), (1, 'co.uk', 'uk', 'United Kingdom'),
          (2, 'com', NULL, NULL), (3, 'eu', NULL, NULL), (4, 'io', 'io', 'British Indian Ocean Territory'),
          (5, 'uk', 'uk', 'United Kingdom'), (6, 'uk.com', 'uk', 'United Kingdom'), (7, 'zz', NULL, NULL),
          (8, 'com.au', 'au', 'Australia'), (9, 'de.com', 'de', 'Germany'), (10, 'eu.int', NULL, NULL),
          (11, 'GB', 'gb', 'United Kingdom'), (12, 'de', 'de', 'Germany'), (13, 'notuk.com', NULL, NULL)
        ) s(n, suffix, code, name) ON s.n = event_id % 14""",
    "ip_geolocate_any": """
        SELECT event_id, ip, coalesce(g.country, n.n_name, 'Unknown') AS country,
          coalesce(g.region, r.r_name, 'Unknown') AS region,
          coalesce(g.city, CASE WHEN n.n_name IS NOT NULL THEN 'city6_' || number END, 'Unknown') AS city
        FROM mixed_addresses a
        LEFT JOIN geo_ranges g ON a.four BETWEEN g.ip_from AND g.ip_to
        LEFT JOIN nation n ON n.n_nationkey = a.number % 25
        LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "ip_geolocate": "SELECT id AS event_id, ip, country, region, city FROM located",
    "ip_to_long": f"SELECT id AS event_id, ip, {_IP_NUMBER} AS ip_number FROM raw_events",
    "domain_country": f"""
        SELECT id AS event_id, regexp_extract({_TLD}, '\\.([a-z]+)$', 1) AS domain_label,
          {_DOMAIN} AS domain_country FROM raw_events""",
    "domain_country_name": f"""
        SELECT id AS event_id, CASE {_DOMAIN} WHEN 'fr' THEN 'France' WHEN 'de' THEN 'Germany'
          WHEN 'es' THEN 'Spain' WHEN 'uk' THEN 'United Kingdom' WHEN 'it' THEN 'Italy'
          WHEN 'cl' THEN 'Chile' WHEN 'au' THEN 'Australia' END AS country
        FROM raw_events""",
    # Star schema
    "dim_time": "SELECT * FROM dim_time",
    "dim_product": "SELECT * FROM dim_product",
    "dim_location": "SELECT * FROM dim_location",
    "dim_store": "SELECT * FROM dim_store",
    "dim_referrer_url": "SELECT * FROM dim_referrer_url",
    "dim_browser": "SELECT * FROM dim_browser",
    "dim_os": "SELECT * FROM dim_os",
    "fact_view_event": f"SELECT {_FACT_COLUMNS} FROM fact",
    "earliest_event_per_product": f"""
        SELECT {_FACT_COLUMNS.replace('product_id', 'effective_product_id AS product_id')}
        FROM (SELECT *, row_number() OVER (PARTITION BY effective_product_id
            ORDER BY time_stamp NULLS LAST, event_id) AS n FROM enriched
          WHERE effective_product_id IS NOT NULL)
        WHERE n = 1""",
    "star_join": f"""
        SELECT f.event_id, f.event_type, f.time_id, f.product_id, f.store_id, f.location_id,
          f.referrer_url_id, f.browser_id, f.os_id, t.* EXCLUDE (time_id), s.store_name,
          l.city, l.region, l.country, b.browser, o.os, p.product_name, r.referrer_url
        FROM fact f LEFT JOIN dim_time t ON t.time_id = f.time_id
        LEFT JOIN dim_store s ON s.store_id = f.store_id
        LEFT JOIN dim_location l ON l.location_id = f.location_id
        LEFT JOIN dim_browser b ON b.browser_id = f.browser_id
        LEFT JOIN dim_os o ON o.os_id = f.os_id
        LEFT JOIN dim_product p ON p.product_id = f.product_id
        LEFT JOIN dim_referrer_url r ON r.referrer_url_id = f.referrer_url_id""",
    "audit_star": _AUDIT,
    # KPIs
    "kpi_top_products": f"""
        SELECT product_id, count(*) AS views FROM fact WHERE {_DAY} AND product_id IS NOT NULL
        GROUP BY product_id ORDER BY views DESC, product_id LIMIT 10""",
    "kpi_top_countries_domain": f"""
        SELECT domain_country, count(*) AS views FROM fact
        WHERE {_DAY} AND domain_country IS NOT NULL
        GROUP BY domain_country ORDER BY views DESC, domain_country LIMIT 10""",
    "kpi_top_countries_ip": f"""
        SELECT country, count(*) AS views FROM fact WHERE {_DAY}
        GROUP BY country ORDER BY views DESC, country LIMIT 10""",
    "kpi_top_referrers": f"""
        SELECT r.referrer_url, c.views
        FROM (SELECT referrer_url_id, count(*) AS views FROM fact
          WHERE {_DAY} AND referrer_url_id IS NOT NULL GROUP BY referrer_url_id
          ORDER BY views DESC, referrer_url_id LIMIT 5) c
        JOIN dim_referrer_url r ON r.referrer_url_id = c.referrer_url_id""",
    "kpi_stores_by_country": """
        SELECT store_id, count(*) AS views FROM fact
        WHERE store_id IS NOT NULL AND country = (SELECT country FROM fact
          WHERE country <> 'Unknown' GROUP BY country ORDER BY count(*) DESC, country LIMIT 1)
        GROUP BY store_id""",
    "kpi_stores_by_domain_country": """
        SELECT store_id, count(*) AS views FROM fact
        WHERE domain_country = 'cl' AND store_id IS NOT NULL GROUP BY store_id""",
    "kpi_product_hourly": f"""
        SELECT CAST(s.hour AS INTEGER) AS hour, count(f.event_id) AS views
        FROM (SELECT range AS hour FROM range(0, 24)) s
        LEFT JOIN (SELECT * FROM fact WHERE {_DAY} AND product_id = (SELECT product_id FROM fact
            WHERE {_DAY} GROUP BY product_id HAVING product_id IS NOT NULL
            ORDER BY count(*) DESC, product_id LIMIT 1)) f
          ON f.time_id % 100 = s.hour GROUP BY s.hour""",
    "kpi_hourly_browser_os": f"""
        SELECT CAST(time_id % 100 AS INTEGER) AS hour, browser, os, count(*) AS views
        FROM fact WHERE {_DAY} GROUP BY ALL""",
    "kpi_hourly_browser_os_sets": f"""
        SELECT hour, browser, os, count(*) AS views
        FROM (SELECT CAST(time_id % 100 AS INTEGER) AS hour, browser, os FROM fact WHERE {_DAY})
        GROUP BY GROUPING SETS ((hour, browser), (hour, os), (hour, browser, os))""",
    # Stream health
    "ops_rate_per_sec": """
        SELECT topic, ts_sec - ts_sec % 60 AS minute_start,
          CAST(count(*) AS DOUBLE) / 60 AS per_second
        FROM message_log GROUP BY ALL""",
    "ops_rate_per_min": """
        SELECT topic, minute_start - w.back * 60 AS window_start,
          CAST(count(*) AS DOUBLE) / 5 AS per_minute
        FROM (SELECT topic, ts_sec - ts_sec % 60 AS minute_start FROM message_log)
        CROSS JOIN (SELECT range AS back FROM range(0, 5)) w GROUP BY ALL""",
    "ops_consumer_lag": """
        SELECT c.group_id, c.topic, CAST(sum(e.log_end - c.committed) AS BIGINT) AS lag
        FROM (SELECT group_id, topic, partition_id, max(committed_offset) AS committed
          FROM group_commits GROUP BY ALL) c
        JOIN (SELECT topic, partition_id, max(log_offset) + 1 AS log_end
          FROM message_log GROUP BY ALL) e
          ON e.topic = c.topic AND e.partition_id = c.partition_id
        GROUP BY c.group_id, c.topic""",
    "ops_consume_rate": """
        SELECT group_id, topic, minute_start, CAST(sum(moved) AS DOUBLE) / 60 AS per_second
        FROM (SELECT group_id, topic, commit_sec - commit_sec % 60 AS minute_start,
            coalesce(committed_offset - lag(committed_offset) OVER (PARTITION BY group_id, topic,
              partition_id ORDER BY commit_sec, committed_offset), 0) AS moved
          FROM group_commits)
        GROUP BY group_id, topic, minute_start""",
    "ops_partitions": """
        SELECT topic, count(DISTINCT partition_id) AS partitions FROM message_log GROUP BY topic""",
    "ops_counter_rate": """
        SELECT job, instance, minute_start, CAST(sum(CASE WHEN before IS NULL THEN 0
            WHEN value < before THEN value ELSE value - before END) AS DOUBLE) / 60 AS per_second
        FROM (SELECT *, lag(value) OVER (PARTITION BY job, instance, metric, area
            ORDER BY ts_sec, sample_id) AS before FROM metric_samples
          WHERE metric = 'cpu_halfseconds_total')
        GROUP BY job, instance, minute_start""",
    "ops_gauge_sum": """
        SELECT * FROM gauges WHERE metric IN ('memory_used', 'memory_max')""",
    "ops_threshold_alert": """
        SELECT job, minute_start, usage
        FROM (SELECT job, minute_start, CASE WHEN had = 0 THEN 0.0 ELSE
            CAST(used AS DOUBLE) / had END AS usage
          FROM (SELECT job, minute_start,
              sum(total) FILTER (WHERE metric = 'memory_used') AS used,
              sum(total) FILTER (WHERE metric = 'memory_max') AS had
            FROM gauges GROUP BY job, minute_start))
        WHERE usage > 0.2""",
    "canary_roundtrip": """
        SELECT s.message_id, CASE WHEN r.recv_sec IS NULL THEN 'MISSING'
            WHEN r.recv_sec - s.sent_sec <= 10 THEN 'OK' ELSE 'LATE' END AS status,
          r.recv_sec - s.sent_sec AS latency_sec
        FROM canary_sent s LEFT JOIN canary_received r ON r.message_id = s.message_id""",
}


def _uses(sql: str, view: str) -> bool:
    import re

    return re.search(rf"\b(FROM|JOIN)\s+{view}\b", sql) is not None


def _with_views(select: str) -> str:
    """The select with the views it needs, and only those, in front."""
    needed: dict[str, str] = {}
    pending = select
    for view, sql in reversed(_VIEWS.items()):
        if _uses(pending, view):
            needed[view] = sql
            pending += " " + sql
    heads = [f"{view} AS ({sql})" for view, sql in reversed(needed.items())]
    return f"WITH {', '.join(heads)} {select}" if heads else select


# Reports on a stored warehouse or its counts, and queries by their other plan: the same rows.
_SAME_ROWS = {
    "stored_top_products": "kpi_top_products",
    "stored_top_countries_ip": "kpi_top_countries_ip",
    "stored_top_referrers": "kpi_top_referrers",
    "stored_stores_by_country": "kpi_stores_by_country",
    "stored_product_hourly": "kpi_product_hourly",
    "stored_hourly_browser_os": "kpi_hourly_browser_os",
    "stored_top_countries_domain": "kpi_top_countries_domain",
    "stored_stores_by_domain_country": "kpi_stores_by_domain_country",
    "stored_hourly_browser_os_sets": "kpi_hourly_browser_os_sets",
    "rollup_top_products": "kpi_top_products",
    "rollup_top_countries_ip": "kpi_top_countries_ip",
    "rollup_top_referrers": "kpi_top_referrers",
    "rollup_stores_by_country": "kpi_stores_by_country",
    "rollup_product_hourly": "kpi_product_hourly",
    "rollup_hourly_browser_os": "kpi_hourly_browser_os",
    "stream_rate_per_sec": "ops_rate_per_sec",
    "stream_rate_per_min": "ops_rate_per_min",
    "ip_geolocate_large": "ip_geolocate",
    "ip_geolocate_any_large": "ip_geolocate_any",
}


def oracle_sql() -> dict[str, str]:
    selects = _SELECTS | {name: _SELECTS[same] for name, same in _SAME_ROWS.items()}
    return {name: _with_views(select) for name, select in selects.items()}
