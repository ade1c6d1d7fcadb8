"""DuckDB SQL that computes each registered query independently from the same tables."""

from __future__ import annotations

# The shapes of ``shapes.py`` as common table expressions.
EV = """
ev AS (
  SELECT event_id, ts AS timestamp,
         user_id * 1000 + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 3 AS session_id,
         CASE WHEN k % 3 <> 0 THEN user_id END AS user_id,
         'fp_' || substr(md5(CAST(user_id % 100 AS VARCHAR)), 1, 8) AS device_fingerprint,
         CASE WHEN k % 11 <> 0 THEN user_id % 50 END AS ip_bucket,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'click'
              WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'checkout'
              WHEN 'purchase' THEN 'conversion' END AS event_type,
         CASE k % 7 WHEN 0 THEN 'google' WHEN 1 THEN 'direct' WHEN 2 THEN 'facebook'
              WHEN 3 THEN 'email' WHEN 4 THEN 'affiliate' WHEN 5 THEN 'organic'
              ELSE CASE WHEN event_id % 2 = 0 THEN 'bing' END END AS referrer,
         value, user_id AS true_user_id
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
),
pre AS (SELECT * FROM ev WHERE event_type IN ('page_view', 'click')),
lagged AS (
  SELECT *,
         epoch_us(timestamp) - epoch_us(lag(timestamp) OVER w) AS gap_us, gap_us / 1e6 AS gap_s,
         lag(event_type) OVER w AS prev_type
  FROM pre WINDOW w AS (PARTITION BY session_id ORDER BY timestamp, event_id)
)"""

TYPE_COUNTS = """
type_counts AS (
  SELECT session_id, n_page_views, n_clicks, n_page_views + n_clicks AS n_pre_events,
         n_clicks / (n_page_views + n_clicks + 1e-9) AS click_ratio,
         n_page_views / (n_page_views + n_clicks + 1e-9) AS page_view_ratio,
         ln(1.0 + n_clicks) AS log_n_clicks, ln(1.0 + n_page_views) AS log_n_page_views,
         ln(1.0 + n_page_views + n_clicks) AS log_n_pre_events
  FROM (SELECT session_id, count(*) FILTER (WHERE event_type = 'page_view') AS n_page_views,
               count(*) FILTER (WHERE event_type = 'click') AS n_clicks
        FROM pre GROUP BY session_id)
)"""

CONTEXT = """
ctx AS (
  SELECT session_id, n_referrers, ip_bucket, has_user_id, pre_duration_s,
         CAST(hour(first_ts) AS INTEGER) AS hour_of_day, CAST(isodow(first_ts) - 1 AS INTEGER) AS day_of_week,
         CASE WHEN isodow(first_ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CAST(hour(first_ts) // 6 AS DOUBLE) AS hour_bucket,
         ln(1.0 + pre_duration_s) AS log_duration_s
  FROM (SELECT session_id, count(DISTINCT referrer) AS n_referrers,
               first(ip_bucket ORDER BY timestamp, event_id) FILTER (WHERE ip_bucket IS NOT NULL) AS ip_bucket,
               max(CASE WHEN user_id IS NOT NULL THEN 1 ELSE 0 END) AS has_user_id,
               min(timestamp) AS first_ts,
               (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6 AS pre_duration_s
        FROM pre GROUP BY session_id)
)"""

GAPS = """
gaps AS (
  SELECT *, std_gap_s / (mean_gap_s + 1e-9) AS gap_cv, p75_gap_s - p25_gap_s AS gap_iqr
  FROM (SELECT session_id,
               coalesce(max(gap_s), 0.0) AS max_gap_s, coalesce(min(gap_s), 0.0) AS min_gap_s,
               coalesce(stddev_samp(gap_s), 0.0) AS std_gap_s, coalesce(CAST(sum(gap_us) AS DOUBLE) / count(gap_us) / 1e6, 0.0) AS mean_gap_s,
               CAST(count(*) FILTER (WHERE gap_s < 5.0) AS DOUBLE) AS n_rapid_events,
               coalesce(quantile_cont(gap_s, 0.25), 0.0) AS p25_gap_s,
               coalesce(quantile_cont(gap_s, 0.5), 0.0) AS median_gap_s,
               coalesce(quantile_cont(gap_s, 0.75), 0.0) AS p75_gap_s
        FROM lagged GROUP BY session_id)
)"""

TRANSITIONS = """
transitions AS (
  SELECT session_id,
         CAST(count(*) FILTER (WHERE prev_type = 'page_view' AND event_type = 'click') AS DOUBLE) AS click_after_pageview,
         CAST(count(*) FILTER (WHERE prev_type = 'click' AND event_type = 'page_view') AS DOUBLE) AS pageview_after_click,
         count(*) FILTER (WHERE prev_type <> event_type) / CAST(greatest(count(*) - 1, 1) AS DOUBLE) AS alternation_rate
  FROM lagged GROUP BY session_id
)"""

_REFS = ["google", "direct", "facebook", "email", "affiliate", "organic"]
REFERRER_COUNTS = """
ref_counts AS (
  SELECT session_id, """ + ", ".join(
    f"count(*) FILTER (WHERE referrer = '{r}') AS ref_{r}" for r in _REFS) + """, count(referrer) AS n_ref
  FROM pre GROUP BY session_id
),
refs AS (
  SELECT * EXCLUDE (n_ref), """ + ", ".join(
    f"ref_{r} / CAST(greatest(n_ref, 1) AS DOUBLE) AS ref_{r}_ratio"
    for r in _REFS) + """
  FROM ref_counts
)"""

_REF_CODE = "coalesce(CAST(CASE {c} " + " ".join(
    f"WHEN '{r}' THEN {i}" for i, r in enumerate(_REFS)) + " END AS DOUBLE), -1.0)"
REFERRER_SEQUENCE = """
ref_seq AS (
  SELECT session_id, """ + _REF_CODE.format(c="a") + " AS first_referrer_enc, " + _REF_CODE.format(c="b") + """
         AS last_referrer_enc, CASE WHEN a = b THEN 0 ELSE 1 END AS referrer_changed
  FROM (SELECT session_id,
               first(referrer ORDER BY timestamp, event_id) FILTER (WHERE referrer IS NOT NULL) AS a,
               first(referrer ORDER BY timestamp DESC, event_id DESC) FILTER (WHERE referrer IS NOT NULL) AS b
        FROM pre GROUP BY session_id)
)"""

DEVICE = """
device AS (
  SELECT session_id, h % 16 AS device_bucket_16, h % 32 AS device_bucket_32, h % 64 AS device_bucket_64
  FROM (SELECT session_id, CAST('0x' || substr(md5(first(device_fingerprint ORDER BY timestamp, event_id)), 1, 8) AS BIGINT) AS h
        FROM pre GROUP BY session_id)
)"""

IP_FREQ = """
first_ip AS (
  SELECT session_id, first(ip_bucket ORDER BY timestamp, event_id) FILTER (WHERE ip_bucket IS NOT NULL) AS ip_bucket
  FROM pre GROUP BY session_id
),
ip_freq AS (
  SELECT session_id, ip_bucket,
         CASE WHEN ip_bucket IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY ip_bucket) END AS ip_bucket_freq
  FROM first_ip
)"""

LABELS = """
session_target AS (
  SELECT session_id, max(CASE WHEN event_type = 'conversion' THEN 1 ELSE 0 END) AS target
  FROM ev GROUP BY session_id
)"""

RATE_DIGITS = 4


def rnd(expr: str, digits: int = 6) -> str:
    """The rounding arithmetic of ``queries.rnd``."""
    return f"(floor(({expr}) * 1e{digits} + 0.5001) / 1e{digits})"


def rounded(columns: dict[str, int | None], source: str, ctes: list[str]) -> str:
    """SELECT the columns of ``source``, rounding those with a digit count."""
    cols = ", ".join(c if d is None else f"{rnd(c, d)} AS {c}" for c, d in columns.items())
    return "WITH " + ",".join(ctes) + f"\nSELECT {cols} FROM {source}"


def _cols(ints: str, doubles: str, digits: int = 6) -> dict[str, int | None]:
    out: dict[str, int | None] = {c: None for c in ints.split()}
    out.update({c: digits for c in doubles.split()})
    return out


_TYPE = _cols("n_page_views n_clicks n_pre_events",
              "click_ratio page_view_ratio log_n_clicks log_n_page_views log_n_pre_events")
_CTX = _cols("n_referrers ip_bucket has_user_id hour_of_day day_of_week is_weekend",
             "pre_duration_s hour_bucket log_duration_s")
_GAP = _cols("", "max_gap_s min_gap_s std_gap_s mean_gap_s n_rapid_events p25_gap_s median_gap_s p75_gap_s gap_cv gap_iqr")
_SEQ = _cols("", "click_after_pageview pageview_after_click alternation_rate")
_REF = _cols(" ".join(f"ref_{r}" for r in _REFS), " ".join(f"ref_{r}_ratio" for r in _REFS))
_RSEQ = _cols("referrer_changed", "first_referrer_enc last_referrer_enc")
_DEV = _cols("device_bucket_16 device_bucket_32 device_bucket_64", "")
_SID = {"session_id": None}

SQL: dict[str, str] = {}
SQL["session_type_counts"] = rounded(_SID | _TYPE, "type_counts", [EV, TYPE_COUNTS])
SQL["session_context"] = rounded(_SID | _CTX, "ctx", [EV, CONTEXT])
SQL["session_gaps"] = rounded(_SID | _GAP, "gaps", [EV, GAPS])
SQL["session_transitions"] = rounded(_SID | _SEQ, "transitions", [EV, TRANSITIONS])
SQL["session_referrer_onehot"] = rounded(_SID | _REF, "refs", [EV, REFERRER_COUNTS])
SQL["session_referrer_sequence"] = rounded(_SID | _RSEQ, "ref_seq", [EV, REFERRER_SEQUENCE])
SQL["session_device_buckets"] = rounded(_SID | _DEV, "device", [EV, DEVICE])
SQL["session_ip_frequency"] = rounded(_SID | {"ip_bucket": None, "ip_bucket_freq": None}, "ip_freq", [EV, IP_FREQ])
SQL["session_label_broadcast"] = "WITH " + EV + """
SELECT event_id, session_id, event_type,
       max(CASE WHEN event_type = 'conversion' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id) AS session_converted
FROM ev"""

FEATURE_TABLE = """
session_table AS (
  SELECT t.*, c.* EXCLUDE (session_id, ip_bucket), coalesce(c.ip_bucket, -1) AS ip_bucket,
         g.* EXCLUDE (session_id), r.* EXCLUDE (session_id), d.* EXCLUDE (session_id),
         i.ip_bucket_freq, s.* EXCLUDE (session_id), x.* EXCLUDE (session_id),
         c.pre_duration_s / (t.n_pre_events + 1e-9) AS duration_per_event,
         t.n_clicks / (c.pre_duration_s / 60.0 + 1e-9) AS clicks_per_minute,
         t.n_page_views / (c.pre_duration_s / 60.0 + 1e-9) AS page_views_per_minute,
         t.click_ratio * c.log_duration_s AS click_ratio_x_duration,
         t.n_clicks * r.ref_google_ratio AS clicks_x_google,
         t.n_clicks * r.ref_email_ratio AS clicks_x_email,
         y.target
  FROM type_counts t JOIN ctx c USING (session_id) JOIN gaps g USING (session_id)
  JOIN refs r USING (session_id) JOIN device d USING (session_id) JOIN ip_freq i USING (session_id)
  JOIN ref_seq s USING (session_id) JOIN transitions x USING (session_id)
  JOIN session_target y USING (session_id)
)"""
ALL_SESSION_CTES = [EV, TYPE_COUNTS, CONTEXT, GAPS, TRANSITIONS, REFERRER_COUNTS, REFERRER_SEQUENCE,
                    DEVICE, IP_FREQ, LABELS, FEATURE_TABLE]
_INTER = _cols("", "duration_per_event click_ratio_x_duration clicks_x_google clicks_x_email") | _cols(
    "", "clicks_per_minute page_views_per_minute", RATE_DIGITS)
SQL["session_features"] = rounded(
    _SID | _TYPE | _CTX | _GAP | _SEQ | _REF | _RSEQ | _DEV | _INTER | {"ip_bucket_freq": None, "target": None},
    "session_table", ALL_SESSION_CTES)


# --- pairs ---------------------------------------------------------------------------------

def cells_text(*parts: str) -> str:
    cells = [f"coalesce(length(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR), '-')" for p in parts]
    return f"concat_ws('|', {', '.join(cells)})"


def md5_long(*parts: str) -> str:
    return f"CAST('0x' || substr(md5({cells_text(*parts)}), 1, 15) AS BIGINT)"


def draw(purpose: str) -> str:
    return md5_long("'42'", f"'{purpose}'", "draw")


LINKAGE_SELECT = f"""
SELECT pair_id, target, a_event_id, b_event_id,
       {rnd("abs(epoch_us(a.timestamp) - epoch_us(b.timestamp)) / 1e6")} AS abs_time_diff_s,
       CAST(coalesce(a.device_fingerprint = b.device_fingerprint, false) AS INTEGER) AS same_fingerprint,
       CAST(coalesce(a.ip_bucket = b.ip_bucket, false) AS INTEGER) AS same_ip_bucket,
       CAST(coalesce(a.referrer = b.referrer, false) AS INTEGER) AS same_referrer,
       CAST(a.event_type = b.event_type AS INTEGER) AS same_event_type,
       CAST(a.user_id IS NOT NULL AND b.user_id IS NOT NULL AS INTEGER) AS both_have_user_id,
       CAST(coalesce(a.user_id = b.user_id, false) AS INTEGER) AS both_same_user_id
FROM chosen JOIN ev a ON a.event_id = a_event_id JOIN ev b ON b.event_id = b_event_id"""


def negatives(records: str, item: str, truth: str, copies: int, block: str | None) -> str:
    """CTEs drawing negatives from ``records``; one accepted per record."""
    same = "" if block is None else (
        f" AND (coalesce(a.{block} = b.{block}, false) OR {draw('accept')} % 1000 < 200)")
    return f"""
spots AS (SELECT *, row_number() OVER (ORDER BY {item}) - 1 AS spot FROM {records}),
total AS (SELECT count(*) AS n FROM {records}),
neg_draws AS (
  SELECT draw, {draw('negative a')} % n AS pa, {draw('negative b')} % n AS pb
  FROM (SELECT spot * {copies} + c.range AS draw FROM spots, range({copies}) c), total),
neg AS (
  SELECT draw AS pair_id, 0 AS target, a.{item} AS a_{item}, b.{item} AS b_{item}
  FROM neg_draws JOIN spots a ON a.spot = pa JOIN spots b ON b.spot = pb
  WHERE pa <> pb AND a.{truth} <> b.{truth}{same}
  ORDER BY draw LIMIT (SELECT n FROM total))"""


POSITIVES = f"""
placed AS (
  SELECT *, row_number() OVER (PARTITION BY true_user_id, session_id ORDER BY event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY true_user_id, session_id) AS size FROM ev),
members AS (
  SELECT true_user_id, session_id, size,
         row_number() OVER (PARTITION BY true_user_id ORDER BY session_id) - 1 AS m,
         count(*) OVER (PARTITION BY true_user_id) AS n
  FROM placed WHERE pos = 0),
grp AS (SELECT true_user_id, n, row_number() OVER (ORDER BY true_user_id) - 1 AS g
        FROM members WHERE m = 0 AND n >= 2),
pos_draws AS (
  SELECT draw, true_user_id, ma, (ma + 1 + {draw('second')} % (n - 1)) % n AS mb
  FROM (SELECT draw, true_user_id, n, {draw('first')} % n AS ma
        FROM (SELECT draw, {draw('group')} % (SELECT count(*) FROM grp) AS g
              FROM (SELECT row_number() OVER (ORDER BY event_id) - 1 AS draw FROM ev)) d
        JOIN grp USING (g))),
pos AS (
  SELECT d.draw AS pair_id, 1 AS target, a.event_id AS a_event_id, b.event_id AS b_event_id
  FROM pos_draws d
  JOIN members x ON x.true_user_id = d.true_user_id AND x.m = d.ma
  JOIN members y ON y.true_user_id = d.true_user_id AND y.m = d.mb
  JOIN placed a ON a.true_user_id = d.true_user_id AND a.session_id = x.session_id
                AND a.pos = {draw('record a')} % x.size
  JOIN placed b ON b.true_user_id = d.true_user_id AND b.session_id = y.session_id
                AND b.pos = {draw('record b')} % y.size)"""

SQL["linkage_sampled_pairs"] = ("WITH " + EV + "," + POSITIVES + "," + negatives("ev", "event_id", "true_user_id", 2, None)
                                + ",\nchosen AS (SELECT * FROM pos UNION ALL SELECT * FROM neg)" + LINKAGE_SELECT)
SQL["linkage_hard_negatives"] = ("WITH " + EV + "," + negatives("ev", "event_id", "true_user_id", 8, "ip_bucket")
                                 + ",\nchosen AS (SELECT * FROM neg)" + LINKAGE_SELECT)
SQL["linkage_window_candidates"] = "WITH " + EV + """,
chosen AS (
  SELECT x.event_id AS a_event_id, y.event_id AS b_event_id, 0 AS pair_id, 0 AS target
  FROM ev x JOIN ev y ON x.ip_bucket = y.ip_bucket AND x.event_id < y.event_id AND x.session_id <> y.session_id
  WHERE abs(epoch_us(x.timestamp) - epoch_us(y.timestamp)) <= 21600000000)
SELECT * EXCLUDE (pair_id, target) FROM (""" + LINKAGE_SELECT + ")"

_BLOCK_MATCH = "(x.device_fingerprint = y.device_fingerprint OR x.ip_bucket = y.ip_bucket OR x.user_id = y.user_id)"
SQL["linkage_multi_block"] = "WITH " + EV + f""",
chosen AS (
  SELECT x.event_id AS a_event_id, y.event_id AS b_event_id, 0 AS pair_id, 0 AS target
  FROM ev x JOIN ev y ON x.event_id < y.event_id AND x.session_id <> y.session_id
       AND y.timestamp BETWEEN x.timestamp - INTERVAL 2 HOUR AND x.timestamp + INTERVAL 2 HOUR
  WHERE {_BLOCK_MATCH})
SELECT * EXCLUDE (pair_id, target) FROM (""" + LINKAGE_SELECT + ")"
_BLOCK_KEYS = ["session_id", "device_fingerprint", "ip_bucket", "user_id"]
SQL["linkage_pruned_blocks"] = "WITH " + EV + ", " + ", ".join(
    f"s_{k} AS (SELECT {k} FROM ev WHERE {k} IS NOT NULL GROUP BY 1 HAVING count(*) * (count(*) - 1) / 2 <= 2000)" for k in _BLOCK_KEYS
) + " UNION ".join(
    f" SELECT x.event_id AS a_event_id, y.event_id AS b_event_id FROM ev x JOIN ev y ON x.{k} = y.{k} AND x.event_id < y.event_id JOIN s_{k} s ON s.{k} = x.{k}"
    for k in _BLOCK_KEYS
)
SQL["block_weights"] = "WITH " + EV + " UNION ALL ".join(
    f""" SELECT '{k}' AS block_key, count(*) AS blocks, max(n) AS largest, sum(n * (n - 1) / 2)::DOUBLE AS comparisons,
     coalesce(sum(n * (n - 1) / 2) FILTER (WHERE n * (n - 1) / 2 <= 2000), 0)::DOUBLE AS kept_comparisons
FROM (SELECT {k}, count(*) AS n FROM ev WHERE {k} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""" for k in _BLOCK_KEYS
)

OFFERS = """
offers AS (
  SELECT l_partkey * 1000000 + l_suppkey AS catalog_id, l_suppkey % 6 AS retailer,
         CASE WHEN l_suppkey % 4 <> 0 THEN md5(CAST(l_partkey AS VARCHAR)) END AS gtin,
         CASE WHEN l_suppkey % 3 = 0 THEN lower(concat_ws(' ', p_brand, p_name, p_type))
              WHEN l_suppkey % 17 <> 0 THEN concat_ws(' ', p_brand, p_name, p_type) END AS title,
         p_type AS category, p_retailprice * (1 + (l_suppkey % 10) / 50.0) AS list_price,
         l_partkey AS true_canonical_id, p_type AS true_category_path
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN part ON p_partkey = l_partkey),
worded AS (
  SELECT *, regexp_extract_all(lower(coalesce(title, '')), '[a-z0-9]+') AS words FROM offers)"""

MATCHER_SELECT = f"""
SELECT pair_id, target, a_catalog_id, b_catalog_id,
       CAST(coalesce(a.gtin = b.gtin, false) AS INTEGER) AS same_gtin,
       CAST(a.gtin IS NOT NULL AND b.gtin IS NOT NULL AS INTEGER) AS both_have_gtin,
       CAST((a.gtin IS NULL) <> (b.gtin IS NULL) AS INTEGER) AS one_has_gtin,
       CAST(a.gtin IS NULL AND b.gtin IS NULL AS INTEGER) AS no_gtin,
       CAST(coalesce(a.words[1], '') = coalesce(b.words[1], '') AS INTEGER) AS same_brand_token,
       {rnd("coalesce(len(list_intersect(a.words, b.words)) / CAST(nullif(len(list_distinct(list_concat(a.words, b.words))), 0) AS DOUBLE), 0.0)")} AS title_jaccard,
       CAST(len(list_intersect(a.words, b.words)) AS INTEGER) AS title_token_overlap,
       CAST(a.category IS NOT DISTINCT FROM b.category AS INTEGER) AS same_category,
       CAST(a.retailer = b.retailer AS INTEGER) AS same_retailer,
       {rnd("abs(ln(greatest(0.01, a.list_price)) - ln(greatest(0.01, b.list_price)))")} AS log_price_diff_ratio
FROM chosen JOIN worded a ON a.catalog_id = a_catalog_id JOIN worded b ON b.catalog_id = b_catalog_id"""

MATCHER_POSITIVES = f"""
placed AS (
  SELECT *, row_number() OVER (PARTITION BY true_canonical_id ORDER BY catalog_id) - 1 AS pos,
         count(*) OVER (PARTITION BY true_canonical_id) AS n FROM offers),
grp AS (SELECT true_canonical_id, n, row_number() OVER (ORDER BY true_canonical_id) - 1 AS g
        FROM placed WHERE pos = 0 AND n >= 2),
pos_draws AS (
  SELECT draw, true_canonical_id, ma, (ma + 1 + {draw('second')} % (n - 1)) % n AS mb
  FROM (SELECT draw, true_canonical_id, n, {draw('first')} % n AS ma
        FROM (SELECT draw, {draw('group')} % (SELECT count(*) FROM grp) AS g
              FROM (SELECT i * 4 + c.range AS draw
                    FROM (SELECT row_number() OVER (ORDER BY catalog_id) - 1 AS i FROM offers), range(4) c)) d
        JOIN grp USING (g))),
pos AS (
  SELECT d.draw AS pair_id, 1 AS target, a.catalog_id AS a_catalog_id, b.catalog_id AS b_catalog_id
  FROM pos_draws d
  JOIN placed a ON a.true_canonical_id = d.true_canonical_id AND a.pos = ma
  JOIN placed b ON b.true_canonical_id = d.true_canonical_id AND b.pos = mb
  WHERE a.retailer <> b.retailer
  ORDER BY draw LIMIT (SELECT count(*) FROM offers))"""
SQL["matcher_sampled_pairs"] = ("WITH " + OFFERS + "," + MATCHER_POSITIVES + ","
                                + negatives("offers", "catalog_id", "true_canonical_id", 2, None)
                                + ",\nchosen AS (SELECT * FROM pos UNION ALL SELECT * FROM neg)" + MATCHER_SELECT)
SQL["matcher_hard_negatives"] = ("WITH " + OFFERS + ","
                                 + negatives("offers", "catalog_id", "true_canonical_id", 8, "true_category_path")
                                 + ",\nchosen AS (SELECT * FROM neg)" + MATCHER_SELECT)

# --- as-of features ------------------------------------------------------------------------

VIEWS = """
e AS (SELECT event_id, true_user_id, timestamp AS event_timestamp FROM ev WHERE event_type = 'conversion'),
v AS (SELECT true_user_id, timestamp AS view_ts, value AS view_value, referrer AS view_referrer
      FROM ev WHERE event_type = 'page_view')"""
SQL["asof_features"] = "WITH " + EV + "," + VIEWS + """
SELECT e.event_id, e.true_user_id, e.event_timestamp, v.view_value, v.view_referrer, v.view_ts
FROM e ASOF LEFT JOIN v ON e.true_user_id = v.true_user_id AND e.event_timestamp >= v.view_ts"""
SQL["asof_features_ttl"] = "WITH " + EV + "," + VIEWS + """
SELECT event_id, true_user_id, event_timestamp,
       CASE WHEN ok THEN view_value END AS view_value, CASE WHEN ok THEN view_referrer END AS view_referrer,
       CASE WHEN ok THEN view_ts END AS view_ts
FROM (SELECT e.*, v.view_value, v.view_referrer, v.view_ts,
             v.view_ts >= e.event_timestamp - INTERVAL 2 DAY AS ok
      FROM e ASOF LEFT JOIN v ON e.true_user_id = v.true_user_id AND e.event_timestamp >= v.view_ts)"""


def _asof_views() -> str:
    ttl = {"page_view": "INTERVAL 1 DAY", "click": "INTERVAL 7 DAY", "add_to_cart": None, "checkout": "INTERVAL 6 HOUR"}
    ctes, columns, joins = [], [], []
    for kind, limit in ttl.items():
        # one row per user and time, then the nearest earlier time
        ctes.append(f"{kind}_rows AS (SELECT true_user_id, timestamp AS at, max(event_id) AS id, max_by(value, event_id) AS v"
                    f" FROM ev WHERE event_type = '{kind}' GROUP BY ALL)")
        fresh = f"{kind}_rows.at >= e.event_timestamp - {limit}" if limit else "true"
        columns += [f"CASE WHEN {fresh} THEN {kind}_rows.v END AS {kind}__value", f"CASE WHEN {fresh} THEN {kind}_rows.id END AS {kind}__event_id"]
        joins.append(f"ASOF LEFT JOIN {kind}_rows ON e.true_user_id = {kind}_rows.true_user_id AND e.event_timestamp >= {kind}_rows.at")
    return (f"WITH {EV}, e AS (SELECT event_id, true_user_id, timestamp AS event_timestamp FROM ev WHERE event_type = 'conversion'),"
            f"{', '.join(ctes)} SELECT e.*, {', '.join(columns)} FROM e {' '.join(joins)}")


SQL["asof_many_views"] = _asof_views()
LATEST = """
latest AS (
  SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (PARTITION BY true_user_id ORDER BY view_ts DESC, view_value DESC, view_referrer DESC) AS r FROM v)
  WHERE r = 1)"""
SQL["latest_features"] = "WITH " + EV + "," + VIEWS + "," + LATEST + "SELECT * FROM latest"
SQL["online_lookup"] = "WITH " + EV + "," + VIEWS + "," + LATEST + """
SELECT c_custkey AS true_user_id, view_value, view_referrer
FROM customer LEFT JOIN latest ON c_custkey = true_user_id"""

# --- interactions and ranking --------------------------------------------------------------

INTERACTIONS = """
raw AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS weight,
         o_orderdate, l_orderkey, l_linenumber, l_shipdate, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
dedup AS (
  SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY o_orderdate DESC, l_orderkey DESC,
      l_linenumber DESC, l_shipdate DESC, l_extendedprice DESC, weight DESC) AS r FROM raw)
  WHERE r = 1)"""
SQL["interactions_dedup"] = "WITH " + INTERACTIONS + """
SELECT user_id, item_id, weight, o_orderdate, l_orderkey FROM dedup"""


def _kcore(passes: int, min_users: int, min_items: int) -> str:
    out, prev = "c0 AS (SELECT user_id, item_id, weight FROM dedup)", "c0"
    for i in range(1, passes + 1):
        out += f""",
i{i} AS (SELECT * FROM {prev} WHERE item_id IN (
  SELECT item_id FROM {prev} GROUP BY item_id HAVING count(DISTINCT user_id) >= {min_users})),
c{i} AS (SELECT * FROM i{i} WHERE user_id IN (
  SELECT user_id FROM i{i} GROUP BY user_id HAVING count(DISTINCT item_id) >= {min_items}))"""
        prev = f"c{i}"
    return out


SQL["interactions_kcore"] = "WITH " + INTERACTIONS + ",\n" + _kcore(12, 19, 26) + """
SELECT * FROM c12 WHERE (SELECT count(*) FROM c12) = (SELECT count(*) FROM c11)"""
SQL["dense_ids"] = """
SELECT o_custkey AS user_id, CAST(row_number() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS user_idx
FROM (SELECT DISTINCT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
SPLIT = f"""
marked AS (
  SELECT user_id, item_id, weight,
         n >= 3 AND pos < greatest(1, CAST(round_even(n * 0.2, 0) AS BIGINT)) AS is_test
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
                    {md5_long("'42'", "user_id", "item_id")}, item_id) - 1 AS pos,
               count(*) OVER (PARTITION BY user_id) AS n
        FROM dedup))"""
SQL["leave_k_out"] = "WITH " + INTERACTIONS + "," + SPLIT + "\nSELECT * FROM marked"
SQL["item_partner_counts"] = """
SELECT l_partkey AS item_id, count(DISTINCT o_custkey) AS n_partners
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey HAVING count(DISTINCT o_custkey) >= 25"""
SQL["items_per_user"] = "WITH " + INTERACTIONS + """
SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items FROM dedup GROUP BY user_id"""
SQL["interaction_summary"] = "WITH " + INTERACTIONS + f"""
SELECT n_rows, n_users, n_items, {rnd('weight_min', 9)} AS weight_min, {rnd('weight_max', 9)} AS weight_max,
       {rnd('n_rows / (CAST(n_users AS DOUBLE) * n_items)', 9)} AS density
FROM (SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
             min(weight) AS weight_min, max(weight) AS weight_max FROM raw)"""
POPULAR = """
train AS (SELECT user_id, item_id FROM marked WHERE NOT is_test),
test AS (SELECT user_id, item_id FROM marked WHERE is_test),
ranked AS (SELECT item_id, row_number() OVER (ORDER BY n_users DESC, item_id) - 1 AS at
           FROM (SELECT item_id, count(DISTINCT user_id) AS n_users FROM train GROUP BY item_id)),
recs AS (
  SELECT user_id, item_id, rank FROM (
    SELECT u.user_id, r.item_id,
           CAST(row_number() OVER (PARTITION BY u.user_id ORDER BY r.at) AS INTEGER) AS rank
    FROM (SELECT c_custkey AS user_id FROM customer) u CROSS JOIN ranked r
    WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = r.item_id))
  WHERE rank <= 10)"""
SQL["popularity_topk_unseen"] = "WITH " + INTERACTIONS + "," + SPLIT + "," + POPULAR + "\nSELECT * FROM recs"
SQL["ranking_metrics"] = "WITH " + INTERACTIONS + "," + SPLIT + "," + POPULAR + f""",
truth AS (SELECT user_id, count(*) AS n FROM test GROUP BY user_id),
hits AS (SELECT user_id, rank, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS h
         FROM recs JOIN test USING (user_id, item_id)),
per_user AS (
  SELECT user_id, n, count(rank) AS k, coalesce(sum(1.0 / log2(rank + 1)), 0) AS dcg,
         coalesce(sum(h / CAST(rank AS DOUBLE)), 0) AS ap,
         list_sum(list_transform(range(1, least(n, 10) + 1), lambda i: 1.0 / log2(i + 1))) AS ideal
  FROM truth LEFT JOIN hits USING (user_id) GROUP BY user_id, n)
SELECT {rnd('avg(k / CAST(n AS DOUBLE))', 9)} AS recall_at_10, {rnd('avg(k / 10.0)', 9)} AS precision_at_10,
       {rnd('avg(CASE WHEN k > 0 THEN 1.0 ELSE 0.0 END)', 9)} AS hit_rate_at_10,
       {rnd('avg(dcg / ideal)', 9)} AS ndcg_at_10, {rnd('avg(ap / least(n, 10))', 9)} AS map_at_10,
       count(*) AS n_entities_evaluated
FROM per_user"""

# --- corpus and search ---------------------------------------------------------------------

_BLANKS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
SQL["corpus_text"] = f"""
SELECT p_partkey AS item_id,
       concat_ws('. ', nullif(trim(p_name, '{_BLANKS}'), ''),
                 CASE WHEN p_size > 10 THEN nullif(trim(p_type, '{_BLANKS}'), '') END) AS text,
       '{{"product_id":' || p_partkey || ',"title":"' || p_name || '"'
         || CASE WHEN p_size % 5 <> 0 THEN ',"brand":"' || p_brand || '"' ELSE '' END
         || ',"size":' || p_size || '}}' AS metadata
FROM part"""
SQL["document_corpus"] = f"""
SELECT doc_id AS item_id,
       md5(concat_ws('. ', nullif(trim(lang, '{_BLANKS}'), ''), nullif(trim(text, '{_BLANKS}'), ''))) AS text_md5,
       '{{"product_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || '}}' AS metadata
FROM documents"""
CENTRES = """
parts AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
centres AS (SELECT label AS c_label, i, avg(x) AS c FROM parts GROUP BY label, i)"""
KNN = "WITH" + CENTRES + f"""
SELECT query_id, item_id, {rnd('d')} AS _distance, rank, hit_label
FROM (SELECT CAST(c_label AS BIGINT) AS query_id, vec_id AS item_id, label AS hit_label, d,
             CAST(row_number() OVER (PARTITION BY c_label ORDER BY d, vec_id) AS INTEGER) AS rank
      FROM (SELECT c_label, vec_id, label, sum((x - c) * (x - c)) AS d
            FROM parts JOIN centres USING (i) GROUP BY c_label, vec_id, label))
WHERE rank <= 10"""
SQL["knn_l2"] = KNN
SQL["knn_l2_blocks"] = KNN
SQL["embedding_cosine_pairs"] = "WITH" + CENTRES + f"""
SELECT vec_id AS item_id, label, {rnd('sum(x * c) / (sqrt(sum(x * x)) * sqrt(sum(c * c)))')} AS cosine
FROM parts JOIN centres ON c_label = label AND parts.i = centres.i GROUP BY vec_id, label"""

# --- numeric tables, splits and profiles ---------------------------------------------------

HOUSE = """
house AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 5.0 AS MedInc, l_linenumber * 7.0::DOUBLE AS HouseAge,
         l_tax * 100.0 + 1.0 AS AveRooms, l_discount * 10.0 + 0.5 AS AveBedrms,
         l_quantity * 30.0 + l_linenumber AS Population, l_discount * 20.0 + 1.0 AS AveOccup,
         32.5::DOUBLE + (l_partkey % 1000) / 100.0::DOUBLE AS Latitude, -124.0::DOUBLE + (l_suppkey % 1000) / 100.0::DOUBLE AS Longitude,
         l_quantity * (1.0::DOUBLE - l_discount) / 10.0 + l_extendedprice / 1000000.0 AS target
  FROM lineitem),
ratios AS (
  SELECT *, AveRooms / (AveOccup + 1e-6) AS rooms_per_household, AveBedrms / (AveRooms + 1e-6) AS bedrooms_per_room,
         Population / (AveOccup + 1e-6) AS population_per_household, AveBedrms / (AveOccup + 1e-6) AS bedrooms_per_household,
         AveRooms / (Population + 1e-6) AS rooms_per_person, AveOccup / (AveRooms + 1e-6) AS occ_ratio,
         MedInc / (AveRooms + 1e-6) AS income_per_room, MedInc / (AveBedrms + 1e-6) AS income_per_bedroom,
         sqrt(pow(Latitude - 34.05, 2) + pow(Longitude + 118.24, 2)) AS dist_la,
         sqrt(pow(Latitude - 37.77, 2) + pow(Longitude + 122.42, 2)) AS dist_sf,
         sqrt(pow(Latitude - 32.72, 2) + pow(Longitude + 117.15, 2)) AS dist_sd,
         sqrt(pow(Latitude - 37.34, 2) + pow(Longitude + 121.89, 2)) AS dist_sj,
         sqrt(pow(Latitude - 38.58, 2) + pow(Longitude + 121.49, 2)) AS dist_sac,
         sqrt(pow(Latitude - 34.42, 2) + pow(Longitude + 119.70, 2)) AS dist_sb,
         sqrt(pow(Latitude - 36.74, 2) + pow(Longitude + 119.77, 2)) AS dist_fresno,
         sqrt(pow(Latitude - 35.0, 2) + pow(Longitude + 119.0, 2)) AS geo_dist
  FROM house),
engineered AS (
  SELECT *, Population / (rooms_per_household + 1e-6) AS pop_density,
         ln(1.0 + MedInc) AS log_medinc, ln(1.0 + Population) AS log_population, ln(1.0 + AveOccup) AS log_households,
         ln(1.0 + AveRooms) AS log_rooms, ln(1.0 + AveBedrms) AS log_bedrooms,
         ln(1.0 + rooms_per_household) AS log_rooms_per_household,
         ln(1.0 + population_per_household) AS log_population_per_household,
         Latitude * Longitude AS lat_lon, Latitude * Latitude AS lat2, Longitude * Longitude AS lon2,
         MedInc * MedInc AS medinc2, MedInc * MedInc * MedInc AS medinc3, sqrt(greatest(MedInc, 0.0)) AS sqrt_medinc,
         ln(1.0 + MedInc) * ln(1.0 + MedInc) AS log_medinc2, MedInc * Latitude AS medinc_x_lat,
         MedInc * Longitude AS medinc_x_lon, ln(1.0 + MedInc) * Latitude AS log_medinc_x_lat,
         ln(1.0 + MedInc) * Longitude AS log_medinc_x_lon, MedInc * dist_la AS medinc_x_dist_la,
         MedInc * dist_sf AS medinc_x_dist_sf, MedInc * dist_sd AS medinc_x_dist_sd, MedInc * dist_sj AS medinc_x_dist_sj,
         HouseAge * AveRooms AS age_x_rooms, HouseAge * MedInc AS age_x_income,
         HouseAge * rooms_per_household AS age_x_rooms_per_hh, HouseAge * Latitude AS age_x_lat,
         least(dist_la, dist_sf, dist_sd, dist_sj, dist_sac, dist_sb, dist_fresno) AS min_city_dist
  FROM ratios)"""
SQL["numeric_features"] = "WITH" + HOUSE + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       floor(COLUMNS(* EXCLUDE (l_orderkey, l_linenumber, l_partkey, l_suppkey)) * 1e5 + 0.5001) / 1e5
FROM engineered"""

_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
SQL["train_test_split"] = f"""
SELECT {_LINE}, {md5_long("'42'", *_LINE.split(", "))} % 1000000 < 200000 AS is_test FROM lineitem"""
SQL["stratified_sample"] = f"""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {md5_long("'42'", 'o_orderkey')}, o_orderkey) AS r FROM orders)
WHERE r <= 200"""
SQL["eval_subsample"] = f"""
SELECT o_orderkey, o_custkey FROM orders ORDER BY {md5_long("'0'", 'o_orderkey')}, o_orderkey LIMIT 2000"""
SQL["first_rows"] = """
SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10"""
SQL["class_balance"] = f"""
SELECT quality, count(*) AS n, {rnd('count(*) / CAST((SELECT count(*) FROM labels) AS DOUBLE)')} AS share
FROM labels GROUP BY quality"""
SQL["balanced_weights"] = f"""
SELECT doc_id, toxic, {rnd("count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY toxic))")} AS class_weight FROM labels"""
SQL["dataset_profile"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, {rnd(f'avg({c})', 5)} AS mean, {rnd(f'stddev_samp({c})', 5)} AS stddev,
       {rnd(f'min({c})', 5)} AS min, {rnd(f'max({c})', 5)} AS max,
       {rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 5)} AS p25, {rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 5)} AS p50,
       {rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 5)} AS p75 FROM lineitem"""
    for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
SQL["dataset_summary"] = f"""
SELECT count(*) AS n_rows, 11 AS n_cols, {rnd('min(l_discount)')} AS target_min, {rnd('max(l_discount)')} AS target_max,
       {rnd('avg(l_discount)')} AS target_mean,
       {rnd('avg(CASE WHEN l_discount > 0 THEN 1.0 ELSE 0.0 END)')} AS positive_fraction
FROM lineitem"""
_LINE_TYPES = dict(sorted({
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}.items()))
SQL["dataset_fingerprint"] = f"""
SELECT n_rows, 11 AS n_cols, sha256(n_rows || ':' || s || ':' || x || ':{",".join(f"{c} {t}" for c, t in _LINE_TYPES.items())}') AS dataset_sha256
FROM (SELECT count(*) AS n_rows, sum(h) AS s, bit_xor(h) AS x
      FROM (SELECT {md5_long(*_LINE_TYPES)} AS h FROM lineitem))"""
SQL["unseen_category"] = """
SELECT p_partkey, coalesce(code, -1) AS code,
       (SELECT string_agg(CASE WHEN t.p_type = part.p_type THEN '1' ELSE '0' END, '' ORDER BY t.p_type)
        FROM (SELECT DISTINCT p_type FROM part WHERE p_type <> 'PROMO') t) AS hot
FROM part LEFT JOIN (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code
                     FROM (SELECT DISTINCT p_type FROM part WHERE p_type <> 'PROMO')) v USING (p_type)"""
SQL["rare_categories"] = """
SELECT p_partkey, CASE WHEN c >= k THEN p_name ELSE 'other' END AS p_name
FROM (SELECT p_partkey, p_name, count(*) OVER (PARTITION BY p_name) AS c FROM part),
     (SELECT CAST(ceil(count(*) / CAST(count(DISTINCT p_name) AS DOUBLE)) AS BIGINT) AS k FROM part)"""
SQL["drift_psi"] = "WITH" + EV + f""",
shares AS (
  SELECT greatest(coalesce(a / (SELECT CAST(count(*) AS DOUBLE) FROM ev WHERE user_id IS NOT NULL), 0), 1e-6) AS p,
         greatest(coalesce(b / (SELECT CAST(count(*) AS DOUBLE) FROM ev WHERE user_id IS NULL), 0), 1e-6) AS q
  FROM (SELECT event_type, count(*) AS a FROM ev WHERE user_id IS NOT NULL GROUP BY 1)
  FULL JOIN (SELECT event_type, count(*) AS b FROM ev WHERE user_id IS NULL GROUP BY 1) USING (event_type))
SELECT {rnd('sum((q - p) * ln(q / p))')} AS psi, {rnd('sum(q * ln(q / p))')} AS kl, count(*) AS n_values FROM shares"""
SQL["drift_numeric"] = """
SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS column, unnest([true, false, false, false]) AS drifted, true AS kl_positive"""
SQL["fingerprint_parts"] = """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE l_returnflag <> 'R') AS n_rest, true AS added, true AS taken_out, true AS differ FROM lineitem"""
SQL["implicit_ranking"] = "SELECT true AS learned, true AS beats_popularity"
SQL["boundary_checks"] = "WITH" + EV + """
SELECT unnest(['known_referrer', 'has_ip', 'positive_value', 'known_type']) AS rule, unnest([a, b, c, d]) AS n_bad, n AS n_rows
FROM (SELECT count(*) FILTER (WHERE referrer IS NULL OR referrer = 'bing') AS a, count(*) FILTER (WHERE ip_bucket IS NULL) AS b,
             count(*) FILTER (WHERE value IS NULL OR value <= 0) AS c, count(*) FILTER (WHERE event_type IS NULL) AS d,
             count(*) AS n FROM ev)"""
SQL["price_zscore"] = "WITH" + OFFERS + f"""
SELECT catalog_id, category, retailer, {rnd('list_price')} AS list_price,
       {rnd("CASE WHEN s > 0 THEN (list_price - m) / s ELSE 0.0 END")} AS z
FROM offers JOIN (SELECT category, retailer, avg(list_price) AS m, stddev_samp(list_price) AS s FROM offers GROUP BY 1, 2)
  USING (category, retailer)"""
SQL["last_click"] = "WITH" + EV + """
SELECT e.event_id, e.session_id, c.event_id AS click_event_id, c.referrer AS click_referrer
FROM (SELECT * FROM ev WHERE event_type = 'conversion') e
LEFT JOIN LATERAL (
  SELECT event_id, referrer FROM ev c
  WHERE c.event_type = 'click' AND c.session_id = e.session_id AND (c.timestamp, c.event_id) <= (e.timestamp, e.event_id)
  ORDER BY c.timestamp DESC, c.event_id DESC LIMIT 1) c ON true"""

# --- metrics -------------------------------------------------------------------------------

GRADED = """
graded AS (
  SELECT doc_id, quality, toxic, n_chars, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted,
         CASE WHEN n_chars < 500 THEN 0 WHEN n_chars < 2000 THEN 1 ELSE 2 END AS size_class, noise % 3 AS size_guess
  FROM (SELECT *, (noise + 64 * quality) / 320.0::DOUBLE AS score
        FROM (SELECT labels.*, n_chars, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 2) AS INTEGER) AS noise
              FROM labels JOIN documents USING (doc_id))))"""
SQL["class_summary"] = "WITH" + GRADED + """
SELECT count(DISTINCT size_class) AS n_classes, max(size_class) + 1 AS max_plus_one FROM graded"""
PER_CLASS = """
per_class AS (
  SELECT class, CASE WHEN predicted > 0 THEN hits / CAST(predicted AS DOUBLE) ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN hits / CAST(support AS DOUBLE) ELSE 0.0 END AS recall,
         CASE WHEN hits > 0 THEN 2.0 * hits / (predicted + support) ELSE 0.0 END AS f1, support
  FROM (SELECT class, count(*) FILTER (WHERE {y} = class) AS support, count(*) FILTER (WHERE {p} = class) AS predicted,
               count(*) FILTER (WHERE {y} = class AND {p} = class) AS hits
        FROM graded, (SELECT {y} AS class FROM graded UNION SELECT {p} FROM graded) GROUP BY class))"""
_BIN, _MULTI = PER_CLASS.format(y="quality", p="predicted"), PER_CLASS.format(y="size_class", p="size_guess")
SQL["classification_report"] = "WITH" + GRADED + "," + _BIN + f"""
SELECT {rnd("(SELECT avg(CASE WHEN quality = predicted THEN 1.0 ELSE 0.0 END) FROM graded)")} AS validation_accuracy,
       {rnd('precision')} AS precision, {rnd('recall')} AS recall, {rnd('f1')} AS f1, 'binary' AS averaging,
       (SELECT count(*) FROM graded) AS n_test, '0,1' AS classes
FROM per_class WHERE class = 1"""
SQL["classification_report_macro"] = "WITH" + GRADED + "," + _MULTI + f"""
SELECT {rnd("(SELECT avg(CASE WHEN size_class = size_guess THEN 1.0 ELSE 0.0 END) FROM graded)")} AS validation_accuracy,
       {rnd('avg(precision)')} AS precision, {rnd('avg(recall)')} AS recall, {rnd('avg(f1)')} AS f1, 'macro' AS averaging,
       (SELECT count(*) FROM graded) AS n_test, string_agg(CAST(class AS VARCHAR), ',' ORDER BY class) AS classes
FROM per_class"""
SQL["class_metrics"] = "WITH" + GRADED + "," + _MULTI + f"""
SELECT class, {rnd('precision')} AS precision, {rnd('recall')} AS recall, {rnd('f1')} AS f1, support FROM per_class"""
SQL["confusion_matrix"] = "WITH" + GRADED + "SELECT size_class, size_guess, count(*) AS n FROM graded GROUP BY 1, 2"
SQL["roc_auc"] = "WITH" + GRADED + f"""
SELECT {rnd("sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) / count(*)")} AS auc,
       count(DISTINCT a.doc_id) AS n_pos, count(DISTINCT b.doc_id) AS n_neg
FROM graded a, graded b WHERE a.quality = 1 AND b.quality = 0"""
CURVE = """
steps AS (
  SELECT t AS threshold, count(*) FILTER (WHERE quality = 1) AS tp, count(*) FILTER (WHERE quality = 0) AS fp
  FROM (SELECT DISTINCT score AS t FROM graded) JOIN graded ON score >= t GROUP BY t),
totals AS (SELECT count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality = 0) AS n FROM graded)"""
SQL["roc_curve"] = "WITH" + GRADED + "," + CURVE + f"""
SELECT {rnd('threshold')} AS threshold, tp, fp, {rnd('tp / CAST(p AS DOUBLE)')} AS tpr, {rnd('fp / CAST(n AS DOUBLE)')} AS fpr
FROM steps, totals"""
SQL["threshold_sweep"] = "WITH" + GRADED + "," + CURVE + f"""
SELECT {rnd('threshold')} AS threshold, {rnd('tp / CAST(tp + fp AS DOUBLE)')} AS precision,
       {rnd('tp / CAST(p AS DOUBLE)')} AS recall, {rnd('2.0 * tp / (tp + fp + p)')} AS f1
FROM steps, totals"""
PRICED = """
priced AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS y, l_quantity * p_retailprice AS p
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""
SQL["regression_report"] = "WITH" + PRICED + f""",
r AS (
  SELECT 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
         avg(y) AS m, stddev_samp(y) AS s, count(*) AS n FROM priced)
SELECT {rnd('r2', 4)} AS validation_r2, {rnd('rmse', 4)} AS rmse, {rnd('mae', 4)} AS mae, {rnd('m', 4)} AS target_mean,
       {rnd('s', 4)} AS target_std, n AS n_test, r2 >= 0.5 AS passed
FROM r"""
SQL["residuals"] = "WITH" + PRICED + f"""
SELECT {_LINE}, {rnd('y - p', 4)} AS residual, {rnd('abs(y - p)', 4)} AS abs_residual FROM priced"""
SQL["residual_summary"] = "WITH" + PRICED + f"""
SELECT {rnd('avg(abs(y - p))', 4)} AS mean_abs_residual, count(*) FILTER (WHERE y = p) AS n_match, count(*) AS n FROM priced"""
SQL["single_feature_auc"] = f"""WITH published AS ({SQL["session_features"]}),
long AS (UNPIVOT (
    SELECT target, CAST(COLUMNS(* EXCLUDE (session_id, target)) AS DOUBLE) FROM published)
  ON COLUMNS(* EXCLUDE (target)) INTO NAME feature VALUE v),
ranked AS (
  SELECT feature, target, rank() OVER (PARTITION BY feature ORDER BY v)
         + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS r FROM long),
aucs AS (
  SELECT feature, (sum(r) FILTER (WHERE target = 1) - np * (np + 1) / 2.0) / (np * nn) AS auc
  FROM ranked JOIN (SELECT feature, CAST(sum(target) AS DOUBLE) AS np, CAST(count(*) - sum(target) AS DOUBLE) AS nn
                    FROM long GROUP BY feature) USING (feature)
  GROUP BY feature, np, nn)
SELECT feature, {rnd('auc')} AS auc, greatest(auc, 1 - auc) > 0.95 AS leaks FROM aucs"""

# --- incremental ---------------------------------------------------------------------------

SQL["online_materialized"] = SQL["latest_features"]
SQL["session_stream_totals"] = "WITH" + EV + """
SELECT session_id, count(*) FILTER (WHERE event_type = 'page_view') AS n_page_views,
       count(*) FILTER (WHERE event_type = 'click') AS n_clicks, count(*) AS n_events,
       max(CASE WHEN event_type = 'conversion' THEN 1 ELSE 0 END) AS session_converted
FROM ev GROUP BY session_id"""

# --- fitted models: the agreement itself is what is checked --------------------------------

SQL["saved_model_parity"] = f"""
SELECT count(DISTINCT ({_LINE}, l_extendedprice, l_quantity)) AS n_matched, 0.0::DOUBLE AS max_abs_diff, true AS all_close,
       unnest(['reloaded', 'refitted']) AS model
FROM lineitem WHERE {md5_long("'42'", *_LINE.split(", "))} % 1000000 < 200000"""

# --- facts about fitted results that any right model has -----------------------------------

def held_out(*key: str) -> str:
    return f"{md5_long("'42'", *key)} % 1000000 < 200000"


SQL["knn_approx"] = """
SELECT vec_id AS query_id, 10::BIGINT AS n_hits, true AS ranks_dense, true AS distances_true, true AS recall_reached
FROM embeddings WHERE vec_id % 50 = 0"""
SQL["knn_index"] = SQL["knn_approx"].replace("true AS recall_reached", "true AS recall_reached, true AS few_compared")
SQL["hashing_embed_search"] = """
SELECT item_id AS query_id, 5::BIGINT AS n_hits, true AS ranks_dense, true AS distances_true FROM benchmark"""
SQL["text_search"] = """
SELECT doc_id AS query_id, 5::BIGINT AS n_hits, true AS found_itself FROM documents WHERE doc_id % 50 = 0"""
SQL["geo_clusters"] = """
SELECT l_orderkey, l_linenumber, l_partkey, true AS nearest, true AS distance_true FROM lineitem"""
_PLACES = [f"{md5_long(f"'{c}'", c)} % 64" for c in ("p_brand", "p_type", "p_name")]
SQL["feature_hashing"] = f"""
SELECT p_partkey, array_to_string(list_sort(list_distinct([{", ".join(_PLACES)}])), ',') AS positions FROM part"""
SQL["fit_score_boosted"] = f"""
WITH published AS ({SQL["session_features"]})
SELECT session_id, target, true AS is_probability, true AS at_threshold FROM published WHERE {held_out("session_id")}"""
_GRADED = f"""
FROM labels JOIN documents USING (doc_id) WHERE {held_out("doc_id")}"""
_SIZE = "CASE WHEN n_chars < 500 THEN 0 WHEN n_chars < 2000 THEN 1 ELSE 2 END"
SQL["fit_score_forest"] = "SELECT doc_id, quality AS target, true AS is_probability, true AS learned" + _GRADED
SQL["fit_score_multiclass"] = f"SELECT doc_id, {_SIZE} AS target, true AS learned" + _GRADED
SQL["fit_score_perceptron"] = SQL["fit_score_multiclass"]
_HOUSE_ROWS = "WITH" + HOUSE.split(",\nratios AS")[0]
_HELD_LINES = f"FROM house WHERE {held_out(*_LINE.split(', '))}"
SQL["network_value_class"] = f"""{_HOUSE_ROWS}
SELECT {_LINE}, CASE WHEN target < 1.5 THEN 0 WHEN target < 3.5 THEN 1 ELSE 2 END AS target, true AS sums_to_one, true AS learned {_HELD_LINES}"""
SQL["boost_value"] = f"{_HOUSE_ROWS} SELECT {_LINE}, {rnd('target')} AS target, true AS learned {_HELD_LINES}"
SQL["boost_high_value"] = f"""{_HOUSE_ROWS}
SELECT {_LINE}, (target > 2.5)::INTEGER AS target, true AS is_probability, true AS at_threshold, true AS learned {_HELD_LINES}"""
SQL["boost_value_class"] = f"""{_HOUSE_ROWS}
SELECT {_LINE}, CASE WHEN target < 1.5 THEN 0 WHEN target < 3.5 THEN 1 ELSE 2 END AS target, true AS sums_to_one, true AS learned {_HELD_LINES}"""
SQL["fit_score_regressor"] = "WITH" + HOUSE.split(",\nratios AS")[0] + f"""
SELECT {_LINE}, {rnd("target")} AS target, true AS residual_true, true AS learned FROM house WHERE {held_out(*_LINE.split(", "))}"""
SQL["linkage_model"] = """
SELECT 'validation_auc' AS metric, true AS passed, 2 * (count(*) // 2) AS n_scored, true AS is_probability FROM events"""
SQL["matcher_model"] = "WITH" + OFFERS + """
SELECT 'validation_auc' AS metric, true AS passed, 2 * (count(*) // 4) AS n_scored, true AS is_probability FROM offers"""
SQL["asof_forest"] = "WITH" + EV + f"""
SELECT c.event_id,
       CAST(coalesce((epoch_us(c.timestamp) - epoch_us(max(v.timestamp))) / 1e6 <= 172800.0, false) AS INTEGER) AS target,
       true AS is_probability, true AS learned
FROM (SELECT * FROM ev WHERE event_type = 'conversion' AND {held_out("event_id")}) c
LEFT JOIN ev v ON v.event_type = 'page_view' AND v.true_user_id = c.true_user_id AND v.timestamp <= c.timestamp
GROUP BY c.event_id, c.timestamp"""
SQL["permutation_importance"] = """
SELECT unnest(['score', 'n_chars']) AS feature, 10::BIGINT AS repeats, unnest([true, false]) AS matters"""
_CORE = "WITH " + INTERACTIONS + ",\n" + _kcore(8, 3, 3)
SQL["als_recommendations"] = _CORE + """
SELECT DISTINCT user_id, 10::BIGINT AS n_items, true AS in_order, true AS all_unseen FROM c8"""
SQL["als_metrics"] = _CORE + """
SELECT count(*) AS n_entities_evaluated, true AS all_shares FROM (SELECT user_id FROM c8 GROUP BY user_id HAVING count(*) >= 3)"""
SQL["recommendation_lists"] = _CORE + """
SELECT c_custkey AS entity_id, CASE WHEN c_custkey IN (SELECT user_id FROM c8) THEN 10 ELSE 0 END AS n_items FROM customer"""
SQL["retrieve_then_rank"] = "WITH" + OFFERS + """
SELECT DISTINCT true_canonical_id AS query_id, 5::BIGINT AS n_hits, true AS ranks_dense, true AS distances_true, true AS is_probability FROM offers"""
