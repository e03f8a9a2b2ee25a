"""SQL twins of the named queries, over the same tables, for a second engine to run.

They are written the plain way (joins, windows, row numbers) and share
nothing with the Spark side but the fixed values. Amounts are added as
decimals: a sum of doubles depends on the order of the rows, and an average
that lies on half a cent would then round either way.
"""

from __future__ import annotations

from adlift import schemas as S
from adlift.operators import texts

_SUM = "CAST(SUM(CAST(order_amount AS DECIMAL(18,2))) AS DOUBLE)"
_MEAN = f"{_SUM} / COUNT(order_amount)"
_NOW = (
    "(SELECT CAST(max(ts) AS DATE) + INTERVAL 1 DAY FROM events "
    "WHERE event_type IN ('view', 'click', 'purchase'))"
)
_TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_EVENTS = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
base AS (
  SELECT event_id, ts AS "timestamp", event_type, value, k,
         printf('usr_%06d', user_id) AS customer_id,
         printf('merch_%04d', k % 10) AS merchant_id,
         CASE (k % 10) % 7 WHEN 0 THEN 'Pizza' WHEN 1 THEN 'Burger' WHEN 2 THEN 'Japonesa'
              WHEN 3 THEN 'Brasileira' WHEN 4 THEN 'Saudavel' WHEN 5 THEN 'Mercado' ELSE 'Doces' END AS cuisine,
         CASE (k // 10) % 4 WHEN 0 THEN 'feed_banner_top' WHEN 1 THEN 'search_sponsored_item'
              WHEN 2 THEN 'post_order_carousel' ELSE 'category_highlight' END AS ad_placement
  FROM ev),
bronze_impressions AS (
  SELECT printf('imp_%08d', event_id) AS impression_id, "timestamp", customer_id, merchant_id, ad_placement,
         cuisine AS advertiser_cuisine, CASE WHEN event_id % 3 = 0 THEN 'ios' ELSE 'android' END AS device
  FROM base WHERE event_type = 'view'),
bronze_orders AS (
  SELECT printf('ord_%07d', event_id) AS order_id, "timestamp", customer_id, merchant_id,
         value AS order_amount, CASE WHEN k >= 65 THEN 1 ELSE 0 END AS used_coupon, cuisine
  FROM base WHERE event_type = 'purchase'),
bronze_clicks AS (
  SELECT click_id, impression_id, "timestamp", customer_id, merchant_id, ad_placement FROM (
    SELECT printf('clk_%07d', event_id) AS click_id, event_type, "timestamp", customer_id, merchant_id, ad_placement,
           last_value(CASE WHEN event_type = 'view' THEN printf('imp_%08d', event_id) END IGNORE NULLS)
             OVER (PARTITION BY customer_id, merchant_id ORDER BY "timestamp", event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS impression_id
    FROM base WHERE event_type IN ('view', 'click')) WHERE event_type = 'click')"""

_LINES = """
line_orders AS (
  SELECT printf('ord_%d_%d', l_orderkey, l_linenumber) AS order_id, l_shipdate AS "timestamp",
         printf('usr_%06d', o_custkey) AS customer_id, printf('merch_%04d', l_suppkey) AS merchant_id,
         l_extendedprice AS order_amount, CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS used_coupon,
         p_type AS cuisine
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def _asof(name: str, orders: str, row: str = "order_id") -> str:
    """Last click at or before each order within the window, by joining and ranking."""
    return f"""
{name}_in AS (SELECT *, row_number() OVER (ORDER BY {row}) AS rid FROM {orders}),
{name} AS (
  SELECT o.order_id, o."timestamp" AS order_timestamp, o.customer_id, o.merchant_id, o.order_amount,
         o.used_coupon, o.cuisine, c.click_id AS attributed_click_id,
         c.impression_id AS attributed_impression_id, c.ad_placement,
         CASE WHEN c.click_id IS NOT NULL THEN '{S.CLICK_STATUS}' ELSE '{S.ORGANIC_STATUS}' END
           AS attribution_status,
         round((epoch(o."timestamp") - epoch(c."timestamp")) / 3600.0, 1) AS hours_from_click_to_order
  FROM {name}_in o LEFT JOIN bronze_clicks c
    ON o.customer_id = c.customer_id AND o.merchant_id = c.merchant_id
   AND c."timestamp" <= o."timestamp" AND epoch(o."timestamp") - epoch(c."timestamp") <= 7 * 86400
  QUALIFY row_number() OVER (PARTITION BY o.rid ORDER BY c."timestamp" DESC, c.click_id DESC) = 1)"""


def _profiles(silver: str, prefix: str, key: str) -> str:
    """Per key: distinct and attributed orders, means, and the most frequent cuisine."""
    short = key[0]
    return f"""
{prefix}top_{short} AS (
  SELECT {key}, cuisine FROM {silver} GROUP BY {key}, cuisine
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, cuisine) = 1),
{prefix}sold_{short} AS (
  SELECT {key}, count(DISTINCT order_id) AS n,
         count(DISTINCT order_id) FILTER (attribution_status = '{S.CLICK_STATUS}') AS from_ads,
         round({_MEAN}, 2) AS ticket, round(avg(used_coupon), 3) AS coupons
  FROM {silver} GROUP BY {key})"""


def _gold(silver: str, prefix: str = "") -> str:
    filled = ", ".join(
        f"ifnull({name}, {_text(value) if isinstance(value, str) else value}) AS {name}"
        for name, value in S.GOLD_DEFAULTS.items()
    )
    return f"""{_profiles(silver, prefix, "customer_id")},
{prefix}order_agg AS (
  SELECT customer_id, n AS user_total_orders, from_ads AS user_attributed_orders, ticket AS user_avg_basket_value,
         coupons AS user_discount_affinity, cuisine AS user_preferred_cuisine
  FROM {prefix}sold_c JOIN {prefix}top_c USING (customer_id)),
{prefix}ads_n AS (
  SELECT i.customer_id, count(DISTINCT i.impression_id) AS shown, count(DISTINCT c.click_id) AS hit
  FROM bronze_impressions i LEFT JOIN bronze_clicks c USING (impression_id) GROUP BY i.customer_id),
{prefix}ads_u AS (
  SELECT customer_id, shown AS total_impressions, hit AS total_clicks,
         round(hit / shown, 4) AS user_historical_ctr, round(shown / (hit + 1.0), 2) AS user_ad_fatigue_score
  FROM {prefix}ads_n),
{prefix}gold_u AS (
  SELECT customer_id, {filled} FROM (
    SELECT a.customer_id, a.total_impressions AS user_ad_impressions, a.total_clicks AS user_ad_clicks,
           a.user_historical_ctr, a.user_ad_fatigue_score, o.* EXCLUDE (customer_id)
    FROM {prefix}ads_u a LEFT JOIN {prefix}order_agg o ON a.customer_id = o.customer_id)),
{_profiles(silver, prefix, "merchant_id")},
{prefix}gold_m AS (
  SELECT merchant_id, n AS merchant_total_orders, ticket AS merchant_avg_ticket,
         coupons AS merchant_coupon_dependency, cuisine AS merchant_cuisine,
         round(from_ads / n, 4) AS merchant_retail_media_dependency_rate
  FROM {prefix}sold_m JOIN {prefix}top_m USING (merchant_id))"""


_OBSERVED = """
observed AS (
  SELECT i.impression_id, i.customer_id, i.merchant_id, i.ad_placement, i.device, i."timestamp",
         CAST(c.click_id IS NOT NULL AS INT) AS has_clicked
  FROM bronze_impressions i LEFT JOIN bronze_clicks c USING (impression_id))"""

_TRAINING = """
training AS (
  SELECT o.impression_id, o.customer_id, o.merchant_id, o.ad_placement, o.device, o.has_clicked,
         u.user_total_orders, u.user_avg_basket_value, u.user_discount_affinity, u.user_ad_fatigue_score,
         u.user_historical_ctr, u.user_preferred_cuisine, m.merchant_total_orders, m.merchant_avg_ticket,
         m.merchant_retail_media_dependency_rate, m.merchant_cuisine
  FROM observed o LEFT JOIN gold_u u ON o.customer_id = u.customer_id
  LEFT JOIN gold_m m ON o.merchant_id = m.merchant_id)"""

_REQUESTS = """
line_requests AS (
  SELECT DISTINCT printf('req_%d_%d', l_orderkey, l_suppkey) AS request_id,
         printf('usr_%06d', o_custkey) AS customer_id, printf('merch_%04d', l_suppkey) AS merchant_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
looked_up AS (
  SELECT r.*, u.customer_id IS NOT NULL AS customer_found, m.merchant_id IS NOT NULL AS merchant_found,
         u.user_total_orders, u.user_avg_basket_value, u.user_discount_affinity, u.user_ad_fatigue_score,
         u.user_historical_ctr, u.user_preferred_cuisine, m.merchant_total_orders, m.merchant_avg_ticket,
         m.merchant_retail_media_dependency_rate, m.merchant_cuisine
  FROM line_requests r LEFT JOIN gold_u u ON r.customer_id = u.customer_id
  LEFT JOIN gold_m m ON r.merchant_id = m.merchant_id)"""


def _vector(missing: str) -> str:
    names = [*S.CUSTOMER_FEATURES, *S.MERCHANT_FEATURES]
    columns = ["request_id", "customer_id", "merchant_id", "customer_found", "merchant_found"]
    for n in names:
        if missing == "zero":
            columns.append(f"CAST(COALESCE({n}, 0) AS DOUBLE) AS {n}")
        else:
            found = "customer_found" if n in S.CUSTOMER_FEATURES else "merchant_found"
            columns.append(
                f"CAST(CASE WHEN {found} THEN {n} ELSE {S.SERVING_DEFAULTS[n]} END AS DOUBLE) AS {n}"
            )
    same = "=" if missing == "zero" else "IS NOT DISTINCT FROM"
    columns.append(
        f"CASE WHEN user_preferred_cuisine {same} merchant_cuisine THEN 1 ELSE 0 END AS is_affinity_match"
    )
    return f"SELECT {', '.join(columns)} FROM looked_up"


def _propensity(ticket: str, sensitive: str) -> str:
    return (
        f"least(0.95::DOUBLE, greatest(0.12::DOUBLE, {ticket} / 100.0::DOUBLE * "
        f"CASE WHEN {sensitive} THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END))"
    )


def _period(ts: str) -> str:
    minute = f"(hour({ts}) * 60 + minute({ts}))"
    return f"CASE WHEN {minute} < 690 THEN 'manha' WHEN {minute} < 975 THEN 'almoco' ELSE 'jantar' END"


_MEMBERS = f"""
periods AS (
  SELECT customer_id, {_period('"timestamp"')} AS period, count(*) AS n FROM bronze_orders GROUP BY ALL),
usual AS (
  SELECT customer_id, period FROM periods
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, period) = 1),
members AS (
  SELECT g.customer_id,
         'seg_' || lower(g.user_preferred_cuisine) || '_'
           || CASE WHEN g.user_discount_affinity > {S.PRICE_SENSITIVE_ABOVE} THEN 'promo' ELSE 'regular' END
           || '_' || COALESCE(p.period, 'jantar') AS segment_id,
         g.user_preferred_cuisine AS cuisine,
         g.user_discount_affinity > {S.PRICE_SENSITIVE_ABOVE} AS discount_sensitive,
         COALESCE(p.period, 'jantar') AS period, g.user_avg_basket_value, g.user_historical_ctr
  FROM gold_u g LEFT JOIN usual p ON g.customer_id = p.customer_id)"""


def _profile(minimum: int) -> str:
    return f"""
profile AS (
  SELECT segment_id, cuisine, discount_sensitive, period, count(*) AS customers,
         round(CAST(sum(CAST(user_avg_basket_value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS avg_ticket,
         round(CAST(sum(CAST(user_historical_ctr AS DECIMAL(18,4))) AS DOUBLE) / count(*), 4) AS avg_ctr
  FROM members GROUP BY ALL HAVING count(*) >= {minimum})"""


def _texts() -> str:
    rows = [
        f"({_text(c)}, {str(d).upper()}, {_text(p)}, {i}, {_text(line)})"
        for (c, d, p), lines in texts.TEMPLATES.items()
        for i, line in enumerate(lines)
    ]
    generic = [
        f"({i}, {_text(line.split('{cuisine}')[0])}, {_text(line.split('{cuisine}')[1])})"
        for i, line in enumerate(texts.GENERIC)
    ]
    return f"""
texts(cuisine, discount_sensitive, period, position, copy_text) AS (VALUES {', '.join(rows)}),
generic(position, head, tail) AS (VALUES {', '.join(generic)}),
generated AS (
  SELECT p.segment_id, p.cuisine, p.discount_sensitive, p.period, t.position, t.copy_text
  FROM profile p JOIN texts t ON p.cuisine = t.cuisine AND p.discount_sensitive = t.discount_sensitive
   AND p.period = t.period
  UNION ALL
  SELECT p.segment_id, p.cuisine, p.discount_sensitive, p.period, g.position, g.head || p.cuisine || g.tail
  FROM profile p, generic g
  WHERE NOT EXISTS (SELECT 1 FROM texts t WHERE p.cuisine = t.cuisine
                    AND p.discount_sensitive = t.discount_sensitive AND p.period = t.period))"""


def _guarded(source: str, max_chars: int, banned: tuple[str, ...]) -> str:
    hits = " OR ".join(f"contains(lower(clean), {_text(b)})" for b in banned)
    return f"""
cleaned AS (
  SELECT * EXCLUDE (copy_text), trim(regexp_replace(regexp_replace(copy_text,
         '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g'), '[ \\t\\r\\n]+', ' ', 'g'), ' ') AS clean
  FROM {source}),
judged AS (
  SELECT * EXCLUDE (clean), clean AS copy_text, CAST(length(clean) AS INT) AS n_chars,
         CASE WHEN clean IS NULL OR length(clean) = 0 THEN 'empty'
              WHEN length(clean) > {max_chars} THEN 'too_long'
              WHEN {hits} THEN 'banned_term' END AS reason
  FROM cleaned),
guarded AS (
  SELECT * EXCLUDE (reason),
         CASE WHEN reason IS NULL THEN '{texts.APPROVED}' ELSE 'REJECTED_GUARDRAILS' END AS status, reason
  FROM judged)"""


_CATALOG = f"""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY position) - 1 AS arm
  FROM guarded WHERE status = '{texts.APPROVED}'),
catalog AS (
  SELECT 'crt_' || segment_id || printf('_%02d', arm) AS creative_id, segment_id, cuisine,
         discount_sensitive, period, copy_text, status, CAST(1.0 AS DOUBLE) AS mab_arm_weight, arm
  FROM numbered)"""


def _hash(column: str, salt: str) -> str:
    return f"CAST('0x' || substr(md5('{salt}' || {column}), 1, 8) AS BIGINT)"


_ARMS = f"""
ad_requests AS (
  SELECT i.impression_id AS request_id, m.segment_id
  FROM bronze_impressions i LEFT JOIN members m ON i.customer_id = m.customer_id),
arms0 AS (
  SELECT creative_id, segment_id, arm, 10 AS impressions, {_hash('creative_id', 'prior:')} % 4 + 1 AS clicks,
         count(*) OVER (PARTITION BY segment_id) AS arms
  FROM catalog),
shown AS (
  SELECT r.request_id, COALESCE(a.creative_id, (SELECT min(creative_id) FROM catalog)) AS creative_id
  FROM ad_requests r LEFT JOIN arms0 a
    ON r.segment_id = a.segment_id AND {_hash('r.request_id', 'arm:log:')} % a.arms = a.arm),
served AS (
  SELECT s.creative_id, count(*) AS n,
         count(*) FILTER (s.request_id IN (SELECT impression_id FROM bronze_clicks WHERE impression_id IS NOT NULL))
           AS c
  FROM shown s GROUP BY s.creative_id),
stats AS (
  SELECT a.creative_id, a.segment_id, a.arm, CAST(a.impressions + COALESCE(s.n, 0) AS BIGINT) AS impressions,
         CAST(a.clicks + COALESCE(s.c, 0) AS BIGINT) AS clicks, a.arms
  FROM arms0 a LEFT JOIN served s ON a.creative_id = s.creative_id),
best AS (
  SELECT segment_id, creative_id, round(clicks / impressions, 6) AS ctr, arms FROM stats
  QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY clicks / impressions DESC, arm) = 1)"""

_SNAPSHOTS = f"""
u_days AS (
  SELECT customer_id, CAST(order_timestamp AS DATE) AS day, count(DISTINCT order_id) AS orders,
         sum(CAST(order_amount AS DECIMAL(18,2))) AS amount, count(*) AS amounts, sum(used_coupon) AS coupons,
         0 AS shown, 0 AS hit
  FROM silver GROUP BY ALL
  UNION ALL
  SELECT customer_id, CAST("timestamp" AS DATE), 0, 0, 0, 0, count(DISTINCT impression_id), 0
  FROM bronze_impressions GROUP BY ALL
  UNION ALL
  SELECT i.customer_id, CAST(c."timestamp" AS DATE), 0, 0, 0, 0, 0, count(DISTINCT c.click_id)
  FROM bronze_clicks c JOIN bronze_impressions i ON c.impression_id = i.impression_id GROUP BY ALL),
u_top AS (
  SELECT o.rid, s.cuisine FROM numbered_obs o JOIN silver s
    ON o.customer_id = s.customer_id
   AND CAST(CAST(s.order_timestamp AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) < o."timestamp"
  GROUP BY o.rid, s.cuisine
  QUALIFY row_number() OVER (PARTITION BY o.rid ORDER BY count(*) DESC, s.cuisine) = 1),
m_top AS (
  SELECT o.rid, s.cuisine FROM numbered_obs o JOIN silver s
    ON o.merchant_id = s.merchant_id
   AND CAST(CAST(s.order_timestamp AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) < o."timestamp"
  GROUP BY o.rid, s.cuisine
  QUALIFY row_number() OVER (PARTITION BY o.rid ORDER BY count(*) DESC, s.cuisine) = 1),
u_tot AS (
  SELECT o.rid, max(d.day) AS last_day, sum(d.orders) AS orders, CAST(sum(d.amount) AS DOUBLE) AS amount,
         sum(d.amounts) AS amounts, sum(d.coupons) AS coupons, sum(d.shown) AS shown, sum(d.hit) AS hit
  FROM numbered_obs o JOIN u_days d
    ON o.customer_id = d.customer_id AND CAST(d.day + INTERVAL 1 DAY AS TIMESTAMP) < o."timestamp"
  GROUP BY o.rid),
m_tot AS (
  SELECT o.rid, count(DISTINCT s.order_id) AS orders,
         CAST(sum(CAST(s.order_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS amounts,
         count(DISTINCT CASE WHEN s.attribution_status = '{S.CLICK_STATUS}' THEN s.order_id END) AS attributed
  FROM numbered_obs o JOIN silver s
    ON o.merchant_id = s.merchant_id
   AND CAST(CAST(s.order_timestamp AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) < o."timestamp"
  GROUP BY o.rid)"""

_SILVER = _asof("silver", "bronze_orders")
_LINE_SILVER = _asof("line_silver", "line_orders")
_GOLD = _gold("silver")
_CREATIVE = [_EVENTS, _SILVER, _GOLD, _MEMBERS, _profile(1), _texts()]
_BANDIT = [*_CREATIVE, _guarded("generated", texts.MAX_CHARS, texts.BANNED_TERMS), _CATALOG, _ARMS]
_SILVER_ROWS = f"SELECT * REPLACE (strftime(order_timestamp, {_TS}) AS order_timestamp) FROM"


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _skew() -> str:
    names = ["user_total_orders", "user_avg_basket_value", "user_discount_affinity", "user_ad_fatigue_score",
             "user_historical_ctr", "merchant_total_orders", "merchant_avg_ticket",
             "merchant_retail_media_dependency_rate", "is_affinity_match"]
    widths = [5.0, 10.0, 0.1, 0.5, 0.1, 50.0, 10.0, 0.1, 1.0]
    stacked = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, CAST(a.{n} AS DOUBLE) AS off, CAST(b.{n} AS DOUBLE) AS srv, "
        f"CAST({w} AS DOUBLE) AS width FROM zero_rows a JOIN serving_rows b ON a.request_id = b.request_id"
        for n, w in zip(names, widths)
    )
    return _with(
        [
            _EVENTS, _SILVER, _GOLD, _REQUESTS,
            f"zero_rows AS ({_vector('zero')})",
            f"serving_rows AS ({_vector('serving_defaults')})",
            f"stacked AS ({stacked})",
            """counts AS (
  SELECT feature, bin, sum(o) AS o, sum(s) AS s FROM (
    SELECT feature, greatest(0, least(9, floor(off / width))) AS bin, 1 AS o, 0 AS s FROM stacked
    UNION ALL SELECT feature, greatest(0, least(9, floor(srv / width))), 0, 1 FROM stacked) GROUP BY ALL),
totals AS (
  SELECT feature, count(*) AS n, count(*) FILTER (off IS DISTINCT FROM srv) AS mismatches
  FROM stacked GROUP BY feature),
shares AS (
  SELECT t.feature, t.n, t.mismatches, greatest(o / n, 1e-6) AS p, greatest(s / n, 1e-6) AS q
  FROM counts c JOIN totals t ON c.feature = t.feature)""",
        ],
        """SELECT feature, n AS "rows", mismatches, round(sum((p - q) * ln(p / q)), 6) AS psi,
       round(mismatches / n, 6) AS mismatch_rate FROM shares GROUP BY feature, n, mismatches""",
    )


def statements() -> dict[str, str]:
    logs, silver, gold = [_EVENTS], [_EVENTS, _SILVER], [_EVENTS, _SILVER, _GOLD]
    training = [*gold, _OBSERVED, _TRAINING]
    lines = [_EVENTS, _LINES, _LINE_SILVER]
    out: dict[str, str] = {}

    out["layer_counts"] = _with(
        gold,
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
            for name, source in [
                ("bronze_impressions", "bronze_impressions"),
                ("bronze_clicks", "bronze_clicks"),
                ("bronze_orders", "bronze_orders"),
                ("silver_ad_attribution", "silver"),
                ("gold_customer_features", "gold_u"),
                ("gold_merchant_features", "gold_m"),
            ]
        ),
    )
    out["ranked_clicks"] = _with(
        logs,
        f"""SELECT click_id, impression_id, strftime("timestamp", {_TS}) AS "timestamp", customer_id, merchant_id,
       ad_placement, CAST(row_number() OVER (PARTITION BY customer_id, merchant_id
         ORDER BY "timestamp" DESC, click_id DESC) AS INT) AS click_rank FROM bronze_clicks""",
    )
    out["attribution_global_last"] = _with(
        [
            _EVENTS,
            """newest AS (
  SELECT DISTINCT ON (customer_id, merchant_id) customer_id, merchant_id, click_id, impression_id, ad_placement,
         epoch("timestamp") AS clicked_at
  FROM bronze_clicks ORDER BY customer_id, merchant_id, "timestamp" DESC, click_id DESC),
aged AS (
  SELECT o.*, n.* EXCLUDE (customer_id, merchant_id), epoch(o."timestamp") - n.clicked_at AS age,
         coalesce(age BETWEEN 0 AND 604800, FALSE) AS hit
  FROM bronze_orders o LEFT JOIN newest n ON o.customer_id = n.customer_id AND o.merchant_id = n.merchant_id)""",
        ],
        f"""SELECT order_id, strftime("timestamp", {_TS}) AS order_timestamp, customer_id, merchant_id, order_amount,
       used_coupon, cuisine, if(hit, click_id, NULL) AS attributed_click_id,
       if(hit, impression_id, NULL) AS attributed_impression_id, if(hit, ad_placement, NULL) AS ad_placement,
       if(hit, '{S.CLICK_STATUS}', '{S.ORGANIC_STATUS}') AS attribution_status,
       if(hit, round(age / 3600.0, 1), NULL) AS hours_from_click_to_order
FROM aged""",
    )
    out["attribution_asof"] = _with(silver, f"{_SILVER_ROWS} silver")
    views = f"""
viewed AS (
  SELECT o.order_id, o."timestamp" AS order_timestamp, o.customer_id, o.merchant_id, o.order_amount,
         o.used_coupon, o.cuisine, i.impression_id AS viewed_impression_id, i.ad_placement,
         CASE WHEN i.impression_id IS NOT NULL THEN '{S.VIEW_STATUS}' ELSE '{S.ORGANIC_STATUS}' END
           AS attribution_status,
         round((epoch(o."timestamp") - epoch(i."timestamp")) / 3600.0, 1) AS hours_from_view_to_order
  FROM bronze_orders o LEFT JOIN bronze_impressions i
    ON o.customer_id = i.customer_id AND o.merchant_id = i.merchant_id
   AND i."timestamp" <= o."timestamp" AND epoch(o."timestamp") - epoch(i."timestamp") <= 24 * 3600
  QUALIFY row_number() OVER (PARTITION BY o.order_id ORDER BY i."timestamp" DESC, i.impression_id DESC) = 1)"""
    out["attribution_view_through"] = _with([_EVENTS, views], f"{_SILVER_ROWS} viewed")
    out["attribution_full"] = _with(
        [_EVENTS, _SILVER, views],
        f"""SELECT s.order_id, strftime(s.order_timestamp, {_TS}) AS order_timestamp, s.customer_id, s.merchant_id,
       s.order_amount, s.used_coupon, s.cuisine, s.attributed_click_id,
       CASE WHEN s.attributed_click_id IS NOT NULL THEN s.attributed_impression_id
            ELSE v.viewed_impression_id END AS attributed_impression_id,
       CASE WHEN s.attributed_click_id IS NOT NULL THEN s.ad_placement ELSE v.ad_placement END AS ad_placement,
       CASE WHEN s.attributed_click_id IS NOT NULL THEN '{S.CLICK_STATUS}'
            WHEN v.viewed_impression_id IS NOT NULL THEN '{S.VIEW_STATUS}'
            ELSE '{S.ORGANIC_STATUS}' END AS attribution_status,
       s.hours_from_click_to_order,
       CASE WHEN s.attributed_click_id IS NULL THEN v.hours_from_view_to_order END AS hours_from_view_to_order,
       CAST(CASE WHEN s.attributed_click_id IS NOT NULL THEN 1.0
            WHEN v.viewed_impression_id IS NOT NULL THEN 0.5 ELSE 0.0 END AS DOUBLE) AS attribution_weight
FROM silver s JOIN viewed v ON s.order_id = v.order_id""",
    )
    out["attribution_summary"] = _with(
        silver,
        f"""SELECT attribution_status, COUNT(*) AS total_orders, ROUND({_SUM}, 2) AS total_revenue,
       ROUND({_MEAN}, 2) AS avg_ticket,
       ROUND(CAST(SUM(CAST(hours_from_click_to_order AS DECIMAL(18,1))) AS DOUBLE)
             / COUNT(hours_from_click_to_order), 1) AS avg_hours_to_convert
FROM silver GROUP BY attribution_status""",
    )
    out["dedup_orders"] = _with(
        [_LINES],
        f"""SELECT * REPLACE (strftime("timestamp", {_TS}) AS "timestamp") FROM line_orders
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY "timestamp" DESC, order_amount DESC, merchant_id DESC,
                           customer_id DESC, used_coupon DESC, cuisine DESC) = 1""",
    )

    out["customer_order_agg"] = _with(gold, "SELECT * FROM order_agg")
    out["customer_ad_behavior"] = _with(gold, "SELECT * FROM ads_u")
    out["gold_customer_features"] = _with(gold, "SELECT * FROM gold_u")
    out["gold_customer_features_sparse"] = _with(
        [*lines, _gold("line_silver", "l_")], "SELECT * FROM l_gold_u"
    )
    out["gold_merchant_features"] = _with(gold, "SELECT * FROM gold_m")
    ends = ", ".join(f'(SELECT max("timestamp") FROM bronze_{log})' for log in ("impressions", "clicks", "orders"))
    out["gold_customers_as_of"] = _with(
        gold,
        f"""SELECT customer_id, user_total_orders, user_ad_impressions,
  strftime(CAST(CAST(greatest({ends}) AS DATE) + INTERVAL 1 DAY AS TIMESTAMP), {_TS}) AS last_feature_update
FROM gold_u""",
    )
    out["merchant_quality"] = """SELECT 'merch_' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS merchant_id,
  round((COALESCE(kept * 3, 0) + COALESCE(settled, 0))
    / NULLIF(CASE WHEN kept IS NULL THEN 0 ELSE 3 END + CASE WHEN settled IS NULL THEN 0 ELSE 1 END, 0), 4)
    AS merchant_score_quality
FROM supplier LEFT JOIN (
  SELECT l_suppkey, avg(CASE WHEN l_returnflag <> 'R' THEN 1.0 ELSE 0.0 END) AS kept,
         avg(CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END) FILTER (l_discount >= 0.05) AS settled
  FROM lineitem GROUP BY l_suppkey) ON s_suppkey = l_suppkey"""
    second = """date_trunc('second', "timestamp")"""
    out["csv_orders"] = _with(
        logs, f"""SELECT * REPLACE (strftime({second}, {_TS}) AS "timestamp") FROM bronze_orders"""
    )
    out["csv_relation"] = _with(
        logs,
        """SELECT cuisine, count(*) AS orders, count(DISTINCT customer_id) AS customers,
  CAST(sum(used_coupon) AS BIGINT) AS coupons, max(order_amount) AS largest FROM bronze_orders GROUP BY cuisine""",
    )
    out["csv_time_order"] = _with(
        logs,
        f"""SELECT count(*) AS row_count, strftime(min({second}), {_TS}) AS first_time,
  strftime(max({second}), {_TS}) AS last_time, CAST(0 AS BIGINT) AS overlapping_files FROM bronze_orders""",
    )
    digit = "CAST(right(click_id, 1) AS INT)"
    out["evolving_clicks"] = _with(
        logs,
        f"""SELECT click_id, impression_id, strftime("timestamp", {_TS}) AS "timestamp", customer_id, merchant_id,
  CASE WHEN {digit} % 2 = 0 THEN ad_placement END AS ad_placement,
  CASE WHEN {digit} % 2 = 1 THEN '2.' || {digit} END AS app_version FROM bronze_clicks""",
    )
    # Batches must not show in the result.
    out["gold_incremental_customers"] = _with(gold, "SELECT * FROM gold_u")
    out["gold_incremental_merchants"] = _with(gold, "SELECT * FROM gold_m")
    out["line_merchant_features"] = _with([*lines, _gold("line_silver", "l_")], "SELECT * FROM l_gold_m")
    out["line_customer_order_agg"] = _with([*lines, _gold("line_silver", "l_")], "SELECT * FROM l_order_agg")
    out["traffic_totals"] = _with(
        logs,
        f"""SELECT i AS impressions, c AS clicks, o AS orders, round(c / i, 6) AS global_ctr, v AS order_value
FROM (SELECT (SELECT count(*) FROM bronze_impressions) AS i, (SELECT count(*) FROM bronze_clicks) AS c,
             (SELECT count(*) FROM bronze_orders) AS o, (SELECT round({_SUM}, 2) FROM bronze_orders) AS v)""",
    )
    out["orders_last_30d"] = _with(
        logs,
        f"""SELECT customer_id, count(DISTINCT order_id) AS user_orders_last_30d FROM bronze_orders
WHERE "timestamp" > {_NOW} - INTERVAL 30 DAY AND "timestamp" <= {_NOW}
GROUP BY customer_id""",
    )
    out["fatigue_last_7d"] = _with(
        logs,
        f"""SELECT i.customer_id, count(DISTINCT i.impression_id) AS impressions_last_7d,
       count(DISTINCT c.click_id) AS clicks_last_7d,
       round(count(DISTINCT i.impression_id) / (count(DISTINCT c.click_id) + 1.0), 2) AS user_ad_fatigue_last_7d
FROM bronze_impressions i LEFT JOIN (
  SELECT * FROM bronze_clicks WHERE "timestamp" <= {_NOW}) c
  ON i.impression_id = c.impression_id
WHERE i."timestamp" > {_NOW} - INTERVAL 7 DAY AND i."timestamp" <= {_NOW}
GROUP BY i.customer_id""",
    )
    out["orders_trailing_days"] = _with(
        logs,
        f"""SELECT customer_id, count(DISTINCT order_id) AS user_orders_last_14d FROM bronze_orders
WHERE "timestamp" > {_NOW} - INTERVAL 250 HOUR - INTERVAL 14 DAY AND "timestamp" <= {_NOW} - INTERVAL 250 HOUR
GROUP BY customer_id""",
    )
    out["fatigue_trailing_days"] = _with(
        logs,
        f"""SELECT i.customer_id, count(DISTINCT i.impression_id) AS impressions_last_7d,
       count(DISTINCT c.click_id) AS clicks_last_7d,
       round(count(DISTINCT i.impression_id) / (count(DISTINCT c.click_id) + 1.0), 2) AS user_ad_fatigue_last_7d
FROM bronze_impressions i LEFT JOIN (
  SELECT * FROM bronze_clicks WHERE "timestamp" <= {_NOW} - INTERVAL 250 HOUR) c
  ON i.impression_id = c.impression_id
WHERE i."timestamp" > {_NOW} - INTERVAL 250 HOUR - INTERVAL 7 DAY AND i."timestamp" <= {_NOW} - INTERVAL 250 HOUR
GROUP BY i.customer_id""",
    )
    out["fatigue_from_daily"] = _with(
        gold,
        """SELECT customer_id, total_impressions AS ad_impressions, total_clicks AS ad_clicks, user_ad_fatigue_score
FROM ads_u""",
    )
    out["rolling_customer_features"] = _with(
        [
            _EVENTS,
            """log AS (
  SELECT customer_id, "timestamp", NULL AS impression_id, 1 AS o, 0 AS v, 0 AS c FROM bronze_orders
  UNION ALL SELECT customer_id, "timestamp", impression_id, 0, 1, 0 FROM bronze_impressions
  UNION ALL SELECT i.customer_id, c."timestamp", NULL, 0, 0, 1
  FROM bronze_clicks c JOIN bronze_impressions i ON c.impression_id = i.impression_id),
windowed AS (
  SELECT impression_id, customer_id, "timestamp",
         CAST(COALESCE(sum(o) OVER (PARTITION BY customer_id ORDER BY "timestamp"
           RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), 0) AS BIGINT) AS o30,
         CAST(COALESCE(sum(v) OVER (PARTITION BY customer_id ORDER BY "timestamp"
           RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), 0) AS BIGINT) AS v7,
         CAST(COALESCE(sum(c) OVER (PARTITION BY customer_id ORDER BY "timestamp"
           RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), 0) AS BIGINT) AS c7
  FROM log)""",
        ],
        f"""SELECT impression_id, customer_id, strftime("timestamp", {_TS}) AS "timestamp",
       o30 AS user_orders_last_30d, v7 AS user_impressions_last_7d, c7 AS user_clicks_last_7d,
       round(v7 / (c7 + 1.0), 2) AS user_ad_fatigue_7d FROM windowed WHERE impression_id IS NOT NULL""",
    )
    out["merchant_conversion_rate"] = _with(
        silver,
        f"""SELECT c.merchant_id, c.clicks, COALESCE(s.n, 0) AS attributed_orders,
       round(COALESCE(s.n, 0) / c.clicks, 4) AS merchant_conversion_rate
FROM (SELECT merchant_id, count(DISTINCT click_id) AS clicks FROM bronze_clicks GROUP BY 1) c
LEFT JOIN (SELECT merchant_id, count(DISTINCT order_id) AS n FROM silver
           WHERE attribution_status = '{S.CLICK_STATUS}' GROUP BY 1) s ON c.merchant_id = s.merchant_id""",
    )
    out["advertiser_rollup"] = _with(
        [
            *silver,
            f"""facts AS (
  SELECT merchant_id, ad_placement, strftime("timestamp", '%Y-%m-%d') AS day, 1 AS i, 0 AS c, 0 AS o,
         CAST(0 AS DECIMAL(18,2)) AS r FROM bronze_impressions
  UNION ALL SELECT merchant_id, ad_placement, strftime("timestamp", '%Y-%m-%d'), 0, 1, 0, 0 FROM bronze_clicks
  UNION ALL SELECT merchant_id, ad_placement, strftime(order_timestamp, '%Y-%m-%d'), 0, 0, 1,
         CAST(order_amount AS DECIMAL(18,2)) FROM silver WHERE attribution_status = '{S.CLICK_STATUS}')""",
        ],
        """SELECT merchant_id, ad_placement, day, CAST(grouping(merchant_id, ad_placement, day) AS INT) AS level,
       CAST(sum(i) AS BIGINT) AS impressions, CAST(sum(c) AS BIGINT) AS clicks,
       CAST(sum(o) AS BIGINT) AS attributed_orders, CAST(sum(r) AS DOUBLE) AS attributed_revenue
FROM facts GROUP BY ROLLUP (merchant_id, ad_placement, day)""",
    )
    out["feature_sample"] = _with(
        gold,
        """SELECT customer_id, user_preferred_cuisine, user_avg_basket_value, user_ad_fatigue_score,
       user_historical_ctr FROM gold_u ORDER BY customer_id LIMIT 5""",
    )
    out["feature_table_pk_check"] = _with(
        [*gold, _LINES],
        " UNION ALL ".join(
            f"""SELECT '{name}' AS table_name, CAST(COALESCE(sum(n), 0) AS BIGINT) AS row_count,
       count(*) FILTER (k IS NOT NULL) AS distinct_keys,
       count(*) FILTER (k IS NOT NULL AND n > 1) AS repeated_keys,
       CAST(COALESCE(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS null_key_rows
FROM (SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY 1)"""
            for name, source, key in [
                ("customer_features", "gold_u", "customer_id"),
                ("merchant_features", "gold_m", "merchant_id"),
                ("line_orders", "line_orders", "order_id"),
            ]
        ),
    )
    out["meal_period"] = f"SELECT event_id, {_period('ts')} AS period FROM events"

    observed = "impression_id, customer_id, merchant_id, ad_placement, device"
    out["observations_clicked"] = _with(
        [_EVENTS, _OBSERVED], f"SELECT {observed}, has_clicked FROM observed"
    )
    out["observations_converted"] = _with(
        silver,
        f"""SELECT {observed}, CASE WHEN impression_id IN (
  SELECT attributed_impression_id FROM silver WHERE attributed_impression_id IS NOT NULL)
  THEN 1 ELSE 0 END AS has_converted FROM bronze_impressions""",
    )
    out["label_prevalence"] = _with(
        [_EVENTS, _OBSERVED],
        """SELECT count(*) AS observations, CAST(sum(has_clicked) AS BIGINT) AS positives,
       round(avg(has_clicked), 6) AS prevalence FROM observed""",
    )
    out["training_set"] = _with(training, "SELECT * FROM training")
    out["training_set_converted"] = _with(
        training,
        """SELECT t.* EXCLUDE (has_clicked), CASE WHEN t.impression_id IN (
  SELECT attributed_impression_id FROM silver WHERE attributed_impression_id IS NOT NULL) THEN 1 ELSE 0 END
  AS has_converted
FROM (SELECT DISTINCT * EXCLUDE (has_clicked), 0 AS has_clicked FROM training) t""",
    )
    out["affinity_match"] = _with(
        training,
        """SELECT impression_id, CASE WHEN user_preferred_cuisine = merchant_cuisine THEN 1 ELSE 0 END
  AS is_affinity_match FROM training""",
    )
    numeric = ", ".join(
        f"CAST(COALESCE({n}, 0) AS DOUBLE) AS {n}" for n in [*S.CUSTOMER_FEATURES, *S.MERCHANT_FEATURES]
    )
    hot = ", ".join(
        [
            f"CASE WHEN ad_placement = '{p}' THEN 1 ELSE 0 END AS ad_placement_{p}"
            for p in ("feed_banner_top", "post_order_carousel", "search_sponsored_item")
        ]
    )
    out["training_matrix"] = _with(
        training,
        f"""SELECT impression_id, {numeric},
       CAST(CASE WHEN user_preferred_cuisine = merchant_cuisine THEN 1 ELSE 0 END AS DOUBLE) AS is_affinity_match,
       {hot}, CASE WHEN device = 'ios' THEN 1 ELSE 0 END AS device_ios, has_clicked FROM training""",
    )
    out["training_set_excluding"] = _with(
        training, "SELECT * EXCLUDE (customer_id, merchant_id) FROM training"
    )
    out["training_vectors"] = _with(
        training,
        f"""SELECT {numeric},
       CAST(CASE WHEN user_preferred_cuisine = merchant_cuisine THEN 1 ELSE 0 END AS DOUBLE) AS is_affinity_match,
       {hot}, CASE WHEN device = 'ios' THEN 1 ELSE 0 END AS device_ios,
       count(*) FILTER (has_clicked = 1) AS positives, count(*) FILTER (has_clicked = 0) AS negatives
FROM training GROUP BY ALL""",
    )
    out["training_set_point_in_time"] = _with(
        [
            *silver,
            _OBSERVED,
            "numbered_obs AS (SELECT *, row_number() OVER (ORDER BY impression_id) AS rid FROM observed)",
            _SNAPSHOTS,
        ],
        f"""SELECT o.impression_id, o.customer_id, o.merchant_id, o.ad_placement, o.device,
       strftime(o."timestamp", {_TS}) AS "timestamp", o.has_clicked,
       CAST(u.orders AS BIGINT) AS user_total_orders,
       CASE WHEN u.rid IS NOT NULL THEN COALESCE(round(u.amount / NULLIF(u.amounts, 0), 2), 45.0) END
         AS user_avg_basket_value,
       CASE WHEN u.rid IS NOT NULL THEN COALESCE(round(u.coupons / NULLIF(u.amounts, 0), 3), 0.20) END
         AS user_discount_affinity,
       round(u.shown / (u.hit + 1.0), 2) AS user_ad_fatigue_score,
       CASE WHEN u.rid IS NOT NULL THEN COALESCE(round(u.hit / NULLIF(u.shown, 0), 4), 0.0) END
         AS user_historical_ctr,
       m.orders AS merchant_total_orders, round(m.amount / m.amounts, 2) AS merchant_avg_ticket,
       round(m.attributed / m.orders, 4) AS merchant_retail_media_dependency_rate,
       CASE WHEN u.rid IS NOT NULL THEN COALESCE(ut.cuisine, 'Burger') END AS user_preferred_cuisine,
       mt.cuisine AS merchant_cuisine
FROM numbered_obs o LEFT JOIN u_tot u ON o.rid = u.rid LEFT JOIN m_tot m ON o.rid = m.rid
LEFT JOIN u_top ut ON o.rid = ut.rid LEFT JOIN m_top mt ON o.rid = mt.rid""",
    )
    out["last_customer_snapshots"] = _with(
        gold,
        """SELECT customer_id, user_total_orders, user_avg_basket_value, user_discount_affinity,
       user_ad_fatigue_score, user_historical_ctr, user_preferred_cuisine FROM gold_u""",
    )
    out["batch_lookup_defaults"] = _with([*gold, _REQUESTS], _vector("serving_defaults"))
    out["batch_lookup_zero"] = _with([*gold, _REQUESTS], _vector("zero"))
    out["feature_skew_report"] = _skew()
    user_score = _propensity("user_avg_basket_value", f"user_discount_affinity > {S.PRICE_SENSITIVE_ABOVE}")
    out["heuristic_propensity"] = _with(
        gold, f"SELECT customer_id, round({user_score}, 6) AS propensity FROM gold_u"
    )
    out["binary_metrics"] = _with(
        [
            *gold,
            _OBSERVED,
            f"""scored AS (
  SELECT o.has_clicked AS y, {user_score} AS s FROM observed o JOIN gold_u g ON o.customer_id = g.customer_id),
totals AS (SELECT count(*) AS n, sum(y) AS p FROM scored),
levels AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY s),
curve AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM levels WINDOW w AS (ORDER BY s DESC))""",
        ],
        """SELECT n AS observations, CAST(p AS BIGINT) AS positives,
  round((SELECT sum(neg * (tp - pos / 2)) FROM curve) / (p * (n - p)), 6) AS auc_roc,
  round((SELECT sum(pos * tp / (tp + fp)) FROM curve) / p, 6) AS pr_auc,
  round((SELECT -avg(y * ln(s) + (1 - y) * ln(1 - s)) FROM scored), 6) AS log_loss,
  round(COALESCE((SELECT 2 * count(*) FILTER (s >= 0.25 AND y = 1) FROM scored)
    / (p + (SELECT count(*) FILTER (s >= 0.25) FROM scored)), 0.0), 6) AS f1_score
FROM totals""",
    )
    names = ("observations", "positives", "auc_roc", "pr_auc", "log_loss", "f1_score")
    out["run_log"] = " UNION ALL ".join(
        f"SELECT 'propensity' AS experiment, 'heuristic' AS run_name, '{n}' AS metric, CAST({n} AS DOUBLE) AS value "
        f"FROM ({out['binary_metrics']})"
        for n in names
    )
    out["stratified_split"] = _with(
        [
            _EVENTS,
            """labelled AS (
  SELECT impression_id, CASE WHEN impression_id IN (
    SELECT impression_id FROM bronze_clicks WHERE impression_id IS NOT NULL) THEN 1 ELSE 0 END AS has_clicked
  FROM bronze_impressions)""",
        ],
        f"""SELECT impression_id, has_clicked,
  CASE WHEN row_number() OVER (PARTITION BY has_clicked ORDER BY {_hash('impression_id', '42:')}, impression_id)
    <= floor(count(*) OVER (PARTITION BY has_clicked) * 0.20 + 0.5) THEN 1 ELSE 0 END AS is_test FROM labelled""",
    )
    shop_score = _propensity("merchant_avg_ticket", f"merchant_coupon_dependency > {S.PRICE_SENSITIVE_ABOVE}")
    out["rank_candidates"] = _with(
        [
            *gold,
            f"shops AS (SELECT merchant_id, round({shop_score}, 6) AS score FROM gold_m)",
            """ranked AS (
  SELECT i.customer_id || '@' || strftime(i."timestamp", '%Y-%m-%d') AS request_id, i.merchant_id,
         i.impression_id, s.score
  FROM bronze_impressions i JOIN shops s ON i.merchant_id = s.merchant_id)""",
        ],
        """SELECT *, CAST(row_number() OVER (PARTITION BY request_id
    ORDER BY score DESC, merchant_id, impression_id) AS INT) AS "rank" FROM ranked
QUALIFY "rank" <= 3""",
    )

    members = [*gold, _MEMBERS]
    out["customer_segments"] = _with(members, "SELECT * FROM members")
    out["segment_profile"] = _with([*members, _profile(3)], "SELECT * FROM profile")
    out["segment_prompts"] = _with(
        [*members, _profile(3)],
        """SELECT segment_id, cuisine, discount_sensitive, period,
       'Gere 5 textos de ate 60 caracteres para o publico de ' || cuisine || ', '
         || CASE WHEN discount_sensitive THEN 'sensivel a desconto' ELSE 'sem foco em desconto' END
         || ', no periodo ' || period || '.' AS prompt FROM profile""",
    )
    out["creative_generation"] = _with(_CREATIVE, "SELECT * FROM generated")
    out["creative_guardrails"] = _with(
        [*members, _profile(1), _texts(), _guarded("generated", 60, ("erro", "relâmpago"))],
        "SELECT * FROM guarded",
    )
    out["document_guardrails"] = _with(
        [
            "docs AS (SELECT doc_id, text AS copy_text FROM documents)",
            _guarded("docs", texts.MAX_CHARS, texts.BANNED_TERMS),
        ],
        "SELECT doc_id, n_chars, status, reason FROM guarded",
    )
    out["creative_catalog"] = _with(_BANDIT, "SELECT * EXCLUDE (arm) FROM catalog")
    out["customer_context"] = _with(
        gold,
        f"""SELECT customer_id, known, cuisine, discount_sensitive, avg_ticket, fatigue,
       round({_propensity('avg_ticket', 'discount_sensitive')}, 6) AS propensity FROM (
  SELECT printf('usr_%06d', c_custkey) AS customer_id, g.customer_id IS NOT NULL AS known,
         COALESCE(g.user_preferred_cuisine, 'Pizza') AS cuisine,
         COALESCE(g.user_discount_affinity > {S.PRICE_SENSITIVE_ABOVE}, FALSE) AS discount_sensitive,
         COALESCE(g.user_avg_basket_value, 50.0) AS avg_ticket, COALESCE(g.user_ad_fatigue_score, 1.0) AS fatigue
  FROM customer LEFT JOIN gold_u g ON printf('usr_%06d', c_custkey) = g.customer_id)""",
    )
    out["arm_stats"] = _with(
        _BANDIT, "SELECT creative_id, segment_id, CAST(arm AS INT) AS arm, impressions, clicks FROM stats"
    )
    out["best_arm"] = _with(_BANDIT, "SELECT segment_id, creative_id, ctr, arms FROM best")
    first = "(SELECT min(creative_id) FROM catalog)"
    out["creative_decisions_greedy"] = _with(
        _BANDIT,
        f"""SELECT r.request_id, r.segment_id, COALESCE(b.creative_id, {first}) AS creative_id, FALSE AS explored
FROM ad_requests r LEFT JOIN best b ON r.segment_id = b.segment_id""",
    )
    out["creative_decisions_egreedy"] = _with(
        _BANDIT,
        f"""SELECT r.request_id, r.segment_id, COALESCE(s.creative_id, b.creative_id, {first}) AS creative_id,
       s.creative_id IS NOT NULL AS explored
FROM ad_requests r LEFT JOIN best b ON r.segment_id = b.segment_id
LEFT JOIN stats s ON r.segment_id = s.segment_id AND {_hash('r.request_id', 'explore:42:')} % 10000 < 1500
  AND {_hash('r.request_id', 'arm:42:')} % b.arms = s.arm""",
    )
    out["propensity_checks"] = _with(
        [_EVENTS, _OBSERVED],
        """SELECT has_clicked, count(*) AS observations, count(*) AS probabilities, count(*) AS repeated
FROM observed GROUP BY has_clicked""",
    )
    out["score_request_checks"] = _with(
        gold,
        """SELECT i.impression_id AS request_id, u.customer_id IS NOT NULL AS customer_found,
       m.merchant_id IS NOT NULL AS merchant_found, TRUE AS is_probability
FROM bronze_impressions i LEFT JOIN gold_u u ON i.customer_id = u.customer_id
LEFT JOIN gold_m m ON i.merchant_id = m.merchant_id""",
    )
    out["thompson_checks"] = _with(
        _BANDIT,
        """SELECT request_id, segment_id, coalesce(segment_id IN (SELECT segment_id FROM catalog), FALSE) AS in_segment,
       TRUE AS repeats FROM ad_requests""",
    )
    out["ad_decisions"] = _with(
        [
            *_BANDIT,
            """asked AS (
  SELECT r.request_id, CASE WHEN substr(r.request_id, -2) IN ('00', '50') THEN 'seg_pizza_promo_jantar'
         ELSE r.segment_id END AS segment_id, i.customer_id
  FROM ad_requests r JOIN bronze_impressions i ON r.request_id = i.impression_id)""",
            f"""chosen AS (
  SELECT r.*, COALESCE(s.creative_id, b.creative_id, {first}) AS creative_id, s.creative_id IS NOT NULL AS explored
  FROM asked r LEFT JOIN best b ON r.segment_id = b.segment_id
  LEFT JOIN stats s ON r.segment_id = s.segment_id AND {_hash('r.request_id', 'explore:42:')} % 10000 < 1500
    AND {_hash('r.request_id', 'arm:42:')} % b.arms = s.arm)""",
            f"""context AS (
  SELECT c.*, g.customer_id IS NOT NULL AS known, COALESCE(g.user_preferred_cuisine, 'Pizza') AS cuisine,
         COALESCE(g.user_discount_affinity > {S.PRICE_SENSITIVE_ABOVE}, FALSE) AS discount_sensitive,
         COALESCE(g.user_avg_basket_value, 50.0) AS avg_ticket, COALESCE(g.user_ad_fatigue_score, 1.0) AS fatigue
  FROM chosen c LEFT JOIN gold_u g ON c.customer_id = g.customer_id)""",
        ],
        f"""SELECT x.request_id, x.customer_id, known, x.cuisine, x.discount_sensitive, avg_ticket, fatigue,
       round({_propensity('avg_ticket', 'x.discount_sensitive')}, 6) AS propensity, x.segment_id, x.creative_id,
       k.copy_text, explored
FROM context x LEFT JOIN catalog k ON x.creative_id = k.creative_id""",
    )
    out["ab_assignment"] = f"""SELECT customer_id, bucket, CASE WHEN bucket < 5000 THEN 'control'
  WHEN bucket < 8000 THEN 'bandit' ELSE 'holdout' END AS variant FROM (
  SELECT customer_id, CAST({_hash('customer_id', 'ab:')} % 10000 AS INT) AS bucket
  FROM (SELECT printf('usr_%06d', c_custkey) AS customer_id FROM customer))"""

    out["pseudonymized_features"] = _with(
        gold, "SELECT * REPLACE (sha256('adlift:' || customer_id) AS customer_id) FROM gold_u"
    )
    out["masked_orders"] = _with(
        [_LINES],
        """SELECT order_id, substr(customer_id, 1, 4) || '***' AS customer_id, merchant_id,
       CAST(NULL AS DOUBLE) AS order_amount, used_coupon, 'hidden' AS cuisine FROM line_orders""",
    )
    out["row_filtered_silver"] = _with(
        lines,
        f"""{_SILVER_ROWS} line_silver WHERE merchant_id IN (
  SELECT printf('merch_%04d', s_suppkey) FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')""",
    )

    out["stream_bronze_ingest"] = _with(
        logs, f"""SELECT * REPLACE (strftime("timestamp", {_TS}) AS "timestamp") FROM bronze_impressions"""
    )
    out["stream_dedup_orders"] = _with(
        logs, f"""SELECT * REPLACE (strftime("timestamp", {_TS}) AS "timestamp") FROM bronze_orders"""
    )
    out["stream_attribution"] = out["attribution_asof"]
    out["stream_click_matches"] = _with(
        silver,
        """SELECT order_id, attributed_click_id AS click_id, hours_from_click_to_order FROM silver
WHERE attributed_click_id IS NOT NULL""",
    )
    out["stream_view_through"] = out["attribution_view_through"]
    out["stream_late_orders"] = _with(
        [_LINES],
        """SELECT order_id, CAST(1 AS BIGINT) AS times,
       date_diff('day', CAST(max("timestamp") AS DATE), (SELECT CAST(max("timestamp") AS DATE) FROM line_orders)) >= 180 AS late
FROM line_orders GROUP BY order_id""",
    )
    out["creative_weights"] = _with(
        [
            *_BANDIT,
            """
fed_back AS (
  SELECT a.creative_id, a.segment_id, COALESCE(s.n, 0) AS shown, CAST(COALESCE(s.c, 0) AS BIGINT) AS clicked
  FROM arms0 a LEFT JOIN served s ON a.creative_id = s.creative_id),
rates AS (SELECT segment_id, (sum(clicked) + 1) / (sum(shown) + 2) AS rate FROM fed_back GROUP BY segment_id)""",
        ],
        """SELECT creative_id, segment_id, shown, clicked,
       round((clicked + 10 * rate) / (shown + 10) / rate, 6) AS mab_arm_weight
FROM fed_back JOIN rates USING (segment_id)""",
    )
    return out
