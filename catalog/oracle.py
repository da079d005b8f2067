"""SQL counterparts of the registered queries, written apart from the DataFrame code."""

from __future__ import annotations

from newsquake import constants as K


def _bits(key: str, salt: str) -> str:
    return f"('0x' || substr(sha256(({key})::VARCHAR || ':{salt}'), 1, 8))::BIGINT"


def _draw(key: str, salt: str) -> str:
    return f"({_bits(key, salt)} / 4294967295.0::DOUBLE)"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _r(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


_SECTORS = ", ".join(
    f"({_q(name)}, {K.SECTOR_MEDIAN_PE.get(name, 'NULL')}::DOUBLE, {str(name in K.ASSET_HEAVY_SECTORS).lower()}, "
    f"{str(name in K.REIT_SECTORS).lower()})"
    for name in sorted({*K.SECTOR_MEDIAN_PE, *K.SECTOR_KEYWORDS, *K.ASSET_HEAVY_SECTORS, *K.REIT_SECTORS})
)
_FUSION = ", ".join(f"({_q(a)}, {_q(b)}, {_q(c)}, {d}::DOUBLE)" for a, b, c, d in K.FUSION_ROWS)
_CLASSES = "(VALUES (1,'good'),(2,'bad'),(3,'neutral'),(4,'overreaction_down'),(5,'overreaction_up'))"
_DENIED = "^(marketbeat|stocktwits|gurufocus|trefis|simply wall st|simplywall st|zacks|stockstory|tikr|moomoo|tradingkey|quiver quantitative)( |$)"
_KEYWORDS = {
    "Energy": r"\b(refinery|pipeline|drilling|crude|opec|oil|gas)\b",
    "Technology": r"\b(artificial intelligence|cybersecurity|semiconductor|data centers|data center|software|cloud|chips|chip|ai)\b",
    "Financial Services": r"\b(federal reserve|interest rates|rate hike|rate cut|payments|banking|fintech|credit|fed)\b",
    "Industrials": r"\b(manufacturing|supply chain|aerospace|aviation|factory|defense|airline)\b",
}
_KEYWORD_CASE = "CASE sector " + " ".join(f"WHEN {_q(k)} THEN {_q('(?i)' + v)}" for k, v in _KEYWORDS.items()) + " END"
_SCEN = "(VALUES ('normal'), ('best'), ('worst'))"


def _classify(m1: str, m21: str, ok: str, x: str, y: str, z: str) -> str:
    return f"""CASE WHEN {m1} IS NULL THEN NULL
      WHEN {ok} AND {m21} IS NOT NULL AND {m1} <= -({y}) AND ({m21} - {m1}) / abs({m1}) >= {z} THEN 'overreaction_down'
      WHEN {ok} AND {m21} IS NOT NULL AND {m1} >= {y} AND ({m1} - {m21}) / {m1} >= {z} THEN 'overreaction_up'
      WHEN {m1} >= {x} THEN 'good' WHEN {m1} <= -({x}) THEN 'bad' ELSE 'neutral' END"""


PRELUDE = f"""WITH
ent AS (
  SELECT n_nationkey AS entity_key, n_name AS ticker, 'Nation ' || n_nationkey || ' Holdings Inc.' AS name,
    CASE n_regionkey WHEN 0 THEN 'Energy' WHEN 1 THEN 'Technology' WHEN 2 THEN 'Real Estate'
      WHEN 3 THEN 'Financial Services' ELSE 'Industrials' END AS sector
  FROM nation),
sec(sector, median_pe, asset_heavy, reit) AS (VALUES {_SECTORS}),
fusion(reaction, bucket, recommendation, base) AS (VALUES {_FUSION}),
sales AS (
  SELECT e.ticker, e.entity_key, l_shipdate::DATE AS day,
    (date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS quarter_end,
    sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cents,
    sum(l_quantity::BIGINT)::BIGINT AS units,
    sum(round(l_extendedprice * 100)::BIGINT * (round(l_discount * 100)::BIGINT - 2 - s_nationkey % 6))::BIGINT AS profit
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN ent e ON s_nationkey = e.entity_key
  GROUP BY 1, 2, 3, 4),
prices AS (SELECT ticker, day AS trade_date, cents::DOUBLE / 100.0::DOUBLE / units::DOUBLE AS close FROM sales),
quarters AS (
  SELECT ticker, entity_key, quarter_end, sum(cents)::BIGINT AS cents, sum(units)::BIGINT AS units,
    sum(profit)::DOUBLE / 10000.0::DOUBLE / sum(units)::DOUBLE AS eps
  FROM sales GROUP BY 1, 2, 3),
eps_q AS (SELECT ticker, entity_key, quarter_end AS period_end, eps AS value FROM quarters),
rev_q AS (SELECT ticker, quarter_end AS period_end, cents::DOUBLE / 100.0::DOUBLE AS revenue FROM quarters),
earnings AS (
  SELECT ticker, (quarter_end + INTERVAL 20 DAY)::TIMESTAMP + INTERVAL 18 HOUR AS event_ts,
    lag(eps) OVER (PARTITION BY ticker ORDER BY quarter_end) AS eps_estimate,
    CASE WHEN lead(eps) OVER (PARTITION BY ticker ORDER BY quarter_end) IS NOT NULL THEN eps END AS eps_reported
  FROM quarters),
cust AS (SELECT c_nationkey, count(*) AS customers, sum(round(c_acctbal * 100)::BIGINT)::BIGINT AS balance FROM customer GROUP BY 1),
fund AS (
  SELECT ticker, sector, entity_key AS k, customers * 200.0::DOUBLE AS shares_outstanding,
    CASE WHEN k % 9 <> 4 THEN (k * 7 % 13) / 10.0::DOUBLE END AS payout_ratio,
    CASE WHEN k % 8 <> 3 THEN (balance * (k % 4 - 1))::DOUBLE / 100.0::DOUBLE END AS free_cash_flow,
    CASE WHEN k % 3 <> 0 THEN (k * 3 % 11) * 2.0::DOUBLE END AS dividend_rate,
    CASE WHEN k % 6 <> 1 THEN (k * 5 % 17 - 4) / 100.0::DOUBLE END AS growth_0y,
    CASE WHEN k % 6 <> 1 THEN (k * 5 % 17 - 4) / 100.0::DOUBLE + 0.02::DOUBLE END AS growth_1y,
    CASE WHEN k % 4 <> 2 THEN (k * 5 % 17 - 4) / 100.0::DOUBLE - 0.03::DOUBLE END AS growth_0y_low,
    CASE WHEN k % 5 <> 3 THEN (k * 5 % 17 - 4) / 100.0::DOUBLE + 0.25::DOUBLE END AS growth_0y_high,
    CASE WHEN k % 4 = 0 THEN (k * 3 % 7) * 0.13::DOUBLE END AS eps_growth_5y,
    CASE WHEN k % 7 <> 5 THEN 150.0::DOUBLE + (k * 11 % 23) * 40.0::DOUBLE END AS book_value_per_share,
    CASE WHEN k % 10 <> 9 THEN (k * 4 % 9) * 0.03::DOUBLE END AS operating_margin,
    'USD' AS currency, CASE WHEN k % 12 = 7 THEN 'EUR' ELSE 'USD' END AS financial_currency,
    CASE WHEN k % 5 <> 0 THEN 4.0::DOUBLE + (k * 6 % 31) * 1.5::DOUBLE END AS pe_forward,
    CASE WHEN k % 3 <> 0 THEN (k * 2 % 9) * 0.5::DOUBLE END AS dividend_yield,
    CASE WHEN k % 5 <> 2 THEN 500.0::DOUBLE + k * 10.0::DOUBLE END AS year_low,
    CASE WHEN k % 5 <> 2 THEN 5000.0::DOUBLE + k * 10.0::DOUBLE END AS year_high
  FROM ent LEFT JOIN cust ON c_nationkey = entity_key),
feed AS (
  SELECT e.ticker, e.sector, o_orderkey AS feed_pos, o_orderdate AS published_at,
    CASE o_orderkey % 12
      WHEN 0 THEN 'Nation ' || entity_key || ' signs a supply deal (' || o_orderkey % 499 || ')'
      WHEN 1 THEN ticker || ' Stock Trades Up, Here Is Why'
      WHEN 2 THEN 'Should You Buy ' || ticker || ' Stock?'
      WHEN 3 THEN 'OPEC agrees to cut oil output (' || o_orderkey % 499 || ')'
      WHEN 4 THEN 'New cloud software rules announced (' || o_orderkey % 499 || ')'
      WHEN 5 THEN 'Rate hike worries weigh on lenders (' || o_orderkey % 499 || ')'
      WHEN 6 THEN o_custkey || ' Shares in ' || ticker || ' Purchased by Trust'
      WHEN 7 THEN 'Nation ' || entity_key || ' raises full-year guidance (' || o_orderkey % 499 || ')'
      WHEN 8 THEN 'Markets close mixed on light volume (' || o_orderkey % 499 || ')'
      WHEN 9 THEN '(' || ticker || ') cuts outlook after order slump (' || o_orderkey % 499 || ')'
      WHEN 10 THEN 'Nation ' || entity_key || ' reports record quarter (' || o_orderkey % 499 || ') - analysts'
      ELSE 'Factory output slows for suppliers (' || o_orderkey % 499 || ')' END
    || CASE o_custkey % 8 WHEN 0 THEN ' - Reuters' WHEN 1 THEN ' - Bloomberg' WHEN 2 THEN ' - MarketBeat'
      WHEN 3 THEN ' - marketbeat.com' WHEN 4 THEN ' - CNBC' WHEN 5 THEN ' - Tikrit Daily'
      WHEN 6 THEN ' - Zacks Investment Research' ELSE '' END AS feed_title,
    o_orderstatus <> 'P' AS relevant, 6 - substr(o_orderpriority, 1, 1)::INT AS importance, o_totalprice >= 20000 AS assessed
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN ent e ON c_nationkey = e.entity_key),
headlines AS (
  SELECT ticker, sector, feed_pos, published_at, published_at::DATE AS as_of,
    ceil((DATE '2001-11-22' - published_at::DATE) / 7.0)::INT AS window_idx,
    CASE WHEN contains(feed_title, ' - ') THEN regexp_extract(feed_title, '^(.*) - (.*)$', 1) ELSE feed_title END AS title,
    CASE WHEN contains(feed_title, ' - ') THEN regexp_extract(feed_title, '^(.*) - (.*)$', 2) ELSE 'Google News' END AS publisher
  FROM feed),
assess AS (SELECT ticker, feed_pos, relevant, importance FROM feed WHERE assessed),
bars AS (
  SELECT ticker, trade_date, close, row_number() OVER w AS bar_no, lag(trade_date) OVER w AS prev_date,
    lag(close) OVER w AS prev_close, lead(trade_date, 21) OVER w AS ahead_date, lead(close, 21) OVER w AS ahead_close
  FROM prices WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
events_on_axis AS (
  SELECT e.ticker, e.event_ts, b.bar_no AS event_bar FROM earnings e LEFT JOIN bars b
    ON b.ticker = e.ticker AND b.trade_date >= e.event_ts::DATE AND (b.prev_date IS NULL OR b.prev_date < e.event_ts::DATE)),
days AS (SELECT DISTINCT ticker, as_of FROM headlines),
next_event AS (
  SELECT d.ticker, d.as_of, min(e.event_ts) AS event_ts FROM days d JOIN earnings e
    ON e.ticker = d.ticker AND e.event_ts > d.as_of::TIMESTAMP GROUP BY 1, 2),
located AS (
  SELECT d.ticker, d.as_of, b.trade_date, b.close, b.bar_no, b.prev_date, b.prev_close, b.ahead_date, b.ahead_close,
    n.event_ts, x.event_bar - b.bar_no AS bars_to_event
  FROM days d
  LEFT JOIN bars b ON b.ticker = d.ticker AND b.trade_date >= d.as_of AND (b.prev_date IS NULL OR b.prev_date < d.as_of)
  LEFT JOIN next_event n ON n.ticker = d.ticker AND n.as_of = d.as_of
  LEFT JOIN events_on_axis x ON x.ticker = n.ticker AND x.event_ts = n.event_ts),
reasoned AS (
  SELECT *, CASE
      WHEN trade_date IS NULL OR prev_date IS NULL OR trade_date >= as_of + 39 OR prev_date < as_of - 7 OR prev_close = 0
        THEN 'insufficient_history'
      WHEN bars_to_event <= 0 THEN 'earnings_within_1d' END AS skip_reason
  FROM located),
measured AS (
  SELECT ticker, as_of, trade_date AS day0_date, bars_to_event, skip_reason,
    CASE WHEN skip_reason IS NULL THEN (close - prev_close) / prev_close END AS move_1d,
    CASE WHEN skip_reason IS NULL AND ahead_date < as_of + 39 THEN (ahead_close - prev_close) / prev_close END AS move_21d,
    skip_reason IS NULL AND coalesce(bars_to_event > 21, true) AS assessable
  FROM reasoned),
day_labels AS (SELECT *, {_classify('move_1d', 'move_21d', 'assessable', '0.01', '0.03', '0.5')} AS news_reaction FROM measured),
eps_ttm AS (
  SELECT ticker, period_end, CASE WHEN lag(value, 3) OVER w IS NOT NULL
      THEN value + lag(value, 1) OVER w + lag(value, 2) OVER w + lag(value, 3) OVER w ELSE value * 4 END AS eps_ttm
  FROM eps_q WINDOW w AS (PARTITION BY ticker ORDER BY period_end)),
rev_pairs AS (
  SELECT r.ticker, r.period_end, max(p.period_end) AS year_ago_period FROM rev_q r JOIN rev_q p
    ON p.ticker = r.ticker AND abs(p.period_end - (r.period_end - INTERVAL 12 MONTH)::DATE) < 20 GROUP BY 1, 2),
rev_ya AS (
  SELECT r.ticker, r.period_end, r.revenue, p.revenue AS year_ago FROM rev_q r
  LEFT JOIN rev_pairs x ON x.ticker = r.ticker AND x.period_end = r.period_end
  LEFT JOIN rev_q p ON p.ticker = x.ticker AND p.period_end = x.year_ago_period),
px AS (
  SELECT d.ticker, d.as_of, max(p.trade_date) AS price_date FROM days d JOIN prices p
    ON p.ticker = d.ticker AND p.trade_date BETWEEN d.as_of - 10 AND d.as_of GROUP BY 1, 2),
lastq AS (
  SELECT d.ticker, d.as_of, max(q.period_end) AS period_end FROM days d JOIN rev_q q
    ON q.ticker = d.ticker AND q.period_end < d.as_of GROUP BY 1, 2),
lastr AS (
  SELECT d.ticker, d.as_of, max(e.event_ts) AS event_ts FROM days d JOIN earnings e
    ON e.ticker = d.ticker AND e.event_ts < d.as_of::TIMESTAMP AND e.eps_reported IS NOT NULL GROUP BY 1, 2),
facts AS (
  SELECT d.ticker, d.as_of, px.price_date, p.close AS price, t.eps_ttm, q.period_end AS last_quarter, v.revenue,
    v.year_ago AS year_ago_revenue, e.eps_reported AS last_eps, e.eps_estimate AS last_estimate, n.event_ts::DATE AS next_earnings
  FROM days d
  LEFT JOIN px ON px.ticker = d.ticker AND px.as_of = d.as_of
  LEFT JOIN prices p ON p.ticker = px.ticker AND p.trade_date = px.price_date
  LEFT JOIN lastq q ON q.ticker = d.ticker AND q.as_of = d.as_of
  LEFT JOIN eps_ttm t ON t.ticker = q.ticker AND t.period_end = q.period_end
  LEFT JOIN rev_ya v ON v.ticker = q.ticker AND v.period_end = q.period_end
  LEFT JOIN lastr r ON r.ticker = d.ticker AND r.as_of = d.as_of
  LEFT JOIN earnings e ON e.ticker = r.ticker AND e.event_ts = r.event_ts
  LEFT JOIN next_event n ON n.ticker = d.ticker AND n.as_of = d.as_of),
m1 AS (
  SELECT f.*, u.* EXCLUDE (ticker, sector, k), u.sector, s.median_pe, coalesce(s.asset_heavy, false) AS asset_heavy,
    coalesce(s.reit, false) AS reit, nullif(f.eps_ttm, 0) AS eps_known, f.price * nullif(u.shares_outstanding, 0) AS market_cap,
    f.revenue * 4 AS annual_revenue, CASE WHEN f.eps_ttm > 0 THEN f.price / f.eps_ttm END AS pe_trailing,
    (f.last_eps - nullif(f.last_estimate, 0)) / abs(nullif(f.last_estimate, 0)) AS eps_surprise
  FROM facts f LEFT JOIN fund u ON u.ticker = f.ticker LEFT JOIN sec s ON s.sector = u.sector),
m2 AS (
  SELECT *,
    CASE WHEN eps_known > 0 AND book_value_per_share > 0 AND eps_known / book_value_per_share >= 0.02
      THEN least(eps_known / book_value_per_share, 0.25) * (1 - coalesce(payout_ratio, 0)) END AS sgr,
    CASE WHEN reit THEN 'dividends' WHEN eps_known IS NULL OR eps_known <= 0 THEN 'revenue'
      WHEN payout_ratio BETWEEN 0.55 AND 1.20 THEN 'dividends'
      WHEN asset_heavy AND free_cash_flow > 0 THEN 'fcf' ELSE 'eps' END AS first_basis,
    CASE WHEN book_value_per_share > 0 THEN eps_known / book_value_per_share END AS roe,
    CASE WHEN annual_revenue > 0 THEN nullif(market_cap, 0) / annual_revenue END AS price_to_sales,
    CASE WHEN market_cap > 0 THEN free_cash_flow / market_cap END AS fcf_yield,
    CASE WHEN growth_0y > 0.02 THEN pe_trailing / (growth_0y * 100) END AS peg_ratio,
    CASE WHEN book_value_per_share > 0 THEN nullif(price, 0) / book_value_per_share END AS price_to_book,
    CASE WHEN pe_trailing > 0 AND pe_forward > 0 AND pe_trailing < pe_forward * 0.5 THEN price / pe_forward
      WHEN pe_trailing > 0 AND pe_trailing < 6 AND (pe_forward IS NULL OR (pe_forward > 0 AND pe_forward < 6)) THEN NULL
      ELSE eps_known END AS cf_eps,
    dividend_rate AS cf_dividends,
    CASE WHEN currency = financial_currency THEN nullif(free_cash_flow, 0) / nullif(market_cap / price, 0) END AS cf_fcf,
    CASE WHEN currency = financial_currency THEN nullif(annual_revenue, 0) / nullif(market_cap / price, 0) END AS cf_revenue
  FROM m1),
scen AS (
  SELECT m2.*, s.name,
    greatest(least(CASE
      WHEN abs(eps_growth_5y) <= 0.6 THEN CASE WHEN sgr IS NULL THEN eps_growth_5y ELSE (eps_growth_5y + sgr) / 2 END
        + CASE s.name WHEN 'best' THEN 0.02 WHEN 'worst' THEN -0.04 ELSE 0 END
      WHEN (growth_0y >= 0) = (growth_1y >= 0) AND abs(growth_0y) <= 0.6 AND abs(growth_1y) <= 0.6 THEN (growth_0y + growth_1y) / 2
        + CASE s.name
          WHEN 'best' THEN CASE WHEN growth_0y_high IS NOT NULL THEN least(growth_0y_high - growth_0y, 0.1)
            WHEN growth_0y_low IS NOT NULL THEN least(growth_0y - growth_0y_low, 0.1) ELSE 0.02 END
          WHEN 'worst' THEN -CASE WHEN growth_0y_low IS NOT NULL THEN least(growth_0y - growth_0y_low, 0.1)
            WHEN growth_0y_high IS NOT NULL THEN least(growth_0y_high - growth_0y, 0.1) ELSE 0.04 END
          ELSE 0 END
      WHEN sgr IS NOT NULL THEN sgr + CASE s.name WHEN 'best' THEN 0.02 WHEN 'worst' THEN -0.04 ELSE 0 END
      ELSE CASE s.name WHEN 'best' THEN 0.10 WHEN 'worst' THEN 0.04 ELSE 0.08 END END, 0.30), -0.10)::DOUBLE AS g1,
    CASE s.name WHEN 'best' THEN 0.12 WHEN 'worst' THEN 0.04 ELSE 0.10 END::DOUBLE AS g2_ceiling,
    (least(20.0, coalesce(greatest(median_pe, pe_trailing), 20.0)))::DOUBLE AS normal_exit,
    CASE WHEN asset_heavy THEN 12.0 ELSE 13.0 END::DOUBLE AS worst_exit
  FROM m2 CROSS JOIN {_SCEN} AS s(name)),
scen2 AS (
  SELECT *, greatest(0.0, least(g2_ceiling, g1))::DOUBLE AS g2, greatest(g1, -0.05)::DOUBLE AS g2d,
    CASE name WHEN 'normal' THEN normal_exit WHEN 'best' THEN normal_exit + 5 ELSE worst_exit END AS exit_market,
    CASE name WHEN 'normal' THEN 20.0 WHEN 'best' THEN 25.0 ELSE worst_exit END::DOUBLE AS exit_dividends,
    CASE name WHEN 'normal' THEN 3.0 WHEN 'best' THEN 6.0 ELSE 1.0 END::DOUBLE AS exit_revenue
  FROM scen),
scen3 AS (
  SELECT ticker, as_of, name,
    cf_eps * pow(1 + g1, 5) * pow(1 + g2, 5) * exit_market / pow(1.1, 10) AS pv_eps,
    cf_fcf * pow(1 + g1, 5) * pow(1 + g2, 5) * exit_market / pow(1.1, 10) AS pv_fcf,
    cf_revenue * pow(1 + g1, 5) * pow(1 + g2, 5) * exit_revenue / pow(1.1, 10) AS pv_revenue,
    cf_dividends * (list_sum([pow(1 + g1, y) / pow(1.1, y) FOR y IN [1, 2, 3, 4, 5]])
      + list_sum([pow(1 + g1, 5) * pow(1 + g2d, y - 5) / pow(1.1, y) FOR y IN [6, 7, 8, 9, 10]])
      + pow(1 + g1, 5) * pow(1 + g2d, 5) * exit_dividends / pow(1.1, 10)) AS pv_dividends,
    coalesce(nullif(dividend_rate, 0) * list_sum([pow(1 + g2, y) / pow(1.1, y) FOR y IN [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]]), 0) AS stream
  FROM scen2),
ivs AS (
  SELECT ticker, as_of, sum(pv_eps) / 3 AS e, sum(pv_fcf) / 3 AS f, sum(pv_revenue) / 3 AS r, sum(pv_dividends) / 3 AS d, sum(stream) / 3 AS s
  FROM scen3 GROUP BY 1, 2),
m3 AS (
  SELECT m2.*, CASE WHEN cf_eps > 0 THEN e END AS iv_eps, CASE WHEN cf_fcf > 0 THEN f END AS iv_fcf,
    CASE WHEN cf_revenue > 0 THEN r END AS iv_revenue, CASE WHEN cf_dividends > 0 THEN d END AS iv_dividends, s AS stream_pv,
    first_basis = 'eps' AND coalesce(eps_surprise > 0.75, false) AS gated,
    CASE WHEN first_basis <> 'revenue' AND NOT reit AND payout_ratio BETWEEN 0.5::DOUBLE AND 0.6000000000000001::DOUBLE
      THEN (payout_ratio - 0.5::DOUBLE) / (0.6000000000000001::DOUBLE - 0.5::DOUBLE) END AS t,
    CASE WHEN asset_heavy AND free_cash_flow > 0 THEN 'fcf' ELSE 'eps' END AS other
  FROM m2 JOIN ivs ON ivs.ticker = m2.ticker AND ivs.as_of = m2.as_of),
m4 AS (
  SELECT *, CASE other WHEN 'fcf' THEN iv_fcf ELSE iv_eps END AS other_iv,
    CASE first_basis WHEN 'eps' THEN iv_eps + stream_pv WHEN 'fcf' THEN iv_fcf + stream_pv
      WHEN 'revenue' THEN iv_revenue + stream_pv ELSE iv_dividends END AS first_iv
  FROM m3),
m5 AS (
  SELECT *, CASE WHEN t IS NULL THEN first_iv WHEN iv_dividends IS NOT NULL AND other_iv IS NOT NULL
        THEN t * iv_dividends + (1 - t) * other_iv ELSE coalesce(iv_dividends, other_iv) END AS tried,
    CASE WHEN t IS NULL THEN first_basis
      WHEN iv_dividends IS NOT NULL AND (other_iv IS NULL OR t >= 0.5) THEN 'dividends' ELSE other END AS tried_basis
  FROM m4),
m6 AS (
  SELECT *, CASE WHEN tried IS NULL AND NOT gated THEN CASE
      WHEN tried_basis <> 'fcf' AND iv_fcf IS NOT NULL THEN 'fcf' WHEN tried_basis <> 'eps' AND iv_eps IS NOT NULL THEN 'eps'
      WHEN tried_basis <> 'dividends' AND iv_dividends IS NOT NULL THEN 'dividends'
      WHEN tried_basis <> 'revenue' AND iv_revenue IS NOT NULL THEN 'revenue' END END AS fb
  FROM m5),
valued AS (
  SELECT *, CASE WHEN price IS NULL THEN NULL WHEN gated THEN 'eps' ELSE coalesce(fb, tried_basis) END AS basis,
    CASE WHEN price IS NOT NULL AND NOT gated THEN coalesce(tried, CASE fb WHEN 'fcf' THEN iv_fcf + stream_pv
      WHEN 'eps' THEN iv_eps + stream_pv WHEN 'dividends' THEN iv_dividends WHEN 'revenue' THEN iv_revenue + stream_pv END) END AS intrinsic
  FROM m6),
gaps AS (SELECT *, (price - intrinsic) / intrinsic * 100 AS gap_pct FROM valued),
shown AS (
  SELECT *, CASE WHEN abs(gap_pct) >= 1 THEN sign(gap_pct) * CASE WHEN abs(gap_pct) > 150 THEN 150 ELSE round_even(abs(gap_pct), 0) END END AS text_gap
  FROM gaps),
signals AS (
  SELECT l.*, s.* EXCLUDE (ticker, as_of), u.recommendation,
    CASE WHEN l.news_reaction IS NOT NULL THEN b.bucket END AS valuation_bucket,
    CASE WHEN l.news_reaction IS NOT NULL THEN round(CASE WHEN b.bucket = 'no_data' THEN u.base
      ELSE least(0.95, u.base + 0.10 * least(abs(s.text_gap) / 50.0, 1.0)) END, 2) END AS confidence
  FROM day_labels l JOIN shown s ON s.ticker = l.ticker AND s.as_of = l.as_of
  JOIN (SELECT ticker, as_of, CASE WHEN text_gap IS NULL THEN 'no_data' WHEN text_gap <= -15 THEN 'undervalued'
      WHEN text_gap >= 15 THEN 'overvalued' ELSE 'near_fair' END AS bucket FROM shown) b ON b.ticker = l.ticker AND b.as_of = l.as_of
  LEFT JOIN fusion u ON u.reaction = l.news_reaction AND u.bucket = b.bucket),
unseen AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, title ORDER BY window_idx, feed_pos) AS seen FROM headlines) WHERE seen = 1),
pool AS (
  SELECT p.*, a.relevant, a.importance,
    count(*) OVER (PARTITION BY p.ticker, p.window_idx) = count(a.importance) OVER (PARTITION BY p.ticker, p.window_idx) AS covered
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, window_idx ORDER BY feed_pos) AS pool_rank FROM unseen) WHERE pool_rank <= 30) p
  LEFT JOIN assess a ON a.ticker = p.ticker AND a.feed_pos = p.feed_pos),
ruled AS (
  SELECT u.*, regexp_matches(array_to_string(regexp_extract_all(lower(u.publisher), '[a-z0-9]+'), ' '), '{_DENIED}') AS denied,
    regexp_matches(u.title, {_q('(?i)' + K.LOW_CONTENT_PATTERN)}) AS low_content,
    regexp_matches(lower(replace(replace(u.title, '.', ''), ',', '')), '\\bnation ' || e.entity_key || '\\b') AS by_name,
    regexp_matches(u.title, '\\b' || u.ticker || '\\b') AS by_ticker,
    coalesce(regexp_matches(u.title, {_KEYWORD_CASE.replace('sector', 'u.sector', 1)}), false) AS by_sector
  FROM unseen u JOIN ent e ON e.ticker = u.ticker),
selected AS (
  SELECT ticker, window_idx, feed_pos, title, publisher, published_at, as_of, 'screen' AS path,
    CASE WHEN NOT relevant THEN 'screen_not_relevant' WHEN importance < 3 THEN 'screen_unimportant' END AS skip_reason,
    -importance::BIGINT AS order_1, -epoch_us(published_at) AS order_2
  FROM pool WHERE covered
  UNION ALL
  SELECT ticker, window_idx, feed_pos, title, publisher, published_at, as_of, 'regex',
    CASE WHEN denied THEN 'low_quality_publisher' WHEN low_content THEN 'low_content_headline'
      WHEN NOT (by_name OR by_ticker OR by_sector) THEN 'not_relevant' END, 0, 0
  FROM ruled WHERE (ticker, window_idx) IN (SELECT (ticker, window_idx) FROM pool WHERE NOT covered)),
tried AS (
  SELECT c.* EXCLUDE (skip_reason), s.news_reaction, s.move_1d, s.skip_reason, s.recommendation, s.valuation_bucket, s.confidence
  FROM selected c JOIN signals s ON s.ticker = c.ticker AND s.as_of = c.as_of WHERE c.skip_reason IS NULL),
in_window AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, window_idx ORDER BY order_1, order_2, feed_pos) AS rank_in_window
    FROM tried WHERE news_reaction IS NOT NULL) WHERE rank_in_window <= 8),
kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY window_idx, order_1, order_2, feed_pos) AS rank_in_entity
    FROM in_window) WHERE rank_in_entity <= 50),
docs AS (
  SELECT d.doc_id, source, lang, n_chars,
    CASE WHEN quality = 1 AND toxic = 0 THEN 'good' WHEN quality = 0 AND toxic = 0 THEN 'bad'
      WHEN quality = 0 AND toxic = 1 THEN 'overreaction_down' WHEN quality = 1 AND toxic = 1 THEN 'overreaction_up'
      ELSE 'neutral' END AS news_reaction,
    CASE n_chars % 5 WHEN 0 THEN 'undervalued' WHEN 1 THEN 'near_fair' WHEN 2 THEN 'overvalued' WHEN 3 THEN 'no_data' ELSE '' END AS bucket
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
eval_rows AS (
  SELECT doc_id * 2 AS row_id, 'reaction' AS task, source, news_reaction, '' AS recommendation, '' AS bucket, doc_id, n_chars, lang FROM docs
  UNION ALL
  SELECT doc_id * 2 + 1, 'analysis', source, d.news_reaction, coalesce(f.recommendation, 'HOLD'), d.bucket, doc_id, n_chars, lang
  FROM docs d LEFT JOIN fusion f ON f.reaction = d.news_reaction AND f.bucket = d.bucket),
texts AS (
  SELECT e.*, m.model,
    CASE WHEN task = 'reaction' THEN '"news_reaction": "' || c.name || '"'
      ELSE '"recommendation": "' || CASE (n_chars + m.off) % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' ELSE 'HOLD' END
        || '", "reasoning": "' || source || '", "answer": "' || CASE WHEN doc_id % 5 = 0 THEN ' ' ELSE lang END || '"' END AS fields
  FROM eval_rows e CROSS JOIN (VALUES ('base', 1), ('tuned', 0)) AS m(model, off)
  JOIN {_CLASSES} AS c(no, name) ON c.no = (n_chars + m.off) % 5 + 1),
scored AS (
  SELECT *, CASE doc_id % 6 WHEN 3 THEN NULL
      ELSE CASE WHEN task = 'reaction' THEN regexp_extract(fields, '"news_reaction": "([a-z_]+)"', 1)
        ELSE regexp_extract(fields, '"recommendation": "([A-Z]+)"', 1) END END AS predicted,
    CASE WHEN task = 'reaction' THEN news_reaction ELSE recommendation END AS expected,
    doc_id % 6 IN (0, 1, 4) AS json_ok,
    CASE WHEN task = 'analysis' THEN doc_id % 6 <> 3 AND doc_id % 5 <> 0 END AS nonempty
  FROM texts),
marked AS (SELECT *, coalesce(predicted = expected, false) AS correct FROM scored),
weeks AS (
  SELECT ticker, i AS window_idx, DATE '2001-11-22' - 7 * i::INT AS after, DATE '2001-11-22' - 7 * i::INT + 7 AS before
  FROM ent CROSS JOIN range(1, 401) AS r(i)),
sample_days AS (SELECT ticker, after AS as_of FROM weeks),
s_event AS (
  SELECT d.ticker, d.as_of, min(e.event_ts) AS event_ts FROM sample_days d JOIN earnings e
    ON e.ticker = d.ticker AND e.event_ts > d.as_of::TIMESTAMP GROUP BY 1, 2),
samples AS (
  SELECT ticker, as_of, skip_reason,
    CASE WHEN skip_reason IS NULL THEN (close - prev_close) / prev_close END AS move_1d,
    CASE WHEN skip_reason IS NULL AND ahead_date < as_of + 39 THEN (ahead_close - prev_close) / prev_close END AS move_21d,
    coalesce(bars_to_event > 21, true) AS assessable
  FROM (
    SELECT d.ticker, d.as_of, b.*  EXCLUDE (ticker), x.event_bar - b.bar_no AS bars_to_event,
      CASE WHEN b.trade_date IS NULL OR b.prev_date IS NULL OR b.trade_date >= d.as_of + 39 OR b.prev_date < d.as_of - 7 OR b.prev_close = 0
          THEN 'insufficient_history' WHEN x.event_bar - b.bar_no <= 0 THEN 'earnings_within_1d' END AS skip_reason
    FROM sample_days d
    LEFT JOIN bars b ON b.ticker = d.ticker AND b.trade_date >= d.as_of AND (b.prev_date IS NULL OR b.prev_date < d.as_of)
    LEFT JOIN s_event n ON n.ticker = d.ticker AND n.as_of = d.as_of
    LEFT JOIN events_on_axis x ON x.ticker = n.ticker AND x.event_ts = n.event_ts)),
usable AS (SELECT * FROM samples WHERE skip_reason IS NULL),
series AS (
  SELECT 'move_1d' AS series, move_1d AS value FROM usable
  UNION ALL
  SELECT CASE WHEN move_1d < 0 THEN 'retracement_down' ELSE 'retracement_up' END,
    CASE WHEN move_1d < 0 THEN (move_21d - move_1d) / abs(move_1d) ELSE (move_1d - move_21d) / move_1d END
  FROM usable WHERE assessable AND move_21d IS NOT NULL AND abs(move_1d) >= 0.03),
grid AS (
  SELECT x, y, z, count(*) AS n, {", ".join(f"count(*) FILTER (label = '{name}') AS {name}" for name in K.REACTIONS)}
  FROM (SELECT x, y, z, {_classify('move_1d', 'move_21d', 'assessable', 'x', 'y', 'z')} AS label FROM usable
    CROSS JOIN (VALUES {", ".join(f"({x}::DOUBLE)" for x in K.X_CANDIDATES)}) AS gx(x)
    CROSS JOIN (VALUES {", ".join(f"({y}::DOUBLE)" for y in K.Y_CANDIDATES)}) AS gy(y)
    CROSS JOIN (VALUES {", ".join(f"({z}::DOUBLE)" for z in K.Z_CANDIDATES)}) AS gz(z) WHERE y > x)
  GROUP BY 1, 2, 3),
pools AS (
  SELECT CASE p_partkey % 5 WHEN 0 THEN 'good' WHEN 1 THEN 'bad' WHEN 2 THEN 'neutral' WHEN 3 THEN 'overreaction_down' ELSE 'overreaction_up' END AS pool,
    row_number() OVER (PARTITION BY p_partkey % 5 ORDER BY p_partkey) - 1 AS idx, p_name FROM part),
pool_sizes AS (SELECT pool, count(*) AS n, greatest(1, floor(count(*) * 0.2::DOUBLE)::INT) AS k FROM pools GROUP BY 1),
held AS (SELECT pool, floor((i + 0.5::DOUBLE) * (n::DOUBLE / k::DOUBLE))::BIGINT AS idx FROM pool_sizes CROSS JOIN range(0, 1000000) AS r(i) WHERE i < k),
drawn AS (
  SELECT o_orderkey AS draw_id, o_orderdate::DATE AS as_of,
    CASE WHEN u < 0.22::DOUBLE THEN 'good' WHEN u < 0.44::DOUBLE THEN 'bad' WHEN u < 0.22::DOUBLE + 0.22::DOUBLE + 0.26::DOUBLE THEN 'neutral'
      WHEN u < 0.22::DOUBLE + 0.22::DOUBLE + 0.26::DOUBLE + 0.15::DOUBLE THEN 'overreaction_down' ELSE 'overreaction_up' END AS news_reaction,
    {_bits('o_orderkey', 'entity')} % 25 AS entity_no
  FROM (SELECT *, {_draw('o_orderkey', 'reaction')} AS u FROM orders)),
placed AS (
  SELECT d.*, e.ticker, e.name, e.sector, {_bits('draw_id', 'template')} % s.n AS idx
  FROM drawn d JOIN ent e ON e.entity_key = d.entity_no JOIN pool_sizes s ON s.pool = d.news_reaction),
filled AS (
  SELECT p.*, q.p_name, h.idx IS NOT NULL AS template_held_out,
    p.news_reaction IN ('good', 'bad') AND p.sector IN ('Energy', 'Industrials') AND {_draw('draw_id', 'sector-override')} < 0.40 AS swapped
  FROM placed p JOIN pools q ON q.pool = p.news_reaction AND q.idx = p.idx LEFT JOIN held h ON h.pool = p.news_reaction AND h.idx = p.idx)
"""

ORACLE: dict[str, str] = {}


def _sql(name: str, body: str, prelude: bool = True) -> None:
    ORACLE[name] = (PRELUDE if prelude else "") + body


def _rounded(*names: str, digits: int = 6) -> str:
    return ", ".join(f"{_r(n, digits)} AS {n}" for n in names)


_CALL3 = "CASE {0} % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' ELSE 'HOLD' END"


def _pick(values, index: str) -> str:
    return f"([{', '.join(_q(v) for v in values)}])[({index}) + 1]"


def _index(n, key: str, salt: str) -> str:
    return f"({_bits(key, salt)} % {n})"


_DATED = "strftime({0}, '%a, %d %b %Y')"
_LINE = "'- [' || " + _DATED.format("as_of") + " || '] ' || title || ' - ' || publisher"

_sql("src5_headline_feed", "SELECT ticker, feed_pos, title, publisher FROM headlines")
_sql(
    "src6_price_range",
    f"""SELECT ticker, count(*) AS bars, min(trade_date)::VARCHAR AS first, max(trade_date)::VARCHAR AS last,
    {_r('min(close)')} AS low, {_r('max(close)')} AS high FROM prices
    WHERE trade_date >= DATE '1996-01-01' AND trade_date < DATE '2001-01-01' GROUP BY 1""",
)
_EST = """(SELECT ticker, arg_min(value, period_end) AS ya, min(value) AS lo, max(value) AS hi FROM eps_q GROUP BY 1)"""
_sql(
    "src7_fundamentals_assembly",
    f"""SELECT e.ticker, e.sector, {_r('shares_outstanding')} AS shares_outstanding, {_r('free_cash_flow')} AS free_cash_flow,
    {_r('CASE WHEN ya <> 0 THEN 0.05::DOUBLE END')} AS growth_0y, {_r('(lo - nullif(ya, 0)) / abs(nullif(ya, 0))')} AS growth_0y_low,
    {_r('eps_growth_5y')} AS eps_growth_5y
    FROM ent e LEFT JOIN fund f ON f.ticker = e.ticker LEFT JOIN {_EST} x ON x.ticker = e.ticker""",
)
_sql(
    "src8_consensus_range",
    f"""SELECT ticker, {_r('CASE WHEN ya <> 0 THEN 0.05::DOUBLE END')} AS growth_0y, {_r('CASE WHEN ya <> 0 THEN 0.06::DOUBLE END')} AS growth_1y,
    {_r('(lo - nullif(ya, 0)) / abs(nullif(ya, 0))')} AS growth_0y_low, {_r('(hi - nullif(ya, 0)) / abs(nullif(ya, 0))')} AS growth_0y_high FROM {_EST}""",
)
_sql(
    "src1_rows_and_rejects",
    """SELECT doc_id, CASE doc_id % 7 WHEN 2 THEN 'broken_json' WHEN 3 THEN 'missing ticker' WHEN 4 THEN 'broken_json' WHEN 5 THEN 'no_object' ELSE 'row' END AS outcome,
      CASE WHEN doc_id % 7 NOT IN (2, 3, 4, 5) THEN source END AS ticker, CASE WHEN doc_id % 7 NOT IN (2, 3, 4, 5) THEN length(coalesce(text, '')) END AS news_chars,
      CASE WHEN doc_id % 7 NOT IN (2, 3, 4, 5) THEN md5(coalesce(text, '')) END AS news_digest FROM documents""",
    prelude=False,
)
_sql(
    "src2_4_set1_tagged_files",
    """SELECT tag, doc_id, length(coalesce(text, '')) AS news_chars FROM documents, (VALUES ('all'), ('english'), ('other')) v(tag)
    WHERE lang IS NOT NULL AND (tag = 'all' OR (tag = 'english') = (lang = 'en'))""",
    prelude=False,
)
_sql(
    "src9_cell_after_label",
    r"""WITH c AS (SELECT page_id, [trim(regexp_replace(x, '<[^>]*>', '', 'g')) FOR x IN regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1)] AS cells FROM pages)
    SELECT page_id, CASE WHEN list_position(cells, 'the') > 0 THEN cells[list_position(cells, 'the') + 1] END AS cell FROM c""",
    prelude=False,
)
_LABELS = ("the", "de", "in", "was", "los")
_sql(
    "src9_cells_by_label",
    r"""WITH c AS (SELECT page_id, [trim(regexp_replace(x, '<[^>]*>', '', 'g')) FOR x IN regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1)] AS cells FROM pages),
    """ + "a AS (SELECT page_id, " + ", ".join(f"CASE WHEN list_position(cells, '{x}') > 0 THEN cells[list_position(cells, '{x}') + 1] END AS after_{x}" for x in _LABELS)
    + " FROM c) SELECT * FROM a WHERE coalesce(" + ", ".join(f"after_{x}" for x in _LABELS) + ") IS NOT NULL",
    prelude=False,
)
_INFORMAL = sorted(K.INFORMAL_SECTORS)
_sql(
    "join9_informal_sectors",
    f"""WITH m(informal_sector, sector) AS (VALUES {', '.join(f"('{k}', '{v}')" for k, v in K.INFORMAL_SECTORS.items())}),
    f(sector, median_pe) AS (VALUES {', '.join(f"('{k}', {v}::DOUBLE)" for k, v in K.SECTOR_MEDIAN_PE.items())}),
    p AS (SELECT {[*_INFORMAL, 'shipbuilding']}[p_partkey % {len(_INFORMAL) + 1} + 1] AS informal_sector FROM part)
    SELECT p.informal_sector, m.sector, f.median_pe, CASE WHEN m.sector IS NOT NULL THEN m.sector IN ({', '.join(f"'{x}'" for x in K.ASSET_HEAVY_SECTORS)}) END AS asset_heavy, count(*) AS n
    FROM p LEFT JOIN m USING (informal_sector) LEFT JOIN f ON f.sector = m.sector GROUP BY ALL""",
    prelude=False,
)
_sql(
    "src10_preferred_metric",
    f"SELECT ticker, CASE WHEN entity_key % 5 = 0 THEN 'Basic EPS' ELSE 'Diluted EPS' END AS metric, period_end::VARCHAR AS period_end, {_r('value')} AS value FROM eps_q",
)
_sql("prj1_feed_title_split", "SELECT publisher, count(*) AS n, count(DISTINCT title) AS titles FROM headlines GROUP BY 1")
_TOKENS = "array_to_string(regexp_extract_all(lower(publisher), '[a-z0-9]+'), ' ')"
_sql("flt1_publisher_tokens", f"SELECT publisher, {_TOKENS} AS tokens, count(*) AS n FROM headlines GROUP BY 1, 2")
_sql("flt2_denied_publishers", f"SELECT publisher, regexp_matches({_TOKENS}, '{_DENIED}') AS denied, count(*) AS n FROM headlines GROUP BY 1, 2")
_LOW = _q("(?i)" + K.LOW_CONTENT_PATTERN)
_sql("flt3_low_content_headlines", f"SELECT ticker, regexp_matches(title, {_LOW}) AS low_content, count(*) AS n FROM headlines GROUP BY 1, 2")
_sql("flt3_low_content_documents", f"SELECT doc_id, regexp_matches(text, {_LOW}) AS low_content FROM documents", prelude=False)
_sql(
    "flt4_normalized_text",
    r"""SELECT doc_id, length(t) AS n, md5(t) AS digest FROM (
    SELECT doc_id, trim(regexp_replace(replace(replace(lower(strip_accents(text)), '.', ''), ',', ''), '\s+', ' ', 'g')) AS t FROM documents)""",
    prelude=False,
)
_WORDS = "|".join(K.LEGAL_SUFFIX_WORDS)
_AMBIG = ", ".join(_q(w) for w in K.AMBIGUOUS_NAME_CORES)
_sql(
    "flt5_6_name_needles",
    f"""SELECT name, core, CASE WHEN length(needle) >= 2 THEN needle ELSE '' END AS needle, count(*) AS n FROM (
      SELECT name, core, CASE WHEN core <> '' AND (contains(core, ' ') OR core NOT IN ({_AMBIG})) THEN core ELSE folded END AS needle FROM (
        SELECT name, folded, regexp_replace(regexp_replace(folded, '^((?:{_WORDS})(?: |$))+', ''), '((?:^| )(?:{_WORDS}))+$', '') AS core FROM (
          SELECT name, trim(replace(replace(lower(name), '.', ''), ',', '')) AS folded FROM (
            SELECT 'The ' || s_name || ' Group, Inc.' AS name FROM supplier UNION ALL SELECT name FROM ent
            UNION ALL SELECT split_part(p_name, ' ', 2) || ' Corp.' FROM part)))) GROUP BY 1, 2, 3""",
)
_sql("flt7_8_relevance", "SELECT ticker, by_name OR by_ticker OR by_sector AS relevant, count(*) AS n FROM ruled GROUP BY 1, 2")
_sql(
    "flt9_10_screen_coverage",
    "SELECT ticker, covered, count(*) AS pooled, count(*) FILTER (relevant AND importance >= 3) AS accepted FROM pool GROUP BY 1, 2",
)
_sql("flt11_selected_headlines", "SELECT ticker, window_idx::BIGINT AS window_idx, feed_pos, title, publisher, path, skip_reason FROM selected")
_SUSPECT = _q("(?i)" + K.SUSPICIOUS_TEXT_PATTERN)
_sql(
    "flt12_generated_text_check",
    f"""WITH g AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN 'NOTE: ' ELSE 'Reasoning: ' END || text
        || CASE WHEN turn % 2 = 0 THEN chr(10) || 'ANSWER: ' || text ELSE '' END AS t FROM conversations),
    p AS (SELECT conv_id, turn, regexp_replace(regexp_extract(t, '(?is)REASONING:\\s*(.*?)(?:\\n\\s*ANSWER:|$)', 1), '^\\s+|\\s+$', '', 'g') AS r,
        regexp_replace(regexp_extract(t, '(?is)ANSWER:\\s*(.*)', 1), '^\\s+|\\s+$', '', 'g') AS a FROM g),
    j AS (SELECT *, CASE WHEN r = '' THEN 'no_reasoning' WHEN length(r) > 800 OR length(a) > 400 THEN 'too_long'
        WHEN regexp_matches(r, {_SUSPECT}) OR regexp_matches(a, {_SUSPECT}) THEN 'suspicious' END AS reject_reason FROM p)
    SELECT conv_id, turn, reject_reason, CASE WHEN reject_reason IS NULL THEN length(r) END AS reasoning_chars,
      CASE WHEN reject_reason IS NULL AND a <> '' THEN length(a) END AS answer_chars FROM j""",
    prelude=False,
)
# A line pattern needs a publisher without a hyphen; a headline line dated twice is ambiguous.
_sql("flt13_signal_line_date", "SELECT feed_pos AS row_id, CASE WHEN feed_pos % 9 <> 0 THEN as_of::VARCHAR END AS published FROM headlines")
_CONVERT = f""", gapped AS (
  SELECT h.feed_pos, h.ticker, l.news_reaction, l.skip_reason, l.move_1d, {_CALL3.format('feed_pos')} AS old_call,
    CASE WHEN feed_pos % 4 = 0 THEN NULL WHEN feed_pos % 2 = 0 THEN feed_pos % 60 ELSE -(feed_pos % 60) END AS gap
  FROM headlines h JOIN day_labels l ON l.ticker = h.ticker AND l.as_of = h.as_of),
refused AS (
  SELECT g.*, b.bucket, u.recommendation FROM (SELECT *, CASE WHEN gap IS NULL THEN 'no_data' WHEN gap <= -15 THEN 'undervalued'
    WHEN gap >= 15 THEN 'overvalued' ELSE 'near_fair' END AS bucket FROM gapped) b JOIN gapped g ON g.feed_pos = b.feed_pos
  LEFT JOIN fusion u ON u.reaction = g.news_reaction AND u.bucket = b.bucket),
outcomes AS (
  SELECT *, CASE WHEN feed_pos % 13 = 0 THEN 'unparseable_output' WHEN feed_pos % 9 = 0 THEN 'unresolvable_headline'
    WHEN news_reaction IS NULL THEN 'relabel_failed:' || skip_reason
    WHEN recommendation <> old_call THEN 'recommendation_mismatch' ELSE 'converted' END AS outcome FROM refused)
"""
_CONTEXT = "ticker || ' moved ' || printf('%+.1f', move_1d * 100) || '% on the day this was published.'"
_sql("flt14_15_convert_outcomes", _CONVERT + "SELECT outcome, count(*) AS n FROM outcomes GROUP BY 1")
_sql(
    "prj6_converted_rows",
    _CONVERT + f"""SELECT feed_pos AS row_id, ticker, news_reaction, recommendation, bucket AS valuation_bucket, {_CONTEXT} AS price_context
    FROM outcomes WHERE outcome = 'converted'""",
)
_sql(
    "prj2_3_stored_rows",
    f"""SELECT task, ticker, news_reaction, count(*) AS n, min(output) AS output, min(price_context) AS lowest, max(price_context) AS highest FROM (
      SELECT t.task, ticker, news_reaction, CASE t.task WHEN 'reaction' THEN '{{"news_reaction":"' || news_reaction || '"}}'
        ELSE '{{"recommendation":"HOLD","reasoning":"r","answer":"a"}}' END AS output, {_CONTEXT} AS price_context
      FROM day_labels CROSS JOIN (VALUES ('reaction'), ('analysis')) AS t(task) WHERE news_reaction IS NOT NULL) GROUP BY 1, 2, 3""",
)


def _template(template: str, *fields: str) -> str:
    pieces = template.split("%s")
    out = [_q(pieces[0])]
    for field, piece in zip(fields, pieces[1:]):
        out += [field, _q(piece)]
    return " || ".join(out)


_R_OUT = "'{\"news_reaction\":\"' || news_reaction || '\"}'"
_A_OUT = "'{\"recommendation\":\"HOLD\",\"reasoning\":\"r\",\"answer\":\"a\"}'"
_sql(
    "prj5_prompts",
    f"""SELECT ticker, as_of::VARCHAR AS as_of, task, md5(CASE task WHEN 'reaction' THEN
      {_template(K.REACTION_PROMPT, 'ticker', f'({_CONTEXT})', "'- ' || ticker", _R_OUT)} ELSE
      {_template(K.ANALYSIS_PROMPT, 'ticker', "'q'", 'news_reaction', "'m'", "'v'", "'e'", "'- ' || ticker", _A_OUT)} END || '</s>') AS prompt_digest
    FROM day_labels CROSS JOIN (VALUES ('reaction'), ('analysis')) AS t(task) WHERE news_reaction IS NOT NULL""",
)
_sql("join1_first_trading_day", f"SELECT ticker, as_of::VARCHAR AS as_of, trade_date::VARCHAR AS trade_date, {_r('close')} AS close FROM located")
_sql(
    "join2_next_earnings",
    "SELECT d.ticker, d.as_of::VARCHAR AS as_of, n.event_ts::DATE::VARCHAR AS next_event FROM days d LEFT JOIN next_event n ON n.ticker = d.ticker AND n.as_of = d.as_of",
)
_sql("join3_bars_to_event", "SELECT ticker, as_of::VARCHAR AS as_of, bars_to_event::BIGINT AS bars_to_event, assessable, skip_reason FROM measured")
_sql(
    "join4_to_7_facts_as_of",
    f"""SELECT ticker, as_of::VARCHAR AS as_of, price_date::VARCHAR AS price_date, last_quarter::VARCHAR AS last_quarter,
    next_earnings::VARCHAR AS next_earnings, {_rounded('price', 'eps_ttm', 'revenue', 'year_ago_revenue', 'last_eps', 'last_estimate')} FROM facts""",
)
_sql(
    "join8_fusion",
    f"SELECT news_reaction, valuation_bucket, recommendation, count(*) AS n, {_r('min(confidence)')} AS low, {_r('max(confidence)')} AS high FROM signals GROUP BY 1, 2, 3",
)
_sql(
    "fuse_raw_gap",
    """SELECT l.news_reaction, CASE WHEN l.news_reaction IS NOT NULL THEN g.bucket END AS valuation_bucket, u.recommendation, count(*) AS n
    FROM day_labels l JOIN (SELECT ticker, as_of, CASE WHEN gap_pct IS NULL THEN 'no_data' WHEN gap_pct <= -15 THEN 'undervalued'
      WHEN gap_pct >= 15 THEN 'overvalued' ELSE 'near_fair' END AS bucket FROM gaps) g ON g.ticker = l.ticker AND g.as_of = l.as_of
    LEFT JOIN fusion u ON u.reaction = l.news_reaction AND u.bucket = g.bucket GROUP BY 1, 2, 3""",
)
_KNOWN_WORDS = ", ".join(_q(k) for k in K.SECTOR_KEYWORDS)
_sql(
    "join9_sector_lookup",
    f"SELECT ticker, e.sector, median_pe, asset_heavy, reit, e.sector IN ({_KNOWN_WORDS}) AS has_keywords FROM ent e LEFT JOIN sec s ON s.sector = e.sector",
)
_KINDS = [kind for kind, _ in K.USER_QUESTIONS]
_ANSWERS = " ".join(
    f"WHEN {_q(kind + '|' + call)} THEN {_q(words)}" for kind, by_call in K.ANSWER_TEMPLATES.items() for call, words in by_call.items()
)
_KIND = _pick(_KINDS, _index(10, "feed_pos", "question"))
_QUESTION = f"replace({_pick([words for _, words in K.USER_QUESTIONS], _index(10, 'feed_pos', 'question'))}, '{{ticker}}', ticker)"


def _answer(kind: str, call: str) -> str:
    return f"replace(CASE {kind} || '|' || {call} {_ANSWERS} END, '{{ticker}}', ticker)"


_sql(
    "join10_33_answers",
    f"SELECT feed_pos, {_KIND} AS kind, {_QUESTION} AS question, {_answer(_KIND, _CALL3.format('feed_pos'))} AS answer FROM headlines",
)
_sql(
    "join13_pending_entities",
    "SELECT w AS window_idx, ticker, name FROM ent, range(1, 401) r(w) WHERE NOT EXISTS (SELECT 1 FROM headlines h WHERE h.window_idx = w AND h.ticker = ent.ticker)",
)
_sql("join15_scored_predictions", "SELECT row_id, model, task, expected, predicted, correct, json_ok, nonempty FROM marked")
_sql("join17_weekly_windows", "SELECT ticker, window_idx::BIGINT AS window_idx, after::VARCHAR AS after, before::VARCHAR AS before FROM weeks")
_sql(
    "reaction_counts",
    """SELECT coalesce(news_reaction, skip_reason) AS outcome, count(*) AS headlines FROM headlines h
    JOIN day_labels l ON l.ticker = h.ticker AND l.as_of = h.as_of GROUP BY 1""",
)
_sql(
    "reaction_counts_wide_thresholds",
    f"""SELECT coalesce({_classify('move_1d', 'move_21d', 'assessable', '0.05', '0.30', '0.5')}, skip_reason) AS outcome, count(*) AS headlines
    FROM headlines h JOIN day_labels l ON l.ticker = h.ticker AND l.as_of = h.as_of GROUP BY 1""",
)
_sql(
    "fn1_to_3_labelled_headlines",
    f"""SELECT feed_pos, h.ticker, news_reaction, skip_reason, {_rounded('move_1d', 'move_21d')} FROM headlines h
    JOIN day_labels l ON l.ticker = h.ticker AND l.as_of = h.as_of""",
)
_sql(
    "fn4_5_fused_headlines",
    f"""SELECT feed_pos, news_reaction, valuation_bucket, recommendation, {_rounded('confidence')} FROM headlines h
    JOIN signals s ON s.ticker = h.ticker AND s.as_of = h.as_of""",
)
_sql(
    "fn6_to_18_valuation",
    f"""SELECT ticker, as_of::VARCHAR AS as_of, first_basis, basis, {_rounded('price', 'market_cap', 'intrinsic', 'gap_pct', digits=4)},
    {_rounded('pe_trailing', 'roe', 'price_to_sales', 'fcf_yield', 'peg_ratio', 'price_to_book', digits=8)} FROM gaps""",
)
_PARTS = ", ".join(
    f"{_r(f'max({source}) FILTER (name = {_q(name)})')} AS {target}_{name}"
    for target, source in (("g1", "g1"), ("g2", "g2"), ("g2d", "g2d"), ("exit", "exit_market"))
    for name in K.SCENARIOS
)
_sql("fn10_11_scenarios", f"SELECT ticker, as_of::VARCHAR AS as_of, {_PARTS} FROM scen2 GROUP BY ticker, as_of")
_sql(
    "agg8_basis_values",
    f"SELECT ticker, as_of::VARCHAR AS as_of, {_rounded('iv_eps', 'iv_fcf', 'iv_revenue', 'iv_dividends', 'stream_pv', digits=4)} FROM m3",
)


def _money(v: str) -> str:
    return f"(CASE WHEN {v} >= 1e12 THEN printf('$%.2fT', {v} / 1e12::DOUBLE) ELSE printf('$%.1fB', {v} / 1e9::DOUBLE) END)"


def _na(expr: str) -> str:
    return f"coalesce({expr}, 'N/A')"


_MARKET = f"""CASE WHEN price IS NOT NULL AND market_cap IS NOT NULL AND eps_known IS NOT NULL THEN
  printf('Price: $%.2f', price) || ' | Market Cap: ' || {_money('market_cap')}
  || chr(10) || 'P/E (trailing): ' || {_na("printf('%.1f', pe_trailing)")} || ' | P/E (forward): ' || {_na("printf('%.1f', nullif(pe_forward, 0))")}
  || chr(10) || printf('EPS (trailing): $%.2f', eps_ttm) || ' | Dividend Yield: ' || coalesce(printf('%.2f', nullif(dividend_yield, 0)) || '%', '0.00%')
  || chr(10) || '52-Week Range: ' || {_na("printf('$%.2f - $%.2f', year_low, year_high)")}
  || chr(10) || 'Operating Margin: ' || {_na("printf('%.1f', operating_margin * 100) || '%'")} || ' | ROE: ' || {_na("printf('%.1f', roe * 100) || '%'")}
  || ' | Price/Book: ' || {_na("printf('%.1f', price_to_book)")}
  || chr(10) || 'Price/Sales: ' || {_na("printf('%.1f', price_to_sales)")} || ' | FCF Yield: ' || {_na("printf('%.1f', fcf_yield * 100) || '%'")}
  || ' | PEG: ' || {_na("printf('%.1f', peg_ratio)")}
  || chr(10) || 'Sector Median P/E: ' || CASE WHEN median_pe IS NOT NULL THEN printf('%.1f', median_pe) || ' (' || sector || ')' ELSE 'N/A (' || sector || ')' END
  ELSE 'Data unavailable.' END"""
_LABEL = "CASE basis WHEN 'eps' THEN 'EPS-based' WHEN 'fcf' THEN 'FCF-based' WHEN 'revenue' THEN 'Revenue-based' ELSE 'Dividend-based' END"
_VALUATION = f"""CASE WHEN price IS NULL THEN 'Data unavailable.'
  WHEN intrinsic IS NULL THEN 'Not applicable (insufficient data for the ' || lower({_LABEL}) || ' valuation basis).'
  ELSE 'Intrinsic Value (' || {_LABEL} || '): ' || printf('$%.2f', intrinsic) || chr(10) || 'vs Current Price: '
    || CASE WHEN abs(gap_pct) < 1 THEN 'trading near fair value'
      ELSE CASE WHEN gap_pct >= 0 THEN 'overvalued' ELSE 'undervalued' END || ' by '
        || CASE WHEN abs(gap_pct) > 150 THEN '>150' ELSE printf('~%.0f', abs(gap_pct)) END || '%' END END"""
_EARNINGS = f"""CASE WHEN revenue IS NULL THEN 'Data unavailable.' ELSE 'Last Quarter (' || last_quarter::VARCHAR || '): Revenue ' || {_money('revenue')}
  || coalesce(printf(' (%+.1f', (revenue - year_ago_revenue) / nullif(year_ago_revenue, 0) * 100) || '% YoY)', '')
  || coalesce(CASE WHEN last_estimate <> 0 THEN printf(', EPS $%.2f (', last_eps) || CASE WHEN last_eps > last_estimate THEN 'beat est. '
      WHEN last_eps < last_estimate THEN 'missed est. ' ELSE 'in line with est. ' END || printf('$%.2f)', last_estimate) END, '')
  || coalesce(chr(10) || 'Next Earnings Date: ' || next_earnings::VARCHAR, '') END"""
_sql("fn19_to_23_blocks", f"SELECT ticker, as_of::VARCHAR AS as_of, {_MARKET} AS market_data, {_VALUATION} AS valuation, {_EARNINGS} AS earnings FROM gaps")
_sql("fn20_gap_from_text", "SELECT ticker, as_of::VARCHAR AS as_of, text_gap::DOUBLE AS parsed, text_gap::DOUBLE AS typed FROM shown")

# The latest trading day of each entity as the only days to value.
LAST_DAYS = PRELUDE.replace(
    "days AS (SELECT DISTINCT ticker, as_of FROM headlines)", "days AS (SELECT ticker, max(trade_date) AS as_of FROM prices GROUP BY 1)"
)
ORACLE["srt2_valuation_ranking"] = LAST_DAYS + f"""SELECT ticker, as_of::VARCHAR AS as_of, basis,
  CASE WHEN text_gap IS NOT NULL THEN CASE WHEN gap_pct >= 0 THEN 'overvalued' ELSE 'undervalued' END END AS verdict,
  abs(text_gap)::DOUBLE AS shown_pct, {_rounded('intrinsic', digits=4)} FROM shown"""
ORACLE["snk6_spot_check"] = LAST_DAYS + (
    "SELECT ticker, as_of::VARCHAR AS as_of, true AS market_data_matches, ticker <> 'NATION_3' AS valuation_matches, true AS earnings_matches FROM days"
)
_TYPED_FROM = f""", t AS (SELECT ticker, price IS NOT NULL AND market_cap IS NOT NULL AND eps_known IS NOT NULL AS known, * EXCLUDE (ticker) FROM shown)"""
_TYPED = f"""SELECT ticker, as_of::VARCHAR AS as_of, CASE WHEN known THEN printf('%.2f', price) END AS price, CASE WHEN known THEN coalesce(printf('%.1f', pe_trailing), 'N/A') END AS pe_trailing,
    CASE WHEN known THEN coalesce(printf('%.1f', nullif(pe_forward, 0)), 'N/A') END AS pe_forward,
    CASE WHEN known AND median_pe IS NOT NULL THEN sector END AS sector,
    CASE WHEN text_gap IS NOT NULL THEN {_LABEL} END AS basis, CASE WHEN text_gap IS NOT NULL THEN printf('%.2f', intrinsic) END AS intrinsic,
    CASE WHEN text_gap IS NOT NULL THEN CASE WHEN gap_pct >= 0 THEN 'overvalued' ELSE 'undervalued' END END AS verdict,
    printf('%.0f', abs(text_gap)::DOUBLE) AS pct FROM t"""
ORACLE["prj7_typed_from_text"] = PRELUDE + _TYPED_FROM + " " + _TYPED
# chr(10) line ends; one text per entity, its last day.
ORACLE["snk5_valuation_report"] = LAST_DAYS + _TYPED_FROM + f""", plain AS ({_TYPED}),
  said AS (SELECT ticker, {_MARKET} AS market_data, {_VALUATION} AS valuation, {_EARNINGS} AS earnings FROM gaps),
  listed AS (SELECT n.n_name AS ticker, 'Nation ' || n.n_nationkey || ' Holdings Inc.' AS name, y.* EXCLUDE (ticker), x.* EXCLUDE (ticker), x.ticker IS NOT NULL AS there
    FROM nation n LEFT JOIN plain y ON y.ticker = n.n_name LEFT JOIN said x ON x.ticker = n.n_name),
  shown_cells AS (SELECT ticker, name, coalesce(pct::BIGINT, 0) AS pct, CASE WHEN there THEN coalesce(price, 'N/A') ELSE 'ERROR' END AS price,
    CASE WHEN there THEN coalesce(intrinsic, 'N/A') || ' (' || coalesce(basis, 'N/A') || ')' ELSE '- (-)' END AS intrinsic,
    CASE WHEN there THEN coalesce(verdict || ' ' || pct || '%', 'N/A') ELSE '-' END AS gap, CASE WHEN there THEN coalesce(sector, 'N/A') ELSE '-' END AS sector,
    CASE WHEN there THEN coalesce(pe_trailing, 'N/A') || '/' || coalesce(pe_forward, 'N/A') ELSE '-/-' END AS pe,
    coalesce(market_data, 'no texts for this entity') AS market_data, coalesce(valuation, '-') AS valuation, coalesce(earnings, '-') AS earnings FROM listed)
  SELECT 1::BIGINT AS place, pct, ticker, '| ' || concat_ws(' | ', ticker, name, price, intrinsic, gap, sector, pe) || ' |' AS value FROM shown_cells
  UNION ALL SELECT 3, pct, ticker, concat_ws(chr(10), '### ' || ticker || ' (' || name || ')', '', '**Market Data:**', '```', market_data, '```', '', '**Valuation:**', '```', valuation, '```', '',
    '**Earnings:**', '```', earnings, '```', '') FROM shown_cells
  UNION ALL SELECT 0, 0, '', '# Valuation report - all ' || count(*) || ' tickers' || chr(10) || chr(10) || 'Generated 2002-01-01. Sorted by |mispricing %|, largest first.' || chr(10) || chr(10)
    || '| Ticker | Name | Price | Intrinsic (basis) | Gap | Sector | P/E (T/F) |' || chr(10) || '|---|---|---|---|---|---|---|' FROM nation
  UNION ALL SELECT 2, 0, '', chr(10) || '---' || chr(10) || chr(10) || '## Full detail per ticker' || chr(10)"""
_sql("agg7_trailing_eps", f"SELECT ticker, period_end::VARCHAR AS period_end, {_rounded('eps_ttm')} FROM eps_ttm")
_sql("agg18_revenue_ranges", f"SELECT ticker, {_r('min(revenue) / 1e9::DOUBLE', 9)} AS low, {_r('max(revenue) / 1e9::DOUBLE', 9)} AS high FROM rev_q GROUP BY 1")
_sql(
    "win1_to_3_trading_bars",
    f"""SELECT ticker, trade_date::VARCHAR AS trade_date, bar_no::BIGINT AS bar_no, prev_date::VARCHAR AS prev_date,
    ahead_date::VARCHAR AS ahead_date, {_rounded('prev_close', 'ahead_close')} FROM bars""",
)
_sql("win4_first_seen_titles", "SELECT ticker, title, window_idx::BIGINT AS window_idx, feed_pos FROM unseen")
_sql(
    "win5_join14_assessed_pool",
    "SELECT ticker, feed_pos, pool_rank::BIGINT AS pool_rank, covered, relevant, importance::BIGINT AS importance FROM pool",
)
_sql(
    "win6_7_kept_headlines",
    """SELECT ticker, window_idx::BIGINT AS window_idx, feed_pos, news_reaction, recommendation, rank_in_window::BIGINT AS rank_in_window,
    rank_in_entity::BIGINT AS rank_in_entity FROM kept""",
)
_sql(
    "win8_latest_quarters",
    f"""SELECT ticker, period_end::VARCHAR AS period_end, n::BIGINT AS n, {_rounded('value')} FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY period_end DESC) AS n FROM eps_q) WHERE n <= 4""",
)
_sql(
    "win9_misclassified_samples",
    """SELECT model, source, expected, predicted, row_id, rank::BIGINT AS rank FROM (SELECT *, row_number() OVER (
    PARTITION BY model, source, expected, predicted ORDER BY row_id) AS rank FROM marked WHERE task = 'reaction' AND NOT correct) WHERE rank <= 3""",
)
_sql("win9_first_mismatches", "SELECT row_id, expected, predicted FROM marked WHERE task = 'analysis' AND model = 'tuned' AND NOT correct ORDER BY row_id LIMIT 20")
_sql(
    "win11_set5_rebalanced",
    f""", r AS (SELECT feed_pos, news_reaction, CASE WHEN feed_pos % 5 = 0 THEN 'analysis' ELSE 'reaction' END AS task FROM headlines h
      JOIN day_labels l ON l.ticker = h.ticker AND l.as_of = h.as_of WHERE news_reaction IS NOT NULL),
    goal AS (SELECT greatest(30, count(*)) AS target FROM r WHERE task = 'reaction' AND news_reaction LIKE 'overreaction%'),
    ranked AS (SELECT r.*, row_number() OVER (PARTITION BY news_reaction ORDER BY {_bits('feed_pos', 'rebalance')}, feed_pos) AS n
      FROM r WHERE task = 'reaction' AND news_reaction NOT LIKE 'overreaction%')
    SELECT feed_pos, news_reaction, task FROM r WHERE task <> 'reaction' OR news_reaction LIKE 'overreaction%'
    UNION ALL SELECT feed_pos, news_reaction, task FROM ranked, goal WHERE n <= target""",
)
_sql(
    "agg9_class_targets",
    """, r AS (SELECT news_reaction, count(*) AS n FROM headlines h JOIN day_labels l ON l.ticker = h.ticker AND l.as_of = h.as_of
      WHERE news_reaction IS NOT NULL GROUP BY 1)
    SELECT news_reaction, n, (SELECT greatest(30, sum(n)) FROM r WHERE news_reaction LIKE 'overreaction%')::BIGINT AS target FROM r""",
)
_sql("win12_holdout_templates", "SELECT pool, idx::BIGINT AS idx FROM held")
_sql(
    "srt7_top_headlines",
    """SELECT ticker, window_idx::BIGINT AS window_idx, string_agg(title || ' | reaction: ' || news_reaction, chr(10) ORDER BY rank_in_window) AS headlines,
    max(recommendation) FILTER (rank_in_window = 1) AS recommendation FROM in_window WHERE rank_in_window <= 3 GROUP BY 1, 2""",
)
_sql(
    "agg1_skip_totals",
    """SELECT ticker, skip_reason, count(*) AS n FROM selected WHERE skip_reason IS NOT NULL GROUP BY GROUPING SETS ((ticker, skip_reason), (skip_reason))""",
)
_sql(
    "agg1_attempted_skips",
    """, steps AS (SELECT t.*, coalesce(sum((news_reaction IS NOT NULL)::INT) OVER (PARTITION BY ticker, window_idx
        ORDER BY order_1, order_2, feed_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_w FROM tried t),
    counted AS (SELECT *, coalesce(sum((news_reaction IS NOT NULL AND before_w < 8)::INT) OVER (PARTITION BY ticker
        ORDER BY window_idx, order_1, order_2, feed_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_e FROM steps),
    last_window AS (SELECT ticker, max(window_idx) AS w FROM kept WHERE rank_in_entity = 50 GROUP BY 1),
    considered AS (SELECT s.* FROM selected s LEFT JOIN last_window e ON e.ticker = s.ticker WHERE e.w IS NULL OR s.window_idx <= e.w)
    SELECT ticker, skip_reason, count(*) AS n FROM (
      SELECT ticker, skip_reason FROM considered WHERE skip_reason IS NOT NULL
      UNION ALL SELECT ticker, 'screen_fallback_windows' FROM (SELECT DISTINCT ticker, window_idx FROM considered WHERE path = 'regex')
      UNION ALL SELECT ticker, skip_reason FROM counted WHERE skip_reason IS NOT NULL AND before_w < 8 AND before_e < 50) GROUP BY 1, 2""",
)
_PCTS = ", ".join(f"({p})" for p in K.PERCENTS)
_sql(
    "agg2_4_percentiles",
    f"""SELECT series, percent::BIGINT AS percent, n, {_rounded('value')} FROM (
      SELECT series, value, row_number() OVER (PARTITION BY series ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM series)
    JOIN (VALUES {_PCTS}) AS p(percent) ON i = round_even(percent / 100.0::DOUBLE * (n - 1), 0)""",
)
_sql(
    "agg2_price_percentiles",
    f"""SELECT ticker, percent::BIGINT AS percent, n, {_rounded('close')} FROM (
      SELECT ticker, close, row_number() OVER (PARTITION BY ticker ORDER BY close) - 1 AS i, count(*) OVER (PARTITION BY ticker) AS n FROM prices)
    JOIN (VALUES {_PCTS}) AS p(percent) ON i = round_even(percent / 100.0::DOUBLE * (n - 1), 0)""",
)
_sql(
    "agg3_4_moments",
    f"SELECT series, count(*) AS n, {_r('avg(value)')} AS mean, {_r('CASE WHEN count(*) > 1 THEN stddev_samp(value) END')} AS stdev FROM series GROUP BY 1",
)
_OVER = "(overreaction_down + overreaction_up) / n::DOUBLE"
_sql(
    "join16_agg5_6_threshold_grid",
    f"""SELECT x, y, z, n, {", ".join(K.REACTIONS)}, {_r(_OVER)} AS overreaction_share, {_r('neutral / n::DOUBLE')} AS neutral_share,
    {_OVER} BETWEEN 0.05 AND 0.12 AND neutral / n::DOUBLE BETWEEN 0.25 AND 0.45 AS passes FROM grid""",
)
_sql(
    "agg6_cells_in_wide_bands",
    f"SELECT x, y, z, {_OVER} >= 0.05 AND {_OVER} <= 0.185 AND neutral / n::DOUBLE >= 0.008 AND neutral / n::DOUBLE <= 0.45 AS passes FROM grid",
)
_sql(
    "agg4_retracements",
    f"""SELECT ticker, CASE WHEN move_1d < 0 THEN 'down' ELSE 'up' END AS side, count(*) AS n,
    {_r('avg(CASE WHEN move_1d < 0 THEN (move_21d - move_1d) / abs(move_1d) ELSE (move_1d - move_21d) / move_1d END)')} AS mean_retraced
    FROM day_labels WHERE assessable AND move_21d IS NOT NULL AND abs(move_1d) >= 0.03 GROUP BY 1, 2""",
)
_sql(
    "agg10_accuracy",
    f"""SELECT task, model, source, count(*) AS total, count(*) FILTER (correct) AS correct, count(*) FILTER (json_ok) AS json_ok,
    count(*) FILTER (nonempty) AS nonempty, {_r('count(*) FILTER (correct) / count(*)::DOUBLE')} AS accuracy,
    {_r('count(*) FILTER (json_ok) / count(*)::DOUBLE')} AS json_rate, {_r('count(*) FILTER (nonempty) / count(*)::DOUBLE')} AS nonempty_rate
    FROM marked GROUP BY GROUPING SETS ((task, model, source), (task, model))""",
)
_sql(
    "agg11_srt4_confusion",
    "SELECT task, model, source, expected, coalesce(predicted, 'UNPARSEABLE') AS predicted, count(*) AS n FROM marked GROUP BY 1, 2, 3, 4, 5",
)
_sql(
    "agg12_class_recall",
    f"""SELECT model, expected, count(*) AS total, count(*) FILTER (correct) AS correct, {_r('count(*) FILTER (correct) / count(*)::DOUBLE')} AS recall,
    max(no)::BIGINT AS position FROM marked JOIN {_CLASSES} AS c(no, name) ON name = expected WHERE task = 'reaction' GROUP BY 1, 2""",
)
_CELLS = """(SELECT model, news_reaction, coalesce(nullif(bucket, ''), 'unknown') AS bucket, count(*) AS total, count(*) FILTER (correct) AS correct
  FROM marked WHERE task = 'analysis' GROUP BY 1, 2, 3)"""
_sql("agg13_cell_accuracy", f"SELECT *, {_r('correct / total::DOUBLE')} AS accuracy FROM {_CELLS}")
_sql(
    "agg14_ship_gate",
    f"""SELECT model, sum(total)::BIGINT AS total, sum(correct)::BIGINT AS correct, count(*) AS cells, {_r('min(correct / total::DOUBLE)')} AS worst_cell,
    {_r('sum(correct)::DOUBLE / sum(total)::DOUBLE')} AS agreement, sum(correct)::DOUBLE / sum(total)::DOUBLE >= 0.9 AS ships FROM {_CELLS} GROUP BY 1""",
)
_sql(
    "agg14_low_ship_gate",
    f"SELECT model, {_r('avg(correct::INT)')} AS agreement, avg(correct::INT) >= 0.275 AS ships FROM marked WHERE task = 'analysis' GROUP BY 1",
)
_sql(
    "agg15_running_accuracy",
    f"""SELECT model, i::BIGINT AS i, {_r('hits / i::DOUBLE')} AS accuracy FROM (SELECT model, row_number() OVER w AS i, sum(correct::INT) OVER w AS hits
    FROM marked WHERE task = 'reaction' WINDOW w AS (PARTITION BY model ORDER BY row_id)) WHERE i % 20 = 0""",
)
_SHARE = "count(*) FILTER (model = '{0}' AND correct) / nullif(count(*) FILTER (model = '{0}'), 0)::DOUBLE"
_sql(
    "agg16_model_comparison",
    f"""SELECT task, source, {_rounded('tuned', 'base')}, {_r('tuned - base')} AS delta FROM (SELECT task, source, {_SHARE.format('tuned')} AS tuned,
    {_SHARE.format('base')} AS base FROM marked GROUP BY GROUPING SETS ((task, source), (task)))""",
)
_sql(
    "win11_eval_sample",
    f"""SELECT row_id, task, source FROM (SELECT *, row_number() OVER (PARTITION BY task, source ORDER BY {_bits('row_id', 'eval')}, row_id) AS n
    FROM eval_rows) WHERE n <= 10""",
)
_PHRASE = "CASE news_reaction " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in K.REACTION_PHRASES.items()) + " END"
_REASONING = f"replace(replace(replace({_q(K.FALLBACK_REASONING)}, '{{ticker}}', ticker), '{{phrase}}', {_PHRASE}), '{{recommendation}}', recommendation)"
_FINISHED = f""", done AS (
  SELECT k.feed_pos, k.ticker, k.news_reaction, k.move_1d, k.recommendation, k.valuation_bucket,
    CASE WHEN k.ticker IN ('NATION_3', 'NATION_7') THEN 'val' ELSE 'train' END AS split,
    g.* EXCLUDE (ticker, as_of) FROM kept k JOIN gaps g ON g.ticker = k.ticker AND g.as_of = k.as_of)
"""
_sql(
    "finished_rows",
    _FINISHED + f"""SELECT feed_pos, split, 'reaction' AS task, ticker, '' AS user_query, {_CONTEXT} AS price_context, '' AS valuation, news_reaction,
      '' AS recommendation, '' AS valuation_bucket, NULL AS reasoning, NULL AS answer FROM done
    UNION ALL SELECT feed_pos, split, 'analysis', ticker, {_QUESTION}, {_CONTEXT}, {_VALUATION}, news_reaction, recommendation, valuation_bucket,
      {_REASONING}, {_answer(_KIND, 'recommendation')} FROM done""",
)
ORACLE["job_rows_resumed"] = f"SELECT * EXCLUDE (feed_pos) FROM ({ORACLE['finished_rows']})"
_sql(
    "fn35_generated_texts",
    _FINISHED + f""", said AS (SELECT d.feed_pos, 'REASONING: ' || coalesce(a.text, '') || CASE WHEN d.feed_pos % 3 = 0 THEN '' ELSE chr(10) || 'ANSWER: ' || coalesce(b.text, '') END AS t
      FROM done d JOIN conversations a ON a.conv_id = d.feed_pos % 100 AND a.turn = 0 LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = 1),
    p AS (SELECT feed_pos, regexp_replace(regexp_extract(t, '(?is)REASONING:\\s*(.*?)(?:\\n\\s*ANSWER:|$)', 1), '^\\s+|\\s+$', '', 'g') AS r,
      regexp_replace(regexp_extract(t, '(?is)ANSWER:\\s*(.*)', 1), '^\\s+|\\s+$', '', 'g') AS a FROM said),
    j AS (SELECT feed_pos, r, nullif(a, '') AS a FROM p WHERE r <> '' AND length(r) <= 800 AND length(a) <= 400
      AND NOT regexp_matches(r, {_SUSPECT}) AND NOT regexp_matches(a, {_SUSPECT}))
    SELECT feed_pos, coalesce(r, {_REASONING}) AS reasoning, coalesce(a, {_answer(_KIND, 'recommendation')}) AS answer FROM done LEFT JOIN j USING (feed_pos)""",
)
_sql(
    "agg17_split_summary",
    _FINISHED + """SELECT 2 * count(*) AS total, 2 * count(*) FILTER (split = 'train') AS train, 2 * count(*) FILTER (split = 'val') AS val,
    count(DISTINCT ticker) AS tickers FROM done""",
)
_RULE = "#" * 100
_sql(
    "snk4_win10_review_headers",
    _FINISHED + f"""SELECT ticker, 1::BIGINT AS place, split, 2 * count(*) AS n, NULL AS header FROM done GROUP BY 1, 3
    UNION ALL SELECT DISTINCT ticker, 0, '', 1, chr(10) || '{_RULE}' || chr(10) || '# TICKER: ' || ticker || chr(10) || '{_RULE}' || chr(10) FROM done""",
)
_sql(
    "snk4_review_heading",
    _FINISHED + f"""SELECT 'REAL dataset review list: ' || 2 * count(*) || ' total rows (' || 2 * count(*) FILTER (split = 'train') || ' train, '
    || 2 * count(*) FILTER (split = 'val') || ' val), grouped by ticker.' || chr(10) || '{"=" * 100}' || chr(10) AS value FROM done""",
)
_sql("fn24_market_cap_text", f"SELECT o_orderkey, {_money('v')} AS amount FROM (SELECT o_orderkey, o_totalprice * 4e6::DOUBLE AS v FROM orders)", prelude=False)
_sql(
    "fn18_exact_decimal_text",
    "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, printf('%.1f', l_extendedprice / 8) AS one, printf('%.2f', -(l_extendedprice / 8)) AS two FROM lineitem",
    prelude=False,
)
_sql(
    "fn25_26_dates",
    f"SELECT o_orderkey, {_DATED.format('o_orderdate')} AS shown, o_orderdate::DATE::VARCHAR AS parsed FROM orders",
    prelude=False,
)
_sql("fn27_price_context", f"SELECT ticker, as_of::VARCHAR AS as_of, {_CONTEXT} AS price_context FROM day_labels WHERE move_1d IS NOT NULL")


def _noise(index: str, place: int) -> str:
    day = f"(DATE '2002-01-01' - {_index(7, 'feed_pos', f'noise-day-{place}')}::INT)"
    return (
        f"'- [' || {_DATED.format(day)} || '] ' || {_pick(K.NOISE_HEADLINES, index)} || ' - ' || "
        f"{_pick(K.NOISE_PUBLISHERS, _index(4, 'feed_pos', f'noise-publisher-{place}'))}"
    )


_sql(
    "fn28_news_blocks",
    f""", n1 AS (SELECT *, {_index(12, 'feed_pos', 'noise-1')} AS first, {_index(3, 'feed_pos', 'noise-count')} + 1 AS size FROM headlines),
    n2 AS (SELECT *, (first + 1 + {_index(11, 'feed_pos', 'noise-2')}) % 12 AS second FROM n1),
    n3 AS (SELECT *, list_filter(range(0, 12), lambda i: i <> first AND i <> second)[{_index(10, 'feed_pos', 'noise-3')} + 1] AS third FROM n2),
    n4 AS (SELECT feed_pos, list_concat([{_LINE}], list_slice([{_noise('first', 1)}, {_noise('second', 2)}, {_noise('third', 3)}], 1, size)) AS lines FROM n3)
    SELECT feed_pos, string_agg(line, chr(10) ORDER BY sha256(feed_pos || ':' || line)) AS news FROM (SELECT feed_pos, unnest(lines) AS line FROM n4) GROUP BY 1""",
)
_sql("fn29_window_index", "SELECT CASE WHEN window_idx BETWEEN 1 AND 400 THEN window_idx ELSE 0 END::BIGINT AS window_idx, count(*) AS n FROM headlines GROUP BY 1")
_sql("fn30_trait_rolls", f"SELECT c_custkey, {_r(_draw('c_name', 'dividend'))} AS roll FROM customer", prelude=False)
_DAY_KEY = "(ticker || '|' || as_of::VARCHAR)"


def _phrases(table: dict, tier: str, salt: str) -> str:
    return "CASE " + tier + " " + " ".join(
        f"WHEN {_q(name)} THEN {_pick(words, _index(len(words), _DAY_KEY, salt))}" for name, words in table.items()
    ) + " END"


_sql(
    "fn31_value_commentary",
    f""", tiers AS (SELECT ticker, as_of, CASE WHEN operating_margin IS NULL OR roe IS NULL THEN NULL WHEN operating_margin > 0.15 AND roe > 0.15 THEN 'strong'
        WHEN operating_margin < 0.08 OR roe < 0.08 THEN 'weak' ELSE 'adequate' END AS quality,
      CASE WHEN peg_ratio IS NULL THEN 'unknown' WHEN peg_ratio < 1 THEN 'cheap' WHEN peg_ratio > 2 THEN 'rich' ELSE 'fair' END AS growth FROM gaps)
    SELECT ticker, as_of::VARCHAR AS as_of, quality, growth, {_phrases(K.QUALITY_PHRASES, 'quality', 'quality')}
      || {_pick(K.COMMENTARY_CONNECTORS, _index(3, _DAY_KEY, 'connector'))} || {_phrases(K.GROWTH_PHRASES, 'growth', 'growth')} || '.' AS commentary FROM tiers""",
)
_sql(
    "fn32_fusion_clauses",
    f""", kinds AS (SELECT ticker, as_of, valuation_bucket, recommendation, text_gap, CASE WHEN valuation_bucket IN ('no_data', 'near_fair') THEN valuation_bucket
        WHEN news_reaction = 'neutral' THEN 'driving'
        WHEN recommendation = CASE WHEN news_reaction IN ('good', 'overreaction_down') THEN 'BUY' ELSE 'SELL' END THEN 'reinforcing' ELSE 'capping' END AS kind
      FROM signals WHERE news_reaction IS NOT NULL)
    SELECT ticker, as_of::VARCHAR AS as_of, kind, replace(replace(replace(replace({_phrases(K.FUSION_CLAUSES, 'kind', 'clause')}, '{{ticker}}', ticker),
      '{{bucket_word}}', valuation_bucket), '{{pct}}', coalesce(printf('%.0f', abs(text_gap)::DOUBLE), '')), '{{recommendation}}', recommendation) AS clause FROM kinds""",
)
_sql(
    "fn36_37_text_fields",
    r"""SELECT row_id, model, json_ok, CASE WHEN task = 'reaction' THEN predicted END AS reaction, CASE WHEN task = 'analysis' THEN predicted END AS call,
    CASE WHEN task = 'analysis' AND doc_id % 6 <> 3 THEN regexp_extract(fields, '"answer": "([^"]*)"', 1) END AS answer FROM marked""",
)
_sql("fn39_draws", "SELECT news_reaction, e.ticker, count(*) AS n FROM drawn d JOIN ent e ON e.entity_key = d.entity_no GROUP BY 1, 2")
_MISS = "CASE WHEN {0} < 0.15 THEN 'Data unavailable.' ELSE 'x' END"
_sql(
    "fn40_missing_blocks",
    "SELECT "
    + ", ".join(f"{_MISS.format(_draw('o_orderkey', f'missing-{n}'))} AS {n}" for n in ("market_data", "valuation", "earnings"))
    + ", count(*) AS n FROM orders GROUP BY 1, 2, 3",
    prelude=False,
)
_sql(
    "fn4_bucket_edges",
    """SELECT CASE WHEN g <= -15 THEN 'undervalued' WHEN g >= 15 THEN 'overvalued' ELSE 'near_fair' END AS bucket, count(*) AS n
    FROM (SELECT round(l_extendedprice / 100 - 500, 0) AS g FROM lineitem) GROUP BY 1""",
    prelude=False,
)
_SPLIT = "CASE WHEN ticker = 'NATION_3' OR (template_held_out AND NOT swapped) THEN 'val' ELSE 'train' END"
_sql(
    "join11_12_template_rows",
    f"""SELECT draw_id, {_SPLIT} AS split, ticker, news_reaction, true AS has_reasoning, swapped AND news_reaction = 'good' AS sector_good,
    swapped AND news_reaction = 'bad' AS sector_bad, CASE WHEN swapped THEN '' ELSE p_name END AS part_name FROM filled""",
)
_sql(
    "prj4_template_row_counts",
    f"SELECT t.task, {_SPLIT} AS split, news_reaction, count(*) AS n FROM filled CROSS JOIN (VALUES ('reaction'), ('analysis')) AS t(task) GROUP BY 1, 2, 3",
)
_sql(
    "set2_merged_pools",
    """SELECT pool, row_number() OVER (PARTITION BY pool ORDER BY place) - 1 AS idx, headline, n_reasonings FROM (
      SELECT pool, 2 * (row_number() OVER (PARTITION BY pool ORDER BY p_partkey) - 1) AS place, headline, n_reasonings FROM (
        SELECT ['good', 'bad', 'neutral', 'overreaction_down', 'overreaction_up'][p_partkey % 5 + 1] AS pool, p_partkey,
          '{name} ({ticker}) updates its ' || p_name || ' line' AS headline, 2::BIGINT AS n_reasonings FROM part)
      UNION ALL SELECT CASE WHEN p_partkey % 3 < 2 THEN 'neutral' WHEN p_size % 2 = 0 THEN 'good' ELSE 'bad' END, 2 * p_partkey + 1,
        '{name} ({ticker}) reviews its ' || p_name || ' line', 1 FROM part)""",
    prelude=False,
)
_sql(
    "str1_weekly_counts",
    """SELECT event_type AS ticker, strftime(TIMESTAMP '1970-01-01' + to_days((7 * floor(epoch(ts) / 604800))::INT), '%Y-%m-%d %H:%M:%S') AS after, count(*) AS n
    FROM events GROUP BY 1, 2""",
    prelude=False,
)
_sql(
    "set1_4_entity_sets",
    """, p AS (SELECT DISTINCT ticker, ceil(datediff('day', trade_date, DATE '2001-12-31' - 39) / 7.0)::BIGINT AS window_idx FROM prices),
    priced AS (SELECT * FROM p WHERE window_idx BETWEEN 1 AND 400),
    heard AS (SELECT DISTINCT ticker, window_idx::BIGINT AS window_idx FROM headlines WHERE window_idx BETWEEN 1 AND 400)
    SELECT ticker, window_idx, 'prices' AS part FROM priced UNION ALL SELECT ticker, window_idx, 'headlines' FROM heard
    UNION ALL SELECT ticker, window_idx, 'prices only' FROM (SELECT * FROM priced EXCEPT SELECT * FROM heard)""",
)
_sql(
    "str2_unseen_titles",
    """SELECT ticker, title, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, feed_pos FROM (
      SELECT ticker, feed_title AS title, published_at, feed_pos,
        row_number() OVER (PARTITION BY ticker, feed_title ORDER BY published_at, feed_pos) AS n FROM feed) WHERE n = 1""",
)
_sql(
    "str3_ready_labels",
    """SELECT feed_pos, news_reaction, skip_reason FROM headlines h JOIN day_labels l ON l.ticker = h.ticker AND l.as_of = h.as_of
    WHERE h.as_of <= DATE '1998-06-01' - 39""",
)
