"""DuckDB SQL that answers the p1_ to p3_ and p5_ to p7_ queries by plainer means."""

from __future__ import annotations

from marlstone.operators.schema_drift import squeezed_names
from marlstone.plans.holdings import HOLDING_FIELDS

_ALIASES = "aliases(k, f) as (values " + ", ".join(f"('{k}', '{f.name}')" for f in HOLDING_FIELDS for k in squeezed_names(f)) + ")"

_DRIFT = f"""
with {_ALIASES},
 recs as (select file_id, symbol, file_no, unnest(from_json(json_extract(body, '$.holdings'), '["JSON"]')) rec
   from bronze_holdings_files where json_valid(body)),
 keys as (select file_id, symbol, file_no, rec, unnest(json_keys(rec)) k from recs),
 typed as (select file_id, symbol, file_no, k,
     case json_type(json_extract(rec, '$."' || k || '"')) when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'OBJECT' then 'object'
       when 'ARRAY' then 'array' when 'NULL' then null else 'number' end t from keys),
 fields as (select file_id, symbol, file_no, coalesce(f, typed.k) field, any_value(typed.k) k, any_value(t) t
   from typed left join aliases a on a.k = regexp_replace(lower(typed.k), '[^a-z0-9]', '', 'g') group by all),
 pairs as (select file_id, lag(file_id) over (partition by symbol order by file_no) prev from (select distinct file_id, symbol, file_no from fields)),
 met as (select p.file_id, f.field, f.k, f.t, p.prev from pairs p join fields f using (file_id) where prev is not null),
 gone as (select p.file_id, f.field, f.k, f.t from pairs p join fields f on f.file_id = p.prev
   where not exists (select 1 from fields g where g.file_id = p.file_id and g.field = f.field)),
 both_sides as (select m.file_id, m.field, m.k, m.t, f.k pk, f.t pt from met m left join fields f on f.file_id = m.prev and f.field = m.field)
"""

_CHANGES = """
select file_id, field, 'added' as change, k as key, null as prev_key, t as type, null as prev_type from both_sides where pk is null
union all select file_id, field, 'removed', null, k, null, t from gone
union all select file_id, field, 'renamed', k, pk, t, pt from both_sides where pk <> k
union all select file_id, field, 'retyped', k, pk, t, pt from both_sides where pt <> t
"""

def _known(extra: str) -> str:
    return f"""
 rows as (select distinct symbol, trade_date{extra} from fact_valuation_daily),
 days as (select distinct symbol, trade_date from fact_valuation_daily),
 s as (select d.symbol, d.trade_date, arg_max(h.shares_outstanding, (h.as_of_date, h.pull_date)) v from days d join shares_history h
   on h.symbol = d.symbol and h.as_of_date <= d.trade_date and h.pull_date <= d.trade_date group by all),
 f as (select d.symbol, d.trade_date, max(e.fiscal_date_ending) v from days d join fact_earnings e
   on e.symbol = d.symbol and e.period_type = 'quarterly' and coalesce(e.report_date, e.fiscal_date_ending + 60) <= d.trade_date group by all)
"""


def _rolling(source: str, day: str, measure: str, windows: list[int], where: str, cast: str) -> tuple[str, str]:
    parts = []
    for w in windows:
        parts.append(
            f"""select c.symbol, strftime(c.day, '%Y-%m-%d') as day, '{measure}' as measure, {w} as days,
  coalesce(sum(e.x), 0)::double as total, count(e.x) as n, sum(e.x)::double / nullif(count(e.x), 0) as average
 from cal_{measure} c left join once_{measure} e on e.symbol = c.symbol and e.d between c.day - {w - 1} and c.day group by c.symbol, c.day"""
        )
    ctes = f"""
 once_{measure} as (select symbol, {day} d, {measure}::{cast} x from {source} where {where}
   qualify row_number() over (partition by symbol, {day} order by pull_date desc, gold_built_utc desc) = 1),
 cal_{measure} as (select symbol, unnest(generate_series(min(d), max(d), interval 1 day))::date as day from once_{measure} group by 1)"""
    return ctes, " union all ".join(parts)


def _rolling_all() -> str:
    specs = [
        _rolling("fact_prices_enriched", "trade_date", "volume", [7, 30], "true", "decimal(30,0)"),
        _rolling("fact_prices_enriched", "trade_date", "adjusted_close", [7, 30], "true", "decimal(30,6)"),
        _rolling("fact_fundamentals_wide", "fiscal_date_ending", "total_revenue", [120], "period_type = 'quarterly'", "decimal(30,0)"),
    ]
    return "with " + ",".join(c for c, _ in specs) + " " + " union all ".join(q for _, q in specs)


SQL = {
    "p1_found": """
with e as (select symbol, trade_date d, volume > 0 v, adjusted_close is not null a from fact_prices_enriched),
 q as (select symbol, fiscal_date_ending d, total_revenue is not null r from fact_fundamentals_wide where period_type = 'quarterly'),
 cal as (select symbol, unnest(generate_series(min(d), max(d), interval 1 day))::date as day from e group by 1),
 qcal as (select symbol, unnest(generate_series(min(d), max(d), interval 1 day))::date as day from q group by 1)
select symbol, strftime(day, '%Y-%m-%d') as day, 'volume' as measure from cal
 where not exists (select 1 from e where e.symbol = cal.symbol and e.v and e.d between cal.day - 6 and cal.day)
union all select symbol, strftime(day, '%Y-%m-%d'), 'adjusted_close' from cal
 where not exists (select 1 from e where e.symbol = cal.symbol and e.a and e.d between cal.day - 29 and cal.day)
union all select symbol, strftime(day, '%Y-%m-%d'), 'total_revenue' from qcal
 where not exists (select 1 from q where q.symbol = qcal.symbol and q.r and q.d between qcal.day - 119 and qcal.day)
""",
    "p1_rolling_totals": _rolling_all(),
    "p2_found": f"""
with {_known(', shares_outstanding, fundamentals_as_of')}
select distinct symbol, strftime(trade_date, '%Y-%m-%d') as trade_date, field from (
 select r.symbol, r.trade_date, unnest([case when r.shares_outstanding is distinct from s.v then 'shares_outstanding' end,
   case when r.fundamentals_as_of is distinct from f.v then 'fundamentals_as_of' end]) field
 from rows r left join s using (symbol, trade_date) left join f using (symbol, trade_date)) where field is not null
""",
    "p2_known_at_event": f"""
with {_known('')}
select r.symbol, r.universe, strftime(r.trade_date, '%Y-%m-%d') as trade_date, s.v as shares_outstanding, strftime(f.v, '%Y-%m-%d') as fundamentals_as_of
from fact_valuation_daily r left join s using (symbol, trade_date) left join f using (symbol, trade_date)
""",
    "p3_found": f"{_DRIFT} select file_id, field, change from ({_CHANGES})",
    "p3_change_report": f"""{_DRIFT}, marks as (select file_id, symbol, file_no, list_sort(list(k || '|' || coalesce(t, ''))) fp from fields group by all),
 turns as (select *, (fp is distinct from lag(fp) over (partition by symbol order by file_no))::int turn from marks),
 vers as (select file_id, (sum(turn) over (partition by symbol order by file_no))::bigint as schema_version from turns)
select * from ({_CHANGES}) join vers using (file_id)""",
    "p5_found": """
with docs as (select file_id, symbol, pull_date, json_extract(body, '$."Time Series (Daily)"') s from bronze_price_files where json_valid(body)),
 days as (select file_id, symbol, pull_date, s, unnest(json_keys(s)) k from docs where json_type(s) = 'OBJECT'),
 recs as (select file_id, symbol, pull_date, k, json_extract(s, '$."' || k || '"') r from days),
 vals as (select file_id, symbol, pull_date, k, """
    + ", ".join(f"try_cast(json_extract_string(r, '$.\"{k}\"') as double) v{i}" for i, k in enumerate(("1. open", "2. high", "3. low", "4. close", "5. adjusted close", "6. volume", "7. dividend amount", "8. split coefficient")))
    + """ from recs)
select min(file_id) as file_id, symbol, k as trade_date from vals group by symbol, pull_date, k, v0, v1, v2, v3, v4, v5, v6, v7
""",
    "p5_daily_prices": "select row_id, symbol, strftime(trade_date, '%Y-%m-%d') as trade_date, strftime(pull_date, '%Y-%m-%d') as pull_date, close, volume from fact_daily_prices",
    "p6_found": """
with named as (select *, upper(trim(symbol)) key from dim_company),
 once as (select * from named where key is not null and key not in ('', 'NONE', 'NULL')
   qualify row_number() over (partition by snapshot_date, key order by last_updated desc) = 1),
 norm as (select snapshot_date, key, ["""
    + ", ".join(f"case when upper(trim({c})) not in ('', 'NONE', 'NULL') then upper(trim({c})) end" for c in ("name", "exchange", "asset_type", "cik", "sector", "industry", "country", "currency", "fiscal_year_end", "listing_status"))
    + """, ipo_date::varchar, delisted_date::varchar] vals from once),
 days as (select distinct snapshot_date from norm),
 pairs as (select snapshot_date, lag(snapshot_date) over (order by snapshot_date) prev from days),
 now_rows as (select n.snapshot_date, p.prev, key, vals from norm n join pairs p using (snapshot_date) where prev is not null),
 then_rows as (select p.snapshot_date, key, vals from norm n join pairs p on p.prev = n.snapshot_date)
select strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, key as symbol,
 case when t.vals is null then 'added' when n.vals is null then 'removed' else 'changed' end as change
from now_rows n full join then_rows t using (snapshot_date, key)
where t.vals is null or n.vals is null or t.vals is distinct from n.vals
""",
    "p7_found": """
with price as (select universe, load_id, count(*) n, count(*) - count(adjusted_close) a_null, count(*) - count(trade_date) d_null,
   count(*) filter (isnan(adjusted_close) or adjusted_close <= 0 or adjusted_close >= 100000) a_range,
   count(*) filter (trade_date > pull_date or trade_date < date '2000-01-01') d_range,
   count(*) filter (isodow(trade_date) >= 6) d_pattern, count(distinct trade_date) d_distinct,
   median(adjusted_close) filter (not isnan(adjusted_close) and adjusted_close > 0 and adjusted_close < 100000) a_median
  from fact_daily_prices group by all),
 company as (select universe, load_id, count(*) n, count(*) - count(symbol) s_null, count(distinct symbol) s_distinct,
   count(*) filter (symbol is not null and not regexp_full_match(symbol, '[A-Z]+(-[A-Z])?')) s_pattern from dim_company group by all),
 p as (select a.*, b.a_median pm, b.d_distinct pd from price a left join price b on b.universe = a.universe and b.load_id = a.load_id - 1),
 c as (select a.*, b.s_distinct ps from company a left join company b on b.universe = a.universe and b.load_id = a.load_id - 1)
select 'fact_daily_prices' as table_name, 'adjusted_close' as column_name, load_id, unnest([case when a_null > 0.1 * n then 'null_rate' end,
   case when a_range > 0 then 'range' end, case when a_median > 4 * pm or a_median < pm / 4 then 'distribution' end]) as finding from p qualify finding is not null
union all select 'fact_daily_prices', 'trade_date', load_id, unnest([case when d_null > 0.1 * n then 'null_rate' end, case when d_range > 0 then 'range' end,
   case when d_pattern > 0 then 'pattern' end, case when d_distinct > 2 * pd or d_distinct * 2 < pd then 'distribution' end]) as finding from p qualify finding is not null
union all select 'dim_company', 'symbol', load_id, unnest([case when s_null > 0.1 * n then 'null_rate' end, case when s_pattern > 0 then 'pattern' end,
   case when s_distinct > 1.5 * ps or s_distinct * 3 < ps * 2 then 'distribution' end]) as finding from c qualify finding is not null
""",
}
SQL["p7_found"] = "select * from (" + SQL["p7_found"].replace(" qualify finding is not null", "") + ") where finding is not null"
SQL["p7_profile"] = """
with x as (select universe, load_id, adjusted_close a, trade_date d, pull_date p,
   case when not isnan(adjusted_close) and adjusted_close > 0 and adjusted_close < 100000 then adjusted_close end g from fact_daily_prices),
 price as (select universe, load_id, count(*) n, count(*) - count(a) nulls, count(distinct a) n_distinct, count(*) filter (a is not null and g is null) v_range, 0 v_pattern, median(g) median, min(g) lo, max(g) hi,
   sum(round(g * 10000)) / nullif(count(g), 0) / 10000 mean, stddev_pop(round(g * 10000)) / 10000 sd from x group by all),
 third as (select p.universe, p.load_id, avg(pow((round(x.g * 10000) / 10000 - p.mean) / nullif(p.sd, 0), 3)) skew from price p join x on x.universe = p.universe and x.load_id = p.load_id group by all),
 q as (select a.*, t.skew, (a.mean - b.mean) / nullif(sqrt((a.sd * a.sd + b.sd * b.sd) / 2), 0) shift from price a left join price b on b.universe = a.universe and b.load_id = a.load_id - 1 left join third t on t.universe = a.universe and t.load_id = a.load_id)
select 'fact_daily_prices' as table_name, 'adjusted_close' as column_name, universe, load_id, n, nulls, n_distinct, v_range, v_pattern::bigint as v_pattern, median, null as lo_text, null as hi_text, lo, hi, 0::bigint as big, round(mean, 8) as mean, round(sd, 8) as sd, round(skew, 4) as skew, round(shift, 6) as shift from q
union all select 'fact_daily_prices', 'trade_date', universe, load_id, count(*), count(*) - count(d), count(distinct d), count(*) filter (d > p or d < date '2000-01-01'), count(*) filter (isodow(d) >= 6), null, min(d)::varchar, max(d)::varchar, null, null, 0, null, null, null, null from x group by all
union all select 'dim_company', 'symbol', universe, load_id, count(*), count(*) - count(symbol), count(distinct symbol), 0, count(*) filter (symbol is not null and not regexp_full_match(symbol, '[A-Z]+(-[A-Z])?')), null, min(symbol), max(symbol), null, null, 0, null, null, null, null from dim_company group by all
"""

_NUMBER = "try_cast(regexp_replace({}, '[,%$ ]', '', 'g') as double)"
SQL["p3_holdings"] = f"""
with {_ALIASES},
 files as (select file_id, symbol, file_no, pull_date, from_json(json_extract(body, '$.holdings'), '["JSON"]') recs from bronze_holdings_files where json_valid(body)),
 recs as (select file_id, symbol, file_no, pull_date, unnest(recs) rec, generate_subscripts(recs, 1) place from files where len(recs) > 0),
 keys as (select file_id, place, rec, unnest(json_keys(rec)) k from recs),
 vals as (select file_id, place, f field, json_extract(rec, '$."' || keys.k || '"') v from keys join aliases a on a.k = regexp_replace(lower(keys.k), '[^a-z0-9]', '', 'g')),
 texts as (select file_id, place, field, case when json_type(v) = 'OBJECT' then coalesce(json_extract_string(v, '$.name'), json_extract_string(v, '$.amount')) else json_extract_string(v, '$') end t from vals),
 wide as (select file_id, place, max(t) filter (field = 'holder_name') holder_name, {', '.join(f"{_NUMBER.format(f'max(t) filter (field = {chr(39)}{c}{chr(39)})')} {c}" for c in ('shares_held', 'shares_change', 'pct_of_portfolio', 'market_value'))},
   max(t) filter (field = 'report_date') d from texts group by all),
 dated as (select r.file_id, r.symbol, r.file_no, r.pull_date, w.* exclude (file_id, place, d),
   case when d like '____-__-__' then try_cast(d as date) when d like '________' then try_strptime(d, '%Y%m%d')::date else try_strptime(d, '%m/%d/%Y')::date end report_date from recs r left join wide w using (file_id, place)),
 per_file as (select file_id, max(report_date) fd, sum(market_value) filter (shares_held > 0) / nullif(sum(shares_held) filter (market_value is not null and shares_held > 0), 0) price from dated group by 1),
 chain as (select file_id, lag(file_id) over (partition by symbol order by file_no) before from (select distinct file_id, symbol, file_no from dated)),
 held as (select file_id before, holder_name, max(shares_held) h from dated where shares_held is not null group by all)
select d.symbol, coalesce(d.holder_name, 'UNKNOWN') as holder_name, coalesce(d.shares_held, round(market_value / nullif(price, 0)), h + coalesce(shares_change, 0), h, shares_change, 0) as shares_held,
 shares_change, pct_of_portfolio, market_value, coalesce(report_date, fd, date_trunc('quarter', pull_date)::date - 1) as report_date, pull_date, file_id
from dated d left join per_file using (file_id) left join chain using (file_id) left join held on held.before = chain.before and held.holder_name = d.holder_name
"""
