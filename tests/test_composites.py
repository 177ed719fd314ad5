import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from marlstone.functions import clean
from marlstone.operators import cross_section as cs
from marlstone.operators.asof import asof_join
from marlstone.plans import composites as cp

D = dt.date
QUARTERS = [D(2022, 3, 31), D(2022, 6, 30), D(2022, 9, 30), D(2022, 12, 31), D(2023, 3, 31), D(2023, 6, 30)]
INC = "symbol string, fiscal_date_ending date, period_type string, reported_currency string, total_revenue long, gross_profit long, operating_income long, net_income long, ebitda long, interest_expense long, pull_date date, extra string"
BAL = "symbol string, fiscal_date_ending date, period_type string, total_assets long, total_equity long, cash_and_equivalents long, short_term_investments long, long_term_debt long, short_term_debt long, pull_date date"
CASH = "symbol string, fiscal_date_ending date, period_type string, operating_cashflow long, capex long, free_cash_flow long, dividend_payout long, pull_date date"
EARN = "symbol string, fiscal_date_ending date, period_type string, reported_eps double, estimated_eps double, report_date date, pull_date date"


def wide(spark, inc=(), bal=(), cash=(), earn=()):
    return cp.fundamentals_wide(*[spark.createDataFrame(list(r), s) for r, s in ((inc, INC), (bal, BAL), (cash, CASH), (earn, EARN))])


def income(d, revenue, kind="quarterly", pull=D(2024, 1, 1), net=10, interest=5):
    return ("A", d, kind, "USD", revenue, 40, 20, net, 30, interest, pull, "clash")


def test_fundamentals_wide(spark):
    inc = [income(d, 100 + i) for i, d in enumerate(QUARTERS)] + [income(QUARTERS[0], 999, pull=D(2023, 1, 1))] * 2  # older repeats
    inc += [income(D(2022, 12, 31), 0, "annual", interest=0)]
    bal = [("A", QUARTERS[0], "quarterly", 500, 0, None, 7, 60, None, D(2024, 2, 1))] * 3 + [("B", QUARTERS[0], "quarterly", 1, 1, 1, 1, 1, 1, D(2024, 2, 1))]
    cash = [("A", d, "quarterly", 15, 5, None if i == 1 else 10, 3, D(2024, 1, 5)) for i, d in enumerate(QUARTERS)]
    rows = {(r.symbol, r.fiscal_date_ending, r.period_type): r for r in wide(spark, inc, bal, cash).collect()}
    assert len(rows) == 8 and rows["B", QUARTERS[0], "quarterly"].total_revenue is None
    a = rows["A", QUARTERS[0], "quarterly"]
    assert (a.total_revenue, a.gross_margin, a.roe, a.roic, a.debt_to_equity, a.net_debt, a.interest_coverage, a.pull_date) == (100, 0.4, None, 20 / 60, None, 53, 4.0, D(2024, 2, 1))
    assert a.accruals_ratio == -5 / 500 and a.cash_conversion == 1.5
    last = rows["A", QUARTERS[5], "quarterly"]
    assert (last.total_revenue_ttm, last.free_cash_flow_ttm, rows["A", QUARTERS[4], "quarterly"].free_cash_flow_ttm, rows["A", QUARTERS[2], "quarterly"].total_revenue_ttm) == (102 + 103 + 104 + 105, 40, None, None)
    assert last.revenue_growth_yoy == pytest.approx((105 - 101) / 101) and last.revenue_growth_qoq == pytest.approx(1 / 104)
    year = rows["A", D(2022, 12, 31), "annual"]
    assert (year.gross_margin, year.interest_coverage, year.total_revenue_ttm, year.revenue_growth_qoq) == (None, None, None, None)


def test_growth_rates_come_from_the_last_year_that_has_one(spark):
    eps = [1.0, 2.0, 3.0, 8.0, -1.0, 5.0, None]
    earn = [("A", D(2010 + i, 12, 31), "annual", e, None, None, D(2024, 1, 1)) for i, e in enumerate(eps)] + [("A", QUARTERS[0], "quarterly", 1.0, None, None, D(2024, 1, 1))]
    rows = wide(spark, earn=earn).collect()
    assert {(round(r.eps_cagr_5y, 9), round(r.eps_cagr_3y, 9), r.eps_cagr_as_of) for r in rows} == {(round(5 ** (1 / 5) - 1, 9), round((5 / 3) ** (1 / 3) - 1, 9), D(2016, 12, 31))}


def test_valuation(spark):
    q = [(d, "quarterly") for d in QUARTERS]
    earn = [("A", d, k, 1.0, None, None if i == 4 else D(2023, 5, 1) if i == 3 else d + dt.timedelta(days=30), D(2024, 1, 1)) for i, (d, k) in enumerate(q)]
    earn += [("A", D(2017 + i, 12, 31), "annual", 1.0 * 1.1**i, None, None, D(2024, 1, 1)) for i in range(6)]
    w = wide(spark, [income(d, 1000) for d in QUARTERS], [("A", d, "quarterly", 5000, 1000, 100, None, 400, 50, D(2024, 1, 1)) for d in QUARTERS], earn=earn)
    days = [D(2020, 1, 1), D(2022, 12, 1), D(2023, 5, 1), D(2023, 5, 30), D(2023, 7, 30)]
    prices = spark.createDataFrame([("A", d, 2.0, 2.0) for d in days] + [("Z", days[1], 3.0, 3.0)], "symbol string, trade_date date, close double, adjusted_close double")
    firms = spark.createDataFrame([("A", "S", "I", 100)], "symbol string, sector string, industry string, shares_outstanding long")
    rows = {(r.symbol, r.trade_date): r for r in cp.valuation_daily(prices, firms, w).collect()}
    assert [rows["A", d].fundamentals_as_of for d in days] == [None, QUARTERS[2], QUARTERS[3], QUARTERS[4], QUARTERS[5]]
    r = rows["A", days[3]]
    assert (r.market_cap, r.enterprise_value, r.pe_ttm, r.ps_ttm, r.pb) == (200.0, 550.0, 0.5, 0.05, 0.2)
    assert r.fair_pe == pytest.approx(8 + 5) and r.fair_price == pytest.approx(52) and r.upside_pct == pytest.approx(25) and r.margin_of_safety_met is True
    assert rows["A", days[0]].fair_price is None and rows["Z", days[1]].market_cap is None


def test_prices_without_benchmark_and_short(spark):
    rows = [("A", D(2024, 1, 1) + dt.timedelta(days=i), 1.0, 2.0, 1.0, 1.5, 10.0 + i, 5) for i in range(30)]
    df = spark.createDataFrame(rows, "symbol string, trade_date date, open double, high double, low double, close double, adjusted_close double, volume long")
    out = cp.prices_enriched(df, "none").orderBy("trade_date").collect()
    assert len(out) == 30 and out[0].return_1d is None and out[-1].return_21d == pytest.approx(39 / 18 - 1) and out[-1].rel_strength_3m is None and out[-1].sma_50 is None
    assert out[-1].rsi_14 is None and out[18].bb_middle is None and out[19].bb_middle == pytest.approx(19.5)  # only gains: no strength index
    assert cp.prices_enriched(df.limit(0), "none").count() == 0


def brute_asof(left, right, equal):
    out = []
    for i, k, t in left:
        ok = [(u, p) for q, u, p in right if q == k and u and t and (u < t or (equal and u == t))]
        out.append((i, max(ok)[1] if ok and k is not None else None))
    return out


@pytest.mark.parametrize("block", [1, 7, 1000])
@pytest.mark.parametrize("equal", [True, False])
def test_asof_over_blocks(spark, block, equal):
    r = random.Random(block)
    day = lambda: D(2023, 12, 1) + dt.timedelta(days=r.randrange(90)) if r.random() > 0.05 else None
    left = [(i, r.choice(["A", "A", "B", "C", None]), day()) for i in range(200)]
    right = list({(k, u): (k, u, p) for k, u, p in [(r.choice(["A", "A", "B", None]), day(), r.randrange(99)) for _ in range(40)]}.values())
    a, b = spark.createDataFrame(left, "i int, k string, t date"), spark.createDataFrame(right, "k string, u date, p int")
    got = asof_join(a, b, ["k"], "t", "u", ["p"], equal, block).collect()
    assert sorted((x.i, x.p) for x in got) == sorted(brute_asof(left, right, equal))


def test_asof_over_partitioned_inputs(spark):
    """Inputs that are already dealt out by key for windows of their own."""
    from marlstone.operators.relational import latest_by

    left = spark.createDataFrame([(k, D(2020, 1, 1) + dt.timedelta(days=40 * i)) for k in "ABCDEFGH" for i in range(40)], "k string, t date")
    right = spark.createDataFrame([(k, D(2020, 1, 1) + dt.timedelta(days=90 * i), i) for k in "ABCDEFGH" for i in range(20)], "k string, u date, v int")
    one = latest_by(left, ["k", "t"], [F.desc("t")], cluster=["k"])
    two = latest_by(right, ["k", "u"], [F.desc("v")], cluster=["k"])
    assert all(r.v == min(19, (r.t - D(2020, 1, 1)).days // 90) for r in asof_join(one, two, ["k"], "t", "u", ["v"]).collect())


def test_exact_quantiles(spark):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", "b", None]), r.choice([r.gauss(0, 50), 1.5, float(r.randrange(5))])) for _ in range(900)] + [("a", None), ("a", float("nan")), ("b", float("inf")), ("c", 2.0)]
    got = {x.g: x for x in cs.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], F.col("v"), {"p25": 0.25, "median": 0.5, "p99": 0.99}).collect()}
    for g in "abc":
        xs = sorted(v for k, v in rows if k == g and v is not None and math.isfinite(v))
        def at(q, xs=xs):
            p = q * (len(xs) - 1)
            lo = math.floor(p)
            return xs[lo] + (xs[min(lo + 1, len(xs) - 1)] - xs[lo]) * (p - lo)
        assert got[g].n == len(xs) and got[g].p25 == pytest.approx(at(0.25)) and got[g]["median"] == pytest.approx(at(0.5)) and got[g].p99 == pytest.approx(at(0.99)) and got[g]["mean"] == pytest.approx(sum(xs) / len(xs))
    assert set(got) == {"a", "b", "c"}


def test_peers_against_brute_force(spark):
    r = random.Random(6)
    firms = [(f"k{i:02d}", r.choice("XY"), r.choice("abcd") if r.random() > 0.1 else None, 10 ** r.uniform(0, 5)) for i in range(60)] + [("zero", "X", "a", 0.0), ("none", None, "a", 5.0)]
    days = [(k, t, r.gauss(0, 1)) for k, *_ in firms for t in range(20) if r.random() > 0.2]
    got = cs.peers(spark.createDataFrame(firms, "k string, w string, n string, s double"), spark.createDataFrame(days, "k string, t int, x double"), "k", "t", "x", "s", ("w", "n"), 5, 2.0, 12, (0.6, 0.4)).collect()
    series = {}
    for k, t, x in days:
        series.setdefault(k, {})[t] = x
    def corr(a, b):
        both = sorted(set(series[a]) & set(series[b]))
        if len(both) < 12:
            return None
        xs, ys = [series[a][t] for t in both], [series[b][t] for t in both]
        mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
        return sum((x - mx) * (y - my) for x, y in zip(xs, ys, strict=True)) / math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))
    want = {}
    ok = [f for f in firms if f[1] and f[3] > 0]
    for k, w, n, s in ok:
        near = [(p, pw, n is not None and pn == n, math.log10(ps / s)) for p, pw, pn, ps in ok if p != k and abs(math.log10(ps / s)) <= 2]
        pool = [x for x in near if x[2]]
        pool = pool if len(pool) >= 5 else [x for x in near if x[1] == w]
        want[k] = [p for _, _, p in sorted((not m, -round(0.6 * (1 - abs(lr) / 2) + 0.4 * (corr(k, p) or 0), 9), p) for p, _, m, lr in pool)[:5]]
    have = {}
    for x in sorted(got, key=lambda x: x.rank):
        have.setdefault(x.key, []).append(x.peer)
    assert have == {k: v for k, v in want.items() if v}


def test_peer_fallback_order(spark):
    firms = spark.createDataFrame([("A", "S", "I", 10.0), ("B", "S", "I", 9.0), ("C", "S", "J", 10.0), ("D", "T", "J", 10.0), ("E", "S", "J", 1e5)], "symbol string, sector string, industry string, size double")
    sets = spark.createDataFrame([("B", "Z", 1)], "symbol string, peer_symbol string, peer_rank long")
    def of(name, **more):
        return [(r.peer_symbol, r.place, r.source) for r in cp.peers_or_fallback(firms.where(F.col("symbol") == name), firms, sets, **more).orderBy("place").collect()]
    assert of("A") == [("B", 1, "inline"), ("C", 2, "inline")] and of("B") == [("Z", 1, "stored")] and of("A", override=["x", "y"]) == [("X", 1, "by hand"), ("Y", 2, "by hand")]


def test_symbol_list():
    assert clean.symbol_list(["BRK.B", "AB-C", "X1"]) == ["BRK.B", "AB-C", "X1"]
    for bad in ("a b", "x';--", "", "a_b"):
        with pytest.raises(ValueError, match="symbol"):
            clean.symbol_list([bad])


def test_roles_and_titles(spark):
    turns = spark.createDataFrame([("A", "2024Q1", t, s, c) for t, s, c in ((None, 1.0, "x"), ("Operator, former CEO", 0.5, ""), ("Analyst", -1.0, "ab"), ("Director PACEOX", 0.2, "abcd"), ("CFO", 0.4, "abcd"), ("CFO", None, "abcd"))], "symbol string, quarter string, title string, sentiment double, content string")
    calls = spark.createDataFrame([("A", "2024Q1", D(2024, 2, 1), 3)], "symbol string, quarter string, call_date date, participant_count long")
    r = cp.transcript_sentiment(turns, calls).first()
    assert (r.scored_turns, r.mgmt_turns, r.analyst_turns, r.call_date) == (5, 2, 1, D(2024, 2, 1))
    assert r.ceo_cfo_avg_sentiment == pytest.approx(0.45) and r.mgmt_wtd_sentiment == pytest.approx(0.3) and r.mgmt_analyst_spread == pytest.approx(1.3) and r.overall_avg_sentiment == pytest.approx(-0.4 / 3)
