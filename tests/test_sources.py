import json

import pytest

from marlstone.quality import checks
from marlstone.quality.metrics import JobRecord
from marlstone.sources import documents as docs
from marlstone.sources import storage
from marlstone.sources.tables import scan, table_exists


@pytest.fixture
def tree(tmp_path):
    def put(kind, symbol, stamp, body):
        p = tmp_path / kind / symbol / f"{stamp}.json"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(body if isinstance(body, str) else json.dumps(body))
    put("income_statement", "AA", "2024-01-01", {"annualReports": [{"fiscalDateEnding": "2023-12-31", "totalRevenue": "100.0", "ebit": "None"}], "quarterlyReports": [{"fiscalDateEnding": "2023-09-30", "totalRevenue": "x"}, {"fiscalDateEnding": None}]})
    put("income_statement", "AA", "2023-01-01", {"annualReports": [{"fiscalDateEnding": "2020-12-31"}]})
    put("income_statement", "BB", "2024-01-01", '{"annualReports": [{"fisc')
    put("etf_profile", "E", "2024-01-01", {"net_assets": "5", "holdings": [{"symbol": "AA", "weight": "0.5"}, {"symbol": "", "weight": "1"}], "sectors": [{"sector": "Tech", "weight": "1"}]})
    put("earnings_transcript", "AA", "2023Q3", {"transcript": [{"speaker": "x", "content": "hi", "sentiment": "0.2"}, {"speaker": None, "content": ""}]})
    put("news_sentiment", "T", "2024-01-01", {"feed": [{"url": "u", "title": "t", "time_published": "20240101T1000", "authors": ["a", "b"], "ticker_sentiment": [{"ticker": "AA", "relevance_score": "0.5", "ticker_sentiment_score": "0.1"}, {"ticker": "BB"}]}]})
    put("company_overview", "AA", "2024-01-01", {"Name": "Alpha", "MarketCapitalization": "12.7"})
    put("company_overview", "BB", "2024-01-01", "{}")
    put("shares_outstanding", "AA", "2024-01-01", {"data": [{"date": "2023-12-31", "shares_outstanding_basic": "9"}, {"date": "2023-09-30", "shares_outstanding_basic": "8"}]})
    return tmp_path


def parsed(spark, tree, kind, i=0, keep=("symbol", "pull_date"), latest=True):
    files = docs.read_documents(spark, str(tree / kind))
    return docs.parse(docs.latest_documents(files) if latest else files, docs.SPECS[kind][i], keep)


def test_reports(spark, tree):
    got = {(r.symbol, str(r.fiscal_date_ending), r.period_type, r.total_revenue, r.ebit) for r in parsed(spark, tree, "income_statement").collect()}
    assert got == {("AA", "2023-12-31", "annual", 100, None), ("AA", "2023-09-30", "quarterly", None, None)}
    assert parsed(spark, tree, "income_statement", latest=False).count() == 3


def test_nested(spark, tree):
    assert parsed(spark, tree, "etf_profile").first().net_assets == 5.0
    assert [r.holding_symbol for r in parsed(spark, tree, "etf_profile", 1).collect()] == ["AA"]
    assert [r.sector for r in parsed(spark, tree, "etf_profile", 2).collect()] == ["Tech"]
    turns = parsed(spark, tree, "earnings_transcript", keep=("symbol", "stamp")).orderBy("turn_idx").collect()
    assert [(r.stamp, r.turn_idx, r.speaker) for r in turns] == [("2023Q3", 0, "x"), ("2023Q3", 1, None)]
    news = docs.read_documents(spark, str(tree / "news_sentiment"))
    assert docs.parse(news, docs.SPECS["news_sentiment"][0]).first().authors == '["a","b"]'
    assert {(r.ticker, r.relevance) for r in docs.news_tickers(news).collect()} == {("AA", 0.5), ("BB", None)}
    assert [(r.symbol, r.market_cap) for r in parsed(spark, tree, "company_overview").collect()] == [("AA", 12)]
    assert [(r.place, r.shares_outstanding) for r in parsed(spark, tree, "shares_outstanding").orderBy("place").collect()] == [(0, 9), (1, 8)]


@pytest.mark.parametrize("kind", sorted(docs.SPECS))
def test_every_kind_survives_bad_bodies(spark, kind):
    bad = spark.createDataFrame([("A", None, None), ("A", None, ""), ("A", None, "{"), ("A", None, "[]"), ("A", None, '"x"'), ("A", None, '{"data": null, "feed": {}}')], "symbol string, pull_date date, body string")
    for spec in docs.SPECS[kind]:
        assert docs.parse(bad, spec).count() == 0


def test_csv(spark, tmp_path):
    a, d = tmp_path / "a.csv", tmp_path / "d.csv"
    a.write_text("symbol, name,exchange,assetType,ipoDate,delistingDate,status\nAA,Alpha,N,Stock,2001-01-01,null,Active\nBB,Beta,N,Stock,,null,Active\n")
    d.write_text("symbol,name,exchange,assetType,ipoDate,delistingDate,status\nAA,Old,N,Stock,1999-01-01,2000-01-01,Delisted\n")
    got = {r.symbol: (r["name"], r.listing_status, r.delisted_date) for r in docs.listing(docs.read_csv(spark, str(a)), docs.read_csv(spark, str(d))).collect()}
    assert got == {"AA": ("Alpha", "active", None), "BB": ("Beta", "active", None)}
    c = tmp_path / "c.csv"
    c.write_text("symbol,name,active\naa,x,True\nbb,y,false\n")
    assert [r.symbol for r in docs.active_symbols(docs.read_csv(spark, str(c))).collect()] == ["AA"]
    k = tmp_path / "k.csv"
    k.write_text("symbol,name,reportDate,fiscalDateEnding,estimate,currency\nAA,x,2024-05-01,2024-03-31,1.5,USD\nBB,,bad,,None,\n")
    assert [(r.symbol, r.estimate) for r in docs.earnings_calendar(docs.read_csv(spark, str(k)), "2024-04-01").collect()] == [("AA", 1.5)]


def test_quarter_dates(spark, day):
    turns = spark.createDataFrame([("AA", "2023Q3"), ("AA", "2020Q1")], "symbol string, stamp string")
    e = spark.createDataFrame([("AA", day("2023-09-30"), day("2023-11-01"), day("2023-11-02")), ("AA", day("2023-09-30"), day("2023-11-05"), day("2023-12-02"))], "symbol string, fiscal_date_ending date, report_date date, pull_date date")
    assert {r.stamp: str(r.report_date) for r in docs.with_quarter_dates(turns, e).collect()} == {"2023Q3": "2023-11-05", "2020Q1": "None"}


def test_storage_and_sinks(spark, tmp_path):
    root = tmp_path / "lake"
    for layer, n in (("bronze", 3), ("silver", 1)):
        (root / layer / "prices").mkdir(parents=True)
        for i in range(n):
            (root / layer / "prices" / f"{i}.json").write_text("x" * 10)
    got = {(r.layer, r.dataset): (r.files, r.bytes) for r in storage.inventory(spark, str(root)).collect()}
    assert got == {("bronze", "prices"): (3, 30), ("silver", "prices"): (1, 10)}
    storage.write_csv(spark.range(3), str(tmp_path / "out"))
    assert docs.read_csv(spark, str(tmp_path / "out")).count() == 3
    spark.range(2).write.parquet(str(tmp_path / "p1"))
    spark.range(2).selectExpr("id", "'x' as s").write.parquet(str(tmp_path / "p2"))
    assert scan(spark, str(tmp_path / "p1"), str(tmp_path / "p2")).columns == ["id", "s"]
    assert table_exists(spark, str(tmp_path / "p1")) and not table_exists(spark, str(tmp_path / "nothing"))


def test_quality(spark, tmp_path, day):
    df = spark.createDataFrame([("a", day("2024-01-05"), None), ("a", day("2024-01-05"), 1.0)], "k string, d date, x double")
    assert not checks.unique("t", df, ["k"]).passed and checks.unique("t", df, ["k"]).details["examples"] == [["a"]]
    assert [r.passed for r in checks.freshness("t", df, "d", "2024-01-08")] == [True, True]  # Friday to Monday
    assert [r.passed for r in checks.freshness("t", df, "d", "2024-01-10")] == [False, True]
    assert [r.passed for r in checks.freshness("t", df.limit(0), "d", "2024-01-10")] == [False, False]
    assert not checks.null_rate("t", df, "x", 1.0).passed and checks.null_rate("t", df.limit(0), "x", 1.0).passed
    assert checks.coverage("t", df, df, "k", 100.0).passed and not checks.columns_present("t", df, ["k", "z"]).passed
    code, report = checks.run("s", {"rows": lambda: checks.has_rows("t", df), "broken": lambda: 1 / 0}, str(tmp_path / "r.json"))
    assert code == 1 and report["failed"] == ["broken"] and json.loads((tmp_path / "r.json").read_text())["suite"] == "s"
    with pytest.raises(ValueError, match="x"), JobRecord(spark, "job", str(tmp_path / "m")) as m:
        m.count("calls", 2)
        raise ValueError("x")
    row = json.loads(next((tmp_path / "m").glob("*.json")).read_text())
    assert (row["status"], row["calls"]) == ("failed", 2)


def test_spreadsheet(spark, tmp_path):
    import zipfile

    from marlstone.sources.spreadsheet import read_sheet

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = f'''<worksheet {ns}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>title</t></is></c></row>
      <row r="4"><c r="A4" t="s"><v>0</v></c><c r="C4" t="s"><v>1</v></c></row>
      <row r="5"><c r="A5" t="inlineStr"><is><t>AA</t></is></c><c r="C5"><v>1.5</v></c></row>
      <row r="6"><c r="A6" t="s"><v>2</v></c></row><row r="8"><c r="A8" t="inlineStr"><is><t>footer</t></is></c></row></sheetData></worksheet>'''
    shared = f"<sst {ns}><si><t>Ticker</t></si><si><t>Weight</t></si><si><t>BB</t></si></sst>"
    with zipfile.ZipFile(tmp_path / "h.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", shared)
    assert [tuple(r) for r in read_sheet(spark, str(tmp_path / "h.xlsx"), 4, "Ticker").collect()] == [("AA", "1.5"), ("BB", None)]


def table(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).collect())


def test_publication_cut_short(spark, tmp_path):
    from pyspark.sql import functions as F

    from marlstone.operators import relational as rel

    path = str(tmp_path / "t")
    rel.upsert_parquet(spark.createDataFrame([(1,), (2,)], "k int"), path, ["k"], [F.col("k")])
    (tmp_path / "t").rename(tmp_path / "t.superseded")  # stopped between the two renames
    rel.upsert_parquet(spark.createDataFrame([(3,)], "k int"), path, ["k"], [F.col("k")])
    assert table(spark, path) == [1, 2, 3] and not (tmp_path / "t.superseded").exists()
    spark.createDataFrame([(9,)], "k int").write.parquet(path + ".superseded")  # stopped before the old one was removed
    rel.upsert_parquet(spark.createDataFrame([(4,)], "k int"), path, ["k"], [F.col("k")])
    assert table(spark, path) == [1, 2, 3, 4] and not (tmp_path / "t.superseded").exists()
    with pytest.raises(Exception):
        storage.rename_into_place(spark, str(tmp_path / "nothing"), path)
    assert table(spark, path) == [1, 2, 3, 4]


def test_dedup_rewrite(spark, tmp_path):
    from pyspark.sql import functions as F

    from marlstone.operators import relational as rel

    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 1), (None, 3)], "k int, v int").write.parquet(path)
    assert rel.dedup_rewrite(spark, path, ["k"], [F.desc("v")]) == (5, 3)
    assert rel.dedup_rewrite(spark, path, ["k"], [F.desc("v")]) == (3, 3)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, 2), (2, 1), (None, 3)}


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    storage.upload(spark, str(tmp_path / "a.txt"), str(tmp_path / "b.txt"))
    storage.download(spark, str(tmp_path / "b.txt"), str(tmp_path / "c.txt"))
    assert (tmp_path / "c.txt").read_text() == "x" and storage.exists(spark, str(tmp_path / "b.txt"))
    storage.delete(spark, str(tmp_path / "b.txt"))
    assert not storage.exists(spark, str(tmp_path / "b.txt"))


def test_group_coverage(spark, day):
    df = spark.createDataFrame([(day("2024-01-01"), "a"), (day("2024-02-01"), "a"), (day("2024-02-01"), " None "), (None, "b")], "at date, sector string")
    r = checks.group_coverage("t", df, "at", "sector", 60.0)
    assert not r.passed and r.details == {"snapshot": "2024-02-01", "percent": 50.0}
    assert checks.group_coverage("t", df, "at", "sector", 50.0).passed and not checks.group_coverage("t", df.limit(0), "at", "sector", 1.0).passed


def test_suites(spark, day):
    t = {
        "dim_company": spark.createDataFrame([("A", "n", "s", "i", "Active", day("2024-01-01"))], "symbol string, name string, sector string, industry string, listing_status string, snapshot_date date"),
        "fact_daily_prices": spark.createDataFrame([("A", day("2024-01-05"), 1.0, 1.0, 1)], "symbol string, trade_date date, close double, adjusted_close double, volume long"),
        "fact_prices_enriched": spark.createDataFrame([("A",)], "symbol string"),
        "fact_valuation_daily": spark.createDataFrame([("A", day("2024-01-05"), 1.0)], "symbol string, trade_date date, pe_ttm double"),
        "fact_institutional_holdings": spark.createDataFrame([("A", "h", 1.0, 120.0)], "symbol string, holder_name string, shares_held double, pct_of_portfolio double"),
    }
    assert checks.run("daily", checks.suite("daily", t, "2024-01-08"))[0] == 0
    code, report = checks.run("full", checks.suite("full", t, "2024-01-08"))
    assert code == 1 and report["failed"] == ["fact_institutional_holdings.pct_of_portfolio.bounds"]
