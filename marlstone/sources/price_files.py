"""Price records from raw JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import whole_json

SERIES = "Time Series (Daily)"
# The keys of a day's record, and the columns they become.
KEYS = {
    "1. open": "open",
    "2. high": "high",
    "3. low": "low",
    "4. close": "close",
    "5. adjusted close": "adjusted_close",
    "6. volume": "volume",
    "7. dividend amount": "dividend_amount",
    "8. split coefficient": "split_coefficient",
}


def price_records(files: DataFrame) -> DataFrame:
    """file_id, symbol, pull_date, trade_date and the eight numbers, one row per day of a series.

    A body that is null, empty, cut off, followed by anything, no object or without a series has no
    records. Values are numbers whether written as numbers or as text; what
    is neither is null. Days that aren't dates are left out.
    """
    ids = ["file_id", "symbol", "pull_date"]
    docs = files.select(*ids, "body", whole_json.wrapped(F.col("body")).alias("_doc"))
    # the test is part of the value: a filter would be pushed down and parse every body twice
    days = docs.select(*ids, F.explode(whole_json.member(F.col("_doc"), F.col("body"), f"$['{SERIES}']", "map<string,variant>")).alias("_day", "_v"))
    days = days.select(*ids, "_day", F.try_variant_get("_v", "$", "map<string,string>").alias("_r"))
    date = F.when(F.col("_day").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("_day").try_cast("date"))
    numbers = [F.try_element_at("_r", F.lit(k)).try_cast("double").alias(c) for k, c in KEYS.items()]
    return days.select(*ids, date.alias("trade_date"), *numbers).where("trade_date is not null")
