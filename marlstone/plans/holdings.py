"""The fields of the holdings table: the keys they come under, and how gaps are filled."""

from __future__ import annotations

from marlstone.operators.schema_drift import Field

# The keys under which the six fields may come.
HOLDING_FIELDS = (
    Field("holder_name", "text", ("holderName", "Holder Name", "name", "institution", "investor", "filer", "holder", "institution_name", "investor_name", "owner_name", "organization"), ("unknown",)),
    Field("shares_held", "number", ("sharesHeld", "Shares Held", "shares", "position", "qty_held", "quantity", "shares_owned"), ("value_over_price", "held_before_plus_change", "held_before", "change_alone", "none_held")),
    Field("shares_change", "number", ("sharesChange", "Shares Change", "change", "delta_shares", "change_in_shares", "shares_delta")),
    Field("pct_of_portfolio", "number", ("pctPortfolio", "percentage_of_portfolio", "percent_of_portfolio", "pctOfPortfolio", "portfolio_pct", "portfolio_percent", "weight")),
    Field("market_value", "number", ("marketValue", "Market Value", "value", "mkt_val_usd", "mkt_value", "value_usd")),
    Field("report_date", "date", ("reportDate", "Report Date", "asOf", "as_of_date", "period_of_report", "date_reported", "reported_date"), ("rest_of_file", "last_quarter_end")),
)
