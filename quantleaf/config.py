"""Engine parameters.

Every operator that depends on "today" takes ``as_of`` explicitly; nothing reads
the clock. Where the two reference implementations disagree, the chosen default
is documented in README.md and the other variant is reachable by a flag here.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class EngineConfig:
    # Reporting date. None → max(trade_date) of the cleaned prices.
    as_of: dt.date | None = None
    home_currency: str = "INR"
    # Currencies quoted in a minor unit and the divisor to the major unit.
    # Case-sensitive: 'GBp' (pence) is divided, 'GBP' is not.
    minor_units: dict[str, int] = field(default_factory=lambda: {"GBp": 100})
    # Alternative rule keyed by ticker (the dbt models list the pence tickers by name);
    # when set it replaces the currency rule.
    minor_units_by_ticker: dict[str, int] | None = None
    # Trailing window for 52-week range and volatility: trade_date > as_of - window_days.
    window_days: int = 365
    # Year-ago cut: latest trade_date <= add_months(as_of, -lookback_months).
    lookback_months: int = 12
    # Missing FX rate on a price date: 'exact_or_one' (rate 1, as the reference),
    # 'asof' (last known rate on or before the date), 'null'.
    fx_policy: str = "exact_or_one"
    # Year-ago FX when the pair has no rate that old: False → NULL (rate 1 only for
    # home-currency rows); True → rate 1 for every missing start rate (dbt behaviour).
    fx_start_default_one: bool = False
    # Take the start FX as of the price's own start date when the earliest-price
    # fallback is used (instead of the year-ago FX).
    align_fx: bool = False
    risk_free: float = 0.0
    # Minimum common observations for a correlation pair (HAVING COUNT(*) > min_obs).
    min_obs: int = 0
    # Label for a NULL correlation coefficient. None keeps it NULL; 'Negative'
    # reproduces the reference's CASE falling through to ELSE.
    null_relationship: str | None = None
    # Time-bucket width for per-key ordered windows (lag, forward fill). Windows are
    # partitioned by (key, bucket) so a key with a large share of the rows is still
    # spread across many tasks; bucket boundaries are stitched with one carry row.
    bucket_days: int = 90
    # As-of joins: left rows of one (key, bucket) are dealt to this many tasks; the right rows, one per
    # pair and day, are repeated for each.
    asof_salts: int = 4
    # Ticker blocks for the correlation Gram computation (0 = about 512 tickers per
    # block, from a distinct count) and the date-chunk width in days.
    corr_blocks: int = 0
    corr_chunk_days: int = 366
    # Which reference implementation the gold layer reproduces where the two differ:
    # 'dbt' (default, the newer models) or 'sp' (the stored procedures: one-year window,
    # inner joins, unguarded Sharpe on the raw stdev, integer EPS, home test by
    # currency code, matched FX pair, best category of the best stock, raw-value buckets).
    reference_variant: str = "dbt"

    def __post_init__(self) -> None:
        if self.fx_policy not in ("exact_or_one", "asof", "null"):
            raise ValueError(f"fx_policy must be 'exact_or_one', 'asof' or 'null', not {self.fx_policy!r}")
        if self.reference_variant not in ("dbt", "sp"):
            raise ValueError(f"reference_variant must be 'dbt' or 'sp', not {self.reference_variant!r}")
        if min(self.window_days, self.lookback_months, self.bucket_days, self.asof_salts) <= 0:
            raise ValueError("window_days, lookback_months, bucket_days and asof_salts must be positive")
        if any(d <= 0 for d in {**self.minor_units, **(self.minor_units_by_ticker or {})}.values()):
            raise ValueError("minor-unit divisors must be positive")

    @property
    def sp(self) -> bool:
        return self.reference_variant == "sp"

    def with_as_of(self, as_of: dt.date) -> "EngineConfig":
        from dataclasses import replace
        return replace(self, as_of=as_of)
