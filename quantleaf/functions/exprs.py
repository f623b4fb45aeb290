"""Column-expression helpers (F1–F18). All return JVM-side Column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: ColumnOrName) -> Column:
    return col(c).cast("double")


def pct_change(new: ColumnOrName, old: ColumnOrName) -> Column:
    """(new - old) / old * 100 in double; NULL when old is NULL or 0."""
    n, o = dbl(new), dbl(old)
    return (n - o) / F.nullif(o, F.lit(0.0)) * 100


def unscaled(c: ColumnOrName, scale: int) -> Column:
    """A decimal with at most ``scale`` fraction digits as an integer: c · 10^scale."""
    return (col(c) * F.lit(Decimal(10) ** scale)).cast("decimal(38,0)")


def exact_quotient(num: Column, den: Column, precision: int, scale: int) -> Column:
    """num / den of two integers (DECIMAL(38,0)), already scaled by 10^scale, as DECIMAL(precision, scale): rounded half away
    from zero, as T-SQL's casts do, with no step in double; NULL for a zero or NULL divisor."""
    a, b = F.abs(num), F.abs(F.nullif(den, F.lit(0).cast("decimal(38,0)")))
    size = F.call_function("div", 2 * a + b, 2 * b)      # DECIMAL div DECIMAL is an integer
    signed = F.when((num < 0) != (den < 0), -size).otherwise(size).cast("decimal(19,0)")
    return (signed * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal({precision},{scale})")


def exact_pct(new: ColumnOrName, old: ColumnOrName, digits: int, precision: int = 18, scale: int = 4) -> Column:
    """(new - old) / old * 100 of decimals with at most ``digits`` fraction digits, exact."""
    n, o = unscaled(new, digits), unscaled(old, digits)
    return exact_quotient((n - o) * F.lit(Decimal(10) ** (2 + scale)), o, precision, scale)


def exact_compound(local_pct: ColumnOrName, end_rate: ColumnOrName, start_rate: ColumnOrName, less_local: bool = False) -> Column:
    """((1 + r/100) * end/start - 1) * 100, less r itself with ``less_local``, of DECIMAL(18,4) returns and DECIMAL(18,6) rates, exact."""
    r, e, s = unscaled(local_pct, 4), unscaled(end_rate, 6), unscaled(start_rate, 6)
    num = (r + 1_000_000) * e - s * 1_000_000
    return exact_quotient(num - r * s if less_local else num, s, 18, 4)


def compound_pct(local_pct: ColumnOrName, end_rate: ColumnOrName, start_rate: ColumnOrName) -> Column:
    """Home-currency return: ((1 + r/100) * end/start - 1) * 100."""
    ratio = dbl(end_rate) / F.nullif(dbl(start_rate), F.lit(0.0))
    return ((1 + dbl(local_pct) / 100.0) * ratio - 1) * 100


def to_dec(c: ColumnOrName, precision: int = 18, scale: int = 4) -> Column:
    return col(c).cast(f"decimal({precision},{scale})")


def try_dec(c: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """Decimal cast that yields NULL instead of failing on overflow."""
    return col(c).try_cast(f"decimal({precision},{scale})")


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b in double, NULL for a zero or NULL divisor."""
    return dbl(a) / F.nullif(dbl(b), F.lit(0.0))


def tsql_weekday(d: ColumnOrName) -> Column:
    """Weekday with Sunday = 1 … Saturday = 7."""
    return F.dayofweek(col(d))


def tsql_week(d: ColumnOrName) -> Column:
    """Week of year where week 1 holds 1 January and weeks start on Sunday."""
    d = col(d)
    return (F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 2) / 7) + 1).cast("int")


def quarter_end(d: ColumnOrName) -> Column:
    """Last day of the date's quarter."""
    return F.last_day(F.add_months(F.trunc(col(d), "quarter"), 2))


def years_back(d: ColumnOrName, years: int = 1) -> Column:
    """DATEADD(YEAR, -n, d): 29 Feb maps to 28 Feb (F2)."""
    return F.add_months(col(d), -12 * years)


def in_trailing_window(d: ColumnOrName, as_of, days: int) -> Column:
    """trade_date in the trailing ``days`` window ending at ``as_of`` (exclusive start, C1)."""
    return (col(d) > F.date_sub(F.lit(as_of), days)) & (col(d) <= F.lit(as_of))


def correlation_label(coef: ColumnOrName, null_label: str | None = None) -> Column:
    """Ordered buckets of a (rounded) correlation coefficient (P5)."""
    c = col(coef)
    # --- fixed values: relationship thresholds and labels ---
    lab = (F.when(c >= 0.7, "Strong Positive")
           .when(c >= 0.3, "Weak Positive")
           .when(c >= -0.3, "Uncorrelated"))
    # --- end of fixed values ---
    if null_label is None:
        return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(lab.otherwise("Negative"))
    return lab.otherwise("Negative") if null_label == "Negative" else \
        F.when(c.isNull(), F.lit(null_label)).otherwise(lab.otherwise("Negative"))
