"""Column expressions shared by batch and stream plans. Built-ins only, no Python workers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.config import DAY, HOUR

# Amounts are summed as whole micro-units (BIGINT): exact, order-free and cheap to add or subtract.
MICRO = 1_000_000


def columns_of(df: DataFrame, *without: str) -> list[Column]:
    """The columns of a frame, quoted: one-hot names such as ``P_emaildomain_gmail.com`` hold dots."""
    return [F.col(f"`{c}`") for c in df.columns if c not in without]


def to_micro(amount: Column) -> Column:
    """Null stays null, and so does NaN: no whole number stands for it."""
    return F.round(F.when(~F.isnan(amount), amount) * F.lit(float(MICRO))).cast("bigint")


def from_micro(total: Column) -> Column:
    return total.cast("double") / F.lit(float(MICRO))


def temporal_parts(dt: Column) -> dict[str, Column]:
    """Day, hour, weekday, weekend flag and 30-day month of relative seconds; floors on negatives."""
    day = F.floor(dt / F.lit(DAY))
    weekday = F.pmod(day, F.lit(7))
    return {
        "day_number": day.cast("int"),
        "hour": F.floor(F.pmod(dt, F.lit(DAY)) / F.lit(HOUR)).cast("int"),
        "day_of_week": weekday.cast("int"),
        "is_weekend": weekday.isin(5, 6).cast("int"),
        "month": F.floor(day / F.lit(30)).cast("int"),
    }


def text_of(column: str, data_type: T.DataType) -> Column:
    """Plain decimal text of a value; doubles keep one decimal digit and never turn to 1.0E7."""
    value = F.col(column)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        whole = (F.abs(value) >= 1e7) & (value == F.floor(value))
        return F.when(whole, F.concat(value.cast("decimal(38,0)").cast("string"), F.lit(".0"))).otherwise(
            value.cast("string")
        )
    return value.cast("string")


def composite_key(df: DataFrame, columns: Iterable[str]) -> Column:
    """Null parts become empty text; one function serves training, scoring and streams."""
    parts = [F.coalesce(text_of(c, df.schema[c].dataType), F.lit("")) for c in columns]
    return F.concat_ws("_", *parts)


def hash32(seed: int, salt: str, *ids: Column) -> Column:
    """32 hash bits of the row identity as BIGINT; the same on every run, executor and engine."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(salt), *[i.cast("string") for i in ids])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash60(seed: int, salt: str, *ids: Column) -> Column:
    """60 hash bits: enough to draw from any number of rows by a remainder."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(salt), *[i.cast("string") for i in ids])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def uniform(seed: int, salt: str, *ids: Column) -> Column:
    """Repeatable uniform number in [0, 1)."""
    return hash32(seed, salt, *ids) / F.lit(4294967296.0)


def normal(seed: int, salt: str, *ids: Column) -> Column:
    """Repeatable standard normal number (Box-Muller)."""
    u1 = (hash32(seed, salt + "-r", *ids) + 1) / F.lit(4294967296.0)
    u2 = uniform(seed, salt + "-a", *ids)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)


def hour_bucket(hour: Column) -> Column:
    """(-1,6] night, (6,12] morning, (12,18] afternoon, (18,24] evening; outside is 'nan' text."""
    return (
        F.when((hour > -1) & (hour <= 6), "night")
        .when((hour > 6) & (hour <= 12), "morning")
        .when((hour > 12) & (hour <= 18), "afternoon")
        .when((hour > 18) & (hour <= 24), "evening")
        .otherwise("nan")
    )


def decision(p: Column, fraud: float = 0.5, suspicious: float = 0.3) -> Column:
    return F.when(p >= fraud, "FRAUD").when(p >= suspicious, "SUSPICIOUS").otherwise("CLEAN")


def confidence(p: Column, fraud: float = 0.5, suspicious: float = 0.3) -> Column:
    """HIGH at 0.70 and above for fraud, below 0.15 for clean, MEDIUM in between."""
    return (
        F.when(p >= fraud, F.when(p >= 0.70, "HIGH").otherwise("MEDIUM"))
        .when(p >= suspicious, "MEDIUM")
        .otherwise(F.when(p < 0.15, "HIGH").otherwise("MEDIUM"))
    )


def filled(column: Column, default: str) -> Column:
    """Null and empty text both take the default."""
    return F.coalesce(F.nullif(column, F.lit("")), F.lit(default))


def scoring_card_label(card_type: Column, network: Column) -> Column:
    return F.format_string("%s (%s)", filled(card_type, "debit"), filled(network, "visa"))


def log_card_label(card_type: Column, network: Column) -> Column:
    kind = filled(card_type, "debit")
    known = network.isNotNull() & (network != "") & (network != "unknown")
    return F.when(known, F.format_string("%s (%s)", kind, network)).otherwise(kind)


def rate_severity(rate: Column) -> Column:
    return F.when(rate >= 0.06, "red").when(rate >= 0.04, "yellow").otherwise("green")


def explanation_kept(contributions: Column, floor: float = 1e-4) -> Column:
    return F.map_filter(contributions, lambda _, v: F.abs(v) > floor)


def matches_search(term: str, *columns: Column) -> Column:
    """Case-insensitive substring search, any column."""
    needle = F.lit(term.lower())
    hit = F.lit(False)
    for column in columns:
        hit = hit | F.coalesce(F.contains(F.lower(column), needle), F.lit(False))
    return hit
