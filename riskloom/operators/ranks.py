"""Order statistics over whole tables without a one-partition sort.

Values are first counted (pre-aggregated), then cut into value buckets; each bucket is summed up on its
own and starts from the total of the buckets below it. Bucket limits come from an approximate quantile
sketch and only balance the work: results are exact whatever they are. The counts are written once, since
limits, bucket totals and ranks all read them; the rows themselves are read a single time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.scalars import columns_of, hash32
from riskloom.session import settle

_B = "_bucket"


# Broadcast tables hold one short row per (group, bucket); above this many rows they are joined by shuffle.
MAX_SMALL_ROWS = 1_000_000


@dataclass(frozen=True)
class Splits:
    """Bucket limits per series, and about how many groups there are."""

    limits: dict
    groups: int

    @property
    def small_rows(self) -> int:
        """Rows of a (group, bucket) table, with room for the error of the estimate."""
        return int(1.2 * self.groups) * (1 + max((len(x) for x in self.limits.values()), default=0))


def value_splits(
    df: DataFrame, value: str, series: str | None = None, buckets: int | None = None, group: Sequence[str] = ()
) -> Splits:
    """Bucket limits per series: a few numbers per series, so they may pass through the driver.

    The same job estimates the number of groups, the size check for what is broadcast later.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(2, min(n, 2000))
    points = F.array(*[F.lit(i / n) for i in range(1, n)])
    sketch = [F.percentile_approx(value, points, 1000).alias("s")]
    sketch += [F.approx_count_distinct(F.struct(*group)).alias("g")] if group else [F.lit(1).alias("g")]
    rows = (df.groupBy(series) if series else df.groupBy()).agg(*sketch).collect()
    limits = {(r[series] if series else None): sorted(set(r["s"] or [])) for r in rows}
    return Splits(limits, sum(r["g"] for r in rows))


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= MAX_SMALL_ROWS else table


def _bucket(value: str, series: str | None, splits: Splits) -> Column:
    def index(limits: Sequence) -> Column:
        if not limits:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(x) for x in limits]), lambda x: x < F.col(value)))

    if series is None:
        return index(splits.limits.get(None, []))
    out = F.lit(0)
    for name, limits in splits.limits.items():
        if name is not None:
            out = F.when(F.col(series) == F.lit(name), index(limits)).otherwise(out)
    return out


def cumulative(
    counts: DataFrame, value: str, measures: Sequence[str], splits: Splits,
    series: str | None = None, group: Sequence[str] = (),
) -> DataFrame:
    """Add ``<measure>_below``: the sum of the measure over smaller values of the same group.

    ``counts`` has one row per (group, value). ``series`` names the column the splits are keyed by; it is
    part of the group.
    """
    keys = list(group) + ([series] if series and series not in group else [])
    rows = counts.withColumn(_B, _bucket(value, series, splits))
    per_bucket = rows.groupBy(*keys, _B).agg(*[F.sum(m).alias(m) for m in measures])
    before = Window.partitionBy(*keys, F.lit(0)).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*keys, _B, *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}_off") for m in measures])
    inside = Window.partitionBy(*keys, _B).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(_small(offsets, splits.small_rows), [*keys, _B], "left").select(
        *counts.columns,
        *[(F.coalesce(F.sum(m).over(inside), F.lit(0)) + F.col(f"{m}_off")).alias(f"{m}_below") for m in measures],
    )


def quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], series: str | None = None,
    group: Sequence[str] = (),
) -> DataFrame:
    """Exact interpolated quantiles of the non-null values, one row per group."""
    keys = list(group) + ([series] if series and series not in group else [])
    known = df.where(F.col(value).isNotNull()).select(*keys, value)
    counts = settle(known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")), "counts")
    splits = value_splits(counts, value, series, group=group)
    ranked = cumulative(counts, value, ["_c"], splits, series, group)
    sizes = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    if keys:
        ranked = ranked.join(_small(sizes, splits.small_rows), keys)
    else:
        ranked = ranked.withColumn("_n", sizes.scalar())
    picks = []
    for name, q in probabilities.items():
        at = F.lit(float(q)) * (F.col("_n") - 1)
        for part, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (F.col("_c_below") <= rank) & (rank < F.col("_c_below") + F.col("_c"))
            picks.append(F.max(F.when(hit, F.col(value))).alias(f"_{name}_{part}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_{name}_f"))
    found = ranked.groupBy(*keys).agg(*picks)
    out = [
        (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_f")).alias(n)
        for n in probabilities
    ]
    return found.select(*keys, *out)


def median_of(df: DataFrame, value: str) -> Column:
    """The exact median as a scalar subquery."""
    return quantiles(df, value, {"median": 0.5}).scalar()


def newest(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last n rows by the given columns (top-k per task, then merged)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def newest_edge(df: DataFrame, n: int, order: Sequence[str]) -> tuple | None:
    """Order columns of the n-th newest row: one top-k job, one row to the driver."""
    row = newest(df.select(*order), n, *order).agg(F.min(F.struct(*order)).alias("edge")).first()
    return None if row["edge"] is None else tuple(row["edge"])


def at_or_after(order: Sequence[str], edge: tuple) -> Column:
    """Whether a row stands at or after the edge, compared column by column."""
    out = F.lit(True)
    for column, value in reversed(list(zip(order, edge))):
        out = (F.col(column) > F.lit(value)) | ((F.col(column) == F.lit(value)) & out)
    return out


def flag_newest(df: DataFrame, n: int, order: Sequence[str], flag: str) -> DataFrame:
    """Flag the newest n rows by comparing with the n-th newest row: a projection, no join and no sort."""
    edge = newest_edge(df, n, order)
    return df.withColumn(flag, F.lit(False) if edge is None else F.coalesce(at_or_after(order, edge), F.lit(False)))


def rank_cuts(df: DataFrame, row_id: str, seed: int, salt: str, ranks: dict, stratum: str | None = None) -> dict:
    """Exact cut points of a random order: for each stratum and rank the (hash, id) of the row at that rank.

    Rows are ordered by a hash of their id. Counting by ever finer hash prefixes narrows each cut to a
    sliver of the table, and only that sliver is ranked: narrow scans, a few numbers to the driver, and the
    rows themselves never move.
    """
    h = hash32(seed, salt, F.col(row_id))
    label = F.col(stratum) if stratum else F.lit(0)
    rows = df.select(label.alias("_s"), h.alias("_h"), F.col(row_id).alias("_id"))
    # stratum, rank still to go, hash range [lo, hi)
    open_cuts = [(s, rank, 0, 1 << 32, rank) for s, wanted in ranks.items() for rank in wanted if rank > 0]
    for shift in (20, 8):
        if not open_cuts:
            return {}
        within = F.lit(False)
        for s, _, lo, hi, _r in open_cuts:
            within = within | ((F.col("_s") == F.lit(s)) & (F.col("_h") >= lo) & (F.col("_h") < hi))
        counted = rows.where(within).groupBy("_s", F.shiftright("_h", shift).alias("_p")).count().collect()
        by_stratum: dict = {}
        for r in counted:
            by_stratum.setdefault(r["_s"], []).append((r["_p"], r["count"]))
        narrowed = []
        for s, rank, lo, hi, name in open_cuts:
            left = rank
            for prefix, count in sorted(by_stratum.get(s, [])):
                if not lo <= prefix << shift < hi:
                    continue
                if left <= count:
                    narrowed.append((s, left, prefix << shift, (prefix + 1) << shift, name))
                    break
                left -= count
        open_cuts = narrowed
    within, wanted = F.lit(False), F.lit(False)
    place = Window.partitionBy("_s", F.shiftright("_h", 8)).orderBy("_h", "_id")
    for s, rank, lo, hi, _ in open_cuts:
        inside = (F.col("_s") == F.lit(s)) & (F.col("_h") >= lo) & (F.col("_h") < hi)
        within = within | inside
        wanted = wanted | (inside & (F.col("_k") == rank))
    found = rows.where(within).withColumn("_k", F.row_number().over(place)).where(wanted).collect()
    place_of = {(r["_s"], r["_h"] >> 8, r["_k"]): (r["_h"], r["_id"]) for r in found}
    return {(s, name): place_of[(s, lo >> 8, rank)] for s, rank, lo, _, name in open_cuts}


def at_or_before(row_id: str, seed: int, salt: str, cut: tuple) -> Column:
    """Whether a row stands at or before a cut of the random order."""
    h = hash32(seed, salt, F.col(row_id))
    return (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & (F.col(row_id) <= F.lit(cut[1])))


def numbered(df: DataFrame, row_id: str, seed: int, salt: str, name: str = "row_index") -> DataFrame:
    """Number all rows 0..n-1 in random order, bucket by bucket, without a global sort."""
    h = hash32(seed, salt, F.col(row_id))
    rows = df.withColumn("_h", h).withColumn("_p", F.shiftright("_h", 20))
    # 4096 hash prefixes at most
    sizes = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    place = Window.partitionBy("_p").orderBy("_h", row_id)
    return rows.join(F.broadcast(offsets), "_p").select(
        *columns_of(df), (F.col("_off") + F.row_number().over(place) - 1).cast("bigint").alias(name)
    )
