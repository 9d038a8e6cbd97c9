"""Rolling point-in-time aggregates as a sweep, with hot keys cut into time chunks.

A range frame over a long window re-reads the frame for every row. Here every row instead enters the
window at its time ``t`` and leaves it after ``t + window``; a running sum of entries minus exits, read at
the entry, is the rolling value. That is one shuffle and one sort whatever the window length.

A key that holds a large share of all rows must not land in one task. Keys above ``chunk_rows`` are found
by a counting pass and cut into time chunks as wide as their density allows, busy chunks again into narrower
ones; each chunk is swept on its own and starts from the total of the chunks before it (pre-aggregated, one
short row per chunk). All other keys stay whole and pay nothing.

Tie rules for rows of one key at the same time:
  sequential  a row sees itself and the ties ordered before it
  peers       a row sees all ties
  strict      a row sees strictly earlier rows, plus itself
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.scalars import columns_of, from_micro, to_micro
from riskloom.session import settle

# At most this many keys, the largest ones, are cut; a key beyond them holds less than total / MAX_HOT_KEYS
# rows. The table of hot keys is broadcast on the strength of this bound.
MAX_HOT_KEYS = 100_000
_CHUNK, _WIDTH, _POS, _ROW = "_chunk", "_width", "_pos", "_row"
_FIRST = -(2**62)  # ahead of every position


@dataclass(frozen=True)
class Measure:
    """One rolling value: what a row adds on entry and takes back when it leaves the window."""

    name: str
    window: int
    entry: Column
    exit: Column | None = None  # default: what entered
    own: Column | None = None  # what the row itself adds under the strict rule; default: what entered


@dataclass(frozen=True)
class HotKeys:
    """Keys with too many rows for one task, each with the chunk width (seconds) that cuts it."""

    table: DataFrame | None  # None when no key is hot

    def __bool__(self) -> bool:
        return self.table is not None


def _largest(groups: DataFrame, time: str, chunk_rows: int) -> DataFrame:
    """Keys above ``chunk_rows`` rows, largest first, and how wide a chunk of that many rows is."""
    counts = groups.agg(F.count(F.lit(1)).alias("_n"), F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    span = F.col("_hi") - F.col("_lo") + 1
    width = F.greatest(F.lit(1), F.ceil(span / F.col("_n") * F.lit(int(chunk_rows)))).cast("bigint")
    hot = counts.where(F.col("_n") > F.lit(int(chunk_rows))).orderBy(F.desc("_n")).limit(MAX_HOT_KEYS)
    return hot.withColumn(_WIDTH, width).drop("_n", "_lo", "_hi")


def hot_keys(df: DataFrame, keys: Sequence[str], time: str, chunk_rows: int) -> HotKeys:
    """Find the hot keys with one counting job over the key and time columns.

    The answer decides the plan: without hot keys a sweep is a single shuffle. It holds at most
    MAX_HOT_KEYS short rows, so it may pass through the driver and be broadcast.
    """
    hot = _largest(df.groupBy(*keys), time, chunk_rows)
    rows = hot.collect()
    return HotKeys(df.sparkSession.createDataFrame(rows, hot.schema) if rows else None)


def hot_text_keys(df: DataFrame, keys: Sequence[str], time: str, chunk_rows: int) -> dict[str, HotKeys]:
    """Hot values of several text keys from one pass over the rows."""
    pairs = F.array(*[F.struct(F.lit(k).alias("_name"), F.col(k).alias("_key")) for k in keys])
    rows = _largest(df.select(time, F.inline(pairs)).groupBy("_name", "_key"), time, chunk_rows).collect()
    found = {}
    for k in keys:
        mine = [(r["_key"], r[_WIDTH]) for r in rows if r["_name"] == k]
        table = df.sparkSession.createDataFrame(mine, f"`{k}` string, {_WIDTH} bigint") if mine else None
        found[k] = HotKeys(table)
    return found


def _chunked(df: DataFrame, hot: HotKeys, keys: Sequence[str], at: Column, limit: int) -> DataFrame:
    """Add the chunk: zero for ordinary keys, the time it begins at for hot ones.

    Chunks as wide as a key's mean density allows are cut again where they hold more than ``limit`` rows, until
    none does; only rows of one second are never parted. A pass cuts the MAX_HOT_KEYS fullest chunks, so what is
    broadcast stays bounded, and the next pass finds the others.
    """
    width, chunk = F.col(_WIDTH), F.col(_CHUNK)
    begin = (F.floor(at / width) * width).cast("bigint")
    joined = df.alias("_f").join(F.broadcast(hot.table.alias("_h")), _same("_f", "_h", keys), "left")
    cut = joined.select("_f.*", _WIDTH).withColumn(_CHUNK, F.coalesce(begin, F.lit(0).cast("bigint")))
    while True:
        counts = cut.where(width.isNotNull()).groupBy(*keys, _CHUNK).agg(
            F.count(F.lit(1)).alias("_n"), F.min(at).alias("_lo"), F.max(at).alias("_hi")
        )
        full = counts.where((F.col("_n") > limit) & (F.col("_lo") < F.col("_hi"))).orderBy(F.desc("_n")).limit(MAX_HOT_KEYS)
        part = F.ceil((F.col("_hi") - F.col("_lo") + 1) / F.col("_n") * F.lit(limit / 2))
        full = full.select(*keys, _CHUNK, F.greatest(F.lit(1), part).cast("bigint").alias("_part"))
        found = full.collect()
        if not found:
            return cut
        table = F.broadcast(df.sparkSession.createDataFrame(found, full.schema).alias("_h"))
        part = F.col("_part")
        cut = cut.alias("_f").join(table, _same("_f", "_h", [*keys, _CHUNK]), "left").select("_f.*", "_part").withColumns({
            _CHUNK: F.coalesce((chunk + F.floor((at - chunk) / part) * part).cast("bigint"), chunk), _WIDTH: F.coalesce(part, width),
        }).drop("_part")


def _same(left: str, right: str, keys: Sequence[str]) -> list[Column]:
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def sweep(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    measures: Sequence[Measure],
    ties: str = "sequential",
    chunk_rows: int = 1_000_000,
    hot: HotKeys | None = None,
    costly: bool = False,
) -> DataFrame:
    """Append one BIGINT column per measure to every row of ``df``.

    ``hot`` hands in hot keys already known from a cheaper frame. ``costly`` says that ``df`` is not a plain
    scan: with hot keys its events are then written once instead of computed for the totals and again.
    """
    if ties not in ("sequential", "peers", "strict"):
        raise ValueError(f"Unknown tie rule: {ties}")
    t = F.col(time).cast("bigint")
    names = [f"_d{i}" for i in range(len(measures))]
    zero = F.lit(0).cast("bigint")
    entries = [F.coalesce(m.entry.cast("bigint"), zero) for m in measures]
    exits = [F.coalesce((m.exit if m.exit is not None else m.entry).cast("bigint"), zero) for m in measures]
    payload = F.struct(*columns_of(df))
    ties_of = [F.col(c) for c in order]

    def event(position: Column, row: Column, tie: Sequence[Column], deltas: Sequence[Column]) -> Column:
        parts = [position.alias(_POS), row.alias(_ROW)]
        parts += [c.alias(f"_o{i}") for i, c in enumerate(tie)]
        parts += [c.alias(n) for n, c in zip(names, deltas)]
        return F.struct(*parts)

    # Entries sit on even positions, exits on the odd position after the last time they still count.
    rows = [event(t * 2, payload, ties_of, entries)]
    empty = F.lit(None).cast(df.schema)
    no_tie = [F.lit(None).cast(df.schema[c].dataType) for c in order]
    for window in sorted({m.window for m in measures}):
        leaving = [-x if m.window == window else zero for m, x in zip(measures, exits)]
        rows.append(event((t + window) * 2 + 1, empty, no_tie, leaving))

    hot = hot_keys(df, keys, time, chunk_rows) if hot is None else hot
    flow = df.select(*keys, F.inline(F.array(*rows)))
    # An exit that changes nothing need not travel.
    flow = flow.where(F.col(_ROW).isNotNull() | _any_nonzero(names))
    group = list(keys)
    if hot:
        group = [*keys, _CHUNK]
        if costly:
            flow = settle(flow, "sweep")
        flow = _chunked(flow, hot, keys, F.floor(F.col(_POS) / 2), 2 * chunk_rows * len(rows))
        before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        totals = flow.where(F.col(_WIDTH).isNotNull()).groupBy(*group).agg(*[F.sum(n).alias(n) for n in names])
        # What the chunks before left behind opens each chunk, as one more event ahead of all others.
        opening = totals.select(
            *group, F.lit(_FIRST).alias(_POS), *[F.coalesce(F.sum(n).over(before), zero).alias(n) for n in names]
        )
        flow = flow.drop(_WIDTH).unionByName(opening, allowMissingColumns=True)

    base = Window.partitionBy(*group)
    if ties == "sequential":
        frame = base.orderBy(_POS, *[f"_o{i}" for i in range(len(order))]).rowsBetween(Window.unboundedPreceding, 0)
    elif ties == "peers":
        frame = base.orderBy(_POS).rangeBetween(Window.unboundedPreceding, 0)
    else:
        frame = base.orderBy(_POS).rangeBetween(Window.unboundedPreceding, -1)
    running = flow.select(
        _ROW, *names, *[F.coalesce(F.sum(n).over(frame), zero).alias(f"{n}_run") for n in names]
    )
    out = running.where(F.col(_ROW).isNotNull()).select(f"{_ROW}.*", *names, *[f"{n}_run" for n in names])
    values = []
    for m, n in zip(measures, names):
        value = F.col(f"{n}_run")
        if ties == "strict":
            value = value + (F.col(n) if m.own is None else F.coalesce(m.own.cast("bigint"), zero))
        values.append(value.alias(m.name))
    return out.select(*columns_of(df), *values)


def _any_nonzero(names: Sequence[str]) -> Column:
    changed = F.lit(False)
    for n in names:
        changed = changed | (F.col(n) != 0)
    return changed


def neighbour_times(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], chunk_rows: int = 1_000_000,
    hot: HotKeys | None = None, costly: bool = False, strict: bool = True,
) -> DataFrame:
    """Append the times of the previous row, the next row and, if ``strict``, the last strictly earlier row
    of the key. All three read one sort."""
    hot = hot_keys(df, keys, time, chunk_rows) if hot is None else hot
    group, rows = list(keys), df
    if hot:
        group = [*keys, _CHUNK]
        rows = settle(df, "neighbours") if costly else df
        rows = _chunked(rows.withColumn(_ROW, F.lit(True)), hot, keys, F.col(time).cast("bigint"), 2 * chunk_rows)
        chunks = Window.partitionBy(*keys).orderBy(_CHUNK)
        edges = rows.where(F.col(_WIDTH).isNotNull()).groupBy(*group).agg(
            F.min(time).alias("_first"), F.max(time).alias("_last")
        )
        # The last time of the chunk before and the first of the chunk after stand in as rows at its ends.
        ends = F.array(F.lag("_last").over(chunks), F.lead("_first").over(chunks))
        edges = edges.select(*group, ends.alias("_ends")).select(*group, F.explode("_ends").alias(time))
        edges = edges.where(F.col(time).isNotNull())
        rows = rows.drop(_WIDTH).unionByName(edges, allowMissingColumns=True)
    near = Window.partitionBy(*group).orderBy(time, *order)
    earlier = Window.partitionBy(*group).orderBy(time).rangeBetween(Window.unboundedPreceding, -1)
    last = F.max(time).over(earlier) if strict else F.lit(None)
    found = rows.select(
        "*",
        F.lag(time).over(near).cast("bigint").alias("_prev"),
        F.lead(time).over(near).cast("bigint").alias("_next"),
        last.cast("bigint").alias("_earlier"),
    )
    return found.where(F.col(_ROW)).drop(_ROW, _CHUNK) if hot else found


def distinct_measure(name: str, window: int, time: str) -> Measure:
    """Rolling distinct values, given ``neighbour_times`` of (key, value).

    A value counts from the first row of a run to ``window`` after its last, a run being rows of that value
    never more than ``window`` apart.
    """
    t = F.col(time).cast("bigint")
    starts = F.col("_prev").isNull() | (F.col("_prev") < t - window)
    ends = F.col("_next").isNull() | (F.col("_next") > t + window)
    unseen = F.col("_earlier").isNull() | (F.col("_earlier") < t - window)
    return Measure(name, window, starts.cast("bigint"), ends.cast("bigint"), unseen.cast("bigint"))


def rolling_user_stats(
    df: DataFrame, user: str, amount: str, time: str, order: Sequence[str], window: int,
    ties: str = "sequential", chunk_rows: int = 1_000_000,
    count_name: str = "tx_count", sum_name: str = "total_amount", mean_name: str = "avg_amount",
    extra: Sequence[Measure] = (), hot: HotKeys | None = None,
) -> DataFrame:
    """Count, sum and mean of non-null amounts in the trailing window; mean is 0 where nothing counts."""
    known = F.col(amount).isNotNull().cast("bigint")
    measures = [Measure(count_name, window, known), Measure("_total", window, to_micro(F.col(amount))), *extra]
    out = sweep(df, [user], time, order, measures, ties, chunk_rows, hot)
    total = from_micro(F.col("_total"))
    mean = F.when(F.col(count_name) > 0, total / F.col(count_name)).otherwise(F.lit(0.0))
    return out.withColumns({sum_name: total, mean_name: mean}).drop("_total")


def rolling_count(
    df: DataFrame, key: str, time: str, order: Sequence[str], window: int, name: str,
    ties: str = "sequential", chunk_rows: int = 1_000_000,
) -> DataFrame:
    return sweep(df, [key], time, order, [Measure(name, window, F.lit(1))], ties, chunk_rows)


def rolling_unique(
    df: DataFrame, key: str, value: str, time: str, order: Sequence[str], window: int, name: str,
    ties: str = "sequential", chunk_rows: int = 1_000_000, extra: Sequence[Measure] = (),
    base: DataFrame | None = None, hot: HotKeys | None = None,
) -> DataFrame:
    """Exact distinct values of ``value`` per key in the trailing window, with linear memory.

    ``base`` is a cheap frame with the same rows, used to find hot keys when ``df`` is itself derived;
    ``hot`` hands in the hot keys when they are known.
    """
    source = df if base is None else base
    hot = hot_keys(source, [key], time, chunk_rows) if hot is None else hot
    # A pair can only be hot where its key is.
    hot_pairs = hot_keys(source, [key, value], time, chunk_rows) if hot else HotKeys(None)
    if not hot:
        # Keys this small fit a task: one shuffle by key serves the pair windows and the sweep.
        df = df.repartition(key)
    marked = neighbour_times(df, [key, value], time, order, chunk_rows, hot_pairs, base is not None, ties == "strict")
    measures = [distinct_measure(name, window, time), *extra]
    return sweep(marked, [key], time, order, measures, ties, chunk_rows, hot, True).drop("_prev", "_next", "_earlier")


def history_lookup(
    probes: DataFrame, history: DataFrame, key: str, time: str, probe_id: str, amount: str,
    long_window: int, short_window: int, chunk_rows: int = 1_000_000,
) -> DataFrame:
    """Point-in-time lookup: for each probe the strictly earlier history of its key, plus the probe itself.

    Probes and history run through one tagged sweep: linear in both, no range join.
    """
    columns = [key, time, amount]
    past = history.select(*columns, F.lit(None).cast(probes.schema[probe_id].dataType).alias(probe_id), F.lit(1).alias("_w"))
    asked = probes.select(*columns, probe_id, F.lit(0).alias("_w"))
    weight = F.col("_w")
    known = weight * F.col(amount).isNotNull().cast("int")
    micro = F.coalesce(to_micro(F.col(amount)), F.lit(0))
    out = sweep(
        past.unionByName(asked), [key], time, [],
        [
            Measure("_count", long_window, known),
            Measure("_total", long_window, weight * micro),
            Measure("_recent", short_window, weight),
        ],
        "strict", chunk_rows,
    ).where(weight == 0)
    count = F.col("_count") + F.col(amount).isNotNull().cast("bigint")
    total = from_micro(F.col("_total") + micro)
    return out.select(
        probe_id, key, time, amount,
        count.alias("user_tx_count_30d"),
        total.alias("user_total_amount_30d"),
        F.when(count > 0, total / count).otherwise(F.lit(0.0)).alias("user_avg_amount_30d"),
        (F.col("_recent") + 1).alias("velocity_1hr"),
    )
