"""Totals with row-time lateness and state expiry, for users who need those exact rules.

`operators.totals.window_totals` is the form to use at volume. This one differs in two ways:

* a trade is late by its own time (at or before the watermark), not by the end of its window;
* a group not updated until the watermark passes its timeout is forgotten without output. If
  trades for it still arrive after that, it starts again from nothing, and its new row replaces
  the full one in a keyed table. In the first micro-batch the watermark is still 0, so the groups
  of that batch expire in the next one unless they are updated again.

Groups are dealt out to buckets, which are the grouping key. A bucket's state is a list to which a
micro-batch appends the groups that it changed, in one entry and one call; the last entry of a group
counts. What is appended follows the changed groups alone, whether the watermark moves or stands. The
list is written anew once more than half of it is out of date, so that costs a constant share. A bucket
has one timer per micro-batch that changed any of its groups, and its time tells which groups are
forgotten.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tapeline.operators.normalize import (
    WINDOW_SECONDS,
    assign_window,
    keep_sides,
    normalize_trades,
)
from tapeline.operators.totals import CURRENCY, WATERMARK, total_columns

# The functions below run on executors, which need not have this package: send them whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

IDLE_MS = 5 * 60 * 1000
BUCKETS_PER_TASK = 4

KEY = ["market", "fromcoin", "direction", "window_seconds"]
_SECOND = ["market", "fromcoin", "direction", "seconds"]
SUMS = ["vol", "price", "quantity", "n"]
_PARTIAL = (
    "market string, fromcoin string, direction string, seconds bigint, "
    "vol double, price double, quantity double, n bigint"
)
_OUTPUT = (
    "market string, fromcoin string, direction string, window_seconds bigint, "
    "totalvol double, avgprice double, totalquantity double, counttxns bigint"
)
# What a micro-batch changed in a bucket, a place in each list per group.
_ENTRY = (
    "timeout_ms bigint, market array<string>, fromcoin array<string>, direction array<string>, "
    "window_seconds array<bigint>, vol array<double>, price array<double>, quantity array<double>, "
    "n array<bigint>"
)
_MARKS = "forgotten_ms bigint, last_ms bigint"
# A list is written anew when it has this many groups or entries more than it needs.
_SLACK_ROWS, _SLACK_ENTRIES = 256, 1_024

# Rows a task holds before it combines them: with what combining takes, some 30 MB of its Python worker.
_HELD_ROWS = 40_000


def _grouped(rows: pa.Table, by: list[str], functions: dict[str, str]) -> pa.Table:
    result = rows.group_by(by, use_threads=False).aggregate(list(functions.items()))
    names = {f"{name}_{function}": name for name, function in functions.items()}
    result = result.rename_columns([names.get(name, name) for name in result.column_names])
    return result.select(rows.column_names).cast(rows.schema)


def combine_partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum a task's trades per key and second, before they are shuffled.

    Trade times are whole seconds, so a window of 60 s sends about 60 rows per key and task, however
    many trades it holds. Rows of one second share one time and are late or not together. A task
    with more keys and seconds than it may hold passes on what it has and begins again.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= _HELD_ROWS:
            combined = _grouped(pa.Table.from_batches(held), _SECOND, dict.fromkeys(SUMS, "sum"))
            held, rows = combined.to_batches(), combined.num_rows
            if rows >= _HELD_ROWS // 2:
                yield from held
                held, rows = [], 0
    if held:
        combined = _grouped(pa.Table.from_batches(held), _SECOND, dict.fromkeys(SUMS, "sum"))
        yield from combined.to_batches()


def _group_sums(parts: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """Sums per group, a part at a time."""
    total = None
    for part in parts:
        rows = part[[*KEY, *SUMS]]
        rows = rows if total is None else pd.concat([total.reset_index(), rows])
        total = rows.groupby(KEY, dropna=False)[SUMS].sum()
    return total


def _entry(timeout_ms: int, groups: pd.DataFrame) -> tuple:
    rows = groups.reset_index()
    return (int(timeout_ms), *[rows[name].tolist() for name in [*KEY, *SUMS]])


class GroupTotals(StatefulProcessor):
    """Totals of the groups of a bucket, each kept until `idle_ms` after its last update."""

    def __init__(self, idle_ms: int, least_watermark_ms: int = 0):
        self.idle_ms = idle_ms
        self.least_watermark_ms = least_watermark_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.changes = handle.getListState("changes", _ENTRY)
        # Groups with a timeout up to the first are forgotten; the second is the last timeout set.
        self.marks = handle.getValueState("marks", _MARKS)

    def _held(self, forgotten_ms: int) -> tuple[pd.DataFrame | None, int, int]:
        """The groups that are not forgotten, as last changed; rows and entries of the list."""
        entries = list(self.changes.get())
        if not entries:
            return None, 0, 0
        frames = [
            pd.DataFrame(dict(zip([*KEY, *SUMS], columns, strict=True))).assign(timeout_ms=timeout_ms)
            for timeout_ms, *columns in entries
        ]
        rows = pd.concat(frames)
        # A group's later entries are those that count, forgotten or not: none is older than they are.
        held = rows.drop_duplicates(KEY, keep="last")
        return held[held["timeout_ms"] > forgotten_ms].set_index(KEY), len(rows), len(entries)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        for timeout_ms, some in initialState.groupby("timeout_ms"):
            self.changes.appendList([_entry(timeout_ms, some.set_index(KEY)[SUMS])])
            self.handle.registerTimer(int(timeout_ms) + 1)
        self.marks.update((-(2**62), int(initialState["timeout_ms"].max())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        watermark_ms = max(timerValues.getCurrentWatermarkInMs(), self.least_watermark_ms)
        timeout_ms = watermark_ms + self.idle_ms
        marks = self.marks.get()
        forgotten_ms = -(2**62) if marks is None else marks[0]
        new = _group_sums(rows)
        held, n_rows, n_entries = self._held(forgotten_ms)
        if held is not None:
            known = held.reindex(new.index)[SUMS].fillna(0)
            new = (new + known).astype({"n": "int64"})
        still = None if held is None else held[~held.index.isin(new.index)]
        n_live = len(new) + (0 if still is None else len(still))
        if n_rows + len(new) > 2 * n_live + _SLACK_ROWS or n_entries >= _SLACK_ENTRIES:
            older = [_entry(t, some[SUMS]) for t, some in still.groupby("timeout_ms")]
            self.changes.put([*older, _entry(timeout_ms, new)])
        else:
            self.changes.appendList([_entry(timeout_ms, new)])
        self.marks.update((forgotten_ms, timeout_ms))
        # A timer is due at its time; a group is forgotten once the watermark is past its timeout.
        self.handle.registerTimer(timeout_ms + 1)
        yield (
            new.assign(price=new["price"] / new["n"])
            .reset_index()
            .set_axis(_OUTPUT_NAMES, axis=1)
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        forgotten_ms = expiredTimerInfo.getExpiryTimeInMs() - 1
        marks = self.marks.get()
        if marks is not None and marks[1] <= forgotten_ms:
            # Nothing was changed since.
            self.changes.clear()
            self.marks.clear()
        elif marks is not None and marks[0] < forgotten_ms:
            self.marks.update((forgotten_ms, marks[1]))
        return iter([])

    def close(self) -> None:
        pass


_OUTPUT_NAMES = [column.split()[0] for column in _OUTPUT.split(", ")]


def second_sums(trades: DataFrame) -> DataFrame:
    """Trades with a side, summed per key and second: first in every task, then where their rows meet.

    A hot group sends a row per second and task to the first shuffle, which spreads its seconds over
    the tasks, and a row per second to what follows.
    """
    rows = normalize_trades(keep_sides(trades)).select(
        "market",
        "fromcoin",
        "direction",
        F.unix_seconds("timestamp").alias("seconds"),
        "vol",
        "price",
        "quantity",
        F.lit(1).cast("bigint").alias("n"),
    )
    once = rows.mapInArrow(combine_partials, _PARTIAL)
    return once.repartition(*_SECOND).mapInArrow(combine_partials, _PARTIAL)


def stateful_totals(
    trades: DataFrame,
    period_seconds: int = WINDOW_SECONDS,
    *,
    watermark: str = WATERMARK,
    idle_ms: int = IDLE_MS,
    currency: str = CURRENCY,
    buckets: int | None = None,
    max_partitions: int | None = None,
    carried: DataFrame | None = None,
) -> DataFrame:
    """The rows of `window_totals`, kept in explicit state. Streams only, update mode.

    Groups are spread over `buckets` by their whole key, window included, so a busy market is
    spread as well. There are a few per task of the shuffle unless their number is given; never
    change it, or the shuffle width it is taken from, under a checkpoint: groups would lose their
    state. To change it, stop the query and start it under a new checkpoint with the old one's groups
    as `carried` (`states.carried_groups`): their sums, their timeouts and the watermark are kept.
    """
    if buckets is None:
        width = int(trades.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = BUCKETS_PER_TASK * width
    if max_partitions is not None:
        trades = trades.coalesce(max_partitions)
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int").alias("bucket")
    windowed = assign_window(
        second_sums(trades).withColumn("timestamp", F.timestamp_seconds("seconds")), period_seconds
    ).withColumn("window_seconds", F.unix_seconds("window_start"))
    least_ms, initial = 0, None
    if carried is not None:
        latest = carried.agg(F.max("timeout_ms")).first()[0]
        least_ms = 0 if latest is None else max(latest - idle_ms, 0)
        initial = carried.select(bucket, *KEY, *SUMS, "timeout_ms").groupBy("bucket")
        # The new query's own watermark begins anew: what the old one would have dropped is dropped here.
        windowed = windowed.where(F.col("seconds") * 1000 > least_ms)
    partials = windowed.select(bucket, *KEY, "timestamp", *SUMS).withWatermark("timestamp", watermark)

    totals = partials.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=GroupTotals(idle_ms, least_ms),
        outputStructType=_OUTPUT,
        outputMode="Update",
        timeMode="EventTime",
        initialState=initial,
    )
    return total_columns(
        totals.withColumn("window_start", F.timestamp_seconds("window_seconds")).withColumn(
            "window_end", F.timestamp_seconds(F.col("window_seconds") + period_seconds)
        ),
        currency,
    )
