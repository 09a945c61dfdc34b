"""State of the totals: what reaches it, what is written, what can be read back and carried over."""

from collections import Counter

import pytest
from helpers import trade, trades_frame, write_batches
from pyspark.sql import functions as F

from tapeline.operators.totals import window_totals
from tapeline.sources.files import read_trades
from tapeline.streaming import stateful
from tapeline.streaming.runs import STATE_SETTINGS, start
from tapeline.streaming.states import carried_groups, open_groups
from tapeline.streaming.stateful import second_sums, stateful_totals

# As a batch without trades would forget what the last one changed.
QUIET = {**STATE_SETTINGS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def run(spark, folder, make, batches, state="state", landing="in", first=0, **settings):
    """Emitted rows per batch, one file each."""
    write_batches(folder / landing, batches, first=first)
    seen = {}

    def keep(batch, batch_id):
        seen[batch_id] = {
            (r.market, f"{r.window_start:%H:%M}"): (r.counttxns, round(r.avgprice, 6))
            for r in batch.collect()
        }

    trades = read_trades(spark, str(folder / landing), maxFilesPerTrigger=1)
    writer = make(trades).writeStream.outputMode("update").foreachBatch(keep)
    query = start(spark, writer, str(folder / state), once=True, state_settings=QUIET, **settings)
    query.awaitTermination()
    return [seen[k] for k in sorted(seen)]


def open_rows(spark, folder, state="state", **options):
    found = open_groups(spark, str(folder / state), **options).collect()
    rows = {(r.market, f"{r.window_start:%H:%M}"): (r.counttxns, round(r.avgprice, 6)) for r in found}
    assert len(rows) == len(found)
    return rows


def test_a_hot_group_sends_a_row_per_second(spark):
    hot = [trade(f"10:00:{n % 60:02d}", float(n % 7), ID=str(n)) for n in range(6_000)]
    others = [trade(f"10:01:{n % 60:02d}", M=f"m{n % 50}", ID=str(n)) for n in range(3_000)]
    trades = trades_frame(spark, hot + others).repartition(16)
    rows = second_sums(trades).collect()
    per_second = Counter((r.market, r.fromcoin, r.direction, r.seconds) for r in rows)
    assert set(per_second.values()) == {1}
    assert sum(r.n for r in rows) == 9_000
    assert sum(r.price for r in rows if r.market == "Coinbase") == sum(n % 7 for n in range(6_000))
    assert len([r for r in rows if r.market == "Coinbase"]) == 60


def test_what_is_written_follows_the_groups_that_changed(spark, tmp_path):
    """Many open groups, then one changed per batch under a watermark that stands."""
    many = [trade("10:00:30", M=f"m{n:05d}") for n in range(6_000)]
    # The first batch only sets the watermark: until then it is 0, and groups expire at once.
    batches = [[trade("10:00:30")], many, *[[trade("10:00:30", float(n), M="m00007")] for n in range(12)]]
    seen = run(spark, tmp_path, lambda t: stateful_totals(t, buckets=4), batches)
    assert seen[-1] == {("m00007", "10:00"): (13, round((100 + sum(range(12))) / 13, 6))}
    logs = {}
    for file in (tmp_path / "state" / "state" / "0").rglob("*.changelog"):
        logs.setdefault(int(file.name.split(".")[0].split("_")[0]), []).append(file.stat().st_size)
    sizes = [sum(logs[version]) for version in sorted(logs)]
    assert len(sizes) >= 14
    assert max(sizes[2:14]) < sizes[1] / 20
    # All groups, each once, as last changed.
    assert len(open_rows(spark, tmp_path)) == 6_000


def test_a_list_is_written_anew_when_it_is_mostly_out_of_date(spark, tmp_path):
    groups = [f"m{n}" for n in range(40)]
    batches = [[trade("10:00:30", float(b), M=m) for m in groups] for b in range(20)]
    seen = run(spark, tmp_path, lambda t: stateful_totals(t, buckets=1), batches)
    assert seen[-1][("m3", "10:00")] == (20, 9.5)
    state = str(tmp_path / "state")
    kept = spark.read.format("statestore").option("stateVarName", "changes").load(state)
    rows = kept.select(F.sum(F.size("list_element.n"))).first()[0]
    assert 40 <= rows <= 2 * 40 + stateful._SLACK_ROWS
    assert open_rows(spark, tmp_path) == dict.fromkeys([(m, "10:00") for m in groups], (20, 9.5))


def test_open_groups_leave_when_they_expire(spark, tmp_path):
    batches = [[trade("10:00:10", 1.0)], [trade("10:05:30", 2.0)], [trade("10:05:31", 3.0, M="Kraken")],
               [trade("10:30:00", 4.0)], [trade("10:31:00", 5.0)]]
    run(spark, tmp_path, stateful_totals, batches)
    first = {("Coinbase", "10:00"): (1, 1.0)}
    assert open_rows(spark, tmp_path, batch_id=0) == first
    # The watermark, now 10:00:30, is past the timeout of what the second batch changed, 10:00:10.
    later = {("Kraken", "10:05"): (1, 3.0)}
    assert open_rows(spark, tmp_path, batch_id=2) == later
    assert open_rows(spark, tmp_path, batch_id=3) == {**later, ("Coinbase", "10:30"): (1, 4.0)}
    assert open_rows(spark, tmp_path) == {("Coinbase", "10:31"): (1, 5.0)}


def test_open_windows_of_the_native_form(spark, tmp_path):
    batches = [[trade("10:00:10", 1.0), trade("10:00:20", 3.0)], [trade("10:05:30", 2.0)],
               [trade("10:10:00", 3.0)]]
    run(spark, tmp_path, window_totals, batches)
    assert open_rows(spark, tmp_path, batch_id=0) == {("Coinbase", "10:00"): (2, 2.0)}
    # The watermark of the last batch, 10:00:30, has not passed the end of the first window.
    assert open_rows(spark, tmp_path) == {
        ("Coinbase", "10:00"): (2, 2.0), ("Coinbase", "10:05"): (1, 2.0), ("Coinbase", "10:10"): (1, 3.0),
    }


@pytest.mark.parametrize("widths", [(2, 5), (5, 2)])
def test_state_carried_to_another_width(spark, tmp_path, widths):
    batches = [
        [trade("10:00:10", float(m), M=f"m{m}") for m in range(30)],
        [trade("10:02:10", 1.0, M=f"m{m}") for m in range(0, 30, 2)],
        [trade("10:03:00", 8.0, M="m1"), trade("10:00:20", 7.0, M="m3")],
        [trade("10:03:30", 5.0, M="m1"), trade("10:00:30", 9.0, M="m3"), trade("10:00:31", 9.0, M="new")],
        [trade("10:20:00", 1.0, M="m1")],
        [trade("10:00:32", 2.0, M="m3"), trade("10:20:01", 4.0, M="m1")],
        [trade("10:21:00", 4.0, M="m1")],
    ]
    whole = run(spark, tmp_path, stateful_totals, batches, state="one", shuffle_partitions=3)
    before = run(spark, tmp_path, stateful_totals, batches[:3], state="a", landing="a",
                 shuffle_partitions=widths[0])
    carried = carried_groups(spark, str(tmp_path / "a"), str(tmp_path / "carried"))
    after = run(
        spark, tmp_path, lambda t: stateful_totals(t, carried=carried), batches[3:], state="b",
        landing="b", shuffle_partitions=widths[1],
    )
    assert len(list((tmp_path / "b" / "state" / "0").glob("[0-9]*"))) == widths[1]
    assert [x for x in before + after if x] == [x for x in whole if x]
    assert open_rows(spark, tmp_path, "b") == open_rows(spark, tmp_path, "one")


def test_nothing_to_carry(spark, tmp_path):
    run(spark, tmp_path, stateful_totals, [[trade(F="4")]], state="a")
    carried = carried_groups(spark, str(tmp_path / "a"), str(tmp_path / "carried"))
    assert carried.count() == 0
    rows = run(spark, tmp_path, lambda t: stateful_totals(t, carried=carried), [[trade()]], state="b", landing="b")
    assert [x for x in rows if x] == [{("Coinbase", "10:00"): (1, 100.0)}]
