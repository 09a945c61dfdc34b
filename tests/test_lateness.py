"""Both forms of the totals against a plain loop over random micro-batches with late rows."""

import random
from collections import defaultdict

import pyarrow as pa
import pytest
from helpers import trade, write_batches

from tapeline.operators.totals import window_totals
from tapeline.sources.files import read_trades
from tapeline.streaming import stateful
from tapeline.streaming.runs import start
from tapeline.streaming.stateful import combine_partials, stateful_totals

MINUTES_5 = 300


def random_batches(seed):
    """Times move on by some minutes per batch; many rows are late by up to 20 minutes."""
    chance = random.Random(seed)
    now, batches = 36_000, []
    for _ in range(9):
        now += chance.choice([0, 30, 200, 400, 900])
        rows = []
        for _ in range(chance.randint(1, 6)):
            at = now - chance.choice([0, 0, 20, 250, 310, 400, 700, 1200])
            rows.append(
                trade(TS=at, M=chance.choice(["Kraken", "Gemini"]), F=chance.choice("12"),
                      P=float(chance.randint(1, 50)))
            )
        batches.append(rows)
    return batches


def expected(batches, row_time):
    """Emitted rows per batch. Late rows are judged by the watermark of the batch before."""
    groups, result = {}, []
    latest, late_before, watermark = 0, 0, 0
    for rows in batches:
        late_before, watermark = watermark, max(watermark, latest - MINUTES_5)
        touched = set()
        for row in rows:
            latest = max(latest, row["TS"])
            start = row["TS"] // 60 * 60
            key = (row["M"], row["F"], start)
            if (row["TS"] if row_time else start + 60) <= late_before:
                continue
            prices, _ = groups.get(key, ([], None))
            groups[key] = ([*prices, row["P"]], watermark + MINUTES_5)
            touched.add(key)
        result.append(
            sorted((*key, sum(groups[key][0]) / len(groups[key][0]), len(groups[key][0]))
                   for key in touched)
        )
        groups = {
            key: (prices, timeout)
            for key, (prices, timeout) in groups.items()
            if (key in touched or timeout >= watermark if row_time else key[2] + 60 > watermark)
        }
    return result


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("row_time", [True, False])
def test_random_micro_batches(spark, tmp_path, seed, row_time):
    batches = random_batches(seed)
    write_batches(tmp_path / "in", batches)
    seen = defaultdict(list)

    def keep(batch, batch_id):
        for row in batch.collect():
            flag = "1" if row.direction == "SELL" else "2"
            start_at = row.window_start.hour * 3600 + row.window_start.minute * 60
            seen[batch_id].append((row.market, flag, start_at, row.avgprice, row.counttxns))

    trades = read_trades(spark, str(tmp_path / "in"), maxFilesPerTrigger=1)
    totals = stateful_totals(trades, buckets=2) if row_time else window_totals(trades)
    writer = totals.writeStream.outputMode("update").foreachBatch(keep)
    start(spark, writer, str(tmp_path / "state"), once=True,
          shuffle_partitions=2).awaitTermination()
    assert [sorted(seen[n]) for n in range(len(batches))] == expected(batches, row_time)


def test_combine_partials_bounds_what_it_holds(monkeypatch):
    monkeypatch.setattr(stateful, "_HELD_ROWS", 10)
    names = ["market", "fromcoin", "direction"]
    schema = pa.schema(
        [(n, pa.string()) for n in names] + [("seconds", pa.int64())]
        + [(n, pa.float64()) for n in ("vol", "price", "quantity")] + [("n", pa.int64())]
    )

    def batch(second, count):
        columns = [["M"] * count, ["BTC"] * count, ["BUY"] * count,
                   [second + i % 3 for i in range(count)],
                   [1.0] * count, [2.0] * count, [3.0] * count, [1] * count]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema)

    sizes = [batch(second, 30) for second in range(0, 60, 3)]
    out = pa.Table.from_batches(list(combine_partials(iter(sizes))))
    assert out.num_rows == 60
    assert sum(out["n"].to_pylist()) == 600
    assert sum(out["price"].to_pylist()) == 1200.0
    same = pa.Table.from_batches(list(combine_partials(iter([batch(0, 30)] * 20))))
    assert same.num_rows == 3
    assert list(combine_partials(iter([]))) == []


def test_combine_partials_holds_little_of_a_large_task():
    """A worker's memory does not follow the rows of its task: held are 40,000, or 10,000 more."""
    held, n = [], 40

    def batches():
        begin = pa.total_allocated_bytes()
        for number in range(n):
            held.append(pa.total_allocated_bytes() - begin)
            yield pa.RecordBatch.from_pydict({
                "market": ["Coinbase"] * 10_000, "fromcoin": ["BTC"] * 10_000,
                "direction": ["SELL"] * 10_000,
                "seconds": list(range(number * 10_000, (number + 1) * 10_000)),
                "vol": [1.5] * 10_000, "price": [2.0] * 10_000, "quantity": [3.0] * 10_000,
                "n": [1] * 10_000,
            })

    rows, volume, seconds = 0, 0.0, 0
    for batch in combine_partials(batches()):
        rows += batch.num_rows
        volume += sum(batch["vol"].to_pylist())
        seconds += sum(batch["seconds"].to_pylist())
        del batch
    total = n * 10_000
    assert (rows, volume, seconds) == (total, 1.5 * total, total * (total - 1) // 2)
    assert max(held) < 8 * 2**20
