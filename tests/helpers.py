"""Small inputs made by hand."""

import json
import os
import time
from datetime import datetime, timezone

from tapeline.schemas import TRADE


def seconds(clock: str, day: str = "2021-01-08") -> int:
    moment = datetime.fromisoformat(f"{day}T{clock}").replace(tzinfo=timezone.utc)
    return int(moment.timestamp())


def trade(clock="10:00:00", price=100.0, *, day="2021-01-08", **changes):
    row = {
        "TYPE": "0", "M": "Coinbase", "FSYM": "BTC", "TSYM": "USD", "F": "2", "ID": "1",
        "TS": seconds(clock, day), "Q": 2.0, "P": price, "TOTAL": 2.0 * price,
        "RTS": seconds(clock, day),
    }
    return {**row, **changes}


def trades_frame(spark, rows):
    return spark.createDataFrame([tuple(row[n] for n in TRADE.fieldNames()) for row in rows], TRADE)


def text_frame(spark, values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def write_batches(folder, batches, first=0):
    """One JSON-lines file per micro-batch, oldest first, numbered from `first`."""
    os.makedirs(folder, exist_ok=True)
    now = time.time() - 1000
    for number, rows in enumerate(batches, first):
        path = os.path.join(folder, f"{number:04d}.json")
        with open(path, "w") as out:
            out.writelines(json.dumps(row) + "\n" for row in rows)
        os.utime(path, (now + 10 * number, now + 10 * number))
