"""Accounts of a query: what came in per micro-batch, what was left out and why.

Spark drops late rows without a word, and metrics observed in a plan go to whoever listens. A listener
writes them to a folder, one small file per micro-batch, named after query and batch, so a batch that is
run again replaces its own. What the totals took in is in their change log, so every trade is accounted for:

    input = rejected + other sides + taken + late
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tapeline.functions.trades import has_side
from tapeline.operators.served import SERVED_KEY, batch_order

COUNTS = "query_id string, batch_id bigint, metric string, n bigint"


def observe_sides(trades: DataFrame, name: str = "sides") -> DataFrame:
    """Count trades with and without a side, as the query metrics `sided` and `other`."""
    side = F.coalesce(has_side(F.col("F")), F.lit(False))
    return trades.observe(name, F.count_if(side).alias("sided"), F.count_if(~side).alias("other"))


def progress_counts(progress) -> list[dict]:
    """The counts of a progress report: `input`, `<name>.<metric>` of all observed metrics, and
    `late_partials`, the partial sums that were dropped as late."""
    counts = {"input": progress.numInputRows}
    for name, metrics in progress.observedMetrics.items():
        for metric, value in metrics.asDict().items():
            if isinstance(value, int):
                counts[f"{name}.{metric}"] = value
    counts["late_partials"] = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
    where = {"query_id": str(progress.id), "batch_id": progress.batchId}
    return [{**where, "metric": metric, "n": n} for metric, n in counts.items()]


class Accounts(StreamingQueryListener):
    """Writes the counts of every micro-batch of the session's queries, or of those named, to a folder.

    Add it with `spark.streams.addListener` before the queries start. Batches without input are left out.
    """

    def __init__(self, spark: SparkSession, folder: str, names: tuple[str, ...] | None = None):
        self.spark, self.folder, self.names = spark, folder, names

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if progress.numInputRows and (self.names is None or progress.name in self.names):
            lines = "\n".join(json.dumps(count) for count in progress_counts(progress))
            name = f"{progress.id}-{progress.batchId:020d}.json"
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            conf = self.spark._jsparkSession.sessionState().newHadoopConf()
            stream = path.getFileSystem(conf).create(path, True)
            try:
                stream.write(bytearray(lines.encode()))
            finally:
                stream.close()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def wait(self, seconds: float = 30) -> None:
        """Until all that has happened so far is written."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(int(seconds * 1000))


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(COUNTS).json(folder)


def taken_per_batch(change_log: DataFrame) -> DataFrame:
    """`batch_id`, `taken`: trades that each batch added to its groups, from the counts in the log.

    A group that has fewer than before began again (`stateful_totals` does that after its state expired);
    one that came back with as many or more at once counts as having gone on.
    """
    order = batch_order(F.col("batch_ms"), F.col("batch_id"))
    before = F.lag("counttxns").over(Window.partitionBy(*SERVED_KEY).orderBy(order))
    goes_on = F.col("counttxns") >= before
    added = F.col("counttxns") - F.when(goes_on, before).otherwise(0)
    rows = change_log.select("batch_id", added.alias("added"))
    return rows.groupBy("batch_id").agg(F.sum("added").alias("taken"))


def batch_accounts(counts: DataFrame, change_log: DataFrame) -> DataFrame:
    """Per batch of one query: input, rejected, other_side, taken, late, late_partials.

    `counts` of a query whose trades went through `observe_sides`, and its change log. What was rejected
    while decoding counts as input; without a decoding step nothing is rejected.
    """

    def of(metric: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("metric") == metric, F.col("n"))), F.lit(0).cast("bigint"))

    batches = counts.groupBy("batch_id").agg(
        of("input").alias("input"),
        of("decode.rejected").alias("rejected"),
        of("sides.other").alias("other_side"),
        of("sides.sided").alias("sided"),
        of("late_partials").alias("late_partials"),
    )
    taken = F.coalesce("taken", F.lit(0).cast("bigint"))
    return batches.join(taken_per_batch(change_log), "batch_id", "left").select(
        "batch_id",
        "input",
        "rejected",
        "other_side",
        taken.alias("taken"),
        (F.col("sided") - taken).alias("late"),
        "late_partials",
    )
