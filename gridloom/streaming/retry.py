"""Refused messages tried again until they pass or are given up.

The transport of messages that lack a device, or whose device's entry is incomplete,
would hand them back.  Here they wait in a keyed table with the number of tries and the
time when the next is due.  Every batch also takes what is due and routes it with the
registry as it is then.  A message leaves by exactly one exit: that of its routing when it
passes, or ``dead_letter`` after ``max_tries``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gridloom import session
from gridloom.operators import route
from gridloom.operators.ordering import spread_small
from gridloom.operators.parse import INCOMPLETE_METADATA, INVALID_MESSAGE
from gridloom.schemas import ENVELOPE
from gridloom.sinks import tables
from gridloom.sinks.keyed import KeyedTable
from gridloom.sinks.tables import Sink
from gridloom.sources.landed import RegistrySnapshot

DEAD_LETTER = "dead_letter"
REFUSED = (INVALID_MESSAGE, INCOMPLETE_METADATA)
PENDING = StructType([*ENVELOPE.fields]).add("tries", "integer").add("due_at", "timestamp").add("reason", "string")


def pending_table(spark: SparkSession, path: str) -> KeyedTable:
    """The waiting messages, one row per message id."""
    return KeyedTable(spark, path, PENDING, ["message_id"])


class Retry:
    """Route batches together with what is due from ``pending``.

    The wait doubles with every try.  ``clock`` gives the time of a batch;
    ``reasons`` are the reasons to try again for, of quarantined or unidentified messages.
    """

    def __init__(
        self,
        registry: RegistrySnapshot,
        pending: KeyedTable,
        sink: Sink,
        max_tries: int = 5,
        wait_seconds: int = 60,
        reasons: Sequence[str] = REFUSED,
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
        ingested_at: Column | None = None,
    ) -> None:
        self.registry, self.pending, self.sink = registry, pending, sink
        self.max_tries, self.wait_seconds, self.reasons = max_tries, wait_seconds, list(reasons)
        self.clock, self.ingested_at = clock, ingested_at

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        """A micro-batch of envelopes; message ids name messages."""
        self.run(spread_small(df, "message_id"), tables.run_of(df), batch_id)

    def due_only(self, run: str, batch_id: int) -> None:
        """Try what is due without new messages, as when the stream is idle."""
        self.run(self.pending.spark.createDataFrame([], ENVELOPE), run, batch_id)

    def run(self, envelopes: DataFrame, run: str, batch_id: int) -> None:
        if self.pending.done(run, batch_id):
            return
        now = F.lit(self.clock().isoformat()).cast("timestamp")
        waiting = self.pending.current()
        names = [c for c in ENVELOPE.names if c in envelopes.columns]
        fresh = envelopes.select(*names, F.lit(0).alias("_tries"))
        # A message that is sent again while it waits is one message.
        fresh = fresh.join(waiting.select(F.col("message_id").alias("_id")), F.col("message_id") == F.col("_id"), "left_anti")
        due = waiting.where(F.col("due_at") <= now).select(*names, F.col("tries").alias("_tries"))
        routed = route.route(fresh.unionByName(due), self.registry.get(), self.ingested_at)
        refused = F.coalesce(F.col("reason").isin(self.reasons), F.lit(False))
        marked = routed.withColumns(
            {"tries": F.col("_tries") + 1, "_again": refused & (F.col("_tries") + 1 < self.max_tries)}
        )
        marked = session.settle(marked, "retry")
        given_up = F.coalesce(F.col("reason").isin(self.reasons), F.lit(False))
        final = marked.where("not _again").withColumn("exit", F.when(given_up, DEAD_LETTER).otherwise(F.col("exit")))
        self.sink(final.drop("_tries", "_again"), batch_id)
        wait = F.make_interval(secs=F.lit(float(self.wait_seconds)) * F.pow(F.lit(2.0), F.col("_tries")))
        changed = marked.where("_again or _tries > 0").select(
            *[F.col(c) if c in names else F.lit(None).cast(ENVELOPE[c].dataType).alias(c) for c in ENVELOPE.names],
            "tries",
            (now + wait).alias("due_at"),
            "reason",
            (~F.col("_again")).alias("_gone"),
        )
        self.pending.commit(changed, run, batch_id)
        session.discard(marked)


def exits_of(written: DataFrame) -> DataFrame:
    """How many messages left by each exit, after how many tries."""
    return written.groupBy("exit", "reason", "tries").agg(F.count("*").alias("n_messages"))
