"""Change classes of items as they arrive, against the last known state of each key.

``classify_changes`` compares a batch with a stored table; here Spark keeps what is known of a
key as state of a running job: one hash per compared column, so texts never enter the state or
leave the JVM.  What a key's items of one micro-batch become is decided by the newest of them,
found in one pass, so a key with many items is held in constant memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField

from evidenza.functions.text import london_time
from evidenza.operators.ingest import AUDIT_COLUMNS

#: Time of items without one: before all others.
NEVER = -(1 << 62)
#: What is forgotten leaves the state this much later, so that a clock that is set back loses no item.
CLOCK_DELAY = "1 hour"
STATE = T.StructType([StructField("hashes", T.StringType()), StructField("at", T.LongType()), StructField("seen_ms", T.LongType())])


def decide(known: tuple[str, int] | None, hashes: str, at: int, columns: Sequence[str]) -> tuple[str, list[str] | None]:
    """(action, changed columns) of an item against what is known of its key."""
    if known is None:
        return "insert", None
    if at < known[1]:
        return "late", None
    pairs = zip(columns, known[0].split(","), hashes.split(","), strict=True)
    changed = [name for name, old, new in pairs if old != new]
    return ("update", changed) if changed else ("unchanged", changed)


def change_stream(
    items: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    at: str = "scraped_at",
    ignored: Sequence[str] = AUDIT_COLUMNS,
    expire_after: timedelta | None = None,
) -> DataFrame:
    """``(*key, action, changed, n_items, at, london_at)`` per key and micro-batch of ``items``.

    ``action`` is ``insert`` for a key that is not known, ``update`` (``changed`` names the
    columns), ``unchanged``, or ``late`` if the newest item is older than what is known, which then
    stays.  Of items of equal time, in one micro-batch, that with the smallest hashes counts.
    Items without a time are older than all others; a null key is a key; null is a value of its own.

    Without ``expire_after`` a key is known for ever.  With it, a key that had no item (of any
    kind) for that long is forgotten, by the clock of the micro-batch, which a batch that is run
    again keeps.  The watermark is on that clock, not on the items' own times, so however old an
    item is, none is dropped.  The number of shuffle partitions is fixed by the first run.
    """
    compared = [c for c in columns if c not in ignored]
    hashes = F.concat_ws(",", *[F.when(F.col(c).isNull(), "-").otherwise(F.xxhash64(c).cast("string")) for c in compared])
    kinds = dict(items.dtypes)
    time = F.unix_micros(F.col(at)) if kinds[at] == "timestamp" else F.col(at).cast("bigint")
    narrow = items.select(*key, hashes.alias("_hashes"), F.coalesce(time, F.lit(NEVER)).alias("_at"))
    names = [f"_key{i}" for i in range(len(key))]
    output = T.StructType(
        [StructField(n, items.schema[k].dataType) for n, k in zip(names, key, strict=True)]
        + [
            StructField("action", T.StringType()),
            StructField("changed", T.ArrayType(T.StringType())),
            StructField("n_items", T.LongType()),
            StructField("at", T.LongType()),
        ]
    )
    life = None if expire_after is None else max(int(expire_after / timedelta(milliseconds=1)), 1)

    def step(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        known = tuple(state.get) if state.exists else None
        if known and life is not None and now - known[2] >= life:
            known = None
        n_items, newest = 0, None
        for part in parts:
            n_items += len(part)
            for row in zip(part["_at"], part["_hashes"], strict=True):
                if newest is None or (-row[0], row[1]) < (-newest[0], newest[1]):
                    newest = row
        if newest is None:
            return
        at_newest, found = int(newest[0]), newest[1]
        action, changed = decide(known and known[:2], found, at_newest, compared)
        state.update((*known[:2], now) if action == "late" else (found, at_newest, now))
        if life is not None:
            state.setTimeoutTimestamp(now + life)
        cells = {n: [v] for n, v in zip(names, group, strict=True)}
        yield pd.DataFrame({**cells, "action": [action], "changed": [changed], "n_items": [n_items], "at": [at_newest]})

    timeout = GroupStateTimeout.NoTimeout
    if life is not None:
        narrow = narrow.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", CLOCK_DELAY)
        timeout = GroupStateTimeout.EventTimeTimeout
    found = narrow.groupBy(*key).applyInPandasWithState(step, output, STATE, "append", timeout)
    known_at = F.when(F.col("at") > NEVER, F.col("at"))
    instant = F.timestamp_micros(known_at) if kinds[at] == "timestamp" else known_at
    local = [london_time(instant).alias("london_at")] if kinds[at] == "timestamp" else []
    return found.select(
        *[F.col(n).alias(k) for n, k in zip(names, key, strict=True)], "action", "changed", "n_items", instant.alias("at"), *local
    )
