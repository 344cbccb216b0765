"""Rows that may arrive twice, or late, land once by event time."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.lookups import _with_part
from tidemark.sources import commits

WATERMARK = "watermark"


def _split(batch: DataFrame, event_time: str, mark: str | None) -> tuple[DataFrame, DataFrame]:
    """Rows the watermark has not passed, and the others; a row without event time is late."""
    if mark is None:
        behind = F.col(event_time).isNull()
    else:
        behind = F.col(event_time).isNull() | (F.col(event_time) < F.lit(mark).cast("timestamp"))
    return batch.where(~behind), batch.where(behind)


def _unseen(fresh: DataFrame, target: str, keys: Sequence[str], manifest: commits.Manifest | None) -> DataFrame:
    """One row per key, without keys that have landed in a month the fresh rows may lie in.

    Months before the watermark's are not read: no fresh row lies there. A null key equals no other.
    """
    spark = fresh.sparkSession
    whole = [F.col(k).isNotNull() for k in keys]
    known_key = whole[0]
    for w in whole[1:]:
        known_key &= w
    rows = fresh.where(known_key).dropDuplicates(list(keys)).unionByName(fresh.where(~known_key))
    if manifest is None:
        return rows
    mark = manifest.notes.get(WATERMARK)
    months = {p.month for p in manifest.parts if mark is None or p.month == commits.NO_DATE or p.month >= mark[:7]}
    landed = commits.read(spark, target, manifest, months).select(*keys)
    on = [*keys, "__part"]
    return _with_part(rows, keys, True).join(_with_part(landed, keys, False), on, "left_anti").drop("__part")


def land_once(
    stream: DataFrame, target: str, late: str, keys: Sequence[str], event_time: str, delay: str, checkpoint: str
) -> StreamingQuery:
    """Add the rows of a stream to ``target`` by month of event time, each key once; then stop.

    The watermark is the latest event time seen less ``delay`` (an interval such as ``2 days``). Rows behind the
    watermark of the batches before go to ``late``, whole and as often as they come, so that none is lost. The
    landed rows are the state: keys are looked up in the months the watermark has not passed, and the
    watermark is published with the rows it follows from. A batch that is run again, after a restart
    or a failure between both tables, finds the same watermark and adds what is missing.
    """
    name = hashlib.sha1(checkpoint.encode()).hexdigest()[:8]
    spark = stream.sparkSession

    def land(batch: DataFrame, number: int) -> None:
        key = f"{name}-{number}"
        manifest = commits.newest(spark, target)
        if manifest is not None and key in manifest.keys:
            return
        mark = manifest.notes.get(WATERMARK) if manifest else None
        latest = batch.select(F.max(F.col(event_time)) - F.expr(f"INTERVAL {delay}")).first()[0]
        now = mark if latest is None else max(filter(None, (mark, latest.isoformat(sep=" "))))
        month = F.trunc(event_time, "month").alias(commits.PARTITION)
        fresh, behind = _split(batch.select("*", month), event_time, mark)
        commits.add_once(behind, late, key)
        commits.add_once(_unseen(fresh, target, keys, manifest), target, key, notes={WATERMARK: now})

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
