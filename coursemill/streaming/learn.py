"""The learning log as a stream: play times, covered ranges and learned seconds, out of one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from coursemill.functions.scalars import seconds_between
from coursemill.operators.playback import PLAY_TIMES, VIDEO, durations_of, interval_texts, play_order
from coursemill.streaming.sinks import append_commits, start
from coursemill.streaming.state import state_rows, whole_groups

RANGE = [*VIDEO, "ps", "pe"]
TOTAL = ["dimension", "id"]
VALUES = ["secs_all", "first", "plays"]

#: Tables of the job: their keys and what else they hold.
TABLES = {
    "play_time": (TOTAL, "totaltime bigint"),
    "video_interval": (VIDEO, "play_interval string"),
    "video_learn_detail": (VIDEO, "totaltime bigint, effecttime bigint, completetime bigint"),
}


def learn_groups(learn: DataFrame) -> DataFrame:
    """Seconds per (dimension, id) and seconds, first play and plays per range of a video, as one aggregation.

    Each play counts in six groups, folded inside each task before the shuffle: a much-repeated video costs its different
    ranges and not its plays, a dimension its different ids.
    """
    kinds = dict(learn.dtypes)
    none = [F.lit(None).cast(kinds[c]).alias(c) for c in RANGE]
    text = F.lit(None).cast("string")
    dims = [F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("id"), *none) for c in PLAY_TIMES.values()]
    video = F.struct(text.alias("dimension"), text.alias("id"), *[F.col(c).alias(c) for c in RANGE])
    secs = seconds_between(F.col("ts"), F.col("te"))
    plays = learn.select("*", secs.alias("secs"), F.struct(*play_order(learn), secs.alias("secs")).alias("play"))
    rows = plays.select(F.inline(F.array(*dims, video)), "secs", "play")
    return rows.groupBy(*TOTAL, *RANGE).agg(
        F.sum("secs").alias("secs_all"), F.min(F.when(F.col("dimension").isNull(), F.col("play"))).alias("first"),
        F.count(F.lit(1)).alias("plays"))


def run_learn(spark: SparkSession, learn: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The tables of ``TABLES`` below ``out``, each a batch's changed rows under the batch's number.

    Ranges live in the state store only. Of a video that was played in the batch all ranges count again, in order of
    (ps, pe), so results are those of the batch operators however the plays are dealt to batches. A batch that failed
    between two tables writes the same rows again.
    """
    write = {name: append_commits(f"{out}/{name}", keys) for name, (keys, _) in TABLES.items()}

    def each(batch: DataFrame, number: int) -> None:
        changed = batch.persist()
        ranges = F.col("dimension").isNull()
        write["play_time"](changed.where(~ranges).select(*TOTAL, F.col("secs_all").alias("totaltime")), number)
        before = state_rows(spark, checkpoint, TOTAL + RANGE, VALUES, number - 1).where(ranges) if number else None
        videos = whole_groups(changed.where(ranges), before, RANGE, VIDEO).persist()
        write["video_interval"](interval_texts(videos), number)
        write["video_learn_detail"](durations_of(videos), number)
        videos.unpersist()
        changed.unpersist()
    return start(learn_groups(learn), checkpoint, each, trigger=trigger)


def table_schema(learn: DataFrame, name: str) -> StructType:
    """Schema of a table of the job, as the log's key columns are typed."""
    keys, rest = TABLES[name]
    kinds = dict(learn.dtypes) | dict.fromkeys(TOTAL, "string")
    return StructType.fromDDL(", ".join(f"{k} {kinds[k]}" for k in keys) + ", " + rest)
