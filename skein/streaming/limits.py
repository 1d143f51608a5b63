"""Streams: seen-set, link expansion, statistics and the token bucket (STM-01..04, 06, 09, MATH-04, 05)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

FRONTIER = "url string, depth int, project_id string, crawl_id string, priority int, retry_count int, discovered_from string, strategy string, queued_at timestamp"


def frontier(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """STM-01, STM-02: a bounded source over files of frontier events; the checkpoint makes it exactly-once."""
    return spark.readStream.schema(FRONTIER).option("maxFilesPerTrigger", per_trigger).json(folder)


def unseen(events: DataFrame, delay: str | None = None) -> DataFrame:
    """STM-03: each (crawl, url) once; with a delay, state is dropped behind the watermark."""
    if delay:
        return events.withWatermark("queued_at", delay).dropDuplicatesWithinWatermark(["crawl_id", "url"])
    return events.dropDuplicates(["crawl_id", "url"])


def expand(pages: DataFrame) -> DataFrame:
    """STM-04: an event a level deeper for every link."""
    return pages.select(F.explode("links").alias("url"), (F.col("depth") + 1).alias("depth"), "project_id", "crawl_id", F.col("url").alias("discovered_from"), "strategy")


def routed(events: DataFrame, known: tuple[str, ...] = ("polite", "full", "wiki")) -> DataFrame:
    """STM-06: the strategy of each event; unspecified is polite, unknown ones are skipped."""
    s = F.lower(F.coalesce(F.nullif("strategy", F.lit("")), F.lit("unspecified")))
    return events.withColumn("strategy", F.when(s == "unspecified", "polite").when(s.isin(*known), s).otherwise("skipped"))


def effective(rps: Column, burst: Column, default: float = 1.0) -> tuple[Column, Column]:
    """MATH-05: rate, or the default if 0; burst, or the whole part of the rate, 1 at least."""
    rate = F.when(F.coalesce(rps, F.lit(0.0)) > 0, rps).otherwise(default)
    return rate, F.when(F.coalesce(burst, F.lit(0)) > 0, burst).otherwise(F.greatest(F.lit(1), F.floor(rate).cast("int")))


def bucket_step(tokens: float, last_us: int, now_us: int, rate: float, burst: int) -> tuple[float, int]:
    """MATH-04: (tokens after, wait in microseconds) of a request."""
    tokens = min(float(burst), tokens + max(0, now_us - last_us) / 1e6 * rate)
    if tokens >= 1:
        return tokens - 1, 0
    return tokens, -int(-(1 - tokens) / rate * 1e6 // 1)


def token_bucket(requests: DataFrame, rate: float, burst: int, domain: str = "domain", arrival: str = "arrival_us", tie: str = "id") -> DataFrame:
    """STM-09 over a table: (domain, id, arrival, wait_us). A domain's requests are taken in order; a step needs the
    state before it only, which goes along as the sorted rows of the domain's partition stream by."""
    kinds = {f.name: f.dataType.simpleString() for f in requests.schema.fields}
    rows = requests.select(domain, tie, arrival)
    parts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, domain).sortWithinPartitions(domain, arrival, tie)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = object(), (float(burst), None)
        for f in frames:
            waits = []
            for d, at in zip(f[domain], f[arrival], strict=True):
                if d != now:
                    now, state = d, (float(burst), at)
                tokens, wait = bucket_step(state[0], state[1], at, rate, burst)
                state = tokens, at
                waits.append(wait)
            yield f.assign(wait_us=pd.Series(waits, index=f.index, dtype="int64"))

    return rows.mapInPandas(run, f"{domain} {kinds[domain]}, {tie} {kinds[tie]}, {arrival} {kinds[arrival]}, wait_us bigint")


def token_bucket_stream(requests: DataFrame, rate: float, burst: int) -> DataFrame:
    """STM-09 over a stream of (domain, id, arrival_us): the bucket of a domain is kept between batches."""

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tokens, last = state.get if state.exists else (float(burst), None)
        for f in frames:
            f = f.sort_values(["arrival_us", "id"])
            waits = []
            for at in f["arrival_us"]:
                tokens, wait = bucket_step(tokens, int(at) if last is None else last, int(at), rate, burst)
                last = int(at)
                waits.append(wait)
            yield pd.DataFrame({"domain": key[0], "id": f["id"], "arrival_us": f["arrival_us"], "wait_us": waits})
        state.update((tokens, last))

    return requests.groupBy("domain").applyInPandasWithState(
        run, "domain string, id bigint, arrival_us bigint, wait_us bigint", "tokens double, last_us bigint", "append", GroupStateTimeout.NoTimeout
    )


def crawl_counters(events: DataFrame) -> DataFrame:
    """AGG-10 over a stream: per crawl, events by outcome."""
    return events.groupBy("crawl_id").agg(*(F.count_if(F.col("outcome") == k).alias(k) for k in ("crawled", "failed", "skipped")), F.count("*").alias("total"))
