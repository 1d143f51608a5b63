"""Crawl dataflow in batch: frontier, breadth-first closure, pacing, conditional fetches, statistics (STM-*, WIN-03,
AGG-10, 11, PRED-19, JOIN-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import any_part, host, micros
from ..session import written as _written


def link_edges(pages: DataFrame, url: str = "url", links: str = "links") -> DataFrame:
    """STM-04: (src, dst), an edge per link."""
    return pages.select(F.col(url).alias("src"), F.explode(links).alias("dst"))


def route(status: Column, kind: str = "polite") -> Column:
    """PRED-19: what becomes of an answer: store, skip, ok (nothing to store), retry, drop or error."""
    good = status.between(200, 299)
    if kind == "polite":
        return F.when(status == 304, "skip").when(good, "store").otherwise("ok")
    if kind == "full":
        return F.when(status == 304, "skip").when(status == 200, "store").otherwise("error")
    return F.when(status == 200, "store").when(status == 429, "retry").when(status == 404, "drop").otherwise("error")


def unseen(urls: DataFrame, seen: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """JOIN-10, STM-03: addresses not seen yet, each once, the first by ord if there is one."""
    keys = keys or ["crawl_id", "url"]
    if "ord" in urls.columns:
        urls = urls.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("ord"))).where("__n = 1").drop("__n")
    else:
        urls = urls.dropDuplicates(keys)
    return urls.join(seen.select(*keys).distinct(), keys, "left_anti")


def breadth_first(edges: DataFrame, seeds: DataFrame, depth: int, include: list[str] | None = None, exclude: list[str] | None = None, stay: bool = False) -> DataFrame:
    """STM-07: (node, depth) of all nodes within `depth` steps of seeds(node), by the level they are first met on.

    edges(src, dst). A node is marked when it enters the frontier, so it is expanded once. Optional filters on found
    addresses: any of the include parts, none of the exclude parts, the host of the page before.
    """
    if include:
        edges = edges.where(any_part(F.col("dst"), include))
    if exclude:
        edges = edges.where(~any_part(F.col("dst"), exclude))
    if stay:
        edges = edges.where(host(F.col("src")) == host(F.col("dst")))
    found = _written(seeds.select("node").distinct().withColumn("depth", F.lit(0)), "level")
    frontier = found
    for d in range(1, depth + 1):
        step = edges.join(frontier, edges.src == frontier.node, "left_semi").select(F.col("dst").alias("node")).distinct()
        frontier = _written(step.join(found, "node", "left_anti").withColumn("depth", F.lit(d)), "level")
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return found


def pacing(requests: DataFrame, gap_us: Column, domain: str = "domain", arrival_us: str = "arrival_us", tie: str = "id") -> DataFrame:
    """WIN-03, STM-08: start of each request if a domain's starts lie gap_us apart: start_n is the largest of
    arrival_k + (n - k) * gap over k <= n, a running maximum in whole microseconds."""
    w = Window.partitionBy(domain).orderBy(arrival_us, tie)
    n = F.row_number().over(w) - 1
    rows = requests.withColumn("__n", n)
    top = F.max(F.col(arrival_us) - F.col("__n") * gap_us).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("start_us", (top + F.col("__n") * gap_us).cast("bigint")).drop("__n")


def changed(old: DataFrame, new: DataFrame, key: str = "url", mark: str = "content_hash") -> DataFrame:
    """STM-10: new rows with changed: unknown before, or of another mark."""
    before = old.select(F.col(key).alias("__k"), F.col(mark).alias("__m"))
    return new.join(before, F.col(key) == F.col("__k"), "left").withColumn("changed", F.col("__k").isNull() | ~F.col("__m").eqNullSafe(F.col(mark))).drop("__k", "__m")


def crawl_stats(events: DataFrame, by: str, kind: str, ts: str, kinds: dict[str, list[str]]) -> DataFrame:
    """AGG-10, AGG-11: per crawl, counts by kind, first and last time, and rows per second."""
    seconds = (micros(F.max(ts)) - micros(F.min(ts))) / 1_000_000
    return events.groupBy(by).agg(*(F.count_if(F.col(kind).isin(*v)).alias(k) for k, v in kinds.items()), F.count("*").alias("n"), F.try_divide(F.count("*"), seconds).alias("per_second"))


def polite_plan(frontier: DataFrame, pages: DataFrame, permitted: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """STM-11: (stored, queued) of one step: frontier rows that are permitted (urls without a verdict are) and fetched;
    pages marked noindex aren't stored, links of nofollow pages aren't followed; new links queue once, a level deeper."""
    ok = frontier.join(permitted.where(~F.col("allowed")).select("url"), "url", "left_anti")
    got = ok.join(pages, "url").withColumn("action", route(F.col("status"))).where("action = 'store'")
    stored = got.where("index")
    links = got.where("follow").select("crawl_id", F.col("url").alias("discovered_from"), (F.col("depth") + 1).alias("depth"), F.explode("links").alias("url"))
    order = F.row_number().over(Window.partitionBy("crawl_id", "url").orderBy("depth", "discovered_from"))
    return stored, unseen(links.withColumn("__n", order).where("__n = 1").drop("__n"), seen)


def sitemap_plan(frontier: DataFrame, sitemaps: DataFrame, expanded: DataFrame, seen: DataFrame) -> DataFrame:
    """STM-05: addresses of sitemaps(domain, sitemap, loc) for domains met first in this step, at depth 0."""
    fresh = frontier.select("crawl_id", host(F.col("url")).alias("domain")).distinct().join(expanded, ["crawl_id", "domain"], "left_anti")
    urls = fresh.join(sitemaps, "domain").select("crawl_id", F.col("loc").alias("url"), F.lit(0).alias("depth"), F.concat(F.lit("sitemap:"), "sitemap").alias("discovered_from"))
    return unseen(urls, seen)


def full_plan(frontier: DataFrame, pages: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """STM-12: (stored, queued, errors) of one step without robots rules: every 200 is stored and all its links, resolved
    against the requested address, are queued once, a level deeper; 304 is skipped; another status is an error."""
    got = frontier.join(pages, "url").withColumn("action", route(F.col("status"), "full"))
    stored = got.where("action = 'store'")
    links = stored.select("crawl_id", F.col("url").alias("discovered_from"), (F.col("depth") + 1).alias("depth"), F.explode("links").alias("url"))
    order = F.row_number().over(Window.partitionBy("crawl_id", "url").orderBy("depth", "discovered_from"))
    return stored, unseen(links.withColumn("__n", order).where("__n = 1").drop("__n"), seen), got.where("action = 'error'")


def retry_plan(attempts: DataFrame, most: int = 3) -> DataFrame:
    """STM-14: per url the outcome of its attempts(url, attempt, status) and the seconds waited between them: n + 1 after
    attempt n, three more after a 429; later attempts than `most` don't count."""
    rows = attempts.where(F.col("attempt") < most)
    wait = F.when(F.col("status") == 200, 0).otherwise(F.col("attempt") + 1 + F.when(F.col("status") == 429, 3).otherwise(0))
    return rows.groupBy("url").agg(F.max_by("status", "attempt").alias("status"), (F.max("attempt") + 1).alias("attempts"), F.sum(wait).alias("waited_s"))


def fan_out(urls: DataFrame, workers: int, per_second: float, key: str = "url") -> DataFrame:
    """STM-15: urls dealt to workers that share one ticker: worker and start (microseconds) of each, in order of key within
    a worker; together they start per_second requests a second.

    A worker's rows are numbered in stretches of keys, which are written, and the stretches before are added; what is
    broadcast is a row per worker and stretch.
    """
    gap = int(workers / per_second * 1_000_000)
    rows = urls.withColumn("worker", F.pmod(F.xxhash64(key), F.lit(workers)).cast("int")).withColumn("__at", F.monotonically_increasing_id())
    rows = _written(rows.repartitionByRange("worker", key, "__at").withColumn("__part", F.spark_partition_id()), "fan")
    sizes = rows.groupBy("worker", "__part").agg(F.count("*").alias("__size"))
    before = F.coalesce(F.sum("__size").over(Window.partitionBy("worker").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("worker", "__part").orderBy(key, "__at")) - 1
    rows = rows.withColumn("__n", own).join(F.broadcast(sizes.select("worker", "__part", before.alias("__before"))), ["worker", "__part"])
    start = (F.col("__before") + F.col("__n")) * F.lit(gap).cast("bigint") + F.col("worker") * F.lit(gap // workers).cast("bigint")
    return rows.select(*urls.columns, "worker", start.alias("start_us"))
