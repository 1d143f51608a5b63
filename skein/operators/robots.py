"""robots.txt and sitemaps (ROB-01..07, JOIN-12, AGG-17, MATH-03, SRC-16..18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import any_part, none_if_empty, strip, text
from ..functions.udfs import body_text

SITEMAP_LIMIT = 10_000


def policy(status: Column) -> Column:
    """ROB-01: null (no answer) or 5xx: deny all; 4xx: allow all; else the rules count."""
    return F.when(status.isNull() | (status >= 500), "deny").when(status >= 400, "allow").otherwise("rules")


def rules(robots: DataFrame, agent: str, keys: list[str] | None = None, compat: bool = False) -> DataFrame:
    """ROB-02: (domain, kind, value, line) of the group that applies: kinds allow, disallow and crawl-delay of the first
    group whose agent is part of ours, else of the first '*'; and every sitemap line.

    Agent lines join the group before them while it has no rules; an empty Disallow ends that, unless compat.
    """
    keys = keys or ["domain"]
    lines = robots.select(*keys, F.posexplode(F.split(text(F.col("body")), "\n")).alias("line", "t"))
    lines = lines.withColumn("t", strip(F.regexp_replace("t", "#.*", ""))).where(F.col("t").contains(":"))
    lines = lines.select(*keys, "line", F.lower(strip(F.substring_index("t", ":", 1))).alias("kind"), strip(F.regexp_replace("t", "^[^:]*:", "")).alias("value"))
    lines = lines.where(F.col("kind").isin("user-agent", "allow", "disallow", "crawl-delay", "sitemap"))
    rule = F.col("kind").isin("allow", "disallow", "crawl-delay") & ((F.col("value") != "") if compat else F.lit(True))
    w = Window.partitionBy(*keys).orderBy("line")
    groups = lines.where("kind <> 'sitemap'").withColumn("is_rule", rule)
    before = F.last(F.when((F.col("kind") == "user-agent") | F.col("is_rule"), F.col("is_rule")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    groups = groups.withColumn("opens", (F.col("kind") == "user-agent") & F.coalesce(before, F.lit(True)))
    groups = groups.withColumn("grp", F.sum(F.col("opens").cast("int")).over(w)).where("grp > 0")
    agents = groups.where("kind = 'user-agent'")
    ours = F.when(F.col("value") == "*", 1).when((F.col("value") != "") & F.contains(F.lit(agent.lower()), F.lower("value")), 0)
    chosen = agents.withColumn("p", ours).where("p is not null").groupBy(*keys).agg(F.min(F.struct("p", "grp")).alias("c"))
    chosen = chosen.select(*keys, F.col("c.grp").alias("grp"))
    kept = groups.join(chosen, [*keys, "grp"]).where(F.col("is_rule") & (F.col("value") != "")).select(*keys, "kind", "value", "line")
    return kept.unionByName(lines.where("kind = 'sitemap' AND value <> ''").select(*keys, "kind", "value", "line"))


def rule_pattern(value: Column) -> Column:
    r"""ROB-04: a rule as a regular expression: segments between stars are found leftmost, without going back (atomic
    groups); $ at the end needs the path to end there."""
    ends = value.endswith("$")
    body = F.when(ends, F.substring(value, F.lit(1), F.char_length(value) - 1)).otherwise(value)
    parts = F.split(body, r"\*", -1)
    quoted = F.transform(parts, lambda p: F.concat(F.lit(r"\Q"), p, F.lit(r"\E")))
    middle = F.transform(F.slice(quoted, F.lit(2), F.greatest(F.size(quoted) - 1, F.lit(0))), lambda p: F.concat(F.lit("(?>.*?"), p, F.lit(")")))
    tail = F.when(ends & ~F.endswith(body, F.lit("*")), r"\z").otherwise("")
    return F.concat(F.lit("(?s)^"), F.element_at(quoted, 1), F.array_join(middle, ""), tail)


def allowed(urls: DataFrame, found: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """ROB-03, JOIN-12: urls(domain, path) with allowed: the longest matching allow rule is at least as long as the
    longest matching disallow rule, or there is none of these."""
    keys = keys or ["domain"]
    r = found.where(F.col("kind").isin("allow", "disallow")).withColumn("pattern", rule_pattern(F.col("value")))
    hits = urls.select(*keys, "path").distinct().join(r, keys).where(F.expr("path RLIKE pattern"))
    longest = lambda k: F.coalesce(F.max(F.when(F.col("kind") == k, F.octet_length("value"))), F.lit(-1))
    judged = hits.groupBy(*keys, "path").agg(((longest("disallow") < 0) | (longest("allow") >= longest("disallow"))).alias("ok"))
    return urls.join(judged, [*keys, "path"], "left").withColumn("allowed", F.coalesce("ok", F.lit(True))).drop("ok")


def verdicts(urls: DataFrame, answers: DataFrame, agent: str) -> DataFrame:
    """ROB-01, ROB-06: urls(domain, path) with allowed, over the domains' answers(domain, status, body): each domain's
    text is parsed once, whatever the number of its addresses; an answer that can't be had denies all, a 4xx allows all,
    and so does a domain that wasn't asked."""
    answers = answers.dropDuplicates(["domain"]).withColumn("policy", policy(F.col("status")))
    found = rules(answers.where("policy = 'rules'").select("domain", "body"), agent)
    judged = allowed(urls, found).join(answers.select("domain", "policy"), "domain", "left")
    return judged.withColumn("allowed", F.when(F.col("policy") == "deny", False).when(F.col("policy") == "allow", True).otherwise(F.col("allowed"))).drop("policy")


def crawl_delay(found: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """ROB-05, MATH-03: (domain, delay, rps) by the last delay of the group; no row, no delay."""
    d = F.expr("try_cast(value AS double)")
    rows = found.where("kind = 'crawl-delay'").where(d >= 0).groupBy(*(keys or ["domain"])).agg(F.max_by(d, "line").alias("delay"))
    return rows.withColumn("rps", F.when(F.col("delay") > 0, 1 / F.col("delay")))


def sitemap_locs(body: Column) -> tuple[Column, Column]:
    """(whether it is an index, its addresses) of a sitemap, parsed as XML: prefixes don't matter, references and CDATA
    are resolved; a broken document gives nothing."""
    entry = "array<struct<loc:string>>"
    doc = F.from_xml(none_if_empty(strip(text(body))), f"url {entry}, sitemap {entry}", {"ignoreNamespace": "true"})
    index = text(body).rlike(r"(?is)^(?:[^<]|<[?!][^>]*>)*<(?:\w+:)?sitemapindex[\s>/]")
    locs = F.transform(F.when(index, doc["sitemap"]).otherwise(doc["url"]), lambda x: strip(text(x["loc"])))
    return index, F.filter(F.coalesce(locs, F.array().cast("array<string>")), lambda x: x != "")


def sitemap_urls(sitemaps: DataFrame, root: str, limit: int = SITEMAP_LIMIT, depth: int = 2) -> DataFrame:
    """SRC-16, LIM-03: (loc, place) of a sitemap over sitemaps(loc, body), where body is text or fetched bytes, gzipped or
    not: an index is followed down to `depth` levels, broken or missing children give nothing; order of the documents;
    at most `limit`."""
    body = body_text(F.col("body")) if dict(sitemaps.dtypes)["body"] == "binary" else F.col("body")
    index, locs = sitemap_locs(F.col("body"))
    parsed = sitemaps.select("loc", body.alias("body")).select(F.col("loc").alias("from"), index.alias("is_index"), F.posexplode(locs).alias("i", "loc"))
    here = parsed.where(F.col("from") == root).withColumn("place", F.array("i"))
    out = here.where(~F.col("is_index"))
    for _ in range(depth):
        up = here.where("is_index").select(F.col("loc").alias("parent"), F.col("place").alias("above"))
        here = up.join(parsed, F.col("parent") == F.col("from")).select("from", "is_index", "i", "loc", F.concat("above", F.array("i")).alias("place"))
        out = out.unionByName(here.where(~F.col("is_index")))
    return out.select("loc", "place").orderBy("place").limit(limit)


def platform_urls(sitemaps: DataFrame, root: str, filters: list[str], paths: list[str]) -> DataFrame:
    """SRC-17, PRED-05: content addresses of one level of sub-sitemaps whose address has any of the filters."""
    parsed = sitemaps.select(F.col("loc").alias("from"), F.explode(sitemap_locs(F.col("body"))[1]).alias("loc"))
    subs = parsed.where(F.col("from") == root)
    if filters:
        subs = subs.where(any_part(F.upper("loc"), [f.upper() for f in filters]))
    return parsed.join(subs.select(F.col("loc").alias("sub")), F.col("from") == F.col("sub"), "left_semi").where(any_part(F.col("loc"), paths)).select("loc")


def probe_report(sites: DataFrame) -> DataFrame:
    """ROB-07: what a site's robots text and pages tell: rules found, sitemap lines, whether something rooted is
    disallowed, screening types, whether an interface answers."""
    low = F.lower(text(F.col("robots")))
    maps = F.regexp_extract_all(text(F.col("robots")), F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), F.lit(1))
    types = F.coalesce("types", F.array().cast("array<string>"))
    return sites.select(
        "domain", (none_if_empty(low).isNotNull()).alias("has_robots"), maps.alias("sitemaps"), low.contains("disallow: /").alias("disallows_root"),
        (F.array_contains(types, "ScreeningEvent") | F.array_contains(types, "MovieTheater")).alias("has_screenings"), F.col("api_status").isin(200, 401, 403).alias("has_api"),
    )
