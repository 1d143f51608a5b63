"""Sinks (SNK-*)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text


_ZERO = {"string": "", "bigint": 0, "int": 0, "double": 0.0, "boolean": False}


def _present(c: str, kind: str) -> Column:
    """A column's value, null if it is zero or empty."""
    if kind in _ZERO:
        return F.nullif(F.col(f"`{c}`"), F.lit(_ZERO[kind]))
    return F.when(F.size(f"`{c}`") > 0, F.col(f"`{c}`")) if kind.startswith(("array", "map")) else F.col(f"`{c}`")


def without_zeros(df: DataFrame) -> DataFrame:
    """Zero and empty values as null, which JSON output leaves out."""
    return df.select(*(_present(c, k).alias(c) for c, k in df.dtypes))


def json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """SNK-01; SNK-02 with append."""
    without_zeros(df).write.mode("append" if append else "overwrite").json(path)


def by_column(df: DataFrame, path: str, column: str) -> None:
    """SNK-03, SNK-04: a folder for each value (kind, language name)."""
    df.write.mode("overwrite").partitionBy(column).json(path)


def object_key(project: Column, crawl: Column, url: Column) -> Column:
    """SNK-06: {project}/{crawl}/{sha256(url)}.json."""
    return F.concat_ws("/", project, crawl, F.concat(F.sha2(F.encode(url, "UTF-8"), 256), F.lit(".json")))


def pages(df: DataFrame, path: str) -> None:
    """SNK-05: pages of each crawl, appended; a page crawled again is kept twice."""
    df.write.mode("append").partitionBy("crawl_id").json(path)


def upserted(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """SNK-06: the new row of a key in place of the old one."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def batches(df: DataFrame, size: int = 100) -> Iterator[list]:
    """SNK-07: rows in batches, one partition at a time on the driver; the last batch may be short."""
    out: list = []
    for row in df.toLocalIterator():
        out.append(row)
        if len(out) == size:
            yield out
            out = []
    if out:
        yield out


def report(df: DataFrame, **metrics: Column) -> DataFrame:
    """SNK-09: (metric, value) rows of text."""
    one = df.agg(*(c.cast("string").alias(k) for k, c in metrics.items()))
    return one.unpivot([], list(metrics), "metric", "value").select("metric", text(F.col("value")).alias("value"))


def to_path(df: DataFrame, url: str, kind: str = "parquet") -> None:
    """SNK-08: an upload is a write to a path of the object store."""
    df.write.mode("overwrite").format(kind).save(url)


def camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(x.capitalize() for x in rest)


def wire_json(df: DataFrame) -> Column:
    """JSON-07: a row as JSON text of the wire form: camel-case names, 64-bit integers as text, zero values left out."""
    cols = [(_present(c, k).cast("string") if k == "bigint" else _present(c, k)).alias(camel(c)) for c, k in df.dtypes]
    return F.to_json(F.struct(*cols))


def from_wire_json(c: Column, df: DataFrame) -> list[Column]:
    """JSON-07, back: the columns of df's schema from that text; what was left out is null."""
    kinds = ", ".join(f"{camel(n)} {'string' if k == 'bigint' else k}" for n, k in df.dtypes)
    parsed = F.from_json(c, kinds)
    return [parsed[camel(n)].cast(k).alias(n) for n, k in df.dtypes]
