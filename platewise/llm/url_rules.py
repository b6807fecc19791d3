"""Allow and block rules on hosts and paths, found by a sorted sweep.

A host becomes a key of reversed labels (``com.example.www.``), so that the keys of a host and of all its subdomains
form one interval. Urls and rules are sorted together by key and cut into blocks; in each block a sweep keeps the
stack of rules whose interval is open. A rule that opened in an earlier block and is still open at a block's first
key belongs to an ancestor of that key, so it is found by an equality join of a few ancestors per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.session import new_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _sweep(table: pa.Table) -> pa.Table:
    """Rows of a block to rows of urls with the longest fitting rule."""
    rows = sorted(
        zip(*(table.column(c).to_pylist() for c in ("host_key", "is_url", "host", "path", "verdict", "key", "row"))),
        key=lambda r: (r[0], r[1]),
    )
    stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []
    out: list[tuple] = []
    for host_key_, is_url, host, path, verdict, key, _ in rows:
        while stack and not host_key_.startswith(stack[-1][0]):
            stack.pop()
        if not is_url:
            if not stack or stack[-1][0] != host_key_:
                stack.append((host_key_, {}, []))
            paths = stack[-1][1]
            known = paths.get(path)
            if known is None or verdict == "block":
                paths[path] = (host + path, verdict)
            stack[-1][2][:] = sorted({len(p) for p in paths}, reverse=True)
            continue
        best = None
        for _, paths, lengths in stack:
            for n in lengths:
                found = paths.get(path[:n]) if n <= len(path) else None
                if found:
                    if best is None or len(found[0]) >= len(best[0]):
                        best = found
                    break
        out.append((key, host, path, *(best or (None, None))))
    names = ["key", "host", "path", "rule", "verdict"]
    kinds = [table.schema.field("key").type, *[pa.string()] * 4]
    return pa.table([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)], names=names)


def match_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow", rows_per_block: int = 50_000
) -> DataFrame:
    """Columns: the key, ``host``, ``path``, ``rule`` (host and path of the longest fitting rule, or null), ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host and all subdomains if the
    url's path starts with the rule's. Of two rules as long, the one on the longer host wins; of two that are equal,
    block wins. A rule without host fits nothing, one without path has the empty path. A null url, or one without
    ``://``, has an empty host and path and takes the default. One row per row of ``pages``; other columns are not read.
    """
    spark = pages.sparkSession
    urls = pages.select(
        F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.lit(None).cast("string").alias("verdict"), F.lit(True).alias("is_url")
    )
    rules = rules.where(F.col("host").isNotNull() & F.col("verdict").isin("allow", "block")).select(
        F.lit(None).cast(pages.schema[key].dataType).alias("key"),
        F.translate("host", _UPPER, _UPPER.lower()).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "verdict",
        F.lit(False).alias("is_url"),
    ).dropDuplicates(["host", "path", "verdict"])
    events = urls.unionByName(rules).withColumn("host_key", host_key(F.col("host")))
    n = max(1, -(-pages.count() // rows_per_block))
    # A random last key splits a host, or a url, that holds a large share of the rows.
    cut = (
        events.withColumn("row", F.when(F.col("is_url"), F.rand(7)).otherwise(F.lit(-1.0)))
        .repartitionByRange(n, "host_key", "is_url", "path", "row")
        .withColumn("block", F.spark_partition_id())
    )
    path = new_path(spark, "url-blocks")
    cut.write.parquet(path)  # fixes which row is in which block
    blocks = spark.read.schema(cut.schema).parquet(path)
    heads = blocks.groupBy("block").agg(F.min("host_key").alias("head"))
    labels = F.filter(F.split("head", r"\."), lambda x: x != "")
    ancestors = heads.select(
        "block", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))), lambda i: F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit(".")))).alias("host_key")
    )
    placed = blocks.where(~F.col("is_url"))
    carried = ancestors.join(placed.drop("block"), "host_key").select(*blocks.columns)
    kinds = f"key {pages.schema[key].dataType.simpleString()}, host string, path string, rule string, verdict string"
    found = blocks.unionByName(carried).groupBy("block").applyInArrow(_sweep, kinds)
    return found.select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
