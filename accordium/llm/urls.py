"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for what no rule decides.

The labelled URLs are those that a rule decides. Label shares of suffixes are counted over all distinct ones and joined to the
pages; a bounded sample of them is what the trees are fitted on.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import Trees, sigmoid
from .common import slices, written

#: Fixed values: (verdict, host, path); a rule also holds for subdomains and for paths that go on.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Rules are part of the plan, one expression each; a longer list must be joined as a table instead.
MOST_RULES = 500
SAMPLE_ROWS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first :// up to a slash, question mark, hash or the end, A-Z lower-cased; then up to ? or #."""
    known = url.isNotNull() & (F.instr(url, "://") > 0)
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(known, F.translate(host, UPPER, LOWER)).otherwise(""), F.when(known, path).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(length, rule, verdict); null without one."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in rules]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length: int, rule: string, verdict: string>")


def suffixes(url: str) -> tuple[str, str, str]:
    """Last label of the host, last two, and the first step of the path."""
    rest = url.split("://", 1)[1] if "://" in url else url
    host, _, path = rest.partition("/")
    labels = host.split("?")[0].split("#")[0].lower().split(".")
    return labels[-1], ".".join(labels[-2:]), "/" + path.split("/")[0].split("?")[0].split("#")[0]


def features(urls: list[str | None], shares: np.ndarray) -> np.ndarray:
    """Length, depth, digits, entropy, parameters, and, as given, the label's share and logged count for each suffix."""
    out = np.zeros((len(urls), 14))
    for i, url in enumerate(urls):
        url = url or ""
        n = max(1, len(url))
        rest = url.split("://", 1)[-1]
        host, _, path = rest.partition("/")
        counts = Counter(url)
        out[i, :8] = (len(url), path.count("/"), sum(map(str.isdigit, url)) / n, -sum(c / n * log2(c / n) for c in counts.values()), url.count("="), url.count("&") + url.count("?"), len(host), host.count(".") + 10 * host.count("-"))
    out[:, 8:] = shares
    return out


def _with_suffixes(rows: DataFrame) -> DataFrame:
    """rows with s0, s1 and s2, the suffixes of their url; a null url is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column("url").to_pylist()
            for a, b in slices([u and u.encode() for u in urls]):
                found = [suffixes(u or "") for u in urls[a:b]]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array([f[k] for f in found], pa.string()) for k in range(3))], names=[*part.schema.names, "s0", "s1", "s2"])

    return rows.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", s0 string, s1 string, s2 string")


def _with_shares(rows: DataFrame, sums: DataFrame, base: float) -> DataFrame:
    """rows with `shares`: the smoothed share of allow and the logged count of each suffix; (base, 0) for one that no labelled URL has."""
    rows = _with_suffixes(rows)
    for k in range(3):
        own = sums.where(F.col("k") == k).select(F.col("suffix").alias(f"s{k}"), ((F.col("allowed") + 5 * base) / (F.col("n") + 5)).alias(f"a{k}"), F.log1p("n").alias(f"n{k}"))
        rows = rows.join(own, f"s{k}", "left")
    shares = F.array(*(x for k in range(3) for x in (F.coalesce(f"a{k}", F.lit(base)), F.coalesce(f"n{k}", F.lit(0.0)))))
    return rows.withColumn("shares", shares).drop(*(f"{c}{k}" for c in "san" for k in range(3)))


def train(pages: DataFrame, rules: Sequence[tuple[str, str, str]], sample_rows: int = SAMPLE_ROWS):
    """Sums by suffix over all URLs that rules decide, as a table, their share of allow, and trees from a sample; label 1 is allow."""
    host, path = host_and_path(F.col("url"))
    known = pages.select("url").where("url is not null").distinct().select("url", rule_of(host, path, rules)["verdict"].alias("verdict")).where("verdict is not null")
    known = written(known.select("url", (F.col("verdict") == "allow").cast("int").alias("y")), "labelled")
    total = known.agg(F.coalesce(F.sum("y"), F.lit(0)).alias("y"), F.count(F.lit(1)).alias("n")).first()
    base = (total.y + 1) / (total.n + 2)
    each = _with_suffixes(known).select("y", F.posexplode(F.array("s0", "s1", "s2")).alias("k", "suffix"))
    sums = written(each.groupBy("k", "suffix").agg(F.sum("y").alias("allowed"), F.count(F.lit(1)).alias("n")), "suffixes")
    rows = sorted((r.url, r.y, r.shares) for r in _with_shares(known.orderBy(F.xxhash64("url"), "url").limit(sample_rows), sums, base).collect())
    x = features([r[0] for r in rows], np.array([r[2] for r in rows]).reshape(-1, 6))
    return sums, base, Trees(depth=3, rounds=50).fit(x, np.array([r[1] for r in rows], np.float64))


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict, score; one row for each row of pages.

    pages needs page_id and url; other columns are ignored, whatever their names. A null url, or one without ://, has an empty
    host and path, so no rule fits; the trees judge it by what text there is. The longest rule wins; of rules of one length the
    last in order. score is the probability of allow that the trees give; without labelled URLs, or with one label only, it is
    the smoothed share of allow. Repeated rows are judged alike. An empty table gives an empty result.
    """
    sums, base, trees = train(pages, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, shares = batch.column(1).to_pylist(), np.array(batch.column(2).to_pylist()).reshape(-1, 6)
            for a, b in slices([u and u.encode() for u in urls]):
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:2]), pa.array(sigmoid(trees.raw(features(urls[a:b], shares[a:b]))), pa.float64())], names=["page_id", "url", "score"])

    judged = _with_shares(pages.select("page_id", "url"), sums, base).select("page_id", "url", "shares").mapInArrow(run, f"page_id {dict(pages.dtypes)['page_id']}, url string, score double")
    host, path = host_and_path(F.col("url"))
    out = judged.select("page_id", host.alias("host"), path.alias("path"), "score").withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", F.when(F.col("score") >= 0.5, "allow").otherwise("block")).alias("verdict"), "score")
