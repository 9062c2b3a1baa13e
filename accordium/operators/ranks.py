"""Exact ranks without sorting a group: counts of buckets say in which one a rank lies, and only that one is looked at again.

Each pass is one aggregate with partial sums, whose state is bounded by groups x buckets; a hot group is counted in all tasks at
once. What a pass leaves is a small part of the one before, so few passes do for any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import small, written

#: Rows of a bucket that are looked at one by one in the end.
FEW = 4_096
#: Groups whose brackets are broadcast.
BROADCAST_GROUPS = 10_000
#: Digits of a hash that make a bucket: 4,096 buckets.
DIGITS = 3
#: Points that split a bracket of values, each about as frequent as the next; and how exact they are.
SPLITS, ACCURACY = 32, 1_000


def least_by_hash(df: DataFrame, group: str, order: Column, take: Column) -> DataFrame:
    """The rows of df with the least `order` in each group, null being one: as many as `take` says, a column over n, the group's rows.

    order is a text of hexadecimal digits that all have the same length, as a sha256 has. Its first digits make buckets; the one
    that holds the last row taken is split by the next digits, until it has few rows, and its hashes are compared. Rows with
    equal hashes at that limit are interchangeable: as many are taken as fit. A null order is never taken, but counts in n.
    """
    g, h, n, upto, ties = (f"__rank_{x}" for x in ("group", "hash", "n", "upto", "ties"))
    rows = df.withColumn(h, order)
    keyed = rows.select(F.col(group).alias(g), h)

    def bucket(brackets: DataFrame, part: Column) -> DataFrame:
        """The counts by `part` within the brackets' prefixes."""
        near = small(written(brackets.select(F.col(g).alias("__g"), "prefix", "k")), BROADCAST_GROUPS)
        inside = keyed.join(near, F.col(g).eqNullSafe(F.col("__g")) & F.col(h).startswith(F.col("prefix")))
        counted = inside.groupBy(g, "k", part.alias("p")).agg(F.count(F.lit(1)).alias("c"))
        return counted.groupBy(g, "k").agg(F.array_sort(F.collect_list(F.struct("p", "c"))).alias("b"))

    sizes = keyed.groupBy(g, F.left(h, F.lit(DIGITS)).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    first = sizes.groupBy(g).agg(F.sum("c").alias(n), F.array_sort(F.collect_list(F.when(F.col("p").isNotNull(), F.struct("p", "c")))).alias("b"))
    open_ = written(_narrowed(first.withColumn("k", F.least(take.cast("long"), F.coalesce(F.aggregate("b", F.lit(0).cast("long"), lambda s, x: s + x.c), F.lit(0)))).where("k > 0"), g))
    digits, limits = DIGITS, None
    while True:
        done = open_.where("whole").select(g, F.col("prefix").alias(upto), F.lit(None).cast("long").alias(ties))
        limits = done if limits is None else limits.unionByName(done)
        split = ~F.col("whole") & (F.col("c") > FEW) & F.lit(digits < 64)
        found = bucket(open_.where(~F.col("whole") & ~split), F.col(h))  # FEW hashes at most
        limits = limits.unionByName(_narrowed(found, g).select(g, F.col("prefix").alias(upto), F.when(~F.col("whole"), F.col("k")).alias(ties)))
        more = open_.where(split)
        if more.isEmpty():
            break
        digits += DIGITS
        open_ = written(_narrowed(bucket(more, F.left(h, F.lit(digits))), g))
    limits = written(limits)
    kept = rows.join(small(limits, BROADCAST_GROUPS), F.col(group).eqNullSafe(F.col(g)))
    head = F.left(h, F.length(upto))
    if limits.where(F.col(ties).isNotNull()).isEmpty():
        return kept.where(head <= F.col(upto)).select(df.columns)
    least = kept.where((head < F.col(upto)) | ((head == F.col(upto)) & F.col(ties).isNull())).select(df.columns)
    # only rows with equal hashes are numbered, and Spark cuts their ranks before it shuffles
    equal = kept.where((head == F.col(upto)) & F.col(ties).isNotNull())
    placed = equal.withColumn(n, F.row_number().over(Window.partitionBy(g).orderBy(h))).where(F.col(n) <= F.col(ties))
    return least.unionByName(placed.select(df.columns))


def _narrowed(found: DataFrame, g: str) -> DataFrame:
    """group, prefix, k, c, whole: the bucket of b (prefixes and counts, ascending) that holds the k-th row, which it is in there,
    the bucket's rows, and whether all of them are taken."""
    start = F.struct(F.col("k").alias("k"), F.lit("").alias("prefix"), F.lit(0).cast("long").alias("c"))

    def step(s: Column, x: Column) -> Column:
        passed = s.c > 0  # the bucket is found
        here = s.k <= x.c
        return F.when(passed, s).when(here, F.struct(s.k.alias("k"), x.p.alias("prefix"), x.c.alias("c"))).otherwise(F.struct((s.k - x.c).alias("k"), s.prefix.alias("prefix"), s.c.alias("c")))

    at = found.select(g, F.aggregate("b", start, step).alias("at"))
    return at.select(g, "at.prefix", "at.k", "at.c", (F.col("at.k") == F.col("at.c")).alias("whole"))


def order_statistics(df: DataFrame, by: str, value: str, ranks: dict[str, Column]) -> DataFrame:
    """by, runs, and for each name the value at that rank, which is a column over `runs`, the group's values; null and NaN are none.

    Points taken from an approximate summary split a group's values; exact counts below and at each say which two a rank lies
    between, or that it is at one. Brackets with more than FEW rows are split again. A rank below 1 is 1, one beyond runs is runs.
    """
    kind = dict(df.dtypes)[value]
    v = F.col(f"`{value}`")
    clean = df.where(v.isNotNull() & ~F.isnan(v.cast("double")) if kind in ("double", "float") else v.isNotNull()).select(F.col(f"`{by}`").alias("g"), v.alias("v"))
    shares = [i / SPLITS for i in range(SPLITS + 1)]

    def points(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("runs"), F.array_sort(F.array_distinct(F.percentile_approx("v", shares, ACCURACY))).alias("s"))

    def counted(rows: DataFrame, *keys: str) -> DataFrame:
        """How many values lie below each point, and at it: positions 2i between two points, 2i + 1 at a point."""
        at = 2 * F.size(F.filter("s", lambda s: s < F.col("v"))) + F.array_contains("s", F.col("v")).cast("int")
        return rows.groupBy(*keys, at.alias("at")).agg(F.count(F.lit(1)).alias("c")).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "c"))).alias("b"))

    def located(found: DataFrame) -> DataFrame:
        """g, name, runs, k, low, high, done: the bracket of a rank, which one it is there, and the value where it is a point."""
        start = F.struct(F.col("k").alias("k"), F.lit(-1).alias("at"), F.lit(0).cast("long").alias("c"))

        def step(s: Column, x: Column) -> Column:
            return F.when(s.at >= 0, s).when(s.k <= x.c, F.struct(s.k.alias("k"), x["at"].alias("at"), x.c.alias("c"))).otherwise(F.struct((s.k - x.c).alias("k"), s["at"].alias("at"), s.c.alias("c")))

        x = found.select("g", "name", "runs", "s", F.aggregate("b", start, step).alias("x")).withColumn("i", F.floor(F.col("x.at") / 2).cast("int"))
        low, high = F.try_element_at("s", F.nullif("i", F.lit(0))), F.try_element_at("s", F.col("i") + 1)
        return x.select("g", "name", "runs", F.col("x.k").alias("k"), F.col("x.c").alias("c"), low.alias("low"), high.alias("high"), F.when(F.col("x.at") % 2 == 1, high).alias("done"))

    asked = F.array(*(F.struct(F.lit(name).alias("name"), F.greatest(F.lit(1), F.least(F.col("runs"), rank.cast("long"))).alias("k")) for name, rank in ranks.items()))
    first = written(points(clean, "g"))
    seen = clean.join(small(first.select(F.col("g").alias("__g"), "s"), BROADCAST_GROUPS), F.col("g").eqNullSafe(F.col("__g")))
    counts = counted(seen, "g")
    each = first.select("g", "runs", "s", F.inline(asked)).join(counts.withColumnRenamed("g", "__g"), F.col("g").eqNullSafe(F.col("__g"))).drop("__g")
    open_ = written(located(each))
    done = open_.where("done is not null").select("g", "name", "runs", F.col("done").alias("value"))
    open_ = open_.where("done is null")

    def inside(brackets: DataFrame) -> DataFrame:
        b = small(written(brackets.select(F.col("g").alias("__g"), "name", "runs", "k", "low", "high")), BROADCAST_GROUPS)
        return clean.join(b, F.col("g").eqNullSafe(F.col("__g")) & (F.col("low").isNull() | (F.col("v") > F.col("low"))) & (F.col("high").isNull() | (F.col("v") < F.col("high")))).drop("__g", "low", "high")

    while True:
        last = inside(open_.where(F.col("c") <= FEW)).groupBy("g", "name", "runs", "k").agg(F.array_sort(F.collect_list("v")).alias("x"))
        done = done.unionByName(last.select("g", "name", "runs", F.element_at("x", F.col("k").cast("int")).alias("value")))
        more = open_.where(F.col("c") > FEW)
        if more.isEmpty():
            break
        rows = inside(more)
        s = written(points(rows, "g", "name").drop("runs"))
        rows = rows.join(small(s.withColumnsRenamed({"g": "__g", "name": "__name"}), BROADCAST_GROUPS), F.col("g").eqNullSafe(F.col("__g")) & (F.col("name") == F.col("__name"))).drop("__g", "__name")
        both = counted(rows, "g", "name", "runs", "k", "s")
        open_ = written(located(both))
        done = done.unionByName(open_.where("done is not null").select("g", "name", "runs", F.col("done").alias("value")))
        open_ = open_.where("done is null")
    return done.groupBy(F.col("g").alias(by), "runs").agg(*(F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in ranks))
