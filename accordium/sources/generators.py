"""Synthetic customers and transactions from spark.range, the same for a seed, and bad rows of known kinds.

Every value is a function of the seed, the row's number and the column, so that partitions and retries change nothing.
"""

from __future__ import annotations

import functools
import math
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows by country and by currency.
COUNTRIES = {"US": 30_000, "GB": 8_000, "DE": 5_000, "FR": 3_000, "IN": 2_500, "JP": 1_000, "CA": 450, "AU": 50}
CURRENCIES = {"USD": 140_000, "EUR": 24_000, "GBP": 16_000, "JPY": 10_000, "CAD": 5_000, "AUD": 3_000, "INR": 1_960, "CHF": 40}
EVENTS = {"AUTHORIZED": 30, "CAPTURED": 30, "SETTLED": 30, "REFUNDED": 7, "REVERSED": 3}
START, DAY = 1_735_689_600_000, 86_400_000


def uniform(seed: int, name: str) -> Column:
    """0 to 1, by seed, column and row number (`id`)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(name), "id"), F.lit(1 << 53)) / float(1 << 53)


def between(seed: int, name: str, low: int, high: int) -> Column:
    return F.floor(uniform(seed, name) * (high - low)).cast("long") + low


def chosen(seed: int, name: str, weights: dict[str, int]) -> Column:
    """A weighted choice: the first name whose running share isn't below the draw."""
    total, run, out = sum(weights.values()), 0, F.lit(list(weights)[-1])
    steps = []
    for k, w in weights.items():
        run += w
        steps.append((k, run / total))
    for k, upto in reversed(steps):
        out = F.when(uniform(seed, name) < upto, k).otherwise(out)
    return out


def quotas(weights: dict[str, int], n: int) -> dict[str, int]:
    """n rows dealt by weights: each share rounded down, what is left to the largest remainders, first names first."""
    total = sum(weights.values())
    out = {k: n * w // total for k, w in weights.items()}
    for k in sorted(weights, key=lambda k: -(n * weights[k] % total))[: n - sum(out.values())]:
        out[k] += 1
    return out


def permuted(seed: int, name: str, n: int) -> Column:
    """A permutation of row numbers (`id`) from 0 to n - 1, by seed and name: a row's place is known without any other row.

    Affine steps, which reach every place, take turns with rounds of a Feistel network over pairs, which mix; each is a one-to-one
    map of all places, so the whole is.
    """
    wide = max(1, math.isqrt(n))
    high = n // wide  # pairs cover wide * high places; the last few only take the affine steps
    draw = random.Random(f"{seed}/{name}")

    def affine(x: Column) -> Column:
        a = draw.randrange(1, min(max(2, n), 1 << 31))
        while math.gcd(a, n) > 1:
            a += 1
        return F.pmod(x * F.lit(a).cast("long") + F.lit(draw.randrange(max(1, n))).cast("long"), F.lit(n).cast("long"))

    def mixed(x: Column, k: int) -> Column:
        left, right = F.floor(x / F.lit(wide)).cast("long"), F.pmod(x, F.lit(wide).cast("long"))
        left = F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), F.lit(f"{name}.l{k}"), right), F.lit(high).cast("long")), F.lit(high).cast("long"))
        right = F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), F.lit(f"{name}.r{k}"), left), F.lit(wide).cast("long")), F.lit(wide).cast("long"))
        return F.when(x < wide * high, left * wide + right).otherwise(x)

    if n >= 1 << 31:
        raise ValueError("row numbers beyond 31 bits aren't permuted")
    return affine(F.transform(F.array(affine(F.transform(F.array(affine(F.col("id"))), lambda x: mixed(x, 0))[0])), lambda x: mixed(x, 1))[0])


def dealt(seed: int, name: str, weights: dict[str, int], n: int) -> Column:
    """One of the names for each of n rows, so that each has exactly its quota."""
    run, steps = 0, []
    for k, c in quotas(weights, n).items():
        run += c
        steps.append((k, run))
    pick = lambda x: functools.reduce(lambda out, s: F.when(x < s[1], s[0]).otherwise(out), reversed(steps), F.lit(None).cast("string"))
    return F.transform(F.array(permuted(seed, name, n)), pick)[0]


def beta_2_8(seed: int, name: str) -> Column:
    """A draw of the beta distribution with 2 and 8: the second least of nine uniform draws."""
    return F.array_sort(F.array(*(uniform(seed, f"{name}.{i}") for i in range(9))))[1]


def normal(seed: int, name: str) -> Column:
    """Box and Muller's transform of two draws."""
    return F.sqrt(-2 * F.log(F.greatest(uniform(seed, name + ".r"), F.lit(1e-12)))) * F.cos(2 * F.pi() * uniform(seed, name + ".a"))


def kept(seed: int, name: str, share: float, value: Column) -> Column:
    return F.when(uniform(seed, name + ".kept") < share, value)


def conform(df: DataFrame, fields: Sequence[tuple[str, bool]]) -> DataFrame:
    """Exactly the contract's fields (name, nullable): an unknown one is null where it may be, else an error."""
    if unknown := [n for n, nullable in fields if n not in df.columns and not nullable]:
        raise ValueError(f"no generator for {unknown}, which can't be null")
    return df.select(*(F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n, _ in fields))


def customers(spark: SparkSession, n: int, seed: int) -> DataFrame:
    created = F.lit(START) - between(seed, "created", 0, 365 * DAY)
    number = F.col("id") + 1
    name = F.concat(F.lit("user"), number.cast("string"))
    rows = spark.range(n)
    return rows.select(
        F.format_string("CUST-%06d", number).alias("customer_id"), F.concat(name, F.lit("@example.com")).alias("email"),
        F.format_string("%03d-%02d-%04d", between(seed, "ssn1", 100, 900), between(seed, "ssn2", 10, 100), between(seed, "ssn3", 1000, 10_000)).alias("ssn"),
        F.initcap(name).alias("full_name"), dealt(seed, "country", COUNTRIES, n).alias("country"), created.alias("created_at"), kept(seed, "updated", 0.4, created + between(seed, "updated", 0, 30 * DAY)).alias("updated_at"),
    )


def transactions(spark: SparkSession, n: int, people: int, seed: int) -> DataFrame:
    created, who = F.lit(START) + between(seed, "created", 0, 90 * DAY), between(seed, "customer", 1, people + 1)
    rows = spark.range(n).select("id", dealt(seed, "currency", CURRENCIES, n).alias("currency"), chosen(seed, "event", EVENTS).alias("event_type"))
    drawn = F.least(F.round(F.when(F.col("currency") == "JPY", 5000.0).otherwise(4000.0) * F.exp(normal(seed, "amount"))).cast("long"), F.lit(50_000_000))
    amount = F.when(uniform(seed, "verified") < 0.005, F.lit(0).cast("long")).otherwise(drawn)  # a card is only verified
    status = F.when(uniform(seed, "pending") < 0.03, "PENDING").otherwise(F.col("event_type"))
    hexes = F.sha2(F.concat_ws("|", F.lit(seed), "id"), 256)
    uuid4 = F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.concat(F.lit("4"), F.substring(hexes, 14, 3)), F.concat(F.lit("8"), F.substring(hexes, 18, 3)), F.substring(hexes, 21, 12))
    return rows.select(
        uuid4.alias("transaction_id"), F.format_string("M-%05d", between(seed, "merchant", 1, 301)).alias("merchant_id"), F.format_string("CUST-%06d", who).alias("customer_id"), amount.alias("amount_minor"), "currency",
        status.alias("status"), "event_type", (created + between(seed, "event_ts", 0, 5000)).alias("event_ts"), created.alias("created_at"), kept(seed, "updated", 0.5, created + between(seed, "updated", 0, 3 * DAY)).alias("updated_at"),
        kept(seed, "risk", 0.7, beta_2_8(seed, "risk")).alias("risk_score"), kept(seed, "receipt", 0.6, F.format_string("user%d@example.com", who)).alias("receipt_email"),
    )


def with_bad_rows(df: DataFrame, donors: DataFrame, changes: Sequence[dict[str, Column]]) -> DataFrame:
    """df and, for each row of donors and each change, a copy with the change's columns replaced; all columns of df, in its order."""
    bad = [donors.select(*((change[c].cast(t).alias(c) if c in change else F.col(c)) for c, t in df.dtypes)) for change in changes]
    for rows in bad:
        df = df.unionByName(rows)
    return df
