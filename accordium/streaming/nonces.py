"""A guard of nonces as a stream's state: the second use of a nonce under one key is refused, whichever batch or run it comes in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: What is remembered of a nonce: the row that used it first.
STATE = "first string"


def _judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames), ignore_index=True)
    rows = rows.sort_values("row", kind="stable")
    if state.exists:
        (first,) = state.get
        refused = [True] * len(rows)
    else:
        first = rows["row"].iloc[0]
        state.update((first,))
        refused = [False] + [True] * (len(rows) - 1)
    yield pd.DataFrame({"row": rows["row"], "key_id": key[0], "nonce": key[1], "first": first, "refused": refused})


def guarded(uses: DataFrame) -> DataFrame:
    """row, key_id, nonce, first, refused of a stream of uses(row, key_id, nonce), as texts: all but the first use of a nonce under a
    key are refused, and say which row was first. Within a batch the least row counts as first.

    State is kept for each key and nonce, so that a key used for a third of all rows is spread as its nonces are. It is kept for
    ever: a nonce never gets free. Rows without a key or nonce are refused (they hold no state).
    """
    texts = uses.select(*(F.col(c).cast("string").alias(c) for c in ("row", "key_id", "nonce")))
    whole = texts.where("key_id is not null and nonce is not null").withColumn("row", F.coalesce("row", F.lit("")))
    judged = whole.groupBy("key_id", "nonce").applyInPandasWithState(_judge, "row string, key_id string, nonce string, first string, refused boolean", STATE, "append", GroupStateTimeout.NoTimeout)
    return judged.unionByName(texts.where("key_id is null or nonce is null").select("row", "key_id", "nonce", F.lit(None).cast("string").alias("first"), F.lit(True).alias("refused")))


def encrypted_uses(sealed: DataFrame, row: str, column: str, key_id: str) -> DataFrame:
    """The uses in a column of encrypted values (enc:v1:nonce:...); plain values are none."""
    return sealed.where(F.col(column).startswith("enc:v1:")).select(F.col(row).cast("string").alias("row"), F.col(key_id).cast("string").alias("key_id"), F.split(column, ":")[2].alias("nonce"))


def guard_once(uses: DataFrame, out: str, checkpoint: str) -> None:
    """Judges the uses that are there now, before anything is written with them; a later run knows those of earlier ones."""
    guarded(uses).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
