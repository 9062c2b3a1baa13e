"""Quarantine: offending rows with evidence, appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import row_fingerprint

EVIDENCE = ("dataset", "suite", "expectation", "run_ts", "checkpoint_id", "source_version", "owner", "row_fingerprint")


def evidence(offenders: DataFrame, meta: dict) -> DataFrame:
    """Offending rows (with `expectation`) and the evidence columns; a source column of such a name is an error."""
    source = [c for c in offenders.columns if c != "expectation"]
    if clash := set(source) & (set(EVIDENCE) - {"expectation"}):
        raise ValueError(f"source has evidence columns: {sorted(clash)}")
    given = {k: F.lit(meta.get(k)).cast(t) for k, t in (("dataset", "string"), ("suite", "string"), ("run_ts", "long"), ("checkpoint_id", "string"), ("source_version", "long"), ("owner", "string"))}
    return offenders.withColumns(given | {"row_fingerprint": row_fingerprint(*source)}).select(*source, *EVIDENCE)


def new_rows(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of the batch whose fingerprint isn't stored yet; duplicates inside the batch stay."""
    return batch.join(stored.select("row_fingerprint").distinct(), "row_fingerprint", "left_anti")


def still_in_source(quarantined: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Quarantined rows whose key the source still holds."""
    return quarantined.join(source.select(key).distinct(), key, "left_semi")


def totals(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """new: rows appended; total: distinct fingerprints stored before, and the new rows."""
    added = new_rows(batch, stored).agg(F.count(F.lit(1)).alias("added"))
    before = stored.agg(F.count_distinct("row_fingerprint").alias("before"))
    return added.crossJoin(before).select("added", (F.col("before") + F.col("added")).alias("total"))  # one row each
