"""Release metadata: operation flags and their rates by class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborspark.functions.text import to_bool

# Operation flags of the metadata sheet.
OPERATIONS = ("remove_soma_branches_automatically", "prun_soma_region", "Multifurcation_Binarization", "Assign_synapse")


def clean_metadata(sheet: DataFrame, flags: Sequence[str] = OPERATIONS) -> DataFrame:
    """Unnamed columns dropped, flags as 0/1, missing class as Unknown."""
    kept = [c for c in sheet.columns if not c.startswith("Unnamed")]
    out = sheet.select(*kept).withColumns({f: to_bool(F.col(f)).cast("int") for f in flags})
    return out.withColumn("classify", F.coalesce(F.col("classify").cast("string"), F.lit("Unknown")))


def operation_rates(cleaned: DataFrame, flags: Sequence[str] = OPERATIONS) -> DataFrame:
    """Files per class and the share of each operation in percent."""
    return cleaned.groupBy("classify").agg(
        F.count(F.lit(1)).alias("files"), *[(F.avg(f) * 100).alias(f) for f in flags]
    )


def operation_totals(cleaned: DataFrame, flags: Sequence[str] = OPERATIONS) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(f).alias("operation"), F.col(f).alias("n")) for f in flags])
    sums = cleaned.agg(F.count(F.lit(1)).alias("files"), *[F.sum(f).alias(f) for f in flags])
    return sums.select("files", F.inline(rows)).withColumn("percent", F.col("n") * 100.0 / F.col("files"))
