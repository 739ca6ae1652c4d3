"""Metadata, synapse and mesh files, CSV logs and resumable outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborspark.functions.text import stem
from arborspark.operators import ordering
from arborspark.sources.swc import SPLIT_COLUMNS, line_order


def read_soma_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated soma list; ids stay text so that no digit is lost.  ``row_idx`` keeps the order of the list."""
    raw = spark.read.option("header", "true").option("sep", "\t").csv(path).select("*", "_metadata.file_block_start")
    number = [F.col(f"soma_{a}").try_cast("double").alias(f"soma_{a}") for a in "xyz"]
    keep = ["nucleus_id"] if "nucleus_id" in raw.columns else []
    return raw.select(F.regexp_replace("root_id", r"\.0+$", "").alias("root_id"), *keep, *number, line_order().alias("row_idx"))


def read_synapses(spark: SparkSession, path: str, syn_type: str) -> DataFrame:
    """Synapse text files (five or more columns, 3-5 are x y z in nm); the decoded file stem
    is the neuron.  Lines that begin with # are comments; files with unreadable
    rows contribute their readable ones."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        *SPLIT_COLUMNS
    )
    fields = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    out = lines.select(stem(F.url_decode("file_path")).alias("neuron"), line_order().alias("syn_index"), fields.alias("f"))
    number = [F.try_element_at("f", F.lit(i)).try_cast("double").alias(a) for i, a in zip((3, 4, 5), "xyz")]
    typed = out.filter((F.size("f") >= 5) & ~F.col("f")[0].startswith("#")).select("neuron", F.lit(syn_type).alias("syn_type"), "syn_index", *number)
    return typed.dropna(subset=["x", "y", "z"])


def read_obj_meshes(spark: SparkSession, path: str, key: str = "region") -> DataFrame:
    """Face table of OBJ files; polygons are cut into triangle fans.

    Vertex numbers count the ``v`` lines of a file, so vertices are numbered by a
    running count and joined to the faces; negative ones count back from the face.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[oO][bB][jJ]").text(path).select(
        *SPLIT_COLUMNS
    )
    fields = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    rows = lines.select(stem(F.url_decode("file_path")).alias(key), line_order().alias("at"), fields.alias("f")).filter(F.col("f")[0].isin("v", "f"))
    rows = ordering.running(rows, [key], ["at"], {"n": F.when(F.col("f")[0] == "v", 1).otherwise(0)})
    number = lambda i: F.try_element_at("f", F.lit(i)).try_cast("double")
    v = rows.filter(F.col("f")[0] == "v").select(key, "n", *[number(i).alias(a) for i, a in zip((2, 3, 4), "xyz")])
    corners = F.transform(F.slice("f", 2, F.size("f")), lambda t: F.regexp_extract(t, r"^-?\d+", 0).cast("bigint"))
    f = rows.filter(F.col("f")[0] == "f").select(key, "at", F.transform(corners, lambda c: F.when(c < 0, F.col("n") + 1 + c).otherwise(c)).alias("c"))
    fans = f.select(key, "at", F.col("c")[0].alias("u"), F.posexplode(F.slice("c", 2, F.size("c"))).alias("i", "v"), "c")
    tri = fans.filter(F.col("i") + 2 < F.size("c")).select(
        key, F.shiftleft("at", 20).bitwiseOR(F.col("i")).alias("face_id"), "u", "v", F.col("c")[F.col("i") + 2].alias("w")
    )
    for corner in "uvw":
        place = v.select(key, F.col("n").alias(corner), *[F.col(a).alias(f"{corner}{a}") for a in "xyz"])
        tri = tri.join(place, [key, corner])
    return tri.select(key, "face_id", *[f"{c}{a}" for c in "uvw" for a in "xyz"])


def read_metadata_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Release metadata sheet: CSV everywhere, XLSX where the reader is installed."""
    if path.lower().endswith(".csv"):
        return spark.read.option("header", "true").csv(path)
    import pandas as pd

    try:
        sheet = pd.read_excel(path, dtype=str)
    except ImportError as missing:
        raise RuntimeError("reading XLSX needs openpyxl; export the sheet as CSV") from missing
    return spark.createDataFrame(sheet.astype(object).where(sheet.notna(), None), ", ".join(f"`{c}` string" for c in sheet.columns))


def write_log(df: DataFrame, path: str, append: bool = False) -> None:
    """CSV log with a header, one folder of part files."""
    df.write.mode("append" if append else "overwrite").option("header", "true").csv(path)


def read_log(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    log = spark.read.option("header", "true").csv(path)
    return log.select(*columns) if columns else log


def surface_meshes(spark: SparkSession, path: str) -> DataFrame:
    """Neuron surfaces landed beforehand as a parquet face table keyed by neuron.

    The online mesh service is an input here, not an operator: fetch once,
    land, compare many times.
    """
    return spark.read.parquet(path)
