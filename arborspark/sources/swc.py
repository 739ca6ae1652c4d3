"""Skeleton text files as tables and back.

A scan never needs a whole file in one row.  The order of lines comes from the
byte offset of the input split and the position inside it, which grows with the
line number and is unique within a file, so no shuffle is needed to number them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborspark.functions.text import stem
from arborspark.operators import repair
from arborspark.operators.topology import CHUNK_ROWS
from arborspark.schema import VOXEL_NM

COLUMNS = ("id", "type", "x", "y", "z", "radius", "parent")


SPLIT_COLUMNS = ("value", "_metadata.file_path", "_metadata.file_block_start")


def line_order() -> Column:
    """Position of a line in its file: start of the input split plus the place inside."""
    return F.col("file_block_start") + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)


def split_lines(lines: DataFrame, relative_path: Column) -> DataFrame:
    """Numbered raw lines with their fields (null for blank lines and comments)."""
    out = lines.select(
        stem(F.url_decode("file_path")).alias("neuron"),
        relative_path.alias("relative_path"),
        line_order().alias("row_idx"),
        F.regexp_replace("value", "\r$", "").alias("raw"),
    )
    text = F.trim(F.regexp_replace("raw", r"\s+", " "))
    return out.withColumn("fields", F.when((text == "") | text.startswith("#"), F.lit(None)).otherwise(F.split(text, " ")))


def read_lines(spark: SparkSession, root: str | Sequence[str], glob: str = "*.[sS][wW][cC]", source_group: str | None = None) -> DataFrame:
    """Raw lines below ``root``: neuron (file stem), relative_path, row_idx, raw, fields."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root).select(*SPLIT_COLUMNS)
    plain = lambda c: F.regexp_replace(c, r"^file:/*", "/")
    base = plain(F.lit(root.rstrip("/") if isinstance(root, str) else ""))
    relative = F.regexp_replace(F.url_decode(plain(F.col("file_path"))), F.concat(F.lit("^\\Q"), base, F.lit("\\E/*")), F.lit(""))
    out = split_lines(lines, relative)
    return out.withColumn("source_group", F.lit(source_group)) if source_group else out


def _number(i: int) -> Column:
    return F.try_element_at("fields", F.lit(i + 1)).try_cast("double")


def parse(lines: DataFrame, mode: str = "lossless") -> DataFrame:
    """Lines with typed columns, ``extra`` fields and ``is_node`` / ``problem``.

    Modes differ in what happens to a row that is no valid node:
    ``lossless`` keeps it verbatim, ``coerce`` (all seven numeric or dropped) and
    ``strict`` (named in ``problem``) treat it as data.
    Ids, types and parents are cut from their decimal text towards zero.
    """
    whole = lambda i: _number(i).cast("bigint")
    enough = F.coalesce(F.size("fields") >= 7, F.lit(False))
    numeric = F.lit(True)
    for i in range(7) if mode != "lossless" else (0, 1, 6):
        numeric = numeric & _number(i).isNotNull()
    good = F.col("fields").isNotNull() & enough & numeric
    is_data = F.col("fields").isNotNull()
    problem = F.when(is_data & ~enough, "fewer than 7 columns").when(is_data & ~numeric, "not numeric")
    out = lines.select(
        *[c for c in lines.columns if c != "fields"],
        whole(0).alias("id"), whole(1).cast("int").alias("type"),
        *[_number(i).alias(c) for i, c in zip((2, 3, 4, 5), ("x", "y", "z", "radius"))],
        whole(6).alias("parent"),
        F.when(good & (F.size("fields") > 7), F.slice("fields", F.lit(8), F.greatest(F.size("fields") - 7, F.lit(0)))).alias("extra"),
        F.coalesce(good, F.lit(False)).alias("is_node"),
        problem.alias("problem") if mode == "strict" else F.lit(None).cast("string").alias("problem"),
    )
    return out.filter("is_node") if mode == "coerce" else out


def nodes(parsed: DataFrame) -> DataFrame:
    """The node table of parsed lines."""
    keep = ["neuron", "relative_path", "row_idx", *COLUMNS, "extra"]
    return parsed.filter("is_node").select(*keep, *[c for c in ("source_group",) if c in parsed.columns])


def read_swc(spark: SparkSession, root: str | Sequence[str], mode: str = "coerce", **options) -> DataFrame:
    return nodes(parse(read_lines(spark, root, **options), mode))


def read_many(spark: SparkSession, roots: dict[str, str], mode: str = "coerce") -> DataFrame:
    """Several named folders as one tagged table."""
    tables = [read_swc(spark, path, mode, source_group=name) for name, path in roots.items()]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def problems(parsed: DataFrame) -> DataFrame:
    """Neurons a strict reader refuses: bad rows, no nodes, repeated ids."""
    listed = parsed.groupBy("neuron").agg(F.max("problem").alias("bad"), F.count_if("is_node").alias("n"))
    repeated = repair.duplicate_ids(parsed.filter("is_node")).withColumn("twice", F.lit(True))
    error = F.coalesce(F.col("bad"), F.when(F.col("n") == 0, "No valid SWC nodes"), F.when(F.col("twice"), "Duplicate node IDs"))
    return listed.join(repeated, "neuron", "left").select("neuron", error.alias("error")).filter("error IS NOT NULL")


def to_nm(table: DataFrame, xyz_unit: str = "nm", radius_unit: str | None = None) -> DataFrame:
    """Coordinates and radii in nanometres; negative radii become zero."""
    if xyz_unit not in ("nm", "um", "voxel"):
        raise ValueError("xyz_unit must be nm, um or voxel")
    radius_unit = radius_unit or (None if xyz_unit == "voxel" else xyz_unit)
    if radius_unit not in ("nm", "um"):
        raise ValueError("radius_unit must be nm or um")
    factors = {"nm": (1.0, 1.0, 1.0), "um": (1000.0, 1000.0, 1000.0), "voxel": VOXEL_NM}[xyz_unit]
    r = F.col("radius") * (1000.0 if radius_unit == "um" else 1.0)
    return table.withColumns({c: F.col(c) * f for c, f in zip("xyz", factors)} | {"radius": F.greatest(r, F.lit(0.0))})


# -------------------------------------------------------------------- sinks

def node_line(decimals: int = 3, extra: Sequence[str] = ()) -> Column:
    """One output line: whole numbers for ids, fixed decimals for the rest."""
    fixed = f"%.{decimals}f"
    parts = [F.col("id").cast("string"), F.col("type").cast("string"),
             *[F.format_string(fixed, F.col(c)) for c in ("x", "y", "z", "radius")], F.col("parent").cast("string"),
             *[F.col(c).cast("string") for c in extra]]
    return F.concat_ws(" ", *parts)


def rewritten_lines(parsed: DataFrame, retyped: DataFrame) -> DataFrame:
    """Original text with only the changed types replaced.

    ``retyped``: neuron, id, new_type for the nodes that change.  A changed line
    is rebuilt with single spaces, every other line stays as it was.
    """
    change = retyped.select("neuron", "id", F.col("new_type").alias("_t"))
    hit = parsed.join(change, ["neuron", "id"], "left")
    parts = F.split(F.trim(F.regexp_replace("raw", r"\s+", " ")), " ")
    rebuilt = F.concat_ws(" ", F.slice(parts, 1, 1), F.array(F.col("_t").cast("string")), F.slice(parts, F.lit(3), F.size(parts)))
    return hit.select("neuron", "row_idx", F.when(F.col("is_node") & F.col("_t").isNotNull(), rebuilt).otherwise(F.col("raw")).alias("line"))


# Meaning of the node types in the release header.
TYPE_LEGEND = (
    "# 0 = unlabeled", "# 1 = soma", "# 2 = pre-synaptic only", "# 3 = post-synaptic only",
    "# 4 = mixed pre- and post-synaptic", "# 5 = branch point", "# 6 = terminal",
)


def with_header(lines: DataFrame, header: Sequence[str]) -> DataFrame:
    """Header lines put before the lines of every neuron."""
    rows = F.array(*[F.struct(F.lit(i - len(header)).cast("bigint").alias("row_idx"), F.lit(h).alias("line")) for i, h in enumerate(header)])
    heads = lines.select("neuron").distinct().select("neuron", F.inline(rows))
    return heads.unionByName(lines.select("neuron", "row_idx", "line"))


def write_lines(lines: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    """Text output, one folder per neuron (below ``partition`` columns, if any).

    Lines are sorted inside the task that writes them.  A neuron with more than
    ``CHUNK_ROWS`` lines is written as consecutive numbered parts by several tasks.
    """
    part = F.greatest(F.floor(F.col("row_idx") / CHUNK_ROWS), F.lit(0))
    by = [*partition, "neuron", "part"]
    out = lines.withColumn("part", part).repartition(*by).sortWithinPartitions(*by, "row_idx")
    out.select(*by, "line").write.mode("overwrite").partitionBy(*by).text(path)


def write_swc(table: DataFrame, path: str, decimals: int = 3, extra: Sequence[str] = (), header: Sequence[str] = (),
              order: str = "row_idx", partition: Sequence[str] = ()) -> None:
    lines = table.select(*partition, "neuron", F.col(order).cast("bigint").alias("row_idx"), node_line(decimals, extra).alias("line"))
    if header:
        if partition:
            raise ValueError("headers and routed output are written separately")
        lines = with_header(lines, header)
    write_lines(lines, path, partition)


def rounded(table: DataFrame, decimals: int = 3) -> DataFrame:
    """Coordinates as they would come back from a text file with few decimals."""
    return table.withColumns({c: F.round(c, decimals) for c in ("x", "y", "z", "radius")})


def write_by_category(table: DataFrame, path: str, category: str = "category") -> None:
    """Columnar output routed into one folder per category."""
    table.write.mode("overwrite").partitionBy(category).parquet(path)
