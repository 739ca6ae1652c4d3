"""String expressions: ids in file names, lenient booleans and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words read as true.
TRUE_WORDS = ("true", "1")


def root_id(stem: Column) -> Column:
    """Neuron id of a file stem: the whole stem when all digits, otherwise its only
    run of 15 to 21 digits, otherwise null."""
    runs = F.regexp_extract_all(stem, F.lit(r"(?<!\d)(\d{15,21})(?!\d)"), F.lit(1))
    return F.when(stem.rlike(r"^\d+$"), stem).when(F.size(runs) == 1, F.get(runs, F.lit(0)))


def to_bool(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def stem(path: Column) -> Column:
    """File name without folder and last suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]+$", "")
