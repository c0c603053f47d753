"""A stored collection of documents with its most used paths as plain columns.

The plain columns take the place of an index: the files are sorted by them, so a filter on such a
path skips the row groups that cannot match before any document is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.containment import contains
from tidemark.functions.variants import get_as

_STRING, _NUMBERS = "string", ("int", "bigint", "double")


@dataclass(frozen=True)
class HotPath:
    """A path of the documents that is kept as column ``column`` of type ``kind``."""

    column: str
    kind: str
    steps: tuple[str, ...]

    def wanted(self, literal) -> object | None:
        """The value a containment literal asks for at this path, if the column can test it."""
        for step in self.steps:
            if not isinstance(literal, dict) or step not in literal:
                return None
            literal = literal[step]
        if isinstance(literal, str) and self.kind == _STRING:
            return literal
        if isinstance(literal, bool):
            return None
        if isinstance(literal, int) and self.kind in _NUMBERS:
            return literal
        if isinstance(literal, float) and self.kind == "double":
            return literal
        return None


def store_collection(df: DataFrame, path: str, doc: str, hot: Sequence[HotPath], spread: str) -> None:
    """Write documents sorted by their hot paths.

    ``spread`` is a column with many values; it divides a frequent path value over several files.
    """
    columns = {h.column: get_as(F.col(doc), h.kind, *h.steps, safe=True) for h in hot}
    order = [F.col(c).asc_nulls_last() for c in columns] + [F.xxhash64(spread).asc()]
    shaped = df.withColumns(columns)
    shaped.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def find(collection: DataFrame, doc: str, literal, hot: Sequence[HotPath]) -> DataFrame:
    """Documents containing ``literal``: hot columns narrow the scan, the full test decides."""
    narrow: Column = F.lit(True)
    for path in hot:
        value = path.wanted(literal)
        if value is not None:
            narrow = narrow & (F.col(path.column) == value)
    return collection.filter(narrow & contains(F.col(doc), literal))
