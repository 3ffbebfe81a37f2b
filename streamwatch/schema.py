"""The transaction event: its fields, its wire form and the model's feature order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The field names of a transaction event and the order in which
# a model reads its features.
COMPONENTS = tuple(f"V{i}" for i in range(1, 29))
FEATURE_COLUMNS = (*COMPONENTS, "Time", "Amount")

EVENT_SCHEMA = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in ("Time", *COMPONENTS, "Amount")]
    + [T.StructField("Class", T.IntegerType()), T.StructField("timestamp", T.StringType())]
)

# A replay or training file holds the same fields without the send time.
TABLE_SCHEMA = T.StructType([f for f in EVENT_SCHEMA if f.name != "timestamp"])


def require_columns(df: DataFrame, names: Iterable[str | None]) -> None:
    """Raise ``ValueError`` naming the columns that ``df`` lacks."""
    missing = [n for n in names if n is not None and n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; the input has {df.columns}")
