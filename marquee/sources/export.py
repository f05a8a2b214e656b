"""Shape in which a mart leaves for the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from marquee.contracts import EXPORTS


def arrays_as_text(df: DataFrame, separator: str = ", ") -> DataFrame:
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    return df.withColumns({name: F.concat_ws(separator, F.col(name)) for name in arrays}) if arrays else df


def export_projection(df: DataFrame, mart: str) -> DataFrame:
    """The mart's configured columns that exist, arrays as delimited text."""
    return arrays_as_text(df.select(*[c for c in EXPORTS[mart].columns if c in df.columns]))
