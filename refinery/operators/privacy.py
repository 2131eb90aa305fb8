"""PII masking: SHA-256 of the string form of personal columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions import fixed


def mask(df: DataFrame, cols: Iterable[str] = fixed.PII_COLUMNS, salt: str | None = None) -> DataFrame:
    """Replace each listed column that exists with ``sha2(string(col), 256)``.

    Null stays null.  Columns absent from ``df`` are skipped.  ``salt`` (off by
    default, for parity) is prepended before hashing.
    """
    present = [c for c in cols if c in df.columns]
    out = {}
    for c in present:
        s = F.col(c).cast("string")
        if salt:
            s = F.concat(F.lit(salt), s)
        out[c] = F.sha2(s, 256)
    return df.withColumns(out) if out else df
