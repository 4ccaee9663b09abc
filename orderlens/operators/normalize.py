"""Order ids normalised between the global and the legacy form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import trailing_digits
from ..functions.text import normalize

# Fixed value: record field that keeps the original global id.
GID_FIELD = "shopifyGid"


def normalize_order_ids(df: DataFrame, id_col: str = "id", legacy_col: str = "legacyResourceId") -> DataFrame:
    """``legacy`` = normalised legacy id, else the trailing digits of the gid. When present it
    becomes both ``legacyResourceId`` and ``id``; the gid is kept in ``shopifyGid``. Rows
    with neither keep their ``id``. Narrow: no shuffle."""
    gid = normalize(F.col(id_col))
    legacy_in = normalize(F.col(legacy_col)) if legacy_col in df.columns else F.lit(None).cast("string")
    legacy = F.coalesce(legacy_in, trailing_digits(gid))
    out = df.withColumn(GID_FIELD, gid)
    out = out.withColumns({
        legacy_col: F.coalesce(legacy, F.col(legacy_col) if legacy_col in df.columns else F.lit(None).cast("string")),
        id_col: F.coalesce(legacy, F.col(id_col)),
    })
    return out
