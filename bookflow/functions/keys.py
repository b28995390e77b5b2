"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid_of(*parts: str | Column) -> Column:
    """UUID-shaped text made from a 128-bit hash of the parts: the same row gets the same id on every attempt."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    digest = F.md5(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]))
    return F.concat_ws("-", *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
