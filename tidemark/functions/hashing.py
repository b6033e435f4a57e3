"""Row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str | Column], null_token: str | None = None) -> Column:
    """SHA-256 over the text of ``columns`` joined by ``||``.

    Nulls are skipped by default, so (a, null, b) and (a, b) share a hash; give
    ``null_token`` to keep the positions apart.
    """
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    if null_token is not None:
        texts = [F.coalesce(t, F.lit(null_token)) for t in texts]
    return F.sha2(F.concat_ws("||", *texts), 256)
