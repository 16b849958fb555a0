"""Land scans. Pagination is Spark's: a scan is complete and its filters and columns reach the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def eligible(lands: DataFrame, tenant_col: str = "tenant_id", tenant=None) -> DataFrame:
    """SRC1, SRC2: active lands that are not deleted, of one tenant if given."""
    out = lands.where(F.col("is_active") & F.col("deleted_at").isNull())
    return out if tenant is None else out.where(F.col(tenant_col) == tenant)


def by_ids(lands: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """SRC3: a semi-join, whatever the size of the list; Spark broadcasts it when it is small."""
    return lands.join(ids.select(key), key, "left_semi")


def capped(lands: DataFrame, key: str, most: int | None) -> DataFrame:
    """SO5: the first `most` by id, all when None."""
    return lands if most is None else lands.orderBy(key).limit(most)
