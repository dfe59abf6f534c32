"""Row-level access by granted keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_filter(
    df: DataFrame,
    grants: DataFrame,
    login: str,
    key: str,
    roles: set[str] = frozenset(),
    privileged: set[str] = frozenset({"owner", "technician"}),
) -> DataFrame:
    """All rows for privileged roles, else rows whose key is granted to the login.

    A login without grants sees nothing.
    """
    if roles & privileged:
        return df
    return df.join(grants.filter(F.col("login") == login).select(key).distinct(), key, "left_semi")


def add_grant(grants: DataFrame, request: DataFrame, privileged: set[str]) -> DataFrame:
    """Add (login, key, role) lines once per login and key.

    Privileged roles need no line, because the filter lets them through.
    """
    key = [c for c in grants.columns if c != "role"]
    needed = request.filter(~F.col("role").isin(list(privileged))).groupBy(*key).agg(F.min("role").alias("role"))
    return grants.unionByName(needed.join(grants.select(*key), key, "left_anti").select(*grants.columns))
