"""Who may see which document, as Column expressions.

Two definitions of visibility are kept on purpose: ``may_read`` filters before ranking,
``is_visible`` audits what came out. They share no code so that one can catch the other.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Users with their roles, label ranks, role names.
USERS = {
    "alice": ("HR", "Everyone"),
    "bob": ("Finance", "Everyone"),
    "carol": ("Everyone",),
    "admin": ("HR", "Finance", "Everyone", "Admin"),
}
LABEL_RANK = {"public": 0, "internal": 1, "confidential": 2}
EVERYONE, TEAM_ODD, TEAM_EVEN = "Everyone", "HR", "Finance"

_SEPARATOR = "\u001f"


def users_frame(spark: SparkSession, users: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``user, roles`` for a fixed set of users."""
    rows = [(name, list(roles)) for name, roles in (users or USERS).items()]
    return spark.createDataFrame(rows, "user string, roles array<string>")


def label_rank(label: Column) -> Column:
    rank = F.lit(None).cast("int")
    for name, value in LABEL_RANK.items():
        rank = F.when(label == name, F.lit(value)).otherwise(rank)
    return rank


def explicit_roles(roles: Column) -> Column:
    """Roles that count as an explicit grant."""
    return F.array_remove(roles, EVERYONE)


def may_read(label: Column, allowed: Column, roles: Column) -> Column:
    """Pre-filter: any common role, and for confidential a common explicit role."""
    common = F.arrays_overlap(allowed, roles)
    granted = F.arrays_overlap(allowed, explicit_roles(roles))
    return F.coalesce(common & ((label != "confidential") | granted), F.lit(False))


def is_visible(label: Column, allowed: Column, roles: Column) -> Column:
    """Audit form: counts what the two role lists share."""
    shared = F.array_intersect(allowed, roles)
    needed = F.when(
        label == "confidential", F.array_except(shared, F.array(F.lit(EVERYONE)))
    ).otherwise(shared)
    return F.coalesce(F.size(F.array_compact(needed)) > 0, F.lit(False))


def signature(label: Column, allowed: Column) -> Column:
    """Documents with equal signatures are visible to exactly the same users."""
    roles = F.array_sort(F.array_distinct(F.array_compact(allowed)))
    return F.concat(label, F.lit(_SEPARATOR), F.array_join(roles, _SEPARATOR))


def role_set_key(allowed: Column) -> Column:
    return F.array_join(F.array_sort(allowed), "+")


def team_by_sha(doc_id: Column) -> Column:
    """Team from the parity of the last hex digit of sha-256, entirely in the JVM."""
    odd = F.substring(F.sha2(doc_id, 256), -1, 1).isin(*"13579bdf")
    return F.when(odd, F.lit(TEAM_ODD)).otherwise(F.lit(TEAM_EVEN))


@F.pandas_udf(T.StringType())
def _blake_team(ids: pd.Series) -> pd.Series:
    def team(value: str | None) -> str | None:
        if value is None:
            return None
        return TEAM_ODD if hashlib.blake2b(value.encode(), digest_size=1).digest()[0] & 1 else TEAM_EVEN

    return ids.map(team)


def team_by_blake(doc_id: Column) -> Column:
    """Team from the parity of a one-byte BLAKE2b digest (no JVM function computes it)."""
    return _blake_team(doc_id)


def assigned_roles(label: Column, modality: Column, team: Column) -> Column:
    """Seeded grant: images and public to everyone, internal adds a team, else the team."""
    unknown = F.raise_error(F.concat(F.lit("unknown label: "), label)).cast("array<string>")
    return (
        F.when((modality == "image") | (label == "public"), F.array(F.lit(EVERYONE)))
        .when(label == "internal", F.array(F.lit(EVERYONE), team))
        .when(label == "confidential", F.array(team))
        .otherwise(unknown)
    )
