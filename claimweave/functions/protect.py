"""Column-level protection of personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pseudonymise(df: DataFrame, columns: list[str], salt: Column) -> DataFrame:
    """Replace columns by a salted digest: still joinable, no longer readable.

    A literal salt shows in plans and event logs; read a secret one from a table, as a scalar subquery.
    """
    return df.withColumns({c: F.sha2(F.concat(salt, F.col(c).cast("string")), 256) for c in columns})


def encrypt(df: DataFrame, columns: list[str], key: Column) -> DataFrame:
    """Encrypt columns with AES-GCM; `key` is a 16, 24 or 32 byte Column."""
    return df.withColumns(
        {c: F.base64(F.aes_encrypt(F.col(c).cast("string"), key)) for c in columns}
    )


def decrypt(df: DataFrame, columns: list[str], key: Column) -> DataFrame:
    return df.withColumns(
        {c: F.aes_decrypt(F.unbase64(F.col(c)), key).cast("string") for c in columns}
    )
