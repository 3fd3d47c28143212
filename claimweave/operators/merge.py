"""Keyed changes to a table, each expressed as (target, batch) -> new table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.operators.dedup import latest_per_key


def without_keys(
    target: DataFrame, batch: DataFrame, keys: list[str], null_safe: bool = False
) -> DataFrame:
    """Target rows whose key is not in the batch.

    Only the distinct keys of the batch are joined: when they are few, AQE
    broadcasts them and the target is not shuffled.
    """
    return _by_keys(target, batch, keys, null_safe, "left_anti")


def matching(
    target: DataFrame, batch: DataFrame, keys: list[str], null_safe: bool = False
) -> DataFrame:
    """Target rows whose key is in the batch."""
    return _by_keys(target, batch, keys, null_safe, "left_semi")


def _by_keys(
    target: DataFrame, batch: DataFrame, keys: list[str], null_safe: bool, how: str
) -> DataFrame:
    named = batch.select(*(F.col(k).alias(f"_batch_{k}") for k in keys)).distinct()
    pairs = [(F.col(k), F.col(f"_batch_{k}")) for k in keys]
    same = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return target.join(named, reduce(and_, same), how)


def upsert(
    target: DataFrame | None, batch: DataFrame, keys: list[str], null_safe: bool = True
) -> DataFrame:
    """Matched rows take the batch's values, unmatched batch rows are added.

    The batch must hold one row per key (see `latest_per_key`).
    """
    if target is None:
        return batch
    kept = without_keys(target, batch, keys, null_safe)
    return kept.unionByName(batch, allowMissingColumns=True)


def delete_insert(
    target: DataFrame, batch: DataFrame, keys: list[str], newest_first: list[str]
) -> DataFrame:
    """Delete the target rows named by the batch, then insert the batch, one row per key."""
    return upsert(target, latest_per_key(batch, keys, newest_first), keys, null_safe=False)


def new_keys(source: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the dimension does not hold yet."""
    return source.join(dim.select(key), key, "left_anti")


def append_evolving(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows that may bring new columns; older rows get NULL there."""
    return existing.unionByName(new, allowMissingColumns=True)


def missing_from(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows whose key is not stored yet: what an idempotent append has to write."""
    return without_keys(batch, existing, keys, null_safe=True)


def row_digest(columns: list[str]) -> Column:
    """Digest of a row's values; NULL and the empty string stay distinct."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)
