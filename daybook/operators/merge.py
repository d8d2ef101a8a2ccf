"""Keyed upsert as a DataFrame operator."""

from pyspark.sql import DataFrame


def merge_by_key(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new` replace stored rows with the same key as a whole; other rows stay."""
    kept = stored.join(new.select(*keys), keys, "left_anti")
    return kept.select(*new.columns).unionByName(new)


def complete_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that can be stored: a NULL in the key has no place in a keyed table."""
    return rows.dropna(subset=keys)
