"""Totals over several groupings at once: grouping sets, rollup, cube."""

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup_sets(keys: list[str]) -> list[list[str]]:
    """All keys, all but the last, and so on to none."""
    return [keys[:n] for n in range(len(keys), -1, -1)]


def cube_sets(keys: list[str]) -> list[list[str]]:
    """Every selection of the keys."""
    return [list(some) for n in range(len(keys), -1, -1) for some in combinations(keys, n)]


def grouped_totals(rows: DataFrame, keys: list[str], sets: list[list[str]], sums: list[str]) -> DataFrame:
    """The keys, `level`, `n_rows` and sums for every set of keys, from one pass over the rows.

    A key that a set leaves out is NULL, and so may be a genuine value: `level` tells them apart, a bit a key, the
    last key the lowest, set where the key is left out. NULL values of a key are one group. The sum of nothing
    but NULLs is NULL. No rows give no groups, but one for the empty set, as without grouping.

    Each row becomes one for each set and is added up in its task before the shuffle, so a frequent group is one
    row a task; groups of several sets share the exchange.
    """
    given = rows.select(*keys, *sums)
    sets_of = [[F.col(name) for name in some] for some in sets]
    totals = [F.sum(name).alias(name) for name in sums]
    grouped = given.groupingSets(sets_of, *[F.col(name) for name in keys])
    return grouped.agg(F.grouping_id(*keys).alias("level"), F.count("*").alias("n_rows"), *totals)
