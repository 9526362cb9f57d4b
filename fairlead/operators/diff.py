"""Differences between two copies of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.functions.text import layout_free
from fairlead.schema import require


def diff_copies(left: DataFrame, right: DataFrame, key: str, fields: list[str], order: str, names: tuple[str, str]) -> DataFrame:
    """(key, field, kind, left_value, right_value): what differs between two copies, field by field.

    Both sides are tagged, put together and grouped once by ``key``; each group keeps one struct per side, the one of
    the latest ``order`` (ties: the greatest values), so a group never holds more than two rows and is combined before
    the shuffle, however often a key repeats. ``kind`` is only_in_<name> with field '' or 'differs'. Values are compared
    without differences of layout; null equals ''. Rows with a null key cannot be matched and are left out.
    """
    def side(df: DataFrame, tag: int) -> DataFrame:
        df = require(df, key, order, *fields)
        return df.where(F.col(key).isNotNull()).select(F.col(key), F.lit(tag).alias("_side"), F.struct(F.col(order), *[layout_free(F.col(f).cast("string")).alias(f) for f in fields]).alias("_row"))

    both = side(left, 0).unionByName(side(right, 1))
    pick = [F.max(F.when(F.col("_side") == k, F.col("_row"))).alias(f"_{k}") for k in (0, 1)]
    one = lambda kind: f"array(named_struct('field', '', 'kind', '{kind}', 'left_value', cast(null as string), 'right_value', cast(null as string)))"
    pairs = ", ".join(f"named_struct('field', '{f}', 'kind', 'differs', 'left_value', _0.`{f}`, 'right_value', _1.`{f}`)" for f in fields)
    found = F.expr(f"case when _1 is null then {one(f'only_in_{names[0]}')} when _0 is null then {one(f'only_in_{names[1]}')} else filter(array({pairs}), x -> x.left_value <> x.right_value) end")
    return both.groupBy(key).agg(*pick).select(key, F.inline(found))
