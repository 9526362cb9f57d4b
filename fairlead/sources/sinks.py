"""Reports as CSV and JSON, and a digest for people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined(c: Column, sep: str = " + ", missing: str = "?") -> Column:
    """An array as text, with a mark for missing entries."""
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep, missing)


def shortened(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Columns cut to their width for people's eyes."""
    return df.select(*[F.substring(F.col(c).cast("string"), 1, widths[c]).alias(c) if c in widths else F.col(c) for c in df.columns])


def flat(df: DataFrame) -> DataFrame:
    """Arrays and maps as text, for formats without them."""
    out = []
    for name, kind in df.dtypes:
        out.append(joined(F.col(name)).alias(name) if kind.startswith("array<") and "struct" not in kind else F.to_json(name).alias(name) if kind.startswith(("map", "struct", "array")) else F.col(name))
    return df.select(*out)


def write_report(df: DataFrame, path: str, form: str = "csv", widths: dict[str, int] | None = None, partition_by: list[str] | None = None) -> None:
    """csv (with header), json or parquet; a partition per value of ``partition_by``."""
    df = shortened(df, widths or {})
    writer = (flat(df) if form == "csv" else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if form == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(form).save(path)


def by_number(key: str, missing: int = 0) -> Column:
    """Sort key: the whole number of a text id, ``missing`` for others."""
    return F.coalesce(F.col(key).try_cast("bigint"), F.lit(missing))


def digest(counts: DataFrame, title: str, most: int = 200) -> str:
    """Markdown table of an aggregate (label, n), largest first; an aggregate of more than ``most`` rows is cut and says so."""
    rows = counts.orderBy(F.desc("n"), "label").limit(most + 1).collect()
    lines = [f"# {title}", "", "| | n |", "|-|-|", *[f"| {r.label} | {r.n} |" for r in rows[:most]]]
    return "\n".join(lines + (["", f"more than {most} rows"] if len(rows) > most else [])) + "\n"


def styled_cells(sheet: DataFrame, proposals: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Long grid (key, column_name, value, fill): proposed values in the colour of their confidence, existing ones gray, others without.

    proposals: key, column_name, value, confidence. A rendering to spreadsheet files is left to other tools.
    """
    cells = sheet.select(key, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit("")).alias("old")) for c in columns])))
    best = proposals.groupBy(key, "column_name").agg(F.max_by(F.struct("value", "confidence"), F.struct("confidence", "value")).alias("p"))
    fill = F.when(F.col("p").isNotNull(), F.coalesce(F.create_map(F.lit("G"), F.lit("green"), F.lit("Y"), F.lit("yellow"), F.lit("R"), F.lit("red"))[F.col("p.confidence")], F.lit("red"))).when(F.col("old") != "", "gray").otherwise("")
    return cells.join(best, [key, "column_name"], "left").select(key, "column_name", F.coalesce("p.value", "old").alias("value"), fill.alias("fill"))
