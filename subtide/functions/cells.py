"""Stacked reports from one scan: rows fanned out to the report sections they count in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ["section", "dim", "col1", "col2", "col3", "col4"]


def fan_out(rows: DataFrame, sections: list[tuple[str, Column | None, dict[str, Column]]]) -> DataFrame:
    """Each row once per section it belongs to.

    ``sections`` holds (label, condition or None for every row, columns); all sections
    give the same columns of the same types. Every row of the result carries
    ``section`` and those columns.
    """
    structs = []
    for label, condition, columns in sections:
        entry = F.struct(F.lit(label).alias("section"), *[c.alias(name) for name, c in columns.items()])
        structs.append(entry if condition is None else F.when(condition, entry))
    return rows.select(F.inline(F.array(*structs))).where(F.col("section").isNotNull())


def by_section(texts: dict[str, list[Column]], position: int) -> Column:
    """The text column ``col<position + 1>``: each section fills it its own way."""
    chosen = F.lit(None).cast("string")
    for label, columns in texts.items():
        chosen = F.when(F.col("section") == label, columns[position]).otherwise(chosen)
    return chosen.alias(f"col{position + 1}")
