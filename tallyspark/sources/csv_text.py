"""CSV line encoding (A11) as a native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def csv_field(col: Column) -> Column:
    """Quote a field iff it contains a comma, a newline or a quote; inner
    quotes are doubled.  NULL is written as an empty field."""
    c = F.coalesce(col.cast("string"), F.lit(""))
    needs = c.contains(",") | c.contains("\n") | c.contains('"')
    return F.when(needs, F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def csv_line(cols: list[Column]) -> Column:
    return F.concat_ws(",", *[csv_field(c) for c in cols])


def csv_line_from_array(cells: Column) -> Column:
    return F.array_join(F.transform(cells, csv_field), ",")
