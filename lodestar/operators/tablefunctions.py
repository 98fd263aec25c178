"""A table function whose columns are found when the query is analysed."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


class FlagColumns:
    """``TABLE(rows), column, names, separator``: the rows with a 0/1 column per name in the text column, and ``code``, the
    flags joined. The names are one constant text, so the columns depend on the call; a null text has no tags."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, column: AnalyzeArgument, names: AnalyzeArgument, separator: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument must be a table")
        if any(a.value is None for a in (column, names, separator)):
            raise ValueError("column, names and separator must be constants")
        given = rows.dataType.fieldNames()
        if column.value not in given:
            raise ValueError(f"no column {column.value}; there are {', '.join(given)}")
        added = [n for n in names.value.split(separator.value) if n]
        clash = sorted({n for n in [*added, "code"] if n in given or [*added, "code"].count(n) > 1})
        if clash:
            raise ValueError(f"columns {', '.join(clash)} are there twice")
        schema = StructType(list(rows.dataType.fields))
        for name in added:
            schema = schema.add(name, IntegerType())
        return AnalyzeResult(schema=schema.add("code", StringType()))

    def eval(self, rows: Row, column: str, names: str, separator: str) -> Iterator[tuple]:
        here = set((rows[column] or "").split(separator))
        flags = [int(n in here) for n in names.split(separator) if n]
        yield (*rows, *flags, "".join(map(str, flags)))


def flag_columns(df: DataFrame, column: str, names: Sequence[str], separator: str = ",") -> DataFrame:
    """Rows with a flag per name, by the table function; ``names`` become its constant argument."""
    function = F.udtf(FlagColumns)
    return function(df.asTable(), F.lit(column), F.lit(separator.join(names)), F.lit(separator))
