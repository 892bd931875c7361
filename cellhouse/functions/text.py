"""Text functions: line splitting, Java-style token split and line parsers.

All of them are Catalyst expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Line terminators recognised when a text value is cut into lines.
LINE_BREAK = r"\r\n|\n|\r"
# Token delimiter of the line parsers (a single U+0020 space).
TOKEN_DELIMITER = " "
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(line) -> Column:
    """Split on single spaces the way ``String.split(" ")`` does.

    Inner and leading empty tokens are kept, trailing ones dropped;
    ``""`` gives ``[""]`` and an all-blank line gives ``[]``.  ``rtrim``
    removes only U+0020, which is exactly the trailing-empty rule.
    """
    c = _c(line)
    return (
        F.when(c == F.lit(""), F.array(F.lit("")))
        .when(F.rtrim(c) == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(F.rtrim(c), TOKEN_DELIMITER, -1))
    )


def split_lines(text) -> Column:
    """Array of the lines of a text value (``\\r\\n``, ``\\n`` or ``\\r``)."""
    return F.split(_c(text), LINE_BREAK, -1)


def explode_words(df, line_col: str = "line", out: str = "word"):
    """one output row per token of each line (flat map)."""
    return df.select(F.explode(java_split(line_col)).alias(out))


def kv_format(key, count) -> Column:
    """``key:count``."""
    return F.concat_ws(":", _c(key), _c(count).cast("string"))


def parse_cells(line, ts) -> Column:
    """``row family qualifier value`` -> cell struct, null unless 4 tokens.

    ``ts`` is an argument (a column or literal) so the result is checkable;
    pass ``unix_millis(current_timestamp())`` for the clock.
    """
    t = java_split(line)
    cell = F.struct(
        F.encode(t[0], "UTF-8").alias("row"),
        t[1].alias("family"),
        F.encode(t[2], "UTF-8").alias("qualifier"),
        _c(ts).cast("bigint").alias("ts"),
        F.encode(t[3], "UTF-8").alias("value"),
    )
    return F.when(F.size(t) == 4, cell)


def parse_kv(line, family: str, qualifier: str, ts) -> Column:
    """``row value`` -> put into a fixed column; null unless 2 tokens."""
    t = java_split(line)
    cell = F.struct(
        F.encode(t[0], "UTF-8").alias("row"),
        F.lit(family).alias("family"),
        F.encode(F.lit(qualifier), "UTF-8").alias("qualifier"),
        _c(ts).cast("bigint").alias("ts"),
        F.encode(t[1], "UTF-8").alias("value"),
    )
    return F.when(F.size(t) == 2, cell)


def parse_multi_cells(line, n_pairs: int, ts) -> Column:
    """``row family (qualifier value){k}`` -> array of cells.

    Accepted only when the line has exactly ``2 + 2*n_pairs`` tokens; for
    other lines the array is empty, while the row key is still token 0
    (``multi_cells_row``).
    """
    t = java_split(line)
    idx = F.sequence(F.lit(2), F.size(t) - 1, F.lit(2))
    cells = F.transform(
        idx,
        lambda i: F.struct(
            F.encode(t[0], "UTF-8").alias("row"),
            t[1].alias("family"),
            F.encode(F.element_at(t, i + 1), "UTF-8").alias("qualifier"),
            _c(ts).cast("bigint").alias("ts"),
            F.encode(F.element_at(t, i + 2), "UTF-8").alias("value"),
        ),
    )
    empty = F.array().cast("array<struct<row:binary,family:string,qualifier:binary,ts:bigint,value:binary>>")
    return F.when(F.size(t) == 2 + 2 * n_pairs, cells).otherwise(empty)


def multi_cells_row(line) -> Column:
    """Row key of an F4 line: token 0, taken even when the line is malformed."""
    return F.encode(java_split(line)[0], "UTF-8")
