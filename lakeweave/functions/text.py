"""Text slicing for line-oriented sources.

Each rule is written once as SQL text (``*_sql``) so a whole projection can go to
Spark in one ``selectExpr`` call; the Column form wraps the same text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def byte_substring_sql(line: str, pos: int, length: int) -> str:
    """1-based substring counted in UTF-8 bytes, like the warehouse's ``substring``.

    Spark's ``substring`` counts characters; a fixed-width layout counts bytes, so
    a multi-byte character earlier on the line would shift every later field.
    Slice the binary form, then decode. A line shorter than the layout gives ''.
    """
    return f"decode(substring(cast({q(line)} as binary), {int(pos)}, {int(length)}), 'UTF-8')"


def byte_substring(line: str, pos: int, length: int) -> Column:
    return F.expr(byte_substring_sql(line, pos, length))


def fixed_width_sql(line: str, layout: dict[str, tuple[int, int]]) -> list[str]:
    """One untrimmed string column per ``name -> (pos, len)``; typing happens later."""
    return [f"{byte_substring_sql(line, p, n)} AS {q(name)}" for name, (p, n) in layout.items()]
