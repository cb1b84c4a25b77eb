"""Words and white space as the operators of this package share them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
#: The same as a Spark SQL pattern.
WHITE_RUN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words of a text; none for NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas inside ``body`` use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(docs: DataFrame, name: str = "doc") -> DataFrame:
    """The rows of a table in one column, so that names of a step never meet those of its input."""
    return docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias(name))


def unpacked(rows: DataFrame, like: DataFrame, changed: dict[str, Column] | None = None, name: str = "doc") -> DataFrame:
    """The columns of ``like`` out of packed rows, some of them changed."""
    return rows.select(*[((changed or {}).get(n, F.col(name)[n])).alias(n) for n in like.columns])
