"""Row conditions built from plain Python values, and the table verbs that use them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_empty

_COMPARE = {
    "eq": lambda c, v: c == v,
    "neq": lambda c, v: c != v,
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
    "like": lambda c, v: c.like(v),
    "in": lambda c, v: c.isin(list(v)),
}


def _all_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def matching(filters: Mapping[str, Any]) -> Column:
    """Every column equals its value."""
    return _all_of(F.col(name) == F.lit(value) for name, value in filters.items())


def conditions(tests: Mapping[str, Any]) -> Column:
    """``{"price": {"gt": 5, "lte": 9}, "source": "x"}``: all tests must hold; a plain value means eq."""
    found = []
    for name, test in tests.items():
        for op, value in (test if isinstance(test, Mapping) else {"eq": test}).items():
            if op not in _COMPARE:
                raise ValueError(f"unknown comparison {op!r} on column {name!r}")
            found.append(_COMPARE[op](F.col(name), value))
    return _all_of(found)


def has_fields(columns: Iterable[str]) -> Column:
    """All columns hold text. A blank string counts as text."""
    return _all_of(~is_empty(c) for c in columns)


def read_rows(
    df: DataFrame,
    columns: list[str] | None = None,
    filters: Mapping[str, Any] | None = None,
    order_by: str | None = None,
    limit: int | None = None,
    offset: int | None = None,
) -> DataFrame:
    """Select, filter, sort and slice. A limit or offset of 0 or None means none."""
    out = df.where(matching(filters)) if filters else df
    if order_by:
        out = out.orderBy(order_by)
    if offset:
        if not order_by:
            raise ValueError("an offset needs an order")
        out = out.offset(offset)
    if limit:
        out = out.limit(limit)
    return out.select(*columns) if columns else out


def count_rows(df: DataFrame, filters: Mapping[str, Any] | None = None) -> DataFrame:
    return (df.where(matching(filters)) if filters else df).agg(F.count("*").alias("count"))


def update_where(df: DataFrame, changes: Mapping[str, Any], filters: Mapping[str, Any]) -> DataFrame:
    """The table with ``changes`` set on matching rows; one scan, no shuffle. Filters as in ``conditions``."""
    hit = conditions(filters)
    types = dict(df.dtypes)
    return df.withColumns(
        {
            name: F.when(hit, F.lit(value).cast(types[name])).otherwise(F.col(name))
            for name, value in changes.items()
        }
    )


def delete_where(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    """The table without matching rows; a comparison with null does not match."""
    return df.where(~F.coalesce(conditions(filters), F.lit(False)))


def page_of(df: DataFrame, page: int, page_size: int, order_by: list[str], columns: list[str] | None = None):
    """Rows of one page (from 1). ``order_by`` must be a total order for stable pages."""
    if not order_by:
        raise ValueError("a page needs an order")
    out = df.orderBy(*order_by).offset((page - 1) * page_size).limit(page_size)
    return out.select(*columns) if columns else out


def rows_after(df: DataFrame, order_by: list[str], after: list | None, rows: int) -> DataFrame:
    """The ``rows`` rows that follow the key values ``after`` in a total order without nulls.

    Unlike a page number this costs the same however deep: the condition is pushed to the scan,
    and each task gives at most ``rows`` rows.
    """
    if not order_by:
        raise ValueError("a page needs an order")
    if after is not None:
        beyond, equal = F.lit(False), F.lit(True)
        for name, value in zip(order_by, after, strict=True):
            beyond = beyond | (equal & (F.col(name) > F.lit(value)))
            equal = equal & (F.col(name) == F.lit(value))
        df = df.where(F.col(order_by[0]) >= F.lit(after[0])).where(beyond)
    return df.orderBy(*order_by).limit(rows)


def page_info(page_rows: DataFrame, page: int, page_size: int) -> DataFrame:
    return page_rows.agg(
        F.lit(page).alias("page"), F.lit(page_size).alias("page_size"), F.count("*").alias("rows_in_page")
    )


def sample_row(df: DataFrame) -> DataFrame:
    """Any one row, for looking at a table; its schema is ``df.schema``."""
    return df.limit(1)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]
