"""Subset queries as lazy DataFrames: filter, order, limit and tie-safe pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.predicates import Predicate, PredicateError, column_name, to_column
from tidelog.plans.coverage import Plan, Query


def types_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def where(df: DataFrame, p: Predicate | None) -> DataFrame:
    return df if p is None else df.where(to_column(p, types_of(df)))


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """The selected columns in a fixed (sorted) order; only they reach the scan."""
    return df.select(*sorted(columns))


def order_columns(order_by: tuple[tuple[str, bool], ...], ties: tuple[str, ...] = ()) -> list[Column]:
    """Ascending with nulls last, descending with nulls first; key columns break ties."""
    keys = [F.col(column_name(f)).asc_nulls_last() if up else F.col(column_name(f)).desc_nulls_first() for f, up in order_by]
    return keys + [F.col(k).asc_nulls_last() for k in ties]


def subset(df: DataFrame, q: Query, base: Predicate | None = None, key: tuple[str, ...] = ()) -> DataFrame:
    """The rows of a query within its shape's base predicate. A cursor adds to both predicates, it replaces neither.

    A page after a cursor is all rows that tie with the cursor, without limit, and then the limited rows after it.
    """
    rows = where(where(df, base), q.predicate)
    if q.limit is not None and q.limit < 0:
        raise PredicateError("negative limit")

    def page(x: DataFrame) -> DataFrame:
        keys = order_columns(q.order_by, key if q.limit is not None else ())
        ordered = x.orderBy(*keys) if keys else x
        return ordered if q.limit is None else ordered.limit(q.limit)

    if q.cursor is None:
        return page(rows)
    return where(rows, q.cursor.ties).unionByName(page(where(rows, q.cursor.after)))


def answer(local: DataFrame, remote: DataFrame, q: Query, plan: Plan, key: tuple[str, ...] = ()) -> DataFrame:
    """A planned request in its order: what is covered from the local table, only the remainder from the remote one."""
    if plan.remainder is None:
        return subset(local, q, key=key)
    if q.scoped:
        return subset(remote, q, key=key)
    rows = where(local, plan.covered).unionByName(where(remote, plan.remainder))
    return rows.orderBy(*order_columns(q.order_by)) if q.order_by else rows
