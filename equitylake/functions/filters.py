"""User predicates given as JSON objects, compiled to a Column."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ISO = re.compile(r"(\d{4}-\d\d-\d\d)(?:T(\d\d:\d\d:\d\d)(?:\.\d+)?Z?)?$")


def literal(value: Any) -> Any:
    """ISO dates and times (fraction and Z dropped) as timestamps; the rest as it is."""
    if isinstance(value, str) and (m := _ISO.match(value)):
        try:
            return dt.datetime.fromisoformat(f"{m[1]} {m[2] or '00:00:00'}")
        except ValueError:
            return value
    return value


def _field(name: str, test: Any) -> Column:
    column = F.col(name)
    if not isinstance(test, dict) or not any(str(k).startswith("$") for k in test):
        return column.isNull() if test is None else F.coalesce(column == F.lit(literal(test)), F.lit(False))
    parts = []
    for op, value in test.items():
        if op == "$exists":
            part = column.isNotNull() if value else column.isNull()
        elif op == "$regex":
            part = column.rlike(("(?i)" if "i" in test.get("$options", "") else "") + value)
        elif op == "$options":
            continue
        elif op in ("$in", "$nin"):
            known = [literal(v) for v in value if v is not None]
            part = column.isin(known) if known else F.lit(False)
            part = F.coalesce(part, F.lit(False)) | (column.isNull() if None in value else F.lit(False))
            part = ~part if op == "$nin" else part
        elif op == "$not":
            part = ~_field(name, value)
        elif op in ("$eq", "$ne"):
            part = _field(name, value)
            part = ~part if op == "$ne" else part
        elif op in ("$gt", "$gte", "$lt", "$lte"):
            other = F.lit(literal(value))
            part = {"$gt": column > other, "$gte": column >= other, "$lt": column < other, "$lte": column <= other}[op]
        else:
            raise ValueError(f"unknown operator {op}")
        parts.append(F.coalesce(part, F.lit(False)))
    return reduce(and_, parts)


def compile_filter(query: dict[str, Any]) -> Column:
    """Null counts as absent: it equals only null, and no comparison holds for it."""
    parts = []
    for key, value in query.items():
        if key in ("$and", "$or", "$nor"):
            inner = [compile_filter(q) for q in value]
            parts.append(reduce(and_, inner) if key == "$and" else reduce(or_, inner) if key == "$or" else ~reduce(or_, inner))
        else:
            parts.append(_field(key, value))
    return reduce(and_, parts, F.lit(True)) if parts else F.lit(True)


def matching_symbols(stocks: DataFrame, query: dict[str, Any]) -> DataFrame:
    """Symbols of the stocks that fit, in order; rows without one are left out."""
    return stocks.where(compile_filter(query)).where("symbol is not null").select("symbol").orderBy("symbol")


def created_after(day: str, query: dict[str, Any] | None = None) -> dict[str, Any]:
    """``query`` and a createdAt at or after ``day``."""
    newer = {"createdAt": {"$gte": day}}
    return {"$and": [query, newer]} if query else newer
