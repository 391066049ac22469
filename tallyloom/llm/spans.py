"""Spans of code points in texts: their column type, their digest, and their removal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,stop:int>>"


def joined(spans: Column) -> Column:
    """``kind:start:stop`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(of_kinds(spans, kind)).cast("long")


def without(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """``text`` with every run of overlapping spans replaced by ``mark``."""
    parts, at = [], 0
    for start, stop in sorted(spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, stop)
    return "".join([*parts, text[at:]])
