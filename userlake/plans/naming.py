"""Collecting builder functions under their own names."""

from __future__ import annotations

from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

if TYPE_CHECKING:
    from userlake.tables import Tables

    Builder = Callable[[Tables], DataFrame]


def collector(into: dict[str, Builder]) -> Callable[[Builder], Builder]:
    """Decorator that files a builder in `into` under its function name."""

    def file(builder: Builder) -> Builder:
        into[builder.__name__] = builder
        return builder

    return file


def ordered_collector(
    into: dict[str, Builder], orders: dict[str, tuple[str, ...]]
) -> Callable[..., Callable[[Builder], Builder]]:
    """Decorator factory that also files the order in which a view is shown.

    A column name means ascending, a name after "-" descending. Queries that
    read a view take it without that order, so it costs a sort only where the
    view itself is the result.
    """

    def ordered_by(*columns: str) -> Callable[[Builder], Builder]:
        def file(builder: Builder) -> Builder:
            orders[builder.__name__] = columns
            return collector(into)(builder)

        return file

    return ordered_by
