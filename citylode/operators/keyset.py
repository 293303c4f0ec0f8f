"""Pages by position in an order, not by number: a page begins after the last row of the one before.

No task keeps more rows than a page holds, however far the reader has come, and the leading column prunes what
lies before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class By:
    """A column of an order; missing values come first."""
    column: str
    descending: bool = False

    def ordering(self) -> Column:
        return F.col(self.column).desc_nulls_first() if self.descending else F.col(self.column).asc_nulls_first()

    def backward(self) -> Column:
        return F.col(self.column).asc_nulls_last() if self.descending else F.col(self.column).desc_nulls_last()

    def same(self, value) -> Column:
        return F.col(self.column).isNull() if value is None else F.col(self.column) == F.lit(value)

    def later(self, value) -> Column:
        """Strictly after a value."""
        if value is None:
            return F.col(self.column).isNotNull()
        return F.col(self.column) < F.lit(value) if self.descending else F.col(self.column) > F.lit(value)


def seek(order: list[By], last: dict) -> Column:
    """Rows that come after the row ``last``: later in some column and the same in those before it.

    The leading column is also tested alone, as that is what a scan can use.
    """
    tests, before = [], []
    for by in order:
        tests.append(reduce(lambda a, b: a & b, [*before, by.later(last[by.column])]))
        before.append(by.same(last[by.column]))
    head = order[0]
    return (head.later(last[head.column]) | head.same(last[head.column])) & reduce(lambda a, b: a | b, tests)


def page(df: DataFrame, order: list[By], size: int, last: dict | None = None) -> DataFrame:
    """The first rows, or the first ones after ``last``. The order must tell all rows apart."""
    rest = df if last is None else df.filter(seek(order, last))
    return rest.orderBy(*[by.ordering() for by in order]).limit(size)


def pages(df: DataFrame, order: list[By], size: int) -> Iterator[list]:
    """All pages in turn, as a client reads them: one page at a time is on the driver."""
    last = None
    while True:
        rows = page(df, order, size, last).collect()
        if rows:
            yield rows
        if len(rows) < size:
            return
        last = rows[-1].asDict()
