"""Declarative data-quality checks.

A check gives a number of failures: rows with a missing value, key values that occur twice,
unexpected values, rows that break a rule. All checks of a table share one pass over it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylode.functions import casts

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str
    severity: str = ERROR

    @property
    def name(self) -> str:
        return f"not_null:{self.column}"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class NotAfter:
    """No date later than a day."""
    table: str
    column: str
    as_of: dt.date | None = None
    severity: str = ERROR

    @property
    def name(self) -> str:
        return f"not_future:{self.column}"

    def broken(self) -> Column:
        return F.col(self.column) > (F.current_date() if self.as_of is None else F.lit(self.as_of))


@dataclass(frozen=True)
class AtMost:
    """A sum of columns within a limit."""
    table: str
    columns: tuple[str, ...]
    limit: int
    severity: str = ERROR

    @property
    def name(self) -> str:
        return "at_most:" + "+".join(self.columns)

    def total(self) -> Column:
        return reduce(lambda a, b: a + b, [F.col(c) for c in self.columns])

    def broken(self) -> Column:
        return self.total() > self.limit


@dataclass(frozen=True)
class Unique:
    """Key values that occur more than once; keys with a missing part are ignored."""
    table: str
    columns: tuple[str, ...]
    severity: str = ERROR

    @property
    def name(self) -> str:
        return "unique:" + "|".join(self.columns)


@dataclass(frozen=True)
class Accepted:
    """Distinct values outside a list; missing values pass."""
    table: str
    column: str
    values: tuple[str, ...]
    severity: str = ERROR

    @property
    def name(self) -> str:
        return f"accepted_values:{self.column}"


@dataclass(frozen=True)
class Readable:
    """Texts that are there but cannot be read as a number, or as a pair of coordinates."""
    table: str
    column: str
    pair: bool = False
    severity: str = WARN

    @property
    def name(self) -> str:
        return f"readable:{self.column}"

    def broken(self) -> Column:
        text = F.col(self.column)
        value = casts.latitude(text) + casts.longitude(text) if self.pair else casts.number(text)
        return (F.trim(F.coalesce(text, F.lit(""))) != "") & value.isNull()


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with its number of missing values, from one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "failures")


def repeated_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values present more than once, with their number of rows."""
    return df.dropna(subset=columns).groupBy(*columns).agg(
        F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def unexpected_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list, with their number of rows."""
    return df.filter(~F.col(column).isin(values)).groupBy(F.col(column).alias("value_field")).agg(
        F.count(F.lit(1)).alias("n_records"))


def future_dates(tables: dict[str, tuple[DataFrame, str]], as_of: dt.date | None = None) -> DataFrame:
    """Rows dated after a day, over several tables."""
    limit = F.current_date() if as_of is None else F.lit(as_of)
    parts = [
        df.filter(F.col(column) > limit).select(
            F.lit(name).alias("source_model"), F.col(column).alias("bad_date"))
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def hours_over(daily: DataFrame, hour_columns: list[str], keys: list[str], limit: int = 24) -> DataFrame:
    """Rows whose classified hours add up to more than a day has."""
    rule = AtMost("", tuple(hour_columns), limit)
    return daily.filter(rule.broken()).select(*keys, rule.total().alias("total_heures_classees"))


def run_checks(tables: dict[str, DataFrame], checks: list) -> DataFrame:
    """Evaluate checks as one DataFrame (check_name, table_name, severity, failures), one pass over each table."""
    return reduce(DataFrame.unionByName, [
        table_report(tables[table], [c for c in checks if c.table == table])
        for table in dict.fromkeys(c.table for c in checks)])


def table_report(df: DataFrame, checks: list) -> DataFrame:
    """All checks of one table from one expanded aggregate.

    The whole table is one grouping set, in which rows that break a rule are counted; each key and each
    label is another, in which groups are: values of a key that occur twice, and labels outside their list
    (listed ones are taken as missing before, so that only the others are shuffled). Equal keys are counted
    where they are read.
    """
    rules = [c for c in checks if hasattr(c, "broken")]
    columns: dict[str, Column] = {}  # what is grouped by
    sets: list[list[str]] = []
    for c in checks:
        if isinstance(c, Unique):
            columns |= {f"key_{name}": F.col(name) for name in c.columns}
            sets.append([f"key_{name}" for name in c.columns])
        elif isinstance(c, Accepted):
            columns[f"label_{c.column}"] = F.when(~F.col(c.column).isin(list(c.values)), F.col(c.column))
            sets.append([f"label_{c.column}"])
    counted = [F.count_if(F.col(f"broken_{i}")).alias(f"broken_{i}") for i in range(len(rules))]
    flags = [c.broken().alias(f"broken_{i}") for i, c in enumerate(rules)]
    names = list(columns)
    if not names:
        grouped = df.select(*flags).agg(*counted)
    else:
        grouped = df.select(*flags, *[e.alias(n) for n, e in columns.items()]).groupingSets([[], *sets], *names).agg(
            *counted, F.count(F.lit(1)).alias("rows"), F.grouping_id(*names).alias("grouping"))

    def grouping(members: list[str]) -> int:
        """The number of a grouping set: a bit for each column that is not in it, the first column highest."""
        return sum(1 << (len(names) - 1 - i) for i, n in enumerate(names) if n not in members)

    def failures(c, i: int) -> Column:
        if hasattr(c, "broken"):
            n = F.col(f"broken_{i}")
            return F.coalesce(F.max(n if not names else F.when(F.col("grouping") == grouping([]), n)), F.lit(0))
        members = [f"key_{n}" for n in c.columns] if isinstance(c, Unique) else [f"label_{c.column}"]
        there = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in members])
        least = 2 if isinstance(c, Unique) else 1
        return F.count_if((F.col("grouping") == grouping(members)) & there & (F.col("rows") >= least))

    found = grouped.agg(*[
        failures(c, rules.index(c) if c in rules else -1).alias(f"n{i}") for i, c in enumerate(checks)])
    return found.select(F.inline(F.array(*[
        F.struct(
            F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"),
            F.lit(c.severity).alias("severity"), F.col(f"n{i}").cast("long").alias("failures"))
        for i, c in enumerate(checks)])))


class QualityError(RuntimeError):
    """Raised when a check of severity error has failures."""


def gate(report: DataFrame) -> DataFrame:
    """Stop on failed error checks; warnings pass. The report has one row per check."""
    failed = report.filter((F.col("severity") == ERROR) & (F.col("failures") > 0)).collect()
    if failed:
        raise QualityError("; ".join(
            f"{r['table_name']} {r['check_name']}: {r['failures']}" for r in failed))
    return report
