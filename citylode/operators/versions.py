"""Tables of immutable month folders behind a manifest.

A commit writes its months into a folder of its own and then publishes a manifest, one small file, that names
the folder of every month. Readers follow the newest manifest, so they see the table before a commit or after
it, never half of it, and what they have begun to read stays: folders are deleted only when no kept manifest
names them. A writer that is killed leaves a folder that nothing names; the next commit deletes it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from citylode.operators.predicates import MONTH, with_month
from citylode.operators.storage import children, create_text, read_text, remove

WHOLE = ""  # the part of a table without months
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
KEEP = 3


class ConcurrentCommit(RuntimeError):
    """Another writer published this version first."""


@dataclass(frozen=True)
class Manifest:
    """What a version consists of: a folder for each month, side tables, and notes of the writer."""
    version: int = 0
    schema: str | None = None
    parts: dict[str, str] = field(default_factory=dict)
    sides: dict[str, list[str]] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)


def part_name(month: dt.date | None) -> str:
    return f"{MONTH}={NO_MONTH if month is None else month.isoformat()}"


class VersionedTable:
    """A table at a path, with months of ``date_column`` if it has one. One writer at a time; a second one fails."""

    def __init__(self, spark: SparkSession, path: str, date_column: str | None = None, keep: int = KEEP):
        self.spark, self.path, self.date_column, self.keep = spark, path.rstrip("/"), date_column, keep

    # ------------------------------------------------------------------ reading

    def numbers(self) -> list[int]:
        """Versions with a manifest, whole or not."""
        return [int(n.split(".")[0]) for n in children(self.spark, f"{self.path}/manifest") if n.endswith(".json")]

    def manifest(self) -> Manifest:
        """The newest whole manifest; version 0 before the first commit."""
        for number in reversed(self.numbers()):
            found = self.load(number)
            if found is not None:
                return found
        return Manifest()

    def load(self, number: int) -> Manifest | None:
        """A manifest, None if its writer was killed while writing it."""
        try:
            return Manifest(**json.loads(read_text(self.spark, f"{self.path}/manifest/{number:012d}.json")))
        except json.JSONDecodeError:
            return None

    def version(self) -> int:
        return self.manifest().version

    def read(self, months: Iterable[dt.date | None] | None = None) -> DataFrame | None:
        """The current rows, of the given months only if there are any; None before the first commit."""
        manifest = self.manifest()
        if not manifest.version or manifest.schema is None:
            return None
        parts = manifest.parts
        if months is not None:
            parts = {m: parts[m] for m in map(part_name, months) if m in parts}
        schema = StructType.fromJson(json.loads(manifest.schema))
        if not parts:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        if WHOLE in parts:
            return reader.parquet(f"{self.path}/{parts[WHOLE]}")
        # Folders of several commits, each with its months: the column of the commits is dropped again.
        return reader.option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/{folder}" for folder in parts.values()]).select(*schema.fieldNames())

    def side(self, name: str) -> DataFrame | None:
        """A side table of the current version."""
        found = self.manifest().sides.get(name)
        if found is None:
            return None
        folder, schema = found
        return self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{self.path}/{folder}")

    # ------------------------------------------------------------------ writing

    def next_version(self) -> int:
        """The number that the next commit gets."""
        return max(self.numbers(), default=0) + 1

    def commit(
        self, rows: DataFrame, months: Iterable[dt.date | None] | None = None, notes: dict | None = None,
        sides: dict[str, DataFrame] | None = None,
    ) -> DataFrame:
        """Publish a version in which the given months are these rows, or the whole table if none are given.

        Months of which there are no rows become empty. Side tables and notes are published with the rows;
        those not given stay as they were. Rows may be derived from the current version. Returns the new one.
        """
        before = self.manifest()
        folder = f"commit={self.next_version()}-{uuid.uuid4().hex[:8]}"
        if self.date_column is None:
            rows.write.parquet(f"{self.path}/data/{folder}")
            schema, parts = rows.schema, {WHOLE: f"data/{folder}"}
        else:
            rows = with_month(rows.drop(MONTH), self.date_column)
            # Rebalancing gathers a month's rows into few files, and adaptive execution splits a month that
            # is too large for one task.
            rows.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(f"{self.path}/data/{folder}")
            schema = StructType([*[f for f in rows.schema if f.name != MONTH], StructField(MONTH, DateType())])
            parts = {m: f"data/{folder}/{m}" for m in children(self.spark, f"{self.path}/data/{folder}") if m.startswith(MONTH)}
            if months is not None:
                replaced = {part_name(m) for m in months}
                if not parts.keys() <= replaced:
                    raise ValueError(f"rows outside the months that are replaced: {sorted(parts.keys() - replaced)}")
                parts = {m: f for m, f in before.parts.items() if m not in replaced} | parts
        return self.publish(before, folder, json.dumps(schema.jsonValue()), parts, notes, sides)

    def annotate(self, notes: dict | None = None, sides: dict[str, DataFrame] | None = None) -> None:
        """Publish a version with the same rows and other notes or side tables."""
        before = self.manifest()
        folder = f"commit={self.next_version()}-{uuid.uuid4().hex[:8]}"
        self.publish(before, folder, before.schema, before.parts, notes, sides)

    def publish(self, before: Manifest, folder: str, schema: str | None, parts: dict, notes, sides) -> DataFrame | None:
        written = {}
        for name, df in (sides or {}).items():
            df.write.parquet(f"{self.path}/side/{folder}/{name}")
            written[name] = [f"side/{folder}/{name}", json.dumps(df.schema.jsonValue())]
        number = self.next_version()
        manifest = Manifest(number, schema, parts, before.sides | written, before.notes | (notes or {}))
        if self.manifest().version != before.version or not create_text(
                self.spark, f"{self.path}/manifest/{number:012d}.json", json.dumps(asdict(manifest))):
            raise ConcurrentCommit(f"{self.path}: version {before.version} has been replaced by another writer")
        self.collect_old()
        return self.read()

    def collect_old(self) -> None:
        """Delete manifests but the last few, and folders that none of those name."""
        numbers = self.numbers()
        kept = [m for m in map(self.load, numbers[-self.keep:]) if m is not None]
        named = {f for m in kept for f in [*m.parts.values(), *(side[0] for side in m.sides.values())]}
        for kind in ("data", "side"):
            for commit in children(self.spark, f"{self.path}/{kind}"):
                folder = f"{kind}/{commit}"
                inside = {f for f in named if f == folder or f.startswith(f"{folder}/")}
                if not inside:
                    remove(self.spark, f"{self.path}/{folder}")
                elif folder not in inside:
                    for part in children(self.spark, f"{self.path}/{folder}"):
                        if f"{folder}/{part}" not in inside and not part.startswith("_"):
                            remove(self.spark, f"{self.path}/{folder}/{part}")
        for number in numbers[:-self.keep]:
            remove(self.spark, f"{self.path}/manifest/{number:012d}.json")


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a table, None before its first commit."""
    return VersionedTable(spark, path).read()


def months_in(df: DataFrame) -> list[dt.date | None]:
    """The months that occur in a table with a month column: a calendar has few."""
    return [r[0] for r in df.select(MONTH).distinct().collect()]


def in_months(column: str, months: Iterable[dt.date | None]):
    """Whether a month is one of the given ones, a missing one included."""
    months = list(months)
    named = [m for m in months if m is not None]
    test = F.col(column).isin(named) if named else F.lit(False)
    return test | F.col(column).isNull() if len(named) < len(months) else test
