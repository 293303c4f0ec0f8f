"""What several operators share: stored tables, free column names, decisions applied to rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.session import scratch_path

BROADCAST_ROWS = 500_000  # rows of an id or two; beyond it a join shuffles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: ids stay, lineage is cut, executors may go."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer until no column of the table has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table, marked for broadcast if its counted rows are few; else the join shuffles it.

    For narrow, stored tables: they are read once to count.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def documents(df: DataFrame) -> DataFrame:
    """Only ``doc_id`` as a long and ``text``, null as empty."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def text_sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def apply_decisions(spark: SparkSession, docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` keeps, with all their columns.

    ``decisions`` is a stored table of doc_id, text_sha256 and kept, a row for each row of ``docs``. Rows equal in
    doc_id and text cannot be told apart: all stay if all are kept, none if none is, and one if only some are. The
    rows that go are few beside the texts: as long as they are, they are broadcast and no text is shuffled.
    """
    doc_id, sha = fresh(docs, "gone_id", "gone_sha")
    flags = decisions.groupBy("doc_id", "text_sha256").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("kept").alias("kept")).filter(
        "kept < rows").withColumnsRenamed({"doc_id": doc_id, "text_sha256": sha})
    flags = stored(spark, flags, "flags")
    (key,) = fresh(docs, "row_sha")
    keyed = docs.withColumn(key, text_sha256(F.col("text")))

    def matches() -> Column:
        return (F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id))) & (F.col(key) == F.col(sha))

    rest = keyed.join(small(flags.select(doc_id, sha), BROADCAST_ROWS // 4), matches(), "left_anti")
    again = flags.filter("kept > 0").select(doc_id, sha)
    if not again.isEmpty():
        repeated = keyed.join(small(again, BROADCAST_ROWS // 4), matches(), "left_semi")
        rest = rest.unionByName(repeated.dropDuplicates(["doc_id", key]))
    return rest.drop(key)


def sampled(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows at most, the same ones on every run: those whose hashed key is low."""
    total = df.count()
    if total <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(key), F.lit(1 << 60)) < F.lit((1 << 60) * rows // total))


def all_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns)
