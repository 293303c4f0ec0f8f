"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Equal blocks get equal integer names, different
blocks different ones; then adjacent names are paired and the pairs named, level by level, until one name
is left. Names are numbers in sorted tables, not hashes, so texts share an identity only if all their bytes
agree. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.llm.common import apply_decisions, stored, text_sha256

BLOCK_BYTES = 4096
NO_NAME = -1


def fingerprints(block: str, bits: int, seed: int) -> str:
    """SQL of a struct of two 64-bit fingerprints of a block; ``bits`` fewer of the first alone, for tests."""
    if bits < 64:
        return f"struct(shiftrightunsigned(xxhash64({block}), {64 - bits}) as h, 0L as g)"
    return f"struct(xxhash64({block}) as h, xxhash64({seed}, {block}) as g)"


def named_blocks(
    spark: SparkSession, docs: DataFrame, block_bytes: int, bits: int,
) -> tuple[DataFrame, DataFrame]:
    """Rows (uid, doc_id, text_sha256, marks) with the fingerprints of each text's blocks, and their names.

    The blocks themselves are shuffled once, to the place of their fingerprint, equal ones already merged
    where they are read. There they are compared in full: a fingerprint that two different blocks share
    shows as least and greatest block that differ, and then all is done again with other fingerprints, so
    a name never stands for two blocks. Afterwards only fingerprints travel.
    """
    data = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
        text_sha256(F.col("text")).alias("text_sha256"),
        F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    blocks = F.expr(
        f"transform(sequence(0L, greatest(0L, (octet_length(data) - 1L) div {block_bytes})), "
        f"i -> substring(data, cast(i * {block_bytes} + 1 as int), {block_bytes}))")
    seed = 1
    while True:
        marked = data.select("uid", "doc_id", "text_sha256", blocks.alias("blocks"))
        each = marked.select(F.explode("blocks").alias("block")).select(
            F.expr(fingerprints("block", bits, seed)).alias("m"), "block")
        sorted_names = each.groupBy("m.h", "m.g").agg(
            F.min("block").alias("least"), F.max("block").alias("most")).sortWithinPartitions("h", "g").select(
            "h", "g", F.monotonically_increasing_id().alias("name"), (F.col("least") != F.col("most")).alias("clash"))
        names = stored(spark, sorted_names, "block-names")
        if names.filter("clash").isEmpty():
            break
        bits, seed = 128, seed + 1
    marks = F.expr(f"transform(blocks, b -> {fingerprints('b', bits, seed)})").alias("marks")
    rows = stored(spark, marked.select("uid", "doc_id", "text_sha256", marks), "marks")
    return rows, names.select("h", "g", "name")


def identities(spark: SparkSession, rows: DataFrame, names: DataFrame) -> DataFrame:
    """(uid, level, name): equal level and name exactly where the texts are equal."""
    one = rows.filter(F.size("marks") == 1).select("uid", F.col("marks")[0].alias("m")).select("uid", "m.h", "m.g")
    done = [one.join(names, ["h", "g"]).select("uid", F.lit(0).alias("level"), "name")]
    longest = rows.agg(F.max(F.size("marks"))).first()[0] or 1
    many = rows.filter(F.size("marks") > 1).select(
        "uid", F.size("marks").alias("n"), F.posexplode("marks").alias("pos", "m")).select(
        "uid", "n", "pos", "m.h", "m.g")
    level, current = 0, many.join(names, ["h", "g"]).select("uid", "n", "pos", "name")
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        even = F.col("pos") % 2 == 0
        pairs = stored(spark, current.groupBy("uid", "n", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.max(F.when(even, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NO_NAME)).alias("right")), "pairs")
        pair_names = stored(spark, pairs.select("left", "right").distinct().sortWithinPartitions(
            "left", "right").withColumn("name", F.monotonically_increasing_id()), "pair-names")
        named = pairs.join(pair_names, ["left", "right"]).select(
            "uid", ((F.col("n") + 1) / 2).cast("int").alias("n"), "pos", "name")
        done.append(named.filter("n = 1").select("uid", F.lit(level).alias("level"), "name"))
        current = named.filter("n > 1")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_duplicates(
    spark: SparkSession, docs: DataFrame, block_bytes: int = BLOCK_BYTES, bits: int = 128,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest doc_id
    stays; a null doc_id is smaller than any, and of rows equal in both, one stays. A group of null ids
    has a null keep_id. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    rows, names = named_blocks(spark, docs, block_bytes, bits)
    named = stored(spark, identities(spark, rows, names).join(
        rows.select("uid", "doc_id", "text_sha256"), "uid"), "identities")
    groups = named.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "uid")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    return named.join(groups, ["level", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("keep.uid")).alias("kept"), "text_sha256")


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decisions = exact_duplicates(spark, docs, **options).select("doc_id", "text_sha256", "kept")
    return apply_decisions(spark, docs, stored(spark, decisions, "exact"))
