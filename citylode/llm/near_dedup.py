"""Near-duplicates by MinHash bands and sequential Bayesian verification.

Texts with the same shingle set are one class from the start. Classes that share a band of their signatures
are candidates; the signatures of a candidate pair are compared batch by batch, and the pair is dropped as
soon as the posterior probability that its similarity reaches the threshold is below the miss probability.
What is left is verified on the full shingle sets.

Inside a bucket not all pairs are made. Every member is compared with two of them first; links found so
join components. Only buckets whose members are then in different components need more. There the members
outside the bucket's largest component meet further members in a few turns, and those still outside are
compared with all of other components in blocks, inside tasks, so that no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.llm import scan
from citylode.llm.common import apply_decisions, documents, small, stored, text_sha256
from citylode.llm.components import connected_components

BANDS, ROWS = 32, 5  # at similarity 0.8 a pair shares no band once in 300,000
HASHES = BANDS * ROWS
BATCH = 32
MISS = 1e-7
BLOCK = 1024  # members of a bucket compared in one task with as many others
CELL = 1024  # nodes whose full sets are held in one task with as many others
CELL_SHINGLES = 1 << 21  # shingles of a cell, if its sets are large
ROW_PAIRS = 1 << 16  # pairs of nodes in one row
TURNS = 2  # further hubs before members are compared in blocks
RNG = np.random.default_rng(20)
XOR = RNG.integers(1 << 32, size=HASHES, dtype=np.uint32)[:, None]
TIMES = (RNG.integers(1 << 31, size=HASHES, dtype=np.uint32) * 2 + 1).astype(np.uint32)[:, None]

SKETCH = "doc_id bigint, text_sha256 string, n_shingles bigint, digest binary, signature binary"
SETS = "doc_id bigint, digest binary, shingles array<bigint>"


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of each of the hash functions over a set of shingles."""
    values, least = (shingles >> np.uint64(32)).astype(np.uint32), np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(values), 4096):
        h = (values[None, i:i + 4096] ^ XOR) * TIMES
        h ^= h >> np.uint32(15)
        np.minimum(least, h.min(axis=1), out=least)
    return least


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The shingle set of every text of a column."""
    data, offsets = scan.bytes_of(texts)
    for lo, hi in scan.slices(offsets):
        part = offsets[lo:hi + 1]
        hashes, ends = scan.word_hashes(data[part[0]:part[-1]], part - part[0])
        for k in range(hi - lo):
            yield scan.shingles(hashes[ends[k]:ends[k + 1]], words)


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Size, digest and MinHash signature of every text's shingle set."""
    def work(batches):
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for s in shingle_sets(batch.column(1), words):
                sizes.append(len(s))
                digests.append(digest(s))
                signatures.append(signature(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.binary())],
                ["doc_id", "text_sha256", "n_shingles", "digest", "signature"])

    return documents(docs).withColumn("text_sha256", text_sha256(F.col("text"))).mapInArrow(work, SKETCH)


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """The shingle set of every text."""
    def work(batches):
        for part in (batch.slice(i, 500) for batch in batches for i in range(0, batch.num_rows, 500)):
            sets = list(shingle_sets(part.column(1), words))
            ends = np.cumsum([0, *map(len, sets)])
            flat = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(map(digest, sets), pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["doc_id", "digest", "shingles"])

    return documents(docs).mapInArrow(work, SETS)


def buckets_of(signatures: np.ndarray) -> np.ndarray:
    """The bucket of every band (columns) of every signature (rows)."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    bucket = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2])
    for r in range(ROWS):
        bucket = scan.mix(bucket * np.uint64(scan.BASE) + rows[:, :, r])
    return bucket.view(np.int64)


def band_rows(classes: DataFrame) -> DataFrame:
    """(bucket, node) for every band of every class's signature."""
    def work(batches):
        for batch in batches:
            bucket = buckets_of(matrix(batch.column(1)))
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.reshape(-1)), pa.array(nodes)], ["bucket", "node"])

    return classes.select("node", "signature").mapInArrow(work, "bucket bigint, node bigint")


def matrix(signatures: pa.Array) -> np.ndarray:
    """A column of signatures as a matrix."""
    return np.frombuffer(b"".join(signatures.to_pylist()), np.uint32).reshape(len(signatures), HASHES)


def least_matches(threshold: float, miss: float = MISS) -> list[int]:
    """For each batch, the matches so far below which a pair is dropped.

    With m of n hashes equal and an even prior, the similarity has the posterior Beta(m + 1, n - m + 1); it
    reaches t with the probability that a binomial of n + 1 trials at t is at most m.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        p, m = (1 - threshold) ** (n + 1), 0
        while p < miss and m <= n:
            m += 1
            p += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def plausible(a: np.ndarray, b: np.ndarray, limits: list[int]) -> np.ndarray:
    """Which of the signature pairs (row by row) are not dropped in any batch."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, limit in enumerate(limits):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (a[alive, part] == b[alive, part]).sum(axis=1)
        keep = matches >= limit
        alive, matches = alive[keep], matches[keep]
    return alive


def prune(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Candidate pairs (a, b) that the posterior does not rule out."""
    limits = least_matches(threshold)

    def work(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                alive = plausible(matrix(part.column(2)), matrix(part.column(3)), limits)
                yield part.select([0, 1]).take(pa.array(alive))

    a = classes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    b = classes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(work, "a bigint, b bigint")


PAIRS = "left bigint, right bigint, a array<bigint>, b array<bigint>"


def blockwise(members: DataFrame, threshold: float) -> DataFrame:
    """Pairs of a bucket's members in different components that the posterior does not rule out.

    A bucket is cut into blocks of about BLOCK members, the largest component apart from the rest; a task
    compares two blocks, never two of the largest component. A pair that meets in several buckets is compared
    in the one of its first common band. A row holds all pairs (a, b) that a task leaves between the members
    of two cells, ROW_PAIRS at most, so pairs are not rows.
    """
    limits = least_matches(threshold)

    def work(group: pa.Table) -> pa.Table:
        node, root, cell, own, i, j = (group.column(k).to_numpy() for k in ("node", "root", "cell", "own", "i", "j"))
        out_a, out_b = [], []
        if len(np.unique(root)) > 1:
            signatures = matrix(group.column("signature").combine_chunks())
            buckets = buckets_of(signatures)
            band = int(np.flatnonzero(buckets[0] == group.column("bucket")[0].as_py())[0])
            right = np.flatnonzero(own == j[0])
            for x in np.flatnonzero(own == i[0]):
                y = right[(root[right] != root[x]) & ((node[right] > node[x]) | (i[0] != j[0]))]
                y = y[(buckets[y, :band] != buckets[x, :band]).all(axis=1)]
                y = y[plausible(np.broadcast_to(signatures[x], (len(y), HASHES)), signatures[y], limits)]
                out_a.append(np.full(len(y), x))
                out_b.append(y)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_a, out_b))
        flip = cell[a] > cell[b]
        a, b = np.where(flip, b, a), np.where(flip, a, b)
        order = np.lexsort((cell[b], cell[a]))
        a, b = a[order], b[order]
        cut = np.arange(len(a)) % ROW_PAIRS == 0
        cut[1:] |= (cell[a][1:] != cell[a][:-1]) | (cell[b][1:] != cell[b][:-1])
        edges = np.flatnonzero(cut)
        ends = pa.array(np.append(edges, len(a)), pa.int32())
        return pa.table({
            "left": cell[a[edges]], "right": cell[b[edges]],
            "a": pa.ListArray.from_arrays(ends, pa.array(node[a])), "b": pa.ListArray.from_arrays(ends, pa.array(node[b]))})

    sizes = members.groupBy("bucket").agg(
        F.ceil(F.count_if(~F.col("rest")) / BLOCK).cast("int").alias("main_blocks"),
        F.ceil(F.count_if("rest") / BLOCK).cast("int").alias("rest_blocks"))
    draw, end = F.xxhash64("node"), F.col("main_blocks") + F.col("rest_blocks") - 1
    own = F.when(F.col("rest"), F.col("main_blocks") + F.pmod(draw, "rest_blocks")).otherwise(F.pmod(draw, "main_blocks"))
    others = F.sequence(F.when(F.col("rest"), 0).otherwise(F.col("main_blocks")), end)
    dealt = members.join(sizes, "bucket").withColumn("own", own.cast("int")).select(
        "*", F.explode(others).alias("other")).select(
        "bucket", "node", "root", "cell", "signature", "own",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return dealt.groupBy("bucket", "i", "j").applyInArrow(work, PAIRS)


def cells(labels: DataFrame, likely: DataFrame, members: DataFrame, weights: DataFrame) -> DataFrame:
    """(node, root, cell): cells of about CELL nodes that are at home in the same component.

    ``weights`` gives (node, n_shingles); a cell holds fewer nodes if their sets pass CELL_SHINGLES together.

    A node is at home in the smallest component among its own and those of its likely partners, so that nodes
    which must be verified against each other lie in few cells.
    """
    near = likely.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        likely.select(F.col("b").alias("node"), F.col("a").alias("other")))
    homes = near.join(labels.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(
        F.min("root").alias("home"))
    placed = members.select("node").distinct().join(weights, "node").join(labels, "node", "left").join(homes, "node", "left").select(
        "node", "n_shingles", F.coalesce("root", "node").alias("root"),
        F.least(F.coalesce("home", "node"), F.coalesce("root", "node")).alias("home"))
    sizes = placed.groupBy("home").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / CELL, F.sum("n_shingles") / CELL_SHINGLES)).alias("parts"))
    return placed.join(sizes, "home").select(
        "node", "root", F.xxhash64("home", F.pmod(F.xxhash64("node"), "parts")).alias("cell"))


def cell_nodes(pairs: DataFrame) -> DataFrame:
    """(l, r, node): the nodes whose sets each pair of cells needs, each once."""
    return pairs.groupBy(F.col("left").alias("l"), F.col("right").alias("r")).agg(
        F.array_distinct(F.flatten(F.collect_list(F.array_union("a", "b")))).alias("nodes")).select(
        "l", "r", F.explode("nodes").alias("node"))


def verify_cells(pairs: DataFrame, wanted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the stored pairs of cells, as few as join the same nodes.

    ``wanted`` holds the nodes of each pair of cells, see ``cell_nodes``. A task holds the sets of two cells and counts intersections for all pairs between them.
    """
    def work(group: pa.Table, members: pa.Table) -> pa.Table:
        shingles = members.column("shingles").combine_chunks()
        ends = np.cumsum([0, *shingles.value_lengths().to_pylist()])
        _, codes = np.unique(shingles.flatten().to_numpy(), return_inverse=True)
        at = {n: k for k, n in enumerate(members.column("node").to_pylist())}
        parent = list(range(len(at)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        a, b = (np.array([at[n] for n in group.column(k).combine_chunks().flatten().to_pylist()], np.int64) for k in "ab")
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        flags, found = np.zeros(len(codes) + 1, bool), []
        for part in np.split(np.arange(len(a)), np.flatnonzero(np.diff(a)) + 1) if len(a) else []:
            x = a[part[0]]
            own = codes[ends[x]:ends[x + 1]]
            flags[own] = True
            for y in np.unique(b[part]):
                if find(x) == find(y):
                    continue
                common = int(np.count_nonzero(flags[codes[ends[y]:ends[y + 1]]]))
                size = len(own) + int(ends[y + 1] - ends[y])
                if 100 * common >= percent * (size - common):
                    parent[find(x)] = find(y)
                    found.append((x, y))
            flags[own] = False
        names = members.column("node").to_numpy()
        links = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": names[links[:, 0]], "b": names[links[:, 1]]})

    return pairs.groupBy("left", "right").cogroup(wanted.join(sets, "node").groupBy("l", "r")).applyInArrow(work, "a bigint, b bigint")


def sets_of(spark: SparkSession, nodes: DataFrame, docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the nodes, stored.

    A class is read from the text that stands for it; repeated rows of that text are the same set.
    """
    wanted = stored(spark, classes.join(nodes, "node", "left_semi").select("node", "digest", "doc_id"), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        small(wanted.select("doc_id")), "doc_id", "left_semi")
    return stored(spark, full_sets(texts, words).join(wanted, ["doc_id", "digest"]).dropDuplicates(
        ["node"]).select("node", "shingles"), "sets")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return pairs.join(b, "b").join(a, "a").withColumn("common", common).filter(
        100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b")


def mixed_members(spark: SparkSession, members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, root, rest) of the buckets that hold several components, stored.

    ``rest`` is false for the members of a bucket's largest component.
    """
    labelled = members.select("bucket", "node").join(labels, "node", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("root"))
    sizes = labelled.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("bucket").agg(
        F.max_by("root", "size").alias("main"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
    return stored(spark, labelled.join(largest, "bucket").select(
        "bucket", "node", "root", (F.col("root") != F.col("main")).alias("rest")), "mixed")


def hub_pairs(mixed: DataFrame, turn: int) -> DataFrame:
    """(a, b): the rest of every bucket with one member of its largest component and one of the rest.

    The two are drawn for each bucket and turn, so a node meets others in each of its buckets.
    """
    lot = F.xxhash64("node", "bucket", F.lit(turn))
    hubs = mixed.groupBy("bucket").agg(
        F.min_by("node", F.when(~F.col("rest"), lot)).alias("first"),
        F.min_by("node", F.when(F.col("rest"), lot)).alias("last"))
    return mixed.filter("rest").join(hubs, "bucket").select("node", F.explode(F.array("first", "last")).alias("hub")).filter(
        "node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def links(
    spark: SparkSession, docs: DataFrame, classes: DataFrame, words: int, percent: int,
) -> DataFrame | None:
    """(node, root) of all classes that a link joins to another; None if there is no candidate."""
    bands = band_rows(classes)
    shared = bands.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("first"), F.max("node").alias("last")).filter("n > 1")
    members = stored(spark, bands.join(shared, "bucket"), "members")
    star = stored(spark, members.select(
        "node", F.explode(F.array_distinct(F.array("first", "last"))).alias("hub")).filter("node <> hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "star")
    if star.isEmpty():
        return None
    used = stored(spark, star.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "used")
    candidates = stored(spark, classes.join(small(used), "node", "left_semi"), "candidates")

    def confirmed(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The pairs that the posterior leaves, and those of them that are links."""
        left = stored(spark, prune(pairs, candidates, percent / 100), "likely")
        ends = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = sets_of(spark, ends, docs, candidates, words)
        return left, stored(spark, verify(left, sets, percent), "linked")

    likely, linked = confirmed(star)
    labels = connected_components(spark, linked)
    # The first two hubs settle buckets of up to three members.
    mixed = mixed_members(spark, members.filter("n > 3"), labels)
    for turn in range(TURNS):
        if mixed.isEmpty():
            return labels
        more_likely, more_linked = confirmed(stored(spark, hub_pairs(mixed, turn), "hubs"))
        likely, linked = likely.unionByName(more_likely), linked.unionByName(more_linked)
        labels = connected_components(spark, linked)
        mixed = mixed_members(spark, mixed, labels)

    placed = stored(spark, cells(labels, likely, mixed, candidates.select("node", "n_shingles")), "cells")
    left_over = mixed.drop("root").join(placed, "node").join(candidates.select("node", "signature"), "node")
    more = stored(spark, blockwise(left_over, percent / 100), "more")
    if more.isEmpty():
        return labels
    needed = stored(spark, cell_nodes(more), "needed")
    sets = sets_of(spark, needed.select("node").distinct(), docs, candidates, words)
    found = verify_cells(more, needed, sets, percent)
    return connected_components(spark, linked.unionByName(stored(spark, found, "found")))


def near_duplicates(
    spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, text_sha256.

    A text's set holds its distinct runs of ``words`` words (bytes other than 9 to 13 and 32, A to Z as
    lower case); with fewer words, all of them as one run. Sets with 100 * intersection >= percent * union
    are linked; component_id is the smallest doc_id reachable, and the row that has it is kept. Null and
    word-less texts have empty sets and link with nothing. A row without doc_id links with nothing, has no
    component_id and is kept. Rows that share a doc_id are judged by their own texts. Runs are told apart by
    64-bit hashes, sets by 128-bit ones. An empty table gives no rows; other columns are not read.
    """
    base = stored(spark, sketches(docs, words), "sketches")
    classes = stored(spark, base.filter("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("signature").alias("signature"),
        F.any_value("n_shingles").alias("n_shingles")).withColumn(
        "node", F.monotonically_increasing_id()), "classes")
    labels = links(spark, docs, classes, words, percent)
    named = classes.select("digest", "node", "doc_id")
    if labels is None:
        found = named.select("digest", F.col("doc_id").alias("component_id"))
    else:
        rooted = stored(spark, named.join(labels, "node", "left").select(
            "digest", "doc_id", F.coalesce("root", "node").alias("root")), "rooted")
        found = rooted.join(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select(
            "digest", "component_id")
    component = F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(
        F.col("component_id"))
    return base.select("doc_id", "n_shingles", "digest", "text_sha256").join(found, "digest", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), "text_sha256")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``, with all columns."""
    decisions = near_duplicates(spark, docs, words, percent).select("doc_id", "text_sha256", "kept")
    return apply_decisions(spark, docs, stored(spark, decisions, "near"))
