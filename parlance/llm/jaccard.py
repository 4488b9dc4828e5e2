"""N-gram Jaccard join: exact groups of documents whose shingle sets are near.

Jaccard distance is a metric. Documents that share nothing are all at distance
one from each other, so regions around pivots that are documents would have to
copy every document into every region. The pivots of the first level are
therefore single shingles: every document belongs to the regions of its nearest
pivots, where the pivots are ranked by one order of all shingles, and the window
of boundary regions that it has to be copied to follows from the triangle
inequality. Two sets that link differ in at most a fifth of either, so a common
shingle must be among the first n - ceil(0.8 n) + 1 of both in that order. The
order puts shingles that many documents share last, so that common passages
rarely make a region; it decides cost only, never the result.

A region of up to ``LEAF`` documents is compared directly. Larger ones are split
again by pivots that are documents: the pivots are compared with all members,
their balls become one component, regions inside one component are done, and
what remains is joined recursively around new pivots, those of the smallest
components first. Links between members of one component need not be looked at,
so a large group of near copies costs a multiple of its size, not its square.

Before two sets are fetched, a window test on parity sketches drops pairs that
cannot link: every differing shingle flips one bit, so the number of different
bits is a lower bound of the symmetric difference, which is a metric as well.

Equal sets are one node of the graph, so copies are neither paired nor expanded.

Defined results: words are lower-cased in A-Z. A text of one to four words is a
set of one element, its sequence of words; a null or empty text has an empty
set and links with nothing. Null ids take part, and the component id is the
smallest id that is not null. Repeated rows share a component. Extra columns do
not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from parlance.llm import words as W
from parlance.llm.components import components
from parlance.llm.storage import free_names, one_row, release, stored

SHINGLE = 5
LEAF = 16
# Pivots of a region in the first round of the recursion, and the factor by which they grow.
FIRST_PIVOTS, MORE_PIVOTS = 4, 8
SKETCH_BITS = 1024
# Shingles are counted in blocks of this many; those found three times in a block are common.
BLOCK = 1_500_000
COMMON_IN_BLOCK = 3
# A table of up to so many ids is sent to every executor; a larger one is joined with a shuffle.
SENT_IDS = 2_000_000
# Common shingles that are ranked last by number of documents; 8 bytes each go to every executor.
MAX_COMMON = 1 << 19

PROFILE = "doc_id bigint, n int, node bigint, mark bigint, sketch array<bigint>, shingle bigint, found bigint"
SKETCH = pa.list_(pa.int64())
PROFILE_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("mark", pa.int64()), ("sketch", SKETCH),
    ("shingle", pa.int64()), ("found", pa.int64()),
])


def shingle_sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a batch."""
    for piece in W.pieces(batch, "text"):
        data, offsets = W.texts_of(piece.column("text"))
        found = W.words_of(W.FOLD[data], offsets, W.SPACED)
        shingles = W.runs_hash(found.hash, SHINGLE)
        for a, b in zip(found.first[:-1], found.first[1:], strict=True):
            if b - a >= SHINGLE:
                ordered = np.sort(shingles[a:b - SHINGLE + 1])
                fresh = np.ones(len(ordered), bool)
                fresh[1:] = ordered[1:] != ordered[:-1]
                yield ordered[fresh]
            else:
                yield W.runs_hash(found.hash[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64)


def _name(shingles: np.ndarray, seed: int) -> tuple[int, int]:
    """Two independent 64-bit sums that name a set."""
    salted = W.mix(shingles + np.uint64((2 * seed + 1) * int(W.ODD) % (1 << 64)))
    return int(salted.sum(dtype=np.uint64).view(np.int64)), int(W.mix(salted).sum(dtype=np.uint64).view(np.int64))


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """One bit per class of shingles, in 64-bit words: whether the set holds an odd number of them."""
    odd = np.bincount((shingles % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _common(block: list[np.ndarray]) -> pa.RecordBatch:
    values, counts = np.unique(np.concatenate(block), return_counts=True)
    often = counts >= COMMON_IN_BLOCK
    n = int(often.sum())
    return pa.RecordBatch.from_arrays([
        pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
        pa.nulls(n, SKETCH), W.as_long(values[often]), pa.array(counts[often], pa.int64()),
    ], schema=PROFILE_ARROW)


def _profiler(seed: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[np.ndarray] = []
        seen: set[int] = set()
        held = 0
        for batch in batches:
            sizes, nodes, marks, sketches = [], [], [], []
            for shingles in shingle_sets(batch):
                sizes.append(len(shingles))
                node, mark = _name(shingles, seed) if len(shingles) else (None, None)
                nodes.append(node)
                marks.append(mark)
                sketches.append(_sketch(shingles) if len(shingles) else None)
                if len(shingles) and node not in seen:
                    seen.add(node)
                    block.append(shingles)
                    held += len(shingles)
                    if held > BLOCK:
                        yield _common(block)
                        block, held = [], 0
                        seen.clear()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(nodes, pa.int64()),
                pa.array(marks, pa.int64()), pa.array(sketches, SKETCH),
                pa.nulls(len(batch), pa.int64()), pa.nulls(len(batch), pa.int64()),
            ], schema=PROFILE_ARROW)
        if block:
            yield _common(block)

    return profile


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def _profiles(spark: SparkSession, documents: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Profile rows, distinct sets, and the seed under which no two different sets share a name."""
    seed = 0
    while True:
        rows = stored(spark, _texts(documents).mapInArrow(_profiler(seed), PROFILE), "jaccard-profile")
        nodes = stored(spark, rows.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
            (F.min("mark") != F.max("mark")).alias("clash")), "jaccard-nodes")
        if not one_row(nodes.agg(F.coalesce(F.max(F.col("clash").cast("int")), F.lit(0))))[0]:
            return rows, nodes.drop("clash"), seed
        seed += 1


def _common_shingles(counts: DataFrame) -> np.ndarray:
    """Common shingles, rarest first, from ``shingle`` and the documents it was ``found`` in.

    At most ``MAX_COMMON``: the most frequent ones by powers of two.
    """
    counts = counts.groupBy("shingle").agg(F.max("found").alias("found"))
    level = F.floor(F.log2("found"))
    levels = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, least = 0, None
    for row in levels:
        total += row["count"]
        if total > MAX_COMMON:
            break
        least = row["level"]
    if least is None:
        return np.zeros(0, np.uint64)
    found = counts.where(level >= least).toPandas()
    keys = found["shingle"].to_numpy(np.int64).view(np.uint64)
    return keys[np.lexsort((keys, found["found"].to_numpy()))]


def _prefixes(shared, seed: int):
    """Regions of each document: the first shingles of its set, common ones last."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        by_key = np.argsort(common, kind="stable")
        keys = common[by_key]
        seen: set[int] = set()
        for batch in batches:
            regions, nodes, sizes = [], [], []
            for shingles in shingle_sets(batch):
                n = len(shingles)
                if not n:
                    continue
                node = _name(shingles, seed)[0]
                if node in seen:
                    continue
                seen.add(node)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
                    often = keys[at] == shingles
                    shingles = np.concatenate((shingles[~often], common[np.sort(by_key[at[often]])]))
                regions.append(shingles[:n - (4 * n + 4) // 5 + 1])
                nodes.append(node)
                sizes.append(n)
            if len(seen) > 1_000_000:
                seen.clear()
            if not nodes:
                continue
            lengths = [len(r) for r in regions]
            yield pa.RecordBatch.from_arrays([
                W.as_long(np.concatenate(regions)), pa.array(np.repeat(np.array(nodes, np.int64), lengths)),
                pa.array(np.repeat(np.array(sizes, np.int32), lengths)),
            ], ["region", "node", "n"])

    return emit


def _regions(spark: SparkSession, documents: DataFrame, common: np.ndarray, seed: int) -> DataFrame:
    """Members of all regions with at least two documents: ``region``, ``node``, ``n``, ``members``."""
    shared = spark.sparkContext.broadcast(common)
    rows = _texts(documents).mapInArrow(_prefixes(shared, seed), "region bigint, node bigint, n int")
    # Dealt by region once; the counts and the removal of copies from other tasks need no other exchange.
    members = F.count("*").over(Window.partitionBy("region")).alias("members")
    alive = rows.repartition("region").select("*", members).where("members > 1").drop("members")
    alive = alive.dropDuplicates(["region", "node"]).select("*", members).where("members > 1")
    return stored(spark, alive, "jaccard-regions")


def _near_sizes(a: str, b: str):
    """Sets of very different sizes cannot link."""
    return (5 * F.least(a, b)) >= (4 * F.greatest(a, b))


def _leaf_pairs(regions: DataFrame) -> DataFrame:
    """All pairs of the regions of at most ``LEAF`` documents."""
    grouped = regions.where(F.col("members") <= LEAF).groupBy("region").agg(
        F.sort_array(F.collect_list(F.struct("n", "node"))).alias("m"))
    partners = F.filter(F.slice(F.col("m"), F.col("i") + 2, F.lit(LEAF)), lambda y: 4 * y["n"] <= 5 * F.col("x")["n"])
    return (
        grouped.select("m", F.posexplode("m").alias("i", "x"))
        .select(F.col("x")["node"].alias("one"), F.explode(partners).alias("two"))
        .select(F.least("one", F.col("two")["node"]).alias("a"), F.greatest("one", F.col("two")["node"]).alias("b"))
        .distinct()
    )


def _window_test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        one, two = (
            batch.column(c).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(batch), -1)
            for c in ("sa", "sb"))
        differ = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
        # J >= 0.8 means that at most a ninth of |a| + |b| differs.
        sizes = batch.column("na").to_numpy().astype(np.int64) + batch.column("nb").to_numpy()
        yield batch.select(["a", "b"]).filter(pa.array(9 * differ <= sizes))


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that the sketches do not rule out."""
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(
        _window_test, "a bigint, b bigint")


def _set_rows(seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for s in shingle_sets(batch) if len(s)]
            yield pa.RecordBatch.from_arrays([
                pa.array([_name(s, seed)[0] for s in sets], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ], ["node", "shingles"])

    return rows


def _sendable(ids: DataFrame) -> DataFrame:
    """A stored table of ids, marked for sending if its counted size is within the bound."""
    return F.broadcast(ids) if ids.count() <= SENT_IDS else ids


def _sets(spark: SparkSession, documents: DataFrame, nodes: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """Shingle sets of the wanted nodes, from the texts of their first documents.

    Repeated ids may bring sets that nobody asks for; they meet no pair.
    """
    needed = wanted.distinct().join(nodes.select("node", "doc_id"), "node")
    ids = stored(spark, needed.select(F.col("doc_id").alias("id")).distinct(), "jaccard-ids")
    texts = _texts(documents).join(_sendable(ids), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")
    return stored(spark, texts.mapInArrow(_set_rows(seed), "node bigint, shingles binary"), "jaccard-sets")


def _link_test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for one, two in zip(batch.column("xa"), batch.column("xb"), strict=True):
            a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (one, two))
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            common = int((b[at] == a).sum())
            linked.append(100 * common >= 80 * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that link, by their whole sets."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "xa", "xb").mapInArrow(_link_test, "a bigint, b bigint")


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after a look at the edges: nodes take the smallest label within two links.

    Equal labels always mean the same component. The labels only spare
    comparisons, so they need not be complete.
    """
    one = labels.select(F.col("node").alias("a"), F.col("label").alias("u"))
    two = labels.select(F.col("node").alias("b"), F.col("label").alias("v"))
    ends = edges.join(one, "a").join(two, "b").where("u <> v").select(
        F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")
    ).select("e.u", "e.v")
    least = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moves = ends.join(least, "u").groupBy(F.col("v").alias("label")).agg(F.min("m").alias("to"))
    return labels.join(moves, "label", "left").select("node", F.coalesce("to", "label").alias("label"))


def _in_window(one: str, two: str, n: str, m: str):
    """The window test of :func:`_window_test` as a join condition."""
    differ = F.aggregate(
        F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, bits: total + bits)
    return (9 * differ) <= (F.col(n) + F.col(m))


def _split_regions(
    spark: SparkSession, regions: DataFrame, nodes: DataFrame, sets: DataFrame, edges: DataFrame,
) -> list[DataFrame]:
    """Links of the regions above ``LEAF`` documents, by recursion around pivots.

    The first pivots are central ones, the documents in most regions, whose balls
    join most of a crowd of near copies. The next ones are those that are left
    over. A pivot is compared with all members of its regions in other
    components and is done then.
    """
    members = regions.where(F.col("members") > LEAF).select("region", "node")
    central = members.groupBy("node").agg(F.count("*").alias("central"))
    open_regions = members.join(central, "node").join(nodes.select("node", "n", "sketch"), "node")
    labels = central.select("node", F.col("node").alias("label"))
    found, pivots = [edges], FIRST_PIVOTS
    order = (F.desc("central"), F.xxhash64("node"), "node")
    while True:
        labels = stored(spark, _merged(labels, found[-1]), "jaccard-labels")
        labelled = open_regions.join(labels, "node")
        # Sums and limits per region combine on the map side, so a crowded region is not gathered.
        mixed = labelled.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        crowds = labelled.groupBy("region", "label").agg(F.count("*").alias("crowd"))
        open_regions = stored(spark, labelled.join(mixed.select("region"), "region", "left_semi").join(
            crowds, ["region", "label"]), "jaccard-open")
        if open_regions.isEmpty():
            return found
        place = F.row_number().over(Window.partitionBy("region").orderBy(*order))
        chosen = stored(spark, open_regions.withColumn("place", place).where(F.col("place") <= pivots).select(
            "region", F.col("node").alias("p"), F.col("n").alias("pn"), F.col("sketch").alias("ps"),
            F.col("label").alias("plabel")), "jaccard-pivots")
        pairs = open_regions.join(chosen, "region").where(
            (F.col("label") != F.col("plabel")) & _near_sizes("n", "pn") & _in_window("sketch", "ps", "n", "pn"))
        pairs = stored(spark, pairs.select(
            F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct(), "jaccard-pairs")
        # A round looks at few of the sets; the others are not moved.
        ends = stored(spark, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "jaccard-ends")
        some = sets.join(_sendable(ends), "node", "left_semi")
        found.append(stored(spark, _linked(pairs, some).distinct(), "jaccard-links"))
        release(spark)
        done = chosen.select("region", F.col("p").alias("node"))
        open_regions = open_regions.select("region", "node", "n", "sketch", "central").join(
            done, ["region", "node"], "left_anti")
        order = (F.asc("crowd"), F.xxhash64("node"), "node")
        pivots *= MORE_PIVOTS


def _grouped(spark: SparkSession, documents: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Profile rows, nodes with their component, and the seed of the names."""
    rows, nodes, seed = _profiles(spark, documents)
    # The blocks know the most common shingles; the regions that come of that order know the others.
    counts = rows.where("shingle is not null").groupBy("shingle").agg(F.sum("found").alias("found"))
    first = _regions(spark, documents, _common_shingles(counts), seed)
    crowded = first.where(F.col("members") > LEAF // 2).groupBy(F.col("region").alias("shingle")).agg(
        F.max("members").alias("found"))
    release(spark)
    regions = _regions(spark, documents, _common_shingles(counts.unionByName(crowded)), seed)
    release(spark)
    candidates = stored(spark, _possible(_leaf_pairs(regions), nodes), "jaccard-pairs")
    wanted = candidates.select(F.col("a").alias("node")).unionByName(candidates.select(F.col("b").alias("node")))
    wanted = wanted.unionByName(regions.where(F.col("members") > LEAF).select("node"))
    sets = _sets(spark, documents, nodes, wanted, seed)
    release(spark)
    edges = stored(spark, _linked(candidates, sets), "jaccard-links")
    release(spark)
    links = reduce(DataFrame.unionByName, _split_regions(spark, regions, nodes, sets, edges))
    labels = components(spark, links)
    joined = nodes.select("node", "doc_id").join(labels, "node", "left").select(
        "node", "doc_id", F.coalesce("label", "node").alias("label"))
    smallest = joined.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    groups = stored(spark, joined.join(smallest, "label").select("node", "doc_id", "component_id"), "jaccard-groups")
    return rows.where("n is not null").select("doc_id", "n", "node"), groups, seed


def jaccard_groups(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles`` and ``component_id``."""
    rows, groups, _ = _grouped(spark, documents)
    return rows.join(groups.select("node", "component_id"), "node", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _named(seed: int, name: str):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [_name(s, seed)[0] if len(s) else None for s in shingle_sets(batch)]
            yield batch.append_column(name, pa.array(nodes, pa.int64()))

    return add


def one_per_group(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The document with the smallest id of each group, all columns kept; documents without words stay."""
    _, groups, seed = _grouped(spark, documents)
    names = [f"`{c}`" for c in documents.columns]
    id_text = F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit(""))
    node, key, keep, first = free_names(documents.columns, "__node", "__id", "__kept", "__first")
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("node").alias(node), id_text.alias(key), F.lit(True).alias(keep))
    schema = T.StructType([*documents.schema.fields, T.StructField(node, T.LongType())])
    named = documents.mapInArrow(_named(seed, node), schema).withColumn(key, id_text)
    place = F.row_number().over(Window.partitionBy(node, key).orderBy(F.lit(1)))
    return (
        named.join(kept, [node, key], "left").where(F.col(node).isNull() | F.col(keep))
        .withColumn(first, place).where(F.col(node).isNull() | (F.col(first) == 1)).select(*names)
    )

