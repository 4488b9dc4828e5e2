"""Mixing sources to target weights.

Sizes are counted in words. Every source gets a share of the budget by weight,
bounded by ``max_repeats`` times its own size; what a bounded source leaves is
shared by weight among the others, until none is above its bound. The closed
form of that sharing is a water level: a source takes the smaller of its bound
and level times weight, and the level follows from running sums over the
sources in the order in which they reach their bound.

A document is emitted floor(rate) times, and once more with a probability equal
to the rate's fraction. Its coin is a hash of its id under one seed fixed in
advance. Independent coins of a small or uneven source stray far from its
target, so the coins are thinned evenly: documents of a source whose sizes have
equally many binary digits are a class, and a class copies those with the
smallest coins, n times fraction of its n documents. The coins of a class are
exchangeable, so every document of it, long or short, has a chance equal to the
fraction, while the words of a class differ from their share only by what its
sizes differ within a factor of two.

The bound below which a class copies follows from counts of its coins in
``BINS`` bins: the running sum names the bin in which the last copies fall, and
inside that bin the bound is interpolated. No document is ranked or moved; the
counts combine on the map side, and each source's bounds, at most one per binary
digit, are joined back as one narrow row.

Defined results: a null or empty text has size 0 and takes 0; a null source is
a source of its own, last in order; a null id hashes as the empty text; repeated
rows share a coin; a document without words keeps its chance of a copy; an empty
table gives an empty mix. Extra columns, whatever their names, stay as they are
in the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from parlance.llm.storage import free_names, stored

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_REPEATS = 2.0
SEED = "mix0:"
BINS = 1024
SCALE = float(1 << 32)


def word_count(text: Column) -> Column:
    """Words between space and the control characters tab to carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def coin(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    digits = F.substring(F.sha2(F.concat(F.lit(SEED), name), 256), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(SCALE)


def size_class(size: Column) -> Column:
    """Number of binary digits of a size."""
    return F.length(F.bin(size))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeats: float = MAX_REPEATS,
) -> DataFrame:
    """Per source: ``source_size`` and ``target`` words. ``sizes`` has ``source`` and ``size``."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (number % len(weights) + 1).cast("int"))
    bound = F.col("source_size") * F.lit(max_repeats)
    known = sources.select("source", "source_size", weight.alias("w"), bound.alias("bound"))
    everything = Window.partitionBy()
    reached = Window.orderBy((F.col("bound") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = reached.rowsBetween(Window.unboundedPreceding, -1)
    filling = known.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(budget)).alias("all_words"),
        F.coalesce(F.sum("bound").over(before), F.lit(0.0)).alias("bounds_before"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("weights_left"),
    )
    # With all earlier sources at their bound, this would be the level. The first
    # source that stays below its bound has the final one; levels fall after it.
    level = (F.col("all_words") - F.col("bounds_before")) / F.col("weights_left")
    full = F.col("bound") <= level * F.col("w")
    levelled = filling.select("*", level.alias("level"), full.alias("full"))
    final = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    open_level = levelled.select("*", final.alias("final"))
    return open_level.select(
        "source", "source_size",
        F.when(F.col("final").isNull(), F.col("bound"))
        .otherwise(F.least(F.col("bound"), F.col("final") * F.col("w"))).alias("target"),
    )


def copies(rate: Column, bounds: Column, size: Column, doc_id: Column) -> Column:
    """Number of times a document is emitted: the whole part of the rate, and a copy if its coin is below its bound."""
    bound = F.element_at(bounds, size_class(size))
    return (F.floor(rate) + F.when(coin(doc_id) < bound, 1).otherwise(0)).cast("bigint")


def copy_bounds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source and class: the bound below which a coin gives a copy."""
    bins = sizes.groupBy(
        "source", size_class(F.col("size")).alias("class"), F.floor(coin(F.col("doc_id")) * BINS).alias("bin"),
    ).agg(F.count("*").alias("n"))
    of_class = Window.partitionBy("source", "class")
    before = of_class.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    counted = bins.select(
        "source", "class", "bin", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(of_class).alias("of_class"),
    )
    wanted = counted.join(
        targets.select(F.col("source").alias("of_source"), (F.col("rate") - F.floor("rate")).alias("fraction")),
        F.col("source").eqNullSafe(F.col("of_source")),
    ).withColumn("wanted", F.col("of_class") * F.col("fraction"))
    end = F.col("before") + F.col("n")
    # A fraction next to one can round up to all documents of a class.
    last = wanted.where((F.col("before") <= F.col("wanted")) & ((F.col("wanted") < end) | (end == F.col("of_class"))))
    bound = (F.col("bin") + (F.col("wanted") - F.col("before")) / F.col("n")) / F.lit(float(BINS))
    return last.select("source", "class", bound.alias("bound"))


def source_plan(spark: SparkSession, sizes: DataFrame, **options) -> DataFrame:
    """Per source: ``source_size``, ``target``, ``rate`` and ``bounds``, the bound of each class for copies."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = stored(spark, source_targets(sizes, **options).withColumn("rate", rate), "mixing-targets")
    bounds = copy_bounds(sizes, targets).groupBy("source").agg(
        F.map_from_entries(F.collect_list(F.struct("class", "bound"))).alias("bounds"))
    return _of_source(bounds, targets.select("source", "source_size", "target", "rate"))


def _of_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the columns of their source's plan."""
    name, = free_names(rows.columns, "__source")
    plan = plan.withColumnRenamed("source", name)
    return rows.join(plan, F.col("source").eqNullSafe(F.col(name))).drop(name)


def _sizes(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return stored(spark, documents.select(
        F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size")), "mixing-sizes")


def mixed(spark: SparkSession, documents: DataFrame, **options) -> DataFrame:
    """Per document: size, source size, target of its source, copies and words taken."""
    sizes = _sizes(spark, documents)
    plan = stored(spark, source_plan(spark, sizes, **options), "mixing-plan")
    return _of_source(sizes, plan).select(
        "doc_id", "source", "size", "source_size", "target",
        copies(F.col("rate"), F.col("bounds"), F.col("size"), F.col("doc_id")).alias("copies"),
    ).withColumn("taken", F.col("size") * F.col("copies"))


def mix_documents(spark: SparkSession, documents: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is emitted, all columns kept."""
    plan = stored(spark, source_plan(spark, _sizes(spark, documents), **options), "mixing-plan")
    mix, copy = free_names(documents.columns, "__mix", "__copy")
    plan = plan.select("source", F.struct("rate", "bounds").alias(mix))
    emitted = copies(F.col(mix)["rate"], F.col(mix)["bounds"], word_count(F.col("text")), F.col("doc_id"))
    return (
        _of_source(documents, plan)
        .withColumn(copy, F.explode(F.array_repeat(F.lit(1), emitted.cast("int"))))
        .select(*(F.col(f"`{c}`") for c in documents.columns))
    )
