"""Mixing sources to target weights by entropy balancing.

Every source has a target of tokens (words). Among all document rates that meet the targets the mix takes the
one closest to the corpus in relative entropy, taken over tokens, so that every token weighs alike and a
document's length does not change its chance. Its convex dual has one multiplier per source; the rate of a
document is the exponential tilt exp(multiplier of its source). Newton's method solves the dual: the gradient
of a source is its tilted tokens minus its target, the Hessian is diagonal (a document has one source), and
both are sums over documents that are reduced once to one row per source before the first iteration.

Rates become copies by systematic rounding. The documents of a source are ordered by a hash; those whose place
in that order, as a share of the tokens, is below the fraction of the rate are taken once more. This is
done for long documents first, and what they miss is carried to the shorter ones, so the tokens taken come
within one short document of the target. Reruns agree, and all that has to be known about a source is its
whole copies and the hashes at which the extra copies end (and, where many rows share that hash, how many of them). Running totals are taken inside hash ranges, so a
source with most documents is spread over 2,048 of them and more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from custbehav.functions.ordering import join_null_safe, running_totals
from custbehav.llm.common import columns, set_aside, stored, words

WEIGHTS = (5, 2, 1)
# Words from which a document belongs to the first and the second stratum.
STRATA = (1024, 128)


def size_in_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def order_mark(doc_id: Column, text: Column) -> Column:
    """The hash that orders the documents of a source."""
    return F.xxhash64(doc_id, text)


def numbered(sources: DataFrame) -> DataFrame:
    """Add ``place``, from 0 in the order of the sources' code points, null last; ``source`` must be distinct.

    The buckets are the ranges that the sources are dealt into, so names that begin alike do not share one.
    """
    ranged = sources.repartitionByRange(F.col("source").asc_nulls_last())
    bucket = F.when(F.col("source").isNull(), F.lit((1 << 31) - 1)).otherwise(F.spark_partition_id())
    ranged = stored(ranged.withColumn("_range", bucket).withColumn("_one", F.lit(1)))
    placed = running_totals(ranged, [], "source", F.col("_range"), ["_one"], few_buckets=True)
    return placed.withColumnRenamed("_one_before", "place").drop("_range", "_one")


def source_targets(sources: DataFrame, total_share: float, weights: tuple[int, ...], most_copies: float) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Sources in the order of their code points, null last, have the weights in turn and share ``total_share`` of all
    tokens. A target stops at ``most_copies`` times its source's size and the excess is shared again by
    weight: each round takes three sums over the sources, until no further source is full.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = stored(numbered(sources).withColumn("weight", weight.cast("double")).drop("place"))
    limit = F.col("source_size") * F.lit(float(most_copies))
    total = (weighed.agg(F.sum("source_size")).first()[0] or 0) * total_share
    level, full = 0.0, -1
    while True:
        is_full = F.col("weight") * F.lit(level) >= limit
        now, taken, free = weighed.agg(
            F.count_if(is_full), F.sum(F.when(is_full, limit).otherwise(0.0)), F.sum(F.when(is_full, 0.0).otherwise(F.col("weight")))
        ).first()
        if now == full or not free:
            break
        full, level = now, (total - taken) / free
    target = F.least(F.col("weight") * F.lit(level), limit) if free else limit
    return weighed.withColumn("target", target).drop("weight")


def multipliers(targets: DataFrame, tolerance: float = 1e-12, most_iterations: int = 100) -> DataFrame:
    """Add ``rate``, the tilt of a source's documents, by Newton's method on the dual.

    From zero a step is target / tilted tokens - 1; steps are held to 1 upwards, where the exponential
    would overshoot. A source without tokens or target has the rate zero.
    """
    solved = targets.withColumn("_l", F.lit(0.0))
    active = (F.col("source_size") > 0) & (F.col("target") > 0)
    tilted = F.col("source_size") * F.exp("_l")
    for _ in range(most_iterations):
        gradient = F.abs(tilted - F.col("target")) / F.col("target")
        worst = solved.filter(active).agg(F.max(gradient)).first()[0]
        if worst is None or worst <= tolerance:
            break
        step = F.least(F.col("target") / tilted - 1.0, F.lit(1.0))
        solved = stored(solved.withColumn("_l", F.when(active, F.col("_l") + step).otherwise(0.0)))
    return solved.withColumn("rate", F.when(active, F.exp("_l")).otherwise(0.0)).drop("_l")


def _stratum(size: Column) -> Column:
    """0 for long documents, then shorter ones."""
    return F.when(size >= STRATA[0], 0).when(size >= STRATA[1], 1).otherwise(2)


def mixture(
    docs: DataFrame, total_share: float = 1.5, weights: tuple[int, ...] = WEIGHTS, most_copies: float = 2.0
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``, ``whole`` copies of all, and per stratum k ``last_k``,
    ``part_k`` and ``all_k``.

    ``docs`` has source, size and mark. Rows of a stratum with a mark below its ``last`` are taken once more, and ``part`` of the
    ``all`` rows that have this mark. Rows of one mark are one row with its number before they are put in order.
    """
    strata = range(len(STRATA) + 1)
    docs = docs.select("source", "mark", "size", _stratum(F.col("size")).alias("stratum"))
    size = F.col("size")
    totals = docs.groupBy("source").agg(
        F.sum(size).alias("source_size"),
        *[F.sum(F.when(F.col("stratum") == k, size).otherwise(0)).alias(f"size_{k}") for k in strata],
    )
    rate = F.round("rate", 9)
    solved = multipliers(source_targets(totals, total_share, weights, most_copies))
    solved = solved.withColumn("whole", F.floor(rate)).withColumn("fraction", rate - F.floor(rate))
    solved = stored(solved.withColumn("carried", F.lit(0.0)).drop("rate"))
    bucket = F.shiftright("mark", 53)
    alike = docs.groupBy("source", "stratum", "mark").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("alike"))
    alike = alike.withColumn("together", F.col("size") * F.col("alike"))
    placed = stored(running_totals(alike, ["source", "stratum"], "mark", bucket, ["together"]))
    for k in strata:
        goal = F.col("fraction") * F.col(f"size_{k}") + F.col("carried")
        goals = solved.select("source", goal.alias("goal"))
        extra = join_null_safe(placed.filter((F.col("stratum") == k) & (size > 0)), goals, ["source"])
        # Rows whose middle lies before the goal.
        before = F.ceil((F.col("goal") - F.col("together_before")) / size - 0.5)
        extra = extra.withColumn("part", F.least(F.col("alike"), before)).filter(F.col("part") > 0)
        ends = extra.groupBy("source").agg(
            F.max("mark").alias(f"last_{k}"), F.max_by("part", "mark").alias(f"part_{k}"), F.max_by("alike", "mark").alias(f"all_{k}"),
            F.sum(size * F.col("part")).alias("extra"),
        )
        solved = join_null_safe(solved, ends, ["source"], "left")
        solved = stored(solved.withColumn("carried", goal - F.coalesce("extra", F.lit(0))).drop("extra"))
    return solved.drop("fraction", "carried", *[f"size_{k}" for k in strata])


def _with_copies(docs: DataFrame, shares: DataFrame, size: str, mark: str, name: str) -> DataFrame:
    """Add how often each row is taken, and the columns of ``mixture``.

    Only rows that have the last mark of their stratum, where not all of them are taken, must be numbered: they are
    written once, and numbered in ranges of their places, so that many equal rows are not put in order in one task.
    """
    rows, strata = join_null_safe(docs, shares, ["source"]), range(len(STRATA) + 1)
    stratum = _stratum(F.col(size))

    def own(kind: str) -> Column:
        return F.when(stratum == 0, F.col(f"{kind}_0")).when(stratum == 1, F.col(f"{kind}_1")).otherwise(F.col(f"{kind}_2"))

    last, part = own("last"), own("part")
    divided = F.coalesce((F.col(mark) == last) & (part < own("all")), F.lit(False)) & (F.col(size) > 0)
    whole = F.when(F.col(size) > 0, F.col("whole") + F.when(F.col(mark) <= last, 1).otherwise(0)).otherwise(0)
    if shares.filter(reduce(lambda a, b: a | b, [F.col(f"part_{k}") < F.col(f"all_{k}") for k in strata])).isEmpty():
        return rows.withColumn(name, whole)
    near = reduce(lambda a, b: a | b, [F.coalesce(F.col(mark) == F.col(f"last_{k}"), F.lit(False)) for k in strata])
    some = rows.filter(near).filter(divided).withColumns({"_stratum": stratum, "_one": F.lit(1), "_place": F.monotonically_increasing_id()})
    some = running_totals(stored(some), ["source", "_stratum"], "_place", F.shiftright("_place", 20), ["_one"])
    some = some.withColumn(name, F.col("whole") + F.when(F.col("_one_before") < part, 1).otherwise(0))
    return rows.filter(~divided).withColumn(name, whole).unionByName(some.select(*rows.columns, name))


def mix(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` words.

    Null texts have size 0 and are never taken; the null source is a source, the last one; of rows that repeat
    id and text as many are taken once more as bring the source nearest to its target; an empty table gives no rows.
    """
    rows = columns(docs, doc_id=id_column, source=source_column, text=text_column)
    sized = stored(
        rows.select(
            "doc_id", "source", size_in_words(F.col("text")).alias("size"), order_mark(F.col("doc_id"), F.col("text")).alias("mark")
        )
    )
    joined = _with_copies(sized, mixture(sized, **options), "size", "mark", "copies")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def replicate(docs: DataFrame, **options) -> DataFrame:
    """Every document as often as the mix takes it, with the columns of ``docs`` (doc_id, source and text among them)."""
    docs, back = set_aside(docs, "doc_id", "source", "text")
    mark, size = order_mark(F.col("doc_id"), F.col("text")), size_in_words(F.col("text"))
    sized = stored(docs.select("source", size.alias("size"), mark.alias("mark")))
    shares = mixture(sized, **options).drop("source_size", "target")
    marked = docs.withColumns({"_mark": mark, "_size": size})
    joined = _with_copies(marked, shares, "_size", "_mark", "_n")
    times = F.when(F.col("_n") > 0, F.sequence(F.lit(1), F.col("_n").cast("int")))
    return back(joined.withColumn("_copy", F.explode(times)))
