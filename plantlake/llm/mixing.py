"""Mix sources to target weights by Pareto order sampling.

Each source has a target in words. Within it a document's expected number of copies falls mildly with its
length, as repeating a long document costs many words for the variety of one; the level is such that the
expected words of a source are its target. The whole part of that number is certain, the rest is the document's
inclusion probability, which so differs from document to document. For that rest the documents of a source are
ranked by random odds divided by inclusion odds, and taken in this order up to a fixed size: the words that the
target leaves after the certain copies. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.llm.shared import store

#: One-row-per-source tables of up to so many rows are sent to every task; longer ones are joined by
#: a shuffle, in which adaptive execution splits a hot source.
SENT_SOURCES = 100_000
#: The rank order of a source is cut into so many steps, of which one is looked at row by row.
STEPS = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixRule:
    """``weights`` go round the sources by name (null last); all share ``share`` of all words; no
    target exceeds ``most`` times its source, and no document is expected more than ``most`` times.

    A document of 2^k words is expected ``ease`` / (``ease`` + k) times as often as one of one word; with no
    ``ease`` all documents of a source are expected alike. Another ``seed`` draws another sample.
    """

    weights: Sequence[float] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    ease: float | None = 8.0
    seed: str = ""


def words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, rule: MixRule) -> DataFrame:
    """Target of each row of ``totals`` (source, source_size): one row per source.

    With the level at which the shares of all sources that are not full sum to the rest, a source is
    full or has level times weight. Sources are passed in the order in which they fill.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(rule.weights) + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in rule.weights]), turn.cast("int"))
    weighted = totals.withColumn("weight", weight).withColumn("full", rule.most * F.col("source_size"))
    fills = [(F.col("full") / F.col("weight")), F.col("source").asc_nulls_last()]
    order = Window.orderBy(*fills)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        rule.share * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    # Rounding must not leave the last source without a level.
    last = F.row_number().over(order) == F.count("*").over(everything)
    levelled = weighted.withColumn("place", F.row_number().over(order)).withColumn("level", level).withColumn(
        "open", (F.col("level") <= F.col("full") / F.col("weight")) | last
    )
    first_open = F.min(F.when(F.col("open"), F.struct("place", "level"))).over(everything)
    found = levelled.withColumn("first_open", first_open)
    target = F.when(F.col("place") < F.col("first_open.place"), F.col("full")).otherwise(
        F.least(F.col("first_open.level") * F.col("weight"), F.col("full"))
    )
    return found.select("source", "source_size", target.alias("target"))


def uniform(key: Column, seed: str = "") -> Column:
    """A number between 0 and 1 that depends on the key and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def length_class(size: Column) -> Column:
    """The k of 2^k <= size < 2^(k + 1); 0 where there are no words."""
    return F.length(F.bin(F.greatest(size, F.lit(1).cast("long")))) - 1


def preference(of_class: Column, rule: MixRule) -> Column:
    return F.lit(1.0) if rule.ease is None else F.lit(rule.ease) / (F.lit(rule.ease) + of_class)


def expected_copies(preferred: Column, rule: MixRule) -> Column:
    """Of a row joined to its source's ``source_size``, ``target`` and ``level``."""
    full = F.col("target") >= rule.most * F.col("source_size")
    some = F.least(F.lit(float(rule.most)), F.coalesce("level", F.lit(0.0)) * preferred)
    return F.when(F.col("source_size") == 0, 0.0).when(full, float(rule.most)).otherwise(some)


def with_rank(sized: DataFrame, rule: MixRule) -> DataFrame:
    """Certain copies, inclusion probability and Pareto rank of each row.

    The rank is random odds over inclusion odds, null where nothing is left to chance.
    """
    expected = expected_copies(preference(length_class(F.col("size")), rule), rule)
    parted = sized.withColumn("expected", expected).withColumn("whole", F.floor("expected"))
    parted = parted.withColumn("part", F.col("expected") - F.col("whole"))
    part, odds = F.col("part"), F.col("u") / (1 - F.col("u"))
    rank = F.when(part > 0, odds / (part / (1 - part)))
    step = F.floor(rank / (1 + rank) * STEPS)
    return parted.withColumn("rank", rank).withColumn("step", step)


def levels(classes: DataFrame, targets: DataFrame, rule: MixRule, sent: bool) -> DataFrame:
    """``targets`` with ``level``, and ``rest``, the words left to chance: one row per source.

    ``classes`` has the words of each source's length classes, 64 at most. Expected copies of a class are
    level times its preference, but no more than ``most``; classes reach that from the shortest on.
    """
    kept = join_source(classes.where("words > 0"), targets, sent)
    order = Window.partitionBy("source").orderBy("class")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    preferred = preference(F.col("class"), rule)
    level = (F.col("target") - rule.most * F.coalesce(F.sum("words").over(before), F.lit(0))) / F.sum(
        preferred * F.col("words")
    ).over(onward)
    last = F.lead("class").over(order).isNull()
    tried = kept.withColumn("tried", level).withColumn("last", last)
    is_open = (F.col("tried") * preferred <= rule.most) | F.col("last")
    first = F.min(F.when(is_open, F.struct("class", "tried"))).over(Window.partitionBy("source"))
    levelled = tried.withColumn("level", first["tried"])
    certain = F.floor(expected_copies(preferred, rule)) * F.col("words")
    found = levelled.groupBy("source").agg(F.first("level").alias("level"), F.sum(certain).alias("certain"))
    joined = join_source(targets, found, sent, "left")
    return joined.withColumn("rest", F.col("target") - F.coalesce("certain", F.lit(0))).drop("certain")


def cuts(sized: DataFrame, rule: MixRule) -> DataFrame:
    """One row per source: its target, its level, and the last row of the rank order it takes.

    ``sized`` has id, source, size and u. Sizes are summed per source and length class, then per source and
    step, so that a source with most of all rows meets in no task; rows are put in order only in the one
    step the fixed size falls in.
    """
    per_class = sized.groupBy("source", length_class(F.col("size")).alias("class")).agg(F.sum("size").alias("words"))
    classes = store(per_class, "classes")
    totals = store(classes.groupBy("source").agg(F.sum("words").alias("source_size")), "sources")
    sent = totals.count() <= SENT_SOURCES
    targets = store(levels(classes, source_targets(totals, rule), rule, sent), "levels")
    ranked = with_rank(join_source(sized, targets, sent), rule).where(F.col("part") > 0)
    steps = ranked.groupBy("source", "step", "rest").agg(F.sum("size").alias("words"))
    reached = F.sum("words").over(
        Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    )
    beyond = steps.withColumn("reached", reached).where(F.col("reached") > F.col("rest"))
    edge = beyond.groupBy("source").agg(F.min(F.struct("step", (F.col("reached") - F.col("words")).alias("before"))).alias("e"))
    edge = edge.select("source", F.col("e.step").alias("edge"), F.col("e.before").alias("before"))
    inside = join_source(ranked, edge, sent).where(F.col("step") == F.col("edge"))
    order = Window.partitionBy("source").orderBy("rank", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("size").over(order) - F.col("size") / 2
    taken = inside.withColumn("middle", middle).where(F.col("middle") <= F.col("rest"))
    last = taken.groupBy("source").agg(F.max(F.struct("rank", "id", "size")).alias("last"))
    found = join_source(join_source(targets, edge.drop("before"), sent, "left"), last, sent, "left")
    return store(found, "cuts")


def join_source(left: DataFrame, right: DataFrame, sent: bool, how: str = "inner") -> DataFrame:
    """Join one-row-per-source columns; a null source is a source."""
    right = right.withColumnRenamed("source", "_source")
    right = F.broadcast(right) if sent else right
    return left.join(right, left["source"].eqNullSafe(right["_source"]), how).drop("_source")


def copies() -> Column:
    """Copies a ranked row joined to its cut is taken with."""
    passed = F.struct("rank", "id", "size") <= F.col("last")
    drawn = (F.col("step") < F.col("edge")) | ((F.col("step") == F.col("edge")) & passed)
    # Without an edge all that is ranked is needed.
    drawn = F.when(F.col("rank").isNull(), False).when(F.col("edge").isNull(), True).otherwise(F.coalesce(drawn, F.lit(False)))
    return F.col("whole") + drawn.cast("long")


def size_rows(
    docs: DataFrame, rule: MixRule, *more: Column, text: str = "text", source: str = "source", doc_id: str = "doc_id"
) -> DataFrame:
    return docs.select(
        *more, docs[doc_id].alias("id"), docs[source].alias("source"), words(docs[text]).alias("size"),
        uniform(docs[doc_id], rule.seed).alias("u"),
    )


def mix_counts(docs: DataFrame, rule: MixRule = MixRule(), **names: str) -> DataFrame:
    """Per document: id, source, size, source_size, target, expected copies and copies taken.

    Texts are measured once and only ids, sources and sizes are kept for the rest. A null or blank text
    has size 0, a null source is a source, a null id is like an empty one; rows of one id, source and
    size are taken or left alike. The same rows give the same result on every run.
    """
    sized = store(size_rows(docs, rule, **names), "mix")
    found = cuts(sized, rule)
    ranked = with_rank(join_source(sized, found, found.count() <= SENT_SOURCES), rule)
    return ranked.select("id", "source", "size", "source_size", "target", "expected", copies().alias("copies"))


def mix(docs: DataFrame, rule: MixRule = MixRule(), **names: str) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it, columns as they are.

    The texts are not shuffled: each row finds its copies from its own id and size and its source's cut.
    """
    sized = store(size_rows(docs, rule, **names), "mix")
    own = [docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]
    found = cuts(sized, rule)
    ranked = with_rank(join_source(size_rows(docs, rule, *own, **names), found, found.count() <= SENT_SOURCES), rule)
    repeated = ranked.withColumn("copies", copies()).where("copies > 0")
    repeated = repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
