"""Mixing sources to target weights: hash-threshold histograms, refined in the boundary bucket only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import materialise, spread_join

WORD = r"[^\x20\x09-\x0D]+"
#: Hashes of a row have 60 bits each; a histogram is over the next 12 of them.
BITS, STEP = 60, 12
#: Hashes in the order they are compared: of the id; of the text, for rows that share an id; of the row's place.
HASHES = ("__h0", "__h1", "__h2")
BOUNDS = ("__b0", "__b1", "__b2")
ADDED = ("size", "source_size", "target", "repeats", "taken")


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[float] | Mapping[str | None, float] = (1, 2, 3),
    share: float = 1.0,
    most: int = 3,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with size (words of the text), source_size (of its source), target (words that the mix wants of its
    source), repeats (how often the mix takes the row, 0 to ``most``) and taken (repeats times size).

    ``weights``: a mapping of sources (others weigh 0), or a cycle dealt to the sources in code point order, null last.
    The mix holds ``share`` of all words; a source's target is proportional to its weight, but at most ``most`` times
    its size, and what that cuts off is shared among the others by weight. A source whose target is q times its size
    gives every row floor(q) times, and once more the rows whose hash is below the source's threshold. Thresholds are
    nested: a larger target takes every row that a smaller one takes, at least as often.

    No row is sorted. Words are summed by source and the hash's first 12 bits (4,096 buckets a source, summed before
    they are shuffled); only rows of a source's boundary bucket are summed again, by the next 12 bits, until it holds
    one row. That is taken if it brings the source nearer to its target, so the source is off by half of one row's
    size at most. Equal inputs give equal outputs, whatever the partitions: ids are hashed by md5; rows that share an id
    are told apart by their text, and equal rows, of which any may stand for another, by their place.

    Null texts and texts without words have size 0 and are taken as 0 words. A null source is a source of its own, a null id
    hashes as empty text. Sources without words have target 0. Equal rows are rows of their own. An empty table gives
    no row. ``keep`` names the columns that stay (all by default); those called like added ones are replaced.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    text, source = F.col(f"`{text_col}`").cast("string"), F.col(f"`{source_col}`").cast("string")
    spelled = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    marked = docs.select(
        *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)],
        F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)).alias("__key"),  # in order, null last
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("__size"),
        F.conv(F.substring(F.md5(spelled.cast("binary")), 1, BITS // 4), 16, 10).cast("long").alias("__h0"),
        _cut(F.xxhash64(text)).alias("__h1"),
        _cut(F.xxhash64(F.monotonically_increasing_id())).alias("__h2"),
    )
    marked = materialise(marked, "marked")  # a row's place is drawn once
    plan = targets(marked.groupBy("__key").agg(F.sum("__size").alias("source_size")), weights, share, most)
    plan = materialise(plan, "targets")
    plan = plan.join(thresholds(marked.select("__key", "__size", *HASHES), plan.where("__rest > 0").select("__key", "__rest")), "__key", "left")
    out = spread_join(marked, plan, ["__key"], ["__h0", "__h2"])
    below = F.lit(False)
    for h, b in zip(reversed(HASHES), reversed(BOUNDS)):
        below = (F.col(h) < F.col(b)) | ((F.col(h) == F.col(b)) & below)
    repeats = F.col("__whole") + F.coalesce(below, F.lit(False)).cast("int")
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)], F.col("__size").alias("size"), "source_size", "target", repeats.alias("repeats"), (F.col("__size") * repeats).alias("taken"))


def targets(sources: DataFrame, weights: Sequence[float] | Mapping[str | None, float], share: float, most: int) -> DataFrame:
    """``sources`` (__key, source_size) with target, and its parts: __whole times the source's size and __rest.

    Below its limit each source gets the same level times its weight. The level follows from running sums of limits and
    weights in the order in which sources reach their limits, so that no resharing round has to be run. Sources may be
    many: they are never sorted in one task, and the driver gets sums."""
    limit = (F.lit(most) * F.col("source_size")).cast("double")
    if isinstance(weights, Mapping):
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("__key") == ("1" if name is None else f"0{name}"), F.lit(float(value))).otherwise(weight)
        weighed = sources
    else:
        weighed = running(sources.withColumn("__one", F.lit(1)), ["__key"], {"__place": "__one"}).drop("__one")
        weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("__place") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = weighed.select("__key", "source_size", weight.alias("__weight"), limit.alias("__limit"))
    ordered = running(weighed.where("__weight > 0").withColumn("__ratio", F.col("__limit") / F.col("__weight")), ["__ratio", "__key"], {"__limits": "__limit", "__weights": "__weight"})
    ordered = materialise(ordered, "ordered")
    sums = ordered.agg(F.sum("source_size").alias("positive"), F.sum("__weight").alias("weight")).first()
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first().n * share
    full = F.col("__limits") + F.col("__ratio") * (F.lit(sums.weight or 0.0) - F.col("__weights")) <= F.lit(float(total))
    reached = ordered.where(full).agg(F.max(F.struct("__limits", "__weights")).alias("x")).first().x
    limits, capped = (reached["__limits"], reached["__weights"]) if reached else (0.0, 0.0)
    left = (sums.weight or 0.0) - capped
    level = F.lit((total - limits) / left if left > 0 else None).cast("double")  # none: all are at their limits
    target = F.when(F.col("__weight") > 0, F.least(level * F.col("__weight"), F.col("__limit"))).otherwise(0.0)
    out = weighed.withColumn("target", target)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    return out.withColumn("__whole", whole).select("__key", "source_size", "target", "__whole", (F.col("target") - F.col("__whole") * F.col("source_size")).alias("__rest"))


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(__key, __b0, __b1, __b2): rows of a source whose hashes come before these hold about ``__rest`` words of it."""
    edge, state, done = rows, wanted.withColumns({b: F.lit(0).cast("long") for b in BOUNDS}), []
    levels = len(HASHES) * BITS // STEP
    for level in range(levels):
        word, place = divmod(level, BITS // STEP)
        shift = BITS - STEP * (place + 1)
        digit = F.shiftright(HASHES[word], shift).bitwiseAND(2**STEP - 1)
        counts = edge.groupBy("__key", digit.alias("__digit")).agg(F.sum("__size").alias("__words"), F.count(F.lit(1)).alias("__rows"))
        upto = F.sum("__words").over(Window.partitionBy("__key").orderBy("__digit"))  # at most 4,096 rows a source
        found = counts.withColumn("__before", upto - F.col("__words")).join(state, "__key")
        found = found.where("__before < __rest and __rest <= __before + __words").withColumn("__rest", F.col("__rest") - F.col("__before"))
        closed = (F.col("__rows") == 1) | F.lit(level == levels - 1)
        end = F.col("__digit") + (closed & (2 * F.col("__rest") >= F.col("__words"))).cast("long")  # included if that is nearer
        found = materialise(found.withColumn(BOUNDS[word], F.col(BOUNDS[word]) + F.shiftleft(end, shift)).withColumn("__closed", closed), "boundary")
        done.append(found.where("__closed").select("__key", *BOUNDS))
        state = found.where("not __closed").select("__key", "__digit", "__rest", *BOUNDS)
        if state.isEmpty():
            break
        edge = edge.withColumn("__digit", digit).join(state.select("__key", "__digit"), ["__key", "__digit"]).drop("__digit")
        edge = materialise(edge, "edge")
        state = state.drop("__digit")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def running(df: DataFrame, order: list[str], sums: dict[str, str]) -> DataFrame:
    """``df`` with running sums {name: column} in the total order ``order``: within ranges of rows, and between ranges by
    one row a range."""
    ranged = materialise(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranged")
    ends = ranged.groupBy("__range").agg(*[F.sum(c).alias(f"__sum{n}") for n, c in sums.items()])
    behind = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shuffle partition
    ends = ends.select("__range", *[F.coalesce(F.sum(f"__sum{n}").over(behind), F.lit(0)).alias(f"__sum{n}") for n in sums])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(ends), "__range")
    return out.withColumns({n: F.sum(c).over(inside) + F.col(f"__sum{n}") for n, c in sums.items()}).drop("__range", *[f"__sum{n}" for n in sums])


def _cut(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - BITS)
