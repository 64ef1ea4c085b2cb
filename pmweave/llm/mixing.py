"""Entropy balancing: document rates that meet each source's token target.

Of all rates between 0 and the cap, those nearest to 1 (in relative entropy) whose words add up to
the target are ``least(cap, exp(lambda * size))``. Newton's method on the convex dual finds each
source's lambda. Documents of one size share a rate, so the iterations run over counts per source
and size, not over documents, and no source, however hot, is gathered anywhere. Rates become whole
copies by a hash of the id and one threshold per source that makes up for the rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pmweave.session import discard, stage

CAP = 3.0
WORD = r"[^\x20\x09-\x0D]+"
TOLERANCE = 1e-9
MAX_STEPS = 100
BINS = 1 << 16
MADE = ["size", "source_size", "target", "rate", "copies", "taken"]


def targets(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn. Targets share the whole by
    weight; none exceeds ``cap`` times its source's size, and what is cut off is shared anew by
    weight: with sources sorted by size over weight that is one running sum, not a loop. The one
    window without keys sees a row per source, never documents.
    """
    n = len(weights)
    ordered = (F.col("source").isNull(), F.col("source"))  # UTF-8 bytes sort by code point
    place = F.row_number().over(Window.orderBy(*ordered)) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % n + 1).cast("int"))
    weighed = sources.withColumn("weight", weight)
    total = Window.partitionBy()
    ratio = F.col("source_size") / F.col("weight")
    earlier = Window.orderBy(ratio, *ordered).rowsBetween(Window.unboundedPreceding, -1)
    left_words = F.sum("source_size").over(total) - cap * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    left_weight = F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    shared = weighed.withColumn("level", left_words / left_weight).withColumn("capped", cap * F.col("source_size") <= F.col("level") * F.col("weight"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(total)  # the first that is not capped
    target = F.when(F.col("capped"), cap * F.col("source_size")).otherwise(level * F.col("weight"))
    return shared.select("source", F.col("source_size").cast("long"), target.cast("double").alias("target"))


def balance(sizes: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """``(source, lambda)``: the dual solution per source, from ``(source, size, n)`` counts.

    Each step is one grouped sum over the counts. The root is kept in a bracket, and a Newton step
    that leaves it is replaced by the middle, so every source converges. Sizes are measured in
    units of the source's mean.
    """
    unit = (F.col("source_size") / F.col("docs")).alias("unit")
    counted = sizes.groupBy("source").agg(F.sum("n").alias("docs"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    same = "s.source <=> g.source"
    open_goals = goals.alias("s").join(counted.alias("g"), F.expr(same)).where("source_size > 0").select("s.source", "target", unit, F.col("least"))
    top = F.log(F.lit(cap)) * F.col("unit") / F.col("least")  # here every rate is the cap
    state = stage(open_goals.select("source", "target", "unit", F.lit(0.0).alias("lam"), F.lit(-750.0).alias("low"),
                                    (top * 2 + 1).alias("high"), F.lit(1.0).alias("miss")), "dual")
    rate = F.exp(F.col("lam") * F.col("size") / F.col("unit"))
    words = F.col("size") * F.col("n")
    exact = lambda term: F.sum(term.cast("decimal(28,9)")).cast("double")  # noqa: E731  the same in any order, so reruns agree
    for _ in range(MAX_STEPS):
        fitted = sizes.alias("s").join(state.alias("g"), F.expr(same)).select("g.*", "size", "n")
        sums = fitted.groupBy("source", "target", "unit", "lam", "low", "high").agg(
            exact(words * F.least(rate, F.lit(cap))).alias("got"),
            exact(F.when(rate < cap, words * rate * F.col("size") / F.col("unit")).otherwise(0.0)).alias("slope"))
        over = F.col("got") > F.col("target")
        moved = sums.withColumn("low", F.when(over, F.col("low")).otherwise(F.col("lam"))).withColumn(
            "high", F.when(over, F.col("lam")).otherwise(F.col("high")))
        newton = F.col("lam") - (F.col("got") - F.col("target")) / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        following = F.when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        miss = F.abs(F.col("got") / F.col("target") - 1)
        done = miss <= TOLERANCE
        stepped = stage(moved.select("source", "target", "unit", F.when(done, F.col("lam")).otherwise(following).alias("lam"), "low", "high", miss.alias("miss")), "dual")
        discard(state)
        state = stepped
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst <= TOLERANCE:
            return state.select("source", "unit", "lam")
    raise RuntimeError(f"a source is {worst:.3g} off its target after {MAX_STEPS} steps")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size`` (words) and ``toss``, a hash in [0, 1) of the id, or of the text where there is none."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    hashed = F.pmod(F.xxhash64(F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(1 << 53))
    return docs.withColumns({"size": words, "toss": hashed / F.lit(float(1 << 53))})


def rated(documents: DataFrame, rates: DataFrame, cap: float) -> DataFrame:
    """Measured rows with ``rate``, its ``whole`` part, and ``bin``: where the shift of the source reaches it, the document gets one copy more."""
    rate = F.when(F.col("size") == 0, 0.0).otherwise(F.least(F.lit(cap), F.exp(F.col("lam") * F.col("size") / F.col("unit"))))
    whole = F.floor("rate").cast("long")
    edge = F.col("toss") - (F.col("rate") - F.col("whole"))  # in (-1, 1)
    full = (F.col("rate") >= cap) | (F.col("size") == 0)
    met = documents.alias("l").join(rates.alias("k"), F.expr("l.source <=> k.source"))
    extra = [c for c in rates.columns if c != "source"]
    joined = met.select("l.*", *[f"k.{c}" for c in extra]).withColumn("rate", rate).withColumn("whole", whole)
    return joined.withColumn("bin", F.when(~full, F.floor((edge + 1) * (BINS / 2)).cast("long")))


def _shifts(rows: DataFrame) -> DataFrame:
    """``(source, shift)``: the last bin that gets a copy more, so that the words come nearest the target (-1: none).

    The words are counted in a fixed number of bins per source, however many documents it has.
    """
    grown = rows.where("bin is not null").groupBy("source", "bin").agg(F.sum("size").alias("more"))
    base = rows.groupBy("source", "target").agg(F.sum(F.col("whole") * F.col("size")).alias("base"))
    running = F.sum("more").over(Window.partitionBy("source").orderBy("bin"))
    after = grown.withColumn("more", running).alias("a").join(base.alias("b"), F.expr("a.source <=> b.source"))
    border = after.select("b.source", "bin", F.abs(F.col("base") + F.col("more") - F.col("target")).alias("off"))
    none = base.select("source", F.lit(-1).cast("long").alias("bin"), F.abs(F.col("base") - F.col("target")).alias("off"))
    return border.union(none).groupBy("source").agg(F.min(F.struct("off", "bin"))["bin"].alias("shift"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: int = 3) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``rate``, ``copies`` and ``taken`` (words, repeats counted).

    A null or wordless text has size 0 and no copies. Rows that repeat get the same hash and so the
    same copies; a null source is one source. Reruns agree: nothing depends on the order of rows.
    If all texts are empty every target is 0; an empty table stays empty. Other columns of ``docs``
    stay as they are, whatever their names; those with one of the names above are replaced.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in MADE])
    documents = measured(docs.select("doc_id", "text", "source", kept.alias("document")))
    light = stage(documents.select("source", "size", "toss"), "sizes")
    sizes = stage(light.groupBy("source", "size").agg(F.count("*").alias("n")), "counts")
    per_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = stage(targets(per_source, weights, float(cap)), "targets")
    dual = balance(sizes.where("size > 0"), goals, float(cap))
    rates = stage(goals.alias("g").join(dual.alias("d"), F.expr("g.source <=> d.source"), "left").select("g.*", "d.unit", "d.lam"), "rates")
    shifts = _shifts(rated(light, rates, float(cap)))
    rates = stage(rates.alias("g").join(shifts.alias("s"), F.expr("g.source <=> s.source"), "left").select("g.*", "s.shift"), "rates")
    found = rated(documents, rates, float(cap))
    copies = F.col("whole") + F.coalesce((F.col("bin") <= F.col("shift")).cast("long"), F.lit(0))
    added = {"copies": copies, "taken": copies * F.col("size")}
    return found.withColumns(added).select("document.*", *MADE)
