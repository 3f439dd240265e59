"""Mixing sources to target weights by entropy balancing.

Each source gets a token target; the documents of a source get rates as close to one
copy as possible (least relative entropy) whose token sum is that target.  The convex
dual has one multiplier for each token constraint: the rate of a document of x tokens
is ``min(cap, exp(lambda_source * x))``, an exponential tilt held at the cap.  Newton
steps on the dual (safeguarded by a bracket) run as distributed aggregates over a
(source, size, count) table, which is the corpus pre-aggregated; the driver sees one
number a step.  Rates are rounded into whole copies by cumulative rounding along
falling sizes, then a few groups are moved by whole copies until no group's size fits
what is missing.  Which documents of a (source, size) group get the extra copy is the order of a
hash of ``doc_id``, found by counts over hash prefixes, so reruns agree and a group that
holds a third of all rows is never gathered.

Defined results: null and empty texts have size 0 and one copy (0 tokens); a null source is
a source of its own, last in order; repeated rows of an id get equal copies, for which a
target may be missed by their number; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sevlens.llm.common import stored, stored_and_seen

TOKEN = r"[^\x20\x09-\x0D]+"
EXACT = "decimal(38,9)"         # sums of these do not depend on the order of rows


def tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("long")


def order_hash() -> Column:
    return F.xxhash64(F.lit("copies"), F.col("doc_id"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target): ``share`` of all tokens by repeating ``weights`` in order of source.

    A target stops at ``cap`` times its source's size and the excess goes to the others by
    weight, again and again: the least level at which targets ``min(cap * size, level * weight)``
    give the total.  Each round is one aggregate over the source table.
    """
    pattern = F.array(*[F.lit(w) for w in weights])
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1    # one row for each source
    t = stored(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("c")).alias("source_size"))
               .withColumn("weight", F.element_at(pattern, (turn % len(weights) + 1).cast("int"))), "sources")
    most = F.col("source_size") * F.lit(cap)
    total = (t.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) >= most
        held, w = t.agg(F.sum(F.when(full, most).otherwise(0.0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        new = (total - (held or 0.0)) / w if w else level
        if not w or new <= level:
            break
        level = new
    return t.select("source", "source_size", F.least(most, F.col("weight") * F.lit(level)).alias("target"))


def tilts(sizes: DataFrame, targets: DataFrame, cap: float, tolerance: float = 1e-9, steps: int = 80) -> DataFrame:
    """(source, lambda) by Newton steps in the logarithm of each source's token sum."""
    import math

    top = math.log(cap)
    ends = sizes.where("size > 0").groupBy("source").agg(F.min("size").alias("least"))
    t = targets.withColumnRenamed("source", "s").where("target > 0")
    state = (ends.join(t, F.col("source").eqNullSafe(F.col("s")))
             .select("source", "target", F.lit(0.0).alias("lam"), (F.lit(top) / F.col("least")).alias("hi"),
                     F.least(F.lit(0.0), -F.log(F.col("source_size") / F.col("target")) / F.col("least")).alias("lo"),
                     F.lit(1e9).alias("gap"), (F.col("source_size") * cap - F.col("target") <= 1e-9 * F.col("target")).alias("full")))
    apart = F.count(F.when(F.col("gap") > tolerance, 1))
    state, seen = stored_and_seen(state.withColumn("lam", F.when(F.col("full"), F.col("hi")).otherwise(F.col("lam")))
                                  .withColumn("gap", F.when(F.col("full"), 0.0).otherwise(F.col("gap"))).drop("full"), "tilt", apart=apart)
    x, lam = F.col("size"), F.col("lam")
    rate = F.exp(F.least(lam * x, F.lit(top)))
    for _ in range(steps):
        if not seen["apart"]:
            break
        s = state.select(F.col("source").alias("s"), "target", "lam", "lo", "hi")
        sums = (sizes.where("size > 0").join(s, F.col("source").eqNullSafe(F.col("s")))
                .groupBy("source", "target", "lam", "lo", "hi")
                .agg(F.sum((F.col("c") * x * rate).cast(EXACT)).cast("double").alias("f"),
                     F.sum(F.when(lam * x < top, F.col("c") * x * x * rate).otherwise(0.0).cast(EXACT)).cast("double").alias("g")))
        over = F.col("f") > F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(lam), F.when(over, lam).otherwise(F.col("hi"))
        step = sums.select("source", "target", "lam", "f", "g", lo.alias("lo"), hi.alias("hi"))
        newton = lam - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("g")
        inside = (F.col("g") > 0) & (newton > F.col("lo")) & (newton < F.col("hi"))
        gap = F.abs(F.col("f") / F.col("target") - 1)
        gap = F.when((F.col("hi") - F.col("lo")) <= 1e-15 * F.abs(lam), F.lit(0.0)).otherwise(gap)
        state, seen = stored_and_seen(step.select("source", "target", F.when(gap <= tolerance, lam).when(inside, newton)
                                                  .otherwise((F.col("lo") + F.col("hi")) / 2).alias("lam"), "lo", "hi", gap.alias("gap")), "tilt", apart=apart)
    return state.select("source", "lam")


def whole_copies(sizes: DataFrame, targets: DataFrame, lam: DataFrame, cap: int, rounds: int = 8) -> DataFrame:
    """(source, size, c, k): copies k of each group of c documents, token sums near the targets."""
    rate = F.least(F.lit(float(cap)), F.exp(F.coalesce("lam", F.lit(0.0)) * F.col("size")))
    t = targets.select(F.col("source").alias("s"), "target")
    lam = lam.select(F.col("source").alias("l"), "lam")
    groups = (sizes.join(t, F.col("source").eqNullSafe(F.col("s"))).join(lam, F.col("source").eqNullSafe(F.col("l")), "left")
              .select("source", "size", "c", "target", (F.col("c") * F.when(F.col("size") > 0, rate).otherwise(1.0)).alias("want")))
    octave = F.floor(F.log2(F.col("size") + 1)).alias("octave")
    w = Window.partitionBy("source", "octave").orderBy(F.desc("size"))
    upto = F.sum("want").over(w.rowsBetween(Window.unboundedPreceding, 0))
    groups = groups.select("*", octave).withColumn("upto", F.floor(upto + 0.5))
    k = F.col("upto") - F.coalesce(F.lag("upto").over(w), F.lit(0))
    groups = stored(groups.select("source", "size", "c", "target", F.greatest(F.lit(0), F.least(k, F.col("c") * cap)).cast("long").alias("k")),
                    "copies")
    for _ in range(rounds):
        off = (groups.groupBy("source", "target").agg(F.sum(F.col("k") * F.col("size")).alias("took"))
               .select(F.col("source").alias("s"), (F.col("target") - F.col("took")).alias("off")))
        j = groups.join(off, F.col("source").eqNullSafe(F.col("s")))
        room = F.when(F.col("off") > 0, F.col("c") * cap - F.col("k")).otherwise(F.col("k"))
        move = F.least(room, F.floor(F.abs("off") / F.col("size")))
        fits = j.where((F.col("size") > 0) & (F.col("size") <= F.abs("off")) & (room > 0))
        best = fits.groupBy("source").agg(F.max(F.struct("size", (F.signum("off") * move).cast("long").alias("move"))).alias("b"))
        best, seen = stored_and_seen(best.select(F.col("source").alias("s"), F.col("b.size").alias("at"), "b.move"), "copies-move", n=F.count("*"))
        if not seen["n"]:
            break
        groups = stored(groups.join(best, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("at")), "left")
                        .select("source", "size", "c", "target", (F.col("k") + F.coalesce("move", F.lit(0))).alias("k")), "copies")
    return groups.select("source", "size", "c", "k")


def extra_limits(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """(source, size, base, upto): a document has base copies, one more if its hash is at most ``upto``.

    The k-th smallest hash of a group is found in two levels: counts over 2,048 hash
    prefixes, then the hashes of the one prefix where the k-th lies.
    """
    g = groups.select("source", "size", F.floor(F.col("k") / F.col("c")).alias("base"), (F.col("k") % F.col("c")).alias("extra"))
    part = g.where("extra > 0").select(F.col("source").alias("s"), F.col("size").alias("z"), "extra")
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    prefix = F.shiftright("h", 53).alias("p")
    bins = docs.groupBy("source", "size", prefix).agg(F.count("*").alias("n"))
    bins = bins.groupBy("source", "size").agg(F.array_sort(F.collect_list(F.struct("p", "n"))).alias("bins"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("p"), F.lit(0).cast("long").alias("before"))
    step = lambda s, x: F.when(s["p"].isNotNull(), s).otherwise(F.struct(
        (s["n"] + x["n"]).alias("n"), F.when(s["n"] + x["n"] >= F.col("extra"), x["p"]).alias("p"), s["n"].alias("before")))
    at = (bins.join(part, same).select("s", "z", "extra", F.aggregate("bins", zero, step).alias("a"))
          .select("s", "z", F.col("a.p").alias("at"), (F.col("extra") - F.col("a.before")).alias("left")))
    last = (docs.select("source", "size", "h", prefix).join(at, same & (F.col("p") == F.col("at")))
            .groupBy("source", "size", "left").agg(F.array_sort(F.collect_list("h")).alias("h"))
            .select(F.col("source").alias("s"), F.col("size").alias("z"), F.element_at("h", F.col("left").cast("int")).alias("upto")))
    return g.join(last, same, "left").select("source", "size", "base", "upto")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2) -> tuple[DataFrame, DataFrame]:
    """Copies of each (source, size) group and targets of each source.

    Returns (groups, targets): groups as of :func:`extra_limits`, for :func:`with_copies`.
    """
    slim = stored(docs.select("source", tokens().alias("size"), order_hash().alias("h")), "sizes")
    sizes = stored(slim.groupBy("source", "size").agg(F.count("*").alias("c")), "size-counts")
    targets = stored(source_targets(sizes, weights, share, float(cap)), "targets")
    copies = whole_copies(sizes, targets, tilts(sizes, targets, float(cap)), cap)
    return stored(extra_limits(slim, copies), "mix"), targets


def with_copies(docs: DataFrame, groups: DataFrame, size: str = "__mix_size", copies: str = "__mix_copies") -> DataFrame:
    """``docs`` with its token count and its number of copies as two more columns."""
    s, z, base, upto = (f"__mix_{x}" for x in ("source", "group", "base", "upto"))
    g = groups.toDF(s, z, base, upto)
    j = docs.withColumn(size, tokens()).join(g, F.col("source").eqNullSafe(F.col(s)) & (F.col(size) == F.col(z)))
    more = F.coalesce((order_hash() <= F.col(upto)).cast("int"), F.lit(0))
    return j.withColumn(copies, (F.col(base) + more).cast("int")).drop(s, z, base, upto)
