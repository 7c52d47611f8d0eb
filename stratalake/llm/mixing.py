"""Mixing sources to target weights with Pareto order sampling; DataFrame functions only.

The size of a document is its number of words. A source's target is its share of the wanted
volume by weight; it stops at `CEILING` times the source's size, and what is cut off goes to
the others by weight. That is the level at which min(ceiling, level * weight) sums to the
volume, found from sums over the sources ordered by ceiling / weight.

Inside a source every document gets the whole number of copies below target / size for
certain. The rest of the target is drawn: a document's inclusion measure is the root of its
size, scaled so that the expected words are the rest; documents whose measure would reach one
are certain, and the scale is that of the others. Documents are ranked by random odds over
inclusion odds (Pareto order sampling), certain ones first, and taken in that order up to the
fixed size, which is counted in words. What the first document beyond it leaves open is filled by a second pass over
smaller documents further down.

The cut is one key per source, found by summing words in bins of the rank, then in bins of the
one bin that holds the cut, and only then by row; no source is sorted or gathered as a whole.
The tables with one row per source are stored first, so Spark knows their size and broadcasts
them only below its limit. A row's decision follows from its own values and the cuts, so a retried task repeats it.

Null texts have size 0 and are never drawn; null sources form the last source; an empty table
gives no rows. Rows with equal id, text and source are numbered, and each is drawn by itself: which
number a row gets is arbitrary, how many of them are taken is not. Sources are expected to be far
fewer than documents: one row per source is ordered in one task, and the distinct sizes of a source in
another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import WORD, fresh, join_checked, staged

WEIGHTS, VOLUME, CEILING, BINS = (5, 2, 1), 1.5, 2, 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, volume: float = VOLUME, ceiling: int = CEILING) -> DataFrame:
    """(source, source_size, target) from rows (source, size)."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    ranked = sums.withColumn("weight", weight).withColumn("cap", ceiling * F.col("source_size"))
    ranked = ranked.withColumn("reach", F.col("cap") / F.col("weight"))
    order = Window.orderBy("reach", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    levels = ranked.withColumn("n", F.row_number().over(order)).withColumn("level", (volume * total - before) / left)
    first = F.min(F.when(F.col("level") <= F.col("reach"), F.struct("n", "level"))).over(Window.partitionBy())
    target = F.least(F.col("cap").cast("double"), F.col("found.level") * F.col("weight"))
    return levels.withColumn("found", first).select("source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def numbered(docs: DataFrame, out: str, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """`docs` with a column `out` that counts rows of equal id, text and source from 0.

    Only such rows are looked at, in a stored copy: counted by the task that wrote them, plus what
    the tasks before it have, so that a row repeated very often is spread like any others."""
    name, part, start = fresh(docs, "row_name"), fresh(docs, "part"), fresh(docs, "start")
    body = F.md5(F.coalesce(F.col(text), F.lit("")))
    named = docs.withColumn(name, F.md5(F.to_json(F.struct(F.col(doc_id).alias("i"), F.col(source).alias("s"), body.alias("t")))))
    repeated = staged(named.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name), "mix-repeated")
    if repeated.isEmpty():
        return docs.withColumn(out, F.lit(0).cast("long"))
    rows = staged(join_checked(named, repeated, name, "left_semi").withColumn(part, F.spark_partition_id()), "mix-copies")
    before = Window.partitionBy(name).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(name, part).agg(F.count(F.lit(1)).alias("n"))
    starts = staged(starts.select(name, part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start)), "mix-starts")
    inside = Window.partitionBy(name, part).orderBy(F.xxhash64(F.to_json(F.struct(*docs.columns))))
    counted = join_checked(rows.withColumn(out, F.row_number().over(inside)), starts, [name, part])
    counted = counted.withColumn(out, F.col(start) + F.col(out) - 1)
    single = join_checked(named, repeated, name, "left_anti").withColumn(out, F.lit(0).cast("long"))
    return single.select(*docs.columns, out).unionByName(counted.select(*docs.columns, out))


def draw_number(doc_id: Column, text: Column, number: Column, seed: str) -> Column:
    """52 hashed bits of the id, the text and the number among equal rows."""
    parts = (F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))), number.cast("string"))
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def pareto_rank(draw: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds, as a number from 0 to 1 in the same order; 0 if certain."""
    u = (draw + 0.5) / float(1 << 52)
    p = F.when(inclusion > 0, inclusion)
    ratio = (u / (1 - u)) / (p / (1 - p))
    return F.when(p >= 1, 0.0).otherwise(ratio / (1 + ratio))


def sized_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix") -> DataFrame:
    number = fresh(docs, "number")
    rows = numbered(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")), number)
    return rows.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        draw_number(F.col("doc_id"), F.col("text"), F.col(number), seed).alias("draw"),
    )


def inclusion_scales(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, scale): the measure scale * root(size), or 1 where that is more, adds up to the
    source's `rest` in words. Sizes go down; those before the first that stays below 1 are certain."""
    sizes = rows.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.alias("l").join(plan.where("rest > 0").alias("r"), F.col("l.source").eqNullSafe(F.col("r.source"))).select("l.*", "r.rest")
    order = Window.partitionBy("source").orderBy(F.desc("size"))
    certain = F.coalesce(F.sum(F.col("size") * F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    roots = F.sum(F.col("n") * F.col("size") * F.sqrt("size")).over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = sizes.withColumn("scale", (F.col("rest") - certain) / roots)
    drawn = levels.where(F.col("scale") * F.sqrt("size") < 1)
    return drawn.groupBy("source").agg(F.max_by("scale", "size").alias("scale"))


def _prefix(groups: DataFrame, by: list[str], budget: str) -> DataFrame:
    """The first group of each source, in order of `by`, with which the words exceed the budget,
    and the words before it."""
    window = Window.partitionBy("source").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    cum = groups.withColumn("cum", F.sum("words").over(window)).where(F.col("cum") > F.col(budget))
    first = F.min(F.struct(*by, (F.col("cum") - F.col("words")).alias("before"))).alias("first")
    return cum.groupBy("source").agg(first).select("source", "first.*")


def _cut(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cut, spent) for rows (source, size, rank, draw) and budgets (source, budget).

    The rows below `cut` hold `spent` words; a source whose rows all fit has no cut."""
    same = lambda right, *cols: [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("source", *cols)]
    coarse = F.floor(F.col("rank") * BINS)
    fine = F.floor(F.col("rank") * (BINS * BINS))
    rows = rows.withColumn("coarse", coarse).withColumn("fine", fine)

    def narrowed(part: DataFrame, found: DataFrame, level: str) -> DataFrame:
        on = same(found, level)
        return part.alias("l").join(found.alias("r"), on[0] & on[1]).select("l.*", F.col("r.left").alias("left"))

    def level(part: DataFrame, by: list[str], budget: DataFrame | None) -> DataFrame:
        sums = part.groupBy("source", *by, *([] if budget is not None else ["left"])).agg(F.sum("size").alias("words"))
        if budget is not None:
            sums = sums.alias("l").join(budget.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
            sums = sums.select("l.*", F.col("r.budget").alias("left"))
        limits = sums.groupBy("source").agg(F.max("left").alias("limit"))
        found = _prefix(sums, by, "left").alias("l").join(limits.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
        return staged(found.select("l.*", (F.col("r.limit") - F.col("l.before")).alias("left")), "mix-level")

    top = level(rows, ["coarse"], budgets)
    part = staged(narrowed(rows, top, "coarse").select("source", "size", "rank", "draw", "fine", "left"), "mix-bin")
    mid = level(part, ["fine"], None)
    low = level(narrowed(part.drop("left"), mid, "fine"), ["rank", "draw", "size"], None)
    cuts = low.select("source", F.struct("rank", "draw", "size").alias("cut"), "left")
    spent = budgets.alias("l").join(cuts.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")), "left")
    return spent.select("l.source", "r.cut", F.col("r.left").alias("open"))


def plan_mix(rows: DataFrame, weights=WEIGHTS, volume: float = VOLUME, ceiling: int = CEILING) -> DataFrame:
    """One row per source: what `copies` needs to decide each document."""
    targets = source_targets(rows, weights, volume, ceiling)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = staged(targets, "mix-targets")
    scales = inclusion_scales(rows, targets)
    plan = targets.alias("l").join(scales.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")), "left")
    plan = staged(plan.select("l.*", "r.scale"), "mix-plan")
    ranked = ranked_rows(rows, plan).where("size > 0 and rest > 0").select("source", "size", "rank", "draw")
    first = staged(_cut(ranked, plan.select("source", F.col("rest").alias("budget"))), "mix-cut")
    gaps = first.where("cut is not null")
    later = ranked.alias("l").join(gaps.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
    later = later.where("struct(l.rank, l.draw, l.size) > r.cut and l.size <= r.open").select("l.*")
    second = _cut(later, gaps.select("source", F.col("open").alias("budget")))
    cuts = first.alias("l").join(second.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")), "left")
    cuts = cuts.select("l.source", "l.cut", "l.open", F.col("r.cut").alias("cut2"))
    out = plan.alias("l").join(cuts.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")), "left")
    return staged(out.select("l.*", "r.cut", "r.open", "r.cut2"), "mix-cuts")


def ranked_rows(rows: DataFrame, plan: DataFrame, source: str = "source") -> DataFrame:
    """Rows with their source's plan and their rank."""
    joined = rows.alias("l").join(plan.alias("r"), F.col(f"l.{source}").eqNullSafe(F.col("r.source")))
    extra = [F.col(f"r.{c}").alias(c) for c in plan.columns if c != "source"]
    rank = pareto_rank(F.col("draw"), F.col("scale") * F.sqrt("size"))
    return joined.select("l.*", *extra).withColumn("rank", rank)


def copies() -> Column:
    """Number of copies of a row that carries its source's plan and its rank."""
    key = F.struct("rank", "draw", "size")
    drawable = (F.col("size") > 0) & (F.col("rest") > 0)
    below = F.col("cut").isNull() | (key < F.col("cut"))
    filled = (key > F.col("cut")) & (F.col("size") <= F.col("open")) & (F.col("cut2").isNull() | (key < F.col("cut2")))
    return F.col("whole") + F.when(drawable & (below | filled), 1).otherwise(0)


def mixed(rows: DataFrame, weights=WEIGHTS, volume: float = VOLUME, ceiling: int = CEILING) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for rows of `sized_rows`."""
    plan = plan_mix(rows, weights, volume, ceiling)
    out = ranked_rows(rows, plan).withColumn("copies", copies())
    return out.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )
