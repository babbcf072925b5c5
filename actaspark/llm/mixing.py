"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a share of all words by its weight, stopped at ``max_epochs`` times its own words; what is
over is shared again by weight. A source is taken whole as often as its target allows (complete epochs);
what is left of the target is filled with a weighted sample without replacement: documents stand in the
order of the key -ln(u) / w, u being a hash of the document and w its quality weight, and their words are
summed along that order until the budget is used up. Documents that no longer fit are passed over, and the
remaining gap is filled in further passes along the same order, so a long document at the end of a budget
leaves no large hole. The last pass takes documents as long as each brings the sum nearer to the target, also
one that is longer than the gap, so what is missing or too much in the end is at most half a document.

No source is ever sorted as a whole: keys are summed by classes of equal ratio, which hold small shares of a source
whatever its weights, and only the class in which the budget ends is ordered. Texts are never shuffled.

Defined results: null text has no words; null sources are one source, last in order; a source without words
has target 0; very long documents count whole; wholly equal rows tie and are taken or left together; columns
named ``mix_*`` are replaced, others stay whatever their names; an empty table gives no rows."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, forget, stored, text_of

#: Key classes of a factor of two; keys lie between 2 ** -60 and 2 ** 60.
CLASSES, LAST_CLASS = 4096, 60 * 4096
#: Sources whose plan (some hundred bytes each) is broadcast.
MAX_BROADCAST_SOURCES = 20_000


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def quality_weight(column: str = "text") -> Column:
    """1 for plain prose, less the more digits and signs of markup a text has."""
    text = text_of(column)
    marks = F.regexp_count(text, F.lit(r"[0-9#$%&*|<>{}=+~^_\\]"))
    return F.lit(1.0) / (1.0 + 10.0 * marks / F.greatest(F.length(text), F.lit(1)))


def with_keys(docs: DataFrame, seed: int, weight: Column | None = None) -> DataFrame:
    """``docs`` with size, tie and key (both from the document alone, so reruns agree) and the class of the key."""
    tie = F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(seed))
    u = F.least((F.shiftrightunsigned("mix_tie", 11).cast("double") + 0.5) * (2.0**-53), F.lit(1 - 2.0**-53))
    key = -F.log(u) / F.greatest(weight if weight is not None else quality_weight(), F.lit(1e-6))
    keyed = docs.withColumns({"mix_size": n_words(), "mix_tie": tie}).withColumn("mix_key", key)
    return keyed.withColumn("mix_class", F.floor(F.log2("mix_key") * CLASSES).cast("int"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """From (source, source_size): target, epochs, rest. The windows run over one row for each source.

    Sources ordered by cap over weight: one is capped if the level that the earlier caps leave lies above
    its own; the others share what remains by weight."""
    everything = Window.partitionBy()
    order = Window.orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("w", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumns({"cap": F.col("source_size") * float(max_epochs), "total": F.sum("source_size").over(everything).cast("double"), "all_w": F.sum("w").over(everything)})
    earlier = Window.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    left_w = F.col("all_w") - F.coalesce(F.sum("w").over(earlier), F.lit(0.0))
    rows = rows.withColumn("capped", F.col("cap") * left_w <= F.col("w") * left)
    free = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0))
    free_w = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)
    rows = rows.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("w") * free / free_w)))
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(max_epochs), F.floor(F.col("target") / F.greatest("source_size", F.lit(1))))).otherwise(0).cast("int")
    rows = rows.withColumn("epochs", epochs)
    return rows.select("source", "source_size", "target", "epochs", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"))


def _key() -> Column:
    return F.struct(F.col("mix_key").alias("key"), F.col("mix_tie").alias("tie"), F.col("doc_id").alias("id"))


def _within(step: Column) -> Column:
    """Whether a step (gap, class, last key) takes a row."""
    before = F.col("mix_class") < step["cls"]
    at = (F.col("mix_class") == step["cls"]) & F.coalesce(_key() <= step["last"], F.lit(False))
    return (F.col("mix_size") <= step["gap"]) & (before | at)


def _by_source(rows: DataFrame, plan: DataFrame, n_sources: int) -> DataFrame:
    p = plan.withColumnRenamed("source", "plan_source")
    p = F.broadcast(p) if n_sources <= MAX_BROADCAST_SOURCES else p
    return rows.join(p, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")


def _step(keys: DataFrame, plan: DataFrame, n_sources: int, last: bool) -> DataFrame:
    """``plan`` with one more step for each source."""
    rows = _by_source(keys, plan.select("source", "steps", "rest"), n_sources)
    longest = F.col("rest") * (2 if last else 1)
    rows = rows.filter((F.col("rest") > 0) & (F.col("mix_size") > 0) & (F.col("mix_size") <= longest) & ~F.exists("steps", _within))
    classes = rows.groupBy("source", "mix_class").agg(F.sum("mix_size").alias("n"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("mix_class").rowsBetween(Window.unboundedPreceding, 0)
    classes = classes.withColumn("upto", F.sum("n").over(upto))
    # the class in which the budget ends; without one every candidate fits
    ends = classes.groupBy("source").agg(
        F.coalesce(F.min(F.when(F.col("upto") > F.col("rest"), F.col("mix_class"))), F.lit(LAST_CLASS)).alias("cls"),
        F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))), F.lit(0)).alias("below"),
    )
    at = ends.withColumnsRenamed({"source": "end_source"})
    inside = rows.join(F.broadcast(at) if n_sources <= MAX_BROADCAST_SOURCES else at, F.col("source").eqNullSafe(F.col("end_source")) & (F.col("mix_class") == F.col("cls")))
    along = Window.partitionBy("source").orderBy("mix_key", "mix_tie", "doc_id")
    inside = inside.withColumn("used", F.col("below") + F.sum("mix_size").over(along))
    fits = F.col("used") - (F.col("mix_size") / 2 if last else F.lit(0)) <= F.col("rest")
    lasts = inside.filter(fits).groupBy("source").agg(F.max(_key()).alias("last"), F.max("used").alias("used"))
    a, b = ends.alias("a"), lasts.alias("b")
    found = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")), "left").select("a.source", "cls", "below", "last", "used")
    p, f = plan.alias("p"), found.alias("f")
    joined = p.join(f, F.col("p.source").eqNullSafe(F.col("f.source")), "left")
    step = F.when(F.col("f.cls").isNotNull(), F.array(F.struct((F.col("p.rest") * (2 if last else 1)).alias("gap"), F.col("f.cls").alias("cls"), F.col("f.last").alias("last"))))
    rest = F.greatest(F.lit(0.0), F.col("p.rest") - F.coalesce(F.col("f.used"), F.col("f.below"), F.lit(0)))
    steps = F.when(step.isNotNull(), F.concat(F.col("p.steps"), step)).otherwise(F.col("p.steps"))
    return joined.select("p.source", "p.source_size", "p.target", "p.epochs", steps.alias("steps"), rest.alias("rest"))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 17, passes: int = 4, weight: Column | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(keys of all documents without their texts, the plan of each source, number of sources)."""
    keys = stored(with_keys(docs.select("doc_id", "text", "source"), seed, weight).drop("text"), "mix-keys")
    sizes = keys.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    none = F.array().cast("array<struct<gap:double,cls:int,last:struct<key:double,tie:bigint,id:bigint>>>")
    plan = stored(targets(sizes, weights, max_epochs).withColumn("steps", none), "mix-plan")
    n_sources = plan.count()
    for k in range(passes):
        old, plan = plan, stored(_step(keys, plan, n_sources, k == passes - 1), "mix-plan")
        forget(old)
    return keys, plan, n_sources


def taken(rows: DataFrame, plan: DataFrame, n_sources: int) -> DataFrame:
    """``rows`` (with keys) and how often the mix takes each: ``mix_copies``."""
    return _by_source(rows, plan.drop("rest"), n_sources).withColumn("mix_copies", F.col("epochs") + F.exists("steps", _within).cast("int"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, epochs, copies, taken."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    keys, plan, n = mix_plan(rows, **options)
    out = taken(keys, plan, n)
    return out.select("doc_id", "source", F.col("mix_size").alias("size"), "source_size", "target", "epochs", F.col("mix_copies").alias("copies"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The mix itself: ``docs`` with every document as often as it is taken. Texts stay where they are read."""
    _, plan, n = mix_plan(docs, seed=seed, **options)
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("mix_row"), "doc_id", "text", "source")
    rows = taken(with_keys(own, seed, options.get("weight")).drop("text"), plan, n)
    copies = F.when(F.col("mix_copies") > 0, F.sequence(F.lit(1), F.col("mix_copies"))).otherwise(F.array().cast("array<int>"))
    return rows.select("mix_row", F.explode(copies)).select("mix_row.*")
