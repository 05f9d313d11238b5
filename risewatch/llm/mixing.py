"""Mixing sources to target weights with hash-threshold histograms. Native DataFrame functions only.

Every document has a hash. For each source, words are summed by source and hash bucket; the bucket in which the budget
runs out is cut into finer buckets, and so on: three levels of 4,096 buckets fix 36 bits of the hash, and only the boundary
bucket is refined each time. Documents below the threshold are taken once more than the others. No sort of documents, and
a larger budget takes a superset of a smaller one.

Defined cases: a null text has size 0; null is a source of its own and comes last; a table without words has targets 0;
rows equal in id and text share a hash
and are taken or left together, so a source misses its target by at most the words of one such set of rows; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risewatch.llm.shared import settle

LEVEL_BITS = 12
LEVELS = 3
#: Weights of the sources in their order, repeating; share of all words the mix takes; copies of a document at most.
WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2


def words(text: Column) -> Column:
    """Number of maximal runs of characters that are not white space."""
    runs = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(runs, " \t\n\x0b\x0c\r", "")).cast("long")


def _cell(level: int) -> Column:
    """Bucket of the hash on a level, from its highest bits down."""
    return F.shiftrightunsigned("hash", 64 - LEVEL_BITS * (level + 1)).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target: weights shared out over the sources (a row each; in code point order, null last).

    A source's target stops at `most` times its size and the excess goes to the others by weight: target = min(cap, level
    * weight) for the one level at which the targets add up. In order of cap / weight, the level follows from the sums
    before (caps) and after (weights); the first source that does not reach its cap shows it. The windows run over one row
    per source, not over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1))
    whole = Window.partitionBy()
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    at = (
        ranked.withColumn("cap", (F.col("source_size") * most).cast("double"))
        .withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("capped", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open"))
        .withColumn("level", F.min(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(whole)["level"])
    )
    return at.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def _refine(rows: DataFrame, plan: DataFrame, level: int) -> DataFrame:
    """Adds to each source's plan the boundary bucket of this level and what is left of the budget inside it."""
    inside = rows.join(plan, rows["source"].eqNullSafe(plan["source"]), "inner").select(rows["source"], "hash", "size", *[f"cut{i}" for i in range(level)])
    for i in range(level):
        inside = inside.where(_cell(i) == F.col(f"cut{i}"))
    sums = inside.groupBy("source", _cell(level).alias("cell")).agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    found = sums.select(F.col("source").alias("s"), "cell", "words", "before").join(plan, F.col("s").eqNullSafe(plan["source"]))
    hit = found.where("before <= rest").groupBy("source").agg(F.max_by(F.struct("cell", "before", "words"), F.col("cell")).alias("hit"))
    out = plan.join(hit.withColumnRenamed("source", "s"), F.col("s").eqNullSafe(plan["source"]), "left").drop("s")
    cut = F.coalesce(F.col("hit.cell"), F.lit(0).cast("long"))
    left = F.col("rest") - F.coalesce(F.col("hit.before"), F.lit(0))
    if level == LEVELS - 1:  # the last bucket, a document as a rule, is taken if that brings the sum nearer the target
        cut = cut + (left * 2 >= F.coalesce(F.col("hit.words"), F.lit(0))).cast("long")
    return out.withColumn(f"cut{level}", cut).withColumn("rest", left).drop("hit")


def mix_plan(rows: DataFrame, **kind) -> DataFrame:
    """source, source_size, target, full (copies all documents get) and the threshold of one more copy.

    rows: source, size, hash; read once per level, so a stored narrow table.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, **kind).withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = settle(plan.withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")))
    for level in range(LEVELS):
        plan = settle(_refine(rows, plan, level))
    bits = 64 - LEVEL_BITS * LEVELS
    cut = sum((F.col(f"cut{i}") * (1 << LEVEL_BITS * (LEVELS - 1 - i)) for i in range(LEVELS)), F.lit(0))
    return plan.select("source", "source_size", "target", "full", cut.alias("threshold"), F.lit(bits).alias("shift"))


def _hash(seed: int, doc_id: str, text: str) -> Column:
    """Of id and text: rows that share one id, or have none, still spread over the buckets."""
    return F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("hash")


def hashed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        words(F.col(text_col)).alias("size"),
        _hash(seed, id_col, text_col),
    )


def copies_taken() -> Column:
    return (F.col("full") + (F.shiftrightunsigned("hash", 64 - LEVEL_BITS * LEVELS) < F.col("threshold")).cast("long")).cast("long")


def mix(docs: DataFrame, **kind) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (size times copies) of every document."""
    rows = settle(hashed(docs, **kind))
    plan = mix_plan(rows)
    joined = rows.join(plan.withColumnRenamed("source", "s"), rows["source"].eqNullSafe(F.col("s")), "left")
    return joined.select("doc_id", "source", "size", "source_size", "target", copies_taken().alias("copies"), (F.col("size") * copies_taken()).alias("taken"))


def mixed(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The documents of the mix, a row per copy, with the columns of docs. The plan (a row per source) joins the texts in place."""
    plan = mix_plan(settle(hashed(docs, seed=seed))).select(F.col("source").alias("_mix_source"), "full", "threshold")
    keep = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_mix_doc")
    rows = docs.select(keep, _hash(seed, "doc_id", "text"))
    taken = rows.join(plan, F.col("_mix_doc.source").eqNullSafe(F.col("_mix_source")), "inner")
    return taken.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(0), copies_taken().cast("int")))).select("_mix_doc.*")
