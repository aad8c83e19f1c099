"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Every source gets the same level ``t`` times its weight, clamped at
``max_epochs`` times its size; what a clamp frees is shared again in proportion
to the weights of the sources that are still free, until no source is above
its clamp.  Only sums leave the source table in a round, never its rows.

A source whose target is ``e`` times its size is repeated ``floor(e)`` times
whole; for the fractional rest its documents are put in a seeded order and
taken until the rest is filled (the document at the border is in if at least
half of it fits).  Running sums are made in two steps, over (source, slice of
the seeded order) and then inside a slice, so that a source with a third of all
rows is spread over 16 ** SLICE_DIGITS groups.

Cases: a null or blank text has size 0, target 0 if its source has no words,
and is taken 0 times; a null source is a source of its own, last in order;
repeated rows are separate documents; rows that tie in the seeded order have
the same doc_id, and the smaller comes first (equal ones are told apart in no order that matters); an empty table gives an empty
mix; columns other than the named ones pass through ``mixed`` untouched.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import stored, table

#: Weights dealt to the sources in code point order, again and again.
WEIGHTS = (5, 2, 1)
#: Words to share: 3/2 of all words.
SHARE = (3, 2)
MAX_EPOCHS = 2
SEED = "mix-1"
#: Slices of a source's seeded order: 16 ** 2, by the first two hex digits.
SLICE_DIGITS = 2

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_sizes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight) with a weight by position in code point order, null last.
    ``docs`` has source and size.  One row per source reaches the ordering step."""
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    return sizes.select("source", "source_size", weight.cast("long").alias("weight"))


def water_fill(sizes: DataFrame, share: tuple[int, int] = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target``.  The level is a quotient of whole numbers, so equal inputs give equal bits."""
    up, down = share
    # Products of sums of words and of weights outgrow 64 bits with very many sources.
    exact = lambda x: F.lit(Decimal(x)).cast("decimal(38,0)") if isinstance(x, int) else x.cast("decimal(19,0)")
    clamp = F.col("source_size") * max_epochs
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * up  # in units of 1/down words
    level, n_clamped = (0, 1), -1
    while True:
        above = exact(clamp) * exact(level[1]) <= exact(F.col("weight")) * exact(level[0])
        clamped, used, free = sizes.agg(
            F.coalesce(F.sum(above.cast("long")), F.lit(0)),
            F.coalesce(F.sum(F.when(above, clamp)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if clamped == n_clamped or not free:
            break
        level, n_clamped = (total - used * down, free * down), clamped
    share_of = (exact(F.col("weight")) * exact(level[0])).cast("double") / F.lit(float(level[1]))
    return sizes.withColumn("target", F.when(above, clamp.cast("double")).otherwise(share_of))


def _decided(docs: DataFrame, weights, share, max_epochs: int, seed: str) -> DataFrame:
    """doc_id, source, size, _text (a hash), source_size, target and repeats of every row; no text goes on from here."""
    order = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    # The texts are read once for their sizes; everything goes on from there.
    slim = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_text"))
    slim = stored(slim.withColumn("_order", order).withColumn("_slice", F.substring("_order", 1, SLICE_DIGITS)), "mix-sizes")
    targets = water_fill(stored(source_sizes(slim, weights), "mix-sources"), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.select(
        "source", "source_size", "target", whole.cast("long").alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("rest"))
    slices = slim.groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(F.col("source").alias("_source"), F.col("_slice").alias("_at"),
                           F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    # One row per source (and slice); whether that is broadcast is left to the sizes seen at run time.
    slices = slices.join(targets, F.col("_source").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "_slice").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, -1)
    sized = slim.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = sized.join(slices, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice") == F.col("_at")))
    left = F.col("rest") - F.col("_before") - F.col("_inside")
    extra = (F.col("size") > 0) & (left * 2 >= F.col("size"))
    return out.select("doc_id", "source", "size", "_text", "source_size", "target", (F.col("whole") + extra.cast("long")).alias("repeats"))


def planned(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, repeats (whole repetitions, the sampled one included), taken."""
    return _decided(docs, weights, share, max_epochs, seed).select(
        "doc_id", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its own columns.

    Rows are joined to their decision by doc_id, source and text.  Of rows that agree in these some may be taken once more
    than others (at the border of a source's sampled repetition, so one such group a source): there they are numbered."""
    key = ("doc_id", "source", "_text")
    decided = _decided(docs, weights, share, max_epochs, seed).groupBy(*key).agg(
        F.min("repeats").alias("_least"), F.max("repeats").alias("_most"), (F.sum("repeats") - F.min("repeats") * F.count(F.lit(1))).alias("_more"))
    decided = stored(decided.where("_most > 0"), "mix-decided").withColumnsRenamed({c: f"_of{c}" for c in key})
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs["doc_id"].alias("doc_id"),
                       docs["source"].alias("source"), F.xxhash64(docs["text"]).alias("_text"))
    same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in key]
    even = rows.join(decided.where("_least = _most"), same).select("_row", F.col("_least").alias("_times"))
    other = F.xxhash64(*[F.col("_row")[c] for c, t in docs.dtypes if "map<" not in t])
    numbered = F.row_number().over(Window.partitionBy(*[f"_of{c}" for c in key]).orderBy(other))
    uneven = rows.join(decided.where("_least < _most"), same).withColumn("_number", numbered).select(
        "_row", (F.col("_least") + (F.col("_number") <= F.col("_more")).cast("long")).alias("_times"))
    times = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))
    return even.unionByName(uneven).where("_times > 0").select("_row", times).select("_row.*")


def op7_mixing(spark, sf_dir) -> DataFrame:
    """All ``documents`` mixed to the weights 5, 2, 1 at 150 % of their words, at most two epochs."""
    return planned(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: Closed form of the same filling: sources by clamp over weight; the level after the first k clamps.
OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, source, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS o,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size,
             CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
      FROM s),
c AS (SELECT *, sum(2 * source_size) OVER p AS used, sum(weight) OVER p AS gone,
             sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
      FROM w WINDOW p AS (ORDER BY 2.0 * source_size / weight, source_size, encode(source) NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
l AS (SELECT *, CAST(3 * total - 2 * (used - 2 * source_size) AS BIGINT) AS up,
             CAST(2 * (weights - gone + weight) AS BIGINT) AS down FROM c),
v AS (SELECT up, down FROM l WHERE 2 * source_size * down > weight * up
      ORDER BY 2.0 * source_size / weight, source_size, encode(source) NULLS LAST LIMIT 1),
t AS (SELECT w.source, w.source_size,
             CASE WHEN v.up IS NULL OR 2 * w.source_size * v.down <= w.weight * v.up THEN CAST(2 * w.source_size AS DOUBLE)
                  ELSE CAST(w.weight * v.up AS DOUBLE) / CAST(v.down AS DOUBLE) END AS target
      FROM w LEFT JOIN v ON true),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN size > 0 AND (target - whole * source_size - before) * 2 >= size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
