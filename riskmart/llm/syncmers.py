"""Document fingerprints from closed syncmers of words, in DataFrame functions only.

A k-mer of words is a closed syncmer when the smallest hash among its inner
runs of ``INNER`` words stands at its first or last place.  That depends on the
k-mer alone, so an edit elsewhere leaves an anchor where it is.  A fingerprint
is the list of anchors in text order, each as its hash and its distance in words
from the anchor before, written in hex; the likeness of two fingerprints is the
share of anchors that agree in hash and relative position (2 common / all).

The next document (descending doc_id) is found by order, without a global sort of
texts: rows fall into buckets between borders that are quantiles of the ids, an id
that holds several borders is spread over as many buckets by its text hash, the
heads of the buckets are chained, and each bucket gets a copy of the next
bucket's head as its last row.  Texts move once, to their bucket.

Cases: a null text counts as empty; an empty text has an empty fingerprint, like
1 to another empty one and like 0 to the rest; fewer words than a k-mer give one
anchor of all words; rows with a null doc_id come after all others, in the order of
their text hash; repeated doc_ids are ordered by text hash, and equal rows follow
each other; after the last row comes the first, so a single row follows itself;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import stored, table

#: Words of a k-mer and of its inner runs: of 8 places 2 are edges, so about every fourth k-mer is an anchor.
KMER, INNER = 9, 2
#: Rows of a bucket, on average, up to ``BORDERS`` buckets; with more rows the buckets grow (they are sorted, not gathered).
BUCKET, BORDERS = 1024, 4096
#: Borders that are looked through at once: first every ``STRIDE``-th, then those between two.
STRIDE = 64

WHITE = r"[\x20\x09-\x0D]+"


def _get(array: str, i: Column) -> Column:
    return F.get(array, i)


def with_anchors(rows: DataFrame, text: str, out: str, kmer: int = KMER, inner: int = INNER) -> DataFrame:
    """Adds ``out``: the anchors of column ``text`` as array<long>, hash in the upper 48 bits, distance below."""
    keep = rows.columns
    words = F.filter(F.split(F.col(text), WHITE), lambda w: w != "")
    step = rows.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias("_h"))
    # A window that reaches past the end is made of nulls there and is never asked for.
    runs = F.transform("_h", lambda h, i: F.xxhash64(h, *[_get("_h", i + j) for j in range(1, inner)]))
    step = step.select(*keep, "_h", runs.alias("_r"))
    last = kmer - inner

    def closed(i: Column) -> Column:
        edge = F.least(_get("_r", i), _get("_r", i + last))
        return edge <= F.least(*[_get("_r", i + j) for j in range(1, last)], F.lit(2 ** 63 - 1))

    places = F.when(F.size("_h") >= kmer, F.filter(F.sequence(F.lit(0), F.size("_h") - kmer), closed))
    step = step.select(*keep, "_h", places.alias("_p"))
    high = lambda h: F.shiftleft(h, 16)
    anchors = F.transform("_p", lambda p, n: high(F.xxhash64(*[_get("_h", p + j) for j in range(kmer)])).bitwiseOR(
        F.when(n == 0, F.lit(0)).otherwise(F.least(p - _get("_p", n - 1), F.lit(65535))).cast("long")))
    few = F.when(F.size("_h") > 0, F.array(high(F.xxhash64("_h")))).otherwise(F.array().cast("array<bigint>"))
    return step.select(*keep, F.coalesce(anchors, few).alias(out))


def written(anchors: str) -> Column:
    return F.concat_ws(" ", F.transform(anchors, lambda a: F.lower(F.hex(a))))


def likeness(a: str, b: str) -> Column:
    left, right = F.array_distinct(a), F.array_distinct(b)
    common = F.size(F.array_intersect(a, b)) * 2.0
    every = F.size(left) + F.size(right)
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def _borders_below(key: Column, borders: list[int]) -> Column:
    """How many of the sorted ``borders`` are smaller than ``key``."""
    if not borders:
        return F.lit(0)
    every = F.array(*[F.lit(x).cast("long") for x in borders])
    coarse = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in borders[::STRIDE]]), lambda x: x < key))
    near = F.slice(every, F.greatest(coarse - 1, F.lit(0)) * STRIDE + 1, F.lit(STRIDE))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * STRIDE + F.size(F.filter(near, lambda x: x < key)))


def bucket_of(key: Column, text_hash: Column, borders: list[int]) -> Column:
    """The bucket of a row, rising with (key, text hash)."""
    hot = {x: n for x, n in Counter(borders).items() if n > 1}
    spread = F.lit(0)
    if hot:
        # A key on several borders: by the upper 31 bits of its text hash, moved to 0 and above.
        share = F.element_at(F.create_map(*[F.lit(v) for x, n in hot.items() for v in (F.lit(x).cast("long"), n)]), key)
        spread = F.coalesce(1 + F.floor((F.shiftright(text_hash, 33) + (1 << 30)) * share / F.lit(1 << 31)), F.lit(0))
    return _borders_below(key, borders).cast("long") * (1 << 20) + spread.cast("long")


def in_order(docs: DataFrame, bucket: int = BUCKET, borders: int = BORDERS) -> tuple[DataFrame, object]:
    """(rows with doc_id, text, _ghost, and the window in which a row's lead is its next document).
    Rows with _ghost = 1 only close a bucket."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_t"))
    low = keyed.agg(F.min("doc_id")).first()[0] or 0
    # ids that are null: below all others (the lowest ids of all leave no room there, and share it)
    far = F.greatest(F.lit(max(low - 1, -1 << 63)).cast("decimal(20,0)") - F.pmod(F.col("_t"), F.lit(1 << 20)),
                     F.lit(-1 << 63).cast("decimal(20,0)")).cast("long")
    keyed = keyed.withColumn("_k", F.coalesce("doc_id", far))
    n = keyed.count()
    parts = max(1, min(borders, -(-n // bucket)))
    cuts = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        cuts = sorted(keyed.agg(F.percentile_approx("_k", at, 8 * parts)).first()[0])  # at most ``borders`` numbers
    keyed = keyed.withColumn("_b", bucket_of(F.col("_k"), F.col("_t"), cuts))
    heads = stored(keyed.groupBy("_b").agg(F.max(F.struct("_k", "_t")).alias("head")), "syncmer-heads")
    # One row a bucket, at most twice ``borders``.
    every = Window.orderBy(F.col("_b").desc())
    ends = heads.select(F.col("_b").alias("_to"), F.coalesce(
        F.lead("head").over(every), F.max("head").over(every.rowsBetween(Window.unboundedPreceding, 0))).alias("next"))
    ends = ends.select("_to", F.col("next._k").alias("_k"), F.col("next._t").alias("_t"))
    # Of equal rows one closes the bucket.
    ghosts = keyed.select("_k", "_t", "text").join(ends, ["_k", "_t"]).dropDuplicates(["_to"]).select(
        F.lit(None).cast("long").alias("doc_id"), "text", "_t", "_k", F.col("_to").alias("_b"), F.lit(1).alias("_ghost"))
    rows = keyed.withColumn("_ghost", F.lit(0)).unionByName(ghosts)
    order = Window.partitionBy("_b").orderBy("_ghost", F.col("_k").desc(), F.col("_t").desc())
    return rows, order


def fingerprinted(docs: DataFrame, bucket: int = BUCKET, kmer: int = KMER, inner: int = INNER) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next."""
    if not 0 < inner < kmer:
        raise ValueError("an inner run is shorter than its k-mer")
    rows, order = in_order(docs, bucket)
    rows = rows.withColumn("_next", F.lead("text").over(order))
    rows = with_anchors(rows, "text", "_own", kmer, inner)
    rows = rows.withColumn("_after", F.lead("_own").over(order)).where("_ghost = 0")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "_own", "_after")
    rows = with_anchors(rows, "edited", "_edited", kmer, inner)
    return rows.select("doc_id", "n_chars", "edited", written("_own").alias("fingerprint"),
                       written("_edited").alias("edited_fingerprint"), likeness("_own", "_edited").alias("near_edited"),
                       likeness("_own", "_after").alias("near_next"))


def op5_syncmers(spark, sf_dir) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts."""
    out = fingerprinted(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                      "fingerprint", "edited_fingerprint", "near_edited", "near_next")
