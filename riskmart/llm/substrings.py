"""Substring dedup: repeated 50-word windows found through super-k-mers.

A window is ``WINDOW`` consecutive words of a document.  Its minimiser is the
smallest hash among its runs of ``INNER`` words, so equal windows have equal
minimisers, wherever they stand.  Consecutive windows with one minimiser form a
super-k-mer and travel as one string of their words to the minimiser's bucket.

1. Every text gives its minimisers (one row per super-k-mer: hash and document,
   no text).  A window in two documents has its minimiser in two documents, so
   a minimiser seen in one document only is done with.
2. Texts that hold a shared minimiser give their super-k-mers of such
   minimisers as packed strings.  Both text passes read one exchange by row key.
3. In a bucket equal strings collapse; the windows of the different strings are
   sorted, equal ones stand together, the smallest document of each is known,
   and every row learns which of its windows start in a smaller document too.
4. A minimiser with more than ``BUCKET`` super-k-mers or ``BUCKET_BYTES`` of them is not
   gathered: its windows become single rows keyed by a 128-bit digest of their words
   and a salt; the smallest document is found per salt, then per digest, and joined
   back per salt.

Hashes only choose where windows meet; in a bucket, windows are compared as words.  A
row is known by its doc_id and a hash of its text, so rows of different documents are
never taken for each other.

Cases: a null text has no words; a document with fewer words than a window loses
none; a null doc_id keeps its words and removes none; rows that repeat a doc_id are
judged each on its own text, and never against each other; white space between
kept words becomes one space; an empty table gives no rows; other columns are
carried untouched by ``deduplicated``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import as_bytes, mix64, row_chunks, span_hashes, spans, stored, table

WINDOW = 50
#: Words of the runs a minimiser is chosen from.
INNER = 8
#: Super-k-mers of one minimiser that a task gathers.
BUCKET = 4096
#: Bytes of the super-k-mers of one minimiser that a task gathers (their windows are some 50 times as much).
BUCKET_BYTES = 1 << 21
#: Window digests of one Arrow batch.
DIGESTS = 50_000
#: Tasks that the windows with one digest are dealt over.
SALTS = 32


def super_kmers(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, inner: int = INNER):
    """Runs of windows with one minimiser, over consecutive texts:
    (text, first word in the whole data, first word in the text, windows, minimiser), and the word spans."""
    starts, ends, first = spans(data, offsets)
    empty = np.zeros(0, np.int64)
    n = len(starts)
    if n < window:
        return empty, empty, empty, empty, empty, starts, ends
    hashes = span_hashes(data, starts, ends)
    runs = np.zeros(n - inner + 1, np.uint64)
    for k in range(inner):
        runs = runs * np.uint64(0xD6E8FEB86659FD93) + hashes[k:k + len(runs)]
    runs = mix64(runs)
    # Sliding minimum over window - inner + 1 runs, by doubling.
    width, least = window - inner + 1, runs
    step = 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        rest = width - step
        least = np.minimum(least[:-rest], least[rest:])
    counts = np.diff(first)
    text_of = np.repeat(np.arange(len(counts)), counts)[:len(least)]
    valid = np.arange(len(least)) + window <= first[text_of + 1]
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    at = np.flatnonzero(begins)
    # A run ends at the next one or after the last whole window of its text.
    stop = np.minimum(np.r_[at[1:], len(least)], first[text_of[at] + 1] - window + 1)
    return text_of[at], at, at - first[text_of[at]], stop - at, least[at].view(np.int64), starts, ends


def _minimisers(docs: DataFrame, window: int, inner: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_bytes(batch.column(2))
            for a, b in row_chunks(offsets):
                text, at, _, count, key, starts, ends = super_kmers(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a],
                                                                    window, inner)
                size = ends[at + count + window - 2] - starts[at] if len(at) else at
                rows = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(size)],
                    ["h", "row", "doc", "size"])

    return docs.where("named").select("row", "doc", "text").mapInArrow(run, "h long, row long, doc long, size long")


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: int, n: int) -> bytes:
    """n words from word a on, joined by one space."""
    return b" ".join(data[starts[a]:ends[a + n - 1]].tobytes().split())


def _packing(window: int, inner: int):
    """Batches of (row, doc, text, wanted minimisers) to batches of (h, row, doc, place, words): the
    packed super-k-mers of the wanted minimisers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_bytes(batch.column(2))
            wanted = batch.column(3)
            for a, b in row_chunks(offsets):
                part = data[offsets[a]:offsets[b]]
                text, at, place, count, key, starts, ends = super_kmers(part, offsets[a:b + 1] - offsets[a], window, inner)
                lists = wanted.slice(a, b - a)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(b - a), lists.value_lengths().to_numpy(zero_copy_only=False))
                keep = _member(text, key, owner, flat)
                text, at, place, count, key = (x[keep] for x in (text, at, place, count, key))
                strings = [_words(part, starts, ends, i, n + window - 1) for i, n in zip(at.tolist(), count.tolist())]
                rows = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(place),
                     pa.array(strings, pa.binary())], ["h", "row", "doc", "place", "words"])

    return run


def _member(text: np.ndarray, key: np.ndarray, owner: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which (text, key) pairs are among the (owner, wanted) pairs."""
    known = np.unique(np.concatenate([wanted, key]))
    code = lambda at, k: at * len(known) + np.searchsorted(known, k)
    return np.isin(code(text, key), code(owner, wanted))


def _windows(words: bytes, window: int) -> Iterator[bytes]:
    cuts = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    begin, end = np.r_[0, cuts + 1], np.r_[cuts, len(words)]
    return (words[a:b] for a, b in zip(begin.tolist(), end[window - 1:].tolist()))


def bucket_spans(rows: list[tuple[int, int, int, bytes]], window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """(row, doc, from, to) word spans of one bucket's rows (row, doc, place, words) covered by windows
    that also start in a smaller document."""
    least: dict[bytes, int] = {}
    for _, doc, _, words in rows:
        if doc < least.get(words, doc + 1):
            least[words] = doc
    smallest: dict[bytes, list[int] | None] = {}
    if len(least) == 1:
        smallest = {words: None for words in least}  # every row has the same windows
    else:
        listed = {words: list(_windows(words, window)) for words in least}
        every = sorted((w, least[words]) for words, ws in listed.items() for w in ws)
        best: dict[bytes, int] = {}
        for w, doc in every:  # equal windows stand together, the smallest document first
            best.setdefault(w, doc)
        smallest = {words: [best[w] for w in ws] for words, ws in listed.items()}
    out = []
    for row, doc, place, words in rows:
        first = smallest[words]
        if first is None:
            if least[words] < doc:
                out.append((row, doc, place, place + words.count(b" ") + 1))
            continue
        open_at = None
        for j, other in enumerate(first):
            if other < doc:
                if open_at is None:
                    open_at = j
            elif open_at is not None:
                out.append((row, doc, place + open_at, place + j - 1 + window))
                open_at = None
        if open_at is not None:
            out.append((row, doc, place + open_at, place + len(first) - 1 + window))
    return out


def _bucket_spans(texts: DataFrame, window: int, inner: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        key = None

        def flush(found):
            cols = list(zip(*found)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["row", "doc", "a", "b"])

        found: list[tuple[int, int, int, int]] = []
        for batch in batches:
            for h, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if h != key:
                    if len(held) > 1:
                        found += bucket_spans(held, window)
                    held, key = [], h
                    if len(found) > 20_000:
                        yield flush(found)
                        found = []
                held.append(tuple(row))
        if len(held) > 1:
            found += bucket_spans(held, window)
        yield flush(found)

    packed = texts.mapInArrow(_packing(window, inner), "h long, row long, doc long, place long, words binary")
    sorted_ = packed.repartition("h").sortWithinPartitions("h")
    return sorted_.select("h", "row", "doc", "place", "words").mapInArrow(run, "row long, doc long, a long, b long")


def _large_spans(texts: DataFrame, window: int, inner: int) -> DataFrame:
    """The same spans for minimisers above the bucket limit, by grouped minimum over window digests."""
    packing = _packing(window, inner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in packing(batches):  # in one Python step: a second one would be a second process a task
            rows: list[int] = []
            place: list[int] = []
            digest: list[bytes] = []

            def flush() -> pa.RecordBatch:
                take = pa.array(rows, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [pa.array(digest, pa.binary()), batch.column(1).take(take), batch.column(2).take(take),
                     pa.array(place, pa.int64())], ["digest", "row", "doc", "place"])

            for i, (at, words) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                for j, w in enumerate(_windows(words, window)):
                    rows.append(i)
                    place.append(at + j)
                    digest.append(hashlib.blake2b(w, digest_size=16).digest())
                    if len(rows) >= DIGESTS:
                        yield flush()
                        rows, place, digest = [], [], []
            yield flush()

    digested = texts.mapInArrow(run, "digest binary, row long, doc long, place long")
    # One exchange, read by both sides below; a digest's rows are dealt over SALTS tasks.
    single = digested.withColumn("salt", F.pmod(F.xxhash64("row", "place"), F.lit(SALTS))).repartition("digest", "salt")
    parts = single.groupBy("digest", "salt").agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
    least = parts.groupBy("digest").agg(F.min("a").alias("least"), F.max("b").alias("most"),
                                        F.collect_set("salt").alias("salts")).where("least < most")
    least = least.select("digest", "least", F.explode("salts").alias("salt"))
    hit = single.join(least, ["digest", "salt"]).where("least < doc")
    return hit.select("row", "doc", F.col("place").alias("a"), (F.col("place") + window).alias("b"))


def deduplicated(docs: DataFrame, window: int = WINDOW, inner: int = INNER, bucket: int = BUCKET,
                 verbatim: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the kept words joined by one
    space; null for a null text; ``verbatim``: the text as it is where nothing is removed) and, if ``docs`` has other
    columns, ``_row`` with them."""
    if not 0 < inner <= window:
        raise ValueError("a minimiser is made inside a window")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = [F.struct(*[docs[c] for c in others]).alias("_row")] if others else []
    # Keys that cannot be null: the joins below then put no filter of their own under the exchange of the texts.
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("row"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)).alias("doc"),
                        F.col("text").cast("binary").alias("text"), F.col("doc_id").isNotNull().alias("named"), *rest)
    seen = stored(_minimisers(keyed, window, inner), "substring-minimisers")
    shared = seen.groupBy("h").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count(F.lit(1)).alias("n"),
                                   F.sum("size").alias("size"))
    large = (F.col("n") > bucket) | (F.col("size") > bucket_bytes)
    shared = stored(shared.where("a < b").select("h", large.alias("large")), "substring-shared")
    wanted = seen.select("h", "row", "doc").join(shared, "h").groupBy("row", "doc").agg(
        F.collect_set(F.when(~F.col("large"), F.col("h"))).alias("small"),
        F.collect_set(F.when(F.col("large"), F.col("h"))).alias("big"))
    wanted = stored(wanted, "substring-wanted")
    # All text passes read this one exchange: each takes all of its columns, for only equal exchanges are reused.
    texts = keyed.repartition("row", "doc")
    carried = [c for c in ("_row",) if others]
    asked = texts.join(wanted, ["row", "doc"])
    listed = lambda name: asked.where(F.size(name) > 0).select("row", "doc", "text", name, "named", *carried)
    found = _bucket_spans(listed("small"), window, inner).union(_large_spans(listed("big"), window, inner))
    cover = found.groupBy("row", "doc").agg(F.collect_set(F.struct("a", "b")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_bytes(batch.column(1))
            raw, cuts = data.tobytes(), offsets.tolist()
            total, gone, kept = [], [], []
            for a, b, null, covered in zip(cuts, cuts[1:], batch.column(1).is_null().to_pylist(), batch.column(2).to_pylist()):
                words = raw[a:b].split()
                total.append(len(words))
                if covered:
                    keep = np.ones(len(words), bool)
                    for s in covered:
                        keep[s["a"]:s["b"]] = False
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                gone.append(total[-1] - len(words))
                kept.append(None if null else raw[a:b] if verbatim and not gone[-1] else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), *batch.columns[3:]],
                ["doc_id", "n_words", "n_removed", "kept", *carried])

    joined = texts.join(cover, ["row", "doc"], "left").select(F.when(F.col("named"), F.col("doc")).alias("doc"), "text", "spans", *carried)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
                           *(joined.schema[c] for c in carried)])
    return joined.mapInArrow(run, schema)


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its texts shortened (n_chars follows, where there is one); a row that loses all of its
    words goes, one that had none stays."""
    out = deduplicated(docs, verbatim=True, **options).where("n_removed = 0 OR n_removed < n_words")
    value = {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in docs.columns:
        value["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("_row")["n_chars"])
    return out.select(*[value[c].alias(c) if c in value else F.col("_row")[c].alias(c) for c in docs.columns])


def op8_substrings(spark, sf_dir) -> DataFrame:
    """Every text of ``documents`` without the 50-word passages that a smaller doc_id has too."""
    out = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, p, md5(array_to_string(w[p : p + 49], ' ')) AS g FROM s),
f AS (SELECT g, min(doc_id) AS least FROM h GROUP BY g),
r AS (SELECT doc_id, p FROM h JOIN f USING (g) WHERE least < doc_id),
c AS (SELECT DISTINCT doc_id, p + o.i AS i FROM r, range(50) AS o(i)),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM x ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
