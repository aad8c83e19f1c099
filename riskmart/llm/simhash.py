"""SimHash near-dedup: exact linking of 64-bit fingerprints within a bit distance.

* Fingerprints are made next to the text (Arrow batches, one pass); texts never move.
* Equal fingerprints collapse first.  Two fingerprints within ``radius`` bits
  agree on at least ``blocks - radius`` of ``blocks`` bit blocks, so grouping by
  every choice of that many blocks finds each pair at least once.  Only groups
  with two members travel on.
* Inside a group the comparison is bit-sliced: 64 members form a lane word, their
  bits are stored as 64 vertical planes, a query's bits are xor-ed in plane by
  plane, and carry-save counters add up 64 distances at once.  Work items whose
  64 counters all passed the radius are abandoned every eight planes.
* Of a group only a spanning forest of its links is emitted, so a large group of
  near copies gives as many links as members, not their square.  A group above
  ``GROUP`` members is dealt into parts by hash, and every pair of parts is a group.

Cases: a null or wordless text has fingerprint zero and is linked like any
other; fewer words than a shingle make one shingle of all words; a null doc_id
keeps its row and does not count for the smallest id; repeated rows share their
fingerprint; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import as_bytes, stored, table
from riskmart.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Bit blocks of the grouping keys: 6 choose 2 = 15 keys of 20 to 22 bits. More blocks: more, longer keys.
BLOCKS = 6
#: Members of a group compared in one go.
GROUP = 8192
#: Rows of whole groups that a task compares at once (more if one group is larger).
ROWS = 1 << 16
#: Work items (a query against 64 members) in one numpy step.
ITEMS = 8192


def text_fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Majority bits over the hashes of all word shingles, repeats included."""
    words = text.lower().split()  # bytes: A-Z only; splits at 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - width + 1].tolist()
    ends = ends[width - 1:].tolist()
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends)]), np.uint8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8 << 13):
        part = hashes[at:at + (8 << 13)].reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(row, doc_id, fp long) of every row; ``row`` is a hash of doc_id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_bytes(batch.column(2))
            raw, cuts = data.tobytes(), offsets.tolist()
            values = [text_fingerprint(raw[a:b], width) for a, b in zip(cuts, cuts[1:])]
            fps = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["row", "doc_id", "fp"])

    texts = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "row long, doc_id long, fp long")


def block_masks(blocks: int, radius: int) -> list[int]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    ranges = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    masks = [sum(c) for c in combinations(ranges, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def close_pairs(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of the same group whose fingerprints differ in at most ``radius`` bits, found by
    bit-sliced comparison and thinned to a spanning forest.  ``group`` is sorted."""
    n = len(fps)
    firsts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[firsts, n])
    first_of = np.repeat(firsts, sizes)
    slot = np.arange(n) - first_of
    words = (sizes + 63) // 64
    word_base = np.r_[0, np.cumsum(words)[:-1]] if len(words) else words
    word_of = np.repeat(word_base, sizes) + slot // 64
    planes = _planes(fps, word_of, slot % 64, int(words.sum()))
    last_word = np.repeat(word_base + words - 1, sizes)
    # Lanes past a group's last member hold nobody, though their bits look like fingerprint zero.
    empty = np.zeros(int(words.sum()), np.uint64)
    ragged = sizes % 64 != 0
    empty[(word_base + words - 1)[ragged]] = ~np.uint64(0) << (sizes[ragged] % 64).astype(np.uint64)
    # Work items: every member against its own lane word and the later ones of its group.
    reach = last_word - word_of + 1
    reach[(slot == np.repeat(sizes, sizes) - 1)] = 0  # the last member has nobody after it
    parent = np.arange(n)
    kept_a, kept_b = [], []
    total = np.cumsum(reach)
    at = 0
    while at < n:
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + ITEMS, side="right")))
        counts = reach[at:upto]
        who = np.repeat(np.arange(at, upto), counts)
        step = np.arange(len(who)) - np.repeat(np.cumsum(counts) - counts, counts)
        word = word_of[who] + step
        rows, near = _within(planes, empty, word, fps[who], radius)
        who, word, step = who[rows], word[rows], step[rows]
        own = step == 0  # in the own lane word only later lanes count
        lanes = (slot[who] % 64).astype(np.uint64)
        near = np.where(own, near & ~((np.uint64(2) << lanes) - np.uint64(1)), near)
        hit = near != 0
        if hit.any():
            who, word, near = who[hit], word[hit], near[hit]
            bits = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(bits)
            a = who[row]
            b = first_of[a] + (word[row] - (word_of[a] - slot[a] // 64)) * 64 + lane
            a, b = _forest(parent, a, b)
            kept_a.append(a)
            kept_b.append(b)
        at = upto
    if not kept_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(kept_a), np.concatenate(kept_b)


def _planes(fps: np.ndarray, word: np.ndarray, lane: np.ndarray, n_words: int) -> np.ndarray:
    """(64 bits, words): bit k of 64 members side by side in one word; empty lanes are zero."""
    full = np.zeros((n_words, 64), np.uint64)
    full[word, lane] = fps
    out = np.empty((64, n_words), np.uint64)
    place = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for k in range(64):
        out[k] = (((full >> np.uint64(k)) & np.uint64(1)) * place).sum(axis=1, dtype=np.uint64)
    return out


def _within(planes: np.ndarray, empty: np.ndarray, word: np.ndarray, queries: np.ndarray,
            radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(alive item rows, lanes within the radius as bits), counting with carry-save adders of enough bits.
    ``empty``: the lanes of each word that are never within."""
    width = max(1, radius.bit_length())
    rows = np.arange(len(word))
    counters = [np.zeros(len(word), np.uint64) for _ in range(width)]
    over = empty[word]  # sticky: the counter ran past its bits, or the lane is empty
    for k in range(64):
        spread = np.uint64(0) - ((queries >> np.uint64(k)) & np.uint64(1))
        carry = planes[k, word] ^ spread
        for i in range(width):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over |= carry
        if k % 8 == 7:
            dead = _passed(counters, over, radius)
            alive = dead != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not alive.all():
                rows, word, queries, over = rows[alive], word[alive], queries[alive], over[alive]
                counters = [c[alive] for c in counters]
                if not len(rows):
                    break
    return rows, ~_passed(counters, over, radius)


def _passed(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius (bitwise comparison with a constant)."""
    above, equal = over.copy(), ~over
    for i in range(len(counters) - 1, -1, -1):
        if radius >> i & 1:
            equal = equal & counters[i]
        else:
            above |= equal & counters[i]
            equal = equal & ~counters[i]
    return above


def _forest(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that join two trees of ``parent`` (updated in place)."""
    out_a, out_b = [], []
    while len(a):
        for _ in range(64):  # flatten
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        if not len(a):
            break
        high, low = np.maximum(ra, rb), np.minimum(ra, rb)
        roots, pick = np.unique(high, return_index=True)  # each high root hooks once, always downwards
        parent[roots] = low[pick]
        out_a.append(a[pick])
        out_b.append(b[pick])
    if not out_a:
        return a[:0], b[:0]
    return np.concatenate(out_a), np.concatenate(out_b)


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """(u, v): links between distinct fingerprints (column ``fp``) that join all that are reachable."""
    if not radius < blocks <= 64:
        raise ValueError("blocks must be above the radius")
    masks = block_masks(blocks, radius)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    keyed = distinct.select("fp", F.explode(keys).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / group).cast("int")
    member = keyed.join(shared, "key").select("fp", "key", parts.alias("parts"))
    own = F.pmod(F.xxhash64(F.col("fp"), F.lit(7)), F.col("parts")).cast("int")
    # A large group: part i travels to every pair of parts that holds it.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    member = member.select("fp", "key", own.alias("own"), other.alias("other"))
    member = member.select("fp", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"))
    member = member.repartition("key").sortWithinPartitions("key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(key, fp):
            a, b = close_pairs(fp.view(np.uint64), key, radius)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], ["u", "v"])

        def joined():
            return tuple(np.concatenate(parts) for parts in zip(*held))

        for batch in batches:
            held.append(tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)))
            if sum(len(key) for key, _ in held) < ROWS:
                continue
            key, fp = joined()
            cut = int(np.searchsorted(key, key[-1]))  # the last group may go on in the next batch
            held = [(key[cut:], fp[cut:])]
            if cut:
                yield out(key[:cut], fp[:cut])
        if held:
            yield out(*joined())

    return member.select("key", "fp").mapInArrow(run, "u long, v long")


def classes(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS,
            group: int = GROUP) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, fp (long), root (smallest fingerprint reachable, as a long)
    and component_id (smallest doc_id reachable)."""
    fps = stored(fingerprints(docs, width), "simhash")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct, radius, blocks, group)).withColumnRenamed("node", "fp")
    joined = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("row", "doc_id", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of every class: that of the smallest doc_id (a null is larger than any),
    by row hash among rows that share it, and by the other columns among rows of one doc_id and text."""
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    chosen = classes(docs, **options).groupBy("root").agg(F.min_by(F.struct("row", "doc_id"), rank).alias("best"))
    # Keys without nulls, so that the join and the choice among equal rows share one exchange of the texts.
    keys = lambda row, id: [row.alias("row"), F.coalesce(id, F.lit(0)).alias("id"), id.isNull().alias("no_id")]
    chosen = stored(chosen.select(*keys(F.col("best.row"), F.col("best.doc_id"))), "simhash-chosen")
    others = [docs[c] for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(
        *keys(F.xxhash64("doc_id", "text"), docs["doc_id"].cast("long")), F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        F.to_json(F.struct(*others)).alias("others") if others else F.lit("").alias("others"))
    rows = rows.join(chosen, ["row", "id", "no_id"], "left_semi")
    first = F.row_number().over(Window.partitionBy("row", "id", "no_id").orderBy("others"))  # of fully equal rows one
    return rows.withColumn("_n", first).where("_n = 1").select("_row.*")


def op1_simhash(spark, sf_dir) -> DataFrame:
    """Near-duplicate classes of all ``documents``: 4-word shingles, at most 4 differing bits."""
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
