"""Best-fit packing: large-item matching on a length histogram.

Documents become token ids (one pass beside the text), longer ones are cut into
pieces of the capacity.  What the packing needs of the pieces is how many there
are of each length: at most ``capacity`` numbers, whatever the corpus.  On that
histogram the driver makes the plan:

* pieces above a third of the capacity are large: a bin holds two of them at
  most.  From the longest down, each is matched with the longest other large
  piece that fits beside it;
* smaller pieces, from the longest down, go where the gap left is smallest.

A plan is a list of bin kinds with a multiplicity.  Its size depends on the
capacity alone.  Pieces find their place by rank within their length: ranks
are made from (length, slice) counts and a window inside a slice, so a length
that a third of all pieces share is spread over ``SLICES`` groups.  Texts never
move, only (doc_id, piece, length, checksum) rows do.

Cases: a null or empty text is the closing id alone; repeated rows are packed
each; ties in length are ordered by doc_id, start and checksum, and rows equal
in those are interchangeable; an empty table packs into nothing; other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import as_bytes, stored, table

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
END_ID = 0
#: Groups that the pieces of one length are ranked in.
SLICES = 64
#: Entries of a task's word memory; when it is full it starts anew.
MEMORY = 400_000

#: Words that the short way of ``Words`` takes: printable ASCII and composed Latin letters, no special-token mark.
_PLAIN = re.compile("(?!.*<[|])[!-~À-ÖØ-öø-įı-ſ]+")
#: The vocabulary's own splitting rule, for those characters.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Words:
    """Token ids of blank-separated words, remembered as little-endian bytes.

    The vocabulary's splitting rule never joins characters across a blank, so a
    text's ids are its words' ids in a row.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        import tokenizers
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.memory = memory
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        spelled = "".join([self.letters[b] for b in part.encode()])
        ids = np.array([t.id for t in self.tokenizer.model.tokenize(spelled)], "<u4").tobytes()
        if len(self.parts) >= self.memory:
            self.parts.clear()
        self.parts[part] = ids
        return ids

    def _learn(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word):
            found = [self.parts.get(p) or self._part(p) for p in _PARTS.findall(word.lower())]
            ids = found[0] if len(found) == 1 else b"".join(found)
        else:
            ids = self._whole(word)
        if len(self.words) >= self.memory:
            self.words.clear()
        self.words[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            get, learn = self.words.get, self._learn
            found = (get(w) for w in words)
            return b"".join([f if f is not None else learn(w) for f, w in zip(found, words)])


_OPEN: dict[str, Words] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every text's ids and the closing id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary if "/" in vocabulary else vocabulary_path(vocabulary)
        if path not in _OPEN:
            _OPEN[path] = Words(path)  # kept by a reused Python worker
        words = _OPEN[path]
        end = np.array([end_id], "<u4").tobytes()
        step = capacity * 4
        for batch in batches:
            data, offsets = as_bytes(batch.column(1))
            rows, piece, start, length, crc = [], [], [], [], []
            for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                ids = words.ids(data[a:b].tobytes().decode("utf-8")) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Bin kinds as (multiplicity, {length: pieces in a bin}), by large-item matching and best fit.

    Work and result depend on the number of lengths, not of pieces: a step moves as
    many pieces of a length at once as equal gaps can take.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a piece is empty or longer than the capacity")
    large = sorted(n for n in left if 3 * n > capacity)
    gaps: dict[int, list[tuple[int, dict[int, int]]]] = {}

    def add(gap: int, times: int, kind: dict[int, int]) -> None:
        gaps.setdefault(gap, []).append((times, kind))

    # Large pieces: the longest is matched with the longest that fits beside it.
    for n in reversed(large):
        while left[n]:
            k = bisect_left(large, capacity - n + 1) - 1
            while k >= 0 and not (left[large[k]] - (large[k] == n)):
                k -= 1
            if k < 0:
                add(capacity - n, left[n], {n: 1})
                left[n] = 0
                break
            mate = large[k]
            times = left[n] // 2 if mate == n else min(left[n], left[mate])
            left[n] -= times
            left[mate] -= times
            add(capacity - n - mate, times, {n: 2} if mate == n else {n: 1, mate: 1})
    # Smaller pieces: the tightest gap first; a fresh bin when none is left.
    open_gaps = sorted(gaps)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            k = bisect_left(open_gaps, n)
            if k == len(open_gaps):
                fill = capacity // n
                full, rest = divmod(left[n], fill)
                for times, count in ((full, fill), (1, rest)):
                    if times and count:
                        gap = capacity - n * count
                        if gap not in gaps:
                            open_gaps.insert(bisect_left(open_gaps, gap), gap)
                        add(gap, times, {n: count})
                left[n] = 0
                break
            gap = open_gaps[k]
            times, kind = gaps[gap].pop()
            fill = min(gap // n, left[n])
            used = min(times, left[n] // fill)
            if not gaps[gap]:
                del gaps[gap]
                open_gaps.pop(k)
            if used < times:
                if gap not in gaps:
                    open_gaps.insert(bisect_left(open_gaps, gap), gap)
                add(gap, times - used, kind)
            left[n] -= used * fill
            gap -= n * fill
            if gap not in gaps:
                open_gaps.insert(bisect_left(open_gaps, gap), gap)
            add(gap, used, kind | {n: fill})
    return [kind for at in sorted(gaps) for kind in gaps[at] if kind[0]]


def places(kinds: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, bins, first sequence, offset), ordered by length and rank: the pieces of a
    length with ranks from a row's first on go into its bins, round after round."""
    rows, next_rank, sequence = [], {}, 0
    for times, kind in kinds:
        at = 0
        for n in sorted(kind, reverse=True):
            first = next_rank.get(n, 0)
            rows.append((n, first, times, sequence, at))
            next_rank[n] = first + times * kind[n]
            at += n * kind[n]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(found: DataFrame, slices: int = SLICES) -> DataFrame:
    """Adds ``rank``: the place among all pieces of the same length, from 0."""
    slice_of = F.pmod(F.xxhash64("doc_id", "start"), F.lit(slices)).cast("int")
    found = found.withColumn("slice", slice_of)
    counts = found.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "slice").orderBy("doc_id", "start", "ids_crc32"))
    found = found.withColumn("inside", inside - 1)
    return found.join(counts, ["length", "slice"]).withColumn("rank", F.col("before") + F.col("inside")).drop(
        "slice", "before", "inside")


def packed(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """The pieces with sequence_id and offset."""
    found = stored(pieces(docs, capacity, vocabulary, end_id), "pack-pieces")
    # At most ``capacity`` rows, one per length.
    histogram = {r[0]: r[1] for r in found.groupBy("length").agg(F.count(F.lit(1))).collect()}
    table_ = places(plan(histogram, capacity))  # bounded by the capacity, not by the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One sortable number for (length, rank); ranks stay below 2 ** 48.
        starts = (table_[:, 0] << 48) + table_[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(starts, (length << 48) + rank, side="right") - 1
            step = rank - table_[at, 1]
            sequence = table_[at, 3] + step % table_[at, 2]
            offset = table_[at, 4] + step // table_[at, 2] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    columns = ranked(found).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return columns.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                   "sequence_id long, offset long")


def op2_packing(spark, sf_dir) -> DataFrame:
    """All ``documents`` in sequences of at most 2048 tokens."""
    return packed(table(spark, sf_dir, "documents"))
