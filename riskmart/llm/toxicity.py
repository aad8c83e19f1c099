"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word (run of letters, digits and non-ASCII bytes, A-Z lower-cased) has three
hashed embeddings side by side: two by independent hashes of the word, so that
both must be shared to mistake one word for another, and one by its first bytes, for
endings that training has not met.  Filters of several widths run over the words, their largest
response in the whole text is kept (max pooling), and a linear layer gives the
logit.  Every labelled row is learned from: three of four train, the fourth calibrates.

Training is stochastic gradient descent in numpy (Adagrad steps); some words with swapped
hashes are mixed in, so that a match of one hash does not count.  The rows are dealt into
shards by hash, as many as their bytes ask for.  The log odds that words start from are
counts over all shards; an epoch then trains every shard, in its own task, from the
common network, and a number of the network moves by the mean of what the shards that
touched it moved it (sums of whole numbers, so that their order does not matter).  The
driver holds the network alone, bounded by the hash tables.

Calibration uses the rows kept back from training, all of them, weighted to the label shares of the whole
table: for each language, as predicted from the text (by a model of all rows with a language), the threshold with the best F1 is found
by running counts over the sorted logits, and the logit shifted, so that a score of 0.5 is that language's threshold.  A
language with few kept-back toxic rows uses the threshold of all.

Cases: a null, empty or wordless text is scored like any other (no filter
responds but its bias); rows with a null label, doc_id or text are not learned
from; a doc_id with several labels or texts is learned from as each, equal rows
once; repeated rows are scored each; without labels of both kinds every score is the share of toxic
labels (0 without any); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm import langid
from riskmart.llm.common import LOWER, as_bytes, byte_set, row_chunks, span_hashes, spans, stored, table
from riskmart.llm.langid import held_out
from riskmart.session import new_work_dir

BITS = 18
TABLES = 3
PART = 8  # numbers of one hashed embedding; a word has TABLES of them
PREFIX = 4  # bytes
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Bytes of text of a training shard, about; one file, one row group and one task's work.
SHARD_BYTES = 12 << 20
#: Rows and words of a shard that are shuffled together (a longer text is a block of its own).
BLOCK_ROWS, BLOCK_WORDS = 512, 1 << 19
#: One row in so many is kept back from training, for calibration.
KEPT_BACK = 4
EPOCHS, BATCH, RATE = 6, 32, 0.1
#: Words with swapped hashes, as a share of a text.
SWAPPED = 0.25
#: Kept-back toxic rows that a language needs for a threshold of its own.
ENOUGH = 15
SEED = 23
#: Words of a mini-batch, about (one text at least).
BATCH_WORDS = 1 << 16
STEP_BYTES = 1 << 19
#: Words whose filter responses are held at once; few, so that they stay in the processor's cache.
STEP_WORDS = 1 << 13

#: All bytes that are no letter, digit or part of a non-ASCII character.
_BETWEEN = ~byte_set((48, 57), (65, 90), (97, 122), (128, 255))


def word_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """((words, TABLES) table rows, first word of each text + total). Row 0 is the empty word after a text."""
    starts, ends, first = spans(data, offsets, _BETWEEN)
    # Words and their fronts in one call, for one pass over the bytes.
    whole, front = span_hashes(LOWER[data], np.r_[starts, starts], np.r_[ends, np.minimum(ends, starts + PREFIX)]).reshape(2, -1)
    rows = np.empty((len(starts), TABLES), np.int32)
    for k, found in enumerate((whole, whole >> np.uint64(32), front)):
        rows[:, k] = found & np.uint64((1 << BITS) - 1) | np.uint64(1)
    return rows, first


@dataclass
class Network:
    tables: list[np.ndarray]
    taps: dict[int, np.ndarray]  # width -> (width, TABLES * PART, FILTERS)
    bias: np.ndarray  # (len(WIDTHS) * FILTERS)
    out: np.ndarray
    shift: float

    def embedded(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([np.take(t, rows[..., k], axis=0) for k, t in enumerate(self.tables)], axis=-1)

    def flat_taps(self) -> np.ndarray:
        """All taps as one matrix, a row each, so that one product serves every width."""
        return np.ascontiguousarray(np.concatenate([tap for w in WIDTHS for tap in self.taps[w]], axis=1).T)

    def responses(self, rows: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """(filters, positions): responses before the bias; the last max(WIDTHS) - 1 words only look ahead."""
        y = flat @ self.embedded(rows).T
        n = len(rows) - WIDTHS[-1] + 1
        found, at = np.empty((len(self.bias), n), np.float32), 0
        for k, width in enumerate(WIDTHS):
            own = found[k * FILTERS:(k + 1) * FILTERS]
            own[:] = y[at:at + FILTERS, :n]
            for j in range(1, width):
                own += y[at + j * FILTERS:at + (j + 1) * FILTERS, j:j + n]
            at += width * FILTERS
        return found

    def steps(self, rows: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first position, responses, texts, start and end of each) in steps of bounded size, of padded texts."""
        pad, flat = WIDTHS[-1] - 1, self.flat_taps()
        for at in range(0, len(rows) - pad, STEP_WORDS):
            y = self.responses(rows[at:at + STEP_WORDS + pad], flat)
            text = np.arange(np.searchsorted(begin, at, side="right") - 1, np.searchsorted(begin[:-1], at + y.shape[1]))
            # Positions that start in the text (one for an empty text).
            lo, hi = np.maximum(begin[text] - at, 0), np.minimum(begin[text + 1] - pad - at, y.shape[1])
            inside = lo < hi
            if inside.any():
                yield at, y, text[inside], lo[inside], hi[inside]

    def pooled(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(texts, filters): largest response of each text, in steps of bounded size."""
        rows, begin = padded(rows, first)
        best = np.full((len(first) - 1, len(self.bias)), -np.inf, np.float32)
        for _, y, text, lo, hi in self.steps(rows, begin):
            edges = np.column_stack([lo, hi]).ravel()  # every second stretch is between texts
            found = np.maximum.reduceat(y, edges[:-1] if hi[-1] == y.shape[1] else edges, axis=1)[:, ::2]
            best[text] = np.maximum(best[text], found.T)
        return best + self.bias

    def tops(self, rows: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of padded texts: (texts, filters) place of the largest response and the response, in steps of bounded size."""
        filters = np.arange(len(self.bias))
        top = np.zeros((len(begin) - 1, len(filters)), np.int64)
        best = np.full(top.shape, -np.inf, np.float32)
        for at, y, texts, starts, ends in self.steps(rows, begin):
            for i, lo, hi in zip(texts.tolist(), starts.tolist(), ends.tolist()):
                k = lo + y[:, lo:hi].argmax(axis=1)
                found = y[filters, k]
                top[i] = np.where(found > best[i], at + k, top[i])
                best[i] = np.maximum(found, best[i])
        return top, best + self.bias

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.out + self.shift

    def __getstate__(self):
        """Without the table rows that are zero, as those of words not met in training are."""
        kept = [np.flatnonzero(t.any(axis=1)) for t in self.tables]
        return self.__dict__ | {"tables": [(at, t[at]) for at, t in zip(kept, self.tables)]}

    def __setstate__(self, state):
        tables = [np.zeros((1 << BITS, PART), np.float32) for _ in state["tables"]]
        for t, (at, rows) in zip(tables, state["tables"]):
            t[at] = rows
        self.__dict__.update(state | {"tables": tables})


def padded(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with empty words between them: at least one position each, and room for the widest filter."""
    sizes = np.diff(first)
    begin = np.r_[0, np.cumsum(np.maximum(sizes, 1) + WIDTHS[-1] - 1)]
    out = np.zeros((begin[-1], TABLES), np.int32)
    out[np.arange(len(rows)) - np.repeat(first[:-1], sizes) + np.repeat(begin[:-1], sizes)] = rows
    return out, begin


#: Where the squares of the Adagrad steps start.
SEEN = np.float32(1e-3)


@dataclass
class Training:
    """A network, the words met in two texts at least, and the squares of the Adagrad steps so far."""
    network: Network
    known: list[np.ndarray]  # rows of each table, ascending
    seen: list[np.ndarray]  # of the known rows
    seen_taps: dict[int, np.ndarray]
    seen_rest: np.ndarray  # of bias, out and shift

    def parts(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(values, squares) of the known table rows, and of everything else in rows of PART numbers."""
        net = self.network
        rest = [np.concatenate([*(t[w].ravel() for w in WIDTHS), r]) for t, r in (
            (net.taps, np.r_[net.bias, net.out, np.float32(net.shift)]), (self.seen_taps, self.seen_rest))]
        rest = [np.pad(x, (0, -len(x) % PART)).reshape(-1, PART) for x in rest]
        return [(t[at], seen) for t, at, seen in zip(net.tables, self.known, self.seen)] + [tuple(rest)]

    def put(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        net = self.network
        for k, (value, seen) in enumerate(parts[:TABLES]):
            net.tables[k][self.known[k]], self.seen[k] = value, seen
        for taps, rest in ((net.taps, parts[-1][0].ravel()), (self.seen_taps, parts[-1][1].ravel())):
            for w in WIDTHS:
                taps[w], rest = rest[:taps[w].size].reshape(taps[w].shape).copy(), rest[taps[w].size:]
            if taps is net.taps:
                n = len(net.bias)
                net.bias, net.out, net.shift = rest[:n].copy(), rest[n:2 * n].copy(), float(rest[2 * n])
            else:
                self.seen_rest = rest[:2 * len(net.bias) + 1].copy()

    def learn(self, texts: list[np.ndarray], label: np.ndarray, weight: np.ndarray, rate: float, rng) -> None:
        """One pass over a block of texts, in mini-batches; weight: of each label."""
        net, count = self.network, len(self.network.bias)
        pool = np.concatenate(texts)  # where swapped hashes are drawn from
        pad = WIDTHS[-1] - 1
        shift = np.array([net.shift], np.float32)
        seen_bias, seen_out, seen_shift = np.split(self.seen_rest, [count, 2 * count])  # views
        order = rng.permutation(len(texts))
        for batch in _batches(order, np.array([len(t) for t in texts])):
            parts = []
            for i in batch:
                extra = int(len(texts[i]) * SWAPPED)
                mixed = [pool[rng.integers(0, len(pool), extra), k] for k in range(TABLES)]
                parts.append(np.concatenate([texts[i], np.stack(mixed, axis=1)]))
            rows, begin = padded(np.concatenate(parts), np.cumsum([0, *map(len, parts)]))
            top, best = net.tops(rows, begin)
            act = np.maximum(best, 0)
            z = act @ net.out + shift[0]
            dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[batch]) * weight[label[batch]] / len(batch)
            d_act = np.where(best > 0, dz[:, None] * net.out, 0).astype(np.float32)
            met_rows, met_grads = [], []
            for k, width in enumerate(WIDTHS):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                g, grads = d_act[:, own], np.zeros_like(net.taps[width])
                for j in range(width):
                    at_top = rows[top[:, own] + j]
                    grads[j] = np.einsum("bf,bfd->df", g, net.embedded(at_top))
                    met_rows.append(at_top.reshape(-1, TABLES))
                    met_grads.append((g[:, :, None] * net.taps[width][j].T[None]).reshape(-1, TABLES * PART))
                _adagrad(net.taps[width], self.seen_taps[width], grads, rate)
            met_rows, met_grads = np.concatenate(met_rows), np.concatenate(met_grads)
            for k in range(TABLES):
                self._step_rows(k, met_rows[:, k], met_grads[:, k * PART:(k + 1) * PART], rate)
            _adagrad(net.bias, seen_bias, d_act.sum(axis=0), rate)
            _adagrad(net.out, seen_out, (dz[:, None] * act).sum(axis=0).astype(np.float32), rate)
            _adagrad(shift, seen_shift, np.array([dz.sum()], np.float32), rate)
            net.shift = float(shift[0])

    def _step_rows(self, k: int, rows: np.ndarray, grad: np.ndarray, rate: float) -> None:
        unique, where = np.unique(rows, return_inverse=True)
        total = np.zeros((len(unique), PART), np.float32)
        np.add.at(total, where, grad)
        at = np.searchsorted(self.known[k], unique)
        met = np.append(self.known[k], -1)[at] == unique  # the others, and the empty word, stay zero
        unique, total, at = unique[met], total[met], at[met]
        self.seen[k][at] += total * total
        self.network.tables[k][unique] -= rate * total / np.sqrt(self.seen[k][at])


def _adagrad(value: np.ndarray, seen: np.ndarray, grad: np.ndarray, rate: float) -> None:
    seen += grad * grad
    value -= rate * grad / np.sqrt(seen)


def _batches(order: np.ndarray, words: np.ndarray) -> Iterator[np.ndarray]:
    """At most BATCH texts and about BATCH_WORDS words (one text at least)."""
    at = 0
    while at < len(order):
        total = np.cumsum(words[order[at:at + BATCH]])
        upto = at + max(1, int(np.searchsorted(total, BATCH_WORDS, side="right")))
        yield order[at:upto]
        at = upto


def _count(seen: np.ndarray, texts: list[np.ndarray], label: np.ndarray) -> None:
    """Adds the texts that hold each table row to ``seen`` (label, table, row)."""
    for rows, y in zip(texts, label):
        for k, found in enumerate(np.sort(rows.T, axis=1)):
            seen[y, k, found[np.diff(found, prepend=-1) > 0]] += 1


def started(seen: np.ndarray, n: np.ndarray, seed: int = SEED) -> Training:
    """seen: texts of each label that hold each table row; n: texts of each label.
    The first number of a table row starts from its log odds."""
    rng = np.random.default_rng(seed)
    tables, known = [], []
    for k in range(TABLES):
        odds = np.clip(np.log((seen[1, k] + 0.5) / (n[1] + 1)) - np.log((seen[0, k] + 0.5) / (n[0] + 1)), -3, 3)
        met = seen[:, k].sum(axis=0) >= 2
        rows = rng.normal(0, 0.05, (1 << BITS, PART)).astype(np.float32)
        rows[:, 0] = odds / 3
        rows[~met] = 0  # words not met in training say nothing
        rows[0] = 0
        tables.append(rows)
        known.append(np.flatnonzero(met))
    taps = {w: rng.normal(0, 0.1, (w, TABLES * PART, FILTERS)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        taps[w][0, ::PART] += 0.5
    count = len(WIDTHS) * FILTERS
    net = Network(tables, taps, np.full(count, -0.3, np.float32), np.full(count, 0.3, np.float32), -1.0)
    return Training(net, known, [np.full((len(at), PART), SEEN) for at in known],
                    {w: np.full_like(t, SEEN) for w, t in taps.items()}, np.full(2 * count + 1, SEEN))


def label_weights(n: np.ndarray) -> np.ndarray:
    """Both labels weigh the same, however many rows they have."""
    return n.sum() / (2 * np.maximum(n, 1))


def rate_of(epoch: int) -> float:
    return RATE * (1 - epoch / EPOCHS)


def train(texts: list[np.ndarray], label: np.ndarray, seed: int = SEED) -> Network:
    """The training of a single shard of one block, in this process. texts: table rows of each text's words."""
    seen, n = np.zeros((2, TABLES, 1 << BITS)), np.bincount(label, minlength=2)
    _count(seen, texts, label)
    state = started(seen, n, seed)
    for epoch in range(EPOCHS):
        state.learn(texts, label, label_weights(n), rate_of(epoch), np.random.default_rng([seed, epoch]))
    return state.network


@dataclass
class Classifier:
    network: Network | None
    languages: langid.Model
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.0
    share: float = 0.0  # of toxic labels; the score when nothing could be learned

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logit, number of the language as predicted: -1 without any) of every text."""
        n = len(offsets) - 1
        out = np.empty(n)
        for a, b in row_chunks(offsets, STEP_BYTES):
            part, cuts = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            out[a:b] = self.network.logits(self.network.pooled(*word_rows(part, cuts)))
        if not self.languages.languages:
            return out, np.full(n, -1)
        return out, self.languages.logits(data, offsets).argmax(axis=1)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(offsets) - 1, self.share)
        out, language = self.logits(data, offsets)
        # The last one is for no language.
        out -= np.array([*(self.thresholds.get(x, self.threshold) for x in self.languages.languages), self.threshold])[language]
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def best_threshold(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the gap below which F1 is best (label shares by weight); what ``best_thresholds`` finds, in one process."""
    order = np.argsort(-z)
    z, y, weight = z[order], y[order], weight[order]
    hit = np.cumsum(weight * y)
    f1 = 2 * hit / (np.cumsum(weight) + (weight * y).sum())
    # A threshold stands between different logits.
    last = np.r_[z[1:] != z[:-1], True]
    k = int(np.argmax(np.where(last, f1, -1)))
    return float((z[k] + z[k + 1]) / 2 if k + 1 < len(z) else z[k] - 1)


def best_thresholds(rows: DataFrame, weight: tuple[float, float]) -> dict[int, float]:
    """The best threshold of every group of rows (group, z, toxic); weight: of each label.
    Running counts over all logits: those of a range of the sorted ones, and the totals of the ranges before it."""
    counted = rows.groupBy("group", "z").agg(F.count_if(F.col("toxic") == 0).alias("n0"), F.count_if(F.col("toxic") == 1).alias("n1"))
    placed = stored(counted.repartitionByRange(F.col("group"), F.col("z").desc()).withColumn("range", F.spark_partition_id()),
                    "toxicity-logits")
    totals = placed.groupBy("group", "range").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    ranges = Window.partitionBy("group").orderBy("range")
    before = totals.select("group", "range", *[(F.sum(n).over(ranges) - F.col(n)).alias("before_" + n) for n in ("n0", "n1")],
                           F.sum("n1").over(Window.partitionBy("group")).alias("toxic"))
    inside = Window.partitionBy("group", "range").orderBy(F.col("z").desc()).rowsBetween(Window.unboundedPreceding, 0)
    n0, n1 = [F.col("before_" + n) + F.sum(n).over(inside) for n in ("n0", "n1")]
    f1 = 2 * weight[1] * F.col("n1") / (weight[0] * F.col("n0") + weight[1] * F.col("n1") + weight[1] * F.col("toxic"))
    sums = placed.join(F.broadcast(before), ["group", "range"]).select("group", "z", n0.alias("n0"), n1.alias("n1"), "toxic")
    best = sums.groupBy("group").agg(F.max_by("z", F.struct(f1.alias("f1"), "z")).alias("best"))
    found = placed.join(F.broadcast(best), "group").groupBy("group", "best").agg(F.max(F.when(F.col("z") < F.col("best"), F.col("z"))))
    return {group: best - 1 if below is None else (best + below) / 2 for group, best, below in found.collect()}


def labelled_texts(docs: DataFrame, marked: DataFrame, seed: int) -> DataFrame:
    """(doc_id, toxic, place, text) of every labelled row, equal ones once; place: a hash that deals them."""
    # Labels grow with the texts, so they are not broadcast; the texts are shuffled once, here.
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        marked.distinct().hint("merge"), "doc_id")
    return texts.groupBy("doc_id", "toxic", F.xxhash64("doc_id", "toxic", "text", F.lit(seed)).alias("place")).agg(
        F.min("text").alias("text"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
    """(shard, block, texts, labels): blocks are counted from their shard's start, however the rows come."""
    texts, label, words, now, block = [], [], 0, None, 0
    for batch in batches:
        lists = langid.arrays(pa.chunked_array([batch.column("words")]))
        for shard, y, x in zip(batch.column("shard").to_pylist(), batch.column("toxic").to_pylist(), lists):
            if texts and (shard != now or len(texts) == BLOCK_ROWS or words >= BLOCK_WORDS):
                yield now, block, texts, np.array(label)
                texts, label, words, block = [], [], 0, block + 1
            if shard != now:
                now, block = shard, 0
            texts.append(x.reshape(-1, TABLES))
            label.append(y)
            words += len(texts[-1])
    if texts:
        yield now, block, texts, np.array(label)


def shards(texts: DataFrame, seed: int, shard_bytes: int) -> DataFrame:
    """(toxic, words, shard): the words of every text as table rows, a shard in one file and in a fixed order."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = texts.withColumn("shard", F.pmod(F.xxhash64("place", F.lit(seed)), F.lit(-(-size // shard_bytes) or 1)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, first = word_rows(*as_bytes(batch.column(0)))
            words = pa.ListArray.from_arrays(pa.array((first * TABLES).astype(np.int32)), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([words, *batch.columns[1:]], ["words", *batch.schema.names[1:]])

    rows = dealt.repartition("shard").select(F.col("text").cast("binary").alias("text"), "toxic", "place", "doc_id", "shard")
    rows = rows.mapInArrow(run, "words array<int>, toxic int, place long, doc_id long, shard int")
    rows = rows.sortWithinPartitions("shard", "place", "doc_id", "toxic").select("words", "toxic", "shard")
    path = new_work_dir(texts.sparkSession, "toxicity-shards")
    rows.write.option("parquet.block.size", 1 << 30).partitionBy("shard").parquet(path)
    return texts.sparkSession.read.schema(rows.schema).parquet(path)


def evidence(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(texts of each label that hold each table row, texts of each label), over all shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros((2, TABLES, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for _, _, texts, label in _blocks(batches):
            _count(seen, texts, label)
            n += np.bincount(label, minlength=2)
        where = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[where, -1, -2]), pa.array(np.r_[seen.ravel()[where], n])], ["place", "n"])

    found = rows.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    place, count = found["place"].to_numpy(), found["n"].to_numpy()
    seen, n = np.zeros(2 * TABLES << BITS), np.zeros(2, np.int64)
    n[-1 - place[place < 0]] = count[place < 0]
    seen[place[place >= 0]] = count[place >= 0]
    return seen.reshape(2, TABLES, 1 << BITS), n


#: Changes are added up as whole numbers of this size.
UNIT = 2.0 ** -32


def epoch_over(rows: DataFrame, state: Training, n: np.ndarray, epoch: int, seed: int) -> None:
    """Trains every shard from ``state`` and moves it by the mean change of the shards that touched a row."""
    shared = rows.sparkSession.sparkContext.broadcast(state)  # bounded by the hash tables
    weight, rate, numbers = label_weights(n), rate_of(epoch), [f"c{i}" for i in range(2 * PART)]

    def changes(old: Training, new: Training) -> pa.RecordBatch:
        found = []
        for k, ((v0, s0), (v1, s1)) in enumerate(zip(old.parts(), new.parts())):
            change = np.concatenate([v1.astype(np.float64) - v0, s1.astype(np.float64) - s0], axis=1)
            at = np.flatnonzero((s1 != s0).any(axis=1))
            found.append(np.column_stack([np.full(len(at), k), at, np.rint(change[at] / UNIT).astype(np.int64)]))
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in np.concatenate(found).T], ["part", "row", *numbers])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for shard, block, texts, label in _blocks(batches):
            if shard != now:
                if state:
                    yield changes(shared.value, state)
                now, state = shard, copy.deepcopy(shared.value)
            state.learn(texts, label, weight, rate, np.random.default_rng([seed, epoch, shard, block]))
        if state:
            yield changes(shared.value, state)

    moved = rows.mapInArrow(run, ", ".join(f"{x} long" for x in ("part", "row", *numbers))).groupBy("part", "row").agg(
        *[(F.sum(x) / F.count(F.lit(1)) * UNIT).cast("float").alias(x) for x in numbers]).toArrow()
    shared.destroy()
    part, row = moved["part"].to_numpy(), moved["row"].to_numpy()
    change = np.column_stack([moved[x].to_numpy() for x in numbers])
    parts = []
    for k, (value, seen) in enumerate(state.parts()):
        value, seen, own = value.copy(), seen.copy(), part == k
        value[row[own]] += change[own, :PART]
        seen[row[own]] += change[own, PART:]
        parts.append((value, seen))
    state.put(parts)


def fit(docs: DataFrame, labels: DataFrame, seed: int = SEED, shard_bytes: int = SHARD_BYTES) -> Classifier:
    """Learn ``labels.toxic`` (0 or 1) from every labelled row of ``docs``."""
    marked = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    total = {r[0]: r[1] for r in marked.groupBy("toxic").agg(F.count(F.lit(1))).collect()}
    share = total.get(1, 0) / max(1, sum(total.values()))
    texts = stored(labelled_texts(docs, marked, seed), "toxicity-labelled")
    back: Column = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(KEPT_BACK)) == 0
    languages = langid.fit_all(docs, seed=seed)
    rows = shards(texts.where(~back), seed, shard_bytes)
    seen, n = evidence(rows)
    if not n.all():
        return Classifier(None, languages, share=share)
    state = started(seen, n, seed)
    del seen
    for epoch in range(EPOCHS):
        epoch_over(rows, state, n, epoch, seed)
    model = Classifier(state.network, languages, share=share)
    logits = _logits(texts.where(back), model)
    count = dict(logits.groupBy("toxic").count().collect())
    by_language = count.get(1, 0) > 0
    if not by_language:
        logits = _logits(texts, model)
        count = dict(logits.groupBy("toxic").count().collect())
    # Label shares of the whole table, not of the kept-back rows.
    weight = tuple(total.get(y, 0) / max(1, count.get(y, 0)) for y in (0, 1))
    found = best_thresholds(logits.withColumn("group", F.explode(F.array(F.lit(-1), "language"))) if by_language and languages.languages
                            else logits.withColumn("group", F.lit(-1)), weight)
    enough = {r[0] for r in logits.groupBy("language").agg(F.sum("toxic").alias("n")).where(F.col("n") >= ENOUGH).collect()}
    model.threshold = found.pop(-1)
    model.thresholds = {languages.languages[k]: x for k, x in found.items() if k in enough}
    return model


def _logits(texts: DataFrame, model: Classifier) -> DataFrame:
    """(z, language, toxic) of labelled texts, before any threshold."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, language = shared.value.logits(*as_bytes(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(z), pa.array(language.astype(np.int32)), batch.column(1)], ["z", "language", "toxic"])

    rows = texts.select(F.col("text").cast("binary").alias("text"), "toxic")
    return stored(rows.mapInArrow(run, "z double, language int, toxic int"), "toxicity-kept-back")


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.zeros((0, TABLES), np.int32), *texts]), np.cumsum([0, *map(len, texts)])


def scored(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the hash tables

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_bytes(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(data, offsets))],
                                             ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` without the rows that the classifier rejects (a score of 0.5 or more)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = shared.value.scores(*as_bytes(batch.column(names.index("text")))) < 0.5
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def op9_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity of all ``documents``, learned from four fifths of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = scored(docs, fit(docs.where(~held_out(5, 0)), labels.where(~held_out(5, 0))))
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
