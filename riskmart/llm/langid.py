"""Language ID: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its letter byte n-grams (lower-cased A-Z,
everything that is not a letter byte is a border), hashed into ``BUCKETS`` rows
a length.  Embeddings and softmax are trained by stochastic gradient descent in
numpy on a bounded sample of labelled rows; part of the sample is kept back to
fit a temperature and the rejection level: the lowest confidence from which on
the kept-back rows reach ``PRECISION``.  For prediction the embedding and the
softmax matrix are multiplied once, so a text costs one table row per n-gram;
with more languages than dimensions they stay apart, so that rows stay short.

``fit_all`` learns from every labelled row instead, for use inside another operator that
needs the likeliest language only: tasks train side by side on the rows they read, from the
common model, which then moves by their mean change; no row goes to the driver.

The sample is drawn by a seeded hash of doc_id, at most ``PER_LANGUAGE`` rows a
language, of every language there is; each row comes to the driver as n-gram counts (bounded by the number of
buckets), not as text.  Prediction reads whole texts and nothing but the text.

Cases: a null text or one without a letter is ``und`` with score 0 and is rejected;
rows with a null lang, text or doc_id are not learned from; of rows that repeat a doc_id
and lang one text is learned from; without any learnable row everything is ``und``; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import LOWER, as_bytes, row_chunks, table

LENGTHS = (3, 4)
BUCKETS = 1 << 15
DIMENSION = 16
#: Rows of a language in the training sample. With more than LANGUAGES languages each gives fewer, down to FEWEST.
PER_LANGUAGE, LANGUAGES, FEWEST = 400, 256, 100
EPOCHS, BATCH, RATE = 6, 32, 0.5
#: One row in so many of the sample is kept back for calibration.
KEPT_BACK = 5
PRECISION = 0.99
#: Rows that ``fit_all`` gives a task at least, and rows of all its passes together (two passes at least, EPOCHS at most).
TASK_ROWS, PASS_ROWS = 16384, 9600
SEED = 17
#: Bytes of text in one numpy step.
STEP_BYTES = 1 << 19
#: N-grams of a text whose table rows are added up in one.
STEP_GRAMS = 1 << 15

_BORDER = np.full(256, 32, np.uint8)
for _b in (*range(97, 123), *range(128, 256)):
    _BORDER[_b] = _b
_FOLD = _BORDER[LOWER]
_LETTERS = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTERS.finditer(text))


def grams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length: (bucket of every n-gram that holds a letter byte, first n-gram of each text + total); a text is closed by a border."""
    n = len(offsets) - 1
    borders = offsets + np.arange(n + 1)  # one before the first text and one after every text
    folded = np.full(len(data) + n + 1, 32, np.uint8)
    between = np.ones(len(folded), bool)
    between[borders] = False
    folded[between] = _FOLD[data]
    letter = folded != 32
    out = []
    for k, width in enumerate(LENGTHS):
        m = max(0, len(folded) - width + 1)
        code = np.zeros(m, np.uint32)
        for j in range(width):
            code = (code << np.uint32(8)) | folded[j:j + m]
        # A word's pieces only: no border inside, and so both ends in one text.
        keep = letter[1:1 + m].copy()
        for j in range(2, width - 1):
            keep &= letter[j:j + m]
        at = np.flatnonzero(keep)
        bucket = ((code[at] * np.uint32(0x9E3779B1)) >> np.uint32(17)) + np.uint32(k * BUCKETS)
        out.append((bucket, np.searchsorted(at, borders)))
    return out


def ngrams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length: (bucket, text) of every n-gram that ``grams`` finds."""
    return [(bucket.astype(np.int64), np.repeat(np.arange(len(offsets) - 1), np.diff(first))) for bucket, first in grams(data, offsets)]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # one row a bucket: its share of the logits, or with a weight its embedding
    bias: np.ndarray
    temperature: float
    level: float
    weight: np.ndarray | None = None

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        total, count = np.zeros((n, self.table.shape[1])), np.zeros(n)
        table, ones = self.table.astype(np.float64), np.ones(STEP_GRAMS)
        for a, b in row_chunks(offsets, STEP_BYTES):
            part = data[offsets[a]:offsets[b]]
            for bucket, first in grams(part, offsets[a:b + 1] - offsets[a]):
                for i, lo, hi in zip(range(a, b), first.tolist(), first[1:].tolist()):
                    for at in range(lo, hi, STEP_GRAMS):
                        some = np.take(table, bucket[at:min(at + STEP_GRAMS, hi)], axis=0)
                        total[i] += ones[:len(some)] @ some
                count[a:b] += np.diff(first)
        mean = total / np.maximum(count, 1)[:, None]
        return (mean if self.weight is None else mean @ self.weight) + self.bias

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return softmax(self.logits(data, offsets) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _step(embedding, weight, bias, buckets: list, share: list, target: np.ndarray, importance: np.ndarray, rate: float) -> None:
    """One mini-batch; a text is its buckets and their shares."""
    met = np.zeros(len(embedding), bool)
    for b in buckets:
        met[b] = True
    met = np.flatnonzero(met)
    place = np.empty(len(embedding), np.int64)
    place[met] = np.arange(len(met))
    shares = np.zeros((len(buckets), len(met)))
    for row, b, s in zip(shares, buckets, share):
        row[place[b]] = s
    own = embedding[met]  # the rows that the batch met, read and written once
    x = shares @ own
    error = softmax(x @ weight + bias)
    error[np.arange(len(x)), target] -= 1
    error *= importance[:, None]
    back_x = error @ weight.T
    weight -= rate * x.T @ error / len(x) * 8
    bias -= rate * error.mean(axis=0)
    # A mean over very many n-grams moves each a little; the step is scaled back up by their number.
    shares *= 200
    np.minimum(shares, 1, out=shares)
    own -= rate * (shares.T @ back_x)
    embedding[met] = own


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], languages: list[str], seed: int = SEED) -> Model:
    """rows: (language, buckets, their counts). Stochastic gradient descent, then calibration."""
    rng = np.random.default_rng(seed)
    index = {x: i for i, x in enumerate(languages)}
    target = np.array([index[x] for x, _, _ in rows])
    share = [c / max(c.sum(), 1) for _, _, c in rows]
    size = BUCKETS * len(LENGTHS)
    embedding = rng.normal(0, 0.1, (size, DIMENSION))
    weight, bias = rng.normal(0, 0.3, (DIMENSION, len(languages))), np.zeros(len(languages))
    back = rng.permutation(len(rows))[:len(rows) // KEPT_BACK]
    learn = np.setdiff1d(np.arange(len(rows)), back)
    # Every language weighs the same, however many rows it has.
    count = np.bincount(target[learn], minlength=len(languages))
    importance = (len(learn) / np.maximum(count, 1) / max(1, (count > 0).sum()))[target]
    steps = EPOCHS * max(1, -(-len(learn) // BATCH))
    done = 0
    for _ in range(EPOCHS):
        order = rng.permutation(learn)
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            _step(embedding, weight, bias, [rows[i][1] for i in batch], [share[i] for i in batch], target[batch], importance[batch], rate)
    apart = len(languages) > DIMENSION
    folded = embedding if apart else embedding @ weight
    mean = lambda i: share[i] @ folded[rows[i][1]]
    logits = lambda i: (mean(i) @ weight if apart else mean(i)) + bias
    temperature, level = 1.0, 0.0
    if len(back):
        z, y = np.array([logits(i) for i in back]), target[back]
        loss = lambda t: -np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()
        temperature = min(np.geomspace(0.05, 5, 60), key=loss)
        p = softmax(z / temperature)
        sure, right = p.max(axis=1), p.argmax(axis=1) == y
        down = np.argsort(-sure)
        good = np.flatnonzero(np.cumsum(right[down]) / np.arange(1, len(down) + 1) >= PRECISION)
        level = float(sure[down[good[-1]]]) if len(good) else 1.0
    return Model(languages, folded.astype(np.float32), bias, float(temperature), level, weight if apart else None)


def _counts(texts: DataFrame) -> DataFrame:
    """(lang, buckets, counts) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_bytes(batch.column(1))
            found = []
            for a, b in zip(offsets[:-1], offsets[1:]):
                parts = ngrams(data[a:b], np.array([0, b - a]))
                found.append(np.unique(np.concatenate([p[0] for p in parts]), return_counts=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                 pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32()))], ["lang", "buckets", "counts"])

    return texts.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "lang string, buckets array<int>, counts array<int>")


def hashed_sample(rows: DataFrame, label: str, counts: dict, most: int, seed: int, once: bool = False) -> DataFrame:
    """At most ``most`` rows of each label, the same in every run: those of the smallest hash of doc_id.
    A share by hash, four times too large, comes first, so that few rows meet to be ranked.
    ``once``: equal rows count as one (``counts`` too)."""
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4.0 * most / n))]), F.col(label))
    place = F.xxhash64("doc_id", F.lit(seed))
    near = rows.where(F.pmod(place, F.lit(1 << 20)) / float(1 << 20) < share)
    near = near.distinct() if once else near
    rank = F.row_number().over(Window.partitionBy(label).orderBy(F.pmod(place, F.lit(1 << 20)), place, "doc_id"))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")


def arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of an Arrow column as numpy arrays, without Python numbers."""
    found = []
    for chunk in column.chunks:
        values = chunk.flatten().to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.cumsum(chunk.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        found += [values[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    return found


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES, seed: int = SEED) -> Model:
    """Learn every non-null lang of ``docs`` from at most per_language rows; beyond ``languages`` of them, from fewer rows each."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    # Of doc_ids, not of rows: a much repeated one must not take the place of others.
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()}
    known = sorted(counts)
    if not known:
        return Model([], np.zeros((BUCKETS * len(LENGTHS), 0), np.float32), np.zeros(0), 1.0, 1.0)
    per_language = min(per_language, max(FEWEST, per_language * languages // len(known)))
    chosen = hashed_sample(labelled.select("doc_id", "lang"), "lang", counts, per_language, seed, once=True)
    # At most per_language rows a language: small enough to go to every task, so that the texts stay where they are.
    texts = labelled.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
    texts = texts.groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    # Ordered, so that a rerun trains on the same rows in the same order.
    rows = _counts(texts.select("lang", "text")).orderBy("lang", F.xxhash64("buckets", "counts")).toArrow()
    found = [(lang, b.astype(np.int64), c.astype(np.float64)) for lang, b, c in
             zip(rows["lang"].to_pylist(), arrays(rows["buckets"]), arrays(rows["counts"]))]
    return train(found, known, seed)


def _shares(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, their shares) of every text."""
    for a, b in row_chunks(offsets, STEP_BYTES):
        parts = grams(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        for i in range(b - a):
            found = np.concatenate([bucket[first[i]:first[i + 1]] for bucket, first in parts])
            found.sort()
            edges = np.flatnonzero(np.diff(found, prepend=~np.uint32(0)))
            yield found[edges].astype(np.int64), np.diff(edges, append=len(found)) / max(1, len(found))


def _pass_over(labelled: DataFrame, model: tuple, number: dict, importance: np.ndarray, rates: tuple, seed: list) -> tuple:
    """The model after the tasks' passes over their rows, each from ``model``: the mean change of the tasks that touched a row of it."""
    shared = labelled.sparkSession.sparkContext.broadcast(tuple(x.astype(np.float32) for x in model))  # bounded by the buckets
    names, unit = [f"c{i}" for i in range(DIMENSION)], 2.0 ** -32

    def flat(embedding: np.ndarray, weight: np.ndarray, bias: np.ndarray) -> np.ndarray:
        rest = np.r_[weight.ravel(), bias]
        return np.concatenate([embedding, np.pad(rest, (0, -len(rest) % DIMENSION)).reshape(-1, DIMENSION)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = [x.astype(np.float64) for x in shared.value]
        now, rng, done = [x.copy() for x in before], np.random.default_rng(seed), 0
        for batch in batches:
            target = np.array([number[x] for x in batch.column(0).to_pylist()])
            texts = list(_shares(*as_bytes(batch.column(1))))
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                some = order[at:at + BATCH]
                # The rate falls over the task's rows, about TASK_ROWS.
                rate = rates[0] + (rates[1] - rates[0]) * min(1, done / TASK_ROWS)
                _step(*now, [texts[i][0] for i in some], [texts[i][1] for i in some], target[some], importance[target[some]], rate)
                done += len(some)
        change = np.rint((flat(*now) - flat(*before)) / unit).astype(np.int64)
        at = np.flatnonzero(change.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(np.ascontiguousarray(x)) for x in change[at].T)], ["row", *names])

    moved = labelled.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, ", ".join(f"{x} long" for x in ["row", *names])).groupBy("row").agg(
        *[(F.sum(x) / F.count(F.lit(1)) * unit).cast("float").alias(x) for x in names]).toArrow()
    shared.destroy()
    out = flat(*model)
    out[moved["row"].to_numpy()] += np.column_stack([moved[x].to_numpy() for x in names])
    embedding, weight, bias = model
    rest = out[len(embedding):].ravel()
    return out[:len(embedding)], rest[:weight.size].reshape(weight.shape), rest[weight.size:weight.size + len(bias)]


def fit_all(docs: DataFrame, seed: int = SEED) -> Model:
    """Learn every non-null lang of ``docs`` from all its rows; without temperature and rejection level."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    counts = dict(labelled.groupBy("lang").count().collect())
    known, total = sorted(counts), sum(counts.values())
    if not known:
        return Model([], np.zeros((BUCKETS * len(LENGTHS), 0), np.float32), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    model = (rng.normal(0, 0.1, (BUCKETS * len(LENGTHS), DIMENSION)), rng.normal(0, 0.3, (DIMENSION, len(known))), np.zeros(len(known)))
    # Every language weighs the same, however many rows it has.
    importance = np.array([total / counts[x] / len(known) for x in known])
    dealt = labelled.coalesce(-(-total // TASK_ROWS))  # partitions joined as they lie: no text is shuffled
    passes = max(2, min(EPOCHS, -(-PASS_ROWS // total)))
    for k in range(passes):
        rates = tuple(RATE * (1 - x / passes) for x in (k, k + 1))
        model = _pass_over(dealt, model, {x: i for i, x in enumerate(known)}, importance, rates, [seed, k])
    embedding, weight, bias = model
    apart = len(known) > DIMENSION
    return Model(known, (embedding if apart else embedding @ weight).astype(np.float32), bias, 1.0, 0.0, weight if apart else None)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, accepted (the score reaches the calibrated level) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by buckets * dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, offsets = as_bytes(batch.column(1))
            n = len(offsets) - 1
            if not model.languages:
                names, score = ["und"] * n, np.zeros(n)
            else:
                p = model.probabilities(data, offsets)
                raw = data.tobytes()
                letters = np.array([has_letter(raw[a:b].decode("utf-8", "replace"))
                                    for a, b in zip(offsets.tolist(), offsets.tolist()[1:])], bool)
                names = [model.languages[i] if ok else "und" for i, ok in zip(p.argmax(axis=1), letters)]
                score = np.where(letters, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score),
                 pa.array((score >= model.level) & (score > 0))], ["doc_id", "lang_pred", "score", "accepted"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")


def held_out(every: int, is_out: int) -> Column:
    """crc32 of doc_id as text leaves the given remainder; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == is_out, F.lit(False))


def op4_langid(spark, sf_dir) -> DataFrame:
    """Language of all ``documents``, learned from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    out = predicted(docs, fit(docs.where(~held_out(4, 2))))
    return out.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "accepted")
