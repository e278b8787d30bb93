"""Toxicity scores: a factorization machine over hashed terms.

Terms of a text are its words and their beginnings of three to five letters, each
hashed to one of 2^BITS buckets. A window of ``2 * STEP`` words has the logit

    bias + sum of w(t) + sum over pairs of terms t, u of <v(t), v(u)>

so that two terms can mean what neither means alone (an insult near the name of a
group). Windows overlap by half; the logit of a text is the logarithm of the mean of
the exponentials of its windows' logits, so one bad passage tells in a text of any
length, and gradients go to the windows that matter.

Training sees a bounded sample of labelled documents. Tasks train on their part
(Adagrad); weights are averaged over tasks by the number of updates, a bucket at a
time, and the next round starts from these. Nothing but buckets reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StructField, StructType,
)

from biomeframe.llm.common import shipped
from biomeframe.session import stored

BITS = 18
FACTORS = 4
#: Words from the start of one window to that of the next; a window has twice as many.
STEP = 32
BEGINNINGS = (3, 4, 5)
#: Expected number of training documents of each label, chosen by a hash of their id.
DOCS_PER_LABEL = 4_000
TASKS = 8
ROUNDS = 4
PASSES = 4
RATE = 0.05
#: Squared gradients each weight is taken to have seen: rare terms move in small steps.
START = 10.0
DECAY = 1e-4
SEED = 42
_BATCH = 16
#: Letters that are handled at once.
_BLOCK = 1 << 17
_ROWS = 256
_NONE = 1 << BITS
_BASE = 0x9E3779B97F4A7C15
_KINDS = 1 + len(BEGINNINGS)


@dataclass
class Model:
    bias: float
    weights: np.ndarray  # (buckets + 1) x (1 + FACTORS); the last row belongs to no term and is zero


@cache
def _letters() -> np.ndarray:
    """Each code point itself if it is a letter or digit, else 0."""
    return np.array([i if chr(i).isalnum() else 0 for i in range(0x110000)], dtype=np.uint64)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and their inverses."""
    size = 2 * _BLOCK + 2
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    up, down = np.full(size, _BASE, dtype=np.uint64), np.full(size, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _pieces(text: str) -> Iterator[np.ndarray]:
    """The code points of a text in pieces of a block.

    A piece ends behind a multiple of STEP words; where a block has fewer words
    than that, behind its last whole word, or else inside a word.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters, at = _letters(), 0
    while at < len(codes):
        piece = letters[codes[at : at + _BLOCK]]
        if at + _BLOCK < len(codes):
            ends = np.flatnonzero((piece[:-1] != 0) & (piece[1:] == 0)) + 1
            whole = len(ends) // STEP * STEP or len(ends)
            if whole:
                piece = piece[: ends[whole - 1] + 1]
        yield piece
        at += len(piece)


def _terms(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the terms of each word (words x kinds), and the words' places.

    A substring's hash is a difference of running sums, divided by the power at its start.
    """
    edge = np.diff((codes != 0).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers()
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(codes * up[: len(codes)], dtype=np.uint64)))
    out = np.empty((len(starts), _KINDS), dtype=np.int32)
    for kind, size in enumerate((None, *BEGINNINGS)):
        stop = ends if size is None else np.minimum(starts + size, ends)
        h = (sums[stop] - sums[starts]) * down[starts]
        h = (h ^ (h >> np.uint64(31)) ^ np.uint64(kind * 0x5851F42D4C957F2D % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
        out[:, kind] = h >> np.uint64(64 - BITS)
        if size is not None:
            out[ends - starts < size, kind] = _NONE
    return out, starts


def _once(terms: np.ndarray, owners: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """The terms, where those that their chunk has already are none."""
    step = np.diff(owners, prepend=owners[:1]) | np.diff(chunks, prepend=chunks[:1])
    key = (np.cumsum(step != 0)[:, None] << (BITS + 1) | terms).ravel()
    order = np.argsort(key, kind="stable")
    again = order[1:][key[order][1:] == key[order][:-1]]
    terms.ravel()[again] = _NONE
    return terms


def _blocks(texts: Iterator[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Terms, owners and chunk numbers of words, some texts at a time.

    A chunk is STEP words of one text, counted from its start. Only words of
    thousands of letters split a chunk between two blocks.
    """
    parts, owners, firsts, size = [], [], [], 0

    def joined():
        codes = np.concatenate([np.append(p, np.uint64(0)) for p in parts])
        found, at = _terms(codes)
        ends = np.cumsum([len(p) + 1 for p in parts])
        part = np.searchsorted(ends, at, side="right")
        counts = np.bincount(part, minlength=len(parts))
        within = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
        owner, chunk = np.array(owners)[part], (within + np.array(firsts)[part]) // STEP
        return _once(found, owner, chunk), owner, chunk

    for k, text in enumerate(texts):
        words = 0
        for piece in _pieces(text or ""):
            parts.append(piece)
            owners.append(k)
            firsts.append(words)
            filled = np.concatenate(([False], piece != 0))
            words += int((filled[1:] & ~filled[:-1]).sum())
            size += len(piece) + 1
            if size >= _BLOCK:
                yield joined()
                parts, owners, firsts, size = [], [], [], 0
    if parts:
        yield joined()


def _chunk_sums(weights: np.ndarray, terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For chunks that start at the given words: sums of w, of v, and of the squares of v, of their terms."""
    mine = weights[terms]  # words x kinds x (1 + FACTORS)
    sums = mine.sum(axis=1)
    squares = np.einsum("nkf,nkf->n", mine[:, :, 1:], mine[:, :, 1:])
    return np.add.reduceat(np.column_stack((sums, squares)).astype(np.float64), starts, axis=0)


def _pooled(bias: float, sums: np.ndarray, owners: np.ndarray, n: int):
    """Logit of each of ``n`` texts from its chunks, and for the gradient: first chunks, sums and shares of windows.

    A window is a chunk and the next one of its text; the last chunk stands for a
    window only where it is the text's only one.
    """
    last = np.concatenate((owners[1:] != owners[:-1], [True]))
    alone = last & np.concatenate(([True], owners[1:] != owners[:-1]))
    first = np.flatnonzero(~last | alone)
    both = sums[first] + np.where(last[first, None], 0.0, sums[np.minimum(first + 1, len(sums) - 1)])
    logits = bias + both[:, 0] + 0.5 * ((both[:, 1:-1] ** 2).sum(axis=1) - both[:, -1])
    text = owners[first]
    heads = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    counts = np.diff(heads, append=len(text))
    top = np.maximum.reduceat(logits, heads)
    shares = np.exp(logits - np.repeat(top, counts))
    total = np.add.reduceat(shares, heads)
    out = np.full(n, bias)
    out[text[heads]] = top + np.log(total / counts)
    return out, first, both, shares / np.repeat(total, counts), text


def logits(model: Model, texts: list[str | None]) -> np.ndarray:
    """The logit of each text; the bias for texts without a word."""
    sums, owners, numbers = [], [], []
    for terms, owner, chunk in _blocks(iter(texts)):
        if not len(owner):
            continue
        starts = np.flatnonzero(np.diff(owner, prepend=-1) | np.diff(chunk, prepend=-1))
        sums.append(_chunk_sums(model.weights, terms, starts))
        owners.append(owner[starts])
        numbers.append(chunk[starts])
    if not sums:
        return np.full(len(texts), model.bias)
    sums, owners, numbers = np.concatenate(sums), np.concatenate(owners), np.concatenate(numbers)
    # A chunk that was split between two blocks becomes one again.
    heads = np.flatnonzero(np.diff(owners, prepend=-1) | np.diff(numbers, prepend=-1))
    return _pooled(model.bias, np.add.reduceat(sums, heads, axis=0), owners[heads], len(texts))[0]


def loss_gradient(bias: float, weights: np.ndarray, terms: np.ndarray, owners: np.ndarray,
                  chunks: np.ndarray, labels: np.ndarray, importance: np.ndarray):
    """Logits of texts with words, and the gradient of their weighted log loss.

    The gradient is that of the bias and, for each bucket in use, of its row.
    """
    starts = np.flatnonzero(np.diff(owners, prepend=-1) | np.diff(chunks, prepend=-1))
    sums = _chunk_sums(weights, terms, starts)
    out, first, both, shares, text = _pooled(bias, sums, owners[starts], len(labels))
    slope = (1 / (1 + np.exp(-np.clip(out, -50, 50))) - labels) * importance
    slope = slope[text] * shares
    pull = np.column_stack((slope, slope[:, None] * both[:, 1:-1]))
    by_chunk = np.zeros((len(starts), 1 + FACTORS))
    by_chunk[first] += pull
    pairs = np.concatenate((owners[starts][1:] == owners[starts][:-1], [False]))
    second = pairs[first]
    by_chunk[first[second] + 1] += pull[second]
    by_word = np.repeat(by_chunk, np.diff(starts, append=len(owners)), axis=0).astype(np.float32)
    flat = terms.ravel()
    order = np.argsort(flat, kind="stable")
    order = order[: np.searchsorted(flat[order], _NONE)]
    used, heads = np.unique(flat[order], return_index=True)
    rows = by_word[order // _KINDS]
    rows[:, 1:] -= weights[flat[order], 1:] * rows[:, :1]
    return out, float(slope.sum()), used, np.add.reduceat(rows, heads, axis=0)


def initial() -> Model:
    rng = np.random.default_rng(SEED)
    weights = rng.normal(scale=0.02, size=(_NONE + 1, 1 + FACTORS)).astype(np.float32)
    weights[:, 0] = 0
    weights[_NONE] = 0
    return Model(0.0, weights)


def fit_part(
    model: Model, texts: list[str], labels: np.ndarray, seed: int, positive: float = 1.0
) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and number of updates of each bucket after PASSES over the texts.

    positive: how much a text of label 1 counts, against 1 for others.
    """
    weights, bias = model.weights.copy(), model.bias
    speed, bias_speed = np.full(weights.shape, START, dtype=np.float32), START
    updates = np.zeros(_NONE, dtype=np.int64)
    blocks = [b for b in _blocks(iter(texts)) if len(b[1])]
    if not blocks:
        return bias, weights, updates
    terms, owners, chunks = (np.concatenate([b[k] for b in blocks]) for k in range(3))
    starts = np.searchsorted(owners, np.arange(len(texts) + 1))
    filled = np.flatnonzero(np.diff(starts))
    rng = np.random.default_rng(seed)
    for _ in range(PASSES):
        order = rng.permutation(filled)
        for at in range(0, len(order), _BATCH):
            batch = order[at : at + _BATCH]
            sizes = starts[batch + 1] - starts[batch]
            words = np.concatenate([np.arange(starts[k], starts[k + 1]) for k in batch])
            text = np.repeat(np.arange(len(batch)), sizes)
            importance = np.where(labels[batch] > 0, positive, 1.0)
            _, slope, used, rows = loss_gradient(
                bias, weights, terms[words], text, chunks[words], labels[batch], importance
            )
            rows += DECAY * weights[used]
            speed[used] += rows * rows
            weights[used] -= RATE * rows / np.sqrt(speed[used])
            bias_speed += slope * slope
            bias -= RATE * slope / bias_speed**0.5
            updates[used] += 1
    return bias, weights, updates


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, docs_per_label: int):
    """Texts and labels of about ``docs_per_label`` documents of each label, and the number of either.

    One label a document (1 if any of its rows says so) and one text (the smallest)
    for each id, so neither repeated ids nor copies make the sample larger.
    """
    named = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    totals = {r.label: r.n for r in named.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000)) / F.lit(1_000_000)
    share = [min(1.0, docs_per_label / totals.get(k, 1)) for k in (0, 1)]
    some = named.filter(place < F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0])))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The sample's ids are broadcast: about twice docs_per_label rows, whatever the input.
    found = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("label").alias("label")
    )
    return found, totals


_STEP = StructType([
    StructField("bucket", IntegerType()), StructField("updates", LongType()),
    *[StructField(f"w{k}", DoubleType()) for k in range(1 + FACTORS)],
])


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    docs_per_label: int = DOCS_PER_LABEL,
) -> Model:
    """A model of the documents that have a row in ``labels`` with label 0 or 1.

    About ``docs_per_label`` documents of each label are used, whole; all where
    there are fewer. Both labels weigh the same. Labels without a document and
    documents without a label are left out; without any the model gives 0.5.
    """
    spark = shipped(docs.sparkSession)
    found, totals = _sample(docs, labels, doc_id, text, label, docs_per_label)
    model = initial()
    if not totals:
        return model
    sample = stored(found, "labelled").select("text", "label").repartition(TASKS)
    used = [min(totals.get(k, 0), docs_per_label) for k in (0, 1)]
    positive = used[0] / used[1] if used[0] and used[1] else 1.0

    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)

        def of(batches: Iterator[pa.RecordBatch], turn=turn, shared=shared) -> Iterator[pa.RecordBatch]:
            texts, marks = [], []
            for batch in batches:
                texts += batch.column(0).to_pylist()
                marks += batch.column(1).to_pylist()
            if not texts:
                return
            order = sorted(range(len(texts)), key=lambda k: (texts[k], marks[k]))
            bias, weights, updates = fit_part(
                shared.value, [texts[k] for k in order], np.array([marks[k] for k in order], dtype=float),
                SEED + turn, positive,
            )
            some = np.flatnonzero(updates)
            # Row -1 is the bias, by the number of texts.
            n = np.append(updates[some], len(texts))
            values = np.vstack((weights[some].astype(float), [[bias] + [0.0] * FACTORS])) * n[:, None]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(some, -1), pa.int32()), pa.array(n, pa.int64()),
                 *[pa.array(values[:, k]) for k in range(1 + FACTORS)]],
                names=_STEP.names,
            )

        summed = sample.mapInArrow(of, _STEP).groupBy("bucket").agg(
            *[F.sum(c).alias(c) for c in _STEP.names[1:]]
        ).toArrow()  # at most one row a bucket
        rows = np.column_stack([summed.column(c).to_numpy() for c in _STEP.names[2:]])
        rows = rows / summed.column("updates").to_numpy()[:, None]
        bucket = summed.column("bucket").to_numpy()
        weights, bias = model.weights.copy(), model.bias
        weights[bucket[bucket >= 0]] = rows[bucket >= 0]
        if (bucket < 0).any():
            bias = float(rows[bucket < 0][0, 0])
        model = Model(bias, weights)
    return model


def score(
    docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text", extra: Column | None = None
) -> DataFrame:
    """doc_id, score, predicted (and the boolean ``extra``), one row for each row of ``docs``.

    score is the probability of label 1 were both labels equally frequent;
    predicted is 1 from 0.5. A null text and one without a letter or digit have
    the score of the bias. Repeated rows and null ids stay; other columns are not
    read. Whole texts are scored.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        (F.lit(None).cast("boolean") if extra is None else extra).alias("extra"),
    )
    shared = shipped(docs.sparkSession).sparkContext.broadcast(model)  # as large as the table of buckets
    schema = StructType([
        rows.schema["doc_id"], StructField("extra", BooleanType()), StructField("score", DoubleType()),
        StructField("predicted", IntegerType()),
    ])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                found = logits(shared.value, batch.column(1).to_pylist())
                chance = 1 / (1 + np.exp(-np.clip(found, -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(chance, pa.float64()),
                     pa.array(chance >= 0.5, pa.bool_()).cast(pa.int32())],
                    names=schema.names,
                )

    found = rows.mapInArrow(of, schema)
    return found.drop("extra") if extra is None else found
