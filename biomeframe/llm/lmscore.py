"""Documents scored by a masked pseudo-likelihood.

Every token is predicted from the ``SIDE`` tokens before and after it by a small
network: embeddings of the window, one hidden layer, then the token's class and
its place in the class, each a softmax. The score of a document is the sum of the
log-probabilities of its tokens.

The vocabulary is the most frequent words of all documents. Any other word is token
0 and then spelled: its probability is that of token 0 in the window times that of
its UTF-8 bytes, each after the one before, and of its end, as counted over all
tokens outside the vocabulary. So each word has a probability of its own. The network is
trained in numpy on all partitions at once: in each round a task goes through its
own documents from the common weights, and the weights are averaged. What is
gathered, word counts and weights of each task, grows with the input; what
reaches the driver is bounded by the vocabulary, the pairs of bytes and ``FAN``
sets of weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from biomeframe.llm.common import shipped
from biomeframe.session import stored

#: A token is class * PLACES + place; classes hold words of like frequency. Token 0 is
#: any word outside the vocabulary.
CLASSES, PLACES = 64, 64
TOKENS = CLASSES * PLACES
PAD = TOKENS
SIDE = 2
WIDTH, HIDDEN = 16, 32
ROUNDS = 2
#: In a round each document trains on every STRIDE-th of its tokens, at another offset each
#: time: every token of the corpus is a target once.
STRIDE = ROUNDS
RATE = 0.1
STEP = 512
FAN = 32
SEED = 7
_BLOCK = 2048
_DOCS = 1024
#: The byte pairs of a word's spelling, where EDGE stands before its first and behind its last.
EDGE = 256
PAIRS = (EDGE + 1) ** 2
_SHAPES = {
    "embed": (TOKENS + 1, WIDTH),
    "w1": (2 * SIDE * WIDTH, HIDDEN),
    "b1": (HIDDEN,),
    "wc": (HIDDEN, CLASSES),
    "bc": (CLASSES,),
    "known": (CLASSES, HIDDEN),
    "wp": (HIDDEN, PLACES),
    "bp": (PLACES,),
}
SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())
_CELLS = np.arange((TOKENS + 1) * WIDTH).reshape(TOKENS + 1, WIDTH)


class Network:
    """Weights in one flat vector; forward pass, and training steps with Adagrad."""

    def __init__(self, flat: np.ndarray):
        self.flat = np.array(flat, dtype=np.float32)
        self.w = self._views(self.flat)
        self.past = None

    @staticmethod
    def _views(flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in _SHAPES.items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    @staticmethod
    def start(counts: np.ndarray) -> np.ndarray:
        """First weights: small random ones, class biases from the counts of tokens."""
        rng = np.random.default_rng(SEED)
        net = Network(np.zeros(SIZE, dtype=np.float32))
        for name in ("embed", "w1", "wc", "known", "wp"):
            shape = _SHAPES[name]
            net.w[name][:] = rng.normal(0, 0.5 if name == "embed" else shape[0] ** -0.5, shape)
        by_class = counts.reshape(CLASSES, PLACES)
        net.w["bc"][:] = np.log(by_class.sum(axis=1) + 1.0)
        net.w["bp"][:] = np.log(by_class.sum(axis=0) + 1.0)
        return net.flat

    def _forward(self, context: np.ndarray, target: np.ndarray):
        """Inputs, hidden layer, classes of the targets, and both softmaxes: of the class
        in ``[:, 0]``, of the place in it in ``[:, 1]``."""
        w = self.w
        x = np.take(w["embed"], context.ravel(), axis=0).reshape(len(context), -1)
        h = x @ w["w1"]
        h += w["b1"]
        np.tanh(h, out=h)
        group = target // PLACES
        z = (h @ np.hstack((w["wc"], w["wp"]))).reshape(-1, 2, PLACES)
        z[:, 0] += w["bc"]
        z[:, 1] += np.take(w["known"] @ w["wp"] + w["bp"], group, axis=0)
        z -= z.max(axis=2, keepdims=True)
        np.exp(z, out=z)
        z /= (z.reshape(-1, PLACES) @ np.ones(PLACES, dtype=np.float32)).reshape(-1, 2, 1)
        return x, h, group, z

    def scorer(self):
        """A function of (context, target) giving log-probabilities.

        What does not depend on a row is multiplied out first: the hidden layer's
        share of each token at each place, and the class's share of the places.
        """
        w = self.w
        shares = [w["embed"] @ part for part in np.split(w["w1"], 2 * SIDE)]
        # In doubles: a product in single precision rounds a row as its place in the block has it.
        both = np.hstack((w["wc"], w["wp"])).astype(float)
        places = w["known"] @ w["wp"] + w["bp"]

        def log_prob(context: np.ndarray, target: np.ndarray) -> np.ndarray:
            h = np.take(shares[0], context[:, 0], axis=0)
            h += w["b1"]
            for k in range(1, 2 * SIDE):
                h += np.take(shares[k], context[:, k], axis=0)
            z = (np.tanh(h, out=h) @ both).astype(np.float32)
            group = target // PLACES
            z[:, :CLASSES] += w["bc"]
            z[:, CLASSES:] += np.take(places, group, axis=0)
            z -= z.max(axis=1, keepdims=True)
            rows = np.arange(len(target))
            mine = z[rows, group] + z[rows, CLASSES + target % PLACES]
            np.exp(z, out=z)
            tiny = np.float32(1e-37)  # a softmax far below the other one
            lost = np.log(z[:, :CLASSES].sum(axis=1) + tiny) + np.log(z[:, CLASSES:].sum(axis=1) + tiny)
            return mine - lost

        return log_prob

    def train(self, context: np.ndarray, target: np.ndarray) -> None:
        """One Adagrad step on the mean log-probability; weights without a gradient stay."""
        self._step(self.gradient(context, target))

    def gradient(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of the mean negative log-probability, in the order of the flat vector."""
        w, n = self.w, len(target)
        x, h, group, z = self._forward(context, target)
        rows = np.arange(n)
        z[rows, 0, group] -= 1
        z[rows, 1, target % PLACES] -= 1
        z /= n
        both = z.reshape(n, -1)
        which = np.zeros((CLASSES, n), dtype=np.float32)
        which[group, rows] = 1
        by_class = which @ z[:, 1]  # of the places, summed for each class
        dh = (both @ np.hstack((w["wc"], w["wp"])).T) * (1 - h * h)
        flat = np.empty(SIZE, dtype=np.float32)
        g = self._views(flat)
        g["known"][:] = by_class @ w["wp"].T
        outer, sums = h.T @ both, both.sum(axis=0)
        g["wc"][:], g["bc"][:] = outer[:, :CLASSES], sums[:CLASSES]
        # The hidden layer of the places has the class's share added to it.
        g["wp"][:], g["bp"][:] = outer[:, CLASSES:] + w["known"].T @ by_class, sums[CLASSES:]
        g["w1"][:], g["b1"][:] = x.T @ dh, dh.sum(axis=0)
        cells = np.take(_CELLS, context.ravel(), axis=0).ravel()
        g["embed"].ravel()[:] = np.bincount(cells, (dh @ w["w1"].T).ravel(), _CELLS.size)
        return flat

    def _step(self, grad: np.ndarray) -> None:
        if self.past is None:
            self.past = np.full(SIZE, 1e-4, dtype=np.float32)
        self.past += grad * grad
        grad /= np.sqrt(self.past)
        grad *= RATE
        self.flat -= grad


def windows(docs: list[np.ndarray], every: int = 1, offset: int = 0):
    """Contexts, targets and document numbers of the tokens.

    Of each document only the tokens whose place, counted from 0, leaves ``offset``
    when divided by ``every``; this does not depend on the documents beside it.
    """
    pad = np.full(SIDE, PAD, dtype=np.int64)
    flat = np.concatenate([x for d in docs for x in (pad, d)] + [pad]).astype(np.int64)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    at = np.flatnonzero(flat != PAD)
    if every > 1:
        first = np.cumsum([0] + [len(d) for d in docs])[owner]
        mine = (np.arange(len(at)) - first) % every == offset
        at, owner = at[mine], owner[mine]
    beside = [k for k in range(-SIDE, SIDE + 1) if k]
    return np.stack([flat[at + k] for k in beside], axis=1), flat[at], owner


def _groups(docs: Iterator[np.ndarray], size: int) -> Iterator[list[np.ndarray]]:
    """Documents in lists of about ``size`` tokens or more."""
    some, n = [], 0
    for doc in docs:
        some.append(doc)
        n += len(doc)
        if n >= size:
            yield some
            some, n = [], 0
    if some:
        yield some


def _byte_pairs(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The byte pairs of all words in a row, and where each word's begin."""
    words = pa.array(words, pa.large_binary())
    raw = np.frombuffer(b"".join(words.to_pylist()), dtype=np.uint8)
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    starts = np.cumsum(np.concatenate(([0], sizes + 1)))
    flat = np.full(starts[-1] + 1, EDGE, dtype=np.int64)
    inside = np.ones(starts[-1], dtype=bool)
    inside[starts[1:] - 1] = False
    # A word's bytes, then one EDGE, which is also the one before the next word.
    flat[1:][inside] = raw
    return flat[:-1] * (EDGE + 1) + flat[1:], starts[:-1]


def spelling(counts: np.ndarray) -> np.ndarray:
    """Log-probability of the second of each byte pair after the first, with half a pair added."""
    table = counts.reshape(EDGE + 1, EDGE + 1) + 0.5
    return np.log(table / table.sum(axis=1, keepdims=True)).ravel()


def _pair_counts(words: DataFrame) -> np.ndarray:
    """Counts of the byte pairs of (word, n) rows, each word counted n times."""
    schema = StructType([StructField("pair", IntegerType()), StructField("n", LongType())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PAIRS, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                pairs, starts = _byte_pairs(batch.column(0).cast(pa.large_binary()))
                each = np.repeat(batch.column(1).to_numpy(), np.diff(np.append(starts, len(pairs))))
                total += np.bincount(pairs, each, PAIRS).astype(np.int64)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], names=schema.names
        )

    out = np.zeros(PAIRS)
    for r in words.select("word", "n").mapInArrow(of, schema).groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r.pair] = r.n
    return out


def vocabulary(docs: DataFrame, text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The most frequent words of all documents, ties by the word, counts of all tokens,
    and the spelling of the words outside.

    Words are first counted in Arrow, some documents at a time, so that Spark sums
    one row for each distinct word of these.
    """
    shipped(docs.sparkSession)
    schema = StructType([StructField("word", StringType()), StructField("n", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _DOCS):
                some = pc.ascii_split_whitespace(whole.column(0).slice(at, _DOCS))
                found = pc.value_counts(some.flatten())
                kept = found.filter(pc.not_equal(found.field(0), ""))
                yield pa.RecordBatch.from_arrays([kept.field(0), kept.field(1)], names=schema.names)

    texts = docs.select(F.coalesce(F.lower(text), F.lit("")).alias("text"))
    counted = stored(
        texts.mapInArrow(count, schema).groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    top = counted.orderBy(F.desc("n"), "word").limit(TOKENS - 1).collect()
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    counts = np.array([total - sum(r.n for r in top)] + [r.n for r in top], dtype=float)
    rare = counted
    if top:
        last = F.struct(F.lit(-top[-1].n).alias("n"), F.lit(top[-1].word).alias("word"))
        rare = counted.filter(F.struct((-F.col("n")).alias("n"), "word") > last)
    counts = np.concatenate((counts, np.zeros(TOKENS - len(counts))))
    return [r.word for r in top], counts, spelling(_pair_counts(rare))


def encoded(docs: DataFrame, vocab: list[str], spelled: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """doc_id, ids (two bytes each) and log-probability of the spellings of every row."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.lower(text), F.lit("")).alias("text")
    )
    shared = shipped(docs.sparkSession).sparkContext.broadcast(
        ({w: k + 1 for k, w in enumerate(vocab)}, spelled)
    )
    schema = StructType(
        [rows.schema["doc_id"], StructField("ids", BinaryType()), StructField("spelled", DoubleType())]
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, log_pair = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, _DOCS):
                batch = whole.slice(at, _DOCS)
                split = pc.ascii_split_whitespace(batch.column(1))
                coded = split.flatten().dictionary_encode()
                # The empty piece beside white space at an end is no word.
                ids = [PAD if w == "" else known.get(w, 0) for w in coded.dictionary.to_pylist()]
                ids = np.array(ids, dtype="<u2")
                cost, rare = np.zeros(len(ids)), np.flatnonzero(ids == 0)
                if len(rare):
                    pairs, starts = _byte_pairs(coded.dictionary.take(pa.array(rare)).cast(pa.large_binary()))
                    cost[rare] = np.add.reduceat(log_pair[pairs], starts)
                places = coded.indices.to_numpy(zero_copy_only=False)
                flat = ids[places]
                sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                costs = np.bincount(np.repeat(np.arange(len(sizes)), sizes), cost[places], len(sizes))
                parts = [x[x != PAD].tobytes() for x in np.split(flat, ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(parts, pa.binary()), pa.array(costs, pa.float64())],
                    names=schema.names,
                )

    return stored(rows.mapInArrow(of, schema), "ids")


def _arrays(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for value in batch.column(column):
            yield np.frombuffer(value.as_buffer(), dtype="<u2")


def train(ids: DataFrame, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after ``rounds`` rounds over all documents, averaged by tokens seen."""
    flat = Network.start(counts)
    context = shipped(ids.sparkSession).sparkContext
    schema = StructType([
        StructField("slot", IntegerType()), StructField("n", LongType()),
        StructField("weights", BinaryType()),
    ])

    def row(slot: int, n: int, weights: np.ndarray) -> pa.RecordBatch:
        data = weights.astype("<f4").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([slot], pa.int32()), pa.array([n], pa.int64()), pa.array([data], pa.binary())],
            names=schema.names,
        )

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SIZE), 0
        for batch in batches:
            for k, data in zip(batch.column(1).to_pylist(), batch.column(2)):
                total += k * np.frombuffer(data.as_buffer(), dtype="<f4").astype(float)
                n += k
        if n:
            yield row(0, n, total / n)

    for number in range(rounds):
        shared = context.broadcast(flat)
        offset = number * STRIDE // rounds

        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            net, seen = Network(shared.value), 0
            for docs in _groups(_arrays(batches, 0), STEP * STRIDE * 8):
                around, target, _ = windows(docs, STRIDE, offset)
                for at in range(0, len(target), STEP):
                    net.train(around[at : at + STEP], target[at : at + STEP])
                seen += len(target)
            if seen:
                yield row(TaskContext.get().partitionId() % FAN, seen, net.flat)

        trained = ids.select("ids").mapInArrow(local, schema)
        means = trained.repartition(FAN, "slot").mapInArrow(average, schema).collect()
        seen = sum(r.n for r in means)
        if seen:
            flat = sum(r.n / seen * np.frombuffer(r.weights, dtype="<f4") for r in means)
            flat = np.asarray(flat, dtype=np.float32)
    return flat


def score(ids: DataFrame, flat: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, log_likelihood, per_token of each row of an encoded table."""
    shared = shipped(ids.sparkSession).sparkContext.broadcast(flat)
    schema = StructType([
        ids.schema["doc_id"], StructField("n_tokens", LongType()),
        StructField("log_likelihood", DoubleType()), StructField("per_token", DoubleType()),
    ])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_prob = Network(shared.value).scorer()
        for batch in batches:
            sums, sizes = [], []
            spelled = batch.column(2).to_pylist()
            for docs in _groups(_arrays(iter([batch]), 1), 32 * _BLOCK):
                around, target, owner = windows(docs)
                total = np.zeros(len(docs))
                for at in range(0, len(target), _BLOCK):
                    got = log_prob(around[at : at + _BLOCK], target[at : at + _BLOCK])
                    total += np.bincount(owner[at : at + _BLOCK], got, len(docs))
                sums += total.tolist()
                sizes += [len(d) for d in docs]
            sums = [s + x for s, x in zip(sums, spelled)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64()),
                 pa.array([s / n if n else None for s, n in zip(sums, sizes)], pa.float64())],
                names=schema.names,
            )

    return ids.mapInArrow(of, schema)


def pseudo_likelihood(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, log_likelihood, per_token, one row for each row of ``docs``.

    Words are lower-cased and cut at ASCII white space. A null, empty or blank
    text has no token, log_likelihood 0 and a null per_token. Null ids and
    repeated rows stay; other columns are not read. Weights depend on how the
    rows are partitioned, so scores of differently laid out copies of a table
    differ slightly.
    """
    vocab, counts, spelled = vocabulary(docs, text)
    ids = encoded(docs, vocab, spelled, doc_id, text)
    return score(ids, train(ids, counts))
