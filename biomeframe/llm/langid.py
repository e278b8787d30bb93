"""Language identification: multinomial naive Bayes over hashed character n-grams.

The log-probability matrix (languages x buckets, bounded by parameters) is
broadcast. Texts are scored in numpy: each n-gram is one entry of a sparse
document x bucket matrix, multiplied by the log-probabilities block by block.
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
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from biomeframe.llm.common import free_name, shipped

BITS = 16
#: Expected number of training documents of each language, chosen by a hash of their id.
DOCS_PER_LANGUAGE = 5_000
SMOOTHING = 0.5
UNKNOWN = "und"
#: Deviations below the mean: texts of the learned languages stay under 0.6 in the tables
#: at hand, Finnish, Polish, Russian and random letters begin above 1.
MAX_STRANGE = 0.9
_BLOCK = 1 << 18
_ROWS = 512
_NONE = 1 << BITS


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # languages x buckets

    def usual(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean and deviation of the log-probability of an n-gram in texts of each language."""
        chance = np.exp(self.log_prob.astype(float))
        mean = (chance * self.log_prob).sum(axis=1)
        return mean, np.sqrt(np.maximum((chance * (self.log_prob - mean[:, None]) ** 2).sum(axis=1), 0.0))


@cache
def _fold() -> np.ndarray:
    """Each code point itself if it is a letter, else 0."""
    letters = [i if chr(i).isalpha() else 0 for i in range(0x110000)]
    return np.array(letters, dtype=np.uint32)


def _buckets(folded: np.ndarray) -> list[np.ndarray]:
    """Bucket of the 1-, 2- and 3-gram that starts at each place, but the last two."""
    a, b, c = folded[:-2], folded[1:-1], folded[2:]
    one = a * np.uint32(0x9E3779B1)
    two = (one ^ (one >> np.uint32(15))) * np.uint32(0x85EBCA77) + b * np.uint32(0xC2B2AE3D)
    three = (two ^ (two >> np.uint32(15))) * np.uint32(0x27D4EB2F) + c * np.uint32(0x165667B1)
    out = []
    for k, h in enumerate((one, two, three)):
        h = (h ^ np.uint32(k + 1)) * np.uint32(0x9E3779B1)
        out.append(((h ^ (h >> np.uint32(13))) & np.uint32((1 << BITS) - 1)).astype(np.int32))
    return out


def _blocks(texts: Iterator[str]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Buckets of several texts for each order, with the starts and numbers of the texts.

    A text stands between zeros. A text longer than a block comes in pieces that
    overlap by two, so that each n-gram starts in one of them. The two places at
    the end of each piece start no n-gram of it and get the bucket ``_NONE``.
    """
    parts, owners, size = [], [], 0
    for k, text in enumerate(texts):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for at in range(0, len(codes), _BLOCK):
            piece = _fold()[codes[max(at - 2, 0) : at + _BLOCK]]
            lead, tail = [0] * (at == 0), [0, 0] * (at + _BLOCK >= len(codes))
            parts.append(np.concatenate((lead, piece, tail)).astype(np.uint32))
            owners.append(k)
            size += len(parts[-1])
            if size >= _BLOCK:
                yield _joined(parts, owners)
                parts, owners, size = [], [], 0
    if parts:
        yield _joined(parts, owners)


def _joined(parts, owners):
    ends = np.cumsum([len(p) for p in parts])
    found = _buckets(np.concatenate(parts))
    cut = np.concatenate((ends[:-1] - 2, ends[:-1] - 1))
    for idx in found:
        idx[cut] = _NONE
    return found, np.concatenate(([0], ends[:-1])), np.array(owners)


def ngram_counts(texts: list[str]) -> np.ndarray:
    """How often each bucket occurs in the texts."""
    total = np.zeros(_NONE + 1, dtype=np.int64)
    for found, _, _ in _blocks(iter(texts)):
        for idx in found:
            total += np.bincount(idx, minlength=_NONE + 1)
    return total[:_NONE]


def train(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
) -> Model:
    """A model of the rows of ``docs`` with text and label.

    About ``docs_per_language`` rows of each language are used, whole; all of
    them where there are fewer. Priors come from all rows. What reaches the
    driver is one count for each language and bucket in use.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    shipped(docs.sparkSession)
    totals = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, 1 << BITS), dtype=np.float32))
    shares = F.create_map(
        *[x for k in languages for x in (F.lit(k), F.lit(min(1.0, docs_per_language / totals[k])))]
    )
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) / F.lit(1_000_000)
    sample = rows.filter(place < shares[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(name, []).append(value)
            for name, texts in by_lang.items():
                sums[name] = sums.get(name, 0) + ngram_counts(texts)
        for name, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()),
                 pa.array(total[used], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    schema = StructType([
        StructField("lang", StringType()), StructField("bucket", IntegerType()),
        StructField("n", LongType()),
    ])
    summed = sample.mapInArrow(count, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(languages), 1 << BITS))
    at = {name: k for k, name in enumerate(languages)}
    found = summed.toArrow()  # at most languages x buckets rows
    rank = np.array([at[x] for x in found.column("lang").to_pylist()], dtype=np.int64)
    counts[rank, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    counts += SMOOTHING
    prior = np.array([totals[k] for k in languages], dtype=float)
    return Model(
        languages,
        np.log(prior / prior.sum()),
        np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32),
    )


def scores(model: Model, texts: list[str]) -> np.ndarray:
    """Log joint probability, texts x languages."""
    out = np.tile(model.log_prior, (len(texts), 1))
    rows = [np.append(row, np.float32(0)) for row in model.log_prob]  # _NONE adds nothing
    for found, starts, owners in _blocks(iter(texts)):
        for idx in found:
            for k, row in enumerate(rows):
                np.add.at(out[:, k], owners, np.add.reduceat(row[idx], starts, dtype=np.float64))
    return out


def _best(model: Model, texts: list[str | None]) -> tuple[list[str], list[float], np.ndarray]:
    """Language and posterior of each text, ``und`` and 0 for null; and how strange the text is for it.

    That is how many deviations the mean log-probability of its n-grams lies below
    that of the language's training texts, less three standard errors.
    """
    langs, sure, strange = [UNKNOWN] * len(texts), [0.0] * len(texts), np.zeros(len(texts))
    known = [k for k, t in enumerate(texts) if t is not None and model.languages]
    if known:
        joint = scores(model, [texts[k] for k in known])
        best = joint.argmax(axis=1)
        top = joint[np.arange(len(known)), best]
        post = 1.0 / np.exp(joint - top[:, None]).sum(axis=1)
        mean, spread = model.usual()
        grams = np.array([3 * (len(texts[k].lower()) + 1) for k in known])
        off = mean[best] - (top - model.log_prior[best]) / grams
        strange[known] = off / np.maximum(spread[best], 1e-9) - 3 / np.sqrt(grams)
        for k, b, p in zip(known, best.tolist(), post.tolist()):
            langs[k], sure[k] = model.languages[b], p
    return langs, sure, strange


def _lettered(text: str) -> Column:
    return F.when(F.col(text).rlike(r"\p{L}"), F.col(text))


def predict(
    docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text",
    extra: Column | None = None,
) -> DataFrame:
    """doc_id, lang_pred, score (and the boolean ``extra``), one row for each row of ``docs``.

    score is the posterior probability of lang_pred. A null text and one without
    a letter give ``und`` with score 0, as does a model without languages.
    Repeated rows and null ids stay; other columns are not read.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), _lettered(text).alias("text"),
        (F.lit(None).cast("boolean") if extra is None else extra).alias("extra"),
    )
    shared = shipped(docs.sparkSession).sparkContext.broadcast(model)
    schema = StructType([
        rows.schema["doc_id"], StructField("extra", BooleanType()),
        StructField("lang_pred", StringType()), StructField("score", DoubleType()),
    ])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                langs, sure, _ = _best(shared.value, batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(langs, pa.string()),
                     pa.array(sure, pa.float64())],
                    names=["doc_id", "extra", "lang_pred", "score"],
                )

    found = rows.mapInArrow(of, schema)
    return found.drop("extra") if extra is None else found


def keep_languages(
    docs: DataFrame, model: Model, min_score: float = 0.5, max_strange: float = MAX_STRANGE
) -> DataFrame:
    """The rows of ``docs`` whose language is known, unchanged, unshuffled.

    Known is a language with a posterior of at least ``min_score``, if the text is
    not too strange for it: a text of a language that was not learned has a sure
    posterior too, but unlikely n-grams. Null texts and those without a letter go;
    repeated rows share one verdict; other columns may have any name.
    """
    text = free_name(docs, "lettered")
    rows = docs.withColumn(text, _lettered("text"))
    shared = shipped(docs.sparkSession).sparkContext.broadcast(model)
    last = len(docs.columns)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                langs, sure, strange = _best(shared.value, batch.column(last).to_pylist())
                good = [
                    x != UNKNOWN and p >= min_score and far <= max_strange
                    for x, p, far in zip(langs, sure, strange.tolist())
                ]
                yield batch.select(range(last)).filter(pa.array(good, pa.bool_()))

    return rows.mapInArrow(of, docs.schema)
