"""Quality classifier: similarity-weighted votes of nearest labelled neighbours in a latent-semantic space.

A text's terms are its byte trigrams, its words, and words that stand again within the next few words; trigrams and
words are hashed into a fixed number of terms. Square roots of term counts, weighted by inverse document frequency,
make a vector; a singular value decomposition of a bounded sample of labelled documents gives the latent space. The
sample's latent vectors are sent to all tasks, at most ``SAMPLE`` vectors of ``DIMENSIONS`` numbers, and every
document's exact cosines with all of them are computed in blocks; the ``NEIGHBOURS`` most similar vote for their labels,
each with its cosine as weight.

The labelled sample is bounded (the labelled rows of smallest hash); everything else is computed for
every document, over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideway.llm import text_kernel as K

FOLDS, HELD_OUT = 3, 1
#: Labelled documents that the space is made of and that vote, at most.
SAMPLE = 2048
DIMENSIONS = 24
NEIGHBOURS = 7
#: Documents whose cosines are computed at once.
BLOCK = 64
#: Sampled documents that the driver writes out with all their terms at once.
STRIP = 128
#: Blocks of a Krylov space, how often one is begun again, and the residuals that end it, as a share of the largest eigenvalue.
BLOCKS, CYCLES, SETTLED = 8, 60, 1e-9
#: Terms that trigrams and words are hashed into, and within how many words a repeated word is a term.
GRAMS, WORDS, LAGS = 4096, 4096, 4
TERMS = GRAMS + WORDS + LAGS


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of how often each term stands in each text."""
    docs = len(offsets) - 1
    out = np.zeros((docs, TERMS), dtype=np.float32)
    of = np.repeat(np.arange(docs), np.diff(offsets))
    if len(data) > 2:
        gram = data[:-2].astype(np.uint64) | data[1:-1].astype(np.uint64) << K.U(8) | data[2:].astype(np.uint64) << K.U(16)
        at = of[2:] * GRAMS + (K.mix(gram) % K.U(GRAMS)).astype(np.int64)
        out[:, :GRAMS] = np.bincount(at[of[2:] == of[:-2]], minlength=docs * GRAMS).reshape(docs, GRAMS)
    words, first = K.word_hashes(data, offsets, K.SPACES)
    owner = np.repeat(np.arange(docs), np.diff(first))
    out[:, GRAMS : GRAMS + WORDS] = np.bincount(owner * WORDS + (words % K.U(WORDS)).astype(np.int64), minlength=docs * WORDS).reshape(docs, WORDS)
    for lag in range(1, min(LAGS, len(words) - 1) + 1):
        again = (words[lag:] == words[:-lag]) & (owner[lag:] == owner[:-lag])
        out[:, GRAMS + WORDS + lag - 1] = np.bincount(owner[lag:][again], minlength=docs)
    return np.sqrt(out, out=out)


class Model(NamedTuple):
    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """The latent space of labelled documents, and their unit vectors there; a row has the places of its terms and their weights.

    The driver does this: only ``STRIP`` rows at a time, and another ``STRIP`` that they meet, are written out with all their terms.
    """
    n = len(rows)
    seen = np.zeros(TERMS, dtype=np.int64)
    for places, weights in rows:
        seen[places[weights != 0]] += 1
    idf = (np.log((1.0 + n) / (1.0 + seen)) + 0.2).astype(np.float32)

    def strip(a: int) -> np.ndarray:
        out = np.zeros((min(STRIP, n - a), TERMS), dtype=np.float32)
        for x, (places, weights) in zip(out, rows[a : a + STRIP], strict=False):
            x[places] = weights
        out *= idf
        out /= np.maximum(1e-12, np.sqrt(np.einsum("ij,ij->i", out, out)))[:, None]
        return out

    # The right singular vectors, from the leading eigenvectors of the documents' inner products.
    gram = np.empty((n, n), dtype=np.float32)
    for a in range(0, n, STRIP):
        one = strip(a)
        for b in range(0, a + 1, STRIP):
            inner = one @ (one if a == b else strip(b)).T
            gram[a : a + STRIP, b : b + STRIP] = inner
            gram[b : b + STRIP, a : a + STRIP] = inner.T
    values, left = _leading(gram, dimensions)
    del gram
    some = values > 1e-9
    values, left = values[some], left[:, some].astype(np.float32)
    space = np.zeros((TERMS, len(values)), dtype=np.float32)
    for a in range(0, n, STRIP):
        space += strip(a).T @ left[a : a + STRIP]
    space = (space / np.sqrt(values)).astype(np.float32)
    vectors = np.concatenate([strip(a) @ space for a in range(0, n, STRIP)])
    return Model(idf, space, _unit(vectors), labels.astype(np.float32))


def _leading(gram: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and their eigenvectors in double precision.

    Of a large matrix by block Krylov spaces, each begun with what the one before found, until the residuals are below ``SETTLED`` of the
    largest eigenvalue; if they don't get there, and of a small one, by all its eigenvectors, which take many times the matrix's memory.
    """
    n, block = len(gram), count + 8
    if n > BLOCKS * block * 2:
        found = np.linalg.qr(np.random.Generator(np.random.PCG64(n)).standard_normal((n, block)))[0]
        for _ in range(CYCLES):
            basis, images = [found], [_times(gram, found)]
            least = 1e-10 * np.linalg.norm(images[0])
            for _ in range(BLOCKS - 1):
                x = _apart(images[-1], basis)
                new, size, _ = np.linalg.svd(x, full_matrices=False)
                new = new[:, size > least]
                if not new.shape[1]:  # nothing leads out of the space
                    break
                basis.append(np.linalg.qr(_apart(new, basis))[0])
                images.append(_times(gram, basis[-1]))
            q, image = np.concatenate(basis, axis=1), np.concatenate(images, axis=1)
            del basis, images
            inner = q.T @ image
            values, turn = np.linalg.eigh((inner + inner.T) / 2)
            values, turn = values[::-1][:block], turn[:, ::-1][:, :block]
            found, image = q @ turn, image @ turn
            off = np.linalg.norm(image[:, :count] - found[:, :count] * values[:count], axis=0)
            if off.max() <= SETTLED * values[0]:
                return values[:count], found[:, :count]
            found = np.linalg.qr(found)[0]
    values, vectors = np.linalg.eigh(gram.astype(np.float64))
    return values[::-1][:count], vectors[:, ::-1][:, :count]


def _apart(x: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """What the columns hold besides the basis, taken off twice for what rounding leaves."""
    for q in basis * 2:
        x = x - q @ (q.T @ x)
    return x


def _times(gram: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.concatenate([gram[a : a + STRIP].astype(np.float64) @ x for a in range(0, len(gram), STRIP)])


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(1e-12, np.linalg.norm(x, axis=1, keepdims=True))).astype(np.float32)


def votes(model: Model, weights: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """The similarity-weighted share of label 1 among each row's nearest labelled rows; of equally similar ones the first count.

    A row that is similar to none gets the labels' mean.
    """
    out = np.empty(len(weights))
    k, labels = min(neighbours, len(model.labels)), model.labels.astype(np.float64)
    for a in range(0, len(weights), BLOCK):
        cosine = _unit((weights[a : a + BLOCK] * model.idf) @ model.space) @ model.vectors.T
        least = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
        near = cosine >= least
        for row in np.flatnonzero(near.sum(axis=1) > k):
            tied = np.flatnonzero(cosine[row] == least[row])
            near[row, tied[k - int((cosine[row] > least[row]).sum()) :]] = False
        pull = np.where(near, np.maximum(cosine, 0.0), 0.0).astype(np.float64)
        total = pull.sum(axis=1)
        out[a : a + BLOCK] = np.where(total > 0, pull @ labels / np.where(total > 0, total, 1.0), labels.mean())
    return np.clip(out, 0.0, 1.0)


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model of a sample of labelled documents outside the held-out fold; None if there are none."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    fold = F.crc32(key) % FOLDS
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold != HELD_OUT))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))  # of a repeated doc_id the first text
    found = one.mapInArrow(K.tidy(_sampled), "doc_id long, places binary, weights binary, quality int").collect()  # SAMPLE rows at most, of TERMS numbers
    if not found:
        return None
    found = sorted(found, key=lambda r: r["doc_id"])
    rows = [(np.frombuffer(r["places"], dtype=np.uint16), np.frombuffer(r["weights"], dtype=np.float32)) for r in found]
    labels_of = np.array([r["quality"] for r in found])
    model = fit(rows, labels_of)
    del found, rows
    K.release()
    return model


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = K.raw_bytes(batch.column(1))
        for a, b in K.chunks(offsets):
            for c in range(a, b, BLOCK):
                d = min(b, c + BLOCK)
                w = terms(data[offsets[c] : offsets[d]], offsets[c : d + 1] - offsets[c])
                places = [np.flatnonzero(x).astype(np.uint16) for x in w]
                held = [pa.array([p.tobytes() for p in places], pa.binary()), pa.array([x[p].tobytes() for x, p in zip(w, places, strict=True)], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0)[c:d].cast(pa.int64()), *held, batch.column(2)[c:d].cast(pa.int32())], names=["doc_id", "places", "weights", "quality"])


def scorer(model: Model | None):
    """A column function: a text's score, 0.5 where nothing was learnt."""

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            data, offsets = K.raw_bytes(column)
            parts = [np.zeros(0)]
            for a, b in K.chunks(offsets):
                for c in range(a, b, BLOCK):
                    d = min(b, c + BLOCK)
                    parts.append(votes(model, terms(data[offsets[c] : offsets[d]], offsets[c : d + 1] - offsets[c])) if model else np.full(d - c, 0.5))
            del column
            yield pa.array(np.concatenate(parts))
            del data, offsets
            K.release()

    return score


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document.

    Learns only from labelled documents whose crc32(doc_id as text) mod 3 is not 1; held_out tells
    that it is. score, from 0 to 1, is higher where quality 1 is likelier; predicted is 1 from 0.5 on. Only
    the text enters a score.

    Null texts score as empty ones: similar to none, by the labels' mean. Labels that are null or neither 0 nor 1 don't
    count; of repeated labels the larger counts, of a repeated labelled doc_id the text that sorts first. Rows without doc_id are scored, and not held out. Repeated
    rows are each scored. Without usable labels all scores are 0.5. An empty table gives no rows. Other
    columns are ignored.
    """
    model = learn(documents, labels)
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT
    scored = documents.select("doc_id", held.alias("held_out"), scorer(model)(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
