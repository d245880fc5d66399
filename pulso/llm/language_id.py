"""Language identification with error-correcting output codes.

Every language gets a codeword of bits. For each bit a binary n-gram classifier
separates the languages whose bit is set from the others: its weights are the
log ratios of the two sides' smoothed n-gram distributions, each side the mean of its
languages so that a large language does not outweigh a small one. A text's margin
for a bit is the mean weight of its n-grams. Decoding is loss-weighted:
the distance to a codeword is the sum over bits of an exponential loss of bit times
margin, weighted with how reliably that classifier separates that
language. The nearest codeword wins; a small lead over the second one is flagged as ambiguous.

N-grams are hashed byte n-grams of the lower-cased text in which every run of
ASCII non-letters is one space. Counts come from all training rows, added up map-side; thresholds, scales and
reliabilities of the bit classifiers are fitted on about ``CALIBRATION_ROWS`` rows per language, chosen by
hash. The model has (languages x BUCKETS) counts; the set of languages is a small vocabulary.

Defined results: NULL texts and texts without a letter are ``und`` with score 0,
flagged ambiguous; a single learned language wins with score 1 where there is a letter; with none
learned all is ``und``; repeated rows count as often as they occur; an empty table gives an empty result.
Only ``doc_id``, ``text`` and ``lang`` are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, text_buffer

GRAM = 3
BUCKETS = 1 << 14
SMOOTHING = 0.5
CALIBRATION_ROWS = 400
EXHAUSTIVE_UP_TO = 6
SLAB_BYTES = 1 << 20
AMBIGUOUS_LEAD = 0.25
UNDETERMINED = "und"

# Byte classes: ASCII letters (lowered before) and bytes of non-ASCII characters stay, the rest is a space.
_CLASS = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint32)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray        # languages x bits, +1 or -1
    weights: np.ndarray      # (BUCKETS + 1) x bits; the last row, of no n-gram, is zero
    threshold: np.ndarray    # bits
    scale: np.ndarray        # bits
    trust: np.ndarray        # languages x bits, rows sum to one


def codewords(n: int) -> np.ndarray:
    """Codewords of n languages: all two-sided splits for few languages, else the best of seeded dense random codes."""
    if n <= EXHAUSTIVE_UP_TO:
        splits = [s for s in range(1, 1 << max(n - 1, 0))]
        return np.array([[1 if s >> k & 1 else -1 for s in splits] for k in range(n)], np.int8).reshape(n, len(splits))
    rng, bits, best, widest = np.random.default_rng(n), int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        if (abs(code.sum(axis=0)) == n).any():
            continue
        apart = (bits - code.astype(int) @ code.T.astype(int)) // 2
        least = min(apart[a, b] for a, b in combinations(range(n), 2))
        if least > widest:
            best, widest = code, least
    return best


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bucket of the n-gram that begins at each byte of data[starts[0]:ends[-1]]; BUCKETS where there is none."""
    a = starts[0]
    cls = _CLASS[data[a:ends[-1]]]
    if not len(cls):
        return np.zeros(0, np.int64)
    padded = np.concatenate((cls, np.full(GRAM - 1, 32, np.uint32)))
    code = np.zeros(len(cls), np.uint32)
    blank = np.ones(len(cls), bool)
    for i in range(GRAM):
        part = padded[i:i + len(cls)]
        code = code * np.uint32(0x01000193) ^ part * np.uint32(0x9E3779B1)
        blank &= part == 32
    bucket = (code * np.uint32(0x85EBCA6B) >> np.uint32(32 - (BUCKETS - 1).bit_length())).astype(np.int64)
    # An n-gram neither starts with two spaces nor runs past its text.
    blank[:-1] |= (cls[:-1] == 32) & (cls[1:] == 32)
    for i in range(1, GRAM):
        over = ends - a - i
        blank[over[over >= starts - a]] = True
    bucket[blank] = BUCKETS
    return bucket


def _slabs(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, first position of each, buckets) slab by slab; overlapping cuts keep every n-gram exactly once."""
    offsets, data = text_buffer(col)
    for rows, starts, ends in pieces(offsets, SLAB_BYTES, overlap=GRAM - 1):
        # Pieces of one slab are neighbours in the buffer, as texts follow each other without gaps.
        yield rows, starts - starts[0], _grams(data, starts, ends)


def _gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows, and bucket -1 with the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            order = {x: k for k, x in enumerate(dict.fromkeys(names))}
            number = np.array([order[x] for x in names])
            for x in order:
                sums.setdefault(x, np.zeros(BUCKETS + 2, np.int64))[BUCKETS + 1] += names.count(x)
            for at, begin, buckets in _slabs(batch.column(1)):
                lens = np.diff(np.append(begin, len(buckets)))
                joint = np.repeat(number[at], lens) * (BUCKETS + 1) + buckets
                table = np.bincount(joint, minlength=len(order) * (BUCKETS + 1)).reshape(len(order), -1)
                for x, k in order.items():
                    sums[x][:BUCKETS + 1] += table[k]
        for x, n in sums.items():
            n[BUCKETS] = 0
            found = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(found), pa.string()), pa.array(np.where(found > BUCKETS, -1, found), pa.int32()),
                 pa.array(n[found], pa.int64())], names=["lang", "bucket", "n"])

    return (rows.mapInArrow(run, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def _margins(col: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each text's n-grams, per bit; zero for a text without n-grams."""
    total, n = np.zeros((len(col), weights.shape[1])), np.zeros(len(col))
    for at, begin, buckets in _slabs(col):
        if len(buckets):
            # Of a run of equal begins (empty pieces) reduceat would repeat the next one; pieces are never empty.
            np.add.at(total, at, np.add.reduceat(weights[buckets], begin, axis=0, dtype=np.float64))
            np.add.at(n, at, np.add.reduceat(buckets < BUCKETS, begin, dtype=np.int64))
    return total / np.maximum(n, 1)[:, None]


def fit(rows: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id") -> Model:
    """Learn from rows with a language; ``key`` only picks the calibration rows."""
    rows = rows.filter(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.lower(F.col(text).cast("string")).alias("text"), F.col(key).alias("key"))
    counts: dict[str, np.ndarray] = {}
    for r in _gram_counts(rows.select("lang", "text")).toLocalIterator():  # languages x BUCKETS numbers at most
        counts.setdefault(r["lang"], np.zeros(BUCKETS + 1))[r["bucket"]] = r["n"]
    languages = sorted(counts)
    sizes = {x: counts[x][-1] for x in languages}
    codes = codewords(len(languages))
    bits = codes.shape[1]
    weights = np.zeros((BUCKETS + 1, bits), np.float32)
    model = Model(languages, codes, weights, np.zeros(bits), np.ones(bits), np.full(codes.shape, 1 / max(bits, 1)))
    if len(languages) < 2:
        return model
    share = np.array([counts[x][:-1] + SMOOTHING for x in languages])
    share /= share.sum(axis=1, keepdims=True)
    for b in range(bits):
        weights[:BUCKETS, b] = np.log(share[codes[:, b] > 0].mean(axis=0)) - np.log(share[codes[:, b] < 0].mean(axis=0))
    # About CALIBRATION_ROWS rows of each language, drawn by the hash of their key.
    rate = F.create_map(*[F.lit(v) for x in languages for v in (x, float(min(1.0, CALIBRATION_ROWS / sizes[x])))])
    picked = rows.filter(F.pmod(F.xxhash64("key", F.lit("calibration")), F.lit(1 << 30)) < F.element_at(rate, F.col("lang")) * F.lit(float(1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(_margins(batch.column(1), weights)), pa.list_(pa.float64()))], names=["lang", "margins"])

    sample = picked.select("lang", "text").mapInArrow(run, "lang string, margins array<double>").limit(4 * CALIBRATION_ROWS * len(languages)).collect()
    by_lang = [np.array([r["margins"] for r in sample if r["lang"] == x]).reshape(-1, bits) for x in languages]
    mean = np.array([m.mean(axis=0) if len(m) else codes[k] * 0.0 for k, m in enumerate(by_lang)])
    for b in range(bits):
        high, low = mean[codes[:, b] > 0, b].mean(), mean[codes[:, b] < 0, b].mean()
        model.threshold[b] = (high + low) / 2
        model.scale[b] = max((high - low) / 2, 1e-6)
    right = np.array([((m - model.threshold) * codes[k] > 0).mean(axis=0) if len(m) else np.full(bits, 0.5) for k, m in enumerate(by_lang)])
    trust = np.maximum(right - 0.5, 1e-3)
    model.trust = trust / trust.sum(axis=1, keepdims=True)
    return model


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest language, score, lead over the second nearest) by weighted exponential loss."""
    z = np.clip((margins - model.threshold) / model.scale, -4, 4)
    loss = (np.exp(-model.codes[None, :, :] * z[:, None, :]) * model.trust[None, :, :]).sum(axis=2)
    like = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
    like /= like.sum(axis=1, keepdims=True)
    best = like.argmax(axis=1)
    ordered = np.sort(like, axis=1)
    lead = ordered[:, -1] - (ordered[:, -2] if like.shape[1] > 1 else 0.0)
    return best, ordered[:, -1], lead


def _predictor(shared):
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    @F.arrow_udf("struct<lang:string, score:double, ambiguous:boolean>")
    def predict(text: pa.Array) -> pa.Array:
        model = shared.value
        best, score, lead = decode(model, _margins(text, model.weights))
        return pa.StructArray.from_arrays([pa.array([model.languages[k] for k in best], pa.string()), pa.array(score),
                                           pa.array(lead < AMBIGUOUS_LEAD)], fields=list(kind))

    return predict


def predict(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The predicted language of ``docs[text]``: struct of lang, score (0 to 1) and ambiguous."""
    none = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    if not model.languages:
        return none
    text = F.col(text).cast("string")
    found = _predictor(docs.sparkSession.sparkContext.broadcast(model))(F.lower(text))
    return F.when(text.rlike(r"\p{L}"), found).otherwise(none)
