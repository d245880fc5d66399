"""Toxicity scores from a factorization machine over hashed terms.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

x_i says whether hashed term i occurs in the text; terms are the lower-cased words and
their first ``PREFIXES`` bytes, so inflected forms share evidence. The factors let a pair of terms
count although neither does alone, which additive weights miss.

The machine is fitted on a bounded sample: about ``SAMPLE_PER_CLASS`` labelled rows of
each class, drawn by the hash of their id over all labels (a document labelled more than once
counts once, as toxic if any label says so). Only the sample's hashed terms, not its texts, reach the
driver. Of 2^``HASH_BITS`` buckets those that tell the classes apart alone (chi-square
above ``MIN_CHI2``, strongest ``MAX_TERMS``) and those that do in a pair (the pair's toxic rates differ from what its
terms add up to; ``PAIR_CHI2`` allows for the number of pairs) are fitted first. Then all terms of the sample get weights and factors, so
that terms that matter only in pairs are learned too; a fifth of the sample, left out of a trial fit, says for how many
passes that makes unseen texts more likely (none, if not clearly so). Scoring reads every whole text.

Defined results: NULL and empty texts score as texts without any known term; repeated
rows get equal scores; without labels of both classes every score is the share
of toxic labels in the sample (0 without any); an empty table gives an empty result. Only ``doc_id`` and ``text``, and
``doc_id`` and the label of the labels, are read, so further columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_bytes
from .decontaminate import BREAK, CHUNK_BYTES, WORD

SAMPLE_PER_CLASS = 4000
HASH_BITS = 20
PREFIXES = (4, 6)
MAX_TERMS = 4096
MIN_CHI2 = 10.8
PAIR_CHI2 = 40.0
PAIR_BLOCK = 2048
FACTORS = 8
EPOCHS = 20
SHOWN = 0.75
LEAST_STEPS = 1500
BATCH = 128
RATE, DECAY = 0.2, 1e-4
PAIR_RATE, PAIR_DECAY = 0.01, 1e-3
# Terms that do not tell alone start with smaller steps, so that rare ones do not take over what the others explain.
CALM = 1e-4
TRIAL = 5


@dataclass
class Model:
    slot: np.ndarray     # bucket -> row of w and v, -1 for buckets without weight
    bias: float
    w: np.ndarray
    v: np.ndarray


def buckets(text: bytes) -> np.ndarray:
    """The distinct hashed terms of a lower-cased text."""
    terms: set[bytes] = set()
    at = 0
    while at < len(text):
        cut = BREAK.search(text, at + CHUNK_BYTES) if at + CHUNK_BYTES < len(text) else None
        end = cut.start() if cut else len(text)
        terms.update(WORD.findall(text, at, end))
        at = end
    mask, crc = (1 << HASH_BITS) - 1, zlib.crc32
    hashed = [crc(t) & mask for t in terms]
    for size in PREFIXES:
        hashed += [crc(t, size) & mask for t in {t[:size] for t in terms if len(t) > size}]
    return np.unique(np.array(hashed, np.int32))


def _rows(slot: np.ndarray, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(weight rows, first position of each text) of texts' buckets; every text gets a leading dummy row -1."""
    known = [np.concatenate(([-1], (k := slot[b])[k >= 0])) for b in found]
    lens = np.fromiter(map(len, known), np.int64, len(known))
    return np.concatenate(known) if known else np.zeros(0, np.int64), np.cumsum(lens) - lens


def _raw(model: Model, rows: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(machine output, factor sums) per text; row -1 is the zero row at the end of w and v."""
    v = model.v[rows]
    sums = np.add.reduceat(v, begin, axis=0)
    squares = np.add.reduceat((v * v).sum(axis=1), begin)
    return model.bias + np.add.reduceat(model.w[rows], begin) + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _loss(model: Model, found: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """The log loss of every text, classes weighing the same."""
    p = np.clip(_sigmoid(_raw(model, *_rows(model.slot, found))[0]), 1e-6, 1 - 1e-6)
    n, pos = len(label), max(int(label.sum()), 1)
    return np.where(label == 1, -np.log(p) / pos, -np.log(1 - p) / max(n - pos, 1)) * n / 2


def _telling(found: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """The buckets that tell the classes apart, alone or in a pair."""
    n, pos = len(label), int(label.sum())
    in_pos, in_neg = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    for b, y in zip(found, label):
        (in_pos if y else in_neg)[b] += 1
    a, c, total = in_pos, in_neg, in_pos + in_neg
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = np.nan_to_num(n * (a * (n - pos - c) - c * (pos - a)) ** 2 / (total * (n - total) * pos * (n - pos)))
    picked = np.argsort(-chi2, kind="stable")[:MAX_TERMS]
    picked = picked[chi2[picked] > MIN_CHI2]
    # A pair cannot reach PAIR_CHI2 through a term that occurs (or is missing) less often than this.
    often = np.flatnonzero(np.minimum(total, n - total) >= PAIR_CHI2 * 4 * pos * (n - pos) / (n * n))
    return np.append(picked, np.setdiff1d(_paired(found, label, often), picked))


def _paired(found: list[np.ndarray], label: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The buckets of ``often`` in a pair whose interaction p11 - p10 - p01 + p00 of toxic rates is not chance."""
    n, rate, size = len(label), label.mean(), len(often)
    place = np.full(1 << HASH_BITS, -1, np.int32)
    place[often] = np.arange(size)
    cols = [(k := place[b])[k >= 0] for b in found]
    text, col = np.repeat(np.arange(n), list(map(len, cols))), np.concatenate(cols)
    order = np.argsort(col, kind="stable")
    text, col = text[order], col[order]
    count = np.bincount(col, minlength=size).astype(np.float32)
    toxic = np.bincount(col, label[text], size).astype(np.float32)

    def block(at: int) -> np.ndarray:
        a, b = np.searchsorted(col, (at, at + PAIR_BLOCK))
        out = np.zeros((n, min(PAIR_BLOCK, size - at)), np.float32)
        out[text[a:b], col[a:b] - at] = 1
        return out

    is_toxic, hit = np.flatnonzero(label == 1), np.zeros(size, bool)
    for i in range(0, size, PAIR_BLOCK):
        x = block(i)
        for j in range(i, size, PAIR_BLOCK):
            y = block(j) if j > i else x
            n11, t11 = x.T @ y, x[is_toxic].T @ y[is_toxic]
            ni, nj, ti, tj = (v[o:o + PAIR_BLOCK] for v in (count, toxic) for o in (i, j))
            diff, var = np.zeros_like(n11), np.zeros_like(n11)
            for sign, m, t in ((1, n11, t11), (-1, ni[:, None] - n11, ti[:, None] - t11), (-1, nj - n11, tj - t11),
                               (1, n - ni[:, None] - nj + n11, label.sum() - ti[:, None] - tj + t11)):
                p = (t + rate) / (m + 1)
                diff += sign * p
                var += np.maximum(rate * (1 - rate), p * (1 - p)) / (m + 1)
            strong = diff * diff > PAIR_CHI2 * var
            hit[i:i + len(ni)] |= strong.any(axis=1)
            hit[j:j + len(nj)] |= strong.any(axis=0)
    return often[hit]


def train(found: list[np.ndarray], label: np.ndarray, seed: int = 7) -> Model:
    """Fit by mini-batch gradient steps with per-weight step sizes; classes weigh the same."""
    n, pos = len(label), int(label.sum())
    if pos in (0, n):
        return Model(np.full(1 << HASH_BITS, -1, np.int32), 30.0 if n and pos == n else -30.0, np.zeros(1), np.zeros((1, FACTORS)))
    out = np.zeros(n, bool)
    for y in (0, 1):
        of = np.random.default_rng(seed).permutation(np.flatnonzero(label == y))
        out[of[:len(of) // TRIAL]] = True
    wide = 0
    if min(label[out].sum(), (1 - label[out]).sum()) > 0:
        seen, losses = [b for b, o in zip(found, out) if o], []

        def worse(model: Model) -> bool:
            losses.append(_loss(model, seen, label[out]))
            return _clearly_less(min(losses, key=np.mean), losses[-1])

        _fit([b for b, o in zip(found, out) if not o], label[~out], seed, None, worse)
        best = int(np.argmin([x.mean() for x in losses]))
        wide = best if _clearly_less(losses[best], losses[0]) else 0
    return _fit(found, label, seed, wide)


def _clearly_less(a: np.ndarray, b: np.ndarray) -> bool:
    return bool((b - a).mean() > 2 * (b - a).std() / np.sqrt(len(a)))


def _fit(found: list[np.ndarray], label: np.ndarray, seed: int, wide: int | None, stop: Callable[[Model], bool] = lambda m: False) -> Model:
    """Fit the telling terms, then all terms for ``wide`` passes (None: as many as the telling ones got); ``stop`` sees
    the model before the first and after each of these and may end them."""
    n, pos = len(label), int(label.sum())
    picked = _telling(found, label)
    told = len(picked)
    slot = np.full(1 << HASH_BITS, -1, np.int32)
    slot[picked] = np.arange(told)
    rng = np.random.default_rng(seed)
    model = Model(slot, 0.0, np.zeros(told + 1), np.vstack([rng.normal(0, 0.01, (told, FACTORS)), np.zeros((1, FACTORS))]))
    # A text without any telling term is clean: empty texts stand for them in the fit.
    blank = max(1, n // 20)
    found, label, n = [*found, *[np.zeros(0, np.int32)] * blank], np.append(label, np.zeros(blank, label.dtype)), n + blank
    weight = np.where(label == 1, n / (2 * pos), n / (2 * (n - pos)))
    seen_w, seen_v, seen_b = np.full(told + 1, 1e-8), np.full((told + 1, FACTORS), 1e-8), 1e-8
    batches = -(-n // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    for epoch in range(epochs + (epochs if wide is None else wide)):
        if epoch == epochs:
            stop(model)
            # From here on every term of the sample has a row.
            slot = slot.copy()
            rest = np.setdiff1d(np.unique(np.concatenate(found)), picked)
            slot[rest] = told + np.arange(len(rest))
            model = Model(slot, model.bias, np.append(model.w[:-1], np.zeros(len(rest) + 1)),
                          np.vstack([model.v[:-1], rng.normal(0, 0.01, (len(rest), FACTORS)), np.zeros((1, FACTORS))]))
            seen_w = np.append(seen_w[:-1], np.full(len(rest) + 1, CALM))
            seen_v = np.vstack([seen_v[:-1], np.full((len(rest) + 1, FACTORS), CALM)])
        # Single terms first: pairs then learn only what the terms alone leave unexplained.
        pairs = epoch >= epochs // 2
        for part in np.array_split(rng.permutation(n), batches):
            # Hiding some terms at random keeps a text from leaning on all of its terms together.
            rows, begin = _rows(slot, [b[rng.random(len(b)) < SHOWN] for b in (found[k] for k in part)])
            raw, sums = _raw(model, rows, begin)
            step = (_sigmoid(raw) - label[part]) * weight[part] / len(part)
            each = np.repeat(step, np.diff(np.append(begin, len(rows))))
            of = np.repeat(np.arange(len(part)), np.diff(np.append(begin, len(rows))))
            # Only rows of the batch change: sorted by row, each row's share is one stretch.
            order = np.argsort(rows, kind="stable")
            at = np.flatnonzero(np.diff(rows[order], prepend=-2))
            u = rows[order][at]
            gw = np.add.reduceat(each[order], at) + DECAY * model.w[u]
            gw[u < 0], gb = 0.0, step.sum()
            seen_w[u] += gw * gw
            seen_b += gb * gb
            model.w[u] -= RATE * gw / np.sqrt(seen_w[u])
            model.bias -= RATE * gb / np.sqrt(seen_b)
            if pairs:
                gv = np.add.reduceat((each[:, None] * (sums[of] - model.v[rows]))[order], at) + PAIR_DECAY * model.v[u]
                gv[u < 0] = 0.0
                seen_v[u] += gv * gv
                model.v[u] -= PAIR_RATE * gv / np.sqrt(seen_v[u])
        if epoch >= epochs and stop(model):
            break
    return model


def _lower(text: Column | str) -> Column:
    return F.lower((F.col(text) if isinstance(text, str) else text).cast("string"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on a sample of the given labels; the caller has left out the labels that must not be learned."""
    once = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y")))
    sizes = {r["y"]: r["n"] for r in once.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect() if r["y"] in (0, 1)}
    rate = F.when(F.col("y") == 1, min(1.0, sample_per_class / sizes.get(1, 1))).otherwise(min(1.0, sample_per_class / sizes.get(0, 1)))
    drawn = once.filter(F.col("y").isin(0, 1) & (F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) < rate * F.lit(float(1 << 30))))
    # The draw is about twice sample_per_class rows of two numbers, and the limit makes that a bound.
    drawn = drawn.limit(4 * sample_per_class)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), _lower("text").alias("text"))
            .join(F.broadcast(drawn), "doc_id").select("y", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([buckets(t).tobytes() for t in text_bytes(batch.column(1))], pa.binary())], names=["y", "found"])

    sample = rows.mapInArrow(run, "y int, found binary").limit(4 * sample_per_class).collect()
    return train([np.frombuffer(r["found"], np.int32) for r in sample], np.array([r["y"] for r in sample], np.int64))


def predict(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The probability that a text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(col: pa.Array) -> pa.Array:
        m = shared.value
        rows, begin = _rows(m.slot, [buckets(t) for t in text_bytes(col)])
        return pa.array(_sigmoid(_raw(m, rows, begin)[0]) if len(begin) else np.zeros(0))

    return score(_lower(text))
