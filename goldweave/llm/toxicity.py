"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(bias + sum of w_i + sum over pairs of <v_i, v_j>) over the
distinct terms of a text. The pair part lets two harmless terms weigh together,
such as an insult next to the mention of a group.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.llm.common import alnum_words


@dataclass(frozen=True)
class Settings:
    """``rows`` bounds the labelled rows the model is fitted on, and so what the driver holds.

    Terms in fewer than ``min_docs`` of them carry no weight of their own, nor
    do terms in less than a share ``common`` of them whose number of toxic rows
    is within ``away`` standard deviations of what chance gives. Which terms
    weigh in pairs does not depend on that: pairs of terms in a share
    ``pair_share`` of the rows each are compared with what the terms alone
    predict, and enter from ``pair_away`` deviations on. A share ``held_back``
    of the rows sets the scale of the score, so that 0.5 is the right cut.
    """

    rows: int = 12_000
    slots: int = 1 << 18
    factors: int = 8
    min_docs: int = 4
    away: float = 5.0
    common: float = 0.2
    pair_share: float = 0.01
    pair_away: float = 7.0
    held_back: float = 0.2
    steps: int = 100
    l2: float = 3.0
    seed: int = 17


@dataclass(frozen=True)
class Machine:
    """Weights of the known slots, sorted by slot; at most the distinct terms of the fitted rows."""

    slots: Any
    bias: float
    linear: Any
    pairs: Any
    n_slots: int


def term_slots(text: Column, slots: int) -> Column:
    """Distinct hashed terms of a whole text; none for a null text."""
    return F.array_distinct(F.transform(alnum_words(text), lambda w: F.pmod(F.xxhash64(w), F.lit(slots)).cast("int")))


def training_rows(
    docs: DataFrame, labels: DataFrame, cfg: Settings, *, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
) -> DataFrame:
    """(label, slots) of at most ``rows`` labelled documents, those with the smallest hash of their id.

    Labels other than 0 and 1 and null ids do not count. An id that occurs
    several times, on either side, gives a row for each pair; ties of the hash
    go by id, label and terms.
    """
    order = F.xxhash64("_id")
    known = labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("label")).filter("label IN (0, 1) AND _id IS NOT NULL")
    picked = known.orderBy(order, "_id", "label").limit(cfg.rows)
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).join(picked, "_id")
    hashed = texts.select("_id", "label", term_slots(F.col("_text"), cfg.slots).alias("slots"))
    return hashed.orderBy(order, "_id", "label", F.xxhash64("slots")).limit(cfg.rows).select("label", "slots")


def _margin(np, rows, at, n, bias, linear, pairs):
    """Log-odds of each row; the vectors of its terms and their sum."""
    v = pairs[at]
    total = np.stack([np.bincount(rows, v[:, f], n) for f in range(v.shape[1])], 1) if v.shape[1] else np.zeros((n, 0))
    pair = 0.5 * ((total**2).sum(1) - np.bincount(rows, (v * v).sum(1), n))
    return bias + np.bincount(rows, linear[at], n) + pair, v, total


def _probability(np, z):
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _lowest(np, loss, x, steps):
    """Minimum of a smooth function (value, gradient) by limited-memory BFGS."""
    value, slope = loss(x)
    past: list = []
    for _ in range(steps):
        step, factors = slope.copy(), []
        for s, y in reversed(past):
            factors.append((s @ step) / (y @ s))
            step -= factors[-1] * y
        step *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.linalg.norm(slope))
        for (s, y), factor in zip(past, reversed(factors)):
            step += (factor - (y @ step) / (y @ s)) * s
        size = 1.0
        while size > 1e-8:
            moved, (new, new_slope) = x - size * step, loss(x - size * step)
            if new <= value - 1e-4 * size * (slope @ step):
                break
            size /= 2
        else:
            break
        if (moved - x) @ (new_slope - slope) > 1e-12:
            past = [*past[-7:], (moved - x, new_slope - slope)]
        small = value - new <= 1e-7 * abs(value)
        x, value, slope = moved, new, new_slope
        if small:
            break
    return x


def _weights(np, y, doc, at, weighs, meets, start, cfg):
    """Bias, linear weights and pair vectors that fit the rows; only terms that ``weighs`` or ``meets`` mark have any."""
    n, terms, factors = len(y), len(weighs), cfg.factors
    own, vectors = np.flatnonzero(weighs), np.flatnonzero(meets)
    mine, theirs = weighs[at], meets[at]
    own_at, own_doc = (np.cumsum(weighs) - 1)[at[mine]], doc[mine]
    pair_at, pair_doc = (np.cumsum(meets) - 1)[at[theirs]], doc[theirs]

    def loss(x):
        w, v = x[1:1 + len(own)], x[1 + len(own):].reshape(len(vectors), factors)
        pair, each, total = _margin(np, pair_doc, pair_at, n, 0.0, np.zeros(len(vectors)), v)
        z = x[0] + np.bincount(own_doc, w[own_at], n) + pair
        error = _probability(np, z) - y
        left = error[pair_doc, None] * (total[pair_doc] - each)
        slopes = np.stack([np.bincount(pair_at, left[:, f], len(vectors)) for f in range(factors)], 1)
        return (np.logaddexp(0, z) - y * z).sum() + cfg.l2 / 2 * (x[1:] @ x[1:]), np.concatenate([
            [error.sum()], np.bincount(own_at, error[own_doc], len(own)) + cfg.l2 * w, (slopes + cfg.l2 * v).ravel()])

    bias, linear, pairs = start
    x = _lowest(np, loss, np.concatenate([[bias], linear[own], pairs[vectors].ravel()]), cfg.steps)
    linear, pairs = np.zeros(terms), np.zeros((terms, factors))
    linear[own], pairs[vectors] = x[1:1 + len(own)], x[1 + len(own):].reshape(len(vectors), factors)
    return x[0], linear, pairs


def _meeting(np, y, expected, doc, at, seen, cfg):
    """Vectors for the terms of pairs that are toxic together more, or less, often than the terms alone predict; zero for all others.

    Terms are compared a block of columns at a time, so that memory grows with
    their number, not with its square.
    """
    n, wide, deep = len(y), 512, 1024
    often = np.flatnonzero(seen >= max(cfg.min_docs, cfg.pair_share * n))
    place = np.full(len(seen), -1)
    place[often] = np.arange(len(often))
    here = place[at] >= 0
    column, row = place[at[here]], doc[here]
    starts = np.searchsorted(row, np.arange(0, n + deep, deep))
    found = []
    for c in range(0, len(often), wide):
        end = min(c + wide, len(often))
        met, foreseen = (np.zeros((end, end - c), np.float32) for _ in range(2))
        for k, b in enumerate(range(0, n, deep)):
            part = slice(starts[k], starts[k + 1])
            x = np.zeros((min(deep, n - b), end), np.float32)
            inside = column[part] < end
            x[row[part][inside] - b, column[part][inside]] = 1
            toxic = x[y[b:b + deep] > 0]
            met += toxic.T @ toxic[:, c:]
            foreseen += x.T @ (x[:, c:] * expected[b:b + deep, None].astype(np.float32))
        strength = (met - foreseen) / np.sqrt(np.maximum(foreseen, 1))
        i, j = np.nonzero(np.abs(strength) >= cfg.pair_away)
        found.append(np.stack([i, j + c, strength[i, j]], 1)[i < j + c])
    pairs = np.zeros((len(seen), cfg.factors))
    listed = np.concatenate(found) if found else np.zeros((0, 3))
    if len(listed):
        used, local = np.unique(listed[:, :2].astype(int), return_inverse=True)
        a, b = local.reshape(-1, 2).T
        wanted = np.zeros((len(used), len(used)))
        wanted[a, b] = wanted[b, a] = np.clip(listed[:, 2], -4, 4)
        scale, direction = np.linalg.eigh(wanted)
        top = np.argsort(-scale)[:cfg.factors]
        pairs[often[used], :len(top)] = direction[:, top] * np.sqrt(np.maximum(scale[top], 0))
        pairs[often[used]] += np.random.default_rng(cfg.seed).normal(0, 0.01, (len(used), cfg.factors))
    return pairs


def _calibrated(np, z, y, steps=50):
    """(scale, shift) that make log-odds fit the labels; no change without both labels."""
    if not 0 < y.sum() < len(y):
        return 1.0, 0.0

    def loss(x):
        fitted = x[0] * z + x[1]
        error = _probability(np, fitted) - y
        return (np.logaddexp(0, fitted) - y * fitted).sum() + 0.5 * (x[0] - 1) ** 2, np.array([error @ z + x[0] - 1, error.sum()])

    scale, shift = _lowest(np, loss, np.array([1.0, 0.0]), steps)
    return (float(scale), float(shift)) if scale > 0 else (1.0, 0.0)


def fit(rows: DataFrame, cfg: Settings) -> Machine:
    """Fits the machine on a bounded frame of (label, slots) by logistic loss.

    First the terms' own weights, then the vectors of pairs whose toxic rows
    these do not explain, with the weights again; last its scale, on rows held
    back. Without labelled rows every score is 0; with one class only, it is
    that class's share.
    """
    import numpy as np

    table = rows.toArrow().combine_chunks()
    y = table["label"].to_numpy().astype(float)
    if not len(y):
        return Machine(np.zeros(0, int), -np.inf, np.zeros(0), np.zeros((0, cfg.factors)), cfg.slots)
    lists = table["slots"].combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    flat, doc = np.asarray(lists.flatten()), np.repeat(np.arange(len(y)), sizes)
    first = len(y) - int(cfg.held_back * len(y))  # rows come in the order of a hash
    cut = int(sizes[:first].sum())
    slots, at, seen = np.unique(flat[:cut], return_inverse=True, return_counts=True)
    fitted, row = y[:first], doc[:cut]
    share = (fitted.sum() + 0.5) / (first + 1)
    # A term in few rows that goes with neither class is noise: summed over a long text it would drown the signal.
    away = (np.bincount(at, fitted[row], len(slots)) - seen * share) / np.sqrt(seen * share * (1 - share))
    weighs = (seen >= cfg.min_docs) & ((np.abs(away) >= cfg.away) | (seen >= cfg.common * first))
    weights = (np.log(share / (1 - share)), np.zeros(len(slots)), np.zeros((len(slots), cfg.factors)))
    if 0 < fitted.sum() < first:
        weights = _weights(np, fitted, row, at, weighs, np.zeros(len(slots), bool), weights, cfg)
        # No pairs yet; looking up their vectors for every term of every row would take most of the driver's memory.
        expected = _probability(np, weights[0] + np.bincount(row, weights[1][at], first))
        pairs = _meeting(np, fitted, expected, row, at, seen, cfg)
        meets = pairs.any(1)
        if meets.any():
            weights = _weights(np, fitted, row, at, weighs | meets, meets, (*weights[:2], pairs), cfg)
    bias, linear, pairs = weights
    known = linear.astype(bool) | pairs.any(1)
    machine = Machine(slots[known], float(bias), linear[known], pairs[known], cfg.slots)
    scale, shift = _calibrated(np, _log_odds(np, machine, flat[cut:], doc[cut:] - first, len(y) - first), y[first:])
    return Machine(machine.slots, scale * machine.bias + shift, scale * machine.linear, scale**0.5 * machine.pairs, cfg.slots)


def _log_odds(np, machine: Machine, flat, row, n):
    """Log-odds of rows given as hashed terms; unknown terms count for nothing."""
    at = np.searchsorted(machine.slots, flat)
    known = at < len(machine.slots)
    known[known] = machine.slots[at[known]] == flat[known]
    return _margin(np, row[known], at[known], n, machine.bias, machine.linear, machine.pairs)[0]


def scored(docs: DataFrame, machine: Machine, *, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every row; a column of that name is replaced.

    A null or empty text, and one without known terms, gets the score of no
    terms; a text of any length is read whole, each distinct term once.
    Repeated rows score alike; empty input gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by the fitted rows, not by the corpus

    @F.arrow_udf("double")
    def score(slots):
        import numpy as np
        import pyarrow as pa

        row = np.repeat(np.arange(len(slots)), np.diff(np.asarray(slots.offsets)))
        z = _log_odds(np, shared.value, np.asarray(slots.flatten()), row, len(slots))
        return pa.array(np.where(np.isneginf(z), 0.0, _probability(np, z)))

    return docs.withColumn(score_column, score(term_slots(F.col(text_column), machine.n_slots)))
