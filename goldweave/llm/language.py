"""Language of words and texts by a linear-chain conditional random field.

States are languages. A word's score for a language is the sum of learned
weights of its affixes, its character n-grams and the word itself (the
lexicon); learned transitions tie neighbours together. Forward-backward gives
each word of code-switched text its distribution over languages.

A position of a chain is a word; a long one, such as a compound, is cut into
several positions, and so is a run in a script that sets no blanks between
words. Texts are worked through in pieces, whose transfer matrices carry the
messages from one to the next, so the pieces leave no trace in the result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldweave.llm.common import sieve

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
# Letters of one position at most, and of one in a script without blanks: Thai, Lao, Burmese, Khmer, Japanese and Chinese.
WIDTH, DENSE_WIDTH = 24, 2
_DENSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")


@dataclass(frozen=True)
class Settings:
    """``rows`` bounds the labelled documents of each language the model is fitted on, ``chars`` the characters of each that it is shown.

    Texts are worked through ``chain`` positions at a time; only the fit depends on it.
    """

    rows: int = 400
    chars: int = 50_000
    slots: int = 1 << 16
    chain: int = 32
    batch: int = 2048
    epochs: int = 3
    rate: float = 0.1
    l2: float = 1e-6
    seed: int = 5


@dataclass(frozen=True)
class Field:
    langs: list[str]
    emission: Any
    transition: Any
    start: Any
    slots: int
    chain: int


def positions(text: str) -> list[str]:
    """The chain's positions of a whole text: its words in lower case, long ones and those of dense scripts in parts."""
    words = _WORD.findall(text.lower())
    if any(len(w) > WIDTH for w in words) or _DENSE.search(text):
        sized = [(w, DENSE_WIDTH if _DENSE.search(w) else WIDTH) for w in words]
        words = [w[i:i + size] for w, size in sized for i in range(0, len(w), size)]
    return [w for w in words if w.isalpha() or any(map(str.isalpha, w))]


def features(words: list[str], slots: int):
    """Slots of each position's features, 0 where it has fewer: n-grams of two and three characters, affixes of one to four, the whole."""
    import numpy as np

    width, short = WIDTH, words

    def matrix(texts):
        return np.array([f"<{t}>" for t in texts], dtype=f"<U{width + 2}").view(np.uint32).reshape(len(texts), width + 2).astype(np.uint64)

    def slot(hashes, kind):
        mixed = (hashes + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(40)) % np.uint64(slots - 1) + np.uint64(1)).astype(np.int32)

    step = np.uint64(1_000_003)
    forward, backward = matrix(short), matrix([t[::-1] for t in short])
    found = []
    with np.errstate(over="ignore"):
        for n in (2, 3):
            h = forward[:, : width + 3 - n]
            for k in range(1, n):
                h = h * step + forward[:, k:width + 3 - n + k]
            found.append(np.where(forward[:, n - 1:] > 0, slot(h, n), 0))
        for kind, side in ((10, forward), (20, backward)):
            h = side[:, 0]
            for k in range(1, 5):
                h = h * step + side[:, k]
                found.append(np.where(side[:, k] > 0, slot(h, kind + k), 0)[:, None])
        whole = np.zeros(len(short), np.uint64)
        for k in range(width + 2):
            whole = whole * step + forward[:, k]
        found.append(slot(whole, 30)[:, None])
    return np.concatenate(found, 1)


def posteriors(scores, lengths, transition, start):
    """Forward-backward over padded chains.

    scores: (chain, position, state); returns the states' probabilities at each
    position, the scaled forward and backward factors for pair counts, and the
    log-likelihood of the chains' normalisers.
    """
    import numpy as np

    n, span, states = scores.shape
    peak = scores.max(2, keepdims=True)
    e = np.exp(scores - peak)
    move = np.exp(transition)
    forward, backward = np.zeros_like(e), np.ones_like(e)
    a = e[:, 0] * np.exp(start)
    forward[:, 0] = a / a.sum(1, keepdims=True)
    for t in range(1, span):
        a = (forward[:, t - 1] @ move) * e[:, t]
        forward[:, t] = a / a.sum(1, keepdims=True)
    for t in range(span - 2, -1, -1):
        b = (e[:, t + 1] * backward[:, t + 1]) @ move.T
        inside = (t + 1 < lengths)[:, None]
        backward[:, t] = np.where(inside, b / b.sum(1, keepdims=True), 1.0)
    p = forward * backward
    return p / p.sum(2, keepdims=True), forward, backward, e


def text_posteriors(scores, sizes, transition, start, chain: int):
    """Probabilities of the states at every position of whole texts, exact for any ``chain``.

    scores: (position, state) of all texts in a row, ``sizes`` positions each.
    Texts are cut into pieces. A piece's transfer matrix says how messages
    pass through it; carried from piece to piece they give each piece the
    messages from before and behind it, and then all pieces are worked at once.
    """
    import numpy as np

    states = scores.shape[1]
    runs = -(-sizes // chain)
    first = np.cumsum(sizes) - sizes
    first_run = np.cumsum(runs) - runs
    order = np.arange(runs.sum()) - np.repeat(first_run, runs)
    begin = np.repeat(first, runs) + chain * order
    lengths = np.minimum(np.repeat(first + sizes, runs) - begin, chain)
    move = np.exp(transition)
    slabs = [slice(at, at + 4096) for at in range(0, len(begin), 4096)]

    def factors(slab):
        b, n = begin[slab], lengths[slab]
        inside = np.arange(n.max()) < n[:, None]
        place = np.where(inside, b[:, None] + np.arange(n.max()), 0)
        e = scores[place]
        return np.exp(e - e.max(2, keepdims=True)), inside, place

    # Messages into each piece; the first piece of a text starts with the start weights and makes no move.
    opening = order == 0
    into = np.tile(np.exp(start), (len(begin), 1))
    after = np.ones((len(begin), states))
    if runs.max(initial=0) > 1:
        transfer = np.empty((len(begin), states, states))
        for slab in slabs:
            e, inside, _ = factors(slab)
            matrix = np.tile(np.eye(states), (len(e), 1, 1))
            for t in range(e.shape[1]):
                moved = matrix @ move
                if t == 0:
                    moved = np.where(opening[slab][:, None, None], matrix, moved)
                moved *= e[:, t, None, :]
                moved /= moved.sum((1, 2), keepdims=True)
                matrix = np.where(inside[:, t, None, None], moved, matrix)
            transfer[slab] = matrix
        for j in range(1, int(runs.max())):
            at = (first_run + j)[runs > j]
            u = np.einsum("ns,nst->nt", into[at - 1], transfer[at - 1])
            into[at] = u / u.sum(1, keepdims=True)
        for j in range(int(runs.max()) - 1, 0, -1):
            at = (first_run + j)[runs > j]
            u = np.einsum("nst,nt->ns", transfer[at], after[at])
            after[at - 1] = u / u.sum(1, keepdims=True)

    out = np.empty_like(scores)
    for slab in slabs:
        e, inside, place = factors(slab)
        span, last = e.shape[1], lengths[slab] - 1
        forward, backward = np.empty_like(e), np.empty_like(e)
        a = np.where(opening[slab][:, None], into[slab], into[slab] @ move) * e[:, 0]
        forward[:, 0] = a / a.sum(1, keepdims=True)
        for t in range(1, span):
            a = (forward[:, t - 1] @ move) * e[:, t]
            forward[:, t] = a / a.sum(1, keepdims=True)
        back = after[slab]
        for t in range(span - 1, -1, -1):
            if t + 1 < span:
                b = (e[:, t + 1] * backward[:, t + 1]) @ move.T
                back = np.where((t < last)[:, None], b / b.sum(1, keepdims=True), after[slab])
            backward[:, t] = back
        p = forward * backward
        out[place[inside]] = (p / p.sum(2, keepdims=True))[inside]
    return out


def training_rows(
    docs: DataFrame, cfg: Settings, *, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
) -> DataFrame:
    """(lang, text) of at most ``rows`` documents of each language, those with the smallest hash of their id and text.

    Null languages and texts do not count; a null id is one like others; rows
    equal in language, id and text count once, so ties do not occur but by a
    collision of hashes. Which documents these are is found by hash in many
    parts of each language; only their texts are shuffled.
    """
    keyed = docs.filter(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(lang_column).alias("lang"), F.col(id_column).alias("id"), F.col(text_column).alias("text"),
    ).withColumn("pick", F.xxhash64("id", "text"))
    place = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy("pick"))
    distinct = keyed.select("lang", "pick").distinct()
    some = distinct.withColumn("part", F.pmod("pick", F.lit(64))).withColumn("n", place("part")).filter(F.col("n") <= cfg.rows)
    picked = some.withColumn("n", place()).filter(F.col("n") <= cfg.rows).select("lang", "pick")
    near, _ = sieve(keyed, F.col("pick"), picked.select("pick"))
    return near.join(picked, ["lang", "pick"]).dropDuplicates(["lang", "pick"]).select("lang", F.substring("text", 1, cfg.chars).alias("text"))


def fit(rows: DataFrame, cfg: Settings) -> Field:
    """Fits the field on a bounded frame of (lang, text) by mini-batches of the conditional log-likelihood.

    Every second chain is put together from two documents, so that switches
    are seen as well as runs. Without rows no language is known.
    """
    import numpy as np

    table = sorted((r["lang"], r["text"]) for r in rows.collect())
    langs = sorted({lang for lang, _ in table})
    k, index = len(langs), {lang: i for i, lang in enumerate(langs)}
    if not langs:
        return Field([], np.zeros((cfg.slots, 0)), np.zeros((0, 0)), np.zeros(0), cfg.slots, cfg.chain)
    rng = np.random.default_rng(cfg.seed)
    vocabulary: dict[str, int] = {}
    runs = []
    for lang, text in table:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in positions(text)]
        runs += [(index[lang], ids[i:i + cfg.chain]) for i in range(0, len(ids), cfg.chain)]
    rng.shuffle(runs)
    chains, states = np.full((len(runs), cfg.chain), -1), np.zeros((len(runs), cfg.chain), int)
    for i, (lang, ids) in enumerate(runs):
        other = runs[i - 1] if i % 2 else (lang, [])
        half = len(ids) // 2 if other[1] else len(ids)
        mixed = ids[:half] + other[1][: cfg.chain - half]
        chains[i, :len(mixed)] = mixed
        states[i, :half], states[i, half:] = lang, other[0]
    slots = features(list(vocabulary), cfg.slots)
    emission, transition, start = np.zeros((cfg.slots, k)), np.zeros((k, k)), np.zeros(k)
    seen = [np.full_like(w, 1e-2) for w in (emission, transition, start)]
    for _ in range(cfg.epochs):
        order = rng.permutation(len(runs))
        for b in range(0, len(runs), cfg.batch):
            part = order[b:b + cfg.batch]
            words, y = chains[part], states[part]
            inside = words >= 0
            lengths = inside.sum(1)
            used, local = np.unique(words[inside], return_inverse=True)
            table_scores = emission[slots[used]].sum(1)
            scores = np.zeros((*words.shape, k))
            scores[inside] = table_scores[local]
            p, forward, backward, e = posteriors(scores, lengths, transition, start)
            truth = np.eye(k)[y]
            delta = (truth - p) * inside[:, :, None]
            by_word = np.stack([np.bincount(local, delta[inside][:, s], len(used)) for s in range(k)], 1)
            flat = slots[used].ravel()
            g_emission = np.stack([np.bincount(flat, np.repeat(by_word[:, s], slots.shape[1]), cfg.slots) for s in range(k)], 1)
            g_emission[0] = 0
            both = inside[:, 1:]
            pair = forward[:, :-1, :, None] * np.exp(transition) * (e * backward)[:, 1:, None, :]
            pair /= pair.sum((2, 3), keepdims=True)
            g_transition = np.einsum("nta,ntb->ab", truth[:, :-1] * both[:, :, None], truth[:, 1:]) - (pair * both[:, :, None, None]).sum((0, 1))
            g_start = (delta[:, 0] * (lengths > 0)[:, None]).sum(0)
            for weight, gradient, total in zip((emission, transition, start), (g_emission, g_transition, g_start), seen):
                gradient = gradient / len(part) - cfg.l2 * weight
                total += gradient**2
                weight += cfg.rate * gradient / np.sqrt(total)
    return Field(langs, emission, transition, start, cfg.slots, cfg.chain)


class _Labeller:
    """Word scores a worker remembers, at most ``limit`` words and those of one batch."""

    limit = 200_000

    def __init__(self, field: Field):
        self.field = field
        self.ids: dict[str, int] = {}
        self.scores = None

    def scores_of(self, lists: list[list[str]]):
        import numpy as np

        if len(self.ids) > self.limit:
            self.ids, self.scores = {}, None
        new = list(set().union(*lists).difference(self.ids))
        if new:
            got = np.zeros((len(new), len(self.field.langs)))
            for at in range(0, len(new), 8192):
                part = new[at:at + 8192]
                slots = features(part, self.field.slots)
                for j in range(slots.shape[1]):
                    got[at:at + len(part)] += self.field.emission[slots[:, j]]
            base = len(self.ids)
            self.ids.update(zip(new, range(base, base + len(new))))
            self.scores = got if self.scores is None else np.concatenate([self.scores, got])
        get = self.ids.__getitem__
        return self.scores[np.fromiter((i for words in lists for i in map(get, words)), np.int64)]

    def label(self, texts: list[str | None]):
        """(row of each word, probabilities of each word's languages, word lists)."""
        import numpy as np

        f = self.field
        lists = [positions(t) if t else [] for t in texts]
        sizes = np.array([len(words) for words in lists])
        rows = np.repeat(np.arange(len(texts)), sizes)
        if not f.langs or not len(rows):
            return rows, np.zeros((len(rows), len(f.langs))), lists
        return rows, text_posteriors(self.scores_of(lists), sizes, f.transition, f.start, f.chain), lists


_labellers: dict[int, _Labeller] = {}


def _labeller(shared) -> _Labeller:
    if shared.id not in _labellers:
        _labellers.clear()
        _labellers[shared.id] = _Labeller(shared.value)
    return _labellers[shared.id]


class _Shared:
    def __init__(self, broadcast, key: str):
        self.broadcast, self.id = broadcast, key

    @property
    def value(self):
        return self.broadcast.value


def _share(docs: DataFrame, field: Field) -> _Shared:
    import uuid

    return _Shared(docs.sparkSession.sparkContext.broadcast(field), uuid.uuid4().hex)  # slots x languages numbers, whatever the corpus


def identified(docs: DataFrame, field: Field, *, text_column: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score: the language most of the words' probability goes to, and its share of it.

    A null text, one without letters, and any text of a field fitted on no
    rows is ``und`` with score 0. Texts are read whole, however long they or
    their words are. Ties go to the language first in the alphabet. Repeated
    rows get equal results; empty input gives an empty result; columns of
    these names are replaced, and one named __lang is not kept.
    """
    shared = _share(docs, field)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def identify(texts):
        import numpy as np
        import pyarrow as pa

        worker = _labeller(shared)
        langs = worker.field.langs
        rows, p, _ = worker.label(texts.to_pylist())
        n = len(texts)
        words = np.bincount(rows, minlength=n)
        if not langs:
            return pa.StructArray.from_arrays([pa.array([UNKNOWN] * n), pa.array(np.zeros(n))], ["lang_pred", "score"])
        total = np.stack([np.bincount(rows, p[:, s], n) for s in range(len(langs))], 1)
        best = total.argmax(1)
        share = np.where(words > 0, total[np.arange(n), best] / np.maximum(words, 1), 0.0)
        names = [langs[b] if w else UNKNOWN for b, w in zip(best, words)]
        return pa.StructArray.from_arrays([pa.array(names), pa.array(np.clip(share, 0, 1))], ["lang_pred", "score"])

    return docs.withColumn("__lang", identify(F.col(text_column))).withColumns({
        "lang_pred": F.col("__lang.lang_pred"), "score": F.col("__lang.score"),
    }).drop("__lang")


def word_languages(docs: DataFrame, field: Field, *, text_column: str = "text") -> DataFrame:
    """``docs`` with words: the text's positions in order, each with its likeliest language and that one's probability.

    Positions are words, or parts of them (:func:`positions`), all of them in
    texts of any length. A null or empty text has none; for a field fitted on
    no rows each is ``und`` with probability 0. Repeated rows get equal
    results; empty input gives an empty result; a column named words is
    replaced.
    """
    shared = _share(docs, field)

    @F.arrow_udf("array<struct<word:string,lang:string,p:double>>")
    def label(texts):
        import numpy as np
        import pyarrow as pa

        worker = _labeller(shared)
        langs = worker.field.langs
        rows, p, lists = worker.label(texts.to_pylist())
        names = [langs[b] for b in p.argmax(1)] if langs else [UNKNOWN] * len(rows)
        best = p.max(1) if langs else np.zeros(len(rows))
        offsets = np.concatenate([[0], np.cumsum([len(words) for words in lists])])
        flat = pa.StructArray.from_arrays(
            [pa.array([w for words in lists for w in words], pa.string()), pa.array(names, pa.string()), pa.array(best)], ["word", "lang", "p"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)

    return docs.withColumn("words", label(F.col(text_column)))
