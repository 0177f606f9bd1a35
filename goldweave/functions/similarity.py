"""Jaro-Winkler similarity: an Arrow-batched column function and its upper bound in built-in functions."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

# Fixed values of the Winkler variant: boost only above this Jaro score, weight per shared leading character.
BOOST_ABOVE = 0.7
PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4

_CHUNK_CELLS = 250_000

# Ships the UDF with its helpers, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _codepoints(values: list[str], width: int) -> np.ndarray:
    return np.array(values, dtype=f"U{width}").view(np.uint32).reshape(len(values), width)


def _jaro_winkler_block(left: list[str], right: list[str]) -> np.ndarray:
    len_a = np.fromiter(map(len, left), np.int64, len(left))
    len_b = np.fromiter(map(len, right), np.int64, len(right))
    return _jaro_winkler_codes(_codepoints(left, int(len_a.max())), _codepoints(right, int(len_b.max())), len_a, len_b)


def _jaro_winkler_codes(a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray) -> np.ndarray:
    """Similarity of texts given as rows of code points and lengths."""
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)

    if max(a.shape[1], b.shape[1]) <= 64:
        hit_a, hit_b = _common_in_words(a, b, len_a, len_b, reach)
    else:
        hit_a, hit_b = _common(a, b, len_a, len_b, reach)

    matches = hit_a.sum(axis=1)
    # A row has as many common characters on either side, so the lists of both sides run in step.
    swaps = np.bincount(np.nonzero(hit_a)[0], a[hit_a] != b[hit_b], len(a)).astype(np.int64) // 2

    m = np.maximum(matches, 1)
    jaro = (m / np.maximum(len_a, 1) + m / np.maximum(len_b, 1) + (m - swaps) / m) / 3.0
    jaro = np.where(matches == 0, 0.0, jaro)

    width = min(PREFIX_LENGTH, a.shape[1], b.shape[1])
    alike = (a[:, :width] == b[:, :width]) & (a[:, :width] != 0)
    prefix = np.cumprod(alike, axis=1).sum(axis=1)
    return np.where(jaro > BOOST_ABOVE, jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro), jaro)


def _common_in_words(a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_common` of texts of 64 characters at most: the free places of a text are the bits of one word."""
    one, width = np.uint64(1), b.shape[1]
    free = (one << np.minimum(len_b, 63).astype(np.uint64)) - one
    free[len_b == 64] = ~np.uint64(0)
    before = free.copy()
    hit_a = np.zeros(a.shape, dtype=bool)
    packed = np.zeros((len(a), 8), dtype=np.uint8)
    for i in range(a.shape[1]):
        same = np.packbits(b == a[:, i, None], axis=1, bitorder="little")
        packed[:, :same.shape[1]] = same
        lo, hi = np.maximum(i - reach, 0).astype(np.uint64), np.minimum(i + reach, 63).astype(np.uint64)
        # Shifting the two highest bits out of the word leaves 0 - 1, which is all bits.
        near = ((np.uint64(2) << hi) - one) & ~((one << lo) - one)
        found = packed.view("<u8")[:, 0] & free & near
        found[i >= len_a] = 0
        first = found & (~found + one)
        free ^= first
        hit_a[:, i] = first != 0
    used = (before ^ free).astype("<u8")
    hit_b = np.unpackbits(used.view(np.uint8).reshape(-1, 8), axis=1, count=width, bitorder="little").astype(bool)
    return hit_a, hit_b


def _common(a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which characters of either side have a partner: each takes the first free equal one in reach."""
    rows, cols_b = np.arange(len(a)), np.arange(b.shape[1])
    free_b = cols_b[None, :] < len_b[:, None]
    hit_a = np.zeros(a.shape, dtype=bool)
    widest = int(reach.max())
    for i in range(a.shape[1]):
        lo, hi = max(0, i - widest), min(b.shape[1], i + widest + 1)
        if lo >= hi:
            break
        near = np.abs(cols_b[lo:hi] - i)[None, :] <= reach[:, None]
        same = free_b[:, lo:hi] & near & (b[:, lo:hi] == a[:, i, None]) & (i < len_a)[:, None]
        first = same.argmax(axis=1)
        found = same[rows, first]
        hit_a[:, i] = found
        free_b[rows[found], first[found] + lo] = False
    return hit_a, (cols_b[None, :] < len_b[:, None]) & ~free_b


def jaro_winkler_array(left: list[str], right: list[str]) -> np.ndarray:
    """Similarity of each (left, right) pair; 0.0 where either text is empty or missing.

    Pairs are ordered by length and cut into blocks of bounded size, so a few
    very long texts do not widen every row of the batch.
    """
    out = np.zeros(len(left))
    width = np.fromiter(
        ((max(len(x), len(y)) if x and y else 0) for x, y in zip(left, right)), np.int64, len(left)
    )
    order = np.argsort(width, kind="stable")
    order = order[width[order] > 0]
    start = 0
    while start < len(order):
        stop = start + 1
        limit = min(len(order), start + max(1, _CHUNK_CELLS // int(width[order[start]])))
        stop = limit
        while stop > start + 1 and (stop - start) * int(width[order[stop - 1]]) > _CHUNK_CELLS:
            stop = start + max(1, (stop - start) // 2)
        pick = order[start:stop]
        out[pick] = _jaro_winkler_block([left[k] for k in pick], [right[k] for k in pick])
        start = stop
    return out


# Longest text whose code points are held for a whole cell, and words of a set of characters there.
_HELD_LENGTH, _MASK_WORDS = 64, 2


def _rows_compared(left: list[str], right: list[str]):
    """What pairs of rows need of a text: their similarities as a function of row numbers, and the sets of characters of either side.

    A text is taken apart once and not for each pair. The (character,
    occurrence) tokens that these rows have get bits of their own as far as
    the words of a set go, the most frequent ones first.
    """
    len_a, len_b = (np.fromiter(map(len, texts), np.int64, len(texts)) for texts in (left, right))
    width = max(1, int(len_a.max()), int(len_b.max()))
    if width > _HELD_LENGTH:
        a, b = (np.array(texts, dtype=object) for texts in (left, right))
        masks = [char_mask_array(texts).view(np.uint64)[None, :] for texts in (left, right)]
        return lambda i, j: jaro_winkler_array(a[i].tolist(), b[j].tolist()), *masks
    a, b, some = _codepoints(left, width), _codepoints(right, width), _CHUNK_CELLS // width

    def similarity(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i))
        for start in range(0, len(i), some):
            x, y = i[start:start + some], j[start:start + some]
            out[start:start + some] = _jaro_winkler_codes(a[x], b[y], len_a[x], len_b[y])
        return out

    chars, nth = _occurrences(np.concatenate([a, b]))
    tokens = chars.astype(np.int64) * (_HELD_LENGTH + 1) + nth
    known, place, times = np.unique(np.where(chars != 0, tokens, -1), return_inverse=True, return_counts=True)
    rank = np.empty(len(known), np.int64)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(known))
    bits = 64 * _MASK_WORDS
    bit = np.where(rank < bits, rank, bits - 64 + rank % 64)[place.reshape(chars.shape)]
    masks = np.stack([
        np.bitwise_or.reduce(np.where((chars != 0) & (bit // 64 == word), np.uint64(1) << (bit % 64).astype(np.uint64), np.uint64(0)), axis=1)
        for word in range(_MASK_WORDS)])
    return similarity, masks[:, :len(a)], masks[:, len(a):]


def _occurrences(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters of each row in order, and how many equal ones stand before each."""
    chars = np.sort(codes, axis=1)
    place = np.broadcast_to(np.arange(chars.shape[1]), chars.shape)
    begins = np.ones(chars.shape, dtype=bool)
    begins[:, 1:] = chars[:, 1:] != chars[:, :-1]
    return chars, place - np.maximum.accumulate(np.where(begins, place, 0), axis=1)


@F.pandas_udf(DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity of two text columns, one Arrow batch at a time."""
    return pd.Series(jaro_winkler_array(left.fillna("").tolist(), right.fillna("").tolist()))


def weighted_similarity(name_weight: float, address_weight: float, threshold: float, binarize: float | None = None):
    """Arrow function of a pair's names, addresses, best possible address similarity and place score: its total score.

    Names are compared first and addresses only where the total can still
    reach ``threshold``; other pairs get -1. It must run once a pair, so it is
    marked as not repeatable, which keeps filters above it.
    """
    total = _total_score(name_weight, address_weight, threshold, binarize)

    def score(
        name_a: pd.Series, name_b: pd.Series, address_a: pd.Series, address_b: pd.Series, address_best: pd.Series, place: pd.Series,
    ) -> pd.Series:
        alike = lambda a, b: jaro_winkler_array(a.fillna("").tolist(), b.fillna("").tolist())
        return pd.Series(total(alike(name_a, name_b), lambda k: alike(address_a.iloc[k], address_b.iloc[k]), address_best.to_numpy(), place.to_numpy()))

    return F.pandas_udf(score, DoubleType()).asNondeterministic()


def _total_score(name_weight: float, address_weight: float, threshold: float, binarize: float | None):
    """Function of pairs' name similarities, address similarities by position, best possible ones and place scores: total scores, -1 where below the threshold."""
    graded = lambda values: values if binarize is None else (values >= binarize).astype(float)

    def total(name, address_at, address_best, place):
        base = graded(name) * name_weight + place
        left = np.flatnonzero(base + address_best * address_weight >= threshold - 1e-9)
        out = np.full(len(base), -1.0)
        out[left] = base[left] + graded(address_at(left)) * address_weight
        return out

    return total


# Pairs whose bounds are held at once: few enough to stay in a core's cache.
_STRIP_PAIRS = 1 << 16

# Pairs that are scored in one go.
_SCORED_PAIRS = 1 << 17


def matched_in_cell(columns: list[str], name_weight: float, address_weight: float, city_weight: float, postal_weight: float, threshold: float,
                    binarize: float | None = None):
    """Arrow function of the two sides of a cell: its cross-source pairs that reach ``threshold``, as (l, r, raw).

    Every pair costs a count of shared characters, compared with the least
    count with which names of their lengths can do. That takes names for
    different from the first character on and places for equal in the block's
    key only; the pairs that share more meet again among their like, under the
    whole bound of :func:`jaro_winkler_bound`. What passes is scored in large
    batches, so that no pair pays for a call.
    """
    import pyarrow as pa

    total = _total_score(name_weight, address_weight, threshold, binarize)
    graded = lambda best: best if binarize is None else (best >= binarize - 1e-5).astype(best.dtype)

    def bound(a, b, kind, text, i, j):
        """Bound of rows ``i`` against rows ``j``, which broadcast to the shape of the result."""
        shared = sum(np.bitwise_count(x[i] & y[j]) for x, y in zip(a[f"{text}_mask"], b[f"{text}_mask"]))
        spare = np.minimum(a[f"{text}_spare"][i], b[f"{text}_spare"][j])
        best = (shared + spare).astype(kind) * (a[f"{text}_share"].astype(kind)[i] + b[f"{text}_share"].astype(kind)[j]) + kind(1 / 3)
        boost = np.zeros(best.shape, kind)
        for prefix, step in ((1, 1), (2, 2), (4, 1)):
            boost += (a[f"{text}_p{prefix}"][i] == b[f"{text}_p{prefix}"][j]) * kind(step * PREFIX_WEIGHT)
        return graded(best + boost * (1 - best))

    def side(table):
        out = {c: table[c].to_numpy() for c in ("city_hash", "source_rank")}
        out["postal"] = table["postal_hash"].to_numpy()
        out["placed"] = table["postal_code"].is_valid().to_numpy()
        for text in ("name", "address"):
            out[f"{text}_size"] = table[f"{text}_size"].to_numpy()
            out[f"{text}_share"] = table[f"{text}_share"].to_numpy()
            out |= {f"{text}_p{k}": table[f"{text}_p{k}"].to_numpy() for k in (1, 2, 4)}
        for c in ("city_key", "postal_code", "name_key", "address_key"):
            out[c] = table[c].to_numpy(zero_copy_only=False)
        return out

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if left.num_rows and right.num_rows:
            a, b = side(left), side(right)
            kind = left["place_kind"][0].as_py()
            alike = {}
            for text in ("name", "address"):
                alike[text], a[f"{text}_mask"], b[f"{text}_mask"] = _rows_compared(a[f"{text}_key"].tolist(), b[f"{text}_key"].tolist())
                for rows in (a, b):
                    rows[f"{text}_spare"] = (rows[f"{text}_size"] - np.bitwise_count(rows[f"{text}_mask"]).sum(axis=0)).astype(np.int32)
            for rank in np.unique(a["source_rank"]):
                mine, theirs = np.flatnonzero(a["source_rank"] == rank), np.flatnonzero(b["source_rank"] > rank)
                if len(theirs):
                    found += [scored(a, b, alike, i, j, kind == "postal") for i, j in in_batches(candidates(a, b, mine, theirs, kind))]
        i, j, raw = (np.concatenate(part) for part in zip(*found))
        return pa.table({"l": left.select(columns).take(i).to_struct_array(), "r": right.select(columns).take(j).to_struct_array(), "raw": raw})

    def candidates(a, b, mine, theirs, kind):
        """(i, j) of the pairs that may reach the threshold, each once: with what they have in common beyond the block's key, or for lack of it."""
        alike = ["name_p1"]
        if kind != "postal":  # in there, all agree on it
            alike.append("postal")
        if kind == "state":  # pairs of one city meet in the block of the city where there is one
            alike.append("city_hash")

        def others(i, j, keys):
            """Which pairs differ in all of the keys."""
            keep = np.ones(len(i), bool)
            for key in keys:
                keep &= (a[key][i] != b[key][j]) | (~a["placed"][i] if key == "postal" else False)
            return i[keep], j[keep]

        for i, j in by_count(a, b, mine, theirs, {"city": city_weight, "postal": postal_weight}.get(kind, 0.0)):
            yield others(i, j, alike)
        for n, key in enumerate(alike):
            for i, j in of_alike(a, b, mine[a["placed"][mine]] if key == "postal" else mine, theirs, key):
                yield others(i, j, alike[:n])

    def by_count(a, b, mine, theirs, place):
        """Pairs with enough characters in common, of names that start differently."""
        wanted = threshold - address_weight - place - 1e-5
        wanted = wanted / name_weight if name_weight else np.inf if wanted > 0 else 0.0
        if binarize is not None and 0 < wanted <= 1:
            wanted = binarize - 1e-5
        elif binarize is not None and wanted > 1:
            wanted = np.inf
        traits, kind_of = np.unique(np.stack([a["name_spare"][mine], a["name_share"][mine].astype(np.float64)]), axis=1, return_inverse=True)
        kind_of = kind_of.reshape(-1)
        spare = np.minimum(traits[0][:, None], b["name_spare"][theirs][None, :])
        share = traits[1][:, None] + b["name_share"][theirs][None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(share > 0, (wanted - 1 / 3) / share - spare, np.where(wanted <= 1 / 3, 0.0, np.inf))
        least = np.clip(np.ceil(needed - 1e-6), 0, 255).astype(np.uint8)
        deep, ours, others = max(1, _STRIP_PAIRS // len(theirs)), a["name_mask"][:, mine, None], b["name_mask"][:, None, theirs]
        both, shared, more = (np.empty((deep, len(theirs)), kind) for kind in (np.uint64, np.uint8, np.uint8))
        for start in range(0, len(mine), deep):
            rows = min(deep, len(mine) - start)
            for word in range(len(ours)):
                np.bitwise_and(ours[word, start:start + rows], others[word], out=both[:rows])
                np.bitwise_count(both[:rows], out=(more if word else shared)[:rows])
                if word:
                    shared[:rows] += more[:rows]
            row, column = np.divmod(np.flatnonzero(shared[:rows] >= least[kind_of[start:start + rows]]), len(theirs))
            yield mine[start + row], theirs[column]

    def of_alike(a, b, mine, theirs, key):
        """Pairs of rows that agree on ``key`` and may reach the threshold, by the whole bound of the names."""
        mine, theirs = (rows[np.argsort(values[key][rows], kind="stable")] for rows, values in ((mine, a), (theirs, b)))
        ours, others = a[key][mine], b[key][theirs]
        first, last = np.searchsorted(others, ours, "left"), np.searchsorted(others, ours, "right")
        ends = np.cumsum(last - first)
        start = 0
        while start < len(mine):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _STRIP_PAIRS, "right")))
            sizes = (last - first)[start:stop]
            i = np.repeat(mine[start:stop], sizes)
            if len(i):
                within = np.arange(len(i)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                j = theirs[np.repeat(first[start:stop], sizes) + within]
                best = bound(a, b, np.float64, "name", i, j) * name_weight
                best += ((a["postal"][i] == b["postal"][j]) & a["placed"][i]) * postal_weight
                best += (a["city_hash"][i] == b["city_hash"][j]) * city_weight
                keep = best >= threshold - address_weight - 1e-5
                yield i[keep], j[keep]
            start = stop

    def in_batches(pairs):
        """The pairs of many strips as few large arrays."""
        held, size = [], 0
        for i, j in pairs:
            held.append((i, j))
            size += len(i)
            if size >= _SCORED_PAIRS:
                yield tuple(map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield tuple(map(np.concatenate, zip(*held)))

    def scored(a, b, alike, i, j, once):
        place = (a["city_hash"][i] == b["city_hash"][j]) * city_weight + ((a["postal"][i] == b["postal"][j]) & a["placed"][i]) * postal_weight
        address = bound(a, b, np.float64, "address", i, j)
        best = bound(a, b, np.float64, "name", i, j) * name_weight + address * address_weight + place
        keep = np.flatnonzero(best >= threshold - 1e-5)
        same_city = a["city_key"][i[keep]] == b["city_key"][j[keep]]
        if once:
            keep, same_city = keep[~same_city], same_city[~same_city]
        i, j, address = i[keep], j[keep], address[keep]
        same_postal = (a["postal_code"][i] == b["postal_code"][j]) & a["placed"][i]
        place = same_city.astype(float) * city_weight + same_postal.astype(float) * postal_weight
        raw = total(alike["name"](i, j), lambda k: alike["address"](i[k], j[k]), address, place)
        good = np.flatnonzero(raw >= threshold - 1e-9)
        return i[good], j[good], raw[good]

    return match


def char_mask_array(texts: list[str]) -> np.ndarray:
    """64-bit set of the (character, occurrence) tokens of each text; 0 for an empty one."""
    out = np.zeros(len(texts), dtype=np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    start = 0
    while start < len(order):
        stop = min(len(order), start + max(1, _CHUNK_CELLS // int(sizes[order[start]])))
        while stop > start + 1 and (stop - start) * int(sizes[order[stop - 1]]) > _CHUNK_CELLS:
            stop = start + max(1, (stop - start) // 2)
        pick = order[start:stop]
        width = int(sizes[order[stop - 1]])
        chars, nth = _occurrences(_codepoints([texts[k] for k in pick], width))
        token = chars.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + nth.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        bits = np.where(chars != 0, np.uint64(1) << (token >> np.uint64(58)), np.uint64(0))
        out[pick] = np.bitwise_or.reduce(bits, axis=1)
        start = stop
    return out.view(np.int64)


@F.pandas_udf(LongType())
def char_mask(text: pd.Series) -> pd.Series:
    """64-bit set of the (character, occurrence) tokens of a text.

    A bit set on one side only proves at least one character without a partner
    there, whatever collides, so the mask gives a safe bound on shared characters.
    """
    return pd.Series(char_mask_array(text.fillna("").tolist()))


def bound_traits(text: str, name: str) -> dict[str, Column]:
    """Columns of one text that :func:`jaro_winkler_bound` compares: mask, length and hashed prefixes."""
    return {f"{name}_mask": char_mask(text), **native_traits(text, name)}


def native_traits(text: str, name: str) -> dict[str, Column]:
    """Those of :func:`bound_traits` that built-in functions make: length and hashed prefixes."""
    size = F.length(text)
    return {
        f"{name}_size": size,
        f"{name}_share": F.when(size > 0, 1.0 / (3.0 * size)).otherwise(0.0),
        **{f"{name}_p{k}": F.hash(F.substring(text, 1, k)) for k in (1, 2, 4)},
    }


def jaro_winkler_bound(name: str) -> str:
    """SQL expression over sides ``l`` and ``r`` that is never below the similarity of two texts.

    Only arithmetic on the traits of :func:`bound_traits`, so it runs inside
    the generated code of a join. Characters without a partner lower the
    number of matches; a shared prefix is read off the prefix hashes.
    """
    c = lambda side, trait: f"{side}.{name}_{trait}"
    matches = " , ".join(
        f"{c(a, 'size')} - bit_count({c(a, 'mask')} & ~{c(b, 'mask')})" for a, b in (("l", "r"), ("r", "l"))
    )
    jaro = f"(least({matches}) * ({c('l', 'share')} + {c('r', 'share')}) + {1 / 3!r}D)"
    same = lambda k: f"{c('l', f'p{k}')} = {c('r', f'p{k}')}"
    step = PREFIX_WEIGHT
    boost = f"IF({same(1)}, IF({same(2)}, IF({same(4)}, {4 * step}D, {round(3 * step, 10)}D), {step}D), 0D)"
    return f"({jaro} * (1D - {boost}) + {boost})"
