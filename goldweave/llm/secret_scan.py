"""Secret scan by a battery of randomness tests.

A candidate is a run of token characters in which the alphabet of an encoding
(hexadecimal, base 32, base 36, base 62 or base 64) is inferred. Three tests
ask how its symbols would look if they were drawn evenly from that alphabet:
a chi-squared test of their frequencies, a runs test about the alphabet's
middle, and the serial correlation of neighbours. Ordinary words fail them;
keys pass. Passing alone says little about a short run, so each candidate also
gets a p-value under the opposite hypothesis, ordinary text: the ratio of its
likelihood as ordinary text to that as random symbols bounds how often
ordinary text of that length looks so random. Ordinary text is a chain of
symbols whose shares are counted in the corpus itself. These p-values, which
need length to become small, go through a Benjamini-Hochberg step over all
candidates of the corpus.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Symbols of the encodings, the narrowest first.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
# Usual shares of letters in running text, in per mille.
LETTER_SHARES = {
    "a": 82, "b": 15, "c": 28, "d": 43, "e": 127, "f": 22, "g": 20, "h": 61, "i": 70, "j": 2, "k": 8, "l": 40, "m": 24,
    "n": 67, "o": 75, "p": 19, "q": 1, "r": 60, "s": 63, "t": 91, "u": 28, "v": 10, "w": 24, "x": 2, "y": 20, "z": 1,
}


# Symbols a candidate may hold; the place in this text numbers them.
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"


@dataclass(frozen=True)
class Settings:
    """Every run of at least ``shortest`` token characters is a candidate.

    ``passing`` is the smallest combined p-value of the three tests it may
    have, ``fdr`` the accepted share of false finds. ``prior`` is how many
    symbols after each symbol the fixed letter shares count for next to those
    counted in the corpus.
    """

    shortest: int = 12
    passing: float = 1e-3
    fdr: float = 0.01
    prior: int = 2000
    bins: int = 120


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of assignments, access keys and long hexadecimal runs of a whole text."""
    spans = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    return spans + [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]


def _upper_gamma(x: float, df: int) -> float:
    """Probability that a chi-squared variable of df degrees exceeds x (Wilson and Hilferty)."""
    if x <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str, encoding: str) -> tuple[float, float, float]:
    """p-values of frequencies, runs and serial correlation for symbols drawn evenly from the encoding's alphabet."""
    alphabet = ALPHABETS[encoding]
    values = [alphabet.index(c) for c in token.rstrip("=")]
    n, size = len(values), len(alphabet)
    # Neighbouring symbols share a cell so that a cell expects two at least.
    cells = max(2, min(size, n // 2))
    seen = Counter(v * cells // size for v in values)
    widths = Counter(v * cells // size for v in range(size))
    chi = sum((seen[c] - n * w / size) ** 2 / (n * w / size) for c, w in widths.items())
    high = [v * 2 >= size for v in values]
    ones = sum(high)
    zeros = n - ones
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    if ones and zeros and n > 2:
        mean = 1 + 2 * ones * zeros / n
        spread = math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
        p_runs = math.erfc(abs(runs - mean) / spread / math.sqrt(2))
    else:
        p_runs = 2.0 ** (1 - n)
    middle = (size - 1) / 2
    power = (size * size - 1) / 12
    serial = sum((a - middle) * (b - middle) for a, b in zip(values, values[1:])) / (power * math.sqrt(n - 1))
    return _upper_gamma(chi, cells - 1), min(1.0, p_runs), math.erfc(abs(serial) / math.sqrt(2))


def combined(p_values: tuple[float, ...]) -> float:
    """Fisher's combination of independent p-values."""
    half = -sum(math.log(max(p, 1e-300)) for p in p_values)
    term, total = 1.0, 0.0
    for k in range(len(p_values)):
        total += term
        term *= half / (k + 1)
    return min(1.0, math.exp(-half) * total)


def _shares():
    """Shares of the symbols in ordinary identifiers and words: mostly lower-case letters; capitals, digits and joints now and then."""
    import numpy as np

    total = sum(LETTER_SHARES.values())
    share = {c: 0.80 * s / total for c, s in LETTER_SHARES.items()} | {c.upper(): 0.10 * s / total for c, s in LETTER_SHARES.items()}
    return np.array([share.get(c, 0.06 / 10 if c.isdigit() else 0.04 / 4) for c in SYMBOLS])


@lru_cache(1)
def _tables():
    """Symbol number of each byte, -1 for none; for each encoding the symbols it lacks, and the log of its size."""
    import numpy as np

    number = np.full(256, -1, np.int8)
    number[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
    lacks = np.array([[c not in alphabet for c in SYMBOLS] for alphabet in ALPHABETS.values()])
    return number, lacks, np.log([len(alphabet) for alphabet in ALPHABETS.values()])


def _bytes(texts):
    """Bytes of an Arrow column of texts and the first byte of each; nulls are empty."""
    import numpy as np
    import pyarrow as pa

    column = pa.array(texts).cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _pairs(data, starts):
    """Symbols, and the symbol before each in the same run (the number of symbols if there is none)."""
    import numpy as np

    symbol = _tables()[0][data].astype(np.int64)
    before = np.empty_like(symbol)
    before[1:], before[:1] = symbol[:-1], -1
    before[starts[starts < len(symbol)]] = -1
    before[before < 0] = len(SYMBOLS)
    return symbol, before


def symbol_pairs(docs: DataFrame, *, text_column: str = "text") -> DataFrame:
    """(pair, n): how often each symbol follows each, or begins a run, in all texts; at most 67 x 66 rows."""
    size = len(SYMBOLS)

    def count(batches):
        import numpy as np
        import pyarrow as pa

        n = np.zeros((size + 1) * size, np.int64)
        for batch in batches:
            data, offsets = _bytes(batch.column(0))
            symbol, before = _pairs(data, offsets[:-1])
            some = symbol >= 0
            n += np.bincount(before[some] * size + symbol[some], minlength=len(n))
        pair = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(pair, pa.int32()), "n": pa.array(n[pair], pa.int64())})

    return docs.select(text_column).mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def ordinary_logs(pairs: DataFrame, cfg: Settings) -> Any:
    """Log share of each symbol behind each symbol, or at a run's start, in ordinary text."""
    import numpy as np

    size = len(SYMBOLS)
    n = np.zeros((size + 1) * size)
    for row in pairs.collect():  # bounded by the pairs of symbols
        n[row["pair"]] = row["n"]
    n = n.reshape(size + 1, size)
    shares = (n.sum(0) + cfg.prior * _shares()) / (n.sum() + cfg.prior)
    return np.log((n + cfg.prior * shares) / (n.sum(1, keepdims=True) + cfg.prior))


def candidates(data, starts, logs, cfg: Settings):
    """(start, stop, encoding number, log p as ordinary text) of every run that is long enough, as arrays; places are bytes.

    Under the ordinary model the ratio of the random to the ordinary likelihood
    has mean 1, so it exceeds 1/p with probability p at most. A run of digits
    or of one character repeated carries no surprise beyond its first symbol.
    """
    import numpy as np

    _, lacks, log_sizes = _tables()
    symbol, before = _pairs(data, starts)
    inside = symbol >= 0
    opens = inside & (before == len(SYMBOLS))
    run_starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    run_stops = np.flatnonzero(closes) + 1
    long = run_stops - run_starts >= cfg.shortest
    run_starts, run_stops = run_starts[long], run_stops[long]
    if not len(run_starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0),)
    # Only the bytes of candidates from here on, one run behind the other.
    length = run_stops - run_starts
    first = np.cumsum(length) - length
    at = np.repeat(run_starts - first, length) + np.arange(length.sum())
    here, back = symbol[at], before[at]
    digit = len(SYMBOLS) - 14  # where the digits begin
    both = (here >= digit) & (here < digit + 10) & (back >= digit) & (back < digit + 10)
    again = (back == here) | (both & ((here - back == 0) | (here - back == 1)))
    value = logs[back, here]
    total = np.add.reduceat(np.where(again, np.maximum(value, math.log(0.5)), value), first)
    encoding = np.full(len(length), -1)
    for number in reversed(range(len(lacks))):
        fits = ~np.logical_or.reduceat(lacks[number][here], first)
        encoding[fits] = number
    some = encoding >= 0
    # A token drawn from one alphabet out of several: the choice is paid for once.
    log_p = np.minimum(0.0, total[some] + length[some] * log_sizes[encoding[some]] + math.log(len(ALPHABETS)))
    return run_starts[some], run_stops[some], encoding[some], log_p


SCANNED = "struct<base:array<struct<start:int,stop:int,kind:string>>,n_candidates:int,tested:array<struct<start:int,stop:int,encoding:string,p_random:double,log_p:double>>>"


def tested(docs: DataFrame, logs: Any, cfg: Settings, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, base, n_candidates, tested): base spans, the number of candidates, and with all p-values those that can be accepted at all.

    No false-discovery step accepts a p-value above its rate, so the battery only runs for the others.
    """
    names, rate = list(ALPHABETS), math.log(cfg.fdr)

    @F.arrow_udf(SCANNED)
    def scan(texts):
        import numpy as np
        import pyarrow as pa

        data, offsets = _bytes(texts)
        starts, stops, encodings, log_p = candidates(data, offsets[:-1], logs, cfg)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        numbers = np.bincount(owner, minlength=len(texts))
        found: dict[int, list] = {}
        for i in np.flatnonzero(log_p <= rate):
            found.setdefault(int(owner[i]), []).append(i)
        rows = []
        for row, text in enumerate(texts.to_pylist()):
            listed, seen, place = [], 0, int(offsets[row])
            for i in found.get(row, ()):
                seen += len(data[place:starts[i]].tobytes().decode())  # code points up to the run
                place = int(starts[i])
                token = data[place:stops[i]].tobytes().decode()
                encoding = names[encodings[i]]
                listed.append({"start": seen, "stop": seen + len(token), "encoding": encoding, "p_random": combined(battery(token, encoding)), "log_p": float(log_p[i])})
            rows.append({"base": [dict(zip(("start", "stop", "kind"), s)) for s in base_spans(text or "")], "n_candidates": int(numbers[row]), "tested": listed})
        place, span = [("start", pa.int32()), ("stop", pa.int32())], pa.list_
        return pa.array(rows, pa.struct([
            ("base", span(pa.struct([*place, ("kind", pa.string())]))), ("n_candidates", pa.int32()),
            ("tested", span(pa.struct([*place, ("encoding", pa.string()), ("p_random", pa.float64()), ("log_p", pa.float64())]))),
        ]))

    return docs.select(F.col(id_column).alias("doc_id"), scan(F.col(text_column)).alias("s")).select("doc_id", "s.base", "s.n_candidates", "s.tested")


def accepted_limit(counts: dict[int, int], total: int, fdr: float) -> float:
    """Largest log p-value that the Benjamini-Hochberg step accepts among ``total`` values, counted in half units of -log p; minus infinity if none.

    A value stands for its bin's upper end, so the step is never laxer than on the values themselves.
    """
    accepted, limit = 0, -math.inf
    for b in sorted(counts, reverse=True):
        accepted += counts[b]
        if math.exp(-b / 2) * total <= fdr * accepted:
            limit = -b / 2
    return limit


def false_discovery_limit(scored: DataFrame, cfg: Settings) -> float:
    """Largest log p-value that is accepted over all documents; p-values are counted in at most ``bins`` bins."""
    number = F.least(F.floor(-F.col("c.log_p") * 2), F.lit(cfg.bins - 1)).cast("int").alias("bin")
    counts = {r["bin"]: r["n"] for r in scored.select(F.explode("tested").alias("c")).groupBy(number).agg(F.count(F.lit(1)).alias("n")).collect()}
    return accepted_limit(counts, scored.agg(F.sum("n_candidates")).first()[0] or 0, cfg.fdr)


def scan_secrets(docs: DataFrame, scratch: Any, cfg: Settings = Settings(), *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, spans): per document its spans (start, stop, kind, encoding, p_random, log_p), by start, then in the order of ``KINDS``.

    The base kinds are found by pattern; kind ``random`` are candidates that
    pass the battery and the false-discovery step and lie in no base span.
    Starts and stops count code points. A null text is an empty one and has no
    spans; a text of any length is read whole; repeated rows get equal spans,
    and each counts as candidates of its own; empty input gives an empty
    result; extra columns are left out.
    """
    logs = ordinary_logs(symbol_pairs(docs, text_column=text_column), cfg)
    stored = scratch.save(tested(docs, logs, cfg, id_column=id_column, text_column=text_column), "tested")
    limit = false_discovery_limit(stored, cfg)
    none, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    base = F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("place"), s["stop"].alias("stop"),
        s["kind"].alias("kind"), none.alias("encoding"), number.alias("p_random"), number.alias("log_p")))
    passed = F.filter("tested", lambda c: (c["p_random"] >= cfg.passing) & (c["log_p"] <= F.lit(limit)) & ~F.exists(
        F.col("base"), lambda s: (s["start"] < c["stop"]) & (c["start"] < s["stop"])))
    added = F.transform(passed, lambda c: F.struct(
        c["start"].alias("start"), F.lit(len(KINDS)).cast("long").alias("place"), c["stop"].alias("stop"), F.lit("random").alias("kind"),
        c["encoding"].alias("encoding"), c["p_random"].alias("p_random"), c["log_p"].alias("log_p")))
    return stored.select("doc_id", F.array_sort(F.concat(base, added)).alias("spans"))
