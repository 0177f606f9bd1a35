"""Personal data by pattern and by a linear-chain conditional random field over word shapes.

The field is trained from a small table of labelled lines. It reads the words
around every digit and at sign, labels them by Viterbi, and finds what the
patterns miss, such as numbers without a country code.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweave.llm.language import posteriors

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_EDGES = "\"'<>[]{},;:!?|*"
_RUN = re.compile(r"[A-Z]+|[a-z]+|[0-9]+|[^\x00-\x7F]+")

# The labelled table. A span is written [kind text]; everything else is no personal data.
LABELLED = """
write to [email jan.kerr@mail.example.org] today
contact: [email a_b+news@sub.host.co] or wait
[email office@firm.example.com] answers all mail
ask [email r.lund99@post7.example.net], please
mail [email müller@amt.example.de] for the form
her address is [email k-o@web.example.fr].
the key @ home was lost
follow @handle for more
see you @ 5 pm
host [ip 10.0.3.77] is down
login from [ip 192.168.14.202] failed twice
ping [ip 8.8.4.4] first
the peer [ip 172.16.254.1], port 8080
release 2.4.1 is out
version 10.3.22 fixes this
section 4.3.2.1a of the law
pay with [card 4556 7375 8689 9855] now
card [card 4929-1234-5678-9018] was charged
number [card 5425233430109903] expires soon
[card 3714 496353 98431] was declined
the card [card 6011000990139424] is blocked
order 4817263 has shipped
invoice 2021-00042 is due
isbn 978 3 16 148410 0 is listed
serial 00012345 and 00012346
call [phone +1 (988) 555-2485] after nine
phone [phone +44 20 7946 0958] is busy
dial [phone +49 30 901820] for help
tel. [phone (415) 555-0132] or come by
ring [phone (212) 555-0199] tonight
my number is [phone 555-867-5309] at work
reach us at [phone 202-555-0143], all day
fax [phone 030 901820 11] works too
text [phone 415.555.0177] any time
mobile [phone 0171 2345678] only
on 2021-03-04 we met
at 12:30 on 24.12.2020
between 1998 and 2004 it grew
costs 1,299.00 or 15 percent
about 3.5 million in 1987
room 12 on floor 3
page 117 of 240
0 1 2 3 4 5 6 7 8 9
12 34 56 78 90 11 22
rows 100 200 300 400 500
id 7f3a9c and 88213
| 12 | 4.5 | 3 |
width 1024 height 768
score 3-2 after 90 minutes
the year 2020 had 366 days
mobile [phone 0171 23456789] works best
call [phone 0160 98765432] at night
or under [phone 0176 5551234]
handy: [phone 0152 34567890]
mobil [phone 01577 7654321], please
telephone [phone 089 1234567] or come
phone [phone 07700 900461] after six
cell [phone 310-555-0148] is mine
you can call [phone 646-555-0121] now
phone [phone 202.555.0164] today
tel [phone 01 44 55 66 77] in the morning
call her at [phone (617) 555-0174], she waits
text me on [phone 503 555 0118] later
his number: [phone 04 78 12 34 56]
reach me under [phone 0043 1 5556677]
whatsapp [phone 0171/5550123] is fine
product code 212-555-0199 is sold out
product code 617-555-0101 was recalled
code 503-555-0177 on the box
part number 310-555-0122 fits both
part no 646-555-0199 again
article 202-555-0111 in blue
serial number 415-555-0166 is void
sku 212.555.0144 has moved
ticket 0171 2345678 is closed
order number 0160 98765432 was paid
reference 089 1234567 in the letter
case 0152 34567890 is pending
tracking 503 555 0118 is lost
batch (617) 555-0174 failed
invoice no 4929 1234 5678 9018 is open
lot 310 555 0148 of the stock
account [card 4716 1089 9971 6531] was used
visa [card 4539-5787-6362-1486] please
charge it to [card 5105 1051 0510 5100] then
server [ip 10.12.14.200] answers
from [ip 203.0.113.77] at noon
address [ip 198.51.100.23], twice
build 10.12.14.200b broke
chapter 1.2.3.4.5 is short
email [email kim_lee@uni.example.ac] soon
send it to [email a.roth-7@x1.example.com]; thanks
"""


@dataclass(frozen=True)
class Settings:
    """``near`` words on either side of a digit or at sign belong to its chain."""

    near: int = 3
    slots: int = 1 << 13
    steps: int = 150
    rate: float = 0.1
    l2: float = 0.02


@dataclass(frozen=True)
class Tagger:
    tags: list[str]
    emission: Any
    transition: Any
    start: Any
    cfg: Settings


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def holds(kind: str, text: str) -> bool:
    """Whether a span's text can be of its kind."""
    digits = _digits(text)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)
    return "@" in text and "." in text.rpartition("@")[2]


def _emails(text: str) -> list[tuple[int, int]]:
    """From each at sign back over the characters before it, so that long runs without one cost nothing."""
    spans, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append((start, domain.end()))
            after = domain.end()
        at = text.find("@", max(at + 1, after))
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches in a whole text that hold."""
    spans = [(a, b, "email") for a, b in _emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        spans += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if holds(kind, m[0])]
    return spans


def _shape(token: str) -> tuple[str, str]:
    """Word shape with the lengths of runs, and without."""
    letter = lambda run: "X" if "A" <= run[0] <= "Z" else "x" if "a" <= run[0] <= "z" else "d" if "0" <= run[0] <= "9" else "u"
    sized = _RUN.sub(lambda m: f"{letter(m[0])}{min(len(m[0]), 20)}", token)
    return sized, re.sub(r"(?<=[Xxdu])[0-9]+", "", sized)


def token_slots(token: str, slots: int) -> list[int]:
    """Slots of a token's own features; the tagger adds those of its neighbours."""
    sized, plain = _shape(token)
    digits = sum("0" <= c <= "9" for c in token)
    features = [
        f"s{sized}", f"p{plain}", f"d{min(digits, 12)}", f"l{min(len(token), 16)}", f"a{'@' in token}", f"o{min(token.count('.'), 4)}",
        f"f{token[0] if not token[0].isalnum() else plain[0]}", f"w{token.lower() if token.isalpha() and len(token) < 12 else ''}",
    ]
    return [zlib.crc32(f.encode()) % slots for f in features]


def chains(text: str, near: int) -> list[list[tuple[int, int]]]:
    """(start, end) of the words of each chain: those of a line within ``near`` words of one with a digit or an at sign."""
    found = []
    at = 0
    for line in text.split("\n") if _TRIGGER.search(text) else []:
        if _TRIGGER.search(line):
            places = []
            for m in _TOKEN.finditer(line):
                word = m[0].strip(_EDGES)
                if word:
                    start = at + m.start() + m[0].index(word)
                    places.append((start, start + len(word)))
            last = -1
            for i, (a, b) in enumerate(places):
                if _TRIGGER.search(text, a, b):
                    begin = max(last + 1, i - near)
                    if begin > last + 1 or last < 0 or not found:
                        found.append([])
                    end = min(len(places), i + near + 1)
                    found[-1] += places[max(begin, last + 1):end]
                    last = max(last, end - 1)
        at += len(line) + 1
    return [chain for chain in found if chain]


def chain_slots(words: list[str], slots: int, known: dict) -> list[list[int]]:
    own = []
    for w in words:
        got = known.get(w)
        if got is None:
            got = known[w] = token_slots(w, slots)
        own.append(got)
    edge = [0, 0]
    out = []
    for i, features in enumerate(own):
        before, after = own[i - 1][1:3] if i else edge, own[i + 1][1:3] if i + 1 < len(own) else edge
        word = own[i - 1][-1] if i else 0
        out.append(features + [(x * 31 + 7 + k) % slots for k, x in enumerate([*before, *after, word])])
    return out


def parse_labelled(line: str) -> tuple[list[str], list[str]]:
    """(words, tags) of a labelled line, tags in begin/inside/outside form."""
    words, tags = [], []
    for part in re.split(r"(\[[a-z]+ [^\]]*\])", line):
        if part.startswith("["):
            kind, _, inner = part[1:-1].partition(" ")
            for i, w in enumerate(inner.split()):
                words.append(w)
                tags.append(("B-" if i == 0 else "I-") + kind)
        else:
            for w in part.split():
                w = w.strip(_EDGES)
                if w:
                    words.append(w)
                    tags.append("O")
    return words, tags


def train(lines: list[str] | None = None, cfg: Settings = Settings()) -> Tagger:
    """Fits the field on labelled lines, a table of a page or so, by gradient ascent on its conditional log-likelihood."""
    import numpy as np

    rows = [parse_labelled(line) for line in (lines if lines is not None else LABELLED.strip().split("\n"))]
    rows = [r for r in rows if r[0]]
    tags = ["O", *(f"{b}-{k}" for k in KINDS for b in "BI")]
    k, n, span = len(tags), len(rows), max((len(w) for w, _ in rows), default=1)
    emission, transition, start = np.zeros((cfg.slots, k)), np.zeros((k, k)), np.zeros(k)
    if rows:
        known: dict = {}
        slots = np.zeros((n, span, len(chain_slots(["x"], cfg.slots, known)[0])), int)
        truth, inside = np.zeros((n, span, k)), np.zeros((n, span), bool)
        for i, (words, labels) in enumerate(rows):
            slots[i, :len(words)] = chain_slots(words, cfg.slots, known)
            truth[i, np.arange(len(words)), [tags.index(t) for t in labels]] = 1
            inside[i, :len(words)] = True
        lengths, both = inside.sum(1), inside[:, 1:]
        weights, seen = [emission, transition, start], [np.full_like(w, 1e-3) for w in (emission, transition, start)]
        for _ in range(cfg.steps):
            p, forward, backward, e = posteriors(emission[slots].sum(2), lengths, transition, start)
            delta = (truth - p) * inside[:, :, None]
            g_emission = np.stack([np.bincount(slots.ravel(), np.repeat(delta[:, :, t].ravel(), slots.shape[2]), cfg.slots) for t in range(k)], 1)
            pair = forward[:, :-1, :, None] * np.exp(transition) * (e * backward)[:, 1:, None, :]
            pair /= np.maximum(pair.sum((2, 3), keepdims=True), 1e-300)
            g_transition = np.einsum("nta,ntb->ab", truth[:, :-1] * both[:, :, None], truth[:, 1:]) - (pair * both[:, :, None, None]).sum((0, 1))
            for weight, gradient, total in zip(weights, (g_emission, g_transition, delta[:, 0].sum(0)), seen):
                gradient = gradient - cfg.l2 * weight
                total += gradient**2
                weight += cfg.rate * gradient / np.sqrt(total)
    for j, t in enumerate(tags):
        if t.startswith("I-"):  # an inside tag only follows its own kind
            for i, before in enumerate(tags):
                if before[2:] != t[2:]:
                    transition[i, j] = -1e4
            start[j] = -1e4
    return Tagger(tags, emission, transition, start, cfg)


def train_on(labelled: DataFrame, cfg: Settings = Settings(), *, line_column: str = "line", rows: int = 5_000) -> Tagger:
    """Fits the field on a table of labelled lines; of a larger one, on the ``rows`` lines with the smallest hashes.

    Null lines and repeated ones do not count; an empty table gives a field that finds nothing.
    """
    lines = labelled.filter(F.col(line_column).isNotNull()).select(F.col(line_column).alias("line")).distinct()
    return train([r["line"] for r in lines.orderBy(F.xxhash64("line"), "line").limit(rows).collect()], cfg)


def viterbi(scores, lengths, transition, start):
    """Best tags of padded chains (chain, position, tag) at once."""
    import numpy as np

    n, span, _ = scores.shape
    best, back = scores[:, 0] + start, np.zeros(scores.shape, np.int16)
    for t in range(1, span):
        step = best[:, :, None] + transition
        back[:, t] = step.argmax(1)
        moved = step.max(1) + scores[:, t]
        best = np.where((t < lengths)[:, None], moved, best)
    path = np.zeros((n, span), np.int64)
    last, row = best.argmax(1), np.arange(n)
    for t in range(span - 1, -1, -1):
        here = t < lengths
        path[here, t] = last[here]
        if t:
            last = np.where(here, back[row, t, last], last)
    return path


def decode(tagger: Tagger, texts: list[str], known: dict) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) of the spans the field finds in each text, words apart by blanks."""
    import numpy as np

    work = []
    for row, text in enumerate(texts):
        for chain in chains(text, tagger.cfg.near):
            work.append((row, chain, chain_slots([text[a:b] for a, b in chain], tagger.cfg.slots, known)))
    work.sort(key=lambda w: len(w[1]))
    found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    at = 0
    while at < len(work):
        # Chains of like length together; the longer they are, the fewer.
        size = max(1, min(2048, 100_000 // len(work[min(at + 256, len(work) - 1)][1])))
        part = work[at:at + size]
        at += size
        lengths = np.array([len(c) for _, c, _ in part])
        scores = np.zeros((len(part), lengths.max(), len(tagger.tags)))
        inside = np.arange(lengths.max()) < lengths[:, None]
        scores[inside] = tagger.emission[np.array([s for _, _, slots in part for s in slots])].sum(1)
        path = viterbi(scores, lengths, tagger.transition, tagger.start)
        for (row, chain, _), tags in zip(part, path):
            if not tags[:len(chain)].any():
                continue
            names = [tagger.tags[t] for t in tags[:len(chain)]]
            i = 0
            while i < len(chain):
                j = i + 1
                if names[i] != "O":
                    while j < len(chain) and names[j] == f"I-{names[i][2:]}":
                        j += 1
                    found[row].append((chain[i][0], chain[j - 1][1], names[i][2:]))
                i = j
    return found


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while end > start and text[end - 1] in ".-)":
        end -= 1
    return start, end


SPANS = "array<struct<start:int,place:int,stop:int,kind:string,base:boolean>>"


def find_personal_data(
    docs: DataFrame, tagger: Tagger | None = None, *, text_column: str = "text", spans_column: str = "spans",
) -> DataFrame:
    """``docs`` with spans: (start, place, stop, kind, base) by start, then in the order of ``KINDS``.

    ``base`` marks the patterns' matches. Spans of the field are added where
    they hold for their kind and touch no base span. Starts and stops count
    code points of the whole text, however long. A null or empty text has no spans; repeated
    rows get equal spans; empty input gives an empty result; a column of that
    name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger or train())  # slots x tags numbers, whatever the corpus

    @F.arrow_udf(SPANS)
    def scan(column):
        import pyarrow as pa

        model, known = shared.value, {}
        texts = [t or "" for t in column.to_pylist()]
        rows = []
        for text, added in zip(texts, decode(model, texts, known)):
            base = base_spans(text)
            spans = [(a, KINDS.index(kind), b, kind, True) for a, b, kind in base]
            for a, b, kind in added:
                a, b = _trimmed(text, a, b)
                if holds(kind, text[a:b]) and not any(x < b and a < y for x, y, _ in base):
                    spans.append((a, KINDS.index(kind), b, kind, False))
            rows.append([dict(zip(("start", "place", "stop", "kind", "base"), s)) for s in sorted(spans)])
        return pa.array(rows, pa.list_(pa.struct([
            ("start", pa.int32()), ("place", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())])))

    return docs.withColumn(spans_column, scan(F.col(text_column)))
