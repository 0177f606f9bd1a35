"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two
in n's binary form, the longest first and none above the sequence length.
Each piece is a sequence by itself in the bucket of its length, so no sequence
crosses documents and none needs padding.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A worker keeps the ids of recent words and pieces of words, at most twice this many in all (some 300 MB), and keeps them from task
# to task; older ones are encoded again.
REMEMBERED_WORDS = 800_000
_BLANKS = re.compile("[ \t\n\r]+")
_MARK = "\x01"
# How the vocabulary folds a text and cuts it into pieces that are encoded alone.
_FOLDS = ["NFC", ("\\s+", " "), "Lowercase"]
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same cuts of a folded text of printable ASCII and these Latin letters, which are in form C, one lower-case letter each.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_OTHER = re.compile(rf"[^\t\n\r\x20-\x7e{_LATIN}]")
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^\t\n\r\x20a-z0-9{_LATIN}]+")
_encoders: dict[str, _Encoder] = {}


class _Encoder:
    """Ids of whole texts, encoded word by word, or piece by piece where the cuts inside words are known.

    The vocabulary never merges across white space, so a text's ids are those
    of its words in a row. Words come back far more often than they are new,
    their pieces, in lower case and without the signs around them, still more.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        # A character that is a token of its own and stands between words that are encoded together.
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.words, self.pieces = _Recent(self._ids), _Recent(self._piece_ids)
        self.ends, self.reserved = self._cut_alike()

    def _cut_alike(self):
        """(which ids end a piece, a pattern of the reserved texts); None twice if the vocabulary cuts otherwise than ``_PIECES``."""
        import json

        import numpy as np
        from tokenizers import normalizers, pre_tokenizers

        made = json.loads(self.tokenizer.to_str())
        folds = [(n["pattern"].get("Regex"), n["content"]) if n["type"] == "Replace" else n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
        cuts = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
        model, suffix = made["model"], made["model"].get("end_of_word_suffix")
        if (
            folds != _FOLDS or [c["type"] for c in cuts] != ["Split", "ByteLevel"] or cuts[0]["pattern"] != {"Regex": _CUTS} or not cuts[0]["invert"]
            or cuts[0]["behavior"] != "Removed" or cuts[1]["use_regex"] or cuts[1]["add_prefix_space"] or made["post_processor"] or not suffix or model["dropout"]
            or model["unk_token"] or model["continuing_subword_prefix"]
        ):
            return None, None
        # Pieces are folded and cut already: white space between them is all that is left to see.
        self.plain = type(self.tokenizer).from_str(self.tokenizer.to_str())
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends = np.zeros(max(model["vocab"].values()) + 1, bool)
        ends[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
        return ends, re.compile("|".join(re.escape(t["content"]) for t in made["added_tokens"]) or "(?!)")

    def encode(self, texts: list[str], remembered: int = REMEMBERED_WORDS) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.words.recent) + len(self.pieces.recent) > remembered:
            self.words.age()
            self.pieces.age()
        plain = [self.ends is not None and not _OTHER.search(text) and not self.reserved.search(text) for text in texts]
        by_piece = iter(self.pieces.joined([_PIECES.findall(text.lower()) for text, p in zip(texts, plain) if p]))
        by_word = iter(self.words.joined([_BLANKS.split(text) for text, p in zip(texts, plain) if not p]))
        return [next(by_piece if p else by_word) for p in plain]

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. Pieces are encoded a thousand in a go; the suffix of its last token tells where one ends."""
        import numpy as np

        out: list[bytes] = []
        for at in range(0, len(pieces), 1000):
            part = pieces[at:at + 1000]
            ids = np.asarray(self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(ends) == len(part):
                data, cuts = ids.tobytes(), [0, *ends.tolist()]
                out += [data[a:b] for a, b in zip(cuts, cuts[1:])]
            else:
                out += self._ids(part)
        return out

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Words are encoded a thousand in a go, as one text in which a mark tells them apart."""
        import numpy as np

        out: list[bytes] = []
        for at in range(0, len(words), 1000):
            part = words[at:at + 1000]
            if len(self.mark) == 1:
                text = f" {_MARK} ".join(part)
                ids = np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                ends = np.flatnonzero(ids == self.mark[0])
                if len(ends) == len(part) - 1:  # no word holds the mark
                    data, cuts = ids.tobytes(), [0, *(4 * ends).tolist(), 4 * len(ids)]
                    out.append(data[:cuts[1]])
                    out += [data[a + 4:b] for a, b in zip(cuts[1:], cuts[2:])]
                    continue
            out += [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        return out


class _Recent:
    """Ids of recent words, and of those before them; others come from ``find``, which takes a list of words."""

    def __init__(self, find: Callable[[list[str]], list[bytes]]):
        self.find = find
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def age(self) -> None:
        self.recent, self.older = {}, self.recent

    def joined(self, split: list[list[str]]) -> list[bytes]:
        """The ids of each list of words in a row."""
        recent, older = self.recent, self.older
        new = []
        for word in set().union(*split).difference(recent):
            ids = older.get(word)
            if ids is None:
                new.append(word)
            else:
                recent[word] = ids
        recent.update(zip(new, self.find(new)))
        return [b"".join(map(recent.__getitem__, words)) for words in split]


def _encoder(vocabulary: str) -> _Encoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = _Encoder(vocabulary)
    return _encoders[vocabulary]


def piece_lengths(tokens: int, longest: int) -> list[int]:
    """Longest pieces first, then the binary digits of what is left."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, vocabulary: str, *, longest: int = 2048, end: int = 1, id_column: str = "doc_id", text_column: str = "text",
    remembered: int = REMEMBERED_WORDS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids, bucket, sequence_id, offset.

    ``vocabulary`` is the path of a tokenizer file on every executor whose
    words never merge across white space; ``longest`` is a power of two;
    ``end`` is the id after each document. ``ids`` holds little-endian unsigned
    32-bit ids, ``bucket`` the exponent of the length. Every document gives at
    least one piece: a null or empty text is its end id alone. Rows with equal
    or null ids are documents of their own, and other columns are left out.
    Empty input gives no pieces; a text of any length is read whole.
    ``remembered`` words and their ids a worker keeps, which changes the time
    alone. ``docs`` should be read from stored files:
    sequence ids number the rows of its partitions, so a retried task gives
    the same ones.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    slice_rows = 64

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder, last = _encoder(vocabulary), np.uint32(end).astype("<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, slice_rows):
                batch = whole.slice(at, slice_rows)
                rows, starts, lengths, totals, ids = [], [], [], [], []
                for row, data in enumerate(encoder.encode([t or "" for t in batch.column(1).to_pylist()], remembered)):
                    data += last
                    tokens, start = len(data) // 4, 0
                    for length in piece_lengths(tokens, longest):
                        rows.append(row)
                        starts.append(start)
                        lengths.append(length)
                        totals.append(tokens)
                        ids.append(data[4 * start:4 * (start + length)])
                        start += length
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                    pa.array(totals, pa.int64()), pa.array(ids, pa.binary()),
                ], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_column].dataType), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(cut, schema).withColumns({
        "bucket": F.log2("length").cast("int"), "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"),
    })
