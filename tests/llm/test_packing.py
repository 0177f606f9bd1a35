import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from goldweave.llm.packing import _Encoder, pack, piece_lengths

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def test_lengths_are_binary_digits_longest_first():
    for n in (1, 2, 3, 2047, 2048, 2049, 5000):
        lengths = piece_lengths(n, 2048)
        assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
        assert all(x & (x - 1) == 0 and x <= 2048 for x in lengths)
        assert len({x for x in lengths if x < 2048}) == sum(x < 2048 for x in lengths)


def test_round_trip_of_odd_texts(spark):
    texts = [
        None, "", " ", "Plain words, twice. plain words", "tab\tnew\nline\x0bvt\x1cfs\xa0nbsp em", "<|endoftext|> in <|startoftext|>text",
        "it's we'll I'D 12.5 can't", "é café İstanbul ΣΣ", "long " * 5000, "x" * 3000, "\U0001F600 ok", "áb ́c",
    ]
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts)] + [(3, texts[3], "clash", 7), (None, "no id", "clash", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, length int")
    out = pack(docs, PATH).collect()
    assert len({r.sequence_id for r in out}) == len(out) and all(r.offset == 0 and r.length == 1 << r.bucket for r in out)
    tokenizer = Tokenizer.from_file(PATH)
    found = defaultdict(list)
    for r in out:
        found[r.doc_id].append(r)
    for i, text, _, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        copies = 2 if i == 3 else 1
        pieces = sorted(found[i], key=lambda r: (r.start, r.sequence_id))
        assert len(pieces) == copies * len(piece_lengths(len(ids), 2048))
        for r in pieces:
            assert r.doc_tokens == len(ids)
            assert r.ids == np.array(ids[r.start:r.start + r.length], "<u4").tobytes(), (i, r.start)
        covered = sorted(x for r in pieces[::copies] for x in range(r.start, r.start + r.length))
        assert covered == list(range(len(ids)))


def test_words_share_the_ids_of_their_pieces():
    """Each word in another case or with other signs around it was encoded, and remembered, as a word of its own."""
    words = ["The", "the", "THE,", "(the)", "thé", "THÉ", "it's", "IT'S!", "'s", "''s", "a1b22", "&'m", "x<y|z", "_é_", "ÿ×÷", "it'd've"]
    texts = [" ".join(words), *words, "\t".join(words) + "\r\n", "the\x0bthe", "the <|endoftext|>the", "the<|startoftext|>", "<| endoftext |>", "é and e\u0301", "naïve Ω the", "İt's", "²the", "\x85"]
    encoder, tokenizer = _Encoder(PATH), Tokenizer.from_file(PATH)
    encoded = []
    find = encoder.pieces.find
    encoder.pieces.find = lambda pieces: encoded.extend(pieces) or find(pieces)
    for remembered in (100, 0):
        for text, ids in zip(texts, encoder.encode(texts, remembered)):
            assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    assert encoded.count("the") == 1 and not any(w in encoded for w in ("The", "THE,", "the)"))
    assert not set(encoded) & {"startoftext", "and", "naïve"}, "reserved texts and other letters go by whole words"


def test_no_documents_give_no_pieces(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_checksum_of_the_query(spark):
    from goldweave.llm.queries import op1_power_of_two_packing

    row = op1_power_of_two_packing(spark, "/root/testdata/sf0.001").orderBy("doc_id", "start").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(f"doc_id = {row.doc_id}").first().text
    ids = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids + [1]
    assert row.ids_crc32 == zlib.crc32(np.array(ids[:row.length], "<u4").tobytes())
