"""Decontamination, line dedup and the Jaccard join against plain versions."""

import random
import re
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from goldweave.llm.common import scratch, sieve
from goldweave.llm.decontamination import contamination, drop_contaminated
from goldweave.llm.jaccard import Settings, drop_linked, jaccard_join
from goldweave.llm.lines import drop_boilerplate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def plain_contamination(docs, items, window=10):
    held = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            held[tuple(w[i:i + n])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in held}:
            for i in range(len(w) - n + 1):
                if items_here := held.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= items_here
        out.append((doc, len(w), len(hit), sorted(x for x in found if x is not None)))
    return out


def sample_texts(seed, n):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(40)] + ["Éa", "éa", "ÑO", "x9"]
    return rng, [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_contamination_equals_word_by_word_search(spark):
    rng, texts = sample_texts(1, 40)
    items = [(1, texts[0] + " tail of the item here now"), (2, " ".join(["same"] * 14)), (3, "Short One"), (4, None), (5, "-- ,"), (None, texts[1]), (2, "other text of item two again and again and more"), (6, "one")]
    docs = [(i, t) for i, t in enumerate(texts)]
    docs += [(50, "intro, " + items[0][1].upper().replace("É", "É") + "; outro"), (51, " ".join(["same"] * 40)), (52, "a SHORT one!"), (53, None), (54, ""), (54, ""), (None, texts[1]), (55, "same " * 9), (53, "again " + items[0][1]), (56, "z " * 3000 + items[0][1])]
    df = spark.createDataFrame([(d, t, "c", 1) for d, t in docs], "doc_id long, text string, items string, n_words int")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, length string")
    got = contamination(df, bench, scratch(spark, "test"))
    ours = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=str)
    assert ours == sorted(plain_contamination(docs, items), key=str)
    kept = drop_contaminated(df, got)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _, n, _ in plain_contamination(docs, items) if not n)


@pytest.mark.parametrize("window", [1, 2, 3, 7])
def test_contamination_of_other_windows(spark, window):
    _, texts = sample_texts(3, 25)
    docs, items = [(i, t) for i, t in enumerate(texts[:15])], [(i, t) for i, t in enumerate(texts[12:])]
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), scratch(spark, "test"), window=window)
    assert sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()) == plain_contamination(docs, items, window)


def test_contamination_without_documents_or_items(spark):
    docs, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [(r.doc_id, r.n_words, r.n_hit) for r in contamination(docs, none, scratch(spark, "test")).collect()] == [(1, 2, 0)]
    assert contamination(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string"), scratch(spark, "test")).count() == 0


def plain_boilerplate(rows, ratio=0.02, copied=0.5):
    """(host, line) of the lines that are boilerplate; rows are (doc_id, text, host)."""
    pages = {(host, text): {x.strip(" ") for x in text.split("\n") if x.strip(" ")} for _, text, host in rows if text is not None}

    def frequent(pages):
        totals, seen = Counter(host for host, _ in pages), Counter((host, x) for (host, _), lines in pages.items() for x in lines)
        return {k for k, n in seen.items() if n > 1 and n > ratio * totals[k[0]]}

    often = frequent(pages)
    length = lambda lines: sum(map(len, lines))
    own = {(host, text): lines for (host, text), lines in pages.items() if length(x for x in lines if (host, x) in often) <= copied * length(lines)}
    return frequent(own) & often


def plain_cut(rows, often):
    out = []
    for doc, text, host in rows:
        parts = text.split("\n") if text is not None else []
        kept = [p for p in parts if (host, p.strip(" ")) not in often]
        out.append((doc, "\n".join(kept) if text is not None else None, host, len(parts), len(parts) - len(kept)))
    return sorted(map(str, out))


def test_boilerplate_is_relative_to_its_host(spark):
    words = lambda i: " ".join(f"w{i}x{j}" for j in range(8))
    rows = [(i, f"page {words(i)}\n  Menu \nbody {words(i)}\n\n", "a") for i in range(8)]
    rows += [(20 + i, f"only {words(i)}" + "\nMenu" * (i % 3 > 0), "b") for i in range(100)] + [(200 + i, f"x{i}x{i}\nMenu" if i < 2 else f"t{words(i)}", "c") for i in range(150)]
    rows += [(400, None, "a"), (401, "", None), (402, "Menu\nMenu", None), (403, "Menu", "d"), (404, "Menu\nMenu\nMenu", "e"), (405, "Menu\n" + "long " * 30_000, "a")]
    rows += [(410, "copy\nlines", "f")] * 6  # copies are one page
    rows += [(420 + i, "\n".join(["Menu", *[f"shared {words(j)}" for j in range(8) if j != i], f"own {words(i)}"]), "g") for i in range(8)]  # edited copies
    rows += [(430 + i, f"Menu\nsole {words(i)}", "g") for i in range(8)]
    docs = spark.createDataFrame([(*r, "c", "p") for r in rows], "doc_id long, text string, source string, host string, pages string")
    often = plain_boilerplate(rows)
    assert {("a", "Menu"), ("b", "Menu"), ("g", "Menu")} <= often and not {("c", "Menu"), ("f", "copy"), ("d", "Menu"), (None, "Menu")} & often
    assert not any(line.startswith("shared") for _, line in often)
    got = drop_boilerplate(docs, scratch(spark, "test"))
    assert plain_cut(rows, often) == sorted(str((r.doc_id, r.text, r.source, r.n_lines, r.n_dropped)) for r in got.collect())
    assert set(docs.columns) <= set(got.columns)
    assert drop_boilerplate(docs.limit(0), scratch(spark, "test")).count() == 0


def plain_join(docs, similarity=0.8, size=5):
    def grams(text):
        w = words(text)
        return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())

    sets = [grams(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(docs)
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    classes = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        classes[find(i)].append(d)
    return [(d, min((x for x in classes[find(i)] if x is not None), default=None), links[i]) for i, (d, _) in enumerate(docs)]


def near_copies(seed):
    rng = random.Random(seed)
    base = [[f"v{rng.randint(0, 3000)}" for _ in range(rng.randint(5, 200))] for _ in range(30)]
    docs = []
    for b in base:
        for _ in range(rng.choice([1, 1, 2, 4])):
            w = list(b)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 99)}"
            docs.append((len(docs), " ".join(w)))
    return docs


@pytest.mark.parametrize("block", [1024, 7])
def test_join_equals_all_pairs(spark, block):
    docs = near_copies(5)
    hot = " ".join(f"h{i}" for i in range(150))
    docs += [(1000 + i, hot.replace(f"h{i * 3} ", f"k{i} ")) for i in range(40)]
    docs += [(2000 + i, "Exact COPY of a text, with words") for i in range(30)]
    docs += [(3000, None), (3001, ""), (3001, ""), (3002, "one"), (3003, "One!"), (3004, "two words"), (None, "no id but a text of some words here"), (3005, docs[0][1]), (3005, docs[0][1]), (3006, "q " * 5000)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, key string, n int")
    joined = jaccard_join(df, scratch(spark, "test"), Settings(block=block))
    ours = sorted(((r.doc_id, r.class_id, r.n_links) for r in joined.collect()), key=str)
    assert ours == sorted(plain_join(docs), key=str)
    kept = drop_linked(df, joined)
    assert kept.columns == df.columns
    classes = Counter(c for d, c, _ in plain_join([x for x in docs if words(x[1])]))
    got = Counter(r.doc_id for r in kept.collect())
    assert got == Counter(dict.fromkeys(classes, 1)) + Counter({3000: 1, 3001: 2})


def test_join_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    joined = jaccard_join(df, scratch(spark, "test"))
    assert joined.count() == 0 and drop_linked(df, joined).count() == 0


def test_banding_reaches_its_recall():
    for similarity in (0.5, 0.8, 0.95):
        cfg = Settings(similarity=similarity)
        bands, rows = cfg.banding
        assert 1 - (1 - similarity**rows) ** bands >= cfg.recall or bands * rows > cfg.hashes


def test_sieve_keeps_every_wanted_row_and_all_columns(spark):
    rows = [(i, f"t{i}") for i in range(500)] + [(None, "none"), (7, "again")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "k long, t string, _row int, _at int")
    for wanted in ([3, 7, 400, None, 9999], [], [None]):
        keys = spark.createDataFrame([(k,) for k in wanted], "id long")
        near, far = sieve(df, F.col("k"), keys)
        assert near.columns == far.columns == df.columns
        inside, outside = near.collect(), far.collect()
        assert sorted(map(str, inside + outside)) == sorted(map(str, df.collect()))
        assert not {r.k for r in outside} & set(wanted) and len(inside) <= len([k for k, _ in rows if k in wanted]) + 5
