"""Copies of a document do not make its lines boilerplate."""

import corpus_pipeline
from goldweave.llm.common import scratch
from goldweave.llm.lines import drop_boilerplate

SF = "/root/testdata/sf0.001"


def body(name, lines=12):
    return [f"{name} line {j} " + " ".join(f"{name}x{j}y{k}" for k in range(9)) for j in range(lines)]


def hosts():
    """Three hosts of 90 pages under a menu: a third of one is a document, a third of another are near copies of one."""
    rows = []
    for host in ("exact", "near", "plain"):
        for i in range(90):
            name = f"{host}{i}"
            lines = body(name)
            if i < 30 and host != "plain":
                lines = body(host)
                if host == "near" and i:
                    lines[i % 12] = f"edited {i}"
            rows.append((len(rows), "\n".join(["Home About Contact", *lines]), "en", host, 0))
    return rows


def test_a_document_of_many_copies_stays_once_and_whole(spark):
    rows = hosts()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cut = corpus_pipeline.cut_lines(spark, docs, SF)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    kept = {r.doc_id: r for r in corpus_pipeline.drop_near_duplicates(spark, scratch(spark, "test").save(cut, "cut"), SF).collect()}
    texts = [r.text for r in kept.values()]
    for host in ("exact", "near"):
        assert sum(set(body(host)) <= set(t.split("\n")) or sum(line in t.split("\n") for line in body(host)) >= 11 for t in texts) == 1, host
    assert "\n".join(body("exact")) in texts
    for i, _, _, host, _ in rows:
        if host == "plain" or i % 90 >= 30:
            assert kept[i].text == "\n".join(body(f"{host}{i % 90}"))
    assert all(t.strip() for t in texts) and not any("Home About Contact" in t for t in texts)


def test_lines_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (2, "", None), (None, "x\n\nx", None), (3, " ", "a")] + [(10 + i, f" Menu\nquite own words {i}", None) for i in range(6)]
    docs = spark.createDataFrame([(*r, "c", 7) for r in rows], "doc_id long, text string, source string, line string, n_lines int")
    got = drop_boilerplate(docs, scratch(spark, "test"))
    assert sorted(map(str, ((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()))) == sorted(map(str, [
        (1, None, 0, 0), (2, "", 1, 0), (2, "", 1, 0), (None, "x\n\nx", 3, 0), (3, " ", 1, 0), *((10 + i, f"quite own words {i}", 2, 1) for i in range(6))]))


def test_a_line_on_every_page_of_a_small_host_goes(spark):
    rows = [(i, "\n".join([*body(f"small{i}", 3), "Home About Contact"]), "small") for i in range(4)]
    rows += [(10 + i, "\n".join([*body(f"large{i}", 3), *["Seldom seen"] * (i < 6)]), "large") for i in range(300)]
    got = {r.doc_id: r.text for r in drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), scratch(spark, "test")).collect()}
    for i, text, host in rows:
        assert got[i] == (text.replace("\nHome About Contact", "") if host == "small" else text)
