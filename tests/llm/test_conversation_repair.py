"""Conversation repair against a search over all cheapest edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

from goldweave.llm.common import scratch
from goldweave.llm.conversation_repair import _END, Settings, _Lattice, damage, repair_conversations
from goldweave.llm.queries import repaired_digests
from goldweave.llm.turns import placed

SCHEMA = "conv_id long, turn long, role string, text string, chunk int, position string"
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def plain_damage(rows):
    out = []
    said = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        harm = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if harm == 1:
            text = ""
        elif harm == 2:
            text = re.sub("[.!?]", "", text)
        elif harm == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired) by uniform-cost search over (cost, audit); rows are (role, text, fault)."""
    grammar = re.compile(r"(s|s?(ua)*u?)?")
    queue, seen = [(0, "", 0, ())], set()
    while queue:
        cost, audit, i, done = heapq.heappop(queue)
        initials = "".join(r[:1] for r, _ in done)
        state = (i, "" if not done else initials[-1] if initials[-1] in "su" else "a")
        if state in seen:
            continue
        seen.add(state)
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", initials):
            return cost, audit, list(done)
        options = [(2, "I", i, (r, "")) for r in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            options.append((3, "D", i + 1, None))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                options.append((more, "K", i + 1, (role, text)))
                options += [(2 + more, "R", i + 1, (r, text)) for r in ("user", "assistant")]
        for more, edit, j, turn in options:
            new = done + ((turn,) if turn else ())
            if turn is None or (turn[0] and grammar.fullmatch("".join(r[:1] or "?" for r, _ in new))):
                heapq.heappush(queue, (cost + more, audit + edit, j, new))


def plain(rows, known):
    talks = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
        talks[conv].append((turn, role, text))
    out = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in known}
    for conv, turns in talks.items():
        seen, judged = set(), []
        for _, role, text in turns:
            last = text.rstrip(" \t\n\x0b\f\r")[-1:]
            judged.append((role, text, "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None))
            seen.add((role, text))
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, done = cheapest(judged)
        faults = [sum(j[2] == f for j in judged) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest())
    return out


def check(spark, rows, *settings, harmed=True):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    said = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    expected = plain(plain_damage(rows) if harmed else said, {r[0] for r in rows})
    for cfg in settings:
        got = repaired_digests(df, damage(df) if harmed else df, scratch(spark, "test"), cfg).collect()
        ours = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}
        assert len(got) == len(ours)
        assert ours == expected, cfg


def talks(seed, convs, turns, roles=("system", "user", "assistant", "user", "assistant", "tool", "", "ubuntu", "User"), start=0):
    rng = random.Random(seed)
    texts = ["Fine.", "Cut", "What?", " \t\n", "", "Yes! ", "One more. \n", "é.", "tail  "]
    return [(c, rng.choice([t, t, t + 1, 2 * t]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {c} {t}" + rng.choice([".", "", "!"]))
            for c in range(start, start + convs) for t in range(rng.randint(1, turns))]


def test_damaged_conversations_of_every_kind(spark):
    rows = talks(1, 120, 7) + talks(2, 60, 8, ("user", "assistant"), 200) + talks(3, 30, 5, ("system", "user"), 400)
    check(spark, rows, Settings(), Settings(chunk=2), Settings(chunk=3))


def test_nulls_ties_copies_and_long_texts(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (1, None, "user", "b."), (1, None, "assistant", None), (2, None, None, "c.")]
    rows += [(3, 5, "user", "same.")] * 3 + [(3, -2, "user", "same."), (4, 1, "user", "w " * 40000), (4, 2, "assistant", " " * 30000 + ".")]
    check(spark, rows, Settings(), Settings(chunk=1), harmed=False)
    check(spark, rows, Settings())


def test_empty_table_and_conversations_without_rows(spark):
    check(spark, [], Settings())
    dropped = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert dropped
    check(spark, dropped, Settings())


def test_a_conversation_of_a_third_of_all_rows(spark):
    rng = random.Random(9)
    rows = [(5, t, rng.choice(["user", "assistant", "system"]), f"t{t}" + rng.choice([".", ""])) for t in range(900)] + talks(11, 150, 6, start=50)
    check(spark, rows, Settings(), Settings(chunk=64))


def test_edits_are_real_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", ""), (1, 4, "user", "Still there?"), (1, 6, "assistant", "Yes")]
    edits, report = repair_conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"), scratch(spark, "test"))
    got = [(r.edit, r.position, r.turn, r.role, r.text) for r in edits.orderBy("conv_id", "chunk", "step").collect()]
    assert got == [
        ("Keep", 0, 0, "system", "Be kind."), ("Keep", 1, 1, "user", "Hi."), ("Delete", 2, 2, None, None), ("Insert", None, None, "assistant", ""),
        ("Keep", 3, 4, "user", "Still there?"), ("Keep", 4, 6, "assistant", "Yes")]
    row = report.first()
    assert (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit) == (2, 1, 0, 1, 2, 6, "KKDIKK")


def test_prices_are_distances():
    """The auction's prices against relaxation of all arcs until nothing changes."""
    rng = random.Random(2)
    goals = [_END, *(tuple(0 if j == k else 1 << 50 for j in range(4)) for k in range(4)), (5, 1, 4, 2)]
    for _ in range(300):
        lattice = _Lattice("".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(1, 9))), rng.choice(goals), rng.random() < 0.5)
        far = 1 << 50
        best = [far] * (4 * lattice.n + 4)
        changed = True
        while changed:
            changed = False
            for node in range(len(best)):
                new = min([cost + (best[j] if j >= 0 else 0) for cost, _, _, j in lattice.arcs(node)], default=far)
                if new < best[node]:
                    best[node], changed = new, True
        assert lattice.prices() == [min(b, far) for b in best]


def test_positions_of_a_conversation_that_lies_in_several_parts(spark):
    rows = [(5, t, "user", str(t)) for t in range(5000)] + [(6, 0, "user", "a"), (None, 0, "user", "b"), (None, None, "user", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        work = scratch(spark, "test")
        got = placed(df, work, "turn").collect()
        assert work.read("ranges").filter("conv_id = 5").select("part").distinct().count() > 1
    finally:
        spark.conf.unset(key)
    assert all(r.position == r.turn for r in got if r.conv_id == 5) and len(got) == len(rows)
    assert {(r.turn, r.position) for r in got if r.conv_id is None} == {(None, 0), (0, 1)}
