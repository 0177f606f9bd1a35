"""Small party tables and literal re-statements of the rules, for comparison."""

from __future__ import annotations

import itertools

from goldweave.config import FIELD_SOURCES, PRIORITY_FIELDS, SOURCE_PRIORITY
from goldweave.schemas import SOURCE_PARTIES

CRM, DNB, MKT = "internal_crm", "dnb_feed", "markit_feed"


def party(id, source=CRM, **values):
    row = {f.name: None for f in SOURCE_PARTIES}
    row.update(id=id, source_system=source, source_party_id=f"P-{id}", party_type="INDIVIDUAL", full_name=f"name {id}",
               address_line1=f"{id} road", city=f"city {id}", state="NY", postal_code=f"{10000 + id}", country="USA", entity_status="ACTIVE")
    row.update(values)
    return row


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in SOURCE_PARTIES) for r in rows], SOURCE_PARTIES)


def jaro_winkler(a, b):
    """Textbook version, one pair at a time."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, left = [False] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                left.append(ch)
                break
    if not left:
        return 0.0
    right = [ch for ch, u in zip(b, used) if u]
    m, swaps = len(left), sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    same = len(list(itertools.takewhile(lambda p: p[0] == p[1], zip(a[:4], b[:4]))))
    return jaro + same * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def clean(text):
    return (text or "").lower().strip()


def brute_pairs(rows, binarize=False):
    """{(a, b): (score, type)} with later steps overwriting earlier ones; fuzzy skips exact pairs."""
    found = {}
    for kind, field in (("TAX_ID_EXACT", "tax_id"), ("LEI_EXACT", "lei")):
        for x, y in itertools.combinations(rows, 2):
            if x[field] and x[field] == y[field]:
                found[tuple(sorted((x["id"], y["id"])))] = (1.0, kind)
    exact = set(found)
    rank = [CRM, DNB, MKT]
    for x, y in itertools.product(rows, rows):
        if x["source_system"] not in rank or y["source_system"] not in rank:
            continue
        if rank.index(x["source_system"]) >= rank.index(y["source_system"]) or x["state"] is None or x["state"] != y["state"]:
            continue
        name = 1.0 if binarize else jaro_winkler(clean(x["full_name"]), clean(y["full_name"]))
        address = 1.0 if binarize else jaro_winkler(clean(x["address_line1"]), clean(y["address_line1"]))
        total = name * 0.5 + address * 0.25 + (clean(x["city"]) == clean(y["city"])) * 0.15
        total += (x["postal_code"] is not None and x["postal_code"] == y["postal_code"]) * 0.1
        pair = tuple(sorted((x["id"], y["id"])))
        if round(total, 10) >= 0.8 and pair not in exact:
            found[pair] = (round(total, 4), "FUZZY_NAME_ADDRESS")
    return found


def brute_clusters(rows, pairs):
    parent = {r["id"]: r["id"] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    groups = {}
    for r in sorted(rows, key=lambda r: (r["source_system"], r["id"])):
        groups.setdefault(find(r["id"]), []).append(r)
    return groups


def _good(value):
    return value is not None and str(value).strip() and str(value) != "nan"


def brute_survivors(members):
    golden = {}
    for field, order in FIELD_SOURCES.items():
        picks = []
        for source in order:
            picks += [r[field] for r in members if r["source_system"] == source][:1]
        picks += [r[field] for r in members]
        golden[field] = next((str(v).strip() for v in picks if _good(v)), None)
    ranked = sorted(members, key=lambda r: -SOURCE_PRIORITY.get(r["source_system"], 0))
    for field in PRIORITY_FIELDS:
        golden[field] = next((str(r[field]).strip() for r in ranked if _good(r[field])), None)
    return golden


def brute_confidence(members, pairs):
    ids = [r["id"] for r in members]
    if len(ids) == 1:
        return 1.0
    scores = [pairs.get(tuple(sorted(p)), (0.85, None)) for p in itertools.combinations(ids, 2)]
    if any(kind == "TAX_ID_EXACT" for _, kind in scores):
        return 0.99
    return round(sum(s for s, _ in scores) / len(scores), 4)


def brute_link_score(members, pairs):
    """Last member in order with a scored partner, with its first such partner."""
    score = 1.0
    for a in members:
        for b in members:
            pair = tuple(sorted((a["id"], b["id"])))
            if a is not b and pair in pairs:
                score = pairs[pair][0]
                break
    return score
