"""SQL counterparts of the registered queries, for an independent engine.

They compute the plain way: every pair, unpruned state blocks, literal
survivorship order, recursive closures.
"""

from __future__ import annotations

from goldweave.config import ENTITY_STATUSES, FIELD_SOURCES, PARTY_TYPES, PRIORITY_FIELDS, SOURCE_SYSTEMS
from goldweave.fixtures import PARTY_EVENTS_SQL, SOURCE_PARTIES_SQL
from goldweave.schemas import GOLDEN_PARTIES, PARTY_COLUMNS

AS_OF = "2025-01-01 00:00:00"
EVENTS_AS_OF = "2025-02-01 00:00:00"

_LOADED = "strftime(TIMESTAMP '2024-12-30 00:00:00' + to_seconds(id % 100000), '%Y-%m-%d %H:%M:%S')"


def _uuid(key: str) -> str:
    h = f"sha256({key})"
    return "||'-'||".join(f"substr({h},{a},{n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_CTE: dict[str, str] = {
    "src": SOURCE_PARTIES_SQL,
    "tax": "SELECT a.id AS id1, b.id AS id2 FROM src a JOIN src b ON a.tax_id = b.tax_id AND a.id < b.id WHERE a.tax_id <> ''",
    "lei": "SELECT a.id AS id1, b.id AS id2 FROM src a JOIN src b ON a.lei = b.lei AND a.id < b.id WHERE a.lei <> ''",
    "exact": "SELECT id1, id2 FROM tax UNION SELECT id1, id2 FROM lei",
    "cleaned": """SELECT id, source_system, state, postal_code,
        CASE source_system WHEN 'internal_crm' THEN 0 WHEN 'dnb_feed' THEN 1 ELSE 2 END AS rk,
        CASE source_system WHEN 'internal_crm' THEN 'CRM' WHEN 'dnb_feed' THEN 'DNB' ELSE 'Markit' END AS lb,
        lower(trim(coalesce(full_name, ''))) AS n, lower(trim(coalesce(address_line1, ''))) AS a, lower(trim(coalesce(city, ''))) AS c FROM src""",
    "scored": """SELECT least(x.id, y.id) AS id1, greatest(x.id, y.id) AS id2, x.lb || ' vs ' || y.lb AS source_pair,
        {name} * 0.5::double + {address} * 0.25::double
          + (x.c = y.c)::int * 0.15::double + coalesce((x.postal_code = y.postal_code)::int, 0) * 0.1::double AS total
        FROM cleaned x JOIN cleaned y ON x.state = y.state AND x.rk < y.rk""",
    "fuzzy": """SELECT id1, id2, source_pair, round(total, 4) AS score FROM scored
        WHERE round(total, 10) >= 0.8::double AND NOT EXISTS (SELECT 1 FROM exact e WHERE e.id1 = scored.id1 AND e.id2 = scored.id2)""",
    "pairs": """SELECT id1, id2, max_by(score, step) AS score, max_by(kind, step) AS kind FROM (
        SELECT id1, id2, 1.0::double AS score, 'TAX_ID_EXACT' AS kind, 1 AS step FROM tax
        UNION ALL SELECT id1, id2, 1.0::double, 'LEI_EXACT', 2 FROM lei
        UNION ALL SELECT id1, id2, score, 'FUZZY_NAME_ADDRESS', 3 FROM fuzzy) GROUP BY id1, id2""",
    "sym": "SELECT id1 AS a, id2 AS b, score FROM pairs UNION ALL SELECT id2, id1, score FROM pairs",
    "reach": "SELECT id, id AS r FROM src UNION SELECT reach.id, sym.b FROM reach JOIN sym ON reach.r = sym.a",
    "comp": "SELECT id, min(r) AS cluster_id FROM reach GROUP BY id",
    "members": """SELECT s.*, c.cluster_id, row_number() OVER (PARTITION BY c.cluster_id ORDER BY s.source_system, s.id) AS ord,
        row_number() OVER (PARTITION BY c.cluster_id, s.source_system ORDER BY s.id) AS nth,
        CASE s.source_system WHEN 'markit_feed' THEN 3 WHEN 'dnb_feed' THEN 2 WHEN 'internal_crm' THEN 1 ELSE 0 END AS prio
        FROM src s JOIN comp c USING (id)""",
    "pair_facts": """SELECT a.cluster_id, avg(coalesce(p.score, 0.85::double)) AS mean, coalesce(bool_or(p.kind = 'TAX_ID_EXACT'), false) AS any_tax
        FROM members a JOIN members b ON a.cluster_id = b.cluster_id AND a.id < b.id
        LEFT JOIN pairs p ON p.id1 = a.id AND p.id2 = b.id GROUP BY a.cluster_id""",
    "partners": """SELECT a.cluster_id, a.ord AS ord_a, b.ord AS ord_b, s.score FROM sym s
        JOIN members a ON a.id = s.a JOIN members b ON b.id = s.b""",
    "link_score": "SELECT cluster_id, arg_max(score, ord_a * 1000000 - ord_b) AS match_score FROM partners GROUP BY cluster_id",
}


def _survivorship() -> str:
    picks = []
    good = lambda f: f"trim({f}::varchar) <> '' AND {f}::varchar <> 'nan'"
    for f, order in FIELD_SOURCES.items():
        steps = " ".join(f"WHEN source_system = '{s}' AND nth = 1 THEN {i}" for i, s in enumerate(order))
        picks.append(f"arg_min(trim({f}::varchar), (CASE {steps} ELSE {len(order)} END) * 1000000 + ord) FILTER (WHERE {good(f)}) AS {f}")
    for f in PRIORITY_FIELDS:
        picks.append(f"arg_min(trim({f}::varchar), (10 - prio) * 1000000 + ord) FILTER (WHERE {good(f)}) AS {f}")
    return f"""SELECT cluster_id, count(*) AS n, max(prio) AS top, min(source_system || '|' || source_party_id) AS natural_key,
        list_sort(map_entries(histogram(source_system))) AS by_source, {', '.join(picks)}
        FROM members GROUP BY cluster_id"""


_CTE["best"] = _survivorship()
_CTE["entities"] = f"""SELECT b.*, {_uuid('b.natural_key')} AS golden_id,
    CASE WHEN n = 1 THEN 1.0::double WHEN any_tax THEN 0.99::double ELSE round(mean, 4) END AS confidence_score,
    coalesce(match_score, 1.0::double) AS match_score
    FROM best b LEFT JOIN pair_facts USING (cluster_id) LEFT JOIN link_score USING (cluster_id)"""
_GOLDEN_TEXT = [c for c in GOLDEN_PARTIES.names if c not in ("golden_id", "confidence_score", "created_at", "updated_at")]
# A first run over the records with odd ids; its golden ids stay with their records in the full run.
_CTE["sym_odd"] = "SELECT a, b FROM sym WHERE a % 2 = 1 AND b % 2 = 1"
_CTE["reach_odd"] = "SELECT id, id AS r FROM src WHERE id % 2 = 1 UNION SELECT reach_odd.id, sym_odd.b FROM reach_odd JOIN sym_odd ON reach_odd.r = sym_odd.a"
_CTE["comp_odd"] = "SELECT id, min(r) AS cluster_id FROM reach_odd GROUP BY id"
_CTE["held"] = f"""SELECT c.id, {_uuid('k')} AS golden_id FROM comp_odd c JOIN (SELECT cluster_id, min(source_system || '|' || source_party_id) AS k
    FROM comp_odd JOIN src USING (id) GROUP BY cluster_id) USING (cluster_id)"""
_CTE["golden"] = f"SELECT golden_id, {', '.join(_GOLDEN_TEXT)}, confidence_score, '{AS_OF}' AS created_at, '{AS_OF}' AS updated_at FROM entities"
_CTE["links"] = f"""SELECT e.golden_id, m.id AS source_party_id, m.prio = e.top AS is_survivor, e.match_score, '{AS_OF}' AS linked_at
    FROM members m JOIN entities e USING (cluster_id)"""

# Events
_CTE["ev"] = PARTY_EVENTS_SQL
_CTE["refs"] = "SELECT s.source_party_id AS ref, l.golden_id AS gid FROM src s JOIN links l ON l.source_party_id = s.id WHERE s.source_system = 'internal_crm'"
_CTE["resolved"] = """SELECT ev.*, CASE WHEN party_ref IS NOT NULL THEN coalesce(a.gid, 'unknown-' || party_ref) END AS golden_id,
    CASE WHEN primary_ref IS NOT NULL THEN coalesce(b.gid, 'unknown-' || primary_ref) END AS primary_id,
    CASE WHEN secondary_ref IS NOT NULL THEN coalesce(c.gid, 'unknown-' || secondary_ref) END AS secondary_id
    FROM ev LEFT JOIN refs a ON a.ref = party_ref LEFT JOIN refs b ON b.ref = primary_ref LEFT JOIN refs c ON c.ref = secondary_ref"""
_CTE["judged"] = """SELECT r.*, CASE
    WHEN event_type IN ('ADDRESS_CHANGE', 'KYC_STATUS_UPDATE') THEN CASE WHEN golden_id IS NULL THEN 'skipped: no golden_id'
        WHEN golden_id NOT IN (SELECT golden_id FROM golden) THEN 'skipped: golden_id not found' ELSE 'success' END
    WHEN event_type = 'STATUS_CHANGE' THEN CASE WHEN golden_id IS NULL THEN 'skipped: no golden_id'
        WHEN new_status IS NULL THEN 'skipped: no entity_status in payload'
        WHEN golden_id NOT IN (SELECT golden_id FROM golden) THEN 'skipped: golden_id not found' ELSE 'success' END
    WHEN event_type = 'ENTITY_MERGE' THEN CASE WHEN primary_id IS NULL OR secondary_id IS NULL THEN 'skipped: missing golden IDs for merge'
        WHEN primary_id = secondary_id THEN 'skipped: merge of a record with itself'
        WHEN primary_id NOT IN (SELECT golden_id FROM golden) THEN 'error: primary not found' ELSE 'success' END
    WHEN event_type = 'NEW_PARTY' THEN 'success'
    ELSE 'skipped: unknown event type: ' || event_type END AS verdict FROM resolved r"""
_NEW_ID = _uuid("'internal_crm|STREAM-' || event_id")
_CTE["done"] = "SELECT * FROM judged WHERE verdict = 'success'"
_CTE["status_ops"] = """SELECT o.golden_id, seq, event_type, written,
    coalesce(lag(written) OVER (PARTITION BY o.golden_id ORDER BY seq), g.entity_status) AS old_status FROM (
      SELECT golden_id, seq, event_type, new_status AS written FROM done WHERE event_type = 'STATUS_CHANGE'
      UNION ALL SELECT secondary_id, seq, event_type, 'MERGED' FROM done WHERE event_type = 'ENTITY_MERGE') o
    JOIN golden g ON g.golden_id = o.golden_id"""
_CTE["address_ops"] = """SELECT d.*, lag(seq) OVER w AS before, lag(d.address_line1) OVER w AS l1, lag(d.city) OVER w AS lc, lag(d.state) OVER w AS ls, lag(d.postal_code) OVER w AS lp,
    g.address_line1 AS g1, g.city AS gc, g.state AS gs, g.postal_code AS gp
    FROM done d JOIN golden g USING (golden_id) WHERE event_type = 'ADDRESS_CHANGE' WINDOW w AS (PARTITION BY golden_id ORDER BY seq)"""
_CTE["merges"] = "SELECT seq, primary_id AS p, secondary_id AS s FROM done WHERE event_type = 'ENTITY_MERGE'"
_CTE["chain"] = """SELECT source_party_id, golden_id, CAST(-1 AS BIGINT) AS last FROM links
    UNION ALL SELECT c.source_party_id, m.p, m.seq FROM chain c JOIN merges m ON m.s = c.golden_id AND m.seq > c.last
      AND NOT EXISTS (SELECT 1 FROM merges x WHERE x.s = m.s AND x.seq > c.last AND x.seq < m.seq)"""
_NEW_LINKS = f"SELECT {_NEW_ID} AS golden_id, (SELECT max(id) FROM src) + row_number() OVER (ORDER BY seq) AS source_party_id FROM done WHERE event_type = 'NEW_PARTY'"
_CTE["new_links"] = _NEW_LINKS
_CTE["links_after"] = """SELECT arg_max(golden_id, last) AS golden_id, source_party_id, max(last) >= 0 AS moved FROM chain GROUP BY source_party_id"""
_CTE["stream_lineage"] = f"""SELECT golden_id, 'ADDRESS_UPDATED' AS event_type, event_id FROM done WHERE event_type = 'ADDRESS_CHANGE'
    UNION ALL SELECT golden_id, 'KYC_STATUS_UPDATED', event_id FROM done WHERE event_type = 'KYC_STATUS_UPDATE'
    UNION ALL SELECT {_NEW_ID}, 'CREATED', event_id FROM done WHERE event_type = 'NEW_PARTY'
    UNION ALL SELECT golden_id, 'STATUS_CHANGED', event_id FROM done WHERE event_type = 'STATUS_CHANGE'
    UNION ALL SELECT primary_id, 'MERGED', event_id FROM done WHERE event_type = 'ENTITY_MERGE'"""
_CTE["all_lineage"] = f"""SELECT golden_id, 'CREATED' AS event_type, '{AS_OF}' AS event_at FROM golden
    UNION ALL SELECT golden_id, event_type, '{EVENTS_AS_OF}' FROM stream_lineage"""

_GRADED = {"name": "jaro_winkler_similarity(x.n, y.n)", "address": "jaro_winkler_similarity(x.a, y.a)"}
_BINARY = {"name": "1.0::double", "address": "1.0::double"}

_MATCH = ["src", "tax", "lei", "exact", "cleaned", "scored", "fuzzy"]
_ENTITY = [*_MATCH, "pairs", "sym", "reach", "comp", "members", "pair_facts", "partners", "link_score", "best", "entities"]
_TABLES = [*_ENTITY, "golden", "links"]
_EVENTS = [*_TABLES, "ev", "refs", "resolved", "judged", "done"]


def _with(names: list[str], body: str, similarity: dict[str, str] = _GRADED) -> str:
    text = lambda n: _CTE[n].format(**similarity) if n == "scored" else _CTE[n]
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({text(n)})" for n in names) + "\n" + body


def _src(body: str) -> str:
    return _with(["src"], body)


def _tables(body: str) -> str:
    return _with(_TABLES, body)


def _events(body: str, *extra: str) -> str:
    return _with([*_EVENTS, *extra], body)


def _normal(source: str, own: tuple[str, ...]) -> str:
    null = "CAST(NULL AS VARCHAR)"
    opt = lambda c: f"nullif(coalesce({c}, ''), '')" if c in own else null
    name = lambda c: f"coalesce({c}, '')" if c in own else null
    return f"""SELECT source_system, source_party_id, party_type, trim(coalesce(full_name, '')) AS full_name,
        {name('first_name')} AS first_name, {name('last_name')} AS last_name,
        {"date_of_birth::varchar" if "date_of_birth" in own else null} AS date_of_birth, coalesce(tax_id, '') AS tax_id, {opt('lei')} AS lei,
        coalesce(address_line1, '') AS address_line1, nullif(coalesce(address_line2, ''), '') AS address_line2, city, state, postal_code, country,
        {opt('email')} AS email, {opt('phone')} AS phone, entity_status FROM src WHERE source_system = '{source}'"""


# Columns each feed carries beyond the shared ones.
_FEEDS = {
    "internal_crm": ("first_name", "last_name", "date_of_birth", "email", "phone"), "dnb_feed": ("phone",), "markit_feed": ("lei",),
}


def _links_of(cte: str, column: str, kind: str) -> str:
    return _src(f"""SELECT '{kind}' AS match_type, {column} AS match_key, min(id) OVER w AS anchor_id, id, count(*) OVER w AS members,
        count(*) OVER w * (count(*) OVER w - 1) // 2 AS pairs, 1.0::double AS score FROM src
        WHERE {column} <> '' WINDOW w AS (PARTITION BY {column}) QUALIFY count(*) OVER w > 1""")


_FUZZY = "SELECT id1 AS id_1, id2 AS id_2, score, 'FUZZY_NAME_ADDRESS' AS match_type, source_pair, CAST(1 AS BIGINT) AS pairs FROM fuzzy"
# Binarized matching sees only source, state, city and postal code, so look-alike records form one profile.
_FUZZY_PROFILES = """SELECT least(pa, pb) AS id_1, greatest(pa, pb) AS id_2, score, 'FUZZY_NAME_ADDRESS' AS match_type, source_pair, count(*) AS pairs
    FROM (SELECT f.*, a.pid AS pa, b.pid AS pb FROM fuzzy f JOIN prof a ON a.id = f.id1 JOIN prof b ON b.id = f.id2)
    GROUP BY least(pa, pb), greatest(pa, pb), score, source_pair"""
_PROF = "prof AS (SELECT id, min(id) OVER (PARTITION BY source_system, state, c, postal_code) AS pid FROM cleaned)"


def _expect(suite: str, position: int, expectation: str, column: str, table: str, total: str, passed: str, mostly: float, filter_text: str = "") -> str:
    shown = "'" + filter_text.replace("'", "''") + "'" if filter_text else "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{suite}' AS suite, CAST({position} AS BIGINT) AS position, '{expectation}' AS expectation, '{column}' AS "column", {shown} AS filter,
        (SELECT count(*) FROM {table}) AS table_rows, t AS total, p AS passed, t - p AS failed, CAST(NULL AS BIGINT) AS "unique",
        CAST(NULL AS BIGINT) AS duplicates, CASE WHEN t > 0 THEN round(p / t, 4) ELSE 1.0::double END AS pass_rate, {mostly}::double AS mostly,
        CASE WHEN t > 0 THEN round(p / t, 4) ELSE 1.0::double END >= {mostly}::double AS success
        FROM (SELECT count(*) FILTER (WHERE {total}) AS t, count(*) FILTER (WHERE ({total}) AND ({passed})) AS p FROM {table})"""


def _unique(suite: str, position: int, column: str, key: str, table: str) -> str:
    return f"""SELECT '{suite}', CAST({position} AS BIGINT), 'expect_{column}_unique', '{column}', CAST(NULL AS VARCHAR), (SELECT count(*) FROM {table}),
        count({key}), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), count(DISTINCT {key}), count({key}) - count(DISTINCT {key}),
        CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), count({key}) = count(DISTINCT {key}) FROM {table}"""


def _not_null(suite, i, column, table, mostly):
    return _expect(suite, i, f"expect_{column}_not_null", column, table, "true", f"{column} IS NOT NULL", mostly)


def _in_set(suite, i, column, table, values, mostly):
    return _expect(suite, i, f"expect_{column}_in_set", column, table, f"{column} IS NOT NULL", f"{column} IN ({_list(values)})", mostly)


def _length(suite, i, column, table, lo, hi, mostly):
    return _expect(suite, i, f"expect_{column}_length_{lo}_to_{hi}", column, table, f"{column} IS NOT NULL", f"length({column}) BETWEEN {lo} AND {hi}", mostly)


def _between(suite, i, column, table, lo, hi, mostly):
    n = f"try_cast({column} AS DOUBLE)"
    return _expect(suite, i, f"expect_{column}_between_{lo}_{hi}", column, table, f"{n} IS NOT NULL", f"{n} BETWEEN {lo} AND {hi}", mostly)


_S, _G = "source_parties_suite", "golden_parties_suite"
_DQ_SOURCE = " UNION ALL ".join([
    _in_set(_S, 0, "party_type", "src", PARTY_TYPES, 1.0), _not_null(_S, 1, "full_name", "src", 0.99), _not_null(_S, 2, "tax_id", "src", 0.9),
    _length(_S, 3, "tax_id", "src", 9, 12, 0.95), _in_set(_S, 4, "source_system", "src", SOURCE_SYSTEMS, 1.0),
    _in_set(_S, 5, "entity_status", "src", ENTITY_STATUSES, 0.99), _not_null(_S, 6, "address_line1", "src", 0.95),
    _not_null(_S, 7, "city", "src", 0.95), _length(_S, 8, "state", "src", 2, 2, 0.95),
    _unique(_S, 9, "source_key", "source_system || '|' || source_party_id", "src"),
])
_DQ_GOLDEN = " UNION ALL ".join([
    _not_null(_G, 1, "full_name", "golden", 0.99), _in_set(_G, 2, "party_type", "golden", PARTY_TYPES, 1.0),
    _not_null(_G, 3, "tax_id", "golden", 0.9), _between(_G, 4, "confidence_score", "golden", 0.0, 1.0, 1.0),
    _between(_G, 5, "confidence_score", "golden", 0.8, 1.0, 0.95), _in_set(_G, 6, "entity_status", "golden", ENTITY_STATUSES, 0.99),
    _not_null(_G, 7, "address_line1", "golden", 0.9), _not_null(_G, 8, "city", "golden", 0.9), _unique(_G, 0, "golden_id", "golden_id", "golden"),
])
_DQ_CLUSTERS = """SELECT 'cluster_integrity_suite' AS suite, CAST(position AS BIGINT) AS position, expectation, total, linked, total - linked AS missing,
    total = linked AS success FROM (
      SELECT 0 AS position, 'all_source_records_linked' AS expectation, (SELECT count(*) FROM src) AS total, (SELECT count(DISTINCT source_party_id) FROM links) AS linked
      UNION ALL SELECT 1, 'all_golden_records_have_clusters', (SELECT count(*) FROM golden), (SELECT count(DISTINCT golden_id) FROM links)
      UNION ALL SELECT 2, 'each_cluster_has_one_survivor', (SELECT count(*) FROM golden), (SELECT count(*) FROM links WHERE is_survivor))"""
_DQ_TABLES = [*_TABLES]
_DQ_CTES = f""", checks AS (SELECT * FROM ({_DQ_SOURCE}) UNION ALL SELECT * FROM ({_DQ_GOLDEN})), integrity AS ({_DQ_CLUSTERS}),
    summary AS (SELECT suite, max(table_rows) AS total_records, coalesce(sum(passed), 0)::bigint AS passed_records, coalesce(sum(failed), 0)::bigint AS failed_records,
      count(*) AS total_checks, count(*) FILTER (WHERE success) AS passed_checks, count(*) FILTER (WHERE NOT success) AS failed_checks FROM checks GROUP BY suite
      UNION ALL SELECT suite, max(total) FILTER (WHERE position = 0), max(linked) FILTER (WHERE position = 0), max(missing) FILTER (WHERE position = 0),
      count(*), count(*) FILTER (WHERE success), count(*) FILTER (WHERE NOT success) FROM integrity GROUP BY suite),
    results AS (SELECT 'run-1' AS run_id, CASE suite WHEN '{_S}' THEN 'source_parties' WHEN '{_G}' THEN 'golden_parties' ELSE 'party_clusters' END AS source_system,
      suite AS expectation_suite, total_records, passed_records, failed_records, round(passed_records / total_records, 4) AS pass_rate,
      round(passed_records / (passed_records + failed_records), 4) AS record_check_rate, '{AS_OF}' AS run_at FROM summary),
    history AS (SELECT * EXCLUDE (k) REPLACE ('run-' || k AS run_id, strftime(TIMESTAMP '{AS_OF}' + to_hours(3 * (k - 1)), '%Y-%m-%d %H:%M:%S') AS run_at)
      FROM results, (SELECT unnest(range(1, 9)) AS k))"""
# What each check of the suites was asked for: allowed values, lower and upper bound.
_ARGUMENTS = " UNION ALL ".join(
    f"SELECT '{suite}' AS suite, '{name}' AS expectation, {values} AS value_set, {low}::double AS min_value, {high}::double AS max_value"
    for suite, name, values, low, high in [
        *[(suite, f"expect_{column}_in_set", "'" + ",".join(allowed) + "'", "NULL", "NULL") for suite, column, allowed in (
            (_S, "party_type", PARTY_TYPES), (_S, "source_system", SOURCE_SYSTEMS), (_S, "entity_status", ENTITY_STATUSES),
            (_G, "party_type", PARTY_TYPES), (_G, "entity_status", ENTITY_STATUSES))],
        (_S, "expect_tax_id_length_9_to_12", "NULL::varchar", 9, 12), (_S, "expect_state_length_2_to_2", "NULL::varchar", 2, 2),
        (_G, "expect_confidence_score_between_0.0_1.0", "NULL::varchar", 0, 1), (_G, "expect_confidence_score_between_0.8_1.0", "NULL::varchar", 0.8, 1),
    ])


def _quality(body: str) -> str:
    return _with(_TABLES, "").rstrip() + _DQ_CTES + "\n" + body


_EXPORT_COLUMNS = [c for c in GOLDEN_PARTIES.names if c != "updated_at"]
_EXPORT = f"""SELECT {', '.join('g.' + c for c in _EXPORT_COLUMNS)}, coalesce(n, 0) AS source_record_count, systems AS contributing_sources,
    '2025-01-02T00:00:00' AS exported_at, '1.0' AS export_version FROM golden g LEFT JOIN (
      SELECT golden_id, count(*) AS n, string_agg(DISTINCT source_system, ',' ORDER BY source_system) AS systems
      FROM links l JOIN src s ON s.id = l.source_party_id GROUP BY golden_id) USING (golden_id)"""
_BUSIEST = "(SELECT golden_id FROM links GROUP BY golden_id ORDER BY count(*) DESC, golden_id LIMIT 1)"
_PAGE = "SELECT golden_id, full_name, tax_id, state, party_type, entity_status, confidence_score FROM golden"
_BAND = """CASE WHEN confidence_score >= 0.99 THEN '0.99-1.00 (Exact)' WHEN confidence_score >= 0.90 THEN '0.90-0.99 (High)'
    WHEN confidence_score >= 0.80 THEN '0.80-0.90 (Good)' ELSE 'Below 0.80 (Low)' END"""
_GOLDEN_AFTER = f"""SELECT g.golden_id, CASE WHEN a.golden_id IS NULL THEN g.address_line1 ELSE a.l.address_line1 END AS address_line1,
    CASE WHEN a.golden_id IS NULL THEN g.address_line2 ELSE a.l.address_line2 END AS address_line2,
    CASE WHEN a.golden_id IS NULL THEN g.city ELSE a.l.city END AS city, CASE WHEN a.golden_id IS NULL THEN g.state ELSE a.l.state END AS state,
    CASE WHEN a.golden_id IS NULL THEN g.postal_code ELSE a.l.postal_code END AS postal_code,
    CASE WHEN a.golden_id IS NULL THEN g.country ELSE coalesce(a.l.country, 'USA') END AS country,
    coalesce(o.written, g.entity_status) AS entity_status,
    CASE WHEN a.golden_id IS NULL AND o.golden_id IS NULL THEN g.updated_at ELSE '{EVENTS_AS_OF}' END AS updated_at
    FROM golden g
    LEFT JOIN (SELECT golden_id, arg_max({{'address_line1': address_line1, 'address_line2': address_line2, 'city': city, 'state': state, 'postal_code': postal_code, 'country': country}}, seq) AS l
               FROM address_ops GROUP BY golden_id) a USING (golden_id)
    LEFT JOIN (SELECT golden_id, arg_max(written, seq) AS written FROM status_ops GROUP BY golden_id) o USING (golden_id)
    UNION ALL SELECT {_NEW_ID}, address_line1, address_line2, city, state, postal_code, coalesce(country, 'USA'), 'ACTIVE', '{EVENTS_AS_OF}' FROM done WHERE event_type = 'NEW_PARTY'"""


def _chart(column: str, table: str) -> str:
    return f"SELECT {column} AS name, count(*) AS value FROM {table} GROUP BY {column}"


_STEP = """SELECT '{step}' AS step, 'success' AS status, strftime(last, '%Y-%m-%d %H:%M:%S') AS last_run,
    round((epoch(TIMESTAMP '2025-01-02 06:30:00') - epoch(last)) / 3600, 1) AS age_hours,
    (epoch(TIMESTAMP '2025-01-02 06:30:00') - epoch(last)) / 3600 > 24 AS is_stale, {detail} AS details FROM ({facts})"""


_CONFIRMED = f"""SELECT j.seq, event_id, j.event_type, split_part(verdict, ': ', 1) AS status,
            CASE WHEN verdict <> 'success' THEN substr(verdict, instr(verdict, ': ') + 2) END AS reason,
            CASE WHEN verdict = 'success' THEN CASE j.event_type WHEN 'NEW_PARTY' THEN {_NEW_ID} WHEN 'ENTITY_MERGE' THEN primary_id ELSE j.golden_id END END AS golden_id,
            CASE WHEN verdict = 'success' THEN CASE j.event_type WHEN 'ADDRESS_CHANGE' THEN 'address_updated' WHEN 'KYC_STATUS_UPDATE' THEN 'kyc_logged'
              WHEN 'NEW_PARTY' THEN 'new_party_created' WHEN 'STATUS_CHANGE' THEN 'status_changed_' || o.old_status || '_to_' || new_status
              ELSE 'merged_' || secondary_id || '_into_' || primary_id END END AS action
            FROM judged j LEFT JOIN status_ops o ON o.seq = j.seq AND o.event_type = 'STATUS_CHANGE' WHERE verdict NOT LIKE 'error%'"""
_LANDED = ["source_party_id", "party_type", "tax_id", "address_line1", "address_line2", "city", "state", "postal_code", "country", "entity_status"]
_HALF = "(SELECT (min(seq) + max(seq)) // 2 FROM ev)"


def registry() -> dict[str, str]:
    sql = {
        "source_parties": _src(f"SELECT * REPLACE (date_of_birth::varchar AS date_of_birth), {_LOADED} AS ingested_at, {_LOADED} AS updated_at FROM src"),
        "normalize_crm": _src(_normal("internal_crm", _FEEDS["internal_crm"])),
        "normalize_dnb": _src(_normal("dnb_feed", _FEEDS["dnb_feed"])),
        "normalize_markit": _src(_normal("markit_feed", _FEEDS["markit_feed"])),
        "feed_csv_roundtrip": _src(" UNION ALL ".join(f"""SELECT n.source_system, n.source_party_id, n.party_type, n.full_name, n.date_of_birth, n.tax_id, n.lei,
            n.address_line1, n.city, n.state, n.postal_code, n.country, n.email, n.phone, n.entity_status, ' ' || chr(9) || coalesce(s.full_name, '') || '  ' || chr(9) AS raw_full_name,
            coalesce(s.tax_id, '') AS raw_tax_id, coalesce(s.city, '') AS raw_city FROM ({_normal(feed, own)}) n JOIN src s USING (source_system, source_party_id)"""
            for feed, own in _FEEDS.items())),
        "raw_landing": _src(f"""SELECT source_system AS source, {" || ',' || ".join(f"coalesce({c}, '')" for c in _LANDED)} AS line FROM src
            UNION ALL SELECT f, '{",".join(_LANDED)}' FROM (VALUES ('internal_crm'), ('dnb_feed'), ('markit_feed')) t(f)"""),
        "feed_rejects": _src("""SELECT reason, count(*) AS rows FROM (
            SELECT 'date_of_birth_unreadable' AS reason FROM src WHERE source_system = 'internal_crm' AND (id - 1 + 10000) % 7 = 0
            UNION ALL SELECT 'postal_code_too_long' FROM src WHERE source_system = 'internal_crm' AND (id - 1 + 10000) % 5 = 0) GROUP BY reason"""),
        "upsert_sources": _src(f"""SELECT id, source_system, source_party_id,
            CASE WHEN id % 2 = 0 THEN 'B ' ELSE 'A ' END || full_name AS full_name, city, tax_id,
            CASE WHEN id % 2 = 0 THEN 'PENDING' ELSE entity_status END AS entity_status,
            CASE WHEN id % 3 = 0 THEN {_LOADED} ELSE '{EVENTS_AS_OF}' END AS ingested_at, '{EVENTS_AS_OF}' AS updated_at FROM src"""),
        "upsert_new_ids": _src("""SELECT CASE WHEN id <= 500 AND source_system = 'internal_crm' THEN id ELSE
            (SELECT max(id) FROM src WHERE id <= 500 AND source_system = 'internal_crm')
            + row_number() OVER (PARTITION BY id <= 500 AND source_system = 'internal_crm' ORDER BY id) END AS id, source_system, source_party_id FROM src"""),
        "upsert_golden": _tables(f"""SELECT golden_id, upper(full_name) AS full_name, CASE WHEN party_type = 'LEGAL_ENTITY' THEN 'Moved' ELSE city END AS city,
            'PENDING' AS entity_status, CASE WHEN party_type = 'LEGAL_ENTITY' THEN '{EVENTS_AS_OF}' ELSE created_at END AS created_at,
            '{EVENTS_AS_OF}' AS updated_at FROM golden"""),
        "append_links": _tables("SELECT CASE WHEN source_party_id % 2 = 0 THEN golden_id ELSE 'new-' || golden_id END AS golden_id, source_party_id FROM links"),
        "exact_tax_links": _links_of("tax", "tax_id", "TAX_ID_EXACT"),
        "exact_lei_links": _links_of("lei", "lei", "LEI_EXACT"),
        "fuzzy_pairs": _with(_MATCH, _FUZZY),
        "fuzzy_pairs_binarized": _with(_MATCH, "", _BINARY).rstrip() + ", " + _PROF + "\n" + _FUZZY_PROFILES,
        "match_edges": _with(_MATCH, """SELECT min(id) OVER w AS id_1, id AS id_2, 1.0::double AS score, 'TAX_ID_EXACT' AS match_type FROM src
            WHERE tax_id <> '' WINDOW w AS (PARTITION BY tax_id) QUALIFY min(id) OVER w < id
            UNION ALL SELECT min(id) OVER w, id, 1.0::double, 'LEI_EXACT' FROM src WHERE lei <> '' WINDOW w AS (PARTITION BY lei) QUALIFY min(id) OVER w < id
            UNION ALL SELECT id1, id2, score, 'FUZZY_NAME_ADDRESS' FROM fuzzy"""),
        "match_counts": _with(_MATCH, """SELECT 'TAX_ID_EXACT' AS match_type, 'all' AS source_pair, count(*) AS pairs FROM tax HAVING count(*) > 0
            UNION ALL SELECT 'LEI_EXACT', 'all', count(*) FROM lei HAVING count(*) > 0
            UNION ALL SELECT 'FUZZY_NAME_ADDRESS', source_pair, count(*) FROM fuzzy GROUP BY source_pair"""),
        "pair_types": _with([*_MATCH, "pairs"], "SELECT kind AS match_type, count(*) AS pairs FROM pairs GROUP BY kind"),
        "components": _with([*_MATCH, "pairs", "sym", "reach", "comp"], "SELECT id, cluster_id FROM comp"),
        "cluster_sizes": _with([*_MATCH, "pairs", "sym", "reach", "comp"], """SELECT count(*) FILTER (WHERE n > 1) AS multi_record,
            count(*) FILTER (WHERE n = 1) AS single_record, count(*) AS total FROM (SELECT count(*) AS n FROM comp GROUP BY cluster_id)"""),
        "golden_records": _tables("SELECT * FROM golden"),
        "golden_records_binarized": _with(_TABLES, "SELECT golden_id, full_name, city, confidence_score FROM golden", _BINARY),
        "party_links": _tables("SELECT * FROM links"),
        "party_links_single_survivor": _tables("""SELECT e.golden_id, m.id AS source_party_id,
            m.prio = e.top AND m.ord = min(CASE WHEN m.prio = e.top THEN m.ord END) OVER (PARTITION BY m.cluster_id) AS is_survivor
            FROM members m JOIN entities e USING (cluster_id)"""),
        "lineage_created": _tables(f"""SELECT golden_id, 'CREATED' AS event_type, 'batch_mastering' AS triggered_by, '{AS_OF}' AS event_at, n AS source_count,
            '[' || array_to_string(list_transform(by_source, lambda e: '"' || e.key || '"'), ',') || ']' AS sources,
            '[' || array_to_string(list_transform(by_source, lambda e: e.value), ',') || ']' AS source_counts, confidence_score AS confidence, CASE WHEN confidence_score >= 0.99 THEN 'EXACT' ELSE 'FUZZY' END AS match_type FROM entities"""),
        "stable_golden_ids": _with([*_ENTITY, "sym_odd", "reach_odd", "comp_odd", "held"], """SELECT m.id AS source_party_id,
            coalesce(min(h.golden_id) OVER (PARTITION BY m.cluster_id), e.golden_id) AS golden_id
            FROM members m JOIN entities e USING (cluster_id) LEFT JOIN held h ON h.id = m.id"""),
        "master_incremental": _with([*_ENTITY, "sym_odd", "reach_odd", "comp_odd", "held"], """SELECT m.id AS source_party_id,
            coalesce(min(h.golden_id) OVER (PARTITION BY m.cluster_id), e.golden_id) AS golden_id, m.prio = e.top AS is_survivor, e.match_score,
            e.full_name, e.confidence_score FROM members m JOIN entities e USING (cluster_id) LEFT JOIN held h ON h.id = m.id"""),
        "ingest_counts": _src("""SELECT source_system, party_type, count(*) AS count FROM src GROUP BY source_system, party_type
            UNION ALL SELECT 'TOTAL', '', count(*) FROM src"""),
        "golden_by_type": _tables("SELECT party_type, count(*) AS count, round(avg(confidence_score), 3) AS avg_confidence FROM golden GROUP BY party_type"),
        "link_stats": _tables("""SELECT count(DISTINCT golden_id) AS total_golden, count(*) AS total_links,
            count(*) FILTER (WHERE is_survivor) AS survivors FROM links"""),
        "lineage_count": _tables("SELECT count(*) AS lineage_events FROM golden"),
        "stats_overview": _tables(f"""SELECT (SELECT count(*) FROM golden) AS total_golden, (SELECT round(avg(confidence_score), 4) FROM golden) AS avg_confidence,
            (SELECT count(*) FROM src) AS total_source, (SELECT count(*) FROM links WHERE golden_id IN
            (SELECT golden_id FROM links GROUP BY golden_id HAVING count(*) > 1)) AS duplicates_resolved, '{AS_OF}' AS last_run"""),
        "stats_by_type": _tables("SELECT party_type, count(*) AS count, coalesce(round(avg(confidence_score), 3), 0) AS avg_confidence FROM golden GROUP BY party_type"),
        "source_breakdown": _src(f"""SELECT source_system, party_type, entity_status, count(*) AS count, max({_LOADED}) AS last_ingested
            FROM src GROUP BY source_system, party_type, entity_status"""),
        "source_rollup": _src("SELECT source_system, count(*) AS count FROM src GROUP BY source_system"),
        "golden_breakdown": _tables("""SELECT party_type, entity_status, count(*) AS count, round(avg(confidence_score), 3) AS avg_confidence,
            round(min(confidence_score), 3) AS min_confidence FROM golden GROUP BY party_type, entity_status"""),
        "dup_resolution": _tables("""SELECT count(DISTINCT golden_id) AS total_golden, count(*) AS total_links, count(*) FILTER (WHERE is_survivor) AS survivors,
            count(*) - count(DISTINCT golden_id) AS duplicates_resolved FROM links"""),
        "lineage_by_type": _events("SELECT event_type, count(*) AS count, max(event_at) AS last_event FROM all_lineage GROUP BY event_type", "stream_lineage", "all_lineage"),
        "chart_golden_by_type": _tables(_chart("party_type", "golden")),
        "chart_source_by_system": _src(_chart("source_system", "src")),
        "chart_confidence": _tables(f"SELECT {_BAND} AS range, count(*) AS count FROM golden GROUP BY 1"),
        "chart_quality": _quality("SELECT expectation_suite AS suite, round(avg(pass_rate) * 100, 1) AS pass_rate FROM history GROUP BY expectation_suite"),
        "chart_lineage_events": _events(_chart("event_type", "all_lineage"), "stream_lineage", "all_lineage"),
        "chart_entity_status": _tables(_chart("entity_status", "golden")),
        "chart_summary": _tables("""SELECT (SELECT count(*) FROM src) AS total_source, (SELECT count(*) FROM golden) AS total_golden,
            (SELECT round(avg(confidence_score) * 100, 1) FROM golden) AS avg_confidence_pct,
            (SELECT count(*) FROM src) - (SELECT count(*) FROM golden) AS duplicates_resolved"""),
        "freshness": _quality(" UNION ALL ".join([
            _STEP.format(step="generate_data", detail="'3 CSV files generated'", facts="SELECT TIMESTAMP '2025-01-01 12:00:00' AS last"),
            _STEP.format(step="export_s3", detail="'Size: 2.0 KB'", facts="SELECT TIMESTAMP '2025-01-01 12:00:00' AS last"),
            _STEP.format(step="ingest", detail="n || ' source records loaded'", facts=f"SELECT count(*) AS n, max(({_LOADED})::timestamp) AS last FROM src"),
            _STEP.format(step="master", detail="n || ' golden records created'", facts="SELECT count(*) AS n, max(created_at::timestamp) AS last FROM golden"),
            _STEP.format(step="quality", detail="'Pass rate: ' || round(rate * 100, 1) || '%'", facts="SELECT max(run_at::timestamp) AS last, avg(pass_rate) AS rate FROM history"),
        ])),
        "dq_source": _src(_DQ_SOURCE),
        "dq_golden": _tables(_DQ_GOLDEN),
        "dq_while_writing": _tables(_DQ_GOLDEN),
        "dq_clusters": _tables(_DQ_CLUSTERS),
        "dq_filtered": _src(" UNION ALL ".join([
            _expect("filtered", 0, "expect_tax_id_not_null", "tax_id", "src", "coalesce(entity_status = 'ACTIVE', false)", "tax_id IS NOT NULL", 0.9, "entity_status = 'ACTIVE'"),
            _expect("filtered", 1, "expect_lei_not_null", "lei", "src", "coalesce(source_system = 'markit_feed', false)", "lei IS NOT NULL", 1.0, "source_system = 'markit_feed'"),
            _between("filtered", 2, "postal_code", "src", 20000, 90000, 0.5),
            _unique("filtered", 3, "postal_code", "postal_code", "src"),
            """SELECT 'filtered', CAST(4 AS BIGINT), 'column_missing_no_such_column', 'no_such_column', CAST(NULL AS VARCHAR), count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT),
               CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), 0.0::double, 1.0::double, false FROM src""",
        ])),
        "dq_results": _quality(f"""SELECT r.*, c.expectation, c."column", a.value_set, a.min_value, a.max_value, c.mostly, c.unlinked, c.orphans, c.survivors, c.golden
            FROM results r JOIN (
              SELECT suite, expectation, "column", mostly, NULL::bigint AS unlinked, NULL::bigint AS orphans, NULL::bigint AS survivors, NULL::bigint AS golden FROM checks
              UNION ALL SELECT suite, expectation, NULL, NULL, CASE WHEN position = 0 THEN missing END, CASE WHEN position = 1 THEN missing END,
              CASE WHEN position = 2 THEN linked END, CASE WHEN position = 2 THEN total END FROM integrity) c ON c.suite = r.expectation_suite
            LEFT JOIN ({_ARGUMENTS}) a ON a.suite = c.suite AND a.expectation = c.expectation"""),
        "dq_append": _quality("SELECT * FROM history"),
        "dq_report": _quality("""SELECT s.suite, CASE WHEN failed_checks = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, total_records, passed_checks, total_checks,
            coalesce(f.names, '') AS failed_checks FROM summary s LEFT JOIN (SELECT suite, string_agg(expectation, ',' ORDER BY position) AS names FROM (
              SELECT suite, position, expectation, success FROM checks UNION ALL SELECT suite, position, expectation, success FROM integrity) WHERE NOT success GROUP BY suite) f USING (suite)
            UNION ALL SELECT 'OVERALL', CASE WHEN sum(failed_checks) = 0 THEN 'PASSED' ELSE 'FAILED' END, sum(total_records)::bigint, sum(passed_checks)::bigint, sum(total_checks)::bigint, '' FROM summary"""),
        "dq_history": _quality("""SELECT run_id, source_system, expectation_suite, total_records, passed_records, pass_rate, run_at FROM history
            ORDER BY run_at DESC, expectation_suite, run_id LIMIT 20"""),
        "dq_runs": _quality("SELECT count(DISTINCT run_id) AS total_runs FROM history"),
        "search_name": _tables(_PAGE + " WHERE full_name ILIKE '%AB%' ORDER BY full_name, golden_id LIMIT 20"),
        "search_indexed": _tables(_PAGE + " WHERE full_name ILIKE '%ab1%' ORDER BY full_name, golden_id LIMIT 20"),
        "search_indexed_total": _tables("SELECT count(*) AS total FROM golden WHERE full_name ILIKE '%ab1%'"),
        "search_filters": _tables(_PAGE + """ WHERE state = 'S3' AND party_type = 'INDIVIDUAL' AND entity_status = 'ACTIVE'
            ORDER BY full_name, golden_id LIMIT 100 OFFSET 5"""),
        "search_page_2": _tables(_PAGE + " ORDER BY full_name NULLS LAST, golden_id LIMIT 20 OFFSET 20"),
        "search_total": _tables("SELECT count(*) AS total FROM golden WHERE full_name ILIKE '%A%' AND state = 'S3' AND entity_status = 'ACTIVE'"),
        "party_lookup": _tables(f"""SELECT golden_id, {', '.join(PARTY_COLUMNS)}, confidence_score, replace(created_at, ' ', 'T') AS created_at
            FROM golden WHERE golden_id = {_BUSIEST}"""),
        "party_lineage": _events(f"""SELECT golden_id, event_type, event_id, CASE WHEN event_id IS NULL THEN 'batch_mastering' ELSE 'event_stream' END AS triggered_by,
            CASE WHEN event_id IS NULL THEN '{AS_OF}' ELSE '{EVENTS_AS_OF}' END AS event_at
            FROM (SELECT golden_id, 'CREATED' AS event_type, NULL AS event_id FROM golden UNION ALL SELECT * FROM stream_lineage)
            WHERE golden_id = (SELECT golden_id FROM all_lineage GROUP BY golden_id ORDER BY count(*) DESC, golden_id LIMIT 1)""", "stream_lineage", "all_lineage"),
        "party_sources": _tables(f"""SELECT s.id, s.source_system, s.source_party_id, s.party_type, s.full_name, s.tax_id, s.entity_status, l.is_survivor, l.match_score,
            {_LOADED} AS ingested_at FROM links l JOIN src s ON s.id = l.source_party_id WHERE l.golden_id = {_BUSIEST}"""),
        "active_parties": _tables("SELECT golden_id, party_type, full_name, tax_id FROM golden WHERE entity_status = 'ACTIVE' ORDER BY golden_id LIMIT 100"),
        "export_golden": _tables(_EXPORT),
        "export_full": _tables(_EXPORT),
        "export_multi_source": _tables(f"SELECT * FROM ({_EXPORT}) WHERE source_record_count > 1"),
        "export_by_type_counts": _tables("SELECT party_type, count(*) AS count FROM golden GROUP BY party_type"),
        "export_summary": _tables(f"""SELECT count(*) AS total, count(*) FILTER (WHERE source_record_count > 1) AS multi_source,
            count(DISTINCT party_type) AS party_types FROM ({_EXPORT})"""),
        "zone_listing": _tables("""SELECT 'golden' AS zone, 'golden_records/' || f AS folder, true AS sums_agree FROM (VALUES ('full'), ('multi_source')) t(f)
            UNION ALL SELECT DISTINCT 'golden', 'golden_records/by_type/party_type=' || party_type, true FROM golden WHERE party_type IS NOT NULL
            UNION ALL SELECT 'raw', f, true FROM (VALUES ('internal_crm/individuals.csv'), ('dnb_feed/organizations.csv'), ('markit_feed/legal_entities.csv')) t(f)
            UNION ALL SELECT z, '', true FROM (VALUES ('golden'), ('raw'), ('TOTAL')) t(z)"""),
        "file_preview": _tables("""SELECT (SELECT count(*) FROM golden) AS total_rows, golden_id, coalesce(full_name, '') AS full_name, coalesce(lei, '') AS lei, coalesce(date_of_birth, '') AS date_of_birth
            FROM golden ORDER BY golden_id LIMIT 10"""),
        "event_mix": _with(["ev"], "SELECT event_type, count(*) AS count FROM ev GROUP BY event_type"),
        "event_routing": _with(["ev"], """SELECT event_type, CASE WHEN event_type = 'PURCHASE' THEN 'skipped' ELSE 'handled' END AS route, count(*) AS count
            FROM ev GROUP BY event_type"""),
        "event_times": _with(["ev"], "SELECT seq, strftime(event_ts, '%Y-%m-%dT%H:%M:%S') AS sent_at FROM ev"),
        "event_keys": _events("SELECT seq, coalesce(golden_id, event_id) AS key FROM resolved"),
        "events_address": _events("""SELECT golden_id, event_id, 'event_stream' AS triggered_by, CASE WHEN before IS NULL THEN g1 ELSE l1 END AS old_line1,
            CASE WHEN before IS NULL THEN gc ELSE lc END AS old_city, CASE WHEN before IS NULL THEN gs ELSE ls END AS old_state,
            CASE WHEN before IS NULL THEN gp ELSE lp END AS old_postal, address_line1 AS new_line1, address_line2 AS new_line2, city AS new_city, state AS new_state,
            postal_code AS new_postal, country AS new_country FROM address_ops""", "address_ops"),
        "events_kyc": _events("SELECT golden_id, event_id, 'event_stream' AS triggered_by, 'VERIFIED' AS kyc_status, risk_score, raw_props AS notes FROM done WHERE event_type = 'KYC_STATUS_UPDATE'"),
        "events_new_party": _events(f"""SELECT {_NEW_ID} AS golden_id, event_id, 'event_stream' AS triggered_by, 'internal_crm' AS source,
            'Party ' || seq AS full_name, 'kafka_stream' AS via FROM done WHERE event_type = 'NEW_PARTY'"""),
        "events_status": _events("""SELECT o.golden_id, d.event_id, 'event_stream' AS triggered_by, old_status, written AS new_status
            FROM status_ops o JOIN done d USING (seq) WHERE o.event_type = 'STATUS_CHANGE'""", "status_ops"),
        "events_merge": _events("""SELECT primary_id AS golden_id, event_id, 'event_stream' AS triggered_by, primary_id, secondary_id
            FROM done WHERE event_type = 'ENTITY_MERGE'"""),
        "golden_after_events": _events(_GOLDEN_AFTER, "status_ops", "address_ops"),
        "links_after_events": _events("""SELECT a.golden_id, a.source_party_id, l.is_survivor AND NOT moved AS is_survivor, l.match_score
            FROM links_after a JOIN links l USING (source_party_id)
            UNION ALL SELECT golden_id, source_party_id, true, 1.0::double FROM new_links""", "merges", "chain", "links_after", "new_links"),
        "confirmations": _events(_CONFIRMED, "status_ops"),
        "event_errors": _events("SELECT seq, event_id, event_type, substr(verdict, instr(verdict, ': ') + 2) AS reason FROM judged WHERE verdict LIKE 'error%'"),
        "stream_run_stats": _events(_RUN_STATS.format(broken="0")),
        "confirmation_messages": _events(f"SELECT event_id AS key, event_id, event_type, status, reason, golden_id, action FROM ({_CONFIRMED})", "status_ops"),
        "stream_export": _events(f"""SELECT golden_id, address_line1, city, state, entity_status, coalesce(n, 0) AS source_record_count FROM ({_GOLDEN_AFTER})
            LEFT JOIN (SELECT golden_id, count(*) AS n FROM (SELECT golden_id FROM links_after UNION ALL SELECT golden_id FROM new_links) GROUP BY golden_id) USING (golden_id)""",
            "status_ops", "address_ops", "merges", "chain", "links_after", "new_links"),
        "stream_progress": _with(["ev"], f"""SELECT count(*) + count(*) FILTER (WHERE seq % 500 = 3) AS input_rows, CAST(0 AS BIGINT) AS lag, 'up_to_date' AS status
            FROM ev WHERE seq > {_HALF}"""),
        "stream_progress_all": _with(["ev"], "SELECT count(DISTINCT (seq - lo) * 120 // (hi - lo + 1)) AS batches, count(*) AS input_rows, 'up_to_date' AS status FROM ev, (SELECT min(seq) AS lo, max(seq) AS hi FROM ev)"),
        "stream_bounded": _events("""SELECT run, count(DISTINCT batch) AS batches, count(*) AS events, CAST(sum(good) AS BIGINT) AS successes FROM (
              SELECT *, CASE WHEN coalesce(before, 0) < aim THEN 1 ELSE 2 END AS run FROM (
                SELECT j.*, CASE WHEN verdict = 'success' THEN 1 ELSE 0 END AS good, (seq - lo) * 4 // (hi - lo + 1) AS batch,
                  (SELECT count(*) // 5 FROM ev) AS aim, (SELECT count(*) FROM judged x WHERE x.verdict = 'success' AND (x.seq - lo) * 4 // (hi - lo + 1) < (j.seq - lo) * 4 // (hi - lo + 1)) AS before
                FROM judged j, (SELECT min(seq) AS lo, max(seq) AS hi FROM ev))) GROUP BY run"""),
        "stream_fold": _with(["src", "ev"], f"""SELECT source_system, source_party_id, CASE WHEN id % 2 = 0 THEN 'B ' ELSE 'A ' END || full_name AS full_name, city, true AS linked FROM src
            UNION ALL SELECT 'internal_crm', 'STREAM-' || event_id, 'Party ' || seq, city, true FROM ev WHERE event_type = 'NEW_PARTY'"""),
        "recent_stream_events": _events("SELECT golden_id, event_type, event_id FROM stream_lineage ORDER BY event_id LIMIT 10", "stream_lineage"),
        "stream_apply_available_now": _events(_GOLDEN_AFTER, "status_ops", "address_ops"),
        "stream_stats_available_now": _events(_RUN_STATS.format(broken="(SELECT count(*) FROM ev WHERE seq % 500 = 3)")),
    }
    return sql


_RUN_STATS = """SELECT 'processed' AS measure, count(*) AS count FROM judged WHERE verdict = 'success' HAVING count(*) > 0
    UNION ALL SELECT 'skipped', count(*) FROM judged WHERE verdict LIKE 'skipped%' HAVING count(*) > 0
    UNION ALL SELECT 'errors', count(*) + {broken} FROM judged WHERE verdict LIKE 'error%'
    UNION ALL SELECT event_type, count(*) FROM judged WHERE verdict = 'success' GROUP BY event_type"""
