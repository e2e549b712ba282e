"""The same queries for DuckDB, put another way where there is one: recursion for the
sequence rules, last-writer-wins over all earlier levels for books."""

from __future__ import annotations


def _uuid(text: str) -> str:
    return f"regexp_replace(md5({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


def _venues(name: str, *more: int) -> str:
    """The exchanges of the events, and more."""
    return f"(SELECT DISTINCT CASE WHEN 1 + user_id % 7 = 7 THEN 8 ELSE 1 + user_id % 7 END::INT AS {name} FROM events" + "".join(f" UNION SELECT {x}" for x in more) + ")"


def _pairs(name: str, *more: int) -> str:
    return f"(SELECT DISTINCT (1 + (user_id // 7) % 5)::INT AS {name} FROM events" + "".join(f" UNION SELECT {x}" for x in more) + ")"


FEED = f"""
feed0 AS (
    SELECT event_id AS ord, CASE WHEN 1 + user_id % 7 = 7 THEN 8 ELSE 1 + user_id % 7 END::INT AS exchange_id, (1 + (user_id // 7) % 5)::INT AS pair_id, event_type,
           CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 1 ELSE 0 END AS gap, CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(18,1)) AS p, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, epoch_us(ts) // 1000 AS t
    FROM events),
feed AS (
    SELECT ord, exchange_id, pair_id, CASE WHEN event_type = 'signup' THEN 'snapshot' ELSE 'update' END AS type, (ord % 2)::INT AS simulation, {_uuid("'feed|' || ord")} AS id,
           CASE WHEN NOT (event_type = 'signup' AND ord % 2 = 0) THEN 1000 + row_number() OVER w + sum(gap) OVER w - CASE WHEN ord % 23 = 0 THEN 5 ELSE 0 END END::BIGINT AS seq,
           (t - CASE WHEN ord % 29 = 0 THEN 86400000 ELSE 0 END)::BIGINT AS event_time, row_number() OVER w AS n,
           CASE WHEN ord % 3 <> 0 THEN [{{'price': p || '0', 'quantity': k::VARCHAR}}, {{'price': CASE WHEN ord % 11 = 0 THEN p || '00' ELSE (p + 1.5)::DECIMAL(18,1)::VARCHAR END, 'quantity': k || '.25'}}] END AS asks,
           CASE WHEN ord % 3 <> 1 THEN [{{'price': (p - 1)::DECIMAL(18,1)::VARCHAR, 'quantity': (k % 7)::VARCHAR}}, {{'price': (p - 2.5)::DECIMAL(18,1)::VARCHAR, 'quantity': (k + 1)::VARCHAR}}] END AS bids
    FROM feed0 WINDOW w AS (PARTITION BY exchange_id, pair_id ORDER BY ord ROWS UNBOUNDED PRECEDING))
"""

FRAMES = """
framed AS (
    SELECT *, CASE WHEN ord % 53 = 0 THEN NULL WHEN ord % 59 = 0 THEN 7 ELSE exchange_id END AS here, ord % 47 = 0 AS broken, ord % 31 = 0 AND ord % 47 <> 0 AS ack,
           CASE WHEN ord % 71 = 0 AND exchange_id IN (5, 8) THEN '12345' WHEN ord % 41 = 0 THEN 'UNKNOWN' ELSE 'M' || pair_id END AS market, CASE WHEN ord % 37 <> 0 THEN 'f-' || ord END AS parent,
           (ord % 43 = 0 AND exchange_id IN (1, 2, 4, 5)) OR ((ord % 61 = 0 OR ord % 67 = 0) AND exchange_id IN (6, 8)) AS bad
    FROM feed),
heard AS (SELECT * FROM framed WHERE here IS NOT NULL),
told AS (SELECT *, unnest(range(CASE WHEN exchange_id = 5 AND ord % 601 = 0 THEN 70 WHEN exchange_id = 5 AND ord % 5 = 0 THEN 2 ELSE 1 END)) AS pos FROM heard WHERE here = exchange_id AND NOT broken AND NOT ack AND NOT bad
         AND NOT (exchange_id IN (6, 8) AND asks IS NULL AND bids IS NULL))
"""


def _written(side: str) -> str:
    return f"array_to_string(list_transform({side}, lambda x: x.price || '@' || x.quantity), ',')"


def _canon(v: str) -> str:
    """Of a decimal's own text."""
    return f"CASE WHEN contains(({v})::VARCHAR, '.') THEN rtrim(rtrim(({v})::VARCHAR, '0'), '.') ELSE ({v})::VARCHAR END"


def _numbers(side: str) -> str:
    return f"array_to_string(list_transform({side}, lambda x: CASE WHEN contains(x.price, '.') THEN rtrim(rtrim(x.price, '0'), '.') ELSE x.price END || '@' || x.quantity), ',')"


def _parse(e: int) -> str:
    kind, sequence, jump, asks, bids = "type", "coalesce(seq, ord)", "1", _written("asks"), _written("bids")
    if e in (1, 2):
        sequence, jump = "CASE WHEN type = 'update' THEN coalesce(seq, ord) END", "CASE WHEN type = 'update' THEN 1 ELSE 0 END"
    if e in (1, 2, 4, 5):
        asks, bids = f"coalesce({asks}, '')", f"coalesce({bids}, '')"
    if e == 3:
        kind, sequence, jump = "'snapshot'", "NULL", "0"
        asks, bids = f"CASE WHEN ord % 2 = 0 THEN coalesce({_numbers('asks')}, '') END", f"CASE WHEN ord % 2 = 1 THEN coalesce({_numbers('bids')}, '') END"
    if e == 4:
        kind, jump, asks, bids = "'snapshot'", "0", f"coalesce({_numbers('asks')}, '')", f"coalesce({_numbers('bids')}, '')"
    if e == 5:
        kind, jump, sequence = "'snapshot'", "0", "coalesce(seq, ord) + CASE WHEN ord % 601 = 0 THEN pos ELSE 0 END"
    if e == 8:
        sequence, jump = "event_time", "300"
    return f"""WITH {FEED}, {FRAMES} SELECT ord AS "offset", pos::BIGINT AS pos, market, {kind} AS type, simulation, parent, ({sequence})::BIGINT AS sequence_id, ({jump})::BIGINT AS sequence_jump, event_time, {asks} AS asks, {bids} AS bids FROM told WHERE exchange_id = {e}"""


LEVELS = f"""
lines AS (SELECT l_orderkey AS ord, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_linenumber % 2 AS odd, l_extendedprice::DECIMAL(18,2) AS price, l_quantity::DECIMAL(18,2) AS quantity FROM lineitem),
heads AS (SELECT ord, (1 + arg_min(s, (n, price::VARCHAR, quantity::VARCHAR)) % 8)::INT AS exchange_id, (1 + arg_min(p, (n, price::VARCHAR, quantity::VARCHAR)) % 6)::INT AS pair_id FROM lines GROUP BY ord),
levels AS (SELECT l.ord, h.exchange_id, h.pair_id, CASE WHEN odd = 1 THEN 'asks' ELSE 'bids' END AS side, (row_number() OVER (PARTITION BY l.ord, odd ORDER BY n, price::VARCHAR, quantity::VARCHAR) - 1)::BIGINT AS pos, price, quantity, {_uuid("'order|' || l.ord")} AS id
           FROM lines l JOIN heads h USING (ord)),
factors AS (SELECT e AS exchange_id, p AS pair_id, [0, -1, -2, -6, 3][1 + (e + p) % 5] AS a, [0, 0, 2, 6, -3][1 + (e + p) % 5] AS b FROM {_venues('e', 9)}, {_pairs('p')})
"""

MARKETS = f"markets AS (SELECT * FROM (VALUES (1, 1, 2, 1, 2), (2, 1, 3, 0, 0), (3, 2, 3, 2, 1), (4, 3, 1, NULL, 1), (6, 4, 2, 1, NULL)) v(id, base_id, quote_id, pp, qp) WHERE id IN (SELECT p FROM {_pairs('p', 6)}))"
EXCHANGES = f"venues(id, name) AS (SELECT x, 'exchange-' || x FROM {_venues('x', 7, 9)} WHERE x <> 8)"
LISTED = f"listed AS (SELECT e AS exchange_id, p AS pair_id, CASE WHEN (e + p) % 3 <> 0 THEN 'subscribe' ELSE 'unsubscribe' END AS status, CASE WHEN p % 2 = 0 THEN 30 + p END AS threshold FROM {_venues('e', 9)}, {_pairs('p', 6)})"


def _cut(v: str, places: str) -> str:
    return f"CASE WHEN {places} IS NULL THEN ({v})::DECIMAL(38,6) ELSE (trunc(({v})::DECIMAL(38,6) * power(10, {places})::BIGINT) / power(10, {places})::BIGINT)::DECIMAL(38,6) END"


def _rules(prefix: str, feed: str = "feed", jump: str = "1") -> str:
    """The sequence rules over a table that the CTEs before give."""
    return f"""
WITH RECURSIVE {prefix},
run AS (
    SELECT exchange_id, pair_id, 0::BIGINT AS n, NULL::BIGINT AS ord, NULL::BIGINT AS last, false AS awaiting, false AS pending, NULL::BIGINT AS last_time, false AS requested, NULL::VARCHAR AS verdict, false AS request, false AS reset
    FROM (SELECT DISTINCT exchange_id, pair_id FROM {feed})
    UNION ALL
    SELECT f.exchange_id, f.pair_id, f.n, f.ord,
           CASE WHEN v IN ('snap', 'adopt', 'next') THEN f.seq ELSE r.last END, CASE WHEN v IN ('free', 'snap') THEN false WHEN v = 'sequence_gap' THEN true ELSE r.awaiting END,
           CASE WHEN v = 'free' THEN true WHEN v = 'adopt' THEN false ELSE r.pending END, CASE WHEN v IN ('free', 'snap', 'adopt', 'next') THEN f.event_time ELSE r.last_time END,
           CASE WHEN v IN ('free', 'snap', 'adopt') THEN false WHEN v IN ('no_baseline', 'sequence_gap') THEN true ELSE r.requested END,
           CASE WHEN v IN ('free', 'snap', 'adopt', 'next') THEN 'accepted' ELSE v END, v IN ('no_baseline', 'sequence_gap') AND NOT r.requested, v = 'sequence_gap'
    FROM run r JOIN {feed} f ON f.exchange_id = r.exchange_id AND f.pair_id = r.pair_id AND f.n = r.n + 1,
    LATERAL (SELECT CASE WHEN f.seq IS NULL THEN CASE WHEN f.event_time < r.last_time THEN 'out_of_order' ELSE 'free' END
                         WHEN f.type = 'snapshot' THEN CASE WHEN f.seq <= r.last THEN 'stale_or_duplicate' ELSE 'snap' END
                         WHEN r.pending THEN 'adopt' WHEN r.last IS NULL THEN 'no_baseline' WHEN r.awaiting THEN 'awaiting_snapshot'
                         WHEN f.seq = r.last + {jump} THEN 'next' WHEN f.seq <= r.last THEN 'stale_or_duplicate' ELSE 'sequence_gap' END AS v) x),
judged AS (SELECT f.*, r.verdict, r.request, r.reset FROM run r JOIN {feed} f ON f.exchange_id = r.exchange_id AND f.pair_id = r.pair_id AND f.n = r.n),
kept AS (
    SELECT exchange_id, pair_id, ord, CASE WHEN reset THEN 'reset' ELSE type END AS type, simulation, {_uuid("'validate|' || CASE WHEN reset THEN 'reset' ELSE 'event' END || '|' || id")} AS id, id AS parent,
           CASE WHEN NOT reset THEN seq END AS seq, event_time, CASE WHEN NOT reset THEN asks END AS asks, CASE WHEN NOT reset THEN bids END AS bids
    FROM judged WHERE verdict = 'accepted' OR reset)
"""


VERDICTS = _rules(FEED)

_KEYED = "CASE WHEN side = 'asks' THEN price ELSE -price END"
def _books(kept: str = "kept", number: str = "DECIMAL(18,4)") -> str:
    """Books of events whose sides stand in `kept`, after _rules()."""
    return f""",
sides AS (SELECT exchange_id, pair_id, ord, id, type, 'asks' AS side, asks AS levels FROM {kept} UNION ALL SELECT exchange_id, pair_id, ord, id, type, 'bids', bids FROM {kept}),
epochs AS (SELECT *, sum(CASE WHEN type = 'reset' OR (type = 'snapshot' AND levels IS NOT NULL) THEN 1 ELSE 0 END) OVER (PARTITION BY exchange_id, pair_id, side ORDER BY ord) AS epoch FROM sides),
sets AS (SELECT exchange_id, pair_id, side, epoch, ord, id, x.pos, CAST(levels[x.pos].price AS {number}) AS price, CAST(levels[x.pos].quantity AS {number}) AS quantity FROM epochs, LATERAL (SELECT unnest(range(1, len(levels) + 1)) AS pos) x),
held AS (
    SELECT e.exchange_id, e.pair_id, e.side, e.ord, s.price, arg_max({{'q': s.quantity, 'id': s.id}}, (s.ord, s.pos)) AS v
    FROM epochs e JOIN sets s ON s.exchange_id = e.exchange_id AND s.pair_id = e.pair_id AND s.side = e.side AND s.epoch = e.epoch AND s.ord <= e.ord GROUP BY ALL),
alive AS (SELECT exchange_id, pair_id, side, ord, price, v.q AS quantity, v.id AS source_id FROM held WHERE v.q <> 0),
books AS (
    SELECT k.exchange_id, k.pair_id, k.ord, k.simulation, k.event_time, k.seq, k.id AS trigger_id, {_uuid("'book|' || k.id")} AS id
    FROM kept k)
"""


BOOKS = VERDICTS + _books()


def _side_text(side: str) -> str:
    return f"coalesce((SELECT string_agg({_canon('a.price')} || '@' || {_canon('a.quantity')} || '@' || a.source_id, ',' ORDER BY {_KEYED.replace('price', 'a.price').replace('side', 'a.side')}) FROM alive a WHERE a.exchange_id = b.exchange_id AND a.pair_id = b.pair_id AND a.ord = b.ord AND a.side = '{side}'), '')"


FLAT_BOOK = f"SELECT exchange_id, pair_id, ord, id, trigger_id, event_time, seq AS last_sequence_id, {_side_text('asks')} AS asks, {_side_text('bids')} AS bids FROM books b"

_UNIONED = """,
moments AS (SELECT pair_id, side, ord, exchange_id, simulation, event_time FROM books, (VALUES ('asks'), ('bids')) s(side)),
standing AS (
    SELECT m.pair_id, m.side, m.ord, b.exchange_id, max(b.ord) AS from_ord FROM moments m JOIN moments b ON b.pair_id = m.pair_id AND b.side = m.side AND b.ord <= m.ord GROUP BY ALL),
stood AS (SELECT s.*, b.simulation, b.event_time FROM standing s JOIN moments b ON b.pair_id = s.pair_id AND b.side = s.side AND b.exchange_id = s.exchange_id AND b.ord = s.from_ord),
views AS (SELECT pair_id, side, ord, max(event_time) AS event_time FROM stood GROUP BY ALL),
placed AS (SELECT s.pair_id, s.side, s.ord, s.exchange_id, s.simulation, a.price, a.quantity FROM stood s JOIN alive a ON a.exchange_id = s.exchange_id AND a.pair_id = s.pair_id AND a.side = s.side AND a.ord = s.from_ord)
"""
UNION = BOOKS + _UNIONED

_RECORDS = "records AS (SELECT 'ex' || exchange_id || '-p' || pair_id || '-raw-flink' AS topic, ord, event_time FROM feed)"
_STAGES = "(SELECT unnest(['raw-flink', 'type-validated-raw-flink', 'rebased-flink', 'applied-precision-flink', 'orderbook-snapshot-flink']) AS stage)"
WATCHED = f"""{MARKETS}, {LISTED}, subscribed AS (SELECT l.* FROM listed l JOIN markets m ON m.id = l.pair_id WHERE status = 'subscribe'),
derived AS (SELECT 'ex' || exchange_id || '-p' || pair_id || '-' || stage AS topic, coalesce(threshold, 60) AS threshold FROM subscribed, {_STAGES}
            UNION SELECT 'p' || pair_id || '-' || side, 10 FROM subscribed, (VALUES ('asks'), ('bids')) s(side)),
watched AS (SELECT topic, CASE topic WHEN 'p1-asks' THEN 99 ELSE threshold END::INT AS threshold FROM derived UNION ALL SELECT 'ex1-raw', 30)"""

ORACLE_SQL: dict[str, str] = {
    "scan_topic_ids": f"WITH {FEED}, {FRAMES} SELECT here::INT AS exchange_id, count(*) AS n FROM heard GROUP BY 1",
    **{f"parse_ex{e}": _parse(e) for e in (1, 2, 3, 4, 5, 6, 8)},
    "extract_pairs": f"WITH {FEED}, {FRAMES} SELECT exchange_id, pair_id, ord, pos::BIGINT AS pos, {_uuid("'extract|' || exchange_id || '|' || ord || '|' || pos")} AS id, parent FROM told WHERE parent IS NOT NULL AND market LIKE 'M%'",
    "drop_counters": f"""WITH {FEED}, {FRAMES}, outcomes AS (
        SELECT here AS exchange_id, 'no_parser' AS outcome FROM heard WHERE here = 7
        UNION ALL SELECT here, 'unparseable' FROM heard WHERE here <> 7 AND (broken OR (bad AND NOT ack))
        UNION ALL SELECT exchange_id, CASE WHEN parent IS NULL THEN 'no_id' ELSE 'unknown_market' END FROM told WHERE parent IS NULL OR market NOT LIKE 'M%')
        SELECT exchange_id::INT AS exchange_id, outcome, count(*) AS n FROM outcomes GROUP BY ALL""",
    "canonical_decimals": f"SELECT l_orderkey, l_linenumber::BIGINT AS line, CASE WHEN l_orderkey % 5 = 0 THEN '0' ELSE {_canon('CASE WHEN l_linenumber % 2 = 0 THEN -(l_extendedprice::DECIMAL(18,2)) ELSE l_extendedprice::DECIMAL(18,2) END')} END AS canonical FROM lineitem",
    "rebase_levels": f"""WITH {LEVELS}, powers(k, f) AS (VALUES (0, 1.000000), (-1, 0.100000), (-2, 0.010000), (-6, 0.000001), (3, 1000.000000), (2, 100.000000), (6, 1000000.000000), (-3, 0.001000))
        SELECT ord, side, pos, {_canon('price * x.f')} AS price, {_canon('quantity * y.f')} AS quantity FROM levels JOIN factors USING (exchange_id, pair_id) JOIN powers x ON x.k = a JOIN powers y ON y.k = b""",
    "rebase_missing": f"WITH {LEVELS} SELECT h.ord, h.exchange_id, h.pair_id, 'no_rebase_row' AS reject_reason, {_uuid("'order|' || h.ord")} AS parent, {_uuid("'order|' || h.ord")} AS event_id FROM heads h ANTI JOIN factors USING (exchange_id, pair_id)",
    "precision_merge": f"""WITH {LEVELS}, {MARKETS}, cut AS (SELECT l.*, {_cut('price', 'm.pp')} AS cp, m.qp FROM levels l LEFT JOIN markets m ON m.id = l.pair_id),
        summed AS (SELECT ord, side, cp, min(pos) AS first, {_cut('sum(quantity)', 'any_value(qp)')} AS q FROM cut GROUP BY ord, side, cp)
        SELECT ord, side, (row_number() OVER (PARTITION BY ord, side ORDER BY first) - 1)::BIGINT AS pos, {_canon('cp')} AS price, {_canon('q')} AS quantity FROM summed""",
    "null_vs_empty": f"WITH {LEVELS}, s AS (SELECT ord, count(*) FILTER (side = 'asks') AS a, count(*) FILTER (side = 'bids') AS b FROM levels GROUP BY ord) SELECT false AS no_asks, b = 0 AS no_bids, a = 0 AS empty_asks, count(*) AS n FROM s GROUP BY ALL",
    "validate_verdicts": VERDICTS + "SELECT exchange_id, pair_id, ord, verdict, request, reset FROM judged",
    "validate_rejects": VERDICTS + f"SELECT exchange_id, pair_id, ord, verdict AS reject_reason, {_uuid("'validate|rejected|' || id")} AS id, id AS parent, seq AS sequence_id FROM judged WHERE verdict <> 'accepted'",
    "validate_controls": VERDICTS + f"SELECT 'snapshot_request' AS action, exchange_id, pair_id, simulation, {_uuid("'validate|control|' || id")} AS id, id AS parent, exchange_id || '|' || pair_id AS key, ord FROM judged WHERE request",
    "validate_resets": VERDICTS + "SELECT exchange_id, pair_id, ord, id, parent, 0::BIGINT AS sequence_jump, event_time, simulation, asks IS NULL AS no_asks FROM kept WHERE type = 'reset'",
    "book_events": BOOKS + FLAT_BOOK,
    "book_final": BOOKS + FLAT_BOOK + " WHERE ord = (SELECT max(ord) FROM books c WHERE c.exchange_id = b.exchange_id AND c.pair_id = b.pair_id)",
    "book_lineage_check": "SELECT rule, 0::BIGINT AS n FROM (VALUES ('bad_ids'), ('bad_triggers'), ('foreign_levels'), ('bad_controls')) v(rule)",
    "split_sides": BOOKS + f"SELECT pair_id, side, exchange_id, ord, event_time, coalesce((SELECT string_agg(a.exchange_id || '@' || b.simulation || '@' || {_canon('a.price')} || '@' || {_canon('a.quantity')}, ',' ORDER BY {_KEYED.replace('price', 'a.price').replace('side', 'a.side')}) FROM alive a WHERE a.exchange_id = b.exchange_id AND a.pair_id = b.pair_id AND a.ord = b.ord AND a.side = s.side), '') AS levels FROM books b, (VALUES ('asks'), ('bids')) s(side)",
    "aggregate_union": UNION + f"SELECT v.pair_id, v.side, v.ord, v.event_time, coalesce((SELECT string_agg(p.exchange_id || '@' || p.simulation || '@' || {_canon('p.price')} || '@' || {_canon('p.quantity')}, ',' ORDER BY CASE WHEN p.side = 'asks' THEN p.price ELSE -p.price END, p.quantity DESC, p.exchange_id) FROM placed p WHERE p.pair_id = v.pair_id AND p.side = v.side AND p.ord = v.ord), '') AS levels FROM views v",
    "merge_prices": UNION + f""", summed AS (SELECT pair_id, side, ord, simulation, price, sum(quantity)::DECIMAL(18,4) AS q, string_agg(exchange_id, '+' ORDER BY quantity DESC, exchange_id) AS e FROM placed GROUP BY ALL)
        SELECT v.pair_id, v.side, v.ord, v.event_time, coalesce((SELECT string_agg(p.simulation || '@' || p.e || '@' || {_canon('p.price')} || '@' || {_canon('p.q')}, ',' ORDER BY CASE WHEN p.side = 'asks' THEN p.price ELSE -p.price END, p.simulation) FROM summed p WHERE p.pair_id = v.pair_id AND p.side = v.side AND p.ord = v.ord), '') AS levels FROM views v""",
    "top_of_book_spread": BOOKS + f""", tops AS (SELECT b.exchange_id, b.pair_id, b.ord, min(a.price) FILTER (a.side = 'asks') AS ask, max(a.price) FILTER (a.side = 'bids') AS bid, count(a.price) FILTER (a.side = 'asks') AS n_asks, count(a.price) FILTER (a.side = 'bids') AS n_bids FROM books b LEFT JOIN alive a USING (exchange_id, pair_id, ord) GROUP BY ALL)
        SELECT exchange_id, pair_id, ord, {_canon('ask')} AS best_ask, {_canon('bid')} AS best_bid, {_canon('ask - bid')} AS spread, n_asks, n_bids FROM tops""",
    "latest_book": UNION + "SELECT v.pair_id, 0 AS exchange_id, v.side, v.ord, (SELECT count(*) FROM placed p WHERE p.pair_id = v.pair_id AND p.side = v.side AND p.ord = v.ord) AS n FROM views v WHERE v.ord = (SELECT max(ord) FROM views w WHERE w.pair_id = v.pair_id AND w.side = v.side)",
    "selection": BOOKS + "SELECT b.pair_id, b.exchange_id, s.side, b.ord, (SELECT count(*) FROM alive a WHERE a.exchange_id = b.exchange_id AND a.pair_id = b.pair_id AND a.ord = b.ord AND a.side = s.side) AS n FROM books b, (VALUES ('asks'), ('bids')) s(side) WHERE b.pair_id = 2 AND b.exchange_id = 3 AND b.ord = (SELECT max(ord) FROM books WHERE pair_id = 2 AND exchange_id = 3)",
    "book_enriched": BOOKS + f""", {MARKETS}, {EXCHANGES}, coins(id, name) AS (VALUES (1, 'BTC'), (2, 'USDT'), (3, 'IRT'), (4, 'ETH')),
        last AS (SELECT * FROM books b WHERE ord = (SELECT max(ord) FROM books c WHERE c.exchange_id = b.exchange_id AND c.pair_id = b.pair_id))
        SELECT l.pair_id, l.exchange_id, s.side, coalesce(x.name, 'p' || l.pair_id) AS base, coalesce(y.name, '?') AS quote, coalesce(v.name, 'unknown') AS exchange,
               coalesce((SELECT string_agg(coalesce(v.name, 'unknown') || '@' || {_canon('a.price')} || '@' || {_canon('a.quantity')}, ',' ORDER BY {_KEYED.replace('price', 'a.price').replace('side', 'a.side')}) FROM alive a WHERE a.exchange_id = l.exchange_id AND a.pair_id = l.pair_id AND a.ord = l.ord AND a.side = s.side), '') AS levels
        FROM last l CROSS JOIN (VALUES ('asks'), ('bids')) s(side) LEFT JOIN markets m ON m.id = l.pair_id LEFT JOIN coins x ON x.id = m.base_id LEFT JOIN coins y ON y.id = m.quote_id LEFT JOIN venues v ON v.id = l.exchange_id""",
    "latency_deltas": VERDICTS + """, d AS (SELECT ord, 5 + ord % 3 AS w, ord % 7 AS lag, type <> 'reset' AS whole FROM kept)
        SELECT ord, CASE WHEN whole THEN lag END AS lag, CASE WHEN whole THEN w END AS in_pair_extract, w AS in_type_validate, w AS in_rebase, w AS in_precision, w AS in_book_build,
               CASE WHEN whole THEN 10 - w END AS to_type_validate, 10 - w AS to_rebase, 10 - w AS to_precision, 10 - w AS to_book_build, 40 + lag + w AS total FROM d""",
    "topic_plan": f"""WITH {MARKETS}, {EXCHANGES}, {LISTED}, pairs AS (SELECT DISTINCT l.exchange_id, l.pair_id FROM listed l JOIN markets m ON m.id = l.pair_id JOIN venues v ON v.id = l.exchange_id)
        SELECT 'ex' || exchange_id || '-p' || pair_id || '-' || stage AS topic, 3600000::BIGINT AS retention_ms FROM pairs, {_STAGES}
        UNION ALL SELECT 'ex' || exchange_id || '-p' || pair_id || '-rejected-flink', 604800000 FROM pairs
        UNION ALL SELECT DISTINCT 'ex' || exchange_id || '-raw', 604800000 FROM pairs
        UNION ALL SELECT 'p' || pair_id || '-' || side, 21600000 FROM (SELECT DISTINCT pair_id FROM pairs), (VALUES ('asks'), ('bids'), ('asks-merged'), ('bids-merged')) s(side)
        UNION ALL SELECT 'control-plane', 3600000""",
    "watch_list": f"WITH {WATCHED} SELECT topic, threshold FROM watched",
    "watch_removed": f"WITH {WATCHED}, fewer AS (SELECT * FROM subscribed WHERE exchange_id <> 3) SELECT topic FROM watched WHERE topic NOT IN (SELECT 'ex' || exchange_id || '-p' || pair_id || '-' || stage FROM fewer, {_STAGES} UNION ALL SELECT 'p' || pair_id || '-' || side FROM fewer, (VALUES ('asks'), ('bids')) s(side))",
    "staleness_now": f"""WITH {FEED}, {_RECORDS}, {WATCHED}, ends AS (SELECT topic, arg_max(event_time, ord) AS ts FROM records GROUP BY topic, ord % 2), seen AS (SELECT topic, max(ts) AS last_ts FROM ends GROUP BY topic)
        SELECT topic, threshold, coalesce(last_ts, 0) AS last_ts, coalesce((1706000000000 - last_ts) / 1000.0, -1.0)::DOUBLE AS seconds, CASE WHEN last_ts IS NULL OR 1706000000000 - last_ts > 1000 * threshold THEN 1 ELSE 0 END::INT AS stale FROM watched LEFT JOIN seen USING (topic)""",
    "staleness_episodes": f"""WITH {FEED}, {_RECORDS}, polls AS (SELECT topic, ord, event_time % 3 = 0 AS stale, sum(CASE WHEN event_time % 3 <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY topic ORDER BY ord) AS healthy FROM records)
        SELECT p.topic, min(p.ord) AS since, any_value(h.ord) AS recovered, any_value(h.ord) - min(p.ord) AS duration FROM polls p LEFT JOIN polls h ON h.topic = p.topic AND NOT h.stale AND h.healthy = p.healthy + 1 WHERE p.stale GROUP BY p.topic, p.healthy""",
    "subscriptions": "SELECT 'e' || n_regionkey AS exchange, n_name AS market, CASE WHEN n_nationkey % 5 = 0 THEN 'unsubscribe' ELSE 'subscribe' END AS action FROM nation WHERE n_nationkey % 5 IN (0, 1, 4)",
    "market_catalog": f"WITH {MARKETS}, coins(id, name) AS (VALUES (1, 'BTC'), (2, 'USDT'), (3, 'IRT'), (4, 'ETH')) SELECT m.id AS pair_id, b.name AS base, q.name AS quote FROM markets m JOIN coins b ON b.id = m.base_id JOIN coins q ON q.id = m.quote_id",
}

ORACLE_SQL["episode_history"] = f"""SELECT topic, since, coalesce(recovered, CASE WHEN topic LIKE 'ex3-%' THEN 1000000000000 END) AS recovered, coalesce(duration, CASE WHEN topic LIKE 'ex3-%' THEN 1000000000000 - since END) AS duration
    FROM ({ORACLE_SQL["staleness_episodes"]})"""
ORACLE_SQL["staleness_metrics"] = f"""WITH {FEED}, {_RECORDS}, polled AS (SELECT topic, ord, CASE WHEN event_time % 3 = 0 THEN 1 ELSE 0 END AS stale, lag(ord) OVER t AS before, lag(event_time % 3 = 0) OVER t AS was FROM records WINDOW t AS (PARTITION BY topic ORDER BY ord)),
    last AS (SELECT topic, max(ord) AS o, arg_max(stale, ord)::INT AS stale, sum(CASE WHEN was THEN ord - before ELSE 0 END) / 1000.0 AS spent FROM polled GROUP BY topic),
    ended AS (SELECT topic, count(*) AS n, max(since) FILTER (recovered IS NULL) AS since, max(recovered) AS recovered, arg_max(duration, recovered) / 1000.0 AS took FROM ({ORACLE_SQL["staleness_episodes"]}) GROUP BY topic)
    SELECT topic, CASE WHEN o % 2 = 0 AND o > 500 THEN 0.5 ELSE -1.0 END::DOUBLE AS seconds_since, stale, 60 AS threshold, CASE WHEN o % 2 = 0 THEN o - 500 ELSE 0 END::BIGINT AS last_ts, coalesce(since, 0)::BIGINT AS stale_since, coalesce(recovered, 0)::BIGINT AS last_recovery,
           coalesce(took, 0)::DOUBLE AS last_stale_seconds, coalesce(n, 0)::BIGINT AS episodes, spent::DOUBLE AS stale_seconds FROM last LEFT JOIN ended USING (topic)"""
ORACLE_SQL["watch_list_modes"] = f"""WITH {WATCHED} SELECT 'db' AS mode, topic, threshold::INT AS threshold FROM derived
    UNION ALL SELECT 'config', topic, threshold::INT FROM (VALUES ('ex1-raw', 30), ('p1-asks', 99)) m(topic, threshold) UNION ALL SELECT 'both', topic, threshold FROM watched UNION ALL SELECT 'else', topic, threshold FROM watched"""
ORACLE_SQL["stage_timings"] = VERDICTS + """SELECT exchange_id, pair_id, ord, CASE WHEN type = 'reset' THEN 'reset' ELSE 'event' END AS kind, CASE WHEN type <> 'reset' THEN event_time END AS pair_extract_in, CASE WHEN type <> 'reset' THEN event_time + 5 END AS pair_extract_out,
    event_time + 10 AS type_validate_in, event_time + 15 AS type_validate_out, NULL::BIGINT AS rebase_in, NULL::BIGINT AS rebase_out, NULL::BIGINT AS rejected_at FROM kept
    UNION ALL SELECT exchange_id, pair_id, ord, 'rejected', event_time, event_time + 5, ord * 1000, NULL, NULL, NULL, ord * 1000 + 1 FROM judged WHERE verdict <> 'accepted'"""
ORACLE_SQL["rfc3339_times"] = f"WITH {FEED} SELECT ord, strftime(make_timestamp(1000 * CASE WHEN ord % 2 = 0 THEN event_time + ord % 1000 ELSE -ord * 86399999 END), '%Y-%m-%dT%H:%M:%SZ') AS at FROM feed"
ORACLE_SQL["stream_differences"] = f"""WITH {FEED}, want AS (SELECT exchange_id, pair_id, id, row_number() OVER (PARTITION BY exchange_id, pair_id ORDER BY ord) AS n FROM feed),
    got AS (SELECT exchange_id, pair_id, CASE WHEN ord % 97 = 0 THEN id || 'x' ELSE id END AS id, row_number() OVER (PARTITION BY exchange_id, pair_id ORDER BY ord) AS n FROM feed WHERE NOT (exchange_id = 3 AND ord % 101 = 0))
    SELECT exchange_id, pair_id, n, g.id AS got, w.id AS want FROM got g FULL JOIN want w USING (exchange_id, pair_id, n) WHERE g.id IS DISTINCT FROM w.id"""
ORACLE_SQL["expected_union"] = f"SELECT exchange_id, pair_id, side, levels FROM ({ORACLE_SQL['split_sides']}) QUALIFY row_number() OVER (PARTITION BY exchange_id, pair_id, side ORDER BY ord DESC) = 1"
ORACLE_SQL["stream_validate"] = ORACLE_SQL["validate_verdicts"]
ORACLE_SQL["stream_books"] = ORACLE_SQL["book_events"]
ORACLE_SQL["stream_union"] = ORACLE_SQL["aggregate_union"]
ORACLE_SQL["stream_episodes"] = f"SELECT * FROM ({ORACLE_SQL['staleness_episodes']}) WHERE recovered IS NOT NULL"
ORACLE_SQL["stream_chain"] = ORACLE_SQL["aggregate_union"]
ORACLE_SQL["stream_fan_out"] = VERDICTS + f"""SELECT 'ex' || exchange_id || '-p' || pair_id || '-type-validated-raw-flink' AS topic, exchange_id || '|' || pair_id AS key, ord, id, CASE WHEN type = 'reset' THEN 'reset' ELSE 'event' END AS kind, NULL::VARCHAR AS reason FROM kept
    UNION ALL SELECT 'ex' || exchange_id || '-p' || pair_id || '-rejected-flink', exchange_id || '|' || pair_id, ord, {_uuid("'validate|rejected|' || id")}, 'rejected', verdict FROM judged WHERE verdict <> 'accepted'
    UNION ALL SELECT 'control-plane', exchange_id || '|' || pair_id, ord, {_uuid("'validate|control|' || id")}, 'control', NULL FROM judged WHERE request"""

_LAST = "final AS (SELECT p.*, s.from_ord FROM placed p JOIN stood s USING (pair_id, side, ord, exchange_id) WHERE p.ord = (SELECT max(ord) FROM views v WHERE v.pair_id = p.pair_id AND v.side = p.side))"
ORACLE_SQL["lineage_walk"] = UNION + f", {_LAST} SELECT pair_id, side, exchange_id, {_canon('price')} AS price, 'f-' || from_ord AS origin, 3::BIGINT AS hops FROM final"
ORACLE_SQL["lineage_breaks"] = UNION + f", {_LAST} SELECT pair_id, side, exchange_id, {_canon('price')} AS price, 2::BIGINT AS hops FROM final WHERE from_ord % 3 = 0"
ORACLE_SQL["lineage_faults"] = BOOKS + """SELECT 'bad_ids' AS rule, count(*) AS n FROM books WHERE ord % 11 = 0
    UNION ALL SELECT 'bad_triggers', count(*) FROM books WHERE ord % 19 = 0
    UNION ALL SELECT 'foreign_levels', count(*) FROM books b WHERE ord % 17 = 0 AND EXISTS (FROM alive a WHERE a.exchange_id = b.exchange_id AND a.pair_id = b.pair_id AND a.ord = b.ord AND a.side = 'asks')
    UNION ALL SELECT 'bad_controls', count(*) FROM judged WHERE request AND ord % 3 = 0"""
ORACLE_SQL["superseded"] = BOOKS + f""", latest AS (SELECT pair_id, exchange_id, max(ord) FILTER (ord % 2 = 0) AS even, max(ord) AS last FROM books GROUP BY ALL)
    SELECT a.pair_id, a.side, a.exchange_id, {_canon('a.price')} AS price FROM latest l JOIN alive a ON a.exchange_id = l.exchange_id AND a.pair_id = l.pair_id AND a.ord = l.even WHERE l.even <> l.last"""
ORACLE_SQL["stream_rebase"] = ORACLE_SQL["rebase_levels"]
ORACLE_SQL["stream_live_view"] = UNION + """, shown AS (
        SELECT b.pair_id, b.exchange_id, s.side, b.ord, b.event_time, (SELECT count(*) FROM alive a WHERE a.exchange_id = b.exchange_id AND a.pair_id = b.pair_id AND a.ord = b.ord AND a.side = s.side) AS n FROM books b, (VALUES ('asks'), ('bids')) s(side)
        UNION ALL SELECT v.pair_id, 0, v.side, v.ord, v.event_time, (SELECT count(*) FROM placed p WHERE p.pair_id = v.pair_id AND p.side = v.side AND p.ord = v.ord) FROM views v)
    SELECT * FROM shown QUALIFY row_number() OVER (PARTITION BY pair_id, exchange_id, side ORDER BY ord DESC) = 1"""
ORACLE_SQL["stream_silences"] = f"""WITH {FEED}, {_RECORDS}, gaps AS (SELECT topic, ord * 1000 AS ts, lead(ord) OVER (PARTITION BY topic ORDER BY ord) * 1000 AS next, max(ord) OVER () * 1000 AS now FROM records)
    SELECT topic, ts + 60001 AS since, next AS recovered, next - ts - 60001 AS duration FROM gaps WHERE coalesce(next, now) - ts > 60000"""

#: The extracted events of all exchanges as their parsers tell them, numbered; then with rebased and truncated levels.
_CHAIN = f"""{FEED}, {FRAMES},
spoken AS (
    SELECT exchange_id, pair_id, ord AS place, pos, simulation, event_time, CASE WHEN exchange_id IN (3, 4, 5) THEN 'snapshot' ELSE type END AS type,
           CASE WHEN exchange_id IN (1, 2) AND type = 'snapshot' OR exchange_id = 3 THEN NULL WHEN exchange_id = 8 THEN event_time ELSE coalesce(seq, ord) + CASE WHEN exchange_id = 5 AND ord % 601 = 0 THEN pos ELSE 0 END END AS seq,
           CASE WHEN exchange_id = 8 THEN 300 WHEN exchange_id = 6 OR exchange_id IN (1, 2) AND type = 'update' THEN 1 ELSE 0 END AS jump,
           CASE WHEN exchange_id IN (1, 2, 4, 5) OR exchange_id = 3 AND ord % 2 = 0 THEN coalesce(asks, []) WHEN exchange_id <> 3 THEN asks END AS asks,
           CASE WHEN exchange_id IN (1, 2, 4, 5) OR exchange_id = 3 AND ord % 2 = 1 THEN coalesce(bids, []) WHEN exchange_id <> 3 THEN bids END AS bids
    FROM told WHERE parent IS NOT NULL AND market LIKE 'M%'),
chain AS (SELECT exchange_id, pair_id, row_number() OVER (ORDER BY place, exchange_id, pos) AS ord, type, simulation, place || '-' || exchange_id || '-' || pos AS id, seq, jump, event_time, asks, bids,
                 row_number() OVER (PARTITION BY exchange_id, pair_id ORDER BY place, pos) AS n FROM spoken)"""
_SCALED = f""", {MARKETS}, tens(k, f) AS (SELECT k, CASE WHEN k < 0 THEN 1::DECIMAL(38,12) / (10 ** -k)::BIGINT ELSE (10 ** k)::BIGINT END::DECIMAL(20,6) FROM (SELECT unnest(range(-6, 7)) AS k)),
given AS (SELECT exchange_id, pair_id, ord, 'asks' AS side, asks AS levels FROM kept WHERE asks IS NOT NULL UNION ALL SELECT exchange_id, pair_id, ord, 'bids', bids FROM kept WHERE bids IS NOT NULL),
spread AS (SELECT exchange_id, pair_id, ord, side, unnest(range(1, len(levels) + 1)) AS i, levels FROM given),
based AS (SELECT s.exchange_id, s.pair_id, s.ord, s.side, s.i, levels[i].price::DECIMAL(16,4) * x.f AS price, levels[i].quantity::DECIMAL(16,4) * y.f AS quantity, m.pp, m.qp
          FROM spread s JOIN tens x ON x.k = [0, -1, -2, -6, 3][1 + (s.exchange_id + s.pair_id) % 5] JOIN tens y ON y.k = [0, 0, 2, 6, -3][1 + (s.exchange_id + s.pair_id) % 5] LEFT JOIN markets m ON m.id = s.pair_id),
truncated AS (SELECT *, CASE WHEN pp IS NULL THEN price ELSE trunc(price * power(10, pp)::BIGINT) / power(10, pp)::BIGINT END::DECIMAL(38,10) AS cut FROM based),
gathered AS (SELECT exchange_id, pair_id, ord, side, cut, min(i) AS i, sum(quantity) AS q, any_value(qp) AS qp FROM truncated GROUP BY ALL),
lists AS (SELECT exchange_id, pair_id, ord, side, list({{'price': cut, 'quantity': CASE WHEN qp IS NULL THEN q ELSE trunc(q * power(10, qp)::BIGINT) / power(10, qp)::BIGINT END::DECIMAL(38,10)}} ORDER BY i) AS levels FROM gathered GROUP BY ALL),
scaled AS (SELECT k.* REPLACE (CASE WHEN k.asks IS NOT NULL THEN coalesce(a.levels, []) END AS asks, CASE WHEN k.bids IS NOT NULL THEN coalesce(b.levels, []) END AS bids) FROM kept k
           LEFT JOIN lists a ON a.exchange_id = k.exchange_id AND a.pair_id = k.pair_id AND a.ord = k.ord AND a.side = 'asks' LEFT JOIN lists b ON b.exchange_id = k.exchange_id AND b.pair_id = k.pair_id AND b.ord = k.ord AND b.side = 'bids')"""
ORACLE_SQL["full_chain"] = _rules(_CHAIN, "chain", "f.jump") + _SCALED + _books("scaled", "DECIMAL(38,10)") + _UNIONED + """
    SELECT v.pair_id, v.side, (SELECT count(*) FROM (SELECT DISTINCT simulation, price FROM placed p WHERE p.pair_id = v.pair_id AND p.side = v.side AND p.ord = v.ord)) AS n, v.event_time
    FROM views v WHERE v.ord = (SELECT max(ord) FROM views w WHERE w.pair_id = v.pair_id AND w.side = v.side)"""

_FINAL = "final AS (SELECT b.* FROM books b WHERE ord = (SELECT max(ord) FROM books c WHERE c.exchange_id = b.exchange_id AND c.pair_id = b.pair_id))"
ORACLE_SQL["display_books"] = BOOKS + f""", {_FINAL}, told AS (SELECT f.exchange_id, f.pair_id, f.ord, a.side, a.price, {_canon('a.price')} AS p, {_canon('a.quantity')} AS q FROM final f JOIN alive a USING (exchange_id, pair_id, ord)),
    most AS (SELECT exchange_id, pair_id, max(CASE WHEN contains(p, '.') THEN length(p) - strpos(p, '.') ELSE 0 END) AS n FROM told GROUP BY ALL),
    padded AS (SELECT t.*, CASE WHEN n = 0 THEN p WHEN contains(p, '.') THEN p || repeat('0', n - length(p) + strpos(p, '.')) ELSE p || '.' || repeat('0', n) END || '@' || q AS shown FROM told t JOIN most USING (exchange_id, pair_id))
    SELECT f.exchange_id, f.pair_id, f.ord, coalesce((SELECT string_agg(shown, ',' ORDER BY price DESC) FROM padded p WHERE p.exchange_id = f.exchange_id AND p.pair_id = f.pair_id AND side = 'asks'), '') AS asks,
           coalesce((SELECT string_agg(shown, ',' ORDER BY price DESC) FROM padded p WHERE p.exchange_id = f.exchange_id AND p.pair_id = f.pair_id AND side = 'bids'), '') AS bids FROM final f"""
ORACLE_SQL["view_messages"] = BOOKS + f""", {_FINAL}, best AS (SELECT exchange_id, pair_id, ord, side, arg_min(price, {_KEYED}) AS price, arg_min(quantity, {_KEYED}) AS quantity FROM alive GROUP BY ALL)
    SELECT f.pair_id, f.exchange_id, 'select' AS type, s.side AS view_side, {_canon('b.price')} AS best, {_canon('b.quantity')} AS best_quantity, f.event_time::VARCHAR AS at
    FROM final f CROSS JOIN (VALUES ('asks'), ('bids')) s(side) LEFT JOIN best b ON b.exchange_id = f.exchange_id AND b.pair_id = f.pair_id AND b.ord = f.ord AND b.side = s.side"""
ORACLE_SQL["avro_events"] = f"""WITH {FEED} SELECT CASE WHEN ord % 2 = 0 THEN 1 ELSE 2 END AS schema_id, exchange_id, pair_id, ord, type, CASE WHEN ord % 2 = 0 THEN 7 ELSE simulation END AS simulation, id, seq AS sequence_id, event_time, {_written('asks')} AS asks, {_written('bids')} AS bids FROM feed"""
