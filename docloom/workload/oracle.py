"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from docloom.workload import feeds as sql
from docloom.workload.inputs import FLUSH, GAP, HOLD, LONG_HOLD
from docloom.workload.orders import LINES_RULE, ORDERS_RULE, PARTS

ORDER_COLS = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
LINE_COLS = ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
IN_PLACE = (
    "nation_id", "total", "balance_rad", "ordered_at", "lines", "quantity", "line_codes", "suppliers", "part_sizes",
)


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def docs(orders: str, lineitem: str) -> str:
    """The order documents."""
    def numbers(x):
        return f"array_to_string(list_sort(list(DISTINCT {x})), ',')"

    return f"""
SELECT o.o_orderkey AS order_id,
       CAST(coalesce(c.c_nationkey, 0) AS BIGINT) AS nation_id,
       coalesce(n.n_name, '') AS nation_text,
       coalesce(r.r_name, '') AS region_text,
       coalesce(c.c_mktsegment, '') AS segment_text,
       o.o_orderpriority AS priority_text,
       concat_ws(' ', c.c_name, o.o_orderpriority) AS title_text,
       o.o_orderstatus AS status,
       round(o.o_totalprice, 6) AS total,
       round(coalesce(radians(c.c_acctbal), 0), 6) AS balance_rad,
       CAST(epoch(o.o_orderdate) AS BIGINT) AS ordered_at,
       CAST(coalesce(l.n_lines, 0) AS BIGINT) AS lines,
       round(coalesce(l.quantity, 0), 6) AS quantity,
       coalesce(l.line_codes, '') AS line_codes,
       coalesce(l.suppliers, '') AS suppliers,
       coalesce(l.part_sizes, '') AS part_sizes
FROM {orders} o
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN (
    SELECT x.l_orderkey, count(*) AS n_lines, sum(x.l_quantity) AS quantity,
           {numbers("x.l_partkey * 16 | x.l_linenumber")} AS line_codes,
           {numbers("x.l_suppkey")} AS suppliers,
           {numbers("p.p_size")} AS part_sizes
    FROM {lineitem} x LEFT JOIN part p ON p.p_partkey = x.l_partkey
    GROUP BY x.l_orderkey
) l ON l.l_orderkey = o.o_orderkey
"""


def _orders_routed() -> str:
    old = ", ".join(f"old_{c}" for c in ORDER_COLS)
    none_old = ", ".join(f"NULL AS old_{c}" for c in ORDER_COLS)
    new_kept = ", ".join(f"CASE WHEN NOT moved THEN new_{c} END AS new_{c}" for c in ORDER_COLS)
    new = ", ".join(f"new_{c}" for c in ORDER_COLS)
    return f"""
SELECT seq, 0 AS sub_no, CASE WHEN moved THEN 'delete' ELSE action END AS action,
       CASE WHEN action = 'insert' THEN new_o_orderkey ELSE old_o_orderkey END AS doc_id, {old}, {new_kept}
FROM fo_moved
UNION ALL
SELECT seq, 1 AS sub_no, 'insert' AS action, new_o_orderkey AS doc_id, {none_old}, {new}
FROM fo_moved WHERE moved
"""


def _net(rows: str, keys: str, cols, order: str) -> str:
    olds = ", ".join(f"first(old_{c} ORDER BY {order}) AS old_{c}" for c in cols)
    news = ", ".join(f"last(new_{c} ORDER BY {order}) AS new_{c}" for c in cols)
    return f"""
SELECT {keys}, {olds}, {news},
       f = 'insert' AND nd = 0 AS is_insert,
       NOT (f = 'insert' AND nd = 0) AND NOT (l = 'delete' AND NOT (f = 'insert' AND nd = 1)) AS is_update,
       l = 'delete' AND NOT (f = 'insert' AND nd = 1) AS is_delete
FROM (SELECT *, first_value(action) OVER w AS f, last_value(action) OVER w AS l,
             count(*) FILTER (action = 'delete') OVER w AS nd
      FROM {rows}
      WINDOW w AS (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
GROUP BY {keys}, f, l, nd
"""


def _differs(cols) -> str:
    return "(" + " OR ".join(f"old_{c} IS DISTINCT FROM new_{c}" for c in cols) + ")"


def _lines_changed() -> str:
    def image(side):
        return "{" + ", ".join(f"'{c}': {side}_{c}" for c in LINE_COLS) + "}"

    each = " UNION ALL ".join(
        f"SELECT doc_id, '{c}' AS col FROM sets WHERE b <> a AND (len(b) > 1 OR len(a) > 1 OR d_{c})" for c in LINE_COLS
    )
    diffs = ", ".join(f"bool_or(old_{c} IS DISTINCT FROM new_{c}) AS d_{c}" for c in LINE_COLS)
    return f"""
WITH sets AS (
    SELECT doc_id,
           coalesce(list_sort(list(DISTINCT {image("old")}) FILTER (is_delete OR is_update)), []) AS b,
           coalesce(list_sort(list(DISTINCT {image("new")}) FILTER (is_insert OR is_update)), []) AS a, {diffs}
    FROM nl WHERE {_differs(LINE_COLS)} GROUP BY doc_id)
{each}
"""


def _column_map() -> str:
    rows = [
        f"('{r.table}', '{c}', '{a}')" for r in (ORDERS_RULE, LINES_RULE) for c, attrs in r.column_map.items() for a in attrs
    ]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS m(tab, col, attr)"


def _line_key(side: str, columns=sql.LINE_KEY) -> str:
    return "concat_ws('|', " + ", ".join(f"{side}_{c}" for c in columns) + ")"


_tables = {"orders": "orders", "lineitem": "lineitem", "events": "events"}
_line_ids = "seq, action, CASE WHEN action = 'insert' THEN new_l_orderkey ELSE old_l_orderkey END AS doc_id"

VIEWS = {
    "fo": sql.F_ORDERS.format(**_tables),
    "fl": sql.F_LINES.format(**_tables),
    "ob": sql.before("FROM fo", sql.ORDER_COLUMNS),
    "oa": sql.after("FROM fo", sql.ORDER_COLUMNS),
    "lb": sql.before("FROM fl", sql.LINE_COLUMNS),
    "la": sql.after("FROM fl", sql.LINE_COLUMNS),
    "fo_moved": "SELECT *, action = 'update' AND new_o_orderkey <> old_o_orderkey AS moved FROM fo",
    "ro": _orders_routed(),
    "rl": f"SELECT {_line_ids}, CASE WHEN action = 'insert' THEN new_generation ELSE old_generation END AS generation, "
    + f"CASE WHEN action = 'insert' THEN {_line_key('new')} ELSE {_line_key('old')} END AS row_key, "
    + ", ".join(f"old_{c}, new_{c}" for c in LINE_COLS) + " FROM fl",
    "no": _net("ro", "doc_id", ORDER_COLS, "seq, sub_no"),
    "nl": _net("rl", "doc_id, row_key, generation", LINE_COLS, "seq"),
    "co": " UNION ALL ".join(
        f"SELECT doc_id, '{c}' AS col FROM no WHERE old_{c} IS DISTINCT FROM new_{c}" for c in ORDER_COLS
    ),
    "cl": _lines_changed(),
    "cmap": _column_map(),
    "ca": """
        SELECT DISTINCT x.doc_id, m.attr
        FROM (SELECT 'orders' AS tab, * FROM co UNION ALL SELECT 'lineitem', * FROM cl) x
        JOIN cmap m ON m.tab = x.tab AND m.col = x.col""",
    "docs": docs("orders", "lineitem"),
    "db": docs("ob", "lb"),
    "da": docs("oa", "la"),
    "dec": f"""
        SELECT c.doc_id, CAST(c.doc_id % {PARTS} AS BIGINT) AS part, c.attrs, da.title_text, da.total, da.suppliers,
               CASE WHEN da.order_id IS NULL THEN 'delete' WHEN c.n_other = 0 THEN 'update' ELSE 'replace' END AS action
        FROM (SELECT doc_id, string_agg(attr, ',' ORDER BY attr) AS attrs,
                     count(*) FILTER (attr NOT IN ({_names(IN_PLACE)})) AS n_other
              FROM ca GROUP BY doc_id) c
        LEFT JOIN da ON da.order_id = c.doc_id""",
    "ue": "SELECT 'user_doc' AS index, user_id AS doc_id, event_id AS seq, event_id, ts, epoch_us(ts) AS us FROM events",
    "ub": """
        SELECT index, doc_id, count(*) AS n_rows, min(event_id) AS first_event_id, min(seq) AS first_seq,
               max(seq) AS last_seq, first(us ORDER BY seq) AS first_us, max(us) AS last_us
        FROM ue GROUP BY index, doc_id""",
    "us": f"""
        SELECT *, now - last_us >= {GAP}000000 OR now - first_us >= {LONG_HOLD}000000 AS ready
        FROM (SELECT *, max(last_us) OVER () AS now FROM ub)""",
}


def _with(select: str) -> str:
    """`select` with the views it needs."""
    import re

    need: list[str] = []

    def visit(text):
        for name in VIEWS:
            if name not in need and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(VIEWS[name])
                need.append(name)

    visit(select)
    return ("WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in need) + " " if need else "") + select


_flags = "is_insert, is_update, is_delete"
_no_diff, _nl_diff = _differs(ORDER_COLS), _differs(LINE_COLS)

_raw_lines = """
    SELECT l_orderkey * 10 + l_linenumber AS seq, l_quantity AS q,
           CASE l_linenumber % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS action
    FROM lineitem"""

_settle = f"""
WITH RECURSIVE ticks AS (
    SELECT doc_id, tick, first(us ORDER BY seq) AS first_us, max(us) AS last_us, count(*) AS n,
           row_number() OVER (PARTITION BY doc_id ORDER BY tick) AS rn
    FROM (SELECT user_id AS doc_id, event_id AS seq, epoch_us(ts) AS us,
                 (epoch_us(ts) + {FLUSH}000000 - 1) // {FLUSH}000000 AS tick FROM events)
    GROUP BY doc_id, tick),
st AS (
    SELECT doc_id, rn, CAST(0 AS BIGINT) AS b, first_us AS f, last_us AS l, n FROM ticks WHERE rn = 1
    UNION ALL
    SELECT t.doc_id, t.rn, CASE WHEN j THEN b ELSE b + 1 END, CASE WHEN j THEN f ELSE first_us END,
           CASE WHEN j THEN greatest(l, last_us) ELSE last_us END, CASE WHEN j THEN s.n + t.n ELSE t.n END
    FROM (SELECT *, (least(l + {GAP}000000, f + {HOLD}000000) + {FLUSH}000000 - 1) // {FLUSH}000000 AS ready FROM st) s
    JOIN (SELECT * FROM ticks) t ON t.doc_id = s.doc_id AND t.rn = s.rn + 1,
    LATERAL (SELECT s.ready >= t.tick AS j))
SELECT 'user_doc' AS index, doc_id, b AS batch_no, max(f) AS first_us, max(l) AS last_us, CAST(max(n) AS BIGINT) AS n_rows,
       (least(max(l) + {GAP}000000, max(f) + {HOLD}000000) + {FLUSH}000000 - 1) // {FLUSH}000000 * {FLUSH}000000 AS flush_us
FROM st GROUP BY doc_id, b"""

_net_set = """
WITH RECURSIVE moves AS (
    SELECT user_id, event_id,
           CASE WHEN value >= 10 THEN event_type END AS o,
           CASE WHEN event_type = 'view' THEN 'click' WHEN event_type = 'click' THEN 'purchase'
                WHEN event_type = 'purchase' THEN 'error' WHEN value < 5 THEN 'signup' END AS n
    FROM events),
steps AS (
    SELECT user_id, value, delta, row_number() OVER (PARTITION BY user_id, value ORDER BY event_id, sub) AS rn
    FROM (SELECT user_id, event_id, 0 AS sub, o AS value, -1 AS delta FROM moves WHERE o IS DISTINCT FROM n
          UNION ALL SELECT user_id, event_id, 1, n, 1 FROM moves WHERE o IS DISTINCT FROM n)
    WHERE value IS NOT NULL),
st AS (
    SELECT user_id, value, rn, delta AS s FROM steps WHERE rn = 1
    UNION ALL
    SELECT t.user_id, t.value, t.rn, greatest(-1, least(1, st.s + t.delta))
    FROM st JOIN steps t ON t.user_id = st.user_id AND t.value = st.value AND t.rn = st.rn + 1)
SELECT user_id, value, CAST(last(s ORDER BY rn) AS BIGINT) AS net FROM st GROUP BY user_id, value
HAVING last(s ORDER BY rn) <> 0"""

_u32 = "4294967295"

_SELECTS = {
    "cdc_scan": "SELECT 'orders' AS \"table\", seq, action, doc_id FROM ro"
    " UNION ALL SELECT 'lineitem', seq, action, doc_id FROM rl",
    "cdc_table_prune": "SELECT action, count(*) AS n_rows, CAST(sum(seq) AS BIGINT) AS seq_sum FROM fl GROUP BY action",
    "snapshot_as_inserts": f"""
        WITH dump AS (
            SELECT -1 AS seq, 0 AS sub_no, 'insert' AS action, o_orderkey AS doc_id, NULL AS old_o_totalprice,
                   o_totalprice AS new_o_totalprice FROM ob
            UNION ALL SELECT seq, sub_no, action, doc_id, old_o_totalprice, new_o_totalprice FROM ro)
        SELECT doc_id, {_flags}, old_o_totalprice AS old_price, new_o_totalprice AS new_price
        FROM ({_net("dump", "doc_id", ("o_totalprice",), "seq, sub_no")})""",
    "resume_from_position": "SELECT seq, action, new_o_orderkey AS new_key FROM fo"
    " WHERE seq > (SELECT max(seq) // 2 FROM fo)",
    "wait_position": "SELECT action, count(*) AS n_applied, false AS next_applied FROM fo"
    " WHERE seq <= (SELECT max(seq) // 2 FROM fo) GROUP BY action",
    "route_rules": """
        SELECT CAST(r.rule_id AS BIGINT) AS rule_id, r.idx AS index, r.id_field, e.tab AS "table", e.seq, e.action
        FROM (SELECT 'orders' AS tab, seq, action FROM fo UNION ALL SELECT 'lineitem', seq, action FROM fl) e
        JOIN (VALUES (0, 'orders', 'order_doc', 'o_orderkey'), (1, 'lineitem', 'order_doc', 'l_orderkey'),
                     (2, 'orders', 'customer_doc', 'o_custkey')) AS r(rule_id, tab, idx, id_field) ON r.tab = e.tab""",
    "flatten_rows": f"""
        SELECT e.seq, e.action, CAST(k.k AS BIGINT) AS row_no,
               CASE e.action WHEN 'delete' THEN q + k.k WHEN 'update' THEN q + 2 * k.k END AS old_quantity,
               CASE e.action WHEN 'insert' THEN q + k.k WHEN 'update' THEN q + 2 * k.k + 1 END AS new_quantity,
               CAST(CASE e.action WHEN 'delete' THEN k.k WHEN 'update' THEN 2 * k.k END AS BIGINT) AS old_row,
               CAST(CASE e.action WHEN 'insert' THEN k.k WHEN 'update' THEN 2 * k.k + 1 END AS BIGINT) AS new_row
        FROM ({_raw_lines}) e
        JOIN (VALUES ('insert', 0), ('insert', 1), ('insert', 2), ('delete', 0), ('delete', 1), ('delete', 2),
                     ('update', 0), ('update', 1)) AS k(action, k) ON k.action = e.action""",
    "row_count": f"""
        SELECT action, count(*) AS n_events, CAST(count(*) * CASE action WHEN 'update' THEN 2 ELSE 3 END AS BIGINT)
               AS n_rows FROM ({_raw_lines}) GROUP BY action""",
    "doc_id_extract": """
        SELECT event_id, CASE WHEN user_id = 7 THEN 0 ELSE user_id END AS doc_id,
               CASE WHEN user_id = 8 THEN 0 ELSE user_id END AS number_id FROM events""",
    "doc_move_split": """
        WITH m AS (
            SELECT *, action = 'update' AND old_o_orderpriority <> '5-LOW' AND new_o_orderkey <> old_o_orderkey AS mv
            FROM fo)
        SELECT seq, CAST(0 AS BIGINT) AS sub_no, CASE WHEN mv THEN 'delete' ELSE action END AS action,
               CASE WHEN action = 'insert' THEN new_o_orderkey ELSE old_o_orderkey END AS doc_id,
               old_o_totalprice AS old_price, CASE WHEN mv IS NOT TRUE THEN new_o_totalprice END AS new_price FROM m
        UNION ALL SELECT seq, 1, 'insert', new_o_orderkey, NULL, new_o_totalprice FROM m WHERE mv""",
    "column_prune": "SELECT seq, doc_id, action, 'l_partkey,l_suppkey,l_linenumber,l_quantity' AS columns, "
    + ", ".join(
        f"CAST({s}_{c} AS BIGINT) AS {s}_{c}" if c == "l_linenumber" else f"{s}_{c}"
        for s in ("old", "new") for c in LINE_COLS
    )
    + ", false AS image_missing FROM rl",
    "pk_fallback": f"""
        WITH k AS (
            SELECT {_line_ids}, NULL AS old_x, NULL AS new_x,
                   CASE WHEN action = 'insert' THEN new_l_tax ELSE old_l_tax END AS tax,
                   CASE WHEN action = 'insert' THEN {_line_key('new', sql.LINE_COLUMNS)}
                        ELSE {_line_key('old', sql.LINE_COLUMNS)} END AS k
            FROM fl)
        SELECT doc_id, count(*) AS n_keys, count(*) FILTER (is_insert) AS n_insert,
               count(*) FILTER (is_update) AS n_update, count(*) FILTER (is_delete) AS n_delete,
               min(tax) AS least_tax
        FROM ({_net("k", "doc_id, k, tax", ("x",), "seq")}) GROUP BY doc_id""",
    "part_route": "SELECT o_orderkey, o_orderkey % 7 AS part FROM orders",
    "doc_query_full": "SELECT * FROM docs",
    "typed_alias": """
        SELECT c_custkey, c_name AS name, c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey,
               c_custkey * -3 AS minus, round(c_acctbal / 7, 6) AS balance,
               array_to_string(list_sort(list_distinct([c_custkey, c_nationkey])), ',') AS pair,
               array_to_string(list_sort(list_distinct([c_custkey, c_nationkey])), ',') AS pair64
        FROM customer""",
    "doc_query_changed": "SELECT * FROM da WHERE order_id IN (SELECT doc_id FROM ca)",
    "multi_attr": """
        SELECT l_orderkey AS id,
               array_to_string(list_sort(list(DISTINCT l_partkey * 16 | l_linenumber)), ',') AS line_codes,
               array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS suppliers
        FROM lineitem GROUP BY l_orderkey""",
    "doc_dedupe": """
        SELECT l_orderkey AS id, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_quantity DESC) = 1""",
    "coerce_types": f"""
        SELECT o_orderkey, CAST(trunc(o_totalprice - 200000) AS BIGINT) & {_u32} AS as_uint,
               CAST(trunc(o_totalprice - 200000) AS BIGINT) AS as_bigint,
               round((o_totalprice - 200000) / 7, 6) AS as_float,
               CASE WHEN o_custkey = 5 THEN 0 ELSE o_custkey END AS maybe_uint,
               CASE WHEN o_custkey = 5 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS maybe_string,
               CASE WHEN o_custkey = 6 THEN 0 ELSE o_custkey END AS text_uint,
               CASE WHEN o_custkey = 6 THEN 0 ELSE -o_custkey END AS text_bigint,
               array_to_string(list_sort(list_distinct([o_custkey, o_orderkey])), ',') AS as_multi
        FROM orders""",
    "strip_nul": "SELECT doc_id, md5(text || source) AS digest, length(text || source) AS n FROM documents",
    "binary_compare": "SELECT doc_id, 'text' AS columns FROM documents WHERE lang = 'en'",
    "net_row_change": f"""
        SELECT 'orders' AS "table", doc_id, doc_id AS key, {_flags},
               old_o_totalprice AS old_value, new_o_totalprice AS new_value FROM no
        UNION ALL SELECT 'lineitem', doc_id, CAST(generation AS BIGINT), {_flags}, old_l_quantity, new_l_quantity FROM nl""",
    "prune_noop": f"""
        SELECT 'orders' AS "table", doc_id, count(*) AS n_rows FROM no WHERE {_no_diff} GROUP BY doc_id
        UNION ALL SELECT 'lineitem', doc_id, count(*) FROM nl WHERE {_nl_diff} GROUP BY doc_id""",
    "set_equal_prune": "SELECT DISTINCT doc_id FROM cl",
    "changed_columns": """
        SELECT tab AS "table", doc_id, string_agg(col, ',' ORDER BY n) AS columns
        FROM (SELECT 'orders' AS tab, * FROM co UNION ALL SELECT 'lineitem', * FROM cl) x
        JOIN (VALUES """
    + ", ".join(f"('{c}', {n})" for cs in (ORDER_COLS, LINE_COLS) for n, c in enumerate(cs))
    + """) AS o(c, n) ON o.c = x.col GROUP BY tab, doc_id""",
    "changed_attrs": """
        SELECT 'order_doc' AS index, doc_id, string_agg(attr, ',' ORDER BY attr) AS attrs FROM ca GROUP BY doc_id""",
    "changed_docs": """
        SELECT doc_id, doc_id IN (SELECT doc_id FROM ca) AS changed
        FROM (SELECT doc_id FROM ro UNION SELECT doc_id FROM rl)""",
    "net_plain_value": """
        SELECT user_id, old_value, new_value
        FROM (SELECT user_id, first(event_type ORDER BY event_id) AS old_value,
                     last(CASE WHEN value > 20 THEN 'purchase' ELSE event_type END ORDER BY event_id) AS new_value
              FROM events GROUP BY user_id)
        WHERE old_value IS DISTINCT FROM new_value""",
    "decide_action": "SELECT doc_id, part, action, attrs, title_text, total, suppliers FROM dec",
    "actions_per_part": "SELECT part, action, count(*) AS n_docs FROM dec GROUP BY part, action",
    "sync_counters": """
        SELECT 'row_events:orders' AS counter, count(*) AS n FROM fo
        UNION ALL SELECT 'row_events:lineitem', count(*) FROM fl
        UNION ALL SELECT 'doc_events:orders', count(*) FROM ro
        UNION ALL SELECT 'doc_events:lineitem', count(*) FROM rl
        UNION ALL SELECT 'docs:' || action, count(*) FROM dec GROUP BY action""",
    "apply_changes": "SELECT * FROM da",
    "apply_partial_update": """
        SELECT db.* REPLACE (
                   CASE WHEN a.nation_id THEN da.nation_id ELSE db.nation_id END AS nation_id,
                   CASE WHEN a.total THEN da.total ELSE db.total END AS total,
                   CASE WHEN a.balance_rad THEN da.balance_rad ELSE db.balance_rad END AS balance_rad,
                   CASE WHEN a.ordered_at THEN da.ordered_at ELSE db.ordered_at END AS ordered_at,
                   CASE WHEN a.lines THEN da.lines ELSE db.lines END AS lines,
                   CASE WHEN a.quantity THEN da.quantity ELSE db.quantity END AS quantity,
                   CASE WHEN a.line_codes THEN da.line_codes ELSE db.line_codes END AS line_codes,
                   CASE WHEN a.suppliers THEN da.suppliers ELSE db.suppliers END AS suppliers,
                   CASE WHEN a.part_sizes THEN da.part_sizes ELSE db.part_sizes END AS part_sizes)
        FROM db JOIN dec ON dec.doc_id = db.order_id AND dec.action = 'update' JOIN da ON da.order_id = db.order_id
        JOIN (SELECT doc_id, """
    + ", ".join(f"bool_or(attr = '{a}') AS {a}" for a in IN_PLACE)
    + """ FROM ca GROUP BY doc_id) a ON a.doc_id = db.order_id
        WHERE db.status <> 'O'
        UNION ALL SELECT da.* FROM da JOIN dec ON dec.doc_id = da.order_id AND dec.action = 'replace'
        UNION ALL SELECT db.* FROM db WHERE status <> 'O' AND order_id NOT IN (SELECT doc_id FROM ca)""",
    "apply_deletes": """
        SELECT order_id, total FROM db WHERE order_id NOT IN (SELECT doc_id FROM dec WHERE action = 'delete')""",
    "multi_target_apply": """
        SELECT CAST(0 AS BIGINT) AS replica, * FROM da UNION ALL SELECT CAST(1 AS BIGINT), * FROM da""",
    "idempotent_replay": "SELECT *, CAST(3 AS BIGINT) AS n_versions FROM da",
    "commit_log": """
        SELECT 'order_doc' AS target, CAST(1 AS BIGINT) AS version, 'rebuild' AS kind, CAST(NULL AS BIGINT) AS batch_id,
               CAST(0 AS BIGINT) AS seq, CAST(0 AS BIGINT) AS n_replace, CAST(0 AS BIGINT) AS n_update,
               CAST(0 AS BIGINT) AS n_delete
        UNION ALL
        SELECT 'order_doc', 2, 'apply', 1, (SELECT max(seq) FROM fo), count(*) FILTER (action = 'replace'),
               count(*) FILTER (action = 'update'), count(*) FILTER (action = 'delete') FROM dec""",
    "stream_apply": "SELECT *, greatest((SELECT max(seq) FROM fo), (SELECT max(seq) FROM fl)) AS seq FROM da",
    "doc_batches": "SELECT * FROM ub",
    "queue_stats": """
        SELECT 'user_doc' AS index, count(DISTINCT user_id) AS n_docs, count(*) AS n_rows FROM events
        UNION ALL
        SELECT 'order_doc', count(DISTINCT doc_id), count(*)
        FROM (SELECT doc_id FROM ro UNION ALL SELECT doc_id FROM rl)""",
    "settle_split": "SELECT index, doc_id, n_rows, ready FROM us",
    "safe_position": """
        SELECT 'waiting' AS queue,
               coalesce((SELECT min(first_event_id) FROM us WHERE NOT ready), (SELECT max(event_id) FROM events)) AS event_id
        UNION ALL SELECT 'empty', max(event_id) FROM events""",
    "event_tagging": """
        SELECT event_id AS seq, count(*) FILTER (event_type = 'purchase') OVER (ORDER BY event_id) AS event_id
        FROM events""",
    "rebuild_full": "SELECT * FROM docs",
    "rebuild_one_part": f"""
        SELECT * FROM db WHERE order_id % {PARTS} <> 1 UNION ALL SELECT * FROM da WHERE order_id % {PARTS} = 1""",
    "rebuild_swap": "SELECT 'old' AS state, * FROM db UNION ALL SELECT 'new', * FROM da",
    "rebuild_then_replay": "SELECT *, greatest((SELECT max(seq) FROM fo), (SELECT max(seq) FROM fl)) AS seq FROM da",
    "build_mode_replay": "SELECT *, CAST(0 AS BIGINT) AS seq FROM da",
    "rebuild_log": """
        SELECT 'first' AS build_id, 'order_doc' AS indexes, true AS success, count(*) AS n_docs, true AS finished FROM db
        UNION ALL SELECT 'second', 'order_doc', true, count(*), true FROM da""",
    "target_ready": """
        SELECT CAST(r.replica AS BIGINT) AS replica, 'order_doc' AS index, r.ready,
               CASE WHEN r.replica < 2 THEN (SELECT count(*) FROM docs) END AS n_docs
        FROM (VALUES (0, true), (1, false), (2, false)) AS r(replica, ready)""",
    "replica_agreement": f"""
        SELECT 'rebuilt' AS step, CAST(1 AS BIGINT) AS n_states, true AS agree, CAST(0 AS BIGINT) AS seq,
               CAST(0 AS BIGINT) AS n_apart, CAST(0 AS BIGINT) AS n_parts_apart
        UNION ALL SELECT 'one ahead', 2, false, 0, count(*), count(DISTINCT order_id % {PARTS})
            FROM ((SELECT * FROM da EXCEPT ALL SELECT * FROM db) UNION ALL (SELECT * FROM db EXCEPT ALL SELECT * FROM da))
        UNION ALL SELECT 'both', 1, true, max(seq), 0, 0 FROM fo""",
    "recovery_plan": """
        SELECT p.*, da.* FROM da, (VALUES ('order_doc', CAST(0 AS BIGINT), 'rebuild', 'replicas disagree', CAST(9 AS BIGINT)),
            ('order_doc', 1, 'rebuild', 'replicas disagree', 9), ('late_doc', 0, 'rebuild', 'not ready', 9))
            AS p(index, replica, action, reason, seq)
        UNION ALL SELECT 'kept_doc', 0, 'resume', 'ready', 7, db.* FROM db""",
    "part_status": f"""
        SELECT order_id % {PARTS} AS part, count(*) AS n_docs, true AS has_files, true AS has_base, true AS has_delta
        FROM da GROUP BY ALL""",
    "compaction_candidates": f"""
        SELECT order_id % {PARTS} AS part, count(*) AS n_docs, true AS over, CAST(0 AS BIGINT) AS n_when_off,
               CAST(0 AS BIGINT) AS delta_bytes FROM da GROUP BY 1""",
    "sync_status": """
        SELECT t.target, CASE t.target WHEN 'a' THEN m.top // 2 ELSE 0 END AS seq,
               (SELECT count(*) FROM fo WHERE seq > CASE t.target WHEN 'a' THEN m.top // 2 ELSE 0 END) AS n_waiting,
               m.top AS feed_seq, CAST(90 AS DOUBLE) AS lag_seconds,
               CAST(CASE t.target WHEN 'a' THEN 1 ELSE 0 END AS BIGINT) AS n_batches,
               CASE t.target WHEN 'a' THEN (SELECT count(*) FROM dec WHERE action = 'replace') END AS n_replace,
               CASE t.target WHEN 'a' THEN (SELECT count(*) FROM dec WHERE action = 'update') END AS n_update,
               CASE t.target WHEN 'a' THEN (SELECT count(*) FROM dec WHERE action = 'delete') END AS n_delete
        FROM (VALUES ('a'), ('b')) AS t(target), (SELECT max(seq) AS top FROM fo) m""",
}


def _place_with(select: str) -> str:
    """Views in front of a statement that may begin with a WITH clause of its own."""
    text = select.strip()
    head = _with(text)
    if text.upper().startswith("WITH ") and head is not text:
        views = head[: len(head) - len(text)].rstrip()
        return f"{views}, {text[5:]}" if views else text
    return head


ORACLE = {name: _place_with(select) for name, select in _SELECTS.items()}
ORACLE["settle_batches"] = _settle
ORACLE["net_set_value"] = _net_set
