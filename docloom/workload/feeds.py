"""Change feeds derived from the given tables by plain SQL that Spark and DuckDB run alike.

Every row of `orders` and `lineitem` takes part: its key picks what happened to it, and the feed carries the row's
images before and after.  `{orders}` and `{lineitem}` are table placeholders.
"""

# scenario, step, action, has_old, has_new, is_first, is_last,
# old_key_add, old_price_add, new_price_add, old_priority, old_customer_null
ORDER_STEPS = """
  (0, 0, 'insert', false, true,  true,  true,  0, 0, 0, NULL, false),
  (1, 0, 'update', true,  true,  true,  true,  0, 100, 0, NULL, false),
  (2, 0, 'update', true,  true,  true,  false, 0, 0, 1, NULL, false),
  (2, 1, 'update', true,  true,  false, true,  0, 1, 0, NULL, false),
  (3, 0, 'delete', true,  false, true,  false, 0, 0, 0, NULL, false),
  (3, 1, 'insert', false, true,  false, true,  0, 0, 0, NULL, false),
  (4, 0, 'insert', false, true,  true,  false, 0, 0, 0, NULL, false),
  (4, 1, 'delete', true,  false, false, true,  0, 0, 0, NULL, false),
  (5, 0, 'update', true,  true,  true,  true,  0, 0, 0, '0-NONE', false),
  (6, 0, 'delete', true,  false, true,  true,  0, 0, 0, NULL, false),
  (7, 0, 'update', true,  true,  true,  true,  1000000000, 0, 0, NULL, false),
  (8, 0, 'insert', false, true,  true,  false, 0, 0, 5, NULL, false),
  (8, 1, 'delete', true,  false, false, false, 0, 5, 0, NULL, false),
  (8, 2, 'insert', false, true,  false, true,  0, 0, 0, NULL, false),
  (9, 0, 'update', true,  true,  true,  true,  0, 0, 0, NULL, true)
"""

F_ORDERS = f"""
SELECT o.o_orderkey * 10 + s.step AS seq,
       o.o_orderkey AS event_id,
       o.o_orderdate + s.step * INTERVAL '1' SECOND AS ts,
       s.action AS action, s.is_first AS is_first, s.is_last AS is_last,
       s.has_old AS has_old, s.has_new AS has_new,
       CASE WHEN s.has_old THEN o.o_orderkey + s.old_key_add END AS old_o_orderkey,
       CASE WHEN s.has_old AND NOT s.old_customer_null THEN o.o_custkey END AS old_o_custkey,
       CASE WHEN s.has_old THEN o.o_orderstatus END AS old_o_orderstatus,
       CASE WHEN s.has_old THEN o.o_totalprice + s.old_price_add END AS old_o_totalprice,
       CASE WHEN s.has_old THEN o.o_orderdate END AS old_o_orderdate,
       CASE WHEN s.has_old THEN coalesce(s.old_priority, o.o_orderpriority) END AS old_o_orderpriority,
       CASE WHEN s.has_new THEN o.o_orderkey END AS new_o_orderkey,
       CASE WHEN s.has_new THEN o.o_custkey END AS new_o_custkey,
       CASE WHEN s.has_new THEN o.o_orderstatus END AS new_o_orderstatus,
       CASE WHEN s.has_new THEN o.o_totalprice + s.new_price_add END AS new_o_totalprice,
       CASE WHEN s.has_new THEN o.o_orderdate END AS new_o_orderdate,
       CASE WHEN s.has_new THEN o.o_orderpriority END AS new_o_orderpriority
FROM {{orders}} o
JOIN (VALUES {ORDER_STEPS}) AS s(scenario, step, action, has_old, has_new, is_first, is_last,
      old_key_add, old_price_add, new_price_add, old_priority, old_customer_null)
  ON o.o_orderkey % 10 = s.scenario
"""
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")

# Lines have no short natural key, so every row carries one in the feed: order, part, line, ship date, the supplier and
# quantity it began with, and a generation that grows when it is deleted and inserted again (a surrogate key).
# 0: re-inserted unchanged; 1: re-inserted, first lines with another quantity; 2: another supplier;
# 3: inserted; 4: deleted; 5: inserted and deleted; 6: unmapped column updated
LINE_STEPS = """
  (0, 0, 'delete', true,  false, true,  false, 0, 0, 0),
  (0, 1, 'insert', false, true,  false, true,  1, 0, 0),
  (1, 0, 'delete', true,  false, true,  false, 0, 1, 0),
  (1, 1, 'insert', false, true,  false, true,  1, 0, 0),
  (2, 0, 'update', true,  true,  true,  true,  0, 0, 1),
  (3, 0, 'insert', false, true,  true,  true,  0, 0, 0),
  (4, 0, 'delete', true,  false, true,  true,  0, 0, 0),
  (5, 0, 'insert', false, true,  true,  false, 0, 0, 0),
  (5, 1, 'delete', true,  false, false, true,  0, 0, 0),
  (6, 0, 'update', true,  true,  true,  true,  0, 0, 0)
"""

F_LINES = f"""
SELECT l.l_orderkey * 100 + l.l_linenumber * 10 + s.step AS seq,
       l.l_orderkey AS event_id,
       l.l_shipdate + s.step * INTERVAL '1' SECOND AS ts,
       s.action AS action, s.is_first AS is_first, s.is_last AS is_last,
       s.has_old AS has_old, s.has_new AS has_new,
       CASE WHEN s.has_old THEN l.l_orderkey END AS old_l_orderkey,
       CASE WHEN s.has_old THEN l.l_partkey END AS old_l_partkey,
       CASE WHEN s.has_old THEN l.l_suppkey + s.old_supplier_add END AS old_l_suppkey,
       CASE WHEN s.has_old THEN l.l_linenumber END AS old_l_linenumber,
       CASE WHEN s.has_old THEN l.l_quantity + CASE WHEN l.l_linenumber = 1 THEN s.old_quantity_add ELSE 0 END
            END AS old_l_quantity,
       CASE WHEN s.has_old THEN l.l_tax + 1 END AS old_l_tax,
       CASE WHEN s.has_old THEN l.l_shipdate END AS old_l_shipdate,
       CASE WHEN s.has_old THEN l.l_suppkey END AS old_key_suppkey,
       CASE WHEN s.has_old THEN l.l_quantity END AS old_key_quantity,
       CASE WHEN s.has_old THEN s.generation END AS old_generation,
       CASE WHEN s.has_new THEN l.l_orderkey END AS new_l_orderkey,
       CASE WHEN s.has_new THEN l.l_partkey END AS new_l_partkey,
       CASE WHEN s.has_new THEN l.l_suppkey END AS new_l_suppkey,
       CASE WHEN s.has_new THEN l.l_linenumber END AS new_l_linenumber,
       CASE WHEN s.has_new THEN l.l_quantity END AS new_l_quantity,
       CASE WHEN s.has_new THEN l.l_tax END AS new_l_tax,
       CASE WHEN s.has_new THEN l.l_shipdate END AS new_l_shipdate,
       CASE WHEN s.has_new THEN l.l_suppkey END AS new_key_suppkey,
       CASE WHEN s.has_new THEN l.l_quantity END AS new_key_quantity,
       CASE WHEN s.has_new THEN s.generation END AS new_generation
FROM {{lineitem}} l
JOIN (VALUES {LINE_STEPS}) AS s(scenario, step, action, has_old, has_new, is_first, is_last,
      generation, old_quantity_add, old_supplier_add)
  ON l.l_orderkey % 7 = s.scenario
"""
LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_shipdate", "key_suppkey",
    "key_quantity", "generation",
)
LINE_KEY = ("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "key_suppkey", "key_quantity", "generation")

# User activity as a feed: each event is one insert for the document of its user.
F_EVENTS = """
SELECT e.event_id AS seq, e.event_id AS event_id, e.ts AS ts, 'insert' AS action, e.user_id AS doc_id,
       e.event_type AS event_type, e.value AS value
FROM {events} e
"""


def before(feed: str, columns) -> str:
    """Rows of the base table before the feed."""
    cols = ", ".join(f"old_{c} AS {c}" for c in columns)
    return f"SELECT {cols} FROM ({feed}) WHERE is_first AND has_old"


def after(feed: str, columns) -> str:
    """Rows of the base table after the feed."""
    cols = ", ".join(f"new_{c} AS {c}" for c in columns)
    return f"SELECT {cols} FROM ({feed}) WHERE is_last AND has_new"
