"""The document table over the given tables: one document per order, with customer, place and line attributes."""

from docloom.operators.rules import IngestRule
from docloom.operators.source import DocSource

PARTS = 4

ORDER_QUERY = """
SELECT o.o_orderkey AS `order_id:id`,
       coalesce(c.c_nationkey, 0) AS `nation_id:attr_uint`,
       coalesce(n.n_name, '') AS `nation_text:field`,
       coalesce(r.r_name, '') AS `region_text:field`,
       coalesce(c.c_mktsegment, '') AS `segment_text:field`,
       o.o_orderpriority AS `priority_text:field`,
       concat_ws(' ', c.c_name, o.o_orderpriority) AS `title_text:field`,
       o.o_orderstatus AS `status:attr_string`,
       o.o_totalprice AS `total:attr_float`,
       radians(c.c_acctbal) AS `balance_rad:attr_float`,
       unix_timestamp(o.o_orderdate) AS `ordered_at:attr_uint`,
       coalesce(l.n_lines, 0) AS `lines:attr_uint`,
       l.quantity AS `quantity:attr_float`,
       l.line_codes AS `line_codes:attr_multi_64`,
       l.suppliers AS `suppliers:attr_multi`,
       l.part_sizes AS `part_sizes:attr_multi`
FROM {orders} o
LEFT JOIN {customer} c ON c.c_custkey = o.o_custkey
LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey
LEFT JOIN {region} r ON r.r_regionkey = n.n_regionkey
LEFT JOIN (
    SELECT x.l_orderkey,
           count(*) AS n_lines,
           sum(x.l_quantity) AS quantity,
           collect_set((x.l_partkey << 4) | x.l_linenumber) AS line_codes,
           collect_set(x.l_suppkey) AS suppliers,
           collect_set(p.p_size) AS part_sizes
    FROM {lineitem} x
    LEFT JOIN {part} p ON p.p_partkey = x.l_partkey
    GROUP BY x.l_orderkey
) l ON l.l_orderkey = o.o_orderkey
"""

ORDER_DOC = DocSource(
    name="order_doc",
    query=ORDER_QUERY,
    tables={
        "orders": "o_orderkey",
        "lineitem": "l_orderkey",
        "customer": None,
        "nation": None,
        "region": None,
        "part": None,
    },
    parts=PARTS,
)

ORDERS_RULE = IngestRule(
    table="orders",
    id_field="o_orderkey",
    index="order_doc",
    column_map={
        "o_custkey": ("nation_id", "nation_text", "region_text", "segment_text", "title_text", "balance_rad"),
        "o_orderstatus": ("status",),
        "o_totalprice": ("total",),
        "o_orderdate": ("ordered_at",),
        "o_orderpriority": ("priority_text", "title_text"),
    },
)
LINES_RULE = IngestRule(
    table="lineitem",
    id_field="l_orderkey",
    index="order_doc",
    column_map={
        "l_partkey": ("line_codes", "part_sizes", "lines"),
        "l_suppkey": ("suppliers",),
        "l_linenumber": ("line_codes",),
        "l_quantity": ("quantity",),
    },
)
RULES = (ORDERS_RULE, LINES_RULE)
