"""SQL building blocks for the comparison queries. They state the same data mappings as ``plans.datasets``."""

from __future__ import annotations

LINEITEM_MSGS = """
line_msgs AS (
  SELECT CAST(((date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) // 728) % 256) AS SMALLINT) AS epoch,
         ['flag|' || l_returnflag, 'status|' || l_linestatus,
          'disc|' || CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR),
          'qty|' || CAST(CAST(floor(l_quantity / 5) AS INTEGER) AS VARCHAR)] AS layers,
         CASE WHEN l_suppkey % 3 < 2 THEN 20 ELSE 50 END AS threshold,
         CAST(l_orderkey % 3 AS INTEGER) AS batch
  FROM lineitem)"""

EVENT_MSGS = """
event_msgs AS (
  SELECT CAST((date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7) % 256 AS SMALLINT) AS epoch,
         ['type|' || event_type, 'hour|' || CAST(CAST(hour(ts) // 6 AS INTEGER) AS VARCHAR),
          'uid|' || CAST(user_id % 8 AS VARCHAR), 'k|' || json_extract_string(props, '$.k')] AS layers,
         CASE WHEN event_id % 3 < 2 THEN 20 ELSE 50 END AS threshold,
         CAST(event_id AS VARCHAR) AS msg_id, event_id, event_type, ts
  FROM events)"""

ORDER_MSGS = """
order_msgs AS (
  SELECT CAST(date_diff('month', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 256 AS SMALLINT) AS epoch,
         ['segment|' || c_mktsegment, 'nation|' || n_name, 'priority|' || o_orderpriority,
          'status|' || o_orderstatus] AS layers,
         CASE WHEN o_custkey % 3 < 2 THEN 20 ELSE 50 END AS threshold,
         CAST(o_orderkey AS VARCHAR) AS msg_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def classes(source: str, name: str = "classes") -> str:
    """Messages per (epoch, prefix, threshold) of a message table."""
    return f"""
{name} AS (
  SELECT epoch, layers[1:depth] AS prefix, threshold, count(*) AS n, bool_or(depth < len(layers)) AS goes_on
  FROM (SELECT *, unnest(range(1, len(layers) + 1)) AS depth FROM {source})
  GROUP BY ALL)"""


def nodes(source: str = "classes", name: str = "nodes") -> str:
    """Recovered prefixes."""
    return f"""
{name} AS (
  SELECT epoch, prefix, sum(n) AS n, bool_or(goes_on) AS has_children,
         min(CASE WHEN n >= threshold AND threshold >= 2 THEN threshold END) AS recovery_threshold
  FROM {source} GROUP BY epoch, prefix HAVING bool_or(n >= threshold AND threshold >= 2))"""


def revealed(source: str, name: str = "revealed", where: str = "TRUE") -> str:
    """Each message counted at its deepest recovered prefix, found message by message."""
    return f"""{classes(source, name + '_c')},{nodes(name + '_c', name + '_n')},
{name}_m AS (
  SELECT row_number() OVER () AS id, epoch, layers FROM {source}),
{name}_d AS (
  SELECT id, any_value(m.epoch) AS epoch, any_value(m.layers) AS layers, max(depth) AS depth
  FROM (SELECT *, unnest(range(1, len(layers) + 1)) AS depth FROM {name}_m) m
  JOIN {name}_n n ON m.epoch = n.epoch AND m.layers[1:m.depth] = n.prefix
  GROUP BY id),
{name} AS (
  SELECT epoch, layers[1:depth] AS prefix, count(*) AS total, depth < len(layers) AS is_partial
  FROM {name}_d WHERE {where} GROUP BY ALL)"""


def joined(column: str) -> str:
    return f"array_to_string({column}, ',')"


def tag_hex(epoch: str, prefix: str, secret: str = "") -> str:
    """Upper-case hex of the 20-byte tag of a prefix."""
    return f"""upper(list_reduce({prefix}, lambda a, p: substr(sha256(a || '/' || p), 1, 40),
      '{secret}/' || CAST({epoch} AS VARCHAR)))"""


# Defective layers as in ``plans.datasets``; everything from the first one on is out of reach, and marked by one layer
# more that no threshold opens.
DEFECTS = """CASE WHEN event_id % 17 = 0 THEN [layers[1], replace(layers[2], '|', ' '), layers[3], layers[4]]
     WHEN event_id % 19 = 0 THEN [layers[1] || '|x', layers[2], layers[3], layers[4]]
     WHEN event_id % 23 = 0 THEN [layers[1], layers[2], layers[3], 'k'] ELSE layers END"""


def cut(source: str) -> str:
    return f"""
marked AS (
  SELECT *, list_position(list_transform(layers, lambda l: len(l) - len(replace(l, '|', '')) <> 1), TRUE) AS bad FROM {source}),
cut AS (
  SELECT * REPLACE (CASE WHEN bad > 0 THEN list_concat(layers[1:bad - 1], [uuid()::VARCHAR]) ELSE layers END AS layers)
  FROM marked)"""
