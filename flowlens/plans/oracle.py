"""DuckDB SQL that states each registered query's expected result.

The SQL reads the same parquet tables and computes the expected fields from
table columns, never from frame bytes: it restates the frame layout of
``flowlens.sources.frames`` field by field, so a decoder bug cannot hide in
both sides.
"""

from __future__ import annotations

from flowlens.sources.frames import EVENT_PORTS, IPV4_OPTIONS, TCP_OPTIONS


def _event_port_case() -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in EVENT_PORTS.items())
    return f"CASE event_type {whens} ELSE 0 END"


def frame_cte(source: str = "events") -> str:
    """CTE ``g``: one row per frame with its expected layer facts."""
    if source == "events":
        base = (f"SELECT event_id AS pkt_id, epoch_us(ts) AS us, user_id AS host, "
                f"{_event_port_case()} AS dport, strlen(coalesce(props, '')) AS plen FROM events")
    elif source == "lineitem":
        base = ("SELECT l_orderkey * 8 + l_linenumber AS pkt_id, epoch_us(l_shipdate) AS us, "
                "l_suppkey AS host, 1024 + l_partkey % 1000 AS dport, "
                "strlen(concat_ws('|', l_returnflag, l_linestatus, CAST(l_partkey AS VARCHAR))) AS plen "
                "FROM lineitem")
    else:
        raise ValueError(source)
    return f"""
WITH b AS ({base}),
f AS (
  SELECT *, pkt_id % 10 AS k, pkt_id % 20 AS v, (pkt_id // 10) % 4 AS r, (pkt_id // 40) % 2 AS fr,
    167772160 + ((host >> 8) & 255) * 256 + (host & 255) AS ip_s,
    3232235521 + (pkt_id % 4) * 256 AS ip_d,
    1024 + pkt_id % 60000 AS port_s,
    32 + pkt_id % 200 AS ttl_v,
    pkt_id % 65536 AS ident_v,
    (pkt_id % 8) * 4 AS tos_v,
    us // 1000000 AS ts_sec, us % 1000000 AS ts_usec
  FROM b),
g AS (
  SELECT *,
    (k <= 7 OR (k = 9 AND r IN (1, 3))) AS has_ipv4,
    (k <= 4 OR v = 8) AS has_tcp,
    ((k BETWEEN 5 AND 7) OR v = 18) AS has_udp,
    NOT (k = 9 AND r = 2) AS decodable,
    CASE WHEN k <= 4 THEN 6 WHEN k <= 7 THEN 17 WHEN r = 1 THEN 1 ELSE 17 END AS proto_v,
    CASE WHEN v = 2 THEN 6 ELSE 5 END AS ihl_v
  FROM f)
"""


TUPLE_SQL = """
  CAST(CASE WHEN has_ipv4 THEN ip_s ELSE 0 END AS BIGINT) AS sip,
  CAST(CASE WHEN has_ipv4 THEN ip_d ELSE 0 END AS BIGINT) AS dip,
  CAST(CASE WHEN has_tcp OR has_udp THEN port_s ELSE 0 END AS INTEGER) AS sport,
  CAST(CASE WHEN has_tcp OR has_udp THEN dport ELSE 0 END AS INTEGER) AS dport,
  CAST(CASE WHEN has_ipv4 THEN proto_v ELSE 0 END AS INTEGER) AS proto"""


def count_protocols_sql(source: str = "events") -> str:
    return frame_cte(source) + """
SELECT count(*) FILTER (WHERE has_tcp) AS tcp,
       count(*) FILTER (WHERE has_tcp AND has_ipv4) AS tcp_ipv4,
       count(*) FILTER (WHERE has_udp) AS udp,
       count(*) FILTER (WHERE has_udp AND has_ipv4) AS udp_ipv4
FROM g"""


def decodable_packets_sql() -> str:
    return frame_cte() + "SELECT pkt_id FROM g WHERE decodable"


def key_texts_sql() -> str:
    return ("SELECT o_orderkey, CAST(length(CAST(o_orderkey AS VARCHAR)) AS INTEGER) AS bytes, "
            "lower(hex(encode(CAST(o_orderkey AS VARCHAR)))) AS key FROM orders")


def five_tuples_sql() -> str:
    return frame_cte() + f"SELECT pkt_id, {TUPLE_SQL} FROM g"


def session_counts_sql(dense: int = 60, source: str = "events") -> str:
    return frame_cte(source) + f"""
SELECT CAST(((slot % 100) + 100) % 100 AS INTEGER) AS bucket, slot, sip, dip, sport, dport, proto,
       count(*) AS c
FROM (SELECT (ts_sec - ((ts_sec % {dense}) + {dense}) % {dense}) // {dense} AS slot, {TUPLE_SQL} FROM g) t
GROUP BY ALL"""


def packet_count_sql() -> str:
    return "SELECT count(*) AS n FROM events"


def packet_features_sql() -> str:
    return frame_cte() + f"""
SELECT pkt_id,
  CASE WHEN has_ipv4 THEN ip_s END AS src,
  CASE WHEN has_ipv4 THEN ip_d END AS dst,
  CASE WHEN has_ipv4 THEN 4 END AS ip_version,
  CASE WHEN has_ipv4 THEN proto_v END AS protocol,
  CASE WHEN has_ipv4 THEN ihl_v END AS ihl,
  CAST(CASE WHEN has_ipv4 THEN tos_v END AS INTEGER) AS tos,
  CAST(CASE WHEN has_ipv4 THEN ident_v END AS INTEGER) AS identification,
  CAST(CASE WHEN has_ipv4 THEN ihl_v * 4 + (CASE WHEN k <= 4 THEN (CASE WHEN v = 3 THEN 32 ELSE 20 END)
                                            ELSE 8 END) + plen END AS INTEGER) AS total_length,
  CASE WHEN has_ipv4 THEN k <= 4 END AS df,
  CASE WHEN has_ipv4 THEN (k = 9 AND r = 3 AND fr = 0) END AS mf,
  CAST(CASE WHEN has_ipv4 THEN ttl_v END AS INTEGER) AS ttl,
  CASE WHEN has_ipv4 THEN (CASE WHEN v = 2 THEN '{IPV4_OPTIONS}' ELSE '' END) END AS options,
  CAST(CASE WHEN has_tcp THEN port_s END AS INTEGER) AS tcp_sport,
  CAST(CASE WHEN has_tcp THEN dport END AS INTEGER) AS tcp_dport,
  CASE WHEN has_tcp THEN (CASE WHEN pkt_id % 50 = 0 THEN 4 ELSE 0 END) END AS tcp_reserved,
  CASE WHEN has_tcp THEN (CASE WHEN v = 3 THEN '{TCP_OPTIONS}' ELSE '' END) END AS tcp_options,
  CASE WHEN has_tcp THEN (CASE WHEN pkt_id % 7 = 0 THEN 2 ELSE 24 END) END AS tcp_flags,
  CAST(CASE WHEN has_udp THEN port_s END AS INTEGER) AS udp_sport,
  CAST(CASE WHEN has_udp THEN dport END AS INTEGER) AS udp_dport,
  CAST(CASE WHEN has_udp THEN 8 + plen END AS INTEGER) AS udp_length
FROM g WHERE has_ipv4 OR has_tcp OR has_udp"""


def five_tuples_fixed_sql() -> str:
    s8 = "(CASE WHEN ({x}) >= 128 THEN ({x}) - 256 ELSE ({x}) END)"
    s16 = "(CASE WHEN ({x}) >= 32768 THEN ({x}) - 65536 ELSE ({x}) END)"
    s32 = "(CASE WHEN ({x}) >= 2147483648 THEN ({x}) - 4294967296 ELSE ({x}) END)"

    def S(t, x):
        return t.format(x=x)
    plain = (S(s32, "ip_s"), S(s16, "port_s"), S(s32, "ip_d"), S(s16, "dport"))
    return frame_cte() + f"""
SELECT pkt_id,
  CAST(CASE WHEN k = 9 AND r = 2 THEN NULL
            WHEN v = 4 THEN {S(s32, 'ttl_v * 16777216 + 6 * 65536')}
            WHEN v = 7 THEN {S(s32, 'ident_v * 65536')}
            WHEN k = 8 THEN 0
            WHEN k = 9 AND r = 0 THEN 68096
            ELSE {plain[0]} END AS INTEGER) AS saddr,
  CAST(CASE WHEN k = 9 AND r = 2 THEN NULL
            WHEN v = 2 THEN -27644
            WHEN v = 4 THEN {S(s16, 'ip_d >> 16')}
            WHEN v = 7 THEN {S(s16, 'ip_s >> 16')}
            WHEN k = 8 THEN {S(s16, '(host >> 16) & 65535')}
            WHEN k = 9 AND r = 0 THEN 0
            WHEN k = 9 AND r = 1 THEN 2048
            WHEN k = 9 AND r = 3 AND fr = 1 THEN 0
            ELSE {plain[1]} END AS SMALLINT) AS sport,
  CAST(CASE WHEN k = 9 AND r = 2 THEN NULL
            WHEN v = 4 THEN {plain[0]}
            WHEN v = 7 THEN {S(s32, 'ttl_v * 16777216 + 17 * 65536')}
            WHEN k = 8 THEN 0
            WHEN k = 9 AND r = 0 THEN {S(s32, '(ip_s & 65535) * 65536')}
            ELSE {plain[2]} END AS INTEGER) AS daddr,
  CAST(CASE WHEN k = 9 AND r = 2 THEN NULL
            WHEN v = 2 THEN 0
            WHEN v = 4 THEN {S(s16, 'ip_d & 65535')}
            WHEN v = 7 THEN {S(s16, 'ip_s & 65535')}
            WHEN k = 8 THEN {S(s16, 'host & 65535')}
            WHEN k = 9 AND r IN (0, 1) THEN 0
            WHEN k = 9 AND r = 3 AND fr = 1 THEN 0
            ELSE {plain[3]} END AS SMALLINT) AS dport,
  CAST(CASE WHEN k = 9 AND r = 2 THEN NULL
            WHEN v = 4 THEN {S(s8, 'ident_v & 255')}
            WHEN v = 7 THEN tos_v
            WHEN k = 8 OR (k = 9 AND r = 0) THEN 0
            ELSE proto_v END AS TINYINT) AS proto
FROM g"""


# --- keys ---------------------------------------------------------------

_TH = ("lower(lpad(hex(sip), 8, '0') || lpad(hex(dip), 8, '0') || lpad(hex(sport), 4, '0') "
       "|| lpad(hex(dport), 4, '0') || lpad(hex(proto), 2, '0'))")
_SUFFIX = "substr(md5(CAST(pkt_id AS VARCHAR)), 1, 8)"


def _tuple_rows_sql() -> str:
    return frame_cte() + f""", t AS (SELECT pkt_id, ts_sec, ts_usec, {TUPLE_SQL} FROM g),
th AS (SELECT *, {_TH} AS th FROM t)
"""


def import_keys_sql(dataset_id: int = 7) -> str:
    return _tuple_rows_sql() + f"""
SELECT pkt_id, lower(md5(unhex(th)) || lpad(hex({dataset_id}), 4, '0') || lpad(hex(ts_sec), 8, '0')
       || lpad(hex(ts_usec), 8, '0') || th || {_SUFFIX}) AS rowkey, 43 AS key_len
FROM th"""


def legacy_import_keys_sql(dataset_id: int = 7) -> str:
    th = "substr(th, 1, 16) || substr(th, 19, 2) || substr(th, 17, 2) || substr(th, 21)"
    return _tuple_rows_sql() + f"""
SELECT pkt_id, lower(md5(unhex(lh)) || lpad(hex({dataset_id}), 4, '0') || lpad(hex(ts_sec), 8, '0')
       || lpad(hex(ts_usec), 8, '0') || lh || {_SUFFIX}) AS rowkey
FROM (SELECT *, {th} AS lh FROM th)"""


def timeslot_keys_sql(source_id: int = 0, width: int = 60) -> str:
    return _tuple_rows_sql() + f"""
SELECT pkt_id, lower(md5(unhex(th || lpad(hex(ts_sec // {width}), 8, '0')))
       || lpad(hex(ts_sec * 1000 + ts_usec // 1000), 16, '0') || lpad(hex({source_id}), 4, '0')
       || th || {_SUFFIX}) AS rowkey
FROM th"""


def split_keys_sql(dataset_id: int = 7) -> str:
    return _tuple_rows_sql() + f"""
SELECT pkt_id, md5(unhex(th)) AS salt, CAST({dataset_id} AS BIGINT) AS dataset_id,
       CAST(ts_sec AS BIGINT) AS ts_sec, CAST(ts_usec AS BIGINT) AS ts_usec,
       sip, dip, sport, dport, proto, {_SUFFIX} AS suffix
FROM th"""


def split_timeslot_keys_sql(source_id: int = 0, width: int = 60) -> str:
    return _tuple_rows_sql() + f"""
SELECT pkt_id, md5(unhex(th || lpad(hex(ts_sec // {width}), 8, '0'))) AS salt,
       CAST(ts_sec * 1000 + ts_usec // 1000 AS BIGINT) AS ts_ms, CAST({source_id} AS BIGINT) AS source_id,
       sip, dip, sport, dport, proto, {_SUFFIX} AS suffix
FROM th"""


def key_buckets_sql(lo: int = 0x01010101, hi: int = 0xFFFFFFFF, n: int = 15) -> str:
    inc = (hi - lo) // n
    return _tuple_rows_sql() + f"""
SELECT pkt_id, CAST(CASE WHEN v < {lo} THEN 0 ELSE least((v - {lo}) // {inc}, {n - 1}) END AS INTEGER)
       AS bucket
FROM (SELECT pkt_id, ('0x' || substr(md5(unhex(th)), 1, 8))::BIGINT AS v FROM th)"""


# --- index, record keys, flows -------------------------------------------

def with_index_sql() -> str:
    return "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders"


def with_index_payload_sql() -> str:
    return "SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS idx FROM orders"


def _record_key_sql(idx: str) -> str:
    return (f"lower(lpad(hex(CAST((({idx}) // 1200) % 15 AS BIGINT)), 4, '0') "
            f"|| lpad(hex(CAST({idx} AS BIGINT)), 8, '0'))")


def record_keys_sql() -> str:
    return f"""
SELECT l_orderkey, l_linenumber, idx, {_record_key_sql('idx')} AS rowkey
FROM (SELECT l_orderkey, l_linenumber,
             row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                    l_returnflag, l_linestatus) - 1 AS idx FROM lineitem)"""


def flow_cells_sql() -> str:
    vals = ", ".join(f"CAST({c} AS VARCHAR)" for c in
                     ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"])
    return f"""
SELECT {_record_key_sql('idx')} AS rowkey, CAST(pos - 1 AS INTEGER) AS pos, value
FROM (SELECT idx, unnest(vals) AS value, generate_subscripts(vals, 1) AS pos
      FROM (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                             l_returnflag, l_linestatus) - 1 AS idx,
                   [{vals}] AS vals FROM lineitem))"""


# --- cells ----------------------------------------------------------------

def _order_cells_sql() -> str:
    parts = []
    for col, q in (("o_orderstatus", "status"), ("o_orderpriority", "priority"), ("o_orderkey", "orderkey")):
        parts.append(f"SELECT CAST(o_custkey AS VARCHAR) AS row, 'o' AS cf, '{q}' AS cq, "
                     f"epoch_us(o_orderdate) AS version, CAST({col} AS VARCHAR) AS value FROM orders")
    return " UNION ALL ".join(parts)


def _latest_order_cells_sql() -> str:
    return f"""(SELECT * FROM ({_order_cells_sql()}) c
  QUALIFY row_number() OVER (PARTITION BY row, cf, cq ORDER BY version DESC, value DESC) = 1)"""


def cells_latest_sql() -> str:
    return f"SELECT row, cf, cq, version, value FROM {_latest_order_cells_sql()} l"


def nested_rows_sql() -> str:
    return f"""SELECT row, CAST(0 AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n_cells,
  string_agg(cf || ':' || cq || '=' || value, ';' ORDER BY cf, cq, value) AS cells
FROM {_latest_order_cells_sql()} l GROUP BY row"""


def row_bytes_sql() -> str:
    return f"""SELECT row, CAST(0 AS INTEGER) AS part,
  lower(hex(string_agg(cf || cq || value, '' ORDER BY cf, cq, value))) AS bytes
FROM {_latest_order_cells_sql()} l GROUP BY row"""


def wide_rows_sql() -> str:
    return """WITH c AS (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'all' ELSE CAST(o_custkey AS VARCHAR) END AS row,
    CAST(o_orderkey AS VARCHAR) AS cq, o_orderstatus || o_orderpriority AS value, epoch_us(o_orderdate) AS version
  FROM orders
), newest AS (
  SELECT row, cq, value FROM c QUALIFY row_number() OVER (PARTITION BY row, cq ORDER BY version DESC, value DESC) = 1
), numbered AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY row ORDER BY cq) - 1) // 200 AS INTEGER) AS part FROM newest
)
SELECT row, part, CAST(count(*) AS INTEGER) AS n_cells, md5(string_agg('o' || cq || value, '' ORDER BY cq)) AS cells_md5
FROM numbered GROUP BY row, part"""


def rewrite_column_sql(template: str = "just not test haha at ") -> str:
    return (f"SELECT CAST(c_custkey AS VARCHAR) AS row, c_name AS old_value, "
            f"'{template}' || CAST(c_custkey AS VARCHAR) AS new_value FROM customer")


def json_puts_sql() -> str:
    return """
SELECT CAST(c_custkey AS VARCHAR) AS row, 'c' AS cf, cq, CAST(0 AS BIGINT) AS version, value
FROM (SELECT c_custkey, 'name' AS cq, c_name AS value FROM customer
      UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer)
WHERE NOT (c_custkey % 17 = 0 OR c_custkey % 23 = 0)"""


def json_rejects_sql() -> str:
    return "SELECT count(*) AS n_rejects FROM customer WHERE c_custkey % 17 = 0 OR c_custkey % 23 = 0"


def _customer_cells_sql() -> str:
    return """(SELECT CAST(c_custkey AS VARCHAR) AS row, 'c' AS cf, 'name' AS cq, CAST(1 AS BIGINT) AS version,
        c_name AS value FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c', 'nation', 1, CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c', 'segment', 1, c_mktsegment FROM customer)"""


def table_dump_sql() -> str:
    return (f"SELECT row, cf, cq, version, value, row_number() OVER (ORDER BY row, cf, cq) - 1 AS pos "
            f"FROM {_customer_cells_sql()} c")


def kmeans_fit_sql() -> str:
    return ("SELECT cluster, (SELECT count(*) FROM events) AS points, TRUE AS near "
            "FROM (SELECT DISTINCT CAST(event_id % 4 AS BIGINT) AS cluster FROM events)")


def sort_by_key_sql() -> str:
    return ("SELECT CAST(c_custkey AS VARCHAR) AS row, c_name AS value, "
            "row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1 AS pos FROM customer")


def scan_column_sql() -> str:
    return "SELECT CAST(c_custkey AS VARCHAR) AS row, c_name AS value FROM customer"


def first_n_sql() -> str:
    return ("SELECT CAST(c_custkey AS VARCHAR) AS row, c_name AS value FROM customer "
            "ORDER BY CAST(c_custkey AS VARCHAR) LIMIT 10")


# --- capture files ---------------------------------------------------------

FRAME_LEN_SQL = """CASE
    WHEN k <= 4 THEN 14 + (CASE WHEN v = 4 THEN 4 ELSE 0 END) + ihl_v * 4
                     + (CASE WHEN v = 3 THEN 32 ELSE 20 END) + plen
    WHEN k <= 7 THEN 14 + (CASE WHEN v = 7 THEN 8 ELSE 0 END) + 20 + 8 + plen
    WHEN v = 8 THEN 14 + 40 + 20 + plen
    WHEN k = 8 THEN 14 + 40 + 8 + 8 + plen
    WHEN r = 0 THEN 42
    WHEN r = 2 THEN 10
    ELSE 14 + 20 + 8 + plen END"""


def capture_roundtrip_sql() -> str:
    return frame_cte() + f"""
SELECT CAST(ts_sec AS BIGINT) AS ts_sec, CAST(ts_usec AS INTEGER) AS ts_usec,
       CAST(CASE WHEN k = 9 AND r = 2 THEN 60 ELSE {FRAME_LEN_SQL} END AS INTEGER) AS orig_len,
       CAST({FRAME_LEN_SQL} AS INTEGER) AS caplen, {TUPLE_SQL}
FROM g"""


# --- streaming -------------------------------------------------------------

def stream_minute_counts_sql() -> str:
    return "SELECT date_trunc('minute', ts) AS minute, count(*) AS count FROM events GROUP BY 1"


def stream_minute_state_sql(timeout_ms: int = 2000) -> str:
    return (f"SELECT date_trunc('minute', ts) AS minute, count(*) AS count, "
            f"max(epoch_us(ts)) // 1000 + {timeout_ms} AS expires_ms, count(*) AS emitted FROM events GROUP BY 1")


def stream_packet_keys_sql(source_id: int = 0, width: int = 60, topic: str = "test") -> str:
    return _tuple_rows_sql() + f"""
SELECT lower(md5(unhex(th || lpad(hex(ts_sec // {width}), 8, '0')))
       || lpad(hex(ts_sec * 1000 + ts_usec // 1000), 16, '0') || lpad(hex({source_id}), 4, '0')
       || th || substr(md5('{topic}/0/' || CAST(pkt_id AS VARCHAR)), 1, 8)) AS rowkey
FROM th"""


def stream_packet_table_sql() -> str:
    return f"""
WITH keys AS ({_tuple_rows_sql()}
SELECT pkt_id, ts_sec * 1000 + ts_usec // 1000 AS version,
       lower(md5(unhex(th || lpad(hex(ts_sec // 60), 8, '0')))
       || lpad(hex(ts_sec * 1000 + ts_usec // 1000), 16, '0') || lpad(hex(0), 4, '0')
       || th || substr(md5('test/0/' || CAST(pkt_id AS VARCHAR)), 1, 8)) AS rowkey
FROM th),
lens AS (SELECT * FROM ({frame_cte()} SELECT pkt_id,
    CAST(CASE WHEN k = 9 AND r = 2 THEN 10 ELSE {FRAME_LEN_SQL} END AS INTEGER) AS value_len FROM g))
SELECT rowkey, 'p' AS cf, 'r' AS cq, CAST(version AS BIGINT) AS version, value_len FROM keys JOIN lens USING (pkt_id)"""


# --- generators --------------------------------------------------------------

def _dbl(x: float) -> str:
    return format(x, ".17e")


def _uniform_sql(seed: int, stream: str, id_sql: str) -> str:
    return (f"((('0x' || substr(md5('{seed}:{stream}:' || CAST({id_sql} AS VARCHAR)), 1, 13))::BIGINT + 0.5)"
            f" / 4503599627370496.0)")


def _normal_sql(seed: int, stream: str, id_sql: str) -> str:
    u1, u2 = _uniform_sql(seed, stream + "/a", id_sql), _uniform_sql(seed, stream + "/b", id_sql)
    return f"(sqrt({_dbl(-2.0)} * ln({u1})) * cos({_dbl(2.0 * 3.141592653589793)} * {u2}))"


def _poisson_sql(mean: float, u: str) -> str:
    from flowlens.operators.points import poisson_cdf
    lst = ", ".join(_dbl(c) for c in poisson_cdf(mean))
    return f"CAST(len(list_filter([{lst}], lambda c: c <= {u})) AS DOUBLE)"


def poisson_points_sql(seed: int = 42) -> str:
    return (f"SELECT printf('%06d', event_id) AS key, "
            f"{_poisson_sql(50.0, _uniform_sql(seed, 'poisson/x', 'event_id'))} AS x, "
            f"{_poisson_sql(20.0, _uniform_sql(seed, 'poisson/y', 'event_id'))} AS y FROM events")


def cluster_points_sql(seed: int = 42) -> str:
    from flowlens.operators.points import cluster_centers
    cs = cluster_centers(seed=seed)
    cols = []
    for t, name in enumerate(("x", "y")):
        arr = ", ".join(_dbl(c[t]) for c in cs)
        cols.append(f"round([{arr}][(event_id % {len(cs)}) + 1] + {_normal_sql(seed, f'point/{t}', 'event_id')}, 6)"
                    f" AS {name}")
    return f"SELECT printf('%06d', event_id) AS key, {', '.join(cols)} FROM events"


def merge_points_sql(seed: int = 42) -> str:
    return f"""SELECT b.key, b.x AS bx, b.y AS by, k.x AS kx, k.y AS ky
FROM ({poisson_points_sql(seed)}) b FULL OUTER JOIN ({cluster_points_sql(seed)}) k ON b.key = k.key"""


def packet_import_sql(lo: int = 0x01010101, hi: int = 0xFFFFFFFF, n: int = 15) -> str:
    inc = (hi - lo) // n
    return frame_cte() + f""", t AS (SELECT pkt_id, {TUPLE_SQL},
    CAST(CASE WHEN k = 9 AND r = 2 THEN 60 ELSE {FRAME_LEN_SQL} END AS BIGINT) AS orig_len FROM g),
th AS (SELECT *, {_TH} AS th FROM t)
SELECT CAST(CASE WHEN v < {lo} THEN 0 ELSE least((v - {lo}) // {inc}, {n - 1}) END AS INTEGER) AS key_bucket,
       count(*) AS packets, CAST(sum(orig_len) AS BIGINT) AS bytes
FROM (SELECT orig_len, ('0x' || substr(md5(unhex(th)), 1, 8))::BIGINT AS v FROM th)
GROUP BY 1"""


def packet_range_sql(start: str = "3f80", stop: str = "7a00000001",
                     lo: int = 0x01010101, hi: int = 0xFFFFFFFF, n: int = 15) -> str:
    inc = (hi - lo) // n
    return f"""
WITH keys AS ({import_keys_sql()}),
lens AS (SELECT * FROM ({frame_cte()} SELECT pkt_id,
    CAST(CASE WHEN k = 9 AND r = 2 THEN 60 ELSE {FRAME_LEN_SQL} END AS BIGINT) AS orig_len FROM g))
SELECT rowkey, orig_len,
       CAST(CASE WHEN v < {lo} THEN 0 ELSE least((v - {lo}) // {inc}, {n - 1}) END AS INTEGER) AS key_bucket
FROM (SELECT rowkey, orig_len, ('0x' || substr(rowkey, 1, 8))::BIGINT AS v FROM keys JOIN lens USING (pkt_id))
WHERE rowkey >= '{start}' AND rowkey < '{stop}'"""


def row_range_sql(start: str = "12", stop: str = "47") -> str:
    parts = [f"SELECT CAST(c_custkey AS VARCHAR) AS row, 'c' AS cf, '{q}' AS cq, CAST(1 AS BIGINT) AS version, "
             f"CAST({col} AS VARCHAR) AS value FROM customer"
             for col, q in (("c_name", "name"), ("c_nationkey", "nation"), ("c_mktsegment", "segment"))]
    cells = " UNION ALL ".join([_order_cells_sql(), *parts])
    return f"""SELECT row, cf, cq, version, value FROM (
  SELECT *, row_number() OVER (PARTITION BY row, cf, cq ORDER BY version DESC, value DESC) AS rn FROM ({cells}))
WHERE rn = 1 AND row >= '{start}' AND row < '{stop}'"""
