"""Write a copy of the supplied tables in which single keys hold a third of the rows and edge values occur.

usage: python tests/skewed_tables.py <supplied folder> <new folder>
"""

from __future__ import annotations

import os
import sys

import duckdb

CHANGES = {
    # One title and type, and one day, are hot; some values are missing, zero, tied or of many places.
    "events": """select event_id, case when event_id % 5 = 0 then timestamp '2024-01-10 12:00:00' + to_seconds(event_id)
        else ts end as ts, case when event_id % 3 = 0 then 7 else user_id end as user_id,
        case when event_id % 3 = 0 then 'click' else event_type end as event_type,
        case when event_id % 11 = 0 then null when event_id % 13 = 0 then 0e0 when event_id % 7 = 0 then 5e0
        when event_id % 2 = 0 then round(value * 1.000123, 6)
        when event_id % 29 = 0 then 0.004 else round(value / 7, 3) end as value, props from {t}""",
    # Titles without a name, with one word, with a repeated word; free titles.
    "part": """select p_partkey, case when p_partkey % 17 = 3 then null when p_partkey % 17 = 4 then 'red'
        when p_partkey % 17 = 5 then 'red red' else p_name end as p_name, p_brand, p_type, p_size,
        case when p_partkey % 19 = 2 then 0e0 else round(p_retailprice / 3, 5) end as p_retailprice from {t}""",
    # A hot title, free items, and items of titles that do not exist.
    "lineitem": """select l_orderkey, case when l_orderkey % 3 = 0 then 5 when l_orderkey % 101 = 1 then 9999999
        else l_partkey end as l_partkey, l_suppkey, l_linenumber, l_quantity,
        case when l_orderkey % 37 = 1 then 0e0 else round(l_extendedprice * 1.00037, 4) end as l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus, l_shipdate from {t}""",
    # A hot customer and orders without one.
    "orders": """select o_orderkey, case when o_orderkey % 3 = 0 then 11 when o_orderkey % 53 = 1 then null
        else o_custkey end as o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from {t}""",
    "supplier": """select s_suppkey, s_name, s_nationkey, case when s_suppkey % 7 = 0 then -s_acctbal else s_acctbal end
        as s_acctbal from {t}""",
    "documents": "select case when doc_id % 3 = 0 then 4 else doc_id end as doc_id, text, lang, source, n_chars from {t}",
}


def write(source: str, target: str) -> None:
    os.makedirs(target, exist_ok=True)
    connection = duckdb.connect()
    for file in sorted(os.listdir(source)):
        name = file.removesuffix(".parquet")
        select = CHANGES.get(name, "select * from {t}").format(t=f"'{source}/{file}'")
        connection.execute(f"copy ({select}) to '{target}/{file}' (format parquet)")


if __name__ == "__main__":
    write(sys.argv[1], sys.argv[2])
