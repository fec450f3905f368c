"""Audit-shaped views over the benchmark tables.

Each view is plain SQL that Spark and DuckDB run unchanged, so both engines see the
same input.  `{name}` stands for a base table or another view.  The configuration
tables grow with their base table too: every channel has its own few rows.  The
channel under test is OLB with key 101.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

# The columns that views and queries read, so that opening a table starts no job.
BASE_COLUMNS = {
    "customer": "c_custkey bigint",
    "supplier": "s_suppkey bigint",
    "part": "p_partkey bigint",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_returnflag string, l_linestatus string",
    "events": "event_id bigint, user_id bigint, event_type string, props string",
    "pages": "page_id bigint, url string, html string",
}

VIEWS: dict[str, str] = {
    "fx_main": """
SELECT CAST(o_orderkey AS STRING) AS uid,
  DATE '2024-01-01' + CAST(o_orderkey % 30 AS INT) AS log_dte,
  CASE WHEN o_orderkey % 50 = 0 THEN '999999999999' WHEN o_orderkey % 7 = 0 THEN NULL
       ELSE CAST(o_custkey % 400 AS STRING) END AS mmb_num,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE ' C' || CAST(o_custkey AS STRING) || ' ' END AS cus_idr,
  CASE o_orderkey % 6 WHEN 0 THEN ' none ' WHEN 1 THEN 'NULL' WHEN 2 THEN NULL WHEN 3 THEN 'null'
       WHEN 4 THEN 'a failure message far over the limit' ELSE ' E42' END AS err_msg_txt,
  CASE WHEN o_orderkey % 4 = 0 THEN ' SF1 ' END AS stopflow_t,
  CASE WHEN o_orderkey % 3 = 0 THEN 'LOGIN' ELSE 'paym' END AS acn_cat_nme,
  CASE o_orderkey % 40 WHEN 0 THEN 'MOB' WHEN 20 THEN 'WEB' ELSE 'OLB' END AS chnl_cd
FROM {orders}""",
    "fx_details": """
SELECT CAST(l_orderkey AS STRING) AS uid,
  DATE '2024-01-01' + CAST(l_orderkey % 30 AS INT) AS log_dte,
  l_linenumber AS seq,
  CASE WHEN l_linenumber % 2 = 1 THEN 'Paym ' ELSE '/olb/bulkpay/GROUPPAYMENTSTEPFOUR.json' END AS acn_cat_nme,
  CASE l_linenumber % 4 WHEN 0 THEN 'fr_acct_id' WHEN 1 THEN 'tran_amt'
       WHEN 2 THEN 'to_acct_id.' || CAST(l_linenumber AS STRING) ELSE 'mmb_num' END AS tagname,
  CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 11 = 1 THEN ' NULL ' WHEN l_suppkey % 11 = 2 THEN '  '
       WHEN l_linenumber % 4 = 1 THEN 'GBP ' || CAST(l_partkey * 1009 AS STRING) || '.50'
       WHEN l_linenumber % 4 = 3 THEN CAST(l_partkey % 400 AS STRING)
       ELSE CAST(10000000000000 + l_partkey * 7919 AS STRING) END AS tagvalue,
  CAST(l_partkey % 400 AS STRING) AS mmb_num,
  'S' || CAST(l_suppkey AS STRING) AS ses_idr,
  '10:0' || CAST(l_linenumber AS STRING) AS log_tme,
  CASE WHEN l_returnflag = 'A' THEN 'view' ELSE 'submit' END AS acn_nme,
  CAST(l_partkey % 1000 AS STRING) AS log_millisec,
  l_linestatus AS msg_typ
FROM (SELECT * FROM {lineitem} UNION ALL SELECT * FROM {lineitem} WHERE l_suppkey % 13 = 5) l""",
    "fx_custlink": """
SELECT CAST(c_custkey AS STRING) AS cus_idr, CAST(c_custkey % 400 AS STRING) AS mmb_lnk_mmb_num,
  CASE WHEN c_custkey % 5 = 0 THEN 'CL' ELSE ' ac' END AS mmb_lnk_sts, '1' AS active,
  CASE c_custkey % 3 WHEN 0 THEN '01' WHEN 1 THEN '02' ELSE '03' END AS mmb_lnk_fls_type,
  CAST(2000 + c_custkey % 20 AS STRING) || '-01-01' AS eff_start_date,
  CASE WHEN c_custkey % 7 = 0 THEN '2020-01-01' WHEN c_custkey % 2 = 0 THEN '' ELSE NULL END AS mmb_lnk_end_dte
FROM {customer}""",
    "fx_journey": """
SELECT l_orderkey AS journey_id, l_returnflag AS evnt_ed,
  CASE WHEN l_orderkey % 10 = 4 THEN 0 ELSE l_linenumber END AS flow_num,
  CASE WHEN l_orderkey % 10 = 1 AND l_linenumber = 1 THEN 'N' WHEN l_orderkey % 10 = 7 THEN NULL ELSE 'Y' END AS IncompleteMap,
  CASE WHEN l_orderkey % 10 = 2 AND l_linenumber % 2 = 0 THEN 'Or' WHEN l_orderkey % 10 = 5 THEN 'Xor'
       WHEN l_orderkey % 10 = 6 AND l_linenumber = 2 THEN NULL ELSE 'And' END AS emplx_jrny_attrb,
  CASE WHEN l_orderkey % 10 = 3 AND l_linenumber = 1 THEN 'XX' WHEN l_linenumber % 2 = 0 THEN 'EQ' ELSE 'GT' END AS operator
FROM {lineitem}""",
    "fx_accounts": """
SELECT CAST(o_orderkey AS STRING) AS uid,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE ' 20' END AS sortcode1_t, '30 ' AS sortcode2_t,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE '40' END AS sortcode3_t,
  CASE o_orderkey % 3 WHEN 0 THEN CAST(10000 + o_orderkey AS STRING)
       WHEN 1 THEN CAST(10000000000000 + o_orderkey AS STRING)
       ELSE CAST(100000000000000 + o_orderkey AS STRING) END AS to_acct_id,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'abc' ELSE 'A-' || CAST(o_orderkey AS STRING) END AS fr_acct_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'PK' || CAST(o_orderkey * 3 AS STRING) END AS prd_key,
  CASE WHEN o_orderkey % 4 = 1 THEN 'S40' END AS src_idw_tp,
  'v1.5' AS val,
  CASE o_orderkey % 4 WHEN 0 THEN '123456789012.5' WHEN 1 THEN '1234567890123.75'
       WHEN 2 THEN CAST(o_orderkey AS STRING) || '.10' ELSE NULL END AS tran_amt
FROM {orders}""",
    "fx_chnl_map": """
SELECT CASE WHEN s_suppkey % 10 = 2 THEN 0 ELSE 1 END AS active,
  CASE WHEN s_suppkey = 0 OR s_suppkey % 10 = 2 THEN 'OLB' WHEN s_suppkey = 1 THEN 'MOB'
       ELSE 'CH' || CAST(s_suppkey AS STRING) END AS chnl_cd,
  CAST(101 + s_suppkey AS INT) AS chnl_key
FROM {supplier}""",
    "fx_rules": """
SELECT CASE WHEN slot = 5 THEN 0 ELSE 1 END AS active, chnl_key,
  CASE WHEN slot = 1 THEN ' Acn_Cat_Nme' ELSE 'acn_cat_nme' END AS filter_col1,
  CASE WHEN slot = 1 THEN 'PAYM ' WHEN slot IN (2, 7) THEN '/olb/bulkpay/grouppaymentstepfour.json'
       ELSE 'paym' END AS filter_condn1,
  'tagname' AS filter_col2,
  CASE slot WHEN 0 THEN 'tran_amt' WHEN 1 THEN ' Mmb_Num' WHEN 2 THEN 'fr_acct_id' WHEN 3 THEN 'no_such_tag'
       WHEN 4 THEN NULL WHEN 7 THEN 'to_acct_id' WHEN 8 THEN 'tran_amt' ELSE 'mmb_num' END AS filter_condn2,
  CASE slot WHEN 6 THEN 'ses_idr' WHEN 8 THEN 'log_millisec' ELSE 'tagvalue' END AS val_col,
  CASE WHEN chnl_key <> 101 THEN 'other_' || CAST(slot AS STRING)
       WHEN slot IN (0, 3) THEN 'tran_amt' WHEN slot = 1 THEN 'MMB_NUM_T' WHEN slot = 2 THEN 'fr_acct_id'
       WHEN slot = 4 THEN 'never_set' WHEN slot = 5 THEN 'dead_rule' WHEN slot = 6 THEN 'prd_key'
       WHEN slot = 7 THEN 'to_acct_id' WHEN slot = 8 THEN 'val' ELSE 'mmb_num_t' END AS new_trans_col
FROM (SELECT p_partkey % 10 AS slot, CAST(101 + (p_partkey - p_partkey % 10) / 10 AS INT) AS chnl_key FROM {part}) r""",
    "fx_event_config": """
SELECT CASE WHEN slot = 3 THEN 0 ELSE 1 END AS active, chnl_key,
  CASE WHEN slot = 2 THEN 'LOGIN' ELSE 'PAYM' END AS evnt_cd,
  CASE slot WHEN 1 THEN 'mmb_num' WHEN 2 THEN 'fr_acct_id' ELSE 'tran_amt' END AS trgt_col_nm,
  CASE slot WHEN 0 THEN 'Tran_Amt' WHEN 1 THEN 'mmb_num' ELSE 'fr_acct_id' END AS tag_nm,
  CASE WHEN chnl_key <> 101 THEN 'other_' || CAST(slot AS STRING)
       WHEN slot = 0 THEN 'Tran_Amt, MMB_NUM ,tran_amt' WHEN slot = 1 THEN ' mmb_num' ELSE 'fr_acct_id' END AS cmpx_jrny_tag
FROM (SELECT c_custkey % 4 AS slot, CAST(101 + (c_custkey - c_custkey % 4) / 4 AS INT) AS chnl_key FROM {customer}) r""",
    "fx_event_map": """
SELECT CASE WHEN p_partkey % 9 = 1 THEN 0 ELSE 1 END AS active,
  CASE WHEN p_partkey < 2 THEN 'paym' WHEN p_partkey = 2 THEN 'TRANSFER'
       ELSE 'ev' || CAST(p_partkey AS STRING) END AS event_cd,
  CAST(10 + p_partkey AS INT) AS event_key
FROM {part}""",
    "fx_err_map": """
SELECT CASE s_suppkey WHEN 0 THEN 'E42' WHEN 1 THEN 'SF1' ELSE 'E' || CAST(1000 + s_suppkey AS STRING) END AS err_cd,
  CAST(1 + s_suppkey AS INT) AS err_key
FROM {supplier}""",
    "fx_event_detail": """
SELECT chnl_cd, acn_cat_nme AS evnt_cd, TRIM(err_msg_txt) AS err_cd FROM {fx_main}""",
    # the same codes with the request they belong to
    "fx_event_codes": """
SELECT uid, chnl_cd, acn_cat_nme AS evnt_cd, TRIM(err_msg_txt) AS err_cd FROM {fx_main}""",
    "fx_text": """
SELECT event_id, props AS text FROM {events}""",
    # the same texts with their quotes written in each of the escaped styles
    "fx_escaped": """
SELECT page_id, html AS plain,
  REPLACE(html, '"', CHR(92) || '"') AS backslash,
  REPLACE(html, '="', '=' || CHR(92) || CHR(39) || '"') || CHR(92) || CHR(39) || '"' || url || '"' || CHR(92) || CHR(39) AS backslash_apostrophe,
  '""' || url || CHR(92) || '"" ' || html AS doubled
FROM {pages}""",
}


def needs(view: str) -> list[str]:
    """Names a view refers to."""
    return sorted({name for _, name, _, _ in Formatter().parse(VIEWS[view]) if name})


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view or base table as a DataFrame over the Parquet files in `sf_dir`."""
    if name not in VIEWS:
        return base_table(spark, sf_dir, name)
    return spark.sql(VIEWS[name], **{n: view(spark, sf_dir, n) for n in needs(name)})


def as_ctes(*names: str) -> str:
    """The views and what they need as the head of one SQL query."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in order:
            for n in needs(name):
                add(n)
            order.append(name)

    for name in names:
        add(name)
    bodies = [f"{n} AS ({VIEWS[n].format(**{m: m for m in needs(n)})})" for n in order]
    return "WITH " + ",\n".join(bodies)
