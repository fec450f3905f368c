"""SQL for an independent engine, one text per registered query.

Written for DuckDB over the same Parquet tables.  The input views are shared with
the Spark side; everything behind them is written again in SQL.
"""

from __future__ import annotations

from tagloom.sources.sample_views import as_ctes

# "present": not null, not blank, not the word null
CLEAN = """clean AS (
  SELECT * FROM fx_details
  WHERE tagvalue IS NOT NULL AND trim(tagvalue) <> '' AND lower(trim(tagvalue)) <> 'null')"""

DEDUP = CLEAN + """,
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY uid, log_dte, tagname, tagvalue
      ORDER BY seq NULLS FIRST, acn_cat_nme NULLS FIRST, mmb_num NULLS FIRST, ses_idr NULLS FIRST,
               log_tme NULLS FIRST, acn_nme NULLS FIRST, log_millisec NULLS FIRST, msg_typ NULLS FIRST) AS rn
    FROM clean) WHERE rn = 1)"""

# volume first, then the suffix goes, then one row per tag and value
STRIPPED = CLEAN + """,
numbered AS (
  SELECT * REPLACE (
      CASE WHEN lower(trim(acn_cat_nme)) IN ('/olb/bulkpay/grouppaymentstepfour.json', '/olb/fspay/mrp/payments.json')
           THEN regexp_replace(trim(tagname), '\\.[0-9]+', '', 'g') ELSE tagname END AS tagname),
    CASE WHEN lower(trim(acn_cat_nme)) = '/olb/bulkpay/grouppaymentstepfour.json'
         THEN coalesce(TRY_CAST(string_split(trim(tagname), '.')[2] AS INTEGER), 1) ELSE 1 END AS vol
  FROM clean),
stripped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY uid, log_dte, tagname, tagvalue
      ORDER BY vol DESC, acn_cat_nme NULLS FIRST, mmb_num NULLS FIRST, ses_idr NULLS FIRST,
               log_tme NULLS FIRST, acn_nme NULLS FIRST, log_millisec NULLS FIRST, msg_typ NULLS FIRST,
               seq NULLS FIRST) AS rn
    FROM numbered) WHERE rn = 1)"""

# the active rules of the channel, written out as conditional aggregates
WIDE_COLUMNS = """
    max(CASE WHEN lower(trim(acn_cat_nme)) = 'paym' AND lower(trim(tagname)) = 'tran_amt' THEN tagvalue END) AS tran_amt,
    max(CASE WHEN lower(trim(acn_cat_nme)) = 'paym' AND lower(trim(tagname)) = 'mmb_num' THEN tagvalue END) AS mmb_num_t,
    max(CASE WHEN lower(trim(acn_cat_nme)) = '/olb/bulkpay/grouppaymentstepfour.json'
              AND lower(trim(tagname)) = 'fr_acct_id' THEN tagvalue END) AS fr_acct_id,
    max(CASE WHEN lower(trim(acn_cat_nme)) = 'paym' AND lower(trim(tagname)) = 'mmb_num' THEN ses_idr END) AS prd_key,
    max(CASE WHEN lower(trim(acn_cat_nme)) = '/olb/bulkpay/grouppaymentstepfour.json'
              AND lower(trim(tagname)) = 'to_acct_id' THEN tagvalue END) AS to_acct_id,
    max(CASE WHEN lower(trim(acn_cat_nme)) = 'paym' AND lower(trim(tagname)) = 'tran_amt' THEN log_millisec END) AS val,
    CAST(NULL AS VARCHAR) AS never_set"""

CHANNEL = """chnl AS (SELECT chnl_key FROM fx_chnl_map WHERE active = 1 AND chnl_cd = 'OLB')"""

LINK = """link AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY mmb_lnk_mmb_num
        ORDER BY priority DESC, eff_start_date DESC NULLS LAST, cus_idr NULLS FIRST, mmb_lnk_fls_type NULLS FIRST) AS rn
    FROM (SELECT * REPLACE (trim(mmb_lnk_mmb_num) AS mmb_lnk_mmb_num), CASE WHEN trim(mmb_lnk_fls_type) IN ('02', '03') THEN 'B' ELSE 'P' END AS priority
          FROM fx_custlink
          WHERE upper(trim(mmb_lnk_sts)) = 'AC' AND mmb_lnk_mmb_num IS NOT NULL
            AND (mmb_lnk_end_dte IS NULL OR trim(mmb_lnk_end_dte) = '')))
  WHERE rn = 1)"""

LATEST_LINK = """latest AS (
  SELECT trim(mmb_lnk_mmb_num) AS mmb_lnk_mmb_num, cus_idr FROM (
    SELECT *, row_number() OVER (PARTITION BY trim(mmb_lnk_mmb_num)
        ORDER BY eff_start_date DESC NULLS LAST, cus_idr) AS rn
    FROM fx_custlink
    WHERE upper(trim(mmb_lnk_sts)) = 'AC' AND active = '1' AND mmb_lnk_mmb_num IS NOT NULL AND cus_idr IS NOT NULL)
  WHERE rn = 1)"""

MAIN = """main AS (
  SELECT * REPLACE (
    coalesce(trim(cus_idr), '-99') AS cus_idr,
    coalesce(trim(mmb_num), '-99') AS mmb_num,
    CASE WHEN err_msg_txt IS NULL OR lower(trim(err_msg_txt)) IN ('none', 'null') THEN 'none'
         ELSE trim(err_msg_txt) END AS err_msg_txt)
  FROM fx_main)"""

ACTIVE_EVENTS = CHANNEL + """,
event_config AS (
  SELECT c.* FROM fx_event_config c JOIN chnl USING (chnl_key) WHERE c.active = 1)"""

JOURNEY = """broken AS (
  SELECT journey_id,
    coalesce(bool_or(IncompleteMap = 'N'), false) AS J1,
    coalesce(bool_or(emplx_jrny_attrb = 'And'), false) AND coalesce(bool_or(emplx_jrny_attrb = 'Or'), false) AS J2,
    coalesce(bool_or(emplx_jrny_attrb NOT IN ('And', 'Or')), false) AS J2b,
    coalesce(bool_or(operator NOT IN ('EQ', 'NE', 'GT', 'LT', 'GTEQ', 'LTEQ', 'LK', 'NIK', 'B!')), false) AS J3,
    count(*) > count(DISTINCT (coalesce(evnt_ed, '~'), coalesce(emplx_jrny_attrb, '~'), coalesce(flow_num, -1))) AS J4
  FROM fx_journey GROUP BY journey_id)"""


def mask(c: str) -> str:
    return f"CASE WHEN length({c}) >= 14 THEN left({c}, 6) || '|' || right({c}, 7) ELSE {c} END"


def clip(c: str) -> str:
    whole = f"length(string_split({c}, '.')[1])"
    return f"CASE WHEN {whole} > 12 THEN left({c}, 12) WHEN {whole} < 12 THEN {c} END"


def digits(c: str, keep: str = "0-9") -> str:
    return f"nullif(regexp_replace(trim({c}), '[^{keep}]', '', 'g'), '')"


ERR_CODE = """CASE
    WHEN err_msg_txt IS NOT NULL AND length(trim(err_msg_txt)) < 20 AND lower(trim(err_msg_txt)) <> 'none'
      THEN trim(err_msg_txt)
    WHEN (err_msg_txt IS NULL OR lower(trim(err_msg_txt)) = 'none') AND stopflow_t IS NOT NULL
      THEN trim(stopflow_t) END"""

RESULT = "CASE WHEN trim(err_msg_txt) IN ('none', 'null') THEN 'Success' ELSE 'Failure' END"


def _with(views: tuple[str, ...], *ctes: str) -> str:
    return ",\n".join([as_ctes(*views), *ctes]) + "\n"


def build() -> dict[str, str]:
    q: dict[str, str] = {}

    q["active_channel_key"] = _with(("fx_chnl_map",), CHANNEL) + "SELECT chnl_key FROM chnl"
    q["rules_normalised"] = _with(("fx_rules", "fx_chnl_map"), CHANNEL) + """
SELECT lower(trim(filter_col1)) AS filter_col1, lower(trim(filter_condn1)) AS filter_condn1,
  lower(trim(filter_col2)) AS filter_col2, lower(trim(filter_condn2)) AS filter_condn2,
  val_col AS value_col, lower(trim(new_trans_col)) AS new_col
FROM fx_rules WHERE active = 1 AND chnl_key IN (SELECT chnl_key FROM chnl)"""
    q["journey_tags"] = _with(("fx_event_config", "fx_chnl_map"), ACTIVE_EVENTS) + """
SELECT evnt_cd, string_agg(tag, ',' ORDER BY tag) AS tags FROM (
  SELECT DISTINCT evnt_cd, lower(trim(tag)) AS tag
  FROM (SELECT evnt_cd, unnest(string_split(cmpx_jrny_tag, ',')) AS tag FROM event_config))
GROUP BY evnt_cd"""

    q["details_clean"] = _with(("fx_details",), CLEAN) + "SELECT * FROM clean"
    q["tagname_normalised"] = _with(("fx_details",)) + """
SELECT uid, seq, tagvalue, CASE
  WHEN lower(trim(acn_cat_nme)) IN ('/olb/bulkpay/grouppaymentstepfour.json', '/olb/fspay/mrp/payments.json')
  THEN regexp_replace(trim(tagname), '\\.[0-9]+', '', 'g') ELSE tagname END AS tagname
FROM fx_details"""
    q["tagname_marked"] = _with(("fx_details",)) + """
SELECT uid, seq, tagvalue, CASE
  WHEN lower(trim(acn_cat_nme)) IN ('/olb/bulkpay/grouppaymentstepfour.json', 'paym')
  THEN regexp_replace(trim(tagname), '[_0-9]', '*', 'g') ELSE tagname END AS tagname
FROM fx_details"""
    q["tag_category"] = _with(("fx_details",)) + """
SELECT uid, seq, tagvalue, CASE
  WHEN lower(trim(acn_cat_nme)) LIKE '%instn%' THEN '/olb/ku/pay/grouppaymentsstepfour.json'
  WHEN lower(trim(acn_cat_nme)) LIKE '%paym%' THEN '/olb/ku/pay/payments.json'
  ELSE regexp_replace(tagname, '[0-9]', '', 'g') END AS tagname
FROM fx_details"""
    q["tag_category_main"] = _with(("fx_main",)) + """
SELECT uid, CASE
  WHEN lower(trim(acn_cat_nme)) LIKE '%instn%' THEN '/olb/ku/pay/grouppaymentsstepfour.json'
  WHEN lower(trim(acn_cat_nme)) LIKE '%paym%' THEN '/olb/ku/pay/payments.json'
  ELSE regexp_replace('tag' || uid || '_x', '[0-9]', '', 'g') END AS tagname
FROM (SELECT uid, CASE WHEN acn_cat_nme = 'paym' AND stopflow_t IS NOT NULL THEN ' InstN ' || acn_cat_nme
                       ELSE acn_cat_nme END AS acn_cat_nme FROM fx_main)"""
    q["tag_volume"] = _with(("fx_details",), CLEAN) + """
SELECT uid, seq, tagname, tagvalue, CASE
  WHEN lower(trim(acn_cat_nme)) = '/olb/bulkpay/grouppaymentstepfour.json'
  THEN coalesce(TRY_CAST(string_split(trim(tagname), '.')[2] AS INTEGER), 1) ELSE 1 END AS vol
FROM clean"""
    q["tag_volume_marked"] = _with(("fx_details",), CLEAN) + """
SELECT uid, seq, tagvalue, CASE
  WHEN lower(trim(acn_cat_nme)) = '/olb/bulkpay/grouppaymentstepfour.json' THEN coalesce(seq, 1) ELSE 1 END AS vol
FROM clean"""
    q["details_dedup_by_category"] = _with(("fx_details",), CLEAN) + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY uid, log_dte, tagname, tagvalue, acn_cat_nme
    ORDER BY seq NULLS FIRST, mmb_num NULLS FIRST, ses_idr NULLS FIRST,
             log_tme NULLS FIRST, acn_nme NULLS FIRST, log_millisec NULLS FIRST, msg_typ NULLS FIRST) AS rn
  FROM clean) WHERE rn = 1"""
    q["details_dedup"] = _with(("fx_details",), DEDUP) + "SELECT * FROM dedup"
    q["first_transaction"] = _with(("fx_details", "fx_event_config", "fx_chnl_map", "fx_main"), ACTIVE_EVENTS) + """
, ranked AS (
  SELECT uid, lower(trim(acn_cat_nme)) AS category, tagvalue AS tran_amt,
    row_number() OVER (PARTITION BY uid, lower(trim(acn_cat_nme))
      ORDER BY log_dte NULLS FIRST, seq NULLS FIRST, tagvalue NULLS FIRST) AS rn
  FROM fx_details d
  WHERE EXISTS (SELECT 1 FROM event_config c
    WHERE lower(trim(c.trgt_col_nm)) = 'tran_amt' AND lower(trim(c.evnt_cd)) = lower(trim(d.acn_cat_nme))
      AND lower(trim(c.tag_nm)) = lower(trim(d.tagname))))
SELECT m.uid, m.acn_cat_nme, regexp_replace(trim(r.tran_amt), '[^0-9]', '', 'g') AS tran_amt_first
FROM fx_main m JOIN ranked r ON m.uid = r.uid AND lower(trim(m.acn_cat_nme)) = r.category
WHERE r.rn = 1 AND r.tran_amt IS NOT NULL AND trim(r.tran_amt) <> ''"""
    matched = """
, amounts AS (
  SELECT d.uid, d.log_dte, d.tagname, d.tagvalue, c.evnt_cd, c.trgt_col_nm, c.tag_nm,
    CASE WHEN lower(trim(c.trgt_col_nm)) = 'tran_amt' AND lower(trim(c.tag_nm)) = lower(trim(d.tagname))
         THEN d.tagvalue END AS tran_amt
  FROM dedup d LEFT JOIN event_config c ON lower(trim(d.acn_cat_nme)) = lower(trim(c.evnt_cd)))
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY uid, evnt_cd
    ORDER BY tran_amt IS NULL, tagname NULLS FIRST, tagvalue NULLS FIRST, tag_nm NULLS FIRST,
             log_dte NULLS FIRST, trgt_col_nm NULLS FIRST) AS rn
  FROM amounts) WHERE rn = 1"""
    q["event_config_match"] = _with(("fx_details", "fx_event_config", "fx_chnl_map"), DEDUP, ACTIVE_EVENTS) + matched
    q["event_amounts"] = _with(("fx_details", "fx_event_config", "fx_chnl_map"), CLEAN, """dedup AS (
  SELECT DISTINCT uid, log_dte, tagvalue, acn_cat_nme, CASE
    WHEN lower(trim(acn_cat_nme)) LIKE '%instn%' THEN '/olb/ku/pay/grouppaymentsstepfour.json'
    WHEN lower(trim(acn_cat_nme)) LIKE '%paym%' THEN '/olb/ku/pay/payments.json'
    ELSE regexp_replace(tagname, '[0-9]', '', 'g') END AS tagname
  FROM clean)""", ACTIVE_EVENTS) + matched
    q["tags_transposed"] = _with(("fx_details",), STRIPPED) + f"""
SELECT uid, {WIDE_COLUMNS}
FROM stripped GROUP BY uid"""
    q["tags_transposed_by_join"] = q["tags_transposed"]
    q["details_grouped"] = _with(("fx_details",), STRIPPED) + """
SELECT uid, max(log_dte) AS log_dte, max(seq) AS seq, max(acn_cat_nme) AS acn_cat_nme, max(tagname) AS tagname,
  max(tagvalue) AS tagvalue, max(mmb_num) AS mmb_num, max(ses_idr) AS ses_idr, max(log_tme) AS log_tme,
  max(acn_nme) AS acn_nme, max(log_millisec) AS log_millisec, max(msg_typ) AS msg_typ, max(vol) AS vol
FROM stripped GROUP BY uid"""
    request = "uid, mmb_num, ses_idr, log_tme, acn_nme, log_millisec, acn_cat_nme, msg_typ, log_dte"
    q["details_grouped_by_request"] = _with(("fx_details",), STRIPPED) + f"""
SELECT {request}, max(vol) AS vol FROM stripped GROUP BY {request}"""
    pairs = """
, tags AS (
  SELECT DISTINCT lower(trim(evnt_cd)) AS event, lower(trim(tag)) AS tag
  FROM (SELECT evnt_cd, unnest(string_split(cmpx_jrny_tag, ',')) AS tag FROM event_config)),
pairs AS (
  SELECT DISTINCT d.uid, d.tagname, d.tagvalue FROM stripped d
  WHERE EXISTS (SELECT 1 FROM tags t WHERE t.event = lower(trim(d.acn_cat_nme)) AND t.tag = lower(trim(d.tagname))))
"""
    vector_views = ("fx_details", "fx_event_config", "fx_chnl_map")
    part = "CAST(CAST('0x' || left(md5({}), 8) AS BIGINT) % {} AS INTEGER)".format
    q["tag_vector"] = _with(vector_views, STRIPPED, ACTIVE_EVENTS) + pairs + f"""
SELECT uid, {part("tagname || '=' || tagvalue", 3)} AS part,
  string_agg(tagname || '=' || tagvalue, ',' ORDER BY tagname, tagvalue) AS tags
FROM pairs GROUP BY ALL"""
    q["tag_names"] = _with(vector_views, STRIPPED, ACTIVE_EVENTS) + pairs + """
SELECT uid, string_agg(tagname, ',' ORDER BY tagname) AS tags
FROM (SELECT DISTINCT uid, tagname FROM pairs) GROUP BY uid"""
    q["tag_pairs"] = _with(vector_views, STRIPPED, ACTIVE_EVENTS) + pairs + "SELECT * FROM pairs"
    q["request_tags"] = q["tag_pairs"]
    q["tag_map"] = _with(vector_views, STRIPPED, ACTIVE_EVENTS) + pairs + f"""
SELECT uid, {part("tagname", 2)} AS part, string_agg(tagname || '=' || tagvalue, ',' ORDER BY tagname) AS tags
FROM (SELECT uid, tagname, max(tagvalue) AS tagvalue FROM pairs GROUP BY uid, tagname) GROUP BY ALL"""

    q["main_normalised"] = _with(("fx_main",), MAIN) + "SELECT * FROM main"
    wide = f"wide AS (SELECT uid, log_dte, {WIDE_COLUMNS}, max(vol) AS vol FROM stripped GROUP BY uid, log_dte)"
    q["main_enriched"] = _with(("fx_details", "fx_main"), STRIPPED, wide, MAIN) + """
SELECT m.*, w.* EXCLUDE (uid, log_dte) FROM main m LEFT JOIN wide w ON m.uid = w.uid AND m.log_dte = w.log_dte"""
    q["main_grouped"] = _with(("fx_details", "fx_main"), CLEAN, MAIN) + """
SELECT m.*, d.log_dte_t, d.mmb_num_t, d.acn_cat_nme_t, d.ses_idr
FROM main m LEFT JOIN (
  SELECT uid, max(log_dte) AS log_dte_t, max(mmb_num) AS mmb_num_t, max(acn_cat_nme) AS acn_cat_nme_t, max(ses_idr) AS ses_idr
  FROM clean GROUP BY uid) d ON m.uid = d.uid"""

    q["account_ids"] = _with(("fx_accounts",)) + f"""
SELECT uid,
  CASE WHEN sortcode1_t IS NOT NULL AND sortcode2_t IS NOT NULL AND sortcode3_t IS NOT NULL
       THEN trim(sortcode1_t) || trim(sortcode2_t) || trim(sortcode3_t) ELSE to_acct_id END AS v_to_acct_id_t,
  coalesce({digits('fr_acct_id')}, {digits('prd_key')}, {digits('src_idw_tp')}, {digits('val', '0-9.')}) AS fr_acct_id
FROM fx_accounts"""
    q["account_ids_literal"] = _with(("fx_accounts",)) + """
SELECT uid, coalesce(regexp_replace(trim(fr_acct_id), '[^0-9]', '', 'g'), regexp_replace(trim(prd_key), '[^0-9]', '', 'g'),
  regexp_replace(trim(src_idw_tp), '[^0-9]', '', 'g'), regexp_replace(trim(val), '[^0-9.]', '', 'g')) AS fr_acct_id
FROM fx_accounts"""
    members = _with(("fx_details", "fx_main"), STRIPPED, wide, """members AS (
  SELECT m.uid, m.mmb_num, w.mmb_num_t FROM fx_main m LEFT JOIN wide w ON m.uid = w.uid AND m.log_dte = w.log_dte)""")
    q["member_placeholder"] = members + """
SELECT uid, CASE WHEN coalesce(trim(mmb_num), '0') = '999999999999' AND mmb_num_t IS NOT NULL AND trim(mmb_num_t) <> ''
                 THEN trim(mmb_num_t) ELSE mmb_num END AS mmb_num, mmb_num_t FROM members"""
    q["member_prefer_detail"] = members + """
SELECT uid, mmb_num, mmb_num_t,
  CASE WHEN trim(mmb_num) <> '999999999999' AND mmb_num_t IS NOT NULL AND trim(mmb_num_t) <> ''
       THEN trim(mmb_num_t) ELSE coalesce(trim(mmb_num), '-99') END AS cust_mbr_id FROM members"""

    q["customer_link_active"] = _with(("fx_custlink",), LINK) + "SELECT * FROM link"
    q["customer_link_latest"] = _with(("fx_custlink",), LATEST_LINK) + "SELECT * FROM latest"
    q["customer_id"] = _with(("fx_main", "fx_custlink"), LATEST_LINK) + """
SELECT m.* EXCLUDE (cus_idr), m.cus_idr AS main_cus_idr, coalesce(trim(l.cus_idr), '-99') AS cus_idr,
  coalesce(TRY_CAST(trim(l.cus_idr) AS BIGINT), -99) AS cust_id
FROM fx_main m LEFT JOIN latest l ON trim(m.mmb_num) = l.mmb_lnk_mmb_num"""
    newest = "(SELECT max(log_dte) FROM fx_main)"
    q["latest_day"] = _with(("fx_main",)) + f"SELECT * FROM fx_main WHERE log_dte = {newest}"
    q["latest_day_customers"] = _with(("fx_main", "fx_custlink"), LATEST_LINK) + f"""
SELECT m.uid, coalesce(TRY_CAST(trim(l.cus_idr) AS BIGINT), -99) AS cust_id
FROM fx_main m LEFT JOIN latest l ON trim(m.mmb_num) = l.mmb_lnk_mmb_num WHERE m.log_dte = {newest}"""
    q["event_constants"] = _with(("fx_details",)) + """
SELECT uid, seq, tagname, tagvalue, '10001028' AS event_id, 'OLB' AS chnl_cd, trim(acn_cat_nme) AS event_cd FROM fx_details"""
    q["error_code"] = _with(("fx_main",)) + f"SELECT uid, err_msg_txt, {ERR_CODE} AS err_cd FROM fx_main"
    q["result_flag"] = _with(("fx_main",)) + f"SELECT uid, err_msg_txt, {RESULT} AS result_flag FROM fx_main"

    dims = ("fx_chnl_map", "fx_event_map", "fx_err_map")
    q["dimension_keys_left"] = _with(("fx_main", *dims)) + f"""
SELECT m.uid, m.chnl_cd, m.event_cd, m.err_cd, c.chnl_key, e.event_key, r.err_key
FROM (SELECT uid, chnl_cd, trim(acn_cat_nme) AS event_cd, {ERR_CODE} AS err_cd FROM fx_main) m
LEFT JOIN (SELECT * FROM fx_chnl_map WHERE active = 1) c ON m.chnl_cd = c.chnl_cd
LEFT JOIN (SELECT * FROM fx_event_map WHERE active = 1) e ON m.event_cd = e.event_cd
LEFT JOIN fx_err_map r ON m.err_cd = r.err_cd"""
    q["dimension_keys_inner"] = _with(("fx_event_detail", *dims)) + """
SELECT c.chnl_key, e.event_key, r.err_key FROM fx_event_detail d
JOIN (SELECT * FROM fx_chnl_map WHERE active = 1) c ON d.chnl_cd = c.chnl_cd
JOIN (SELECT * FROM fx_event_map WHERE active = 1) e ON d.evnt_cd = e.event_cd
JOIN fx_err_map r ON d.err_cd = r.err_cd"""

    q["mapping_flow"] = _with(("fx_main", "fx_custlink", "fx_event_codes", *dims), LATEST_LINK) + f"""
SELECT m.* EXCLUDE (cus_idr, chnl_cd, err_msg_txt), m.cus_idr AS main_cus_idr, coalesce(trim(l.cus_idr), '-99') AS cus_idr,
  coalesce(TRY_CAST(trim(l.cus_idr) AS BIGINT), -99) AS cust_id, d.chnl_cd, d.evnt_cd, d.err_cd,
  c.chnl_key, e.event_key, r.err_key, {RESULT.replace('err_msg_txt', 'm.err_msg_txt')} AS err_msg_txt
FROM fx_main m LEFT JOIN latest l ON trim(m.mmb_num) = l.mmb_lnk_mmb_num
LEFT JOIN fx_event_codes d ON m.uid = d.uid
LEFT JOIN (SELECT * FROM fx_chnl_map WHERE active = 1) c ON d.chnl_cd = c.chnl_cd
LEFT JOIN (SELECT * FROM fx_event_map WHERE active = 1) e ON d.evnt_cd = e.event_cd
LEFT JOIN fx_err_map r ON d.err_cd = r.err_cd"""

    q["account_masked"] = _with(("fx_accounts",)) + f"""
SELECT uid, {mask('fr_acct_id')} AS fr_acct_id, {mask('to_acct_id')} AS to_acct_id FROM fx_accounts"""
    q["amount_clipped"] = _with(("fx_accounts",)) + f"SELECT uid, {clip('tran_amt')} AS tran_amt FROM fx_accounts"
    q["amount_clipped_keep_12"] = _with(("fx_accounts",)) + """
SELECT uid, CASE WHEN length(string_split(tran_amt, '.')[1]) > 12 THEN left(tran_amt, 12) ELSE tran_amt END AS tran_amt
FROM fx_accounts"""
    q["brace_quoted"] = _with(("fx_text",)) + """
SELECT event_id, regexp_replace(text, '(\\}+)$', '"\\1') AS text FROM fx_text"""
    q["quoted_all"] = _with(("fx_text",)) + """
SELECT event_id, array_to_string(regexp_extract_all(text, '"(.*?)"', 1), '~') AS quoted FROM fx_text"""
    q["quoted_all_pages"] = """
SELECT page_id, array_to_string(regexp_extract_all(html, '"(.*?)"', 1), '~') AS quoted FROM pages"""
    q["quoted_first"] = _with(("fx_text",)) + """
SELECT event_id, regexp_extract(text, '"(.*?)"', 1) AS quoted FROM fx_text"""
    q["quoted_styles"] = _with(("fx_escaped",)) + r"""
SELECT page_id, regexp_extract(plain, '"(.*?)"', 1) AS plain,
  regexp_extract(backslash, '\\"(.*?)\\"', 1) AS backslash,
  regexp_extract(backslash_apostrophe, '\\''"(.*?)"\\''', 1) AS backslash_apostrophe,
  regexp_extract(doubled, '""(.*?)\\""', 1) AS doubled
FROM fx_escaped"""
    q["row_json"] = """
SELECT event_id, '{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '"'
  || CASE WHEN user_id % 5 = 0 THEN '' ELSE ',"user_id":' || CAST(user_id AS VARCHAR) END || '}' AS json
FROM events"""
    q["pair_map"] = """
SELECT event_id, '{"' || event_type || '":"' || CAST(user_id AS VARCHAR) || '"}' AS pair FROM events"""

    q["journey_flags"] = _with(("fx_journey",), JOURNEY) + "SELECT * FROM broken"
    any_rule = "(J1 OR J2 OR J2b OR J3 OR J4)"
    q["journeys_kept"] = _with(("fx_journey",), JOURNEY) + f"""
SELECT j.* FROM fx_journey j JOIN broken b USING (journey_id) WHERE NOT {any_rule}"""
    q["journeys_removed"] = _with(("fx_journey",), JOURNEY) + f"""
SELECT j.*, concat_ws(',', CASE WHEN J1 THEN 'J1' END, CASE WHEN J2 THEN 'J2' END, CASE WHEN J2b THEN 'J2b' END,
  CASE WHEN J3 THEN 'J3' END, CASE WHEN J4 THEN 'J4' END) AS reasons
FROM fx_journey j JOIN broken b USING (journey_id) WHERE {any_rule}"""

    q["journeys_labelled"] = _with(("fx_journey",), JOURNEY) + """
SELECT j.*, concat_ws(',', CASE WHEN J1 THEN 'J1' END, CASE WHEN J2 THEN 'J2' END, CASE WHEN J2b THEN 'J2b' END,
  CASE WHEN J3 THEN 'J3' END, CASE WHEN J4 THEN 'J4' END) AS reasons
FROM fx_journey j LEFT JOIN broken b USING (journey_id)"""

    # other ways to the same results
    q["first_transaction_sql"], q["event_amounts_sql"] = q["first_transaction"], q["event_amounts"]
    q["tag_pairs_filtered"], q["journeys_removed_filtered"] = q["tag_pairs"], q["journeys_removed"]
    q["latest_day_by_catalog"], q["main_enriched_bucketed"] = q["latest_day"], q["main_enriched"]
    q["customer_id_hot"] = _with(("fx_main", "fx_custlink"), LATEST_LINK) + """
SELECT m.* EXCLUDE (cus_idr), m.cus_idr AS main_cus_idr, coalesce(trim(l.cus_idr), '-99') AS cus_idr,
  coalesce(TRY_CAST(trim(l.cus_idr) AS BIGINT), -99) AS cust_id
FROM (SELECT * REPLACE (CASE WHEN CAST(uid AS BIGINT) % 3 = 0 THEN '7' ELSE mmb_num END AS mmb_num) FROM fx_main) m
LEFT JOIN latest l ON trim(m.mmb_num) = l.mmb_lnk_mmb_num"""
    q["table_days"] = _with(("fx_main",)) + """
SELECT * FROM fx_main WHERE log_dte <> DATE '2024-01-05' AND (log_dte <> DATE '2024-01-06' OR acn_cat_nme = 'LOGIN')"""
    q["csv_by_header"] = _with(("fx_event_codes",)) + """
SELECT * FROM fx_event_codes WHERE CAST(uid AS BIGINT) % 97 <> 0 AND CAST(uid AS BIGINT) % 101 <> 0"""
    q["csv_no_rows"] = _with(("fx_event_codes",)) + """
SELECT CASE WHEN CAST(uid AS BIGINT) % 97 = 0 THEN uid ELSE '"' || CASE CAST(uid AS BIGINT) % 3
    WHEN 0 THEN concat_ws(',', uid, chnl_cd, evnt_cd, coalesce(err_cd, ''))
    WHEN 1 THEN concat_ws(',', coalesce(err_cd, ''), evnt_cd, uid, chnl_cd)
    ELSE concat_ws(',', evnt_cd, chnl_cd, coalesce(err_cd, ''), uid) END END AS text,
  CASE WHEN CAST(uid AS BIGINT) % 97 = 0 THEN 'columns' ELSE 'unclosed' END AS reason
FROM fx_event_codes WHERE CAST(uid AS BIGINT) % 97 = 0 OR CAST(uid AS BIGINT) % 101 = 0"""
    q["journey_counts"] = _with(("fx_journey",), JOURNEY) + f"""
SELECT count(*) AS rows, count(*) FILTER (NOT {any_rule}) AS kept, count(*) FILTER ({any_rule}) AS removed,
  {", ".join(f"count(*) FILTER ({r}) AS {r}" for r in ("J1", "J2", "J2b", "J3", "J4"))}
FROM fx_journey JOIN broken USING (journey_id)"""

    q["audit_flow"] = _with(
        ("fx_details", "fx_main", "fx_custlink", "fx_chnl_map", "fx_event_map", "fx_err_map"),
        STRIPPED, wide, MAIN, LINK, CHANNEL,
        f"""enriched AS (
  SELECT m.uid, m.log_dte, m.err_msg_txt, m.acn_cat_nme, m.cus_idr AS main_cus_idr, m.stopflow_t,
    CASE WHEN trim(m.mmb_num) = '999999999999' AND trim(coalesce(w.mmb_num_t, '')) <> ''
         THEN trim(w.mmb_num_t) ELSE m.mmb_num END AS mmb_num,
    w.mmb_num_t, w.vol, w.tran_amt, w.to_acct_id, w.to_acct_id AS v_to_acct_id_t, w.prd_key, w.val, w.never_set,
    coalesce({digits('w.fr_acct_id')}, {digits('w.prd_key')}, {digits('w.val', '0-9.')}) AS fr_acct_id,
    {ERR_CODE.replace('err_msg_txt', 'm.err_msg_txt').replace('stopflow_t', 'm.stopflow_t')} AS err_cd
  FROM main m LEFT JOIN wide w ON m.uid = w.uid AND m.log_dte = w.log_dte)""",
    ) + f"""
SELECT e.uid, e.log_dte, e.mmb_num, e.err_msg_txt, e.stopflow_t, e.acn_cat_nme, e.main_cus_idr, e.mmb_num_t,
  e.vol, e.prd_key, e.val, e.never_set, 'OLB' AS chnl_cd, '10001028' AS event_id, trim(e.acn_cat_nme) AS event_cd, e.err_cd,
  coalesce(trim(l.cus_idr), '-99') AS cus_idr, coalesce(TRY_CAST(trim(l.cus_idr) AS BIGINT), -99) AS cust_id,
  (SELECT chnl_key FROM chnl) AS chnl_key, v.event_key, r.err_key,
  {RESULT.replace('err_msg_txt', 'e.err_msg_txt')} AS result_flag,
  {mask('e.v_to_acct_id_t')} AS v_to_acct_id_t, {mask('e.to_acct_id')} AS to_acct_id, {mask('e.fr_acct_id')} AS fr_acct_id,
  {clip('e.tran_amt')} AS tran_amt,
  CAST(NULL AS VARCHAR) AS sortcode1_t, CAST(NULL AS VARCHAR) AS sortcode2_t, CAST(NULL AS VARCHAR) AS sortcode3_t,
  CAST(NULL AS VARCHAR) AS src_idw_tp
FROM enriched e
LEFT JOIN link l ON trim(e.mmb_num) = l.mmb_lnk_mmb_num
LEFT JOIN (SELECT * FROM fx_event_map WHERE active = 1) v ON trim(e.acn_cat_nme) = v.event_cd
LEFT JOIN fx_err_map r ON e.err_cd = r.err_cd"""
    return q
