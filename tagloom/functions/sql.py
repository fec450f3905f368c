"""The column rules as functions of Spark SQL, and the two statements written with them.

The functions have SQL bodies, so Spark inlines them into the query like built-in ones. They are temporary: `register`
makes them in a session, nothing is left behind in a catalog.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import fields
from tagloom.functions.text import norm
from tagloom.operators.joins import SLOTS, hot_hashes

_STRIPPED = ", ".join(f"'{c}'" for c in fields.STRIPPED_CATEGORIES)

#: Name, arguments, type and body of each function.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "norm": ("c STRING", "STRING", "lower(trim(c))"),
    "is_blank": ("c STRING", "BOOLEAN", "c IS NULL OR trim(c) = ''"),
    "is_present": ("c STRING", "BOOLEAN", "c IS NOT NULL AND lower(trim(c)) NOT IN ('', 'null')"),
    "keep_chars": ("c STRING, dropped STRING", "STRING", "nullif(regexp_replace(trim(c), dropped, ''), '')"),
    "mask_account": (
        "c STRING", "STRING", "CASE WHEN length(c) >= 14 THEN concat(substring(c, 1, 6), '|', substring(c, -7, 7)) ELSE c END"
    ),
    "clip_amount": (
        "c STRING, keep_exact_12 BOOLEAN",
        "STRING",
        "CASE WHEN length(substring_index(c, '.', 1)) > 12 THEN substring(c, 1, 12) "
        "WHEN length(substring_index(c, '.', 1)) < 12 OR keep_exact_12 THEN c END",
    ),
    "quote_before_braces": ("c STRING", "STRING", r"""regexp_replace(c, r'(?<!\})\}++$', '"$0')"""),
    "extract_quoted": ("c STRING", "STRING", """regexp_extract(c, '"(.*?)"', 1)"""),
    "extract_quoted_all": ("c STRING", "ARRAY<STRING>", """regexp_extract_all(c, '"(.*?)"', 1)"""),
    "normalise_tagname": (
        "category STRING, tagname STRING",
        "STRING",
        f"CASE WHEN lower(trim(category)) IN ({_STRIPPED}) THEN regexp_replace(trim(tagname), r'\\.[0-9]+', '') ELSE tagname END",
    ),
    "categorise_tag": (
        "category STRING, tagname STRING",
        "STRING",
        f"CASE WHEN lower(trim(category)) LIKE '%instn%' THEN '{fields.INSTRUCTION_PATH}' "
        f"WHEN lower(trim(category)) LIKE '%paym%' THEN '{fields.PAYMENT_PATH}' ELSE regexp_replace(tagname, '[0-9]', '') END",
    ),
    "tag_volume": (
        "category STRING, tagname STRING",
        "INT",
        f"coalesce(CASE WHEN lower(trim(category)) = '{fields.GROUP_PAYMENT}' AND contains(trim(tagname), '.') "
        "THEN try_cast(substring_index(substring_index(trim(tagname), '.', 2), '.', -1) AS INT) END, 1)",
    ),
    "to_account_id": (
        "sort1 STRING, sort2 STRING, sort3 STRING, account STRING",
        "STRING",
        "coalesce(concat(trim(sort1), trim(sort2), trim(sort3)), account)",
    ),
    "from_account_id": (
        "account STRING, product STRING, source STRING, val STRING",
        "STRING",
        "coalesce(nullif(regexp_replace(trim(account), '[^0-9]', ''), ''), nullif(regexp_replace(trim(product), '[^0-9]', ''), ''), "
        "nullif(regexp_replace(trim(source), '[^0-9]', ''), ''), nullif(regexp_replace(trim(val), '[^0-9.]', ''), ''))",
    ),
    "member_id_placeholder": (
        "member STRING, detail STRING",
        "STRING",
        f"CASE WHEN trim(member) = '{fields.PLACEHOLDER_MEMBER}' AND trim(detail) <> '' THEN trim(detail) ELSE member END",
    ),
    "member_id_prefer_detail": (
        "member STRING, detail STRING",
        "STRING",
        f"CASE WHEN trim(member) <> '{fields.PLACEHOLDER_MEMBER}' AND trim(detail) <> '' THEN trim(detail) "
        f"ELSE coalesce(trim(member), '{fields.NO_ID}') END",
    ),
    "error_code": (
        "message STRING, stopflow STRING",
        "STRING",
        "CASE WHEN length(trim(message)) < 20 AND lower(trim(message)) <> 'none' THEN trim(message) "
        "WHEN message IS NULL OR lower(trim(message)) = 'none' THEN trim(stopflow) END",
    ),
    "result_flag": ("message STRING", "STRING", "CASE WHEN trim(message) IN ('none', 'null') THEN 'Success' ELSE 'Failure' END"),
}


def register(spark: SparkSession, prefix: str = "audit_") -> list[str]:
    """Make the functions in the session, each under its name behind `prefix`; their names."""
    for name, (arguments, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS {kind} RETURN {body}")
    return [prefix + name for name in FUNCTIONS]


#: The amount of the first configured tag of each request and category. Views: audit_details with a column seq,
#: event_attr_config, audit_main.
FIRST_TRANSACTION = """
WITH wanted AS (
  SELECT DISTINCT audit_norm(evnt_cd) AS category, audit_norm(tag_nm) AS tag
  FROM {event_attr_config} WHERE audit_norm(trgt_col_nm) = 'tran_amt'
), detail_tran AS (
  SELECT a.uid, audit_norm(a.acn_cat_nme) AS category, a.tagvalue AS tran_amt,
    row_number() OVER (PARTITION BY a.uid, audit_norm(a.acn_cat_nme)
      ORDER BY a.log_dte NULLS FIRST, a.seq NULLS FIRST, a.tagvalue NULLS FIRST) AS rn
  FROM {audit_details} a
  LEFT SEMI JOIN wanted b ON audit_norm(a.acn_cat_nme) = b.category AND audit_norm(a.tagname) = b.tag
), first_tran AS (
  SELECT uid, category, tran_amt FROM detail_tran WHERE rn = 1
)
SELECT c.uid, c.acn_cat_nme, regexp_replace(trim(d.tran_amt), '[^0-9]', '') AS tran_amt_first
FROM {audit_main} c JOIN first_tran d ON c.uid = d.uid AND audit_norm(c.acn_cat_nme) = d.category
WHERE NOT audit_is_blank(d.tran_amt)
"""

#: The amount of each request and event. Views: audit_details, event_attr_config.
EVENT_AMOUNTS = """
WITH tagged AS (
  SELECT DISTINCT uid, log_dte, audit_categorise_tag(acn_cat_nme, tagname) AS tagname, tagvalue, acn_cat_nme
  FROM {audit_details} WHERE audit_is_present(tagvalue)
), joined AS (
  SELECT d.*, c.evnt_cd, c.trgt_col_nm, c.tag_nm,
    CASE WHEN audit_norm(c.trgt_col_nm) = 'tran_amt' AND audit_norm(c.tag_nm) = audit_norm(d.tagname) THEN d.tagvalue END AS tran_amt
  FROM tagged d LEFT JOIN {event_attr_config} c ON audit_norm(d.acn_cat_nme) = audit_norm(c.evnt_cd)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY uid, evnt_cd ORDER BY tran_amt IS NULL, tagname NULLS FIRST, tagvalue NULLS FIRST,
    tag_nm NULLS FIRST, log_dte NULLS FIRST, trgt_col_nm NULLS FIRST) AS rn
  FROM joined
)
SELECT uid, log_dte, tagname, tagvalue, evnt_cd, trgt_col_nm, tag_nm, tran_amt FROM ranked WHERE rn = 1
"""


def run_statement(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """A statement over frames by the names that it has in braces, with the functions above at hand."""
    register(spark)
    return spark.sql(text, **views)


# The statements join by category and tag, and a few of these hold most rows. The views below put a slot behind such a
# name on both sides, so that the same text joins it in many tasks: equal names and slots are equal texts, as a slot is a
# number behind the last `#`. Every name gets one, 0 where it is not frequent; null stays null.


def _with_slot(name: Column, slot: Column) -> Column:
    """The name with its slot, before the blanks at its end, which the statements trim."""
    bare = F.rtrim(name)
    return F.concat(bare, F.lit("#"), slot.cast("string"), F.substring(name, F.length(bare) + 1, F.length(name)))


def _slots_of(often: Column, hashed: Column) -> tuple[Column, Column]:
    """The slot of a row that is hashed to it, and all slots of a configuration row."""
    row = F.when(often, F.pmod(hashed, F.lit(SLOTS)).cast("int")).otherwise(0)
    return row, F.explode(F.when(often, F.sequence(F.lit(0), F.lit(SLOTS - 1))).otherwise(F.array(F.lit(0))))


def first_transaction_statement(details: DataFrame, event_attr_config: DataFrame, main: DataFrame) -> DataFrame:
    """FIRST_TRANSACTION with frequent pairs of category and tag spread over tasks; the tag is no column of the result."""
    here, there = (norm("acn_cat_nme"), norm("tagname")), (norm("evnt_cd"), norm("tag_nm"))
    hot = hot_hashes(details, here)
    slot, _ = _slots_of(F.array_contains(hot, F.xxhash64(*here)), F.xxhash64("uid", "seq", "tagvalue"))
    _, slots = _slots_of(F.array_contains(hot, F.xxhash64(*there)), F.lit(0))
    rows = details.withColumn("tagname", _with_slot(F.col("tagname"), slot))
    rules = event_attr_config.withColumn("_slot", slots).withColumn("tag_nm", _with_slot(F.col("tag_nm"), F.col("_slot")))
    views = {"audit_details": rows, "event_attr_config": rules.drop("_slot"), "audit_main": main}
    return run_statement(details.sparkSession, FIRST_TRANSACTION, **views)


def event_amounts_statement(details: DataFrame, event_attr_config: DataFrame) -> DataFrame:
    """EVENT_AMOUNTS with frequent categories spread over tasks. The slot is one of the request, so the rows of a request
    and event stay together; it is taken out of the event code again."""
    hot = hot_hashes(details, [norm("acn_cat_nme")])
    slot, _ = _slots_of(F.array_contains(hot, F.xxhash64(norm("acn_cat_nme"))), F.xxhash64("uid"))
    _, slots = _slots_of(F.array_contains(hot, F.xxhash64(norm("evnt_cd"))), F.lit(0))
    rows = details.withColumn("acn_cat_nme", _with_slot(F.col("acn_cat_nme"), slot))
    rules = event_attr_config.withColumn("_slot", slots).withColumn("evnt_cd", _with_slot(F.col("evnt_cd"), F.col("_slot")))
    found = run_statement(details.sparkSession, EVENT_AMOUNTS, audit_details=rows, event_attr_config=rules.drop("_slot"))
    return found.withColumn("evnt_cd", F.regexp_replace("evnt_cd", "#[0-9]+( *)$", "$1"))
