"""The full audit flow: one row per main request."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import fields, text
from tagloom.operators import config, customer, details, dimensions, requests
from tagloom.operators.joins import spread_join
from tagloom.schemas import typed
from tagloom.sources import tables
from tagloom.sources.tables import read_table

# Detail columns the later steps read; null where no rule fills them.
RULE_COLUMNS = (
    "sortcode1_t", "sortcode2_t", "sortcode3_t", "to_acct_id", "fr_acct_id", "prd_key",
    "src_idw_tp", "val", "tran_amt", "mmb_num_t", "stopflow_t",
)


# What details and main rows are grouped and joined by: rows of several days stay apart.
REQUEST_DAY = ("uid", "log_dte")


def wide_details(
    audit_details: DataFrame,
    rules: DataFrame,
    business_date: date | str | None = None,
) -> DataFrame:
    """Clean, number, strip, deduplicate and transpose detail rows: one row per uid and day.

    The volume is read before the suffix is stripped from the tag name, and rules are
    applied before rows are grouped, while the columns they name are still there.
    """
    rows = details.clean_details(audit_details, business_date)
    rows = fields.normalise_tagname(fields.tag_volume(rows))
    # of equal rows the one with the greatest volume stays: so the greatest volume of a
    # request does not depend on which rows are merged, and unused tags can go first
    names = details.rule_names(rules, rows)
    rows = details.cut_for_rules(rows, rules, keep=["vol"], names=names)
    rows = details.dedup_details(rows, greatest="vol")
    return details.transpose_by_rules(rows, rules, by=REQUEST_DAY, carry=["vol"], names=names)


def audit_flow(
    audit_details: DataFrame,
    audit_main: DataFrame,
    cust_link: DataFrame,
    chnl_map: DataFrame,
    rule_config: DataFrame,
    event_map: DataFrame,
    err_map: DataFrame | None = None,
    business_date: date | str | None = None,
    channel: str = fields.CHANNEL,
    colocated_by: str | None = None,
) -> DataFrame:
    """Every main row with its transposed details, customer, keys, masked ids and result.

    Runs over one business date, or over all of them if none is given; all days together
    give the rows of the single days.  Nothing but the names in the rule table is read
    while the plan is built.  Declared columns get their declared types first.
    `colocated_by` is the column that details and main rows lie in equal buckets of.
    """
    audit_details, audit_main = typed(audit_details, "audit_details"), typed(audit_main, "audit_main")
    cust_link, chnl_map = typed(cust_link, "cust_link"), typed(chnl_map, "chnl_map")
    rule_config, event_map = typed(rule_config, "rule_config"), typed(event_map, "event_map")
    err_map = err_map and typed(err_map, "err_map")
    chnl = config.active_channel_key(chnl_map, channel)
    rules = config.normalise_rules(rule_config, chnl)
    wide = wide_details(audit_details, rules, business_date)
    main = requests.normalise_main(audit_main, business_date)

    rows = requests.enrich_main(wide, main, by=REQUEST_DAY, colocated_by=colocated_by)
    have = {c.lower() for c in rows.columns}
    absent = [c for c in RULE_COLUMNS if c not in have]
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in absent})

    rows = fields.member_id_placeholder(rows)
    rows = customer.customer_id(rows, customer.active_customer_link(cust_link))
    # derived fields come after the last shuffle of these rows, which stay narrow that way
    rows = fields.from_account_id(fields.to_account_id(rows))
    rows = fields.event_constants(rows, channel=channel)
    # one error text per row: that among the tags where there is one, else that of the main row
    own = F.col("err_msg_txt")
    if "err_msg_txt_t" in rows.columns:
        own = F.when(text.is_present("err_msg_txt_t"), F.trim("err_msg_txt_t")).otherwise(own)
    rows = fields.error_code(rows.withColumn("_error", own), "_error")
    # the channel is one constant, so its key is a scalar, not a join on that constant
    rows = rows.withColumn("chnl_key", chnl.scalar())
    # frequent codes are found in the main rows; an error code only where these alone make it
    codes = fields.event_constants(main, channel=channel)
    if "err_msg_txt_t" not in rows.columns and "stopflow_t" in main.columns:
        codes = fields.error_code(codes)
    rows = dimensions.dimension_keys_left(rows, None, event_map, err_map, counted=codes)
    return fields.result_flag(rows, "_error").drop("_error").withColumns(
        {
            "v_to_acct_id_t": text.mask_account("v_to_acct_id_t"),
            "to_acct_id": text.mask_account("to_acct_id"),
            "fr_acct_id": text.mask_account("fr_acct_id"),
            "tran_amt": text.clip_amount("tran_amt"),
        }
    )


def flow_over_tables(
    spark: SparkSession,
    names: Mapping[str, str],
    business_date: date | str | None = None,
    channel: str = fields.CHANNEL,
) -> DataFrame:
    """`audit_flow` over catalog tables; `names` has the table of each of its inputs.

    Tables are checked against their schemas. Details and main rows that the sink has dealt to equal buckets of the
    request are joined where they lie.
    """
    inputs = {entity: read_table(spark, name, entity) for entity, name in names.items()}
    by = tables.shared_buckets(spark, names["audit_details"], names["audit_main"])
    return audit_flow(**inputs, business_date=business_date, channel=channel, colocated_by="uid" if by == "uid" else None)


def event_amounts(
    audit_details: DataFrame, event_attr_config: DataFrame, business_date: date | str | None = None
) -> DataFrame:
    """The amount of each request and event: clean, categorise, one row per tag, value and category, match.

    The category is part of the key here: a pair that occurs under two categories belongs
    to two events.
    """
    rows = fields.categorise_tag(details.clean_details(audit_details, business_date))
    key = (*details.DEDUP_KEY, "acn_cat_nme")
    return details.match_event_config(details.dedup_details(rows.select(*key), key), event_attr_config, counted=rows)


def mapping_flow(
    audit_main: DataFrame,
    cust_link: DataFrame,
    event_detail: DataFrame,
    chnl_map: DataFrame,
    event_map: DataFrame,
    err_map: DataFrame,
    on: str = "uid",
) -> DataFrame:
    """Every main row with its customer, the keys of its event's three codes and a result flag.

    `event_detail` has the codes of each request; of several rows of a request the first
    by channel, event and error counts.  The error text of a main row becomes its result.
    """
    codes = ["chnl_cd", "evnt_cd", "err_cd"]
    events = details.first_row(event_detail.select(on, *codes), [on], [F.col(c).asc_nulls_first() for c in codes])
    main = audit_main.drop(*codes)
    rows = customer.customer_id(main, customer.latest_customer_link(cust_link))
    rows = spread_join(rows, events, [on], spread_by=main.columns)
    rows = dimensions.dimension_keys_left(rows, chnl_map, event_map, err_map, event_code="evnt_cd", counted=event_detail)
    return fields.result_flag(rows, out="err_msg_txt")


def request_tags(
    audit_details: DataFrame, journey_config: DataFrame, chnl: DataFrame, business_date: date | str | None = None
) -> DataFrame:
    """The journey tags of each request, as distinct (uid, tagname, tagvalue) rows."""
    rows = fields.normalise_tagname(fields.tag_volume(details.clean_details(audit_details, business_date)))
    dedup = details.dedup_details(rows, greatest="vol")
    return details.tag_pairs(dedup, config.journey_tag_rows(journey_config, chnl), counted=rows)
