
from __future__ import annotations

import sys
from collections.abc import Callable
from functools import cached_property, partial
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from checks import oracle
from tagloom.functions import fields, sql, text
from tagloom.operators import config, customer, details, dimensions, journeys, requests
from tagloom.plans.audit import REQUEST_DAY, audit_flow, event_amounts, mapping_flow, request_tags, wide_details
from tagloom.schemas import REQUEST_COLUMNS
from tagloom.sources import csv_files, tables
from tagloom.sources.sample_views import base_table, view

SMOKE_DIR = "/root/testdata/sf0.001"


class _Inputs:
    """The views of one data directory, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self.spark = spark, sf_dir, spark

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        found = view(self._spark, self._dir, f"fx_{name}")
        setattr(self, name, found)
        return found

    def table(self, name: str) -> DataFrame:
        return base_table(self._spark, self._dir, name)

    # frames that several queries start from

    @cached_property
    def channel(self) -> DataFrame:
        return config.active_channel_key(self.chnl_map)

    @property
    def active_rules(self) -> DataFrame:
        return config.normalise_rules(self.rules, self.channel)

    @property
    def active_events(self) -> DataFrame:
        return config.active_for_channel(self.event_config, self.channel)

    @property
    def tag_rows(self) -> DataFrame:
        return config.journey_tag_rows(self.event_config, self.channel)

    @property
    def clean(self) -> DataFrame:
        return details.clean_details(self.details)

    @property
    def numbered(self) -> DataFrame:
        return fields.normalise_tagname(fields.tag_volume(self.clean))

    @property
    def stripped(self) -> DataFrame:
        return details.dedup_details(self.numbered, greatest="vol")

    @property
    def wide(self) -> DataFrame:
        return wide_details(self.details, self.active_rules)

    @property
    def members(self) -> DataFrame:
        wide, main = self.wide.select(*REQUEST_DAY, "mmb_num_t"), self.main.select(*REQUEST_DAY, "mmb_num")
        return requests.enrich_main(wide, main, by=REQUEST_DAY).drop("log_dte")

    @property
    def latest_link(self) -> DataFrame:
        return customer.latest_customer_link(self.custlink)


_QUERIES: dict[str, Callable[[_Inputs], DataFrame]] = {}


def _query(fn: Callable[[_Inputs], DataFrame]) -> Callable[[_Inputs], DataFrame]:
    _QUERIES[fn.__name__] = fn
    return fn


# --- configuration -----------------------------------------------------------


@_query
def active_channel_key(x: _Inputs) -> DataFrame:
    return x.channel


@_query
def rules_normalised(x: _Inputs) -> DataFrame:
    return x.active_rules


@_query
def journey_tags(x: _Inputs) -> DataFrame:
    tags = config.journey_tags(x.event_config, x.channel)
    return tags.select("evnt_cd", F.array_join("cmpx_jrny_tag_vec", ",").alias("tags"))


# --- details -----------------------------------------------------------------


@_query
def details_clean(x: _Inputs) -> DataFrame:
    return x.clean


@_query
def tagname_normalised(x: _Inputs) -> DataFrame:
    return fields.normalise_tagname(x.details).select("uid", "seq", "tagvalue", "tagname")


@_query
def tagname_marked(x: _Inputs) -> DataFrame:
    """Another strip rule and category list: digits and underscores become stars."""
    marked = fields.normalise_tagname(x.details, (fields.GROUP_PAYMENT, "paym"), "[_0-9]", "*")
    return marked.select("uid", "seq", "tagvalue", "tagname")


@_query
def tag_category(x: _Inputs) -> DataFrame:
    return fields.categorise_tag(x.details).select("uid", "seq", "tagvalue", "tagname")


@_query
def tag_category_main(x: _Inputs) -> DataFrame:
    """All three branches: instruction, payment and other categories."""
    both = (F.col("acn_cat_nme") == "paym") & F.col("stopflow_t").isNotNull()
    rows = x.main.select(
        "uid",
        F.when(both, F.concat(F.lit(" InstN "), "acn_cat_nme")).otherwise(F.col("acn_cat_nme")).alias("acn_cat_nme"),
        F.concat(F.lit("tag"), "uid", F.lit("_x")).alias("tagname"),
    )
    return fields.categorise_tag(rows).select("uid", "tagname")


@_query
def tag_volume(x: _Inputs) -> DataFrame:
    return fields.tag_volume(x.clean).select("uid", "seq", "tagname", "tagvalue", "vol")


@_query
def tag_volume_marked(x: _Inputs) -> DataFrame:
    """Another separator: the number behind an underscore."""
    rows = x.clean.withColumn("tagname", F.concat(F.lit("vol_"), F.col("seq").cast("string"), F.lit("_x")))
    return fields.tag_volume(rows, separator="_").select("uid", "seq", "tagvalue", "vol")


@_query
def details_dedup_by_category(x: _Inputs) -> DataFrame:
    """The category as part of the key: a pair stays once under each category."""
    return details.dedup_details(x.clean, (*details.DEDUP_KEY, "acn_cat_nme"), order_by=["seq"])


@_query
def details_dedup(x: _Inputs) -> DataFrame:
    return details.dedup_details(x.clean, order_by=["seq", "acn_cat_nme"])


@_query
def first_transaction(x: _Inputs) -> DataFrame:
    return details.first_transaction(x.details, x.active_events, x.main, order_by=["log_dte", "seq"])


@_query
def first_transaction_sql(x: _Inputs) -> DataFrame:
    """The same as a statement of SQL."""
    return sql.first_transaction_statement(x.details, x.active_events, x.main)


@_query
def event_amounts_sql(x: _Inputs) -> DataFrame:
    return sql.event_amounts_statement(x.details, x.active_events)


@_query
def event_config_match(x: _Inputs) -> DataFrame:
    dedup = details.dedup_details(x.clean, order_by=["seq", "acn_cat_nme"])
    return details.match_event_config(dedup, x.active_events, counted=x.clean)


@_query
def tags_transposed(x: _Inputs) -> DataFrame:
    return details.transpose_by_rules(x.stripped, x.active_rules)


@_query
def tags_transposed_by_join(x: _Inputs) -> DataFrame:
    """The two tests of each rule the other way round."""
    first, second = ("filter_col1", "filter_condn1"), ("filter_col2", "filter_condn2")
    swap = dict(zip((*first, *second), (*second, *first)))
    swapped = x.active_rules.select(*[F.col(c).alias(swap.get(c, c)) for c in x.active_rules.columns])
    return details.transpose_by_rules(x.stripped, swapped)


@_query
def details_grouped(x: _Inputs) -> DataFrame:
    return details.group_details(x.stripped)


@_query
def details_grouped_by_request(x: _Inputs) -> DataFrame:
    """The greatest volume of each combination of the request columns."""
    return details.group_details(x.stripped.select(*REQUEST_COLUMNS, "vol"), by=REQUEST_COLUMNS)


@_query
def tag_names(x: _Inputs) -> DataFrame:
    """Only the names of the pairs; no more for a request than there are configured tags."""
    names = details.tag_names(x.stripped, x.tag_rows, counted=x.numbered).groupBy("uid").agg(F.sort_array(F.collect_list("tagname")).alias("tags"))
    return names.select("uid", F.array_join("tags", ",").alias("tags"))


@_query
def tag_pairs(x: _Inputs) -> DataFrame:
    return details.tag_pairs(x.stripped, x.tag_rows, counted=x.numbered)


@_query
def tag_pairs_filtered(x: _Inputs) -> DataFrame:
    """Rows without a configured tag go before the shuffle."""
    return details.tag_pairs(x.stripped, x.tag_rows, expected_tags=x.tag_rows.count(), counted=x.numbered)


@_query
def tag_vector(x: _Inputs) -> DataFrame:
    vector = details.tag_vector(x.stripped, x.tag_rows, parts=3, counted=x.numbered)
    pair = F.transform("tag_vec", lambda p: F.concat_ws("=", p.tagname, p.tagvalue))
    return vector.select("uid", "part", F.array_join(pair, ",").alias("tags"))


@_query
def tag_map(x: _Inputs) -> DataFrame:
    entries = F.sort_array(F.map_entries("tag_map"))
    pair = F.transform(entries, lambda e: F.concat_ws("=", e.key, e.value))
    found = details.tag_map(x.stripped, x.tag_rows, parts=2, counted=x.numbered)
    return found.select("uid", "part", F.array_join(pair, ",").alias("tags"))


# --- main rows ---------------------------------------------------------------


@_query
def main_normalised(x: _Inputs) -> DataFrame:
    return requests.normalise_main(x.main)


@_query
def main_enriched(x: _Inputs) -> DataFrame:
    return requests.enrich_main(x.wide, requests.normalise_main(x.main), by=REQUEST_DAY)


@_query
def main_grouped(x: _Inputs) -> DataFrame:
    """Detail columns with the name of a main column get a suffix."""
    grouped = details.group_details(x.clean.select("uid", "log_dte", "mmb_num", "acn_cat_nme", "ses_idr"))
    return requests.enrich_main(grouped, requests.normalise_main(x.main))


@_query
def account_ids(x: _Inputs) -> DataFrame:
    rows = fields.from_account_id(fields.to_account_id(x.accounts))
    return rows.select("uid", "v_to_acct_id_t", "fr_acct_id")


@_query
def account_ids_literal(x: _Inputs) -> DataFrame:
    """An empty text counts as found."""
    return fields.from_account_id(x.accounts, blank_as_null=False).select("uid", "fr_acct_id")


@_query
def member_placeholder(x: _Inputs) -> DataFrame:
    return fields.member_id_placeholder(x.members)


@_query
def member_prefer_detail(x: _Inputs) -> DataFrame:
    return fields.member_id_prefer_detail(x.members)


@_query
def event_constants(x: _Inputs) -> DataFrame:
    rows = fields.event_constants(x.details)
    return rows.select("uid", "seq", "tagname", "tagvalue", "event_id", "chnl_cd", "event_cd")


@_query
def error_code(x: _Inputs) -> DataFrame:
    return fields.error_code(x.main).select("uid", "err_msg_txt", "err_cd")


@_query
def result_flag(x: _Inputs) -> DataFrame:
    return fields.result_flag(x.main).select("uid", "err_msg_txt", "result_flag")


@_query
def latest_day(x: _Inputs) -> DataFrame:
    return requests.latest_partition(x.main)


# --- customers and dimensions --------------------------------------------------


@_query
def customer_link_active(x: _Inputs) -> DataFrame:
    return customer.active_customer_link(x.custlink)


@_query
def customer_link_latest(x: _Inputs) -> DataFrame:
    return x.latest_link


@_query
def customer_id(x: _Inputs) -> DataFrame:
    return customer.customer_id(x.main, x.latest_link)


@_query
def customer_id_hot(x: _Inputs) -> DataFrame:
    """A third of the requests with one member, which nobody has declared."""
    member = F.when(F.col("uid").cast("long") % 3 == 0, F.lit("7")).otherwise(F.col("mmb_num"))
    return customer.customer_id(x.main.withColumn("mmb_num", member), x.latest_link, find_hot=True)


@_query
def latest_day_customers(x: _Inputs) -> DataFrame:
    newest = requests.latest_partition(x.main)
    return customer.customer_id(newest, x.latest_link).select("uid", "cust_id")


@_query
def dimension_keys_left(x: _Inputs) -> DataFrame:
    rows = fields.error_code(x.main).select(
        "uid", "chnl_cd", F.trim("acn_cat_nme").alias("event_cd"), "err_cd"
    )
    return dimensions.dimension_keys_left(rows, x.chnl_map, x.event_map, x.err_map, counted=rows)


@_query
def dimension_keys_inner(x: _Inputs) -> DataFrame:
    return dimensions.dimension_keys_inner(x.event_detail, x.chnl_map, x.event_map, x.err_map, counted=x.event_detail)


# --- text --------------------------------------------------------------------


@_query
def account_masked(x: _Inputs) -> DataFrame:
    masked = [text.mask_account(c).alias(c) for c in ("fr_acct_id", "to_acct_id")]
    return x.accounts.select("uid", *masked)


@_query
def amount_clipped(x: _Inputs) -> DataFrame:
    return x.accounts.select("uid", text.clip_amount("tran_amt").alias("tran_amt"))


@_query
def amount_clipped_keep_12(x: _Inputs) -> DataFrame:
    return x.accounts.select("uid", text.clip_amount("tran_amt", keep_exact_12=True).alias("tran_amt"))


@_query
def brace_quoted(x: _Inputs) -> DataFrame:
    return x.text.select("event_id", text.quote_before_braces("text").alias("text"))


@_query
def quoted_all(x: _Inputs) -> DataFrame:
    return x.text.select("event_id", F.array_join(text.extract_quoted_all("text"), "~").alias("quoted"))


@_query
def quoted_all_pages(x: _Inputs) -> DataFrame:
    return x.table("pages").select(
        "page_id", F.array_join(text.extract_quoted_all("html"), "~").alias("quoted")
    )


@_query
def quoted_first(x: _Inputs) -> DataFrame:
    return x.text.select("event_id", text.extract_quoted("text", "plain").alias("quoted"))


@_query
def quoted_styles(x: _Inputs) -> DataFrame:
    styles = [text.extract_quoted(s, s).alias(s) for s in text.QUOTE_PATTERNS]
    return x.escaped.select("page_id", *styles)


@_query
def row_json(x: _Inputs) -> DataFrame:
    user = F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id")
    return x.table("events").select("event_id", text.row_json("event_id", "event_type", user).alias("json"))


@_query
def pair_map(x: _Inputs) -> DataFrame:
    pair = text.pair_map("event_type", F.col("user_id").cast("string"))
    return x.table("events").select("event_id", F.to_json(pair).alias("pair"))


# --- journeys ------------------------------------------------------------------


@_query
def journey_flags(x: _Inputs) -> DataFrame:
    return journeys.journey_flags(x.journey)


@_query
def journeys_kept(x: _Inputs) -> DataFrame:
    return journeys.validate_journeys(x.journey)[0]


@_query
def journeys_removed(x: _Inputs) -> DataFrame:
    removed = journeys.validate_journeys(x.journey)[1]
    return removed.withColumn("reasons", F.array_join("reasons", ","))


@_query
def journeys_labelled(x: _Inputs) -> DataFrame:
    """All rows in one pass, kept ones without reasons."""
    return journeys.label_journeys(x.journey).withColumn("reasons", F.array_join("reasons", ","))


@_query
def journeys_removed_filtered(x: _Inputs) -> DataFrame:
    """Rows of journeys that break no rule go before the shuffle."""
    expected = journeys.broken_journeys(x.journey).count()
    return journeys.removed_journeys(x.journey, expected).withColumn("reasons", F.array_join("reasons", ","))


@_query
def journey_counts(x: _Inputs) -> DataFrame:
    """Kept, removed and broken rules, counted while the labelled rows are written."""
    counts = Observation("journeys")
    labelled = journeys.observe_journeys(journeys.label_journeys(x.journey), counts)
    labelled.write.parquet(tables.scratch_folder(x.spark, "journeys"))
    return x.spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in counts.get.items()])


# --- tables and files --------------------------------------------------------------


def _code_lines(x: _Inputs, columns: tuple[str, ...], third: int) -> DataFrame:
    """A third of the event codes as CSV lines; some are short, some have an open quote."""
    uid = F.col("uid").cast("long")
    whole = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in columns])
    line = F.when(uid % 97 == 0, F.col("uid")).when(uid % 101 == 0, F.concat(F.lit('"'), whole)).otherwise(whole)
    return x.event_codes.where(uid % 3 == third).select(line.alias(",".join(columns)))


def _code_files(x: _Inputs):
    """The event codes as CSV files of three column orders."""
    folder = tables.scratch_folder(x.spark, "codes")
    orders = ("uid,chnl_cd,evnt_cd,err_cd", "err_cd,evnt_cd,uid,chnl_cd", "EVNT_CD,chnl_cd,err_cd,UID")
    for third, order in enumerate(orders):
        lines = _code_lines(x, tuple(order.split(",")), third)
        # each line is one value that no quote or separator of this write occurs in
        lines.write.options(header=True, sep="\x01", quote="\x02", ignoreTrailingWhiteSpace=False).mode("append").csv(folder)
    return csv_files.read_csv_files(x.spark, folder, orders[0].split(","))


@_query
def csv_by_header(x: _Inputs) -> DataFrame:
    return _code_files(x).rows


@_query
def csv_no_rows(x: _Inputs) -> DataFrame:
    """The lines that are no rows."""
    return _code_files(x).bad.select("text", "reason")


def _new_table(x: _Inputs, name: str, df: DataFrame, **how) -> str:
    x.spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.write_table(df, name, path=tables.scratch_folder(x.spark, name), **how)
    return name


@_query
def table_days(x: _Inputs) -> DataFrame:
    """Main rows as a table; one day is written again without rows, one with its log-ins only."""
    name = _new_table(x, "tagloom_days", x.main)
    again = x.main.where("log_dte = DATE '2024-01-06' AND acn_cat_nme = 'LOGIN'")
    tables.write_table(again, name, days=["2024-01-05", "2024-01-06"])
    return tables.read_table(x.spark, name)


@_query
def latest_day_by_catalog(x: _Inputs) -> DataFrame:
    """The newest day of a table, from the catalog; the day after it is empty."""
    name = _new_table(x, "tagloom_latest", x.main)
    after = x.main.withColumn("log_dte", F.lit("2024-01-31").cast("date"))
    tables.write_table(after, name, days=["2024-01-31"])
    tables.write_table(after.where("uid IS NULL"), name, days=["2024-01-31"])
    return tables.read_newest(x.spark, name)


@_query
def main_enriched_bucketed(x: _Inputs) -> DataFrame:
    """Details and main rows in equal buckets of the request: the join moves no row."""
    main, rows = x.main, x.details
    names = [_new_table(x, f"tagloom_{n}", df, partition_by=None, buckets=(16, "uid")) for n, df in (("main", main), ("details", rows))]
    by = tables.shared_buckets(x.spark, *names)
    main, rows = (tables.read_table(x.spark, n) for n in names)
    wide = wide_details(rows, x.active_rules)
    return requests.enrich_main(wide, requests.normalise_main(main), by=REQUEST_DAY, colocated_by=by)


# --- the whole flow --------------------------------------------------------------


@_query
def audit_flow_query(x: _Inputs) -> DataFrame:
    return audit_flow(x.details, x.main, x.custlink, x.chnl_map, x.rules, x.event_map, x.err_map)


@_query
def event_amounts_query(x: _Inputs) -> DataFrame:
    return event_amounts(x.details, x.active_events)


@_query
def mapping_flow_query(x: _Inputs) -> DataFrame:
    return mapping_flow(x.main, x.custlink, x.event_codes, x.chnl_map, x.event_map, x.err_map)


@_query
def request_tags_query(x: _Inputs) -> DataFrame:
    return request_tags(x.details, x.event_config, x.channel)


for _name in ("event_amounts", "mapping_flow", "request_tags"):
    _QUERIES[_name] = _QUERIES.pop(f"{_name}_query")
_QUERIES["audit_flow"] = _QUERIES.pop("audit_flow_query")


def _run(fn: Callable[[_Inputs], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn(_Inputs(spark, sf_dir))


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators and their pipeline; nothing where those files, or libraries that
    they need, are absent."""
    try:
        import corpus_pipeline
        from tagloom.llm.oracle import SQL
        from tagloom.llm.queries import QUERIES
    except ImportError as missing:
        print(f"training-data queries left out: {missing}", file=sys.stderr)
        return {}, {}
    made, texts = QUERIES | {"pipeline": corpus_pipeline.run}, dict(SQL)
    if corpus_pipeline.ORACLE_SQL:
        texts["pipeline"] = corpus_pipeline.ORACLE_SQL
    return made, texts


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The audit operators alone."""
    return {name: partial(_run, fn) for name, fn in _QUERIES.items()}


def entry(spark: SparkSession) -> DataFrame:
    """The whole audit flow on the smallest data."""
    return queries()["audit_flow"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries() | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL with the same result, by query name."""
    return oracle.build() | _training_data()[1]
