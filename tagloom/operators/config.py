"""Configuration tables: channel, rules, journey tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.fields import CHANNEL
from tagloom.functions.text import norm


def active_channel_key(chnl_map: DataFrame, code: str = CHANNEL) -> DataFrame:
    """Key of the active channel `code`: one row, or none if there is no such channel.

    Two different active keys for one code end the query with an error.
    """
    low, high = F.min("chnl_key"), F.max("chnl_key")
    return (
        chnl_map.filter((F.col("active") == 1) & (F.col("chnl_cd") == code))
        .agg(
            F.when(low != high, F.raise_error(f"several active channels with code {code}"))
            .otherwise(low)
            .alias("chnl_key")
        )
        .filter(F.col("chnl_key").isNotNull())
    )


def active_for_channel(config: DataFrame, chnl: DataFrame) -> DataFrame:
    """Active rows of a configuration table that belong to the channel of `chnl`."""
    return config.filter(F.col("active") == 1).join(chnl.select("chnl_key"), "chnl_key", "left_semi")


def normalise_rules(rule_config: DataFrame, chnl: DataFrame) -> DataFrame:
    """Active rules of the channel, names and conditions in comparison form."""
    return active_for_channel(rule_config, chnl).select(
        norm("filter_col1").alias("filter_col1"),
        norm("filter_condn1").alias("filter_condn1"),
        norm("filter_col2").alias("filter_col2"),
        norm("filter_condn2").alias("filter_condn2"),
        F.col("val_col").alias("value_col"),
        norm("new_trans_col").alias("new_col"),
    )


def journey_tag_rows(journey_config: DataFrame, chnl: DataFrame) -> DataFrame:
    """The distinct tags of each event code, one row per tag."""
    return (
        active_for_channel(journey_config, chnl)
        .select("evnt_cd", F.explode(F.split("cmpx_jrny_tag", ",")).alias("tag"))
        .select("evnt_cd", norm("tag").alias("tag"))
        .filter(F.col("tag") != "")
        .distinct()
    )


def journey_tags(journey_config: DataFrame, chnl: DataFrame) -> DataFrame:
    """Per event code the sorted list of its distinct tags.

    The list is as long as the configuration of one event, not as the data.
    """
    return (
        journey_tag_rows(journey_config, chnl)
        .groupBy("evnt_cd")
        .agg(F.sort_array(F.collect_list("tag")).alias("cmpx_jrny_tag_vec"))
    )
