"""Declared schemas of the input tables and a check against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DateType()

SCHEMAS: dict[str, T.StructType] = {
    "audit_details": _schema(
        uid=_S, log_dte=_D, acn_cat_nme=_S, tagname=_S, tagvalue=_S, mmb_num=_S,
        ses_idr=_S, log_tme=_S, acn_nme=_S, log_millisec=_S, msg_typ=_S,
    ),
    "audit_main": _schema(
        uid=_S, log_dte=_D, mmb_num=_S, cus_idr=_S, err_msg_txt=_S, acn_cat_nme=_S,
    ),
    "cust_link": _schema(
        mmb_lnk_mmb_num=_S, cus_idr=_S, mmb_lnk_sts=_S, mmb_lnk_fls_type=_S,
        mmb_lnk_end_dte=_S, eff_start_date=_S, active=_S,
    ),
    "chnl_map": _schema(active=_I, chnl_cd=_S, chnl_key=_I),
    "rule_config": _schema(
        active=_I, chnl_key=_I, filter_col1=_S, filter_condn1=_S, filter_col2=_S,
        filter_condn2=_S, val_col=_S, new_trans_col=_S,
    ),
    "journey_config": _schema(active=_I, chnl_key=_I, evnt_cd=_S, cmpx_jrny_tag=_S),
    "event_attr_config": _schema(evnt_cd=_S, trgt_col_nm=_S, tag_nm=_S),
    "event_map": _schema(active=_I, event_cd=_S, event_key=_I),
    "err_map": _schema(err_cd=_S, err_key=_I),
    "event_detail": _schema(chnl_cd=_S, evnt_cd=_S, err_cd=_S),
    "journeys": _schema(
        journey_id=T.LongType(), evnt_ed=_S, flow_num=_I, IncompleteMap=_S,
        emplx_jrny_attrb=_S, operator=_S,
    ),
}


# What grouping and filtering go by: a value of these that does not fit never becomes null.
STRICT = ("uid", "log_dte", "chnl_key", "event_key", "err_key", "journey_id")


def conform(df: DataFrame, entity: str, null_bad: bool = False) -> DataFrame:
    """Check that `df` holds the columns of `entity` and give them their declared types.

    A missing column raises.  Further columns are kept as they are.  A value that does
    not fit its declared type ends the query with its column and text; with `null_bad`
    it becomes null instead, but never in a key or a date column (`STRICT`).
    """
    schema = SCHEMAS[entity]
    have = {name.lower() for name in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in have]
    if missing:
        raise ValueError(f"{entity}: missing columns {', '.join(missing)}")
    declared = {f.name.lower() for f in schema}
    given = {f.name.lower(): f for f in df.schema}
    columns = [_typed_column(entity, f, given[f.name.lower()], null_bad) for f in schema]
    return df.select(*columns, *[c for c in df.columns if c.lower() not in declared])


def _typed_column(entity: str, field: T.StructField | None, given: T.StructField, null_bad: bool) -> Column:
    value = F.col(given.name)
    if field is None or given.dataType == field.dataType:
        return value.alias(field.name if field else given.name)
    cast = value.try_cast(field.dataType)
    if null_bad and field.name not in STRICT:
        return cast.alias(field.name)
    what = F.concat(F.lit(f"{entity}.{field.name}: not a {field.dataType.simpleString()}: "), value.cast("string"))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(what)).otherwise(cast).alias(field.name)


def typed(df: DataFrame, entity: str) -> DataFrame:
    """`df` with the declared types in those declared columns that it has; nothing happens where they fit already."""
    have = {f.name.lower(): f for f in df.schema}
    there = [f for f in SCHEMAS[entity] if f.name.lower() in have]
    if all(have[f.name.lower()].dataType == f.dataType for f in there):
        return df
    return df.select(*[_typed_column(entity, next((f for f in there if f.name.lower() == n), None), have[n], False) for n in have])


# The columns that name a request where details are grouped by it rather than by its id alone.
REQUEST_COLUMNS = (
    "uid", "mmb_num", "ses_idr", "log_tme", "acn_nme", "log_millisec", "acn_cat_nme", "msg_typ", "log_dte",
)
