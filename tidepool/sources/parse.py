"""Record parsers (PRJ-1..4): text lines -> typed columns, with quarantine.

Malformed fields become NULL through ``try_cast``; ``split_valid`` separates
rows whose required fields all parsed from the quarantine rows (D-14), so one
bad line never fails a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.timecols import parse_log_time

# Fixed record schemas of the behaviour-analytics jobs (Spark DDL).
SCHEMAS = {
    "user_behavior": "userId bigint, itemId bigint, categoryId int, behavior string, timestamp bigint",
    "login": "userId bigint, ip string, eventType string, eventTime bigint",
    "order": "orderId bigint, eventType string, txId string, eventTime bigint",
    "receipt": "txId string, payChannel string, eventTime bigint",
    "ad_click": "userId bigint, adId bigint, province string, city string, timestamp bigint",
    "sensor": "id string, time bigint, temperature double",
    "client_log": "dt string, logkey string, clientip string, time bigint, logid string, userid string",
}

PAY_RESULT = T.StructType([
    T.StructField("serviceName", T.StringType()),
    T.StructField("bussinessRst", T.StringType()),
    T.StructField("chargefee", T.DoubleType()),
    T.StructField("requestId", T.StringType()),
    T.StructField("receiveNotifyTime", T.StringType()),
    T.StructField("provinceCode", T.IntegerType()),
])


def _schema(schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(SCHEMAS.get(schema, schema))


def _escape(sep: str) -> str:
    return "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep


def parse_delimited(df: DataFrame, schema, sep: str = ",", text_col: str = "value",
                    trim: bool = True, keep_raw: bool = True, strict: bool = False) -> DataFrame:
    """PRJ-1 / PRJ-2: split ``text_col`` on ``sep``, trim (optional), try-cast.

    ``strict`` (FN-3): a field that is missing or doesn't parse is an error
    that fails the job. Otherwise it is NULL.
    Adds ``_ok`` (all fields present and parsed) and keeps the raw line as
    ``_raw`` for the quarantine output.
    """
    st = _schema(schema)
    parts = F.split(F.col(text_col), _escape(sep))
    cols, oks = [], []
    for i, f in enumerate(st.fields):
        raw = F.get(parts, i)
        raw = F.trim(raw) if trim else raw
        if strict:
            raw = F.coalesce(raw, F.raise_error(F.concat(F.lit(f"no field {f.name} in: "), F.col(text_col))))
        val = raw if isinstance(f.dataType, T.StringType) else raw.cast(f.dataType) if strict else raw.try_cast(f.dataType)
        cols.append(val.alias(f.name))
        oks.append(val.isNotNull())
    ok = F.size(parts) >= len(st.fields)
    for o in oks:
        ok = ok & o
    out = df.select(*cols, ok.alias("_ok"), *([F.col(text_col).alias("_raw")] if keep_raw else []))
    return out


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without helper columns, quarantined raw lines)."""
    good = parsed.where(F.col("_ok")).drop("_ok", "_raw")
    bad = parsed.where(~F.col("_ok")).select(F.col("_raw").alias("value"))
    return good, bad


def parse_access_log(df: DataFrame, text_col: str = "value") -> DataFrame:
    """PRJ-3: space separated access log; fields 0,1,3,5,6 = ip,user,time,method,url."""
    p = F.split(F.col(text_col), " ")
    return df.select(F.get(p, 0).alias("ip"), F.get(p, 1).alias("user_id"),
                     parse_log_time(F.get(p, 3)).alias("event_time"),
                     F.get(p, 5).alias("method"), F.get(p, 6).alias("url"))


def parse_pay_result(df: DataFrame, text_col: str = "value", id_mode: str = "hash") -> DataFrame:
    """PRJ-4: one JSON object per line -> PayResult columns plus an ``id``.

    A missing ``provinceCode`` reads as 0 (the JSON getter default the jobs
    rely on). ``id_mode='hash'`` gives a replay-stable id (sha2 of the line);
    ``'uuid'`` a random one.
    """
    js = F.from_json(F.col(text_col), PAY_RESULT)
    rid = F.sha2(F.col(text_col), 256) if id_mode == "hash" else F.expr("uuid()")
    return df.select(rid.alias("id"), js["serviceName"].alias("serviceName"),
                     js["bussinessRst"].alias("bussinessRst"), js["chargefee"].alias("chargefee"),
                     js["requestId"].alias("requestId"),
                     js["receiveNotifyTime"].alias("receiveNotifyTime"),
                     F.coalesce(js["provinceCode"], F.lit(0)).alias("provinceCode"))


def epoch_col(col, unit: str = "s") -> Column:
    """Epoch number (s or ms) -> TIMESTAMP."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_seconds(c) if unit == "s" else F.timestamp_millis(c)
