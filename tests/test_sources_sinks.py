"""Parsers (with quarantine), Kafka shaping, sinks with in-process fake clients."""

import json

from pyspark.sql import functions as F

from tidepool.functions.text import normalize_int, tokenize, tokenize_jvm
from tidepool.sinks.writers import (document_records, hash_upsert, latest_per_key, merge_upsert,
                                    route_write)
from tidepool.sources.kafka import kafka_records, kafka_sink_options, kafka_source_options
from tidepool.sources.parse import (parse_access_log, parse_delimited, parse_pay_result,
                                    split_valid)


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_parse_delimited_quarantines_malformed(spark):
    df = _lines(spark, ["sensor_1,1547718199,35.8", "sensor_7, 1547718202,6.72",
                        "sensor_6,1547718201x,15.4A", "short,1"])
    good, bad = split_valid(parse_delimited(df, "sensor"))
    assert sorted((r.id, r.time) for r in good.collect()) == [("sensor_1", 1547718199),
                                                              ("sensor_7", 1547718202)]
    assert bad.count() == 2


def test_tab_parse_keeps_spaces(spark):
    df = _lines(spark, ["d\t k \tip\t12\tid\tu"])
    good, _ = split_valid(parse_delimited(df, "client_log", sep="\t", trim=False))
    assert good.collect()[0].logkey == " k "


def test_access_log(spark):
    df = _lines(spark, ["83.149.9.216 u1 - 17/05/2015:10:05:03 +0000 GET /presentations/x"])
    r = parse_access_log(df).collect()[0]
    assert (r.ip, r.user_id, r.method, r.url) == ("83.149.9.216", "u1", "GET", "/presentations/x")
    assert r.event_time.strftime("%Y-%m-%d %H:%M:%S") == "2015-05-17 10:05:03"


def test_pay_result_defaults_and_stable_id(spark):
    line = json.dumps({"serviceName": "recharge", "bussinessRst": "0000", "chargefee": 5.5,
                       "requestId": "r1", "receiveNotifyTime": "20170412030031"})
    df = _lines(spark, [line, line])
    rows = parse_pay_result(df).collect()
    assert rows[0].provinceCode == 0 and rows[0].chargefee == 5.5
    assert rows[0].id == rows[1].id


def test_tokenize_variants(spark):
    df = _lines(spark, ["hello  spark hadoop  ", "   "])
    assert sorted(r.word for r in tokenize(df, "value").collect()) == ["hadoop", "hello", "spark"]
    # JVM-style split: interior empty kept, trailing empties dropped, blank line -> nothing
    assert [r.word for r in tokenize_jvm(df, "value").collect()] == ["hello", "", "spark", "hadoop"]


def test_normalize_int(spark):
    df = _lines(spark, ["007", " 42 ", "x1"])
    assert [r.n for r in df.select(normalize_int("value").alias("n")).collect()] == ["7", "42", None]


def test_kafka_shapes(spark):
    assert kafka_source_options("t", "b:9092", "latest", "read_committed")[
        "kafka.isolation.level"] == "read_committed"
    assert kafka_sink_options("t", "b:9092") == {"kafka.bootstrap.servers": "b:9092", "topic": "t"}
    df = spark.createDataFrame([(1, "a"), (1, "a")], "k long, value string")
    recs = kafka_records(df, dedup_cols=["k", "value"]).collect()
    assert recs[0].key == recs[1].key and recs[0].value == "a"


def test_hash_upsert_last_value_wins(spark, tmp_path):
    out = str(tmp_path / "hset.log")

    class FileHash:  # defined here so executors receive it by value
        def __init__(self):
            self.f = open(out, "a")

        def hset(self, name, field, value):
            self.f.write(f"{name}\t{field}\t{value}\n")

        def close(self):
            self.f.close()

    df = spark.createDataFrame([("s1", 1, 10.0), ("s1", 2, 11.0), ("s2", 1, 5.0)],
                               "id string, t long, temp double")
    hash_upsert(df, "sensor", "id", "temp", F.col("t"), FileHash)
    got = {}
    for line in open(out):
        name, field, value = line.rstrip("\n").split("\t")
        got[(name, field)] = value
    assert got == {("sensor", "s1"): "11.0", ("sensor", "s2"): "5.0"}


def test_merge_upsert(spark):
    tgt = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    upd = latest_per_key(spark.createDataFrame([(2, 1, 20.0), (2, 2, 21.0), (3, 1, 3.0)],
                                               "k long, t long, v double"), ["k"], ["v"], F.col("t"))
    r = {x.k: (x.v, x.op) for x in merge_upsert(tgt, upd, "k", ["v"]).collect()}
    assert r == {1: (1.0, "keep"), 2: (21.0, "update"), 3: (3.0, "insert")}


def test_documents_and_routing(spark, tmp_path):
    df = spark.createDataFrame([(1, "sensor_1", 35.8, "high"), (2, "sensor_6", 15.4, "low")],
                               "rid long, id string, temperature double, tag string")
    docs = document_records(df, "sensor", {"id": F.col("id"), "temperature": F.col("temperature")},
                            ["rid"]).collect()
    assert json.loads(docs[0].doc) == {"id": "sensor_1", "temperature": "35.8"}
    assert len({d.doc_id for d in docs}) == 2
    out = {}
    route_write(df, "tag", {t: (lambda d, t=t: out.__setitem__(t, d.count())) for t in ("high", "low")})
    assert out == {"high": 1, "low": 1}


def test_strict_parsing_fails_the_job(spark):
    import pytest

    good = _lines(spark, ["s1,5,1.5"])
    assert parse_delimited(good, "sensor", strict=True).collect()[0].time == 5
    for bad, said in (("s1,x,1.5", "CAST_INVALID_INPUT"), ("s1,5", "no field temperature")):
        with pytest.raises(Exception, match=said):
            parse_delimited(_lines(spark, [bad]), "sensor", strict=True).collect()


def test_unfiltered_words_as_the_jvm_splits_them(spark):
    df = _lines(spark, [" a  b ", "", " \t", "c", "d\n"])
    assert sorted(r.word for r in tokenize(df, "value", drop_empty=False).collect()) == ["", "", "a", "b", "c", "d"]


def test_rendered_times(spark):
    from tidepool.functions.timecols import next_midnight, render_ms

    df = spark.createDataFrame([(1511658000000,), (1511658000120,), (1511658000007,), (-1,)], "ms long")
    got = [r[0] for r in df.select(render_ms("ms")).collect()]
    assert got == ["2017-11-26 01:00:00.0", "2017-11-26 01:00:00.12", "2017-11-26 01:00:00.007", "1969-12-31 23:59:59.999"]
    at = df.select(F.unix_millis(next_midnight(F.timestamp_millis("ms"))).alias("m")).first().m
    assert at == 1511740800000
