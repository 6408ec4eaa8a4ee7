import json

import pytest
from pyspark.errors import PySparkException

from clickflow import functions as C
from clickflow.operators import envelope, widen
from clickflow.sources.files import given_clicks

CLICK = {"channelID": 3, "userID": "u1", "country": "china", "city": "LuoYang", "extra": [1]}


def wrap(message, **fields):
    return json.dumps({"count": 1, "message": message, "timeStamp": 1704067200000, **fields})


GOOD = {
    "plain": wrap(json.dumps(CLICK)),
    "count as text": wrap(json.dumps(CLICK), count="5"),
    "time as text": wrap(json.dumps(CLICK), timeStamp="1704067200000"),
    "more fields": wrap(json.dumps(CLICK), other={"a": 1}),
    "single quotes": "{'count':1,'message':'{}','timeStamp':7}",
    "plain names": '{count:1,message:"{}",timeStamp:7}',
    "a time with a fraction": wrap("{}", timeStamp=1704067200000.5),
}
BAD = {
    "": "envelope is not a JSON object",
    "nonsense": "envelope is not a JSON object",
    "[1]": "envelope is not a JSON object",
    "null": "envelope is not a JSON object",
    wrap("nonsense"): "message is not a JSON object",
    wrap("null"): "message is not a JSON object",
    wrap("[{}]"): "message is not a JSON object",
    wrap(None): "message is missing",
    json.dumps({"count": 1, "timeStamp": 1}): "message is missing",
    json.dumps({"message": "{}", "timeStamp": 1}): "count is missing or no number",
    wrap("{}", count="many"): "count is missing or no number",
    json.dumps({"count": 1, "message": "{}"}): "timeStamp is missing or no number",
    wrap("{}", timeStamp=9223372036854775807): "timeStamp is out of range",
}


def test_good_and_bad_are_told_apart(spark):
    texts = list(GOOD.values()) + list(BAD)
    messages = envelope.parse_messages(given_clicks(spark, texts))
    good = {r.seq for r in envelope.good_messages(messages).collect()}
    bad = {r.raw: r.badReason for r in envelope.bad_messages(messages).collect()}
    assert good == set(range(len(GOOD)))
    assert bad == BAD


def test_missing_text_is_bad(spark):
    raw = spark.createDataFrame([(None, 1)], "value string, seq bigint")
    assert envelope.bad_messages(envelope.parse_messages(raw)).count() == 1


def test_click_fields_become_text(spark):
    messages = envelope.parse_messages(given_clicks(spark, [GOOD["count as text"]]))
    row = envelope.flatten_messages(messages).first()
    assert (row.channelID, row.userID, row.province, row["count"]) == ("3", "u1", None, 5)
    assert widen.with_address(envelope.flatten_messages(messages)).first().address == \
        "chinanullLuoYang"


def test_failfast_stops(spark):
    fine = envelope.parse_messages(given_clicks(spark, list(GOOD.values())), mode="failfast")
    assert fine.count() == len(GOOD)
    broken = envelope.parse_messages(given_clicks(spark, ["nonsense"]), mode="failfast")
    with pytest.raises(PySparkException, match="not a JSON object"):
        envelope.flatten_messages(broken).collect()
    with pytest.raises(ValueError):
        envelope.parse_messages(given_clicks(spark, []), mode="skip")


def test_envelope_round_trip(spark):
    bodies = [json.dumps(CLICK), 'odd "quotes" \\ and 文字']
    sent = envelope.build_envelopes(
        spark.createDataFrame([(b, 5, i) for i, b in enumerate(bodies)],
                              "body string, at bigint, seq bigint"),
        "body", "at", keep=("seq",))
    back = envelope.parse_envelopes(sent, keep=("seq",)).orderBy("seq").collect()
    assert [(r.message, r["count"], r.timeStamp) for r in back] == [(b, 1, 5) for b in bodies]
    now = envelope.build_envelopes(sent.withColumnRenamed("value", "body"), "body")
    assert envelope.parse_envelopes(now).first().timeStamp > 1700000000000


def test_each_record_is_parsed_once(spark):
    messages = envelope.parse_messages(given_clicks(spark, [GOOD["plain"]]))
    flat = envelope.flatten_messages(envelope.good_messages(messages))
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 2


def test_blank_counts_every_kind_of_white_space(spark):
    values = [None, "", " ", "\t\n", "\x1f", "\u3000 \u2003", "\u00a0", "a", " a "]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(C.is_blank("v")).collect()] == [True] * 6 + [False] * 3


def test_to_long(spark):
    values = {"5": 5, " 5 ": 5, "5.9": 5, "-7": -7, "1.5E3": 1500, "x": None, "": None, None: None}
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(C.to_long("v")).collect()] == list(values.values())
