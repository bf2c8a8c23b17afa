import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from tidemark.schemas import POWER_SCHEMA, WEATHER_SCHEMA
from tidemark.sources import (
    accepted,
    observation_items,
    parse_power,
    parse_weather,
    pivot_observations,
    reject_report,
    rejected,
)

AT = dt.datetime(2025, 1, 1, 0, 10)
SLOT = "202501010000"
TIME = "20250101001000"


def responses(spark, *payloads):
    return spark.createDataFrame(
        [(i, AT, p) for i, p in enumerate(payloads)],
        "id int, fetched_at timestamp, payload string",
    ).repartition(2)


def xml(items, code="<resultCode>00</resultCode>", message="<resultMsg>OK</resultMsg>"):
    return (
        f"<response><header>{code}{message}</header>"
        f"<body><items>{items}</items></body></response>"
    )


def item(demand="<currPwrTot>60000.5</currPwrTot>", reserve="<suppReservePwr>5400</suppReservePwr>"):
    return f"<item><baseDatetime>{TIME}</baseDatetime>{demand}{reserve}</item>"


POWER_ACCEPTED = [
    (xml(item()), (TIME, 60000.5, 5400.0)),
    ("<?xml version='1.0' encoding='UTF-8'?>" + xml(item()), (TIME, 60000.5, 5400.0)),
    (xml(item(reserve="<suppReservePwr></suppReservePwr>")), (TIME, 60000.5, 0.0)),
    (xml(item(reserve="<suppReservePwr/>")), (TIME, 60000.5, 0.0)),
    (xml(item(reserve="")), (TIME, 60000.5, 0.0)),
    (xml(item(demand="<currPwrTot> 7 </currPwrTot>")), (TIME, 7.0, 5400.0)),
    (xml(item(demand="<currPwrTot unit='MW'>7</currPwrTot>")), (TIME, 7.0, 5400.0)),
    (xml(item() + "<item><baseDatetime>x</baseDatetime></item>"), (TIME, 60000.5, 5400.0)),
    (xml("<item><currPwrTot>1</currPwrTot></item>"), (None, 1.0, 0.0)),
    (xml("<item/>"), (None, 0.0, 0.0)),
    (f"<r><resultCode>00</resultCode>{item()}</r>", (TIME, 60000.5, 5400.0)),
    (f"<r><resultCode>00</resultCode><items>{item()}</items></r>", (TIME, 60000.5, 5400.0)),
    (f"<r><body><resultCode>00</resultCode>{item()}</body></r>", (TIME, 60000.5, 5400.0)),
    (xml(item(), code="<resultCode>00</resultCode><resultCode>30</resultCode>"), (TIME, 60000.5, 5400.0)),
]

POWER_REJECTED = [
    (xml(item(), code="<resultCode>30</resultCode>"), ("api_error", "30", "OK")),
    (xml(item(), code=""), ("api_error", None, "OK")),
    (xml(item(), code="<resultCode> 00 </resultCode>"), ("api_error", " 00 ", "OK")),
    ("<html><body>busy</body></html>", ("api_error", None, None)),
    (xml(""), ("no_item", None, None)),
    (xml(item(demand="<currPwrTot>n/a</currPwrTot>")), ("bad_value", None, None)),
    (xml(item(demand="<currPwrTot>  </currPwrTot>")), ("bad_value", None, None)),
    (xml(item(demand="<currPwrTot>1.5d</currPwrTot>")), ("bad_value", None, None)),
    (xml(item())[:60], ("malformed", None, None)),
    ("not xml", ("malformed", None, None)),
    ("", ("malformed", None, None)),
    (None, ("malformed", None, None)),
]


def test_power_readings(spark):
    parsed = accepted(parse_power(responses(spark, *[p for p, _ in POWER_ACCEPTED])))
    found = rows(parsed.select("id", *POWER_SCHEMA.names))
    assert found == sorted([(i, *e) for i, (_, e) in enumerate(POWER_ACCEPTED)], key=repr)
    kinds = {f.name: f.dataType for f in parsed.schema}
    assert all(kinds[f.name] == f.dataType for f in POWER_SCHEMA)


def test_power_rejects(spark):
    parsed = parse_power(responses(spark, *[p for p, _ in POWER_REJECTED]))
    assert accepted(parsed).count() == 0
    found = rows(rejected(parsed, "id").drop("excerpt", "payload"))
    assert found == sorted([(i, *e) for i, (_, e) in enumerate(POWER_REJECTED)], key=repr)


def test_rejected_payloads_stay_whole(spark):
    long = ["<html>" + str(i) + "x" * 300 for i in range(3)] + [xml(""), xml(item(demand="<currPwrTot>n/a</currPwrTot>"))]
    kept = rejected(parse_power(responses(spark, *long)), "id", "fetched_at").select("id", "payload")
    assert rows(kept) == list(enumerate(long))
    assert "payload" not in accepted(parse_power(responses(spark, xml(item())))).columns


def test_blank_power_as_null(spark):
    blank = xml(item(reserve="<suppReservePwr></suppReservePwr>"))
    parsed = accepted(parse_power(responses(spark, blank), blank_as_null=True))
    assert rows(parsed.select(*POWER_SCHEMA.names)) == [(TIME, 60000.5, None)]


def test_excerpt_of_unreadable_payload_only(spark):
    long = "x" * 300
    parsed = parse_power(responses(spark, long, xml("")))
    assert rows(rejected(parsed, "id").select("id", "excerpt")) == [(0, "x" * 200), (1, None)]


def seen(*observations):
    listed = ",".join(observations)
    return (
        '{"response":{"header":{"resultCode":"00","resultMsg":"OK"},'
        f'"body":{{"items":{{"item":[{listed}]}}}}}}}}'
    )


def obs(category, value):
    return f'{{"category":"{category}","obsrValue":{value}}}'


T1H, RN1, PTY = obs("T1H", '"12.3"'), obs("RN1", '"2.5"'), obs("PTY", '"1"')

WEATHER_ACCEPTED = [
    (seen(T1H, RN1, PTY), (1, 2.5, 12.3)),
    (seen(T1H, obs("RN1", '"강수없음"'), obs("PTY", '"0"')), (0, 0.0, 12.3)),
    (seen(obs("REH", '"x"'), T1H), (None, None, 12.3)),
    (seen(obs("T1H", '"1"'), T1H), (None, None, 12.3)),
    (seen(obs("T1H", "12.3"), obs("PTY", "3")), (3, None, 12.3)),
    (seen(obs("PTY", '"99999999999"')), (None, None, None)),
    (seen(), (None, None, None)),
    ('{"response":{"body":{"items":{"other":1}}}}', (None, None, None)),
    (seen('{"obsrValue":"1"}', T1H), (None, None, 12.3)),
]

WEATHER_REJECTED = [
    (seen(T1H, obs("RN1", '"1mm 미만"')), ("bad_value", None, None)),
    (seen(T1H, obs("PTY", '"0.5"')), ("bad_value", None, None)),
    (seen(obs("T1H", '"?"'), T1H), ("bad_value", None, None)),
    (seen(obs("T1H", "null")), ("bad_value", None, None)),
    (seen('{"category":"T1H"}'), ("bad_value", None, None)),
    (seen(T1H, "null"), ("bad_value", None, None)),
    (seen(T1H, '"text"'), ("bad_value", None, None)),
    ('{"response":{"body":{"items":{"item":null}}}}', ("bad_value", None, None)),
    ('{"response":{"body":{"items":{"item":' + T1H + "}}}}", ("bad_value", None, None)),
    (
        '{"response":{"header":{"resultCode":"03","resultMsg":"NO DATA"},"body":{"items":""}}}',
        ("api_error", "03", "NO DATA"),
    ),
    ('{"response":{"header":{"resultCode":"30","resultMsg":"KEY"}}}', ("api_error", "30", "KEY")),
    (
        '{"response":{"header":{"resultCode":"00"},"body":{"items":{}}}}',
        ("api_error", "00", None),
    ),
    ('{"response":{"body":{"items":""}}}', ("unknown_structure", None, None)),
    ('{"other":1}', ("unknown_structure", None, None)),
    ("<html>", ("malformed", None, None)),
    (seen(T1H)[:70], ("malformed", None, None)),
    ("[]", ("malformed", None, None)),
    ("", ("malformed", None, None)),
    (None, ("malformed", None, None)),
]


def rounded(frame):
    return [
        tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in rows(frame)
    ]


def test_weather_readings(spark):
    parsed = accepted(parse_weather(responses(spark, *[p for p, _ in WEATHER_ACCEPTED])))
    found = rounded(parsed.select("id", *WEATHER_SCHEMA.names))
    expected = [(i, SLOT, *e) for i, (_, e) in enumerate(WEATHER_ACCEPTED)]
    assert found == sorted(expected, key=repr)
    kinds = {f.name: f.dataType for f in parsed.schema}
    assert all(kinds[f.name] == f.dataType for f in WEATHER_SCHEMA)


def test_weather_rejects(spark):
    parsed = parse_weather(responses(spark, *[p for p, _ in WEATHER_REJECTED]))
    assert accepted(parsed).count() == 0
    found = rows(rejected(parsed, "id").drop("excerpt", "payload"))
    assert found == sorted([(i, *e) for i, (_, e) in enumerate(WEATHER_REJECTED)], key=repr)


def test_pivot_agrees_with_lists(spark):
    cases = [p for p, _ in WEATHER_ACCEPTED + WEATHER_REJECTED]
    by_list = accepted(parse_weather(responses(spark, *cases)))
    measures = ["rainfall_type", "rainfall_mm", "temperature_c"]
    items = observation_items(responses(spark, *cases), "id").repartition(5, "category")
    assert rows(pivot_observations(items, "id").select("id", *measures)) == rows(
        by_list.select("id", *measures)
    )


def test_reject_report_counts(spark):
    parsed = parse_power(
        responses(spark, "a", "b", xml("", code="<resultCode>30</resultCode>"), xml(item()))
    ).withColumn("feed", F.lit("power"))
    assert rows(reject_report(parsed, "feed")) == sorted(
        [("power", "malformed", None, None, "a", 2), ("power", "api_error", "30", "OK", None, 1)],
        key=repr,
    )


def test_each_payload_is_parsed_once(spark):
    """Apart from weather responses without a list, which are looked at again."""
    power = plan(accepted(parse_power(responses(spark, xml(item())))), "simple")
    weather = plan(accepted(parse_weather(responses(spark, seen(T1H)))), "simple")
    assert power.count("from_xml(") == 1
    assert "Python" not in power + weather
    # The list itself, the loose parse, and the list in the loose parse.
    assert weather.count("from_json(") == 3
