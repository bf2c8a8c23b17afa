import json

import pytest
from pyspark.sql import functions as F

from helpers import messages, plan, power, rows
from tidemark.operators import reserve_alerts
from tidemark.schemas import POWER_SCHEMA, WEATHER_SCHEMA
from tidemark.sources import decode, decode_once, decode_with_corrupt, encode, quarantine_split

T = "202511221200"
FULL = f'{{"base_datetime":"{T}","rainfall_type":0,"rainfall_mm":0.0,"temperature_c":12.5}}'
NOTHING = (None, None, None, None)

CASES = [
    (FULL, (T, 0, 0.0, 12.5)),
    (f'{{"base_datetime":"{T}"}}', (T, None, None, None)),
    ("not json", NOTHING),
    (FULL[:40], NOTHING),
    (f"[{FULL}]", NOTHING),
    ("", NOTHING),
    (None, NOTHING),
    (f'{{"base_datetime":{T}}}', (T, None, None, None)),
    (f'{{"base_datetime":"{T}","rainfall_type":1.0,"rainfall_mm":2.5}}', (T, None, 2.5, None)),
    (f'{{"base_datetime":"{T}","rainfall_type":"a"}}', (T, None, None, None)),
    (f'{{"base_datetime":"{T}","rainfall_type":99999999999}}', (T, None, None, None)),
    (f'{{"base_datetime":"{T}","temperature_c":"12.3"}}', (T, None, None, None)),
    (f'{{"base_datetime":"{T}","temperature_c":"NaN"}}', (T, None, None, "NaN")),
    (f'{{"base_datetime":"{T}","extra":[1]}}', (T, None, None, None)),
    (f'{{"Base_Datetime":"{T}","rainfall_type":3}}', (None, 3, None, None)),
    (FULL + FULL.replace("12.5", "99"), (T, 0, 0.0, 12.5)),
]


@pytest.mark.parametrize("decoder", [decode, decode_once])
@pytest.mark.parametrize("text,expected", CASES)
def test_decode(spark, decoder, text, expected):
    assert rows(decoder(messages(spark, text), WEATHER_SCHEMA)) == [expected]


def test_decoders_declare_the_schema(spark):
    for decoder in (decode, decode_once):
        found = decoder(messages(spark, FULL), WEATHER_SCHEMA).schema
        assert found.names == WEATHER_SCHEMA.names
        assert [f.dataType for f in found] == [f.dataType for f in WEATHER_SCHEMA]


def test_quarantine_splits_without_loss(spark):
    texts = [case for case, _ in CASES]
    decoded = decode_with_corrupt(messages(spark, *texts), WEATHER_SCHEMA)
    good, bad = quarantine_split(decoded)
    assert good.columns == WEATHER_SCHEMA.names
    kept = [r[0] for r in bad.collect()]
    assert good.count() + len(kept) == len(texts)
    assert {"not json", FULL[:40], f"[{FULL}]"} <= set(kept)
    assert FULL not in kept


def test_encode_decode_round_trip(spark):
    readings = power(spark, ("20240101003000", 61234.5, 5400.25), (None, None, 1.5), ("x", -0.0, None))
    assert rows(decode(encode(readings), POWER_SCHEMA)) == rows(readings)


def test_encode_writes_missing_fields_as_null(spark):
    value = encode(power(spark, ("20240101003000", None, 5400.5))).collect()[0].value
    assert json.loads(bytes(value)) == {
        "base_datetime": "20240101003000",
        "current_demand_mw": None,
        "reserve_power_mw": 5400.5,
    }


def test_encode_with_key(spark):
    encoded = encode(power(spark, ("a", 1.0, 2.0)), ["base_datetime"], key=F.lit("north"))
    assert [(bytes(r.key), bytes(r.value)) for r in encoded.collect()] == [
        (b"north", b'{"base_datetime":"a"}')
    ]


def test_filtered_decode_parses_once(spark):
    # A frame read from a file: a literal one would be folded away.
    source = messages(spark, FULL).repartition(2)
    text = plan(reserve_alerts(decode_once(source, POWER_SCHEMA)), "simple")
    assert text.count("from_json(") == 1
