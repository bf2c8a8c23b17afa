"""Both parsers against plain rules on the documents that xml.etree and json give."""

import datetime as dt
import json
import math
import random
import struct
import xml.etree.ElementTree as ET

from helpers import rows
from tidemark.sources import parse_power, parse_weather

AT = dt.datetime(2025, 1, 1, 0, 10)


def single(number):
    """The number as a 32-bit float holds it."""
    try:
        return struct.unpack("f", struct.pack("f", number))[0]
    except OverflowError:
        return math.copysign(math.inf, number)


def plain_power(payload):
    try:
        root = ET.fromstring(payload)
    except ET.ParseError:
        return "malformed"
    if root.findtext(".//resultCode") != "00":
        return "api_error"
    item = root.find(".//item")
    if item is None:
        return "no_item"
    try:
        figures = [single(float(item.findtext(n) or 0)) for n in ("currPwrTot", "suppReservePwr")]
    except ValueError:
        return "bad_value"
    return (item.findtext("baseDatetime"), *figures)


def plain_weather(payload):
    try:
        data = json.loads(payload)
    except ValueError:
        return "rejected"
    try:
        response = data.get("response")
        if not (response and response.get("body") and response["body"].get("items")):
            return "rejected"
        found = {"PTY": None, "RN1": None, "T1H": None}
        for observation in response["body"]["items"].get("item", []):
            kind, value = observation.get("category"), observation.get("obsrValue")
            if kind == "T1H":
                found[kind] = single(float(value))
            elif kind == "RN1":
                found[kind] = single(float(0 if "강수" in str(value) else value))
            elif kind == "PTY":
                number = int(value)
                found[kind] = number if -(2**31) <= number < 2**31 else None
    except (AttributeError, TypeError, ValueError, OverflowError):
        return "rejected"
    return tuple(found.values())


def shown(values):
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in values)


def parsed(spark, parse, payloads, columns):
    frame = spark.createDataFrame(
        [(i, AT, p) for i, p in enumerate(payloads)], "id int, fetched_at timestamp, payload string"
    )
    kept = parse(frame).select("id", "reject_reason", *columns, "payload")
    return {r[0]: r[1:] for r in rows(kept)}


def power_payloads(n=400):
    rng = random.Random(7)
    figures = ["", "7", " 7 ", "1.5", "n/a", "  ", "1e3", "inf", "1_0", "<![CDATA[8]]>", "&#55;", "5<!-- x -->"]

    def element(name, values):
        text = rng.choice(values)
        open_ = rng.choice(["", "", " unit='MW'", ' a="x>y"'])
        return rng.choice(["", f"<{name}{open_}/>"] + [f"<{name}{open_}>{text}</{name}>"] * 6)

    def wrapped(text):
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            name = rng.choice(["body", "items", "wrap", "header", "response"])
            text = f"<{name}>{text}</{name}>"
        return text

    def item():
        parts = [element("baseDatetime", ["20250101001000", ""]), element("currPwrTot", figures)]
        parts += [element("suppReservePwr", figures), "<other>1</other>"]
        rng.shuffle(parts)
        return wrapped(f"<item>{''.join(parts)}</item>")

    def one():
        code = wrapped(element("resultCode", ["00"] * 12 + ["30", "0", " 00"]))
        parts = [code, wrapped("<resultMsg>OK &amp; more</resultMsg>")]
        parts += [item() for _ in range(rng.choice([0, 1, 1, 1, 2]))]
        rng.shuffle(parts)
        name = rng.choice(["response", "OpenAPI", "r"])
        text = f"<{name}>{'<!-- <item/> -->'.join(parts)}</{name}>"
        before = rng.choice(["", "", "<?xml version='1.0' encoding='UTF-8'?>", "<!-- hi -->\n", "<!DOCTYPE r>"])
        after = rng.choice([""] * 8 + ["\n", "<!-- bye -->", "junk", "<r/>", text, "&"])
        text = before + text + after
        return text[: rng.randrange(len(text))] if rng.random() < 0.05 else text

    fixed = ["", "x", "<r/>", "<r a='>'/>", "<r/>junk", "<a><b></a></b>", "<r>&bad;</r>", "<item><resultCode>00</resultCode></item>"]
    return fixed + [one() for _ in range(n)]


def test_power_rules(spark):
    payloads = power_payloads()
    found = parsed(spark, parse_power, payloads, ["base_datetime", "current_demand_mw", "reserve_power_mw"])
    kinds = set()
    for i, payload in enumerate(payloads):
        want, (reason, *reading, kept) = plain_power(payload), found[i]
        if isinstance(want, str):
            assert (reason, kept) == (want, payload), payload
        else:
            # An empty time is a missing one.
            assert reason is None and kept is None, payload
            assert (reading[0] or "", *reading[1:]) == (want[0] or "", *shown(want[1:])), payload
        kinds.add(reason)
    assert len(kinds) == 5


ITEM = "<item><baseDatetime>20250101001000</baseDatetime><currPwrTot>1</currPwrTot></item>"
MEGABYTE = 1 << 20


def whole(items, before=""):
    return f"{before}<r><h><resultCode>00</resultCode></h><b>{items}</b></r>"


# Read or rejected just as xml.etree does, whatever their size.
HOSTILE = [
    "<html " + "a" * MEGABYTE,
    "<html " + "a " * (MEGABYTE // 2),
    "<!--" * (MEGABYTE // 4),
    "</r><!--" * (MEGABYTE // 8),
    "<r>" + "</r >" * (MEGABYTE // 5) + "x",
    "<item>" * (MEGABYTE // 6),
    "<item a='" * (MEGABYTE // 9),
    "<!DOCTYPE r [" * (MEGABYTE // 13),
    "<?" * (MEGABYTE // 2),
    "<![CDATA[" * (MEGABYTE // 9),
    whole("x" * MEGABYTE + ITEM),
    whole("<y/>" * (MEGABYTE // 4) + ITEM),
    whole("<!--" + "<item> " * (MEGABYTE // 7) + "-->" + ITEM),
    whole("<x>" * 150 + ITEM + "</x>" * 150),
    whole("<item>" * 100 + "</item>" * 100),
    whole("<item><currPwrTot>" + "1_" * (MEGABYTE // 2) + "1</currPwrTot></item>"),
    whole("<item><currPwrTot>" + "1" * MEGABYTE + "</currPwrTot></item>"),
    whole(f"<item {' '.join(f'a{i}=\"x\"' for i in range(900))}>{ITEM[6:]}"),
]
ODD = [
    whole("<![CDATA[<item><currPwrTot>9</currPwrTot></item>]]>" + ITEM),
    whole("<?p <item><currPwrTot>9</currPwrTot></item>?>" + ITEM),
    whole("<!-- <![CDATA[ -->" + ITEM + "<!-- ]]> -->"),
    whole("<![CDATA[<!--]]>" + ITEM + "<![CDATA[-->]]>"),
    whole("<item><currPwrTot><![CDATA[ 8 ]]></currPwrTot></item>"),
    whole("<item><currPwrTot><![CDATA[a<b&c]]></currPwrTot></item>"),
    whole("<item><item><currPwrTot>5</currPwrTot></item><w><item/></w><currPwrTot>7</currPwrTot></item>" + ITEM),
    whole("<items><itemize/><item-x/></items>" + ITEM),
    whole(ITEM, "\ufeff"),
    whole(ITEM, "\ufeff<?xml version='1.0' encoding='utf-8'?>\n<!DOCTYPE r>"),
    whole(ITEM, "<!DOCTYPE r [<!ENTITY x '7]>'><!-- ' ] --><?p ]>?>]>"),
    whole(ITEM, "<!DOCTYPE r SYSTEM \"a>b\">"),
    whole(ITEM, " <?xml version='1.0'?>"),
    whole(ITEM, "<?xml version='1.0'?><?xml version='1.0'?>"),
    whole("<!-- a -- b -->" + ITEM),
    whole("<x a='<'/>" + ITEM),
    whole("]]>" + ITEM),
    whole("<item a='1' a='2'/>"),
    whole(ITEM) + "<!DOCTYPE r>",
    "<![CDATA[x]]>" + whole(ITEM),
    "<resultCode>00</resultCode>",
    whole("<item><currPwrTot>\uff11\uff12.5</currPwrTot></item>"),
    whole("<item><currPwrTot>\u3000\u0667\u00a0</currPwrTot></item>"),
    whole("<resultCode>30</resultCode>" + ITEM),
    "<r><x><resultCode>0<y/>0</resultCode></x>" + ITEM + "</r>",
]


def test_no_payload_is_too_much(spark):
    payloads = HOSTILE + ODD
    found = parsed(spark, parse_power, payloads, ["base_datetime", "current_demand_mw", "reserve_power_mw"])
    for i, payload in enumerate(payloads):
        want, (reason, *reading, _) = plain_power(payload), found[i]
        if isinstance(want, str):
            assert reason == want, payload[:200]
        else:
            assert (reason, reading[0] or "", *reading[1:]) == (None, want[0] or "", *want[1:]), payload[:200]


def test_beyond_the_parser_means_rejected(spark):
    """Documents that xml.etree reads and the parser here does not: rejected, never misread."""
    deep = whole("<x>" * 100_000 + ITEM + "</x>" * 100_000)
    wide = whole(f"<item {' '.join(f'a{i}=\"x\"' for i in range(5000))}>{ITEM[6:]}")
    entity = whole("<x>&e;</x>" + ITEM, "<!DOCTYPE r [<!ENTITY e '7'>]>")
    inside = whole("<item><currPwrTot>7<b/>8</currPwrTot></item>")
    found = parsed(spark, parse_power, [deep, wide, entity, inside], ["current_demand_mw"])
    assert [found[i][0] for i in range(4)] == ["malformed"] * 3 + ["bad_value"]


def test_no_json_payload_is_too_much(spark):
    def listed(value):
        return f'{{"response":{{"body":{{"items":{{"item":[{{"category":"T1H","obsrValue":{value}}}]}}}}}}}}'

    ok = [listed('"' + "1_" * 9 + '1"'), listed('"' + "0_" * (MEGABYTE // 2) + '5"'), listed('"' + " " * MEGABYTE + '5"')]
    bad = [listed('"' + "1_" * (MEGABYTE // 2) + '_1"'), "[" * MEGABYTE, '{"response":' * (MEGABYTE // 12)]
    bad += ['{"response":{"body":{"items":' + "[" * MEGABYTE, listed("[" * MEGABYTE), listed('"' + "x" * MEGABYTE)]
    bad += ["[" * 100_000 + "]" * 100_000, listed("1" * MEGABYTE + "x")]
    found = parsed(spark, parse_weather, ok + bad, ["temperature_c"])
    assert [found[i][:2] for i in range(len(ok))] == [(None, single(1111111111.0)), (None, 5.0), (None, 5.0)]
    assert all(found[i][0] is not None for i in range(len(ok), len(ok) + len(bad)))


def weather_payloads(n=400):
    rng = random.Random(8)
    values = ['"12.3"', '"강수없음"', '"1"', '"0.5"', '"x"', '""', '" 3 "', '"1_0"', '"nan"', "0.5", "-0.5", "3"]
    values += ["true", "false", "null", "1e3", "-7.9", "99999999999", "2147483647", "-2147483649", "1e400", "[]"]
    values += ['{"a":"강수"}', '["강수"]', "12345678901234567890123", '"99999999999"', '"-5"', "{}"]

    def observation():
        kind = rng.choice(["T1H", "RN1", "PTY", "REH"])
        value = rng.choice(values[:3] + values)
        return rng.choice([f'{{"category":"{kind}","obsrValue":{value}}}'] * 20 + ['{"category":"T1H"}', "{}", "5", "null", '"s"'])

    def one():
        listed = ",".join(observation() for _ in range(rng.choice([0, 1, 1, 2, 3])))
        items = rng.choice([f'{{"item":[{listed}]}}'] * 12 + ['""', "{}", "null", '{"other":1}', '{"item":{}}', '{"item":5}'])
        header = rng.choice(['"header":{"resultCode":"00","resultMsg":"OK"},', ""])
        text = f'{{"response":{{{header}"body":{{"items":{items}}}}}}}'
        after = rng.choice([""] * 10 + [" ", "\n", " junk", "{}", "," + text])
        return rng.choice(["", "", " \n"]) + text + after

    fixed = ["", "[]", "5", "null", "{}", '{"response":{}}', '{"response":null}', "<html>", '{"response":{"body":{}}}']
    return fixed + [one() for _ in range(n)]


def test_weather_rules(spark):
    payloads = weather_payloads()
    found = parsed(spark, parse_weather, payloads, ["rainfall_type", "rainfall_mm", "temperature_c"])
    accepted = 0
    for i, payload in enumerate(payloads):
        want, (reason, *reading, kept) = plain_weather(payload), found[i]
        if want == "rejected":
            assert reason is not None and kept == payload, payload
        else:
            accepted += 1
            assert reason is None and kept is None, payload
            assert tuple(reading) == shown(want), payload
    assert 50 < accepted < len(payloads) - 50
