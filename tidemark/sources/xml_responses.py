"""Power readings from raw XML responses.

The status and the item count wherever they stand below the root, the first of
each in document order. A payload must be one whole document: its root is
renamed and put beside copies of the first such elements, so one parse holds
the whole document to be well-formed and gives the elements' texts.

Nothing here nests calls with the length of a payload: repeated groups in the
patterns are possessive, which Java matches in a loop, and what is nested beyond
MAX_DEPTH never reaches the parser. So a payload can at worst be rejected, as it is
for more attributes or longer ones than the parser takes, for entities that it
declares itself, and for a figure that holds elements.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import real_value
from tidemark.operators.columns import computed_once
from tidemark.sources.responses import (
    API_ERROR,
    BAD_VALUE,
    MALFORMED,
    NO_ITEM,
    kept_columns,
    report,
)

# Element names, and the code of a good response.
STATUS = ["resultCode", "resultMsg"]
ITEM = "item"
FIGURES = "baseDatetime: array<string>, currPwrTot: array<string>, suppReservePwr: array<string>"
RESULT_OK = "00"

CORRUPT = "_corrupt_record"
RESPONSE_SCHEMA = f"""struct<resultCode: array<string>, resultMsg: array<string>,
    item: array<struct<{FIGURES}>>, {CORRUPT}: string>"""

# Texts count as they stand, blanks included.
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": CORRUPT}

# The parser calls itself for each level of elements it skips.
MAX_DEPTH = 200

BYTE_ORDER_MARK = "﻿"
DECLARATION = r"""^<\?xml\s++version\s*+=\s*+(?:"[^"<]++"|'[^'<]++')(?:\s[^<>?]*+)?+\?>"""
QUOTED = r""""[^"]*+"|'[^']*+'"""
DOCTYPE = rf"""^\s*+<!DOCTYPE\s(?:[^\[<>"']++|{QUOTED})*+(?:\[(?:[^\]"']++|{QUOTED})*+\]\s*+)?+>"""
NAME = r"""[^\s/>!?<&"'=]++"""
# The rest of a start tag; quoted values may hold its end, ">".
IN_TAG = rf"""[^<>"']*+(?:(?:{QUOTED})[^<>"']*+)*+"""

# What may hold "<" that opens no element, and all between; what never ends takes the rest.
ASIDE = r"<!--(?:.*?-->|.*+)|<!\[CDATA\[(?:.*?\]\]>|.*+)|<\?(?:.*?\?>|.*+)"
PARTS = rf"(?s){ASIDE}|<?[^<]*+"
COMMENT = r"(?s)^<!--(?:-?[^-])*+-->$"
INSTRUCTION = r"(?s)^<\?(?!(?i:xml)[\s?])[\p{L}_:][\p{L}\p{N}_:.-]*+(?:\s.*)?\?>$"
CDATA = r"(?s)^<!\[CDATA\[(.*)\]\]>$"

# The root: its name, and all from there to its end tag, the last thing there is.
ROOT = rf"(?s)^\s*+<({NAME})(?=[\s>])(.*)</\1\s*+>\s*+$"
EMPTY_ROOT = rf"(?s)^\s*+<{NAME}(?=[\s/]){IN_TAG}(?<=/)>\s*+$"


def _first(elements: Column) -> Column:
    """The first such element; NULL where there is none."""
    return F.try_element_at(elements, F.lit(1))


def _escaped(text: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def _tags_and_text(payload: Column) -> Column:
    """The payload without what stands before the root but names no element, without comments and
    instructions, and with the text of CDATA sections as other text.

    What is not as it should be stays, for the parser to reject.
    """

    def plain(part: Column) -> Column:
        return (
            F.when(part.startswith("<![CDATA["), _escaped(F.regexp_extract(part, CDATA, 1)))
            .when(part.startswith("<!--") & part.rlike(COMMENT), F.lit(""))
            .when(part.startswith("<?") & part.rlike(INSTRUCTION), F.lit(""))
            .otherwise(part)
        )

    text = F.when(payload.startswith(BYTE_ORDER_MARK), F.substr(payload, F.lit(2))).otherwise(payload)
    text = F.when(text.startswith("<?"), F.regexp_replace(text, DECLARATION, "")).otherwise(text)
    parts = F.regexp_extract_all(text, F.lit(PARTS), F.lit(0))
    cleared = F.regexp_replace(F.array_join(F.transform(parts, plain), ""), DOCTYPE, "")
    return F.when(text.contains("<!") | text.contains("<?"), cleared).otherwise(text)


def _start_of_first(name: str) -> str:
    """Pattern of all up to the end of the first start tag of that name, but for its '>'; anchored,
    so that a document is read once."""
    return rf"(?s)^(?:[^<]++|<(?!{name}[\s/>]))*+<{name}(?=[\s/>]){IN_TAG}"


def _text_element(text: Column, name: str) -> Column:
    """An element of that name with the text that the first such one has up to any element in it;
    without text if there is none."""
    found = F.regexp_extract(text, _start_of_first(name) + "(?<!/)>([^<]*+)", 1)
    return F.concat(F.lit(f"<{name}>"), found, F.lit(f"</{name}>"))


def _whole_element(text: Column, name: str) -> Column:
    """The first element of that name up to the first end tag of that name; empty if there is none."""
    rest = rf"(?:(?<=/)>|(?<!/)>(?:[^<]++|<(?!/{name}[\s>]))*+</{name}\s*+>)"
    return F.regexp_extract(text, rf"(?s)^(?:[^<]++|<(?!{name}[\s/>]))*+(<{name}(?=[\s/>]){IN_TAG}{rest})", 1)


def _nested_element(text: Column, name: str) -> Column:
    """The first element of that name, which may hold others of its name."""
    pieces = F.split(text, "<")

    def step(piece: Column, place: Column) -> Column:
        empty = piece.rlike(rf"^{name}(?=[\s/]){IN_TAG}(?<=/)>")
        opens = piece.rlike(rf"^{name}[\s>]") & ~empty
        change = F.when(opens, 1).when(piece.rlike(rf"^/{name}[\s>]"), -1).otherwise(0)
        return F.struct(place.alias("place"), change.alias("change"))

    def follow(state: Column, at: Column) -> Column:
        level = state["level"] + at["change"]
        ends = (state["last"] < 0) & (level == 0)
        return F.struct(
            level.alias("level"),
            F.when(state["first"] < 0, at["place"]).otherwise(state["first"]).alias("first"),
            F.when(ends, at["place"]).otherwise(state["last"]).alias("last"),
        )

    steps = F.filter(F.transform(pieces, step), lambda at: at["change"] != 0)
    begin = F.struct(F.lit(0).alias("level"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def copy(state: Column) -> Column:
        length = state["last"] - state["first"]
        inner = F.array_join(F.slice(pieces, state["first"] + 1, F.greatest(length, F.lit(0))), "<")
        return F.when(length > 0, F.concat(F.lit("<"), inner, F.lit(f"</{name}>")))

    return F.coalesce(F.aggregate(steps, begin, follow, copy), F.lit(""))


def _too_deep(text: Column) -> Column:
    """Whether elements are nested beyond MAX_DEPTH."""

    def follow(state: Column, piece: Column) -> Column:
        empty = piece.rlike(rf"^{NAME}(?=[\s/]){IN_TAG}(?<=/)>")
        level = state["level"] + F.when(piece.startswith("/"), -1).when(empty, 0).otherwise(1)
        return F.struct(level.alias("level"), F.greatest(state["most"], level).alias("most"))

    begin = F.struct(F.lit(0).alias("level"), F.lit(0).alias("most"))
    depth = F.aggregate(F.split(text, "<"), begin, follow, lambda state: state["most"])
    # A level takes seven characters at least, so most payloads are too short for it.
    return F.when(F.length(text) > 7 * MAX_DEPTH, depth > MAX_DEPTH).otherwise(False)


def _one_document(responses: DataFrame, payload: str) -> DataFrame:
    """Add _whole: the document below a root of our own, then its first status and item; NULL
    unless the payload is one document with nothing but comments around it.

    The steps are columns of their own, so that each is computed once.
    """
    text, inner, item = F.col("_text"), F.col("_inner"), F.col("_first_item")
    nested = F.locate(f"<{ITEM}", item, 2) > 0
    copies = [_text_element(inner, name) for name in STATUS]
    copies.append(F.when(nested, _nested_element(inner, ITEM)).otherwise(item))
    whole = F.concat(F.lit("<all><document"), inner, F.lit("</document>"), *copies, F.lit("</all>"))
    found = responses.withColumn("_text", _tags_and_text(F.col(payload)))
    # What a match leaves of the root is never empty.
    found = found.withColumn("_inner", F.regexp_extract(text, ROOT, 2))
    found = found.withColumn("_first_item", _whole_element(inner, ITEM))
    return found.withColumn(
        "_whole",
        F.when((inner != "") & ~_too_deep(text), whole).when(text.rlike(EMPTY_ROOT), F.lit("<all/>")),
    )


def _blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def _number(text: Column) -> Column:
    """Number of a text that may be blank or missing, which counts as zero."""
    return F.when(_blank(text), F.lit(0.0).cast("float")).otherwise(real_value(text))


def parse_power(
    responses: DataFrame, payload: str = "payload", blank_as_null: bool = False
) -> DataFrame:
    """Add the reading of each response, or the reason it has none and its payload.

    Only the first item counts. A blank or missing figure reads as zero, which
    then looks like an alert, unless ``blank_as_null`` is set; a figure that is
    no number rejects the response as a whole. An empty status counts as none.
    """
    doc = F.from_xml(F.col("_whole"), RESPONSE_SCHEMA, XML_OPTIONS)
    found = _one_document(responses, payload).withColumn("_doc", doc).withColumns(
        {
            "_code": F.nullif(_first(F.col("_doc.resultCode")), F.lit("")),
            "_msg": F.nullif(_first(F.col("_doc.resultMsg")), F.lit("")),
            "_item": _first(F.col("_doc.item")),
        }
    )
    demand = _first(F.col("_item.currPwrTot"))
    reserve = _first(F.col("_item.suppReservePwr"))
    found = found.withColumns({"_demand": _number(demand), "_reserve": _number(reserve)})
    reason = (
        F.when(F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull(), MALFORMED)
        .when(F.coalesce(F.col("_code"), F.lit("")) != RESULT_OK, API_ERROR)
        .when(F.col("_item").isNull(), NO_ITEM)
        .when(F.col("_demand").isNull() | F.col("_reserve").isNull(), BAD_VALUE)
    )

    def figure(value: Column, text: Column) -> Column:
        return F.when(~_blank(text), value) if blank_as_null else value

    reading = {
        "base_datetime": _first(F.col("_item.baseDatetime")),
        "current_demand_mw": figure(F.col("_demand"), demand),
        "reserve_power_mw": figure(F.col("_reserve"), reserve),
    }
    found = found.withColumn("_reason", reason)
    why = report(F.col("_reason"), F.col("_code"), F.col("_msg"), F.col(payload))
    return computed_once(found, {**reading, **why}, *kept_columns(responses, payload))
