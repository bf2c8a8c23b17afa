"""Weather readings from raw JSON responses."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import integer_accepted, integer_value, real_value
from tidemark.functions.timekeys import publish_slot
from tidemark.operators.columns import computed_once
from tidemark.sources.responses import (
    API_ERROR,
    BAD_VALUE,
    MALFORMED,
    UNKNOWN_STRUCTURE,
    kept_columns,
    report,
)

# Field names, observation categories, and the word a rain text
# holds when there was none.
ITEMS_SCHEMA = "array<struct<category: string, obsrValue: variant>>"
STATUS = "header: struct<resultCode: string, resultMsg: string>"
RESPONSE_SCHEMA = f"""array<struct<
    response: struct<{STATUS}, body: struct<items: struct<item: {ITEMS_SCHEMA}>>>>>"""
TEMPERATURE = "T1H"
RAIN = "RN1"
RAIN_KIND = "PTY"
NO_RAIN = "강수"

KNOWN = [TEMPERATURE, RAIN, RAIN_KIND]

# The same response with its items under whatever names they have.
LOOSE_SCHEMA = "struct<response: struct<body: struct<items: map<string, variant>>>>"


def _opened_value(value: Column) -> Column:
    """Kind, text and number of a bare or quoted value, each taken from it once."""
    return F.struct(
        F.schema_of_variant(value).alias("kind"),
        F.try_variant_get(value, "$", "string").alias("text"),
        F.try_variant_get(value, "$", "double").alias("number"),
    )


class _Value:
    """An observation's opened value: a text is read by its characters, a bare number or truth
    value (1 or 0) as it is, anything else not at all."""

    def __init__(self, opened: Column):
        kind = opened["kind"]
        self._is_text = kind == "STRING"
        self._is_number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|BOOLEAN)")
        self._text = opened["text"]
        self._number = opened["number"]

    def real(self) -> Column:
        bare = F.when(self._is_number, self._number.cast("float"))
        return F.when(self._is_text, real_value(self._text)).otherwise(bare)

    def rain(self) -> Column:
        """No rain wherever the value, even a list, shows the word for it."""
        return F.when(self._text.contains(NO_RAIN), F.lit(0.0).cast("float")).otherwise(self.real())

    def is_whole(self) -> Column:
        """Whether an integer can be had of it; a bare number loses its fraction."""
        finite = F.coalesce(F.abs(self._number) < float("inf"), F.lit(False))
        return F.when(self._is_text, integer_accepted(self._text)).otherwise(
            F.coalesce(self._is_number, F.lit(False)) & finite
        )

    def whole(self) -> Column:
        fits = (self._number > -(2.0**31) - 1) & (self._number < 2.0**31)
        bare = F.when(self._is_number & fits, F.signum(self._number) * F.floor(F.abs(self._number)))
        return F.when(self._is_text, integer_value(self._text)).otherwise(bare.try_cast("int"))


def _unreadable(category: Column, value: Column) -> Column:
    """Whether an observation of a known category has no usable (opened) value."""
    read = _Value(value)
    return F.coalesce(
        ((category == TEMPERATURE) & read.real().isNull())
        | ((category == RAIN) & read.rain().isNull())
        | ((category == RAIN_KIND) & ~read.is_whole()),
        F.lit(False),
    )


def _opened(responses: DataFrame, payload: str) -> DataFrame:
    """Add the observations of each response and, where it has none, why.

    One parse serves every response that holds a list. Only the others are
    looked at again: empty ``items`` mean no data, ``items`` without a list a
    reading without figures, and a list that is none a bad value.
    """
    # As a list of one, so that anything after the document makes it unreadable.
    docs = F.from_json(F.concat(F.lit("["), F.col(payload), F.lit("]")), RESPONSE_SCHEMA)
    found = responses.withColumn("_docs", docs).withColumn(
        "_doc", F.when(F.size("_docs") == 1, F.get("_docs", F.lit(0)))
    )
    found = found.withColumns(
        {"_header": F.col("_doc.response.header"), "_list": F.col("_doc.response.body.items.item")}
    )
    has_list = F.col("_list").isNotNull()
    loose = F.from_json(F.col(payload), LOOSE_SCHEMA)["response"]["body"]["items"]
    found = found.withColumn("_items", F.when(~has_list, loose))
    item = F.col("_items")["item"]
    item_kind, item_text = F.schema_of_variant(item), F.try_variant_get(item, "$", "string")
    nothing = (item_kind == "OBJECT<>") | ((item_kind == "STRING") & (item_text == ""))
    no_item = ~F.map_contains_key(F.col("_items"), F.lit("item")) | nothing
    found = found.withColumn(
        "_observations",
        F.when(has_list, F.col("_list"))
        .when(no_item, F.from_json(F.lit("[]"), ITEMS_SCHEMA))
        .when(item_kind.startswith("ARRAY"), F.from_json(item_text, ITEMS_SCHEMA)),
    )
    damaged = F.col("_doc").isNull()
    empty = ~has_list & (F.coalesce(F.size("_items"), F.lit(0)) < 1)
    no_list = F.col("_observations").isNull() | F.exists("_observations", lambda o: o.isNull())
    structure = (
        F.when(damaged, MALFORMED)
        .when(empty & F.col("_header").isNotNull(), API_ERROR)
        .when(empty, UNKNOWN_STRUCTURE)
        .when(no_list, BAD_VALUE)
    )
    return found.withColumn("_structure", structure)


def parse_weather(
    responses: DataFrame, payload: str = "payload", fetched_at: str = "fetched_at"
) -> DataFrame:
    """Add the reading of each response, or the reason it has none.

    The event time is the slot that was current at the fetch. Of a category
    listed twice the last counts. A value that cannot be read, wherever it
    stands in the list, rejects the response as a whole.
    """

    def last(category: str) -> Column:
        of_kind = F.filter("_known", lambda o: o["category"] == category)
        return F.try_element_at(of_kind, F.lit(-1))

    known = F.filter("_observations", lambda o: o["category"].isin(KNOWN))
    opened = _opened(responses, payload).withColumn("_known", known)
    opened = opened.withColumns(
        {"_last_t": last(TEMPERATURE), "_last_r": last(RAIN), "_last_k": last(RAIN_KIND)}
    )
    opened = opened.withColumns(
        {f"_value_{n}": _opened_value(F.col(f"_last_{n}.obsrValue")) for n in ("t", "r", "k")}
    )
    opened = opened.withColumns(
        {
            "_degrees": _Value(F.col("_value_t")).real(),
            "_rain": _Value(F.col("_value_r")).rain(),
            "_kind_ok": _Value(F.col("_value_k")).is_whole(),
            "_kind": _Value(F.col("_value_k")).whole(),
        }
    )
    listed = [F.col(name).isNotNull() for name in ("_last_t", "_last_r", "_last_k")]
    n_listed = sum((present.cast("int") for present in listed), F.lit(0))
    bad = (
        (listed[0] & F.col("_degrees").isNull())
        | (listed[1] & F.col("_rain").isNull())
        | (listed[2] & ~F.col("_kind_ok"))
        # Only a category listed twice has values besides the last.
        | (
            (F.size("_known") > n_listed)
            & F.exists("_known", lambda o: _unreadable(o["category"], _opened_value(o["obsrValue"])))
        )
    )
    opened = opened.withColumn("_reason", F.coalesce(F.col("_structure"), F.when(bad, BAD_VALUE)))
    reading = {
        "base_datetime": publish_slot(F.col(fetched_at))["base_datetime"],
        "rainfall_type": F.col("_kind"),
        "rainfall_mm": F.col("_rain"),
        "temperature_c": F.col("_degrees"),
    }
    why = report(
        F.col("_reason"), F.col("_header.resultCode"), F.col("_header.resultMsg"), F.col(payload)
    )
    return computed_once(opened, {**reading, **why}, *kept_columns(responses, payload))


def observation_items(responses: DataFrame, *by: str, payload: str = "payload") -> DataFrame:
    """One row per observation of each well-formed response, in list order.

    A response with an empty list keeps one row without a category.
    """
    opened = computed_once(
        _opened(responses, payload),
        {"_observations": F.col("_observations"), "_structure": F.col("_structure")},
        *by,
    )
    rows = opened.filter(F.col("_structure").isNull()).select(
        *by, F.posexplode_outer("_observations").alias("pos", "_item")
    )
    return rows.select(
        *by,
        "pos",
        F.col("_item.category").alias("category"),
        F.col("_item.obsrValue").alias("obsr_value"),
    )


def pivot_observations(items: DataFrame, *by: str) -> DataFrame:
    """Readings from observations that come as rows, one per response.

    Same rules as ``parse_weather``, which needs no shuffle and suits
    responses that still hold their list.
    """
    value = _Value(F.col("_value"))
    read = items.withColumn("_value", _opened_value(F.col("obsr_value"))).select(
        *by,
        "pos",
        "category",
        _unreadable(F.col("category"), F.col("_value")).alias("_bad"),
        F.when(F.col("category") == RAIN_KIND, value.whole()).alias("_kind"),
        F.when(F.col("category") == RAIN, value.rain()).alias("_rain"),
        F.when(F.col("category") == TEMPERATURE, value.real()).alias("_degrees"),
    )

    def last(value: str, category: str) -> Column:
        return F.max_by(value, F.when(F.col("category") == category, F.col("pos")))

    pivoted = read.groupBy(*by).agg(
        F.bool_or("_bad").alias("_bad"),
        last("_kind", RAIN_KIND).alias("rainfall_type"),
        last("_rain", RAIN).alias("rainfall_mm"),
        last("_degrees", TEMPERATURE).alias("temperature_c"),
    )
    return pivoted.filter(~F.col("_bad")).drop("_bad")
