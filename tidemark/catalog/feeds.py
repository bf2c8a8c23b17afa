"""Feeds derived from the table ``events``, for the registered queries.

Events other than views are power readings, views are weather readings. Damaged
messages and responses are chosen by the number in ``props``, so that every
kind of damage occurs in proportion to the table.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import POWER_TIME_FORMAT

ID = "event_id"
FILES_PER_BATCH = 5000
# Of payloads that would try a parser's patience, one in so many repeats a part so often.
LONG_EVERY, LONG_REPEATS = 100, 5_000
IS_POWER = "event_type <> 'view'"
IS_WEATHER = "event_type = 'view'"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(
    spark: SparkSession, sf_dir: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """The same table as a stream of its files."""
    # The braces make a single file and a folder of files alike readable.
    reader = spark.readStream.schema(events(spark, sf_dir).schema)
    # A bounded batch keeps what a failure repeats small; all files are read.
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{sf_dir}/{{events.parquet}}")


def _power_time() -> Column:
    return F.date_format("ts", POWER_TIME_FORMAT)


def _weather_time() -> Column:
    return F.date_format("ts", "yyyyMMddHH'00'")


def _demand() -> Column:
    return 60000 + 50 * F.col("value")


def _reserve() -> Column:
    return 5000 + 10 * F.col("value")


def _rain_kind() -> Column:
    return F.pmod("user_id", F.lit(4)).cast("int")


def _rain() -> Column:
    return F.when(_rain_kind() == 0, F.lit(0.0)).otherwise(F.col("value") / 10)


def _temperature() -> Column:
    return -10 + F.col("value") / 10


def _repeats() -> Column:
    return F.when(F.col(ID) % LONG_EVERY == 0, LONG_REPEATS).otherwise(3)


def with_kind(source: DataFrame) -> DataFrame:
    """Add the number in props, 0 to 99, that picks the kind of damage."""
    return source.withColumn("kind", F.regexp_extract("props", r"(\d+)", 1).try_cast("int"))


def power_feed(source: DataFrame) -> DataFrame:
    return source.filter(IS_POWER).select(
        _power_time().alias("base_datetime"),
        _demand().cast("float").alias("current_demand_mw"),
        _reserve().cast("float").alias("reserve_power_mw"),
        ID,
    )


def weather_feed(source: DataFrame) -> DataFrame:
    return source.filter(IS_WEATHER).select(
        _weather_time().alias("base_datetime"),
        _rain_kind().alias("rainfall_type"),
        _rain().cast("float").alias("rainfall_mm"),
        _temperature().cast("float").alias("temperature_c"),
        ID,
    )


def power_messages(source: DataFrame, *keep: str) -> DataFrame:
    """Messages of the power feed, some of them damaged."""
    kind, time = F.col("kind"), _power_time()
    figures = F.format_string(
        '"current_demand_mw":%.2f,"reserve_power_mw":%.2f', _demand(), _reserve()
    )
    whole = F.format_string('{"base_datetime":"%s",%s}', time, figures)
    text = (
        F.when(kind < 3, F.lit("not json"))
        .when(kind < 6, F.substring(whole, 1, 25))
        .when(kind < 8, F.format_string('{"base_datetime":"%s"}', time))
        .when(
            kind < 10,
            F.format_string(
                '{"base_datetime":"%s","current_demand_mw":%.2f,"reserve_power_mw":"%.2f"}',
                time, _demand(), _reserve(),
            ),
        )
        .when(kind < 12, F.format_string('{"note":"x","base_datetime":"%s",%s}', time, figures))
        .when(kind == 12, F.lit(None).cast("string"))
        .when(kind == 13, F.lit(""))
        .when(kind < 16, F.format_string('{"base_datetime":%s,%s}', time, figures))
        .when(kind == 16, F.format_string('{"Base_Datetime":"%s",%s}', time, figures))
        .when(kind == 17, F.format_string("[%s]", whole))
        .otherwise(whole)
    )
    return with_kind(source.filter(IS_POWER)).select(*keep, text.cast("binary").alias("value"))


def weather_messages(source: DataFrame, *keep: str) -> DataFrame:
    """Messages of the weather feed, some of them damaged."""
    kind, time = F.col("kind"), _weather_time()
    number = F.format_string("%d", _rain_kind())
    degrees = F.format_string("%.3f", _temperature())
    rain_kind = (
        F.when(kind < 5, number)
        .when(kind < 7, F.lit('"a"'))
        .when(kind < 9, F.lit("99999999999"))
        .when(kind == 11, F.format_string("%s.0", number))
        .otherwise(number)
    )
    shown = F.when(kind.between(9, 10), F.format_string('"%s"', degrees)).otherwise(degrees)
    whole = F.format_string(
        '{"base_datetime":"%s","rainfall_type":%s,"rainfall_mm":%.3f,"temperature_c":%s}',
        time, rain_kind, _rain(), shown,
    )
    text = (
        F.when(kind < 3, F.lit("not json"))
        .when(kind < 5, F.format_string('{"base_datetime":"%s"}', time))
        .otherwise(whole)
    )
    return with_kind(source.filter(IS_WEATHER)).select(*keep, text.cast("binary").alias("value"))


def power_responses(source: DataFrame) -> DataFrame:
    """Raw XML responses, one per power reading, some of them errors."""
    kind, often = F.col("kind"), _repeats()
    demand = (
        F.when(kind == 46, F.concat(F.repeat(F.lit("1_"), often), F.lit("_1")))
        .when(kind.between(30, 33), F.lit("n/a"))
        .otherwise(F.format_string("%.2f", _demand()))
    )
    reserve = F.format_string("<suppReservePwr>%.2f</suppReservePwr>", _reserve())
    reserve = (
        F.when(kind.between(21, 25), F.lit("<suppReservePwr></suppReservePwr>"))
        .when(kind.between(26, 29), F.lit(""))
        .otherwise(reserve)
    )
    item = F.format_string(
        "<item><baseDatetime>%s</baseDatetime><currPwrTot>%s</currPwrTot>%s</item>",
        _power_time(), demand, reserve,
    )
    second = "<item><baseDatetime>19700101000000</baseDatetime><currPwrTot>1</currPwrTot></item>"
    items = (
        F.when(kind.between(13, 16), F.lit(""))
        .when(kind.between(17, 20), F.concat(item, F.lit(second)))
        .otherwise(item)
    )
    header = (
        F.when(
            kind.between(5, 9),
            F.lit("<resultCode>30</resultCode><resultMsg>KEY ERROR</resultMsg>"),
        )
        .when(kind.between(10, 12), F.lit("<resultMsg>NO CODE</resultMsg>"))
        .otherwise(F.lit("<resultCode>00</resultCode><resultMsg>OK</resultMsg>"))
    )
    usual = "<response><header>%s</header><body><items>%s</items></body></response>"
    deeper = (
        "<response><envelope><header>%s</header></envelope>"
        "<body><wrap><items>%s</items></wrap></body></response>"
    )
    whole = F.when(kind.between(34, 37), F.format_string(deeper, header, items)).otherwise(
        F.format_string(usual, header, items)
    )
    aside = "<response><![CDATA[%s]]>" + usual[len("<response>") :]
    whole = (
        F.when(kind == 38, F.format_string(aside, F.lit(second), header, items))
        .when(kind == 39, F.concat(F.lit("\ufeff"), whole))
        .when(kind == 40, F.concat(F.lit('<!DOCTYPE response [<!ENTITY a "]>">]>'), whole))
        .when(kind == 41, F.concat(F.lit("<!--"), F.repeat(F.lit("<item> "), often), F.lit("-->"), whole))
        .when(kind == 42, F.format_string("<response><i%s/>%s</response>", F.repeat(F.lit(" "), often), whole))
        .when(kind == 43, F.concat(F.lit("<html "), F.repeat(F.lit("ab "), often)))
        .when(kind == 44, F.concat(whole, F.repeat(F.lit("</response><!--"), often)))
        .when(kind == 45, F.repeat(F.lit("<item>"), often))
        .otherwise(whole)
    )
    gateway = F.concat(
        F.format_string("<html><title>gateway %d</title><p>", ID), F.repeat(F.lit("no reply "), 40)
    )
    payload = (
        F.when(kind < 2, gateway)
        .when(kind == 2, F.concat(whole, F.lit("junk")))
        .when(kind == 3, F.concat(whole, whole))
        .when(kind == 4, F.lit("<response><header>"))
        .otherwise(whole)
    )
    return with_kind(source.filter(IS_POWER)).select(
        ID, F.col("ts").alias("fetched_at"), payload.alias("payload")
    )


def weather_responses(source: DataFrame) -> DataFrame:
    """Raw JSON responses, one per weather reading, some of them errors."""
    kind, often = F.col("kind"), _repeats()

    def observation(category: str, value: Column, bare: Column | None = None) -> Column:
        quoted = F.format_string(f'{{"category":"{category}","obsrValue":"%s"}}', value)
        if bare is None:
            return quoted
        unquoted = F.format_string(f'{{"category":"{category}","obsrValue":%s}}', bare)
        return F.when(kind == 15, unquoted).otherwise(quoted)

    rain = F.when(_rain_kind() == 0, F.lit("강수없음")).otherwise(
        F.concat(F.when(kind == 17, F.repeat(F.lit("0_"), often)).otherwise(""), F.format_string("%.3f", _rain()))
    )
    rain = F.when(kind.between(9, 10), F.lit("1mm 미만")).otherwise(rain)
    rain_kind = (
        F.when(kind.between(11, 12), F.lit("0.5"))
        .when(kind == 16, F.concat(F.repeat(F.lit("1_"), often), F.lit("_1")))
        .otherwise(F.format_string("%d", _rain_kind()))
    )
    degrees = observation("T1H", F.format_string("%.3f", _temperature()), F.lit("true"))
    degrees = (
        F.when(kind.between(7, 8), F.concat_ws(",", observation("T1H", F.lit("99.9")), degrees))
        .when(kind == 13, observation("WSD", F.lit("2.4")))
        .otherwise(degrees)
    )
    listed = F.concat_ws(
        ",",
        observation("PTY", rain_kind, F.lit("0.5")),
        observation("REH", F.lit("55")),
        observation("RN1", rain),
        degrees,
    )
    listed = F.when(kind.between(5, 6), F.lit("")).otherwise(listed)
    whole = F.format_string(
        '{"response":{"header":{"resultCode":"00","resultMsg":"OK"},'
        '"body":{"items":{"item":[%s]}}}}',
        listed,
    )
    no_data = (
        '{"response":{"header":{"resultCode":"03","resultMsg":"NO DATA"},'
        '"body":{"items":""}}}'
    )
    gateway = F.concat(
        F.format_string("<html>gateway %d</html>", ID), F.repeat(F.lit("no reply "), 40)
    )
    payload = (
        F.when(kind < 2, gateway)
        .when(kind == 2, F.concat(whole, F.lit('{"x":1}')))
        .when(kind < 5, F.lit(no_data))
        .when(kind == 14, F.lit('{"x":1}'))
        .when(kind == 18, F.repeat(F.lit('{"response":['), often))
        .otherwise(whole)
    )
    return with_kind(source.filter(IS_WEATHER)).select(
        ID, F.col("ts").alias("fetched_at"), payload.alias("payload")
    )
