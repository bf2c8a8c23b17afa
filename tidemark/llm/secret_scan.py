"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by its content. A blob is scanned once
for each version of each rule; a ledger keeps what was found. Later runs scan
only pairs of blob and rule version that the ledger lacks, and findings are
joined back to all paths that hold the blob.
"""

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, whole_text, written
from tidemark.session import new_folder


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if its ``group`` has ``least`` characters or more."""

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0
    any_case: bool = False

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Code points at which counted matches start and end; leftmost, non-overlapping."""
        flags = re.ASCII | (re.IGNORECASE if self.any_case else 0)
        return [
            m.span()
            for m in re.compile(self.pattern, flags).finditer(text)
            if m.end(self.group) - m.start(self.group) >= self.least
        ]


# The base rules, in the order in which equal starts are listed. The last asks
# for its length at once: a shorter run of hex digits holds no match either way.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
        group=2,
        any_case=True,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 32),
)

LEDGER = "blob binary, kind string, version int, spans array<struct<start:int,end:int>>"
_LEDGER = pa.schema(
    [
        ("blob", pa.binary()),
        ("kind", pa.string()),
        ("version", pa.int32()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def content_address(text: Column) -> Column:
    """SHA-256 of the text's UTF-8, as binary."""
    return F.unhex(F.sha2(text, 256))


def path_versions(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Written table, a row per row: path (the id) and blob (its text's address, null as empty)."""
    text = whole_text(text_column)
    rows = docs.select(F.col(id_column).alias("path"), content_address(text).alias("blob"))
    return written(rows, "path-versions")


def unseen(versions: DataFrame, rules: Sequence[Rule], ledger: DataFrame | None) -> DataFrame:
    """Blobs that lack a rule version in the ledger: blob, one path that holds it, and the kinds."""
    blobs = versions.groupBy("blob").agg(F.min("path").alias("path"))
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    if ledger is None:
        return blobs.withColumn("kinds", wanted["kind"])
    seen = ledger.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
    lacking = blobs.join(seen, "blob", "left").withColumn(
        "kinds", F.array_except(wanted, F.coalesce("seen", F.slice(wanted, 1, 0)))["kind"]
    )
    return lacking.filter(F.size("kinds") > 0).drop("seen")


def scan_blobs(
    docs: DataFrame,
    todo: DataFrame,
    rules: Sequence[Rule],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Scan the blobs of ``todo`` with the kinds it lists for them; rows of the ledger.

    The text of a blob comes from the one path that ``todo`` names.
    """
    by_kind = {rule.kind: rule for rule in rules}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            rows = []
            for blob, text, kinds in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for rule in map(by_kind.__getitem__, kinds):
                    spans = [{"start": a, "end": b} for a, b in rule.spans(text)]
                    rows.append({"blob": blob, "kind": rule.kind, "version": rule.version, "spans": spans})
            yield pa.RecordBatch.from_pylist(rows, _LEDGER)

    text = whole_text(text_column)
    rows = docs.select(F.col(id_column).alias("path"), text.alias("text"))
    addressed = rows.withColumn("blob", content_address(F.col("text"))).alias("a")
    found = addressed.join(todo.alias("t"), F.expr("a.path <=> t.path AND a.blob = t.blob"))
    return found.select("a.blob", "a.text", "t.kinds").mapInArrow(run, LEDGER)


def update_ledger(
    docs: DataFrame,
    versions: DataFrame,
    ledger_path: str,
    rules: Sequence[Rule] = BASE_RULES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Scan what the ledger at the path lacks, append it and return the whole ledger.

    The ledger is only ever appended to, in one commit per run; a run that fails
    leaves it as it was.
    """
    spark = docs.sparkSession
    before = read_ledger(spark, ledger_path)
    todo = unseen(versions, rules, before)
    found = scan_blobs(docs, todo, rules, id_column, text_column)
    found.write.mode("append").parquet(ledger_path)
    return read_ledger(spark, ledger_path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger, or None where nothing has been written yet."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(LEDGER).parquet(path) if system.exists(place) else None


def findings(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """Every path with what the given rule versions found in its blob: path and spans,
    an array of (start, rank of the rule, end, kind) in that order, empty if nothing was found."""
    ranks = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (f"{r.kind}:{r.version}", i)])
    named = ledger.withColumn("rank", ranks[F.concat_ws(":", "kind", "version")])
    spans = (
        named.filter("rank IS NOT NULL")
        .select("blob", "rank", "kind", F.explode("spans").alias("span"))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set(F.struct("span.start", "rank", "span.end", "kind"))).alias("spans"))
    )
    nothing = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    joined = versions.join(spans, "blob", "left")
    return joined.select("path", "blob", F.coalesce("spans", nothing).alias("spans"))


def scan(
    docs: DataFrame,
    ledger_path: str | None = None,
    rules: Sequence[Rule] = BASE_RULES,
    id_column: str = "doc_id",
    text_column: str = "text",
    arrivals: int = 1,
) -> DataFrame:
    """Every row's path, blob and spans (see ``findings``), after bringing the ledger up to date.

    A null text is empty. Rows that repeat a path each have their own result, by
    their own text. Without a path a new ledger is made in the shared folder.
    Very long texts are scanned whole. An empty table gives no rows. Other columns
    are not read.

    With several ``arrivals`` the rows come in as many parts, dealt by a hash of their
    path, one after the other: each part is scanned only for what the ledger lacks after
    the parts before it.
    """
    versions = path_versions(docs, id_column, text_column)
    ledger_path = ledger_path or new_folder(docs.sparkSession, "secret-ledger")
    for part in range(arrivals):
        rows, paths = (_arriving(*of, part, arrivals) for of in ((docs, id_column), (versions, "path")))
        ledger = update_ledger(rows, paths, ledger_path, rules, id_column, text_column)
    return findings(versions, ledger, rules)


def _arriving(rows: DataFrame, path: str, part: int, arrivals: int) -> DataFrame:
    return rows if arrivals == 1 else rows.filter(F.pmod(F.xxhash64(path), F.lit(arrivals)) == part)


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def scan_report(docs: DataFrame, ledger_path: str | None = None, arrivals: int = 1) -> DataFrame:
    """doc_id, matches of each base kind, digest of the base spans, and all spans as text;
    odd rows count as in ``scan``."""
    found = scan(docs, ledger_path, arrivals=arrivals)
    text = F.concat_ws(
        ",", F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )
    counts = [
        F.size(F.filter("spans", _of_kind(rule.kind))).cast("long").alias(f"n_{rule.kind}")
        for rule in BASE_RULES
    ]
    return found.select(
        F.col("path").alias("doc_id"), *counts, F.sha2(text, 256).alias("base_sha256"), text.alias("spans")
    )


def _without(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, as [kind] of the first."""

    def step(done: Column, span: Column) -> Column:
        gap = text.substr(done["at"] + 1, span["start"] - done["at"])
        marked = F.concat(done["out"], gap, F.lit("["), span["kind"], F.lit("]"))
        return F.struct(
            F.when(span["start"] >= done["at"], marked).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], span["end"]).alias("at"),
        )

    nothing = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(
        spans,
        nothing,
        step,
        lambda done: F.concat(done["out"], text.substr(done["at"] + 1, F.length(text))),
    )


def redact(
    docs: DataFrame,
    ledger_path: str | None = None,
    rules: Sequence[Rule] = BASE_RULES,
    id_column: str = "doc_id",
    text_column: str = "text",
    length_column: str | None = "n_chars",
) -> DataFrame:
    """All documents with the secrets cut out of their texts, columns as they were.

    Each secret gives way to its kind in brackets, and ``length_column``, if there
    is one, to the new length. Texts without findings stay untouched, null too. Rows that
    repeat a path are changed each by its own text. An empty table stays empty.
    """
    found = scan(docs, ledger_path, rules, id_column, text_column).filter(F.size("spans") > 0)
    marks = found.dropDuplicates(["path", "blob"])
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_column).alias("here"),
        content_address(whole_text(text_column)).alias("address"),
    )
    joined = rows.join(marks, F.expr("here <=> path AND address = blob"), "left")
    columns = []
    for name in docs.columns:
        column, new = F.col("row")[name], _without(F.col("row")[text_column], F.col("spans"))
        if name == length_column:
            new = F.length(new).cast(docs.schema[name].dataType)
        if name in (text_column, length_column):
            column = F.when(F.col("spans").isNull(), column).otherwise(new)
        columns.append(column.alias(name))
    return joined.select(columns)
