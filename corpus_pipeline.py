"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again for the next. All but the last return the columns of
documents.

In every stage an empty table stays empty, texts count whole however long they are,
and extra columns, whatever their names, are carried along as they are up to the
last stage. Nulls in lang, source and n_chars mean nothing to any stage. What a
stage does with null texts, null ids, ties and repeated rows is said at each.
"""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, packing, quality, secret_scan, simhash
from tidemark.llm.common import written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects.

    A null text is judged like an empty one. Each row is judged by its own text,
    so rows that repeat one another share a verdict, and a null id makes no
    difference but that it has no label. Without labels of both kinds everything
    scores alike: the share of good labels, or 0.5.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the document with the smallest id.

    Null and empty texts are equal. Of rows that repeat id and text one stays. A
    row without an id stays only where no document of its text has one.
    """
    return exact_dedup.drop_copies(docs, keep="smallest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each SimHash component the document with the smallest id.

    Texts without a word, null or not, have one fingerprint and so one component.
    Of texts that share the smallest id, and where no document of a component has
    an id, the text of the least hash stays. Of rows that repeat id and text one
    stays.
    """
    return simhash.drop_near(docs, repeats=False)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, each secret replaced by its kind and n_chars brought up to date.

    A null text stays null. Of overlapping secrets the first gives its kind to
    the whole stretch; at equal starts the kinds' order decides. Repeated rows
    and rows without an id are changed each by its own text.
    """
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document, byte-level tokens, in sequences of permitted lengths.

    A null or empty text is one token, its end. Repeated rows are placed each,
    and so are rows without an id. Pieces of equal length come in the order of
    id and piece.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("secret scans", secrets),
    ("best-fit packing", packed),
]

# A discriminant, XXH64 shingles and best-fit packing are beyond SQL; tests hold
# run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
