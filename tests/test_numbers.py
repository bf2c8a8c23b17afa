import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import integer_accepted, integer_value, real_value

TEXTS = [
    "12.3", " 12.3 ", "-4", "+4.5", "1e3", "1E-3", ".5", "5.", "1_000.5", "nan", "NaN", "inf",
    "-Infinity", "0", "007", "1.5d", "1.5f", "0x10", "0x1p3", "", " ", "1,5", "abc", "1 2", "1__0",
    "_1", "--1", "1e", "99999999999", "2147483648", "0.5", "강수없음", "1mm 미만", "1_0", "infinit",
    "１２.5", "\u3000٧\u00a0", "\U0001d7cf", "1_2_3", "1_", "1._5", "1.5_", "1e1_0", "²", ".", "+", "1.e2", "\n5\t",
    "1_" * 3000 + "1", "1_" * 3000 + "_1", "x" * 3000,
]


def python_float(text):
    try:
        return np.float32(float(text)).item()
    except ValueError:
        return None


def python_int(text):
    try:
        return int(text)
    except ValueError:
        return None


@pytest.fixture(scope="module")
def read(spark):
    frame = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    t = F.col("t")
    found = frame.select("t", real_value(t), integer_accepted(t), integer_value(t)).collect()
    return {r[0]: tuple(r[1:]) for r in found}


@pytest.mark.parametrize("text", TEXTS)
def test_real_reads_what_python_reads(read, text):
    expected, found = python_float(text), read[text][0]
    if expected is None:
        assert found is None
    elif math.isnan(expected):
        assert math.isnan(found)
    else:
        assert found == expected


@pytest.mark.parametrize("text", TEXTS)
def test_integer_accepts_what_python_accepts(read, text):
    expected = python_int(text)
    _, accepted, value = read[text]
    assert accepted == (expected is not None)
    if expected is not None and abs(expected) < 2**31:
        assert value == expected
    else:
        assert value is None


def test_missing_text(read):
    assert read[None] == (None, False, None)
