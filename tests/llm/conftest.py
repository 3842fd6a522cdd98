import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"word{i % 977} und{i % 31}" for i in range(60_000))
SHARED = "this line stands in several documents"

# Nulls in any column, empty and very long texts, ties and repeated rows.
ODD = [
    (1, "The first text has words enough for rules.\n" + SHARED + "\nand an end", "en", "src0", 10),
    (2, "  THIS line stands in several documents \nown words of the second\n\n", "en", None, 11),
    (3, None, "en", "src0", None),
    (4, "", None, None, 0),
    (5, LONG, "de", "src1", 12),
    (6, " \n\t\n", "en", "src0", 3),
    (7, "é ü ß \U0001f600 日本 " * 5, "fr", "src1", 4),
    (7, "é ü ß \U0001f600 日本 " * 5, "fr", "src1", 4),
    (8, "é ü ß \U0001f600 日本 " * 5, "fr", "src1", 4),
    (None, "no id but " + SHARED, "en", "src0", 1),
    (9, "a\x00b \\ <|im_end|> *** ### $$$", "en", "src0", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}
