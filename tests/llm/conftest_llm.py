import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns that carry the names of results and intermediates.
CLASHES = ("n_words", "kept", "score", "features", "ids", "component_id", "block", "length", "toxic",
           "start", "fp", "prediction", "rawPrediction", "held_out", "text_key", "words", "margin")


def words_of(text, fold=False):
    return WORD.findall((text or "").translate(LOW) if fold else text or "")


def rows_of(texts, first=0):
    return [(first + i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]


def edge_texts():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(1, 8))) for _ in range(3000)]
    long = " ".join(rnd.choice(vocabulary) for _ in range(60_000))
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))
    body = [" ".join(rnd.choice(vocabulary) for _ in range(n)) for n in (5, 34, 35, 36, 120, 300)]
    return [None, "", "   \n\t ", "one", "a b", "a b c", "A B c", *body, body[4], body[4], body[4] + " x",
            f"{body[0]} {passage} {body[1]}", f"{passage}\n{body[2]}", f"{body[3]}\t{passage} {passage}",
            long, long + " tail", "ends\x0bwith\x0codd\r\nspaces\xa0inside 　 é ſ ß Σ", "a " * 500, "\U0001f600 " * 3,
            "x" * 5000]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null ids and texts, empty, short and very long texts, repeated rows and
    ids, and extra columns that clash with the operators' own names."""
    rows = rows_of(edge_texts())
    rows += [(None, "no id here", "en", "s", 10), (None, None, None, None, None), rows[10], (3, "other text", "de", "s", 1)]
    d = spark.createDataFrame(rows, DOCS).repartition(3)
    for i, name in enumerate(CLASHES):
        d = d.withColumn(name, F.lit(i))
    return d


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCS))
