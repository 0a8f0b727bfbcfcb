import random

import pytest

from custbehav.llm.common import ship

DOCUMENT_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)


def prose(seed, words, vocabulary=400):
    """Invented sentences; equal seeds give equal texts."""
    draw = random.Random(seed)
    names = ["".join(draw.choice("aeioutnrslkdm") for _ in range(draw.randint(2, 9))) for _ in range(vocabulary)]
    out = []
    for i in range(words):
        word = draw.choice(names)
        out.append(word.capitalize() + "." if i % 11 == 10 else word)
    return " ".join(out)


@pytest.fixture(scope="session")
def documents(spark):
    """Nulls in every column, blank and very long texts, copies, repeated rows, secrets, odd characters."""
    texts = [prose(i, 20 + 7 * i) for i in range(24)]
    texts += [texts[3], texts[3], texts[5].replace(texts[5].split()[9], "changed", 1), texts[7] + " " + texts[8]]
    texts += [None, "", " \n\t ", "One word.", "é́ ü ß １２ \U0001F600 " * 9, prose(99, 30_000, 5_000), "same " * 5_000]
    texts += ['a token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" b', "x<|endoftext|>y <|startoftext|>"]
    texts += ["A line.\nA line.\n\nHOME\n" + texts[4] + "\nAll rights reserved."]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, texts[1], None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCUMENT_COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT_COLUMNS)


CLASHING = (
    "fingerprint", "mark", "node", "key", "size", "rate", "weight", "target", "words", "text_", "Text", "TEXT", "_t", "_q", "ids", "root"
)


@pytest.fixture(scope="session")
def crowded(documents):
    """The documents with further columns, some of them under names the operators use themselves."""
    from pyspark.sql import functions as F

    return documents.select("*", *[F.lit(1).alias(name) for name in CLASHING if name.lower() != "text"])


def rows_of(df):
    return sorted(map(repr, df.collect()))
