import random

import pytest

from wattflow.llm.common import prepare, read_table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, node string, size long, label string, t string, row_in string"


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF, "documents")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, a very long one, ties, repeated rows, clashing names."""
    prepare(spark)
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    passage = " ".join(word() for _ in range(120))
    texts = {1: None, 2: "", 3: " \n\t ", 4: " ".join(word() for _ in range(30_000)), 5: passage,
             6: passage, 7: word() + " " + passage + " " + word(), 8: "12 34 %%", 9: "one two",
             10: "é" * 700, None: "no id at all", 11: passage + passage}
    rows = [(i, t, "en" if i != 9 else None, "x", 1, "y", "z", "w") for i, t in texts.items()]
    return spark.createDataFrame(rows + [rows[4], rows[4], rows[0]], SCHEMA)
