import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, whole string, score string, body string"


@pytest.fixture(scope="session")
def messy():
    """(doc_id, text) rows: nulls, empty and blank texts, ties, repeated rows, copies with other white space, long texts."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Idiot", "Größe,", "été", "a", "...", "x|y"]
    base = [[rng.choice(words) for _ in range(n)] for n in (3, 5, 14, 30, 80, 80, 200, 3000)]
    rows = [(None, None), (None, ""), (1, None), (2, ""), (3, " \t\n"), (4, "123 456"), (5, "a"), (5, "a"), (5, "b c")]
    for i in range(10, 130):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 0, 1, 2, 5])):
            text[rng.randrange(len(text))] = rng.choice(words)
        if rng.random() < 0.3:
            text += rng.choice(base)[: rng.randint(1, 40)]
        rows.append((rng.choice([None, i, i, i, i, i, 20]), rng.choice([" ", "\n", "  ", "\t"]).join(text)))
    return rows


@pytest.fixture(scope="session")
def docs(spark, messy):
    """The rows as a table with further columns, some of them named like columns that operators make."""
    rows = [
        (d, t, ("en", "de", None)[i % 3], ("s1", "s10", "s2", None, "é")[i % 5], i, "x", None, "y")
        for i, (d, t) in enumerate(messy)
    ]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
