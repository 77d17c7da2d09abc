"""A small corpus with the awkward rows: nulls, empties, repeats, ties and columns whose names clash."""

import random

import pytest

EN = "the of and to in that it is was for on are as with his they at be this from have or by one had not but what all were when".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, h bigint, n int, key string, _score string, component string, _line_doc string, _tiling int, _key int"


def sentence(rng, base, n):
    return " ".join(rng.choice(base) + rng.choice(["", "", "ing", "ly", "er", "en"]) for _ in range(n))


def corpus():
    rng = random.Random(5)
    rows = []
    for i in range(60):
        lang, base = ("de", DE) if i % 3 == 0 else ("en", EN)
        rows.append([i, "\n".join(sentence(rng, base, rng.randint(8, 30)) for _ in range(rng.randint(1, 6))), lang])
    shared = sentence(rng, EN, 30)
    rows[7][1] += "\n" + shared
    rows[9][1] = shared + " " + rows[9][1]
    rows[20][1] = rows[10][1]
    rows[21][1:] = [rows[10][1].replace("\n", " ", 1), rows[10][2]]
    rows += [[100, None, "en"], [101, "", None], [102, " \t\n ", "de"], [None, rows[3][1], "en"], [None, None, None], [103, "ab", "en"], [104, "Ä ### ...", None], [105, "und " * 400, "de"], [106, "1234 5678", "en"]]
    rows += [[5, rows[5][1], "en"], [30, "another text under an id that is taken already", "en"]]
    rows += [[107, " ".join(sentence(rng, EN, 5) for _ in range(3000)), "en"]]
    return [(i, t, lang, "src", len(t or ""), 1, 2, "k", "s", "c", "d", 3, 4) for i, t, lang in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, 0 if i % 10 == 5 else 1, 0) for i in range(0, 60, 2)] + [(105, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def items(spark, rows):
    words = rows[7][1].split()
    passage = words[-30:]
    return spark.createDataFrame(
        [(1, " ".join(passage)), (2, " ".join(passage[15:] + passage[:15])), (3, "four words are few"), (4, None), (None, "x y z u v"), (1, " ".join(passage)), (5, "something that no document has said so far at all")],
        "item_id bigint, text string",
    )
