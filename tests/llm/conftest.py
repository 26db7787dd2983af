import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words int, key string, rank int"


def sentence(rng, n, letters="etaoinshrdlu"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank and very long texts, ties, exact and near copies, repeated rows
    and ids, null ids, shared passages, license lines, odd white space and characters."""
    rng = random.Random(5)
    base = [sentence(rng, 120) for _ in range(12)]
    shared = sentence(rng, 60)
    long = sentence(rng, 30_000)
    texts = [None, "", " ", "\n\t ", "one", "One two", "a b c", *base, base[0], base[0], base[1].replace("e", "E", 1)]
    texts += [base[2] + " " + shared, shared + " " + base[3], base[4][:300] + " " + shared + " " + base[5], long, long + " end"]
    texts += [
        "Released under the MIT License. mit license, MIT\nlicense",
        "Licensed under the Apache License, Version 2.0. GNU General Public License general public license",
        "  double  spaces\tand\r\nlines é ñ 漢字 🙂 <|endoftext|> x y ",
        "same same same same " * 40,
    ]
    rows = [(i, t, ["en", "de", None][i % 3], ["src0", "src0", "src1", None][i % 4], None if t is None else len(t), i, "k", 1) for i, t in enumerate(texts)]
    rows.append((None, base[6], "en", "src0", 5, 0, None, None))
    rows.append((None, None, None, None, None, None, None, None))
    rows.append(rows[8])  # a repeated row
    rows.append((9, base[7], "en", "src0", 5, 0, None, None))  # a repeated id with another text
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    from quire.llm.batches import prepared

    return prepared(spark).createDataFrame(edge_rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark, edge_rows):
    rows = [(r[0], int(i % 2), int(i % 3 == 0)) for i, r in enumerate(edge_rows)] + [(1, None, None), (2, 1, 1), (2, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
