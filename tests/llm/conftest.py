"""Small tables with every odd case, shared by the operator tests."""

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(draw, words, letters="abcdefghij"):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 9))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, copies and repeated rows."""
    draw = random.Random(11)
    base = prose(draw, 120)
    rows = [
        (None, "no id " + prose(draw, 60), "en", "s1", 10),
        (1, None, "en", "s1", None),
        (2, "", None, "s2", 0),
        (3, base, "en", None, len(base)),
        (4, base, "en", "s1", len(base)),
        (4, base, "en", "s1", len(base)),
        (5, base + " and more", None, "s2", None),
        (6, prose(draw, 60_000), "en", "s2", 1),
        (7, " \n\t ", "fr", "s3", 4),
        (8, "123 !!!", "fr", "s3", 7),
        (9, "x", "fr", "s3", 1),
    ]
    return rows + [(k, prose(draw, draw.randint(20, 200), "abcde" if k % 2 else "vwxyz"), "en" if k % 2 else "fr", f"s{k % 4}", 5) for k in range(10, 80)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with extra columns named like the operators' own."""
    extra = {"score": "'mine'", "spans": "1", "copies": "2", "n": "3", "task": "4", "rest": "5", "kept": "'k'", "digest": "6", "lang_pred": "'l'", "n_words": "7", "start": "8", "label": "9"}
    frame = spark.createDataFrame(odd_rows, DOCS).repartition(3)
    return frame.selectExpr("*", *[f"{v} AS `{c}`" for c, v in extra.items()]).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
