"""Odd documents and plain versions of the words."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the cat of the house and the dog in a garden is on the way to it with was for as by"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def alphanumeric(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def prose(seed, n):
    """``n`` words that depend on the seed."""
    common = PROSE.split()
    return " ".join(common[(seed * 7 + i * i) % len(common)] + str((seed * 131 + i * 17) % 9973) if i % 3 else common[i % len(common)] for i in range(n))


def odd_documents(spark):
    """Nulls in every column, empty, blank, one-word and very long texts, copies, repeated rows, and
    columns whose names operators use themselves."""
    texts = [
        (1, None), (2, ""), (3, " \n\t\r\x0b\x0c"), (4, "word"), (5, prose(5, 60_000)), (6, prose(6, 80)), (6, prose(6, 80)),
        (7, prose(6, 80).upper()), (8, prose(8, 50)), (None, prose(8, 50)), (None, None), (9, "é" * 3000), (10, "ß  a\nß  a\nß  a"),
        (11, prose(6, 79) + " end"), (12, prose(12, 200)),
    ]
    rows = [(d, t, None if i % 4 == 0 else "en", (None, "b", "a")[i % 3], None) for i, (d, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.selectExpr("*", "'x' AS kept", "1 AS size", "2 AS shard", "3L AS node", "'t' AS target", "0 AS copies", "5 AS n_words", "'l' AS labels")


def empty_documents(spark):
    return odd_documents(spark).limit(0)
