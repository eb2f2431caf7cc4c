"""Small tables with the cases that every operator must stand."""

from __future__ import annotations

import random

#: Extra columns whose names operators use themselves.
CLASHING = "loss double, fp string, hits int, score string, kept string, mean int, ids string, block int, n int"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

_RND = random.Random(11)
WORDS = ["".join(_RND.choices("abcdefghilmnoprstuvé", k=_RND.randint(2, 9))) for _ in range(400)]
LONG = " ".join(random.Random(12).choices(WORDS, k=30_000))


def prose(seed: int, n: int) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def edge_rows() -> list[tuple]:
    texts = [None, "", "   \n\t ", "One", LONG, prose(1, 60), prose(1, 60), prose(1, 60) + " tail", prose(2, 9), "<|endoftext|> a<|endoftext|>",
             "naïve ÀÉ 漢字 👍\u0000 x", "a b c d " * 60, "l1\nl1\n\n \nl2\nl1", prose(3, 300), "***!!! ### $$$"]
    rows = [(k, t, ["en", None, "de"][k % 3], ["s1", "s1", None][k % 3], None if t is None else len(t)) for k, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, prose(4, 40), None, None, None), (None, None, None, None, None)]


def edge_documents(spark):
    return spark.createDataFrame([r + (None,) * 9 for r in edge_rows()], f"{DOCUMENTS}, {CLASHING}")


def empty_documents(spark):
    return spark.createDataFrame([], f"{DOCUMENTS}, {CLASHING}")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
