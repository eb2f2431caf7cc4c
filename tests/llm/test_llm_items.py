"""Operator 8 on items with short questions and on several shards of items."""

from __future__ import annotations

import pytest
from llm_cases import prose

from opsgrain.llm import decontaminate


def shingles_of(words):
    return [tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))]


@pytest.mark.parametrize("asked", [1, 2, 3, 4])
def test_items_with_short_questions(spark, asked):
    question, answer = prose(31, asked) + "?", prose(32, 12 - asked)
    short = " ".join(["Why"] * (asked - 1) + ["so?", *prose(33, 6 - asked).split()]) + "."
    words = decontaminate.words_of(f"{question} {answer}")
    last = " ".join([*words[:-1], "changed"])
    far = " ".join([*words[:-2], "changed", "twice"])
    docs = [(1, f"{prose(34, 40)} {question} {answer} {prose(35, 40)}"), (2, last), (3, far), (4, f"{prose(36, 9)} {short} {prose(37, 9)}")]
    items = spark.createDataFrame([(1, f"{question} {answer}."), (2, short)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (4, 2)}
    assert got[1, 1]["overlap"] == got[4, 2]["overlap"] == got[1, 1]["question_overlap"] == got[1, 1]["answer_overlap"] == 1
    assert got[2, 1]["overlap"] == pytest.approx(len(set(shingles_of(words)) & set(shingles_of(decontaminate.words_of(last)))) / len(set(shingles_of(words))))
