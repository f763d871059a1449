"""Inputs that every operator must take: nulls, empty and very long texts, repeated rows, clashing columns."""

import random

EXTRA = "n long, key string, node long, row string, h string, score double, part int, lang string"
SYLLABLES = ["an", "the", "or", "ti", "on", "re", "ed", "en", "sh", "ou", "al", "ic"]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = ["".join(r.choices(SYLLABLES, k=r.choice((1, 1, 2, 3)))) for _ in range(n)]
    return " ".join(w.capitalize() + "" if i % 12 == 0 else w + "." if i % 12 == 11 else w for i, w in enumerate(words))


ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, prose(5, 40)), (5, prose(5, 40)), (6, prose(5, 40)),
    (7, prose(7, 30_000)), (None, prose(8, 30)), (9, " éİ <|endoftext|> ▁ \0 日本 " + prose(9, 25)), (10, prose(10, 60)), (5, prose(11, 50)), (None, None),
]


def odd(spark, rows=ODD, more=EXTRA):
    """Rows with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 1, "k", 2, "r", "h", 0.5, 3, None) for i, t in rows], f"doc_id long, text string, {more}")


def none(spark):
    return odd(spark, [])


def plain(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")
