"""A small corpus with every awkward case: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

PASSAGE = "This passage of well over fifty bytes stands in several of the documents, word for word."
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, copy int, fp string, shard long, doc int, version int, rate int, cdf int, block int, id int"


def texts(seed: int = 3, n: int = 40) -> list[tuple[int | None, str | None, str | None]]:
    rng = random.Random(seed)
    syllables = "an be ci do el fa gu hi jo ka lé mü ñi".split()

    def words(count):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(count))

    rows: list[tuple[int | None, str | None, str | None]] = []
    for i in range(n):
        body = words(rng.randint(12, 90))
        if i % 4 == 0:
            body = f"{body}\n{PASSAGE}\n{words(15)}"
        rows.append((i, body, "hot" if i % 3 == 0 else f"s{i % 5}"))
    rows += [(n + i, rows[1][1], "hot") for i in range(6)]  # exact copies
    rows += [(n + 6 + i, rows[2][1].replace("an", "na", 1) if rows[2][1] else None, "hot") for i in range(3)]  # near copies
    rows += [
        (100, None, "s1"),
        (101, "", "s1"),
        (102, " \n\t \r\n", "s1"),
        (103, "one", None),
        (104, "Ça va <|endoftext|> </s> ▁ \U0001f600  two  spaces\n\n漢字\x85x", "s2"),
        (105, words(9000), "s2"),  # long
        (106, "same same same same same same same same same same same same", "s2"),
        (107, "| a | b | # $ %\n| a | b | # $ %\n" * 6, "s2"),
        (108, "x" * 3000, "s2"),
        (None, rows[0][1], "hot"),
        (None, None, None),
        (5, rows[5][1], rows[5][2]),  # a repeated row
        (6, "another text under a key that is taken", "s1"),
    ]
    return rows


def documents(spark, rows=None):
    """The corpus with extra columns whose names the operators use themselves."""
    filled = [(i, t, "xx", s, len(t or ""), None, 7, "f", 1, 2, 3, 4, 5, 6, 8) for i, t, s in (texts() if rows is None else rows)]
    return spark.createDataFrame(filled, SCHEMA).repartition(3)


def collected(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)
