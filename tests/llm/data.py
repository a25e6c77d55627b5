"""Small tables with the odd cases that every operator must stand."""

import random

LONG = 60_000


def odd_documents(seed=1):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 5)))
    rows = [(i, " ".join(word() for _ in range(draw.randint(0, 150)))) for i in range(40)]
    long = " ".join(word() for _ in range(LONG // 4))
    rows += [
        (100, None),
        (101, ""),
        (102, " \n\t "),
        (103, "one"),
        (104, "Ünï çödé ​ text\x1c with　odd spaces\x85and <|endoftext|> marks 漢字 😀"),
        (105, long),
        (106, long[: len(long) // 2] + " tail of another kind"),
        (107, rows[3][1]),
        (107, rows[3][1]),
        (108, "same same same same same same same same same same " * 30),
        (109, "line one is here\nline two\nline one is here\n" * 20),
        (None, "a row without an id"),
        (None, None),
    ]
    return rows


CLASHING = "score double, kept string, row_key int, spans int, rank int, n int, hot int, `rest` int"


def documents(spark, rows=None, clash=True):
    df = spark.createDataFrame(odd_documents() if rows is None else rows, "doc_id long, text string")
    if not clash:
        return df
    from pyspark.sql import functions as F

    extra = {p.split()[0].strip("`"): F.lit(None).cast(p.split()[1]) for p in CLASHING.split(", ")}
    return df.withColumns(extra)
