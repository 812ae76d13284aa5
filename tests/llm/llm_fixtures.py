"""Small tables with every odd row the operators must stand: nulls, blanks, repeats, ties, clashing columns."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, _row bigint, part int, node bigint, bucket int, block int, label string, kept string"


def documents(spark, seed=0, n=120):
    draw = random.Random(seed)
    words = [draw.choice("bcdfgh") + draw.choice("aeiou") + draw.choice(["n", "rt", "é", "ß,", "st."]) for _ in range(400)]
    passage = " ".join(draw.choice(words) for _ in range(60))
    rows = []
    for i in range(n):
        parts = [" ".join(draw.choice(words) for _ in range(draw.choice([3, 12, 40, 90]))) for _ in range(draw.choice([1, 2, 4]))]
        text = "\n".join(parts)
        kind = i % 12
        if kind == 1 and rows:
            text = rows[-1][1]
        elif kind == 2 and rows:
            text = (rows[-1][1] or "") + " " + draw.choice(words)
        elif kind == 3:
            text = f"{text}\n{passage}\n{text[:40]}"
        elif kind == 4:
            text = "\n".join(parts[:1] * 5)
        elif kind == 5:
            text = " ".join(f"{w}###" for w in text.split())
        elif kind == 6:
            text = draw.choice([None, "", "  \n\t ", "Released under the MIT License.", "one two"])
        rows.append((i * 7 % 1000, text, draw.choice(["en", "de", None]), draw.choice(["a", "b", "c", "hot", "hot", "hot", None]), len(text or "")))
    rows += [rows[3], rows[3], (None, passage, None, None, None), (None, None, None, None, None), (5000, "long " * 30000, "en", "hot", 1)]
    return spark.createDataFrame([(*r, 0.5, 1, 2, 3, 4, 5, "x", "y") for r in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def texts(df, *names):
    return [tuple(r[n] for n in names) for r in df.select(*names).collect()]
