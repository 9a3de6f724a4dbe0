"""Small documents with everything that goes wrong in real ones."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_words bigint, spans string, score double, id string, n bigint, h bigint, size bigint"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 7))) for _ in range(n)]


def texts(seed: int = 3) -> list[str | None]:
    rng = random.Random(seed)
    base = [words(rng, n) for n in (3, 4, 5, 30, 60, 120, 200, 400)]
    passage = words(rng, 70)
    out: list[str | None] = [None, None, "", "", " \n\t ", "one", "One", "one two three", "ONE  two\nthree"]
    out += [" ".join(b) for b in base] + [" ".join(base[5]), " ".join(base[5]).upper()]
    for b in base[3:]:
        for rate in (0.01, 0.03, 0.1):
            out.append(" ".join(rng.choice(words(rng, 3)) if rng.random() < rate else w for w in b))
    for _ in range(6):
        a, b = words(rng, rng.randint(5, 80)), words(rng, rng.randint(5, 80))
        out.append(" ".join(a + passage + b))
    out.append(" ".join(base[4] + base[4]))
    out.append("the " * 300)
    out.append("the " * 180 + " ".join(base[3]))
    out.append(" ".join(words(rng, 20_000)))
    return out


def documents(spark, rows: list[str | None] | None = None, first: int = 0):
    """A table of texts whose other columns have the names that operators use inside."""
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(first + i, t, "en", "src1", 1, "x", 0.5, "y", 2, 3, 4) for i, t in enumerate(rows)], SCHEMA)
