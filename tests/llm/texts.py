"""A small corpus with every hard case, and tables made from it."""

from __future__ import annotations

import random

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, `row` STRING, doc STRING, _row STRING, _key INT, _kept STRING, seed INT, first STRING"


def corpus(seed: int = 7) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "a", "café", "naïve", "don't", "x|y", "Ünï", "零", "..", "1,234", "end.", "#tag", "été,"] + ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(300)]
    words = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage = words(90)
    base = words(220)
    near = base.split(" ")
    near[100] = "changed"
    texts: list[str | None] = [None, "", " \t\n ", "one", "two words", base, base, " ".join(near), words(130) + " " + passage + " " + words(60), words(70) + "\n" + passage + "\n" + words(80), "a" * 900, "ab " * 400]
    texts += ["line here\n" * 40, words(50) + "\n\n  " + words(60) + "\r\nend", "x<|endoftext|>y THE<|ENDOFTEXT|>  z", "tab\tsep\x0bvt\x0cff", words(9000), "　 wide  space", "nul\x00byte " * 12, "é combining İstanbul ŉ " * 9]
    texts += [words(rng.randint(1, 300)) for _ in range(40)]
    rows: list[tuple[int | None, str | None]] = [(i * 3, t) for i, t in enumerate(texts)]
    return [*rows, (None, words(40)), (15, base), (15, base), (18, words(60))]


def table(spark, rows, partitions: int = 3):
    full = [(i, t, "en", "s", None if t is None else len(t), "r", "d", "_r", 1, "k", 2, "f") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions).checkpoint()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
