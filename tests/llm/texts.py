"""Awkward rows and generated prose."""

import random

#: Columns beyond those of documents, named like what the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, words string, "
          "node string, kept string, h string, n int, score string")


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def awkward_texts() -> list:
    base, other = prose(1, 120), prose(2, 90)
    near = base.split()
    near[50] = "changed"
    return [None, "", " \t\n ", "...", "one", "one two three", "One TWO three", base, base, base.upper(), " ".join(near),
            other + " " + base[:300], base[:300] + " " + other, "é " * 300, "a" * 900, "ab " * 400, prose(3, 20000), "x\x00y <|endoftext|> z",
            other, other, other + "!", "日本語のテキスト です", "İstanbul ǅ ß", prose(4, 5), prose(4, 5)]


def frame(spark, texts, ids=None, langs=None):
    ids = list(range(len(texts))) if ids is None else ids
    langs = ["xx"] * len(texts) if langs is None else langs
    return spark.createDataFrame([(i, t, g, "s", 0, 7, "w", "x", "k", "h", 1, "q") for i, t, g in zip(ids, texts, langs)], SCHEMA)
