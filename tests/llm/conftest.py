from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()) + str(r.randint(0, 30)) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in each column, empty, blank, short and long texts, ties, repeated rows, one id with two texts."""
    base, other = words(1, 120), words(2, 90)
    near = base.replace(base.split()[60], "changed", 1)
    lines = "\n".join(words(10 + i, 12) for i in range(8))
    return [
        (1, base, "en", "a", len(base)),
        (2, base, "en", "a", len(base)),
        (3, near, "en", "b", len(near)),
        (4, other, None, "a", None),
        (4, other, None, "a", None),
        (5, None, "en", "a", None),
        (6, "", "en", "a", 0),
        (7, "  \n \t", "en", "a", 5),
        (8, "word", "en", None, 4),
        (None, words(3, 40), "en", "a", 1),
        (None, None, None, None, None),
        (9, words(4, 60), "en", "a", 1),
        (9, words(5, 60), "en", "a", 1),
        (10, words(6, 30_000), "en", "a", 1),
        (11, lines, "en", "b", 1),
        (12, words(7, 20) + "\n" + lines + "\n\n" + words(8, 20), "en", "b", 1),
        (13, "a" * 5000, "en", "b", 5000),
        (14, "naïve é日本 <|endoftext|> x\u0000y", "fr", "b", 1),
        (15, "idiot " + words(9, 30) + " idiot", "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns whose names the operators use themselves."""
    df = spark.createDataFrame(odd_rows(), DOCUMENTS).repartition(3)
    for name in ("id", "part", "idx", "score", "n", "doc", "version", "ranges", "word", "cls", "__text", "whole_text", "own_id", "own_0", "toxicity", "__lines", "line_count", "line", "rank", "spans", "items", "label", "h"):
        df = df.withColumn(name, df["lang"])
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
