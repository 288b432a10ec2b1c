"""Small tables with the awkward cases that every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, id string, kept string"


def awkward_texts(seed: int = 7) -> list[str | None]:
    rng = random.Random(seed)
    vocab = [rng.choice("bcdfglmnprst") + rng.choice("aeiouéü") + rng.choice("nrstl") + str(i % 3) * (i % 2) for i in range(60)]
    words = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = words(120)
    near = base.split(" ")
    near[60] = "changed"
    long = words(9000)
    return [
        None, "", " ", "\n\t", "one", "one two", "ONE two", base, base, base.replace(" ", "  "), base.replace(" ", "\n"), " " + base, " ".join(near),
        base + " password = 'abcdef1' end", "secret=token: abcdef12", "api_key:\"x\" AKIA" + "Z9" * 8 + " " + "0a" * 12 + " tail", "PassWord:abcdefg passwd=abc",
        long, long + " x", long[:-1], "x" * 40000, ("line one is here\n" * 30), "a b c " * 100, words(49), words(50), " nbsp em " + words(60),
        "▁marked ▁▁ text  two  spaces ", "<|im_end|> and <|endoftext|> \x00 nul", "ſecret=abcdefgh toKen=abcdefgh \U0001f600 token=abcdefgh", "é" * 70 + " " + words(80),
        "-----BEGIN RSA PRIVATE KEY-----\nabc=\n-----END RSA PRIVATE KEY-----", "\r\n".join(words(5) for _ in range(20)),
        " \t" * 60_000 + words(60) + "\n " * 60_000 + "end" + "\x0b\x0c" * 60_000, "tokentoken" * 8_000 + " " * 50_000 + "x",
    ]


def awkward(spark):
    """Distinct ids in mixed order, nulls in every other column, extra columns with clashing names."""
    texts = awkward_texts()
    rows = [((k * 7) % 1009, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"src{k % 3}", None if t is None else len(t), "x", None, "z") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
