"""Small tables with the awkward cases every operator has to bear."""

import random

DOC_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use themselves
    "doc string, size long, hash long, key string, n long, row int, at string, good_id long, fp long, keeper long"
)
LONG_LINE = "This very long line is found in many documents of the corpus today."


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def rows_of(spark, texts):
    """(doc_id, text, source) triples as a table with clashing extra columns."""
    rows = [(i, t, None, s, None if t is None else len(t), "x", 1, 2, "k", 3, 4, "a", 5, 6, 7) for i, t, s in texts]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def awkward(spark):
    rng = random.Random(5)
    shared = sentence(rng, 60)
    texts = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one", "b"), (5, f"{LONG_LINE}\n\nother", "a"),
        (6, f"  {LONG_LINE.upper()}\t\n{sentence(rng, 70)}", "a"), (7, f"{LONG_LINE}\n{LONG_LINE}", "b"),
        (8, f"x\n{LONG_LINE}\r\ny", None), (9, LONG_LINE, "c"), (10, f"tail\n{LONG_LINE}\nend\n{LONG_LINE}", "a"),
        (11, sentence(rng, 40) + " " + shared + " " + sentence(rng, 30), "a"),
        (12, sentence(rng, 20) + "\n" + shared + " " + sentence(rng, 50), "é"),
        (13, sentence(rng, 30_000), "b"), (14, "ÀÉ ß Ω İ " * 40, "b"),
        (15, sentence(rng, 80), "a"), (15, sentence(rng, 80), "a"), (None, LONG_LINE, "a"), (None, "null id", None),
        (16, "a" * 20_000, "c"), (17, "mail a.b@c.example.org, +1 (555) 123-4567, 4111 1111 1111 1111, 10.0.0.1", "c"),
    ]
    texts += [(20, texts[10][1], "a")] * 3
    return texts
