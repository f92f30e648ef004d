"""Small tables with every awkward case, for all operators."""

import random

WORDS = [a + b for a in "ka ne ti lo su ra mi po".split() for b in "ren dal mos vik tun".split()]

#: Names that operators use for columns of their own.
CLASHING = ("key", "label", "score", "words", "n", "row", "rank", "a", "b", "stray", "lead", "runs",
            "features", "probability", "host", "gone", "text_", "kept", "at", "h", "item", "node")


def sentence(seed, n=40):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(spark, texts, clashing=True):
    """``texts``: doc_id to text, or pairs."""
    rows = list(texts.items() if isinstance(texts, dict) else texts)
    names = CLASHING if clashing else ()
    return spark.createDataFrame(
        [(i, t, "en", "src", None if t is None else len(t), *["x"] * len(names)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long"
        + "".join(f", `{c}` string" for c in names))


def awkward():
    """Null, empty and blank texts, no doc_id, repeated rows, one very long text."""
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, sentence(1)), (5, sentence(1)),
            (6, sentence(1)), (7, sentence(2, 60_000)), (None, sentence(3)), (8, "ß 😀 \x00 é x"),
            (9, sentence(4) + " " + sentence(4))]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
