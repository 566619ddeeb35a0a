"""Small documents with every awkward case, and results by brute force."""

import random
import re

import pytest

CLASHES = "kept string, keep_id string, shard string, slot string, bucket string, rep string, digest string, key string, n string, row string, part string, region string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(int(seed))
    return " ".join(rng.choice("the of and to in that is was he for it with as his on be at by this had not are but".split()) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="session")
def cases():
    long_text = prose(1, 30_000)
    base = prose(2, 300)
    shared = prose(3, 60)
    near = base.split()
    near[150] = "changed"
    shift = base.split()
    shift[10] = shift[200] = "other"
    return [
        (1, base), (2, None), (3, ""), (4, " \t\n "), (5, base), (5, base), (6, " ".join(near)), (7, base.upper()),
        (8, " ".join(shift)), (None, base), (None, None), (9, long_text), (10, long_text.replace("the1 ", "the1  ", 1)),
        (11, prose(4, 80) + "\n" + shared), (12, shared + " " + prose(5, 80)), (13, prose(6, 40) + " " + shared + " end."),
        (14, "one two three"), (15, "One two\tthree"), (16, "word"), (17, "a a a a a a a a a a a a a a a a a a a a"),
        (18, "ünï cödé 中文字 🎉 naïve"), (19, "a b c d"), (20, prose(4, 80) + "\n" + shared), (-3, shared),
        (21, "x" * 5000), (22, "b a a a a a a a a a a a a a a a a a a a a a"),
    ]


@pytest.fixture(scope="session")
def docs(spark, cases):
    """The cases with columns whose names the operators use inside."""
    names = [c.split()[0] for c in CLASHES.split(", ")]
    return spark.createDataFrame(
        [(i, t, "en", ["a", None, "b"][k % 3], *["clash"] * len(names)) for k, (i, t) in enumerate(cases)],
        "doc_id long, text string, lang string, source string, " + CLASHES,
    ).repartition(3)


def split_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def by_key(rows):
    return sorted((tuple("" if v is None else v for v in r) for r in rows), key=repr)
