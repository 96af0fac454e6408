import random

import pytest

#: Names that the operators use inside.
CLASH = ["id", "kind", "bucket", "payload", "mark", "sig", "pair", "rep", "component", "rank", "value", "raw", "rest", "_n"]


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty, short, repeated, near and long texts, with columns of clashing names."""
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta,", "eta.", "Theta", "iota", "kappa"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))
    base = [text(60) for _ in range(6)]
    rows = []
    for i in range(40):
        t = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 9])):
            t[rng.randrange(len(t))] = text(1)
        rows.append((i, " ".join(t)))
    passage = text(30)
    rows += [(100 + i, f"{text(8)} {passage} {text(8)}") for i in range(10)]
    rows += [(200, None), (201, ""), (202, "   \n\t"), (203, "one"), (204, "one two"), (205, "One  TWO"), (206, text(4000)), (207, text(50)), (207, text(50)), (208, "same row"), (208, "same row"), (None, base[0]), (None, None)]
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, *range(len(CLASH))) for r in rows], "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in CLASH))


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
