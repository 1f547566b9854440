import random

import pytest

WORDS = "the of and a to in loser tion ing que der die la xyz ana bor cul dem".split()


def sentence(rng, n, words=WORDS):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture
def made_documents(spark):
    """Documents that repeat one another in many ways; with NULLs, empty texts, ties and further
    columns of awkward names."""

    def make(seed=0, n=60, unique=False):
        rng = random.Random(seed)
        words = [f"w{i}" for i in range(4000)] if unique else WORDS
        passages = [sentence(rng, k, words) for k in (5, 13, 14, 40, 200)]
        rows = []
        for i in range(n):
            parts = [sentence(rng, rng.choice([0, 3, 20, 60]), words)]
            for _ in range(rng.randrange(3)):
                parts += [rng.choice(passages), sentence(rng, rng.randrange(12), words)]
            text = rng.choice([" ", "\n", "  ", "\t"]).join(parts)
            rows.append((i, text))
        rows += [(1000 + i, rows[i % 7][1]) for i in range(10)]
        rows += [(2000, None), (2001, ""), (2002, " \n\t "), (2003, "the " * 50), (2004, "the " * 90)]
        rows += [(2005, "ab ba " * 40), (2006, "ba ab " * 33), rows[3], (None, rows[4][1])]
        rows += [(2007, sentence(rng, 5000, words) + " " + passages[4]), (2008, "été über \x1c x " * 9)]
        rng.shuffle(rows)
        data = [(d, t, "en", f"s{k}", None if t is None else len(t), k) for k, (d, t) in enumerate(rows)]
        return spark.createDataFrame(
            data, "doc_id long, text string, lang string, source string, n_chars long, block int"
        )

    return make
