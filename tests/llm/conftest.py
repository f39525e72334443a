import random

import pytest

# names that the operators use inside
CLASHING = ["bucket", "rep", "found", "key", "digest", "place", "run", "n", "lang_pred"]
SCHEMA = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASHING)


@pytest.fixture(scope="session")
def frame(spark):
    """(doc_id, text[, lang]) rows as a table with extra columns of clashing names."""
    def make(rows, parts=3):
        data = [(r[0], r[1], r[2] if len(r) > 2 else None, *["x"] * len(CLASHING)) for r in rows]
        return spark.createDataFrame(data, SCHEMA).repartition(parts)
    return make


def corpus(seed=1, n=60):
    """Documents with exact and near copies, shared passages, edge cases and one very long text."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "ÜBER", "naïve", "ABC", "x.", "😀"]

    def words(k):
        return [r.choice(vocabulary) for _ in range(k)]
    passage = words(40)
    texts = []
    for i in range(n):
        own = words(r.choice([0, 1, 4, 5, 12, 13, 14, 30, 80, 200]))
        if i % 4 == 0:
            own[len(own) // 2:len(own) // 2] = passage
        if texts and i % 3 == 0:
            own = r.choice(texts).split()
            for _ in range(r.choice([0, 0, 1, 2, 5])):
                if own:
                    own[r.randrange(len(own))] = r.choice(vocabulary)
        texts.append(r.choice([" ", "  ", "\n", "\t"]).join(own))
    texts += [None, "", " \n\t", "one", "  one ", "\n".join(["line a", "line b", "line c"] * 30), " ".join(words(30000))]
    texts += [texts[4]] * 12 + [" ".join(passage)] * 3
    return list(enumerate(texts, start=-5))


@pytest.fixture(scope="session")
def rows():
    return corpus()
