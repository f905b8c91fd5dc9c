"""How many pairs the near-duplicate stage compares within one group of near copies."""

import random

from test_shingle_join import _components

from ledgerlens.llm import shingle_join as J


def _near_copies(count):
    """One text, and copies of it with one to three words changed: many of these are less alike than 0.8 to each other."""
    rnd = random.Random(11)
    base = [f"w{rnd.randrange(3000)}" for _ in range(150)]
    out = [base]
    for k in range(count):
        c = list(base)
        for j, at in enumerate(rnd.sample(range(len(base)), 1 + k % 3)):
            c[at] = f"n{k}x{j}"
        out.append(c)
    rnd.shuffle(out)
    return [" ".join(w) for w in out]


def test_pairs_of_a_group(spark, monkeypatch):
    """The pairs compared are a few for each member, not those of all members; the components are those of all pairs."""
    texts, compared, verified = _near_copies(400), [], J._verified

    def counted(pairs, *more):
        compared.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(J, "_verified", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(map(tuple, J.near_duplicates(docs).collect()))
    sets = [frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4)) for w in map(str.split, texts)]
    assert got == dict(enumerate(_components(texts, lambda i, j: 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])))))
    assert sum(compared) < 15 * len(texts)
