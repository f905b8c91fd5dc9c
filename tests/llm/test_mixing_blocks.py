"""The state of the fit lies in blocks, so that a round costs little beside the classifier."""

import numpy as np

from ledgerlens.llm import mixing as M


def test_state_in_blocks(spark):
    rng = np.random.default_rng(3)
    q, tokens = rng.dirichlet(np.full(3, 0.5), 5000), rng.integers(0, 300, 5000)
    rows = spark.createDataFrame([(int(n), [float(v) for v in x]) for n, x in zip(tokens, q, strict=True)], "n long, q array<double>").repartition(4)
    state = M._packed(rows, M.Params(block=700))
    blocks = state.collect()
    sizes = [len(b["n"]) // 8 for b in blocks]
    assert sum(sizes) == 5000 and max(sizes) <= 700 and len(sizes) <= 4 * (1 + 1250 // 350) and state.rdd.getNumPartitions() <= 4
    back = {(n, *x) for b in blocks for n, x in zip(np.frombuffer(b["n"]), np.frombuffer(b["q"]).reshape(-1, 3), strict=True)}
    assert back == {(float(n), *x) for n, x in zip(tokens, q, strict=True)}
    first, _, *gram = M._totals(state, [], 0, 3, gram=True)
    assert np.allclose(first, tokens @ q) and np.allclose(gram, (q * tokens[:, None]).T @ q)
    step = [np.array([1.5, -0.5, 0.2]), np.array([0.3, 0.1, -0.4])]
    want, look = M.rates(q, step)
    assert (want == 0).any() and np.allclose(M._totals(state, step, 0, 3), [(tokens * want) @ q, (tokens * look) @ q])
    after = M._written(state, step, 0, 3)
    more = [*step, np.array([-0.2, 0.1, 0.1])]
    assert np.allclose(M._totals(after, more, 2, 3)[0], (tokens * M.rates(q, more)[0]) @ q)
    assert M._totals(M._packed(rows.limit(0), M.Params()), [], 0, 3).sum() == 0
