import numpy as np

from veriledger.llm import gated_lm


def test_states_are_those_of_gated_recurrent_units():
    """Both gates and the candidate see the whole last state, unit by unit as the equations say."""
    size, source = gated_lm.HIDDEN, np.random.default_rng(5)
    share = np.full(gated_lm.SHORTLIST + 1, 1 / (gated_lm.SHORTLIST + 1))
    model = gated_lm.GatedModel.start(np.log(share))
    x, h = source.integers(0, gated_lm.SHORTLIST + 1, (4, 3)), source.normal(size=(3, size))
    fresh = np.zeros((4, 3), dtype=bool)
    fresh[2, 1] = True
    found = model.states(x, fresh, h.astype(np.float32))[-1]
    assert model.ug.shape == (size, 2 * size) and model.uh.shape == (size, size)

    def gate(number, word, old):
        return 1 / (1 + np.exp(-(model.eg[word][number] + sum(old[i] * model.ug[i][number] for i in range(size)))))

    for lane in range(3):
        old = h[lane]
        for t in range(4):
            old = np.zeros(size) if fresh[t, lane] else old
            word, new = x[t, lane], np.empty(size)
            reset = [gate(size + i, word, old) for i in range(size)]
            for j in range(size):
                inner = sum(reset[i] * old[i] * model.uh[i][j] for i in range(size))
                z = gate(j, word, old)
                new[j] = (1 - z) * old[j] + z * np.tanh(model.eh[word][j] + inner)
            assert np.allclose(found[t, lane], new, atol=1e-5)
            old = new


def test_each_unit_reaches_every_other():
    model = gated_lm.GatedModel.start(np.log(np.full(gated_lm.SHORTLIST + 1, 1 / (gated_lm.SHORTLIST + 1))))
    one, none = np.array([[7]]), np.array([[False]])
    at_rest = model.states(one, none, np.full((1, gated_lm.HIDDEN), 0.5, dtype=np.float32))[-1]
    for unit in range(gated_lm.HIDDEN):
        h = np.full((1, gated_lm.HIDDEN), 0.5, dtype=np.float32)
        h[0, unit] = 0.9
        assert (model.states(one, none, h)[-1] != at_rest).all()
