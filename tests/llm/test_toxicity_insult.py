import numpy as np

from tabforge.llm import toxicity


def _total(text):
    return toxicity.clause_scores(text, toxicity.seed_lexicon(), toxicity.full_grammar(), {})[0]


def test_insults_count_in_full_only_in_a_pattern():
    w, low = toxicity.SEED_WEIGHT, toxicity.SEED_WEIGHT * toxicity.ISOLATED
    assert np.isclose(_total("the film shows some trash there"), low)               # isolated
    assert np.isclose(_total("you are such an idiot"), 1.5 * w)                     # target, copula, insult
    assert np.isclose(_total("fine. idiot, go home"), w)                            # vocative
    assert np.isclose(_total("take some stupid trash out"), low + w)                # insult phrase
    assert np.isclose(_total("well, you absolute idiot"), 1.5 * w)                  # person right before
    assert np.isclose(_total("they saw a big trash bin"), 1.5 * low)                # a person, but no copula
    assert np.isclose(_total("you are. some trash"), low)                           # a clause ends the pattern
    assert _total("you are not an idiot") < _total("you are an idiot")


def test_full_grammar_equals_running_five_in_turn():
    parts = [toxicity.insult(), toxicity.negation(), toxicity.reported(), toxicity.target(), toxicity.threat()]
    machine, rng = toxicity.full_grammar(), np.random.default_rng(1)
    for _ in range(50):
        state, states = 0, [0] * 5
        for x in rng.choice(list(toxicity.SYMBOLS), 20):
            state, y, w = machine[state][x]
            v, z = 1.0, x
            for k, p in enumerate(parts):
                states[k], z, f = p[states[k]][z]
                v *= f
            assert (y, round(w, 12)) == (z, round(v, 12))
