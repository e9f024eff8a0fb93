"""Insults inside of long tokens."""

import random

import pytest

from corpusforge.llm import toxicity

CLEAN = "garden river window market village bridge summer winter letter number simple yellow orchard mountain station".split()


@pytest.fixture(scope="module")
def model():
    rng = random.Random(5)
    texts = [(" ".join(rng.choices(CLEAN, k=12)) + (f" {rng.choice(['grobnak', 'velthurk'])} today" if i % 3 == 0 else " today"), i % 3 == 0) for i in range(240)]
    return toxicity.fit([t for t, _ in texts], [y for _, y in texts])


@pytest.mark.parametrize("mark", ["/", "_", "-", ",", ""])
@pytest.mark.parametrize("insult", ["grobnak", "velthurk"])
@pytest.mark.parametrize("at", [1, 14, 27])
def test_insults_in_long_tokens(model, mark, insult, at):
    words = random.Random(at).choices(CLEAN, k=30)
    assert model.score([mark.join(words)])[0] < 0.5 < model.score([mark.join([*words[:at], insult, *words[at:]])])[0]


def test_windows_reach_the_end():
    for n in range(17, 80):
        s = "".join(chr(0x4E00 + i) for i in range(n))
        assert all(any(s[i : i + 13] in w for w in toxicity.windows(s)) for i in range(n - 12))
