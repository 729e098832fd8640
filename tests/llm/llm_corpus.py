"""Invented text for the tests of this folder."""

import random

import pytest

_rnd = random.Random(5)
WORDS = ["".join(_rnd.choice("abcdefghij") for _ in range(_rnd.randint(2, 7))) for _ in range(400)]


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n): n words."""
    def make(seed: int, n: int) -> str:
        rnd = random.Random(seed)
        return " ".join(rnd.choice(WORDS) for _ in range(n))

    return make
