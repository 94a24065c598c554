"""Texts for tests."""

import random


def prose(seed, n, words=400):
    r = random.Random(seed)
    return " ".join("w" + format(r.randrange(words * 40), "x") for _ in range(n))
