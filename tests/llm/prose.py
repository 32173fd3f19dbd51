"""Invented texts for the tests."""

import random


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 8))) for _ in range(n))
