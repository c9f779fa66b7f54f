"""Made-up texts."""

from __future__ import annotations

import random


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}{rng.choice(['', ',', '.'])}" for _ in range(n))
