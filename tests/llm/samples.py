import random

WORDS = [a + b + c for a in ("th", "er", "on", "in", "re") for b in ("a", "e", "ou", "i") for c in ("", "n", "ing", "tion", "s")]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))
