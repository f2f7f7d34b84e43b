"""Texts for the tests."""

WORDS = "the river runs down from old hills to a wide sea where small boats sail at dawn".split()


def sentence(seed: int, n: int = 9) -> str:
    words = (WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] + str(seed % 97) for i in range(n))
    return " ".join(words).capitalize() + "."


def prose(seed: int, n: int = 12) -> str:
    return " ".join(sentence(seed * 31 + k, 6 + (seed + k) % 7) for k in range(n))
