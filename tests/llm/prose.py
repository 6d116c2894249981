import random

SYLLABLES = "in on ther and stion ere oua wh th reading ndle able esh orer".split()


def prose(seed, words, syllables=SYLLABLES):
    """Invented words, the same for the same seed."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(words))
