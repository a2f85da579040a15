"""Invented texts of the tests."""


def prose(seed, words, sentence=9):
    """Invented clean text: seeded words, sentences in lines."""
    import random
    draw = random.Random(seed)
    out = []
    for i in range(words):
        word = "".join(draw.choice(["ka", "lo", "mi", "ter", "an", "so", "ve", "ru", "ing", "de"]) for _ in range(draw.randint(1, 4)))
        out.append(word + (".\n" if i % sentence == sentence - 1 else ""))
    return " ".join(out).replace("\n ", "\n").strip()
