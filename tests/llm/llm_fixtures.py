"""Rows and texts of the operator tests."""
import random


def make_texts(seed: int, n: int, words: int = 60) -> list[str]:
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    return [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(5, words))) for _ in range(n)]


#: Rows of every shape: null and empty texts, blanks, ties, repeated rows, a null id.
AWKWARD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (4, "one"), (5, "One"), (None, "one two three four five six"),
           (6, "é ß ½ 一 🙂  x y\n\nz "), (7, "long " * 30_000), (8, "x" * 200_000), (-9, "negative id here")]
