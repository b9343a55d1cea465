"""Small documents with the odd cases every operator has to take."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n long, id long, component string, "
    "ids string, length string, _row string, host string, word string, hash string, a string, b string, body string"
)
SYLLABLES = "an be co du el fi go ha in jo ka lu me no or pa qui ra so ta un va we xi yo ze".split()


def prose(seed, words, rng_words=4000):
    """Invented words; two seeds share no five-word run except by chance."""
    draw = random.Random(seed)
    pick = lambda: "".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 4)))
    return " ".join(pick() for _ in range(words))


def edited(text, seed, changes):
    draw = random.Random(seed)
    words = text.split(" ")
    for at in draw.sample(range(len(words)), changes):
        words[at] = f"changed{seed}x{at}"
    return " ".join(words)


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", 0, 7, 8, "c", "i", "l", "r", "h", "w", "x", "a", "b", "o")


def frame(spark, pairs):
    rows = [row(*p) for p in pairs]
    return spark.createDataFrame(rows, SCHEMA)


def odd():
    """Null, empty and blank texts, a very long one, repeated rows, a null key, a null language."""
    long_one = prose(99, 30_000)
    same = prose(7, 80)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, long_one), (5, same), (6, same), (6, same), (None, prose(8, 60)),
        (7, "one"), (8, "Ünï çødé 中文 🙂 ..."), (9, prose(9, 120), None), (10, None, None),
    ]
