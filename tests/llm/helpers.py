import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, sig long, n long, label string, class string, size long"


def corpus(spark, rows):
    """A documents table with columns whose names clash with the operators' own."""
    full = [(i, t, "en", s, len(t) if t is not None else None, 1, 2, "x", "y", 3) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def sentence(rng, n=8):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)).capitalize() + "."


def awkward(n=60):
    """Null, empty, blank, short, long, repeated and nearly repeated texts."""
    rng = random.Random(7)
    texts = [None, "", " \n\t", "One", "two words", "a b c d", "a b c d e", "A B C D E"]
    texts.append(" ".join(sentence(rng) for _ in range(2000)))
    for _ in range(n):
        base = [sentence(rng) for _ in range(rng.randint(3, 12))]
        texts.append(" ".join(base))
        if rng.random() < 0.5:
            words = " ".join(base).split()
            for _ in range(rng.choice([0, 1, 2])):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    rows = [(i, t, None if i % 11 == 0 else f"s{i % 3}" if i % 2 else "s0") for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[8], rows[-1]]  # repeated rows
