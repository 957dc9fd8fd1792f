"""Invented texts for the tests of the training-data operators."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, size=400):
    """n words of an invented vocabulary."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("w" + format((x >> 8) % size, "x"))
    return out


def prose(n, seed, sentence=9):
    w = words(n, seed, 4000)
    return " ".join(" ".join(w[i:i + sentence]).capitalize() + "." for i in range(0, n, sentence))
