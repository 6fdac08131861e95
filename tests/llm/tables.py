"""Small awkward tables for the corpus operators."""

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau "
         "upsilon phi chi psi omega").split()


def prose(n: int, seed: int = 0) -> str:
    state, out = seed * 7919 + 17, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state >> 8 & 15] + str(state >> 16 & 63))
    return " ".join(out)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, `a.b` int, fp long"


def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, columns with clashing names."""
    shared = prose(80, 99)
    texts = [
        (0, prose(120)), (1, prose(120)), (2, None), (3, ""), (4, "   \n\t"), (5, "one"), (6, "One two"),
        (7, prose(60, 7) + " " + shared), (8, prose(70, 8) + "\n" + shared + " " + prose(20, 9)), (None, prose(30, 3)),
        (10, "ÄÖ ü ñ 日本語 🙂 \x00 end"), (11, "x" * 5000), (12, prose(3000, 12)), (12, prose(3000, 12)), (13, "You IDIOT moron"),
    ]
    rows = [(i, t, "en", None, len(t) if t else None, 0.5, 1, 2) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
