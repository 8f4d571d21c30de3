"""Small corpora for the tests of the text-corpus operators."""

import random

SYL = "the an in er on re ed nd ha to or ea ti as ng it is st en of te hi al ou le".split()


def words(rng, n):
    return ["".join(rng.choice(SYL) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def corpus(seed=1, n=40):
    """(doc_id, text) rows with copies, near copies, short, empty and null texts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        base = words(rng, rng.randint(3, 120))
        rows.append(" ".join(base))
        if i % 3 == 0:
            rows.append(" ".join(base).upper())
            for _ in range(3):
                near = list(base)
                for _ in range(max(1, len(base) // 25)):
                    near[rng.randrange(len(near))] = words(rng, 1)[0]
                rows.append(" ".join(near))
    rows += ["", None, "  \n\t ", "one", "One", "a b", "a  b", "a b c", "a b c d e", "a b c d e f"]
    rng.shuffle(rows)
    return list(enumerate(rows))
