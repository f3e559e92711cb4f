import random

import pytest

WORDS = [f"w{i}" for i in range(40)] + ["The", "of", "and", "Ünd", "que"]


def make_texts(seed=3):
    """Texts with exact copies, near copies, shared passages, repeated lines, and odd ones."""
    r = random.Random(seed)
    say = lambda n: " ".join(r.choice(WORDS) + str(r.randrange(9)) for _ in range(n))
    passage, line = say(70), say(12)
    base = "\n".join([say(40), line, say(60), say(30)])
    out = [base, base, "", None, "  \t\n ", "one", "one two", "a a a a " * 60, base.replace(" ", "\t", 3)]
    for k in range(6):
        w = base.split(" ")
        w[10 + 7 * k] = f"edit{k}"
        out.append(" ".join(w))
    out += [f"{say(20)} {passage} {say(15 + k)}\n{line}" for k in range(5)]
    out += [say(r.randrange(5, 120)) for _ in range(14)]
    out += ["x" * 3000, "\n\n", line, line + " extra"]
    return out


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with missing and repeated ids, repeated rows and columns whose names operators use inside."""
    texts = make_texts()
    rows = [(i, t, "en", "s", len(t or ""), 1.0, "x", 7) for i, t in enumerate(texts)]
    rows += [rows[0], rows[12], (5, "another text under id five", "de", None, None, None, None, None), (None, texts[0], None, "s", 3, 0.0, "y", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, tag string, row int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("1 = 0")
