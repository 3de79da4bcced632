import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, row string, key1 int, fp string"


def rows(docs):
    return [(d, t, "en", None, None if t is None else len(t), "x", None, None, "y") for d, t in docs]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text), with other columns whose names operators use inside."""
    def make(docs, parts=3):
        return spark.createDataFrame(rows(docs), SCHEMA).repartition(parts)
    return make


@pytest.fixture(scope="session")
def odd():
    """Distinct ids; nulls, empty and blank texts, copies, near copies, shared passages, a long text."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(150), prose(90)
    base = prose(400)
    docs = [None, "", " \n\t ", "one", "Two words", "a b c", base, base, base + " ", base.upper(),
            base + " tail", passage, prose(30) + passage + prose(20), prose(5) + "\n" + passage[10:] + other,
            other + "\n" + other, "ab " * 600, "\x00\x1c\x85  x", "<|endoftext|> Σ ΑΣ. İ ́",
            "日本語 " * 200, prose(3000) + passage + prose(3000), "Released under the MIT License.", "a b c"]
    docs += [prose(rng.randint(1, 60)) for _ in range(20)]
    docs += [base.replace(" ", "  ", 1), base.replace("a", "b", 1), None]
    return [(3 * i - 7, t) for i, t in enumerate(docs)]
