import random

import brute
import numpy as np
import pytest

from surgemark.llm import periodic
from surgemark.llm.common import table


def texts(rng):
    words = [str(rng.randrange(rng.choice([1, 2, 4, 40, 300]))) for _ in range(rng.randint(0, 160))]
    for _ in range(rng.randint(0, 4) if len(words) > 2 else 0):
        a, p = rng.randrange(len(words)), rng.randint(1, len(words) // 2)
        for i in range(a, rng.randint(a, len(words))):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_runs_of_small_texts(monkeypatch, rounds):
    monkeypatch.setattr(periodic, "ROUNDS", rounds)
    monkeypatch.setattr(periodic, "PAIRS", 50)
    rng = random.Random(rounds)
    for _ in range(60):
        docs = [texts(rng) for _ in range(rng.randint(1, 6))]
        code = {w: i for i, w in enumerate({w for d in docs for w in d})}
        words = np.array([code[w] for d in docs for w in d], np.int64)
        ends = np.cumsum([len(d) for d in docs], dtype=np.int64)
        assert list(periodic.find_runs(words, ends)) == [brute.periodic(d) for d in docs]


def test_long_periodic_texts_are_not_quadratic():
    n = 60_000
    for words, want in ((np.zeros(n, np.int64), (0, n, 1)), (np.arange(n) % (n // 2 - 1), (0, n, n // 2 - 1))):
        assert list(periodic.find_runs(words, np.array([n]))) == [[want]]
    # Each cut makes one more word single: the splitting goes step by step from the ends.
    chain = np.array([x for i in range(n // 2) for x in (i, max(i - 2, 0))])
    assert list(periodic.find_runs(chain, np.array([len(chain)]))) == [[]]


def test_query_equals_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: tuple(r)[1:] for r in periodic.run_report(docs).collect()}
    assert got == {r.doc_id: brute.run_row(r.doc_id, r.text) for r in docs.collect()}
    assert sum(v[0] > 0 for v in got.values()) > 15


def test_odd_rows(spark, make_docs, odd):
    docs = [*odd, (None, "a b " * 9), odd[6], (50, "x\x1cy " * 20), (60, "é ü " * 500)]
    got = sorted((tuple(r) for r in periodic.run_report(make_docs(docs)).collect()), key=repr)
    assert got == sorted(((d, *brute.run_row(d, t)) for d, t in docs), key=repr)
    assert periodic.run_report(make_docs([])).count() == 0


def test_operator_gives_runs_and_texts(spark, make_docs):
    row = periodic.periodic_runs(make_docs([(1, "x " + "a b c " * 4 + "y")])).first()
    assert [tuple(r) for r in row.runs] == [(1, 12, 3)] and bytes(row.collapsed) == b"x a b c y"
