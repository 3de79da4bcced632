import math
import random
import re

from surgemark.operators import text


def brute_bm25(docs, queries, n):
    tok = lambda s: [w for w in re.sub(r"[^\w\s]", " ", s.lower()).split() if len(w) > 2]
    corpus = {d: tok(t) for d, t in docs}
    avg = sum(map(len, corpus.values())) / len(corpus)
    df = {}
    for words in corpus.values():
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    out = []
    for q, t in queries:
        scores = []
        for d, words in corpus.items():
            total = 0.0
            for w in tok(t):
                if w in df:
                    tf = words.count(w)
                    idf = math.log((len(corpus) - df[w] + 0.5) / (df[w] + 0.5) + 1)
                    total += idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(words) / avg))
            scores.append((-round(total, 9), d))
        out += [(q, d, rank) for rank, (s, d) in enumerate(sorted(scores)[:n], 1) if s < 0]
    return sorted(out)


def test_bm25_equals_brute_force(spark):
    rng = random.Random(8)
    vocab = ["the", "stream", "window", "Élan", "ab", "don't", "x_y", "anomaly", "spike", "café", "2024"]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 40))) + rng.choice(["", "!", " the, the"]))
            for i in range(60)]
    docs += [(60, docs[3][1]), (61, "")]
    queries = [(1, "the the spike"), (2, "élan café"), (3, "ab"), (4, "missing words window")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(queries, "query_id long, text string")
    for staged in (True, False):
        got = text.bm25(d, q, 7, staged=staged).collect()
        assert sorted((r.query_id, r.doc_id, r["rank"]) for r in got) == brute_bm25(docs, queries, 7)


def test_document_text_joins_columns(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert df.select(text.document_text(["x", "y", "z"]).alias("t")).first().t == "a  3"


def test_keyword_category(spark):
    rules = {"one": ["aa", "bb"], "two": ["cc", "aab"]}
    df = spark.createDataFrame([(1, "AA x bb"), (2, "aab cc"), (3, "zz"), (4, "aab")], "doc_id long, text string")
    got = {r.doc_id: (r.category, r.hits) for r in text.keyword_category(df, rules=rules, default="none").collect()}
    assert got == {1: ("one", 2), 2: ("two", 2), 3: ("none", 0), 4: ("one", 1)}


def test_keyword_category_equals_a_search_for_each_keyword(spark):
    rng = random.Random(5)
    rules = {c: ["".join(rng.choices("ab #", k=rng.randint(1, 4))) for _ in range(12)] for c in ("x", "y", "z")}
    rules["z"] += [rules["z"][0], rules["x"][0]]             # twice in one category, and in two
    texts = ["", None, "É ab#A", *("".join(rng.choices("abAB #é", k=rng.randint(1, 30))) for _ in range(200))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rule in (rules, {**rules, "y": ["", "ab"]}, {"x": [], "y": []}):
        for r in text.keyword_category(df, rules=rule, default="none").collect():
            hits = [sum(k in r.text.lower() for k in words) for words in rule.values()] if r.text is not None else [0]
            best = max(hits)
            assert r.category == (list(rule)[hits.index(best)] if best else "none")
            assert r.hits == (None if r.text is None else best)


def test_postings_meet_the_terms_by_document(spark):
    """A term that every document holds is not dealt to one task."""
    d = spark.createDataFrame([(i, "the window") for i in range(20)], "doc_id long, text string")
    q = spark.createDataFrame([(1, "the spike"), (2, "the window")], "query_id long, text string")
    found = text.bm25(d, q, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and "hashpartitioning(term" not in plan
    assert [(r.query_id, r.doc_id) for r in found.orderBy("query_id", "rank").collect()] == [
        (q, i) for q in (1, 2) for i in range(3)]
