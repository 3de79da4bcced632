import collections
import hashlib
import re

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from surgemark.llm import exact_dedup, fingerprints, graph, repeats, simhash


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("digest", [None, lambda body: F.length(body) % 3])
def test_exact_dedup_is_brute_force(make_docs, odd, digest):
    got = by_id(exact_dedup.exact_dedup(make_docs(odd), digest=digest))
    want = brute.exact_groups(odd)
    assert {d: (r.keep_id, r.group_size, r.kept, r.text_sha256) for d, r in got.items()} == want


def test_exact_dedup_rows_without_id_and_repeated_rows(make_docs):
    docs = make_docs([(5, "x y"), (5, "x y"), (None, "xy"), (2, "z"), (None, "q"), (None, "q")])
    out = exact_dedup.exact_dedup(docs).collect()
    assert len(out) == 6
    xy = [r for r in out if r.group_size == 3]
    assert len(xy) == 3 and {r.keep_id for r in xy} == {5} and sum(r.kept for r in xy) == 1
    assert sum(r.kept for r in out if r.doc_id is None and r.keep_id is None) == 1
    left = exact_dedup.exact_survivors(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == [(0, "q"), (2, "z"), (5, "x y")]


def test_exact_dedup_extreme_ids(make_docs):
    docs = [(-2**63, "a"), (2**63 - 1, "a "), (0, "b"), (2**63 - 1 - 5, "b")]
    assert {d: r.keep_id for d, r in by_id(exact_dedup.exact_dedup(make_docs(docs))).items()} == {
        d: v[0] for d, v in brute.exact_groups(docs).items()}


def test_exact_dedup_plan_is_native(make_docs, odd):
    plan = exact_dedup.exact_dedup(make_docs(odd))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_simhash_is_brute_force(make_docs, odd):
    got = by_id(simhash.near_duplicates(make_docs(odd)))
    prints = {d: brute.simhash(t) for d, t in odd}
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {d: r.component_id for d, r in got.items()} == brute.components(prints)


@pytest.mark.parametrize("tile", [3, 4096])
def test_links_join_what_lies_within_the_radius(spark, tile):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 12, dtype=np.uint64)
    prints = set(seeds.tolist()) | {0, 2**64 - 1, 1, 7}
    for s in list(prints):                       # chains of one and two flipped bits, and one of three
        for _ in range(6):
            s ^= 1 << int(rng.integers(64))
            prints.add(s)
            s ^= 1 << int(rng.integers(64))
            prints.add(s)
            prints.add(s ^ 7 << int(rng.integers(61)))
    prints = dict(enumerate(sorted(prints)))
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    nodes = spark.createDataFrame([(signed(p),) for p in prints.values()], "fp long")
    stars = {r.u: r.v for r in graph.components(simhash.links(nodes, tile=tile)).collect()}
    want = brute.components(prints)
    group = lambda pairs: sorted(sorted(g) for g in pairs.values())
    mine, theirs = {}, {}
    for i, p in prints.items():
        mine.setdefault(stars.get(signed(p), signed(p)), []).append(i)
        theirs.setdefault(want[i], []).append(i)
    assert group(mine) == group(theirs)


def test_a_hot_group_gives_few_links(spark):
    ring = sorted({a | b for a in (1 << i for i in range(20)) for b in (1 << j for j in range(20))})
    nodes = spark.createDataFrame([(x,) for x in ring], "fp long")
    found = simhash.links(nodes).collect()
    assert len(found) < 25 * len(ring) < len(ring) ** 2 / 4
    assert len({r.v for r in graph.components(spark.createDataFrame(found)).collect()}) == 1


def test_components_of_a_long_path(spark):
    links = spark.range(300).selectExpr("id as a", "id + 1 as b")
    out = graph.components(links).collect()
    assert {r.v for r in out} == {0} and len(out) == 300


def test_near_survivors(make_docs, odd):
    docs = make_docs([*odd, (None, "kept"), (None, "kept too"), (odd[6][0], odd[6][1])])
    left = simhash.near_survivors(docs)
    want = brute.components({d: brute.simhash(t) for d, t in odd})
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values())) and ids.count(None) == 2


def test_near_survivors_of_shared_and_missing_ids(make_docs):
    rng = np.random.default_rng(8)
    prose = lambda n=40: " ".join("".join(map(chr, rng.integers(97, 123, 5))) for _ in range(n))
    one_id, base, no_id, lone = [prose() for _ in range(12)], prose(), prose(), prose()
    docs = [*((5, t) for t in one_id),                            # one id, unrelated texts: all stay
            (1, base), (5, base.upper()), (7, base + " "),        # near copies: the smallest id stays
            (3, no_id), (None, no_id.upper()), (None, no_id + " "),
            (None, lone), (None, lone.upper()), (None, lone)]
    left = simhash.near_survivors(make_docs(docs))
    got = [(r.doc_id, r.text) for r in left.collect()]
    assert sorted((d, t) for d, t in got if d is not None) == sorted([*((5, t) for t in one_id), (1, base), (3, no_id)])
    (text,) = [t for d, t in got if d is None]
    assert text.lower() == lone and text == simhash.near_survivors(make_docs(docs[::-1])).where("doc_id is null").first().text


@pytest.mark.parametrize("bucket", [512, 2])
def test_repeats_are_brute_force(make_docs, odd, bucket, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", bucket)
    got = by_id(repeats.repeat_report(make_docs(odd)))
    want = brute.repeats(odd)
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == {
        d: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for d, w in want.items()}
    assert any(w[1] for w in want.values())


def test_repeats_across_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 700)
    rng = np.random.default_rng(1)
    text = "".join(map(chr, rng.integers(97, 123, 5000)))
    docs = [(1, text), (2, "x" * 333 + text[1200:3100] + "y"), (3, text[100:499]), (4, text[100:500])]
    got = by_id(repeats.repeat_report(make_docs(docs)))
    assert {d: (r.n_removed, r.n_spans) for d, r in got.items()} == {
        d: w[1:3] for d, w in brute.repeats(docs).items()}


def test_repeats_of_one_hot_passage(make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", 8)
    rng = np.random.default_rng(2)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage = word(700)
    docs = [(i, word(int(rng.integers(0, 300))) + passage + word(int(rng.integers(0, 300)))) for i in range(60)]
    got = by_id(repeats.repeat_report(make_docs(docs)))
    want = brute.repeats(docs)
    assert {d: (r.n_removed, r.n_spans) for d, r in got.items()} == {d: w[1:3] for d, w in want.items()}


def test_remove_repeats_keeps_rows_and_columns(make_docs, odd):
    docs = make_docs(odd)
    left = repeats.remove_repeats(docs)
    assert left.columns == docs.columns
    want = {d: w[3].decode(errors="ignore") for d, w in brute.repeats(odd).items()}
    for r in left.collect():
        text = dict(odd)[r.doc_id]
        assert r.text == (None if text is None else want[r.doc_id]) and r.digest == "x"
        assert r.n_chars == (None if text is None else len(r.text))


def test_short_passages_of_many_words_are_cut(make_docs):
    rng = np.random.default_rng(4)
    prose = lambda n: " ".join("".join(map(chr, rng.integers(97, 123, int(rng.integers(1, 8))))) for _ in range(n))
    long, short, hot = prose(51), prose(50), prose(60)
    assert max(map(len, (long, short, hot))) < 400
    docs = {1: f"{prose(40)} {long} {prose(9)}", 2: f"{prose(3)}\n{long}\n{prose(70)}", 3: f"{prose(20)} {short} {prose(20)}",
            4: f"{short} {prose(30)}", 5: long.replace(" ", "\n", 3), 6: None, 7: "", 8: "ab " * 120, 9: "ab " * 40}
    docs |= {i: f"{prose(int(rng.integers(0, 30)))} {hot} {prose(int(rng.integers(0, 30)))}" for i in range(10, 30)}
    left = by_id(repeats.remove_repeats(make_docs(docs.items()), words=51))
    for i in (1, 2):
        assert left[i].text == docs[i].replace(long, "")
    assert left[3].text == docs[3] and left[4].text == docs[4] and left[9].text == docs[9]
    assert left[5].text == left[7].text == "" and left[6].text is None and left[8].text.strip() == ""
    assert all(left[i].text == docs[i].replace(hot, "") for i in range(10, 30))
    whole = by_id(repeats.remove_repeats(make_docs(docs.items())))
    assert all(whole[i].text == docs[i] for i in docs)


def test_passages_and_repeats_are_brute_force(spark):
    """Real texts: what 400 bytes or 51 words cover that are met again, and no more."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute.passages(texts, 51)
    assert {d: r.text for d, r in by_id(repeats.remove_repeats(docs, words=51)).items()} == want
    assert want != brute.passages(texts, None)


def test_report_shows_what_is_left(spark, make_docs, odd):
    docs = [*odd, *[odd[13]] * 300, *[(900 + i, odd[12][1] + "x" * i) for i in range(3)]]
    want = brute.repeats(list({(d, t): (d, t) for d, t in docs}.values()) + [odd[13]])
    for r in repeats.repeat_report(make_docs(docs)).collect():
        n, removed, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.text) == (n, removed, spans, kept.decode(errors="ignore"))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_pipeline_cuts_every_passage_of_over_50_words(spark, make_docs):
    import corpus_pipeline

    rng = np.random.default_rng(6)
    word = lambda: "".join(map(chr, rng.integers(97, 123, int(rng.integers(2, 7)))))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(51)
    docs = {i: f"{prose(60)}\n{passage}\n{prose(60)}" for i in range(4)}
    left = by_id(dict(corpus_pipeline.STAGES)["suffix_array_dedup"](spark, make_docs(docs.items()), ""))
    assert len(passage) < 400 and all(left[i].text == docs[i].replace(passage, "") for i in docs)


def test_interval_tree():
    words = sorted(w.encode() for w in ["banana", "bandana", "ban", "band", "cab", "cabs"])
    lcp = [repeats.common_prefix(a, b) for a, b in zip(words, words[1:])]
    found = {(d, tuple(words[a:b + 1])) for d, a, b in repeats.intervals(lcp) if d}
    brute_force = set()
    for a in range(len(words)):
        for b in range(a + 1, len(words)):
            d = min(lcp[a:b])
            if d and (a == 0 or lcp[a - 1] < d) and (b == len(lcp) or lcp[b] < d):
                brute_force.add((d, tuple(words[a:b + 1])))
    assert found == brute_force


def test_groups_are_maximal_to_both_sides():
    rng = np.random.default_rng(7)
    for _ in range(40):
        rows = sorted({(bytes(rng.integers(97, 99, 6).tolist()), bytes(rng.integers(97, 99, 5).tolist())) for _ in range(14)})
        ahead, back = [a for a, _ in rows], [b for _, b in rows]
        n, common = len(rows), repeats.common_prefix
        want = set()
        for i in range(n):
            for j in range(i):
                d, r = common(ahead[i], ahead[j]), common(back[i], back[j])
                if d + r >= 5:
                    same = [k for k in range(n) if ahead[k][:d] == ahead[i][:d] and back[k][:r] == back[i][:r]]
                    want.add((d, r, tuple(same)))
        got = [(d, r, tuple(sorted(members[a:b + 1].tolist())))
               for d, members, groups in repeats.repeat_groups(ahead, back, 5) for r, a, b in groups]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("bucket", [512, 2])
def test_groups_hold_all_occurrences(make_docs, odd, bucket, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", bucket)
    docs = [*odd, *((900 + i, odd[12][1] + "x" * i) for i in range(4)), *((950 + i, odd[14][1]) for i in range(3))]
    texts = {d: (t or "").encode() for d, t in docs}
    groups = collections.defaultdict(set)
    for r in repeats.maximal_repeats(make_docs(docs)).occurrences().collect():
        groups[r.group1, r.group2, r.n_bytes].add((r.doc_id, r.start))
    held, places = set(), collections.defaultdict(set)
    for d, t in texts.items():
        for i in range(len(t) - 399):
            places[t[i:i + 400]].add((d, i))
    for (_, _, n), found in groups.items():
        assert n >= 400 and len(found) > 1 and len({texts[d][i:i + n] for d, i in found}) == 1
        d, i = min(found)
        for k in range(n - 399):
            if {(e, j + k) for e, j in found} == places[texts[d][i + k:i + k + 400]]:
                held.add(texts[d][i + k:i + k + 400])
    assert held == {w for w, where in places.items() if len(where) > 1}


def test_rows_of_one_id_and_text_are_read_once(make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", 2)
    rng = np.random.default_rng(12)
    base = "".join(map(chr, rng.integers(97, 123, 500)))
    docs = make_docs([*[(1, base)] * 3000, (2, base[:-1] + "!")])
    keyed = repeats._with_keys(docs).select("k1", "k2", "text")
    seen = repeats.classify(repeats.anchors(keyed, 400))
    wanted = seen.where("first and size > 1")
    assert repeats.contexts(keyed, wanted, 400).count() == wanted.count() > 0
    got = repeats.repeat_report(docs).groupBy("doc_id", "n_removed").count().collect()
    assert {(r.doc_id, r.n_removed, r["count"]) for r in got} == {(1, 500, 3000), (2, 499, 1)}


def test_fingerprints(make_docs, odd):
    out = by_id(fingerprints.edit_fingerprints(make_docs(odd), buckets=5))
    want = brute.edited(odd)
    assert {d: r.edited_sha256 for d, r in out.items()} == {
        d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}
    text = {d: t or "" for d, t in odd}
    assert all(r.n_chars == len(text[d]) for d, r in out.items())
    prints = {}
    for d, r in out.items():
        assert prints.setdefault(text[d], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) == (text[d] == want[d])
    assert len(set(prints.values())) == len(prints)
    assert out[odd[6][0]].near_next == 1          # followed by its copy


def test_fingerprints_are_homomorphic(spark):
    parts = ["first line of a text", "second line, longer than the first one", "third", "second line, longer than the first one"]
    whole = "\n".join(parts)
    texts = [(0, whole), (1, "\n".join(parts[::-1])), (2, parts[0]), (3, "\n".join(parts[1:])), (4, "other words\nthird")]
    df = spark.createDataFrame(texts, "id long, text string")
    v = {r.id: r.v for r in df.select("id", F.explode(fingerprints.pieces(F.col("text"))).alias("p")).groupBy("id").agg(
        fingerprints.lanes(fingerprints.counts(F.col("p"))).alias("v")).collect()}
    assert v[0] == v[1] != v[4] and len(v[0]) == fingerprints.LANES
    pair = spark.createDataFrame([(v[0], v[2], v[3])], "a array<long>, b array<long>, c array<long>")
    r = pair.select(fingerprints.add(F.col("b"), F.col("c")).alias("sum"),
                    fingerprints.subtract(F.col("a"), F.col("b")).alias("rest")).first()
    assert r["sum"] == v[0] and r["rest"] == v[3]


def test_fingerprints_of_repeated_rows_and_missing_ids(make_docs):
    docs = make_docs([(1, "a"), (1, "a"), (None, "zz zz"), (0, "b c d e f")])
    assert fingerprints.edit_fingerprints(docs, buckets=3).count() == 4
    plan = fingerprints.edit_fingerprints(docs, buckets=3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    lone = fingerprints.edit_fingerprints(make_docs([(4, "abcd")])).first()
    assert lone.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


@pytest.mark.parametrize("work", [
    exact_dedup.exact_dedup, exact_dedup.exact_survivors, simhash.near_duplicates, simhash.near_survivors,
    repeats.repeat_report, repeats.remove_repeats, fingerprints.edit_fingerprints])
def test_empty_table(make_docs, work):
    assert work(make_docs([])).count() == 0
