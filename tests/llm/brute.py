"""Plain re-statements of what the text operators compute, for small inputs."""

import collections
import hashlib
import re
import zlib

import numpy as np
import xxhash

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def exact_groups(docs):
    """doc_id -> (keep_id, group_size, kept, sha) for distinct ids."""
    groups = collections.defaultdict(list)
    for d, t in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d))
    out = {}
    for body, members in groups.items():
        keep = min(members)[1]
        for _, d in members:
            out[d] = (keep, len(members), d == keep, hashlib.sha256(body.encode()).hexdigest())
    return out


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=2):
    """doc_id -> smallest doc_id reachable, for a dict doc_id -> fingerprint."""
    ids = sorted(prints)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def repeats(docs, length=400):
    """doc_id -> (bytes, removed, runs, kept bytes)."""
    seen = collections.Counter()
    texts = [(d, (t or "").encode()) for d, t in docs]
    for _, t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] += 1
    out = {}
    for d, t in texts:
        mark = np.zeros(len(t) + 1, np.int8)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                mark[i:i + length] = 1
        kept = bytes(b for b, m in zip(t, mark) if not m)
        out[d] = (len(t), int(mark.sum()), int((np.diff(np.concatenate([[0], mark])) == 1).sum()), kept)
    return out


def passages(docs, words, length=400):
    """doc_id -> text without what ``length`` bytes or as many words cover that are met again."""
    texts = {d: (t or "").encode() for d, t in docs}
    place = {d: [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)] for d, t in texts.items()}
    found = collections.defaultdict(list)
    for d, t in texts.items():
        for i in range(len(t) - length + 1):
            found[t[i:i + length]].append((d, i, i + length))
        for i in range(len(place[d]) - words + 1 if words else 0):
            spans = place[d][i:i + words]
            found[b" ".join(t[a:b] for a, b in spans), "words"].append((d, spans[0][0], spans[-1][1]))
    mark = {d: np.zeros(len(t), bool) for d, t in texts.items()}
    for d, a, b in (x for xs in found.values() if len(xs) > 1 for x in xs):
        mark[d][a:b] = True
    return {d: bytes(np.frombuffer(t, np.uint8)[~mark[d]]).decode(errors="ignore") for d, t in texts.items()}


def edited(docs):
    """doc_id -> edited text, over the documents in ascending doc_id order."""
    docs = sorted((d, t or "") for d, t in docs)
    out = {}
    for i, (d, t) in enumerate(docs):
        half = len(t) // 2
        out[d] = t[:len(t) - half] + docs[(i + 1) % len(docs)][1][:half]
    return out


def planted(doc_id, words):
    """The words with a periodic tail, for one id in ten."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def periodic(words):
    """Runs (start, length, period) by comparing all words at every distance."""
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    best, a = {}, np.array([code[w] for w in words], np.int64)
    for q in range(1, len(words) // 2 + 1):
        change = np.diff(np.concatenate([[0], (a[q:] == a[:-q]).astype(np.int8), [0]]))
        for i, j in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()):
            if j - i + q >= max(12, 2 * q):
                best.setdefault((i, j - i + q), q)
    return sorted((s, n, q) for (s, n), q in best.items())


def run_row(doc_id, text):
    """n_runs, the longest run, and the two digests of op11."""
    words = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = periodic(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2], sha(lines), sha(kept))


def divergence(docs, top=200):
    """Rows of op12 from (lang, source, text)."""
    holding, uses, seen = collections.Counter(), collections.Counter(), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        seen.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        holding.update({(lang, t) for t in terms})
        uses.update((lang, source, t) for t in terms)
    out = set()
    for lang in {g[0] for g in seen}:
        kept = sorted((t for g, t in holding if g == lang and holding[g, t] >= 3), key=str.encode)
        sources = sorted(s for g, s in seen if g == lang)
        count = {s: {t: uses[lang, s, t] for t in kept} for s in sources}
        count[None] = {t: sum(count[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (c + 1) // (sum(of.values()) + len(kept)) for t, c in of.items()}
             for s, of in count.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            terms = sorted((-f(p[s][t], p[None][t]), t.encode(), t) for t in kept
                           if count[s][t] and p[s][t] > p[None][t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, x, -v, i + 1) for i, (v, _, x) in enumerate(found)}
    return out


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(grams)
    again = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(again))
