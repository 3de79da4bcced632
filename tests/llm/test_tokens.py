import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from surgemark.llm import bpe, packing, token_files

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", "ing", "tion", " ", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "'s", "'LL", "Σ", "ΑΣ ",
         "İ", "ß", "é", "한", "ñ", "<|endoftext|>", "<|startoftext|>", "<|end", "!", "$$", "9", "½", "́", "​", "😀",
         "\r\n", "_", "ǅ", "qzx", "antidis", "er", "est", " \n", "\n "]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)] + [
        "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(1, 40))) for _ in range(n)]


def ids_of(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_encoder_equals_the_library():
    codec, library = bpe.TextCodec(WORD), Tokenizer.from_file(WORD)
    for text in texts(3000, 1):
        ids = codec.encode(text)
        assert ids == ids_of(library, text), ascii(text)
        decoded = library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert b"".join(codec.decode(ids, block=3)).decode() == decoded


def test_encoder_on_a_small_vocabulary():
    """All words over three letters against plain merging, with merges that mislead greedy matching."""
    from itertools import product

    merges = [("a", "b"), ("b", "c"), ("ab", "c</w>"), ("a", "bc"), ("c", "ab"), ("b", "b"), ("bb", "a"), ("a", "a"), ("aa", "a"), ("c", "c</w>")]
    symbols = [*"abc", *(x + "</w>" for x in "abc")]
    vocab = {t: i for i, t in enumerate([*symbols, *(a + b for a, b in merges)])}
    coder = bpe.WordEncoder(vocab, merges)
    for n in range(1, 8):
        for letters in product("abc", repeat=n):
            word = [*letters[:-1], letters[-1] + "</w>"]
            while True:
                ranked = [(merges.index(p), i) for i, p in enumerate(zip(word, word[1:])) if p in merges]
                if not ranked:
                    break
                _, i = min(ranked)
                word[i:i + 2] = [word[i] + word[i + 1]]
            assert coder.encode("".join(letters)) == [vocab[t] for t in word], letters


def test_round_trip_rows(make_docs, odd):
    library = Tokenizer.from_file(WORD)
    docs = [*odd, (odd[6][0], odd[6][1]), (None, "no id")]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                  for r in bpe.round_trip(make_docs(docs), WORD).collect()))
    want = []
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d is None, d or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.round_trip(make_docs([]), WORD).count() == 0


def test_piece_encoder_equals_the_library(monkeypatch):
    monkeypatch.setattr(token_files, "PIECES_KEPT", 300)
    coder, library = token_files.PieceEncoder(BYTE), Tokenizer.from_file(BYTE)
    given = texts(3000, 2)
    for text, ids in zip(given, coder.encode_all(given, together=50), strict=True):
        assert np.frombuffer(ids, coder.kind).astype("<u4").tobytes() == ids_of(library, text), ascii(text)


@pytest.mark.parametrize("sequence", [4, 2048])
def test_token_files(make_docs, odd, sequence, monkeypatch):
    monkeypatch.setattr(token_files, "BATCH", 3)
    library = Tokenizer.from_file(BYTE)
    docs = [*odd, (odd[6][0], odd[6][1]), (None, "no id"), (None, "")]
    files = token_files.write_files(make_docs(docs), BYTE, sequence=sequence, partitions=4)
    got = [tuple(r) for r in token_files.read_files(files).orderBy("start").collect()]
    want, at = [], 0
    for _, d, t in sorted((d is not None, d or 0, t or "") for d, t in docs):
        ids = ids_of(library, t) + bytes(4)
        want.append((at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert [g[1:] for g in got] == want
    assert [g[0] for g in got] == sorted((d for d, _ in docs), key=lambda d: (d is not None, d or 0))
    row = files.orderBy("part").first()
    system, path = token_files.filesystem(row["path"])
    import pyarrow as pa

    with pa.memory_map(path + ".arrow") as data:
        table = pa.ipc.open_file(data).read_all()
    assert table.schema.field("ids").type.list_size == sequence
    mask = table["mask"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    assert mask.sum() == row["n_tokens"] and (np.flatnonzero(~mask) >= row["n_tokens"]).all()


def test_token_files_of_nothing(make_docs):
    assert token_files.read_files(token_files.write_files(make_docs([]), BYTE)).count() == 0


def cheapest(lengths, permitted, overhead):
    best = [float("inf")]

    def go(i, bins):
        if i == len(lengths):
            best[0] = min(best[0], sum(next(p for p in permitted if p >= b) + overhead for b in bins))
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= permitted[-1]:
                go(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1:])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best[0]


def test_best_fit_is_near_the_optimum():
    rng, permitted, ratios = random.Random(4), (8, 16, 32), []
    for _ in range(150):
        lengths = sorted((rng.randint(1, 32) for _ in range(rng.randint(1, 7))), reverse=True)
        used = {}
        for (k, at), n in zip(packing.best_fit(lengths, permitted, 2), lengths):
            assert at == used.get(k, 0)
            used[k] = at + n
        cost = sum(next(p for p in permitted if p >= u) + 2 for u in used.values())
        ratios.append(cost / cheapest(lengths, permitted, 2))
    assert max(ratios) < 1.34 and sum(ratios) / len(ratios) < 1.02


@pytest.mark.parametrize("shard", [4, 8192])
def test_packing_places_every_piece_once(make_docs, odd, shard):
    docs = [*odd, (odd[6][0], odd[6][1]), (None, "no id")]
    permitted = (64, 128, 256)
    out = packing.pack(make_docs(docs), permitted=permitted, shard=shard).collect()
    import re

    want = []
    for d, t in docs:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1
        want += [(d is None, d or 0, i, i * 256, min(256, n - 256 * i)) for i in range(-(-n // 256))]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.n_tokens) for r in out) == sorted(want)
    bins = {}
    for r in out:
        bins.setdefault((r.bin_id, r.capacity), []).append((r.offset, r.n_tokens))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), held in bins.items():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert capacity == next(p for p in permitted if p >= at)
    assert packing.pack(make_docs([])).count() == 0
