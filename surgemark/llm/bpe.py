"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

Text goes the way the tokenizer's file says: special tokens are cut out, the rest is put in
NFC, white space becomes a space, letters are lower-cased, and a pattern cuts words, which
end in a word-end mark. A word is then encoded exactly and in linear time:

* an Aho-Corasick automaton over all tokens finds, in one pass over the word, the tokens
  that start at each place;
* a pair (a, b) of tokens is compatible when merging their joined text gives back a, b;
* take the longest match that is compatible with the token before it, fall back to shorter
  ones, and step back where none fits, never to a place twice. The sequence found is the
  one that merging gives.

Words repeat, so a worker keeps the ids of the words it has met, up to a fixed number.

Odd input: a null text is an empty text and has no ids; any length works; rows repeated
with one doc_id give one row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from surgemark.llm.common import text_or_empty

WORD_END = "</w>"
MARK = "\U0010FFFF"            # the word end as one letter, for the automaton
WORDS_KEPT = 400_000          # words a Python worker remembers
PAIRS_KEPT = 500_000          # pairs of tokens in its compatibility table


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class WordEncoder:
    """Exact BPE of single words over a vocabulary and its ordered merges."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        import ahocorasick

        self.vocab = vocab
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.birth: dict[int, int] = {}           # the merge that makes a token; symbols: -1
        self.spines: tuple[dict, dict] = ({}, {})
        usable = {i for t, i in vocab.items() if len(t.removesuffix(WORD_END)) <= 1}
        self.birth.update((i, -1) for i in usable)
        for n, (left, right) in enumerate(merges):
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            self.rank.setdefault((a, b), n)
            # A token counts only if merging its own text ends in it.
            if made not in self.birth and a in usable and b in usable and self.apart(a, b, below=n):
                usable.add(made)
                self.parts[made], self.birth[made] = (a, b), n
        spelled = {}
        for text, i in vocab.items():
            if i in usable:
                spelled[text.removesuffix(WORD_END) + MARK if text.endswith(WORD_END) else text] = i
        machine = ahocorasick.Automaton()
        for text, i in spelled.items():
            machine.add_word(text, (len(text) - 1, i))
        machine.make_automaton()
        self.machine = machine
        self.size = {i: len(t) for t, i in spelled.items()}
        # The next shorter token that starts a token. None may end just before the mark.
        self.shorter = {
            i: next((spelled[t[:k]] for k in range(len(t) - 1 - (t[-1] == MARK), 0, -1) if t[:k] in spelled), None)
            for t, i in spelled.items()}
        self.fits: dict[tuple[int, int], bool] = {}

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts at one edge of a token while it is built, and the merge that ends each."""
        known = self.spines[side].get(token)
        if known is None:
            chain = [token]
            while chain[-1] in self.parts:
                chain.append(self.parts[chain[-1]][side])
            chain.reverse()
            ends = [self.birth[t] for t in chain[1:]] + [float("inf")]
            known = self.spines[side][token] = list(zip(chain, ends))
        return known

    def apart(self, a: int, b: int, below: float = float("inf")) -> bool:
        """Whether no merge joins the two across their seam before merge number ``below``.

        While both are built, the part at a's right edge meets the part at b's left edge. A
        merge of the two happens if it comes before the merge that ends either part; of
        equal merges the one further left is first.
        """
        left, right = self.spine(a, 1), self.spine(b, 0)
        i = j = 0
        while True:
            (x, x_end), (y, y_end) = left[i], right[j]
            n = self.rank.get((x, y))
            if n is not None and n < below and n < x_end and n <= y_end:
                return False
            if x_end == y_end == float("inf"):
                return True
            if x_end <= y_end:
                i += 1
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        """A new entry of the pair table: the tokens stay apart when their joined text is merged."""
        if len(self.fits) > PAIRS_KEPT:
            self.fits.clear()
        known = self.fits[a, b] = self.apart(a, b)
        return known

    def encode(self, body: str) -> list[int]:
        """Ids of one word in byte letters; the word end is understood."""
        n = len(body)
        # The longest token from each place; the mark belongs to the last letter.
        longest = [None] * (n + 1)
        for last, (back, token) in self.machine.iter(body + MARK):
            if last != n - 1:
                longest[last - back] = token
        size, shorter, fits, compatible = self.size, self.shorter, self.fits, self.compatible
        out: list[int] = []
        dead: set[int] = set()
        at, token = 0, longest[0]
        while at <= n:
            while token is not None:
                stop = at + size[token]
                if not out:
                    break
                fit = fits.get((out[-1], token))
                if (compatible(out[-1], token) if fit is None else fit) and stop not in dead:
                    break
                token = shorter[token]
            if token is None:
                # The text up to here has one encoding only, and it leads nowhere.
                dead.add(at)
                token = out.pop()
                at -= size[token]
                token = shorter[token]
            else:
                out.append(token)
                at = stop
                token = longest[at] if at <= n else None
        return out


class TextCodec:
    """Encode and decode whole texts as the tokenizer file prescribes."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in {**vocab, **self.special}.items()}
        self.words = WordEncoder(vocab, merges)
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, bytes] = {}
        # Decoding: the tokens' texts, each with the joining space, and where each begins.
        blob = [(names[i] + " ").encode() if i in names else b" " for i in range(max(names) + 1)]
        self.offset = np.concatenate([[0], np.cumsum([len(b) for b in blob])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(blob), dtype=np.uint8)

    def piece(self, piece: str) -> bytes:
        """Ids, little-endian, of a part of a text that is bounded by white space."""
        ids: list[int] = []
        for part in self.cut.split(piece) if self.cut and any(t in piece for t in self.special) else [piece]:
            if part in self.special:
                ids.append(self.special[part])
                continue
            if part.isascii():
                text = part.lower()
            else:
                # One letter at a time: lower-casing must not look at a letter's neighbours.
                text = "".join([c.lower() for c in unicodedata.normalize("NFC", part)])
            for word in self.pattern.findall(text):
                ids += self.words.encode(word.encode().decode("latin-1").translate(self.letters))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """All ids as little-endian unsigned 32-bit integers."""
        cache = self.cache
        pieces = text.replace("\n", " ").replace("\t", " ").split(" ")
        missing = list(set(pieces).difference(cache))
        cache.update((p, self.piece(p)) for p in missing)
        ids = b"".join(map(cache.__getitem__, pieces))
        # What comes early is common, so a full memory keeps what it has.
        for p in missing[:max(0, len(cache) - WORDS_KEPT)]:
            del cache[p]
        return ids

    @classmethod
    def of_worker(cls, path: str) -> "TextCodec":
        """The codec of this Python worker, which runs many tasks and keeps what it has met."""
        import ahocorasick

        kept = vars(ahocorasick).setdefault("_codecs_of_worker", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def decode(self, ids: bytes, block: int = 1 << 20) -> Iterator[bytes]:
        """The text of the ids, in bounded parts: gather each token's bytes by its offset."""
        all_ids = np.frombuffer(ids, dtype="<u4")
        for i in range(0, len(all_ids), block):
            part = all_ids[i:i + block]
            begin = self.offset[part]
            size = self.offset[part + 1] - begin
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)
            whole = self.blob[at].tobytes()
            yield whole[:-1] if i + block >= len(all_ids) else whole


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TextCodec.of_worker(tokenizer_path)
        for batch in batches:
            sizes, id_hash, text_hash = [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py())
                decoded = hashlib.sha256()
                for part in codec.decode(ids):
                    decoded.update(part)
                sizes.append(len(ids) // 4)
                id_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(id_hash, pa.string()),
                 pa.array(text_hash, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text").withColumn("text", text_or_empty())
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
