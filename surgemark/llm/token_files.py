"""Token ids in Arrow files of equal-length sequences, written and read in doc_id order.

The documents are dealt out in ranges of doc_id, each range is sorted, and the task of a
range writes one file in the shared folder while it encodes: the ids of its documents one
after the other, each ended by the end id, cut into sequences of ``SEQUENCE`` ids. A record
batch holds two fixed-size lists for each sequence, ``ids`` (in the narrowest unsigned type
that the vocabulary fits) and ``mask`` (bits; false marks the padding of the last sequence).
A second file lists the documents: doc_id, the place of their first id in the file and their
number of ids.

Both are in Arrow's file format, so sequence k lies in batch k // BATCH at row k % BATCH
and can be mapped into memory and read without copying or decoding. A file's name carries
the task attempt, and only the attempt that succeeded is listed, so a lost executor leaves
at worst an unlisted file behind.

Odd input: a null text is an empty text (only the end id); any length works; rows repeated
with one doc_id are all written, ordered by a hash of the text and the text; a null doc_id
comes first; malformed UTF-8 counts as U+FFFD; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from surgemark.llm.common import shuffle_partitions, text_or_empty
from surgemark.plans.staging import stage, stage_path

SEQUENCE = 2048               # ids in a sequence
BATCH = 256                   # sequences in a record batch
PIECES_KEPT = 1_000_000       # pieces of texts whose ids a Python worker remembers


# Fixed value: how the vocabulary's tokenizer cuts a text before it merges bytes.
PRE_TOKEN = regex.compile(r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
MARKS, CUT = " .,;:!?", "\x1f"
# Where a cut before a mark would not lie between pre-tokens, or the text holds the sign of a cut.
CROWDED = re.compile(
    r"[.,;:!?\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
    r"(?:(?<=\x1f)|(?<=\s)(?:(?=\s)|(?<=\s.))|(?<=[.,;:!?])(?<![^\W_].))", re.DOTALL)


class PieceEncoder:
    """The library's ids of whole texts, asking it once for each piece between two marks.

    A text's ids are those of its pre-tokens, one after the other. The cut is made here; a character is trusted once the library has been seen to cut around it in the
    same way, and texts with other characters, or with an added token, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        size = max(self.library.get_vocab().values()) + 1
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        space = self.library.encode(" ", add_special_tokens=False).tokens[0]
        self.spaced = np.zeros(size, bool)       # tokens that start with a space
        self.spaced[[i for t, i in self.library.get_vocab().items() if t.startswith(space)]] = True
        self.line = np.zeros(size, bool)
        self.line[self.library.encode("\n", add_special_tokens=False).ids] = True
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.trusted: set[str] = set()
        self.other: set[str] = set()
        self.ascii = all(map(self._cut_alike, map(chr, range(128))))

    def ask(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype=self.kind).tobytes()
                for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut_alike(self, char: str) -> bool:
        cut = self.library.pre_tokenizer.pre_tokenize_str
        tries = [before + char + after for before in ("", " ", "a", "1", ".") for after in ("", " ", "a", "1", ".", char + "a")]
        return all([b - a for _, (a, b) in cut(t)] == [len(x) for x in PRE_TOKEN.findall(t)] for t in tries)

    def plain(self, text: str) -> bool:
        """Whether the pattern cuts this text as the library does."""
        if not text.isascii() or not self.ascii:
            chars = set(text)
            for char in chars - self.trusted - self.other:
                (self.trusted if self._cut_alike(char) else self.other).add(char)
            if not self.trusted.issuperset(chars):
                return False
        return not any(t in text for t in self.added)

    def _learn_joined(self, pieces: list[str], joined: str, first: np.ndarray, skip: int) -> None:
        """Ids of pieces that the library gets in one text, where tokens of ``first`` start each."""
        ids = np.frombuffer(self.ask([joined])[0], self.kind)
        starts = np.flatnonzero(first[ids])
        if len(starts) != len(pieces):
            raise ValueError("the vocabulary joins pieces")
        ends = [*(starts[1:] * self.kind.itemsize).tolist(), ids.nbytes]
        data = ids.tobytes()
        self.known.update((p, data[a:b]) for p, a, b in zip(
            pieces, ((starts + skip) * self.kind.itemsize).tolist(), ends))

    def learn(self, pieces: list[str]) -> None:
        """Ids of new pieces. Those with a space before them follow each other in one text, those
        without white space go in lines of one text, and the few others on their own."""
        spaced, bare, other = [], [], []
        for p in pieces:
            inner = p[1:] if p[0] == " " else p
            (other if not inner or inner.split() != [inner] else bare if inner is p else spaced).append(p)
        self.known.update(zip(other, self.ask(other)))
        for i in range(0, len(spaced), 2000):
            part = spaced[i:i + 2000]
            self._learn_joined(part, "".join(part), self.spaced, 0)
        for i in range(0, len(bare), 2000):
            part = bare[i:i + 2000]
            self._learn_joined(part, "\n" + "\n".join(part), self.line, 1)

    def pieces(self, text: str) -> list[str]:
        """The text cut between pre-tokens, not always between all of them.

        There is a cut before a space next to no other white space, and before a mark that
        follows a letter or digit; where spaces or marks stand otherwise, the pattern is used.
        """
        if "  " in text or CROWDED.search(text):
            return PRE_TOKEN.findall(text)
        for mark in MARKS:
            text = text.replace(mark, CUT + mark)
        return text.split(CUT)

    def encode_all(self, texts: list[str], together: int = 256) -> Iterator[bytes]:
        """Ids of each text, as ``kind``, little-endian."""
        join, of = b"".join, self.known.__getitem__
        for i in range(0, len(texts), together):
            cut = [self.pieces(t) if self.plain(t) else None for t in texts[i:i + together]]
            new = set().union(*(c for c in cut if c)).difference(self.known)
            whole = [p for p in new if p.isalpha() or p[:1] == " " and p[1:].isalpha()]
            split = {p: PRE_TOKEN.findall(p) for p in new.difference(whole)}
            self.learn(list(set(whole).union(*split.values()).difference(self.known)))
            self.known.update([(p, join(map(of, inside))) for p, inside in split.items()])
            for text, c in zip(texts[i:i + together], cut):
                yield self.ask([text])[0] if c is None else join(map(of, c))
            # What comes early is common, so a full memory keeps what it has.
            while len(self.known) > PIECES_KEPT:
                self.known.popitem()


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker, which runs many tasks and keeps what it has met."""
    return PieceEncoder(path)


def filesystem(uri: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch."""

    def __init__(self, sink, sequence: int, kind: np.dtype):
        self.sequence, self.kind = sequence, kind
        ids = pa.list_(pa.from_numpy_dtype(kind), sequence)
        self.schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), sequence))])
        self.file = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[bytes] = []
        self.bytes = 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.bytes += len(ids)
        if self.bytes >= self.kind.itemsize * self.sequence * BATCH:
            self.flush(False)

    def flush(self, end: bool) -> None:
        flat = np.frombuffer(b"".join(self.waiting), self.kind)
        step = self.sequence * BATCH
        full = len(flat) if end else len(flat) // step * step
        for i in range(0, full, step):
            part = flat[i:min(i + step, full)]
            pad = -len(part) % self.sequence
            mask = np.arange(len(part) + pad) < len(part)
            part = np.concatenate([part, np.zeros(pad, self.kind)])
            self.file.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(part), self.sequence),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask), self.sequence)], schema=self.schema))
        self.waiting = [flat[full:].tobytes()]
        self.bytes = len(self.waiting[0])

    def close(self) -> None:
        self.flush(True)
        self.file.close()


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def write_files(docs: DataFrame, tokenizer_path: str, *, end_id: int = 0, sequence: int = SEQUENCE,
                partitions: int | None = None) -> DataFrame:
    """Write all documents; one row for each file: part, path, n_docs, n_tokens, start."""
    spark = docs.sparkSession
    root = stage_path(spark, "token-files")
    partitions = partitions or shuffle_partitions(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        codec = writer = None
        n_docs = at = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                codec = encoder(tokenizer_path)
                system, folder = filesystem(root)
                system.create_dir(folder, recursive=True)
                name = f"part-{part:06d}-{attempt}"
                sink = system.open_output_stream(f"{folder}/{name}.arrow")
                writer = SequenceWriter(sink, sequence, codec.kind)
                end = np.array([end_id], codec.kind).tobytes()
                index_sink = system.open_output_stream(f"{folder}/{name}.index.arrow")
                index = pa.ipc.new_file(index_sink, INDEX)
            starts, sizes = [], []
            for ids in codec.encode_all(batch.column(1).to_pylist()):
                writer.add(ids + end)
                starts.append(at)
                sizes.append(len(ids) // codec.kind.itemsize + 1)
                at += sizes[-1]
            index.write_batch(pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=INDEX))
            n_docs += batch.num_rows
        if writer is not None:
            writer.close()
            index.close()
            sink.close()
            index_sink.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int64()), "path": [f"{root}/{name}"], "n_docs": [n_docs], "n_tokens": [at]})

    # Rows of one id are told apart by text; of equal rows any may come first, so these may part.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.make_valid_utf8(text_or_empty()).alias("text")).select(
        "*", F.xxhash64("text").alias("digest"), F.spark_partition_id().alias("origin"))
    ordered = rows.repartitionByRange(partitions, "doc_id", "digest", "origin").sortWithinPartitions(
        "doc_id", "digest", "text").select("doc_id", "text")
    files = stage(ordered.mapInArrow(run, "part long, path string, n_docs long, n_tokens long"), "token-parts")
    # One row for each file: the ids before it are those of the files before it.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def document_ids(path: str) -> Iterator[tuple[int | None, int, int, Iterator[np.ndarray]]]:
    """doc_id, start and number of ids of each document of a file, and its ids in parts."""
    system, base = filesystem(path)
    local = system.type_name == "local"

    def opened(name: str):
        return pa.memory_map(name) if local else system.open_input_file(name)

    with opened(f"{base}.arrow") as data, opened(f"{base}.index.arrow") as listed:
        file, index = pa.ipc.open_file(data), pa.ipc.open_file(listed)
        sequence = file.schema.field("ids").type.list_size
        per_batch = sequence * BATCH
        held: tuple[int, np.ndarray] | None = None

        def ids(start: int, stop: int) -> Iterator[np.ndarray]:
            nonlocal held
            while start < stop:
                k = start // per_batch
                if held is None or held[0] != k:
                    held = k, file.get_batch(k).column(0).flatten().to_numpy()
                until = min(stop, (k + 1) * per_batch)
                yield held[1][start - k * per_batch:until - k * per_batch]
                start = until

        for b in range(index.num_record_batches):
            batch = index.get_batch(b)
            for doc_id, start, n in zip(*(c.to_pylist() for c in batch.columns)):
                yield doc_id, start, n, ids(start, start + n)


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                for doc_id, start, n, parts in document_ids(path):
                    crc = 0
                    for part in parts:
                        crc = zlib.crc32(part.astype("<u4"), crc)
                    rows.append((doc_id, offset + start, n, crc))
                    if len(rows) == 10_000:
                        yield listed(rows)
                        rows = []
                yield listed(rows)

    def listed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = files.select("path", "start").repartition(shuffle_partitions(files.sparkSession))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
