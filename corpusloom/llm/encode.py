"""Encoding of a whole corpus with a public byte-level BPE vocabulary, by forced-boundary splitting.

A pair of neighbouring bytes that stands inside no token of the vocabulary can never be joined: between
the two there is always a token boundary. The pairs are read off the vocabulary as a 256 x 256 table. A
text is cut at such pairs where also the pre-splitting pattern always breaks (before white space that
follows a visible ASCII character), each fragment is encoded by itself, and the ids are concatenated. As
the same fragments recur throughout a corpus, each is encoded once per task and looked up from then on.

Cuts are found for a batch of texts at once on its bytes; ids leave as Arrow lists without a Python
object per token. The vocabulary (under 1 MB) is read by the driver and goes to the tasks with the function.

Defined cases: null and empty texts have no ids; blank text is encoded like any other; strings of
special tokens are ordinary text; texts of any length and without any forced boundary are one fragment.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public vocabulary files.
FOLDER = "/opt/tokenizers"

# Fixed value: the pre-splitting pattern that belongs to the byte-level BPE vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Fragments remembered by a task.
REMEMBERED = 400_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to id from the text of a vocabulary file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def joined_pairs(tokens: list[bytes]) -> np.ndarray:
    """256 x 256 table: whether two bytes stand next to each other inside some token."""
    table = np.zeros((256, 256), bool)
    data = np.frombuffer(b"".join(tokens), np.uint8)
    ends = np.cumsum([len(t) for t in tokens])
    inner = np.ones(max(len(data) - 1, 0), bool)
    inner[ends[:-1] - 1] = False
    table[data[:-1][inner], data[1:][inner]] = True
    return table


class Encoder:
    """Encodes batches of texts; keeps the ids of fragments it has seen."""

    def __init__(self, vocabulary: bytes) -> None:
        import tiktoken

        ranks = read_ranks(vocabulary)
        self.encoding = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        visible, space = np.zeros(256, bool), np.zeros(256, bool)
        visible[0x21:0x7F] = True
        space[[9, 10, 13, 32]] = True
        self.cut = ~joined_pairs(list(ranks)) & visible[:, None] & space[None, :]
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.ids: list[list[int]] = []

    def _number(self, fragment: bytes) -> int:
        n = self.seen[fragment] = len(self.ids)
        self.ids.append(self.encoding.encode_ordinary(fragment.decode()))
        return n

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the offsets of the texts in it."""
        if len(self.ids) > REMEMBERED:
            self._forget()
        raw = [t.encode() if t else b"" for t in texts]
        data = b"".join(raw)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(size)
        b = np.frombuffer(data, np.uint8)
        cuts = np.flatnonzero(self.cut[b[:-1], b[1:]]) + 1 if len(b) > 1 else np.zeros(0, np.int64)
        bounds = np.unique(np.concatenate([[0], cuts, ends]))
        seen, number = self.seen, self._number
        at = bounds.tolist()
        codes = np.fromiter((seen[f] if (f := data[i:j]) in seen else number(f) for i, j in zip(at[:-1], at[1:])), np.int64, len(at) - 1)
        used, code = np.unique(codes, return_inverse=True)
        lists = [self.ids[u] for u in used.tolist()]
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(count.sum()))
        start = np.cumsum(count) - count
        n = count[code] if len(code) else np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(n)])
        out = flat[np.arange(total[-1]) - np.repeat(total[:-1], n) + np.repeat(start[code], n)] if total[-1] else flat[:0]
        offsets = np.concatenate([[0], total[np.searchsorted(bounds, ends)]])
        return out, offsets


def _vocabulary(folder: str, name: str) -> bytes:
    return (Path(folder) / f"{name}.tiktoken").read_bytes()


def spread(df: DataFrame, bytes_each: int = 1 << 20) -> DataFrame:
    """Rows spread over the cores where the table lies in few splits, as work per byte is high; a big table has splits enough."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def encode(documents: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """The key and ``ids`` (array of int) of each row's text."""
    vocabulary = _vocabulary(folder, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for part in _parts(batch):
                ids, offsets = encoder.encode(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["k", "ids"])

    source = spread(documents.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")))
    return source.mapInArrow(run, "k long, ids array<int>").withColumnRenamed("k", key)


def count_tokens(documents: DataFrame, text: str = "text", name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """The rows with n_tokens (long) instead of their text."""
    vocabulary = _vocabulary(folder, name)
    others = [c for c in documents.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for part in _parts(batch):
                _, offsets = encoder.encode(part.column(len(others)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(np.diff(offsets), pa.int64())], names=[*others, "n_tokens"])

    source = spread(documents.select(*others, text))
    fields = ", ".join(f"`{c}` {t}" for c, t in source.dtypes[:-1])
    return source.mapInArrow(run, f"{fields}, n_tokens long")


def _parts(batch: pa.RecordBatch, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes, at least a row each."""
    size = np.cumsum(np.fromiter((len(s.as_py() or "") if s.is_valid else 0 for s in batch.column(batch.num_columns - 1)), np.int64, batch.num_rows))
    start = 0
    while start < batch.num_rows:
        base = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, base + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop
