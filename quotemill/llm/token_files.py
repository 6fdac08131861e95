"""Token ids as flat binary files with document offsets, read through memory maps.

A folder holds, per shard, ``tokens-N.bin`` (little-endian unsigned ids, 16 bit where the
vocabulary allows it, else 32), ``offsets-N.bin`` (64-bit starts within the shard, one more
than documents) and ``documents-N.bin`` (64-bit document ids), and one ``manifest.json``
with each shard's document and token counts and its base, the number of ids in all shards
before it. Shards follow each other in ascending ``doc_id``; repeated ids stand in order of
their texts, and rows without an id come first.

Every file is written under a name of its own attempt and then moved into place, so a
repeated task replaces its shard whole. Folders that are not local are written and fetched
with ``pyarrow.fs``.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, compress
from operator import not_
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .tables import map_arrow, texts

#: Stands in the files for a missing document id.
NO_ID = -(2**63)
#: Stretches of text whose ids a worker keeps; the table is emptied when it is full.
KEPT = 1_200_000
KEPT_LENGTH = 64
# White space as Unicode defines it, which is what the vocabulary's own splitting uses.
_WHITE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
_LETTERS, _MARKS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", ".,;:!?|%$#&*"
# Words before marks and the marks apart, other runs between white space whole, white space.
_STRETCH = re.compile(
    f" ?[{_LETTERS}]+(?=[{_MARKS}]*(?:[{_WHITE}]|\\Z))|[{_MARKS}]+(?=[{_WHITE}]|\\Z)"
    f"| ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)


class Shard(NamedTuple):
    number: int
    base: int
    n_docs: int
    n_tokens: int


class ByteEncoder:
    """Whole texts to ids with the library, one stretch between blanks at a time.

    The vocabulary's splitting rule never joins what stands before a single blank with what
    follows, so ids of such stretches follow each other just as in the whole text. A text that
    holds a special token's string is encoded whole.
    """

    def __init__(self, vocabulary: str):
        self._tokenizer = Tokenizer.from_file(vocabulary)
        size = self._tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        rule = json.loads(self._tokenizer.to_str())
        self._special = [t["content"] for t in rule["added_tokens"]]
        pre = rule["pre_tokenizer"] or {}
        self._by_stretch = pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and not rule["normalizer"]
        self._kept: dict[str, bytes] = {}

    def _whole(self, batch: list[str]) -> list[bytes]:
        """Ids' bytes of whole texts."""
        encoded = [e.ids for e in self._tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        ends = list(accumulate(map(len, encoded)))
        data = np.fromiter(chain.from_iterable(encoded), self.dtype, ends[-1] if ends else 0).tobytes()
        size = self.dtype.itemsize
        return [data[a * size : b * size] for a, b in zip([0, *ends], ends)]

    def encode(self, batch: list[str]) -> list[bytes]:
        """The ids' bytes of each text."""
        out: list = [b""] * len(batch)
        whole, split = [], []
        for i, text in enumerate(batch):
            if not self._by_stretch or any(s in text for s in self._special):
                whole.append(i)
            else:
                split.append((i, _STRETCH.findall(text)))
        for i, ids in zip(whole, self._whole([batch[i] for i in whole])):
            out[i] = ids
        if len(self._kept) > KEPT:
            self._kept.clear()
        # One look-up a stretch; only those not found are looked up again.
        known = [list(map(self._kept.get, stretches)) for _, stretches in split]
        new: set[str] = set()
        for (_, stretches), ids in zip(split, known):
            new.update(compress(stretches, map(not_, ids)))
        listed = list(new)
        self._kept.update(zip(listed, self._whole(listed)))
        for (i, stretches), ids in zip(split, known):
            for at in [n for n, found in enumerate(ids) if found is None]:
                ids[at] = self._kept[stretches[at]]
            out[i] = b"".join(ids)
        for stretch in listed:
            if len(stretch) > KEPT_LENGTH:
                del self._kept[stretch]
        return out


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> ByteEncoder:
    return ByteEncoder(vocabulary)


def _open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"file:/[^/]", folder):
        folder = folder[5:]
    return fs.FileSystem.from_uri(folder)


def _put(folder: str, name: str, parts: Iterator[bytes]) -> None:
    files, root = _open_folder(folder)
    attempt = f"{root}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(attempt) as out:
        for part in parts:
            out.write(part)
    files.move(attempt, f"{root}/{name}")


def _mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """The file as a memory map; a file elsewhere is fetched first."""
    files, root = _open_folder(folder)
    path = f"{root}/{name}"
    if files.get_file_info(path).size == 0:
        return np.empty(0, dtype)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, dtype, mode="r")
    with tempfile.NamedTemporaryFile() as copy, files.open_input_stream(path) as source:
        while block := source.read(1 << 22):
            copy.write(block)
        copy.flush()
        return np.memmap(copy.name, dtype, mode="r")


def write_tokens(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, shards: int | None = None) -> list[Shard]:
    """Encode all texts (null: empty), add ``end_id`` to each, write the files.

    Rows are dealt by ranges of ``doc_id``, one range a shard. The shards' bases are prefix
    sums over one number per shard. An empty table gives shards without documents.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    files, root = _open_folder(folder)
    files.create_dir(root)

    def write(batches: Iterator[pa.RecordBatch]):
        own = encoder(vocabulary)
        end = np.array([end_id], own.dtype).tobytes()
        number, lengths, ids = TaskContext.get().partitionId(), [], []

        def encoded() -> Iterator[bytes]:
            for batch in batches:
                ids.extend(NO_ID if i is None else i for i in batch["doc_id"].to_pylist())
                for data in own.encode(batch["text"].to_pylist()):
                    data += end
                    lengths.append(len(data) // own.dtype.itemsize)
                    yield data

        _put(folder, f"tokens-{number}.bin", encoded())
        offsets = np.zeros(len(lengths) + 1, "<u8")
        np.cumsum(lengths, out=offsets[1:])
        _put(folder, f"offsets-{number}.bin", iter([offsets.tobytes()]))
        _put(folder, f"documents-{number}.bin", iter([np.array(ids, "<i8").tobytes()]))
        yield [number], [len(lengths)], [int(offsets[-1])]

    ordered = texts(docs).repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    rows = map_arrow(ordered, write, "number long, n_docs long, n_tokens long").collect()
    base, out = 0, []
    for number, n_docs, n_tokens in sorted(rows):
        out.append(Shard(number, base, n_docs, n_tokens))
        base += n_tokens
    listed = {"dtype": encoder(vocabulary).dtype.str, "end_id": end_id, "shards": [s._asdict() for s in out]}
    _put(folder, "manifest.json", iter([json.dumps(listed).encode()]))
    return out


def manifest(folder: str) -> tuple[str, list[Shard]]:
    """The ids' type and the shards."""
    files, root = _open_folder(folder)
    with files.open_input_stream(f"{root}/manifest.json") as source:
        listed = json.loads(source.read())
    return listed["dtype"], [Shard(**s) for s in listed["shards"]]


def open_shard(folder: str, dtype: str, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Memory maps of a shard: ids, starts within the shard, document ids."""
    return (
        _mapped(folder, f"tokens-{number}.bin", dtype),
        _mapped(folder, f"offsets-{number}.bin", "<u8"),
        _mapped(folder, f"documents-{number}.bin", "<i8"),
    )


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before; the checksum is over the document's
    ids as little-endian unsigned 32-bit integers.
    """
    dtype, shards = manifest(folder)
    bases = {s.number: s.base for s in shards if s.n_docs}

    def digest(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for number in batch["number"].to_pylist():
                tokens, offsets, ids = open_shard(folder, dtype, number)
                for at in range(0, len(ids), 5_000):
                    part = slice(at, at + 5_000)
                    starts = offsets[part].astype(np.int64)
                    ends = offsets[at + 1 : at + 1 + len(starts)].astype(np.int64)
                    starts = starts[: len(ends)]
                    sums = [zlib.crc32(tokens[a:b].astype("<u4")) for a, b in zip(starts, ends)]
                    named = [None if i == NO_ID else i for i in ids[part].tolist()]
                    yield named, starts + bases[number], ends - starts, sums

    numbers = spark.createDataFrame([(n,) for n in bases], "number long")
    dealt = numbers.repartition(max(1, len(bases)))
    return map_arrow(dealt, digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
