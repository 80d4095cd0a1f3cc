"""Token ids of all documents in binary files, with Elias-Fano coded document boundaries.

A shard holds documents in ascending id order: the concatenated id array (2 bytes an id where the
vocabulary allows, else 4), the Elias-Fano coded end of each document, the Elias-Fano coded document
ids, and a footer. Shards follow one another in id order. A file appears under its name only when whole, so a task
that is run again leaves the same file.
"""

from __future__ import annotations

import itertools
import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanmart.llm import elias_fano
from loanmart.llm.blocks import LOWER, NOT_SPACE, byte_class, cut_out, sized_blocks, spans, text_bytes
from loanmart.llm.shared import partitions, utf8, written
from loanmart.llm.word_store import WordStore
from loanmart.session import scratch_path

ROWS_PER_SHARD = 8192
BLOCK_BYTES = 2 << 20  # text whose words are looked up together
_FOOTER = struct.Struct("<qqqqqqqq8s")  # id width, ids, documents, null ids, least id, three lengths
_MAGIC = b"EFTOKEN1"


def _footer(*numbers: int) -> bytes:
    return _FOOTER.pack(*numbers, 0, _MAGIC)


class WordIds:
    """Ids of words (bytes between ASCII white space), found once and kept in a ``WordStore``.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its words; that is what this
    format's ``write`` asks of a tokenizer. Where it also leaves words of Latin-1 letters as they are but for their case, and splits
    a word before a full stop or comma, such words go straight to the vocabulary's merges; a tokenizer that does not do so for some
    letter (tried when it is loaded) gets all words whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        letters = [c for c in map(chr, range(256)) if c.isalpha()]
        self.spelled = {}
        if self.tokenizer.pre_tokenizer is not None:
            spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.spelled = {ord(c): "".join(part for part, _ in spell(c)) for c in letters if c == c.lower()}
        self.quick = self._is_quick(letters)
        self.store = WordStore(self.solve, f"<u{self.width}")

    def _is_quick(self, letters: list[str]) -> bool:
        """Whether the quick way gives the library's ids for every letter, pair of letters, and letter before . and ,"""
        tried = [*letters, *(a + b for a in letters for b in letters), *(a + end for a in letters for end in (".", ",", "...", ".,"))]
        if not all(ord(c.lower()) in self.spelled for c in letters if len(c.lower()) == 1 and c.lower() <= "\xff"):
            return False
        wanted = self.tokenizer.encode_batch(tried, add_special_tokens=False)
        return all(self._quickly(t) == w.ids for t, w in zip(tried, wanted) if self._may_be_quick(t.rstrip(".,")))

    @staticmethod
    def _may_be_quick(body: str) -> bool:
        return body.isalpha() and max(body) <= "\xff"

    def _quickly(self, word: str) -> list[int]:
        body = word.rstrip(".,")
        ids = [t.id for t in self.tokenizer.model.tokenize(body.lower().translate(self.spelled))]
        return ids + self.tokenizer.encode(word[len(body) :], add_special_tokens=False).ids if len(body) < len(word) else ids

    def solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids."""
        out: list = [None] * len(words)
        slow = []
        for i, word in enumerate(words):
            if self.quick and self._may_be_quick(word):
                out[i] = [t.id for t in self.tokenizer.model.tokenize(word.lower().translate(self.spelled))]
            else:
                slow.append(i)
        for at in range(0, len(slow), 4096):
            part = slow[at : at + 4096]
            for i, coded in zip(part, self.tokenizer.encode_batch([words[i] for i in part], add_special_tokens=False)):
                out[i] = coded.ids
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return sizes, np.fromiter(itertools.chain.from_iterable(out), f"<u{self.width}", int(sizes.sum()))

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a binary array, and where each text's begin, one more for the end.

        Words of the quick kind are looked up apart from the stops after them, and in lower case.
        """
        data, offsets = text_bytes(column)
        start, end, _ = spans(NOT_SPACE[data], offsets)
        if self.quick and len(start):
            lead = data == 0xC3
            letter = _LETTERS[data] | lead
            # after the lead byte comes a letter, but for the signs of multiplication and division
            letter[1:] = (letter[1:] & ~lead[:-1]) | lead[:-1] & (data[1:] != 0x97) & (data[1:] != 0xB7)
            places = np.arange(len(data))
            last = np.maximum.accumulate(np.where(_STOPS[data], -1, places))[end - 1] + 1  # end without the stops
            other = np.zeros(len(data) + 1, np.int32)
            np.cumsum(~letter, out=other[1:])
            plain = (last > start) & (other[np.maximum(last, start)] == other[start])
            small = np.zeros(len(data) + 1, np.int8)
            small[start[plain]] += 1
            small[last[plain]] -= 1
            data = np.where(np.cumsum(small[:-1], dtype=np.int8) > 0, LOWER[data], data)
            cut = last[plain & (last < end)]
            words = np.sort(np.concatenate([start, cut]))
            return self.store.texts(cut_out(data, words, np.sort(np.concatenate([end, cut]))), np.searchsorted(words, offsets))
        return self.store.texts(cut_out(data, start, end), np.searchsorted(start, offsets))

    def text(self, data: bytes) -> bytes:
        return self.texts(pa.array([data], pa.binary()))[0].tobytes()


_LETTERS = byte_class(bytes([*range(65, 91), *range(97, 123)]))
_STOPS = byte_class(b".,")
_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def write(docs: DataFrame, id_col: str, text_col: str, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Writes the shards; a table ``(shard, documents, ids, path)`` with a row for each.

    Rows go by ascending id, null ids first, equal ids by a hash of their text. A null or empty text
    is its end id alone. An empty table leaves no shard. Ids must be whole numbers.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.withColumn("tie", tie).repartitionByRange(
        partitions(spark, docs.count(), ROWS_PER_SHARD), F.asc_nulls_first("id"), "tie"
    ).sortWithinPartitions(F.asc_nulls_first("id"), "tie").select("id", "text")

    def run(batches):
        shard = TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name, making = f"{base}/shard-{shard:06d}.ids", f"{base}/_{shard}-{uuid.uuid4().hex}"
        known, ids, nulls, counts = word_ids(tokenizer), [], 0, []
        with store.open_output_stream(making) as out:
            for block in sized_blocks(batches, "text", BLOCK_BYTES):
                values, begins = known.texts(block.column("text"))
                out.write(np.insert(values, begins[1:], end_id).tobytes())
                counts.append(np.diff(begins) + 1)
                of = block.column("id")
                nulls += of.null_count
                ids.append(of.drop_null().to_numpy(zero_copy_only=False))
            ends = np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts]))
            ids_ = np.concatenate([np.zeros(0, np.int64), *ids])
            least = int(ids_[0]) if len(ids_) else 0
            total = int(ends[-1]) if len(ends) else 0
            parts = elias_fano.encode(ends), elias_fano.encode((ids_ - least).astype(np.uint64))
            out.write(parts[0] + parts[1] + _footer(known.width, total, len(ends), nulls, least, *map(len, parts)))
        if len(ends):
            store.move(making, name)
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "documents": [len(ends)], "ids": [total], "path": [name]}
            )
        else:
            store.delete_file(making)

    return written(ordered.mapInArrow(run, "shard long, documents long, ids long, path string"))


class Shard:
    """One file: ``ends.select(i)`` and ``ids(i)`` give a document without reading the others."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        at = size - _FOOTER.size
        self.width, self.n_ids, self.n, self.nulls, self.least, a, b, _, magic = _FOOTER.unpack(
            self.file.read_at(_FOOTER.size, at)
        )
        if magic != _MAGIC:
            raise ValueError(f"{path} is no token file")
        coded = self.file.read_at(a + b, at - a - b)
        self.ends, self.doc_ids = elias_fano.Sequence(coded[:a]), elias_fano.Sequence(coded[a:])

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.doc_ids.select(i - self.nulls) + self.least

    def range(self, start: int, end: int) -> np.ndarray:
        data = self.file.read_at((end - start) * self.width, start * self.width)
        return np.frombuffer(data, f"<u{self.width}")

    def ids(self, i: int) -> np.ndarray:
        return self.range(self.ends.select(i - 1) if i else 0, self.ends.select(i))


def read(spark: SparkSession, shards: DataFrame, folder: str) -> DataFrame:
    """Every document of the shards: ``id, start, n_tokens, ids`` with its ids as an array of ints."""

    def plain(each):
        return pa.array([x.tolist() for x in each], pa.list_(pa.int32()))

    return _placed(shards).mapInArrow(
        _documents(folder, plain, "ids"), "id long, start long, n_tokens long, ids array<int>"
    )


def digests(spark: SparkSession, shards: DataFrame, folder: str) -> DataFrame:
    """As ``read``, with the CRC-32 of the ids as little-endian 32-bit numbers in place of the ids."""

    def crc(each):
        return pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in each], pa.int64())

    return _placed(shards).mapInArrow(
        _documents(folder, crc, "ids_crc32"), "id long, start long, n_tokens long, ids_crc32 long"
    )


def _placed(shards: DataFrame) -> DataFrame:
    """Each shard with the number of ids before it; one row for each file."""
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    table = shards.withColumn("before", before).select("path", "before")
    return table.repartition(max(1, shards.count()), "path")


def _documents(folder: str, digest, name: str):
    def run(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(store, path)
                ends = shard.ends.all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                doc_ids = shard.doc_ids.all().astype(np.int64) + shard.least
                at = 0
                while at < shard.n:
                    upto = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 20), "right")))
                    ids = shard.range(starts[at], ends[upto - 1])
                    each = [ids[s - starts[at] : e - starts[at]] for s, e in zip(starts[at:upto], ends[at:upto])]
                    known = [None] * max(0, min(upto, shard.nulls) - at)
                    known += doc_ids[max(at - shard.nulls, 0) : max(upto - shard.nulls, 0)].tolist()
                    yield pa.RecordBatch.from_pydict(
                        {
                            "id": pa.array(known, pa.int64()),
                            "start": pa.array(starts[at:upto] + before),
                            "n_tokens": pa.array(ends[at:upto] - starts[at:upto]),
                            name: digest(each),
                        }
                    )
                    at = upto

    return run


def new_folder(spark: SparkSession) -> str:
    """A folder for files in the shared folder, as a URI."""
    path = scratch_path(spark, "token-files")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
