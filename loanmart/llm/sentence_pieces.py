"""SentencePiece encoding and decoding, with a max-plus scan over the chunks of giant documents.

A text's segmentation is the one with the largest sum of piece scores (the Viterbi path of a unigram
model; the vocabulary and its scores are given). Ties go to the longer last piece. Scores are fixed-point numbers,
whole multiples of 2**-20 or of what ``scale`` allows, so sums are exact and how a text is cut into chunks cannot change the result.

A document of up to ``CHUNK`` characters is segmented at once. A longer one is cut into chunks. At a chunk's
boundary the state is how far the last piece reaches beyond it. Each chunk gives a matrix of the best score
from each entering to each leaving state; max-plus products of the matrices, which are associative, give the best
scores at every boundary. With these each chunk tells from which state each leaving state comes,
these maps are composed from the end, and then all chunks are traced back independently.
"""

from __future__ import annotations

import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanmart.llm import blocks as B
from loanmart.llm.shared import utf8, written
from loanmart.llm.word_store import WordStore

CHUNK = 1 << 15  # characters
BLOCK_BYTES = 2 << 20  # text whose words are looked up together
_BASE, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1
KNOWN = 50_000  # words of giant documents whose segmentation is kept in a task
SPACE = "▁"
NOTHING = -(1 << 60)  # no path


def scale(scores: list[float]) -> int:
    """What scores are multiplied by before rounding: 1 if all are whole, else 2**20 or as much as leaves the
    lowest within 31 bits, so that sums over 2**29 characters stay above ``NOTHING``."""
    if all(float(x).is_integer() for x in scores):
        return 1
    lowest = max(map(abs, scores)) + 10
    return max([1, *(1 << k for k in range(21) if lowest * (1 << k) < 1 << 31)])


class Pieces:
    """Vocabulary with fixed-point scores; the best segmentation of any string.

    Words are segmented one by one where no piece contains a space after something else, as then
    every segmentation has a boundary there, and likewise around a character of no piece.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores: dict[str, tuple[int, int]] = {}
        self.spelled: list[bytes] = []
        self.bytes = [0] * 256
        scored: dict[str, tuple[float, int]] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                scored[piece] = (model.get_score(i), i)
                self.spelled.append(piece.encode())
        times = scale([s for s, _ in scored.values()])
        self.scores = {p: (round(s * times), i) for p, (s, i) in scored.items()}
        self.longest = max(map(len, self.scores))
        self.unknown = min(s for s, _ in self.scores.values()) - 10 * times
        self.width = 2 if len(self.spelled) <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.splits = all(SPACE not in p.lstrip(SPACE) for p in self.scores)
        self.newline_alone = not any("\n" in p for p in self.scores)
        self.known = _Words(self)
        self.single = {p for p in self.scores if len(p) == 1}
        # every beginning of a piece; its score and id if it is one itself
        self.beginnings = {p[:n]: None for p in self.scores for n in range(1, len(p))} | self.scores
        # neighbours that stand together in some piece; between any others is a boundary
        self.joined = {p[i : i + 2] for p in self.scores for i in range(len(p) - 1)}
        self._index()
        self.store = WordStore(self.segment_all, f"<u{self.width}")

    def _index(self) -> None:
        """Beginnings of pieces by hash: sorted, with a directory by leading bits, and what they are."""
        hashes = []
        for text in self.beginnings:
            h = 0
            for c in text:
                h = (h * _BASE + ord(c) + 1) & _ALL
            hashes.append(h)
        mixed = B.mix(np.array(hashes, np.uint64))
        order = np.argsort(mixed)
        found = [self.beginnings[b] for b in self.beginnings]
        self.hashes = np.append(mixed[order], np.zeros(64, np.uint64))  # probing may look beyond the last
        self.worth = np.array([NOTHING if f is None else f[0] for f in found], np.int64)[order]
        self.number = np.array([-1 if f is None else f[1] for f in found], np.int32)[order]
        self.directory = np.searchsorted(mixed[order], np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).astype(np.int64)
        self.probes = int(np.diff(np.append(self.directory, len(mixed))).max())
        self.alphabet = np.array(sorted(map(ord, self.single)), np.uint32)

    def _look(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the beginnings with these hashes, -1 for none."""
        at = self.directory[(hashes >> np.uint64(44)).astype(np.int64)]
        out = np.full(len(hashes), -1, np.int64)
        for step in range(self.probes):
            hit = self.hashes[at + step] == hashes
            out[hit] = at[hit] + step
        return out

    def segment_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``segment`` for each of many words, spaces not yet marked: how many ids each has, and all ids in order.

        Words of one length go through the same steps together.
        """
        words = [w.replace(" ", SPACE) for w in words]
        lengths = np.array([len(w) for w in words])
        done: list = [None] * len(words)
        for length in np.unique(lengths):
            places = np.flatnonzero(lengths == length)
            if length > 64:
                for i in places:
                    done[i] = np.frombuffer(self.word(words[i]), f"<u{self.width}")
                continue
            for at in range(0, len(places), 1 << 14):
                self._segment_equal(words, places[at : at + (1 << 14)], int(length), done)
        sizes = np.array([len(d) for d in done], np.int64)
        return sizes, np.concatenate([np.zeros(0, f"<u{self.width}"), *done])

    def _segment_equal(self, words: list[str], places: np.ndarray, length: int, done: list) -> None:
        points = np.array([words[i] for i in places], f"<U{length}").view(np.uint32).reshape(len(places), length)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        plain = (self.alphabet[at] == points).all(axis=1)
        for i in places[~plain]:  # characters of no piece
            done[i] = np.frombuffer(self.word(words[i]), f"<u{self.width}")
        points, places = points[plain].astype(np.uint64) + np.uint64(1), places[plain]
        many = len(places)
        best = np.full((length + 1, many), NOTHING, np.int64)
        best[0] = 0
        start, ids = np.zeros((length + 1, many), np.int64), np.full((length + 1, many), -1, np.int64)
        for at in range(length):
            live, h = np.arange(many), np.zeros(many, np.uint64)
            for end in range(at + 1, length + 1):
                h = h * np.uint64(_BASE) + points[live, end - 1]
                found = self._look(B.mix(h))
                hit = found >= 0
                live, h, found = live[hit], h[hit], found[hit]
                if not len(live):
                    break
                value = best[at, live] + self.worth[found]
                # earlier starts come first, so ties keep the longer piece
                better = (self.number[found] >= 0) & (value > best[end, live])
                to = live[better]
                best[end, to], start[end, to], ids[end, to] = value[better], at, self.number[found[better]]
        # back from the end, all words together; a word that is done stays at its start
        here, every, steps = np.full(many, length), np.arange(many), []
        while here.any():
            steps.append(np.where(here > 0, ids[here, every], -1))
            here = np.where(here > 0, start[here, every], 0)
        if many:
            table = np.stack(steps[::-1], axis=1).astype(np.int64)
            for i, row in zip(places, table):
                done[i] = row[row >= 0].astype(f"<u{self.width}")

    def encode_block(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a binary array, and where each text's begin: word by word, each distinct word once.

        A word is what stands between two boundaries of every segmentation: spaces and what follows them, or a line end.
        """
        data, offsets = B.text_bytes(column)
        filled = np.flatnonzero(np.diff(offsets))
        data = np.insert(data, offsets[filled], 32)  # the marker before each text
        offsets = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        line, space = data == 10, data == 32
        begins = line.copy()
        begins[1:] |= line[:-1] | (space[1:] & ~space[:-1])
        begins[offsets[filled]] = True
        at = np.flatnonzero(begins)
        ends = np.append(at, len(data)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))
        return self.store.texts(words, np.searchsorted(at, offsets))

    def pack(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def forward(self, text: str, best: list[int], upto: int) -> tuple[list[int], list[tuple[int, int] | None]]:
        """Best sums at all places from those given for the first ones, over pieces that start before ``upto``.

        Also the piece each best sum ends with, None where the given sum is the best. A character that
        is no piece is an edge with id -1.
        """
        beginnings, single, size = self.beginnings, self.single, len(text)
        best = best + [NOTHING] * (len(text) + 1 - len(best))
        last: list[tuple[int, int] | None] = [None] * len(best)
        for at in range(upto):
            here = best[at]
            if here == NOTHING:
                continue
            end = at + 1
            if text[at] not in single and here + self.unknown > best[end]:
                best[end], last[end] = here + self.unknown, (at, -1)
            while end <= size and (found := beginnings.get(text[at:end], -1)) != -1:
                # earlier starts come first, so ties keep the longer piece
                if found is not None and here + found[0] > best[end]:
                    best[end], last[end] = here + found[0], (at, found[1])
                end += 1
        return best, last

    def trace(self, text: str, last: list, at: int) -> tuple[list[int], int]:
        """Ids of the pieces that lead to ``at``, and the place they start from."""
        out: list[int] = []
        while last[at] is not None:
            start, piece = last[at]
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.bytes[b] for b in text[start:at].encode()][::-1]
            at = start
        return out[::-1], at

    def segment(self, text: str) -> list[int]:
        """Ids of the whole text: ``forward`` and ``trace`` from start to end, where every place is reached."""
        size = len(text)
        best, start, ids = [0] + [NOTHING] * size, [0] * (size + 1), [-1] * (size + 1)
        get, unknown = self.beginnings.get, self.unknown
        for at in range(size):
            here, end = best[at], at + 1
            found = get(text[at], -1)
            if (found is None or found == -1) and here + unknown > best[end]:
                best[end], start[end], ids[end] = here + unknown, at, -1
            while found != -1:
                if found is not None and here + found[0] > best[end]:
                    best[end], start[end], ids[end] = here + found[0], at, found[1]
                if end == size:
                    break
                end += 1
                found = get(text[at:end], -1)
        out: list[int] = []
        while size:
            at = start[size]
            if ids[size] >= 0:
                out.append(ids[size])
            else:
                out += [self.bytes[b] for b in text[at:size].encode()][::-1]
            size = at
        out.reverse()
        return out

    def word(self, text: str) -> bytes:
        """As ``segment``, packed, part by part between boundaries."""
        joined, out, at = self.joined, [], 0
        for end in range(1, len(text) + 1):
            if end == len(text) or text[end - 1 : end + 1] not in joined:
                out += self.segment(text[at:end])
                at = end
        return self.pack(out)

    def cuts(self, text: str) -> list[int]:
        """Places in the text that every segmentation has a boundary at."""
        out = []
        if self.splits:
            out += [i for i in _find(text, SPACE) if i and text[i - 1] != SPACE]
        if self.newline_alone:
            out += [j for i in _find(text, "\n") for j in (i, i + 1)]
        return sorted(set(out))

    def plain(self, text: str) -> bytes:
        """Packed ids of a text that begins at a boundary and ends at one; spaces are marked already."""
        if not (self.splits and self.newline_alone):
            return self.pack(self.segment(text)) if text else b""
        out, known = [], self.known
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(known["\n"])
            if not line:
                continue
            words = line.split(SPACE)
            if "" in words[1:]:
                out += [known[w] for w in _runs(line)]
                continue
            if words[0]:
                out.append(known[words[0]])
            out += [known[SPACE + w] for w in words[1:]]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        return self.plain(marked(text))

    def decode(self, ids: list[int]) -> str:
        data = b"".join([self.spelled[i] for i in ids]).replace(SPACE.encode(), b" ")
        return data[1:].decode("utf-8", "replace")


class _Words(dict):
    """Packed ids of words in giant documents."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, word: str) -> bytes:
        found = self.pieces.word(word)
        if len(self) >= KNOWN:
            self.clear()
        if len(word) < 64:
            self[word] = found
        return found


def _find(text: str, what: str):
    at = text.find(what)
    while at >= 0:
        yield at
        at = text.find(what, at + 1)


def _runs(line: str) -> list[str]:
    """A line cut before each space that follows something else."""
    cut = [0, *(i for i in _find(line, SPACE) if i and line[i - 1] != SPACE), len(line)]
    return [line[a:b] for a, b in zip(cut, cut[1:])]


def marked(text: str) -> str:
    """Spaces written as the marker, and one before the text; nothing for an empty text."""
    return SPACE + text.replace(" ", SPACE) if text else ""


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


class Chunk:
    """A stretch of marked text, with the characters after it that its last piece may reach into."""

    def __init__(self, model: Pieces, text: str, size: int):
        self.model, self.text, self.size = model, text, size
        self.states = model.longest
        inner = [c for c in model.cuts(text[:size]) if 0 < c <= size]
        self.head = inner[0] if inner else None
        self.tail = inner[-1] if inner else None

    def _leaving(self, best: list[int], base: int) -> np.ndarray:
        """Scores at the places from the chunk's end on."""
        out = np.full(self.states, NOTHING)
        values = best[self.size - base : self.size - base + self.states]
        out[: len(values)] = values
        return out

    def matrix(self) -> np.ndarray:
        """Best score from each entering state (characters already covered) to each leaving state.

        What lies between two places that every segmentation has a boundary at is the same on all paths
        and is left out.
        """
        out = np.full((self.states, self.states), NOTHING)
        if self.head is None:
            for a in range(min(self.states, len(self.text) + 1)):
                best, _ = self.model.forward(self.text, [NOTHING] * a + [0], self.size)
                out[a] = self._leaving(best, 0)
            return out
        best, _ = self.model.forward(self.text[self.tail :], [0], self.size - self.tail)
        leaving = self._leaving(best, self.tail)
        head = self.text[: self.head]
        for a in range(min(self.states, len(head) + 1)):
            best, _ = self.model.forward(head, [NOTHING] * a + [0], len(head))
            if best[-1] != NOTHING:
                out[a] = np.where(leaving == NOTHING, NOTHING, leaving + best[-1])
        return out

    def _paths(self, entering: list[int]):
        """The forward pass of the stretch that decides where a leaving state comes from."""
        if self.head is None:
            return self.model.forward(self.text, entering, self.size)
        head = self.text[: self.head]
        return self.model.forward(head, entering[: len(head) + 1], len(head))

    def origins(self, entering: list[int]) -> list[int]:
        """For each leaving state the entering state its best path has; -1 if there is no path."""
        best, last = self._paths(entering)
        if self.head is not None:
            origin = self.model.trace(self.text, last, self.head)[1]
            reach, _ = self.model.forward(self.text[self.tail :], [0], self.size - self.tail)
            return [origin if v != NOTHING else -1 for v in self._leaving(reach, self.tail)]
        values = self._leaving(best, 0)
        return [self.model.trace(self.text, last, self.size + e)[1] if v != NOTHING else -1 for e, v in enumerate(values)]

    def ids(self, entering: list[int], leaving: int) -> bytes:
        """Packed ids of the pieces that start in the chunk on the best path to a leaving state."""
        best, last = self._paths(entering)
        if self.head is None:
            return self.model.pack(self.model.trace(self.text, last, self.size + leaving)[0])
        first = self.model.trace(self.text, last, self.head)[0]
        rest = self.text[self.tail :]
        _, last = self.model.forward(rest, [0], self.size - self.tail)
        tail = self.model.trace(rest, last, self.size - self.tail + leaving)[0]
        return self.model.pack(first) + self.model.plain(self.text[self.head : self.tail]) + self.model.pack(tail)


def _times(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    out = (left[:, :, None] + right[None, :, :]).max(axis=1)
    return np.where(out < NOTHING // 2, NOTHING, out)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of all matrices before each one, by doubling; the first is the identity."""
    identity = np.where(np.eye(len(matrices[0]), dtype=bool), 0, NOTHING)
    done = [identity, *matrices[:-1]]
    step = 1
    while step < len(done):
        done = [done[i] if i < step else _times(done[i - step], done[i]) for i in range(len(done))]
        step *= 2
    return done


def _lists(packed: list[bytes], width: int) -> pa.Array:
    values = np.frombuffer(b"".join(packed), f"<u{width}").astype(np.int32)
    ends = np.cumsum([0, *(len(p) // width for p in packed)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _whole(docs: DataFrame, path: str) -> DataFrame:
    def run(batches):
        model = pieces(path)
        for block in B.sized_blocks(batches, "text", BLOCK_BYTES):
            if model.splits and model.newline_alone:
                values, ends = model.encode_block(block.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))
            else:
                lists = _lists([model.encode(t.decode("utf-8", "replace")) for t in block.column("text").to_pylist()], model.width)
            yield pa.RecordBatch.from_arrays([block.column("id"), lists], ["id", "ids"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, ids array<int>")


def _chunks(docs: DataFrame, path: str, size: int) -> DataFrame:
    """``doc, tag, no, size, text``: chunks of marked text with what their last piece may reach into."""

    def run(batches):
        model = pieces(path)
        for batch in batches:
            for doc, tag, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "tag", "text"))):
                whole = marked(text.decode("utf-8", "replace"))
                for no, at in enumerate(range(0, len(whole), size)):
                    part = whole[at : at + size + model.longest - 1]
                    yield pa.RecordBatch.from_pydict(
                        {"doc": [doc], "tag": [tag], "no": [no], "size": [min(size, len(whole) - at)], "text": [part]}
                    )

    kind = dict(docs.dtypes)["doc"]
    found = docs.select("doc", "tag", "text").mapInArrow(run, f"doc {kind}, tag long, no long, size long, text string")
    return found.repartition("doc", "tag", "no")


def _giant(docs: DataFrame, path: str, size: int) -> DataFrame:
    """``doc, tag, ids`` of documents in chunks."""
    kind = dict(docs.dtypes)["doc"]
    chunks = written(_chunks(docs, path, size))

    def matrices(batches):
        model = pieces(path)
        for b in batches:
            rows = [Chunk(model, t, n).matrix().reshape(-1).tolist() for t, n in zip(b.column("text").to_pylist(), b.column("size").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("tag"), b.column("no"), pa.array(rows, pa.list_(pa.int64()))], ["doc", "tag", "no", "matrix"])

    def before(table: pa.Table) -> pa.Table:
        # one document's matrices, a sixteenth of its text
        table = table.sort_by("no")
        side = pieces(path).longest
        products = scan([np.array(m, np.int64).reshape(side, side) for m in table.column("matrix").to_pylist()])
        entering = [m[0].tolist() for m in products]  # a document is entered with nothing covered
        return table.drop_columns(["matrix"]).append_column("entering", pa.array(entering, pa.list_(pa.int64())))

    found = chunks.mapInArrow(matrices, f"doc {kind}, tag long, no long, matrix array<long>")
    keys = ["doc", "tag", "no"]
    entering = written(found.groupBy("doc", "tag").applyInArrow(before, f"doc {kind}, tag long, no long, entering array<long>"))

    def origins(batches):
        model = pieces(path)
        for b in batches:
            rows = [Chunk(model, t, n).origins(e) for t, n, e in zip(*(b.column(c).to_pylist() for c in ("text", "size", "entering")))]
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("tag"), b.column("no"), pa.array(rows, pa.list_(pa.int64()))], [*keys, "origins"])

    def leaving(table: pa.Table) -> pa.Table:
        table = table.sort_by("no")
        state, out = 0, []  # the last chunk is left with nothing beyond it
        for origin in reversed(table.column("origins").to_pylist()):
            out.append(state)
            state = origin[state]
        return table.drop_columns(["origins"]).append_column("leaving", pa.array(out[::-1], pa.int64()))

    def match(a: DataFrame, b: DataFrame):
        return a["doc"].eqNullSafe(b["doc"]) & (a["tag"] == b["tag"]) & (a["no"] == b["no"])

    entered = chunks.join(entering, match(chunks, entering)).select(*[chunks[c] for c in [*keys, "size", "text"]], "entering")
    maps = entered.mapInArrow(origins, f"doc {kind}, tag long, no long, origins array<long>")
    left = written(maps.groupBy("doc", "tag").applyInArrow(leaving, f"doc {kind}, tag long, no long, leaving long"))

    def traced(batches):
        model = pieces(path)
        for b in batches:
            rows = [Chunk(model, t, n).ids(e, s) for t, n, e, s in zip(*(b.column(c).to_pylist() for c in ("text", "size", "entering", "leaving")))]
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("tag"), b.column("no"), _lists(rows, model.width)], [*keys, "ids"])

    both = entered.join(left, match(chunks, left)).select(*[chunks[c] for c in [*keys, "size", "text"]], "entering", "leaving")
    ids = both.mapInArrow(traced, f"doc {kind}, tag long, no long, ids array<int>")
    parts = F.sort_array(F.collect_list(F.struct("no", "ids")))
    return ids.groupBy("doc", "tag").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def encode(docs: DataFrame, id_col: str, text_col: str, path: str, chunk: int = CHUNK) -> DataFrame:
    """``id_col, ids`` for each row. A null or empty text has no ids.

    Characters of no piece become the pieces of their UTF-8 bytes. Rows equal in id and text are each
    returned; empty tables give empty results; other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    long = F.length(text) >= chunk
    short = docs.where(~long).select(F.col(id_col).alias("id"), utf8(text).alias("text"))
    giant = docs.where(long).select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("tag"), utf8(text).alias("text"))
    found = _giant(giant.dropDuplicates(["doc", "tag"]), path, chunk)
    rows = giant.select("doc", "tag")
    match = rows["doc"].eqNullSafe(found["doc"]) & (rows["tag"] == found["tag"])
    joined = rows.join(found, match).select(rows["doc"].alias("id"), "ids")
    return _whole(short, path).union(joined).withColumnRenamed("id", id_col)


def decode(coded: DataFrame, id_col: str, ids_col: str, path: str) -> DataFrame:
    """``id_col, text``, with the marker shown as a space; null ids give a null text."""

    def run(batches):
        model = pieces(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [None if i is None else model.decode(i) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    frame = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return frame.mapInArrow(run, f"id {dict(frame.dtypes)['id']}, text string").withColumnRenamed("id", id_col)


def digest(coded: DataFrame, path: str) -> DataFrame:
    """``id, ids, n_tokens, ids_crc32, n_chars, text_md5``: beside the ids, digests of them and of the text they decode to."""

    def run(batches):
        model = pieces(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column("ids")
                values, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *lists.value_lengths().to_pylist()])
                each = [values[a:b] for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), lists, pa.array(np.diff(ends)),
                        pa.array([zlib.crc32(v.astype("<u4").tobytes()) for v in each], pa.int64()),
                        pa.array([model.decode(v.tolist()) for v in each], pa.string()),
                    ],
                    ["id", "ids", "n_tokens", "ids_crc32", "text"],
                )

    kind = dict(coded.dtypes)["id"]
    found = coded.mapInArrow(run, f"id {kind}, ids array<int>, n_tokens long, ids_crc32 long, text string")
    return found.select(
        "id", "ids", "n_tokens", "ids_crc32", F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5")
    )
