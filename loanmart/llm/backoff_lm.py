"""Scoring of texts by a smoothed word model as a weighted backoff automaton.

N-grams of up to three words are counted over the training texts and smoothed by absolute discounting, interpolated
with the shorter history. The model is an automaton: a history that has kept n-grams is a state, a kept n-gram an arc
with its log-probability, and where a state has no arc for a word, its failure arc leads to the shorter history at the
price of the backoff weight. One traversal from left to right carries the state and adds up log-probabilities.

The model grows with the training texts and is never in one place. Texts are cut into blocks; a block names its distinct
n-grams, by 64-bit hashes sorted and packed by slice of the hash range; each slice of the model answers the blocks with
counts, and the block builds from these the part of the automaton that its own texts can reach. Blocks ask in a few
rounds, so that what is on its way takes a part of the disk. Sieves of fixed size keep rare pairs and triples out of
counts and questions.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from loanmart.llm import blocks as B
from loanmart.llm import sieve
from loanmart.llm.shared import collect_garbage, forget, give_back, utf8, written

LEAST = 5  # pairs and triples found less often in the training texts are left to the shorter history
DISCOUNT = 0.75
BLOCK_BYTES = 8 << 20
SLICE_ROWS = 3_000_000  # names of n-grams a task holds at once
HELD_ROWS = 2_000_000  # n-grams of training texts a task adds up before it passes them on
ROUNDS = 4  # parts of the blocks that ask one after the other
ROUND_BLOCKS = 4  # blocks that are worth a round
COUNTING_BITS = 25  # a task counts pairs or triples in an array of 32 MB
LANE = 512  # tokens of a text that are walked through together with other stretches
_END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word has a line end
_SALTS = (np.uint64(0x3C79AC492BA7B653), np.uint64(0x1C69B3F74AC4AE35))


def _zip(values: np.ndarray) -> bytes:
    """The compressed bytes of some numbers, those of one weight together."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unzip(blob: pa.Buffer | bytes, kind, count: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not count:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=count * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, count).T).view(kind)[:, 0]


def _gathered(batches, column: str, size: int):
    """Batches with about ``size`` bytes of text each, from smaller or larger ones; rows are whole."""
    held, total = [], 0
    for block in B.sized_blocks(batches, column, size):
        more = int(B.text_bytes(block.column(column))[1][-1])
        if held and total + more > size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
        held.append(block)
        total += more
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _blocks_of_tokens(size: int):
    """A row a block: ids, whether held out and number of words of its texts, hashes of its distinct words, words as places
    among these."""

    def tokens(number: int, block: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = B.text_bytes(block.column("text"))
        data = B.LOWER[data]
        start, end, row = B.spans(B.NOT_SPACE[data], offsets)
        words = B.cut_out(data, start, end).dictionary_encode()
        names = words.dictionary.cast(pa.binary()).to_pylist()
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
        sizes = np.bincount(row, minlength=block.num_rows).astype(np.int32)
        whole = [0, block.num_rows]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(pa.array(whole, pa.int32()), block.column("id")),
                pa.ListArray.from_arrays(pa.array(whole, pa.int32()), block.column("held_out")),
                pa.ListArray.from_arrays(pa.array(whole, pa.int32()), pa.array(sizes)),
                pa.array([hashes.tobytes()], pa.binary()),
                pa.array([_zip(words.indices.to_numpy().astype(np.int32))], pa.binary()),
            ],
            ["block", "ids", "held_out", "sizes", "names", "tokens"],
        )

    def run(batches):
        part = TaskContext.get().partitionId()
        for nth, block in enumerate(_gathered(batches, "text", size)):
            yield tokens((part << 32) + nth, block)
            del block
            give_back()

    return run


def _distinct(codes: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct codes from 0 to below ``top``, the place of each code among them, and how often each is found.

    ``numpy.unique`` in less room: a code and its place are sorted as one number where both fit.
    """
    bits = max(1, len(codes) - 1).bit_length()
    if top.bit_length() + bits > 63:
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
    else:
        codes = codes << bits
        codes |= np.arange(len(codes))
        codes.sort()
        order = codes & ((1 << bits) - 1)
        codes >>= bits
    new = np.ones(len(codes), bool)
    np.not_equal(codes[1:], codes[:-1], out=new[1:])
    first = np.flatnonzero(new)
    codes = codes[first]
    at = np.empty(len(order), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return codes, at, np.diff(first, append=len(order))


class _Block:
    """The texts of one row as transitions from one token to the next, an end mark before and after each text."""

    def __init__(self, batch: pa.RecordBatch, at: int, sieves: list[sieve.Sieve] = (), training_only: bool = False):
        names = np.frombuffer(batch.column("names")[at].as_buffer(), np.uint64)
        sizes = batch.column("sizes")[at].values.to_numpy().astype(np.int64)
        words = _unzip(batch.column("tokens")[at].as_buffer(), np.int32, int(sizes.sum()))
        if training_only:
            keep = ~batch.column("held_out")[at].values.to_numpy(zero_copy_only=False).astype(bool)
            words, sizes = words[np.repeat(keep, sizes)], sizes[keep]
        self.sizes, self.end, self.width = sizes, len(names), len(names) + 1
        first = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes + 2, out=first[1:])
        inside = np.ones(int(first[-1]), bool)
        inside[first[:-1]] = inside[first[1:] - 1] = False
        token = np.full(int(first[-1]), self.end, np.int32)
        token[inside] = words
        # a transition for each token but the first mark; ``start`` is the first transition of each text
        moves = np.ones(len(token), bool)
        moves[first[:-1]] = False
        to = np.flatnonzero(moves)
        self.start = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.now, self.before = token[to], token[to - 1]
        self.hash = B.mix(np.append(names, _END))
        self.sieves = sieves

    def keys(self) -> np.ndarray:
        """Keys of all pairs; with a sieve of pairs, those of the triples whose pairs it lets through."""
        if not self.sieves:
            return self._pair_keys(self.before, self.now)
        self._pairs()
        both, last = self._triples()
        return self._triple_keys(self._codes(last[both], self.now[both]))

    def _pair_keys(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys = self.hash[first]  # a copy, gone on with in place: there are as many as tokens
        keys *= B._STEP
        keys += self.hash[second]
        keys ^= _SALTS[0]
        return B.mix(keys)

    def _triple_keys(self, triple: np.ndarray) -> np.ndarray:
        return B.mix((self.pair_key[triple // self.width] * B._STEP + self.hash[triple % self.width]) ^ _SALTS[1])

    def _codes(self, history: np.ndarray, last: np.ndarray) -> np.ndarray:
        codes = history.astype(np.int64)
        codes *= self.width
        codes += last
        return codes

    def _pairs(self) -> None:
        pair, of, n = _distinct(self._codes(self.before, self.now), self.width**2)
        keys = self._pair_keys(pair // self.width, pair % self.width)
        kept = np.flatnonzero(self.sieves[0].passes(keys))
        number = np.full(len(pair), -1, np.int32)
        number[kept] = np.arange(len(kept))
        # of each transition: its pair among those kept, -1 for none
        self.pair_at, self.pair, self.pair_n, self.pair_key = number[of], pair[kept], n[kept], keys[kept]

    def _triples(self) -> tuple[np.ndarray, np.ndarray]:
        """Transitions that end a triple of kept pairs, and the first pair of every transition's triple."""
        last = np.full(len(self.now), -1, np.int32)
        last[1:] = self.pair_at[:-1]
        last[self.start[:-1]] = -1
        return np.flatnonzero((last >= 0) & (self.pair_at >= 0)), last

    def look_up(self) -> None:
        """The distinct words, pairs and triples that may be kept, how often each is found, and where triples are."""
        n = np.bincount(self.now, minlength=self.width)
        self.word = np.flatnonzero(n)
        self.word_n = n[self.word]
        self._pairs()
        both, last = self._triples()
        triple, of, n = _distinct(self._codes(last[both], self.now[both]), len(self.pair) * self.width)
        del last
        keys = self._triple_keys(triple)
        kept = np.flatnonzero(self.sieves[1].passes(keys))
        number = np.full(len(triple), -1, np.int32)
        number[kept] = np.arange(len(kept))
        self.triple_at = np.full(len(self.now), -1, np.int32)
        self.triple_at[both] = number[of]
        self.triple, self.triple_n, self.triple_key = triple[kept], n[kept], keys[kept]

    def _gram_keys(self, *more: np.ndarray) -> np.ndarray:
        return np.concatenate([self.hash[self.word], self.pair_key, self.triple_key, *more])

    def grams(self):
        """Distinct words, pairs and triples that may be kept: keys, keys of their histories, counts."""
        self.look_up()
        return (
            self._gram_keys(),
            np.concatenate([np.zeros(len(self.word), np.uint64), self.hash[self.pair // self.width], self.pair_key[self.triple // self.width]]),
            np.concatenate([self.word_n, self.pair_n, self.triple_n]),
        )

    def names(self) -> np.ndarray:
        """Sorted distinct keys to ask the model for; that of the end mark, which is a history, always among them."""
        self.look_up()
        keys = self._gram_keys(self.hash[self.end :])
        keys.sort()
        return keys[np.concatenate([[True], keys[1:] != keys[:-1]])]


def _slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    if slices == 1:
        return np.zeros(len(keys), np.int64)
    return (keys >> np.uint64(64 - (slices - 1).bit_length())).astype(np.int64)


def _runs(of: np.ndarray):
    """``(slice, from, to)`` of sorted slice numbers."""
    found, at = np.unique(of, return_index=True)
    return zip(found.tolist(), at.tolist(), [*at[1:].tolist(), len(of)])


def _sliced(keys: np.ndarray, slices: int):
    return _runs(_slice_of(keys, slices))


def _rows(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch, at


def _block_rows(batches):
    """Rows that are a block each; what one took is given back before the next, and after the last."""
    for batch, at in _rows(batches):
        give_back()
        yield batch, at
    give_back()


def _packed(sieves: list[sieve.Sieve], bits: int, least: int):
    """Keys of the pairs, or with a sieve of pairs of the triples, of each block's training texts."""

    def run(batches):
        for batch, at in _block_rows(batches):
            keys = _Block(batch, at, sieves, training_only=True).keys()
            keys.sort()
            # of equal keys the first ``least``: those that differ from the one ``least`` places before
            kept = np.ones(len(keys), bool)
            np.not_equal(keys[least:], keys[:-least], out=kept[least:])
            keys = keys[kept]
            if len(keys):
                yield from sieve.pack(keys, bits, COUNTING_BITS)

    return run


def _added_up(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Keys, parents and counts of several blocks together; a column at a time, as there may be millions of each."""
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys = keys[first]
    parents = np.concatenate([p[1] for p in parts])[order[first]]
    return keys, parents, np.add.reduceat(np.concatenate([p[2] for p in parts])[order], first)


def _training_grams(sieves: list[sieve.Sieve], slices: int):
    """``slice, keys, parents, counts`` of training texts, blocks of a task added up while they are few."""

    def packed(keys, parents, n):
        of = _slice_of(keys, slices)
        order = np.lexsort((keys, parents, of))  # of one history together, which zips well
        keys, parents, n = keys[order], parents[order], n[order]
        out = [(s, sieve.zip_sorted(keys[a:b]), sieve.zip_sorted(parents[a:b]), _zip(n[a:b])) for s, a, b in _runs(of[order])]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32(), *[pa.binary()] * 3])], ["slice", "keys", "parents", "counts"])

    def run(batches):
        held = None
        for batch, at in _block_rows(batches):
            keys, parents, n = _Block(batch, at, sieves, training_only=True).grams()
            if not len(keys):
                continue
            found = (keys, parents, n.astype(np.int64))
            held = _added_up([found] if held is None else [held, found])
            del keys, parents, n, found
            if len(held[0]) > HELD_ROWS:
                yield packed(*held)
                held = None
        if held is not None:
            yield packed(*held)
        held = None
        give_back()

    return run


def _summed(least: int):
    """``slice, key, parent, n`` of all words, and of pairs and triples found often enough; a slice at a time."""

    def run(batches):
        def total(now, held):
            keys, parents, n = _added_up(held)
            w = np.flatnonzero((parents == 0) | (n >= least))
            for a in range(0, len(w), 100_000):
                p = w[a : a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), now, np.int32)), pa.array(keys[p].view(np.int64)), pa.array(parents[p].view(np.int64)), pa.array(n[p])],
                    ["slice", "key", "parent", "n"],
                )

        now, held = None, []
        for batch, at in _rows(batches):
            one = batch.column("slice")[at].as_py()
            if one != now and held:
                yield from total(now, held)
                held = []
            now = one
            keys = sieve.unzip_sorted(batch.column("keys")[at].as_buffer(), np.uint64)
            held.append((keys, sieve.unzip_sorted(batch.column("parents")[at].as_buffer(), np.uint64), _unzip(batch.column("counts")[at].as_buffer(), np.int64, len(keys))))
        if held:
            yield from total(now, held)
        held = []
        give_back()

    return run


def _questions(sieves: list[sieve.Sieve], slices: int):
    """``slice, block, keys`` of what each block wants to know."""

    def run(batches):
        for batch, at in _block_rows(batches):
            keys = _Block(batch, at, sieves).names()
            block = batch.column("block")[at].as_py()
            out = [(s, block, sieve.zip_sorted(keys[a:b])) for s, a, b in _sliced(keys, slices)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32(), pa.int64(), pa.binary()])], ["slice", "block", "keys"])

    return run


MODEL = ("n", "kept", "total")


def _packed_model(batches):
    """``slice, keys, answers``: keys of a batch of the model's rows, and what is known of them."""
    for batch in batches:
        slices = batch.column("slice").to_numpy()
        keys = batch.column("key").to_numpy().view(np.uint64)
        order = np.lexsort((keys, slices))
        values = [batch.column(c).to_numpy()[order] for c in MODEL]
        keys = keys[order]
        out = [(s, sieve.zip_sorted(keys[a:b]), _zip(np.concatenate([v[a:b] for v in values]))) for s, a, b in _runs(slices[order])]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32(), pa.binary(), pa.binary()])], ["slice", "keys", "answers"])


def _answers(batches):
    """``block, slice, answers``: count, number and sum of kept successors of each key asked for; 0 where unknown.

    In each slice the rows of the model, which have no block, come first.
    """
    now, model, known, table = None, [], None, None
    for batch in batches:
        out = []
        for at in range(batch.num_rows):
            one, block = batch.column("slice")[at].as_py(), batch.column("block")[at].as_py()
            if one != now:
                now, model, known = one, [], None
            keys = sieve.unzip_sorted(batch.column("keys")[at].as_buffer(), np.uint64)
            if block is None:
                model.append((keys, _unzip(batch.column("answers")[at].as_buffer(), np.int64, 3 * len(keys)).reshape(3, -1)))
                continue
            if known is None:
                known = np.concatenate([k for k, _ in model]) if model else np.zeros(0, np.uint64)
                order, model_values = np.argsort(known), [v for _, v in model]
                known = known[order]
                table, model = (np.concatenate(model_values, axis=1)[:, order] if model_values else None), []
            found = np.zeros((3, len(keys)), np.int64)
            if len(known):
                place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[place] == keys
                found[:, hit] = table[:, place[hit]]
            out.append((block, one, _zip(found.reshape(-1))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64(), pa.int32(), pa.binary()])], ["block", "slice", "answers"])
    known = table = None
    give_back()


class Automaton:
    """States, arcs and failure arcs over the words of a block; state 0 is the empty history.

    States up to ``short`` are histories of one word, those after it of two. State 0 has an arc for every word, in ``plain``
    and ``onward``; other arcs have a number, by which ``weights`` and ``targets`` list them.
    """

    def __init__(self, short, weights, targets, plain, onward, failure, price):
        self.short, self.weights, self.targets = short, weights, targets
        self.plain, self.onward, self.failure, self.price = plain, onward, failure, price

    def step(self, state: np.ndarray, word: np.ndarray, arc2: np.ndarray, arc3: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of a word in each state, and the state after it.

        ``arc2`` and ``arc3`` number the arcs of the word from histories of one and of two words, -1 for none. Where a state
        has no arc, its failure arc is taken.
        """
        score, state = np.zeros(len(state)), state.copy()
        for long, arcs in ((True, arc3), (False, arc2)):
            here = state > self.short if long else state > 0
            missing = here & (arcs < 0)
            score[missing] += self.price[state[missing]]
            state[missing] = self.failure[state[missing]]
        # now every state has the arc: the longest history that has one
        arc = np.where(state > self.short, arc3, np.where(state > 0, arc2, -1))
        taken = arc >= 0
        score += np.where(taken, self.weights[arc], self.plain[word])
        return score, np.where(taken, self.targets[arc], self.onward[word])


def _automaton(block: _Block, look, tokens: int, distinct: int, discount: float):
    """The part of the model a block's texts can reach, with the arc numbers of each transition; ``look`` gives the count, the
    number and the sum of kept successors of keys."""
    c1, s1, t1 = look(block.hash)
    plain = (c1 + 0.5) / (tokens + 0.5 * (distinct + 1))
    c2, s2, t2 = look(block.pair_key)
    c3 = look(block.triple_key)[0]
    one, two = np.flatnonzero(s1 > 0), np.flatnonzero(s2 > 0)
    state1, state2 = np.zeros(block.width, np.int64), np.zeros(len(block.pair), np.int64)
    state1[one] = 1 + np.arange(len(one))
    state2[two] = 1 + len(one) + np.arange(len(two))
    back1 = np.where(s1 > 0, 1 - (t1 - discount * s1) / np.maximum(c1, 1), 1.0)
    back2 = np.where(s2 > 0, 1 - (t2 - discount * s2) / np.maximum(c2, 1), 1.0)
    first, second = block.pair // block.width, block.pair % block.width
    p2 = np.where(c2 > 0, (c2 - discount) / np.maximum(c1[first], 1), 0) + back1[first] * plain[second]
    after2 = np.where(state2 > 0, state2, state1[second])
    arcs2, arcs3 = np.flatnonzero(c2 > 0), np.flatnonzero(c3 > 0)
    history, last = block.triple[arcs3] // block.width, block.triple[arcs3] % block.width
    tail = np.searchsorted(block.pair, second[history] * block.width + last)  # the pair a triple ends with
    p3 = (c3[arcs3] - discount) / c2[history] + back2[history] * p2[tail]
    # one number more, that of no arc
    number2, number3 = np.full(len(block.pair) + 1, -1, np.int32), np.full(len(block.triple) + 1, -1, np.int32)
    number2[arcs2] = np.arange(len(arcs2))
    number3[arcs3] = len(arcs2) + np.arange(len(arcs3))
    machine = Automaton(
        len(one), np.log10(np.concatenate([p2[arcs2], p3, [1.0]])), np.concatenate([after2[arcs2], after2[tail], [0]]),
        np.log10(plain), state1, np.concatenate([[0], np.zeros(len(one), np.int64), state1[second[two]]]),
        np.log10(np.concatenate([[1.0], back1[one], back2[two]])),
    )
    return machine, c1, state1, state2, number2[block.pair_at], number3[block.triple_at]


def _scored(sieves: list[sieve.Sieve], slices: int, tokens: int, distinct: int, discount: float, lane: int):
    """Rows of texts, from a block's answers in the order of their slices and then the block itself."""

    def of(batch, row, blobs):
        block = _Block(batch, row, sieves)
        keys = block.names()
        values = np.zeros((3, len(keys)), np.int64)
        for (_, a, b), blob in zip(_sliced(keys, slices), blobs, strict=True):
            values[:, a:b] = _unzip(blob, np.int64, 3 * (b - a)).reshape(3, -1)
        machine, c1, state1, state2, arc2, arc3 = _automaton(
            block, lambda k: values[:, np.searchsorted(keys, k)], tokens, distinct, discount
        )
        texts = len(block.sizes)
        length = block.sizes + 1
        lanes = -(-length // lane)
        text = np.repeat(np.arange(texts), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = block.start[text] + nth * lane
        size = np.minimum(lane, block.start[text + 1] - begin)
        # a stretch that begins inside a text begins in the state its last two words lead to
        inner = np.where(nth > 0, block.pair_at[begin - 1], -1)
        state = np.where(inner >= 0, state2[inner], 0) if len(state2) else np.zeros(len(text), np.int64)
        state = np.where(state > 0, state, state1[block.before[begin]])
        order = np.argsort(-size, kind="stable")
        begin, size, text, state = begin[order], size[order], text[order], state[order]
        sums = np.zeros(len(text))
        left = -size
        for step in range(int(size[0])):
            live = int(np.searchsorted(left, -step, "left"))
            at = begin[:live] + step
            got, state[:live] = machine.step(state[:live], block.now[at], arc2[at], arc3[at])
            sums[:live] += got
        back = np.argsort(order, kind="stable")
        score = np.bincount(text[back], sums[back], texts)
        owner = np.repeat(np.arange(texts), length)
        base = np.bincount(owner, machine.plain[block.now], texts)
        known = np.bincount(owner, (c1 > 0)[block.now], texts).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("ids")[row].values, batch.column("held_out")[row].values, pa.array(length), pa.array(known),
             pa.array(np.full(texts, tokens)), pa.array(base), pa.array(score)],
            ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def run(batches):
        now, blobs = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                if (one := batch.column("block")[at].as_py()) != now:
                    now, blobs = one, []
                if batch.column("names")[at].is_valid:
                    yield of(batch, at, blobs)
                    blobs = []
                    give_back()
                else:
                    blobs.append(batch.column("answers")[at].as_py())

    return run


def score(
    docs: DataFrame, id_col: str, text_col: str, held_out: Column, least: int = LEAST, discount: float = DISCOUNT,
    block_bytes: int = BLOCK_BYTES, lane: int = LANE,
) -> DataFrame:
    """One row per row of ``docs``: ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    A-Z are lower-cased; tokens are what stands between ASCII white space, then one end mark. The model learns from the rows
    where ``held_out`` is false or null. ``base_score`` adds up log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens, with
    ``c`` a token's count, ``N`` (``train_tokens``) all and ``V`` the distinct training tokens; ``n_known`` counts tokens
    with ``c > 0``. ``score`` is the model's log10 probability; its shortest history is the base. A null or empty text is
    its end mark. Repeated rows count and are scored each; a null id stays null. Other columns are not looked at. Without
    training rows all words are unknown, without rows there is no result. Words are told apart by 64-bit hashes. Blocks are
    of ``block_bytes`` of text at least and one text at most: a text must fit in a task.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), utf8(text_col).alias("text"))
    kind = dict(texts.dtypes)["id"]
    columns = f"block long, ids array<{kind}>, held_out array<boolean>, sizes array<int>, names binary, tokens binary"
    staged = written(texts.mapInArrow(_blocks_of_tokens(block_bytes), columns))
    size = staged.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n + 1))).first()[0] or 0
    bits = sieve.counted_bits(size)
    sieves = []
    for _ in ("pairs", "triples"):
        packed = staged.mapInArrow(_packed(list(sieves), bits, least), "slice int, keys binary")
        sieves.append(sieve.of_frequent(packed, bits, least, size, COUNTING_BITS))
        collect_garbage(spark)  # after the next job, as Spark keeps hold of the last one's files
    slices = 1 << (max(0, -(-size // SLICE_ROWS) - 1)).bit_length()
    tasks = max(slices, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = staged.mapInArrow(_training_grams(sieves, slices), "slice int, keys binary, parents binary, counts binary")
    counts = written(
        packed.repartition(tasks, "slice").sortWithinPartitions("slice").mapInArrow(_summed(least), "slice int, key long, parent long, n long")
    )
    del packed
    tokens, distinct = counts.where("parent = 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    collect_garbage(spark)
    kept = counts.where("parent <> 0").groupBy(F.col("parent").alias("history")).agg(F.count("*").alias("kept"), F.sum("n").alias("total"))
    model = counts.join(kept, F.col("key") == F.col("history"), "left").select(
        "slice", "key", "n", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("kept", "total")]
    )
    told = written(model.mapInArrow(_packed_model, "slice int, keys binary, answers binary"))
    del kept, model
    forget(counts)
    told = told.withColumn("block", F.lit(None).cast("long"))
    result = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def answered(mine: DataFrame, wide: int) -> DataFrame:
        asked = mine.mapInArrow(_questions(sieves, slices), "slice int, block long, keys binary").withColumn("answers", F.lit(None).cast("binary"))
        met = told.unionByName(asked).repartition(tasks, "slice").sortWithinPartitions("slice", F.asc_nulls_first("block"))
        answers = met.mapInArrow(_answers, "block long, slice int, answers binary")
        blank = [F.lit(None).cast(t).alias(c) for c, t in mine.dtypes if c != "block"]
        together = answers.select("block", "slice", "answers", *blank).union(
            mine.select("block", F.lit(1 << 30).alias("slice"), F.lit(None).cast("binary").alias("answers"), *[c for c in mine.columns if c != "block"])
        )
        ready_ = together.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), wide), "block")
        return ready_.sortWithinPartitions("block", "slice").mapInArrow(_scored(sieves, slices, tokens, distinct, discount, lane), result)

    wide = -(-size * 6 // block_bytes)
    rounds = max(1, min(ROUNDS, wide // ROUND_BLOCKS))
    if rounds == 1:
        return answered(staged, wide)
    # a task's neighbouring blocks fall in different rounds, and so do the first blocks of neighbouring tasks
    turn = (F.col("block") % (1 << 32) + F.shiftright("block", 32)) % rounds
    done = []
    for nth in range(rounds):
        one = answered(staged.where(turn == nth), -(-wide // rounds))
        done.append(one if nth == rounds - 1 else written(one))
        del one
        collect_garbage(spark)
    return reduce(DataFrame.union, done)
