"""Language-model scoring with a weighted backoff automaton.

The model is a smoothed bigram model over words. Its automaton has a root and one state for each word. A state has
arcs for all words seen after it, and a failure arc with a weight to the root, where every word has its smoothed
unigram probability. A text is read once from left to right: the automaton is in the state of the last word, takes
the arc of the next word if there is one, or else the failure arc and the root's arc, and adds up log10
probabilities.

Unigram counts, failure weights and arcs cover all training texts and stay distributed. Frequent ones are broadcast
besides, as a cache that changes no score. It has a bound by counting: no more than ``HEAD`` words can each be a
``HEAD``-th part of all tokens, and no more than ``ARCS`` pairs an ``ARCS``-th part.

Pairs that are not at hand are dealt out to parts of about ``SLICE`` tokens. A pair goes to the part of its first word
if that is rare, else to that of its second word if that is rare, else by both. So the part of a rare word has all
arcs of its state, and no part has more than its share of a frequent word. Texts are dealt out alike and meet the arcs
there. What is dealt out are packed columns of numbers: ids of words at hand and hashes of 63 bits of the others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial, reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Words at hand in every worker are those with at least this part of all tokens; so are pairs of such words.
HEAD, ARCS = 1 << 19, 1 << 20
DISCOUNT = 0.75
#: The token after the last word. It cannot be a word, as words hold no white space.
END = "\n"
_FLUSH = 500_000
_START = 0  # the state before the first word
#: Tokens that a worker reads before it deals them out, tokens of a part, and texts whose words are told at once.
FLUSH, SLICE, READS = 1 << 20, 1 << 19, 64
#: Parts are met in so many turns, as what is dealt out in each needs room on disk.
TURNS = 2
#: The highest bit is set in codes of rare words only; the code of no word stands for whatever is before a word.
RARE, ANY = np.uint64(1 << 63), np.uint64((1 << 63) - 1)
#: What a row of dealt columns holds. In a part, rows are read in this order.
PAIRS, ASKED, WORDS, TYPES, HOT, OWN, SUMS, READ = range(8)
DEALT = "part long, kind int, at long, blob binary"


def unigrams(texts: DataFrame) -> DataFrame:
    """(word, c) of all tokens of the single column of ``texts``, ends included."""
    name = texts.columns[0]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        ends = 0

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])
            seen.clear()
            return made

        for b in batches:
            for text in b.column(name).to_pylist():
                ends += 1
                if text:
                    seen.update(text.encode("utf-8", "replace").lower().split())
                if len(seen) > _FLUSH:
                    yield out()
        if ends:
            seen[END.encode()] += ends
        if seen:
            yield out()

    return texts.mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Automaton:
    """States are ids below ``states``; 0 is the start. Words beyond have no state and lead to the root (-1)."""

    total: int
    distinct: int
    words: dict[str, int] = field(default_factory=dict)
    counts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    states: int = 1
    arcs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    failure: np.ndarray = field(default_factory=lambda: np.zeros(1))
    followed: np.ndarray = field(default_factory=lambda: np.zeros(1))
    parts: int = 1

    def base(self, c) -> np.ndarray:
        """log10 of the root's probability of a word with count ``c``."""
        return np.log10((np.asarray(c) + 1) / (self.total + self.distinct + 1))

    def code(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        return state.astype(np.int64) * (len(self.counts) + 1) + word

    def build(self, pairs: np.ndarray, n: np.ndarray, followed: np.ndarray, rest: np.ndarray | None = None) -> None:
        """Arcs from bigram codes with their counts; the failure arc of a state gets the probability left over.

        ``rest`` gives what is left over where ``pairs`` are not all there are.
        """
        order = np.argsort(pairs)
        pairs, n = pairs[order], n[order]
        state, word = pairs // (len(self.counts) + 1), pairs % (len(self.counts) + 1)
        if rest is None:
            taken = np.bincount(state, weights=n - DISCOUNT, minlength=self.states)
            rest = np.where(followed > 0, 1 - taken / np.maximum(followed, 1), 1.0)
        root = 10.0 ** self.base(self.counts)
        self.arcs = pairs
        self.weights = np.log10((n - DISCOUNT) / followed[state] + rest[state] * root[word])
        self.failure = np.log10(rest)

    def taken(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The state before each word, its arc's place, and whether that arc is at hand.

        The state before each word depends on the word before it alone, so all steps are taken at once.
        """
        before = np.concatenate(([_START], ids[:-1]))
        before = np.where(before < self.states, before, -1)
        codes = np.where((before >= 0) & (ids >= 0), self.code(before, ids), -1)
        at = np.searchsorted(self.arcs, codes)
        at[at == len(self.arcs)] = 0
        return before, at, (self.arcs[at] == codes) & (codes >= 0) if len(self.arcs) else np.zeros(len(ids), bool)

    def traverse(self, ids: np.ndarray) -> tuple[float, np.ndarray]:
        """Reads word ids (-1: a rare word) from the start state; log10 probability without the root arcs of rare
        words, and where the root's arc was taken for one."""
        before, at, found = self.taken(ids)
        score = self.weights[at[found]].sum() if found.any() else 0.0
        missed = ~found
        score += self.failure[before[missed & (before >= 0)]].sum()
        known = missed & (ids >= 0)
        return float(score + self.base(self.counts[ids[known]]).sum()), missed & (ids < 0)

    def ids(self, words: list[str]) -> np.ndarray:
        get = self.words.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))


class Codes:
    """Codes of words as UTF-8: ids of those at hand, 63 bits of a hash below the highest bit of others."""

    def __init__(self, words: dict[str, int]):
        own = [(w.encode("utf-8", "replace"), i) for w, i in words.items() if w != END]
        keys, ids = hashes([w for w, _ in own])[0], np.array([i for _, i in own], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], ids[order]
        # Keys are looked up from where those with the same first bits begin.
        bits = min(24, max(4, 2 + len(own).bit_length()))
        self.shift = np.uint64(63 - bits)
        self.begin = np.searchsorted(self.keys, np.arange((1 << bits) + 1, dtype=np.uint64) << self.shift)
        self.end = np.uint64(words[END]) if END in words else RARE

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the words of all ``texts``, each between the start and the end, and how many each text has of these."""
        found, sizes = hashes(texts)
        out, inside, ends = np.zeros(len(found) + 2 * len(sizes), np.uint64), np.ones(len(found) + 2 * len(sizes), bool), np.cumsum(sizes + 2)
        inside[ends - 1] = inside[ends - sizes - 2] = False
        out[inside], out[ends - sizes - 2], out[ends - 1] = self.codes(found), _START, self.end
        return out, sizes + 2

    def codes(self, found: np.ndarray) -> np.ndarray:
        out, todo, first = found | RARE, np.arange(len(found)), (found >> self.shift).astype(np.int64)
        at, end = self.begin[first], self.begin[first + 1]
        while len(todo):
            more = at < end
            todo, at, end = todo[more], at[more], end[more]
            hit = self.keys[at] == found[todo]
            out[todo[hit]] = self.ids[at[hit]]
            todo, at, end = todo[~hit], at[~hit] + 1, end[~hit]
        return out


_LOWER = np.array([b + 33 if 65 <= b <= 90 else b + 1 for b in range(256)], np.uint64)
_BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_factors = np.zeros(0, np.uint64)


def hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """63 bits for each word of ``texts`` as UTF-8, A-Z in lower case, and the number of words of each text."""
    global _factors
    data = np.frombuffer(b" ".join([t or b"" for t in texts]), np.uint8)
    inside = ~_BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts, at = np.flatnonzero(begins), np.flatnonzero(inside)
    first = np.flatnonzero(begins[at])
    place = at - np.repeat(starts, np.diff(np.append(first, len(at))))
    longest = int(place.max()) + 1 if len(place) else 1
    if longest > len(_factors):  # odd numbers, one for each place in a word
        _factors = mixed(np.arange(1, max(longest, 256) + 1, dtype=np.uint64), np.zeros(1, np.uint64)) | np.uint64(1)
    sums = np.add.reduceat(_LOWER[data[at]] * _factors[place], first) if len(first) else np.zeros(0, np.uint64)
    edges = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    return mixed(sums, np.zeros(1, np.uint64)) >> np.uint64(1), np.diff(np.searchsorted(starts, edges))


def rare(codes: np.ndarray) -> np.ndarray:
    return codes >= RARE


def mixed(prev: np.ndarray, word: np.ndarray, salt: int = 0) -> np.ndarray:
    """A number of 64 bits for each pair of codes."""
    x = (prev ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = ((x ^ (x >> np.uint64(32))) + word) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def part_of(prev: np.ndarray, word: np.ndarray, parts: int) -> np.ndarray:
    """The part of each pair: that of its rare word, of the first one if both are, or one by both words."""
    key = np.where(rare(prev), prev, np.where(rare(word), word, mixed(prev, word)))
    return (mixed(key, key) % np.uint64(parts)).astype(np.int64)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length as bytes of equal weight next to each other, without those that are zero in all rows."""
    out = [len(columns[0]).to_bytes(8, "little")]
    for c in columns:
        planes = np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T)
        kept = planes.any(axis=1)
        out += [np.packbits(kept, bitorder="little").tobytes(), planes[kept].tobytes()]
    return b"".join(out)


def unpack(blob: bytes, *types: type) -> list[np.ndarray]:
    """The columns of ``pack``, whose types have at most 8 bytes."""
    raw, out, at = np.frombuffer(blob, np.uint8), [], 9
    n = int.from_bytes(blob[:8], "little")
    for t in map(np.dtype, types):
        kept = np.unpackbits(raw[at - 1 : at], bitorder="little")[: t.itemsize].astype(bool)
        planes, size = np.zeros((t.itemsize, n), np.uint8), n * int(kept.sum())
        planes[kept] = raw[at : at + size].reshape(-1, n) if size else 0
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(n))
        at += size + 1
    return out


def kinds(prev: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Which of the words of each pair are rare: pairs of a kind are packed by themselves."""
    return rare(prev) * 2 + rare(word)


def summed(prev: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs in order, with the sums of ``n``."""
    order = np.lexsort((word, prev))
    prev, word = prev[order], word[order]
    first = np.flatnonzero(np.concatenate(([True], (prev[1:] != prev[:-1]) | (word[1:] != word[:-1])))[: len(prev)])
    return prev[first], word[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def tallied(prev: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs with their numbers, in no order; should two pairs share their number of 64 bits, one may come more than once."""
    order = np.argsort(mixed(prev, word))
    prev, word = prev[order], word[order]
    first = np.flatnonzero(np.concatenate(([True], (prev[1:] != prev[:-1]) | (word[1:] != word[:-1])))[: len(prev)])
    return prev[first], word[first], np.diff(np.append(first, len(prev)))


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` are in the sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["part", "kind", "at", "blob"])


def _deal(kind: int, at: int, parts: int, prev: np.ndarray, word: np.ndarray, column: np.ndarray, turn: int = 0, turns: int = 1) -> Iterator[tuple[int, int, int, bytes]]:
    """A row for each part, of those whose turn it is, and each kind of pairs that it has some of."""
    part = part_of(prev, word, parts)
    if turns > 1:
        own = part % turns == turn
        part, prev, word, column = part[own], prev[own], word[own], column[own]
    key = part * 4 + kinds(prev, word)
    order = np.argsort(key.astype(np.uint16) if parts < 1 << 14 else key, kind="stable")
    key, prev, word, column = key[order], prev[order], word[order], column[order]
    bounds = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))) if len(key) else []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield int(key[a]) // 4, kind, at, pack(prev[a:b], word[a:b], column[a:b])


def _flushes(batches: Iterator[pa.RecordBatch], name: str, words: dict[str, int]) -> Iterator[tuple[int, list[pa.RecordBatch], np.ndarray, np.ndarray, np.ndarray]]:
    """(number, batches, prev, word, text) of about ``FLUSH`` tokens at a time, ``text`` being the place among the texts."""
    number, codes, held, read, size = TaskContext.get().partitionId() << 32, Codes(words), [], [], 0

    def out() -> tuple[int, list[pa.RecordBatch], np.ndarray, np.ndarray, np.ndarray]:
        every, sizes = (np.concatenate(x) for x in zip(*read, strict=True))
        last = np.cumsum(sizes) - 1
        return number, held, np.delete(every, last), np.delete(every, last - sizes + 1), np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes - 1)

    for b in batches:
        held.append(b)
        texts = b.column(name).cast(pa.binary())
        for k in range(0, len(texts), READS):  # few at once, whose arrays stay in the processor's cache
            read.append(codes.of(texts[k : k + READS].to_pylist()))
            size += len(read[-1][0])
        if size >= FLUSH:
            yield out()
            number, held, read, size = number + 1, [], [], 0
    if read:
        yield out()


def _by_part(rows: DataFrame, parts: int, made: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """What ``made`` makes of the rows, those of a part one after the other and by kind."""
    return rows.repartition(max(1, min(parts, 2000)), "part").sortWithinPartitions("part", "kind", "at").mapInArrow(made, DEALT)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, int, int, bytes]]]]:
    return groupby(_each(batches), key=lambda r: r[0])


def train(texts: DataFrame, head: int = HEAD, arcs: int = ARCS) -> tuple[Automaton, DataFrame]:
    """The cache of the automaton of the single text column of ``texts``, and the whole of it as a table.

    The table has rows of packed columns for each part: all pairs of words with their number, and numbers of rare words
    that are the second of a pair of two. Null texts count as empty ones, of which the end is the only token. Without
    any training text the root gives every token the same probability.
    """
    spark, name = texts.sparkSession, texts.columns[0]
    common.small_batches(spark)
    counts = common.store(unigrams(texts), "lm-unigrams")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    model = Automaton(total, distinct)
    # Word ids start at 1, most frequent first; 0 is the start.
    often = counts.filter(F.col("c") * head >= total).orderBy(F.desc("c"), "word").toArrow()
    common.discard(counts)
    model.words = {w: i + 1 for i, w in enumerate(often.column("word").to_pylist())}
    model.counts = np.concatenate(([0], often.column("c").to_numpy())).astype(np.int64)
    model.states, model.parts = len(model.counts), 1 + total // SLICE
    shared, states, parts = spark.sparkContext.broadcast(model.words), model.states, model.parts

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, prev, word, _ in _flushes(batches, name, shared.value):
            prev, word, n = tallied(prev, word)
            # A rare word after a rare one is counted in its own part as well.
            both = rare(prev) & rare(word)
            own = summed(np.full(both.sum(), ANY), word[both], n[both])
            yield _rows(list(_deal(PAIRS, 0, parts, *(np.concatenate(x) for x in zip((prev, word, n), own, strict=True)))))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, followed = np.zeros(states, np.int64), np.zeros(states, np.int64)
        for part, rows in _groups(batches):
            prev, word, n = summed(*map(np.concatenate, zip(*(unpack(r[3], np.uint64, np.uint64, np.int64) for r in rows), strict=True)))
            of = kinds(prev, word)
            out = [(part, PAIRS, 0, pack(prev[of == k], word[of == k], n[of == k])) for k in np.unique(of)]
            at_hand = ~rare(prev) & (prev != ANY)
            types += np.bincount(prev[at_hand].astype(np.int64), minlength=states)
            np.add.at(followed, prev[at_hand].astype(np.int64), n[at_hand])
            hot = at_hand & ~rare(word) & (n * arcs >= total)
            if hot.any():
                out.append((part, HOT, 0, pack(prev[hot], word[hot], n[hot])))
            both = np.unique(word[rare(prev) & rare(word)])
            out += [(p, ASKED, part, blob) for p, _, _, blob in _deal(ASKED, 0, parts, np.full(len(both), ANY), both, np.zeros(len(both), np.uint8))]
            own, c = counted(prev, word, n)
            asked = found(np.sort(word[prev == ANY]), own)[1]
            if asked.any():
                out.append((part, WORDS, 0, pack(own[asked], c[asked])))
            yield _rows(out)
        some = np.flatnonzero(types)
        if len(some):
            yield _rows([(0, TYPES, 0, pack(some, types[some], followed[some]))])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            rows = list(rows)
            own, c = map(np.concatenate, zip(*(unpack(r[3], np.uint64, np.int64) for r in rows if r[1] == WORDS), strict=True))
            order = np.argsort(own)
            own, c = own[order], c[order]
            for _, _, part, blob in (r for r in rows if r[1] == ASKED):
                asked = unpack(blob, np.uint64, np.uint64, np.uint8)[1]
                yield _rows([(part, WORDS, 0, pack(asked, c[found(own, asked)[0]]))])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, blob in _each(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in unpack(blob, np.int64, np.int64, np.int64)], names=["id", "types", "followed"])

    merged = common.store(_by_part(texts.mapInArrow(deal, DEALT), parts, merge), "lm-pairs")
    common.sweep(spark)
    answers = common.store(_by_part(merged.filter(F.col("kind").isin(ASKED, WORDS)), parts, answer), "lm-words")
    table = merged.filter(F.col("kind") == PAIRS).unionByName(answers)
    of = merged.filter(F.col("kind") == TYPES).mapInArrow(spread, "id long, types long, followed long").groupBy("id").agg(F.sum("types").alias("types"), F.sum("followed").alias("followed")).toArrow()
    ids, types = of.column("id").to_numpy(), np.zeros(states)
    model.followed = np.zeros(states)
    types[ids], model.followed[ids] = of.column("types").to_numpy(), of.column("followed").to_numpy()
    rest = np.where(types > 0, DISCOUNT * types / np.maximum(model.followed, 1), 1.0)
    model.failure = np.log10(rest)
    hot = [unpack(r["blob"], np.uint64, np.uint64, np.int64) for r in merged.filter(F.col("kind") == HOT).select("blob").collect()]
    if hot:
        prev, word, n = map(np.concatenate, zip(*hot, strict=True))
        model.build(model.code(prev, word.astype(np.int64)), n, model.followed, rest)
    return model, table


def counted(prev: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rare words of a part in order, with their numbers: all that stand after words at hand or have a count of their own."""
    own = rare(word) & ~rare(prev)
    _, words, c = summed(np.full(own.sum(), ANY), word[own], n[own])
    return words, c


class Part:
    """The arcs of a part, and failure weights and numbers of its rare words."""

    def __init__(self, model: Automaton, rows: list[tuple[int, int, int, bytes]]):
        self.model = model
        pairs = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)), *(unpack(r[3], np.uint64, np.uint64, np.int64) for r in rows if r[1] == PAIRS)]
        prev, word, n = map(np.concatenate, zip(*pairs, strict=True))
        order = np.argsort(prev, kind="stable")
        prev, word, n = prev[order], word[order], n[order]
        answers = [unpack(r[3], np.uint64, np.int64) for r in rows if r[1] == WORDS]
        self.words, self.counts = counted(prev, word, n)
        pair = prev != ANY
        prev, word, n = prev[pair], word[pair], n[pair]
        first = np.flatnonzero(rare(prev) & np.concatenate(([True], prev[1:] != prev[:-1]))[: len(prev)])  # rare ones come last
        self.prevs = prev[first]
        followed = np.add.reduceat(n, first) if len(first) else n[:0]
        self.failure = np.log10(DISCOUNT * np.diff(np.append(first, len(prev))) / followed)
        at, own = found(self.prevs, prev)
        place = np.where(own, 0, prev).astype(np.int64)
        f, fail = model.followed[place], model.failure[place]
        f[own], fail[own] = followed[at[own]], self.failure[at[own]]
        c = model.counts[np.where(rare(word), 0, word).astype(np.int64)]
        at, here = found(self.words, word)
        c[here] = self.counts[at[here]]
        both = own & rare(word)
        if answers:
            asked, numbers = map(np.concatenate, zip(*answers, strict=True))
            order = np.argsort(asked)
            c[both] = numbers[order][found(asked[order], word[both])[0]]
        root = model.base(c)
        gain = np.log10((n - DISCOUNT) / f + 10.0 ** (fail + root)) - fail - root
        self.salt, keys = 0, mixed(prev, word)
        while len(np.unique(keys)) < len(keys):
            self.salt += 1
            keys = mixed(prev, word, self.salt)
        order = np.argsort(keys)
        self.keys, self.prev, self.word, self.gain = keys[order], prev[order], word[order], gain[order]

    def sums(self, prev: np.ndarray, word: np.ndarray, text: np.ndarray) -> bytes:
        """What the pairs of a flush add to its texts: log10 probabilities of rare words, their number, and gains of arcs."""
        gain, base, known = np.zeros(len(prev)), np.zeros(len(prev)), np.zeros(len(prev), np.int64)
        at, have = found(self.keys, mixed(prev, word, self.salt))
        if len(self.keys):
            have &= (self.prev[at] == prev) & (self.word[at] == word)
            gain[have] = self.gain[at[have]]
        at, have = found(self.prevs, prev)
        gain[have] += self.failure[at[have]]
        own = rare(word) & ~rare(prev)
        at, have = found(self.words, word[own])
        c = np.zeros(len(at), np.int64)
        c[have] = self.counts[at[have]]
        base[own], known[own] = self.model.base(c), c > 0
        texts, at = np.unique(text, return_inverse=True)
        add = lambda x: np.bincount(at, weights=x, minlength=len(texts))
        return pack(texts, add(base), add(gain), add(known).astype(np.uint32))


def score(docs: DataFrame, model: Automaton, counts: DataFrame, key: str = "doc_id", text: str = "text", flag: Column | None = None) -> DataFrame:
    """(key, flag, n_tokens, n_known, base_score, score) for every row of ``docs``, over whole texts.

    base_score sums the root's log10 probabilities, score the automaton's. Words and pairs that are not at hand in a
    worker are dealt out to meet the table ``counts`` of ``train``, and their sums come back to their text. A null text
    counts as empty. Rows that repeat keep a row each; other columns play no part.
    """
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), (F.lit(False) if flag is None else flag).alias("flag"), F.col(f"`{text}`").alias("text"))

    def read(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for number, held, prev, word, text in _flushes(batches, "text", own.words):
            near, both, rest = ~rare(prev), ~rare(word), np.ones(len(prev), bool)
            fast = np.flatnonzero(near & both)
            at, have = found(own.arcs, own.code(prev[fast], word[fast].astype(np.int64)))
            fast, at = fast[have], at[have]
            rest[fast] = False
            if not turn:
                base, gain = np.zeros(len(prev)), np.zeros(len(prev))
                base[both] = own.base(own.counts)[word[both].astype(np.int64)]
                gain[near] = own.failure[prev[near].astype(np.int64)]
                gain[fast] = own.weights[at] - base[fast]
                n = sum(b.num_rows for b in held)
                of = lambda x: pa.array(np.bincount(text, weights=x, minlength=n))  # noqa: B023, E731
                columns = [pa.concat_arrays([b.column(c) for b in held]) for c in ("key", "flag")]
                columns += [pa.array(np.bincount(text, minlength=n)), pa.array(np.bincount(text[both], minlength=n)), of(base), of(gain)]
                batch = pa.RecordBatch.from_arrays(columns, names=["key", "flag", "tokens", "known", "base", "gain"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as out:
                    out.write_batch(batch)
                yield _rows([(number % own.parts // turns * turns, OWN, number, sink.getvalue().to_pybytes())])
            # A rare word after a rare one meets its number in its own part as well.
            twice = ~near & ~both
            columns = (prev[rest], np.full(twice.sum(), ANY)), (word[rest], word[twice]), (text[rest], text[twice])
            if made := list(_deal(READ, number, own.parts, *map(np.concatenate, columns), turn, turns)):
                yield _rows(made)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            held, part = [], None
            for (what, number), own in groupby(rows, key=lambda r: r[1:3]):
                if what == READ:
                    part = part or Part(shared.value, held)
                    pairs = zip(*(unpack(r[3], np.uint64, np.uint64, np.uint32) for r in own), strict=True)
                    yield _rows([(0, SUMS, number, part.sums(*map(np.concatenate, pairs)))])
                elif what == OWN:
                    yield _rows(list(own))
                else:
                    held += own

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_each(batches), key=lambda r: r[2]):
            _, _, _, blob = next(rows)
            own = pa.ipc.open_stream(blob).read_all().combine_chunks().to_batches()[0]
            known, base, gain = (own.column(c).to_numpy().copy() for c in ("known", "base", "gain"))
            for r in rows:
                texts, b, g, k = unpack(r[3], np.uint32, np.float64, np.float64, np.uint32)
                base[texts] += b
                gain[texts] += g
                known[texts] += k
            yield pa.RecordBatch.from_arrays([own.column("key"), own.column("flag"), own.column("tokens"), *map(pa.array, (known, base, base + gain))], names=[key, "flag", "n_tokens", "n_known", "base_score", "score"])

    met, turns = [], min(TURNS, model.parts)
    for turn in range(turns):
        dealt = rows.mapInArrow(partial(read, turn=turn), DEALT).unionByName(counts.filter(F.col("part") % turns == turn))
        met.append(common.store(_by_part(dealt, -(-model.parts // turns), meet), "lm-sums"))
        common.sweep(docs.sparkSession)
    return reduce(DataFrame.unionByName, met).repartition("at").sortWithinPartitions("at", "kind").mapInArrow(add, f"`{key}` {kind}, flag boolean, n_tokens long, n_known long, base_score double, score double")
