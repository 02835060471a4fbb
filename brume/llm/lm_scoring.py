"""Katz backoff model: Good-Turing discounts, exactly normalised backoff weights, evaluated recursively over all texts.

Tokens are words with ASCII letters lowered, and one end after each text; contexts before the first token are filled up
with the beginning. With c the training counts, d the Good-Turing discounts of an order for counts of 5 or less, h' the
context h without its first token, and one unknown word of its own:

    P(w)     = d(c(w)) c(w) / N,  the mass that is left for an unknown word
    P(w | h) = d(c(h w)) c(h w) / D(h)  if h w was seen, else a(h) P(w | h')
    a(h)     = (1 - sum of the seen P(w | h)) / (1 - sum of P(w | h') over the seen w)

D(h) is the context's count, one more where nothing in it is discounted (N, the count of all tokens, likewise), so a(h) is
never 0 and each context sums to 1. A context that was not seen has a(h) = 1.

Nothing is identified by a hash, which only says which bucket has a word. Words are gathered as they are and numbered; an n-gram is the number of its context, an
n-gram of the order below, and that of its last word, and gets a number in turn.

The corpus is cut into blocks of texts. A block asks for each different n-gram once, whatever its frequency, with its own
training counts; so an n-gram that a third of all rows share costs one entry per block. Words go to buckets by their hash,
n-grams to the bucket that numbered their context. A bucket adds up the counts, numbers the n-grams, keeps them as a row of the model's table of that
order, and answers each block in the order in which it asked. As all n-grams of a context meet, its bucket also has what
D(h) and a(h) need: the n-grams of the order below that a seen n-gram backs off to were all seen, so their sum is known
from counts. A context with more than `hot` tokens is dealt to several buckets by its last words, and their few sums are
added up and sent to all.

A unit of requests is cut into at most 2 ** `fan_bits` rows. Where there are more buckets than that, units are cut in even
steps: as many are merged as one was cut into rows, so what is merged is about as large as a unit at any size of corpus,
and the merged ones are cut further, and so on; answers come back the same way. So rows are in proportion to the corpus,
times the number of such steps.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import delete, setting
from .common import is_space, shared_dir, shuffles_end, slices, text_bytes, text_or_empty, word_starts, written
from .hashing import mix

NUMBER_BITS = 40  # of a number, those that count within a bucket; the others are the bucket
MOST_HOT = 200_000  # a context is hot if it has over one in so many of all tokens, so there are fewer than that
TOP = 5  # counts above it are not discounted
END = b"\n"  # no word has this byte
BATCH = 1 << 19  # bytes of rows that are handed on together
READ = "4m"  # of rows that Spark hands to a task's Python together: each batch is held by both
BLOCK, ASK, ANSWER, TABLE, HOT, WORDS = range(6)  # kinds of rows
ROWS = "kind int, `order` int, unit long, bucket long, sub long, `to` long, docs array<struct<doc_id: long, held: boolean, n: long>>, parts array<binary>, stats array<long>"
FIELDS = ["kind", "order", "unit", "bucket", "to"]  # of rows, beside their documents and parts
TYPES = {
    "kind": pa.int32(), "order": pa.int32(), "unit": pa.int64(), "bucket": pa.int64(), "sub": pa.int64(), "to": pa.int64(),
    "docs": pa.list_(pa.struct([("doc_id", pa.int64()), ("held", pa.bool_()), ("n", pa.int64())])), "parts": pa.list_(pa.binary()), "stats": pa.list_(pa.int64()),
}


def _pack(values: np.ndarray) -> bytes:
    """Length, least value, bytes a value: of whole numbers the distance to the least, in as few bytes as the largest needs; bytes of equal weight together, compressed.

    Equal values take no bytes. Of doubles all eight bytes are kept.
    """
    if values.dtype == np.float64:
        least, width, bits = 0, 8, np.ascontiguousarray(values).view(np.uint64)
    else:
        values = values.astype(np.int64, copy=False)
        least, most = (int(values.min()), int(values.max())) if len(values) else (0, 0)
        width = ((most - least).bit_length() + 7) // 8
        bits = (values - least).view(np.uint64)
    head = np.array([len(values), least, width], "<i8").tobytes()
    if not width or not len(values):
        return head
    kind = np.dtype("u1") if width == 1 else np.dtype("<u2") if width == 2 else np.dtype("<u4") if width <= 4 else np.dtype("<u8")
    planes = bits.astype(kind, copy=False).view(np.uint8).reshape(-1, kind.itemsize)[:, :width].T
    return head + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes))


def _unpack(data: bytes, dtype=np.int64) -> np.ndarray:
    n, least, width = np.frombuffer(data, "<i8", 3).tolist()
    if not width or not n:
        return np.full(n, least, np.int64).astype(dtype, copy=False)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(memoryview(data)[24:]), np.uint8).reshape(width, n)
    out = planes[width - 1].astype(np.int64)
    for plane in planes[:-1][::-1]:
        out <<= 8
        out |= plane
    if dtype == np.float64:
        return out.view(np.float64)
    out += least
    return out


def _pack_steps(values: np.ndarray) -> bytes:
    """Numbers that mostly rise by little: the first, and the steps from each to the next."""
    return values[:1].astype("<i8").tobytes() + _pack(np.diff(values)) if len(values) else b""


def _unpack_steps(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    return np.cumsum(np.append(np.frombuffer(data, "<i8", 1), _unpack(data[8:])))


def _pack_codes(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, of very uneven frequency: the bit length of each, then what is below its first bit, length by length."""
    values = values.astype(np.int64, copy=False)
    length = np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    if len(values) and values.max() >= 1 << 53:  # a double may round these up to one bit more
        length -= (length > 0) & (values >> np.maximum(length, 1).astype(np.int64) - 1 == 0)
    order = np.argsort(length, kind="stable")
    ends = np.cumsum(np.bincount(length, minlength=1)).tolist()
    parts, ordered = [], values[order]
    for n in range(2, len(ends)):
        if ends[n] > ends[n - 1]:
            below = ordered[ends[n - 1] : ends[n]] - (1 << n - 1)
            parts += [(below >> 8 * k).astype(np.uint8) for k in reversed(range((n + 6) // 8))]
    packed = [zstandard.ZstdCompressor(level=1).compress(x) for x in (length, np.concatenate([np.zeros(0, np.uint8), *parts]))]
    return len(packed[0]).to_bytes(4, "little") + b"".join(packed)


def _unpack_codes(data: bytes) -> np.ndarray:
    cut = 4 + int.from_bytes(data[:4], "little")
    length, rest = (np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8) for x in (memoryview(data)[4:cut], memoryview(data)[cut:]))
    order = np.argsort(length, kind="stable")
    ends = np.cumsum(np.bincount(length, minlength=1)).tolist()
    ordered = (length[order] > 0).astype(np.int64)
    at = 0
    for n in range(2, len(ends)):
        m = ends[n] - ends[n - 1]
        if m:
            below = np.zeros(m, np.int64)
            for _ in range((n + 6) // 8):
                below <<= 8
                below |= rest[at : at + m]
                at += m
            ordered[ends[n - 1] : ends[n]] = below + (1 << n - 1)
    out = np.empty(len(length), np.int64)
    out[order] = ordered
    return out


def _pack_bytes(words: pa.Array) -> tuple[bytes, bytes]:
    data, at = text_bytes(words)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(data)), _pack(np.diff(at))


def _unpack_bytes(data: bytes, lengths: bytes) -> pa.Array:
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return slices(body, np.concatenate([[0], np.cumsum(_unpack(lengths))]))


def _by_hash(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The order of different words by their hashes, and these."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_numpy(zero_copy_only=False).tolist()), np.uint64, len(words))
    return np.argsort(hashes, kind="stable"), hashes


def _joined(arrays: list[np.ndarray], dtype=np.int64) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, dtype)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in TYPES.items()], names=list(TYPES))


def _batched(run: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What makes rows, as a function that gives them in batches of about BATCH bytes."""

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for row in run(given):
            held.append(row)
            size += sum(map(len, row["parts"]))
            if size >= BATCH:
                yield _rows(held)
                held, size = [], 0
        if held:
            yield _rows(held)

    return batches


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[list[dict]]:
    """Rows of sorted input, a list for each group; documents stay in Arrow."""
    held: list[dict] = []
    for batch in batches:
        parts, docs = batch.column("parts"), batch.column("docs")
        fields = [batch.column(k).to_pylist() for k in FIELDS]
        for i, values in enumerate(zip(*fields, strict=True)):
            row = dict(zip(FIELDS, values, strict=True))
            if held and any(held[0][k] != row[k] for k in keys):
                yield held
                held = []
            row["parts"] = parts[i].as_py()
            if row["kind"] == BLOCK:
                row["docs"] = docs.slice(i, 1).flatten()
            held.append(row)
    if held:
        yield held


def _different(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values in order, a place of each, and which one each value is."""
    bits = len(values).bit_length()
    if len(values) and values.min() >= 0 and int(values.max()).bit_length() + bits <= 63:  # sorted with their places in the low bits
        both = values.astype(np.int64) << bits
        both |= np.arange(len(values))
        both.sort()
        ordered, order = both >> bits, both
        order &= (1 << bits) - 1
    else:
        order = np.argsort(values)
        ordered = values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(values), np.int32)
    which[order] = np.cumsum(fresh, dtype=np.int32) - 1
    return ordered[fresh], order[fresh], which


def _bits(values: np.ndarray) -> int:
    return int(values.max(initial=0)).bit_length()


def _shorter(numbers: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in fewer bits, in the same order: without the bits that none has in its bucket."""
    low = numbers & ((1 << NUMBER_BITS) - 1)
    return (numbers >> NUMBER_BITS) << _bits(low) | low


def _ranked(major: np.ndarray, minor: np.ndarray, spare: int = 0) -> np.ndarray:
    """One number in the order of both, with `spare` bits to spare if ranks can take their place."""
    bits = _bits(minor)
    if _bits(major) + bits + spare > 62:
        major = _different(major)[2].astype(np.int64)
    if _bits(major) + bits + spare > 62:
        minor = _different(minor)[2].astype(np.int64)
        bits = _bits(minor)
    return major << bits | minor


class Cut:
    """Which bits of a bucket's number say how requests are cut: `take` bits after the `used` leading ones of all `bits`."""

    def __init__(self, bits: int, take: int = 0, used: int = 0):
        self.bits, self.take, self.used = bits, take, used

    def __call__(self, buckets: np.ndarray) -> np.ndarray:
        return (buckets >> (self.bits - self.used - self.take)) & ((1 << self.take) - 1)


class Words:
    """Requests for words: (their bytes, lengths, own counts), merged to different words in the order of their hashes.

    `code`: the word of each request, `count`: own counts together.
    """

    def __init__(self, rows: list[list[bytes]], cut: Cut):
        coded = pa.concat_arrays([_unpack_bytes(r[0], r[1]) for r in rows]).dictionary_encode()
        order, hashes = _by_hash(coded.dictionary)
        digit = cut((hashes >> np.uint64(64 - cut.bits)).astype(np.int64))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.words, self.digit = coded.dictionary.take(pa.array(order)), digit[order]
        self.code = place[coded.indices.to_numpy(zero_copy_only=False)]
        self.ends = np.cumsum([0] + [len(_unpack(r[2])) for r in rows])
        self.count = np.zeros(len(order), np.int64)
        np.add.at(self.count, self.code, _joined([_unpack(r[2]) for r in rows]))

    def requests(self) -> Iterator[tuple[int, list[bytes]]]:
        """Those of each run of hash bits."""
        edges = np.append(np.flatnonzero(np.diff(self.digit, prepend=-1)), len(self.digit))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield int(self.digit[a]), [*_pack_bytes(self.words.slice(a, b - a)), _pack(self.count[a:b])]

    def answers(self, known: tuple[np.ndarray, ...]) -> Iterator[list[bytes]]:
        """To each row of requests: counts, and numbers of those with a count."""
        count, number = known
        for a, b in zip(self.ends[:-1].tolist(), self.ends[1:].tolist(), strict=True):
            of = self.code[a:b]
            counts = count[of]
            yield [_pack(counts), _pack(number[of[counts > 0]])]

    @staticmethod
    def learn(answers: list[list[bytes]]) -> tuple[np.ndarray, ...]:
        count = _joined([_unpack(r[0]) for r in answers])
        number = np.full(len(count), -1, np.int64)
        number[count > 0] = _joined([_unpack(r[1]) for r in answers])
        return count, number


class Grams:
    """Requests for n-grams, merged to different contexts and n-grams, in the order of the cut, context and word.

    What asks is a list of entries: a context (its rank in that order, its number and salt, whether its sums are wanted and
    whether it is hot) and, where it `has` one, a word (its rank, number, own count, and count of the n-gram of the order
    below). Words are given for these entries only, contexts once for all entries of `each`, if that is given.
    `context_code` and `code` say which different ones these are; `context_at` is an entry of each context. If asked `again`,
    only these and `want` are worked out, which the answers need.
    """

    def __init__(self, digit: np.ndarray, context_rank: np.ndarray, contexts: tuple[np.ndarray, ...], has: np.ndarray, word_rank: np.ndarray, words: tuple[np.ndarray, ...], again: bool = False, each: np.ndarray | None = None):
        number, salt, want, hot = contexts
        word, own, lower = words
        if each is not None:
            context_rank, want = context_rank[each], want[each]
        last = np.zeros(len(has), np.int64)
        last[has] = word_rank
        last[has] += 1
        bits = _bits(last)
        if _bits(context_rank) + bits + len(last).bit_length() > 63:
            context_rank = _different(context_rank)[2].astype(np.int64)
        if _bits(context_rank) + bits > 62:
            last = _different(last)[2].astype(np.int64) + (0 if (last == 0).any() else 1)  # 0 stays what has no word
            bits = _bits(last)
        last |= context_rank << bits
        del context_rank
        key, at, which = _different(last)
        del last
        context = key >> bits
        fresh = np.ones(len(key), bool)
        fresh[1:] = context[1:] != context[:-1]
        of, worded = np.cumsum(fresh, dtype=np.int32) - 1, key & ((1 << bits) - 1) > 0
        del key, context
        self.context_at, self.context_code = at[fresh], of[which]
        self.want = np.zeros(len(self.context_at), bool)
        self.want[self.context_code[want]] = True
        self.code = (np.cumsum(worded, dtype=np.int32) - 1)[which[has]]
        if again:
            return
        given = self.context_at if each is None else each[self.context_at]
        self.context, self.salt, self.hot, self.digit = number[given], salt[given], hot[given], digit[given]
        self.of, at = of[worded], (np.cumsum(has) - 1)[at[worded]]
        self.word, self.lower = word[at], lower[at]
        self.count = np.bincount(self.code, own, len(self.of)).astype(np.int64)

    @classmethod
    def merged(cls, rows: list[list[bytes]], cut: Cut) -> Grams:
        number, salt, want, hot, sizes, word, own, lower = (  # one after the other, as the pieces of one take as much again
            _joined([unpack(r[k]) for r in rows]).astype(kind, copy=False)
            for k, (unpack, kind) in enumerate([(_unpack_steps, np.int64), (_unpack, np.int64), (_unpack, bool), (_unpack, bool), *[(_unpack, np.int64)] * 3, (_unpack_codes, np.int64)])
        )
        n = np.maximum(sizes, 1)  # a context without words is an entry too
        has = np.repeat(sizes > 0, n)
        digit = cut(((number >> NUMBER_BITS) + salt) & ((1 << cut.bits) - 1))
        rank = _ranked(digit, _ranked(_shorter(number), salt))
        each = np.repeat(np.arange(len(n), dtype=np.int32), n)
        out = cls(digit, rank, (number, salt, want, hot), has, _shorter(word), (word, own, lower), each=each)
        out.row_contexts = out.context_code[np.cumsum(n) - n]
        out.context_ends, out.asked = np.cumsum([0] + [len(_unpack(r[4])) for r in rows]), want
        out.ends = np.concatenate([[0], np.cumsum(sizes)])[out.context_ends]
        return out

    def requests(self) -> Iterator[tuple[int, list[bytes]]]:
        edges = np.append(np.flatnonzero(np.diff(self.digit, prepend=-1)), len(self.digit))
        sizes = np.bincount(self.of, minlength=len(self.context))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            c, w = slice(a, b), slice(ends[a], ends[b])
            yield int(self.digit[a]), [_pack_steps(self.context[c]), *(_pack(x[c]) for x in (self.salt, self.want, self.hot, sizes)), _pack(self.word[w]), _pack(self.count[w]), _pack_codes(self.lower[w])]

    def answers(self, known: tuple[np.ndarray, ...]) -> Iterator[list[bytes]]:
        """To each row of requests: counts of n-grams, numbers of those with a count, marks of contexts, and sums of those that it wants."""
        count, number, mark, kinds, mass = known
        for k in range(len(self.ends) - 1):
            of, context = self.code[self.ends[k] : self.ends[k + 1]], slice(self.context_ends[k], self.context_ends[k + 1])
            wanted = self.row_contexts[context][self.asked[context]]
            counts = count[of]
            yield [_pack(counts), _pack_steps(number[of[counts > 0]]), _pack(mark[self.row_contexts[context]]), _pack(kinds[wanted].ravel()), _pack(mass[wanted])]

    def learn(self, answers: list[list[bytes]]) -> tuple[np.ndarray, ...]:
        count, mark = _joined([_unpack(r[0]) for r in answers]), _joined([_unpack(r[2]) for r in answers])
        number = np.full(len(count), -1, np.int64)
        number[count > 0] = _joined([_unpack_steps(r[1]) for r in answers])
        kinds, mass = np.zeros((len(self.context_at), TOP), np.int64), np.zeros(len(self.context_at))
        kinds[self.want] = _joined([_unpack(r[3]) for r in answers]).reshape(-1, TOP)
        mass[self.want] = _joined([_unpack(r[4], np.float64) for r in answers], np.float64)
        return count, number, mark, kinds, mass


def good_turing(n_r: list[int]) -> np.ndarray:
    """Discounts for counts 0 to TOP (0 stays 0) from the numbers of kinds with counts 1 to TOP + 1.

    Where the counts of counts give none between 0 and 1, half a count is taken off instead.
    """
    out = np.ones(TOP + 1)
    out[0] = 0
    n = [0, *n_r]
    tail = (TOP + 1) * n[TOP + 1] / n[1] if n[1] else 1.0
    for r in range(1, TOP + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Model:
    """The model's few numbers: totals, discounts of the orders that are known, hot contexts, and the mass of an unknown word."""

    def __init__(self, stats: list[list[int]], trained: int, hot: int):
        self.trained, self.hot = trained, hot  # training texts; tokens from which on a context is hot
        self.discounts = [good_turing(s[2:]) for s in stats]
        self.tokens, self.kinds = stats[0][:2] if stats else (0, 0)
        low = sum((1 - self.discounts[0][r]) * r * stats[0][1 + r] for r in range(1, TOP + 1)) if stats else 0
        self.total = self.tokens if low else self.tokens + 1
        self.unknown = (low or 1) / self.total if self.tokens else 1.0

    def discounted(self, counts: np.ndarray, order: int) -> np.ndarray:
        return np.where(counts > TOP, 1.0, self.discounts[order - 1][np.minimum(counts, TOP)]) * counts

    def word(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounted(counts, 1) / max(self.total, 1), self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.kinds + 1)))

    def backoff(self, order: int, count: np.ndarray, divisor: np.ndarray, kinds: np.ndarray, mass: np.ndarray) -> np.ndarray:
        """a(h) from the count and divisor of h, its n-grams with counts 1 to TOP, and the mass of those in the order below."""
        r = np.arange(1, TOP + 1)
        seen = count - kinds @ (r * (1 - self.discounts[order - 1][1:]))
        return (1 - seen / divisor) / np.maximum(1 - mass, 1e-12)


class _Block:
    """Tokens of one block, and what is known of their n-grams, order by order.

    Of each token: `count`, `number` and `code` (among those of the block) of its n-gram in the last order that is known,
    and in `orders` for each order count, D(h) and a(h) of its context h.
    """

    def __init__(self, row: dict, cut: Cut):
        self.cut = cut
        self.token = _unpack(row["parts"][0]).astype(np.int32)[_unpack_codes(row["parts"][1])]
        self.ids, held, n = row["docs"].flatten()
        self.n = n.to_numpy()
        self.held = np.repeat(held.to_numpy(zero_copy_only=False), self.n)
        self.start = np.cumsum(self.n) - self.n
        self.orders: dict[int, tuple[np.ndarray, ...]] = {}

    def learn_words(self, answers: list[list[bytes]], model: Model) -> None:
        self.word_count, numbers = Words.learn(answers)
        rank = np.empty(len(numbers), np.int32)
        rank[np.argsort(numbers, kind="stable")] = np.arange(len(numbers))
        self.word, self.rank = numbers[self.token], rank[self.token]
        self.count, self.number, self.code = self.word_count[self.token], self.word, self.rank
        self.divisor = np.full(len(self.token), model.total)

    def _before(self, values: np.ndarray, first: int) -> np.ndarray:
        """The value of the token before each; `first` at the start of a text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.start] = first
        return out

    def ask(self, m: int, model: Model, again: bool = False) -> Grams:
        """Requests of order m. Only an n-gram whose context and whose n-gram below were seen can have been seen."""
        context = self._before(self.number, 0)
        self.context_count = self._before(self.count, model.trained)
        seen = (context >= 0) & (self.context_count > 0)
        hot, possible = seen & (self.context_count > model.hot), seen & (self.count > 0)
        self.hot = np.flatnonzero(hot)
        self.hot_context = context[self.hot]
        self.known = k = np.flatnonzero(possible | seen & self.held & ~hot)
        salt = np.zeros(len(context), np.int64)
        salt[self.hot] = (mix(self.word[self.hot].astype(np.uint64)) >> np.uint64(1)).astype(np.int64) % -(-self.context_count[self.hot] // model.hot)
        context, salt, has = context[k], salt[k], possible[k]
        self.possible = k[has]
        digit = self.cut(((context >> NUMBER_BITS) + salt) & ((1 << self.cut.bits) - 1))
        code = self._before(self.code + 1, 0)[k].astype(np.int64)
        rank = _ranked(_ranked(digit, salt), code)
        p = self.possible
        return Grams(digit, rank, (context, salt, (self.held & ~hot)[k], hot[k]), has, self.rank[p], (self.word[p], ~self.held[p], self.count[p]), again)

    def learn(self, m: int, asked: Grams, answers: list[list[bytes]], model: Model, hot: tuple[np.ndarray, ...]) -> None:
        """`hot`: context numbers in order, kinds and mass of each."""
        count, number, mark, kinds, mass = asked.learn(answers)
        n, k = len(self.token), self.known
        new, numbers, divisor, backoff, code = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.ones(n, np.int64), np.ones(n), np.zeros(n, np.int32)
        new[self.possible], numbers[self.possible], code[self.possible] = count[asked.code], number[asked.code], asked.code
        divisor[k] = self.context_count[k] + mark[asked.context_code]
        at = k[asked.context_at]
        weight = model.backoff(m, self.context_count[at], divisor[at], kinds, mass / self.divisor[at])
        backoff[k] = weight[asked.context_code]
        h = self.hot
        if len(h):
            at = np.searchsorted(hot[0], self.hot_context)
            divisor[h] = self.context_count[h] + (hot[1].sum(axis=1) == 0)[at]
            backoff[h] = model.backoff(m, self.context_count[h], divisor[h], hot[1][at], hot[2][at] / self.divisor[h])
        self.count, self.number, self.divisor, self.code = new, numbers, divisor, code
        self.orders[m] = (new, divisor, backoff)

    def probability(self, model: Model, m: int, at: np.ndarray) -> np.ndarray:
        """P of the tokens at these places, given the m - 1 tokens before each."""
        if m == 1:
            return model.word(self.word_count[self.token[at]])
        count, divisor, backoff = (x[at] for x in self.orders[m])
        seen = count > 0
        out = np.empty(len(at))
        out[seen] = model.discounted(count[seen], m) / divisor[seen]
        out[~seen] = backoff[~seen] * self.probability(model, m - 1, at[~seen])
        return out


def _tokenise(block_bytes: int):
    """(doc_id, text) -> for each block its words (bytes, lengths, training counts), and each token's word and the words' order by hash.

    The most frequent words come first, as small numbers pack well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        ids: list = []
        bodies: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            data, at = text_bytes(pa.array(bodies, pa.binary()))
            data = np.where((data >= 65) & (data <= 90), data | np.uint8(32), data)
            space = is_space(data)
            starts = np.flatnonzero(word_starts(data, at, space))
            before = np.cumsum(~space) - ~space  # bytes of words before each byte
            coded = slices(data[~space], np.append(before[starts], np.count_nonzero(~space))).dictionary_encode()
            first = np.searchsorted(starts, at)
            codes = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), first[1:], len(coded.dictionary))
            words = pa.concat_arrays([coded.dictionary, pa.array([END], pa.large_binary())])
            n = np.diff(first) + 1
            held = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i in ids])
            order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            trained = np.bincount(codes[np.repeat(~held, n)], minlength=len(words))[order]
            docs = [{"doc_id": i, "held": bool(h), "n": int(k)} for i, h, k in zip(ids, held, n, strict=True)]
            words = words.take(pa.array(order))
            by_hash = _by_hash(words)[0]
            place = np.empty_like(by_hash)
            place[by_hash] = np.arange(len(by_hash))
            unit = task << 24 | made
            return _rows([
                {"kind": BLOCK, "order": 0, "unit": unit, "docs": docs, "parts": [_pack(place), _pack_codes(rank[codes])], "stats": [int(n.sum()), int((~held).sum())]},
                {"kind": WORDS, "order": 0, "unit": unit, "parts": [*_pack_bytes(words), _pack(trained)]},
            ])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                ids.append(i)
                bodies.append(text)
                size += len(text)
                if size >= block_bytes:
                    yield block()
                    made, ids, bodies, size = made + 1, [], [], 0
        if ids:
            yield block()

    return run


def _learned(rows: list[dict], order: int, cut: Cut, model: Model, hots: dict) -> _Block:
    """The block of these rows, with the answers to all orders below `order`."""
    answers: dict[int, list] = {m: [] for m in range(1, order)}
    for r in rows[1:]:
        answers[r["order"]].append(r["parts"])
    block = _Block(rows[0], cut)
    block.learn_words(answers[1], model)
    for m in range(2, order):
        block.learn(m, block.ask(m, model, again=True), answers.pop(m), model, hots.get(m))
    return block


def _ask_words(cut: Cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _groups(batches, "unit"):
            for digit, parts in Words([r["parts"] for r in rows], cut).requests():
                yield {"kind": ASK, "order": 1, "unit": rows[0]["unit"], "bucket": digit, "parts": parts}

    return _batched(run)


def _ask(order: int, cut: Cut, model: Model, hots: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _groups(batches, "unit"):
            for digit, parts in _learned(rows, order, cut, model, hots).ask(order, model).requests():
                yield {"kind": ASK, "order": order, "unit": rows[0]["unit"], "bucket": digit, "parts": parts}

    return _batched(run)


def _gather(order: int) -> Callable:
    return Words if order == 1 else Grams.merged


def _combine(order: int, cut: Cut):
    """Requests of a group of units -> those of the group, cut by further hash bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _groups(batches, "bucket", "to"):
            for digit, parts in _gather(order)([r["parts"] for r in rows], cut).requests():
                yield {"kind": ASK, "order": order, "unit": rows[0]["to"], "bucket": rows[0]["bucket"] << cut.take | digit, "parts": parts}

    return _batched(run)


def _spread(order: int, cut: Cut):
    """Requests of a group of units, and the answers to the group -> answers to the units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _groups(batches, "bucket", "to"):
            asked = [r for r in rows if r["kind"] == ASK]
            merged = _gather(order)([r["parts"] for r in asked], cut)
            known = merged.learn([r["parts"] for r in rows if r["kind"] == ANSWER])
            for r, parts in zip(asked, merged.answers(known), strict=True):
                yield {"kind": ANSWER, "order": order, "unit": r["unit"], "bucket": r["bucket"], "parts": parts}

    return _batched(run)


def _stats(count: np.ndarray) -> list[int]:
    return [int(count.sum()), int((count > 0).sum()), *(int((count == r).sum()) for r in range(1, TOP + 2))]


def _numbers(seen: np.ndarray, rank: np.ndarray, bucket: int) -> np.ndarray:
    """Numbers of the seen keys of a bucket, unlike those of any other bucket; -1 for others, 0 is the beginning."""
    return np.where(seen, (bucket << NUMBER_BITS) + rank + 1, -1)


def _settle_words(cut: Cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _groups(batches, "bucket"):
            words, bucket = Words([r["parts"] for r in rows], cut), rows[0]["bucket"]
            order = np.argsort(-words.count, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            seen = words.count > 0
            number = _numbers(seen, rank, bucket)
            yield {"kind": TABLE, "order": 1, "bucket": bucket, "parts": [*_pack_bytes(words.words.filter(pa.array(seen))), _pack(words.count[seen]), _pack(number[seen])], "stats": _stats(words.count)}
            for r, parts in zip(rows, words.answers((words.count, number)), strict=True):
                yield {"kind": ANSWER, "order": 1, "unit": r["unit"], "bucket": bucket, "parts": parts}

    return _batched(run)


def _settle_grams(order: int, cut: Cut, model: Model, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _groups(batches, "bucket"):
            grams, bucket = Grams.merged([r["parts"] for r in rows], cut), rows[0]["bucket"]
            seen = grams.count > 0
            number = _numbers(seen, np.cumsum(seen) - 1, bucket)
            of, n = grams.of[seen], len(grams.context)
            counts = grams.count[seen]
            kinds = np.zeros((n, TOP), np.int32)
            for r in range(1, TOP + 1):
                kinds[:, r - 1] = np.bincount(of[counts == r], minlength=n)
            mass = np.bincount(of, model.discounted(grams.lower[seen], order - 1), n)  # times D(h')
            sizes = np.bincount(of, minlength=n)
            has = sizes > 0
            yield {"kind": TABLE, "order": order, "bucket": bucket, "parts": [_pack_steps(grams.context[has]), _pack(sizes[has]), _pack(grams.word[seen]), _pack(counts)], "stats": _stats(grams.count)}
            hot = np.flatnonzero(grams.hot)
            if len(hot):
                yield {"kind": HOT, "order": order, "bucket": bucket, "parts": [_pack(grams.context[hot]), _pack(kinds[hot].ravel()), _pack(mass[hot])]}
            mark = (kinds.sum(axis=1) == 0).astype(np.int64)
            for r, parts in zip(rows, grams.answers((grams.count, np.zeros_like(number) if last else number, mark, kinds, mass)), strict=True):
                yield {"kind": ANSWER, "order": order, "unit": r["unit"], "bucket": bucket, "parts": parts}

    return _batched(run)


def _hot_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches, "bucket"):
        for r in rows:
            context, kinds, mass = _unpack(r["parts"][0]), _unpack(r["parts"][1]).reshape(-1, TOP), _unpack(r["parts"][2], np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(context), *(pa.array(np.ascontiguousarray(kinds[:, k])) for k in range(TOP)), pa.array(mass)], names=["context", *(f"k{r}" for r in range(1, TOP + 1)), "mass"])


def _score(order: int, cut: Cut, model: Model, hots: dict):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "unit"):
            block = _learned(rows, order + 1, cut, model, hots)
            words, token = block.word_count, block.token
            value = np.log10(block.probability(model, order, np.arange(len(token))))
            total = [np.add.reduceat(v, block.start) for v in ((words[token] > 0).astype(np.int64), model.base(words)[token], value)]
            n = len(block.n)
            yield pa.RecordBatch.from_arrays(
                [block.ids, pa.array(block.held[block.start]), pa.array(block.n), pa.array(total[0]), pa.array(np.full(n, model.tokens)), pa.array(total[1]), pa.array(total[2])], names=names
            )

    return run


def _by(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, "kind", "order", "sub", "bucket", "unit")


def steps(bits: int, fan_bits: int) -> list[int]:
    """The bits of a bucket by which units are cut, step by step: `fan_bits` at most, and about as many in each."""
    n = max(1, -(-bits // fan_bits))
    return [bits // n + (k < bits % n) for k in range(n)]


def _answered(asked: DataFrame, order: int, takes: list[int], step: int, units: int, settle) -> tuple[DataFrame, DataFrame]:
    """Answers to written requests that are cut by the first `takes`, up to `step`, and the tables of their buckets."""
    spark = asked.sparkSession
    if step + 1 == len(takes):
        settled = written(_by(asked, "bucket").mapInArrow(settle, ROWS), f"order-{order}")
        return settled.where(F.col("kind") == ANSWER), settled.where(F.col("kind") > ANSWER)
    units = -(-units >> takes[step]) or 1
    cut = Cut(sum(takes), takes[step + 1], sum(takes[: step + 1]))
    dealt = asked.withColumn("to", F.pmod(F.xxhash64("unit"), F.lit(units)))
    path = f"{shared_dir(spark)}-asked"
    with shuffles_end(spark):
        _by(dealt, "bucket", "to").mapInArrow(_combine(order, cut), ROWS).write.parquet(path)
    answers, table = _answered(spark.read.schema(ROWS).parquet(path), order, takes, step + 1, units, settle)
    delete(spark, path)
    back = answers.withColumns({"to": F.col("unit"), "sub": F.col("bucket"), "bucket": F.shiftright("bucket", cut.take)})
    return written(_by(dealt.unionByName(back), "bucket", "to").mapInArrow(_spread(order, cut), ROWS), "answers"), table


def _exchange(asks: list[DataFrame], order: int, takes: list[int], units: int, shares: int, settle) -> tuple[DataFrame, DataFrame]:
    """Answers to the units that ask, and the table of the order (with the sums of hot contexts).

    Units are cut by `takes` bits of a bucket, step by step. Before each further cut they are merged in groups, as many as
    the last one cut them into, so that a group is about as large as a unit. Requests are written, and their buckets worked
    on in shares, so that not all are on their way at once: twice as many if units are merged, when more is.
    """
    spark, parts = asks[0].sparkSession, shares if len(takes) == 1 else 2 * shares
    path = f"{shared_dir(spark)}-asked"
    for asked in asks:
        with shuffles_end(spark):
            asked.withColumn("share", F.col("bucket") % parts).write.mode("append").partitionBy("share").parquet(path)
    sent = spark.read.schema(f"{ROWS}, share long").parquet(path)
    got = []
    for share in range(parts):
        got.append(_answered(sent.where(F.col("share") == share).drop("share"), order, takes, 0, units, settle))
        delete(spark, f"{path}/share={share}")
    delete(spark, path)
    return tuple(functools.reduce(DataFrame.unionByName, x) for x in zip(*got, strict=True))


def score(docs: DataFrame, *, order: int = 2, block_bytes: int = 3 << 20, bucket_tokens: int = 1_500_000, fan_bits: int = 9, shares: int = 2, hot: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row.

    `order`: tokens in the longest n-grams, 1 or more. Rows whose crc32(doc_id as text) mod 10 is 0 are held out, the
    others train. A null or empty text is its end alone; a null id counts as an empty text's id (held out) and is kept;
    repeated rows train as often as they occur; other columns are ignored; an empty table gives no rows. A context with
    over `hot` tokens (an eighth of what a bucket has, and one in MOST_HOT of all at least) is split. A text is never cut, so a
    block holds `block_bytes` and one text more. Each order's buckets are worked on in so many `shares`, one after the other.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", READ):
        return functools.reduce(DataFrame.unionByName, [written(x, "scores") for x in _scored(texts, order, block_bytes, bucket_tokens, fan_bits, shares, hot)])


def _scored(texts: DataFrame, order: int, block_bytes: int, bucket_tokens: int, fan_bits: int, shares: int, hot: int | None) -> list[DataFrame]:
    """The scores of (doc_id, text) in one share or several, all but the last step worked out and written."""
    spark = texts.sparkSession
    path = f"{shared_dir(spark)}-blocks"
    texts.mapInArrow(_tokenise(block_bytes), ROWS).write.partitionBy("kind").parquet(path)
    made = spark.read.schema(ROWS).parquet(path).select("kind", *(c for c in TYPES if c != "kind"))
    blocks, words = made.where(F.col("kind") == BLOCK), made.where(F.col("kind") == WORDS)
    units, tokens, trained = (int(x or 0) for x in blocks.agg(F.count("*"), F.sum(F.col("stats")[0]), F.sum(F.col("stats")[1])).first())
    bits = max(3, (-(-tokens // bucket_tokens) - 1).bit_length())
    takes = steps(bits, fan_bits)
    first, whole = Cut(bits, takes[0]), Cut(bits, 0, bits)
    hot = hot or max(bucket_tokens // 8, tokens // MOST_HOT)
    sums = [F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)).alias(f"s{i}") for i in range(TOP + 3)]
    answers: list[DataFrame] = []
    stats: list[list[int]] = []
    hots: dict[int, tuple] = {}
    model = None

    def met(run, schema: str) -> list[DataFrame]:
        """Blocks with all answers to them; of a large corpus, units are worked on in shares as well."""
        every = functools.reduce(DataFrame.unionByName, answers, blocks)
        n = 1 if len(takes) == 1 else shares
        parts = [every] if n == 1 else [every.where(F.pmod(F.xxhash64("unit"), F.lit(n)) == share) for share in range(n)]
        return [part.repartition("unit").sortWithinPartitions("unit", "order", "bucket").mapInArrow(run, schema) for part in parts]

    for m in range(1, order + 1):
        asks = [words.mapInArrow(_ask_words(first), ROWS)] if m == 1 else met(_ask(m, first, model, hots), ROWS)
        got, table = _exchange(asks, m, takes, units, shares, _settle_words(whole) if m == 1 else _settle_grams(m, whole, model, m == order))
        answers.append(got)
        if m == 1:
            delete(spark, f"{path}/kind={WORDS}")  # these are in the table of words now
        stats.append([int(x) for x in table.where(F.col("kind") == TABLE).agg(*sums).first()])
        heavy = table.where(F.col("kind") == HOT).mapInArrow(_hot_sums, f"context long, {', '.join(f'k{r} long' for r in range(1, TOP + 1))}, mass double")
        heavy = heavy.groupBy("context").agg(*(F.sum(f"k{r}") for r in range(1, TOP + 1)), F.sum("mass").alias("mass")).toPandas().sort_values("context")  # under MOST_HOT rows
        hots[m] = (heavy["context"].to_numpy(np.int64), heavy.iloc[:, 1 : TOP + 1].to_numpy(np.int64), heavy["mass"].to_numpy(np.float64))
        model = Model(stats, trained, hot)
    return met(_score(order, first, model, hots), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op10_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), order=3)
