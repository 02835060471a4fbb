"""What several text operators share: shared folders, sized broadcasts, units of text and their ids."""

from __future__ import annotations

import functools
import itertools
import os
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import checkpoint_folder, shuffles_end

WORD_MODEL = "word_bpe_49k.json"
BYTE_MODEL = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; callers may pass any other path to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share, in the checkpoint folder of the session."""
    return f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame once to the shared folder and read it back: its lineage and its shuffle files end there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}-{name}"
    schema = df.schema
    with shuffles_end(spark):
        df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """`df`, or a copy of it, such that its rows have the same places in the same partitions whenever it is read.

    What only selects from one scan or checkpoint is that already; all else is written once.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if all(re.match(r"[\s:+-]*(Project|Filter|Relation|LogicalRDD)\b", line) for line in plan.splitlines() if line.strip()):
        return df
    return written(df, name)


MOST_BROADCAST = 32 << 20


def measured_bytes(df: DataFrame) -> int:
    """About how many bytes the rows take when Spark broadcasts them: 16 a column, and those of what has no fixed size."""

    def varying(c: Column, kind: T.DataType) -> Column | None:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.octet_length(c)
        if isinstance(kind, T.ArrayType):
            inner = varying(F.lit(None).cast(kind.elementType), kind.elementType)
            return 16 * F.size(c) if inner is None else F.aggregate(c, F.lit(0), lambda a, x: a + 16 + F.coalesce(varying(x, kind.elementType), F.lit(0)))
        return None

    parts = [v for f in df.schema if (v := varying(F.col(f.name), f.dataType)) is not None]
    row = sum((F.coalesce(v, F.lit(0)).cast("long") for v in parts), F.lit(16 * (1 + len(df.columns))).cast("long"))
    return df.select(row.alias("n")).agg(F.sum("n")).first()[0] or 0


def sized_broadcast(df: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """Broadcast `df`, a written or small table, only if its measured bytes stay within `most`; else leave the join to Spark."""
    return F.broadcast(df) if measured_bytes(df) <= most else df


def fresh(df: DataFrame, name: str) -> str:
    """`name`, longer if the table has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


@functools.lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The tokenizer of a .json file, one thread per Spark task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (or binary values) in one array, and n + 1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    binary = pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type)
    texts = pc.fill_null(texts.cast(pa.large_binary() if binary else pa.large_string()), b"" if binary else "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def is_space(data: np.ndarray) -> np.ndarray:
    """Space, tab, line feed, vertical tab, form feed, carriage return."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_starts(data: np.ndarray, ends: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Mask of the bytes at which a word of some text begins."""
    first = ~space
    first[1:] &= space[:-1] | ~first[1:]
    begins = ends[:-1][ends[:-1] < len(data)]
    first[begins] = ~space[begins]
    return first


def slices(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Strings between neighbouring cuts, without a copy of the bytes."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )


def byte_groups(lengths: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of consecutive rows of at most `limit` bytes each, one row at least."""
    out, begin, total = [], 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > limit:
            out.append((begin, i))
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        out.append((begin, len(lengths)))
    return out


class _Memory:
    """Ids of units: each unit's place, and by place where its ids begin and how many they are."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def places(self, units: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.get, units, itertools.repeat(-1)), np.int64, len(units))

    def add(self, units: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        n = len(self.known)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(units) > len(self.start):
            self.start, self.size = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.size))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[n : n + len(units)] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + len(units)] = sizes
        self.used += len(ids)
        self.known.update(zip(units, range(n, n + len(units)), strict=True))

    def ids_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each has, and all of them one after the other."""
        sizes = self.size[places]
        total = np.cumsum(sizes)
        return sizes, self.ids[np.repeat(self.start[places] - total + sizes, sizes) + np.arange(total[-1] if len(total) else 0)]


class UnitEncoder:
    """Encodes texts by their units, each distinct unit once, with the tokenizers library.

    A unit is about a word with the white space beside it. Units are independent because the library's
    pre-tokenizer never joins what stands on both sides of these cuts:

    * `words=True` (word_bpe): white space of any length is one space and is dropped, letters are lowered, so
      ASCII letters may be lowered and ASCII white space made spaces before the cut. A piece never crosses
      white space, and normal form C joins no character to it.
    * `words=False` (byte_bpe): a piece is white space only, or at most one space and then other characters,
      so a piece always starts where a run of white space starts. Only ASCII white space is seen here; texts
      with other white space must go to `whole()`.
    * In both, a run of letters ends at `, . ; : ! ?`, so a cut before one of these after an ASCII letter
      changes nothing.

    Strings of special tokens hold no white space and none of these marks, so they lie within one unit; where
    one could occur, letters are not lowered. A unit of Latin letters only is one piece by either pattern; in its
    byte-level form it goes to the library's model as it is (these letters have no combining forms, and lower one
    by one).
    """

    def __init__(self, path: str, words: bool, max_units: int = 700_000):
        self.tokenizer = load_tokenizer(path)
        self.model = self.tokenizer.model
        self.words, self.max_units = words, max_units
        self.memory, self.older = _Memory(), _Memory()

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, units: list[bytes]) -> list[list[int]]:
        out: list = [None] * len(units)
        rest = []
        for i, u in enumerate(units):
            bare = u.rstrip().lower() if self.words else u[u[:1] == b" " :]
            if bare.isalpha():
                piece = bare.decode()
            else:
                letters = bare.decode()
                if not (letters.isalpha() and max(letters) < "\u0180" and "\u0130" not in letters):
                    rest.append(i)
                    continue
                piece = (letters.lower() if self.words else letters).encode().decode("latin-1").translate(_BYTE_FORM)
            if not self.words and u[:1] == b" ":
                piece = _BYTE_FORM[32] + piece
            out[i] = [t.id for t in self.model.tokenize(piece)]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([units[i].decode() for i in rest], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    def _learn(self, units: list[bytes]) -> np.ndarray:
        """Places of these different units. What has not been met for long is forgotten, half of the memory at a time."""
        places = self.memory.places(units)
        if (places < 0).any():
            if self.memory.known and len(self.memory.known) + int((places < 0).sum()) > self.max_units // 2:
                self.memory, self.older = _Memory(), self.memory
                places = self.memory.places(units)
            new = [units[i] for i in np.flatnonzero(places < 0).tolist()]
            before = self.older.places(new)
            met = np.flatnonzero(before >= 0).tolist()
            self.memory.add([new[i] for i in met], *self.older.ids_of(before[met]))
            new = [new[i] for i in np.flatnonzero(before < 0).tolist()]
            got = self._encoded(new)
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            self.memory.add(new, sizes, np.fromiter(itertools.chain.from_iterable(got), np.int32, int(sizes.sum())))
            places = self.memory.places(units)
        return places

    def _units(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the memory of each unit, each text's first unit (n + 1), and where the units begin."""
        space = is_space(data)
        letter = (data | 32) - np.uint8(97) < 26
        if self.words:
            cut = word_starts(data, at, space)
            plain = np.where(space, np.uint8(32), data)
            bar = np.flatnonzero(data == ord("|"))
            if not (data[bar[bar > 0] - 1] == ord("<")).any():
                plain = np.where(letter, plain | np.uint8(32), plain)
        else:
            plain, cut = data, space.copy()
            cut[1:] &= ~space[:-1]
        cut[1:] |= letter[:-1] & _MARK[data[1:]]
        cut[at[:-1][at[:-1] < at[1:]]] = True
        cuts = np.flatnonzero(cut)
        first = np.searchsorted(cuts, at)
        if not len(cuts):
            return np.zeros(0, np.int64), first, cuts
        coded = slices(plain, np.append(cuts, len(data))).dictionary_encode()
        places = self._learn(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        return places[coded.indices.to_numpy(zero_copy_only=False)], first, cuts

    def encode_chunks(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, ids before each text (n + 1), where the units begin (with the end), and ids before each unit."""
        units, first, cuts = self._units(data, at)
        sizes, ids = self.memory.ids_of(units)
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, total[first], np.append(cuts, len(data)), total

    def encode(self, data: np.ndarray, at: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, each text followed by `end_id`, and n + 1 offsets."""
        units, first, _ = self._units(data, at)
        sizes, ids = self.memory.ids_of(units)
        total = np.concatenate([[0], np.cumsum(sizes)])
        offsets = total[first]
        if end_id is not None:
            ids = np.insert(ids, offsets[1:], end_id)
            offsets = offsets + np.arange(len(offsets))
        return ids, offsets


def _byte_form() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else the next from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_FORM = _byte_form()
_MARK = np.zeros(256, bool)
_MARK[list(b",.;:!?")] = True


@functools.lru_cache(maxsize=2)
def unit_encoder(path: str, words: bool) -> UnitEncoder:
    """One for each Python worker: tasks that follow each other use what it has learnt."""
    return UnitEncoder(path, words)
