"""Per-chunk caching for tokenizers whose output is local to blank-separated chunks.

The word-end vocabulary drops white space, so what lies between blanks and line
ends is tokenized alone, and a text's ids are its chunks' ids in a row. Chunks
repeat far more often than texts: a batch's chunks are split and numbered by
Arrow, only distinct ones become Python strings, and a worker keeps the values
of those it has seen.
"""

from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks kept by a worker; beyond it the cache starts anew, which costs time only.
CACHE_CHUNKS = 250_000
#: Bytes of text split at once.
BLOCK_BYTES = 4_000_000


def gathered(batches: Iterable[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about BLOCK_BYTES of text, one row at least.

    Spark's batches are bounded by rows as well, and small blocks repeat their chunks.
    """
    held, size = [], 0
    for batch in batches:
        for part in _parts(batch, text):
            more = _text_bytes(part.column(text))
            if held and size + more > BLOCK_BYTES:
                yield _joined(held)
                held, size = [], 0
            held.append(part)
            size += more
    if held:
        yield _joined(held)


def _text_bytes(texts: pa.Array) -> int:
    return pc.sum(pc.binary_length(texts)).as_py() or 0


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _parts(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most about BLOCK_BYTES of text each, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + BLOCK_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def split_chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks, each chunk's number there, and where each text's chunks start.

    Texts are split at blanks and line ends alone, as tokenizers and Python
    differ on other white space; one chunk may be empty. Null is empty.
    """
    lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    coded = lists.flatten().dictionary_encode()
    starts = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)))
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), starts


#: A word of precomposed Latin letters, then punctuation without apostrophes. The
#: tokenizer's rules split such a chunk into these two and lower the word's letters.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
SIMPLE = f"^[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F]+[{re.escape(MARKS)}]*$"
_WORD = "^[^!-~]*(?:[A-Za-z][^!-~]*)*"


class SimpleParts:
    """Chunks in bulk as words and the punctuation behind them.

    ``places`` are the simple chunks and ``odd`` the others, whose strings are
    ``others``. ``parts`` are the distinct words and tails, ``words`` each simple
    chunk's word and ``tails`` the tails of those that are ``tailed``, as numbers.
    """

    def __init__(self, chunks: pa.Array):
        simple = pc.match_substring_regex(chunks, SIMPLE)
        is_simple = simple.to_numpy(zero_copy_only=False)
        self.places, self.odd = np.flatnonzero(is_simple), np.flatnonzero(~is_simple)
        plain = chunks.filter(simple)
        words = pc.ascii_rtrim(plain, characters=MARKS)
        tailed = pc.not_equal(pc.binary_length(plain), pc.binary_length(words))
        tails = pc.replace_substring_regex(plain.filter(tailed), _WORD, "")
        coded = pa.concat_arrays([pc.utf8_lower(words), tails]).dictionary_encode()
        numbers = coded.indices.to_numpy()
        self.parts, self.words, self.tails = coded.dictionary.to_pylist(), numbers[: len(plain)], numbers[len(plain) :]
        self.tailed = np.flatnonzero(tailed.to_numpy(zero_copy_only=False))
        self.others = chunks.filter(pc.invert(simple)).to_pylist()


class NumberCache:
    """A number for each chunk, and the ids of the numbered chunks in one pool.

    ``make`` gives the ids of new chunks in a row and how many each has. Beyond
    ``limit`` chunks both start anew, so numbers hold until the next call.
    """

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int | None = None):
        self.make, self.limit = make, limit or CACHE_CHUNKS
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.first, self.size, self.ids, self.used = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(1 << 16, dtype="<u4"), 0

    def numbers(self, chunks: list[str]) -> np.ndarray:
        """The numbers of distinct chunks."""
        found = np.fromiter(map(self.known.get, chunks, repeat(-1)), dtype=np.int64, count=len(chunks))
        fresh = np.flatnonzero(found < 0)
        if len(fresh) and len(self.known) + len(fresh) > self.limit:
            self.reset()
            fresh = np.arange(len(chunks))
        if len(fresh):
            new = [chunks[i] for i in fresh.tolist()] if len(fresh) < len(chunks) else chunks
            ids, sizes = self.make(new)
            if self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate((self.ids[: self.used], np.zeros(len(self.ids) + len(ids), dtype="<u4")))
            self.ids[self.used : self.used + len(ids)] = ids
            base = len(self.first)
            self.first = np.concatenate((self.first, self.used + np.cumsum(sizes) - sizes))
            self.size = np.concatenate((self.size, sizes))
            self.used += len(ids)
            self.known.update(zip(new, range(base, base + len(new))))
            found[fresh] = base + np.arange(len(fresh))
        return found

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered chunks in a row, and where each chunk's begin, with their count at the end."""
        return gather(self.ids, self.first[numbers], self.size[numbers])


def gather(pool: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of a pool in a row, and where each begins, with their length in all at the end."""
    ends = np.cumsum(sizes)
    at = np.repeat(first - ends + sizes, sizes)
    at += np.arange(len(at))
    return pool[at], np.concatenate(([0], ends))


class ChunkCache:
    """Values of chunks, made in bulk by ``make(list of new chunks)``."""

    def __init__(self, make: Callable[[list[str]], Iterable], limit: int = CACHE_CHUNKS):
        self.make, self.limit, self.known = make, limit, {}

    def values(self, chunks: list[str]) -> list:
        found = list(map(self.known.get, chunks))
        fresh = list({c for c, v in zip(chunks, found) if v is None})
        if not fresh:
            return found
        if len(self.known) + len(fresh) > self.limit:
            self.known = {}
        made = dict(zip(fresh, self.make(fresh)))
        self.known.update(made)
        return [made[c] if v is None else v for c, v in zip(chunks, found)]
