"""Packing documents into fixed windows by the online sum-of-squares rule.

N(h) counts the open windows filled to level h. A document's last piece (what
remains after its full windows) goes to the level h, or to a new window, for
which the sum of N(h)² over partially filled levels grows least. That keeps
windows of every fill at hand, so later pieces find an exact complement.
(Csirik, Johnson, Kenyon, Orlin, Shor, Weber: On the Sum-of-Squares Algorithm
for Bin Packing, J. ACM 2006.) Documents may be cut, so a piece may also fill a
window and go on in a new one; the rule weighs these levels as well once a share
of the windows is open.

Each input partition is packed alone, without a shuffle: the level array has a
fixed size and a closed window leaves memory at once. A shard's last open windows
are topped up from its emptiest ones when it ends, so at most one window of a
shard is partly filled; that one is cut at its binary digits into sequences
whose lengths are powers of two and need no padding.
"""

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from heddle.llm.batches import give_back, text_batches
from heddle.llm.chunks import NumberCache, SimpleParts, gather, gathered, split_chunks
from heddle.sources import table

WINDOW = 2048
END_ID = 1
#: Windows that a shard holds open at most, and the share of its closed ones that may be open.
MOST_OPEN = 2048
OPEN_SHARE = 4
VOCABULARY = "word_bpe_49k.json"


class LevelPacker:
    """Sum-of-squares packing of pieces (key, start, bytes of ids, tokens of the document).

    ``levels[h]`` counts the open windows filled to h. ``leave`` and ``enter``
    hold what the sum of squares gains when a window leaves or enters a level.
    A piece may go past a window's end: it fills that window, which closes, and
    its rest is a window at the level that is left. Such a cut is made only while
    as many windows are open as ``most_open`` allows: a share of the windows
    closed so far, so that few are left at the end of a small input, and large
    inputs, which find exact complements, are hardly cut.
    """

    NEVER = np.iinfo(np.int64).max // 4

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.levels = [0] * (window + 1)
        self.leave = np.full(window + 1, self.NEVER)
        self.enter = np.ones(window + 1, dtype=np.int64)
        self.enter[window] = 0  # a full window is closed and counts no more
        self.open: list[list] = [[] for _ in range(window + 1)]
        self.n_open = self.n_closed = self.n_drained = 0

    def most_open(self) -> int:
        return min(MOST_OPEN, 4 + self.n_closed // OPEN_SHARE)

    def _level_for(self, size: int) -> int:
        """The level, 0 for a new window, whose choice adds least to the sum of squares.

        Ties go to the fullest window. Levels at which the piece would be cut are
        looked at only when no more windows may be opened.
        """
        gain = (self.leave[1 : self.window - size + 1] + self.enter[size + 1 :])[::-1]
        best = int(gain.argmin()) if len(gain) else 0
        least = int(gain[best]) if len(gain) else self.NEVER
        if self.n_open < self.most_open():
            return self.window - size - best if least <= self.enter[size] else 0
        if size > 1:
            past = (self.leave[self.window - size + 1 : self.window] + self.enter[1:size])[::-1]
            cut = int(past.argmin())
            if past[cut] < least:
                return self.window - 1 - cut
        return self.window - size - best if least < self.NEVER else 0

    def _count(self, level: int, by: int) -> None:
        self.levels[level] += by
        self.n_open += by
        n = self.levels[level]
        self.leave[level] = 1 - 2 * n if n else self.NEVER
        self.enter[level] = 2 * n + 1

    def add(self, piece: tuple, size: int) -> list[list]:
        """Place a piece of 1 to ``window`` tokens; the pieces of the window that it fills, if any."""
        if size == self.window:
            return [[piece]]
        level = self._level_for(size)
        pieces, closed = [], []
        if level:
            pieces = self.open[level].pop()
            self._count(level, -1)
        if level + size > self.window:
            key, start, ids, total = piece
            room = self.window - level
            pieces.append((key, start, ids[: 4 * room], total))
            piece, size = (key, start + room, ids[4 * room :], total), size - room
            closed, pieces, level = [pieces], [], 0
        pieces.append(piece)
        level += size
        if level == self.window:
            closed.append(pieces)
        else:
            self._count(level, 1)
            self.open[level].append(pieces)
        self.n_closed += len(closed)
        return closed

    def drain(self) -> Iterator[list]:
        """Close the open windows: the fullest are topped up with pieces of the emptiest."""
        left = [w for level in range(1, self.window) for w in self.open[level]]
        low, high = 0, len(left) - 1
        fill = [sum(len(p[2]) // 4 for p in w) for w in left]
        while low < high:
            need = self.window - fill[high]
            key, start, ids, total = left[low].pop()
            size = len(ids) // 4
            taken = min(need, size)
            if taken < size:
                left[low].append((key, start, ids[: 4 * (size - taken)], total))
            left[high].append((key, start + size - taken, ids[4 * (size - taken) :], total))
            fill[high] += taken
            fill[low] -= taken
            if fill[high] == self.window:
                self.n_drained += 1
                yield left[high]
                high -= 1
            if not fill[low]:
                low += 1
        if low == high and fill[low]:
            yield from self._binary(left[low], fill[low])

    def _binary(self, pieces: list, fill: int) -> Iterator[list]:
        """Cut a last window into sequences of power-of-two lengths, longest first."""
        pieces = pieces[::-1]
        while fill:
            need = size = 1 << (fill.bit_length() - 1)
            sequence = []
            while need:
                key, start, ids, total = pieces.pop()
                taken = min(need, len(ids) // 4)
                sequence.append((key, start, ids[: 4 * taken], total))
                if 4 * taken < len(ids):
                    pieces.append((key, start + taken, ids[4 * taken :], total))
                need -= taken
            fill -= size
            self.n_drained += 1
            yield sequence


#: Words that are encoded in one call.
_CALL = 2000


class ChunkEncoder:
    """The ids of chunks, by the tokenizer itself.

    The common chunks, a word with punctuation behind, go through a copy of the
    tokenizer that only merges: many words are encoded together, and as a word's
    last token bears the word-end mark, the ids fall apart into words. A worker
    keeps the tokenizers from task to task, and the words it has met for a task.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix, vocabulary = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
        self.ends = np.zeros(1 + max(vocabulary.values()), dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        bare = {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}}
        self.merges = Tokenizer.from_str(json.dumps(spec | bare))
        self.words = NumberCache(self._merged)

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        calls = [self.merges.encode(" ".join(words[at : at + _CALL]), add_special_tokens=False).ids for at in range(0, len(words), _CALL)]
        ids = np.concatenate([np.array(c, dtype="<u4") for c in calls])
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks in a row, and how many each has."""
        split = SimpleParts(chunks)
        number = self.words.numbers(split.parts)
        # each word, and its tail behind it
        ids, begins = self.words.joined(np.insert(number[split.words], split.tailed + 1, number[split.tails]))
        last = np.arange(1, len(split.places) + 1)
        last += np.searchsorted(split.tailed, np.arange(len(split.places)), side="right")
        others = [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(split.others, add_special_tokens=False)]
        sizes = np.zeros(len(chunks), dtype=np.int64)
        sizes[split.places] = np.diff(begins[last], prepend=0)
        sizes[split.odd] = list(map(len, others))
        ids = np.concatenate([ids, *others])
        # simple chunks come first there: back into the chunks' order
        order = np.concatenate((split.places, split.odd))
        first = np.empty(len(chunks), dtype=np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        return gather(ids, first, sizes)[0], sizes


@lru_cache(maxsize=2)
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def token_ids(texts: pa.Array, encoder: ChunkEncoder) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and where each text's begin, with their count at the end."""
    chunks, codes, starts = split_chunks(texts)
    ids, sizes = encoder.encode(chunks)
    ids, begins = gather(ids, (np.cumsum(sizes) - sizes)[codes], sizes[codes])
    return ids, begins[starts]


PIECE = pa.schema([*((name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), ("ids", pa.binary())])


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack ``docs`` into sequences of at most ``window`` tokens.

    Returns a row per piece: ``doc_id``, ``start`` (the document's ids before
    the piece), ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and
    ``offset`` (the piece's place in its sequence), and ``ids`` as binary of
    little-endian unsigned 32-bit numbers. A piece is at most a window long.

    A null or empty text is the end id alone. A null id stays null. Repeated
    rows are packed as often as they occur. Other columns are not read. An
    empty table gives no rows. ``vocabulary`` is a tokenizer file at the same
    path on every executor. Sequence ids join the input's partition with a
    count, so a retried task gives the same ids, whatever the plan above does.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = _encoder(vocabulary), LevelPacker(window)
        base = count = 0
        step = 4 * window

        def made(sequences: list[list]) -> pa.RecordBatch:
            nonlocal count
            out = []
            for pieces in sequences:
                offset = 0
                for key, start, ids, total in pieces:
                    out.append((key, start, len(ids) // 4, zlib.crc32(ids), total, base + count, offset, ids))
                    offset += len(ids) // 4
                count += 1
            columns = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(column, type=kind) for column, kind in zip(columns, PIECE.types)], schema=PIECE)

        for batch in gathered(batches):
            base, full = batch.column(2)[0].as_py() << 32, []
            ids, begins = token_ids(batch.column(1), encode)
            cuts, data = (4 * begins).tolist(), ids.tobytes()
            for key, a, b in zip(batch.column(0).to_pylist(), cuts, cuts[1:]):
                whole = data[a:b] + end
                total = len(whole) // 4
                for start in range(0, total, window):
                    piece = (key, start, whole[4 * start : 4 * start + step], total)
                    full += packer.add(piece, len(piece[2]) // 4)
            if full:
                yield made(full)
        if left := list(packer.drain()):
            yield made(left)
        encode.words.reset()
        give_back()

    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.spark_partition_id()).mapInArrow(rows, fields)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, in windows of 2048 tokens of the public word-end vocabulary."""
    import public_tokenizers

    text_batches(spark)
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)).drop("ids")


QUERIES = {"op3_packing": op3_packing}
ORACLE_SQL: dict[str, str] = {}
