"""Token counts by greedy longest match, with a linear-time automaton.

The vocabulary is a trie. When a node has no child for the next symbol, its
failure link leads to the node for what is left after popping the longest
matching tokens, and a number stored beside the link says how many tokens that
pops. So a word's piece count falls out of one walk, and no piece is ever built.
(Song, Salcianu, Song, Dopson, Zhou: Fast WordPiece Tokenization, EMNLP 2021.)

Symbols are bytes, and the last byte of a word is a symbol of its own, as the
vocabulary marks word ends. New words of a batch walk in step, as arrays.
"""

import json
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from heddle.llm.batches import give_back, text_batches
from heddle.llm.chunks import ChunkCache, SimpleParts, gathered, split_chunks
from heddle.sources import table

VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"
SYMBOLS = 512
#: Words and pieces of a text are summed as one number, words in its upper bits.
WORD = 1 << 32


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the letters from U+0100.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class LongestMatch:
    """The automaton over a vocabulary of byte-letter tokens with word-end marks.

    ``edges`` is a table of node * SYMBOLS + symbol and ``targets`` of the children;
    ``fail`` and ``pops`` are a node's failure link and what taking it pops.
    Each single symbol is a token, added if the vocabulary lacks it, so that
    every word has pieces.
    """

    def __init__(self, tokens: list[str]):
        self.letters = byte_letters()
        children: list[dict[int, int]] = [{}]
        is_token = [False]
        single = [[s] for s in range(SYMBOLS)]
        for symbols in [*map(self.symbols_of_token, tokens), *single]:
            if not symbols:
                continue
            node = 0
            for s in symbols:
                if s not in children[node]:
                    children[node][s] = len(children)
                    children.append({})
                    is_token.append(False)
                node = children[node][s]
            is_token[node] = True
        self.fail, self.pops = self._links(children, is_token)
        edges = sorted((node * SYMBOLS + s, child) for node, kids in enumerate(children) for s, child in kids.items())
        self._hash_edges(np.array([e for e, _ in edges], dtype=np.int64), np.array([t for _, t in edges], dtype=np.int32))

    def _hash_edges(self, keys: np.ndarray, targets: np.ndarray) -> None:
        """An open table of the edges with few filled places, so that most are found at the first."""
        self.bits = max(4, int(np.ceil(np.log2(len(keys) * 6))))
        self.edges, self.targets = np.full(1 << self.bits, -1, dtype=np.int64), np.full(1 << self.bits, -1, dtype=np.int32)
        left, place = np.arange(len(keys)), self._place(keys)
        while len(left):
            at = place[left]
            free = self.edges[at] < 0
            first = np.zeros(len(left), dtype=bool)
            first[np.unique(at, return_index=True)[1]] = True
            won = free & first
            self.edges[at[won]], self.targets[at[won]] = keys[left[won]], targets[left[won]]
            left = left[~won]
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def symbols_of_token(self, token: str) -> list[int]:
        ends = token.endswith(WORD_END) and len(token) > len(WORD_END)
        letters = token[: -len(WORD_END)] if ends else token
        try:
            symbols = [self.letters[c] for c in letters]
        except KeyError:
            return []
        if ends:
            symbols[-1] += 256
        return symbols

    @staticmethod
    def _links(children: list[dict], is_token: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        fail = np.full(len(children), -1, dtype=np.int32)
        pops = np.zeros(len(children), dtype=np.int32)
        queue = deque([0])
        while queue:
            above = queue.popleft()
            for s, node in children[above].items():
                queue.append(node)
                if is_token[node]:
                    fail[node], pops[node] = 0, 1
                    continue
                at, popped = fail[above], pops[above]
                while s not in children[at]:
                    popped += pops[at]
                    at = fail[at]
                fail[node], pops[node] = children[at][s], popped
        return fail, pops

    def _child(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children, -1 where there are none."""
        keys = nodes.astype(np.int64) * SYMBOLS + symbols
        at = self._place(keys)
        there = self.edges[at]
        found = np.where(there == keys, self.targets[at], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            there = self.edges[at[left]]
            hit = there == keys[left]
            found[left[hit]] = self.targets[at[left[hit]]]
            left = left[~hit & (there >= 0)]
        return found

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word, given as UTF-8; an empty word has none."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        total = np.zeros(len(words), dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(words) else sizes
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        order = np.argsort(-sizes, kind="stable")
        state = np.zeros(len(words), dtype=np.int32)
        live = int(np.count_nonzero(sizes))
        for step in range(int(sizes.max(initial=0))):
            while live and sizes[order[live - 1]] <= step:
                live -= 1
            at = order[:live]
            symbols = data[starts[at] + step].astype(np.int64) + 256 * (sizes[at] == step + 1)
            now = state[at]
            to = self._child(now, symbols)
            miss = np.flatnonzero(to < 0)
            while len(miss):
                total[at[miss]] += self.pops[now[miss]]
                now[miss] = self.fail[now[miss]]
                to[miss] = self._child(now[miss], symbols[miss])
                miss = miss[to[miss] < 0]
            state[at] = to
        left = np.flatnonzero(state)
        while len(left):
            total[left] += self.pops[state[left]]
            state[left] = self.fail[state[left]]
            left = left[state[left] > 0]
        return total


class ChunkCounter:
    """Words * WORD + pieces of chunks, the words as the tokenizer file's own rules split them.

    Most chunks are a word with punctuation behind, two words by those rules, and
    are split in bulk. A worker keeps the automaton from task to task.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.match = LongestMatch(list(json.load(file)["model"]["vocab"]))
        self.to_bytes = str.maketrans({letter: chr(b) for letter, b in self.match.letters.items()})
        self.words = ChunkCache(lambda words: (WORD + self.match.counts([w.encode() for w in words])).tolist())

    def values(self, chunks: pa.Array) -> np.ndarray:
        split = SimpleParts(chunks)
        known = np.array(self.words.values(split.parts), dtype=np.int64)
        mine = known[split.words]
        mine[split.tailed] += known[split.tails]
        values = np.zeros(len(chunks), dtype=np.int64)
        values[split.places], values[split.odd] = mine, self._odd(split.others)
        return values

    def _odd(self, chunks: list[str]) -> np.ndarray:
        owner, words = [], []
        for i, chunk in enumerate(chunks):
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(chunk))
            owner += [i] * len(found)
            words += [w.translate(self.to_bytes).encode("latin-1") for w, _ in found]
        pieces = WORD + self.match.counts(words)
        total = np.zeros(len(chunks), dtype=np.int64)
        np.add.at(total, np.array(owner, dtype=np.int64), pieces)
        return total


@lru_cache(maxsize=2)
def _counter(path: str) -> ChunkCounter:
    return ChunkCounter(path)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words`` and ``n_tokens``, the greedy longest-match pieces of the whole text.

    Null and empty texts count 0; a null id stays null; repeated rows are
    counted each; other columns are not read; an empty table gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in gathered(batches):
            chunks, codes, starts = split_chunks(batch.column(1))
            running = np.concatenate(([0], np.cumsum(counter.values(chunks)[codes])))
            total = np.diff(running[starts])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total // WORD), pa.array(total % WORD)], names=["doc_id", "n_words", "n_tokens"])
        counter.words.known.clear()
        give_back()

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(rows, "doc_id long, n_words long, n_tokens long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts for every document under the public word-end vocabulary."""
    import public_tokenizers

    text_batches(spark)
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


QUERIES = {"op9_token_counts": op9_token_counts}
ORACLE_SQL: dict[str, str] = {}
