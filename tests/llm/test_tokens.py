import json
import os
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from heddle.llm import packing, wordpiece

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", None, "   ", "It's the user's 12 o'clock... don't 're", "<|endoftext|> inside a<|startoftext|>b", "Ünïcode É é café ́x İstanbul ΑΣ ǅ ﬁ Å ​", "tab\tand\x1cmore\x85 odd blanks",
    "日本語 テスト。 😀!! A.B.C, '' ''s", "word " * 3000, "x" * 30_000, "WORDS!! LIKE%%% these### a.b,c (d) [e] {f} \"g\" '", "ªº ½ ² ŉ ſ K × ÷ a×b",
]


def rows(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, 5, "s") for i, t in enumerate(texts)] + [(None, "no id here", 1, None), (0, "again", 1, None)], "doc_id long, text string, ids int, start string")


def ids_of(text):
    return Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids + [1]


def check_packing(pieces, texts, window=2048):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in pieces:
        sequences[r["sequence_id"]].append(r)
        documents[r["doc_id"]].append(r)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
    for key, text in texts:
        ids = ids_of(text)
        at = 0
        for r in sorted((r for r in documents[key] if r["doc_tokens"] == len(ids)), key=lambda r: r["start"]):
            mine = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(mine)) and mine == bytes(r["ids"])
            at += r["length"]
        assert at == len(ids), key
    fills = [sum(r["length"] for r in parts) for parts in sequences.values()]
    return sum(0 if f & (f - 1) == 0 else window - f for f in fills)


def test_packing_holds_every_id_once(spark):
    df = rows(spark)
    pieces = packing.pack(df.repartition(3), VOCABULARY).coalesce(1).collect()
    padding = check_packing(pieces, [*enumerate(TEXTS[1:], 1), (None, "no id here")])
    assert padding == 0
    assert sum(r["length"] for r in pieces) == sum(len(ids_of(t)) for t in [*TEXTS, "no id here", "again"])
    assert packing.pack(df.limit(0), VOCABULARY).count() == 0


def letters_and_marks():
    letters = [chr(c) for c in range(33, 0x530)] + ["İ", "ﬁ", "ẞ", "K"]
    texts = [" ".join(f"{a}b{c}" for a in letters[k : k + 40] for c in ("", ".", "'s", "!?", "-x")) for k in range(0, len(letters), 40)]
    return texts + [f"{a}{b}{c}" for a in ("Wo", "É", "") for b in ("...", "--'", "'", "`~", "</s>") for c in ("", "x", "é", "9")]


def test_ids_of_every_letter_and_mark():
    """Chunks that are split and lowered in bulk, and those that aren't, get the tokenizer's own ids."""
    texts = letters_and_marks()
    ids, begins = packing.token_ids(pa.array(texts), packing.ChunkEncoder(VOCABULARY))
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [ids_of(t)[:-1] for t in texts]


def test_sum_of_squares_rule():
    """Against the rule computed naively for every piece."""
    chance = np.random.default_rng(4)
    packer, window = packing.LevelPacker(64), 64
    count, closed, cut = [0] * 65, 0, 0
    for size in chance.integers(1, 64, 1500).tolist():
        def cost(level):
            after = list(count)
            if level:
                after[level] -= 1
            after[(level + size) % window] += 1
            return sum(n * n for n in after[1:window])

        fit = [h for h in range(window - size, -1, -1) if h == 0 or count[h]]
        if sum(count[1:]) >= 4 + closed // packing.OPEN_SHARE:
            # no new window: cutting is weighed instead, and taken if it is better
            fit = [h for h in fit if h] + [h for h in range(window - 1, window - size, -1) if count[h]]
        best = min(fit, key=lambda h: (cost(h), h + size > window, -h))
        assert packer._level_for(size) == best
        found = packer.add((0, 0, b"\0\0\0\0" * size, size), size)
        assert all(sum(len(p[2]) // 4 for p in w) == window for w in found) and len(found) == (best + size >= window)
        closed, cut = closed + len(found), cut + (best + size > window)
        if best:
            count[best] -= 1
        count[(best + size) % window] += 1
        count[0] = 0
    assert (packer.n_closed, packer.n_open) == (closed, sum(count)) and 0 < cut < closed
    left = list(packer.drain())
    fills = [sum(len(p[2]) // 4 for p in w) for w in left]
    assert sum(fills) == sum(h * n for h, n in enumerate(count)) and all(f == 64 or f & (f - 1) == 0 for f in fills)
    assert packer.n_drained == len(left) < 0.3 * closed


def test_large_inputs_are_hardly_cut():
    chance = np.random.default_rng(8)
    packer, cuts = packing.LevelPacker(), 0
    for size in np.clip(np.exp2(chance.normal(8.5, 1.5, 20_000)), 1, 2047).astype(int).tolist():
        cuts += sum(len(w[-1][2]) // 4 != size for w in packer.add((0, 0, bytes(4 * size), size), size))
    assert packer.n_open <= packing.MOST_OPEN and packer.n_drained == 0 and cuts < 0.3 * packer.n_closed


@pytest.mark.parametrize("partitions", [1, 8])
def test_the_rule_closes_most_sequences(partitions):
    """Of the documents of the 0.01 tables, dealt to partitions, windows of several documents."""
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("needs the test tables")
    sizes = [len(i.ids) + 1 for i in Tokenizer.from_file(VOCABULARY).encode_batch_fast([t or "" for t in pq.read_table(path, columns=["text"]).column(0).to_pylist()], add_special_tokens=False)]
    closed = drained = 0
    for part in range(partitions):
        packer = packing.LevelPacker()
        for size in sizes[part::partitions]:
            for start in range(0, size, 2048):
                n = min(2048, size - start)
                packer.add((0, start, bytes(4 * n), size), n)
        list(packer.drain())
        closed, drained = closed + packer.n_closed, drained + packer.n_drained
    assert closed > drained


def naive_counts(text, tokenizer, vocabulary):
    words = pieces = 0
    for word, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(text or "")):
        words, i = words + 1, 0
        while i < len(word):
            for j in range(len(word), i, -1):
                if word[i:j] + ("</w>" if j == len(word) else "") in vocabulary or j == i + 1:
                    i, pieces = j, pieces + 1
                    break
    return words, pieces


def test_counts_against_greedy_matching(spark):
    tokenizer, vocabulary = Tokenizer.from_file(VOCABULARY), set(json.load(open(VOCABULARY))["model"]["vocab"])
    texts = [t for t in TEXTS if t is None or len(t) < 20_000]
    found = wordpiece.token_counts(rows(spark, texts), VOCABULARY).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_tokens"]) for r in found), key=str)
    want = sorted(((k, *naive_counts(t, tokenizer, vocabulary)) for k, t in [*enumerate(texts), (None, "no id here"), (0, "again")]), key=str)
    assert got == want
    assert wordpiece.token_counts(rows(spark).limit(0), VOCABULARY).count() == 0


def test_counts_of_every_letter_and_mark():
    texts = letters_and_marks()
    tokenizer, vocabulary = Tokenizer.from_file(VOCABULARY), set(json.load(open(VOCABULARY))["model"]["vocab"])
    chunks = sorted({c for t in texts for c in t.split(" ")})
    found = wordpiece.ChunkCounter(VOCABULARY).values(pa.array(chunks))
    assert [divmod(v, wordpiece.WORD) for v in found.tolist()] == [naive_counts(c, tokenizer, vocabulary) for c in chunks]


@pytest.mark.parametrize("seed", range(3))
def test_automaton_against_greedy_matching(seed):
    chance = np.random.default_rng(seed)
    tokens = ["".join(chance.choice(list("abc"), chance.integers(1, 7))) + chance.choice(["", "</w>"]) for _ in range(60)]
    match = wordpiece.LongestMatch(tokens)
    words = ["".join(chance.choice(list("abcd"), chance.integers(1, 20))) for _ in range(300)]

    def naive(word):
        i = n = 0
        while i < len(word):
            for j in range(len(word), i, -1):
                if word[i:j] + ("</w>" if j == len(word) else "") in tokens or j == i + 1:
                    i, n = j, n + 1
                    break
        return n

    assert match.counts([w.encode() for w in words] + [b""]).tolist() == [naive(w) for w in words] + [0]
