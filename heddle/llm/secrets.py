"""Secrets in text: fixed patterns, and a conditional random field that adds to them.

The field is a linear chain over a document's tokens with the tags B (a secret
begins), I (inside one) and O (outside). A tag's score sums weights for the
token's shape, the two tokens before, the one after and the file's kind, and for
the tag before it. Weights maximise the likelihood of a bounded sample of
documents, tagged by the patterns and by secrets drawn into them at training.

Most words can never be tagged other than O: where a shape's best case stays
below O by more than transitions can return, the best path passes O there. Such
tokens cut the chain, so Viterbi runs over the few short stretches between them
and finds the same path as over the whole.
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.llm.batches import text_batches
from heddle.sources import table

#: Documents that the field is trained on, at most.
FIT_ROWS = 1500
#: Longer documents are not trained on; they are scanned like all others.
FIT_CHARS = 50_000
#: Tokens before and after each drawn or found secret that are trained on.
MARGIN = 6
SEED = 11

BASE_KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_KEYWORDS = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_CHUNK = re.compile(r"\S+")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]+|[^\sA-Za-z0-9+/_-]")
TAGS = 3
B, I, O = range(TAGS)

#: Words before a value, by family; each is a shape of its own.
FAMILIES = {
    "password": "secret", "passwd": "secret", "pwd": "secret", "secret": "secret", "token": "secret", "apikey": "secret", "api_key": "secret", "api-key": "secret",
    "auth": "access", "bearer": "access", "authorization": "access", "credential": "access", "credentials": "access", "key": "access", "private_key": "access", "access_key": "access",
    "sha1": "digest", "sha256": "digest", "md5": "digest", "commit": "digest", "hash": "digest", "uuid": "digest", "id": "digest", "isbn": "digest",
}
MARKS = {"=": "equals", ":": "colon", '"': "quote", "'": "quote", "@": "at", ".": "dot", "+": "plus", "(": "open", ")": "close", "|": "bar"}
SHAPES = ("edge", "word", "name", "upper", "mark", "secret", "access", "digest", *dict.fromkeys(MARKS.values()), "digits_short", "digits_long")
LENGTHS = (8, 12, 16, 20, 24, 32, 40)
MIXES = ("lower_digit", "upper_digit", "hex", "mixed", "mixed_digit", "symbols")
SHAPE = {name: i for i, name in enumerate((*SHAPES, *(f"{mix}_{n}" for mix in MIXES for n in (0, *LENGTHS))))}
FILE_KINDS = 3
#: Shapes that are no secret wherever they stand: plain words, marks, short tokens.
NEVER = [i for name, i in SHAPE.items() if name in SHAPES and name != "digits_long" or name.endswith("_0")]


def shape(token: str) -> int:
    """The shape of a token: its family, kind of mark, or mix of letters with a length."""
    if len(token) == 1 and not token.isalnum():
        return SHAPE[MARKS.get(token, "mark")]
    family = FAMILIES.get(token.lower())
    if family:
        return SHAPE[family]
    if token.isalpha():
        changes = sum(a.islower() and b.isupper() for a, b in zip(token, token[1:]))
        if changes < 2 or len(token) < 16:
            return SHAPE["upper" if token.isupper() else "name" if token[0].isupper() else "word"]
        return SHAPE[f"mixed_{max(n for n in (0, *LENGTHS) if n <= len(token))}"]
    if token.isdigit():
        return SHAPE["digits_short" if len(token) < 12 else "digits_long"]
    digit = any(c.isdigit() for c in token)
    if not digit:
        return SHAPE["word" if token.lower() == token else "name"]
    if all(c in "0123456789abcdef" for c in token):
        mix = "hex"
    elif not token.isalnum():
        mix = "symbols"
    elif token.islower():
        mix = "lower_digit"
    elif token.isupper():
        mix = "upper_digit"
    else:
        mix = "mixed_digit"
    return SHAPE[f"{mix}_{max(n for n in (0, *LENGTHS) if n <= len(token))}"]


class Shapes(dict):
    """Shapes of the words met, of bounded number and length."""

    def __missing__(self, word: str) -> int:
        found = shape(word)
        if len(word) <= 64:
            if len(self) >= 200_000:
                self.clear()
            self[word] = found
        return found


def file_kind(text: str) -> int:
    """The file's features: prose, text with assignments, or code and settings."""
    marks = text.count("=") + text.count("{") + text.count(";")
    return 0 if not marks else 1 if marks * 200 < len(text) else 2


class ChainField:
    """Weights of the field and its exact decoding.

    ``own``, ``back``, ``back2`` and ``ahead`` score a tag by the shape of the
    token, of the two before and of the next; ``file`` by the file's kind; ``move``
    by the tag before.
    """

    NAMES = ("own", "back", "back2", "ahead", "file", "move")

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        n = len(SHAPE)
        sizes = {"own": n, "back": n, "back2": n, "ahead": n, "file": FILE_KINDS, "move": TAGS}
        self.weights = weights or {name: np.zeros((size, TAGS)) for name, size in sizes.items()}
        self.weights["own"][NEVER, O] = max(100.0, 10 * max(np.abs(w).max() for w in self.weights.values()))
        self._bounds()

    def _bounds(self) -> None:
        """Shapes whose tag is O on a best path whatever stands around them."""
        w = self.weights
        gain = [(w[k][:, :O] - w[k][:, O:]).max(axis=0) for k in ("back", "back2", "ahead", "file")]
        move = w["move"]
        turn = [max((move[a, t] + move[t, c]) - (move[a, O] + move[O, c]) for a in range(TAGS) for c in range(TAGS)) for t in (B, I)]
        best = (w["own"][:, :O] - w["own"][:, O:]) + np.sum(gain, axis=0) + np.array(turn)
        self.certain = best.max(axis=1) < 0

    def scores(self, shapes: np.ndarray, kind: int) -> np.ndarray:
        """Tag scores of a stretch of tokens; two edge tokens before and one behind are not scored."""
        w = self.weights
        return w["own"][shapes[2:-1]] + w["back"][shapes[1:-2]] + w["back2"][shapes[:-3]] + w["ahead"][shapes[3:]] + w["file"][kind]

    def viterbi(self, scores: np.ndarray, before: int | None = None, behind: int | None = None) -> list[int]:
        """The best tags of a stretch between fixed tags."""
        move = self.weights["move"]
        best = scores[0] + (move[before] if before is not None else 0)
        links = []
        for row in scores[1:]:
            paths = best[:, None] + move
            links.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        if behind is not None:
            best = best + move[:, behind]
        tags = [int(best.argmax())]
        for link in reversed(links):
            tags.append(int(link[tags[-1]]))
        return tags[::-1]

    def tag(self, shapes: np.ndarray, kind: int) -> np.ndarray:
        """Tags of a whole document, given its tokens' shapes."""
        tags = np.full(len(shapes), O)
        open_at = np.flatnonzero(~self.certain[shapes])
        if not len(open_at):
            return tags
        edge = SHAPE["edge"]
        padded = np.concatenate(([edge, edge], shapes, [edge]))
        for run in np.split(open_at, np.flatnonzero(np.diff(open_at) > 1) + 1):
            a, b = run[0], run[-1] + 1
            scores = self.scores(padded[a : b + 3], kind)
            tags[a:b] = self.viterbi(scores, O if a else None, O if b < len(shapes) else None)
        return tags


def tokens(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Tokens with their first and past-the-end code points."""
    found = [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(text)]
    if not found:
        return [], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    words, starts, ends = zip(*found)
    return list(words), np.array(starts), np.array(ends)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed patterns match, in order."""
    found = []
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def value_spans(text: str) -> list[tuple[int, int]]:
    """The secrets themselves within the base spans: the value of an assignment, else the whole match."""
    found = [m.span(2) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    return found + [m.span() for p in (_ACCESS, _HEX) for m in p.finditer(text)]


def _drawn(chance: np.random.Generator) -> str:
    """A made-up line with a secret between marks (the secret's own ends are \\x00)."""
    alphabets = ("abcdef0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
    letters = alphabets[chance.integers(len(alphabets))]
    value = "".join(chance.choice(list(letters), size=int(chance.integers(18, 48))))
    if chance.random() < 0.5:
        return f"\x00{value}\x00"
    name = chance.choice(["password", "secret", "token", "api_key", "auth", "bearer", "private_key", "access_key"])
    return chance.choice(['{} = "{}"', "{}: {}", "{}='{}'", "{} {}"]).format(name, f"\x00{value}\x00")


def training_stretches(texts: list[str], seed: int = SEED) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(shapes with edges, tags, file kind) around secrets, found and drawn, and elsewhere."""
    chance, out, known = np.random.default_rng(seed), [], Shapes()
    for text in texts:
        text = text.replace("\x00", "")
        gold = value_spans(text)
        blanks = [m.start() for m in re.finditer(" ", text)]
        drawn = sorted(chance.choice(blanks, size=min(2, len(blanks)), replace=False).tolist()) if blanks else []
        shifted, at, made = [], 0, []
        for place in drawn:
            if any(a <= place < b for a, b in gold):
                continue
            shifted.append(text[at:place] + " ")
            line = _drawn(chance)
            start = sum(map(len, shifted)) + line.index("\x00")
            made.append((start, start + len(line) - 2 - line.index("\x00") - (len(line) - 1 - line.rindex("\x00"))))
            shifted.append(line.replace("\x00", ""))
            at = place
        whole = "".join(shifted) + text[at:]
        gold = value_spans(whole) + made
        words, starts, ends = tokens(whole)
        if not words:
            continue
        shapes = np.array(list(map(known.__getitem__, words)))
        tags = np.full(len(words), O)
        for a, b in gold:
            inside = np.flatnonzero((starts < b) & (ends > a))
            tags[inside] = I
            tags[inside[:1]] = B
        kind = file_kind(text)
        padded = np.concatenate(([SHAPE["edge"]] * 2, shapes, [SHAPE["edge"]]))
        odd = np.flatnonzero((shapes >= SHAPE["digits_short"]) | (tags != O))[:40]
        for c in {*odd.tolist(), int(chance.integers(len(words)))}:
            a, b = max(0, c - MARGIN), min(len(words), c + MARGIN + 1)
            out.append((padded[a : b + 3], tags[a:b], kind))
    return out


def likelihood_gradient(w: dict[str, np.ndarray], places: dict[str, np.ndarray], gold: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of the stretches' summed log-likelihood in all weights.

    ``places`` are the rows of each table of weights by stretch and token, ``gold``
    the tags; ``mask`` is true on a stretch's own tokens, which come first. Forward
    and backward sums are scaled at each token, so that they stay in range.
    """
    n, length = gold.shape
    one, pairs = np.eye(TAGS), mask[:, 1:] & mask[:, :-1]
    score = sum(w[k][places[k]] for k in places)
    own, move = np.exp(score - score.max(axis=2, keepdims=True)), np.exp(w["move"] - w["move"].max())
    ahead, behind = np.ones((n, length, TAGS)), np.ones((n, length, TAGS))
    ahead[:, 0] = own[:, 0]
    for i in range(1, length):
        step = (ahead[:, i - 1] @ move) * own[:, i]
        ahead[:, i] = np.where(mask[:, i, None], step / step.sum(axis=1, keepdims=True), 1)
    for i in range(length - 2, -1, -1):
        step = (own[:, i + 1] * behind[:, i + 1]) @ move.T
        behind[:, i] = np.where(mask[:, i + 1, None], step / step.sum(axis=1, keepdims=True), 1)
    share = ahead * behind
    share *= mask[:, :, None] / share.sum(axis=2, keepdims=True)
    error = one[gold] * mask[:, :, None] - share
    grad = {k: np.stack([np.bincount(at.ravel(), weights=error[:, :, tag].ravel(), minlength=len(w[k])) for tag in range(TAGS)], axis=1) for k, at in places.items()}
    joint = ahead[:, :-1, :, None] * move * (own[:, 1:] * behind[:, 1:])[:, :, None, :]
    joint *= (pairs / joint.sum(axis=(2, 3)))[:, :, None, None]
    counts = np.bincount((gold[:, :-1] * TAGS + gold[:, 1:])[pairs], minlength=TAGS * TAGS).reshape(TAGS, TAGS)
    return grad | {"move": counts - joint.sum(axis=(0, 1))}


def train(stretches: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 150, rate: float = 0.1, shrink: float = 1e-3) -> ChainField:
    """Maximise the stretches' mean log-likelihood less a quadratic penalty, by Adam on exact gradients."""
    field = ChainField()
    stretches = [s for s in stretches if len(s[1])]
    if not stretches:
        field.weights["own"][:, O] = 1.0  # nothing learnt, nothing tagged
        return ChainField(field.weights)
    w, (places, gold, mask) = field.weights, _stacked(stretches)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    for t in range(1, rounds + 1):
        grad = likelihood_gradient(w, places, gold, mask)
        for k in w:
            g = grad[k] / len(gold) - shrink * w[k]
            first, second = moment[k]
            first *= 0.9
            first += 0.1 * g
            second *= 0.999
            second += 0.001 * g * g
            w[k] += rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return ChainField(w)


def _stacked(stretches: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """(places, gold, mask) of ``likelihood_gradient``."""
    n, length = len(stretches), max(len(t) for _, t, _ in stretches)
    shapes = np.full((n, length + 3), SHAPE["edge"])
    gold, mask = np.full((n, length), O), np.zeros((n, length), dtype=bool)
    kinds = np.array([k for _, _, k in stretches])
    for i, (s, t, _) in enumerate(stretches):
        shapes[i, : len(s)], gold[i, : len(t)], mask[i, : len(t)] = s, t, True
    places = {"own": shapes[:, 2:-1], "back": shapes[:, 1:-2], "back2": shapes[:, :-3], "ahead": shapes[:, 3:], "file": np.repeat(kinds[:, None], length, axis=1)}
    return places, gold, mask


class Scanner:
    """Base spans and those that the field adds, for whole texts."""

    def __init__(self, field: ChainField):
        self.field = field
        self.shapes = Shapes()

    #: What every token outside NEVER has somewhere: it is of 8 characters or more with a
    #: digit, or of letters that change to upper case twice.
    UNSURE = re.compile(r"[0-9][0-9A-Za-z+/_-]{3}|[A-Za-z+/_-]{3}[0-9]|[a-z][A-Z][A-Za-z]*[a-z][A-Z]")

    def scan(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end), kinds as BASE_KINDS and then the field's own.

        A span of the field that touches a base span is not added.
        """
        spans, added, kind = base_spans(text), [], None
        begins, furthest = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))
        for a, b in self._stretches(text):
            # two tokens before a stretch and one behind stand in the scores
            words, starts, ends = tokens(text[a:b])
            shapes = np.fromiter(map(self.shapes.__getitem__, words), dtype=np.int64, count=len(words))
            if self.field.certain[shapes].all():
                continue
            kind = file_kind(text) if kind is None else kind
            tags = self.field.tag(shapes, kind)
            for k in np.flatnonzero(tags == B):
                end = k
                while end + 1 < len(tags) and tags[end + 1] == I:
                    end += 1
                span = (a + int(starts[k]), len(BASE_KINDS), a + int(ends[end]))
                before = bisect_left(begins, span[2])  # the base spans that begin before its end
                if not before or furthest[before - 1] <= span[0]:
                    added.append(span)
        return sorted(spans + added)

    def redacted(self, text: str, mark: str) -> str:
        """The text with ``mark`` in place of its secrets; values of assignments, not their names."""
        spans = [(a, e) for a, k, e in self.scan(text) if k]
        if any(word in text.lower() for word in _KEYWORDS):
            spans += value_spans(text)
        out, at = [], 0
        for a, b in sorted(spans):
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join(out) + text[at:] if spans else text

    def _stretches(self, text: str) -> Iterator[tuple[int, int]]:
        """Parts of the text, cut at blanks, outside of which every tag is O.

        A part holds a token of an uncertain shape with five chunks without
        blanks, or the text's end, on each side of certain shapes, so that
        decoding it alone gives the tags of the whole text.
        """
        found = [m.span() for m in self.UNSURE.finditer(text)]
        if not found:
            return
        starts, ends = zip(*(m.span() for m in _CHUNK.finditer(text)))
        a = b = None
        for left, right in found:
            left, right = bisect_right(starts, left) - 1, bisect_left(ends, right)
            left, right = starts[max(0, left - 5)], ends[min(len(ends) - 1, right + 5)]
            if a is None:
                a, b = left, right
            elif left <= b:
                b = max(b, right)
            else:
                yield a, b
                a, b = left, right
        yield a, b


def may_hold(text: Column) -> Column:
    """Whether a text has anything that a secret needs; others have no spans. Null for null.

    An uncertain token has a digit among letters or two changes to upper case;
    what else the patterns match has 24 letters of a hexadecimal run, an access
    key's beginning, or a name and the mark of an assignment. Each test begins
    with a rare character, so that the scan passes over prose quickly.
    """
    digit = text.rlike("[0-9](?:[0-9A-Za-z+/_-]{3}|(?<=[A-Za-z+/_-]{3}[0-9]))")
    changes = text.rlike("[A-Z](?<=[a-z][A-Z])[A-Za-z]*[a-z][A-Z]")
    assigned = (F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))) & text.rlike("(?i)passw|secret|token|api_?key")
    return digit | F.contains(text, F.lit("AKIA")) | assigned | changes | text.rlike("[a-f]{24}")


def train_on(docs: DataFrame, rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> ChainField:
    """A field trained on at most ``rows`` documents, the least by a hash of the id, and the same each time."""
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(f"id is not null and length(text) <= {FIT_CHARS}")
    ids = read.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = read.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text"))
    return train(training_stretches([r["text"] for r in sorted(texts.collect(), key=lambda r: r["id"])]))


def find_secrets(docs: DataFrame, field: ChainField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (start, kind, end) of the secrets of every row, in order.

    Kinds 0 to 2 are BASE_KINDS, 3 is what the field adds. Starts and ends are
    code points, the end exclusive. Null and empty texts have no spans; null ids
    stay null; repeated rows are scanned each; other columns are not read; an
    empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field.weights)

    @F.pandas_udf("array<struct<start:long,kind:int,end:long>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(ChainField(sent.value))
        for texts in batches:
            yield pd.Series([None if t is None else [{"start": a, "kind": k, "end": b} for a, k, b in scanner.scan(t)] for t in texts], dtype=object)

    # texts without any sign of a secret stay in the JVM
    text, none = F.col(text_col), F.array().cast("array<struct<start:long,kind:int,end:long>>")
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(scan(F.when(may_hold(text), text)), none).alias("spans"))


def redact(docs: DataFrame, field: ChainField, mark: str = "<SECRET>", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every secret in the texts replaced by ``mark``.

    Of an assignment the value goes and the name stays. A column of lengths, if
    there is one, follows. Null texts stay null. Only texts that may hold a secret
    leave the JVM.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field.weights)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(ChainField(sent.value))
        for texts in batches:
            yield texts.map(lambda t: t if t is None else scanner.redacted(t, mark))

    text = docs[text_col]
    changed = docs.withColumn(text_col, F.coalesce(clean(F.when(may_hold(text), text)), text))
    if length_col not in docs.columns:
        return changed
    length = F.when(F.col(text_col).isNotNull(), F.length(text_col)).otherwise(F.col(length_col))
    return changed.withColumn(length_col, length.cast(docs.schema[length_col].dataType))


def _written(spans):
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, (*BASE_KINDS, "crf")))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _count(spans, kind: int):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole document, as counts and digests of spans."""
    text_batches(spark)
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, train_on(docs))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    return found.select(
        "doc_id",
        *(_count(F.col("spans"), i).alias(f"n_{name}") for i, name in enumerate(BASE_KINDS)),
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )


QUERIES = {"op6_secrets": op6_secrets}
ORACLE_SQL: dict[str, str] = {}
