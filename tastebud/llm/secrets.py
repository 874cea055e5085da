"""Secret scan: a linear-chain conditional random field over the words of a text.

Words (also cut at commas, semicolons, ampersands and braces, so that a line of
JSON or a query string is not one word) are tagged as secret begin (B), inside
(I) or outside (O).  Features read a word to its end.  A word's scores are sums of learned weights for its shape, its length, character mix
and keywords, for the shape of both neighbours, and for features of the whole
text; transitions have weights too.  Viterbi decodes the best tag sequence.

The weights are learned by stochastic gradient descent on the exact
log-likelihood (forward and backward sums) from a bounded sample of texts, in a
bounded number of windows around the spans of the fixed rules and around other odd words; the
fixed rules give the tags.  So the field learns what secrets look like and adds
spans that no rule matches literally; every span of the rules stays.

Decoding is exact over whole texts of any length: a word whose outside score
leads by more than the transitions can ever win back is outside in the best
sequence, so only the runs of other words between such words are decoded.

Offsets are code points, ends exclusive.  Null or empty text: no spans, the
digest of the empty string.  Repeated rows are scanned apiece, a null id is
carried, extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MEMO_WORDS, materialize, mix64, ship_package

# The patterns of the base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "crf")

WORD = re.compile(r"[^\x20\x09-\x0D,;&{}]+")

BITS = 16
O, B, I = 0, 1, 2  # noqa: E741
EDGES = "\"'`()[]{}<>,;:.!?#$%&*|="
KEYWORDS = ("pass", "secret", "token", "key", "pwd", "auth", "cred")
KEYWORD, LETTERS_HEX = re.compile("|".join(KEYWORDS)), re.compile("[a-fA-F]+")
WINDOW = 6          # words kept on both sides of an odd word for training
OTHERS = 40         # odd words outside the rules' spans that one text gives to training, by hash
WINDOWS = 40_000    # windows learned from, chosen by hash where the sampled texts have more


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed rules, by start, then kind as listed."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


def shape(word: str) -> str:
    """Runs of letters and digits as one sign each; what repeats at once stands there once, with a plus."""
    s = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() else "a" if m[0].islower() else "Aa", word)
    return re.sub(r"(.{1,4}?)\1+", r"\1+", re.sub(r"[0-9]+", "9", s))


def word_features(word: str) -> list[str]:
    """Features of a word that the word alone decides."""
    core = word.strip(EDGES)
    n, digits = len(core), sum(map(str.isdigit, core))
    turns = len(re.findall(r"[a-z][0-9]|[0-9][a-z]|[A-Z][0-9]|[0-9][A-Z]", core))
    hexed = bool(re.fullmatch(r"[0-9a-fA-F]+", core))
    out = ["s:" + shape(word), f"n:{min(12, n // 4)}", f"d:{min(5, math.ceil(5 * digits / max(1, n)))}", f"t:{min(6, turns)}"]
    out += [f"h:{hexed}:{min(6, n // 8)}", f"q:{word[:1] in '\"\''}", f"e:{'=' in word.strip('=')}"]
    if turns >= 2 and n >= 12:
        out.append("mixed")
    out += ["k:" + k for k in dict.fromkeys(KEYWORD.findall(word.lower()))]
    return out


def slots(features: list[str], where: str) -> list[int]:
    return [xxhash.xxh32_intdigest(where + f) >> (32 - BITS) for f in features]


def text_features(text: str) -> list[str]:
    return [f"quote:{'\"' in text}", f"assign:{'=' in text}", f"long:{len(text) > 5000}"]


class Field:
    """Weights (table rows by tags) and transitions."""

    def __init__(self) -> None:
        self.w = np.zeros((1 << BITS, 3))
        self.t = np.zeros((3, 3))

    def rows(self, words: list[str], doc: list[int]) -> list[list[int]]:
        own = [word_features(w) for w in words]
        near = [[f[0], f[4], *f[7:]] for f in own]
        return [doc + slots(own[i], "") + slots(near[i - 1] if i else ["first"], "<")
                + slots(near[i + 1] if i + 1 < len(own) else ["last"], ">") for i in range(len(own))]

    def step(self, rows: list[list[int]], tags: list[int], rate: float) -> None:
        """One step up the gradient of the log-likelihood of a sequence."""
        n = len(rows)
        e = np.array([self.w[r].sum(axis=0) for r in rows])
        alpha, beta = np.zeros((n, 3)), np.zeros((n, 3))
        alpha[0] = e[0]
        for i in range(1, n):
            alpha[i] = e[i] + np.logaddexp.reduce(alpha[i - 1][:, None] + self.t, axis=0)
        for i in range(n - 2, -1, -1):
            beta[i] = np.logaddexp.reduce(self.t + (e[i + 1] + beta[i + 1])[None, :], axis=1)
        z = np.logaddexp.reduce(alpha[-1])
        grad = -np.exp(alpha + beta - z)
        grad[np.arange(n), tags] += 1
        change = np.zeros((3, 3))
        for i in range(1, n):
            change -= np.exp(alpha[i - 1][:, None] + self.t + (e[i] + beta[i])[None, :] - z)
            change[tags[i - 1], tags[i]] += 1
        self.t += rate * (change - 1e-3 * self.t)
        for r, g in zip(rows, grad, strict=True):
            if np.abs(g).max() > 1e-4:
                np.add.at(self.w, r, rate * g)

    def viterbi(self, e: np.ndarray, left: int | None, right: int | None) -> list[int]:
        """Best tags of a run between two known tags (None: the text's end)."""
        score, back = e[0] + (self.t[left] if left is not None else 0), []
        for i in range(1, len(e)):
            to = score[:, None] + self.t
            back.append(to.argmax(axis=0))
            score = to.max(axis=0) + e[i]
        if right is not None:
            score = score + self.t[:, right]
        tags = [int(score.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return tags[::-1]

    def slack(self) -> float:
        """The most that a path through a word can win by its transitions against tagging it outside."""
        best = max(self.t[a, x] + self.t[x, c] - self.t[a, O] - self.t[O, c] for a in range(3) for c in range(3) for x in (B, I))
        ends = max(max(self.t[a, x] - self.t[a, O], self.t[x, a] - self.t[O, a]) for a in range(3) for x in (B, I))
        return float(max(best, ends, 0.0))


def tagged(text: str) -> tuple[list[str], list[int], list[tuple[int, int]]]:
    """Words, tags by the fixed rules, and places."""
    at = [m.span() for m in WORD.finditer(text)]
    words, tags, k = [text[a:z] for a, z in at], [], 0
    spans = base_spans(text)
    last = None
    for a, z in at:
        while k < len(spans) and spans[k][2] <= a:
            k += 1
        hit = next((s for s in spans[k:] if s[1] < z and s[2] > a), None) if k < len(spans) and spans[k][1] < z else None
        tags.append(O if hit is None else I if last is not None and hit[1] < last[2] else B)
        last = hit
    return words, tags, at


def train(texts: list[str], epochs: int = 4, rate: float = 0.1, seed: int = 5, windows: int = WINDOWS) -> Field:
    """Fit on windows around every tagged word, OTHERS other words with digits or signs a text, and two places of any kind.

    Where that makes more than ``windows`` of them, those of least hash are taken.
    """
    field, rng, cuts, seqs = Field(), np.random.default_rng(seed), [], []
    for text in texts:
        words, tags, _ = tagged(text)
        odd = [i for i, (w, t) in enumerate(zip(words, tags, strict=True)) if not t and re.search(r"[0-9=@:_]", w)]
        odd = sorted(odd, key=lambda i: xxhash.xxh64_intdigest(f"{i} {words[i]}"))[:OTHERS]
        odd = sorted(odd + [i for i, t in enumerate(tags) if t])
        cuts.append(np.array(odd + list(rng.integers(0, len(words), min(2, len(words)))), np.int64))
    if sum(map(len, cuts)) > windows:
        order = [mix64((np.uint64(k) << np.uint64(32)) + at.astype(np.uint64)) for k, at in enumerate(cuts)]
        last = np.partition(np.concatenate(order), windows - 1)[windows - 1]
        cuts = [at[h <= last] for at, h in zip(cuts, order, strict=True)]
    for text, at in zip(texts, cuts, strict=True):
        if not len(at):
            continue
        words, tags, _ = tagged(text)
        doc = slots(text_features(text), "doc")
        for i in at:
            a, z = max(0, int(i) - WINDOW), min(len(words), int(i) + WINDOW + 1)
            seqs.append((field.rows(words[a:z], doc), tags[a:z]))
    for epoch in range(epochs):
        for k in rng.permutation(len(seqs)):
            field.step(*seqs[k], rate / (1 + epoch))
    return field


class WordScores(dict):
    """Row of each distinct word in a table of scores: its own, and what it adds to its neighbours.

    Words of one pattern share a row.  Both are emptied at MEMO_WORDS words.
    """

    def __init__(self, field: Field) -> None:
        super().__init__()
        self.field, self.rows, self.table, self.patterns = field, [], np.zeros((0, 9)), {}

    def __missing__(self, word: str) -> int:
        core = word.strip(EDGES)
        if core.isalpha():      # all that the features of such a word depend on
            case = 0 if core.islower() else 1 if core.isupper() else 2
            key = (*word.split(core, 1), case, min(12, len(core) // 4), LETTERS_HEX.fullmatch(core) is None, *KEYWORD.findall(word.lower()))
        else:
            key = word
        at = self.patterns.get(key)
        if at is None:
            own = word_features(word)
            near, w = [own[0], own[4], *own[7:]], self.field.w
            at = self.patterns[key] = len(self.rows)
            self.rows.append(np.concatenate([w[slots(f, side)].sum(axis=0) for f, side in ((own, ""), (near, "<"), (near, ">"))]))
        self[word] = at
        return at

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) >= MEMO_WORDS:
            self.clear()
            self.patterns.clear()
            self.rows.clear()
            self.table = np.zeros((0, 9))
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if len(self.rows) > len(self.table):
            self.table = np.concatenate([self.table, self.rows[len(self.table):]])
        return self.table[at]


def decode(text: str, words: list[str], table: np.ndarray, field: Field, slack: float) -> list[tuple[int, int]]:
    """First and last word of each secret in the best tag sequence."""
    w = field.w
    e = table[:, :3].copy()
    e[1:] += table[:-1, 3:6]
    e[0] += w[slots(["first"], "<")].sum(axis=0)
    e[:-1] += table[1:, 6:9]
    e[-1] += w[slots(["last"], ">")].sum(axis=0)
    e += w[slots(text_features(text), "doc")].sum(axis=0)
    open_ = np.flatnonzero(e[:, O] - e[:, 1:].max(axis=1) <= slack)
    found = []
    if not len(open_):
        return found
    for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
        a, z = int(run[0]), int(run[-1])
        tags = field.viterbi(e[a : z + 1], O if a else None, O if z + 1 < len(words) else None)
        for i, t in enumerate(tags):
            if t == B or t == I and (i == 0 or tags[i - 1] == O):
                found.append((a + i, a + i))
            elif t == I:
                found[-1] = (found[-1][0], a + i)
    return found


def secret_spans(text: str, memo: WordScores, field: Field, slack: float) -> tuple[list, list]:
    """Base spans, and all spans: the field's are those outside every base span, without quotes and signs at the ends."""
    base = base_spans(text)
    words = WORD.findall(text)
    spans = list(base)
    if words:
        hits = decode(text, words, memo.of(words), field, slack)
        if hits:
            at = [m.span() for m in WORD.finditer(text)]
            for first, last in hits:
                a, z = at[first][0], at[last][1]
                core = text[a:z]
                a += len(core) - len(core.lstrip(EDGES))
                z -= len(core) - len(core.rstrip(EDGES))
                if a < z and not any(s < z and a < e for _, s, e in base):
                    spans.append(("crf", a, z))
    return base, sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _scan(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = model.value
        memo, slack = WordScores(field), field.slack()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, spans = secret_spans(text or "", memo, field, slack)
                kinds = [k for k, _, _ in base]
                rows.append((*(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(digest(base).encode()).hexdigest(),
                             digest(spans), len(spans) - len(base)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"])
    return run


def _redact(model, mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = model.value
        memo, slack = WordScores(field), field.slack()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            out = []
            for text in batch.column(at).to_pylist():
                spans = secret_spans(text, memo, field, slack)[1] if text else []
                if spans:
                    parts, end = [], 0
                    for _, a, z in spans:
                        if a >= end:
                            parts += [text[end:a], mark]
                        end = max(end, z)
                    text = "".join([*parts, text[end:]])
                out.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))
    return run


def fitted(docs: DataFrame, sample: int = 1500, longest: int = 20_000, windows: int = WINDOWS) -> Field:
    """A field learned from at most ``sample`` texts with rule spans and a third as many others, by hash of id and text.

    Texts over ``longest`` characters are scanned, not learned from: 60 MB at most.  One scan counts both kinds;
    a second one takes the texts under the hash that leaves about twice the sample, equal rows once.
    """
    rule = r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}|[:=] *[\"']?[A-Za-z0-9+/_.=-]{12}"
    has, wanted = F.col("text").rlike(rule), {True: sample, False: sample // 3}
    texts = docs.select("text", F.xxhash64("doc_id", "text").alias("h")).filter(F.length("text").between(1, longest))
    counts = dict(texts.groupBy(has).count().collect())
    last = {k: min(2**63 - 1, int(2**65 * n / counts[k]) - 2**63) for k, n in wanted.items() if counts.get(k)}
    if not last:
        return train([])
    few = texts.filter(F.col("h") <= max(last.values())).select("text", "h", has.alias("has"))      # the pattern on few texts only
    few = materialize(few.filter(F.col("h") <= F.when(F.col("has"), last.get(True)).otherwise(last.get(False)))
                      .groupBy("has", "h").agg(F.min("text").alias("text")), "secrets_sample")
    rows = [r["text"] for k, n in wanted.items() if k in last
            for r in few.filter(F.col("has") == F.lit(k)).orderBy("h").limit(n).collect()]
    return train(rows, windows=windows)


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf for every row of ``docs``."""
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(field)
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        _scan(model), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long")


def redacted(docs: DataFrame, field: Field, mark: str = "[SECRET]") -> DataFrame:
    """``docs``, all columns, with every span of ``text`` replaced by ``mark``."""
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(field)
    return docs.mapInArrow(_redact(model, mark), docs.schema)
