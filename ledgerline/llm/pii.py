"""Personal data in texts: exact patterns, and a skip-chain conditional random field that carries their labels to other mentions.

The patterns find e-mail addresses, IP addresses, cards and phones; their spans always stay. Other mentions of the same data (`name[at]host`, a number
without its country code or with other separators) have no pattern of their own, and alone they look like any number. The field has a
node for each token with a digit, an `@` or an `[at]`; neighbouring tokens share a chain potential, and tokens of one document that are equal or alike
(`alike`) share a skip potential, however far apart: each is linked to the next one like it, so the edges are linear in the tokens.
Tokens within pattern spans are known; loopy message passing gives the marginals of the rest, and a token whose label has THRESHOLD or more becomes a span.

The potentials are fitted by pseudo-likelihood on a bounded sample (SAMPLE, FIT_DOCS, FIT_CHARS): the sampled texts get second mentions of their own data in forms that
the patterns miss, labelled as such, and decoys of the same forms with other digits, labelled as nothing. So the field learns what the links say.

Defined cases: a null or empty text has no spans; repeated rows are judged alike; without a text to learn from there are pattern spans only; an
empty table gives an empty one; columns other than the two named ones are ignored. Time is linear in the text, long runs of digits or letters included.
"""

from __future__ import annotations

import hashlib
import random
import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import sub_batches, tune

#: Kinds in the order of their spans; label 0 is none of them. Fixed values.
KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)
#: Rows whose hash lets them into the sample, expected; texts of them to learn from, at most; code points of such a text, at most.
SAMPLE, FIT_DOCS, FIT_CHARS = 20_000, 2_000, 20_000
#: The least marginal of an added label; rounds of message passing at most, share of the old message kept in each, change at which they end.
THRESHOLD, ROUNDS, DAMPING, SETTLED = 0.8, 40, 0.3, 1e-4
#: Edges whose messages are made together.
BLOCK = 1 << 15
#: Gradient steps, their size and the weight of the squared potentials in the fit.
STEPS, RATE, DECAY = 400, 0.5, 1e-4

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARKED = re.compile(r"[0-9@]|[\[(](?:at|AT)[\])]")
_TOKEN = re.compile(r"\S+")
_AT, _DOT = re.compile(r"[\[(]at[\])]", re.I), re.compile(r"[\[(]\.[\])]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _low(part: str) -> bool:
    """A decimal number of 255 at most."""
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def pattern_spans(text: str) -> list[Span]:
    """What the patterns find, by kind, then start. Each kind by itself: leftmost, not overlapping; a match that fails its test is dropped whole."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:  # an address is the run before an @, which has no @, and a domain behind it
        start = at
        while start > end and not _NOT_LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((EMAIL, start, end))
        else:
            end = max(end, at)
        at = text.find("@", max(end, at + 1))
    if "." in text:
        found += [(IP, *m.span()) for m in _IP.finditer(text) if all(map(_low, m[0].split(".")))]
    found += [(CARD, *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d)]
    if "+" in text:
        found += [(PHONE, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return found


class Token(NamedTuple):
    """A node: its place, and whether it directly follows the node before it."""

    start: int
    end: int
    follows: bool


def tokens(text: str) -> list[Token]:
    """White-space-separated tokens that hold a mark, without outer punctuation."""
    out, before, last = [], -1, -1
    for k, m in enumerate(_TOKEN.finditer(text)):
        word = m[0]
        if _MARKED.search(word):
            core = word.lstrip("!\"#$%&'*,-./:;<=>?@[\\]^_`{|}~")
            start = m.end() - len(core)
            core = core.rstrip("!\"#$%&'*+,-./:;<=>?@[\\^_`{|}~(")
            if _MARKED.search(core):
                out.append(Token(start, start + len(core), last >= 0 and k == before + 1))
                before = last = k
    return out


def alike(word: str) -> tuple[str, str]:
    """Keys of a token: equal words share the first, mentions of the same data the second (empty: none)."""
    word = word.lower()
    plain = _DOT.sub(".", _AT.sub("@", word))
    digits = "".join(c for c in plain if c in "0123456789")
    if "@" in plain:
        return word, "e" + plain
    if len(digits) >= 7:
        return word, "d" + digits[-7:]
    return word, "i" + plain if plain.count(".") == 3 else ""


#: Upper ends of the classes of a token's digits and length.
DIGITS, LENGTHS = (0, 1, 2, 3, 4, 6, 8, 12, 19), (2, 4, 8, 16, 32)
N_FEATURES = len(DIGITS) + 1 + len(LENGTHS) + 1 + 5 + 9


def features(word: str, follows: bool, followed: bool) -> list[int]:
    """The features that a token has, of N_FEATURES."""
    plain = _DOT.sub(".", _AT.sub("@", word))
    digits = "".join(c for c in plain if c in "0123456789")
    at = len(DIGITS) + 1
    has = [next((k for k, most in enumerate(DIGITS) if len(digits) <= most), len(DIGITS)), at + next((k for k, most in enumerate(LENGTHS) if len(word) <= most), len(LENGTHS))]
    at += len(LENGTHS) + 1
    has.append(at + min(plain.count("."), 4))
    parts = plain.split(".")
    tests = [True, any(map(str.isalpha, word)), "@" in plain, "-" in word, "(" in word, len(parts) == 4 and all(p.isascii() and p.isdigit() and _low(p) for p in parts), 13 <= len(digits) <= 19 and luhn(digits), follows, followed]
    return has + [at + 5 + k for k, true in enumerate(tests) if true]


class Graph:
    """The field of some texts: features, known labels (-1: unknown), edges of the kinds chain, equal, similar."""

    def __init__(self, texts: list[str], spans: list[list[Span]]):
        self.nodes: list[tuple[int, Token]] = []
        self.has, self.first, labels = array("h"), array("q"), []
        pairs: list[list[tuple[int, int]]] = [[], [], []]
        for d, (text, known) in enumerate(zip(texts, spans, strict=True)):
            if not text or not _MARKED.search(text):
                continue
            first, seen, found = len(self.nodes), [{}, {}], tokens(text)
            covered = cover(found, known)
            for k, t in enumerate(found):
                node, word = first + k, text[t.start : t.end]
                self.nodes.append((d, t))
                labels.append(covered[k])
                self.first.append(len(self.has))
                self.has.extend(features(word, t.follows, k + 1 < len(found) and found[k + 1].follows))
                if t.follows:
                    pairs[0].append((node - 1, node))
                for kind, key in enumerate(alike(word)):
                    before = seen[kind].get(key) if key else None
                    if before is not None and not (kind and alike(text[found[before - first].start : found[before - first].end])[0] == word.lower()):
                        pairs[1 + kind].append((before, node))
                    if key:
                        seen[kind][key] = node
        self.label = np.array(labels, np.int64)
        self.edges = [np.array(p, np.int64).reshape(-1, 2) for p in pairs]

    def scores(self, unary: np.ndarray) -> np.ndarray:
        """For each node the sum of its features' rows of `unary`."""
        return np.add.reduceat(unary[np.frombuffer(self.has, np.int16)], np.frombuffer(self.first, np.int64), axis=0)


def cover(found: list[Token], spans: list[Span]) -> list[int]:
    """For each token the label (kind + 1) of the first kind that has a span over it, else -1."""
    out = [-1] * len(found)
    for kind in reversed(range(len(KINDS))):
        k = 0
        for _, start, end in sorted(s for s in spans if s[0] == kind):
            while k < len(found) and found[k].end <= start:
                k += 1
            j = k
            while j < len(found) and found[j].start < end:
                out[j] = kind + 1
                j += 1
    return out


class Field(NamedTuple):
    """Potentials: features by label, and label by label for each kind of edge (those of skip edges are symmetric)."""

    unary: np.ndarray
    edge: list[np.ndarray]


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def marginals(field: Field, g: Graph, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals of every node by message passing along all edges at once; exact on trees, given as many rounds as they are long."""
    own = g.scores(field.unary)
    known = g.label >= 0
    own[known] = -1e3
    own[known, g.label[known]] = 0
    source = np.concatenate([e[:, k] for k in (0, 1) for e in g.edges])
    target = np.concatenate([e[:, k] for k in (1, 0) for e in g.edges])
    tables = np.stack([w if k else w.T for k in (1, 0) for w in field.edge])  # by source label, target label
    table = np.repeat(np.arange(len(tables)), [len(e) for _ in (1, 0) for e in g.edges])
    m, half = np.zeros((len(source), own.shape[1])), len(source) // 2
    for _ in range(rounds):
        belief = own.copy()
        np.add.at(belief, target, m)
        rest = belief[source] - np.r_[m[half:], m[:half]]  # without what the target said itself
        new = np.empty_like(m)
        for a in range(0, len(m), BLOCK):
            x = rest[a : a + BLOCK, :, None] + tables[table[a : a + BLOCK]]
            top = x.max(1, keepdims=True)
            new[a : a + BLOCK] = (top + np.log(np.exp(x - top).sum(1, keepdims=True)))[:, 0]
        new = DAMPING * m + (1 - DAMPING) * (new - new.max(1, keepdims=True))
        moved, m = np.abs(new - m).max(initial=0), new
        if moved < SETTLED:
            break
    belief = own.copy()
    np.add.at(belief, target, m)
    return softmax(belief)


def fit(graph: Graph, truth: np.ndarray) -> Field:
    """Potentials by pseudo-likelihood: each unknown node given the true labels of all its neighbours."""
    n, free = len(KINDS) + 1, graph.label < 0
    x, hot = graph.scores(np.eye(N_FEATURES)), np.eye(n)[truth]
    near = []  # sums of neighbours' labels: before and behind in the chain, equal, similar
    for kind, e in enumerate(graph.edges):
        ways = [np.zeros((len(truth), n)) for _ in range(2)]
        np.add.at(ways[0], e[:, 1], hot[e[:, 0]])
        np.add.at(ways[1], e[:, 0], hot[e[:, 1]])
        near.append((ways[0][free], ways[1][free]))
    x, hot = x[free], hot[free]
    unary, edge = np.zeros((x.shape[1], n)), [np.zeros((n, n)) for _ in near]
    speed = [np.zeros_like(w) for w in [unary, *edge]]
    weight = np.where(hot[:, 0] > 0, 1.0, max(1.0, (hot[:, 0] > 0).sum() / max(1, (hot[:, 0] == 0).sum())))[:, None]  # both sides of the question weigh alike
    for _ in range(STEPS):
        logits = x @ unary + sum(a @ w + b @ w.T for (a, b), w in zip(near, edge, strict=True))
        off = (softmax(logits) - hot) * weight / weight.sum()
        slopes = [x.T @ off + DECAY * unary]
        for kind, ((a, b), w) in enumerate(zip(near, edge, strict=True)):
            slope = a.T @ off + (b.T @ off).T
            slopes.append((slope if kind == 0 else (slope + slope.T) / 2) + DECAY * w)
        for k, (w, slope) in enumerate(zip([unary, *edge], slopes, strict=True)):
            speed[k] += slope**2
            w -= RATE * slope / (np.sqrt(speed[k]) + 1e-8)
    return Field(unary, edge)


def second_mention(kind: int, value: str, rng: random.Random) -> tuple[str, str]:
    """A form of a found value that the patterns miss, and a decoy: the same form of something else."""
    digits = [c for c in value if c.isdigit()]
    if kind == EMAIL:
        name, host = value.split("@")
        at = rng.choice(["[at]", "(at)"])
        return name + at + host, re.sub("[a-z0-9]", lambda m: chr(ord(m[0]) ^ 1) if m[0] not in "z`" else "y", name) + at + host
    if kind == IP:
        form = value.replace(".", rng.choice(["[.]", "(.)"]))
    elif kind == CARD:
        form = rng.choice([".", "/"]).join("".join(digits[k : k + 4]) for k in range(0, len(digits), 4))
    else:
        fours = ["".join(digits[max(0, k - 4) : k]) for k in range(len(digits), 0, -4)]
        form = rng.choice([value[1:].split(" ", 1)[-1], ".".join(fours[::-1]), "".join(digits)])
    return form, re.sub("[0-9]", lambda m: str((int(m[0]) + rng.randint(1, 9)) % 10), form)


def practice(texts: list[str], seed: int = 0) -> tuple[list[str], list[list[Span]], list[list[Span]]]:
    """Texts with second mentions and decoys in them, what the patterns find there, and what they should hold."""
    out, rng = ([], [], []), random.Random(seed)
    for text in texts:
        spans, at, pieces, truth = pattern_spans(text), 0, [], []
        gaps = [m.start() for m in re.finditer(r"\s", text)] or [len(text)]
        added = []
        for kind, start, end in spans:
            mention, decoy = second_mention(kind, text[start:end], rng)
            added += [(rng.choice(gaps), kind, mention), (rng.choice(gaps), -1, decoy)]
        size = 0
        for gap, kind, form in sorted(added):
            if any(s < gap < e for _, s, e in spans):
                continue
            pieces += [text[at:gap], " of ", form, " by"]
            size += len(pieces[-4]) + 4
            if kind >= 0:
                truth.append((kind, size, size + len(form)))
            size, at = size + len(form) + 3, gap
        whole = "".join([*pieces, text[at:]])
        known = pattern_spans(whole)
        for column, value in zip(out, (whole, known, known + truth), strict=True):
            column.append(value)
    return out


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field | None:
    """The field fitted on a bounded sample of documents, by the hash of their ids; None if no pattern span is in it."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    share = min(1.0, SAMPLE / max(1, docs.count()))
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 31)) < int(share * (1 << 31))).where(F.col("text").rlike(r"[0-9@]") & (F.length("text") <= FIT_CHARS))
    texts = chosen.groupBy("id").agg(F.min("text").alias("text")).orderBy(F.xxhash64("id"), "id").limit(FIT_DOCS)
    return fit_texts([r["text"] for r in texts.collect()])


def fit_texts(texts: list[str]) -> Field | None:
    whole, known, truth = practice(texts)
    if not any(known):
        return None
    graph = Graph(whole, known)
    return fit(graph, np.maximum(Graph(whole, truth).label, 0))


def added_spans(field: Field, texts: list[str], spans: list[list[Span]]) -> list[list[Span]]:
    """The spans that the field adds to each text's known ones: cards and phones join neighbouring tokens."""
    out: list[list[Span]] = [[] for _ in texts]
    graph = Graph(texts, spans)
    if not graph.nodes:
        return out
    sure = marginals(field, graph)
    label = np.where((sure.max(1) >= THRESHOLD) & (graph.label < 0), sure.argmax(1), 0)
    before = 0
    for (d, t), x in zip(graph.nodes, label.tolist(), strict=True):
        if x:
            joined = t.follows and x == before and x - 1 in (CARD, PHONE)
            start = out[d].pop()[1] if joined else t.start
            out[d].append((x - 1, start, t.end))
        before = x
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_pii(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, n_email, n_ip, n_card, n_phone and base_sha256 of the pattern spans, spans (all, kind:start:end), n_added; no shuffle."""
    tune(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = [f"n_{kind}" for kind in KINDS]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [pattern_spans(t) for t in texts]
            more = added_spans(field, texts, base) if field else [[] for _ in texts]
            numbers = [pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64()) for k in range(len(KINDS))]
            digests = pa.array([hashlib.sha256(listed(spans).encode()).hexdigest() for spans in base])
            yield pa.RecordBatch.from_arrays([batch.column("id"), *numbers, digests, pa.array([listed(a + b) for a, b in zip(base, more, strict=True)]), pa.array(list(map(len, more)), pa.int64())], ["id", *counts, "base_sha256", "spans", "n_added"])

    kinds = ", ".join(f"{c} bigint" for c in counts)
    found = source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, {kinds}, base_sha256 string, spans string, n_added bigint")
    return found.select(F.col("id").alias(id_col), *counts, "base_sha256", "spans", "n_added")
