"""Token counts by a compiled finite-state tokenizer.

A score-ranked BPE (`.model` file) is compiled into a deterministic transducer. The fact behind it:
if the tokens of a text are t1 ... tn, those of its prefix that ends with tk are t1 ... tk, and a
token u may be followed by t exactly if the two-token text ut is cut into u and t. So the last
token at each position, and the count up to it, follow from the last tokens at the positions from
which some piece is still open. That finite list is a state:

    (trie node of the open piece, last token before it, count there minus count here), ...

A piece that can no longer end is left out, and tokens before an open piece that allow the same of
its few remaining endings are one, which keeps the states few.

Each transition on a character leads to one state and is annotated with the tokens emitted: the
change of the count. States are made as texts demand them and kept in a table.

Texts are cut into chunks at synchronising places, before a white-space run and around line feeds,
where every state leads to the start state. A chunk's state map is then the constant map (any state
-> start, + its count); composing such maps is adding their counts, so one prefix scan (a cumulative
sum) over all chunks of a batch gives each text's total. Equal chunks have equal maps, which are kept.

Defined cases: a null or empty text has no tokens; characters outside the vocabulary count one
token for each UTF-8 byte (byte fallback); control strings inside texts are ordinary text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb

from ledgerline.llm.common import held, sub_batches, tune

#: The stand-in for a space in pieces. Fixed value.
MARK = "▁"
REMEMBERED = 500_000
#: States beyond which the table is dropped and made anew as texts demand it.
MOST_STATES = 200_000
#: Open pieces with at most so many endings are put together by what they allow.
FEW_ENDINGS = 12
CHUNKS = re.compile(r"\n[^ \n]*| +[^ \n]*")


class Fresh(dict):
    """Gives each new key the next code and notes it in `fresh`."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        code = self[key] = len(self)
        self.fresh.append(key)
        return code


class Transducer:
    """A `.model` file of kind BPE as a deterministic transducer with token counts on its transitions."""

    def __init__(self, path: str) -> None:
        m = model_pb.ModelProto()
        m.ParseFromString(open(path, "rb").read())
        plain = [p for p in m.pieces if p.type == model_pb.ModelProto.SentencePiece.NORMAL]
        spec = m.normalizer_spec
        odd = [p.piece for p in plain if MARK in p.piece[1:] and p.piece.strip(MARK) or "\n" in p.piece or " " in p.piece]
        if m.trainer_spec.model_type != model_pb.TrainerSpec.BPE or not m.trainer_spec.byte_fallback or odd:
            raise ValueError("not a BPE model with byte fallback whose pieces stay within white-space runs and words")
        if spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only the identity normaliser with a prefixed space is compiled")
        if len(plain) + 3 + 256 < len(m.pieces):
            raise ValueError("user-defined or unused pieces are not compiled")
        self.score = {p.piece: p.score for p in plain}
        self.trie: list[dict[str, int]] = [{}]
        self.piece_at: list[str | None] = [None]
        for p in self.score:
            node = 0
            for c in p:
                if c not in self.trie[node]:
                    self.trie[node][c] = len(self.trie)
                    self.trie.append({})
                    self.piece_at.append(None)
                node = self.trie[node][c]
            if self.cut(p) == [p]:  # other pieces never come out
                self.piece_at[node] = p
        self.endings: list[tuple[str, ...] | None] = [None] * len(self.trie)
        for node in range(len(self.trie) - 1, -1, -1):  # children have higher numbers
            got = [x for to in self.trie[node].values() for x in (*((self.piece_at[to],) if self.piece_at[to] else ()), *(self.endings[to] or ()))]
            full = any(self.endings[to] is None for to in self.trie[node].values())
            self.endings[node] = None if full or len(got) > FEW_ENDINGS else tuple(got)
        self.clear()

    def clear(self) -> None:
        """Drop all states but the start state."""
        self.follows: dict[tuple[str, str], bool] = {}
        self.made: dict[str, tuple[list[float], list[str], list[str]]] = {}
        self.same: dict[tuple, str | None] = {}
        self.kind: dict[tuple, str] = {}
        self.state: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.table: list[dict[str, tuple[int, int]]] = []
        self.start = self.number(((0, "", 0),))

    def cut(self, text: str) -> list[str]:
        """The merges by definition: the best-scored adjacent pair, leftmost first. For short texts, while compiling."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.score[x], i) for i in range(len(parts) - 1) if (x := parts[i] + parts[i + 1]) in self.score]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def number(self, state: tuple) -> int:
        if state not in self.state:
            self.state[state] = len(self.states)
            self.states.append(state)
            self.table.append({})
        return self.state[state]

    def history(self, piece: str) -> tuple[list[float], list[str], list[str]]:
        """A piece's own merges: their ranks in order, then its first and its last symbol before each and at the end."""
        if piece not in self.made:
            parts, ranks, first, last = list(piece), [], [piece[0]], [piece[-1]]
            while len(parts) > 1:
                rank, i = min((-self.score[x], i) for i in range(len(parts) - 1) if (x := parts[i] + parts[i + 1]) in self.score)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                ranks.append(rank)
                first.append(parts[0])
                last.append(parts[-1])
            self.made[piece] = ([*ranks, float("inf")], first, last)
        return self.made[piece]

    def may_follow(self, before: str, piece: str) -> bool:
        """Whether the text of both is cut into just these two: no merge across the border is ever the best."""
        if not before:
            return True
        key = (before, piece)
        if key in self.follows:
            return self.follows[key]
        (left, _, last), (right, first, _) = self.history(before), self.history(piece)
        score, i, j, never = self.score, 0, 0, float("inf")
        while True:
            x, y = left[i], right[j]
            across = score.get(last[i] + first[j])
            if across is not None and -across < x and -across <= y:
                out = False
                break
            if x == never and y == never:
                out = True
                break
            if x <= y:
                i += 1
            else:
                j += 1
        self.follows[key] = out
        return out

    def as_one(self, node: int, before: str) -> str | None:
        """The token that stands for `before` at an open node; None if nothing can end there any more."""
        key = (node, before)
        if key not in self.same:
            allowed = tuple(self.may_follow(before, x) for x in self.endings[node])
            self.same[key] = self.kind.setdefault((node, allowed), before) if any(allowed) else None
        return self.same[key]

    def step(self, number: int, c: str) -> tuple[int, int]:
        """Compile one transition: the next state, and the tokens emitted."""
        open_now, last, emitted = [], None, 0
        for node, before, behind in self.states[number]:
            to = self.trie[node].get(c)
            if to is None:
                continue
            if self.endings[to] is None:
                open_now.append((to, before, behind))
            elif self.endings[to] and (stands := self.as_one(to, before)) is not None:
                open_now.append((to, stands, behind))
            piece = self.piece_at[to]
            if piece is not None and last is None and self.may_follow(before, piece):
                last, emitted = piece, behind + 1
        if last is None:  # no piece holds this character here: byte fallback, or a lone character
            last, emitted = c, 1 if c in self.score else len(c.encode("utf-8", "surrogatepass"))
        state = tuple((n, b, k - emitted) for n, b, k in open_now) + ((0, last, 0),)
        out = self.table[number][c] = (self.number(state), emitted)
        return out

    def count(self, chunk: str) -> int:
        """Tokens emitted along a chunk, from the start state."""
        at, total, table = self.start, 0, self.table
        for c in chunk:
            to = table[at].get(c) or self.step(at, c)
            at, n = to
            total += n
        return total


class Counter:
    """Token counts of texts, with a bounded memory of chunk maps."""

    def __init__(self, path: str) -> None:
        self.fst = Transducer(path)
        self.forget()

    def forget(self) -> None:
        self.code = Fresh()
        self.chars = 0
        self.counts = np.zeros(0, np.int64)

    def chunks(self, text: str) -> list[str]:
        """Chunk keys: what follows a space, or a line feed and what follows it; a key with leading spaces has so many more."""
        if MARK in text:
            text = text.replace(MARK, " ")
        if text[0] == " " or "  " in text:
            return [m if m[0] == "\n" else m[1:] for m in CHUNKS.findall(" " + text)]
        return text.replace("\n", " \n").split(" ")

    def of_key(self, key: str) -> int:
        if key[:1] == "\n":
            return 1 + self.fst.count(key[1:])
        return self.fst.count(MARK + key.replace(" ", MARK))

    def count(self, texts: list[str | None]) -> np.ndarray:
        if len(self.code) > REMEMBERED or self.chars > 32 * REMEMBERED:
            self.forget()
        if len(self.fst.states) > MOST_STATES:
            self.fst.clear()
        keys: list[str] = []
        n_keys = []
        for text in texts:
            got = self.chunks(text) if text else []
            n_keys.append(len(got))
            keys += got
        code = np.fromiter(map(self.code.__getitem__, keys), np.int64, len(keys))
        fresh, self.code.fresh = self.code.fresh, []
        self.chars += sum(map(len, fresh))
        self.counts = np.concatenate([self.counts, np.array([self.of_key(k) for k in fresh], np.int64)])
        scan = np.r_[0, np.cumsum(self.counts[code])]
        return np.diff(scan[np.r_[0, np.cumsum(n_keys)]])


def counter(path: str) -> Counter:
    """The worker's counter for a model file."""
    return held(("token counts", path), lambda: Counter(path))


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, n_bytes, n_tokens, over_limit of every text; no shuffle. Null texts have 0 bytes and tokens."""
    tune(docs.sparkSession)
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in sub_batches(it, keep=("token counts", path)):
            texts = batch.column("text").to_pylist()
            sizes = [0 if (b := x.as_buffer()) is None else b.size for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(c.count(texts), pa.int64())], ["id", "n_bytes", "n_tokens"])

    counted = source.mapInArrow(run, f"id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
