"""URL filters by a bit-parallel wildcard automaton.

Rules are globs over the canonical URL "." + host + path. All globs lie one after another in the bits
of several 64-bit words (Shift-And): a bit is a position in a glob, `take[c]` has the positions that
character c advances to, `loop[c]` the positions that a `*` lets stay. One step simulates all patterns
for all URLs of a batch at once:

    state = (carry-shifted state | first positions) & take[c] | state & loop[c]

`*` stands for any run of characters, and `~` for any run without `/`, which stays within the host.

Host: after the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased; path: then up to `?`, `#` or the end.
A site rule fits its host and all subdomains if the path starts with the rule's; the longest wins (of
equally long ones the one listed first). Where no site rule fits, a URL is blocked if any wildcard glob matches it.

Defined cases: null or a URL without `://` has an empty host and path, no rule and verdict `allow`; repeated rows
each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import sub_batches, tune

#: The site rules of the contract: verdict, host and path. Fixed values.
SITE_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
#: What decides where no site rule fits: words of spam hosts, and file names that are not pages.
WILD_RULES = [".~casino~/*", ".~pills~/*", ".~spam~/*", ".~free-bets~/*", ".~ads-track~/*", "*.exe", "*.zip"]


class Automaton:
    """Globs compiled to multiword Shift-And masks over bytes."""

    def __init__(self, globs: list[str]) -> None:
        tokens: list[list[tuple[int, str]]] = []  # (byte, wildcard before it), and the wildcard at the end
        for glob in globs:
            got, wild = [], ""
            for b in glob.encode("utf-8"):
                if chr(b) in "*~":
                    wild = "*" if "*" in (wild, chr(b)) else "~"
                else:
                    got.append((b, wild))
                    wild = ""
            tokens.append([*got, (-1, wild)])
        n_bits = sum(map(len, tokens))  # for each glob a bit for "nothing read yet", and one for each byte
        self.words = max(1, -(-n_bits // 64))
        self.take = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.begin = np.zeros(self.words, np.uint64)
        self.accept = np.zeros((len(globs), self.words), np.uint64)
        at = 0
        for k, glob in enumerate(tokens):
            self.begin[at // 64] |= np.uint64(1 << at % 64)
            for i, (b, wild) in enumerate(glob):
                here = at + i  # the bit that waits before token i
                if wild:
                    stays = [c for c in range(256) if wild == "*" or c != 47]
                    self.loop[stays, here // 64] |= np.uint64(1 << here % 64)
                if b >= 0:
                    self.take[b, (here + 1) // 64] |= np.uint64(1 << (here + 1) % 64)
            end = at + len(glob) - 1
            self.accept[k, end // 64] |= np.uint64(1 << end % 64)
            at += len(glob)

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """For each URL and glob, whether the glob fits the whole URL."""
        n = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-n, kind="stable")
        longest = int(n.max()) if len(n) else 0
        state = np.tile(self.begin, (len(urls), 1))
        offsets, data = (np.cumsum(n) - n)[order], np.frombuffer(b"".join(urls), np.uint8)
        for step in range(longest):
            m = int(np.searchsorted(-n[order], -step, "left"))  # URLs that have this byte
            c = data[offsets[:m] + step]
            now = state[:m]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:m] = moved & self.take[c] | now & self.loop[c]
        out = np.zeros((len(urls), len(self.accept)), bool)
        out[order] = ((state[:, None, :] & self.accept[None]) != 0).any(axis=2)
        return out


def split_url(url: str | None) -> tuple[str, str]:
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#"]
    stop = min([e for e in ends if e >= 0], default=len(rest))
    host = rest[:stop].encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    path = rest[stop:].split("?", 1)[0].split("#", 1)[0]
    return host, path


def site_glob(rule: str) -> str:
    """A host and its subdomains, and a start of the path: `net/es/` is `~.net/es/*`."""
    return f"~.{rule}*"


def filter_urls(pages: DataFrame, site_rules: list[tuple[str, str]] = SITE_RULES, wild_rules: list[str] = WILD_RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """`id_col`, host, path, rule, verdict of every row; no shuffle."""
    tune(pages.sparkSession)
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    id_type = source.schema["id"].dataType.simpleString()
    by_length = sorted(range(len(site_rules)), key=lambda k: -len(site_rules[k][1]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([*(site_glob(site_rules[k][1]) for k in by_length), *wild_rules])
        for batch in sub_batches(it, "url"):
            parts = [split_url(u) for u in batch.column("url").to_pylist()]
            hits = automaton.matches([f".{h}{p}".encode("utf-8", "surrogatepass") if h or p else b"" for h, p in parts])
            site, wild = hits[:, : len(site_rules)], hits[:, len(site_rules) :].any(axis=1)
            rule = [by_length[int(row.argmax())] if row.any() else None for row in site]
            verdict = [("block" if w else "allow") if k is None else site_rules[k][0] for k, w in zip(rule, wild, strict=True)]
            cols = [pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()), pa.array([None if k is None else site_rules[k][1] for k in rule], pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *cols], ["id", "host", "path", "rule", "verdict"])

    return source.mapInArrow(run, f"id {id_type}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)
