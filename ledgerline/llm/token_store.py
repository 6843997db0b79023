"""Token ids in binary shards with a minimal perfect hash index.

File format: a Parquet folder `blocks`, one row a block of about BLOCK_IDS ids. Blocks of a shard hold
ascending keys, shards are ranges of keys (shard 0 has the smallest), and a block has

    shard, block      its place
    first, last       its smallest and largest key (null in a block of rows with null keys)
    before            ids in earlier blocks of the shard
    n_ids             ids in the block
    payload           all ids of the block, little-endian unsigned 32-bit, row after row
    lengths, keys     ids of each row (unsigned 32-bit) and key of each row (signed 64-bit)
    levels            the minimal perfect hash: bit arrays, one a level
    fingerprints, rows, repeats   for each hash slot: 32 other bits of the key's hash, its first row, its number of rows

A key's shard and block follow from the ranges; within the block its slot is the rank of the first
level whose bit for the key is set, which takes constant expected time; the fingerprint tells keys that are
not there, but for one in 2^32. Spark's writer commits the files, so a task that runs anew replaces its own output.

Defined cases: null or empty texts have only the end id; rows with a null key come first, in blocks without an
index; rows with one key lie together and are all found under it (ordered by a hash of their text); an
empty table gives an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.bpe import encoder
from ledgerline.llm.common import sub_batches, tune
from ledgerline.llm.shingles import mixed

BLOCK_IDS = 1 << 20
#: Bits of a level for each key that is left.
GAMMA = 2
SCHEMA = "shard int, block int, first bigint, last bigint, before bigint, n_ids bigint, payload binary, lengths binary, keys binary, levels array<binary>, fingerprints binary, rows binary, repeats binary"


def hashed(keys: np.ndarray, level: int) -> np.ndarray:
    return mixed(keys.astype(np.int64).view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def build(keys: np.ndarray) -> list[np.ndarray]:
    """Levels of a minimal perfect hash of distinct keys: a bit is set where one key alone falls; others go on to the next level."""
    levels, left = [], keys
    while len(left):
        size = np.uint64(max(8, -(-len(left) * GAMMA // 8) * 8))
        at = (hashed(left, len(levels)) % size).astype(np.int64)
        n = np.bincount(at, minlength=int(size))
        levels.append(n == 1)
        left = left[n[at] != 1]
    return levels


def slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The slot of each key; -1 for some keys that are not in the index."""
    out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for k, bits in enumerate(levels):
        at = (hashed(keys[left], k) % np.uint64(len(bits))).astype(np.int64)
        rank = np.cumsum(bits)
        hit = bits[at]
        out[left[hit]] = base + rank[at[hit]] - 1
        left, base = left[~hit], base + int(rank[-1])
    return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (hashed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


def lookup(block: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and number of rows of each key in a block; 0 rows for keys that are not there."""
    levels = [np.unpackbits(np.frombuffer(b, np.uint8)).astype(bool) for b in block["levels"]]
    at = slots(levels, keys)
    marks, rows, repeats = (np.frombuffer(block[c], "<u4") for c in ("fingerprints", "rows", "repeats"))
    if not len(marks):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    ok = (at >= 0) & (marks[at] == fingerprint(keys))
    return np.where(ok, rows[at], 0).astype(np.int64), np.where(ok, repeats[at], 0).astype(np.int64)


def pack(shard: int, block: int, before: int, keys: list[int | None], ids: list[np.ndarray]) -> dict:
    lengths = np.array([len(x) for x in ids], "<u4")
    out = {"shard": shard, "block": block, "before": before, "n_ids": int(lengths.sum(dtype=np.int64)), "payload": np.concatenate(ids).astype("<u4").tobytes(), "lengths": lengths.tobytes()}
    if keys[0] is None:
        return out | {"first": None, "last": None, "keys": None, "levels": [], "fingerprints": b"", "rows": b"", "repeats": b""}
    own, first, repeats = np.unique(np.array(keys, np.int64), return_index=True, return_counts=True)
    levels = build(own)
    at = slots(levels, own)
    table = np.zeros((3, len(own)), "<u4")
    table[:, at] = fingerprint(own), first, repeats
    return out | {"first": int(own[0]), "last": int(own[-1]), "keys": np.array(keys, "<i8").tobytes(), "levels": [np.packbits(x).tobytes() for x in levels], "fingerprints": table[0].tobytes(), "rows": table[1].tobytes(), "repeats": table[2].tobytes()}


def write_store(docs: DataFrame, path: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all documents and write them to `folder` in ascending key order. The texts are shuffled, once; ids never are."""
    spark = docs.sparkSession
    tune(spark)
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = source.repartitionByRange(shards, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, shard = encoder(path), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        block = before = held = 0
        keys: list[int | None] = []
        rows: list[np.ndarray] = []

        def full() -> pa.RecordBatch:
            row = pack(shard, block, before, keys, rows)
            return pa.RecordBatch.from_pylist([row], arrow_schema())

        for batch in sub_batches(it, keep=("bpe", path)):
            ids, counts = e.encode(batch.column("text").to_pylist())
            cut = np.r_[0, np.cumsum(counts)]
            for key, a, b in zip(batch.column("id").to_pylist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                # a run of one key stays in one block; null keys have blocks of their own
                if keys and (held >= BLOCK_IDS and key != keys[-1] or keys[-1] is None and (key is not None or held >= BLOCK_IDS)):
                    yield full()
                    block, before, held = block + 1, before + held, 0
                    keys, rows = [], []
                keys.append(key)
                rows.append(np.append(ids[a:b], end))
                held += b - a + 1
        if keys:
            yield full()

    ordered.mapInArrow(run, SCHEMA).write.parquet(f"{folder}/blocks")


def arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(n, kinds[k]) for n, k in (x.split(" ") for x in SCHEMA.split(", "))])


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, each found through the index of its block."""
    blocks = spark.read.schema(SCHEMA).parquet(f"{folder}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # one row a shard
    begin: dict[int, int] = {}
    at = 0
    for r in totals:
        begin[r["shard"]] = at
        at += r["n"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it, "payload"):
            for b in batch.to_pylist():
                ids, n = np.frombuffer(b["payload"], "<u4"), np.frombuffer(b["lengths"], "<u4").astype(np.int64)
                cut = np.r_[0, np.cumsum(n)]
                if b["keys"] is None:
                    keys, row = [None] * len(n), np.arange(len(n))
                else:
                    own = np.frombuffer(b["keys"], "<i8")
                    distinct = np.unique(own)
                    first, repeats = lookup(b, distinct)
                    keys = np.repeat(distinct, repeats)
                    row = np.repeat(first - (np.cumsum(repeats) - repeats), repeats) + np.arange(len(keys))
                crc = [zlib.crc32(ids[cut[r] : cut[r + 1]]) for r in row.tolist()]
                start = begin[b["shard"]] + b["before"] + cut[row]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(start, pa.int64()), pa.array(n[row], pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def get(spark: SparkSession, folder: str, key: int) -> list[np.ndarray]:
    """The ids of all rows with one key; only blocks whose range holds the key are read."""
    blocks = spark.read.schema(SCHEMA).parquet(f"{folder}/blocks").where((F.col("first") <= key) & (F.col("last") >= key))
    out = []
    for b in blocks.collect():  # one block, as keys are in ascending ranges
        first, repeats = lookup(b.asDict(), np.array([key], np.int64))
        ids, cut = np.frombuffer(b["payload"], "<u4"), np.r_[0, np.cumsum(np.frombuffer(b["lengths"], "<u4").astype(np.int64))]
        out += [ids[cut[r] : cut[r + 1]] for r in range(int(first[0]), int(first[0] + repeats[0]))]
    return out
