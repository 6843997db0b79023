"""N-gram Jaccard join: exact similarity links between documents on their word shingles, and their groups.

Two documents link when 100 * |A n B| >= 80 * |A u B| on their sets of five-word shingles.

1. Posting lists. By the prefix principle, sets that link share a shingle among the first
   n - ceil(0.8 n) + 1 of each under any order common to all. The order puts shingles that many
   documents hold last, then those of common words (both counted over all documents, in blocks; the bounded tables of
   the most frequent ones only change the order, never the result). So postings of wide-spread passages stay out, and so
   do those of phrases that unrelated documents share by chance, whose number grows with the square of the input.
2. Documents in lists of two or more are compared with one document that has the shingle: a star for
   each list, not its pairs. The verified stars give first groups; long lists that hold several groups get further turns
   with other centres, as long as these link a good part of their pairs, so that a large group of near copies is one group before pairs are looked at.
3. Lists that still hold several groups are joined with themselves across groups, within size-banded
   tiles (equal or adjacent bands of ratio 1 / 0.8; sets that link lie no further apart) and as far as the place
   of the shingle in both prefixes leaves room for the overlap, were it the first they have in common. Stars stand
   for their members there, as far as the triangle inequality of Jaccard distance proves that those can't link. So
   every pair that may link is in one group already, ruled out or compared: no link between groups is lost.
4. Pairs are verified first by hashed bitmap signatures: with parity bits, the bit count of the
   exclusive or is at most |A x B|, so it bounds the overlap from above. Survivors are verified by
   exact intersection of the sorted arrays; equal set digests need none.

Defined cases: null or empty texts have n_shingles 0 and link with nothing; fewer than five words are
one shingle; repeated rows each give a row; rows with one doc_id are one node; rows with a null doc_id
link with nothing and have a null component_id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import discard, parted, settle, shared_folder, sub_batches, tune, without
from ledgerline.llm.components import components
from ledgerline.llm.shingles import grouped, sets_of, weighed_rows, word_hashes

#: Percent of the union that the intersection must have.
PERCENT = 80
#: The same as a distance, and what rounding may change of one.
FAR, SLACK = 1 - PERCENT / 100, 1e-9
LEAST_BITS = 512
#: Frequent shingles are counted in blocks of so many, and the most frequent ones kept for the order.
BLOCK, FREQUENT, WORDS, AT_LEAST = 1_000_000, 400_000, 100_000, 8
#: Lists that get further star turns, and how many turns at most; what is left is compared in full.
LONG_LIST, STAR_TURNS = 8, 4
#: A turn that links fewer than one in so many of its pairs is the last: what is left are different groups, which more turns would leave apart.
YIELD = 20
#: Ids, and ids with their groups, that are broadcast at most; of more ids a table of bits is, more groups are joined.
MOST_IDS, MOST_ROOTS = 2_000_000, 500_000


def prefix_length(n: int) -> int:
    return n - (n * PERCENT + 99) // 100 + 1


def largest_partner(n: int) -> np.ndarray:
    """For each place in the prefix of a set of n: the largest set that may link with it if their first common shingle is there.

    The overlap is at most what is left from there on, and has to be at least PERCENT / (100 + PERCENT) of both sizes.
    """
    return (100 + PERCENT) * (n - np.arange(prefix_length(n))) // PERCENT - n


def signature(s: np.ndarray) -> bytes:
    """Parity bits of the elements: as many as the next power of two of the set's size, LEAST_BITS at least."""
    bits = max(LEAST_BITS, 1 << max(len(s) - 1, 0).bit_length())
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def differing_bits(x: bytes, y: bytes) -> int:
    """Bits in which two signatures differ, the longer one folded (its halves' exclusive or) to the length of the other."""
    if len(x) > len(y):
        x, y = y, x
    p, q, n = int.from_bytes(x, "little"), int.from_bytes(y, "little"), 8 * len(y)
    while n > 8 * len(x):
        n //= 2
        q = q & ((1 << n) - 1) ^ q >> n
    return (p ^ q).bit_count()


def frequent(source: DataFrame) -> tuple[np.ndarray, ...]:
    """The most frequent shingles with their counts and a document that has each, and words with their weights (the counts' bit lengths), each sorted by hash; bounded tables."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {"shingle": [], "owner": [], "word": []}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            token, owner = np.concatenate(held["shingle"]), np.concatenate(held["owner"])
            order = np.argsort(token)
            begin = np.flatnonzero(np.r_[True, np.diff(token[order]) != 0])
            n, first = np.diff(np.r_[begin, len(token)]), np.minimum.reduceat(owner[order], begin)
            yield table("shingle", token[order][begin], n, first, 2)
            token, n = np.unique(np.concatenate(held["word"]), return_counts=True)
            yield table("word", token, n, np.zeros(len(n), np.int64), AT_LEAST)

        def table(kind: str, token: np.ndarray, n: np.ndarray, first: np.ndarray, least: int) -> pa.RecordBatch:
            token, n, first = token[n >= least], n[n >= least], first[n >= least]
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(n), pa.string()), pa.array(token.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(first)], ["kind", "token", "n", "first"])

        for batch in sub_batches(it):
            texts = batch.column("text").to_pylist()
            for i, s in zip(batch.column("id").to_pylist(), sets_of(texts), strict=True):
                held["shingle"].append(s)
                held["owner"].append(np.full(len(s), i, np.int64))
                size += len(s)
            held["word"] += [word_hashes(g)[0] for g in grouped(texts)]
            if size >= BLOCK:
                yield from counted()
                held, size = {"shingle": [], "owner": [], "word": []}, 0
        if size:
            yield from counted()

    counts = source.where("id is not null").mapInArrow(run, "kind string, token bigint, n bigint, first bigint")
    sums = counts.groupBy("kind", "token").agg(F.sum("n").alias("n"), F.min("first").alias("first")).where(F.col("n") >= AT_LEAST)
    out: list[np.ndarray] = []
    for kind, most in (("shingle", FREQUENT), ("word", WORDS)):
        top = sums.where(F.col("kind") == kind).select("token", "n", "first").orderBy(F.desc("n"), "token").limit(most).toArrow()
        token, n, first = top["token"].to_numpy().view(np.uint64), top["n"].to_numpy(), top["first"].to_numpy()
        order = np.argsort(token)
        out += [token[order], n[order], first[order]] if kind == "shingle" else [token[order], np.ceil(np.log2(n[order] + 1)).astype(np.int64)]
    return tuple(out)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(sets, links): sets has id, n and rows of every document; links has (node, root) for documents not smallest in their group."""
    spark = docs.sparkSession
    tune(spark)
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    often = spark.sparkContext.broadcast(frequent(source))

    def postings(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, count, owner, words, weights = often.value
        for batch in sub_batches(it):
            ids, out_id, out_token, out_n, out_top, out_owner, out_hot = batch.column("id").to_numpy(zero_copy_only=False), [], [], [], [], [], []
            for i, (row, weight) in zip(ids, weighed_rows(batch.column("text").to_pylist(), words, weights), strict=True):
                if len(row):
                    s, first = np.unique(row, return_index=True)
                    k, last = prefix_length(len(s)), weight[first]
                    hot, own = np.zeros(len(s), bool), np.zeros(len(s), np.int64)
                    if len(token):
                        at = np.minimum(np.searchsorted(token, s), len(token) - 1)
                        hot = token[at] == s
                        own, last = owner[at], last + (np.where(hot, count[at], 0) << 16)
                    chosen = np.argsort(last, kind="stable")[:k]
                    out_token.append(s[chosen])
                    out_hot.append(hot[chosen])
                    out_owner.append(own[chosen])
                    out_id.append(np.full(k, i))
                    out_n.append(np.full(k, len(s), np.int32))
                    out_top.append(largest_partner(len(s)).astype(np.int32))
            if out_id:
                cold = ~np.concatenate(out_hot)
                cols = [pa.array(np.concatenate(out_token).view(np.int64)), pa.array(np.concatenate(out_id).astype(np.int64)), pa.array(np.concatenate(out_n)), pa.array(np.concatenate(out_top)), pa.array(np.concatenate(out_owner), mask=cold)]
                yield pa.RecordBatch.from_arrays(cols, ["token", "id", "n", "top", "owner"])

    def signatures(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it):
            sets = sets_of(batch.column("text").to_pylist())
            cols = [pa.array([len(s) for s in sets], pa.int64()), pa.array([signature(s) for s in sets], pa.binary()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *cols], ["id", "n", "bits", "digest"])

    work = shared_folder(spark)
    sets = settle(source.mapInArrow(signatures, "id bigint, n bigint, bits binary, digest binary"), "sets")
    apart = sets if sets.groupBy("id").count().where("count > 1 and id is not null").isEmpty() else sets.dropDuplicates(["id", "digest"])  # equal rows are compared once
    posted = source.where("id is not null").mapInArrow(postings, "token bigint, id bigint, n int, top int, owner bigint")
    # one exchange deals out all postings: lists of frequent shingles by document, as their centre is known, the others by shingle
    dealt = Window.partitionBy("token", F.when(F.col("owner").isNotNull(), F.col("id")))
    lists = posted.withColumns({"in_list": F.count("*").over(dealt), "least": F.min("id").over(dealt)}).where("owner is not null or in_list > 1")
    kept = settle(lists.select("token", "id", "n", "top", F.coalesce("owner", "least").alias("centre")), "postings", work)

    stars = kept.where("id <> centre").select(F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b")).distinct()
    links, late = [verified(stars, apart, source)], []
    groups = components(links[0])
    tiled = several(kept.select("token", "id", "n", "top"), groups)
    discard(spark, work)
    for turn in range(STAR_TURNS):
        # long lists first once more by stars, with other centres: one document of each group in the list against the centre
        long = tiled.join(tiled.groupBy("token").agg(F.count("*").alias("c")).where(F.col("c") > LONG_LIST).select("token"), "token")
        mark = lambda c: F.xxhash64(c, F.lit(turn))  # noqa: B023, E731
        one = long.groupBy("token", "root").agg(F.min_by("id", mark("id")).alias("id"))
        centre = one.groupBy("token").agg(F.min_by("id", mark("id")).alias("centre"))
        stars = settle(one.join(centre, "token").where("id <> centre").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct(), "stars")
        more = verified(stars, apart, source)
        if found := more.count():
            links.append(more)
        if YIELD * found <= stars.count():
            late += [more] if found else []  # too few to group and list everything anew for them
            break
        groups = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more.select("a", "b")))
        tiled = several(tiled.select("token", "id", "n", "top"), groups)
    late.append(across(tiled, reduce(DataFrame.union, links), apart, source))
    return sets.select("id", "n"), components(reduce(DataFrame.union, [x.select("a", "b") for x in late], groups.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def across(tiled: DataFrame, links: DataFrame, sets: DataFrame, source: DataFrame) -> DataFrame:
    """All links between groups of one list that may join them.

    Jaccard distance is a metric. Each document has a centre, the best-linked one of the documents linked with it and
    itself, at a known distance. Where the centres of two documents lie further apart than FAR and both documents'
    distances from them, the documents can't link; so the centres are compared first, and only the members that are
    far enough out of theirs are compared with each other.
    """
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("centre"), "d").union(links.select("b", "a", "d"))
    degree = ends.groupBy("id").agg(F.count("*").alias("degree"))
    choice = ends.join(degree.withColumnRenamed("id", "centre"), "centre").select("id", "centre", "d", "degree")
    choice = choice.union(degree.select("id", F.col("id").alias("centre"), F.lit(0.0).alias("d"), "degree"))
    best = choice.groupBy("id").agg(F.max_by(F.struct("centre", "d"), F.struct("degree", -F.col("centre"))).alias("best")).select("id", "best.*")
    work = shared_folder(tiled.sparkSession)
    members = settle(tiled.join(best, "id", "left").select("token", "id", "n", "top", "root", F.coalesce("centre", "id").alias("centre"), F.coalesce("d", F.lit(0.0)).alias("d")), "members", work)

    spots = members.groupBy("token", "centre").agg(F.min("root").alias("root"), F.max("d").alias("d"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("top").alias("top"))
    # tiles are pairs of equal or adjacent bands: a spot lies in the bands of its sets, and is looked for from those and the next
    band = lambda c: F.floor(F.log(100.0 / PERCENT, F.col(c))).cast("int")
    here = spots.withColumn("band", F.explode(F.sequence(band("low"), band("high"))))
    there = spots.withColumn("band", F.explode(F.sequence(band("low") - 1, band("high") + 1)))
    close = "x.root < y.root and 100 * x.high >= {0} * y.low and 100 * y.high >= {0} * x.low and x.low <= y.top and y.low <= x.top".format(PERCENT)
    side = lambda c: F.when(F.col("x.centre") < F.col("y.centre"), F.col(f"{c}.d")).otherwise(F.col(f"{'y' if c == 'x' else 'x'}.d"))
    tiles = here.alias("x").join(there.alias("y"), F.expr(f"x.token = y.token and x.band = y.band and {close}"))
    met = settle(tiles.select("x.token", F.least("x.centre", "y.centre").alias("a"), F.greatest("x.centre", "y.centre").alias("b"), side("x").alias("da"), side("y").alias("db")), "met", work)
    between = verified(met.groupBy("a", "b").agg(F.max(F.col("da") + F.col("db")).alias("reach")), sets, source, "reach")

    # centres that link join their groups; of the others, the members that are far enough out are compared, in the lists where both are
    far = FAR + SLACK
    open_ = between.where(f"not linked and reach > 0 and d <= {far} + reach").select("a", "b", F.col("d").alias("apart"))
    lists = met.join(open_, ["a", "b"]).where(f"da + db + {far} >= apart").distinct().alias("o")
    x, y = members.alias("x"), members.alias("y")
    half = lists.join(x, F.expr(f"o.token = x.token and o.a = x.centre and x.d + o.db + {far} >= o.apart"))
    out = half.join(y, F.expr(f"o.token = y.token and o.b = y.centre and x.d + y.d + {far} >= o.apart and 100 * x.n >= {PERCENT} * y.n and 100 * y.n >= {PERCENT} * x.n and x.n <= y.top and y.n <= x.top"))
    inner = verified(out.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct(), sets, source)
    discard(tiled.sparkSession, work)
    return between.where("linked").select("a", "b", "d").union(inner)


def several(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(token, id, n, top, root) of the lists that hold several groups."""
    few = F.broadcast(groups) if groups.count() <= MOST_ROOTS else groups
    named = postings.join(few.withColumnRenamed("node", "id"), "id", "left").select("token", "id", "n", "top", F.coalesce("root", "id").alias("root"))
    mixed = named.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token")
    return settle(named.join(mixed, "token"), "tiles")


def verified(pairs: DataFrame, sets: DataFrame, source: DataFrame, reach: str | None = None) -> DataFrame:
    """The pairs (a, b) whose sets link, with their distance d: by digest, bitmap bound, then exact intersection.

    With `reach`, pairs have that column; those whose distance is at most FAR and `reach` come back with it and `linked`.
    """
    spark, work = pairs.sparkSession, shared_folder(pairs.sparkSession)
    s = sets.where("n > 0 and id is not null")
    left = s.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"), F.col("digest").alias("da"))
    right = s.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"), F.col("digest").alias("db"))
    pairs = pairs.select("a", "b", (F.col(reach) if reach else F.lit(0.0)).alias("reach"))
    sized = pairs.join(left, "a").join(right, "b").where(f"least(na, nb) >= ({1 - FAR - SLACK} - reach) * greatest(na, nb)")

    def bounded(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if not batch.num_rows:
                continue
            na, nb, more = (batch.column(c).to_numpy() for c in ("na", "nb", "reach"))
            differ = np.array([differing_bits(p, q) for p, q in zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), strict=True)])
            most = (na + nb - differ) // 2
            equal = np.array([p == q for p, q in zip(batch.column("da").to_pylist(), batch.column("db").to_pylist(), strict=True)])
            keep = equal | (most >= (1 - FAR - SLACK - more) * (na + nb - most))
            cols = [batch.column("a"), batch.column("b"), batch.column("reach"), pa.array(equal)]
            yield pa.RecordBatch.from_arrays(cols, ["a", "b", "reach", "equal"]).filter(pa.array(keep))

    candidates = settle(sized.select("a", "b", "reach", "na", "nb", "bits_a", "bits_b", "da", "db").mapInArrow(bounded, "a bigint, b bigint, reach double, equal boolean"), "candidates", work)
    rest = candidates.where("not equal").select("a", "b", "reach")
    wanted = rest.select(F.col("a").alias("id")).union(rest.select(F.col("b").alias("id")))

    def arrays(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([x.tobytes() for x in sets_of(batch.column("text").to_pylist())], pa.binary())], ["id", "set"])

    result = candidates.where("equal").select("a", "b", "reach", F.lit(0.0).alias("d"), F.lit(True).alias("linked"))
    if n_rest := rest.count():
        # whole texts are not shuffled: few ids are broadcast, of more a table of bits; texts that only share a bit meet no pair
        own = source.join(F.broadcast(wanted), "id", "left_semi") if 2 * n_rest <= MOST_IDS else parted(source.where("id is not null"), wanted, "id")[1]
        found = own.select("id", "text").mapInArrow(arrays, "id bigint, set binary")
        full = settle(found, "arrays", work)
        both = rest.join(full.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(full.select(F.col("id").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "reach", "x", "y")

        def exact(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sub_batches(it, "y"):
                d, linked = [], []
                for p, q in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                    u, v = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                    common = len(np.intersect1d(u, v, assume_unique=True))
                    union = len(u) + len(v) - common
                    d.append(1 - common / union)
                    linked.append(100 * common >= PERCENT * union)
                cols = [batch.column("a"), batch.column("b"), batch.column("reach"), pa.array(d, pa.float64()), pa.array(linked, pa.bool_())]
                out = pa.RecordBatch.from_arrays(cols, ["a", "b", "reach", "d", "linked"])
                yield out if reach else out.filter(cols[-1])

        result = result.union(both.mapInArrow(exact, "a bigint, b bigint, reach double, d double, linked boolean"))
    result = settle(result if reach else result.select("a", "b", "d"), "links")
    discard(spark, work)
    return result


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, n_shingles, component_id for every row."""
    sets, links = similar_groups(docs, id_col, text_col)
    roots = links.withColumnRenamed("node", "id")
    return sets.join(roots, "id", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` but for those whose group has a document with a smaller id. Documents without words stay."""
    _, links = similar_groups(docs, id_col, text_col)
    return without(docs, links.select(F.col("node").alias(id_col)), id_col)
