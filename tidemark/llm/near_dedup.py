"""MinHash near-dedup with tensored banding.

Two collections of ``m`` short hashes, each of ``ROWS`` minhashes, give ``m * m`` table keys:
every pair of one from each side. ``2 * m * ROWS`` minhashes do the work of ``m * m * 2 * ROWS``.
Candidates of a shared key are confirmed on their full shingle sets.

Documents with equal sets are one class first, so copies cost nothing further. The members of
each bucket are compared with its least one, the lead. Where those of one lead are then still in
more than one component, the members outside its largest one are compared with all, in blocks
of bounded size, by how each differs from the lead. So no link within a bucket is lost, all
pairs of a group are never listed, what is connected is not compared again, and only links that
connect something new come out of a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, numbered, whole
from tidemark.llm.components import components

WORDS, PERCENT = 5, 80
ROWS = 2                    # minhashes of one hash of a collection
MISS = 1e-4                 # chance, at most, that a pair just at the threshold shares no key
BLOCK = 256                 # members of a block
FAIR = 30                   # percent shared with a lead from which the difference is kept
CACHE_WORDS = 60_000        # a larger cache costs every worker memory and saves no time
SEED = 20_011


def collection_size(percent: int, miss: float = MISS) -> int:
    """The least ``m`` for which a pair at the threshold is lost by either side with chance ``miss``."""
    unmatched = 1 - (percent / 100) ** ROWS
    return max(1, math.ceil(math.log(miss / 2) / math.log(unmatched)))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


_HASHES = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def shingles(text: str, words: int) -> np.ndarray:
    """The document's set: sorted distinct hashes of its runs of ``words`` words.

    A-Z in lower case, words between blanks; fewer words are one shingle as a whole.
    """
    parts = text.encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, parts), np.uint64, len(parts))
    span = min(words, len(hashes))
    rolled = np.full(len(hashes) - span + 1, span, np.uint64)
    for k in range(span):
        rolled = _mixed(rolled * np.uint64(0x100000001B3) + hashes[k:len(hashes) - span + 1 + k])
    return np.unique(rolled)


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    flips, factors = rng.integers(0, 2 ** 64, (2, count), dtype=np.uint64)
    return flips, factors | np.uint64(1)


def minhashes(members: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(flips), 2 ** 32 - 1, np.uint64)
    for at in range(0, len(members), 2048):
        values = ((members[at:at + 2048, None] ^ flips) * factors) >> np.uint64(32)
        np.minimum(least, values.min(axis=0), out=least)
    return least.astype(np.uint32).view(np.int32)


def _sign(words: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips, factors = _functions(count)
        for batch in batches:
            sizes, digests, rows = [], [], []
            for text in batch.column(2):
                members = shingles(text.as_py(), words)
                sizes.append(len(members))
                digests.append(xxhash.xxh3_128_digest(members.tobytes()))
                rows.append(minhashes(members, flips, factors))
            values = np.concatenate(rows) if rows else np.empty(0, np.int32)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * count
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                names=["row", "doc_id", "n_shingles", "digest", "signature"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(text.as_py(), words).view(np.int64) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["row", "members"])

    return run


def _keys(signature: Column, m: int) -> Column:
    """All ``m * m`` table keys: a hash of one entry of the first and one of the second collection."""
    def entry(side: int, i: Column) -> Column:
        return F.slice(signature, side * m * ROWS + i * ROWS + 1, ROWS)

    each = F.sequence(F.lit(0), F.lit(m - 1))
    return F.flatten(F.transform(each, lambda i: F.transform(
        each, lambda j: F.xxhash64(i, j, entry(0, i), entry(1, j)))))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` with their sizes, what they share, and whether that is enough.

    Where a fair part is shared, ``missing`` and ``extra`` say how the set of b differs from that
    of a. A merge join at every size, as sets of all documents may come.
    """
    a = sets.select(F.col("row").alias("a"), F.col("members").alias("set_a"))
    b = sets.select(F.col("row").alias("b"), F.col("members").alias("set_b"))
    both = (pairs.hint("merge").join(b, "b").hint("merge").join(a, "a")
            .withColumns({"size_a": F.size("set_a"), "size_b": F.size("set_b"),
                          "common": F.size(F.array_intersect("set_a", "set_b"))}))
    union = F.col("size_a") + F.col("size_b") - F.col("common")
    fair = 100 * F.col("common") >= FAIR * union
    return materialise(both.select(
        "a", "b", "size_a", "size_b", "common", (100 * F.col("common") >= percent * union).alias("alike"),
        F.when(fair, F.array_except("set_a", "set_b")).alias("missing"),
        F.when(fair, F.array_except("set_b", "set_a")).alias("extra")), "near-judged")


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many numbers each of the left lists has in common with each of the right lists."""
    out = np.zeros((len(left), len(right)), np.float32)
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for at in range(0, len(both), 4096):
        columns = both[at:at + 4096]
        tables = []
        for side in (left, right):
            table = np.zeros((len(side), len(columns)), np.float32)
            for x, numbers in enumerate(side):
                table[x, np.searchsorted(columns, numbers[np.isin(numbers, columns)])] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def _block_pairs(m: int, percent: int):
    """Links inside a block of what shares a bucket with the same lead.

    The sets of members close to the lead are known from the lead's, so these are compared at
    once, and ``sure`` links are given that connect what was not connected, not all. Other pairs
    are given to be compared, if signatures, sizes and distances from the lead allow a link.
    """
    # a pair at the threshold falls below this many agreeing minhashes with chance under 1e-6
    count, share = 2 * m * ROWS, percent / 100
    enough = math.floor(count * share - 5.5 * math.sqrt(count * share * (1 - share)))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        same = frame["first"].iat[0] == frame["second"].iat[0]
        left, right = (frame, frame) if same else (frame[frame["side"] == 0], frame[frame["side"] == 1])
        if left.empty or right.empty:
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64), "sure": np.empty(0, bool)})
        n_l, n_r = left["size_b"].to_numpy()[:, None], right["size_b"].to_numpy()[None]
        fit = (left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None]) & (
            100 * np.minimum(n_l, n_r) >= percent * np.maximum(n_l, n_r))
        if same:
            fit &= np.triu(np.ones(fit.shape, bool), 1)
        near_l, near_r = left["missing"].notna().to_numpy(), right["missing"].notna().to_numpy()
        found = []
        if near_l.any() and near_r.any():
            at_l, at_r = np.flatnonzero(near_l), np.flatnonzero(near_r)
            lists = [[np.asarray(v) for v in side[c].iloc[at]] for side, at in ((left, at_l), (right, at_r))
                     for c in ("missing", "extra")]
            gone_l, gone_r = (np.array([len(v) for v in lists[k]]) for k in (0, 2))
            common = (int(frame["size_a"].iat[0]) - gone_l[:, None] - gone_r[None]
                      + _shared(lists[0], lists[2]) + _shared(lists[1], lists[3]))
            cell = np.ix_(at_l, at_r)
            union = n_l[at_l] + n_r[:, at_r] - common
            linked = np.argwhere((100 * common >= percent * union) & fit[cell])
            found += _joining(at_l[linked[:, 0]], at_r[linked[:, 1]], left["component"].to_numpy(),
                              right["component"].to_numpy())
            fit[cell] = False
        away = [1 - c / (c_a + c_b - c) for c, c_a, c_b in
                ((side["common"].to_numpy(), side["size_a"].to_numpy(), side["size_b"].to_numpy())
                 for side in (left, right))]
        fit &= np.abs(away[0][:, None] - away[1][None]) <= 1 - share + 1e-9
        sure = len(found)
        sig_r = np.stack(right["signature"])
        for x, signature in enumerate(left["signature"]):
            at = np.flatnonzero(fit[x])
            if at.size:
                found += [(x, y) for y in at[(sig_r[at] == signature).sum(axis=1) >= enough]]
        rows_l, rows_r = left["b"].to_numpy(), right["b"].to_numpy()
        pairs = np.array([sorted((rows_l[x], rows_r[y])) for x, y in found], np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "sure": np.arange(len(pairs)) < sure})

    return run


def _joining(at_l: np.ndarray, at_r: np.ndarray, parts_l: np.ndarray, parts_r: np.ndarray) -> list[tuple[int, int]]:
    """Those of the links that join parts which the ones before left apart."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x, y in zip(at_l, at_r, strict=True):
        one, other = root(parts_l[x]), root(parts_r[y])
        if one != other:
            parent[one] = other
            out.append((x, y))
    return out


def _spread(placed: DataFrame) -> DataFrame:
    """Leads ``a`` with members in several components: the largest one, how many blocks it takes
    (``inner``), and how many the members outside it take (``outer``)."""
    def blocks(rows: Column) -> Column:
        return F.ceil(rows / BLOCK).cast("int")

    sizes = placed.groupBy("a", "component").agg(F.count("*").alias("n"))
    most = F.max(F.struct("n", "component"))
    return (sizes.groupBy("a").agg(most.alias("most"), F.sum("n").alias("n"), F.count("*").alias("parts"))
            .where("parts > 1").select("a", F.col("most.component").alias("largest"),
                                       blocks(F.col("most.n")).alias("inner"),
                                       blocks(F.col("n") - F.col("most.n")).alias("outer")))


def _dealt(members: DataFrame, spread: DataFrame) -> DataFrame:
    """Members with every pair of blocks (``first``, ``second``) and the ``side`` they are on there.

    Blocks below ``outer`` hold what is outside the largest component and meet each other and
    all further blocks. Those never meet each other, as all in them is connected.
    """
    def share(count: Column) -> Column:
        return F.pmod(F.xxhash64("b"), count).cast("int")

    outside = F.col("component") != F.col("largest")
    mine = F.when(outside, share(F.col("outer"))).otherwise(F.col("outer") + share(F.col("inner")))
    met = F.when(outside, F.col("outer") + F.col("inner")).otherwise(F.col("outer"))
    cells = F.transform(F.sequence(F.lit(0), F.col("met") - 1), lambda other: F.struct(
        F.least(other, F.col("mine")).alias("first"), F.greatest(other, F.col("mine")).alias("second"),
        (F.col("mine") > other).cast("int").alias("side")))
    return (members.join(spread, "a").withColumns({"mine": mine, "met": met})
            .withColumn("cell", F.explode(cells)).select(*members.columns, "cell.*"))


def _links(reps: DataFrame, base: DataFrame, words: int, percent: int, m: int) -> DataFrame | None:
    """Links between classes that connect all that are alike; None if there is no candidate."""
    keyed = reps.select("row", F.explode(_keys(F.col("signature"), m)).alias("key"))
    buckets = materialise(keyed.groupBy("key").agg(F.min("row").alias("lead"), F.count("*").alias("members"))
                          .where("members > 1"), "near-buckets")
    stars = materialise(keyed.join(buckets, "key").where("row <> lead")
                        .select(F.col("lead").alias("a"), F.col("row").alias("b")).distinct(), "near-stars")
    if stars.isEmpty():
        return None
    # the sets of all that share a bucket. A merge join at every size: their number grows
    wanted = stars.select(F.col("a").alias("row")).unionByName(stars.select(F.col("b").alias("row"))).distinct()
    sets = materialise(base.select("row", whole("doc.text").alias("text"))
                       .join(wanted.hint("merge"), "row", "left_semi")
                       .mapInArrow(_sets(words), "row long, members array<long>"), "near-sets")
    judged = _confirmed(stars, sets, percent)
    links = judged.where("alike").select("a", "b")
    # what shares a lead but is not all connected yet; pairs with the lead are done
    parts = components(links)
    placed = materialise(judged.join(parts, F.col("b") == F.col("node"), "left")
                         .withColumn("component", F.coalesce("component", "b")).drop("node"), "near-placed")
    spread = materialise(_spread(placed), "near-spread")
    if spread.isEmpty():
        return links
    members = _dealt(placed.join(reps.select(F.col("row").alias("b"), "signature"), "b"), spread)
    pairs = materialise(members.groupBy("a", "first", "second")
                        .applyInPandas(_block_pairs(m, percent), "a long, b long, sure boolean"), "near-pairs")
    links = links.unionByName(pairs.where("sure").select("a", "b"))
    unsure = pairs.where("NOT sure").select("a", "b").distinct()
    return links.unionByName(_confirmed(unsure, sets, percent).where("alike").select("a", "b"))


def near_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, miss: float = MISS
                ) -> tuple[DataFrame, DataFrame]:
    """The numbered documents, and ``row, doc_id, n_shingles, component_id, leader`` of each.

    ``component_id`` is the least doc_id that links reach, null ids last; ``leader`` is the one
    row of the component that stays. Documents without words are linked with nothing, equal
    sets always with each other, repeated rows too. A pair exactly at the threshold is missed
    with a chance of at most ``miss``; nothing is linked below it.
    """
    m = collection_size(percent, miss)
    base = numbered(docs, "near-docs")
    signed = materialise(
        base.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), whole("doc.text").alias("text"))
        .mapInArrow(_sign(words, 2 * m * ROWS),
                    "row long, doc_id long, n_shingles long, digest binary, signature array<int>"), "near-signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "n_shingles", "signature"))
    classes = materialise(signed.where("n_shingles > 0").groupBy("digest")
                          .agg(first.alias("first"), F.count("*").alias("copies")), "near-classes")
    reps = classes.select("first.row", "first.n_shingles", "first.signature")
    links = _links(reps, base, words, percent, m)
    named = classes.select("digest", "copies", "first.no_id", "first.doc_id", "first.row")
    if links is None:
        joined = named.withColumn("component", F.lit(None).cast("long"))
    else:
        joined = named.join(components(links), F.col("row") == F.col("node"), "left")
    joined = materialise(joined.where("copies > 1 OR component IS NOT NULL")
                         .withColumn("component", F.coalesce("component", "row")), "near-joined")
    heads = joined.groupBy("component").agg(F.min(F.struct("no_id", "doc_id", "row")).alias("head"))
    answers = materialise(joined.select("digest", "component").join(heads, "component")
                          .select("digest", F.col("head.doc_id").alias("head_id"), F.col("head.row").alias("head_row")),
                          "near-answers")
    alone = F.col("head_row").isNull()
    decided = signed.select("row", "doc_id", "n_shingles", "digest").join(answers, "digest", "left").select(
        "row", "doc_id", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head_id")).alias("component_id"),
        (alone | (F.col("row") == F.col("head_row"))).alias("leader"))
    return base, decided


def near_dedup_decisions(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``; kept where the id is the component's."""
    decided = near_groups(docs, words, percent)[1]
    return decided.select("doc_id", "n_shingles", "component_id",
                          F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_dedup(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns."""
    base, decided = near_groups(docs, words, percent)
    return base.join(decided.where("leader").select("row"), "row", "left_semi").select("doc.*")
