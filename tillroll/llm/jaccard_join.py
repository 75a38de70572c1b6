"""N-gram Jaccard join: documents whose sets of five-word shingles are at least 0.8 similar, and their components.

Method: the shingles of a set are hashed into groups (about as many as shingles), the group counts are points, R-trees over such points bound
the overlap of pairs by summed coordinate minima (`count_tree`), and surviving pairs are verified on the full sets.

A single tree over the whole corpus cannot prune: all documents of one length spread their shingles over the groups alike,
so any box over a few of them admits nearly every query. The points are therefore split into blocks first, by an exact
prefix filter: in one global order of shingles (frequent ones last, by a bounded sample; the order decides only the cost),
two sets of similarity 0.8 share a shingle among the first n - ceil(0.8 n) + 1 of each. Every block is the points that
share such a shingle; no pair outside all blocks can be linked.

Steps. One scan turns each text into (size, set id, group counts, prefix). Equal sets become one class, of which the
smallest document stands for all. (1) In each block every member is held against the block's leader, which settles groups
of near copies with as many pairs as members. (2) Blocks that still hold several components join the rest by R-trees,
only across components. A pair that shares several blocks is mostly looked at in the first of them alone. Pairs that pass the bound are verified on the texts,
in tasks; texts of no such pair are left out before the shuffle. Shingles of the frequent sample
have their blocks salted in (1), and blocks of any size are cut into pairs of bounded parts in (2).

Tables that grow with the corpus are joined by merge joins, also while they are small enough to broadcast: several at once
would pass through the driver. Only joins with whole texts are left to Spark, since a broadcast there spares their shuffle.

Defined cases: no words, empty or null text: empty set, linked with nothing, its own component; one to four words: the
whole sequence is one shingle; a null id counts as larger than any other and gives a null component when it stands alone;
rows are linked by their texts, so rows sharing an id are judged one by one; further columns are ignored.
Sets and shingles are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import first_of, lean, staged
from tillroll.llm.components import components
from tillroll.llm.count_tree import CountTree, can_overlap, sizes_fit
from tillroll.llm.word_grams import WordHashes, gram_hashes, hashed_words, mixed

SHINGLE = 5
LEAST_GROUPS, MOST_GROUPS = 5, 16  # powers of two
SEEN_SETS = 1 << 20
MANY = 3
UNPACKED = (np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3).astype(np.uint8).view("<u4").ravel()  # four codes a byte
BOUND_BYTES = 1 << 16
BLOCK_BYTES = 4 << 20
KNOWN_BYTES = 16 << 20
SAMPLE_DOCS = 4000
FREQUENT_IN_SAMPLE = 4
FREQUENT = 50_000
SALTS = 16
FIRST_BLOCKS = 16  # a matter of cost alone
BITS_A_PAIR = 16
MOST_BITS = 1 << 26
PART_ROWS = 2048
LEAF_ROWS = 32
SEED = 10
LAST_ID = (1 << 63) - 1

SETS = "doc long, body long, n int, sid long, counts binary, prefix array<long>"


def shingle_sets(texts: list[bytes], hashes: WordHashes) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    texts = [t.lower() for t in texts]  # bytes.lower changes A-Z alone
    words, ends = hashed_words(texts, hashes)
    grams, out, start = gram_hashes(words, SHINGLE), [], 0
    for text, end in zip(texts, ends.tolist()):
        if end - start >= SHINGLE:
            out.append(np.unique(grams[start : end - SHINGLE + 1]))
        elif end > start:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(text.split()), seed=1)], dtype=np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        start = end
    return out


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch in blocks of bounded size."""
    low = 0
    while low < batch.num_rows:
        texts, size = [], 0
        while low + len(texts) < batch.num_rows and (size < BLOCK_BYTES or not texts):
            texts.append(batch.column(column)[low + len(texts)].as_py())
            size += len(texts[-1])
        yield low, texts
        low += len(texts)


def groups_for(n: int) -> int:
    """Groups for a set of n shingles: at most one shingle each on average, so that unlike parts of two sets differ in most groups."""
    return 1 << min(max(n.bit_length(), LEAST_GROUPS), MOST_GROUPS)


def group_counts(shingles: np.ndarray) -> bytes:
    """The largest count, then two bits for each group: 0, 1, 2, or 3 for anything from 3 up to the largest count.

    Groups are leading bits of the hash, so the counts for half as many groups are sums of neighbours.
    """
    groups = groups_for(len(shingles))
    at = (shingles >> np.uint64(64 - groups.bit_length() + 1)).astype(np.int64)
    counts = np.bincount(at, minlength=groups)
    codes = np.minimum(counts, MANY).astype(np.uint8).reshape(-1, 4)
    return int(counts.max()).to_bytes(4, "little") + (codes << np.arange(0, 8, 2, dtype=np.uint8)).sum(axis=1, dtype=np.uint8).tobytes()


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    """The same counts for fewer groups, along the last axis."""
    if point.shape[-1] == groups:
        return point
    return point.reshape(*point.shape[:-1], groups, -1).sum(axis=-1, dtype=np.int32)


class PackedCounts:
    """The group counts of many sets, left packed, for the bounds of many pairs at once."""

    def __init__(self, counts: list[bytes]):
        ends = np.cumsum([len(c) for c in counts], dtype=np.int64)
        self.bytes = np.frombuffer(b"".join(counts), np.uint8)
        self.first = np.concatenate([[0], ends[:-1]]).astype(np.int64) + 4
        self.width = ends - self.first
        self.most = self._of(self.first - 4, 4).view("<u4").ravel().astype(np.int64)

    def _of(self, first: np.ndarray, width: int) -> np.ndarray:
        return self.bytes[first[:, None] + np.arange(width)]

    def points(self, rows: np.ndarray) -> np.ndarray:
        """Counts that are exact below MANY and not too small from there, so sums of their minima still bound the overlap.

        The rows have the same number of groups.
        """
        codes = UNPACKED[self._of(self.first[rows], int(self.width[rows[0]]))].view(np.uint8)
        most = np.maximum(self.most[rows], MANY)
        return np.where(codes == MANY, most.astype(np.uint8 if most.max() < 256 else np.int32)[:, None], codes)

    def overlap_bounds(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For every i, no two sets with the counts of x[i] and y[i] share more shingles."""
        out = np.zeros(len(x), np.int64)
        widths = np.stack([self.width[x], self.width[y]], axis=1)
        for wide in np.unique(widths, axis=0):
            alike = np.flatnonzero((widths == wide).all(axis=1))
            step = max(1, BOUND_BYTES // int(wide.max()))
            for low in range(0, len(alike), step):
                at = alike[low : low + step]
                points = (folded(self.points(rows[at]), 4 * int(wide.min())) for rows in (x, y))
                out[at] = np.minimum(*points).sum(axis=1, dtype=np.int64)
        return out


def prefix_of(shingles: np.ndarray, frequent: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 shingles: rare ones by hash, then frequent ones from less to more frequent."""
    n = len(shingles)
    length = n - (4 * n + 4) // 5 + 1 if n else 0
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        rank = np.where(frequent[at] == shingles, ranks[at], 0)
        shingles = shingles[np.lexsort((shingles, rank))]
    return shingles[:length].view(np.int64)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(text).alias("body"),
        text.cast("binary").alias("bytes"),
    )


def frequent_shingles(keyed: DataFrame, rows: int) -> np.ndarray:
    """Shingles that several documents of a bounded sample share, from less to more frequent."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for _, texts in _blocks(batch, 0):
                values, counts = np.unique(np.concatenate(shingle_sets(texts, hashes)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["s", "n"])

    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc", "body"), F.lit(1 << 30)) / float(1 << 30)
    sample = keyed.filter(draw < min(1.0, SAMPLE_DOCS / max(rows, 1))).select("bytes")
    counted = sample.mapInArrow(listed, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    top = counted.filter(F.col("n") >= FREQUENT_IN_SAMPLE).orderBy(F.desc("n"), "s").limit(FREQUENT).toPandas()
    return top["s"].to_numpy(np.int64).view(np.uint64)[::-1].copy()


def described(keyed: DataFrame, frequent: np.ndarray) -> DataFrame:
    """SETS: one row per row of `keyed`."""
    order = np.argsort(frequent)
    shared = keyed.sparkSession.sparkContext.broadcast((frequent[order], (order + 1).astype(np.int64)))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (known, ranks), seen = WordHashes(), shared.value, set()
        for batch in batches:
            for low, texts in _blocks(batch, 2):
                sets = shingle_sets(texts, hashes)
                ids = np.array([int(mixed(s).sum(dtype=np.uint64)) for s in sets], dtype=np.uint64).view(np.int64)
                # A set that this task has met has its prefix listed already; forgetting some merely lists it again.
                fresh = [not (i in seen or seen.add(i)) for i in ids.tolist()]
                if len(seen) > SEEN_SETS:
                    seen.clear()
                columns = [
                    batch.column(0).slice(low, len(texts)),
                    batch.column(1).slice(low, len(texts)),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(ids),
                    pa.array([group_counts(s) for s in sets], pa.binary()),
                    pa.array([prefix_of(s, known, ranks) if new else None for s, new in zip(sets, fresh)], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "body", "n", "sid", "counts", "prefix"])

    return keyed.mapInArrow(lean(describe), SETS)


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose summed minima admit the similarity."""
    for batch in batches:
        if not batch.num_rows:
            continue
        counts = PackedCounts(batch.column("a_counts").to_pylist() + batch.column("b_counts").to_pylist())
        sizes = (batch.column(c).to_numpy().astype(np.int64) for c in ("a_n", "b_n"))
        at = np.arange(batch.num_rows)
        fit = can_overlap(counts.overlap_bounds(at, at + batch.num_rows), *sizes)
        yield batch.select(list(PAIR_COLUMNS)).filter(pa.array(fit))


PAIR_COLUMNS = ("a", "b", "a_doc", "a_body", "b_doc", "b_body")
PAIRS = ", ".join(f"{c} long" for c in PAIR_COLUMNS)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among pairs with both texts; the sets of texts that come again soon are kept, up to a bound."""
    hashes = WordHashes()
    known: dict[bytes, np.ndarray] = {}
    held = 0

    def set_of(text: bytes) -> np.ndarray:
        nonlocal held
        own = known.get(text)
        if own is None:
            own = shingle_sets([text], hashes)[0]
            if held > KNOWN_BYTES:
                known.clear()
                held = 0
            known[text] = own
            held += len(text) + own.nbytes
        return own

    for batch in batches:
        keep = []
        for left, right in zip(batch.column(2), batch.column(3)):
            a, b = set_of(left.as_py()), set_of(right.as_py())
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= 80 * (len(a) + len(b) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _with_classes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        named = classes.select(*[F.col(c).alias(side if c == "sid" else f"{side}_{c}") for c in classes.columns])
        pairs = pairs.join(named.hint("merge"), side)
    return pairs


def texts_of(keyed: DataFrame, sets: DataFrame) -> DataFrame:
    """`keyed` with one row for each (doc, body), for `sets` of the same rows.

    Only rows that repeat id and text, or lack an id, are grouped; the narrow `sets` tell which. All others pass untouched.
    """
    again = sets.groupBy("doc", "body").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc", "body")
    again = staged(again, "jaccard-repeated")
    once = keyed.join(again, ["doc", "body"], "left_anti")
    return once.union(keyed.join(again, ["doc", "body"], "left_semi").dropDuplicates(["doc", "body"]))


def wanted_texts(close: DataFrame, keyed: DataFrame) -> DataFrame:
    """The rows of `keyed` that are in a pair of `close`, and a few others; no text of the rest is shuffled.

    Rows are told by one bit each in a table of bounded size, which alone passes through the driver. Where many rows share
    a bit, more of the others come along; the joins with `close` leave them out.
    """
    bits = min(max(64, 1 << (BITS_A_PAIR * close.count()).bit_length()), MOST_BITS)
    slot = F.pmod(F.xxhash64(F.lit(SEED), "doc", "body"), F.lit(bits))
    named = close.select(F.col("a_doc").alias("doc"), F.col("a_body").alias("body")).union(close.select("b_doc", "b_body"))
    bit = F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")
    words = named.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(bits >> 6, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = keyed.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def wanted(slots: pa.Array) -> pa.Array:
        at = slots.to_numpy()
        return pa.array((shared.value[at >> 6] >> (at & 63) & 1).astype(bool))

    return keyed.filter(wanted(slot))


def links_of(pairs: DataFrame, classes: DataFrame, keyed: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids that are links: bounded by group counts, then verified on the texts."""
    close = staged(_with_classes(pairs, classes).mapInArrow(lean(_bounded), PAIRS), "jaccard-pairs")
    wanted = staged(wanted_texts(close, keyed), "jaccard-texts")
    for side in ("b", "a"):
        texts = wanted.select(*[F.col(c).alias(f"{side}_{c}") for c in ("doc", "body", "bytes")])
        close = close.join(texts, [f"{side}_doc", f"{side}_body"])
    texts = close.select("a", "b", "a_bytes", "b_bytes")
    return staged(texts.mapInArrow(lean(_verified), "a long, b long").distinct(), "jaccard-links")


def _star_pairs(tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of each block's leader with its members, and the rows of blocks with more than one member."""
    block = Window.partitionBy("token", "salt")
    rows = tokens.withColumn("leader", F.min(F.struct("sid", "n")).over(block)).withColumn("members", F.count(F.lit(1)).over(block))
    shared = rows.filter((F.col("members") > 1) | (F.col("salt") >= 0)).drop("members")
    live = staged(shared, "jaccard-live")
    leaders = live.filter("salt >= 0 AND sid = leader.sid").select("token", "sid", "n").distinct()
    head = leaders.groupBy("token").agg(F.min(F.struct("sid", "n")).alias("leader"))
    across = leaders.join(head.hint("merge"), "token").select("leader", "sid", "n")
    stars = live.select("leader", "sid", "n").union(across).filter("leader.sid <> sid")
    fit = stars.filter("5 * least(n, leader.n) >= 4 * greatest(n, leader.n)")
    return fit.select(F.col("leader.sid").alias("a"), F.col("sid").alias("b")).distinct(), live.select("token", "sid", "n")


def _tree_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs inside the blocks of a stream sorted by (token, one, two); the last block waits for more rows."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        table = pa.concat_tables([*held, table]) if held else table
        key = _block_keys(table)
        last = int(key[-1])
        held = [table.slice(last)]
        if last:
            yield from _block_pairs(table.slice(0, last), key[:last])
    for table in held:
        yield from _block_pairs(table, _block_keys(table))


def _block_keys(table: pa.Table) -> np.ndarray:
    """For each row, the position of the first row of its block."""
    columns = [table[c].to_numpy() for c in ("token", "one", "two")]
    new = np.any([np.concatenate([[True], c[1:] != c[:-1]]) for c in columns], axis=0)
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _before_lists(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The lists `before` as rows of a matrix, filled up by the row's own token, which no list of its block holds, and their lengths."""
    lists = table["before"].combine_chunks()
    lengths = pa.compute.list_value_length(lists).to_numpy()
    filled = np.repeat(table["token"].to_numpy()[:, None], max(int(lengths.max()), 1), axis=1)
    filled[np.arange(filled.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy()
    return filled, lengths


def _block_pairs(table: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:
    counts, (before, lengths) = PackedCounts(table["counts"].to_pylist()), _before_lists(table)

    def met_before(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        met = np.zeros(len(x), bool)
        one = before[x]
        for k in range(before.shape[1]):
            met |= (k < lengths[y]) & (one == before[y, k][:, None]).any(axis=1)
        return met

    sid, n, comp, part, one, two = (table[c].to_numpy() for c in ("sid", "n", "comp", "part", "one", "two"))
    n = n.astype(np.int64)
    starts = np.unique(first)
    ends = np.append(starts[1:], len(first))
    found = []
    small = (ends - starts <= LEAF_ROWS) & (one[starts] == two[starts])
    # Blocks no larger than a leaf have nothing to descend: their pairs are bounded directly.
    last = np.repeat(ends, ends - starts)
    rows = np.flatnonzero(np.repeat(small, ends - starts))
    for low in range(0, len(rows), 4096):
        i = rows[low : low + 4096]
        after = last[i] - i - 1
        x = np.repeat(i, after)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(after) - after, after)
        fit = (comp[x] != comp[y]) & sizes_fit(n[x], n[x], n[y], n[y])
        x, y = x[fit], y[fit]
        fit = ~met_before(x, y)
        x, y = x[fit], y[fit]
        fit = can_overlap(counts.overlap_bounds(x, y), n[x], n[y])
        found.append((x[fit], y[fit]))
    for low, high in zip(starts[~small], ends[~small]):
        rows = np.arange(low, high)
        sides = [rows] if one[low] == two[low] else [rows[part[low:high] == p] for p in (one[low], two[low])]
        for x, y in _tree_join(sides, counts, n):
            fit = comp[x] != comp[y]
            x, y = x[fit], y[fit]
            fit = ~met_before(x, y)
            found.append((x[fit], y[fit]))
    if found:
        x, y = (np.concatenate(side) for side in zip(*found))
        a, b = np.minimum(sid[x], sid[y]), np.maximum(sid[x], sid[y])
        pairs = np.unique(np.stack([a, b], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _tree_join(sides: list[np.ndarray], counts: PackedCounts, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows by R-trees: within one side, or between two. Rows whose numbers of groups differ by more than a factor
    of two differ too much in size, so a tree meets the trees of its own and of the neighbouring number of groups."""

    def by_groups(rows: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        groups = 4 * counts.width[rows]
        return {g: (own := rows[groups == g], counts.points(own)) for g in np.unique(groups).tolist()}

    def join(left, right=None, groups=None):
        (rows_a, points_a), (rows_b, points_b) = left, right or left
        tree = CountTree(folded(points_a, groups or points_a.shape[1]), n[rows_a])
        other = CountTree(folded(points_b, groups), n[rows_b]) if right else None
        for i, j in tree.join(other):
            yield rows_a[i], rows_b[j]

    first, second = by_groups(sides[0]), by_groups(sides[-1])
    for g, left in first.items():
        if len(sides) == 1:
            yield from join(left)
        elif g in second:
            yield from join(left, second[g], g)
        if 2 * g in second:
            yield from join(left, second[2 * g], g)
        if len(sides) > 1 and g // 2 in second:
            yield from join(left, second[g // 2], g // 2)


def _open_pairs(live: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Candidate pairs across components, from R-trees over the blocks that still hold several components."""
    labelled = live.join(roots.withColumnRenamed("node", "sid").hint("merge"), "sid", "left").select(
        "token", "sid", "n", F.coalesce("root", "sid").alias("comp")
    )
    spread = labelled.groupBy("token").agg(
        F.min("comp").alias("low"),
        F.max("comp").alias("high"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64("sid").cast("decimal(20,0)")).alias("print_a"),
        F.sum(F.xxhash64("sid", F.lit(SEED)).cast("decimal(20,0)")).alias("print_b"),
    )
    # A passage that several documents share makes one block for each of its shingles, all with the same members.
    same = spread.filter("low <> high").groupBy("rows", "print_a", "print_b").agg(F.min("token").alias("token"))
    still = same.select("token", F.ceil(F.col("rows") / PART_ROWS).cast("int").alias("parts"))
    rows = labelled.join(still.hint("merge"), "token").withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))
    cut = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "token",
        F.least("part", "other").alias("one"),
        F.greatest("part", "other").alias("two"),
        "part",
        "sid",
        "n",
        "comp",
    )
    # Every row carries the first open blocks of its set, so that a pair comes out of the first block of both alone. Where
    # two sets share later blocks only, the pair may come out of several; it is made distinct below.
    first = F.slice(F.sort_array(F.collect_list("token")), 1, FIRST_BLOCKS)
    met = rows.groupBy("sid").agg(first.alias("met"))
    described = classes.select("sid", "counts").join(met.hint("merge"), "sid")
    points = cut.join(described.hint("merge"), "sid").withColumn("before", F.filter("met", lambda t: t < F.col("token"))).drop("met")
    blocks = points.repartition("token", "one", "two").sortWithinPartitions("token", "one", "two")
    return blocks.mapInArrow(lean(_tree_pairs), "a long, b long").distinct()


def _linked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, body, n, root, component) of every row of `docs`."""
    keyed = _keyed(docs, id_col, text_col)
    frequent = frequent_shingles(keyed, docs.count())
    sets = staged(described(keyed, frequent), "jaccard-sets")
    first = sets.filter("n > 0").groupBy("sid").agg(F.min(F.struct("doc", "body", "n", "counts")).alias("first"))
    classes = staged(first.select("sid", "first.*"), "jaccard-classes")
    texts = texts_of(keyed, sets)
    tokens = sets.select("sid", "n", F.explode("prefix").alias("token"))
    if len(frequent):
        hot = docs.sparkSession.createDataFrame([(int(x),) for x in frequent.view(np.int64)], "token long")
        tokens = tokens.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "token", "left")
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("sid"), F.lit(SALTS))).otherwise(-1)
    else:
        salt = F.lit(-1)
    tokens = tokens.select("token", salt.cast("int").alias("salt"), "sid", "n")
    stars, live = _star_pairs(tokens)
    tested = staged(stars, "jaccard-stars")
    links = links_of(tested, classes, texts)
    roots = components(links)
    more = _open_pairs(live, roots, classes)
    ordered = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = links.union(links_of(more.join(ordered, ["a", "b"], "left_anti"), classes, texts))
    return labelled(sets, classes, components(links))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row of `docs`."""
    return _linked(docs, id_col, text_col).select(
        F.when(F.col("doc") != LAST_ID, F.col("doc")).alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("component") != LAST_ID, F.col("component")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without those linked to a kept one: of each component the smallest id stays.

    Rows without words all stay; rows that repeat both id and text become one, chosen by a hash of all columns.
    """
    linked = _linked(docs, id_col, text_col)
    first = linked.filter("n > 0 AND doc = component").groupBy("root").agg(F.min(F.struct("doc", "body")).alias("kept"))
    kept = first.select("kept.doc", "kept.body").union(linked.filter("n = 0").select("doc", "body"))
    text = F.coalesce(F.col(f"whole.`{text_col}`"), F.lit(""))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")).select(
        "whole",
        F.coalesce(F.col(f"whole.`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(text).alias("body"),
    )
    return first_of(packed.join(kept, ["doc", "body"], "left_semi"), "doc", "body").select("whole.*")


def labelled(sets: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """`sets` with the smallest document of each one's component."""
    rooted = classes.select("sid", "doc").join(roots.withColumnRenamed("node", "sid").hint("merge"), "sid", "left")
    rooted = rooted.select("sid", "doc", F.coalesce("root", "sid").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc").alias("component"))
    by_set = rooted.join(least.hint("merge"), "root").select("sid", "root", "component")
    whole = sets.select("doc", "body", "n", "sid")
    return (
        whole.join(by_set.hint("merge"), "sid", "left")
        .select("doc", "body", "n", "root", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component"))
    )
