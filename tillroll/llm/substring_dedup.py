"""Substring deduplication by seed and extend.

A run of at least `WINDOW` words that also stands in a document with a smaller id is removed. Every window of that length
picks its seed by winnowing: the rightmost smallest hash among its `SEED_WORDS`-word grams. Equal windows pick equal
seeds, so documents that share a run meet when occurrences are joined on seed hashes. There the match is extended to both
sides: an occurrence carries a fingerprint of each window around its seed, and it extends as far as the same fingerprints
stand at the same offsets around the seed in an earlier document. The extents that reach the threshold, put together,
are the maximal repeats; they go back to the document as ranges of words.

Scale: only fingerprints are joined. A first pass reduces each seed to the smallest and the largest document that picked
it, and a field of `FIELD_BITS` bits notes the seeds that two documents share; only their occurrences carry fingerprints to the
join (hashes that share a bit let a few more through). Inside each block of a task, occurrences whose whole surroundings
were already met in a smaller document are settled before the shuffle, so a passage that a third of all documents share
arrives as a few rows per block. Equality of extents is judged on the 64-bit seed hash plus 64 bits per window, between
occurrences of the same seed only.

Defined cases: a null or short text loses nothing; a null id counts as larger than any other; rows that share an id do
not clear each other and are told apart by 64 bits of their text; repeated rows get equal results; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bit_fields import bit_field, holds
from tillroll.llm.word_grams import WordHashes, gram_hashes, hashed_words, mixed

WINDOW = 13
SEED_WORDS = 4
BLOCK_BYTES = 4 << 20
LAST_ID = (1 << 63) - 1

FIELD_BITS = 1 << 28

# `place` packs, from the top: 27 bits of the first word, 4 of the lead, 1 for settled.
# A settled row has no prints but the id of an earlier document, and its number of windows in place of the lead.
OCCURRENCES = "seed long, doc long, body long, place int, prints binary"
RANGES = "doc long, body long, start int, covered int, earlier long"


def seeds(words: np.ndarray, ends: np.ndarray, window: int = WINDOW, seed_words: int = SEED_WORDS, with_prints: bool = True):
    """Seed occurrences of a block of texts: (text, start, lead, count, seed, prints); prints are left out on request.

    An occurrence stands for `count` consecutive windows from word `start` of its text on, which all picked the same seed;
    the seed stands `lead` words after the start of the first. `prints` holds one 64-bit fingerprint per window, in order.
    """
    n = max(0, len(words) - window + 1)
    grams = gram_hashes(words, seed_words)
    lengths = np.diff(np.concatenate([[0], ends]))
    text = np.repeat(np.arange(len(ends)), lengths)[:n]
    inside = np.arange(n) + window <= ends[text]
    # Rightmost minimum over `window - seed_words + 1` grams by doubling.
    reach, best, at = 1, grams, np.arange(len(grams))
    span = window - seed_words + 1
    while reach < span and n:
        shift = min(reach, span - reach)
        right = best[shift:] <= best[:-shift]
        at = np.where(right, at[shift:], at[:-shift])
        best = np.where(right, best[shift:], best[:-shift])
        reach += shift
    places = np.flatnonzero(inside)
    at, text = at[:n][places], text[places]
    prints = gram_hashes(words, window)[places] if with_prints else None
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])])) if len(at) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([first, [len(at)]])).astype(np.int64)
    begin = ends - lengths
    return (
        text[first],
        (places[first] - begin[text[first]]).astype(np.int32),
        (at[first] - places[first]).astype(np.int32),
        count,
        mixed(grams[at[first]]).view(np.int64),
        prints,
    )


def _settled(seed: np.ndarray, lead: np.ndarray, count: np.ndarray, prints: np.ndarray, doc: np.ndarray):
    """Occurrences whose seed, lead and fingerprints all stand in the same block under a smaller id, and the smallest."""
    if not len(seed):
        return np.zeros(0, bool), np.zeros(0, np.int64)
    weights = mixed(np.arange(1, 65, dtype=np.uint64))
    inner = np.arange(len(prints)) - np.repeat(np.cumsum(count) - count, count)
    whole = np.add.reduceat(mixed(prints + weights[inner]), np.cumsum(count) - count)
    key = mixed(seed.view(np.uint64) + mixed(whole + lead.astype(np.uint64) * np.uint64(64) + count.astype(np.uint64)))
    order = np.lexsort((doc, key))
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    smallest = doc[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    settled, earlier = np.zeros(len(seed), bool), np.zeros(len(seed), np.int64)
    settled[order], earlier[order] = doc[order] > smallest, smallest
    return settled, earlier


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


def _seed_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, low, high): the smallest and the largest document of each block that picked a seed."""
    hashes = WordHashes()
    for batch in batches:
        docs = batch.column(0).to_numpy()
        for at, texts in _blocks(batch, 1):
            words, ends = hashed_words(texts, hashes)
            text, _, _, _, seed, _ = seeds(words, ends, with_prints=False)
            if not len(seed):
                continue
            doc = docs[at : at + len(texts)][text]
            order = np.lexsort((doc, seed))
            seed, doc = seed[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
            last = np.append(first[1:], len(seed)) - 1
            columns = [pa.array(seed[first]), pa.array(doc[first]), pa.array(doc[last])]
            yield pa.RecordBatch.from_arrays(columns, ["seed", "low", "high"])


def _occurrences(field):
    """OCCURRENCES of the seeds that `field` may hold."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            docs, bodies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for low, texts in _blocks(batch, 2):
                words, ends = hashed_words(texts, hashes)
                text, start, lead, count, seed, prints = seeds(words, ends)
                doc, body = docs[low : low + len(texts)][text], bodies[low : low + len(texts)][text]
                shared = holds(field.value, seed.view(np.uint64))
                prints = prints[np.repeat(shared, count)]
                doc, body, start, lead, count, seed = (x[shared] for x in (doc, body, start, lead, count, seed))
                settled, earlier = _settled(seed, lead, count, prints, doc)
                # Settled rows only pass through; a spread key keeps them off the partitions of frequent seeds.
                seed = np.where(settled, mixed(seed.view(np.uint64) + doc.view(np.uint64)).view(np.int64), seed)
                sizes = np.where(settled, 1, count)
                ends8 = np.cumsum(sizes) * 8
                bytes_ = np.empty(int(sizes.sum()), np.uint64)
                open_places = np.repeat(~settled, sizes)
                bytes_[open_places] = prints[np.repeat(~settled, count)]
                bytes_[~open_places] = earlier[settled].view(np.uint64)
                offsets = np.concatenate([[0], ends8]).astype(np.int32)
                binary = pa.BinaryArray.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(offsets), pa.py_buffer(bytes_)])
                lead = np.where(settled, count, lead)
                place = (start.astype(np.int64) << 5 | lead.astype(np.int64) << 1 | settled).astype(np.uint32).view(np.int32)
                columns = [pa.array(seed), pa.array(doc), pa.array(body), pa.array(place), binary]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in OCCURRENCES.split(", ")])

    return scan


def extend(seed, doc, lead, count, prints) -> tuple[np.ndarray, np.ndarray]:
    """Bit i of the first result: window i of an occurrence also stands around the same seed under a smaller id. The second
    result is the smallest such id.

    Rows come sorted by (seed, doc), so the first row of a run of equal (seed, offset, fingerprint) has the smallest id.
    """
    new = np.concatenate([[True], seed[1:] != seed[:-1]])
    group = np.cumsum(new) - 1
    shared = np.flatnonzero(np.bincount(group)[group] > 1)
    covered, earlier = np.zeros(len(seed), np.int32), np.full(len(seed), LAST_ID)
    if not len(shared):
        return covered, earlier
    starts = (np.cumsum(count) - count)[shared]
    count = count[shared]
    row = np.repeat(np.arange(len(shared)), count)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    mark = prints[np.repeat(starts, count) + inner]
    near = group[shared][row] << 4 | lead[shared][row] - inner
    order = np.lexsort((mark, near))
    fresh = _fresh(near[order], mark[order])
    owner = doc[shared][row][order]
    smallest = owner[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    hit = order[owner > smallest]
    covered[shared] = np.bincount(row[hit], weights=1 << inner[hit], minlength=len(shared)).astype(np.int32)
    np.minimum.at(earlier, shared[row[hit]], smallest[owner > smallest])
    return covered, earlier


def _fresh(near: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Where a new pair begins in sorted pairs."""
    return np.concatenate([[True], (near[1:] != near[:-1]) | (mark[1:] != mark[:-1])])


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges from occurrences sorted by (seed, doc).

    A seed may run over many batches: what follows needs of it only the distinct (offset, fingerprint) with the smallest
    id of each, which stand in front of the next batch as occurrences of a single window.
    """
    ahead = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    for batch in batches:
        table = pa.Table.from_batches([batch])
        doc, body = table["doc"].to_numpy(), table["body"].to_numpy()
        place = table["place"].to_numpy().view(np.uint32).astype(np.int64)
        settled, start = (place & 1).astype(bool), place >> 5
        if settled.any():
            known = np.frombuffer(b"".join(table["prints"].filter(pa.array(settled)).to_pylist()), dtype=np.int64)
            yield _ranges(doc[settled], body[settled], start[settled], (1 << (place[settled] >> 1 & 15)) - 1, known)
        open_rows = ~settled
        if not open_rows.any():
            continue
        count = pa.compute.binary_length(table["prints"]).to_numpy()[open_rows].astype(np.int64) // 8
        prints = np.frombuffer(b"".join(table["prints"].filter(pa.array(open_rows)).to_pylist()), dtype=np.uint64)
        doc, body, start = doc[open_rows], body[open_rows], start[open_rows]
        seed, lead = table["seed"].to_numpy()[open_rows], (place >> 1 & 15)[open_rows]
        if len(ahead[0]) and ahead[0][0] != seed[0]:
            ahead = tuple(x[:0] for x in ahead)
        n = len(ahead[0])
        seed, all_docs, lead, counts, prints = (
            np.concatenate([x, y]) for x, y in zip(ahead, (seed, doc, lead, count, prints))
        )
        covered, earlier = (x[n:] for x in extend(seed, all_docs, lead, counts, prints))
        found = np.flatnonzero(covered)
        yield _ranges(doc[found], body[found], start[found], covered[found], earlier[found])
        first = int(np.searchsorted(seed == seed[-1], True))
        ahead = _distinct(seed[first:], all_docs[first:], lead[first:], counts[first:], prints[counts[:first].sum() :])


def _distinct(seed, doc, lead, count, prints):
    """The windows of one seed's occurrences, one for each (offset, fingerprint), with the smallest id."""
    row = np.repeat(np.arange(len(seed)), count)
    offset = lead[row] - (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
    order = np.lexsort((prints, offset))
    first = order[_fresh(offset[order], prints[order])]
    first = first[np.argsort(doc[row[first]], kind="stable")]
    return seed[row[first]], doc[row[first]], offset[first], np.ones(len(first), np.int64), prints[first]


def _ranges(doc: np.ndarray, body: np.ndarray, start: np.ndarray, covered: np.ndarray, earlier: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(doc), pa.array(body), *(pa.array(x.astype(np.int32)) for x in (start, covered)), pa.array(earlier)]
    return pa.RecordBatch.from_arrays(columns, ["doc", "body", "start", "covered", "earlier"])


def removed_mask(n_words: int, starts: np.ndarray, covered: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words the covered windows hold."""
    steps = np.zeros(n_words + 1, dtype=np.int64)
    for i in range(window):
        at = starts[(covered >> i) & 1 == 1] + i
        np.add.at(steps, at, 1)
        np.add.at(steps, at + window, -1)
    return np.cumsum(steps[:-1]) > 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, removed, digests, kept_texts = [], [], [], []
        for text, ranges in zip(batch.column(1), batch.column(2)):
            words = text.as_py().split()
            gone = 0
            if ranges.is_valid and len(ranges.values):
                pairs = ranges.values
                mask = removed_mask(len(words), pairs.field(0).to_numpy(), pairs.field(1).to_numpy())
                gone = int(mask.sum())
                kept = [w for w, m in zip(words, mask.tolist()) if not m] if gone else words
            else:
                kept = words
            body = b" ".join(kept)
            totals.append(len(words))
            removed.append(gone)
            digests.append(hashlib.sha256(body).hexdigest())
            kept_texts.append(body)
        columns = [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(kept_texts, pa.binary())], ["id", "n_words", "n_removed", "kept_sha256", "kept"]
        )


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """RANGES: windows, as bits from word `start` on, that a document with a smaller id also holds, and the smallest of
    the documents in which their occurrences were met."""
    keyed = _keyed(docs, id_col, text_col).select("doc", "body", "bytes").filter(F.length("bytes") >= 2 * WINDOW - 1)
    listed = keyed.select("doc", "bytes").mapInArrow(_seed_documents, "seed long, low long, high long")
    spread = listed.groupBy(F.col("seed").alias("h")).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    field = docs.sparkSession.sparkContext.broadcast(bit_field(spread.filter("low < high").select("h"), FIELD_BITS))
    found = keyed.mapInArrow(_occurrences(field), OCCURRENCES)
    met = found.repartition("seed").sortWithinPartitions("seed", "doc")
    return met.mapInArrow(_extended, RANGES)


def _spans(least: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, lengths, earliest = [], [], [], []
            for i, ranges in enumerate(batch.column(2)):
                pairs = ranges.values
                start, covered, earlier = (pairs.field(k).to_numpy() for k in range(3))
                places = [start[covered >> k & 1 == 1] + k for k in range(WINDOW - SEED_WORDS + 1)]
                from_ = [earlier[covered >> k & 1 == 1] for k in range(WINDOW - SEED_WORDS + 1)]
                windows, owners = np.concatenate(places), np.concatenate(from_)
                order = np.argsort(windows, kind="stable")
                windows, owners = windows[order], owners[order]
                # Windows whose words overlap or touch make one span.
                new = np.flatnonzero(np.concatenate([[True], windows[1:] > windows[:-1] + WINDOW]))
                last = np.append(new[1:], len(windows)) - 1
                length = windows[last] + WINDOW - windows[new]
                smallest = np.minimum.reduceat(owners, new)
                for a, n, e in zip(windows[new], length, smallest):
                    if n >= least:
                        rows.append(i)
                        starts.append(a)
                        lengths.append(n)
                        earliest.append(e)
            at = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at)]
            columns += [pa.array(starts, pa.int32()), pa.array(lengths, pa.int32()), pa.array(earliest, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "body", "start", "length", "earlier"])

    return scan


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = WINDOW) -> DataFrame:
    """Maximal runs of repeated words: (id, body, start, length, earlier).

    A span joins all repeated windows that overlap or touch; spans under `least` words are left out. `body` is Spark's
    xxhash64 of the text, which tells rows of one id apart; `earlier` is the smallest id among the documents met.
    """
    ranges = repeated_ranges(docs, id_col, text_col)
    per_row = ranges.groupBy("doc", "body").agg(F.collect_list(F.struct("start", "covered", "earlier")).alias("ranges"))
    spans = per_row.mapInArrow(_spans(least), "doc long, body long, start int, length int, earlier long")
    return spans.distinct().select(
        F.when(F.col("doc") != LAST_ID, F.col("doc")).alias(id_col), "body", "start", "length", "earlier"
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row is known by its id and a hash of its text: rows that agree in both have equal results anyway."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(text).alias("body"),
        text.cast("binary").alias("bytes"),
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept text) of every row of `docs`."""
    ranges = repeated_ranges(docs, id_col, text_col)
    per_row = ranges.groupBy("doc", "body").agg(F.collect_list(F.struct("start", "covered")).alias("ranges"))
    joined = _keyed(docs, id_col, text_col).join(per_row, ["doc", "body"], "left").select("id", "bytes", "ranges")
    kind = joined.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, n_removed long, kept_sha256 string, kept binary"
    return joined.mapInArrow(_cut, schema).withColumn("kept", F.col("kept").cast("string")).withColumnRenamed("id", id_col)
