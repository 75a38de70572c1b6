r"""Collocations from word indexes: an FM-index per shard counts phrases, sums over shards decide.

Texts are lower-cased (A-Z), cut into pieces at `[.,;:!?\x0A-\x0D]` and those into words. Tasks pack the word numbers of
each language into shards of about `SHARD_WORDS` words, written once to the shared folder. Several passes read them:

1. the word counts of the shards are summed;
2. for each length from two to `SUMMED_WORDS` words, each shard builds its index over the text that can still hold a frequent phrase of
   that length, grows the frequent phrases one word shorter, and gives out 32 bits of a hash and the count of each; these are summed;
3. each shard builds its index over the text between infrequent pairs, grows patterns up to `max_words` on the right and
   the left in turn, follows those that are frequent, and gives out each with its words, its count and, per side, the one
   word beside all its occurrences, if there is one.

A phrase cannot be more frequent than its parts, so nothing of `min_count` is lost on the way. What a step found travels
as a field of `FILTER_BITS` bits addressed by hash, of one size whatever the corpus; hashes that collide only let more
through, and the last step counts phrases by their words. A phrase lies inside a longer one of the same count exactly
when one word stands beside all its occurrences, in all shards; that settles which candidates are dropped without a join.

Scale: shards are bounded, lie in row groups of a few and reach Python a few at a time, and phrases become words a slice
at a time, so the memory of a task is bounded whatever the share of a shard that is frequent. In the last step each task adds up its shards before it gives a phrase
out. Ranking sorts parts of a language first and then the best of the parts.

Defined cases: a null text is empty, a null language `und`; a table without candidates gives an empty result; repeated
rows count each time; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.bit_fields import bit_field, holds
from tillroll.llm.common import arrow_rows, lean, staged, text_or_empty
from tillroll.llm.word_grams import BASE, mixed
from tillroll.llm.word_index import Patterns, WordIndex

UNKNOWN = "und"
MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
SCORE_SCALE = 1000
SHARD_WORDS = 1 << 19
SUMMED_WORDS = 3  # phrases up to here are summed by hash first; of longer ones few are left to try
FILTER_BITS = 1 << 26  # at most 2^32
HELD_PHRASES = 1 << 18
SLICE_PHRASES = 1 << 15  # phrases of a shard that are written out as words at once
BATCH_SHARDS = 2  # shards that travel to Python at once, a few megabytes each
GROUP_SHARDS = 4  # shards in a row group, which a reader or writer holds at once
OPEN_SHARDS = 4  # full shards whose words a task may hold open, of all languages
BATCH_TEXTS = 500  # texts that travel to Python at once
RANK_PARTS = 64
JVM_SEED = 42  # seed of Spark's xxhash64

SHARDS = "lang string, words array<string>, counts array<int>, tokens binary"
PHRASES = "lang string, size int, phrase string, n long, left string, right string"

# Lower case, and every cut as a byte that no UTF-8 text holds.
_CUT = b"\xff"
_FOLD = bytes(
    0xFF if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


class _Numbers(dict):
    """Word -> number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Shard:
    def __init__(self, lang: str | None) -> None:
        self.lang, self.numbers, self.parts, self.size = lang, _Numbers({_CUT: 0}), [], 0

    def add(self, text: bytes) -> None:
        words = text.translate(_FOLD).replace(_CUT, b" \xff ").split()
        words.append(_CUT)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self) -> pa.RecordBatch:
        """Words in order of frequency, so that small numbers are common and the column compresses well."""
        tokens = np.concatenate(self.parts)
        counts = np.bincount(tokens, minlength=len(self.numbers))
        order = np.concatenate([[0], 1 + np.argsort(-counts[1:], kind="stable")])
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order))
        names = pa.array(list(self.numbers), pa.binary()).take(pa.array(order[1:])).cast(pa.string())
        ends = pa.array([0, len(names)], pa.int32())
        columns = [
            pa.array([self.lang], pa.string()),
            pa.ListArray.from_arrays(ends, names),
            pa.ListArray.from_arrays(ends, pa.array(counts[order[1:]].astype(np.int32))),
            pa.array([number[tokens].tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "words", "counts", "tokens"])


def _pack(shard_words: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shards: dict[str | None, _Shard] = {}
        held = 0
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, batch.column(1)):
                shard = open_shards.setdefault(lang, _Shard(lang))
                before = shard.size
                shard.add(text.as_py())
                held += shard.size - before
                if shard.size < shard_words and held > OPEN_SHARDS * shard_words:
                    shard = max(open_shards.values(), key=lambda s: s.size)
                elif shard.size < shard_words:
                    continue
                held -= shard.size
                yield open_shards.pop(shard.lang).row()
        for shard in open_shards.values():
            yield shard.row()

    return shards


def pack(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", shard_words: int = SHARD_WORDS) -> DataFrame:
    """SHARDS in the shared folder."""
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        text_or_empty(F.col(text_col)).cast("binary").alias("text"),
    )
    options = {"compression": "zstd", "parquet.block.row.count.limit": str(GROUP_SHARDS)}
    with arrow_rows(docs.sparkSession, BATCH_TEXTS):
        return staged(texts.mapInArrow(lean(_pack(shard_words)), SHARDS), "phrase-shards", **options)


def _word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    """Spark's xxhash64(lang, word) of every word."""
    seed = xxhash.xxh64_intdigest(lang.encode(), JVM_SEED)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words.cast(pa.binary()).to_pylist()], dtype=np.uint64)


def _phrase_hashes(hashes: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases given as one column of word numbers per place."""
    found = hashes[columns[0]]
    for words in columns[1:]:
        found = mixed(mixed(found) * np.uint64(BASE) + hashes[words])
    return found


def _closed_up(text: np.ndarray) -> np.ndarray:
    """Without words that stand alone, with one 0 after each run of words that is left."""
    gap = np.concatenate([[True], text == 0, [True]])
    text = np.append(np.where(gap[:-2] & gap[2:], 0, text), 0)
    return text[(text > 0) | (np.concatenate([[0], text[:-1]]) > 0)]


def _kept_links(text: np.ndarray, hashes: np.ndarray, field: np.ndarray, length: int) -> np.ndarray:
    """The text, cut between neighbours that no phrase of that length, as far as `field` knows, holds together."""
    n = len(text) - length + 1
    if n <= 0:
        return np.zeros(0, text.dtype)
    inside = np.ones(n, bool)
    for i in range(length):
        inside &= text[i : i + n] > 0
    at = np.flatnonzero(inside)
    at = at[holds(field, _phrase_hashes(hashes, [text[at + i] for i in range(length)]))]
    steps = np.zeros(len(text), np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + length - 1, -1)
    linked = np.cumsum(steps)[:-1] > 0
    return _closed_up(np.insert(text, np.flatnonzero(~linked & (text[:-1] > 0) & (text[1:] > 0)) + 1, 0))


class _Text:
    """A shard's text with 0 in place of words, and between words, that cannot be part of a frequent phrase."""

    def __init__(self, row: dict, fields: list[np.ndarray], cut_to: int) -> None:
        self.names, self.fields = row["words"], fields
        self.hashes = np.concatenate([[np.uint64(0)], _word_hashes(row["lang"], self.names)])
        allowed = np.concatenate([[False], holds(fields[0], self.hashes[1:])])
        text = row["tokens"].astype(np.int64)
        text = _closed_up(np.where(allowed[text], text, 0))
        for length in range(2, cut_to + 1):
            text = _kept_links(text, self.hashes, fields[length - 1], length)
        self.text = text

    def frequent(self, found: Patterns) -> np.ndarray:
        """Which patterns, or for want of a field of their length their longest parts with one, may be frequent."""
        columns = list(found.words.T)
        known = min(len(columns), len(self.fields))
        kept = np.ones(len(found), bool)
        for i in range(len(columns) - known + 1):
            kept &= holds(self.fields[known - 1], _phrase_hashes(self.hashes, columns[i : i + known]))
        return kept

    def patterns(self, index: WordIndex, most: int) -> Iterator[Patterns]:
        """Frequent patterns, length by length, growing on the right and the left in turn."""
        found = index.single_words()
        for length in range(2, most + 1):
            found = index.extended(found, left=length % 2 == 1)
            found = found.only(self.frequent(found))
            yield found


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            lang, words, tokens = (batch.column(name)[i] for name in ("lang", "words", "tokens"))
            yield {"lang": lang.as_py(), "words": words.values, "tokens": np.frombuffer(tokens.as_buffer(), np.int32)}


def _grams(fields: list, length: int):
    """Rows (h, n): 32 bits of the hash, and count, of the phrases of `length` words whose two shorter parts are frequent."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            shard = _Text(row, [f.value for f in fields], length - 1)
            if not len(shard.text):
                continue
            index = WordIndex(shard.text, len(shard.names) + 1, length)
            shorter = index.single_words()
            for shorter in shard.patterns(index, length - 1):
                pass
            found = index.extended(shorter, left=False)
            columns = list(found.words.T)
            if length > 2:
                tails = holds(shard.fields[length - 2], _phrase_hashes(shard.hashes, columns[1:]))
                found, columns = found.only(tails), [c[tails] for c in columns]
            h = _phrase_hashes(shard.hashes, columns).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(found.count.astype(np.int32))], ["h", "n"])

    return scan


def _merged(tables: list[pa.Table]) -> pa.Table:
    """One row for each phrase; a side keeps its word if all rows agree on it.

    Sides meet as numbers of their words, which are equal just where the words are: the least and the greatest of texts
    would be held once for each phrase and thread.
    """
    whole = pa.concat_tables(tables)
    numbered = {side: whole[side].combine_chunks().dictionary_encode() for side in ("left", "right")}
    for side, words in numbered.items():
        whole = whole.set_column(whole.column_names.index(side), side, words.indices)
    grouped = whole.group_by(["lang", "size", "phrase"], use_threads=False)
    summed = grouped.aggregate([("n", "sum")] + [(side, how) for side in numbered for how in ("min", "max")])
    sides = [
        pc.if_else(pc.equal(summed[f"{side}_min"], summed[f"{side}_max"]), pc.take(words.dictionary, summed[f"{side}_min"]), "")
        for side, words in numbered.items()
    ]
    columns = [summed["lang"], summed["size"], summed["phrase"], summed["n_sum"], *sides]
    return pa.table(columns, names=["lang", "size", "phrase", "n", "left", "right"])


def _phrases(fields: list, max_words: int):
    """PHRASES of the shards of a task, added up as far as HELD_PHRASES rows go."""

    def counted(row: dict) -> Iterator[pa.Table]:
        shard = _Text(row, [f.value for f in fields], 2)
        if not len(shard.text):
            return
        names = pa.concat_arrays([pa.array([""], pa.string()), shard.names])
        index = WordIndex(shard.text, len(names), max_words)
        for length, grown in enumerate(shard.patterns(index, max_words), 2):
            for at in range(0, len(grown), SLICE_PHRASES):
                found = grown.only(slice(at, at + SLICE_PHRASES))
                # A longer phrase than the longest is no candidate, so its neighbours do not matter.
                sides = [
                    index.only_neighbour(found, left) if length < max_words else np.zeros(len(found), np.int64)
                    for left in (True, False)
                ]
                columns = [
                    pa.array([row["lang"]] * len(found), pa.string()),
                    pa.array(np.full(len(found), length, np.int32)),
                    pc.binary_join_element_wise(*(names.take(pa.array(found.words[:, i])) for i in range(length)), " "),
                    pa.array(found.count.astype(np.int64)),
                    *(names.take(pa.array(side)) for side in sides),
                ]
                yield pa.table(columns, names=["lang", "size", "phrase", "n", "left", "right"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for table in (t for row in _rows(batches) for t in counted(row)):
            held.append(table)
            if sum(t.num_rows for t in held) > HELD_PHRASES:
                held = [_merged(held)]
                if held[0].num_rows > HELD_PHRASES * 3 // 4:
                    yield from held.pop().to_batches(SLICE_PHRASES)
        if held:
            yield from _merged(held).to_batches(SLICE_PHRASES)

    return scan


def phrase_counts(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    shard_words: int = SHARD_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """All words (lang, phrase, f), and the phrases of at least `min_count`: (lang, phrase, size, a, inner).

    `inner` says that a longer phrase of up to `max_words` words and the same count holds the phrase.
    """
    shards = pack(docs, text_col, lang_col, shard_words)
    context = docs.sparkSession.sparkContext
    listed = shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    words = staged(
        listed.groupBy("lang", F.col("w.words").alias("phrase")).agg(F.sum("w.counts").alias("f")), "phrase-words"
    )
    frequent = words.filter(F.col("f") >= min_count).select(F.xxhash64("lang", "phrase").alias("h"))
    fields = [context.broadcast(bit_field(frequent, FILTER_BITS))]
    texts = shards.select("lang", "words", "tokens")
    for length in range(2, min(max_words, SUMMED_WORDS) + 1):
        grams = texts.mapInArrow(lean(_grams(fields, length)), "h int, n int").groupBy("h").agg(F.sum("n").alias("n"))
        with arrow_rows(docs.sparkSession, BATCH_SHARDS):
            field = bit_field(grams.filter(F.col("n") >= min_count).select("h"), FILTER_BITS)
        fields.append(context.broadcast(field))
    # Each task adds up its shards first, so with few tasks a phrase is given out few times.
    together = texts.coalesce(2 * context.defaultParallelism)
    found = together.mapInArrow(lean(_phrases(fields, max_words)), PHRASES)

    def always(side: str):
        return (F.min(side) == F.max(side)) & (F.min(side) != "")

    summed = found.groupBy("lang", "phrase", "size").agg(
        F.sum("n").alias("a"), (always("left") | always("right")).alias("inner")
    )
    with arrow_rows(docs.sparkSession, BATCH_SHARDS):
        candidates = staged(summed.filter(F.col("a") >= min_count), "phrase-candidates")
    for field in fields:
        field.unpersist()
    return words, candidates


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    A phrase scores what its weakest cut scores: floor(1000 * a * n / (l * r)), exact in wide decimals.
    """
    words, phrases = phrase_counts(docs, text_col, lang_col, min_count, max_words, shard_words)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    counts = words.filter(F.col("f") >= min_count).unionByName(phrases.select("lang", "phrase", F.col("a").alias("f")))

    split = F.split("phrase", " ", -1)
    cuts = (
        phrases.filter(~F.col("inner"))
        .select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        .withColumn("head", F.array_join(F.slice(split, F.lit(1), F.col("k")), " "))
        .withColumn("tail", F.array_join(F.slice(split, F.col("k") + 1, F.col("size")), " "))
    )
    for name, of in (("l", "head"), ("r", "tail")):
        part = counts.select(F.col("lang"), F.col("phrase").alias(of), F.col("f").alias(name))
        cuts = cuts.join(part, ["lang", of])

    def wide(c: str):
        return F.col(c).cast("decimal(19,0)")

    score = F.call_function("div", wide("a") * wide("n") * SCORE_SCALE, wide("l") * wide("r"))
    weakest = F.min(F.struct(score.alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("cut")
    scored = (
        cuts.join(totals, "lang")
        .groupBy("lang", "phrase", "a", "n")
        .agg(weakest)
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    spread = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    within = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))
    ahead = spread.withColumn("rank", within).filter(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    ranked = ahead.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
