"""Byte-pair encoding with a pair occurrence index, for vocabularies with word ends.

The distinct words of a block of texts are laid out as one chain of symbols. `encode_words` maps each adjacent pair that
has a rank to all its positions, applies the active ranks in ascending order to all their positions at once, and updates
only the lists of the pairs that each merge touches. A merge can only give rise to pairs of higher rank, so one ascending
sweep over the ranks equals merging word by word. Words seen before in the task come from a table of bounded size.

The vocabulary file is a parameter: a JSON file with a BPE model, end-of-word suffix, and special tokens. Text is brought
to NFC, lower-cased character by character, split at white space and into letters, single digits, contractions and
other signs, as the file's normaliser and pre-tokenizer say; strings of special tokens in a text become their ids.
Decoding joins the tokens by spaces, since the file names no decoder.

Defined cases: a null text is the empty text and has no tokens; rows are encoded one by one, so ids may repeat or be
null; further columns are ignored, or carried along by `encode`.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import lean

VOCABULARY = "word_bpe_49k.json"
# Bounds on memory: a block's words and chain cost some 40 bytes a character, a word of the table some 400 bytes.
BLOCK_CHARS = 1 << 20
KNOWN_WORDS = 150_000
NO_RANK = 1 << 30
GONE = -1
NOWHERE = np.zeros(0, dtype=np.int64)

# Unicode white space, and the pre-tokenizer's pattern.
NOT_SPACE = regex.compile(r"[^\t-\r \x85\xa0  -     　]+")
SEPARATORS = regex.compile("[\x1c-\x1f]")
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBpe:
    """The parsed vocabulary with its merges, and the words encoded so far."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merged = np.array([self.vocab[a + b] for a, b in merges], dtype=np.int64)
        keys = np.array([self.vocab[a] << 32 | self.vocab[b] for a, b in merges], dtype=np.int64)
        self.pair_ranks = np.argsort(keys, kind="stable")
        self.pair_keys = keys[self.pair_ranks]
        self.doubled = [a == b for a, b in merges]
        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([self.vocab[c + self.suffix] for c in letters], dtype=np.int64)
        names = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.raw_of: dict[str, bytes] = {}
        self.text_of: dict[str, str] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, `NO_RANK` where the pair never merges."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    def encode_words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces (pre-tokens, none empty) in one array, and where the ids of each piece end."""
        raw = [p.encode() for p in pieces]
        if not raw:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ends = np.cumsum([len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        size = len(symbol)
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        after[ends - 1] = -1
        before[ends[:-1]] = -1
        rank_at = np.full(size, NO_RANK)
        inside = np.flatnonzero(after >= 0)
        rank_at[inside] = self._rank(symbol[inside], symbol[inside + 1])

        # The index: rank of a pair -> its positions. First those of the bare text, then those that merges give rise to.
        found = np.flatnonzero(rank_at < NO_RANK)
        found = found[np.argsort(rank_at[found], kind="stable")]
        names, starts = np.unique(rank_at[found], return_index=True)
        initial = dict(zip(names.tolist(), np.split(found, starts[1:])))
        later: dict[int, list[int]] = {}
        active = names.tolist()
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            at = initial.pop(rank, NOWHERE)
            if rank in later:
                at = np.unique(np.concatenate([at, later.pop(rank)]))
            at = at[rank_at[at] == rank]
            if not len(at):
                continue
            if self.doubled[rank]:  # "aaa": positions overlap, the left one wins
                free, kept = -1, []
                for p in at.tolist():
                    if p != free:
                        kept.append(p)
                        free = after[p]
                at = np.array(kept)
            gone = after[at]
            beyond = after[gone]
            symbol[at], symbol[gone] = self.merged[rank], GONE
            rank_at[gone] = NO_RANK
            after[at] = beyond
            rank_at[at] = NO_RANK
            right = beyond >= 0
            before[beyond[right]] = at[right]
            left = before[at]
            changed = np.concatenate([at[right], left[left >= 0]])
            if len(changed):
                ranks = self._rank(symbol[changed], symbol[after[changed]])
                rank_at[changed] = ranks
                live = ranks < NO_RANK
                for r, p in zip(ranks[live].tolist(), changed[live].tolist()):
                    if r in later:
                        later[r].append(p)
                    else:
                        later[r] = [p]
                        if r not in initial:
                            heapq.heappush(active, r)
        alive = symbol != GONE
        return symbol[alive].astype(np.uint32), np.cumsum(alive)[ends - 1]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])

    def learn(self, words: list[str]) -> None:
        """Put the ids and the decoded form of every word (no white space inside) into the tables."""
        pieces: dict[str, int] = {}
        of_word = []
        for word in words:
            parts = (word,) if word.isalpha() else PIECES.findall(word)
            of_word.append([pieces.setdefault(p, len(pieces)) for p in parts])
        ids, ends = self.encode_words(list(pieces))
        raw, tokens, ends = ids.astype("<u4").tobytes(), list(map(self.tokens.__getitem__, ids.tolist())), [0, *ends.tolist()]
        raws = [raw[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]
        texts = [" ".join(tokens[a:b]) for a, b in zip(ends, ends[1:])]
        for word, parts in zip(words, of_word):
            if len(parts) == 1:
                self.raw_of[word], self.text_of[word] = raws[parts[0]], texts[parts[0]]
            else:
                self.raw_of[word] = b"".join([raws[p] for p in parts])
                self.text_of[word] = " ".join([texts[p] for p in parts])

    def words(self, text: str) -> list[str]:
        """Normalised words; a special token stands for itself behind a space, which no word can contain."""
        if self.specials is None or not any(s in text for s in self.special):
            return _plain_words(text)
        found = []
        for part in self.specials.split(text):
            found += [" " + part] if part in self.special else _plain_words(part)
        return found

    def encode_block(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Ids as little-endian 32-bit numbers and the decoded text, of each text."""
        split = [self.words(t) for t in texts]
        if len(self.raw_of) > KNOWN_WORDS:
            self.raw_of.clear()
            self.text_of.clear()
        new = set().union(*split).difference(self.raw_of)
        for word in [w for w in new if w[0] == " "]:
            new.discard(word)
            self.raw_of[word], self.text_of[word] = np.array([self.special[word[1:]]], dtype="<u4").tobytes(), word[1:]
        self.learn(list(new))
        for words in split:
            yield b"".join(map(self.raw_of.__getitem__, words)), " ".join(map(self.text_of.__getitem__, words))


def _plain_words(text: str) -> list[str]:
    """NFC, then lower case by character: a capital sigma never becomes a final one."""
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    # str.split also splits at the four information separators, which are not white space here.
    return NOT_SPACE.findall(text) if SEPARATORS.search(text) else text.split()


def load(path: str) -> WordBpe:
    with open(path, encoding="utf-8") as file:
        return WordBpe(json.load(file))


def encoded(
    coder: WordBpe, batches: Iterator[pa.RecordBatch], names: list[str], with_ids: bool, with_text: bool
) -> Iterator[pa.RecordBatch]:
    """The rows of `encode` for batches (whole, body), block by block; one batch and one block are held at a time."""
    for batch in batches:
        low = 0
        while low < batch.num_rows:
            high, chars = low, 0
            texts = []
            while high < batch.num_rows and (chars < BLOCK_CHARS or not texts):
                texts.append(batch.column(1)[high].as_py())
                chars += len(texts[-1])
                high += 1
            counts, id_digests, text_digests, ids, decoded = [], [], [], [], []
            for raw, text in coder.encode_block(texts):
                counts.append(len(raw) // 4)
                id_digests.append(hashlib.sha256(raw).hexdigest())
                text_digests.append(hashlib.sha256(text.encode()).hexdigest())
                if with_ids:
                    ids.append(np.frombuffer(raw, dtype="<u4").astype(np.int32))
                if with_text:
                    decoded.append(text)
            columns = [
                batch.column(0).slice(low, high - low),
                pa.array(counts, pa.int64()),
                pa.array(id_digests, pa.string()),
                pa.array(text_digests, pa.string()),
            ]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            if with_text:
                columns.append(pa.array(decoded, pa.string()))
            del texts, ids, decoded
            yield pa.RecordBatch.from_arrays(columns, names)
            # Columns of a batch share its memory, which goes before the next batch comes.
            del columns
            low = high
        del batch


def encode(
    docs: DataFrame,
    vocabulary: str,
    text_col: str = "text",
    with_ids: bool = True,
    with_text: bool = False,
    carry: list[str] | None = None,
) -> DataFrame:
    """(whole, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]); `whole` is a struct of the columns `carry`
    (default: all), so no names can clash.

    The vocabulary file goes to the executors once, by `SparkContext.addFile`.
    """
    context = docs.sparkSession.sparkContext
    context.addFile(vocabulary)
    name = vocabulary.rsplit("/", 1)[-1]
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("whole"),
        F.coalesce(F.col(text_col), F.lit("")).alias("body"),
    )
    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    if with_text:
        fields.append(T.StructField("decoded", T.StringType()))
    schema = T.StructType([packed.schema["whole"], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from encoded(load(SparkFiles.get(name)), batches, schema.names, with_ids, with_text)

    return packed.mapInArrow(lean(run), schema)
