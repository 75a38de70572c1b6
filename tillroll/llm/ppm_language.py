"""Language identification by prediction by partial matching (PPM) over bytes.

Every language has a tree of byte contexts up to `MAX_ORDER` bytes with frozen counts. A byte that its context has seen
costs -log2(count / (total + distinct)) bits; otherwise the context pays the escape, -log2(distinct / (total +
distinct)), and the next shorter context is asked, down to eight bits for a byte never seen at all (method C without
exclusion). The code length of a text is the exact sum over all its bytes; the language with the shortest code wins, and
its posterior under equal priors is the score.

Training: at most about `SAMPLE_DOCS` labelled rows per language, taken by a hash of id and text, each whole. The counts are
made in the tasks and summed by Spark; what reaches the driver is bounded by that sample, not by the corpus. Costs are
worked out once for every (context, byte, language), bytes that training never saw share one class, and a text is scored
by following one automaton over the contexts of all languages, in slices of bounded size.

Defined cases: a null text, or one without a letter, is `und` with score 0; so is every text when nothing could be
learned. Rows with a null id or a null language are never learned from. Ties go to the first language by name. Rows are
predicted one by one, so repeated ids do not matter; further columns are ignored, or carried along by `predict`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import give_back, lean

UNKNOWN = "und"
MAX_ORDER = 3
SAMPLE_DOCS = 3000
SLICE = 1 << 19
BLOCK_BYTES = 1 << 21
CONTEXTS = 512  # a bound on the driver's memory alone
SEED = 4
LETTER = r"\p{L}"


@dataclass
class Model:
    """Contexts of all languages in one automaton; node 0 is the empty context."""

    languages: list[str]
    order: int
    symbol: np.ndarray  # byte -> class, 0 for bytes that training never saw
    step: np.ndarray  # (node, class) -> node of the longest known suffix
    cost: np.ndarray  # (node * classes + class, language) -> bits

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of every text in every language."""
        pad = bytes(self.order)
        starts = np.cumsum([0] + [len(t) + self.order for t in texts])
        data = self.symbol[np.frombuffer(pad.join([b"", *texts]) if texts else b"", dtype=np.uint8)]
        classes, totals = self.step.shape[1], np.zeros((len(texts), len(self.languages)))
        for low in range(0, len(data), SLICE):
            high = min(low + SLICE, len(data))
            nodes = np.zeros(high - low, dtype=np.int32)
            for k in range(1, self.order + 1):
                # The longest known context of at most k bytes ends one byte before; the first bytes of all are padding.
                back = self.order - k + 1
                if low:
                    seen = data[low - back : high - back]
                else:
                    seen = np.concatenate([np.zeros(back, data.dtype), data[: max(0, high - back)]])[: high - low]
                nodes = self.step[nodes, seen]
            bits = np.take(self.cost, nodes * np.int64(classes) + data[low:high], axis=0)
            first = int(np.searchsorted(starts, low, "right")) - 1
            inside = starts[first + 1 : np.searchsorted(starts, high, "left")]
            cuts = np.concatenate([[low], inside]) - low
            pads = (np.concatenate([[starts[first]], inside])[:, None] + np.arange(self.order)).ravel()
            bits[pads[(pads >= low) & (pads < high)] - low] = 0
            totals[first : first + len(cuts)] += np.add.reduceat(bits, cuts, axis=0, dtype=np.float64)
        return totals

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its posterior."""
        bits = self.bits(texts)
        best = bits.argmin(axis=1)
        ahead = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)
        return best, 1.0 / np.exp2(-ahead).sum(axis=1)


def learnable(id_col: Column) -> Column:
    """The rows that may be learned from; null for a null id."""
    return F.crc32(id_col.cast("string")) % 3 != 1


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of one task: gram packs MAX_ORDER context bytes and the byte itself."""
    for batch in batches:
        langs, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        by_lang: dict[int, list[bytes]] = {}
        for lang, body in zip(langs, bodies):
            by_lang.setdefault(lang, []).append(body)
        for lang, texts in by_lang.items():
            for low in range(0, len(texts), 256):
                grams = []
                for text in texts[low : low + 256]:
                    data = np.frombuffer(bytes(MAX_ORDER) + text, dtype=np.uint8).astype(np.int64)
                    n = len(data) - MAX_ORDER
                    grams.append(sum(data[k : k + n] << (8 * (MAX_ORDER - k)) for k in range(MAX_ORDER + 1)))
                values, counts = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), lang, np.int32)), pa.array(values), pa.array(counts.astype(np.int64))],
                    ["lang", "gram", "n"],
                )


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
) -> Model:
    """Learn from labelled rows that `learnable` admits: about `sample_docs` whole texts of each language."""
    labelled = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    ).filter(F.col("lang").isNotNull() & learnable(F.col("id")) & F.col("text").isNotNull())
    rows = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(rows)
    if not rows:
        return build_model([], *(np.zeros(0, np.int64) for _ in range(3)))
    share = F.create_map(*[F.lit(x) for lang, n in rows.items() for x in (lang, min(1.0, sample_docs / n))])
    code = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("id"), F.col("text")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.filter(draw < share[F.col("lang")])
    bodies = sample.select(code[F.col("lang")].alias("lang"), F.col("text").cast("binary").alias("body"))
    summed = bodies.mapInArrow(lean(_gram_counts), "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # One row per byte context of the sample, as columns; the text of a language name never travels.
    counts = summed.toArrow()
    model = build_model(languages, *(counts[c].to_numpy() for c in ("lang", "gram", "n")))
    del counts
    give_back()
    return model


def build_model(languages: list[str], lang_of: np.ndarray, grams: np.ndarray, counts: np.ndarray, order: int = MAX_ORDER) -> Model:
    """The automaton and its costs from columns (number of the language, gram, count)."""
    weights = counts.astype(np.float64)
    bytes_of = np.stack([(grams >> (8 * (order - k))) & 255 for k in range(order + 1)], axis=1).astype(np.uint8)
    symbol = np.zeros(256, dtype=np.uint8)
    present = np.unique(np.append(bytes_of, 0))[:255]
    symbol[present] = np.arange(1, len(present) + 1)
    classes = len(present) + 1
    coded = symbol[bytes_of]

    # Contexts of each length as packed classes; ids grow with the length, the empty context is 0.
    keys, ids, base = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 1
    packed = np.zeros(len(grams), np.int64)
    context = [packed]
    for k in range(1, order + 1):
        packed = sum((coded[:, order - j].astype(np.int64) * classes ** (j - 1) for j in range(1, k + 1)), np.zeros(len(grams), np.int64))
        context.append(packed)
        keys.append(np.unique(packed))
        ids.append(base + np.arange(len(keys[-1])))
        base += len(keys[-1])

    def find(k: int, wanted: np.ndarray) -> np.ndarray:
        """Node of the context `wanted` of length k, or of its longest known suffix."""
        at = np.minimum(np.searchsorted(keys[k], wanted), max(0, len(keys[k]) - 1))
        known = len(keys[k]) > 0 and keys[k][at] == wanted
        if k == 0:
            return np.zeros(len(wanted), np.int64)
        return np.where(known, ids[k][at] if len(keys[k]) else 0, find(k - 1, wanted % classes ** (k - 1)))

    step = np.zeros((base, classes), dtype=np.int32)
    cost = np.full((base, classes, max(1, len(languages))), 8.0, dtype=np.float32)
    every = np.arange(classes)
    for k in range(order + 1):
        if not len(keys[k]):
            continue
        if k < order:
            for low in range(0, len(keys[k]), CONTEXTS):
                grown = (keys[k][low : low + CONTEXTS, None] * classes + every).ravel()
                step[ids[k][low : low + CONTEXTS]] = find(k + 1, grown).reshape(-1, classes)
        seen_by = []
        for lang in range(len(languages)):
            mine = np.flatnonzero(lang_of == lang)
            at = np.searchsorted(keys[k], context[k][mine])
            by_context = np.argsort(at, kind="stable")
            seen_by.append((mine[by_context], at[by_context]))
        # A few contexts at a time: the tallies and their logarithms are many times as large as the costs themselves.
        for low in range(0, len(keys[k]), CONTEXTS):
            nodes = ids[k][low : low + CONTEXTS]
            if k:
                cost[nodes] = cost[find(k - 1, keys[k][low : low + CONTEXTS] % classes ** (k - 1))]
            for lang, (rows, at) in enumerate(seen_by):
                here = slice(*np.searchsorted(at, [low, low + CONTEXTS]))
                tally = np.zeros((len(nodes), classes))
                np.add.at(tally, (at[here] - low, coded[rows[here], order]), weights[rows[here]])
                total, distinct = tally.sum(axis=1), (tally > 0).sum(axis=1)
                seen = np.flatnonzero(total)
                tally, total, distinct = tally[seen], total[seen, None], distinct[seen, None]
                with np.errstate(divide="ignore"):
                    coded_bits = -np.log2(tally / (total + distinct))
                escape = -np.log2(distinct / (total + distinct))
                shorter = cost[nodes[seen], :, lang]
                cost[nodes[seen], :, lang] = np.where(tally > 0, coded_bits, escape + shorter)
    return Model(list(languages), order, symbol, step, cost.reshape(base * classes, -1))


def scored(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of `predict` for batches (whole, body), block by block; one batch and one block are held at a time."""
    for batch in batches:
        low = 0
        while low < batch.num_rows:
            high, size, bodies = low, 0, []
            while high < batch.num_rows and (size < BLOCK_BYTES or not bodies):
                bodies.append(batch.column(1)[high].as_py())
                size += len(bodies[-1] or b"")
                high += 1
            rows = [i for i, b in enumerate(bodies) if b is not None] if model.languages else []
            names, scores = [UNKNOWN] * len(bodies), np.zeros(len(bodies))
            if rows:
                best, scores[rows] = model.predict([bodies[i] for i in rows])
                for i, lang in zip(rows, best):
                    names[i] = model.languages[lang]
            del bodies
            whole = batch.column(0).slice(low, high - low)
            yield pa.RecordBatch.from_arrays(
                [whole, pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["whole", "lang_pred", "score"]
            )
            # Columns of a batch share its memory, which goes before the next batch comes.
            del whole
            low = high
        del batch


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(whole, lang_pred, score): `whole` is a struct of the columns `carry` (default: all), so no names can clash."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = F.when(F.col(text_col).rlike(LETTER), F.col(text_col)).cast("binary")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("whole"), body.alias("body"))
    schema = T.StructType(
        [packed.schema["whole"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scored(shared.value, batches)

    return packed.mapInArrow(lean(score), schema)
