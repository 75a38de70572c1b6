"""Vector code compression by product codebooks, fitted with dual-tree Lloyd rounds on integers.

Every component x counts as the integer floor(4096 * x). Vectors are cut into equal consecutive parts; each part position
has a codebook of a few entries, which starts as that part of the vectors with the smallest ids. A round assigns every
part to its nearest entry and moves each entry to the floor of its parts' mean; entries that nobody chose stay.

Rows are packed once into blocks of at most `BLOCK_ROWS` rows; a block holds one tree per part position with boxes and
cached sums (`code_trees`). The blocks are written to the shared folder and read again by every round, so a lost executor
costs the tasks it ran. A round is one scan: tasks walk point tree against entry tree, add up sums and counts per entry, and
Spark sums them. What reaches the driver is one number per component of the codebooks; what goes out is the codebooks.

Defined cases: rows whose vector is null or holds null, NaN or infinite components are dropped; null ids come last, rows
that share an id follow each other by their components, and every one of them is encoded; with fewer rows than entries
the codebooks have that many entries; an empty table gives an empty result; null labels count as equal; further columns
are ignored. Vectors of different lengths, a length that does not divide into the parts, and components beyond
`LARGEST` in size (16384 before scaling; sums of squares would leave 64 bits) raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import code_trees
from tillroll.llm.common import staged

SCALE = 4096
LARGEST = 1 << 26
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK_ROWS = 4096
BLOCK_NUMBERS = 1 << 20
MOST_NUMBERS_A_PART = 512

TREE = "struct<order:binary,points:binary,boxes:binary,sums:binary>"


def whole_numbers(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, x) of the rows that count; x is an array of integers."""
    vec = F.col(vec_col)

    def counts(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def whole(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * float(SCALE))
        message = F.lit(f"components must stay below {LARGEST // SCALE} in size")
        return F.when(F.abs(scaled) < LARGEST, scaled.cast("int")).otherwise(F.raise_error(message).cast("int"))

    good = vectors.filter(vec.isNotNull() & F.coalesce(F.forall(vec, counts), F.lit(False)))
    return good.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.transform(vec, whole).alias("x")
    )


def _tree_columns(tree: code_trees.Tree) -> dict[str, bytes]:
    boxes = np.stack([tree.low, tree.high]).astype(np.int32)
    return {
        "order": tree.order.astype(np.int32).tobytes(),
        "points": tree.points.astype(np.int32).tobytes(),
        "boxes": boxes.tobytes(),
        "sums": tree.sums.tobytes(),
    }


def _tree_of(row: dict[str, bytes], rows: int) -> code_trees.Tree:
    points = np.frombuffer(row["points"], np.int32).astype(np.int64).reshape(rows, -1)
    low, high = np.frombuffer(row["boxes"], np.int32).astype(np.int64).reshape(2, -1, points.shape[1])
    sums = np.frombuffer(row["sums"], np.int64).reshape(-1, points.shape[1])
    return code_trees.Tree(np.frombuffer(row["order"], np.int32), points, low, high, sums)


def _blocks(length: int, parts: int):
    """Packs rows (vec_id, label, x) into blocks with their trees."""
    most = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(1, length)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def block(table: pa.Table) -> pa.RecordBatch:
            lengths = np.diff(table["x"].combine_chunks().offsets.to_numpy())
            if (lengths != length).any():
                raise ValueError(f"vectors of {sorted(set(lengths.tolist()))} components beside vectors of {length}")
            x = table["x"].combine_chunks().flatten().to_numpy().reshape(len(lengths), parts, -1)
            trees = [_tree_columns(code_trees.build(x[:, p])) for p in range(parts)]
            ids, labels = table["vec_id"].combine_chunks(), table["label"].combine_chunks()
            one = pa.array([0, len(lengths)], pa.int32())
            columns = [pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, labels)]
            kind = pa.struct([(n, pa.binary()) for n in ("order", "points", "boxes", "sums")])
            columns.append(pa.ListArray.from_arrays(pa.array([0, parts], pa.int32()), pa.array(trees, kind)))
            return pa.RecordBatch.from_arrays(columns, ["ids", "labels", "trees"])

        def waiting() -> int:
            return sum(b.num_rows for b in kept)

        for batch in batches:
            kept.append(batch)
            while waiting() >= most:
                table = pa.Table.from_batches(kept)
                yield block(table.slice(0, most))
                kept = table.slice(most).to_batches()
        if waiting():
            yield block(pa.Table.from_batches(kept))

    return pack


def _round(books: list[np.ndarray]):
    """Sums and counts of one round: rows (slot, n); a slot stands for one component of one entry, or for its count."""
    entries, width = books[0].shape

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(books), entries, width + 1), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                rows = len(batch.column(0)[i].values)
                for p, tree in enumerate(batch.column(1)[i].as_py()):
                    found = code_trees.assign(_tree_of(tree, rows), books[p])
                    totals[p, :, :width] += found.sums
                    totals[p, :, width] += found.counts
        slots = np.flatnonzero(totals.ravel())
        columns = [pa.array(slots.astype(np.int32)), pa.array(totals.ravel()[slots])]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "n"])

    return scan


def _encode(books: list[np.ndarray]):
    """Rows (vec_id, label, code, error) of blocks."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column(0)[i].values, batch.column(1)[i].values
                codes = np.zeros((len(ids), len(books)), np.uint8)
                error = np.zeros(len(ids), np.int64)
                for p, row in enumerate(batch.column(2)[i].as_py()):
                    tree = _tree_of(row, len(ids))
                    owner = code_trees.assign(tree, books[p]).owner
                    away = tree.points - books[p][owner]
                    codes[tree.order, p] = owner
                    error[tree.order] += (away * away).sum(axis=1)
                texts = codes.tobytes().hex()
                step = 2 * len(books)
                code = pa.array([texts[k : k + step] for k in range(0, len(texts), step)], pa.string())
                yield pa.RecordBatch.from_arrays([ids, labels, code, pa.array(error)], ["vec_id", "label", "code", "error"])

    return scan


def first_books(numbers: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """One array (entries, width) per part position, from the rows with the smallest ids; empty without rows."""
    first = numbers.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    if not first:
        return []
    lengths = {len(r.x) for r in first}
    if len(lengths) > 1 or max(lengths) % parts:
        raise ValueError(f"vectors of {sorted(lengths)} components do not divide into {parts} equal parts")
    width = max(lengths) // parts
    if width > MOST_NUMBERS_A_PART:
        raise ValueError(f"parts of {width} components; at most {MOST_NUMBERS_A_PART} keep squared distances in 64 bits")
    table = np.array([r.x for r in first], dtype=np.int64).reshape(len(first), parts, width)
    return [np.ascontiguousarray(table[:, p]) for p in range(parts)]


def pack(numbers: DataFrame, length: int, parts: int = PARTS) -> DataFrame:
    """`numbers` as blocks in the shared folder: (ids, labels, trees)."""
    kinds = {f.name: f.dataType.simpleString() for f in numbers.schema}
    schema = f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, trees array<{TREE}>"
    return staged(numbers.mapInArrow(_blocks(length, parts), schema), "code-blocks")


def fit(blocks: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after so many rounds."""
    entries, width = books[0].shape
    for _ in range(rounds):
        sums = blocks.select("ids", "trees").mapInArrow(_round(books), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
        totals = np.zeros(len(books) * entries * (width + 1), np.int64)
        for row in sums.collect():
            totals[row.slot] = row.n
        totals = totals.reshape(len(books), entries, width + 1)
        moved = []
        for book, total in zip(books, totals):
            count = total[:, width:]
            moved.append(np.where(count > 0, total[:, :width] // np.maximum(count, 1), book))
        books = moved
    return books


def books_digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every row that counts, and the codebooks; `entries` is 256 at most."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte a part: 1 to 256 entries")
    numbers = whole_numbers(vectors, id_col, vec_col, label_col)
    books = first_books(numbers, parts, entries)
    if not books:
        schema = T.StructType([numbers.schema["vec_id"], numbers.schema["label"]]).add("code", "string").add("error", "long")
        return vectors.sparkSession.createDataFrame([], schema), books
    blocks = pack(numbers, parts * books[0].shape[1], parts)
    books = fit(blocks, books, rounds)
    kinds = {f.name: f.dataType.simpleString() for f in numbers.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return blocks.mapInArrow(_encode(books), schema), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """`coded` with `label_error`, the error summed over equal labels; labels are summed before anything is joined."""
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(per_label, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
