"""Vectors as short codes: one codebook per part of the vector, fitted by Lloyd's rounds.

Every part of every vector is a member of the entry nearest to it. Members lie in blocks, owned by
(position, entry, salt); a partition holds the blocks of some owners. In a round each owner sums
its resident members, 128 totals or so make the new codebooks, and every block is assigned again
where it lies. Only parts whose entry has changed go through the next shuffle; the others stay in
their partition, with which the arrivals are united without moving it. Salts bound what one entry
has in one place. All sums are whole numbers, so the order of members does not matter.

Rounds are linked by lineage: blocks that stay are kept in memory or on disk and are made again
from the arrivals' shuffle files if an executor is lost. Every ``CUT_ROUNDS`` rounds a checkpoint
cuts the lineage.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import attach, staged
from comarca.sources import scratch_path

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Members of one entry and position in one place, on average at most.
MEMBERS = 1 << 16
# Rows that share a salt when blocks are first cut.
BLOCK_ROWS = 1 << 11
CUT_ROUNDS = 8

Owner = tuple[int, int, int]

BLOCKS = "position int, entry int, salt int, wide boolean, data binary"
CODED = "id long, label string, code string, error long"


class Codebooks(NamedTuple):
    """One array (entries, width) of whole numbers for each part of the vector."""

    books: list[np.ndarray]
    dimension: int
    scale: int

    def sha256(self) -> str:
        """Of all components' decimal digits by part, entry and place, joined by commas."""
        text = ",".join(str(int(x)) for book in self.books for x in book.ravel())
        return hashlib.sha256(text.encode()).hexdigest()


def _components(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vectors: DataFrame, vector_column: str) -> DataFrame:
    """Rows whose vector is there, with all components known and finite."""
    vector = F.col(f"`{vector_column}`")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(vector.isNotNull() & finite)


def bounds(dimension: int, parts: int) -> list[int]:
    return [k * dimension // parts for k in range(parts + 1)]


def nearest(members: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each member's nearest entry, the lower of equally near ones, and its squared distance."""
    best = np.zeros(len(members), dtype=np.int64)
    least = np.full(len(members), np.iinfo(np.int64).max)
    for entry, row in enumerate(book):
        distance = np.square(members - row).sum(axis=1)
        closer = distance < least
        best[closer], least[closer] = entry, distance[closer]
    return best, least


def _matrix(column: pa.ListArray, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dimension)


def _packed(members: np.ndarray) -> tuple[bool, bytes]:
    """Members as 32-bit numbers where they fit."""
    wide = bool(len(members)) and bool(np.abs(members).max(initial=0) >= 1 << 31)
    return wide, members.astype(np.int64 if wide else np.int32).tobytes()


def _unpacked(wide: bool, data: bytes, width: int) -> np.ndarray:
    members = np.frombuffer(data, np.int64 if wide else np.int32).astype(np.int64)
    return members.reshape(-1, width) if width else np.empty((len(members), 0), np.int64)


def _cut(books: list[np.ndarray], dimension: int, salts: int):
    """Cut rows into blocks of parts, each with the entry nearest to it in the first codebooks."""
    cuts = bounds(dimension, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                rows = _matrix(batch.column("vector").slice(at, BLOCK_ROWS), dimension)
                found, salt = [], salt + 1
                for position, book in enumerate(books):
                    members = np.ascontiguousarray(rows[:, cuts[position] : cuts[position + 1]])
                    entries = nearest(members, book)[0]
                    for entry in np.unique(entries):
                        block = (position, int(entry), salt % salts, *_packed(members[entries == entry]))
                        found.append(dict(zip(("position", "entry", "salt", "wide", "data"), block, strict=True)))
                kinds = [("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()), ("wide", pa.bool_()), ("data", pa.binary())]
                yield pa.RecordBatch.from_pylist(found, pa.schema(kinds))

    return run


class Place:
    """Which partition an owner's blocks lie in: the salts and positions of one entry follow each
    other, so that a hot entry is spread evenly."""

    def __init__(self, parts: int, salts: int):
        self.parts, self.salts = parts, salts

    def __call__(self, owner: Owner) -> int:
        position, entry, salt = owner
        return position + self.parts * (salt + self.salts * entry)


Block = tuple[bool, bytes]
# An owner, the entry that its block now belongs to, and the block.
Assigned = tuple[Owner, tuple[int, Block]]


def _gathered(blocks: Iterable[tuple[Owner, Block]], widths: list[int]) -> Iterator[tuple[Owner, np.ndarray]]:
    """The members of each owner of a partition in one array."""
    held: dict[Owner, list[np.ndarray]] = defaultdict(list)
    for owner, (wide, data) in blocks:
        held[owner].append(_unpacked(wide, data, widths[owner[0]]))
    while held:
        owner, members = held.popitem()
        yield owner, np.concatenate(members)


def _reassign(books: list[np.ndarray], blocks: Iterable[tuple[Owner, Block]]) -> Iterator[Assigned]:
    """Assign the members of a partition again, under the owner that has them still."""
    for owner, members in _gathered(blocks, [book.shape[1] for book in books]):
        entries = nearest(members, books[owner[0]])[0]
        for entry in np.unique(entries):
            yield owner, (int(entry), _packed(members[entries == entry]))


def _sums(widths: list[int], blocks: Iterable[tuple[Owner, Block]]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """For each entry with members in a partition, the sums of their components and their number."""
    totals: dict[tuple[int, int], np.ndarray] = {}
    for (position, entry, _), (wide, data) in blocks:
        members = _unpacked(wide, data, widths[position])
        total = np.append(members.sum(axis=0), len(members))
        totals[position, entry] = totals.get((position, entry), 0) + total
    yield from totals.items()


def _stays(record: Assigned) -> bool:
    return record[1][0] == record[0][1]


def _moves(record: Assigned) -> bool:
    return not _stays(record)


def _block(assigned: tuple[int, Block]) -> Block:
    return assigned[1]


def _to_new_owner(record: Assigned) -> tuple[Owner, Block]:
    (position, _, salt), (entry, block) = record
    return (position, entry, salt), block


def migrated(assigned: RDD[Assigned], place: Place, partitions: int) -> RDD[tuple[Owner, Block]]:
    """Blocks under their new owners. Those that stay are not shuffled: filters and new values keep
    the partitioning, and a union of two tables partitioned alike is taken partition by partition."""
    resident = assigned.filter(_stays).mapValues(_block)
    arriving = assigned.filter(_moves).map(_to_new_owner).partitionBy(partitions, place)
    return resident.union(arriving)


def first_codebooks(kept: DataFrame, parts: int, entries: int, scale: int) -> Codebooks:
    """The parts of the vectors with the smallest ids; ``kept`` has id and vector."""
    ordered = kept.orderBy(F.col("id").asc_nulls_last(), "vector")
    first = ordered.limit(1).collect()
    dimension = len(first[0]["vector"]) if first else 0
    rows = [row["vector"] for row in ordered.where(F.size("vector") == dimension).limit(entries).collect()]
    start = np.array(rows, dtype=np.int64).reshape(len(rows), dimension)
    cuts = bounds(dimension, parts)
    return Codebooks([start[:, a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], dimension, scale)


def _scaled(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    kept = usable(vectors, vector_column)
    return kept.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), _components(F.col(f"`{vector_column}`"), scale).alias("vector")
    )


def fit_codebooks(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, members: int = MEMBERS,
) -> Codebooks:
    """Fit one codebook per part on all usable vectors.

    A component x counts as floor(``scale`` * x). Vectors are cut into ``parts`` consecutive parts, equal ones
    if the dimension allows. Codebooks start as the parts of the ``entries`` vectors with the
    smallest ids (null ids last, equal ids by vector; fewer vectors make smaller codebooks). A round
    assigns every part to the nearest entry, the lower of equally near ones, and moves every
    entry with members to the floor of their mean. Without a usable vector the codebooks are empty.
    Vectors of another dimension than the one with the smallest id are left out. Exact while squared
    distances stay below 2**63, as with scaled components below 2**27 in 64 dimensions. Repeated rows count as often as
    they occur. The driver holds the codebooks and one sum per entry.
    """
    spark = vectors.sparkSession
    kept = _scaled(vectors, id_column, vector_column, scale)
    found = first_codebooks(kept, parts, entries, scale)
    books, widths = found.books, [book.shape[1] for book in found.books]
    total = kept.where(F.size("vector") == found.dimension).count() if found.dimension else 0
    if not total:
        return found
    salts = -(-total // members)
    partitions = min(parts * entries * salts, max(spark.sparkContext.defaultParallelism, -(-parts * total // members)))
    place = Place(parts, salts)

    rows = kept.where(F.size("vector") == found.dimension).select("vector")
    blocks = rows.mapInArrow(_cut(books, found.dimension, salts), BLOCKS).rdd
    state = blocks.map(lambda r: ((r[0], r[1], r[2]), (r[3], bytes(r[4])))).partitionBy(partitions, place)
    before: RDD | None = None
    for number in range(1, rounds + 1):
        sums = state.mapPartitions(partial(_sums, widths)).reduceByKey(np.add, min(partitions, parts)).collectAsMap()
        books = [book.copy() for book in books]
        for (position, entry), total_of in sums.items():
            books[position][entry] = total_of[:-1] // total_of[-1]
        if before is not None:
            before.unpersist()
        if number == rounds:
            break
        assigned = state.mapPartitions(partial(_reassign, books), preservesPartitioning=True)
        assigned.persist(StorageLevel.MEMORY_AND_DISK)
        if number % CUT_ROUNDS == 0:
            _checkpoint(assigned)
        state, before = migrated(assigned, place, state.getNumPartitions()), assigned
    return Codebooks(books, found.dimension, scale)


def _checkpoint(blocks: RDD) -> None:
    """Cut the lineage in the shared folder; a checkpointed table keeps its partitioning."""
    if not blocks.context.getCheckpointDir():
        from pyspark.sql import SparkSession

        blocks.context.setCheckpointDir(scratch_path(SparkSession.getActiveSession(), "rounds"))
    blocks.checkpoint()


def _coded(found: Codebooks):
    cuts = bounds(found.dimension, len(found.books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                rows = _matrix(batch.column("vector"), found.dimension)
                codes = np.empty((len(rows), len(found.books)), dtype=np.uint8)
                error = np.zeros(len(rows), dtype=np.int64)
                for position, book in enumerate(found.books):
                    members = np.ascontiguousarray(rows[:, cuts[position] : cuts[position + 1]])
                    codes[:, position], distance = nearest(members, book)
                    error += distance
                columns = [batch.column("id"), batch.column("label"), pa.array([row.tobytes().hex() for row in codes]), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    return run


def encode_vectors(
    vectors: DataFrame, found: Codebooks, id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """One row per usable vector: id, code (an entry's index per part, two hex digits each), error
    (squared distances summed over parts), label_error (errors summed over equal labels, nulls
    together). Vectors of another dimension than the codebooks' are left out. Codebooks have at
    most 256 entries. A frequent label is summed in parts and joined where its rows lie.
    """
    vector = F.col(f"`{vector_column}`")
    kept = usable(vectors, vector_column).where(F.size(vector) == found.dimension)
    label = F.to_json(F.struct(F.col(f"`{label_column}`").alias("label"))).alias("label")
    rows = kept.select(F.col(f"`{id_column}`").cast("long").alias("id"), label, _components(vector, found.scale).alias("vector"))
    coded = staged(rows.mapInArrow(_coded(found), CODED), "codes")
    groups = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("size"))
    return attach(coded, staged(groups, "label_errors"), "label", "size").select("id", "code", "error", "label_error")
