"""Hard-negative mining with exact scores by the method of the Four Russians."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from postlark.llm.clusters import finite, integers
from postlark.session import stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST_PERCENT = 80  # of the positive's score
LARGEST = 2**24  # components beyond are taken for it, so that every score fits a long
ROWS_PER_BLOCK = 8192
ANCHORS_PER_BLOCK = 4096
COMPONENTS_AT_ONCE = 4096  # of the anchors whose tables are held at a time
ROWS_AT_ONCE = 1024

CANDIDATE = "row long, id long, label long, planes binary"
BEST = "a_row long, positive_row long, positive_id long, positive_score long"
MINED = f"{BEST}, negative_row long, negative_id long, negative_score long"


def _padded(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors as rows of a matrix, shorter ones followed by zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), flat.dtype)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def bit_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """(row, plane, byte): the bits of each plane, least first, of eight components to a byte; the last plane is the sign."""
    bits = np.stack([(vectors >> p) & 1 for p in range(planes)], axis=1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little")


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(group, byte, anchor): for every group of eight components the sums over all its subsets."""
    n, dims = anchors.shape
    groups = -(-dims // 8)
    whole = np.zeros((n, groups * 8), kind)
    whole[:, :dims] = anchors
    table = np.zeros((groups, 256, n), kind)
    for i in range(8):
        table[:, 1 << i:2 << i] = table[:, :1 << i] + whole[:, i::8].T[:, None, :]
    return table


def scores(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(row, anchor): the inner products. Each plane looks its bytes up in the tables; from the sign plane down, what has
    been added is doubled and the next plane added to it."""
    total = np.zeros((len(planes), table.shape[2]), table.dtype)
    part, found = np.empty_like(total), np.empty_like(total)
    for p in range(planes.shape[1] - 1, -1, -1):
        part[:] = 0
        for g in range(planes.shape[2]):
            np.take(table[g], planes[:, p, g], axis=0, out=found)
            part += found
        if p == planes.shape[1] - 1:
            np.negative(part, out=total)
        else:
            total += total
            total += part
    return total


def _ordered(score: np.ndarray, at: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` of the rows ``at`` by falling score, then by their place in the order of ids."""
    own = score[at]
    if len(at) > most:
        at = at[own >= np.partition(own, len(own) - most)[len(own) - most]]
        own = score[at]
    return at[np.lexsort((place[at], -own))][:most]


class Block:
    """A block of candidates and the scores of a few anchors at a time."""

    def __init__(self, rows: pa.Table, planes: int, groups: int, largest: int):
        rows = rows.sort_by([("id", "ascending"), ("row", "ascending")])  # null ids last
        self.rows, self.labels = rows["row"].to_numpy(), rows["label"].to_numpy()
        self.ids = rows["id"].to_pylist()
        self.place = np.arange(len(self.rows))
        self.planes = np.frombuffer(b"".join(rows["planes"].to_pylist()), np.uint8).reshape(-1, planes, groups)
        self.kind = np.int32 if groups * 8 * largest * largest < 2**31 else np.int64
        self.same = {label: np.flatnonzero(self.labels == label) for label in np.unique(self.labels)}
        self.other = {label: np.flatnonzero(self.labels != label) for label in self.same}

    def each(self, anchors: pa.Table, dims: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each anchor's place in its table, with the scores of all candidates."""
        at_once = max(1, COMPONENTS_AT_ONCE // dims)
        for start in range(0, len(anchors), at_once):
            some = anchors.slice(start, at_once)
            table = subset_sums(_padded(some["ints"].combine_chunks(), dims), self.kind)
            found = np.concatenate([scores(table, self.planes[i:i + ROWS_AT_ONCE]) for i in range(0, len(self.planes), ROWS_AT_ONCE)])
            for i, own in enumerate(np.ascontiguousarray(found.T)):
                yield start + i, own


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)


def _longs(names: str) -> pa.Schema:
    return pa.schema([(x.split()[0], pa.int64()) for x in names.split(", ")])


def _positives(dims: int, planes: int, largest: int, most: int):
    """For each anchor its best rows of the same label within a block."""

    def block(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(candidates) and len(anchors):
            found = Block(candidates, planes, -(-dims // 8), largest)
            rows, labels = anchors["row"].to_pylist(), anchors["label"].to_pylist()
            for i, score in found.each(anchors, dims):
                at = found.same.get(labels[i], found.place[:0])
                at = at[found.rows[at] != rows[i]]
                out += [(rows[i], int(found.rows[j]), found.ids[j], int(score[j])) for j in _ordered(score, at, found.place, most)]
        return _table(out, _longs(BEST))

    return block


def _negatives(dims: int, planes: int, largest: int, most: int, percent: int):
    """For each anchor and positive the best rows of other labels within a block that score between ``percent`` of the
    positive's score and that score."""

    def block(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(candidates) and len(anchors):
            found = Block(candidates, planes, -(-dims // 8), largest)
            rows, labels, positives = (anchors[c].to_pylist() for c in ("row", "label", "positives"))
            for i, score in found.each(anchors, dims):
                at = found.other.get(labels[i], found.place)
                own = score[at]
                for p in positives[i]:
                    high = p["positive_score"]
                    low = -(-percent * high // 100)
                    hit = at[(own >= low) & (own <= high)]
                    head = (rows[i], p["positive_row"], p["positive_id"], high)
                    out += [(*head, int(found.rows[j]), found.ids[j], int(score[j])) for j in _ordered(score, hit, found.place, most)]
        return _table(out, _longs(MINED))

    return block


def _packed(dims: int, planes: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bits = bit_planes(_padded(batch.column("ints"), dims), planes)
                yield batch.append_column("planes", pa.array([x.tobytes() for x in bits], pa.binary()))

    return task


def _against_all(candidates: DataFrame, anchors: DataFrame, blocks: int, anchor_blocks: int, block, schema: str) -> DataFrame:
    """Every block of anchors with every block of candidates. Blocks are cut by hashes of row numbers, which are unique, so
    no label, id or repeated row makes one large."""
    left = candidates.select(
        "row", "id", "label", "planes", _block_of(F.col("row"), blocks).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("anchor_block"))
    right = anchors.select(
        "*", _block_of(F.col("row"), anchor_blocks).alias("anchor_block"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    keys = ["block", "anchor_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(block, schema)


def _block_of(row: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(blocks)).cast("int")


def mine(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", anchor: Column | None = None,
         positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its best
    ``positives`` rows of its label, the best ``negatives`` rows of other labels that score between ``least_percent`` per
    cent of the positive's score and that score.

    Components become floor(scale * x) and scores are their inner products, exactly: subset sums of each anchor's groups of
    eight components are looked up by the bytes of the candidates' bit planes. ``anchor`` says which rows are anchors (by
    default those whose key is divisible by 100). All anchors meet all rows, in blocks of bounded size; what leaves a pair
    of blocks is an anchor's best few.

    Higher scores come first, ties go by smaller key, null keys last. Rows with a null label or vector, or a null or
    non-finite component, take no part. A row is not its own positive; rows that repeat it are, and a repeated anchor is an
    anchor each time. Vectors of unequal sizes are taken to go on in zeros. An anchor without positives, or a positive
    without negatives (a negative score has none), gives no rows; nor do no rows or no anchors. Components beyond 2**24
    count as 2**24. All other columns are ignored, whatever they are called.
    """
    whole = rows.filter(F.col(label).isNotNull() & finite(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        integers(F.col(vector), scale, LARGEST).alias("ints"),
        F.coalesce(F.col(key) % 100 == 0 if anchor is None else anchor, F.lit(False)).alias("is_anchor"))
    seen = whole.select("id", F.size("ints").alias("dims"), F.array_max(F.transform("ints", F.abs)).alias("most"), "is_anchor").agg(
        F.count(F.lit(1)).alias("n"), F.max("dims").alias("dims"), F.max("most").alias("most"), F.count_if("is_anchor").alias("anchors")).first()
    dims, largest = max(seen.dims or 0, 1), seen.most or 0
    planes = largest.bit_length() + 1
    numbered = whole.select(F.monotonically_increasing_id().alias("row"), "id", "label", "is_anchor", "ints")
    schema = "row long, id long, label long, is_anchor boolean, ints array<long>, planes binary"
    vectors = stage(numbered.mapInArrow(_packed(dims, planes), schema), "bit_planes")
    blocks, anchor_blocks = max(1, -(-seen.n // ROWS_PER_BLOCK)), max(1, -(-seen.anchors // ANCHORS_PER_BLOCK))
    anchors = vectors.filter("is_anchor").select("row", "id", "label", "ints")
    near = _against_all(vectors, anchors.select("row", "label", "ints"), blocks, anchor_blocks, _positives(dims, planes, largest, positives), BEST)
    best = W.partitionBy("a_row").orderBy(F.desc("positive_score"), F.col("positive_id").asc_nulls_last(), "positive_row")
    kept = stage(near.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= positives).drop("n"), "positives")
    of_anchor = kept.groupBy(F.col("a_row").alias("row")).agg(
        F.collect_list(F.struct("positive_row", "positive_id", "positive_score")).alias("positives"))  # a few to an anchor
    asked = stage(anchors.select("row", "label", "ints").join(of_anchor, "row"), "anchors")
    mined = _against_all(vectors, asked, blocks, anchor_blocks, _negatives(dims, planes, largest, negatives, least_percent), MINED)
    hard = W.partitionBy("a_row", "positive_row").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last(), "negative_row")
    ranked = mined.withColumn("rank", F.row_number().over(hard)).filter(F.col("rank") <= negatives)
    return ranked.join(anchors.select(F.col("row").alias("a_row"), F.col("id").alias("anchor_id")), "a_row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
