"""Links between vectors by an epsilon grid order join.

Vectors are scaled to length one, so that a cosine from ``least`` on is a distance of at most
epsilon. The head of a vector is its place in the leading principal dimensions, and one more
number: the length of all that is left over. Heads are never further apart than vectors are. A
grid is laid over the first dimensions of the heads. Sorted lexicographically by cell, the vectors
are one sequence, cut into blocks at borders of cells by many tasks. The sequence is joined with
itself by recursion over intervals: first over a tree of intervals of blocks, as joins of small
tables of bounding boxes, then within each pair of blocks that is left, down to short intervals.
Two intervals whose boxes are more than epsilon apart are skipped, so no link is lost.

Pairs of blocks send heads only and find the vectors that have another one near by head. Those
vectors alone are fetched, once for each pair of blocks that wants them, and compared in full.
Equal vectors are one class with a count. A pair of blocks sends, for each of its classes, the
number of vectors it links with and at most one link to join it to others; pairs of vectors
are never sent.

How much the boxes skip depends on the data. Vectors spread evenly over very many dimensions have
blocks that all come within epsilon of each other; then all pairs of blocks compare their heads,
and what grows with the square of the rows is that comparison and, divided by the size of a
block, the heads sent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.components import connected_components
from rosterlake.llm.scratch import store

# Dimensions of the grid and of the tree of boxes, and cells that one epsilon is divided into.
GRID_DIMENSIONS = 8
CELLS_OF_EPSILON = 4
LEAST_CELL = 1e-6
# A head has as many dimensions as are needed for the mean squared distance of two heads to
# be this many times the square of epsilon, within a limit.
HEAD_SPREAD = 5.0
MOST_DIMENSIONS = 64
# Components of a vector that principal dimensions are made from at most.
PRINCIPAL_FROM = 512
# Vectors of a block, and numbers in them at most; vectors of the intervals that are compared
# without further division, by head and in full.
BLOCK_VECTORS = 8192
BLOCK_NUMBERS = 1 << 22
HEAD_INTERVAL = 512
INTERVAL = 128
# Blocks that one task cuts from its part of the sequence, so that few are short.
BLOCKS_OF_TASK = 4
# Blocks or intervals that form one interval of the next higher level.
FAN_OUT = 16
# Moments that one task adds up.
MERGED_AT_ONCE = 64
# Heads are sent in single precision; this is more than their distances are off by.
ROUNDING = 1e-5

_MOMENT = pa.schema([("part", pa.int64()), ("moments", pa.binary())])
_HEAD = pa.schema([("cls", pa.int64()), ("cell", pa.binary()), ("head", pa.binary())])
_BLOCK_DDL = "part int, place int, low array<double>, high array<double>, classes binary, heads binary"
_BLOCK = pa.schema(
    [
        ("part", pa.int32()),
        ("place", pa.int32()),
        ("low", pa.list_(pa.float64())),
        ("high", pa.list_(pa.float64())),
        ("classes", pa.binary()),
        ("heads", pa.binary()),
    ]
)


def _units(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of length one, filled up with zeros to ``width``."""
    result = np.zeros((len(column), width))
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(column)), sizes)
    result[of, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    result /= np.abs(result).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return result / np.sqrt(np.einsum("ij,ij->i", result, result))[:, None]


def _moments(width: int, used: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((used + 1, used + 1))
        for batch in batches:
            units = _units(batch.column(0), width)[:, :used]
            with_one = np.concatenate([units, np.ones((len(units), 1))], axis=1)
            total += with_one.T @ with_one
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"part": [part], "moments": [total.tobytes()]}, _MOMENT)

    return run


def _add_moments(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in rows:
        for value in batch.column("moments"):
            own = np.frombuffer(value.as_py())
            total = own if total is None else total + own
    yield pa.RecordBatch.from_pydict({"part": [key[0].as_py()], "moments": [total.tobytes()]}, _MOMENT)


def principal_directions(
    vectors: DataFrame, width: int, wanted: int | None = None, least_spread: float = 0.0
) -> np.ndarray:
    """The leading principal directions of a one-column table of arrays, over all rows: ``wanted``
    of them or, without that, as many as make the mean squared distance in them ``least_spread``
    (MOST_DIMENSIONS at most).

    One matrix of PRINCIPAL_FROM + 1 squared numbers at most reaches the driver.
    """
    used = min(width, PRINCIPAL_FROM)
    schema = "part long, moments binary"
    parts = vectors.mapInArrow(_moments(width, used), schema)
    left = vectors.rdd.getNumPartitions()
    while left > 1:
        left = -(-left // MERGED_AT_ONCE)
        group = F.pmod(F.col("part"), F.lit(left)).alias("part")
        parts = parts.select(group, "moments").groupBy("part").applyInArrow(_add_moments, schema)
    total = sum(np.frombuffer(row[0]) for row in parts.select("moments").collect())
    total = total.reshape(used + 1, used + 1)
    mean = total[:-1, -1] / total[-1, -1]
    spread = total[:-1, :-1] / total[-1, -1] - np.outer(mean, mean)
    sizes, directions = np.linalg.eigh(spread)
    if wanted is None:
        distance = 2 * np.cumsum(sizes[::-1])  # of two vectors drawn at random, squared
        wanted = min(MOST_DIMENSIONS, int(np.searchsorted(distance, least_spread)) + 1)
    return directions[:, ::-1][:, :wanted].copy()


def _spots(units: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Heads: places in the principal dimensions, and the length of all that is left over."""
    spots = units[:, : len(directions)] @ directions
    rest = np.einsum("ij,ij->i", units, units) - np.einsum("ij,ij->i", spots, spots)
    return np.concatenate([spots, np.sqrt(np.maximum(rest, 0.0))[:, None]], axis=1)


def _heads(width: int, directions: np.ndarray, epsilon: float):
    """(cls, vector) -> cls, the cell of the vector as bytes that sort like its coordinates, head."""
    step = max(epsilon / CELLS_OF_EPSILON, LEAST_CELL)
    lowest = math.floor(-1.001 / step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = _spots(_units(batch.column(1), width), directions)
            cells = (np.floor(spots[:, :GRID_DIMENSIONS] / step) - lowest).astype(">u4")
            yield pa.RecordBatch.from_pydict(
                {
                    "cls": batch.column(0),
                    "cell": [row.tobytes() for row in cells],
                    "head": [row.tobytes() for row in spots.astype(np.float32)],
                },
                _HEAD,
            )

    return run


def _border(cells: list[bytes]) -> int:
    """Where to cut rows in grid order: before the row, in the last quarter, at which the earliest
    dimension enters another cell; after all rows if all are in one cell."""
    first = max(1, 3 * len(cells) // 4)
    corners = np.frombuffer(b"".join(cells[first - 1 :]), ">u4").reshape(len(cells) - first + 1, -1)
    changed = corners[1:] != corners[:-1]
    if not changed.any():
        return len(cells)
    return first + int(np.where(changed.any(axis=1), changed.argmax(axis=1), changed.shape[1]).argmin())


def _blocks(size: int):
    """Sorted (cls, cell, head) of a partition -> blocks of up to ``size`` consecutive rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []

        def cut(rows: pa.Table) -> pa.RecordBatch:
            heads = b"".join(rows["head"].to_pylist())
            spots = np.frombuffer(heads, np.float32).reshape(rows.num_rows, -1).astype(float)
            return pa.RecordBatch.from_pydict(
                {
                    "part": [part],
                    "place": [place],
                    "low": [spots.min(axis=0).tolist()],
                    "high": [spots.max(axis=0).tolist()],
                    "classes": [rows["cls"].to_numpy().tobytes()],
                    "heads": [heads],
                },
                _BLOCK,
            )

        for batch in batches:
            waiting.append(batch)
            while sum(b.num_rows for b in waiting) >= size:
                rows = pa.Table.from_batches(waiting)
                end = _border(rows["cell"].slice(0, size).to_pylist())
                yield cut(rows.slice(0, end))
                place += 1
                waiting = rows.slice(end).to_batches()
        if sum(b.num_rows for b in waiting):
            yield cut(pa.Table.from_batches(waiting))

    return run


class _Block:
    """Rows of a block in grid order; ``sizes`` and ``units`` only where vectors were fetched."""

    def __init__(self, classes: np.ndarray, heads: np.ndarray, sizes=None, units=None):
        self.classes, self.heads, self.sizes, self.units = classes, heads, sizes, units


class _IntervalJoin:
    """Recursion over the intervals of two blocks, or of one block with itself."""

    interval = INTERVAL

    def __init__(self, left: _Block, right: _Block, epsilon: float):
        self.left, self.right, self.same = left, right, left is right
        self.limit = (epsilon + ROUNDING) ** 2

    def far(self, a: slice, b: slice) -> bool:
        x, y = self.left.heads[a], self.right.heads[b]
        gap = np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0))
        gap = np.maximum(gap, 0.0)
        return float(gap @ gap) > self.limit

    def run(self) -> None:
        self.join(slice(0, len(self.left.classes)), slice(0, len(self.right.classes)))

    def join(self, a: slice, b: slice) -> None:
        """All pairs of two intervals; an interval with itself has each pair once."""
        if a.start == a.stop or b.start == b.stop or self.same and b.stop <= a.start:
            return
        if self.settled(a, b) or self.far(a, b):
            return
        n, m = a.stop - a.start, b.stop - b.start
        if max(n, m) <= self.interval:
            self.compare(a, b)
        elif n >= m:
            middle = (a.start + a.stop) // 2
            self.join(slice(a.start, middle), b)
            self.join(slice(middle, a.stop), b)
        else:
            middle = (b.start + b.stop) // 2
            self.join(a, slice(b.start, middle))
            self.join(a, slice(middle, b.stop))

    def settled(self, a: slice, b: slice) -> bool:
        return False

    def only_once(self, a: slice, b: slice, found: np.ndarray) -> np.ndarray:
        if self.same:  # only pairs of a lower and a higher place
            found &= np.arange(a.start, a.stop)[:, None] < np.arange(b.start, b.stop)
        return found


class _Finder(_IntervalJoin):
    """Marks the rows of two blocks that are near one of the other block, by head."""

    interval = HEAD_INTERVAL

    def __init__(self, left: _Block, right: _Block, epsilon: float):
        super().__init__(left, right, epsilon)
        self.squares = [np.einsum("ij,ij->i", block.heads, block.heads) for block in (left, right)]
        near = np.zeros(len(left.classes), bool)
        self.near = [near, near if self.same else np.zeros(len(right.classes), bool)]

    def settled(self, a: slice, b: slice) -> bool:
        return bool(self.near[0][a].all() and self.near[1][b].all())

    def compare(self, a: slice, b: slice) -> None:
        apart = self.left.heads[a] @ self.right.heads[b].T
        apart *= -2
        apart += self.squares[0][a][:, None]
        apart += self.squares[1][b]
        found = self.only_once(a, b, apart <= self.limit + ROUNDING)
        self.near[0][a] |= found.any(axis=1)
        self.near[1][b] |= found.any(axis=0)


class _Linker(_IntervalJoin):
    """Counts links and joins classes while two blocks are compared."""

    def __init__(self, left: _Block, right: _Block, least: float, epsilon: float):
        super().__init__(left, right, epsilon)
        self.least = least
        self.shift = 0 if self.same else len(left.classes)
        self.labels = np.arange(self.shift + len(right.classes))
        self.counts = np.zeros(len(self.labels), np.int64)
        self.links: list[tuple[int, int]] = []

    def compare(self, a: slice, b: slice) -> None:
        cosines = self.left.units[a] @ self.right.units[b].T
        linked = cosines >= self.least
        for i, j in zip(*np.nonzero(np.abs(cosines - self.least) < 1e-12), strict=True):
            x, y = self.left.units[a.start + i], self.right.units[b.start + j]
            linked[i, j] = math.fsum(x * y) >= self.least * math.sqrt(math.fsum(x * x) * math.fsum(y * y))
        linked = self.only_once(a, b, linked)
        if not linked.any():
            return
        self.counts[a] += linked @ self.right.sizes[b]
        self.counts[self.shift + b.start : self.shift + b.stop] += self.left.sizes[a] @ linked
        for i in np.flatnonzero(linked.any(axis=1)):
            place = a.start + int(i)
            others = self.shift + b.start + np.flatnonzero(linked[i])
            roots, at = np.unique(self.labels[others], return_index=True)
            for root, other in zip(roots, others[at], strict=True):
                own = self.labels[place]
                if root != own:
                    self.links.append((place, int(other)))
                    self.labels[self.labels == max(root, own)] = min(root, own)

    def classes(self) -> np.ndarray:
        own = self.left.classes
        return own if self.same else np.concatenate([own, self.right.classes])


def _near_rows(epsilon: float):
    """The heads of a pair of blocks -> (a, b, side, at, cls) of rows with another one near."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}
        for batch in batches:
            for row in batch.select(["side", "classes", "heads"]).to_pylist():
                classes = np.frombuffer(row["classes"], np.int64)
                heads = np.frombuffer(row["heads"], np.float32).reshape(len(classes), -1)
                blocks[row["side"]] = _Block(classes, heads)
        left = blocks[0]
        finder = _Finder(left, blocks.get(1, left), epsilon)
        finder.run()
        for side, block in blocks.items():
            at = np.flatnonzero(finder.near[side])
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array([key[0].as_py()] * len(at), pa.int64()),
                    "b": pa.array([key[1].as_py()] * len(at), pa.int64()),
                    "side": pa.array([side] * len(at), pa.int32()),
                    "at": pa.array(at, pa.int32()),
                    "cls": pa.array(block.classes[at], pa.int64()),
                },
                pa.schema(
                    [("a", pa.int64()), ("b", pa.int64()), ("side", pa.int32()), ("at", pa.int32()), ("cls", pa.int64())]
                ),
            )

    return run


def _linked(least: float, epsilon: float, width: int, directions: np.ndarray):
    """(a, b, side, at, cls, n, vector) of a pair of blocks -> counts and links of its classes."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).sort_by([("side", "ascending"), ("at", "ascending")])
        rows = rows.combine_chunks()
        units = np.concatenate([_units(b.column("vector"), width) for b in rows.to_batches()])
        heads = _spots(units, directions)
        classes, sizes = rows["cls"].to_numpy(), rows["n"].to_numpy()
        middle = int(np.searchsorted(rows["side"].to_numpy(), 1))
        sides = [
            _Block(classes[part], heads[part], sizes[part], units[part])
            for part in (slice(0, middle), slice(middle, None))
        ]
        left = sides[0]
        linker = _Linker(left, left if key[0] == key[1] else sides[1], least, epsilon)
        linker.run()
        classes = linker.classes()
        some = np.flatnonzero(linker.counts)
        ends = np.array(linker.links, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_pydict(
            {
                "a": np.concatenate([classes[some], classes[ends[:, 0]]]),
                "b": pa.concat_arrays(
                    [pa.nulls(len(some), pa.int64()), pa.array(classes[ends[:, 1]], pa.int64())]
                ),
                "n": np.concatenate([linker.counts[some], np.zeros(len(ends), np.int64)]),
            },
            pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]),
        )

    return run


def _near_pairs(boxes: DataFrame, count: int, epsilon: float, dimensions: int) -> DataFrame:
    """Pairs (a, b) of blocks, a <= b, whose boxes are at most epsilon apart.

    ``boxes``: block (its number in the sequence, below ``count``), low, high. From the one
    interval over all blocks down, a pair of intervals that are near each other in the first
    ``dimensions`` is replaced by the pairs of their parts. Blocks are compared in all dimensions.
    """
    limit = (epsilon + ROUNDING) ** 2
    names = [(f"low_{d}", f"high_{d}") for d in range(dimensions)]
    flat = [name for pair in names for name in pair]
    level = boxes.select(
        F.col("block").alias("node"),
        *[F.get("low", F.lit(d)).alias(low) for d, (low, _) in enumerate(names)],
        *[F.get("high", F.lit(d)).alias(high) for d, (_, high) in enumerate(names)],
    )
    upper = []
    while count > 1:
        count = -(-count // FAN_OUT)
        level = level.groupBy(F.floor(F.col("node") / FAN_OUT).alias("node")).agg(
            *[F.min(low).alias(low) for low, _ in names], *[F.max(high).alias(high) for _, high in names]
        )
        upper.append(level)

    def part(table: DataFrame, columns: list[str], side: str) -> DataFrame:
        parent = F.floor(F.col("node") / FAN_OUT).alias(side)
        return table.select(
            parent, F.col("node").alias(f"node_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in columns]
        )

    def parts(pairs: DataFrame, table: DataFrame, columns: list[str], distance: Column) -> DataFrame:
        joined = pairs.join(part(table, columns, "a"), "a").join(part(table, columns, "b"), "b")
        near = (F.col("node_a") <= F.col("node_b")) & (distance <= limit)
        return joined.where(near).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))

    def gap(low: str, high: str) -> Column:
        one, other = F.col(f"{low}_a") - F.col(f"{high}_b"), F.col(f"{low}_b") - F.col(f"{high}_a")
        return F.greatest(F.lit(0.0), one, other)

    leaves = boxes.withColumnRenamed("block", "node")
    if not upper:
        return leaves.select(F.col("node").alias("a"), F.col("node").alias("b"))
    pairs = upper[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    squared = sum((gap(*pair) * gap(*pair) for pair in names[1:]), gap(*names[0]) * gap(*names[0]))
    for table in reversed(upper[:-1]):
        pairs = parts(pairs, table, flat, squared)
    gaps = F.zip_with(
        F.zip_with("low_a", "high_b", lambda low, high: low - high),
        F.zip_with("low_b", "high_a", lambda low, high: low - high),
        lambda x, y: F.greatest(F.lit(0.0), x, y),
    )
    whole = F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g)
    return parts(pairs, leaves, ["low", "high"], whole)


def link_vectors(
    vectors: DataFrame,
    least: float = 0.9,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    dimensions: int | None = None,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row. Intermediate tables are written to the
    shared folder when this is called.

    Two vectors link when their cosine, in double precision, is at least ``least`` (above 0 and
    below 1). ``n_links`` counts the other vectors linked directly, copies included;
    ``component_id`` is the smallest vec_id that links lead to; ``kept`` marks the rows with that
    id. Vectors that are null, empty, all zero, or hold null or non-finite numbers link with
    nothing. Of vectors of different lengths the shorter one counts as filled up with zeros.
    Rows with the same id are rows of their own; a row with a null id is linked but never kept.
    Whole numbers as ids come back as long; ids of other types keep theirs, smallest in its order.
    ``dimensions``: of the heads; by default as many as keep vectors apart that don't link.
    Columns other than the two named are not looked at. No rows give no rows.
    """
    epsilon = math.sqrt(2 - 2 * least)
    values = F.col("vector")
    whole = dict(vectors.dtypes)[vec_id] in ("tinyint", "smallint", "int", "void")
    rows = vectors.select(
        (F.col(vec_id).cast("long") if whole else F.col(vec_id)).alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("vector"),
    )
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = ~odd & F.exists(values, lambda x: x != 0)
    rows = rows.withColumn("cls", F.when(F.coalesce(sound, F.lit(False)), F.xxhash64(values)))
    of_class = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.count("*").alias("n"),
        F.min("vec_id").alias("least_id"),
        F.any_value("vector").alias("vector"),
    )
    of_class = store(of_class, "classes")
    width, total = of_class.agg(F.max(F.size("vector")), F.count("*")).first()
    alone = (
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.col("vec_id").isNotNull().alias("kept"),
    )
    if width is None:
        return rows.select("vec_id", *alone)
    directions = principal_directions(
        of_class.select("vector"), width, dimensions, HEAD_SPREAD * epsilon * epsilon
    )
    block_rows = max(1, min(BLOCK_VECTORS, BLOCK_NUMBERS // width))
    ordered = (
        of_class.select("cls", "vector")
        .mapInArrow(_heads(width, directions, epsilon), "cls long, cell binary, head binary")
        .repartitionByRange(-(-total // (BLOCKS_OF_TASK * block_rows)), "cell", "cls")
        .sortWithinPartitions("cell", "cls")
    )
    blocks = store(ordered.mapInArrow(_blocks(block_rows), _BLOCK_DDL), "blocks")
    # numbers that follow the order; tasks that cut fewer blocks than others leave gaps
    parts, places = blocks.agg(F.max("part") + 1, F.max("place") + 1).first()
    number = F.col("part").cast("long") * places + F.col("place")
    blocks = blocks.withColumn("block", number)
    grid = min(GRID_DIMENSIONS, directions.shape[1] + 1)
    pairs = store(_near_pairs(blocks.select("block", "low", "high"), parts * places, epsilon, grid), "pairs")
    sides = pairs.select("a", "b", F.col("a").alias("block"), F.lit(0).alias("side")).unionByName(
        pairs.where("a < b").select("a", "b", F.col("b").alias("block"), F.lit(1).alias("side"))
    )
    near = (
        blocks.select("block", "classes", "heads")
        .join(sides, "block")
        .drop("block")
        .groupBy("a", "b")
        .applyInArrow(_near_rows(epsilon), "a long, b long, side int, at int, cls long")
    )
    near = store(near, "near")
    found = (
        near.join(of_class.select("cls", "n", "vector"), "cls")
        .groupBy("a", "b")
        .applyInArrow(_linked(least, epsilon, width, directions), "a long, b long, n long")
    )
    found = store(found, "links")
    links = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links"))
    groups = connected_components(found.where(F.col("b").isNotNull()).select("a", "b"))
    groups = groups.select(F.col("node").alias("cls"), F.col("component").alias("group"))
    by_class = (
        of_class.select("cls", "n", "least_id")
        .join(links, "cls", "left")
        .join(groups, "cls", "left")
        .withColumn("group", F.coalesce("group", "cls"))
    )
    smallest = by_class.groupBy("group").agg(F.min("least_id").alias("component"))
    answers = by_class.join(smallest.hint("rebalance"), "group").select(
        "cls", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component"
    )
    linked = F.col("cls").isNotNull()
    return rows.select("vec_id", "cls").join(answers, "cls", "left").select(
        "vec_id",
        F.when(linked, F.col("links")).otherwise(alone[0]).cast("long").alias("n_links"),
        F.when(linked, F.col("component")).otherwise(F.col("vec_id")).alias("component_id"),
        F.when(linked, F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)))
        .otherwise(alone[2])
        .alias("kept"),
    )
