"""Join of near-duplicate texts on the Jaccard similarity of their word shingles, by parity
sketches.

A sketch has P words of 64 bits. Each shingle of a text is hashed to one word and flips one bit
of it, so that the sketches of two texts differ in at most as many bits, and in at most as many
words, as there are shingles in only one of them. Texts are dealt into bands of set sizes such
that linked texts lie in the same or in neighbouring bands. In a band the threshold bounds the
symmetric difference by D; with P > D words, some word of linked texts must agree (pigeonhole).

1. Texts with equal sets become one class. Each class sends the words of its sketch, hashed
   with the shingles behind them, as keys. P has words to spare: of S spare ones, linked texts
   agree in S + 1 at least. So each text may leave out S words which would bring unrelated texts
   together, if all texts rank words alike: the last of the words in which two linked texts agree
   has at least S others before it in both, so neither leaves it out. Half of the S, the words
   made of the fewest shingles, go at once. Keys are sent packed, a few thousand buckets of a
   batch at a time, and only those in which classes meet come back as rows, counted.
2. Each class leaves out the other half: the keys that most classes hold, those of lines that
   many texts share. Without that, such lines join ever more unrelated texts as a table grows.
   Classes that meet in one of the rest are chained to the smallest of them, first within a task,
   then after the shuffle. No group is ever paired out. The connected parts of this graph, the
   bags, hold every link.
3. Within a bag and band, blocks of classes are compared with each other: sketches first, and
   what differs in few enough bits by the sets themselves. Classes already joined are not
   compared again. A task holds two blocks and sends at most one link for each of their classes.
4. Connected components of the links.

No row, group or candidate is capped. Set hashes have 64 bits. While keys meet, a class goes by
40 bits of its hash and a key by 48. Classes or keys that are taken for one another there only
make a bag larger, except for two linked sets whose 40 bits are the same (a chance of 10^-12).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm import shingles
from rosterlake.llm.components import connected_components
from rosterlake.llm.scratch import store

# Keys that a task collects before it packs them, or chains those that meet; 16 bytes each.
KEYS_AT_ONCE = 1 << 20
# Keys are packed by the first bits, with 36 bits that follow, and 40 bits of the class.
BUCKET_BITS, LOW_BITS, NODE_BITS = 12, 36, 40
# Shingles that are sketched at a time.
SHINGLES_AT_ONCE = 1 << 19
# Words of a sketch that may be left out, as a share of the differing shingles. More of them make
# all words poorer, fewer of them leave poor words among those that are sent. Small sets have a few
# more, as one line makes up much of them.
SPARE, SPARE_MORE = 0.25, 4
# Classes, and shingles of all of them together, in a block; a larger class has its own block.
BLOCK_CLASSES = 1024
BLOCK_SHINGLES = 1 << 19

# Bits that mark the texts which are wanted once more: 2^11 bitmaps of 2^15 bits, 8 MB in all.
MARK_BITS, BITMAP_BITS = 26, 15

# Stands for a missing id where a text of a class is looked for; the text decides in the end.
_LAST_ID = (1 << 63) - 1

DOCUMENT, PACKED, SHARED = 0, 1, 2
_LIGHT = pa.schema(
    [(name, pa.int64()) for name in ("part", "a", "b", "n", "text_hash")]
    + [("kind", pa.int8()), ("packed", pa.binary())]
)
_LIGHT_DDL = "part long, a long, b long, n long, text_hash long, kind byte, packed binary"
KEY, EDGE = 0, 1
_MET = pa.schema([("part", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("kind", pa.int8())])
_MET_DDL = "part long, a long, b long, kind byte"


class Bands:
    """Bands of set sizes and their sketches, for similarities from ``num / den`` on."""

    def __init__(self, num: int, den: int, largest: int):
        if not 0 < num <= den:
            raise ValueError("the similarity must be above 0 and at most 1")
        self.num, self.den = num, den
        self.low: list[int] = []
        self.reach: list[int] = []  # the largest set that links with one of this band
        self.words: list[int] = []  # of a sketch; 0 if only equal sets link
        self.sent: list[int] = []  # of these, the richest ones, which are keys
        self.late: list[int] = []  # of the keys, those which may be left out once they are counted
        low = 1
        while not self.low or self.low[-1] <= largest:
            high = low * den // num
            reach = high * den // num
            differing = self.difference(high, reach)
            self.low.append(low)
            self.reach.append(reach)
            spare = round(SPARE * differing) + min(SPARE_MORE, differing)
            self.words.append(differing + 1 + spare if differing else 0)
            self.late.append(spare - spare // 2)
            self.sent.append(differing + 1 + self.late[-1])
            low = high + 1

    def difference(self, a, b):
        """The most shingles that are in one only of two linked sets of these sizes."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, "right") - 1


@lru_cache(maxsize=4)
def _bands(num: int, den: int, doublings: int) -> Bands:
    return Bands(num, den, 1 << doublings)


def bands_for(num: int, den: int, largest: int) -> Bands:
    return _bands(num, den, max(1, int(largest).bit_length()))


def sketch_keys(
    sets: np.ndarray, bounds: np.ndarray, bands: Bands
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets, each with the number of its set: those for pairs in which the set is
    the smaller one, by its own band, and those for the larger one, by the band below."""
    return sided_keys(sets, bounds, bands)[:2]


def sided_keys(
    sets: np.ndarray, bounds: np.ndarray, bands: Bands
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sketch_keys``, and for each key its side: 0 by the set's own band, 1 by the band below."""
    sizes = np.diff(bounds)
    own = bands.of(np.maximum(sizes, 1))
    words, reach = np.array(bands.words), np.array(bands.reach)
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    sides = [np.zeros(0, np.uint8)]
    for side, band in enumerate((own, own - 1)):
        at = np.maximum(band, 0)
        used = (sizes > 0) & (band >= 0) & (words[at] > 0) & (sizes <= reach[at])
        chosen = np.flatnonzero(used)
        if not len(chosen):
            continue
        width = words[band[chosen]]
        first = np.concatenate([[0], np.cumsum(width)])
        n = sizes[chosen]
        of = np.repeat(np.arange(len(chosen)), n)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        tokens = shingles.mix(sets[bounds[chosen][of] + inside] + np.uint64(0x632BE59BD9B4E019))
        word = ((tokens >> np.uint64(32)) * width[of].astype(np.uint64)) >> np.uint64(32)
        place = first[of] + word.astype(np.int64)
        order = np.argsort(place, kind="stable")
        place, tokens = place[order], tokens[order]
        starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        filled = place[starts]
        count = np.zeros(first[-1], np.int64)
        parity = np.zeros(first[-1], np.uint64)
        joined = np.zeros(first[-1], np.uint64)
        count[filled] = np.diff(np.append(starts, len(place)))
        parity[filled] = np.bitwise_xor.reduceat(np.uint64(1) << (tokens & np.uint64(63)), starts)
        joined[filled] = np.bitwise_xor.reduceat(tokens, starts)
        owner = np.repeat(np.arange(len(chosen)), width)
        value = shingles.mix(parity) + joined
        richest = np.lexsort((value, count, owner))
        left = first[1:][owner] - np.arange(first[-1])  # places to the end of the set's words
        sent = richest[left <= np.array(bands.sent)[band[chosen]][owner]]
        number = sent - first[owner[sent]]
        label = band[chosen][owner[sent]].astype(np.uint64) << np.uint64(40) | number.astype(np.uint64)
        value = value[sent] + shingles.mix(label)
        keys.append(shingles.mix(value))
        owners.append(chosen[owner[sent]])
        sides.append(np.full(len(sent), side, np.uint8))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(sides)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _light(kind: int, rows: int, **columns) -> pa.RecordBatch:
    """Light rows of one kind; columns that are not given are null."""

    def column(field: pa.Field) -> pa.Array:
        values = columns.get(field.name)
        if values is None:
            return pa.nulls(rows, field.type)
        return values if isinstance(values, pa.Array) else pa.array(values, field.type)

    columns["kind"] = np.full(rows, kind, np.int8)
    return pa.RecordBatch.from_arrays([column(field) for field in _LIGHT], schema=_LIGHT)


def pack(low: np.ndarray, nodes: np.ndarray, sides: np.ndarray) -> bytes:
    """Keys of one bucket in some ten bytes each. ``low`` is sorted and has LOW_BITS bits, so that
    its upper four are told by counts; nodes have NODE_BITS bits."""
    counts = np.bincount((low >> np.uint64(32)).astype(np.int64), minlength=1 << LOW_BITS - 32)
    octets = nodes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : NODE_BITS // 8]
    parts = (counts.astype("<u4"), low.astype("<u4"), octets, np.packbits(sides))
    return b"".join(part.tobytes() for part in parts)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``low``, ``nodes`` and ``sides`` of packed keys."""
    upper = 1 << LOW_BITS - 32
    counts = np.frombuffer(packed, "<u4", upper).astype(np.int64)
    n, width, at = int(counts.sum()), NODE_BITS // 8, 4 * upper
    low = np.repeat(np.arange(upper, dtype=np.uint64) << np.uint64(32), counts)
    low |= np.frombuffer(packed, "<u4", n, at).astype(np.uint64)
    octets = np.zeros((n, 8), np.uint8)
    octets[:, :width] = np.frombuffer(packed, np.uint8, n * width, at + 4 * n).reshape(n, width)
    sides = np.unpackbits(np.frombuffer(packed, np.uint8, offset=at + (4 + width) * n), count=n)
    return low, octets.view("<u8").reshape(n), sides


def _distinct(
    keys: np.ndarray, nodes: np.ndarray, sides: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by key, then node, each pair of them once."""
    order = np.lexsort((nodes, keys))
    keys, nodes, sides = keys[order], nodes[order], sides[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    return keys[new], nodes[new], sides[new]


def _packed(keys: np.ndarray, classes: np.ndarray, sides: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket that has keys."""
    nodes = classes & np.uint64((1 << NODE_BITS) - 1)
    keys, nodes, sides = _distinct(keys >> np.uint64(64 - BUCKET_BITS - LOW_BITS), nodes, sides)
    bucket = (keys >> np.uint64(LOW_BITS)).astype(np.int64)
    low = keys & np.uint64((1 << LOW_BITS) - 1)
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(starts[1:], len(bucket))
    rows = [pack(low[i:j], nodes[i:j], sides[i:j]) for i, j in zip(starts, ends, strict=True)]
    return _light(PACKED, len(rows), part=bucket[starts], packed=rows)


def _sketched(k: int, num: int, den: int):
    """(doc_id, text_hash, text) -> light rows: documents, and packed keys of their classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for whole in batches:
            for batch in _portions(whole):
                sets, bounds = shingles.shingle_sets(batch.column(2), k)
                sizes = np.diff(bounds)
                ids = shingles.set_hashes(sets, bounds)
                yield _light(
                    DOCUMENT,
                    len(ids),
                    part=_signed(shingles.mix(ids + np.arange(len(ids), dtype=np.uint64))),
                    a=batch.column(0),
                    b=pa.array(_signed(ids), mask=sizes == 0),
                    n=sizes,
                    text_hash=batch.column(1),
                )
                if not len(sets):
                    continue
                own_keys, owners, sides = sided_keys(sets, bounds, bands_for(num, den, sizes.max()))
                waiting.append((own_keys, ids[owners], sides))
                if sum(len(keys) for keys, _, _ in waiting) >= KEYS_AT_ONCE:
                    yield _packed(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
                    waiting = []
        if waiting:
            yield _packed(*(np.concatenate(x) for x in zip(*waiting, strict=True)))

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Light rows sorted by kind and part: documents pass, and each key that several classes hold
    makes a row for each of them (a: class, b: key, n: classes that hold it, text_hash: side)."""

    def met(bucket: int, rows: list[bytes]) -> Iterator[pa.RecordBatch]:
        keys, nodes, sides = _distinct(
            *(np.concatenate(x) for x in zip(*map(unpack, rows), strict=True))
        )
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
        holders = np.diff(np.append(starts, len(keys)).astype(np.int64))
        holders = np.repeat(holders, holders)
        some = holders > 1
        if some.any():
            keys = _signed(keys[some]) | np.int64(bucket << LOW_BITS)
            nodes, sides = _signed(nodes[some]), sides[some].astype(np.int64)
            yield _light(SHARED, len(keys), a=nodes, b=keys, n=holders[some], text_hash=sides)

    bucket, rows = 0, []
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if (kind == DOCUMENT).any():
            yield batch.filter(pa.array(kind == DOCUMENT))
        batch = batch.filter(pa.array(kind == PACKED))
        for part, packed in zip(batch.column("part").to_pylist(), batch.column("packed"), strict=True):
            if part != bucket and rows:
                yield from met(bucket, rows)
                rows = []
            bucket = part
            rows.append(packed.as_py())
    if rows:
        yield from met(bucket, rows)


def _met(part, a, b, kind: int) -> pa.RecordBatch:
    b = pa.nulls(len(part), pa.int64()) if b is None else pa.array(b, pa.int64())
    kinds = pa.array(np.full(len(part), kind, np.int8))
    columns = [pa.array(part, pa.int64()), pa.array(a, pa.int64()), b, kinds]
    return pa.RecordBatch.from_arrays(columns, schema=_MET)


def _edges(keys: np.ndarray, classes: np.ndarray, leader: np.ndarray) -> Iterator[pa.RecordBatch]:
    other = classes != leader
    pairs = np.unique(np.stack([classes[other], leader[other]], axis=1), axis=0)
    if len(pairs):
        part = _signed(shingles.mix(pairs[:, 0].astype(np.uint64)))
        yield _met(part, pairs[:, 0], pairs[:, 1], EDGE)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, class) -> one key row for each key, and edges from its other classes to the smallest
    one, many keys at a time."""

    def chain(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, classes = (np.concatenate([b.column(x).to_numpy() for b in waiting]) for x in (0, 1))
        order = np.lexsort((classes, keys))
        keys, classes = keys[order], classes[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        yield _met(keys[first], classes[first], None, KEY)
        yield from _edges(keys, classes, classes[np.flatnonzero(first)][np.cumsum(first) - 1])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= KEYS_AT_ONCE:
            yield from chain(waiting)
            waiting = []
    if waiting:
        yield from chain(waiting)


def _portions(batch: pa.RecordBatch, column: int = 2) -> Iterator[pa.RecordBatch]:
    """The batch in parts of a few megabytes of text; a longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    part = np.cumsum(lengths) // (4 * SHINGLES_AT_ONCE)
    first = 0
    while first < len(lengths):
        last = int(np.searchsorted(part, part[first], "right"))
        yield batch.slice(first, last - first)
        first = last


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by kind, part and a: key rows become edges to the first class of their key;
    edges pass."""
    last_key = last_leader = None
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if (kind == EDGE).any():
            yield batch.filter(pa.array(kind == EDGE))
        keys = batch.column("part").to_numpy(zero_copy_only=False)[kind == KEY]
        classes = batch.column("a").filter(pa.array(kind == KEY)).to_numpy()
        if not len(keys):
            continue
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        leader = classes[np.flatnonzero(first)][np.cumsum(first) - 1]
        if last_key == keys[0]:
            leader[keys == keys[0]] = last_leader
        last_key, last_leader = keys[-1], leader[-1]
        yield from _edges(keys, classes, leader)


def _node(cls: str) -> Column:
    return F.col(cls).bitwiseAND(F.lit((1 << NODE_BITS) - 1))


def _own_band(bands: Bands) -> Column:
    own = F.lit(0)
    for k in range(1, len(bands.low)):
        own = F.when(F.col("n") >= bands.low[k], k).otherwise(own)
    return own


def _kept_keys(shared: DataFrame, classes: DataFrame, bands: Bands) -> DataFrame:
    """key and node of the shared keys without those that a class leaves out: as many as its band
    allows, of each side, from those that most classes hold down.

    ``shared``: node, key, holders, side. ``classes``: cls and n. Where two classes have the same
    node, it leaves out as many as the smaller one may.
    """
    late = F.array(*[F.lit(number) for number in bands.late])
    sizes = classes.groupBy(_node("cls").alias("node")).agg(F.min("n").alias("n"))
    sizes = sizes.select("node", _own_band(bands).alias("own"))
    window = Window.partitionBy("node", "side").orderBy(F.col("holders").desc(), "key")
    band = F.greatest(F.col("own") - F.col("side"), F.lit(0)).cast("int")
    ranked = shared.join(sizes, "node").withColumn("rank", F.row_number().over(window))
    return ranked.where(F.col("rank") > F.get(late, band)).select("key", "node")


def _blocks(members: DataFrame, num: int, den: int, largest: int) -> DataFrame:
    """cls and ``tasks``: the comparisons that the class takes part in, as (bag, band, block of
    the smaller, block of the larger, side).

    ``members``: cls, bag, n. A class is in its own band with side 0, and in the band below with
    side 1 for the larger sets there. Sizes of the groups decide how many blocks there are; the
    block follows from a hash, so no group is sorted or gathered.
    """
    bands = bands_for(num, den, largest)
    placed = members.withColumn("own", _own_band(bands))
    roles = F.array(
        F.struct(F.col("own").alias("band"), F.lit(0).alias("side")),
        F.struct((F.col("own") - 1).alias("band"), F.lit(1).alias("side")),
    )
    placed = placed.select("cls", "bag", "n", F.explode(roles).alias("role")).select(
        "cls", "bag", "n", "role.*"
    )
    side = {s: F.col("side") == s for s in (0, 1)}

    def blocks(s: int) -> Column:
        rows = F.count(F.when(side[s], 1))
        load = F.sum(F.when(side[s], F.col("n")).otherwise(0))
        return F.greatest(F.ceil(rows / BLOCK_CLASSES), F.ceil(load / BLOCK_SHINGLES)).cast("int")

    sizes = placed.groupBy("bag", "band").agg(
        F.count(F.when(side[0], 1)).alias("smaller"),
        F.count("*").alias("all"),
        blocks(0).alias("blocks_0"),
        blocks(1).alias("blocks_1"),
    )
    sizes = sizes.where((F.col("smaller") > 0) & (F.col("all") > 1)).drop("smaller", "all")
    number = F.pmod(
        F.xxhash64("cls"), F.when(side[0], F.col("blocks_0")).otherwise(F.col("blocks_1"))
    ).cast("int")
    smaller, larger = F.col("blocks_0"), F.col("blocks_1")

    def task(i: Column, j: Column, with_larger: bool, own_side: int) -> Column:
        return F.struct(
            F.col("bag"),
            F.col("band"),
            i.cast("int").alias("i"),
            j.cast("int").alias("j"),
            F.lit(with_larger).alias("with_larger"),
            F.lit(own_side).alias("side"),
        )

    def numbers(count: Column) -> Column:
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
            F.array().cast("array<int>")
        )

    block = F.col("block")
    among = F.transform(
        numbers(smaller),
        lambda x: F.when(x >= block, task(block, x, False, 0)).otherwise(task(x, block, False, 1)),
    )
    to_larger = F.transform(numbers(larger), lambda x: task(block, x, True, 0))
    from_larger = F.transform(numbers(smaller), lambda x: task(x, block, True, 1))
    return (
        placed.join(sizes.hint("rebalance"), ["bag", "band"])
        .withColumn("block", number)
        .select(
            "cls",
            F.when(side[0], F.concat(among, to_larger)).otherwise(from_larger).alias("some"),
        )
        .groupBy("cls")
        .agg(F.flatten(F.collect_list("some")).alias("tasks"))
    )


def with_mark(rows: DataFrame, wanted: DataFrame, on: list[str], name: str) -> DataFrame:
    """The rows with a column ``name``: false only if their columns ``on`` are not in ``wanted``.

    Each wanted row sets one of 2^MARK_BITS bits, by a hash. The bitmaps are sent to every task:
    8 MB at most, however many rows are wanted. Where most bits are set, most rows are marked;
    what follows decides.
    """
    spot = F.pmod(F.xxhash64(*on), F.lit(1 << MARK_BITS))
    place = F.pmod(spot, F.lit(1 << BITMAP_BITS))
    bitmap = F.shiftright(spot, BITMAP_BITS)
    bits = wanted.groupBy(bitmap.alias(f"{name}_map")).agg(
        F.bitmap_construct_agg(place).alias(f"{name}_bits")
    )
    byte = F.substring(f"{name}_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(place, F.lit(8)).cast("int")) == 1
    found = rows.withColumn(f"{name}_map", bitmap).join(F.broadcast(bits), f"{name}_map", "left")
    return found.withColumn(name, F.coalesce(is_set, F.lit(False))).drop(f"{name}_map", f"{name}_bits")


def _marked(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose columns ``on`` may be in ``wanted``, so that a join moves few others: rows
    on bits that are not set go before any shuffle."""
    return with_mark(rows, wanted, on, "marked").where("marked").select(*rows.columns)


_SET_DDL = (
    "bag long, band int, i int, j int, with_larger boolean, side int, cls long, shingles binary"
)
_SETS = pa.schema(
    [
        ("bag", pa.int64()),
        ("band", pa.int32()),
        ("i", pa.int32()),
        ("j", pa.int32()),
        ("with_larger", pa.bool_()),
        ("side", pa.int32()),
        ("cls", pa.int64()),
        ("shingles", pa.binary()),
    ]
)


def _dealt(k: int):
    """(cls, tasks, text) -> one row for each comparison of the class, with its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _portions(whole):
                sets, bounds = shingles.shingle_sets(batch.column(2), k)
                found = _signed(shingles.set_hashes(sets, bounds))
                classes = batch.column(0).to_numpy()
                rows, size = [], 0
                for t, tasks in enumerate(batch.column(1)):
                    if found[t] != classes[t]:
                        continue  # another row of the same document id
                    own = sets[bounds[t] : bounds[t + 1]].tobytes()
                    for task in tasks.as_py():
                        rows.append(task | {"cls": int(classes[t]), "shingles": own})
                        size += len(own)
                        if size > 1 << 25:
                            yield pa.RecordBatch.from_pylist(rows, _SETS)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _SETS)

    return run


def _sketches(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Parity sketches of ``bits`` bits, one row of 64-bit words for each set."""
    words = bits // 64
    result = np.zeros(len(sets) * words, np.uint64)
    for t, own in enumerate(sets):
        tokens = shingles.mix(own)
        place = t * words + ((tokens >> np.uint64(6)) & np.uint64(words - 1)).astype(np.int64)
        np.bitwise_xor.at(result, place, np.uint64(1) << (tokens & np.uint64(63)))
    return result.reshape(len(sets), words)


def links_between(
    left: dict[int, np.ndarray], right: dict[int, np.ndarray], num: int, den: int
) -> list[tuple[int, int]]:
    """Links that join the classes of two blocks (or of one, if both are the same) as all links
    between them would. Sets are sorted arrays by class."""
    same = left is right
    ids = list(left) if same else [*left, *(c for c in right if c not in left)]
    sets = {**right, **left}
    parent = {c: c for c in ids}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    rows, columns = list(left), list(right)
    sizes = {c: len(own) for c, own in sets.items()}
    if not rows or not columns:
        return []
    bits = max(64, 1 << (4 * max(sizes.values()) - 1).bit_length())
    of_rows = _sketches([sets[c] for c in rows], bits)
    of_columns = of_rows if same else _sketches([sets[c] for c in columns], bits)
    n_rows = np.array([sizes[c] for c in rows])
    n_columns = np.array([sizes[c] for c in columns])
    links = []
    step = max(1, (1 << 21) // max(1, of_columns.size))
    for begin in range(0, len(rows), step):
        some = of_rows[begin : begin + step]
        differ = np.bitwise_count(some[:, None, :] ^ of_columns[None, :, :]).sum(axis=2, dtype=np.int64)
        allowed = (den - num) * (n_rows[begin : begin + step, None] + n_columns) // (den + num)
        near = differ <= allowed
        for x, y in zip(*(v.tolist() for v in np.nonzero(near)), strict=True):
            a, b = rows[begin + x], columns[y]
            if a == b or root(a) == root(b):
                continue
            shared = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if den * shared >= num * (sizes[a] + sizes[b] - shared):
                parent[root(a)] = root(b)
                links.append((a, b))
    return links


def _compared(num: int, den: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[dict, dict] = ({}, {})
        for batch in batches:
            columns = (batch.column(name) for name in ("cls", "side", "shingles"))
            for cls, side, own in zip(*columns, strict=True):
                sides[side.as_py()][cls.as_py()] = np.frombuffer(own.as_py(), np.uint64)
        _, _, i, j, with_larger = (part.as_py() for part in key)
        within = i == j and not with_larger
        links = links_between(sides[0], sides[0] if within else sides[1], num, den)
        yield pa.RecordBatch.from_pydict(
            {"a": [a for a, _ in links], "b": [b for _, b in links]},
            pa.schema([("a", pa.int64()), ("b", pa.int64())]),
        )

    return run


def link_texts(
    docs: DataFrame,
    k: int,
    num: int,
    den: int = 100,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    A text's set is that of its distinct shingles of ``k`` words (runs of anything but space and
    0x09 to 0x0D, with A-Z in lower case); with fewer words, the whole sequence. Two texts link
    when den * |intersection| >= num * |union|; ``component_id`` is the smallest doc_id that
    links lead to, its own included. Null, empty and blank texts have no shingles and link with
    nothing. Rows with the same id are rows of their own with links of their own; a null id is
    never the smallest, and stays null if no linked row has one. Texts are read whole. Columns
    other than the two named are not looked at. No rows give no rows.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.col(text).cast("string").alias("text"),
    )
    light = (
        rows.mapInArrow(_sketched(k, num, den), _LIGHT_DDL)
        .repartition("part")
        .sortWithinPartitions("kind", "part")
        .mapInArrow(_shared, _LIGHT_DDL)
        .drop("part", "packed")
    )
    light = store(light, "light")
    documents = light.where(F.col("kind") == DOCUMENT).select(
        F.col("a").alias("doc_id"), F.col("b").alias("cls"), "n", "text_hash"
    )
    # one text for each class: that of its smallest document; copies meet after a partial sum only
    key = F.coalesce("doc_id", F.lit(_LAST_ID))
    classes = (
        documents.where(F.col("cls").isNotNull())
        .groupBy("cls")
        .agg(
            F.min(key).alias("key"),
            F.min_by("text_hash", key).alias("text_hash"),
            F.min("n").alias("n"),
            F.min("doc_id").alias("least"),
        )
    )
    classes = store(classes, "classes")
    largest = classes.agg(F.max("n")).first()[0] or 1
    shared = light.where(F.col("kind") == SHARED).select(
        F.col("a").alias("node"), F.col("b").alias("key"), F.col("n").alias("holders"),
        F.col("text_hash").alias("side"),
    )
    edges = (
        _kept_keys(shared, classes, bands_for(num, den, largest))
        .mapInArrow(_chained, _MET_DDL)
        .repartition("part")
        .sortWithinPartitions("kind", "part", "a")
        .mapInArrow(_meet, _MET_DDL)
    )
    bags = connected_components(edges.select("a", "b"))
    bags = bags.withColumnRenamed("component", "bag")
    chosen = store(classes.withColumn("node", _node("cls")).join(bags, "node").drop("node"), "chosen")
    tasks = _blocks(chosen.select("cls", "bag", "n"), num, den, largest)
    wanted = chosen.select("cls", "key", "text_hash").join(tasks, "cls")
    texts = _marked(rows.withColumn("key", key), chosen, ["key", "text_hash"])
    links = (
        texts.join(wanted, ["key", "text_hash"])
        .select("cls", "tasks", "text")
        .mapInArrow(_dealt(k), _SET_DDL)
        .groupBy("bag", "band", "i", "j", "with_larger")
        .applyInArrow(_compared(num, den), "a long, b long")
    )
    joined = connected_components(links).select(
        F.col("node").alias("cls"), F.col("component").alias("group")
    )
    # the smallest document of each group, by class, and then one join with all documents
    by_class = classes.select("cls", "least").join(joined, "cls", "left")
    by_class = by_class.withColumn("group", F.coalesce("group", "cls"))
    smallest = by_class.groupBy("group").agg(F.min("least").alias("component_id"))
    answers = by_class.select("cls", "group").join(smallest.hint("rebalance"), "group").select(
        "cls", "component_id"
    )
    return documents.join(answers, "cls", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
