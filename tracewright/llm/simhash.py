"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints come from whole texts. Distinct fingerprints are blocked by the pigeonhole principle: of BLOCKS
blocks of bits, two fingerprints that differ in at most RADIUS bits agree on BLOCKS - RADIUS of them, so one table
for each choice of that many blocks finds every link. Inside a bucket, bit planes are stored vertically (bit j of 64
fingerprints in one machine word), many distances are updated at once with carry-save counters, and words whose 64
distances all exceed the radius are abandoned. A bucket gives the edges of a spanning forest of its links, never all
pairs; buckets above CHUNK fingerprints are compared chunk against chunk in separate cells, so none is capped.

Joins are told to sort and merge, or to hash a partition at a time. Spark takes an explode to add no rows and a column of
few values to be as long as its file, so left alone it broadcasts tables that the driver cannot hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, map_texts, materialize

RADIUS, BLOCKS, SHINGLE, SEED = 4, 7, 4, 42
#: Fingerprints of a bucket that one cell compares with each other; cells hold two chunks at most.
CHUNK = 8192
#: Buckets up to so many fingerprints are compared as a list of pairs.
SMALL = 32
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of a text; 0 for a null text or one without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))[: len(words) - SHINGLE + 1].tolist()
    ends = np.concatenate((gaps, [len(joined)]))[SHINGLE - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """carry, fp (the fingerprint as a signed long), a row for each row of docs."""

    def make():
        return lambda texts: [np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)]

    return map_texts(docs, list(carry), make, "fp long")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 rows; bit j of value i is bit i of row j, 64 values to a word. Padded with zeros."""
    padded = np.zeros(-(-len(values) // 64) * 64, "<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _carry_save(a, b, c):
    half = a ^ b
    return (a & b) | (half & c), half ^ c


def within_radius(plane, size: int, radius: int) -> np.ndarray:
    """Words whose bit i is 1 where distance i is at most radius (0 to 7).

    plane(j, alive): the words of difference bit j at the positions alive. Eight planes at a time go through carry-save
    adders into vertical counters; words of which every distance exceeds the radius are dropped after each eight.
    """
    out, alive = np.zeros(size, np.uint64), np.arange(size)
    ones, twos, fours, over = (np.zeros(size, np.uint64) for _ in range(4))
    for j in range(0, 64, 8):
        p = [plane(j + i, alive) for i in range(8)]
        two_a, ones = _carry_save(ones, p[0], p[1])
        two_b, ones = _carry_save(ones, p[2], p[3])
        four_a, twos = _carry_save(twos, two_a, two_b)
        two_a, ones = _carry_save(ones, p[4], p[5])
        two_b, ones = _carry_save(ones, p[6], p[7])
        four_b, twos = _carry_save(twos, two_a, two_b)
        eights, fours = _carry_save(fours, four_a, four_b)
        over = over | eights
        above, equal = over, ~over
        for counter, bit in ((fours, 4), (twos, 2), (ones, 1)):
            if radius & bit:
                equal = equal & counter
            else:
                above, equal = above | (equal & counter), equal & ~counter
        keep = above != _ONES
        if not keep.all():
            alive, ones, twos, fours, over, above = (x[keep] for x in (alive, ones, twos, fours, over, above))
            if not len(alive):
                return out
    out[alive] = ~above
    return out


def link_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Whether a[i] and b[i] differ in at most radius bits."""
    planes = bit_planes(a ^ b)
    words = within_radius(lambda j, alive: planes[j][alive], planes.shape[1], radius)
    return np.unpackbits(words.view(np.uint8), bitorder="little")[: len(a)].astype(bool)


def forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, root) of a spanning forest of the links among distinct values."""
    n, planes = len(values), bit_planes(values)
    width, masks = planes.shape[1], np.where((values[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1), _ONES, np.uint64(0))
    linked = np.zeros((n, width), np.uint64)
    step = max(1, (1 << 15) // width)
    for at in range(0, n, step):
        q = min(step, n - at)
        linked[at : at + q] = within_radius(lambda j, alive: planes[j][alive % width] ^ masks[j, at + alive // width], q * width, radius).reshape(q, width)
    if n % 64:
        linked[:, -1] &= np.uint64((1 << (n % 64)) - 1)
    own = np.arange(n)
    linked[own, own // 64] &= ~(np.uint64(1) << (own % 64).astype(np.uint64))
    seen, members, roots = np.zeros(n, bool), [], []
    for s in np.flatnonzero(linked.any(axis=1)):
        if seen[s]:
            continue
        seen[s], front = True, np.array([s])
        while len(front):
            near = np.unpackbits(np.bitwise_or.reduce(linked[front], axis=0).view(np.uint8), bitorder="little")[:n].astype(bool) & ~seen
            front = np.flatnonzero(near)
            seen[front] = True
            members.append(values[front])
            roots.append(np.full(len(front), values[s]))
    none = np.zeros(0, np.uint64)
    return (np.concatenate(members), np.concatenate(roots)) if members else (none, none)


def _layout(blocks: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each block."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _cell_edges(batches: Iterator[pa.RecordBatch], radius: int, blocks: int, small: int) -> Iterator[pa.RecordBatch]:
    """Edges of the cells of a partition sorted by (key, cell). A cell that batches split is carried over whole."""
    tables = {c: t for t, c in enumerate(combinations(range(blocks), blocks - radius))}
    masks = np.array([((1 << n) - 1) << a for a, n in _layout(blocks)], np.uint64)
    code = np.array([1 << i for i in range(blocks)])
    first = np.full(1 << blocks, -1)
    for m in range(1 << blocks):
        zero = [i for i in range(blocks) if m >> i & 1]
        if len(zero) >= blocks - radius:
            first[m] = tables[tuple(zero[: blocks - radius])]

    def edges(key, fp, cuts):
        a, b = [], []
        sizes, starts = np.diff(cuts), cuts[:-1]
        for s in np.unique(sizes):
            own = starts[sizes == s]
            if s < 2:
                continue
            if s <= small:
                i, j = np.triu_indices(s, 1)
                for k in range(0, len(own), max(1, (1 << 18) // len(i))):
                    some = own[k : k + max(1, (1 << 18) // len(i))]
                    left, right = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
                    hit = np.flatnonzero(link_pairs(fp[left], fp[right], radius))
                    left, right = left[hit], right[hit]
                    equal = ((((fp[left] ^ fp[right])[:, None] & masks) == 0) * code).sum(axis=1)
                    here = first[equal] == key[left] >> 56  # a pair comes from the first table that holds it
                    a.append(fp[left[here]])
                    b.append(fp[right[here]])
            else:
                for at in own:
                    x, y = forest(fp[at : at + s], radius)
                    a.append(x)
                    b.append(y)
        if sum(map(len, a)):
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0].view(np.int64)), pa.array(pairs[1].view(np.int64))], names=["a", "b"])

    held = None
    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if held:
            now = [np.concatenate(x) for x in zip(held, now)]
        key, cell, fp = now[0], now[1], now[2]
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
        last = cuts[-1] if len(cuts) else 0
        held = [x[last:] for x in now]
        if last:
            yield from edges(key[:last], fp[:last].view(np.uint64), np.concatenate(([0], cuts)))
    if held and len(held[0]):
        yield from edges(held[0], held[2].view(np.uint64), np.array([0, len(held[0])]))


def link_edges(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """(a, b): edges that connect exactly the fingerprints which chains of links connect. distinct: fp, without repeats."""
    layout, keys = _layout(blocks), []
    for t, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key, at = F.lit(t << 56), 0
        for i in chosen:
            a, n = layout[i]
            key = key.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << n) - 1)), at))
            at += n
        keys.append(key)
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    full = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    mine = F.pmod(F.xxhash64("fp"), "chunks").cast("int")
    cells = (
        keyed.join(full.hint("merge"), "key")
        .withColumn("chunks", chunks)
        .withColumn("mine", mine)
        .select("key", "fp", "mine", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("key", (F.least("mine", "other").cast("long") * (1 << 31) + F.greatest("mine", "other")).alias("cell"), "fp")
        .repartition("key", "cell")
        .sortWithinPartitions("key", "cell")
    )
    distinct.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    return cells.mapInArrow(lambda it: _cell_edges(it, radius, blocks, SMALL), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge: alternating large-star and small-star rounds until nothing changes.

    Only aggregates decide when to stop; edges stay distributed and each round is written to the shared scratch folder.
    """

    def state(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    was = state(now)
    while was[0]:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).distinct()
        before, now = now, materialize(small, "edges")
        drop_scratch(before)
        after = state(now)
        if after == was:
            break
        was = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _grouped(docs: DataFrame, carry: tuple[str, ...], radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """carry (doc_id among it), fp, root (the component) and component_id (its least id) for every row of docs."""
    hashed = materialize(fingerprints(docs, carry), "fingerprints")
    distinct = materialize(hashed.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    found = components(link_edges(distinct.select("fp"), radius, blocks))
    groups = distinct.join(found.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    lowest = groups.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = materialize(groups.join(lowest.hint("merge"), "root").select("fp", "root", "component_id"), "components")
    return hashed.join(named.hint("merge"), "fp").select(*carry, "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of docs (columns doc_id, text).

    Null and empty texts have fingerprint zero and link like any other. Repeated rows come back as often as they came.
    Rows with a null doc_id get a component but never name one; component_id is null if no row of the component has an id.
    An empty table gives an empty result. Other columns are ignored.
    """
    return _grouped(docs, ("doc_id",), radius, blocks).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _representatives(pool: DataFrame) -> DataFrame:
    """_row of the row that stands for each component of pool (root, doc_id, _row; no null ids).

    Components offer their least free id and of those that offer the same the least takes it, round by round: an id
    stands for one component at most, and a component is left without only if all its ids stand for others.
    """
    first = materialize(pool.groupBy("root", "doc_id").agg(F.min("_row").alias("_row")), "pool")
    rest, taken = first, None
    while not rest.isEmpty():
        offers = rest.groupBy("root").agg(F.min("doc_id").alias("doc_id"))
        won = materialize(offers.groupBy("doc_id").agg(F.min("root").alias("root")), "won")
        taken = won if taken is None else taken.unionByName(won)
        rest = materialize(rest.join(won.select("root").hint("merge"), "root", "left_anti").join(won.select("doc_id").hint("merge"), "doc_id", "left_anti"), "pool")
    return first.join(taken.hint("merge"), ["root", "doc_id"]).select("_row") if taken is not None else first.select("_row")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that stand for their component: that of the least id.

    An id stays once. If it repeats over different texts it stands for one of their components, and the others are stood
    for by their next free ids. Of the rows of a component that have no id one stays.
    """
    row = F.xxhash64("doc_id", "text")
    named = materialize(_grouped(docs.withColumn("_row", row), ("doc_id", "_row")).drop("fp"), "named")
    known = named.where("doc_id is not null")
    gone = known.where("component_id != doc_id").select("_row")
    repeats = materialize(known.groupBy("doc_id").agg(F.count("*").alias("n"), (F.min("_row") != F.max("_row")).alias("differ")).where("n > 1"), "repeated")
    if not repeats.where("differ").isEmpty():
        # components with an id that repeats over different rows choose among their rows; ids do not tell them apart
        roots = materialize(known.join(repeats.where("differ").hint("merge"), "doc_id", "left_semi").select("root").distinct(), "contested")
        pool = materialize(known.join(roots.hint("merge"), "root", "left_semi"), "rows")
        lost = pool.join(_representatives(pool).hint("merge"), "_row", "left_anti").select("_row")
        gone = known.join(roots.hint("merge"), "root", "left_anti").where("component_id != doc_id").select("_row").unionByName(lost)
    nameless = named.where("doc_id is null")
    have = not nameless.isEmpty()
    if have:
        stays = nameless.groupBy("root").agg(F.min("_row").alias("_row"))
        gone = gone.unionByName(nameless.join(stays.hint("merge"), "_row", "left_anti").select("_row"))
    gone = materialize(gone.distinct(), "gone")
    # each text moves once at any size; the hashes are the side that is held, a partition at a time
    kept = docs.withColumn("_row", row).join(gone.hint("shuffle_hash"), "_row", "left_anti")
    if repeats.isEmpty() and not have:
        return kept.select(docs.columns)
    again = materialize(named.groupBy("_row").count().where("count > 1").select("_row"), "copies").hint("shuffle_hash")
    once = kept.join(again, "_row", "left_semi").dropDuplicates(["_row"])
    return kept.join(again, "_row", "left_anti").unionByName(once).select(docs.columns)
