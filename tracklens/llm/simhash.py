"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that may be close share some bands of bits, so each is dealt out under
every combination of bands that a close one must share. A task lays its sorted
fingerprints out in tiles of 64: bit plane b of a tile is one 64-bit word that
holds bit b of all 64. Two tiles are compared plane by plane; 64 distances at a
time are counted in carry-save bit counters, and a pair of tiles is abandoned once
every distance is beyond the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.llm.common import (
    column_of,
    narrow,
    number_of,
    numbered,
    prepare,
    raw_texts,
    stored,
)
from tracklens.llm.components import connected_components

SEED = 42
BUCKET_ROWS = 4096
BLOCK_ROWS = 1 << 17
TILE_PAIRS = 256


def fingerprint(raw: bytes | None, width: int = 4) -> int:
    """64-bit SimHash of a text's word shingles, repeats included."""
    words = (raw or b"").lower().split()
    n = len(words)
    if n == 0:
        return 0
    digest = xxhash.xxh64_intdigest
    if n <= width:
        return digest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n)) + np.arange(n)
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: n - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, n - width + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes))
    return int(sum(1 << int(b) for b in bits))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(names: list[str], text: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signed(fingerprint(raw, width)) for raw in raw_texts(column_of(batch, text))]
            yield pa.RecordBatch.from_arrays(
                [*(column_of(batch, n) for n in names), pa.array(found, pa.int64())], names=[*names, "fp"]
            )

    return run


def fingerprints(docs: DataFrame, id_name: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """``(id, fp)`` with the 64-bit fingerprint as a signed long."""
    slim = narrow(docs, id_name, text)
    schema = T.StructType([slim.schema[id_name], T.StructField("fp", T.LongType())])
    return slim.mapInArrow(_fingerprints([id_name], text, width), schema)


def band_masks(radius: int, extra: int = 2) -> list[int]:
    """Masks of bits of which fingerprints within ``radius`` share at least one whole.

    The 64 bits are cut into ``radius + extra`` bands; ``radius`` differing bits
    leave ``extra`` of them untouched.
    """
    bands = radius + extra
    edges = [64 * i // bands for i in range(bands + 1)]
    band = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(band[i] for i in chosen) for chosen in combinations(range(bands), extra)]


def _planes(tiles: np.ndarray) -> np.ndarray:
    """Vertical layout of (n, 64) fingerprints: word b of a tile has bit b of its 64 rows."""
    n = len(tiles)
    bits = np.unpackbits(tiles.astype("<u8").view(np.uint8).reshape(n, 64, 8), axis=2, bitorder="little")
    rows = np.ascontiguousarray(bits.transpose(0, 2, 1))
    return np.packbits(rows, axis=2, bitorder="little").view("<u8").reshape(n, 64)


def _within(counts: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose bit-sliced count is at most ``radius``."""
    below = np.zeros_like(over)
    equal = ~np.zeros_like(over)
    for k in range(len(counts) - 1, -1, -1):
        if radius >> k & 1:
            below |= equal & ~counts[k]
            equal &= counts[k]
        else:
            equal &= ~counts[k]
    return (below | equal) & ~over


def close_lanes(planes: np.ndarray, masks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For tile pairs: per row of the one tile, a word with a bit for each close row of the other.

    ``planes`` is (pairs, 64): the other tile's planes. ``masks`` is (pairs, rows, 64): all
    ones where the row's bit is set. Returns the pairs that were not abandoned and
    their (pairs, rows) words.
    """
    full = ~np.uint64(0)
    alive = np.arange(len(planes))
    width = max(1, radius.bit_length())
    counts = [np.zeros(masks.shape[:2], np.uint64) for _ in range(width)]
    over = np.zeros(masks.shape[:2], np.uint64)
    for first in range(0, 64, 8):
        for b in range(first, first + 8, 2):
            x = planes[alive, b, None] ^ masks[alive, :, b]
            y = planes[alive, b + 1, None] ^ masks[alive, :, b + 1]
            # Carry-save adder of ones + x + y, its carry rippling up.
            u = counts[0] ^ x
            carry = (counts[0] & x) | (u & y)
            counts[0] = u ^ y
            for k in range(1, width):
                carry, counts[k] = counts[k] & carry, counts[k] ^ carry
            over |= carry
        lost = ~_within(counts, over, radius)
        live = ~(lost == full).all(axis=1)
        if not live.all():
            alive, over = alive[live], over[live]
            counts = [c[live] for c in counts]
            if not len(alive):
                break
    return alive, _within(counts, over, radius) if len(alive) else over


def _forest(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fp, smallest fp of its part) of what is close among sorted key groups.

    Tiles of 64 rows meet all tiles up to the last one their last row's group reaches.
    """
    n = len(fps)
    tiles = -(-n // 64)
    padded = np.zeros(tiles * 64, np.uint64)
    padded[:n] = fps
    tile = padded.reshape(tiles, 64)
    planes = _planes(tile)
    ends = np.searchsorted(keys, keys[np.minimum(np.arange(1, tiles + 1) * 64, n) - 1], "right")
    last = (ends - 1) // 64
    reach = last - np.arange(tiles) + 1
    label = np.arange(n)

    def root(x: np.ndarray) -> np.ndarray:
        while True:
            up = label[x]
            if (up == x).all():
                return x
            x = up

    first = np.repeat(np.arange(tiles), reach)
    other = first + np.arange(len(first)) - np.repeat(np.cumsum(reach) - reach, reach)
    shifts = np.arange(64, dtype=np.uint64)
    for at in range(0, len(first), TILE_PAIRS):
        a, b = first[at : at + TILE_PAIRS], other[at : at + TILE_PAIRS]
        masks = (np.uint64(0) - ((tile[a][:, :, None] >> shifts) & np.uint64(1)))
        alive, words = close_lanes(planes[b], masks, radius)
        p, row = np.nonzero(words)
        if not len(p):
            continue
        bits = (words[p, row][:, None] >> shifts) & np.uint64(1)
        k, lane = np.nonzero(bits)
        i = a[alive[p[k]]] * 64 + row[k]
        j = b[alive[p[k]]] * 64 + lane
        fine = (i < j) & (j < n)
        i, j = i[fine], j[fine]
        while len(i):
            i, j = root(i), root(j)
            apart = i != j
            i, j = i[apart], j[apart]
            if len(i):
                high, low = np.maximum(i, j), np.minimum(i, j)
                np.minimum.at(label, high, low)
    top = root(np.arange(n))
    linked = top != np.arange(n)
    return fps[linked], fps[top[linked]]


def _links(radius: int):
    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(parts)
        a, b = _forest(rows[:, 0], rows[:, 1].view(np.uint64), radius)
        differ = a != b
        pair = np.unique(np.stack([a[differ].view(np.int64), b[differ].view(np.int64)], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            rows = np.stack([column_of(batch, "key").to_numpy(), column_of(batch, "fp").to_numpy()], 1)
            if not len(rows):
                continue
            held.append(rows)
            size += len(rows)
            if size >= BLOCK_ROWS:
                every = np.concatenate(held)
                cut = int(np.searchsorted(every[:, 0], every[-1, 0], "left"))
                if cut:
                    yield flush([every[:cut]])
                held, size = [every[cut:]], len(every) - cut
        if held:
            yield flush(held)

    return run


def close_edges(distinct: DataFrame, radius: int, extra: int = 2, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges that connect all of ``distinct(fp)`` within ``radius`` bits of one another.

    Buckets above ``bucket_rows`` are cut into chunks by a hash, and every two chunks
    meet in one group, so no group grows with the bucket and no pair is lost.
    """
    keys = [
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")))
        for i, m in enumerate(band_masks(radius, extra))
    ]
    dealt = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(f"n > {bucket_rows}")
    chunks = F.ceil(F.col("n") * 2 / bucket_rows).cast("int")
    large = stored(sizes.select(F.col("key").alias("k"), chunks.alias("chunks")), "simhash-large")
    met = dealt.join(large, F.col("key") == F.col("k"), "left")
    mine = F.pmod(F.xxhash64("fp", F.lit(3)), F.col("chunks")).cast("int")
    met = met.withColumn("mine", F.coalesce(mine, F.lit(0))).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks") - 1, F.lit(0))))
    )
    pair = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))
    rows = met.select(F.when(F.col("chunks").isNull(), F.col("key")).otherwise(pair).alias("key"), "fp")
    placed = rows.repartition("key").sortWithinPartitions("key", "fp")
    return placed.mapInArrow(_links(radius), "a long, b long")


def simhash_components(
    docs: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    width: int = 4,
    radius: int = 4,
    extra: int = 2,
) -> DataFrame:
    """``(id, fp, component_id)`` for every row of ``docs``.

    Texts are put into lower case (A-Z only), cut into words and shingles of ``width``
    words; a text with fewer words is one shingle, one without words has fingerprint
    zero and is linked like any other. Fingerprints link at ``radius`` (at most 15)
    or fewer differing bits; ``component_id`` is the smallest id reachable. A null text
    has no words. Null ids keep a row and take part in links, but are never a component's
    id unless all are null. Repeated rows stay. Other columns are not looked at. An
    empty table gives no rows.
    """
    if not 0 <= radius <= 15:
        raise ValueError("radius must be 0 to 15")
    prepare(docs.sparkSession)
    prints = stored(fingerprints(docs, id_name, text, width), "simhash-prints")
    return _grouped(prints, id_name, radius, extra).drop("root")


def _grouped(prints: DataFrame, id_name: str, radius: int, extra: int) -> DataFrame:
    """``prints(id, fp, ...)`` with ``component_id`` and ``root``, the smallest fingerprint of the component."""
    classes = prints.groupBy("fp").agg(F.min(id_name).alias("least"))
    edges = close_edges(classes.select("fp"), radius, extra)
    roots = connected_components(edges)
    placed = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    placed = stored(placed, "simhash-classes")
    heads = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    names = placed.join(heads, "root").select(F.col("fp").alias("f"), "component_id", "root")
    return prints.join(names, F.col("fp") == F.col("f")).drop("f")


def keep_one(
    docs: DataFrame, id_name: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4, extra: int = 2
) -> DataFrame:
    """One row of each component of ``docs``; columns stay the same, and may have any names.

    It is the row with the smallest id (null ids last); among rows of that id in the component one text stays,
    and of repeated rows one. Texts of any length are compared by their fingerprint alone. An empty table gives no rows.
    """
    rows, doc, words = numbered(docs), number_of(docs, id_name), number_of(docs, text)
    slim = rows.select(doc, F.xxhash64(words).alias("h"), words)
    prepare(docs.sparkSession)
    schema = T.StructType([slim.schema[doc], T.StructField("h", T.LongType()), T.StructField("fp", T.LongType())])
    prints = stored(slim.mapInArrow(_fingerprints([doc, "h"], words, width), schema), "simhash-prints")
    found = _grouped(prints, doc, radius, extra)
    first = F.min(F.struct(F.col(doc).isNull().alias("last"), doc, "fp", "h")).alias("first")
    keep = found.groupBy("root").agg(first).select(F.col(f"first.{doc}").alias("d"), F.col("first.h").alias("t")).distinct()
    kept = rows.join(keep, rows[doc].eqNullSafe(F.col("d")) & (F.xxhash64(words) == F.col("t")), "left_semi")
    # Repeated rows: any of them is the same in id and text.
    turn = W.partitionBy(doc, F.xxhash64(words)).orderBy(F.xxhash64(*rows.columns))
    one = kept.withColumn("turn", F.row_number().over(turn)).where("turn = 1")
    return one.select(*rows.columns).toDF(*docs.columns)
