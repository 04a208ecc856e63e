"""Removal of long repeated passages by recompression.

Rounds give every run of equal symbols and every chosen pair of neighbours a new
name that depends on content alone, so equal passages get equal symbols inside,
wherever they stand. Each symbol remembers the words its making depended on. A
symbol whose words all lie inside a window of ``window`` words is then the same in
every copy of the window; each window points to the smallest such symbol. Spark
counts the symbols of all documents; only windows that point to a shared symbol are
named themselves (128 bits) and their first place is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.llm.common import column_of, prepare, raw_texts, stored

WINDOW = 20
ROUNDS = 2
CHUNK_WORDS = 1 << 19
_LATE = (1 << 63) - 1  # stands for a null id: after all others
_FAR = 1 << 40
_MOST = np.uint64((1 << 64) - 1)
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES)


class WordNames(dict):
    """64-bit names of words; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        name = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= 1 << 18:
                self.clear()
            self[word] = name
        return name


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x + np.uint64((salt * 2 + 1) * 0xA24BAED4963EE407 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Spans:
    """Names of word spans from prefix sums of words times powers."""

    def __init__(self, names: np.ndarray, which: int):
        n = len(names)
        power = np.full(n + 1, _BASES[which])
        power[0] = 1
        back = np.full(n + 1, _INVERSES[which])
        back[0] = 1
        self.back = np.cumprod(back, dtype=np.uint64)
        powers = np.cumprod(power, dtype=np.uint64)[:n]
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(names * powers, dtype=np.uint64)))

    def name(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]


def symbols(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS):
    """Recompress word names; ``doc`` numbers the document of each word.

    Returns name, start, end of each symbol and the span of words that it depends
    on; a span that reaches beyond its document lies far outside.
    """
    name, start = names, np.arange(len(names))
    end, low, high = start + 1, start.copy(), start + 1
    for turn in range(rounds):
        inner = doc[start[1:]] == doc[start[:-1]]
        before = np.concatenate(([-_FAR], np.where(inner, low[:-1], -_FAR)))
        after = np.concatenate((np.where(inner, high[1:], _FAR), [_FAR]))
        # Runs: neighbours that differ bound a run, so it depends on both.
        head = np.flatnonzero(np.concatenate(([True], ~(inner & (name[1:] == name[:-1])))))
        last = np.append(head[1:], len(name)) - 1
        length = (last - head + 1).astype(np.uint64)
        low = np.minimum(np.minimum.reduceat(low, head), before[head])
        high = np.maximum(np.maximum.reduceat(high, head), after[last])
        name = np.where(length > 1, _mix(name[head] + _mix(length, 77), 3 * turn + 1), name[head])
        start, end = start[head], end[last]
        # Pairs: names fall into two classes; left followed by right is one symbol.
        inner = doc[start[1:]] == doc[start[:-1]]
        left = (_mix(name, 3 * turn + 2) >> np.uint64(63)).astype(bool)
        joined = np.concatenate((inner & left[:-1] & ~left[1:], [False]))
        before = np.concatenate(([-_FAR], np.where(inner, low[:-1], -_FAR)))
        after = np.concatenate((np.where(inner, high[1:], _FAR), [_FAR]))
        keep = np.flatnonzero(~np.concatenate(([False], joined[:-1])))
        pair = joined[keep]
        second = np.minimum(keep + 1, len(name) - 1)
        both = _mix(_mix(name[keep], 3 * turn + 3) + name[second], 3 * turn + 3)
        # A joined pair depends on itself alone; a single one on the side it could join.
        new_low = np.where(pair, np.minimum(low[keep], low[second]), low[keep])
        new_low = np.where(~pair & ~left[keep], np.minimum(new_low, before[keep]), new_low)
        new_high = np.where(pair, np.maximum(high[keep], high[second]), high[keep])
        new_high = np.where(~pair & left[keep], np.maximum(new_high, after[keep]), new_high)
        end = np.where(pair, end[second], end[keep])
        name, start = np.where(pair, both, name[keep]), start[keep]
        low, high = new_low, new_high
    return name, start, end, low, high


class Chunk:
    """Word names, windows and the symbol each window points to, of some documents."""

    def __init__(self, texts: list[list[bytes]], cache: WordNames, window: int, rounds: int):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.n = int(sizes.sum())
        self.first = np.cumsum(sizes) - sizes
        self.doc = np.repeat(np.arange(len(texts)), sizes)
        get = cache.__getitem__
        self.names = np.concatenate(
            [np.fromiter(map(get, t), np.uint64, len(t)) for t in texts] or [np.zeros(0, np.uint64)]
        )
        self.window = window
        count = max(0, self.n - window + 1)
        starts = np.arange(count)
        whole = self.doc[:count] == self.doc[window - 1 : window - 1 + count]
        self.windows = starts[whole]
        if not len(self.windows):
            self.points = np.zeros(0, np.int64)
            return
        name, start, _, low, high = symbols(self.names, self.doc, rounds)
        fine = np.flatnonzero((low >= 0) & (high <= self.n) & (high - low <= window))
        spans = _Spans(self.names, 0)
        self.key = np.zeros(self.n, np.uint64)
        self.key[start[fine]] = _mix(spans.name(low[fine], high[fine]) + _mix(name[fine], 91), 5)
        reach = np.full(self.n, -1, np.int32)
        until = np.full(self.n, 1 << 30, np.int32)
        rank = np.full(self.n, _MOST)
        # Offsets of what a symbol depends on from where it starts.
        reach[start[fine]] = start[fine] - low[fine]
        until[start[fine]] = high[fine] - start[fine]
        rank[start[fine]] = _mix(self.key[start[fine]], 6)
        p = self.windows
        best = np.full(len(p), _MOST)
        self.points = np.full(len(p), -1, np.int64)
        for o in range(window):
            x = p + o
            better = (rank[x] < best) & (reach[x] <= o) & (until[x] <= window - o)
            best[better] = rank[x[better]]
            self.points[better] = x[better]

    def window_names(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        end = chosen + self.window
        high = _Spans(self.names, 0).name(chosen, end)
        low = _Spans(_mix(self.names, 12), 1).name(chosen, end)
        return _mix(high, 8), _mix(low, 9)


def _chunks(batches: Iterator[pa.RecordBatch], most: int, more: str | None = None):
    """((id, text hash) pairs, word lists, further values) of documents with about ``most`` words."""
    ids, texts, extra, size = [], [], [], 0
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        others = column_of(batch, more).to_pylist() if more else [None] * batch.num_rows
        docs = zip(column_of(batch, "doc").to_pylist(), column_of(batch, "h").to_pylist(), strict=True)
        for doc, packed, other in zip(docs, column_of(batch, "packed").to_pylist(), others, strict=True):
            if more and other is None:
                continue
            words = unpack(packed).split()
            ids.append(doc)
            texts.append(words)
            extra.append(other)
            size += len(words)
            if size >= most:
                yield ids, texts, extra
                ids, texts, extra, size = [], [], [], 0
    if ids:
        yield ids, texts, extra


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchors(window: int, rounds: int):
    """(key, doc, h, known): symbols that windows point to, each once per chunk and key.

    What occurs twice within a chunk is known to be shared; then its documents
    are listed at once and a single row stands for the chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordNames()
        for ids, texts, _ in _chunks(batches, CHUNK_WORDS):
            chunk = Chunk(texts, cache, window, rounds)
            at = np.unique(chunk.points[chunk.points >= 0])
            bare = np.unique(chunk.doc[chunk.windows[chunk.points < 0]])
            docs = np.array(ids, np.int64).reshape(-1, 2)
            key = chunk.key[at] if len(at) else np.zeros(0, np.uint64)
            row = chunk.doc[at]
            order = np.lexsort((row, key))
            key, row = key[order], row[order]
            head = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
            same = np.zeros(len(key), bool)
            if len(key):
                twice = key[1:] == key[:-1]
                same[1:] |= twice
                same[:-1] |= twice
            fresh = same & np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1]))) if len(key) else same
            keys = np.concatenate((key[head], key[fresh], np.zeros(len(bare), np.uint64)))
            rows = docs[np.concatenate((row[head], row[fresh], bare)).astype(np.int64)]
            known = np.concatenate((np.zeros(head.sum(), bool), np.ones(fresh.sum() + len(bare), bool)))
            yield pa.RecordBatch.from_arrays(
                [_signed(keys), pa.array(rows[:, 0]), pa.array(rows[:, 1].astype(np.int32)), pa.array(known)],
                names=["key", "doc", "h", "known"],
            )

    return run


def _candidates(window: int, rounds: int):
    """(h1, h2, doc, h, pos, len, known): windows that point to a shared symbol, or to none.

    Of equal windows within a chunk only the first asks; the others start later, so
    they come back as known runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordNames()
        for ids, texts, flagged in _chunks(batches, CHUNK_WORDS, "keys"):
            chunk = Chunk(texts, cache, window, rounds)
            docs = np.array(ids, np.int64).reshape(-1, 2)
            if not len(chunk.windows):
                continue
            pointed = chunk.points >= 0
            asked = ~pointed
            bounds = np.append(chunk.first, chunk.n)
            inside = np.searchsorted(chunk.windows, bounds)
            for i, keys in enumerate(flagged):
                a, b = inside[i], inside[i + 1]
                if a < b:
                    mine = chunk.key[np.maximum(chunk.points[a:b], 0)]
                    asked[a:b] |= np.isin(mine, np.array(keys, np.int64).view(np.uint64)) & pointed[a:b]
            chosen = chunk.windows[asked]
            h1, h2 = chunk.window_names(chosen)
            row = chunk.doc[chosen]
            doc, pos = docs[row, 0], chosen - chunk.first[row]
            order = np.lexsort((pos, doc, h2, h1))
            h1, h2, doc, pos, row = h1[order], h2[order], doc[order], pos[order], row[order]
            head = np.ones(len(h1), bool)
            head[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            group = np.flatnonzero(head)[np.cumsum(head) - 1] if len(h1) else head
            later = (doc != doc[group]) | (pos != pos[group]) if len(h1) else head
            back = np.lexsort((pos[later], row[later]))
            kr, kp = row[later][back], pos[later][back]
            cut = np.ones(len(kr), bool)
            cut[1:] = (kr[1:] != kr[:-1]) | (kp[1:] > kp[:-1] + 1)
            at = np.flatnonzero(cut)
            ends = np.append(at[1:], len(kr))[: len(at)] - 1
            ask = int(head.sum())
            owner = docs[np.concatenate((row[head], kr[at])).astype(np.int64)]
            kd = docs[kr, 0]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(np.concatenate((h1[head], kd[at].view(np.uint64)))),
                    _signed(np.concatenate((h2[head], kp[at].astype(np.int64).view(np.uint64)))),
                    pa.array(owner[:, 0]),
                    pa.array(owner[:, 1].astype(np.int32)),
                    pa.array(np.concatenate((pos[head], kp[at])).astype(np.int32)),
                    pa.array(np.concatenate((np.ones(ask, np.int64), kp[ends] - kp[at] + 1)).astype(np.int32)),
                    pa.array(np.concatenate((np.zeros(ask, bool), np.ones(len(at), bool)))),
                ],
                names=["h1", "h2", "doc", "h", "pos", "len", "known"],
            )

    return run


def _pack(text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = pa.array([pack(raw or b"") for raw in raw_texts(column_of(batch, text))], pa.binary())
            columns = [column_of(batch, n) for n in names] + [packed]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "packed"])

    return run


def _remove(text: str, window: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            kept, words_n, removed = [], [], []
            runs = column_of(batch, "runs").to_pylist()
            copies = column_of(batch, "copy").to_pylist()
            for packed, found, copy in zip(column_of(batch, "packed").to_pylist(), runs, copies, strict=True):
                words = unpack(packed).split()
                words_n.append(len(words))
                if copy and len(words) >= window:
                    words = []
                elif found:
                    steps = np.zeros(len(words) + 1, np.int64)
                    at = np.array([(r["pos"], r["len"]) for r in found], np.int64)
                    at = at[at[:, 0] + at[:, 1] + window - 2 < len(words)]
                    np.add.at(steps, at[:, 0], 1)
                    np.add.at(steps, at[:, 0] + at[:, 1] + window - 1, -1)
                    stay = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
                    words = [words[i] for i in stay]
                removed.append(words_n[-1] - len(words))
                kept.append(b" ".join(words))
            made = {
                text: pa.array(kept, pa.binary()).cast(pa.string()),
                "n_words": pa.array(words_n, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(
                [made[n] if n in made else column_of(batch, n) for n in names], names=names
            )

    return run


def remove_repeats(
    docs: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``docs`` with ``text`` cut to the words kept, plus ``n_words`` and ``n_removed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a window of ``window``
    words covers it whose words also start earlier: in a smaller id, or earlier in the
    same document. Windows are judged on the input. Kept words are joined by one space,
    also where nothing goes; null and empty texts become an empty text. Null ids count as
    one document after all others (ids stay below 2**63 - 1). Rows with the same id are
    one document, each judged by its own text: of equal starts none is earlier. Other columns pass through; input
    columns named ``n_words`` or ``n_removed`` are replaced. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    base = docs.drop("n_words", "n_removed")
    fields = base.schema.fields
    out = T.StructType(
        fields + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    )
    # Inside, the columns have numbered names, so none can clash; the text travels packed.
    inner = [f"c{i}" for i in range(len(fields))]
    place = {f.name: n for f, n in zip(fields, inner, strict=True)}
    rest = [n for n in inner if n != place[text]]
    # The hash of the text tells rows with the same id apart.
    plain = base.toDF(*inner).withColumns({
        "doc": F.coalesce(F.col(place[id_name]).cast("long"), F.lit(_LATE)),
        "h": F.hash(place[text]),
    })
    kinds = plain.schema
    schema = T.StructType(
        [kinds[n] for n in [*rest, "doc", "h"]] + [T.StructField("packed", T.BinaryType())]
    )
    # Of equal texts only the first is looked into: all windows of the others start earlier there.
    same = [F.xxhash64(place[text]).alias("k"), F.length(place[text]).alias("n")]
    ids = stored(plain.where(F.length(place[text]) > 0).select("doc", "h", *same), "text-names")
    firsts = ids.groupBy("k", "h", "n").agg(F.min("doc").alias("first"), F.max("doc").alias("final"))
    copies = stored(
        ids.join(firsts.where("first <> final").drop("final"), ["k", "h", "n"])
        .where("doc <> first").select("doc", "h").distinct(),
        "text-copies",
    )
    # The texts are dealt out once; all steps below read that one exchange.
    packed = plain.mapInArrow(_pack(place[text], [*rest, "doc", "h"]), schema).repartition("doc", "h")
    texts = packed.join(copies, ["doc", "h"], "left_anti")
    anchors = texts.mapInArrow(_anchors(window, rounds), "key long, doc long, h int, known boolean")
    spread = F.when(F.col("known"), F.xxhash64("doc", "key")).otherwise(F.col("key"))
    every = W.partitionBy("known", "slot")
    shared = (
        anchors.withColumn("slot", spread)
        .withColumn("n", F.count(F.lit(1)).over(every))
        .where("known or n > 1")
        .groupBy("doc", "h").agg(F.collect_set("key").alias("keys"))
    )
    asked = texts.join(shared, ["doc", "h"])
    found = asked.mapInArrow(
        _candidates(window, rounds), "h1 long, h2 long, doc long, h int, pos int, len int, known boolean"
    )
    first = W.partitionBy("known", "h1", "h2").orderBy("doc", "pos")
    later = (
        found.withColumn("fd", F.first("doc").over(first)).withColumn("fp", F.first("pos").over(first))
        .where("known or doc <> fd or pos <> fp")
        .groupBy("doc", "h").agg(F.collect_list(F.struct("pos", "len")).alias("runs"))
    )
    joined = packed.join(later, ["doc", "h"], "left").join(
        copies.withColumn("copy", F.lit(True)), ["doc", "h"], "left"
    )
    renamed = T.StructType([T.StructField(place.get(f.name, f.name), f.dataType) for f in out.fields])
    names = [place.get(f.name, f.name) for f in out.fields]
    return joined.mapInArrow(_remove(place[text], window, names), renamed).toDF(*out.fieldNames())
