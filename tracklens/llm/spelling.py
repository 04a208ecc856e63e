"""Spelling variants grouped by pivotal grams.

Two words that differ by one edit share a rare bigram: of two disjoint bigrams of a word, its
pivots, one edit leaves at least one as it is. Bigrams have one global order, rarest
first; a word's gram prefix is its three rarest, and its pivots are the two disjoint ones
of that prefix that are cheapest in frequency, found by dynamic programming. Of two near
words the one whose prefix ends earlier in the global order (ties: the smaller word) has a
surviving pivot in the other's prefix, so pivots are matched with prefixes alone.

Position limits make the match narrow. An edit before the second pivot leaves all from
that pivot to the word's end; any other edit leaves all from the word's start to the end
of the first pivot. So the key of a match is the pivot with the whole untouched side, and
the length of the other word. What meets under a key is compared by the parities of its letters and
bigrams first, in arrays, and verified by edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.common import column_of, narrow, prepare, raw_texts, stored

LEAST_POINTS = 7
LEAST_COUNT = 2
RATIO = 10
PREFIX_GRAMS = 3
# Words counted in a task before they are handed on.
HELD_WORDS = 1 << 18
# Keys with more words on a side are cut into parts of so many.
BUCKET_ROWS = 2048
# Rows in whole keys looked at together, and pairs compared at once.
BLOCK_ROWS = 1 << 16
PAIRS = 1 << 20
_LETTERS = np.uint64((1 << 24) - 1)


def _counted(id_name: str, text: str, least: int, typo_every: int):
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        crc = zlib.crc32
        for batch in batches:
            ids = column_of(batch, id_name).to_pylist()
            for doc, raw in zip(ids, raw_texts(column_of(batch, text)), strict=True):
                # bytes.lower() changes A-Z alone; shorter runs cannot become words.
                found = runs.findall(raw.lower().decode()) if raw else []
                if typo_every and found:
                    start = crc(f"{'' if doc is None else doc}:".encode())
                    for i, word in enumerate(found):
                        h = crc(word.encode(), start)
                        if h % typo_every == 0:
                            at = h % len(word)
                            found[i] = word[:at] + word[at + 1 :]
                counts.update(found)
                if len(counts) > HELD_WORDS:
                    yield flush(counts)
                    counts = Counter()
        if counts:
            yield flush(counts)

    return run


def word_counts(
    docs: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    least: int = LEAST_POINTS,
    least_count: int = LEAST_COUNT,
    typo_every: int = 0,
) -> DataFrame:
    """``(word, n)``: runs of Latin letters of at least ``least`` code points, and their occurrences.

    Only A-Z are put into lower case. With ``typo_every`` k, an occurrence whose crc32 of
    ``<id>:<run>`` is divisible by k loses the code point at crc32 modulo length; a null id reads as
    empty there. Occurrences are added up in each task before they are shuffled. Null texts hold no words.
    """
    slim = narrow(docs, id_name, text)
    parts = slim.mapInArrow(_counted(id_name, text, least, typo_every), "word string, n long")
    counted = parts.groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= least_count) & (F.char_length("word") >= least))


def pivots(grams: list[tuple[int, int]], k: int = 2, width: int = 2) -> list[int]:
    """Positions of ``k`` disjoint grams of least total cost among ``(position, cost)``, left to right.

    ``best[j]`` is the cheapest choice of j grams among those seen so far; a gram extends the
    best choice that ends before it begins.
    """
    best: list[tuple[int, tuple[int, ...]] | None] = [(0, ())] + [None] * k
    seen: list[tuple[int, list]] = [(-1, list(best))]
    for at, cost in sorted(grams):
        before = next(state for end, state in reversed(seen) if end < at)
        for j in range(1, k + 1):
            if before[j - 1] is not None:
                new = (before[j - 1][0] + cost, (*before[j - 1][1], at))
                if best[j] is None or new < best[j]:
                    best[j] = new
        seen.append((at + width - 1, list(best)))
    return list(best[k][1])


def _key(side: str, length: int, part: str) -> int:
    x = xxhash.xxh3_64_intdigest(f"{side}{length} {part}".encode())
    return x - (1 << 64) if x >> 63 else x


def parities(word: str) -> int:
    """64 bits: each of the lower 24 is the parity of some letters, each other one that of some bigrams.

    An edit changes two of the lower and four of the upper bits at most.
    """
    bits = 0
    for c in map(ord, word):
        bits ^= 1 << c % 24
    for c, d in pairwise(map(ord, word)):
        bits ^= 1 << 24 + (c * 31 + d) % 40
    return bits - (1 << 64) if bits >> 63 else bits


def word_keys(word: str, order: dict[str, tuple[int, int]]) -> tuple[int, int, int, list[int], list[int], list[int]]:
    """Last rank of the prefix, length from the second pivot on, parity, and the keys: pivots left, right, prefix."""
    size = len(word)
    grams = [(order[word[i : i + 2]], i) for i in range(size - 1)]
    last = sorted(grams)[PREFIX_GRAMS - 1][0][0]
    # All places of the last gram belong to the prefix.
    prefix = [(i, cost) for (rank, cost), i in grams if rank <= last]
    one, two = pivots(prefix)
    lengths = (size - 1, size, size + 1)
    left = [_key("l", n, word[: one + 2]) for n in lengths]
    right = [_key("r", n, word[two:]) for n in lengths]
    index = [_key("l", size, word[: i + 2]) for i, _ in prefix] + [_key("r", size, word[i:]) for i, _ in prefix]
    return last, size - two, parities(word), left, right, index


def _keyed(order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = order.value
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3]
        for batch in batches:
            rows = [word_keys(w, table) for w in column_of(batch, "word").to_pylist()]
            columns = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "word"), column_of(batch, "n"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["word", "n", "last", "tail", "parity", "piv_left", "piv_right", "pre"],
            )

    return run


def _gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Rank and frequency of each bigram, rarest first; 90 letters make at most 8,100."""
    grams = F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substr("word", i, F.lit(2))))
    counts = words.select(grams.alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    ordered = sorted((r["n"], r["gram"]) for r in counts)
    return {gram: (rank, n) for rank, (n, gram) in enumerate(ordered)}


def _candidates(rows: pa.Table) -> pa.RecordBatch:
    """Pivot and prefix rows that meet under a key of ``rows``, which are sorted, and may be one edit apart."""
    key, side, last, parity = (rows.column(n).to_numpy() for n in ("key", "side", "last", "parity"))
    parity = parity.view(np.uint64)
    piv, pre = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    first, end = (np.searchsorted(key[pre], key[piv], at) for at in ("left", "right"))
    piv, first, size = piv[end > first], first[end > first], (end - first)[end > first]
    total = np.cumsum(size)
    found = [(np.zeros(0, np.int64),) * 2]
    at = 0
    while at < len(piv):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
        n = size[at:to]
        a = np.repeat(piv[at:to], n)
        b = pre[np.arange(len(a)) + np.repeat(first[at:to] - (np.cumsum(n) - n), n)]
        differ = parity[a] ^ parity[b]
        near = np.flatnonzero(np.bitwise_count(differ & _LETTERS) <= 2)
        near = near[np.bitwise_count(differ[near] & ~_LETTERS) <= 4]
        a, b = a[near], b[near]
        fine = last[a] <= last[b]
        found.append((a[fine], b[fine]))
        at = to
    a, b = (pa.array(np.concatenate(x)) for x in zip(*found, strict=True))
    taken = [rows.column(n).take(x).combine_chunks() for x, names in ((a, ("word", "n", "last", "tail")), (b, ("word", "n", "last"))) for n in names]
    return pa.RecordBatch.from_arrays(taken, names=["a", "na", "la", "tail", "b", "nb", "lb"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, a block of whole keys at a time."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= BLOCK_ROWS:
            rows = pa.Table.from_batches(held)
            key = rows.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1], "left"))
            if cut:
                yield _candidates(rows.slice(0, cut))
            held, size = rows.slice(cut).combine_chunks().to_batches(), rows.num_rows - cut
    if held:
        yield _candidates(pa.Table.from_batches(held))


def near_pairs(words: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(a, na, b, nb)``: every two of ``words(word, n)`` that are one edit apart, once.

    ``words`` are distinct, of Latin letters, with at least four code points. Keys with more than
    ``bucket_rows`` words in prefixes are cut into parts on both sides, and every two parts meet.
    """
    spark = prepare(words.sparkSession)
    order = spark.sparkContext.broadcast(_gram_order(words))
    lists = "piv_left array<long>, piv_right array<long>, pre array<long>"
    keyed = stored(
        words.select("word", "n").mapInArrow(
            _keyed(order), f"word string, n long, last int, tail int, parity long, {lists}"
        ), "spelling-keys",
    )
    base = ["word", "n", "last", "parity"]
    left = F.transform("piv_left", lambda k: F.struct(k.alias("key"), F.col("tail").alias("tail")))
    right = F.transform("piv_right", lambda k: F.struct(k.alias("key"), F.lit(0).alias("tail")))
    piv = keyed.select(*base, F.inline(F.concat(left, right)))
    pre = keyed.select(*base, F.explode("pre").alias("key"), F.lit(0).alias("tail"))
    sizes = pre.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)
    sizes = stored(sizes, "spelling-large")
    asked = piv.select("key").join(sizes, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    parts = lambda n: F.ceil(F.col(n) / bucket_rows).cast("int")
    large = stored(sizes.join(asked, "key").select(F.col("key").alias("k"), parts("m").alias("parts0"), parts("n").alias("parts1")), "spelling-parts")

    def dealt(rows: DataFrame, side: int) -> DataFrame:
        met = rows.join(large, F.col("key") == F.col("k"), "left")
        own, other = F.col(f"parts{side}"), F.col(f"parts{1 - side}")
        met = met.withColumn("mine", F.pmod(F.xxhash64("word"), own).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.coalesce(other - 1, F.lit(0))))
        )
        pair = (F.col("mine"), F.col("other")) if side == 0 else (F.col("other"), F.col("mine"))
        key = F.when(F.col("k").isNull(), F.col("key")).otherwise(F.xxhash64("key", *pair)).alias("key")
        return met.select(key, F.lit(side).alias("side"), "word", "n", "last", "parity", "tail")

    rows = dealt(piv, 0).unionByName(dealt(pre, 1)).repartition("key").sortWithinPartitions("key")
    met = rows.mapInArrow(_meet, "a string, na long, la int, tail int, b string, nb long, lb int")
    # A pair found from the right side of the word is not taken from the left again.
    again = (F.col("tail") > 0) & (F.expr("right(a, tail)") == F.expr("right(b, tail)"))
    first = (F.col("la") < F.col("lb")) | (F.col("a") < F.col("b"))
    return met.where(first & (F.levenshtein("a", "b", 1) == 1) & ~again).select("a", "na", "b", "nb")


def _roots(forms: DataFrame, rounds: int = 32) -> DataFrame:
    """``(word, root)`` for each word with a form: both halves of a chain are joined until none grows."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        on = now.select(F.col("word").alias("w"), F.col("root").alias("further"))
        step = now.join(on, F.col("root") == F.col("w"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        step = stored(step, "spelling-roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now
    raise RuntimeError(f"chains of forms did not end in {rounds} rounds")


def variants(words: DataFrame, ratio: int = RATIO, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``words(word, n)``.

    A word's form is the near word (one code point inserted, deleted or replaced) of largest n,
    the smallest in code-point order among equals, if that n is at least ``ratio`` times the
    word's; else null. ``root`` follows forms to the last one. Words must be distinct, of a-z and
    U+00C0 to U+00FF, with four code points or more. An empty table gives no rows.
    """
    words = stored(words.select("word", "n"), "spelling-words")
    pairs = stored(near_pairs(words, bucket_rows), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
    near = both.groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("less"), F.col("b"))).alias("best")
    )
    large = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    formed = words.join(near, F.col("word") == F.col("a"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("best.b")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(formed, "spelling-forms")
    roots = _roots(formed.where("form is not null")).withColumnRenamed("word", "w")
    return formed.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    least: int = LEAST_POINTS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    typo_every: int = 0,
) -> DataFrame:
    """Spelling variants among the words of whole texts: ``variants`` of ``word_counts``.

    Null and empty texts hold no words; repeated rows count as often as they are there; a null id takes
    part. Very long words are words like any other. Other columns are not looked at, whatever
    their names. An empty table, or one without words, gives no rows.
    """
    if least < 4:
        raise ValueError("words need at least four code points")
    prepare(docs.sparkSession)
    return variants(word_counts(docs, id_name, text, least, least_count, typo_every), ratio)
