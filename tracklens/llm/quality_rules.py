"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps its measurements and
one failure bit per rule; policies are versioned masks over the bits, so a new
policy or an ablation needs no second look at any text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.common import column_of, narrow, prepare, raw_texts

WINDOW = 8
SYMBOLS = b"#*$%&|<>"

# Bit of each rule, its limit in brackets. Bits are never given to another rule.
FEW_WORDS = 0  # words < 20
REPEATED_WORDS = 1  # 100 * n_repeat_words > 30 * n_words
SYMBOL_HEAVY = 2  # symbols per word > 0.25
DUPLICATE_LINES = 3  # duplicate lines > 30 % of the lines
SHOUTING = 4  # letters A-Z > 60 % of the letters A-Z and a-z
MARKS = 5  # exclamation and question marks per word > 0.5
WORD_LENGTH = 6  # mean characters of a word outside 2 to 15
NO_LETTERS = 7  # less than half of the words hold a letter or a byte beyond ASCII
RULES = {
    "few_words": FEW_WORDS,
    "repeated_words": REPEATED_WORDS,
    "symbol_heavy": SYMBOL_HEAVY,
    "duplicate_lines": DUPLICATE_LINES,
    "shouting": SHOUTING,
    "marks": MARKS,
    "word_length": WORD_LENGTH,
    "no_letters": NO_LETTERS,
}


def mask_of(*rules: str) -> int:
    return sum(1 << RULES[r] for r in rules)


BASE = mask_of("few_words", "repeated_words")
# Versions stay as they are once published; a change is a new version.
POLICIES = {
    "v1": BASE,
    "v2": BASE | mask_of("symbol_heavy", "duplicate_lines", "shouting", "marks"),
    "v3": BASE
    | mask_of("symbol_heavy", "duplicate_lines", "shouting", "marks", "word_length", "no_letters"),
}
# v4: repeated lines are left to line deduplication; prose that quotes itself stays.
POLICIES["v4"] = POLICIES["v3"] & ~mask_of("duplicate_lines")
CURRENT = "v4"

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_marks", "n_letter_words",
]

_ODD = np.random.default_rng(5).integers(1, 1 << 62, WINDOW, dtype=np.uint64) * 2 + 1


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, n)
    # Odd multipliers and a mixed id keep different windows apart.
    ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    ids ^= ids >> np.uint64(29)
    ids *= np.uint64(0xBF58476D1CE4E5B9)
    ids ^= ids >> np.uint64(32)
    m = n - window + 1
    hashes = np.zeros(m, np.uint64)
    for j in range(window):
        hashes += ids[j : j + m] * _ODD[j]
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(m, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(n + 1, np.int64)
    steps[:m] += twice
    steps[window : window + m] -= twice
    return int((np.cumsum(steps[:n]) > 0).sum())


_BREAK = np.zeros(256, bool)
_BREAK[list(b" \t\n\x0b\x0c\r")] = True
_POINT = np.array([(b & 0xC0) != 0x80 for b in range(256)]) & ~_BREAK
_SYMBOL, _UPPER, _LOWER, _MARK = (np.zeros(256, bool) for _ in range(4))
_SYMBOL[list(SYMBOLS)] = True
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER[ord("a") : ord("z") + 1] = True
_MARK[list(b"!?")] = True
_LETTER = _UPPER | _LOWER | (np.arange(256) >= 128)


def measure(raw: bytes | None) -> tuple[int, ...]:
    """The numbers named in ``MEASURES`` for one text."""
    raw = raw or b""
    words = raw.split()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = raw.split(b"\n")
    worded = [x for x in lines if x.strip()]
    letter_words = 0
    if words:
        data = np.frombuffer(raw, np.uint8)
        inside = ~_BREAK[data]
        start = inside & ~np.concatenate(([False], inside[:-1]))
        number = np.cumsum(start)[_LETTER[data]]
        letter_words = int(np.count_nonzero(np.diff(number)) + 1) if len(number) else 0
    return (
        len(words),
        int(counts[_POINT].sum()),
        int(counts[_SYMBOL].sum()),
        len(worded) - len(set(worded)),
        repeat_words(words),
        len(lines),
        int(counts[_UPPER].sum()),
        int(counts[_LOWER].sum()),
        int(counts[_MARK].sum()),
        letter_words,
    )


def _measured(id_name: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(raw) for raw in raw_texts(column_of(batch, text))]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, id_name), *columns], names=[id_name, *MEASURES]
            )

    return run


def _failures() -> Column:
    """One long whose bit of a rule is set where the document fails it."""
    c, words = F.col, F.col("n_words")
    letters = c("n_upper") + c("n_lower")
    tests = {
        FEW_WORDS: words < 20,
        REPEATED_WORDS: 100 * c("n_repeat_words") > 30 * words,
        SYMBOL_HEAVY: 4 * c("n_symbols") > words,
        DUPLICATE_LINES: 10 * c("n_dup_lines") > 3 * c("n_lines"),
        SHOUTING: 10 * c("n_upper") > 6 * letters,
        MARKS: 2 * c("n_marks") > words,
        WORD_LENGTH: (c("word_chars") < 2 * words) | (c("word_chars") > 15 * words),
        NO_LETTERS: 2 * c("n_letter_words") < words,
    }
    bits = F.lit(0).cast("long")
    for bit, test in tests.items():
        bits = bits.bitwiseOR(F.when(test, F.lit(1 << bit)).otherwise(0).cast("long"))
    return bits


def quality_ledger(docs: DataFrame, id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, MEASURES, failures``: one row for every input row.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``word_chars`` counts code points in words,
    ``n_symbols`` characters of ``#*$%&|<>``, ``n_dup_lines`` lines with a word that
    equal an earlier line, ``n_repeat_words`` words in 8-word windows that occur
    twice or more. A null or empty text has no words and one line, so it fails
    ``few_words`` alone. Null and repeated ids are carried along; other columns
    are not looked at. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    slim = narrow(docs, id_name, text)
    kind = slim.schema[id_name].dataType.simpleString()
    schema = f"`{id_name}` {kind}, " + ", ".join(f"{m} long" for m in MEASURES)
    return slim.mapInArrow(_measured(id_name, text), schema).withColumn("failures", _failures())


def passes(policy: str = CURRENT, bits: str = "failures") -> Column:
    """Whether a ledger row passes a policy."""
    return F.col(bits).bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, fail it alone, and would pass without it.

    Distinct bit patterns are counted first, at most 2 to the number of rules.
    """
    mask = POLICIES[policy]
    patterns = ledger.groupBy(
        F.col("failures").bitwiseAND(F.lit(mask)).alias("failures")
    ).agg(F.count(F.lit(1)).alias("n"))
    rules = [(name, 1 << bit) for name, bit in RULES.items() if mask >> bit & 1]
    each = F.explode(
        F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in rules))
    )
    rows = patterns.withColumn("r", each).select("failures", "n", "r.rule", "r.bit")
    total = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    rest = F.col("failures").bitwiseAND(F.lit(mask).bitwiseXOR(F.col("bit")))
    return rows.groupBy("rule").agg(
        total(F.col("failures").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(F.col("failures") == F.col("bit")).alias("n_failed_alone"),
        total(rest == 0).alias("n_kept_without"),
    )
