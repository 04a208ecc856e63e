"""SentencePiece encoding and decoding by finite-state transducers.

The normaliser is a one-state transducer that escapes spaces, with an arc that
emits the dummy prefix. Pieces are arcs from position to position; a character that no
piece holds has one arc that emits its bytes. The states of the piece transducer are
the last pieces, and its arcs carry weights of the tropical semiring: minus the score for a
unigram model; for a BPE model 0 where two pieces may stand side by side after merging
and infinity (no arc) where a merge across their border would have come first. The
composition with a text is walked once from left to right, taking the best arc into
each position. A BPE model leaves a single finite path, which is the result of its merges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tracklens.llm.common import column_of, prepare

SPACE = "▁"
MOST_MODEL_BYTES = 32 << 20
_CACHE = 1 << 19
# Stretches of more characters are walked one by one and not remembered.
_SHORT = 64
# Characters of texts that are encoded together.
_TOGETHER = 1 << 19
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
# Where no piece begins, one character goes by itself.
_UNKNOWN_ARC = ((1, -1),)


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field number and value of a serialised protocol buffer message."""
    at, end = 0, len(data)

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield tag >> 3, data[at : at + size]
        at += size


class Table:
    """A hash table of whole numbers in arrays: many keys are asked or added at once.

    A key lies at its hash or in one of the next places; none holds -1.
    """

    def __init__(self, bits: int = 12):
        self.bits, self.count, self.reach = bits, 0, 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and their values; 0 for those that are not."""
        at = self._place(keys)
        there, held = self.keys[at] == keys, self.values[at]
        open_ = np.flatnonzero(~there & (self.keys[at] != -1))
        for step in range(1, self.reach):
            if not len(open_):
                break
            place = (at[open_] + step) & (len(self.keys) - 1)
            hit = self.keys[place] == keys[open_]
            there[open_[hit]], held[open_[hit]] = True, self.values[place[hit]]
            open_ = open_[~hit & (self.keys[place] != -1)]
        return there, np.where(there, held, 0)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are distinct and not there yet."""
        if 3 * (self.count + len(keys)) > len(self.keys):
            old = self.keys >= 0
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            self.__init__(max(12, int(4 * len(keys)).bit_length()))
        self.count += len(keys)
        at = self._place(keys)
        for step in range(len(self.keys)):
            self.reach = max(self.reach, step + 1)
            place = (at + step) & (len(self.keys) - 1)
            free = np.flatnonzero(self.keys[place] == -1)
            first = free[np.unique(place[free], return_index=True)[1]]
            self.keys[place[first]], self.values[place[first]] = keys[first], values[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, values, at = keys[left], values[left], at[left]
            if not len(keys):
                return


class Model:
    """The compiled transducers of one model file."""

    def __init__(self, data: bytes):
        import struct

        pieces, trainer, normaliser = [], {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normaliser = dict(_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {self.kind} is neither unigram nor BPE")
        if normaliser.get(2):
            raise ValueError("the model's normaliser has a character map; only identity is built")
        if normaliser.get(5, 1) == 0 or trainer.get(24, 0):
            raise ValueError("the model does not escape spaces, or puts them at the end of words")
        if any(k == USER for _, _, k in pieces):
            raise ValueError("the model has user-defined symbols")
        self.prefix = bool(normaliser.get(3, 1))
        self.trim = bool(normaliser.get(4, 1))
        self.names = [p for p, _, _ in pieces]
        self.kinds = [k for _, _, k in pieces]
        self.scores = [s for _, s, _ in pieces]
        self.arcs = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.unknown = next(i for i, k in enumerate(self.kinds) if k == UNKNOWN)
        self.longest = max(map(len, self.arcs))
        self.lowest = min((self.scores[i] for i in self.arcs.values()), default=0.0)
        if self.kind == BPE:
            self._rank()

    def _rank(self) -> None:
        """Order of merges, and the two parts of the merge that makes each piece."""
        merges = sorted((i for p, i in self.arcs.items() if len(p) > 1), key=lambda i: -self.scores[i])
        self.rank = {i: 0 for p, i in self.arcs.items() if len(p) == 1}
        self.rank |= {i: r + 1 for r, i in enumerate(merges)}
        self.parts: dict[int, tuple[int, int]] = {}
        unmade = []
        for i in merges:
            made = self._split(self.names[i])
            if made:
                self.parts[i] = made
            else:
                unmade.append(i)
        # What merging never makes cannot be on a path.
        for i in unmade:
            del self.arcs[self.names[i]]

    def _split(self, piece: str) -> tuple[int, int] | None:
        symbols = list(piece)
        if any(c not in self.arcs for c in symbols):
            return None
        while len(symbols) > 2:
            best = at = None
            for k in range(len(symbols) - 1):
                i = self.arcs.get(symbols[k] + symbols[k + 1])
                if i is not None and (best is None or self.rank[i] < best):
                    best, at = self.rank[i], k
            if at is None:
                return None
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return self.arcs[symbols[0]], self.arcs[symbols[1]]

    @cached_property
    def tree(self) -> dict:
        """The pieces as a tree of characters; under 0, all pieces on the way as (length, id)."""
        root: dict = {0: ()}
        for piece, i in sorted(self.arcs.items()):
            node = root
            for c in piece:
                node = node.setdefault(c, {0: node[0]})
            node[0] += ((len(piece), i),)
        return root

    @cached_property
    def cuts(self) -> re.Pattern:
        """Splits text where no piece can stand across: before spaces and around line ends."""
        inner = {p[k : k + 2] for p in self.arcs for k in range(len(p) - 1)}
        if any(x[1] == SPACE and x[0] != SPACE for x in inner) or any("\n" in p for p in self.arcs):
            return re.compile("(?s).+")
        return re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether no merge across the border of two pieces comes before those inside them."""
        rank, parts, names, arcs = self.rank, self.parts, self.names, self.arcs
        limit = 1 << 60
        while True:
            both = arcs.get(names[a] + names[b])
            if both is not None and rank[both] < limit:
                return False
            if rank[a] > rank[b]:
                limit = rank[a]
                a = parts[a][1]
            elif b in parts:
                limit = rank[b] + 1
                b = parts[b][0]
            else:
                return True

    def _side_by_side_all(self, pair: np.ndarray) -> np.ndarray:
        """``side_by_side`` for packed pairs; a table remembers a bounded number of them."""
        table = self.__dict__.setdefault("_table", Table())
        known, said = table.get(pair)
        if not known.all():
            new = np.unique(pair[~known])
            if table.count > 8 * _CACHE:
                table = self._table = Table()
                new = np.unique(pair)
            fits = np.array([self.side_by_side(x >> 32, x & 0xFFFFFFFF) for x in new.tolist()], np.int64)
            table.add(new, fits)
            said = table.get(pair)[1]
        return said.astype(bool)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("cuts", "tree", "surfaces", "_arrays", "_paths", "_pairs", "_table")}

    def normalise(self, text: str) -> str:
        if self.trim:
            text = " ".join(x for x in text.split(" ") if x)
        text = text.replace(" ", SPACE)
        return SPACE + text if text and self.prefix else text

    def encode(self, text: str) -> list[int]:
        """Piece ids of a whole text."""
        return np.frombuffer(self.encode_all([text])[0], np.int32).tolist()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Piece ids of whole texts, four bytes each; equal stretches are worked out once and remembered for a while."""
        paths = self.__dict__.setdefault("_paths", {})
        found = [self.cuts.findall(self.normalise(t)) for t in texts]
        every = set(chain.from_iterable(found))
        new = every - paths.keys()
        if len(paths) + len(new) > _CACHE:
            paths.clear()
            new = every
        short = [p for p in new if len(p) <= _SHORT]
        if self.kind == BPE and len(short) > 50:
            paths.update(zip(short, self._merged_all(short), strict=True))
        else:
            paths.update((p, _packed(self._path(p))) for p in short)
        long = [p for p in new if len(p) > _SHORT]
        paths.update((p, _packed(self._path(p))) for p in long)
        out = [b"".join(map(paths.__getitem__, parts)) for parts in found]
        for p in long:
            del paths[p]
        return out

    def _path(self, text: str) -> tuple[int, ...]:
        """Shortest path through the composition of one stretch with the pieces."""
        return self._merged(text) if self.kind == BPE else self._lightest(text)

    @cached_property
    def _arrays(self) -> tuple[Table, np.ndarray, np.ndarray]:
        """The tree of pieces as a table of (node, char) to node, each node's piece, and the pieces' sizes."""
        keys, nodes, pieces, todo = [], [], [-1], [(0, self.tree)]
        while todo:
            number, node = todo.pop()
            for c, step in node.items():
                if c == 0:
                    continue
                keys.append(number << 21 | ord(c))
                nodes.append(len(pieces))
                whole = step[0] if len(step[0]) > len(node[0]) else ()
                pieces.append(whole[-1][1] if whole else -1)
                todo.append((nodes[-1], step))
        table = Table()
        table.add(np.array(keys, np.int64), np.array(nodes, np.int64))
        return table, np.array(pieces, np.int64), np.array([len(n) for n in self.names], np.int64)

    def _merged_all(self, parts: list[str]) -> list[bytes]:
        """``_merged`` for many short stretches at once, position by position.

        The text before a position settles its state, so of all arcs into a position exactly one
        has weight 0; arrays hold that arc for every position of every stretch.
        """
        table, pieces, sizes = self._arrays
        length = np.fromiter(map(len, parts), np.int64, len(parts))
        chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        part = np.repeat(np.arange(len(parts)), length)
        end = np.repeat(np.cumsum(length), length)
        offset = np.arange(len(chars)) - np.repeat(np.cumsum(length) - length, length)
        # Compose: walk the tree from every position at once, noting the arcs on the way.
        start, node, arcs = np.arange(len(chars)), np.zeros(len(chars), np.int64), []
        known = np.zeros(len(chars), bool)
        for depth in range(self.longest):
            fine = start + depth < end[start]
            start, node = start[fine], node[fine]
            if not len(start):
                break
            fine, node = table.get(node << 21 | chars[start + depth])
            start, node = start[fine], node[fine]
            whole = pieces[node] >= 0
            arcs.append((start[whole], np.full(int(whole.sum()), depth + 1), pieces[node[whole]]))
            known[start] = True
        start, size, piece = (np.concatenate(x) for x in zip(*arcs, strict=True))
        # Borders are numbered so that every stretch has one more than characters.
        border = start + part[start]
        order = np.argsort(offset[start], kind="stable")
        border, size, piece, turn = border[order], size[order], piece[order], offset[start][order]
        last = np.full(len(chars) + len(parts), -2, np.int64)
        last[np.cumsum(length) - length + np.arange(len(parts))] = -1
        turns = np.searchsorted(turn, np.arange(int(length.max()) + 1))
        for a, b in zip(turns, turns[1:], strict=False):
            before = last[border[a:b]]
            fits = before == -1
            asked = np.flatnonzero(before >= 0)
            fits[asked] = self._side_by_side_all(before[asked] << 32 | piece[a:b][asked])
            last[(border[a:b] + size[a:b])[fits]] = piece[a:b][fits]
        # Follow the arcs back from the ends.
        at = np.cumsum(length) + np.arange(len(parts))
        live, steps = np.arange(len(parts)), []
        left = length.copy()
        broken = np.zeros(len(parts), bool)
        broken[part[~known]] = True
        while len(live):
            piece = last[at[live]]
            broken[live[piece < 0]] = True
            live, piece = live[piece >= 0], piece[piece >= 0]
            steps.append((live, piece))
            at[live] -= sizes[piece]
            left[live] -= sizes[piece]
            live = live[left[live] > 0]
        owner = np.concatenate([x for x, _ in steps[::-1]])
        flat = np.concatenate([x for _, x in steps[::-1]])
        flat = flat[np.argsort(owner, kind="stable")].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(parts)))).tolist()
        out = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for i in np.flatnonzero(broken).tolist():
            # Characters without a piece are spelled one stretch at a time.
            out[i] = _packed(self._merged(parts[i]))
        return out

    def _bytes_of(self, char: str) -> tuple[int, ...]:
        raw = char.encode()
        if all(b in self.bytes for b in raw):
            return tuple(self.bytes[b] for b in raw)
        return (self.unknown,)

    def _merged(self, text: str) -> tuple[int, ...]:
        """The one finite path: all its arcs weigh 0, so the first whole path found is the shortest.

        Depth first with the longest pieces first. A position's state is settled by the text
        before it, so a position from which no path led on is never tried again.
        """
        if text in self.arcs:
            return (self.arcs[text],)
        n, root, longest = len(text), self.tree, self.longest
        pairs = self.__dict__.setdefault("_pairs", {})
        if len(pairs) >= 4 * _CACHE:
            pairs.clear()
        dead: set[int] = set()
        out: list[int] = []
        begun: list[int] = []
        left: list[tuple] = []
        at, arcs, k, before = 0, None, 0, -1
        while at < n:
            if arcs is None:
                node = root
                for c in text[at : at + longest]:
                    step = node.get(c)
                    if step is None:
                        break
                    node = step
                arcs = node[0] or _UNKNOWN_ARC
                k = len(arcs)
            while k:
                k -= 1
                size, piece = arcs[k]
                if dead and at + size in dead:
                    continue
                if before >= 0 and piece >= 0:
                    pair = before << 32 | piece
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self.side_by_side(before, piece)
                    if not fits:
                        continue
                out.append(piece)
                begun.append(at)
                left.append((arcs, k))
                at, arcs, before = at + size, None, piece
                break
            else:
                dead.add(at)
                out.pop()
                at = begun.pop()
                arcs, k = left.pop()
                before = out[-1] if out else -1
        if -1 not in out:
            return tuple(out)
        spelled = ((p,) if p >= 0 else self._bytes_of(text[i]) for i, p in zip(begun, out, strict=True))
        return tuple(chain.from_iterable(spelled))

    def _lightest(self, text: str) -> tuple[int, ...]:
        n, arcs = len(text), self.arcs
        cost = [0.0] + [float("inf")] * n
        back: list[int] = [-1] * (n + 1)
        # An unknown character costs 10 more than the rarest piece.
        none = 10.0 - self.lowest
        for at in range(n):
            for end in range(at + 1, min(n, at + self.longest) + 1):
                piece = arcs.get(text[at:end])
                if piece is not None and cost[at] - self.scores[piece] < cost[end]:
                    cost[end], back[end] = cost[at] - self.scores[piece], piece
            if text[at] not in arcs and cost[at] + none < cost[at + 1]:
                cost[at + 1], back[at + 1] = cost[at] + none, -1
        out, at = [], n
        while at:
            piece = back[at]
            if piece < 0:
                out += reversed(self._bytes_of(text[at - 1]))
                at -= 1
            else:
                out.append(piece)
                at -= len(self.names[piece])
        return tuple(reversed(out))

    @cached_property
    def surfaces(self) -> list[bytes]:
        """The bytes that each id stands for."""
        out = []
        for i, (name, kind) in enumerate(zip(self.names, self.kinds, strict=True)):
            if kind == BYTE:
                out.append(bytes([int(name[1:-1], 16)]))
            elif kind == CONTROL:
                out.append(b"")
            elif i == self.unknown:
                out.append(" ⁇ ".encode())
            else:
                out.append(name.replace(SPACE, " ").encode())
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of piece ids: the inverse transducer."""
        surfaces = self.surfaces
        raw = b"".join([surfaces[i] for i in ids])
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._patched(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), self.unknown)
        # Only a piece can hold the dummy prefix; a space from a byte is text.
        prefixed = self.prefix and self.kinds[first] == NORMAL and self.names[first][0] == SPACE
        return text[1:] if prefixed else text

    def _patched(self, ids: list[int]) -> str:
        """Each byte that is no part of a character becomes U+FFFD."""
        out, held = [], b""
        for i in [*ids, None]:
            if i is not None and self.kinds[i] == BYTE:
                held += self.surfaces[i]
                continue
            while held:
                for size in range(min(4, len(held)), 0, -1):
                    try:
                        out.append(held[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                held = held[size:]
            if i is not None:
                out.append(self.surfaces[i].decode())
        return "".join(out)


def _packed(ids: tuple[int, ...]) -> bytes:
    return np.array(ids, np.int32).tobytes()


def load(path: str) -> Model:
    """Compile the model file at a path of the driver; at most 32 MiB."""
    with open(path, "rb") as file:
        data = file.read(MOST_MODEL_BYTES + 1)
    if len(data) > MOST_MODEL_BYTES:
        raise ValueError("the model file is larger than 32 MiB")
    return Model(data)


def _encoded(model, text: str, names: list[str], check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: Model = model.value
        for batch in batches:
            texts = [t or "" for t in column_of(batch, text).to_pylist()]
            tokens: list[bytes] = []
            while len(tokens) < len(texts):
                first, size = len(tokens), 0
                last = first
                while last < len(texts) and size < _TOGETHER:
                    size += len(texts[last])
                    last += 1
                tokens += compiled.encode_all(texts[first:last])
            counts = np.fromiter((len(raw) // 4 for raw in tokens), np.int64, len(tokens))
            flat = np.frombuffer(b"".join(tokens), np.int32)
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            made = {"tokens": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), "n_tokens": pa.array(counts)}
            if check:
                given = column_of(batch, text).is_valid().to_pylist()
                same = [
                    compiled.decode(np.frombuffer(raw, np.int32).tolist()) == t if valid else None
                    for raw, t, valid in zip(tokens, texts, given, strict=True)
                ]
                made["round_trip"] = pa.array(same, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [made[n] if n in made else column_of(batch, n) for n in names], names=names
            )

    return run


def encode(docs: DataFrame, model_path: str, text: str = "text", check: bool = False) -> DataFrame:
    """``docs`` with ``tokens`` (array of int) and ``n_tokens``; no shuffle.

    Whole texts are encoded; null and empty texts have no tokens. With ``check`` the tokens
    are decoded again and ``round_trip`` tells whether the text comes back (null for
    a null text). Other columns pass through; columns of those names are replaced.
    An empty table gives no rows. The compiled model (bounded, 32 MiB of file) is broadcast.
    """
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(load(model_path))
    made = [T.StructField("tokens", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    if check:
        made.append(T.StructField("round_trip", T.BooleanType()))
    base = docs.drop(*(f.name for f in made))
    schema = T.StructType(base.schema.fields + made)
    return base.mapInArrow(_encoded(model, text, schema.fieldNames(), check), schema)


def decode(tokens: DataFrame, model_path: str, column: str = "tokens", to: str = "text") -> DataFrame:
    """``tokens`` with the decoded text in column ``to``; null tokens give null."""
    spark = prepare(tokens.sparkSession)
    model = spark.sparkContext.broadcast(load(model_path))
    base = tokens.drop(to) if to != column else tokens
    fields = [f for f in base.schema.fields if f.name != to] + [T.StructField(to, T.StringType())]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = column_of(batch, column).to_pylist()
            texts = [None if r is None else model.value.decode(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == to else column_of(batch, n) for n in schema.fieldNames()],
                names=schema.fieldNames(),
            )

    return base.mapInArrow(run, schema)
