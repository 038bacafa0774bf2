"""Byte-level BPE encoding and decoding.

Pre-tokenisation needs no regular expression. Every code point has a class, every class is a function on the states of
a small automaton, and the functions form a finite monoid: composing them is associative, so a blocked prefix scan over
element numbers gives the state after every character of a whole batch. Token starts follow from states and classes.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from filmloom.llm.common import slices, worker_cache

# Classes of code points.
SEP, SPACE, WHITE, NUMBER, OTHER, QUOTE, LETTER, SHORT, R, V, L, E = range(12)
# States: what the last character was, and how far a contraction such as 're has come.
START, S_SPACE, S_WHITE, S_NUMBER, S_OTHER, S_QUOTE, S_LETTER, S_R, S_V, S_L, S_DONE = range(11)

SLICE_BYTES = 1 << 20
CACHE_PIECES = 3 << 16
SHORT_PIECE = 48
MERGED_AT_ONCE = 1 << 13
#: Tokens of whole texts that are laid out together.
DECODED_AT_ONCE = 1 << 17
#: A lone surrogate occurs in no text, so it can part the pieces.
CUT = 0xD800
RARE = (0x1F, 0x1E, 0x1D, 0x1C, 0x01, 0x02)
BLOCK = 512


def _step(state: int, kind: int) -> int:
    if kind >= LETTER:
        if state == S_QUOTE:
            return {SHORT: S_DONE, R: S_R, V: S_V, L: S_L}.get(kind, S_LETTER)
        done = (state in (S_R, S_V) and kind == E) or (state == S_L and kind == L)
        return S_DONE if done else S_LETTER
    if kind == QUOTE:
        return S_OTHER if state in (S_SPACE, S_OTHER, S_QUOTE) else S_QUOTE
    return (START, S_SPACE, S_WHITE, S_NUMBER, S_OTHER)[kind]


def _starts_token(state: int, kind: int) -> bool:
    """Whether a character of this class begins a token after this state, contractions and white space aside."""
    if state == START:
        return True
    if kind in (SPACE, WHITE):
        return state not in (S_SPACE, S_WHITE)
    if state == S_SPACE:
        return False
    if kind == NUMBER:
        return state != S_NUMBER
    if kind in (OTHER, QUOTE):
        return state not in (S_OTHER, S_QUOTE)
    return state not in (S_LETTER, S_R, S_V, S_L)


def _classes() -> np.ndarray:
    """Class of every code point. The tokenizer library itself says which are letters, numbers and white space."""
    import tiktoken

    points = np.arange(0x110000, dtype="<u4")
    everything = points[(points < 0xD800) | (points >= 0xE000)].tobytes().decode("utf-32-le")
    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        encoding = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(encoding.encode_ordinary(everything)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    table[ord(" ")], table[ord("'")] = SPACE, QUOTE
    for letter, kind in zip("stmdrvle", (SHORT, SHORT, SHORT, SHORT, R, V, L, E)):
        table[ord(letter)] = kind
    return table


class Scanner:
    """Token starts of concatenated texts by a scan over transition functions."""

    def __init__(self):
        self.classes = _classes()
        n_states, n_kinds = 11, 12
        identity = tuple(range(n_states))
        number, functions = {identity: 0}, [identity]
        generators = [tuple(_step(s, k) for s in range(n_states)) for k in range(n_kinds)]
        for f in functions:  # grows while it is read: the closure under composition
            for g in generators:
                h = tuple(g[s] for s in f)
                if h not in number:
                    number[h] = len(functions)
                    functions.append(h)
        n = len(functions)
        self.generator = np.array([number[g] for g in generators], np.int16)
        self.apply = np.array(functions, np.uint8)
        index = np.array([[number[tuple(g[s] for s in f)] for g in functions] for f in functions], np.int16)
        self.compose, self.n = index.ravel(), n
        self.default = np.array([[_starts_token(s, k) for k in range(n_kinds)] for s in range(n_states)], bool)

    def _scan(self, elements: np.ndarray) -> np.ndarray:
        """Inclusive prefix compositions."""
        n = len(elements)
        if n <= 64:
            out = elements.copy()
            for i in range(1, n):
                out[i] = self.compose[int(out[i - 1]) * self.n + int(out[i])]
            return out
        width = min(BLOCK, 1 << (int(n**0.5).bit_length()))
        rows = -(-n // width)
        grid = np.zeros((rows * width,), np.int16)
        grid[:n] = elements
        grid = np.ascontiguousarray(grid.reshape(rows, width).T)
        for j in range(1, width):
            grid[j] = self.compose[grid[j - 1].astype(np.int32) * self.n + grid[j]]
        before = np.zeros(rows, np.int16)
        before[1:] = self._scan(grid[-1])[:-1]
        grid = self.compose[before.astype(np.int32)[None, :] * self.n + grid]
        return grid.T.reshape(-1)[:n]

    def starts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points of the texts, each followed by CUT; the token starts in them; the number of tokens per text."""
        cut = chr(CUT)
        points = np.frombuffer((cut.join(texts) + cut).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.classes[points]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        kinds[ends] = SEP
        after = self.apply[self._scan(self.generator[kinds]), START]
        before = np.empty_like(after)
        before[0], before[1:] = START, after[:-1]
        begin = self.default[before, kinds]
        white = (kinds == SPACE) | (kinds == WHITE)
        solid = ~white & (kinds != SEP)
        begin[:-1] |= white[:-1] & solid[1:]  # the last white space of a run goes with what follows
        done = after == S_DONE
        begin[done] = False
        late = np.flatnonzero(done & (before != S_QUOTE))
        begin[late - 1] = False
        begin[ends] = False
        places = np.flatnonzero(begin)
        counts = np.diff(np.searchsorted(places, ends), prepend=0)
        return points, places, counts


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Tokens:
    """The bytes of every token, laid out one after the other: all that decoding needs."""

    def __init__(self, ranks: dict[bytes, int]):
        words = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            words[rank] = word
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.data = np.frombuffer(b"".join(words), np.uint8)
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.vocabulary = pa.array(words, pa.binary())

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """Lays each token's bytes at its offset, counted from the first."""
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        offsets = offsets.astype(np.int64) - int(offsets[0])
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out = np.zeros(int(offsets[-1] + sizes[-1]), np.uint8)
        out[np.repeat(offsets, sizes) + within] = self.data[np.repeat(self.at[ids], sizes) + within]
        return out.tobytes()

    def decode_lists(self, ids: pa.ListArray, offsets: pa.ListArray) -> pa.Array:
        """Bytes of each list of ids. Lists whose tokens follow each other without a gap are laid out all at once."""
        ends = np.asarray(ids.offsets).astype(np.int64)
        flat = ids.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(zero_copy_only=False)
        ends = ends - ends[0]
        at = np.concatenate([[0], np.cumsum(self.sizes[flat])])
        if not ids.null_count and not offsets.null_count and at[-1] < 1 << 31:
            places = offsets.flatten().to_numpy(zero_copy_only=False)
            if np.array_equal(ends, np.asarray(offsets.offsets) - np.asarray(offsets.offsets)[0]):
                # Each list has one distance between its places and those of the whole batch, if it has no gap.
                apart = at[:-1] - places
                same = apart[1:] == apart[:-1]
                same[ends[(ends > 0) & (ends < len(flat))] - 1] = True
                if same.all():
                    data = self.vocabulary.take(pa.array(flat)).buffers()[2] if len(flat) else pa.py_buffer(b"")
                    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(at[ends].astype(np.int32)), data])
        decoded = []
        for own, places in zip(ids, offsets):
            if own.values is None or places.values is None:
                decoded.append(None)
                continue
            decoded.append(self.decode(own.values.to_numpy(), places.values.to_numpy()))
        return pa.array(decoded, pa.binary())


class Merger(Tokens):
    """Pair merging by rank, with the pieces of earlier texts kept up to a bound."""

    def __init__(self, path: str):
        self.ranks = _ranks(path)
        super().__init__(self.ranks)
        # Two generations: what was not asked for while the younger one filled up goes.
        self.cache: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        # Every way to make a token of two others, by the numbers of the two.
        ranks, n = self.ranks, len(self.sizes)
        keys, made = array("q"), array("q")
        for word, rank in ranks.items():
            for cut in range(1, len(word)):
                if (left := ranks.get(word[:cut])) is not None and (right := ranks.get(word[cut:])) is not None:
                    keys.append(left * n + right)
                    made.append(rank)
        keys, made = np.array(keys, np.int64), np.array(made, np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], made[order]
        self.singles = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        #: One object per id, which all cached pieces share.
        self.numbers = list(range(n))

    def merge_short(self, piece: bytes) -> tuple[int, ...]:
        """Lowest rank first, leftmost on ties; one pass over the pairs for each merge."""
        ranks, none = self.ranks, len(self.sizes)
        get = ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (low := min(pairs)) < none:
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        return tuple(map(ranks.__getitem__, parts))

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """As ``merge_short``; a heap keeps long pieces from taking quadratic time."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        n = len(piece)
        if n <= SHORT_PIECE:
            return self.merge_short(piece)
        end = list(range(1, n + 1))  # end of the part that starts here
        left = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, stop = heapq.heappop(heap)
            j = end[i]
            if j is None or j >= n or end[j] != stop:  # one of the two parts has changed since
                continue
            end[i], end[j] = stop, None
            if stop < n:
                left[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (k := left[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def merge_many(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """As ``merge_short`` for many pieces at once: every round makes the next merge of each piece that has one left."""
        none, n = len(self.sizes), len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        parts = self.singles[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(n), sizes)
        last = np.ones(len(parts), bool)
        last[:-1] = owner[1:] != owner[:-1]

        def ranks(at: np.ndarray) -> np.ndarray:
            """Ranks of the pairs that start at these places, which are no piece's last."""
            keys = parts[at] * none + parts[at + 1]
            found = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            return np.where(self.pair_keys[found] == keys, self.pair_ranks[found], none)

        rank = np.full(len(parts), none)
        inner = np.flatnonzero(~last)
        rank[inner] = ranks(inner)
        done_parts, done_owner = [], []
        while len(parts):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            low = np.minimum.reduceat(rank, starts)
            lengths = np.diff(starts, append=len(parts))
            over = np.repeat(low == none, lengths)
            if over.any():
                done_parts.append(parts[over])
                done_owner.append(owner[over])
                keep = ~over
                parts, owner, last, rank = parts[keep], owner[keep], last[keep], rank[keep]
                low, lengths = low[low != none], lengths[low != none]
                if not len(parts):
                    break
            hits = np.flatnonzero(rank == np.repeat(low, lengths))
            at = hits[np.concatenate([[True], owner[hits[1:]] != owner[hits[:-1]]])]  # the leftmost of each piece
            parts[at], last[at] = low, last[at + 1]
            keep = np.ones(len(parts), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one part before it has gone for each earlier piece
            parts, owner, last, rank = parts[keep], owner[keep], last[keep], rank[keep]
            rank[at] = none
            changed = np.concatenate([at[~last[at]], at[(at > 0) & ~last[at - 1]] - 1])
            rank[changed] = ranks(changed)
        if not done_parts:
            return []
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        flat = list(map(self.numbers.__getitem__, np.concatenate(done_parts)[order].tolist()))
        ends = np.cumsum(np.bincount(owner, minlength=n)).tolist()
        return [tuple(flat[i:j]) for i, j in zip([0, *ends], ends)]

    def learn(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        """Ids of pieces that the younger generation lacks."""
        older = self.older.get
        known = {p: ids for p in pieces if (ids := older(p)) is not None}
        short = []
        for piece in pieces - known.keys():
            whole = piece.encode()
            if whole in self.ranks:
                known[piece] = (self.ranks[whole],)
            elif len(whole) <= SHORT_PIECE:
                short.append((piece, whole))
            else:
                known[piece] = self.merge(whole)
        for first in range(0, len(short), MERGED_AT_ONCE):
            chunk = short[first : first + MERGED_AT_ONCE]
            known.update(zip([p for p, _ in chunk], self.merge_many([w for _, w in chunk])))
        for piece, ids in known.items():
            if len(piece) <= 256:
                if len(self.cache) >= CACHE_PIECES // 2:
                    self.older, self.cache = self.cache, {}
                self.cache[piece] = ids
        return known

    def lookup(self, pieces: list[str]) -> list[tuple[int, ...]]:
        found = list(map(self.cache.get, pieces))
        missing = {p for p, ids in zip(pieces, found) if ids is None}
        if missing:
            known = self.learn(missing)
            found = [known[p] if ids is None else ids for p, ids in zip(pieces, found)]
        return found


def encode_texts(texts: list[str], scanner: Scanner, merger: Merger) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts in a row, each one's byte offset in its text, and the number of ids per text."""
    points, places, per_text = scanner.starts(texts)
    inner = np.ones(len(places), bool)
    first = np.cumsum(per_text) - per_text
    inner[first[per_text > 0]] = False  # a text's first piece already stands after a cut, or at the very start
    parted = np.insert(points, places[inner], CUT)
    # Surrogates are slow to decode, so a rare character that these texts lack stands for the cut.
    cut = next((c for c in RARE if not (points == c).any()), CUT)
    if cut != CUT:
        parted[parted == CUT] = cut
    pieces = parted.astype("<u4", copy=False).tobytes().decode("utf-32-le", "surrogatepass").split(chr(cut))[:-1]
    found = merger.lookup(list(filter(None, pieces)))
    per_piece = np.fromiter(map(len, found), np.int64, len(found))
    ids = np.fromiter(chain.from_iterable(found), np.int32, int(per_piece.sum()))
    piece_ends = np.concatenate([[0], np.cumsum(per_piece)])
    text_ends = piece_ends[np.concatenate([[0], np.cumsum(per_text)])]
    counts = np.diff(text_ends)
    sizes = merger.sizes[ids]
    offsets = np.cumsum(sizes) - sizes
    if len(ids):
        first = offsets[np.minimum(text_ends[:-1], len(ids) - 1)]
        offsets = offsets - np.repeat(first, counts)
    return ids, offsets, counts


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values).cast(kind))


def _schema(df: DataFrame, keep: list[str], *new: T.StructField) -> T.StructType:
    names = {f.name for f in new}
    return T.StructType([df.schema[c] for c in keep if c not in names] + list(new))


def encode(df: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``ids`` and ``offsets`` (a token's first byte in the text) to the kept columns, by default all but the text.

    A null text counts as empty and has empty lists; an empty table gives an empty table. Rows are independent, so
    repeated rows and null keys need no rule. Existing columns called ids or offsets are replaced. Texts of any length are
    encoded whole: a long one is a slice of its own. ``vocabulary`` is a rank file that executors can open.
    """
    keep = [c for c in df.columns if c != text] if keep is None else keep
    keep = [c for c in keep if c not in ("ids", "offsets")]
    numbers = T.ArrayType(T.IntegerType(), False)
    schema = _schema(df, keep, T.StructField("ids", numbers), T.StructField("offsets", numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = worker_cache("bpe_scanner", Scanner)
        merger = worker_cache(f"bpe_merger_{vocabulary}", lambda: Merger(vocabulary))
        for part in slices(batches, "_text", SLICE_BYTES):
            texts = part.column("_text").fill_null("").to_pylist()
            ids, offsets, counts = encode_texts(texts, scanner, merger)
            columns = [part.column(c) for c in keep]
            columns += [_lists(ids, counts, pa.int32()), _lists(offsets, counts, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids", "offsets"])

    source = df.select(*[df[c] for c in keep], df[text].alias("_text"))
    return source.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, keep: list[str] | None = None) -> DataFrame:
    """Adds ``decoded``, the bytes that ``ids`` stand for, laid out by ``offsets``, to the kept columns, by default all.

    Null lists give null.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c != "decoded"]
    schema = _schema(df, keep, T.StructField("decoded", T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_cache(f"bpe_tokens_{vocabulary}", lambda: Tokens(_ranks(vocabulary)))
        for batch in batches:
            lists = batch.column("ids")
            group = np.asarray(lists.offsets)[:-1] // DECODED_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                part = batch.slice(i, j - i)  # rows leave as they are done, so no second batch of texts is held
                decoded = tokens.decode_lists(part.column("ids"), part.column("offsets"))
                yield pa.RecordBatch.from_arrays([*map(part.column, keep), decoded], names=[*keep, "decoded"])

    needed = dict.fromkeys([*keep, "ids", "offsets"])
    return df.select(*[c for c in df.columns if c in needed]).mapInArrow(run, schema)
