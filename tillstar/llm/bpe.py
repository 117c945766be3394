"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, exact decoding.

The split rule is the one of the rank files (``public_tokenizers.PATTERN``)::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

No regular expression runs on the text. Every code point is mapped to a symbol (its class and what the next
two characters make of it), every symbol is a function from automaton state to automaton state, and these
functions are composed: inside blocks of a row of columns for all blocks at once, then across blocks by
doubling, as composition is associative. A last sweep with the known entry states marks the token starts.

Results for special rows: null text counts as empty; an empty text has no ids and decodes to no bytes; rows
that repeat are encoded each; rows without doc_id are kept. Other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.common import BoundedCache, in_steps, small_batches, text_or_empty

BLOCK = 64
SHORT_PIECE = 48  # bytes
SEPARATOR = 0x110000  # between texts; not a code point

# Symbols.
LETTER, NUMBER, OTHER, SPACES, BLANK_END, SPACE_END, SHORT, LONG, RESET = range(9)
# States: nothing open; an open run of a class; one or two letters of a contraction to come; a blank that the next run takes.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, ONE_MORE, TWO_MORE, AFTER_BLANK = range(8)
STATES = 8

# Fixed values of the split rule: white space beyond the ASCII controls, and contraction endings.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

# First and last code point of the letters and numbers that Unicode 16, which the tokenizer library follows, added to Unicode 15.1.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]


@functools.cache
def classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACES for each code point, RESET for the separator."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8)
    for kind, added in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):  # Python 3.13 does not know them yet
        for first, last in added:
            out[first : last + 1] = kind
    out[WHITE_SPACE] = SPACES
    return np.append(out, np.uint8(RESET))


@functools.cache
def transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a token starts, both at ``symbol * STATES + state``."""
    after, starts = np.zeros((9, STATES), np.uint8), np.ones((9, STATES), bool)
    for symbol, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        after[symbol] = run
        starts[symbol, [run, AFTER_BLANK]] = False
    after[SPACES] = IN_SPACES
    starts[SPACES, IN_SPACES] = False
    after[BLANK_END], after[SPACE_END], after[RESET] = AFTER_BLANK, FREE, FREE
    for symbol, rest in ((SHORT, ONE_MORE), (LONG, TWO_MORE)):
        after[symbol] = rest
        after[symbol, [IN_OTHERS, AFTER_BLANK]] = IN_OTHERS  # the apostrophe belongs to a run of others
        starts[symbol, [IN_OTHERS, AFTER_BLANK]] = False
    for symbol in (LETTER,):  # only letters follow inside a contraction
        after[symbol, TWO_MORE], after[symbol, ONE_MORE] = ONE_MORE, FREE
        starts[symbol, [TWO_MORE, ONE_MORE]] = False
    return after.ravel(), starts.ravel()


def symbols(points: np.ndarray) -> np.ndarray:
    """The symbol of each code point; ``points`` ends with a separator."""
    kind = classes()[points]
    out = kind.copy()
    follow = np.append(kind[1:], np.uint8(RESET))
    last = np.flatnonzero((kind == SPACES) & (follow != SPACES) & (follow != RESET))
    out[last] = np.where(points[last] == 0x20, BLANK_END, SPACE_END)
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        one = points[np.minimum(quotes + 1, len(points) - 1)]
        two = points[np.minimum(quotes + 2, len(points) - 1)]
        out[quotes[np.isin(one, [ord(c) for c in ONE_LETTER])]] = SHORT
        for pair in TWO_LETTERS:
            out[quotes[(one == ord(pair[0])) & (two == ord(pair[1]))]] = LONG
    return out


def token_starts(points: np.ndarray) -> np.ndarray:
    """Positions at which a token or a separator starts, by a scan over composed transition functions."""
    after, starts = transitions()
    kind = symbols(points)
    blocks = -(-len(kind) // BLOCK)
    grid = np.full(blocks * BLOCK, RESET, np.uint8)
    grid[: len(kind)] = kind
    columns = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T) * np.uint8(STATES)
    whole = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (blocks, STATES))
    for column in columns:  # the function of each block, all blocks at once
        whole = after.take(column[:, None] + whole)
    reach = 1
    while reach < blocks:  # the function of all blocks up to each
        joined = whole.copy()
        joined[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), axis=1)
        whole, reach = joined, 2 * reach
    state = np.append(np.uint8(FREE), whole[:-1, FREE])
    marks = np.empty((BLOCK, blocks), bool)
    for k, column in enumerate(columns):
        at = column + state
        marks[k], state = starts.take(at), after.take(at)
    return np.flatnonzero(marks.T.ravel()[: len(kind)])


class ByteBpe:
    """Encoder and decoder for one rank file, given as its bytes."""

    def __init__(self, rank_file: bytes, cache_limit: int = 400_000):
        pairs = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.names = {rank: str(rank) for rank in self.tokens}
        self.cache = BoundedCache(self.merge, cache_limit, lambda piece: len(piece) <= 40)

    def merge(self, piece: str) -> tuple[int, ...]:
        """Join the pair of lowest rank, the leftmost among equals, until no pair has a rank."""
        data = piece.encode()
        if (whole := self.ranks.get(data)) is not None:
            return (whole,)
        if len(data) <= SHORT_PIECE:
            return self._merge_short(data)
        n = len(data)
        end = list(range(1, n + 1))  # of the part that begins here; 0 once it is joined to the one before
        before = list(range(-1, n - 1))
        queue = [(rank, k, k + 2) for k in range(n - 1) if (rank := self.ranks.get(data[k : k + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, left, stop = heapq.heappop(queue)
            middle = end[left]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[left], end[middle] = stop, 0
            if stop < n:
                before[stop] = left
                if (rank := self.ranks.get(data[left : end[stop]])) is not None:
                    heapq.heappush(queue, (rank, left, end[stop]))
            if (first := before[left]) >= 0 and (rank := self.ranks.get(data[first:stop])) is not None:
                heapq.heappush(queue, (rank, first, stop))
        out, k = [], 0
        while k < n:
            out.append(self.ranks[data[k : end[k]]])
            k = end[k]
        return tuple(out)

    def _merge_short(self, data: bytes) -> tuple[int, ...]:
        """The same merging for few bytes, where looking at all pairs beats keeping them in order."""
        get, none = self.ranks.get, len(self.ranks)
        cuts = list(range(len(data) + 1))
        pairs = [get(data[k : k + 2], none) for k in range(len(data) - 1)]
        while pairs and (lowest := min(pairs)) != none:
            k = pairs.index(lowest)
            del pairs[k], cuts[k + 1]
            if k < len(pairs):
                pairs[k] = get(data[cuts[k] : cuts[k + 2]], none)
            if k:
                pairs[k - 1] = get(data[cuts[k - 1] : cuts[k + 1]], none)
        return tuple(self.ranks[data[i:j]] for i, j in itertools.pairwise(cuts))

    def pieces(self, texts: list[str]) -> list[list[int]]:
        """For each text the offsets at which its pieces begin, and its length."""
        gap = SEPARATOR.to_bytes(4, "little")
        points = np.frombuffer(gap.join([*(t.encode("utf-32-le", "surrogatepass") for t in texts), b""]), np.uint32)
        starts = token_starts(points)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        cuts = np.searchsorted(starts, ends)
        out, low, first = [], 0, 0
        for cut, end in zip(cuts.tolist(), ends.tolist()):
            out.append([*(starts[low:cut] - first).tolist(), end - first])
            low, first = cut + 1, end + 1
        return out

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        found = []
        for text, bounds in zip(texts, self.pieces(texts)):
            parts = [text[i:j] for i, j in itertools.pairwise(bounds)]
            found.append(list(itertools.chain.from_iterable(map(self.cache.__getitem__, parts))))
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def rank_bytes(path: str | None = None) -> bytes:
    """The rank file, read where the driver runs; workers get its bytes, about a megabyte."""
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return file.read()


_coders: dict[str, ByteBpe] = {}


def _coder(shared) -> ByteBpe:
    data = shared.value
    key = hashlib.sha256(data).hexdigest()
    if key not in _coders:
        _coders[key] = ByteBpe(data)
    return _coders[key]


IDS = "doc_id bigint, ids array<int>, decoded binary"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _encoded(docs: DataFrame, path: str | None, schema: str, row) -> DataFrame:
    """``row(coder, ids)`` gives the cells behind doc_id for each document."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(rank_bytes(path))

    def work(batches):
        coder = _coder(shared)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            cells = []
            for low, high in in_steps(texts):
                cells += [row(coder, ids) for ids in coder.encode_many(texts[low:high])]
            rest = [pa.array(list(c), _arrow[name]) for c, name in zip(zip(*cells), names)] if cells else [pa.array([], _arrow[n]) for n in names]
            yield pa.RecordBatch.from_arrays([keys, *rest], names=["doc_id", *names])

    names = [part.split()[0] for part in schema.split(", ")][1:]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(work, schema)


_arrow = {"ids": pa.list_(pa.int32()), "decoded": pa.binary(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids and the bytes that the ids decode to, for every document."""
    return _encoded(docs, path, IDS, lambda coder, ids: (ids, coder.decode(ids)))


def encoding_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The same encoding, kept as its length and digests of ids and decoded bytes."""

    def row(coder, ids):
        written = " ".join(map(coder.names.__getitem__, ids)).encode()
        return len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()

    return _encoded(docs, path, DIGESTS, row)
