"""Token-id files: a context-mixing range coder over ids in independently reset, checksummed blocks."""

from __future__ import annotations

import json
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.bpe import PLAIN_END, Recent, byte_characters, character_classes
from stratum.llm.common import per_worker, shared_folder, table, text_or_empty

#: ids in a block; blocks of a file are coded side by side
BLOCK = 8192
#: a file of a partition is closed at so many ids once as many more are there; the last one takes up to twice as many
FILE_IDS = 6 << 20
END_ID = 0
MAGIC, VERSION = b"TIDS", 2
#: version, six counts, length and crc32 of the head
HEAD = "<HQQQQQQQI"

# ---------------------------------------------------------------- ids of texts

#: bytes of runs and pieces that one worker keeps in each of two generations
ROOM = 40 << 20


class ByteBpe:
    """The tokenizers library's encoding of whole texts, with the ids of recurring pieces kept.

    The file's pattern cuts a text into pieces that are merged each for itself, so equal
    pieces have equal ids. Texts of Latin letters are cut here and only new pieces go to the
    library; any other text, and any that may hold a special token, goes there whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        letters, numbers = character_classes()
        white = r"\t-\r \x85\xa0"
        self.pieces = re.compile(
            rf"'(?:s|t|re|ve|m|ll|d)| ?[{letters}]+| ?[{numbers}]+| ?[^{white}{letters}{numbers}]+"
            rf"|[{white}]+(?![^{white}])|[{white}]+").findall
        self.foreign = re.compile(rf"[^\x00-{chr(PLAIN_END)}]").search
        # white space beside a blank, or a blank at the end: its cut depends on what follows
        self.blanks = re.compile(r"[\t-\r\x85\xa0] | [\t-\r \x85\xa0]| $").search
        self.model = self.library.model
        self.byte = dict(enumerate(byte_characters()))
        self.kept = Recent(ROOM)

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        """A piece is cut already, so it goes to the library's merges alone, as the characters of its bytes."""
        found = self.model.tokenize(piece.encode("utf-8").decode("latin-1").translate(self.byte))
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def _run(self, run: str) -> bytes:
        """Ids of the pieces of a run of text."""
        kept = self.kept
        out = []
        for piece in self.pieces(run):
            ids = kept.get(piece)
            if ids is None:
                ids = self._piece(piece)
                kept.put(piece, ids)
            out.append(ids)
        return b"".join(out)

    def _kept_run(self, run: str) -> bytes:
        ids = self.kept.get(run)
        if ids is None:
            pieces = self.pieces(run)
            ids = self._piece(run) if len(pieces) == 1 else self._run(run)
            self.kept.put(run, ids)
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.foreign(text) or any(s in text for s in self.special):
            return self._whole(text)
        if self.blanks(text) or "\0" in text:
            return self._run(text)
        # between single blanks the pieces of a run don't depend on what is around it
        make, kept = self._kept_run, self.kept
        # the young ones first, without a call; the dictionary may change with every miss
        return b"".join([kept.young.get(run) or make(run) for run in text.replace(" ", "\0 ").split("\0") if run])


# ---------------------------------------------------------------- the coder

#: ids of a block between two adaptations of weights and rates, after the shorter first ones
GROUP, FIRST = 128, (8, 16, 32, 64)
#: ids of a block that share an order-0 table, and the most tables of a file
SEGMENT, TABLES = 32, 8
#: shares of an order-0 table add up to two to this power
SHARES = 18
ONE = 65536
_OUT, _U32 = np.uint64(1 << 32), np.uint64(32)
_S16, _SHARES, _LAST, _NONE = np.uint64(16), np.uint64(SHARES), np.uint64((1 << SHARES) - 1), np.uint64(0)


class Order0:
    """Order-0 tables of one file: for each table the share of every rank (place in the file's vocabulary)."""

    def __init__(self, sizes: np.ndarray):
        self.ranks = sizes.shape[1]
        self.size = sizes.astype(np.uint64).ravel()
        self.start = (np.cumsum(sizes, 1, dtype=np.uint64) - sizes.astype(np.uint64)).ravel()
        self.rank = np.concatenate([np.repeat(np.arange(self.ranks, dtype=np.uint16), x) for x in sizes])


def learn_order0(ranks: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares by table and rank, table of each segment): tables are learned in rounds, every segment
    going to the table that codes it shortest. The rounds see at most some 16,384 segments spread over
    the file; then all segments choose, and the shares are counted over all.
    ``often``: how often each rank comes."""
    n, n_ranks = len(ranks), len(often)
    tables = min(TABLES, 1 + (n >> 17))
    segments = np.concatenate((ranks, np.repeat(ranks[-1:], -n % SEGMENT))).reshape(-1, SEGMENT)
    m = len(segments)
    whole = often / n

    def choose(some, counts):
        # of each table a little goes to the file's own shares, so that nothing is impossible
        p = counts + (0.02 * counts.sum(1, keepdims=True) + 1) * whole
        cost = -np.log2(p / p.sum(1, keepdims=True)).astype(np.float32)
        return np.stack([c.take(some).sum(1) for c in cost]).argmin(0)

    def count(some, choice):
        cells = (choice[:, None] * n_ranks + some).ravel()
        return np.bincount(cells, minlength=tables * n_ranks).reshape(tables, n_ranks).astype(np.float64)

    some = segments[::max(1, m >> 14)]
    learned = np.stack([np.bincount(segments[i * m // tables:][:8].ravel(), minlength=n_ranks)
                        for i in range(tables)]).astype(np.float64)
    for _ in range(6 if tables > 1 else 0):
        learned = count(some, choose(some, learned))
    counts, chosen = np.tile(0.001 * whole * n / tables, (tables, 1)), []
    for i in range(0, m, 8192):
        some = segments[i:i + 8192]
        chosen.append(choose(some, learned))
        counts += count(some, chosen[-1])
    choice = np.concatenate(chosen)
    sizes = 1 + np.floor(counts * ((1 << SHARES) - n_ranks) / counts.sum(1, keepdims=True)).astype(np.int64)
    # what rounding left over goes to, or is taken from, the most frequent rank
    sizes[np.arange(tables), sizes.argmax(1)] += (1 << SHARES) - sizes.sum(1)
    return sizes, choice


class Encoder:
    """A range coder per lane (64-bit low, 32-bit words out), all lanes side by side."""

    def __init__(self, lanes: int, longest: int):
        # an id takes at most one word
        self.room = longest + 2
        self.words = np.zeros(lanes * self.room, np.uint32)
        self.at = np.arange(lanes) * self.room
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, (1 << 64) - 1, np.uint64)

    def _add(self, low, at, add) -> np.ndarray:
        new = low + add
        lanes = (new < low).nonzero()[0]
        if len(lanes):
            back = at[lanes] - 1
            while len(back):  # a carry runs back over words of all ones
                self.words[back] += np.uint32(1)
                back = back[self.words[back] == 0] - 1
        return new

    def step(self, n, order0, table, a, b, c2, c1, x):
        """Code an id per lane: order 2's guess up to ``a`` 65536ths, order 1's up to ``b``, then order 0's shares."""
        all_, at = self.range[:n], self.at[:n]
        second = x == c2
        literal = ~(second | (x == c1))
        r = all_ >> _S16
        ra, rb = r * a, r * b
        rl = (all_ - rb) >> _SHARES
        cell = table * order0.ranks + x
        low = self._add(self.low[:n], at, np.where(literal, rb + rl * order0.start.take(cell), np.where(second, _NONE, ra)))
        r = np.where(literal, rl * order0.size.take(cell), np.where(second, ra, rb - ra))
        out = r < _OUT
        # the next word is put down in every lane and stays where one is out; elsewhere it is written again
        self.words[at] = low >> _U32
        at += out
        shift = out * _U32
        self.low[:n] = low << shift
        self.range[:n] = r << shift
        return x, second, literal

    def finish(self) -> list[bytes]:
        # the range is 2**32 or more, so one word names a number in it
        low = self._add(self.low, self.at, np.uint64((1 << 32) - 1))
        self.words[self.at] = low >> _U32
        return [self.words[i * self.room:at + 1].astype("<u4").tobytes() for i, at in enumerate(self.at.tolist())]


class Decoder:
    """The reverse of ``Encoder``, over the lanes' words."""

    def __init__(self, payloads: list[bytes]):
        sizes = np.array([len(p) // 4 + 3 for p in payloads], np.int64)
        self.words = np.frombuffer(b"".join([p + bytes(12) for p in payloads]), "<u4").astype(np.uint32)
        self.at = np.cumsum(sizes) - sizes + 2
        self.code = (self.words[self.at - 2].astype(np.uint64) << _U32) | self.words[self.at - 1]
        self.range = np.full(len(payloads), (1 << 64) - 1, np.uint64)

    def step(self, n, order0, table, a, b, c2, c1, _):
        all_, code, at = self.range[:n], self.code[:n], self.at[:n]
        r = all_ >> _S16
        ra, rb = r * a, r * b
        rl = (all_ - rb) >> _SHARES
        second, literal = code < ra, code >= rb
        share = np.minimum((code - rb) // rl, _LAST).view(np.int64)
        rank = order0.rank.take((table << SHARES) + share)
        cell = table * order0.ranks + rank
        code = code - np.where(literal, rb + rl * order0.start.take(cell), np.where(second, _NONE, ra))
        r = np.where(literal, rl * order0.size.take(cell), np.where(second, ra, rb - ra))
        out = r < _OUT
        shift = out * _U32
        self.code[:n] = (code << shift) | self.words.take(at) * out
        at += out
        self.range[:n] = r << shift
        return np.where(literal, rank, np.where(second, c2, c1)), second, literal


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Logit of a chance in 4096ths, times 256, and its inverse over -2047..2047 (whole numbers: every machine agrees)."""
    p = (np.arange(4096) + 0.5) / 4096
    stretch = np.round(np.log(p / (1 - p)) * 256).astype(np.int64).clip(-2047, 2047)
    squash = np.round(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))).astype(np.int64).clip(1, 4095)
    return stretch, squash


STRETCH, SQUASH = _tables()
ORDER = 12  # bits of a prediction table
LEVELS = 8
_ID, _LEVEL, _UP = np.int32(0xFFFF), np.int32(16), np.int32(1 << 16)
_HASH = np.int64(0x2F0B4C47)


class _Rates:
    """How often a guess was right, per lane and cell, older groups of ids counting less and less."""

    def __init__(self, lanes: int, cells: int):
        self.trials, self.hits = np.zeros((lanes, cells), np.int64), np.zeros((lanes, cells), np.int64)

    def add(self, trials, hits) -> None:
        # counts are kept in 16ths
        self.trials += (trials << 4) - (self.trials >> 5)
        self.hits += (hits << 4) - (self.hits >> 5)

    def stretched(self) -> np.ndarray:
        return STRETCH[(4096 * (self.hits + 2) // (self.trials + 8)).clip(0, 4095)]


class _Mixer:
    """Chances (4096ths) per lane and cell, mixed from the chances that several orders give (whole numbers)."""

    def __init__(self, lanes: int, inputs: int):
        self.weights = np.full((lanes, inputs), 30000, np.int64)

    def mix(self, *inputs) -> np.ndarray:
        """Each input: stretched chances, broadcast to (lane, cells)."""
        self.inputs = inputs
        shape = (-1,) + (1,) * (inputs[0].ndim - 1)
        dot = sum(w.reshape(shape) * x for w, x in zip(self.weights.T, inputs)) >> 16
        self.chance = SQUASH[dot.clip(-2047, 2047) + 2047]
        return self.chance

    def learn(self, trials, hits) -> None:
        miss = (hits << 12) - trials * self.chance
        axes = tuple(range(1, miss.ndim))
        for i, x in enumerate(self.inputs):
            self.weights[:, i] += (miss * x).sum(axes) >> 12
        self.weights.clip(-ONE, 2 * ONE, self.weights)


class _Model:
    """Chances that the orders' guesses are right; they follow what came, a group of ids at a time."""

    def __init__(self, lanes: int):
        self.lanes = lanes
        self.r2, self.r1, self.r0 = _Rates(lanes, LEVELS), _Rates(lanes, 2 * LEVELS), _Rates(lanes, 1)
        self.q1, self.q0 = _Rates(lanes, LEVELS), _Rates(lanes, 1)
        self.first, self.second = _Mixer(lanes, 3), _Mixer(lanes, 2)
        self.ends()

    def ends(self) -> None:
        """Where the guesses' shares end, in 65536ths, by lane, order 2's level, agreement and order 1's level."""
        p = self.first.mix(self.r2.stretched()[:, :, None], self.r1.stretched()[:, None, :],
                           self.r0.stretched()[:, :, None])
        q = self.second.mix(self.q1.stretched(), self.q0.stretched())
        a = np.minimum(p << 4, ONE - 128)
        b = a.copy()
        apart = a[:, :, :LEVELS]
        b[:, :, :LEVELS] = np.clip(apart + ((ONE - apart) * q[:, None, :] >> 12), apart + 16, ONE - 64)
        self.a, self.b = a.ravel().view(np.uint64), b.ravel().view(np.uint64)

    def learn(self, cells, second, literal) -> None:
        """A group of ids: their cells (of ``ends``), and which were order 2's guess and which no guess."""
        size = self.lanes * LEVELS * 2 * LEVELS
        kinds = np.where(second, 0, size) + literal * size
        n2, n1, n0 = np.bincount(kinds + cells, minlength=3 * size).reshape(3, self.lanes, LEVELS, 2 * LEVELS)
        trials = n2 + n1 + n0
        self.first.learn(trials, n2)
        t, h = trials.sum(1), n2.sum(1)
        self.r2.add(trials.sum(2), n2.sum(2))
        self.r1.add(t, h)
        self.r0.add(t.sum(1, keepdims=True), h.sum(1, keepdims=True))
        # order 1 is asked where order 2 was wrong and guessed otherwise
        h = n1[:, :, :LEVELS].sum(1)
        t = h + n0[:, :, :LEVELS].sum(1)
        self.second.learn(t, h)
        self.q1.add(t, h)
        self.q0.add(t.sum(1, keepdims=True), h.sum(1, keepdims=True))
        self.ends()


def code(coder, lengths: np.ndarray, order0: Order0, choice: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
    """Run the model over blocks of ids (ranks in the file's vocabulary), one lane each, and have ``coder`` code them.

    ``ids`` (place, lane) when encoding, None when decoding; returns the ids. ``lengths`` don't
    grow from lane to lane; ``choice`` (segment, lane) names the order-0 tables. Every block begins
    with a fresh model. Per id: orders 2 and 1 each keep, under a hash of the ids before, the id
    that followed last and how often it was right since; these follow every id. The id is order
    2's, with a chance mixed from the reliability of both orders and the rate of such hits, or
    order 1's, mixed likewise, or goes by the order-0 table of its segment. Reliabilities, rates
    and weights of the mix follow once a group of ids.
    """
    lanes = len(lengths)
    longest = int(lengths.max(initial=0))
    out = np.zeros((longest, lanes), np.uint16) if ids is None else ids
    ends = {*FIRST, *range(GROUP, longest, GROUP)}
    model = _Model(lanes)
    lane = np.arange(lanes)
    at_cell = lane * (LEVELS * 2 * LEVELS)
    # per order and lane a table of entries: an id and, above it, its level
    entries = np.zeros((2 * lanes) << ORDER, np.int32)
    first = np.stack((lane, lanes + lane)) << ORDER
    mask, top, level = (1 << ORDER) - 1, np.int32((LEVELS - 1) << 16), np.int32(LEVELS)
    hashes = np.zeros((2, lanes), np.int64)
    cells, seconds, literals = [], [], []
    n = lanes
    for t in range(longest):
        if t >= lengths[n - 1]:
            n = int((lengths > t).sum())
            at_cell, first, hashes = at_cell[:n], first[:, :n], hashes[:, :n].copy()
        if t in ends:
            model.learn(np.concatenate(cells), np.concatenate(seconds), np.concatenate(literals))
            cells, seconds, literals = [], [], []
        if t % SEGMENT == 0:
            chosen = choice[t // SEGMENT]
        h = (hashes >> 9 & mask) + first
        e = entries.take(h)
        c, l = e & _ID, e >> _LEVEL
        c1, c2 = c
        cell = l[1] * (2 * level) + l[0] + (c1 == c2) * level + at_cell
        got, second, literal = coder.step(n, order0, chosen[:n], model.a.take(cell), model.b.take(cell), c2, c1,
                                          None if ids is None else ids[t, :n])
        if ids is None:
            out[t, :n] = got
        cells.append(cell)
        seconds.append(second)
        literals.append(literal)
        # right: a level up; wrong: half the level, and below two another id
        entries[h] = np.where(got == c, np.minimum(e + _UP, top | c),
                              np.where(l > 1, c | (l >> 1) << _LEVEL, got))
        own = got * _HASH
        hashes[1] = hashes[0] * 5 + own
        hashes[0] = own
    return out


# ---------------------------------------------------------------- the file

def _by_place(flat: np.ndarray, blocks: int, width: int) -> np.ndarray:
    """(place, block) of values that follow one another block by block, ``width`` to a block; the last is filled with 0."""
    square = np.zeros(blocks * width, flat.dtype)
    square[:len(flat)] = flat
    return np.ascontiguousarray(square.reshape(blocks, width).T)


def write_file(docs: list[tuple[int | None, bytes]]) -> tuple[int, bytes]:
    """(number of ids, file) for (doc_id, ids as little-endian 32-bit) in order.

    Layout, little-endian: MAGIC, version, counts of documents, ids, blocks, ids of a block,
    distinct ids and order-0 tables, length and crc32 of the head; the head (zstd): doc_ids, which
    of them are null, ids per document, per block its number of ids, bytes, crc32 of the ids and of
    the bytes, the distinct ids, the tables' shares and the table of each segment; then the blocks.
    """
    flat = np.frombuffer(b"".join(d[1] for d in docs), "<u4")
    if len(flat) and int(flat.max()) > 0xFFFF:
        raise ValueError("ids above 65535 don't fit the coder's ranks")
    blocks = -(-len(flat) // BLOCK)
    lengths = np.full(blocks, BLOCK)
    payloads: list[bytes] = []
    vocabulary, sizes, choice = np.zeros(0, "<u2"), np.zeros((0, 0), "<u4"), np.zeros(0, "u1")
    if blocks:
        lengths[-1] = len(flat) - BLOCK * (blocks - 1)
        # in parts: ids are widened to 64 bits to count and look up
        parts = [flat[i:i + (1 << 20)] for i in range(0, len(flat), 1 << 20)]
        often = sum(np.bincount(x, minlength=1 << 16) for x in parts)
        vocabulary = np.flatnonzero(often).astype("<u2")
        rank = (np.cumsum(often > 0) - 1).astype(np.uint16)
        ranks = np.concatenate([rank.take(x) for x in parts])
        sizes, choice = learn_order0(ranks, often[vocabulary])
        coder = Encoder(blocks, int(lengths.max()))
        code(coder, lengths, Order0(sizes), _by_place(choice, blocks, BLOCK // SEGMENT),
             _by_place(ranks, blocks, BLOCK)[:lengths.max()])
        payloads = coder.finish()
    sums = [zlib.crc32(flat[i * BLOCK:(i + 1) * BLOCK].tobytes()) for i in range(blocks)]
    head = b"".join((
        np.array([d[0] or 0 for d in docs], "<i8").tobytes(), bytes(d[0] is None for d in docs),
        np.array([len(d[1]) // 4 for d in docs], "<u8").tobytes(),
        lengths.astype("<u4").tobytes(), np.array([len(p) for p in payloads], "<u4").tobytes(),
        np.array(sums, "<u4").tobytes(), np.array([zlib.crc32(p) for p in payloads], "<u4").tobytes(),
        vocabulary.tobytes(), sizes.astype("<u4").tobytes(), choice.astype("u1").tobytes()))
    packed = zstandard.ZstdCompressor(level=3).compress(head)
    counts = len(docs), len(flat), blocks, BLOCK, len(vocabulary), len(sizes)
    return len(flat), (MAGIC + struct.pack(HEAD, VERSION, *counts, len(packed), zlib.crc32(packed))
                       + packed + b"".join(payloads))


def read_file(raw: bytes) -> list[tuple[int | None, np.ndarray]]:
    """The documents of ``write_file``, every checksum verified; a damaged file raises ValueError."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token-id file")
    version, = struct.unpack_from("<H", raw, 4)
    if version != VERSION:
        raise ValueError(f"unknown version {version}")
    _, n_docs, n_ids, blocks, width, n_ranks, tables, size, check = struct.unpack_from(HEAD, raw, 4)
    at = 4 + struct.calcsize(HEAD)
    packed = raw[at:at + size]
    if zlib.crc32(packed) != check:
        raise ValueError("damaged head")
    head = zstandard.ZstdDecompressor().decompress(packed)
    at += size
    o = 0

    def column(kind, n):
        nonlocal o
        x = np.frombuffer(head, kind, n, o)
        o += x.nbytes
        return x

    doc_ids, null, counts = column("<i8", n_docs), column("u1", n_docs), column("<u8", n_docs)
    lengths, sizes, sums, checks = (column("<u4", blocks) for _ in range(4))
    vocabulary, shares = column("<u2", n_ranks), column("<u4", tables * n_ranks)
    choice = column("u1", -(-n_ids // SEGMENT))
    ends = at + np.cumsum(sizes, dtype=np.int64)
    payloads = [raw[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())]
    for i, (p, c) in enumerate(zip(payloads, checks.tolist())):
        if zlib.crc32(p) != c:
            raise ValueError(f"damaged block {i}")
    ids = np.zeros(0, "<u4")
    if blocks:
        ranks = code(Decoder(payloads), lengths.astype(np.int64), Order0(shares.reshape(tables, n_ranks)),
                     _by_place(choice.astype(np.int64), blocks, width // SEGMENT), None)
        ranks, known = np.ascontiguousarray(ranks.T), vocabulary.astype("<u4")
        ids = np.concatenate([known.take(ranks[i, :n]) for i, n in enumerate(lengths.tolist())])
        for i, (e, n, c) in enumerate(zip(np.cumsum(lengths, dtype=np.int64).tolist(), lengths.tolist(), sums.tolist())):
            if zlib.crc32(ids[e - n:e].tobytes()) != c:
                raise ValueError(f"block {i} decodes to other ids")
    if len(ids) != n_ids:
        raise ValueError("ids are missing")
    cuts = np.cumsum(counts.astype(np.int64))
    return [(None if z else d, ids[e - c:e]) for d, z, c, e in
            zip(doc_ids.tolist(), null.tolist(), counts.astype(np.int64).tolist(), cuts.tolist())]


def write_token_files(docs: DataFrame, folder: str, vocabulary_path: str, text: str = "text",
                      doc_id: str = "doc_id", end_id: int | None = END_ID) -> DataFrame:
    """Write the ids of all documents, in ascending doc_id order, to files in ``folder``.

    Returns (part, number, n_ids, file), read back: each row is one file of whole documents of
    FILE_IDS to twice as many ids (a partition's only file may hold fewer, whole
    documents may make it more); files follow one another by part and number. Documents are ranged by
    doc_id and, among equal ones, by a hash of the text, so that a repeated doc_id spreads;
    null doc_ids come first. Null and empty texts hold only the end id.
    """
    body = text_or_empty(text)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("h"))
    ranged = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")
    tail = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches):
        bpe = per_worker(("byte-bpe", vocabulary_path), lambda: ByteBpe(vocabulary_path))
        part = TaskContext.get().partitionId()
        held, size, number = [], 0, 0

        def row(docs):
            n, raw = write_file(docs)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([n], pa.int64()),
                 pa.array([raw], pa.binary())], names=["part", "number", "n_ids", "file"])

        for b in batches:
            for i in range(b.num_rows):
                ids = bpe.encode(b.column(1)[i].as_py()) + tail
                held.append((b.column(0)[i].as_py(), ids))
                size += len(ids) // 4
                if size >= 2 * FILE_IDS:
                    counts = np.cumsum([len(d[1]) // 4 for d in held])
                    cut = int(np.searchsorted(counts, FILE_IDS)) + 1
                    yield row(held[:cut])
                    held, size, number = held[cut:], size - int(counts[cut - 1]), number + 1
        if held:
            yield row(held)

    ranged.mapInArrow(run, "part int, number int, n_ids long, file binary").write.parquet(folder)
    return docs.sparkSession.read.schema("part int, number int, n_ids long, file binary").parquet(folder)


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; start counts the ids of all before it."""
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    # one small row per file, so this one ordered sum is over files, not documents
    starts = files.select("part", "number", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("start"))
    rows = files.select("part", "number", "file").join(starts, ["part", "number"]).select("start", "file")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                start = b.column(0)[i].as_py()
                docs = read_file(b.column(1)[i].as_py())
                for at in range(0, len(docs), 1024):
                    part = docs[at:at + 1024]
                    counts = np.array([len(d[1]) for d in part], np.int64)
                    flat = np.concatenate([d[1] for d in part]).astype(np.int32)
                    begins = start + np.cumsum(counts) - counts
                    start += int(counts.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d[0] for d in part], pa.int64()), pa.array(begins), pa.array(counts),
                         pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(flat))],
                        names=["doc_id", "start", "n_tokens", "ids"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids array<int>")


def with_crc(docs: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): crc32 of the ids as little-endian unsigned 32-bit integers."""
    def run(batches):
        for b in batches:
            flat = b.column(3).flatten().to_numpy().astype("<u4")
            ends = np.cumsum(b.column(2).to_numpy())
            sums = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(sums, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return docs.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(table(spark, sf_dir, "documents"), shared_folder(spark, "token-files"),
                              public_tokenizers.path("byte_bpe_50k.json"))
    return with_crc(read_token_files(files))
