"""BPE encoding and decoding: merges picked by a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratum.llm.common import per_worker, table

#: bytes of merged words, and of runs of several words, that one worker keeps in each of two generations
WORDS_ROOM, RUNS_ROOM = 40 << 20, 8 << 20
#: up to this code point text is its own NFC form and character classes are settled in every Unicode version
PLAIN_END = 0x24F


#: children of a node of the segment tree: a minimum over a short slice costs little more than one
#: over two values, so a wide node saves levels
WIDTH = 16


def merge(symbols: list[int], ranks: dict[int, tuple[int, int]], n_ranks: int) -> list[int]:
    """Merge adjacent symbols, always the leftmost pair of lowest rank, until no pair has a rank.

    A segment tree holds, for every place, the rank of the pair that begins there, as the key
    rank * m + place; its root is the lowest rank and, of equal ones, the leftmost. A merge
    changes at most three places (its own, the one before and the one it swallows), each
    updated along one path to the root, so a word of m symbols costs O(m log m) at any length.
    ``ranks``: first << 32 | second -> (rank, merged symbol).
    """
    m = len(symbols)
    if m < 2:
        return symbols
    get = ranks.get
    none = n_ranks * m
    leaves = [none] * m
    found = False
    first = symbols[0]
    for i in range(1, m):
        second = symbols[i]
        r = get(first << 32 | second)
        if r is not None:
            leaves[i - 1] = r[0] * m + i - 1
            found = True
        first = second
    if not found:
        return symbols
    tree = [leaves]
    top = leaves
    while len(top) > WIDTH:
        top = [min(top[i:i + WIDTH]) for i in range(0, len(top), WIDTH)]
        tree.append(top)
    after = list(range(1, m + 1))
    before = list(range(-1, m - 1))
    deep = len(tree) > 1
    while (low := min(top)) < none:
        i = low % m
        j = after[i]
        k = after[j]
        new = symbols[i] = get(symbols[i] << 32 | symbols[j])[1]
        symbols[j] = -1
        after[i] = k
        leaves[i] = leaves[j] = none
        if k < m:
            before[k] = i
            r = get(new << 32 | symbols[k])
            if r is not None:
                leaves[i] = r[0] * m + i
        h = before[i]
        if h >= 0:
            r = get(symbols[h] << 32 | new)
            leaves[h] = none if r is None else r[0] * m + h
        if deep:
            # the places changed lie in up to three nodes of a level; each node is taken once
            nodes = {i // WIDTH, j // WIDTH, h // WIDTH} if h >= 0 else {i // WIDTH, j // WIDTH}
            for level in range(1, len(tree)):
                below, here = tree[level - 1], tree[level]
                changed = set()
                for node in nodes:
                    least = min(below[node * WIDTH:node * WIDTH + WIDTH])
                    if here[node] != least:
                        here[node] = least
                        changed.add(node // WIDTH)
                if not changed:
                    break
                nodes = changed
    return [s for s in symbols if s >= 0]


class Recent:
    """A cache of two generations, each bounded by the bytes of its entries.

    When the young one is full it becomes the old one and the old one is dropped; what is
    found in the old one moves on to the young one. So what comes often stays, at most two
    generations are held, and nothing is ever emptied at once.
    """

    #: beyond keys and values: two objects and a place in a table
    ENTRY = 170

    def __init__(self, room: int):
        self.room, self.used = room, 0
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def get(self, key: bytes) -> bytes | None:
        ids = self.young.get(key)
        if ids is None:
            ids = self.old.get(key)
            if ids is not None:
                self.put(key, ids)
        return ids

    def put(self, key: bytes, ids: bytes) -> None:
        size = len(key) + len(ids) + self.ENTRY
        if self.used + size > self.room:
            self.old, self.young, self.used = self.young, {}, 0
        if size <= self.room:
            self.young[key] = ids
            self.used += size


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def character_classes() -> tuple[str, str]:
    """Ranges of letters and of numbers up to PLAIN_END, for use in a character class."""
    def ranges(kind):
        points = [c for c in range(PLAIN_END + 1) if unicodedata.category(chr(c))[0] == kind]
        out, i = "", 0
        while i < len(points):
            j = i
            while j + 1 < len(points) and points[j + 1] == points[j] + 1:
                j += 1
            out += re.escape(chr(points[i])) + ("-" + re.escape(chr(points[j])) if j > i else "")
            i = j + 1
        return out
    return ranges("L"), ranges("N")


class WordBpe:
    """A lower-casing word-end BPE vocabulary (a tokenizers JSON file), encoded by ``merge``.

    Splitting is that of the file: NFC, runs of white space as one, lower case, then the
    words of its pattern. Texts of Latin letters take a plain regular expression; any other
    text has its normal form and words made by the file's own rules, and only the merges are
    made here.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {vocab[a] << 32 | vocab[b]: (i, vocab[a + b]) for i, (a, b) in enumerate(merges)}
        self.n_ranks = len(merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        chars = byte_characters()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + suffix] for c in chars]
        self.byte = {c: b for b, c in enumerate(chars)}
        self.file = Tokenizer.from_file(path)
        letters, numbers = character_classes()
        white = r"\t-\r \x85\xa0"
        self.words = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{letters}]+|[{numbers}]|[^{white}{letters}{numbers}]+").findall
        self.foreign = re.compile(rf"[^\x00-{chr(PLAIN_END)}]").search
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.kept, self.runs = Recent(WORDS_ROOM), Recent(RUNS_ROOM)

    def symbols(self, raw: bytes) -> bytes:
        """The ids of one word, given by its bytes."""
        symbols = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        ids = merge(symbols, self.ranks, self.n_ranks)
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, raw: bytes) -> bytes:
        ids = self.kept.get(raw)
        if ids is None:
            ids = self.symbols(raw)
            self.kept.put(raw, ids)
        return ids

    def _run(self, run: bytes) -> bytes:
        """The ids of a run of lower-case text without ASCII white space. A run of one word is kept
        as that word; runs of several, of which most come once, have a smaller cache of their own."""
        ids = self.kept.get(run) or self.runs.get(run)
        if ids is None:
            words = self.words(run.decode("utf-8"))
            ids = b"".join([self.word(w.encode("utf-8")) for w in words])
            if len(words) > 1:
                self.runs.put(run, ids)
        return ids

    def _part(self, text: str) -> list[bytes]:
        if not self.foreign(text):
            make, kept, runs = self._run, self.kept, self.runs
            # the young ones first, without a call; the dictionaries may change with every miss
            return [kept.young.get(run) or runs.young.get(run) or make(run)
                    for run in text.lower().encode("utf-8").split()]
        normal = self.file.normalizer.normalize_str(text)
        byte = self.byte.__getitem__
        return [self.word(bytes(map(byte, w))) for w, _ in self.file.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, text: str | None) -> bytes:
        """The ids of the whole text as little-endian unsigned 32-bit integers (null: none)."""
        text = text or ""
        if "<|" not in text:
            return b"".join(self._part(text))
        out = []
        for i, part in enumerate(self.cut(text)):
            if i % 2:
                out.append(struct.pack("<I", self.special[part]))
            elif part:
                out.extend(self._part(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids joined as the file's decoder does: it has none, so by blanks."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode_documents(docs: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ids (array of int), n_tokens, ids_sha256 and decoded_sha256 of the whole texts.

    Null and empty texts have no tokens and decode to the empty text. Every row is its own
    work, nothing is shuffled, and repeated rows get equal answers. Columns with the names of
    the new ones are replaced. Every worker reads the vocabulary file once from
    ``vocabulary_path``.
    """
    new = ["ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    keep = [i for i, c in enumerate(docs.columns) if c not in new]
    place = docs.columns.index(text)

    def run(batches):
        bpe = per_worker(("word-bpe", vocabulary_path), lambda: WordBpe(vocabulary_path))
        for b in batches:
            # a few rows at a time, so that ids of long texts don't gather
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                packed = [bpe.encode(t.as_py()) for t in part.column(place)]
                counts = [len(p) // 4 for p in packed]
                flat = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in keep] +
                    [ids, pa.array(counts, pa.int64()),
                     pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                     pa.array([hashlib.sha256(bpe.decode(p).encode("utf-8")).hexdigest() for p in packed])],
                    names=[docs_columns[i] for i in keep] + new)

    docs_columns = docs.columns
    schema = ", ".join([f"`{docs.schema[i].name}` {docs.schema[i].dataType.simpleString()}" for i in keep]
                       + ["ids array<int>", "n_tokens long", "ids_sha256 string", "decoded_sha256 string"])
    return docs.mapInArrow(run, schema)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
