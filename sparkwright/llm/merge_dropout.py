"""Seeded merge-dropout over a SentencePiece merge-type (BPE) vocabulary.

Encoding starts from characters and repeatedly takes the best-scored adjacent
pair whose concatenation is a piece (leftmost of equals). With dropout a
candidate merge is skipped if a keyed hash of (seed, document key, its start,
middle and end in the text) falls below the rate. The hash holds no state, so a
retried task, another order or another partitioning gives the same pieces,
while other seeds, documents and places give other ones. Rate 0 is the model's
own encoding.

Spaces become the model's space mark and one is put in front. Characters
without a piece, and the mark itself where a text holds it, are spelt as byte
pieces, so decoding gives back every text exactly.

Pieces never reach over a space, so a text falls into chunks. Chunks of many
documents advance together, one merge each per round, in numpy; a chunk too
long for that (a text without spaces) takes its merges from a heap.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = 0x2581
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RATE = 0.1
SEED = 1
#: Longer chunks go to the heap; characters that advance together, about.
LONG_CHUNK = 200
TOGETHER = 150_000


class Merges:
    """Lookup tables of a merge-type model with byte fallback."""

    def __init__(self, model: bytes):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(self.size)]
        plain = {p: i for i, p in enumerate(pieces)
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        byte_ids = [i for i in range(self.size) if sp.is_byte(i)]
        if len(byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        mark = chr(MARK)
        if any(mark in p.lstrip(mark) for p in plain):
            raise ValueError("a piece of the model reaches over a space")
        self.byte_ids = np.array(sorted(byte_ids, key=lambda i: int(pieces[i][1:-1], 16)), np.int32)
        self.text_of = [b""] * self.size
        for p, i in plain.items():
            self.text_of[i] = p.replace(mark, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.text_of[i] = bytes([b])
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in plain.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        # Equal scores share a rank, so that the leftmost of equals comes first.
        scores = np.array([sp.get_score(i) for i in range(self.size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        pairs = {(plain[p[:k]], plain[p[k:]]): i for p, i in plain.items()
                 for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain}
        self.pairs = pairs
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        self.merged = np.full(1 << bits, -1, np.int32)
        last = (1 << bits) - 1
        for (a, b), i in pairs.items():
            key = a * self.size + b
            at = int(key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - bits)
            while self.slots[at] != -1:
                at = (at + 1) & last
            self.slots[at], self.merged[at] = key, i
        self.last = last

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece each pair merges into, -1 for none."""
        key = left.astype(np.int64) * self.size + right
        at = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        held = self.slots[at]
        out = np.where(held == key, self.merged[at], -1)
        go = np.flatnonzero((held != key) & (held != -1))
        while len(go):
            at[go] = (at[go] + 1) & self.last
            held = self.slots[at[go]]
            hit = held == key[go]
            out[go[hit]] = self.merged[at[go[hit]]]
            go = go[~hit & (held != -1)]
        return out


def _skips(key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray,
           limit: np.uint64) -> np.ndarray:
    """Whether the keyed hash of each candidate falls below the limit."""
    x = key ^ (start.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
               + mid.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
               + end.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(11) < limit


def _limit(rate: float) -> np.uint64:
    if not 0 <= rate <= 1:
        raise ValueError("the dropout rate must be from 0 to 1")
    return np.uint64(int(rate * (1 << 53)))


def merge_with_heap(m: Merges, symbols: np.ndarray, start: np.ndarray, end: np.ndarray,
                    key: int, limit: np.uint64) -> tuple[list[int], list[int]]:
    """(pieces, starts) of one chunk, its merges taken from an agenda."""
    n = len(symbols)
    sym, begin, stop = symbols.tolist(), start.tolist(), end.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, int, int]] = []
    keys = np.array([key], np.uint64)

    def push(i: int) -> None:
        j = after[i]
        if i >= 0 and j < n:
            new = m.pairs.get((sym[i], sym[j]))
            if new is not None:
                heapq.heappush(agenda, (int(m.rank[new]), begin[i], i, stop[j], new))

    for i in range(n - 1):
        push(i)
    while agenda:
        _, _, i, last, new = heapq.heappop(agenda)
        j = after[i] if sym[i] >= 0 else n
        if j >= n or stop[j] != last or m.pairs.get((sym[i], sym[j])) != new:
            continue  # one of the two has been merged since
        if limit and _skips(keys, np.array([begin[i]]), np.array([begin[j]]),
                            np.array([last]), limit)[0]:
            continue
        sym[i], stop[i], sym[j] = new, last, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        if before[i] >= 0:
            push(before[i])
        push(i)
    live = [i for i in range(n) if sym[i] >= 0]
    return [sym[i] for i in live], [begin[i] for i in live]


def encode(m: Merges, texts: list[str], keys: list[int], rate: float) -> list[np.ndarray]:
    """The piece ids of each text; an empty text has none."""
    limit = _limit(rate)
    parts, lengths = [], []
    for t in texts:
        c = np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)
        if len(c):
            c = np.where(c == MARK, np.uint32(0x10FFFF + 1), c)
            c = np.where(c == 0x20, np.uint32(MARK), c)
            c = np.concatenate([np.array([MARK], np.uint32), c])
        parts.append(c)
        lengths.append(len(c))
    n = sum(lengths)
    if n == 0:
        return [np.empty(0, np.int32) for _ in texts]
    points = np.concatenate(parts)
    doc = np.repeat(np.arange(len(texts)), lengths)
    first = np.cumsum(lengths) - lengths
    sym = np.where(points <= 0x10FFFF, m.char[np.minimum(points, 0x10FFFF)], -1)
    spaces, unknown = points == MARK, sym < 0
    head = np.ones(n, bool)
    head[1:] = (doc[1:] != doc[:-1]) | (spaces[1:] & ~spaces[:-1]) | unknown[1:] | unknown[:-1]
    out = np.full(n, -1, np.int32)  # by the place of a piece's first character

    at = np.flatnonzero(~unknown)  # places of the symbols still at work
    chunk = np.cumsum(head)[at] - 1
    sym, end = sym[at], at + 1
    doc_key = np.array(keys, np.uint64)
    size = np.bincount(chunk)
    if size.max(initial=0) > LONG_CHUNK:
        long = size[chunk] > LONG_CHUNK
        for c in np.unique(chunk[long]):
            own = chunk == c
            d = doc[at[own][0]]
            got, begin = merge_with_heap(m, sym[own], at[own] - first[d], end[own] - first[d],
                                         int(doc_key[d]), limit)
            out[np.array(begin) + first[d]] = got
        at, chunk, sym, end = at[~long], chunk[~long], sym[~long], end[~long]
    while len(sym):
        same = np.flatnonzero(chunk[1:] == chunk[:-1])
        new = m.lookup(sym[same], sym[same + 1])
        found = new >= 0
        i, new = same[found], new[found]
        if limit and len(i):
            d = doc[at[i]]
            stay = ~_skips(doc_key[d], at[i] - first[d], at[i + 1] - first[d], end[i + 1] - first[d],
                           limit)
            i, new = i[stay], new[stay]
        if not len(i):
            out[at] = sym
            break
        order = (m.rank[new] << 32) | np.arange(len(i))
        groups = np.flatnonzero(np.r_[True, chunk[i[1:]] != chunk[i[:-1]]])
        best = np.minimum.reduceat(order, groups) & 0xFFFFFFFF
        i, new = i[best], new[best]
        active = np.zeros(chunk[-1] + 1, bool)
        active[chunk[i]] = True
        sym[i], end[i] = new, end[i + 1]
        keep = active[chunk]
        out[at[~keep]] = sym[~keep]
        keep[i + 1] = False
        at, chunk, sym, end = at[keep], chunk[keep], sym[keep], end[keep]

    # Spell characters without a piece in bytes.
    place = np.flatnonzero((out >= 0) | unknown)
    ids, owner = out[place], doc[place]
    odd = np.flatnonzero(ids < 0)
    if len(odd):
        codes = points[place[odd]]
        spelt = [m.byte_ids[list(chr(MARK if c > 0x10FFFF else c).encode())] for c in codes.tolist()]
        many = np.ones(len(ids), np.int64)
        many[odd] = [len(s) for s in spelt]
        ids, owner = np.repeat(ids, many), np.repeat(owner, many)
        ids[ids < 0] = np.concatenate(spelt)
    return np.split(ids, np.cumsum(np.bincount(owner, minlength=len(texts)))[:-1])


def decode(m: Merges, ids) -> str:
    """The text that ``ids`` spell."""
    text = b"".join([m.text_of[i] for i in ids])
    return text[1:].decode("utf-8") if text else ""


_LOADED: dict[int, Merges] = {}


def _merges(model: bytes) -> Merges:
    """The tables of a model, made once per worker process."""
    key = xxhash.xxh64_intdigest(model)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Merges(model)
    return _LOADED[key]


def document_key(seed: int, doc_id, copy: int = 0) -> int:
    return xxhash.xxh64_intdigest(f"{seed}:{doc_id}{f':{copy}' if copy else ''}".encode())


def _encode_rows(model, rate: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _merges(model.value)
        before, copy = None, 0
        for b in batches:
            ids, texts = b.column("_id").to_pylist(), b.column("text")
            at = 0
            while at < b.num_rows:
                some, keys, chars, to = [], [], 0, at
                while to < b.num_rows and (to == at or chars < TOGETHER):
                    some.append(texts[to].as_py())
                    row = (ids[to], some[-1])
                    copy = copy + 1 if row == before else 0
                    before = row
                    keys.append(document_key(seed, ids[to], copy))
                    chars += len(some[-1] or "")
                    to += 1
                got = encode(m, [t or "" for t in some], keys, rate)
                exact = [t is None or decode(m, g.tolist()) == t for t, g in zip(some, got)]
                ends = np.cumsum([0, *map(len, got)]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate(got) if got else [], pa.int32()))
                rest = [c for c in b.schema.names if c not in ("_id", "text")]
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c).slice(at, to - at) for c in rest],
                     pa.array([len(g) for g in got], pa.int32()), tokens, pa.array(exact)],
                    names=[*rest, "n_tokens", "tokens", "lossless"])
                at = to
    return run


def encode_documents(docs: DataFrame, model_path: str = MODEL, rate: float = RATE,
                     seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_tokens, tokens, lossless.

    ``model_path`` names the model on the driver; its bytes (half a megabyte)
    are broadcast. ``lossless`` is whether decoding the tokens gives back the
    text; null and empty texts have no tokens and count as lossless. Of rows with
    equal doc_id and text (null ids too) that follow each other in a partition, as
    the copies of a mix do, each gets a segmentation of its own, by its number;
    apart from each other they get equal tokens. Very long texts are encoded
    whole; an empty table gives no rows. Other columns are not read.
    """
    _limit(rate)
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("doc_id").cast("string").alias("_id"), "text").mapInArrow(
        _encode_rows(model, rate, seed),
        f"doc_id {id_type}, n_tokens int, tokens array<int>, lossless boolean")


def _decode_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _merges(model.value)
        for b in batches:
            texts = [None if t is None else decode(m, t) for t in b.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return run


def decode_documents(encoded: DataFrame, model_path: str = MODEL) -> DataFrame:
    """doc_id and text of ``encoded`` (doc_id, tokens); null tokens give null."""
    with open(model_path, "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast(f.read())
    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "tokens").mapInArrow(
        _decode_rows(model), f"doc_id {id_type}, text string")
