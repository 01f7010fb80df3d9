"""Packing along a space-filling curve.

Each document's words are hashed to a vector, projected to three dimensions,
and the point's place on a Hilbert curve is the document's key. Documents are
sorted by range on that key, so a task packs documents that lie near each other
on the curve: they follow one another in sequences of ``CAPACITY`` ids and are
cut where a sequence ends. Cuts fall on multiples of ``GRID`` ids of the
document, so a sequence is padded by fewer than ``GRID`` ids, apart from the
last one of each task.

The texts are tokenised once and never shuffled: a document travels as its key,
its length and the running CRC-32 at every multiple of ``GRID`` ids, from which
the CRC-32 of any piece follows (the CRC of a prefix, shifted by the piece's
length, cancels out). Token ids of words come from the tokenizer's model, and
are kept per word in a table of bounded size in each Python worker.

Defined results: null text is empty and has the closing id only; repeated rows
and null ids are documents of their own; ties on the curve go by id. Words are
told apart by 64-bit hashes.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textops
from ledgerline.llm.common import checkpoint, id_and_text, ship_package, text_or_empty, with_row_id

CAPACITY = 4096
GRID = 32
END_ID = 2
DIMENSIONS, BITS = 3, 10
#: Tokens that one packing task takes.
TASK_TOKENS = CAPACITY * 512
#: Words whose ids a Python worker keeps; then it starts anew.
CACHE_WORDS = 1 << 20
TAIL = ".,!?;:*$%&#|"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids by word: an open-addressed table over 64-bit word hashes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.letters = {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}
        self.tails: dict[str, list[int]] = {}
        self.short_way = True
        tries = ["Étude", "it", "WORD.,", "straße!!", "naïve", "ǅ", "x"]
        self.short_way = all(self.encode(w) == self.whole(w) for w in tries)
        if self.whole(" ".join(tries)) != [i for w in tries for i in self.whole(w)]:
            raise ValueError(f"{path} does not tokenise words by themselves")
        self.clear()

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def clear(self) -> None:
        self.mask = 2 * CACHE_WORDS - 1
        self.keys = np.zeros(2 * CACHE_WORDS, np.uint64)
        self.slots = np.zeros(2 * CACHE_WORDS, np.int32)
        self.starts = np.zeros(CACHE_WORDS + 1, np.int64)
        self.flat = np.zeros(4 * CACHE_WORDS, np.uint32)
        self.count = 0

    def encode(self, word: str) -> list[int]:
        """Ids of a string without white space. Letters that need no
        normalisation beyond lower case go straight to the model, where the
        tokenizer gives the same that way."""
        if not self.short_way:
            return self.whole(word)
        core = word.rstrip(TAIL)
        tail = word[len(core):]
        if core.isalpha() and max(core) < "ƀ" and "İ" not in core:
            text = unicodedata.normalize("NFC", core).lower()
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(text)]
            if tail:
                if tail not in self.tails:
                    self.tails[tail] = self.tokenizer.encode(tail, add_special_tokens=False).ids
                ids += self.tails[tail]
            return ids
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 where unknown."""
        out = np.full(len(h), -1, np.int64)
        open_, at = np.arange(len(h)), (h & np.uint64(self.mask)).astype(np.int64)
        while len(open_):
            k = self.keys[at]
            hit = k == h[open_]
            out[open_[hit]] = self.slots[at[hit]]
            go = ~hit & (k != 0)
            open_, at = open_[go], (at[go] + 1) & self.mask
        return out

    def add(self, h: int, ids: list[int]) -> None:
        at = h & self.mask
        while self.keys[at]:
            at = (at + 1) & self.mask
        self.keys[at], self.slots[at] = h, self.count
        start = int(self.starts[self.count])
        while start + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[start:start + len(ids)] = ids
        self.count += 1
        self.starts[self.count] = start + len(ids)

    def lookup(self, h: np.ndarray, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Index of every word; unknown words are encoded first."""
        h = np.where(h == 0, np.uint64(1), h)
        index = self.find(h)
        missing = np.flatnonzero(index < 0)
        if len(missing):
            new, where = np.unique(h[missing], return_index=True)
            if self.count + len(new) > CACHE_WORDS:
                self.clear()
                new, where = np.unique(h, return_index=True)
                missing = np.arange(len(h))
            raw = data.tobytes()
            for key, i in zip(new.tolist(), missing[where].tolist(), strict=True):
                self.add(key, self.encode(raw[begins[i]:ends[i]].decode("utf-8", "replace")))
            index = self.find(h)
        return index


_workers: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _workers:
        _workers[path] = WordIds(path)
    return _workers[path]


def tokenize_block(ids: WordIds, data: np.ndarray, offs: np.ndarray):
    """(token ids with END_ID after each text, token offsets, word hashes, word offsets)."""
    h, woffs, begins, ends = textops.word_hashes(data, offs, lower=False)
    index = ids.lookup(h, data, begins, ends) if len(h) else np.zeros(0, np.int64)
    first, size = ids.starts[index], ids.starts[index + 1] - ids.starts[index]
    # an end marker after each text, as one more unit of one id
    docs = len(offs) - 1
    units = len(index) + docs
    ends_at = woffs[1:] + np.arange(docs)
    is_word = np.ones(units, bool)
    is_word[ends_at] = False
    length = np.ones(units, np.int64)
    length[is_word] = size
    total = np.concatenate([[0], np.cumsum(length)])
    source = np.zeros(units, np.int64)
    source[is_word] = first
    flat = np.repeat(source - total[:-1], length) + np.arange(total[-1])
    tokens = ids.flat[np.where(np.repeat(is_word, length), flat, 0)].astype("<u4")
    tokens[total[ends_at]] = END_ID
    bounds = np.concatenate([[0], total[ends_at + 1]])
    return tokens, bounds, h, woffs


def curve_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of integer points (n x d) on the Hilbert curve of ``bits`` bits."""
    x = points.astype(np.int64).copy()
    d = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess work from the highest bit down
        p = q - 1
        for i in range(d):
            flip = (x[:, i] & q) != 0
            x[flip, 0] ^= p
            swap = np.where(flip, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= swap
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, d):  # Gray code
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[:, d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def vectors(h: np.ndarray, woffs: np.ndarray) -> np.ndarray:
    """Hashed word vectors summed per document, three dimensions, about N(0, 1)."""
    low = np.uint64((1 << 21) - 1)
    out = np.zeros((len(woffs) - 1, DIMENSIONS))
    for i in range(DIMENSIONS):
        unit = ((h >> np.uint64(21 * i)) & low).astype(np.float64) / float(1 << 20) - 1.0
        sums = np.concatenate([[0.0], np.cumsum(unit)])
        out[:, i] = sums[woffs[1:]] - sums[woffs[:-1]]
    return out / np.sqrt(np.maximum(1, np.diff(woffs)))[:, None] * np.sqrt(3.0)


PREPARED = "_rid long, doc_id long, key long, doc_tokens long, crcs binary"


def _prepare(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path)
        for batch in batches:
            for first, offs, data in textops.blocks(batch.column(2)):
                tokens, bounds, h, woffs = tokenize_block(ids, data, offs)
                raw = tokens.tobytes()
                crcs = []
                for a, b in zip((4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist(), strict=True):
                    crc, seen = 0, []
                    for at in range(a, b, 4 * GRID):
                        crc = zlib.crc32(raw[at:min(at + 4 * GRID, b)], crc)
                        seen.append(crc)
                    crcs.append(np.array(seen, "<u4").tobytes())
                points = np.floor((np.tanh(vectors(h, woffs) / 2) + 1) * (1 << (BITS - 1)))
                key = curve_key(np.clip(points, 0, (1 << BITS) - 1))
                n = len(offs) - 1
                yield pa.record_batch([batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(key),
                                       pa.array(np.diff(bounds)), pa.array(crcs, pa.binary())],
                                      ["_rid", "doc_id", "key", "doc_tokens", "crcs"])
    return run


def _shift_matrices(steps: int = 24) -> list[np.ndarray]:
    """Operator that appends 2**k zero bytes to a CRC-32, as 32 columns, for each k."""
    poly = 0xEDB88320
    bit = np.array([poly] + [1 << i for i in range(31)], np.uint64)  # one zero bit
    square = lambda m: np.array([_apply(m, np.array([c], np.uint64))[0] for c in m], np.uint64)
    for _ in range(3):
        bit = square(bit)
    out = [bit]
    for _ in range(steps - 1):
        out.append(square(out[-1]))
    return out


def _apply(matrix: np.ndarray, v: np.ndarray) -> np.ndarray:
    out = np.zeros_like(v)
    for i in range(32):
        out ^= np.where((v >> np.uint64(i)) & np.uint64(1), matrix[i], np.uint64(0))
    return out


def piece_crc(upto_end: np.ndarray, upto_start: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 of what follows a prefix, from the CRCs of both prefixes."""
    v = upto_start.astype(np.uint64)
    for k, m in enumerate(_shift_matrices()):
        pick = ((n_bytes >> k) & 1).astype(bool)
        if pick.any():
            v[pick] = _apply(m, v[pick])
    return upto_end.astype(np.uint64) ^ v


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    sequence, filled = 0, 0
    for batch in batches:
        out: list[tuple] = []
        rows = zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
        for doc, total, crcs in rows:
            states = np.frombuffer(crcs, "<u4")
            start = 0
            while start < total:
                take = min(total - start, CAPACITY - filled)
                if start + take < total:
                    take = (start + take) // GRID * GRID - start
                if take > 0:
                    end = start + take
                    out.append((doc, start, take, int(states[-(-end // GRID) - 1]),
                                int(states[start // GRID - 1]) if start else 0, total, base + sequence, filled))
                    filled += take
                    start = end
                if start < total or filled == CAPACITY:
                    sequence, filled = sequence + 1, 0
        if out:
            doc, start, length, end_crc, start_crc, total, seq, at = zip(*out, strict=True)
            start, length = np.array(start), np.array(length)
            crc = np.array(end_crc, np.uint64)
            cut = start > 0
            if cut.any():
                crc[cut] = piece_crc(crc[cut], np.array(start_crc, np.uint64)[cut], 4 * length[cut])
            yield pa.record_batch([pa.array(doc, pa.int64()), pa.array(start), pa.array(length), pa.array(crc.astype(np.int64)),
                                   pa.array(total, pa.int64()), pa.array(seq, pa.int64()), pa.array(at, pa.int64())],
                                  [c.split()[0] for c in PIECES.split(", ")])


def pack(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece (ids are whole numbers): doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    ship_package(docs.sparkSession)
    keyed = with_row_id(id_and_text(docs, id_col, text_col), "id", "text")
    prepared = checkpoint(keyed.select("_rid", F.col("id").cast("long").alias("doc_id"), text_or_empty("text").alias("_x"))
                          .mapInArrow(textops.released(_prepare(tokenizer or default_tokenizer())), PREPARED))
    total = prepared.agg(F.sum("doc_tokens")).first()[0] or 0
    tasks = max(1, -(-total // TASK_TOKENS))
    along = prepared.repartitionByRange(tasks, "key", "_rid").sortWithinPartitions("key", "_rid")
    return along.mapInArrow(textops.released(_pack), PIECES)
