"""Repeated passages by prefix-free parsing, to a fixed depth of the corpus order.

A byte goes if a `depth`-byte string that covers it also starts in a document with a
smaller id. Only the order of suffixes to that depth matters.

Parse. Rolling-hash triggers are the least 16-byte grams of each depth-byte window.
Every window has one trigger and belongs to one phrase: the windows with the same
trigger, with all their bytes (phrases overlap by depth - 1 bytes, which makes them
prefix-free for this depth). A document is the sequence of its phrases' numbers.
Dictionary. Equal phrases anywhere in the corpus become one entry. Phrases of a later
document than the entry's first are repeats as a whole; they take no further part.
Order. The suffixes of the dictionary's entries are sorted by their bytes, to the depth:
its suffix array. In general the parse's suffix array would order the suffixes that agree
to the end of a phrase; here every window ends within its phrase, so none is left over,
and an entry's place in the parse only says which document has it first. Two suffixes can
agree to the depth only if their windows have the same trigger gram and the same 16 bytes
before or after it, so the array comes in parts by gram and these bytes, and entries that
share neither with another entry are in place already. Each class of suffixes that agree
gets the least id of its documents.
The answers return to the documents, which are parsed again rather than kept.

Equality. Of phrases: 64 bits of their hash and 32 to 48 of their gram's. Of windows: their
bytes. At 100 TB (about 6e12 phrases) a false pair of phrases has a chance of about 1e-8.

Scale. Documents lie in blocks (by hash), compressed, in one checkpointed table that is
partitioned by block; both passes over it shuffle nothing but keys and the entries to be
ordered. Both are deduplicated within a block before they leave it and spread by hash, so a
gram, phrase or passage of a third of all rows brings at most a few keys per block: a gram
with more than `many` phrases in one block sends a mark in their place, and its entries are
spread by the bytes beside it. A group still grows with the number of blocks that share a
key (16 bytes each).

Defined cases: null texts are empty; texts shorter than the depth lose nothing; a null id
counts as the largest; rows of equal ids don't take bytes from each other; an empty table
gives an empty result; other columns are carried only where asked for. A document is held
whole by one task, with about 10 bytes for each of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import U64, give_back, mix64, stable

DEPTH = 50
GRAM = 16
#: Bytes of text in a block and (of keys' origin) in a bucket, on average.
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 12 << 20
MANY = 8
_NO_ID = np.iinfo(np.int64).max
_PIECE, _BITS = 1 << 17, 17
_POS = U64((1 << _BITS) - 1)
_C1, _C2, _R = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), 0xD6E8FEB86659FD93
_powers: list[np.ndarray] = []


def _power(i: int) -> np.ndarray:
    """Powers of the odd base (0) and of its inverse (1) modulo 2**64."""
    if not _powers:
        for base in (_R, pow(_R, -1, 1 << 64)):
            p = np.full((1 << _BITS) + 1, base, np.uint64)
            p[0] = 1
            _powers.append(np.cumprod(p))
    return _powers[i]


def _words(buf: np.ndarray) -> np.ndarray:
    """The 8-byte little-endian word at each byte offset."""
    return np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))


def _parse(buf: np.ndarray, cuts: list[int], depth: int) -> tuple[np.ndarray, ...]:
    """Phrases of a buffer of at most 2**20 bytes in which no window crosses a cut.

    Returns starts, numbers of windows, gram hashes, phrase hashes, sides and the grams' offsets.
    sides: two 12-bit hashes, of the bytes before and after the gram. Windows of two phrases that
    are equal have one of these in common, since most of what is left of a window lies on one
    side; 0: no window reaches so far.
    """
    n, w = len(buf), depth - GRAM + 1
    words = _words(buf)
    h = mix64(words[: n - GRAM + 1] * _C1 + words[8 : n - GRAM + 9] * _C2)
    key = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span * 2 <= w:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < w:
        key = np.minimum(key[: len(key) - (w - span)], key[w - span :])
    trigger = (key & _POS).astype(np.int64)
    valid = np.ones(len(trigger), bool)
    for c in cuts:
        valid[max(0, c - depth + 1) : c] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return at, at, *[np.zeros(0, np.uint64)] * 3, at
    t = trigger[at]
    new = np.ones(len(at), bool)
    new[1:] = (t[1:] != t[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    lo, hi = at[first], at[np.append(first[1:], len(at)) - 1]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _power(0)[: len(h)])])
    phrase = (total[hi + w] - total[lo]) * _power(1)[lo]
    g, half = t[first], (depth - GRAM + 1) // 2
    left = np.where(g - lo >= half, mix64(h[np.maximum(g - GRAM, 0)]) % U64(4095) + U64(1), U64(0))
    right = np.where(hi > g - half, mix64(h[np.minimum(g + GRAM, len(h) - 1)]) % U64(4095) + U64(1), U64(0))
    return lo, hi - lo + 1, mix64(h[g] ^ _C1), mix64(phrase ^ (hi - lo).astype(np.uint64)), left << U64(12) | right, g - lo


class Block:
    """The documents of a block in order of id, parsed, with the entries of its own dictionary."""

    def __init__(self, ids: list, texts: list[bytes], depth: int = DEPTH, bits: int = 48) -> None:
        if (depth - GRAM + 1) // 2 < GRAM:
            raise ValueError(f"a depth of {depth} is too small for grams of {GRAM} bytes")
        self.depth, self.shift = depth, U64(64 - bits)
        self.rows = sorted(range(len(ids)), key=lambda i: (_NO_ID if ids[i] is None else ids[i], i))
        self.ids = np.array([_NO_ID if ids[i] is None else ids[i] for i in self.rows], np.int64)
        raw = [texts[i] for i in self.rows]
        self.ends = np.cumsum([len(x) for x in raw], dtype=np.int64)
        self.raw = np.frombuffer(b"".join(raw) + bytes(8), np.uint8)
        parts, start = [], 0
        size = int(self.ends[-1]) if len(raw) else 0
        cuts = self.ends.tolist()
        while start + depth <= size:  # pieces overlap by depth - 1 bytes: each window lies in one
            stop = min(size, start + _PIECE)
            a, b = np.searchsorted(self.ends, [start, stop], side="right")
            inner = [c - start for c in cuts[a : b + 1] if c - start > 0 and c <= stop]
            lo, *rest = _parse(self.raw[start:stop], inner, depth)
            parts.append((lo + start, *rest))
            start = stop - depth + 1 if stop < size else size
        empty = (*[np.zeros(0, np.int64)] * 2, *[np.zeros(0, np.uint64)] * 3, np.zeros(0, np.int64))
        self.at, self.n, g, p, sides, self.offset = (np.concatenate(x) for x in zip(*parts)) if parts else empty
        self.doc = self.ids[np.searchsorted(self.ends, self.at, side="right")]
        # equal phrases lie together, least id first: the order of ids is kept by the stable sort
        order = np.argsort((g & ~U64(0xFFFF)) | (p >> U64(48)), kind="stable")
        gs, ps = g[order], p[order]
        new = np.ones(len(order), bool)
        new[1:] = (gs[1:] != gs[:-1]) | (ps[1:] != ps[:-1])
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.first = order[new]
        self.gram, self.phrase, self.sides = gs[new], ps[new], sides[self.first]

    def keys(self, many: int = MANY) -> tuple[np.ndarray, ...]:
        """What stands for the entries: gram, phrase, id, mark, sides, and for each entry the number of its key.

        mark: 0 a phrase; 1 or 2 a gram with more than `many` phrases, in one or more documents.
        """
        n = len(self.first)
        run = np.ones(n, bool)
        gram = self.gram >> self.shift
        run[1:] = gram[1:] != gram[:-1]
        of = np.cumsum(run) - 1
        heads = np.flatnonzero(run)
        crowd = np.diff(np.append(heads, n)) > many
        doc = self.doc[self.first]
        mark = np.zeros(n, np.uint8)
        if n and crowd.any():
            # a document repeated within the block counts: the latest id of any occurrence
            latest = np.zeros(n, np.int64)
            np.copyto(latest, doc)
            np.maximum.at(latest, self.entry, self.doc)
            several = np.maximum.reduceat(latest, heads) > np.minimum.reduceat(doc, heads)
            mark = np.where(crowd[of], 1 + several[of], 0).astype(np.uint8)
        sent = (mark == 0) | run
        number = np.cumsum(sent) - 1
        lowest = np.minimum.reduceat(doc, heads)[of] if n else doc
        return gram[sent], self.phrase[sent], np.where(mark == 0, doc, lowest)[sent], mark[sent], np.where(mark == 0, self.sides, U64(0))[sent], number

    def parts(self, code: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
        """The parts of entries whose suffixes have to be ordered: bucket, entry, start, number of windows.

        code: 2 for the windows that hold the bytes before the gram, 4 for those that hold the bytes
        after it. Parts are in order of bucket.
        """
        rep = self.first
        lo, gram = self.at[rep], self.at[rep] + self.offset[rep]
        hi, half = lo + self.n[rep] - 1, (self.depth - GRAM + 1) // 2
        words, found = _words(self.raw), []
        for bit, start, stop, beside in ((2, lo, np.minimum(hi, gram - half), -GRAM), (4, np.maximum(lo, gram - half + 1), hi, GRAM)):
            e = np.flatnonzero((code & bit > 0) & (stop >= start))
            at = gram[e] + beside
            key = mix64(mix64(words[at] * _C1 + words[at + 8] * _C2 + U64(bit)) + self.gram[e])
            found.append((_bucket(key, 64, buckets), e, start[e], stop[e] - start[e] + 1))
        found = [np.concatenate(x) for x in zip(*found)]
        order = np.argsort(found[0], kind="stable")
        return tuple(x[order] for x in found)


# ------------------------------------------------------------ keys on the wire


def _pack(values: np.ndarray) -> bytes:
    """Byte planes of unsigned numbers, low to high; high planes are mostly zeros and cost little."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


_WIRE = "kind int, bucket int, block long, ids binary, data array<binary>"
_WIRE_PA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("data", pa.list_(pa.binary()))])
_BACK = "kind int, bucket int, block long, codes binary"
_BACK_PA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("codes", pa.binary())])


def _send(kind: int, block: int, bucket: np.ndarray, key: np.ndarray, ids: np.ndarray, rest: list[np.ndarray]) -> pa.Table:
    """Keys, sorted by bucket and key, as one row for each bucket."""
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist() + [len(bucket)] if len(bucket) else []
    out = []
    for a, b in zip(cuts, cuts[1:]):
        known, which = np.unique(ids[a:b], return_inverse=True)
        steps = np.diff(key[a:b], prepend=np.zeros(1, np.uint64))
        out.append((kind, int(bucket[a]), block, known.tobytes(), [_pack(x) for x in (steps, which, *(r[a:b] for r in rest))]))
    return pa.Table.from_arrays([pa.array([r[i] for r in out], _WIRE_PA.field(i).type) for i in range(5)], schema=_WIRE_PA)


def _received(group: pa.Table) -> tuple[list, list[np.ndarray], np.ndarray]:
    """Origins, columns (key, id, others) and the limits of the origins' parts."""
    kinds, buckets, blocks, ids, data = (group.column(i) for i in range(5))
    origin, parts, sizes = [], [], []
    for i in range(group.num_rows):
        steps, which, *rest = (_unpack(x) for x in data[i].as_py())
        parts.append((np.cumsum(steps), np.frombuffer(ids[i].as_py(), np.int64)[which.astype(np.int64)], *rest))
        origin.append((kinds[i].as_py(), buckets[i].as_py(), blocks[i].as_py()))
        sizes.append(len(steps))
    return origin, [np.concatenate(x) for x in zip(*parts)], np.cumsum([0, *sizes])


def _answer(origin: list, codes: list[np.ndarray]) -> pa.Table:
    rows = [(*o, c.tobytes()) for o, c in zip(origin, codes)]
    give_back()
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], _BACK_PA.field(i).type) for i in range(4)], schema=_BACK_PA)


def _ragged(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... n[i] numbers, one i after the other."""
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())


def _send_parts(block: Block, number: int, parts: tuple[np.ndarray, ...]) -> pa.Table:
    """Parts of entries with their bytes and documents, a row for each bucket."""
    from zstandard import ZstdCompressor

    squeeze = ZstdCompressor(level=1).compress
    bucket, entry, start, n = parts
    ids, size = block.doc[block.first[entry]], n + block.depth - 1
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist() + [len(bucket)] if len(bucket) else []
    out = []
    for a, b in zip(cuts, cuts[1:]):
        known, which = np.unique(ids[a:b], return_inverse=True)
        text = block.raw[_ragged(start[a:b], size[a:b])].tobytes()
        out.append((2, int(bucket[a]), number, known.tobytes(), [squeeze(_pack(which)), squeeze(n[a:b].astype(np.uint8).tobytes()), squeeze(text)]))
    return pa.Table.from_arrays([pa.array([r[i] for r in out], _WIRE_PA.field(i).type) for i in range(5)], schema=_WIRE_PA)


def _starts(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    for i, c in enumerate(columns):
        new[1:] = new[1:] | (c[1:] != c[:-1]) if i else c[1:] != c[:-1]
    return new


def _judge_phrases(group: pa.Table) -> pa.Table:
    """1: a smaller id has the phrase; 2, 4: its suffixes with the bytes before (2) or after the gram
    (4) have to be ordered; 0: none of these."""
    origin, (gram, ids, phrase, mark, sides), limits = _received(group)
    mark = mark.astype(np.uint8)
    source = np.repeat(np.arange(len(origin)), np.diff(limits)).astype(np.uint64)
    phrase = np.where(mark > 0, source, phrase)
    order = np.lexsort((ids, phrase, mark > 0, gram))
    g, p, d, m = gram[order], phrase[order], ids[order], mark[order]
    new = _starts(g, p, m > 0)
    least = d[np.maximum.accumulate(np.where(new, np.arange(len(d)), 0))]
    top = _starts(g)
    heads = np.flatnonzero(top)
    of = np.cumsum(top) - 1
    most = np.maximum.reduceat(m, heads)
    apart = (np.maximum.reduceat(d, heads) > np.minimum.reduceat(d, heads)) | (most == 2)
    # open: another phrase of the gram has the same bytes on a side, or can't be told
    some = np.flatnonzero(new)
    open_ = np.where((most > 0)[of[some]], 6, 0)
    for bit, side in ((2, sides[order][some] >> U64(12)), (4, sides[order][some] & U64(4095))):
        by = np.lexsort((side, g[some]))
        head = _starts(g[some][by], side[by])
        alike = np.add.reduceat(np.ones(len(by), np.int64), np.flatnonzero(head))[np.cumsum(head) - 1]
        open_[by] |= np.where((alike > 1) & (side[by] > 0), bit, 0)
    open_ = open_[np.cumsum(new) - 1]  # rows of one id may lie in several blocks
    code = np.where((d > least) & (m == 0), 1, np.where(apart[of], open_, 0)).astype(np.uint8)
    codes = np.empty(len(code), np.uint8)
    codes[order] = code
    return _answer(origin, np.split(codes, limits[1:-1]))


def _judge_suffixes(depth: int):
    """A bit for each window: a smaller id has it. Windows are ordered by their bytes."""

    def judge(group: pa.Table) -> pa.Table:
        from zstandard import ZstdDecompressor

        unzip = ZstdDecompressor().decompress
        kinds, buckets, blocks, ids, data = (group.column(i) for i in range(5))
        origin, parts = [], []
        for i in range(group.num_rows):
            which, n, text = (np.frombuffer(unzip(x), np.uint8) for x in data[i].as_py())
            origin.append((kinds[i].as_py(), buckets[i].as_py(), blocks[i].as_py()))
            parts.append((np.frombuffer(ids[i].as_py(), np.int64)[_unpack(which.tobytes()).astype(np.int64)], n.astype(np.int64), text))
        id_, n, text = (np.concatenate(x) for x in zip(*parts))
        size = n + depth - 1
        start = _ragged(np.cumsum(size) - size, n)  # suffixes of at least the depth
        word = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))
        keys = [word[start + o].astype(np.uint64) for o in (*range(0, depth - 7, 8), depth - 8)]
        doc = np.repeat(id_, n)
        array = np.lexsort((doc, *reversed(keys)))
        new = _starts(*(k[array] for k in keys))
        d = doc[array]
        gone = np.empty(len(d), bool)
        gone[array] = d > d[np.maximum.accumulate(np.where(new, np.arange(len(d)), 0))]
        return _answer(origin, [np.packbits(x) for x in np.split(gone, np.cumsum([x[1].sum() for x in parts])[:-1])])

    return judge


# ------------------------------------------------------------------ the passes


def _bucket(high: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Ranges of the keys' upper bits, so that sorted keys are sorted by bucket."""
    return ((high >> U64(bits - 32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _gram_bits(size: int) -> int:
    """Bits of a gram's hash that tell all of a corpus's grams apart but for one in a hundred or so."""
    return min(48, max(32, size.bit_length() + 3))


def _load(docs: pa.Table, depth: int, bits: int) -> Block:
    from zstandard import ZstdDecompressor

    give_back()  # of the block before
    unzip = ZstdDecompressor().decompress
    return Block(docs.column("doc_id").to_pylist(), [unzip(z.as_py()) for z in docs.column("z")], depth, bits)


def _codes(back: pa.Table, kind: int) -> list[np.ndarray]:
    """A block's answers of one kind by bucket, in the order in which it sent its keys."""
    rows = sorted((b, c) for k, b, c in zip(back.column("kind").to_pylist(), back.column("bucket").to_pylist(), back.column("codes").to_pylist()) if k == kind)
    return [np.frombuffer(c, np.uint8) for _, c in rows]


def _entry_codes(block: Block, back: pa.Table) -> np.ndarray:
    number = block.keys()[5]
    return np.concatenate(_codes(back, 1))[number] if len(number) else np.zeros(0, np.uint8)


def _pack_docs(docs: DataFrame, blocks: int, carried: list[str]) -> DataFrame:
    def zip_texts(batches):
        from zstandard import ZstdCompressor

        squeeze = ZstdCompressor(level=3).compress
        for batch in batches:
            z = pa.array([squeeze(t.as_py()) for t in batch.column("text")], pa.binary())
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), z], names=[*keep, "z"])

    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).alias("block"),
        *([F.struct(*[F.col(f"`{c}`") for c in carried]).alias("rest")] if carried else []),
        text.cast("binary").alias("text"),
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != "text") + ", z binary"
    return own.mapInArrow(zip_texts, schema).repartition(blocks, "block")


def repeated_passages(docs: DataFrame, depth: int = DEPTH, carried: list[str] | None = None, with_text: bool = False, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; also rest (a struct of the
    carried columns) and kept (the remaining bytes), where asked for."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = 1 + size // block_bytes, 1 + size // bucket_bytes
    bits = _gram_bits(size)
    packed = stable(_pack_docs(docs, blocks, carried or []), partitioned=True)
    lean = packed.select("block", "doc_id", "z")

    def parse(key: tuple, group: pa.Table) -> pa.Table:
        gram, phrase, ids, mark, sides, _ = _load(group, depth, bits).keys()
        return _send(1, key[0].as_py(), _bucket(gram, bits, buckets), gram, ids, [phrase, mark, sides])

    def open_suffixes(key: tuple, group: pa.Table, back: pa.Table) -> pa.Table:
        block = _load(group, depth, bits)
        return _send_parts(block, key[0].as_py(), block.parts(_entry_codes(block, back), buckets))

    def remove(key: tuple, group: pa.Table, back: pa.Table) -> pa.Table:
        block = _load(group, depth, bits)
        code = _entry_codes(block, back)
        bucket, entry, start, n = block.parts(code, buckets)
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else bucket
        bits_of = [np.unpackbits(c, count=int(k)) for c, k in zip(_codes(back, 2), np.add.reduceat(n, cuts))] if len(bucket) else []
        entries = np.flatnonzero(code & 6)
        many = block.n[block.first[entries]]
        slot = np.full(len(block.first), -1, np.int64)
        slot[entries] = np.cumsum(many) - many
        gone = np.zeros(int(many.sum()), bool)
        if len(bucket):
            gone[_ragged(slot[entry] + start - block.at[block.first[entry]], n)] = np.concatenate(bits_of) > 0
        change = np.zeros(len(block.raw) + depth, np.int32)
        whole = (code[block.entry] == 1) | (block.doc > block.doc[block.first[block.entry]]) if len(block.entry) else np.zeros(0, bool)
        np.add.at(change, block.at[whole], 1)
        np.subtract.at(change, block.at[whole] + block.n[whole] + depth - 1, 1)
        rest = np.flatnonzero(~whole & (slot[block.entry] >= 0)) if len(block.entry) else np.zeros(0, np.int64)
        n = block.n[rest]
        at = _ragged(block.at[rest], n)[gone[_ragged(slot[block.entry[rest]], n)]]
        np.add.at(change, at, 1)
        np.subtract.at(change, at + depth, 1)
        covered = np.cumsum(change) > 0
        n_bytes, n_removed, n_spans, sha, kept = ([None] * len(block.rows) for _ in range(5))
        start = 0
        for row, end in zip(block.rows, block.ends.tolist()):
            c, raw = covered[start:end], block.raw[start:end]
            left = raw[~c].tobytes() if c.any() else raw.tobytes()
            n_bytes[row], n_removed[row] = end - start, end - start - len(left)
            n_spans[row] = int(c[:1].sum() + (c[1:] & ~c[:-1]).sum())
            sha[row], kept[row], start = hashlib.sha256(left).hexdigest(), left if with_text else None, end
        out = {"doc_id": group.column("doc_id")} | ({"rest": group.column("rest")} if carried else {})
        out |= {"n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
        return pa.table(out | ({"kept": pa.array(kept, pa.binary())} if with_text else {}))

    by_block = lean.groupBy("block")
    first = stable(by_block.applyInArrow(parse, _WIRE).groupBy("bucket").applyInArrow(_judge_phrases, _BACK))
    sent = by_block.cogroup(first.groupBy("block")).applyInArrow(open_suffixes, _WIRE)
    second = sent.groupBy("bucket").applyInArrow(_judge_suffixes(depth), _BACK)
    schema = "doc_id long, " + (f"rest {packed.schema['rest'].dataType.simpleString()}, " if carried else "")
    schema += "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    final = packed if carried else lean
    return final.groupBy("block").cogroup(first.unionAll(second).groupBy("block")).applyInArrow(remove, schema)


def repeats_report(docs: DataFrame) -> DataFrame:
    """The digest per document that the query returns."""
    return repeated_passages(docs)


def strip_repeats(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The documents with repeated bytes taken out of their texts; n_chars, if there, follows.

    Removal is by bytes; what is left of a character that was cut is dropped with it. A
    null text becomes an empty one; any other that nothing is taken from stays as it is.
    """
    names = docs.columns
    others = [c for c in names if c != "text"]
    found = repeated_passages(docs, depth, carried=others, with_text=True)

    def decode(batches):
        for batch in batches:
            text = pa.array([x.as_py().decode("utf-8", "ignore") for x in batch.column("kept")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("rest"), text], names=["rest", "text"])

    schema = f"rest {found.schema['rest'].dataType.simpleString()}, text string"
    texts = found.select("rest", "kept").mapInArrow(decode, schema)
    out = texts.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in names])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
