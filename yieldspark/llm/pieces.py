"""SentencePiece (BPE) encoding with source offsets, and decoding.

A model file is read once on the driver; its piece table and its compiled
character map (a double-array trie of byte strings, followed by their
replacements) are broadcast. Encoding a text:

1. Normalise: at each position the longest prefix that the map knows is
   replaced (without one, a character stands for itself), spaces become U+2581
   and one is put in front. Every normalised byte keeps the source byte it
   came from.
2. Split before each U+2581 that follows another character. A piece that holds
   U+2581 anywhere but at its start would make this wrong; then the text stays
   whole.
3. Merge: in each segment the adjacent pair whose joined piece scores best is
   merged, the leftmost among equals, until none is known. A character that is
   no piece becomes its bytes' pieces.
4. Project: a piece's end in the normalised text gives its end in the source.

Segments repeat, so a worker keeps what it has merged (a bounded cache, only
for speed). Decoding joins the pieces of the ids, turns U+2581 into spaces and
takes off the one that encoding put in front.

Defined cases: a NULL text counts as empty and has no ids; repeated rows and
ids are encoded row by row; an empty table gives an empty result; other
columns are passed through. Models other than BPE, or with user-defined or
unused pieces or spaces as suffixes, are refused.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, without
from .decontam import slices

MARK = "▁".encode()
_REPLACEMENT = "�".encode()
SLICE_BYTES, CACHE_SEGMENTS, HEAP_FROM = 2 << 20, 600_000, 48


class CharMap:
    """Compiled character map: longest known prefix and its replacement."""

    def __init__(self, blob: bytes):
        n = int.from_bytes(blob[:4], "little")
        self.units = array("I", blob[4:4 + n])
        self.texts = blob[4 + n:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        units, best = self.units, None
        offset = lambda u: (u >> 10) << ((u & 0x200) >> 6)
        node = offset(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= offset(unit)
            if unit & 0x100:
                best = i + 1 - at, units[node] & 0x7FFFFFFF
        if best is None:
            return None
        n, start = best
        return n, self.texts[start:self.texts.index(b"\0", start)]


@dataclass(frozen=True)
class Rules:
    charmap: bytes
    dummy_prefix: bool
    remove_extra_spaces: bool
    escape_spaces: bool


def char_length(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normalizer:
    def __init__(self, rules: Rules):
        self.rules = rules
        self.map = CharMap(rules.charmap) if rules.charmap else None
        self.plain = self.map is None and not rules.remove_extra_spaces and rules.escape_spaces and rules.dummy_prefix

    def prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        found = self.map.longest(data, at) if self.map else None
        if found:
            return found
        n = min(char_length(data[at]), len(data) - at)
        return n, data[at:at + n]

    def normalise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them (and the end) the source offset."""
        if not data:
            return b"", np.zeros(1, dtype=np.int64)
        if self.plain:
            src = np.frombuffer(data, dtype=np.uint8)
            wide = np.where(src == 32, 3, 1)
            back = np.repeat(np.arange(len(src)), wide)
            return MARK + data.replace(b" ", MARK), np.concatenate([np.zeros(3, dtype=np.int64), back, [len(src)]])
        r, out, back, at = self.rules, bytearray(), [], 0
        space = MARK if r.escape_spaces else b" "
        if r.remove_extra_spaces:
            while at < len(data):
                n, to = self.prefix(data, at)
                if to != b" ":
                    break
                at += n
            if at == len(data):
                return b"", np.array([at])
        after_space = r.remove_extra_spaces
        if r.dummy_prefix:
            out += space
            back += [at] * len(space)
        while at < len(data):
            n, to = self.prefix(data, at)
            if after_space:
                to = to.lstrip(b" ")
            if to:
                new = to.replace(b" ", space)
                out += new
                back += [at] * len(new)
                after_space = to.endswith(b" ")
            at += n
            if not r.remove_extra_spaces:
                after_space = False
        if r.remove_extra_spaces:
            while out.endswith(space):
                at = back[len(out) - len(space)]
                del out[len(out) - len(space):]
                del back[len(out):]
        return bytes(out), np.array([*back, at])


class Model:
    """Piece table and normalisation rules of a model file's bytes."""

    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        m = pb.ModelProto()
        m.ParseFromString(blob)
        kinds = pb.ModelProto.SentencePiece
        if m.trainer_spec.model_type != pb.TrainerSpec.BPE or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with spaces as prefixes are supported")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in m.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        n = m.normalizer_spec
        self.rules = Rules(n.precompiled_charsmap, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces)
        self.byte_ids: list[int] = [0] * 256
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.out: list[bytes] = []      # what an id adds to a decoded text
        self.size: list[int] = []       # its bytes in the normalised text; byte pieces: -1
        self.unk = 0
        for i, p in enumerate(m.pieces):
            self.out.append(p.piece.encode().replace(MARK, b" ") if p.type == kinds.NORMAL else b"")
            self.size.append(len(p.piece.encode()) if p.type == kinds.NORMAL else 0)
            if p.type == kinds.NORMAL:
                self.ids[p.piece], self.score[p.piece] = i, p.score
            elif p.type == kinds.BYTE:
                b = int(p.piece[3:5], 16)
                self.byte_ids[b], self.out[i], self.size[i] = i, bytes([b]), -1
            elif p.type == kinds.UNKNOWN:
                self.unk, self.out[i] = i, m.trainer_spec.unk_surface.encode()
        self.byte_fallback = m.trainer_spec.byte_fallback
        mark = MARK.decode()
        self.splits = not any(mark in p.lstrip(mark) for p in self.ids)


class Pairs:
    """Which two adjacent symbols make which piece, for merging many segments at once.

    Symbols are piece ids, then numbers for characters that only occur inside pieces; any other character is negative.
    """

    NONE = np.iinfo(np.int32).max

    def __init__(self, model: Model):
        self.symbol = dict(model.ids)
        n = len(model.out)
        for c in sorted({c for p in model.ids for c in p} - set(model.ids)):
            self.symbol[c] = n
            n += 1
        self.n = n
        order = {s: r for r, s in enumerate(sorted(set(model.score.values()), reverse=True))}
        get = self.symbol.get
        rows = []
        for p, i in model.ids.items():
            for k in range(1, len(p)):
                left, right = get(p[:k]), get(p[k:])
                if left is not None and right is not None:
                    rows.append((left * n + right, i, order[model.score[p]]))
        rows.sort()
        self.key, self.piece, self.rank = (np.array(c, dtype=t) for c, t in zip(
            zip(*rows) if rows else ((), (), ()), (np.int64, np.int32, np.int32)))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of each pair; rank NONE for no piece."""
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.n + right)
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        known = self.key[at] == key if len(self.key) else np.zeros(len(key), dtype=bool)
        return np.where(known, self.rank[at], self.NONE), np.where(known, self.piece[at], -1)

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of all segments in order, symbols per segment): in rounds, each merges a segment's first best pair."""
        size = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        code, at = np.unique(np.frombuffer("".join(segments).encode("utf-32-le"), dtype="<u4"), return_inverse=True)
        sym = np.array([self.symbol.get(chr(c), -1 - int(c)) for c in code], dtype=np.int64)[at]
        seg = np.repeat(np.arange(len(size)), size)
        rank, piece = np.full(len(sym), self.NONE, dtype=np.int32), np.full(len(sym), -1, dtype=np.int32)

        def renew(i: np.ndarray) -> None:
            i = i[(i >= 0) & (i < len(sym) - 1)]
            same = seg[i] == seg[i + 1]
            rank[i[~same]] = self.NONE
            i = i[same]
            rank[i], piece[i] = self.look_up(sym[i], sym[i + 1])

        renew(np.arange(len(sym)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            first = np.nonzero(np.diff(seg, prepend=-1))[0]
            n = np.diff(np.append(first, len(seg)))
            best = np.repeat(np.minimum.reduceat(rank, first), n)
            over = best == self.NONE
            if over.any():
                done.append((seg[over], sym[over]))
                go = ~over
                seg, sym, rank, piece, best = seg[go], sym[go], rank[go], piece[go], best[go]
                if not len(sym):
                    break
            hit = np.nonzero(rank == best)[0]
            hit = hit[np.diff(seg[hit], prepend=-1) != 0]
            sym[hit] = piece[hit]
            stay = np.ones(len(sym), dtype=bool)
            stay[hit + 1] = False
            seg, sym, rank, piece = seg[stay], sym[stay], rank[stay], piece[stay]
            hit = hit - np.arange(len(hit))
            rank[hit[hit == len(sym) - 1]] = self.NONE
            renew(hit)
            before = hit - 1
            renew(before[(before >= 0)])
        if not done:
            return sym, size
        segs, syms = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(segs, kind="stable")
        return syms[order], np.bincount(segs, minlength=len(size))


class Encoder:
    def __init__(self, model: Model):
        self.model, self.normalizer = model, Normalizer(model.rules)
        self.sizes = np.array(model.size, dtype=np.int64)
        self.byte_of = np.full(len(model.out), -1, dtype=np.int64)
        if model.byte_fallback:
            self.byte_of[model.byte_ids] = np.arange(256)
        self.pairs = Pairs(model)
        self.slots: dict = {}
        self.clear()

    def clear(self) -> None:
        """Empty the cache but for segments that were asked for again since they came in."""
        old = [k for k, s in self.slots.items() if self.again[s]] if self.slots else []
        keep = old if len(old) <= CACHE_SEGMENTS // 2 else []
        parts = [self.flat[self.starts[self.slots[k]]:self.starts[self.slots[k] + 1]] for k in keep]
        self.slots = {k: i for i, k in enumerate(keep)}
        self.flat, self.starts = array("i"), array("q", [0])
        for p in parts:
            self.flat.extend(p)
            self.starts.append(len(self.flat))
        self.again = np.zeros(len(keep), dtype=bool)

    def learn(self, keys: list) -> None:
        """Put the ids of new segments into the cache."""
        text = [k[0].decode() if isinstance(k, tuple) else (MARK + k).decode() for k in keys]
        short = [i for i, s in enumerate(text) if len(s) < HEAP_FROM]
        ready: dict[int, list[int]] = {}
        if short:
            sym, n = self.pairs.merge([text[i] for i in short])
            byte_ids = np.array(self.model.byte_ids)
            if self.model.byte_fallback:  # a character that is no piece, of one byte
                plain = (sym < 0) & (sym >= -128)
                sym[plain] = byte_ids[-1 - sym[plain]]
            odd = (sym < 0) | (sym >= len(self.model.out))
            edge = np.concatenate([[0], np.cumsum(n)])
            rest = set(np.repeat(np.arange(len(n)), n)[odd].tolist())
            flat = sym.tolist()
            edge = edge.tolist()
            ready = {i: flat[edge[j]:edge[j + 1]] for j, i in enumerate(short) if j not in rest}
        for i, k in enumerate(keys):
            self.flat.extend(ready[i] if i in ready else self.segment_ids(text[i]))
            self.slots[k] = len(self.starts) - 1
            self.starts.append(len(self.flat))

    def merge(self, s: str) -> list[str]:
        """Pieces of one segment."""
        score = self.model.score.get
        sym = list(s)
        if len(sym) >= HEAP_FROM:
            return self._merge_long(sym)
        low = float("-inf")
        pairs = [score(a + b, low) for a, b in zip(sym, sym[1:])]
        while pairs:
            best = max(pairs)
            if best == low:
                break
            i = pairs.index(best)
            sym[i:i + 2] = [sym[i] + sym[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(sym[i - 1] + sym[i], low)
            if i < len(pairs):
                pairs[i] = score(sym[i] + sym[i + 1], low)
        return sym

    def _merge_long(self, sym: list) -> list[str]:
        """The same by a heap over a linked list: n log n for long segments."""
        score = self.model.score.get
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list = []

        def offer(i: int) -> None:
            j = right[i] if i >= 0 else -1
            if j >= 0 and (s := score(sym[i] + sym[j])) is not None:
                heap.append((-s, i, sym[i], sym[j])) if not ready else heapq.heappush(heap, (-s, i, sym[i], sym[j]))

        ready = False
        for i in range(n):
            offer(i)
        heapq.heapify(heap)
        ready = True
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if sym[i] != a or right[i] < 0 or sym[right[i]] != b:
                continue
            j = right[i]
            sym[i], sym[j], right[i] = a + b, None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i])
            offer(i)
        return [x for x in sym if x is not None]

    def segment_ids(self, s: str) -> list[int]:
        ids, m = self.model.ids, self.model
        out: list[int] = []
        for p in self.merge(s):
            i = ids.get(p)
            if i is not None:
                out.append(i)
            elif m.byte_fallback:
                out.extend(m.byte_ids[b] for b in p.encode())
            else:
                out.append(m.unk)
        return out

    def keys(self, norm: bytes) -> list:
        """Segments of a normalised text; one that starts with U+2581 stands without its first."""
        if not norm:
            return []
        if not self.model.splits:
            return [(norm,)]
        parts = norm.split(MARK)
        out: list = [(parts[0],)] if parts[0] else []
        parts = parts[1:]
        if b"" not in parts:
            out += parts
            return out
        run = 0
        for p in parts:
            if p:
                out.append(MARK * run + p)
                run = 0
            else:
                run += 1
        if run:
            out.append(MARK * (run - 1))
        return out

    def encode(self, norms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has."""
        if len(self.slots) > CACHE_SEGMENTS:
            self.clear()
        keys, counts, slots = [], [], self.slots
        for norm in norms:
            k = self.keys(norm)
            keys += k
            counts.append(len(k))
        known = len(slots)
        if new := list(set(keys).difference(slots)):
            self.learn(new)
            self.again = np.concatenate([self.again, np.zeros(len(slots) - len(self.again), dtype=bool)])
        slot = np.fromiter(map(slots.__getitem__, keys), dtype=np.int64, count=len(keys))
        self.again[slot[slot < known]] = True
        # Copies, so that the arrays can grow again.
        starts, flat = np.array(self.starts), np.array(self.flat, dtype=np.int32)
        size = starts[slot + 1] - starts[slot]
        before = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat(starts[slot] - before[:-1], size) + np.arange(before[-1])]
        edge = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64))])
        return ids, np.diff(before[edge])

    def ends(self, ids: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Source end of each piece of one text; all bytes of a character but its last end where it starts."""
        size = self.sizes[ids]
        at = np.nonzero(size < 0)[0]
        if len(at):
            value = self.byte_of[ids[at]]
            lead = (value & 0xC0) != 0x80
            width = np.where(value < 0xC0, 1, np.where(value < 0xE0, 2, np.where(value < 0xF0, 3, 4)))
            size[at] = 0
            size[at[lead] + width[lead] - 1] = width[lead]
        return back[np.cumsum(size)]


def _valid(data: bytes) -> bytes:
    """UTF-8 with U+FFFD for each byte that belongs to no character."""
    out, at = bytearray(), 0
    while at < len(data):
        n = char_length(data[at])
        try:
            data[at:at + n].decode()
            out += data[at:at + n]
            at += n
        except UnicodeDecodeError:
            out += _REPLACEMENT
            at += 1
    return bytes(out)


def decode(model: Model, ids: list[int]) -> bytes:
    out = b"".join(map(model.out.__getitem__, ids))
    first = next((i for i in ids if model.out[i]), None)
    if first is not None and model.size[first] > 0 and out[:1] == b" " and (
            model.rules.dummy_prefix or model.rules.remove_extra_spaces):
        out = out[1:]
    try:
        out.decode()
    except UnicodeDecodeError:
        out = _valid(out)
    return out


_ENCODERS: dict[int, Encoder] = {}


def _encoder(blob: bytes) -> Encoder:
    """One per worker and model, so that its cache outlives a task."""
    key = hash(blob)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Model(blob))
    return _ENCODERS[key]


def encode(docs: DataFrame, model_path: str, out: tuple[str, str, str] = ("ids", "ends", "decoded"),
           text: str = "text") -> DataFrame:
    """``docs`` plus ids (array<int>), the source byte end of each piece (array<int>) and the decoded text.

    A piece starts where the one before it ends, the first one at 0.
    """
    docs = without(docs, *out)
    with open(model_path, "rb") as f:  # the tokenizer file is installed beside the library, on the driver
        blob = docs.sparkSession.sparkContext.broadcast(f.read())
    ints = T.ArrayType(T.IntegerType())
    new = [T.StructField(out[0], ints), T.StructField(out[1], ints), T.StructField(out[2], T.StringType())]
    schema = T.StructType([*docs.schema.fields, *new])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(blob.value)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for b in slices(batch, batch.column(at), SLICE_BYTES):
                texts = [x or b"" for x in b.column(at).cast(pa.binary()).to_pylist()]
                norms, backs = zip(*map(e.normalizer.normalise, texts))
                ids, n = e.encode(norms)
                edge = np.concatenate([[0], np.cumsum(n)])
                offsets = pa.array(edge.astype(np.int32))
                ends = [e.ends(ids[lo:hi], back) for lo, hi, back in zip(edge, edge[1:], backs)]
                plain = [decode(e.model, ids[lo:hi].tolist()) for lo, hi in zip(edge, edge[1:])]
                cols = [pa.ListArray.from_arrays(offsets, pa.array(ids)),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ends).astype(np.int32))),
                        pa.array(plain, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=names)

    return docs.mapInArrow(run, schema)


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    """The columns of the registered query, from ``encode``; n_bytes is the last piece's end in the source."""
    d = encode(docs.select("doc_id", "text"), model_path)
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"),
                    F.coalesce(F.get("ends", F.size("ends") - 1), F.lit(0)).cast("long").alias("n_bytes"))


def with_ids(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` plus its ids, the source byte end of each piece, the decoded text and the number of ids."""
    ids, n, ends, decoded = fresh(docs, "ids", "n_tokens", "ends", "decoded")
    return encode(docs, model_path, (ids, ends, decoded)).withColumn(n, F.size(ids).cast("long"))
