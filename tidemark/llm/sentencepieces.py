"""Operator 1, SentencePiece encoding and decoding by suffix-array matching of all pieces over batches of text."""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, table

SPACE = "▁"
#: Units (words with their leading space marks) whose ids a worker keeps.
KEPT_UNITS = 500_000
#: Signs from which on an atom's pairs wait on a heap; both ways join the same pairs.
LONG_ATOM = 100
#: Piece types of the model file.
UNKNOWN, BYTE, USABLE = 2, 6, (1, 4)


class PieceModel:
    """A byte-pair SentencePiece model (identity normalisation, dummy prefix, byte fallback)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rule = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or rule.name != "identity" or not rule.add_dummy_prefix or rule.remove_extra_whitespaces or not proto.trainer_spec.byte_fallback:
            raise ValueError("only byte-pair models with identity normalisation, dummy prefix and byte fallback")
        pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t not in USABLE and t != UNKNOWN else p.replace(SPACE, " ").encode() for p, _, t in pieces]
        self.byte_id = np.zeros(256, np.int64)
        for i, (p, _, t) in enumerate(pieces):
            if t == BYTE:
                self.byte_id[int(p[3:5], 16)] = i
        usable = [(i, p, s) for i, (p, s, t) in enumerate(pieces) if t in USABLE]
        signs = sorted({ord(c) for _, p, _ in usable for c in p})
        self.number = {c: k + 1 for k, c in enumerate(signs)}  # 0 ends a unit, len + 1 is any other sign
        self.longest = max(len(p) for _, p, _ in usable)
        self.score = np.full(len(pieces), -np.inf, np.float32)
        self.score[[i for i, _, _ in usable]] = [s for _, _, s in usable]
        self.id = np.array([i for i, _, _ in usable])
        self.length = np.array([len(p) for _, p, _ in usable])
        self.low = self._keys([[self.number[ord(c)] for c in p] for _, p, _ in usable], 0)
        self.high = self._keys([[self.number[ord(c)] for c in p] for _, p, _ in usable], 0xFFFF)
        joinable = {c for _, p, _ in usable if len(p) > 1 for c in p}
        self.single = re.compile("([^" + "".join(re.escape(c) for c in sorted(joinable)) + "])")
        self.table = np.full(0x110000, len(signs) + 1, np.uint16)
        self.table[signs] = np.arange(1, len(signs) + 1)

    def _keys(self, rows: list[list[int]], fill: int) -> np.ndarray:
        grid = np.full((len(rows), self.longest), fill, ">u2")
        for k, row in enumerate(rows):
            grid[k, : len(row)] = row
        return self._as_bytes(grid)

    def _as_bytes(self, grid: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(grid).view(f"S{2 * self.longest}").reshape(-1)

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All occurrences of all pieces in a numbered text: (position, length, piece id), by position.

        The suffix array of the text is searched for the range of suffixes that begin with each piece.
        """
        n, width = len(text), self.longest
        padded = np.r_[text, np.zeros(width + 4, np.uint16)]
        wide = padded.astype(np.uint64)
        four = (wide[:-3] << np.uint64(48)) | (wide[1:-2] << np.uint64(32)) | (wide[2:-1] << np.uint64(16)) | wide[3:]
        suffixes = np.lexsort([four[k : k + n] for k in reversed(range(0, width, 4))])
        grid = np.lib.stride_tricks.sliding_window_view(padded, width)[suffixes].astype(">u2")
        keys = self._as_bytes(grid)
        first, last = np.searchsorted(keys, self.low), np.searchsorted(keys, self.high, side="right")
        count = last - first
        before = np.cumsum(count) - count
        which = np.repeat(np.arange(len(count)), count)
        position = suffixes[np.repeat(first - before, count) + np.arange(count.sum())]
        by = np.argsort(position, kind="stable")
        return position[by], self.length[which][by], self.id[which][by]

    def joined(self, at: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the symbols of one atom, positions first..last - 1, after all joins: best score first, then leftmost.

        Pairs wait on a heap, and a join looks at its two neighbours alone, so n signs take O(n log n) steps.
        """
        n = last - first
        pair = at[first : last - 1, 2]
        here = np.flatnonzero(pair >= 0)
        heap = list(zip((-self.score[pair[here]]).tolist(), here.tolist(), (here + 1).tolist(), (here + 2).tolist(), strict=True))
        heapq.heapify(heap)
        end, before = array("q", range(1, n + 1)), array("q", range(-1, n))  # of the symbol that starts here; before[n] serves as a stop
        while heap:
            _, a, b, z = heapq.heappop(heap)
            if end[a] != b or end[b] != z:
                continue  # one of the two has been joined since
            end[a], end[b] = z, -1
            before[z] = a
            for left, right in ((before[a], a), (a, z)):
                if 0 <= left and right < n and end[right] - left <= self.longest:
                    piece = at[first + left, end[right] - left]
                    if piece >= 0:
                        heapq.heappush(heap, (-float(self.score[piece]), left, right, end[right]))
        ends = np.frombuffer(end, np.int64)
        start = np.flatnonzero(ends > 0)
        return start + first, ends[start] + first

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids (packed, 16 or 32 bits) of each unit; units are encoded independently of each other."""
        atoms, owner = [], []
        for k, u in enumerate(units):
            for a in self.single.split(u):
                if a:
                    atoms.append(a)
                    owner.append(k)
        raw = np.frombuffer("\0".join(atoms).encode("utf-32-le"), np.uint32)
        size = np.array([len(a) for a in atoms])
        base = np.cumsum(size + 1) - size - 1
        text = self.table[raw]
        text[(base + size)[:-1]] = 0
        position, length, piece = self.edges(text)
        at = np.full((len(text) + 1, self.longest + 1), -1, np.int32)
        at[position, length] = piece
        atom_of = np.repeat(np.arange(len(size)), size + 1)[: len(text)]
        start = np.flatnonzero(np.r_[text != 0])
        # symbols: start, end, atom; in every round each short atom joins its best pair, the first of equals; long ones take it off a heap
        end, atom = start + 1, atom_of[start]
        done = [self.joined(at, int(a), int(a + n)) for a, n in zip(base[size > LONG_ATOM], size[size > LONG_ATOM], strict=True)]
        short = size[atom] <= LONG_ATOM
        start, end, atom = start[short], end[short], atom[short]
        while len(start):
            span = end[1:] - start[:-1]
            ok = (atom[1:] == atom[:-1]) & (span <= self.longest)
            pair = np.where(ok, at[start[:-1], np.minimum(span, self.longest)], -1)
            score = np.where(pair >= 0, self.score[pair], -np.inf)
            head = np.flatnonzero(np.r_[True, atom[1:] != atom[:-1]])
            best = np.maximum.reduceat(np.r_[score, np.float32(-np.inf)], head)
            best_here = np.repeat(best, np.diff(np.r_[head, len(start)]))
            hit = np.flatnonzero((score == best_here[:-1]) & (pair >= 0))
            hit = hit[np.r_[True, atom[hit[1:]] != atom[hit[:-1]]]] if len(hit) else hit
            joins = np.zeros(len(start), bool)
            joins[hit] = True
            lively = np.zeros(len(size), bool)
            lively[atom[hit]] = True
            stay = lively[atom]
            done.append((start[~stay], end[~stay]))
            end[hit] = end[hit + 1]
            keep = stay & ~np.r_[False, joins[:-1]]
            start, end, atom = start[keep], end[keep], atom[keep]
        start, end = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (start, end)
        by = np.argsort(start, kind="stable")
        start, end = start[by], end[by]
        ids = at[start, end - start].astype(np.int64)
        own = np.array(owner)[atom_of[start]]
        lost = np.flatnonzero(ids < 0)
        if len(lost):  # signs that no piece has: their bytes
            spelled = [self.byte_id[list(chr(raw[p]).encode("utf-8", "surrogatepass"))] for p in start[lost].tolist()]
            repeat = np.ones(len(ids), np.int64)
            repeat[lost] = [len(x) for x in spelled]
            place = np.repeat(ids, repeat)
            place[place < 0] = np.concatenate(spelled)
            ids, own = place, np.repeat(own, repeat)
        upto = np.cumsum(np.bincount(own, minlength=len(units))).tolist()
        packed = ids.astype(np.uint16 if len(self.bytes_of) <= 1 << 16 else np.uint32)
        width, packed = packed.itemsize, packed.tobytes()
        return [packed[width * a : width * z] for a, z in zip([0, *upto], upto, strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        """The text that was encoded; the mark U+2581 itself comes back as a space."""
        spelled = self.bytes_of
        return b"".join([spelled[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


def units_of(text: str) -> list[str]:
    """A text's parts between which no piece reaches: each begins with the space marks before a word."""
    if not text:
        return []
    words = text.replace(SPACE, " ").split(" ")
    if "" not in words:
        return [SPACE + w for w in words]
    out, marks = [], SPACE
    for w in words[:-1]:
        if w:
            out.append(marks + w)
            marks = SPACE
        else:
            marks += SPACE
    return [*out, marks + words[-1]]


class Encoder(dict):
    """Unit -> packed ids, with the units of earlier texts kept."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.kind = np.uint16 if len(self.model.bytes_of) <= 1 << 16 else np.uint32

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [units_of(t) for t in texts]
        if len(self) > KEPT_UNITS:
            self.clear()
        new = list({u for p in parts for u in p if u not in self})
        if new:
            self.update(zip(new, self.model.encode_units(new), strict=True))
        return [np.frombuffer(b"".join([self[u] for u in p]), self.kind) for p in parts]


_encoders: dict[str, Encoder] = {}


def _encoded(path: str, packed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(path) or Encoder(path)
        _encoders[path] = encoder  # for the worker's next tasks
        for batch, texts in slices(batches):
            texts = [t.decode() for t in texts]
            ids = encoder.encode(texts)
            same = [encoder.model.decode(i) == t.replace(SPACE, " ") for i, t in zip(ids, texts, strict=True)]
            if packed:
                column = pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
            else:
                ends = np.cumsum([0, *map(len, ids)])
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32) if ids else [], pa.int32()))
            yield pa.record_batch([batch.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()), column, pa.array(same)], ["doc_id", "n_tokens", "ids", "round_trip"])

    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(path)
        for batch in batches:
            texts = [model.decode(np.array(i.as_py() or [], np.int64)) for i in batch.column("ids")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def encode(documents: DataFrame, model: str, packed: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip for every row of `documents`, by the model file's own merges.

    ids is an array of ints, or with packed=True their bytes as little-endian unsigned 32-bit integers.
    round_trip says that the ids decode to the text (with U+2581 as a space, which the format can't
    tell apart). A null or empty text has no ids. Ids may be null or repeat; each row is encoded on its
    own. An empty table gives no rows; columns other than doc_id and text are not read.

    Each task takes the different words of a batch together: their text gets a suffix array, in which
    every piece is looked up by binary search; the occurrences, sorted by position, are the edges of
    the words' lattices; and the edges are relaxed best score first, as the model's merges are.
    """
    kinds = f"doc_id long, n_tokens long, ids {'binary' if packed else 'array<int>'}, round_trip boolean"
    return documents.select("doc_id", "text").mapInArrow(_encoded(model, packed), kinds)


def decode(tokens: DataFrame, model: str) -> DataFrame:
    """doc_id, text from (doc_id, ids array); null or empty ids give an empty text."""
    return tokens.select("doc_id", "ids").mapInArrow(_decoded(model), "doc_id long, text string")


def op1_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), packed=True)
    return out.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), "round_trip")


SQL: dict[str, str] = {}
QUERIES = {"op1_sentencepieces": op1_sentencepieces}
