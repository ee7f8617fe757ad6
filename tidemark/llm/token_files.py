"""Operator 7, token-id output: frequency-ranked ids in byte-aligned variable-length coding, read back by table lookup."""

from __future__ import annotations

import json
import string
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ranges, shared_dir, slices, small_side, split_words, staged, table

#: Text of a block of documents, about; their different words are looked up together.
BLOCK_BYTES = 4_000_000
#: Words whose ids a worker keeps.
KEPT_WORDS = 1_000_000
END_ID = 1
TAIL = string.punctuation.encode()
#: Steps of a tokenizer file by which words can be encoded one by one: white space separates, and no match goes across it.
BY_WORD_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
BY_WORD_STEPS = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

#: Bytes of each of the four values that a control byte describes, two bits each, low bits first.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.int64)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values: 1 to 4 bytes each, little-endian."""
    v = values.astype(np.uint32)
    size = 1 + (v > 0xFF).astype(np.int64) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    code[: len(v)] = size - 1
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    at = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    for k in range(4):
        more = size > k
        if more.any():
            data[at[more] + k] = (v[more] >> np.uint32(8 * k)) & np.uint32(0xFF)
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, count: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    at, b = np.cumsum(size) - size, np.frombuffer(data, np.uint8)
    out = b[at].astype(np.uint32) if count else np.zeros(0, np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        out[more] |= b[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class WordIds:
    """Ids of texts, by the tokenizers library, asked about a word once and kept.

    Text is encoded word by word only if the file's tokenizer drops white space before it splits and
    nothing in it looks across words; word_bpe_49k.json is such a file. Words of Latin letters with
    final punctuation are kept as the letters in lower case and the punctuation, and the library's BPE
    model is asked about these directly, as its splitter would cut them there.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        config = json.loads(Path(path).read_text())
        steps = (config["pre_tokenizer"] or {}).get("pretokenizers", [])
        normal = (config["normalizer"] or {}).get("normalizers", [])
        self.by_word = steps == BY_WORD_STEPS and normal == BY_WORD_NORMAL
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.kind = np.dtype(self.code)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))
        #: the character that the byte-level step shows each byte as
        self.shown = "".join(chr(b if b in shown else next(hidden)) for b in range(256))
        self.cores, self.tails, self.others = {}, {b"": b""}, {}

    def _keep(self, held: dict, key: bytes, tokens: list) -> bytes:
        if len(held) >= KEPT_WORDS:
            held.clear()
        held[key] = packed = array(self.code, [t.id for t in tokens]).tobytes()
        return packed

    def word(self, word: bytes) -> bytes:
        """Packed ids of a word."""
        core = word.rstrip(TAIL)
        tail, low = word[len(core) :], core.lower()
        ids = self.cores.get(low)
        if ids is None:
            text = core.decode()
            if not text.isalpha() or max(text := text.lower()) >= "ɐ":
                if (ids := self.others.get(word)) is None:
                    if len(self.others) >= KEPT_WORDS:
                        self.others.clear()
                    ids = array(self.code, self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
                    self.others[word] = ids
                return ids
            ids = self._keep(self.cores, low, self.model.tokenize(charmap_decode(text.encode(), "strict", self.shown)[0]))
        if not tail:
            return ids
        after = self.tails.get(tail)
        return ids + (after if after is not None else self._keep(self.tails, tail, self.model.tokenize(tail.decode())))

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the number of ids of each."""
        if not self.by_word:
            ids = [self.tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in texts]
            return np.array([i for x in ids for i in x], self.kind), np.array([len(x) for x in ids], np.int64)
        number, different, count = split_words(texts)
        packed = list(map(self.word, different))
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // self.kind.itemsize
        first, n = (np.cumsum(size) - size)[number], size[number]
        upto = np.r_[0, np.cumsum(n)]
        return np.frombuffer(b"".join(packed), self.kind)[ranges(first, n)], np.diff(upto[np.r_[0, np.cumsum(count)]])


_words: dict[str, WordIds] = {}


def _tokenized(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words.get(path) or WordIds(path)
        _words[path] = words  # for the worker's next tasks
        part, block = TaskContext.get().partitionId(), 0
        for batch, texts in slices(batches, size=BLOCK_BYTES):
            flat, n = words.of(texts)
            flat = np.insert(flat, np.cumsum(n), end_id)
            count = (n + 1).astype(np.int32)
            yield pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([count.tobytes()], pa.binary()), pa.array([flat.tobytes()], pa.binary()), pa.array([len(flat)], pa.int64())],
                ["part", "block", "doc_ids", "counts", "ids", "n_ids"],
            )
            block += 1

    return run


def _kind(row_bytes: int, count: int):
    return np.uint16 if count and row_bytes == 2 * count else np.uint32


def _counted(vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for b, n in zip(batch.column("ids"), batch.column("n_ids").to_pylist(), strict=True):
                raw = b.as_py()
                total += np.bincount(np.frombuffer(raw, _kind(len(raw), n)), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return run


def _written(rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = []
            for b, n in zip(batch.column("ids"), batch.column("n_ids").to_pylist(), strict=True):
                raw = b.as_py()
                coded.append(encode_values(rank[np.frombuffer(raw, _kind(len(raw), n))]))
            control, data = zip(*coded, strict=True) if coded else ((), ())
            yield pa.record_batch(
                [batch.column(c) for c in ("part", "block", "doc_ids", "counts", "n_ids")] + [pa.array(control, pa.binary()), pa.array(data, pa.binary())],
                ["part", "block", "doc_ids", "counts", "n_ids", "control", "data"],
            )

    return run


def _read(id_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = id_of[decode_values(r["control"], r["data"], r["n_ids"])].astype("<u4")
                count = np.frombuffer(r["counts"], np.int32).astype(np.int64)
                upto, raw = np.cumsum(count), memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * (z - n) : 4 * z]) for n, z in zip(count.tolist(), upto.tolist(), strict=True)]
                k = len(count)
                yield pa.record_batch(
                    [pa.array([r["part"]] * k, pa.int32()), pa.array([r["block"]] * k, pa.int32()), pa.array(r["doc_ids"], pa.int64()), pa.array(upto - count), pa.array(count), pa.array(crc, pa.int64())],
                    ["part", "block", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    return run


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encodes every whole text of `documents` and writes a token file set to the folder `path`.

    The set has two Parquet tables. `ranks` (id, n, rank): every id used, its count over all documents
    and its rank, most frequent first, ties by id. `blocks` (part, block, doc_ids, counts, n_ids, control,
    data): documents in ascending doc_id order by (part, block), null ids first; counts holds each
    document's number of ids as 32-bit integers; the ids' ranks are coded in 1 to 4 data bytes, and
    every control byte has the lengths of four. A null or empty text has the end id alone. Repeated rows
    are written each. An empty table gives empty tables. Columns other than doc_id and text are not read.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    kinds = "part int, block int, doc_ids array<long>, counts binary, ids binary, n_ids long"
    raw = staged(rows.mapInArrow(_tokenized(tokenizer, end_id), kinds))
    from tokenizers import Tokenizer

    vocabulary = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    counts = raw.select("ids", "n_ids").mapInArrow(_counted(vocabulary), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranks = counts.withColumn("rank", (F.row_number().over(Window.orderBy(F.col("n").desc(), "id")) - 1).cast("long"))
    ranks.write.parquet(f"{path}/ranks")
    used = spark.read.parquet(f"{path}/ranks").select("id", "rank").toPandas()  # at most one row for each id of the vocabulary
    rank = np.zeros(vocabulary, np.uint32)
    rank[used["id"].to_numpy(np.int64)] = used["rank"].to_numpy(np.uint32)
    kinds = "part int, block int, doc_ids array<long>, counts binary, n_ids long, control binary, data binary"
    raw.mapInArrow(_written(rank), kinds).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 from a token file set."""
    used = spark.read.parquet(f"{path}/ranks").select("id", "rank").toPandas()
    id_of = np.zeros(max(len(used), 1), np.uint32)
    id_of[used["rank"].to_numpy(np.int64)] = used["id"].to_numpy(np.uint32)
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = staged(blocks.select("part", "block", "n_ids"))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("held"))  # one row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(sizes.withColumn("inner", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select("part", "block", (F.col("base") + F.col("inner")).alias("base")))
    docs = blocks.mapInArrow(_read(id_of), "part int, block int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    docs = docs.join(small_side(starts, 48), ["part", "block"])
    return docs.select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_dir(spark)
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, path)


SQL: dict[str, str] = {}
QUERIES = {"op7_token_files": op7_token_files}
