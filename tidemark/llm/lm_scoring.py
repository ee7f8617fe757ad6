"""Operator 8, LM scoring: a hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import joined, slices, split_words, staged, table
from tidemark.llm.exchange import CHUNK_BYTES, beside_chunks, bucket_count, bucketed, exchange, fold, grouped, packed, told_of, unpacked

#: Word classes (0: the end of a text), classes before a token that are its context, and rows of the weight matrix that class features are hashed to.
CLASSES, BEFORE, ROWS = 32, 2, 4096
#: Gradient updates, their step (Adam), the weights' prior in counts, and the parts the counts are dealt to.
UPDATES, STEP, PRIOR, PARTS = 24, 0.1, 2.0, 16
#: Updates of the strengths of word features, which each at most double or halve STRIDE times.
STRENGTH_UPDATES, STRIDE = 20, 3
#: Places of the space that word features are hashed to, for each training token: one feature in SPARSE shares its place.
SPARSE = 8
#: Hashes of what stands before a text, and of its end.
START, END = (np.uint64(xxhash.xxh3_64_intdigest(v)) for v in (b" start", b" end"))


def word_class(word: bytes) -> int:
    """Class of a word, 1 to CLASSES - 1 (0 is the end): a hash of the whole word if it is short or of its last letters."""
    core = word.rstrip(b".,!?;:")
    sign = (core if len(core) <= 3 else b"+" + core[-2:]) + (b"." if len(core) < len(word) else b"")
    return 1 + xxhash.xxh32_intdigest(sign) % (CLASSES - 1)


def is_held_out(doc_id: int | None) -> bool:
    """Every document whose crc32 of the id's text ends in the digit 0 (a null id counts as the text null)."""
    return zlib.crc32(b"null" if doc_id is None else str(doc_id).encode()) % 10 == 0


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different words of about CHUNK_BYTES of text, the end last, as hashes and classes, and the texts' tokens as numbers in them."""
    task, number, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0

    def chunk() -> pa.RecordBatch:
        tokens, words, n = split_words(texts, lower=True)
        tokens = np.insert(tokens, np.cumsum(n), len(words))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        columns = (packed(np.r_[hashes, END]), bytes([*map(word_class, words), 0]), (n + 1).astype(np.int32).tobytes(), packed(tokens.astype(np.uint32)))
        return pa.record_batch([pa.array([task << 24 | number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), *(pa.array([c], pa.binary()) for c in columns)], ["chunk", "doc_ids", "hashes", "classes", "lengths", "tokens"])

    for batch, some in slices(batches):
        ids += batch.column("doc_id").to_pylist()
        texts += some
        held += sum(map(len, some))
        if held >= CHUNK_BYTES:
            yield chunk()
            ids, texts, held, number = [], [], 0, number + 1
    if ids:
        yield chunk()


class _Chunk:
    """The tokens of a chunk and what comes before each."""

    def __init__(self, row: dict):
        self.hashes, self.classes = unpacked(row["hashes"], np.uint64), np.frombuffer(row["classes"], np.uint8)
        self.tokens, self.n = unpacked(row["tokens"], np.uint32), np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.out = np.array([is_held_out(i) for i in row["doc_ids"]], bool)
        self.owner = np.repeat(np.arange(len(self.n)), self.n)
        self.train = ~self.out[self.owner]
        self.c = self.classes[self.tokens].astype(np.int64)

    def before(self, values: np.ndarray, back: int, start: int) -> np.ndarray:
        """values of the token `back` places before each in its text, `start` where there is none."""
        out = np.full(len(values), start, values.dtype)
        same = self.owner[back:] == self.owner[:-back]
        out[back:][same] = values[:-back][same]
        return out

    def words(self) -> tuple[np.ndarray, ...]:
        """The different words' hashes, with their training counts and classes."""
        order = np.argsort(self.hashes)
        count = np.bincount(self.tokens[self.train], minlength=len(self.hashes))
        return self.hashes[order], count[order], self.classes[order]

    def word_counts(self, told: list) -> np.ndarray:
        """Training count, over all chunks, of each of the chunk's words."""
        out = np.empty(len(self.hashes), np.int64)
        out[np.argsort(self.hashes)] = told_of(told, np.int64)
        return out

    def context(self) -> np.ndarray:
        """The classes before each token, as a number."""
        return sum(self.before(self.c, back, 0) * CLASSES ** (back - 1) for back in range(1, BEFORE + 1))

    def features(self, mask: np.uint64) -> tuple[np.ndarray, ...]:
        """The different word features, hashed: of each token the word before it, with the token's word and with its class,
        and the word before that (a skip), with the token's class and alone. With their counts in training tokens."""
        h, c = self.hashes[self.tokens], self.c.astype(np.uint64)
        word, skip = self.before(h, 1, START), self.before(h, 2, START)
        keys, counts, self.number, held = [], [], [], 0
        for k, (left, right) in enumerate(((word, h), (word, c), (skip, c), (skip, np.array([CLASSES], np.uint64)))):
            key = ((joined(left, right) >> np.uint64(2)) | np.uint64(k << 62)) & mask  # the kind first, so that each is sorted on its own
            order, start, number = grouped(key)
            keys.append(key[order[start]])
            counts.append(np.bincount(number[self.train], minlength=len(start)))
            self.number.append((number + held).astype(np.int32))
            held += len(start)
        return np.concatenate(keys), np.concatenate(counts)

    def feature_counts(self, told: list, mask: np.uint64) -> list[np.ndarray]:
        """Counts over all chunks of each token's four features."""
        self.features(mask)
        told = told_of(told, np.int64)
        return [told[n] for n in self.number]


def _sum(keys: np.ndarray, start: np.ndarray, count: np.ndarray, *_: np.ndarray) -> np.ndarray:
    return fold(np.add, count, start)


def _by_class(total: np.ndarray, start: np.ndarray, count: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Different training words of each class, then training tokens."""
    c = classes[start]
    return np.r_[np.bincount(c[total > 0], minlength=CLASSES), np.bincount(c, total, CLASSES).astype(np.int64)]


def _class_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2 * CLASSES, np.int64)
    for batch in batches:
        for told in batch.column("told").to_pylist():
            total += told_of(told, np.int64)
    yield pa.record_batch([pa.array(np.arange(2 * CLASSES)), pa.array(total)], ["at", "n"])


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES ** (BEFORE + 1), np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            chunk = _Chunk(batch.slice(i, 1).to_pylist()[0])
            total += np.bincount((chunk.context() * CLASSES + chunk.c)[chunk.train], minlength=CLASSES ** (BEFORE + 1))
    seen = np.flatnonzero(total)
    yield pa.record_batch([pa.array((seen // CLASSES).astype(np.int32)), pa.array((seen % CLASSES).astype(np.int32)), pa.array(total[seen])], ["context", "class", "n"])


def feature_rows(context: np.ndarray) -> np.ndarray:
    """Rows of the weight matrix for contexts: hashed n-gram features (the class before, the two before) and the skip feature (the one before that)."""
    features = [(1, context % CLASSES), (2, context), (3, context // CLASSES)]
    hashed = [((f.astype(np.uint64) * np.uint64(8) + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52) for k, f in features]
    return np.stack(hashed, 1).astype(np.int64) % ROWS


def log_softmax(weights: np.ndarray, bias: np.ndarray, context: np.ndarray) -> np.ndarray:
    z = weights[feature_rows(context)].sum(1) + bias
    z -= z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def _gradient(weights: np.ndarray, bias: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((CLASSES**BEFORE, CLASSES))
        for batch in batches:
            np.add.at(count, (batch.column("context").to_numpy(), batch.column("class").to_numpy()), batch.column("n").to_numpy())
        context = np.flatnonzero(count.any(1))
        if not len(context):
            return
        count = count[context]
        logs = log_softmax(weights, bias, context)
        wrong = count - count.sum(1, keepdims=True) * np.exp(logs)
        gradient = np.zeros((ROWS, CLASSES))
        for rows in feature_rows(context).T:
            np.add.at(gradient, rows, wrong)
        yield pa.record_batch([pa.array([float((count * logs).sum())]), pa.array([gradient.tobytes()], pa.binary())], ["fit", "gradient"])

    return run


def train(counts: DataFrame, updates: int = UPDATES) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Weights, bias and the fit (mean log-likelihood) before each update, from (context, class, n).

    The counts are dealt to PARTS parts; in each update every part gives the gradient of its own counts
    and the driver adds those up: PARTS matrices of ROWS x CLASSES, whatever the input's size.
    """
    counts = staged(counts.repartition(PARTS, "context"))
    by_class = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    total = sum(by_class.values())
    bias = np.log(np.array([(by_class.get(k, 0) + 0.5) / (total + 0.5 * CLASSES) for k in range(CLASSES)]))
    weights, mean, square, fits = np.zeros((ROWS, CLASSES)), 0.0, 0.0, []
    for k in range(1, updates + 1 if total else 1):
        parts = counts.mapInArrow(_gradient(weights, bias), "fit double, gradient binary").collect()
        g = sum(np.frombuffer(p["gradient"]).reshape(ROWS, CLASSES) for p in parts) / total - PRIOR / total * weights
        fits.append(sum(p["fit"] for p in parts) / total)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        weights = weights + STEP * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-9)
    return weights, bias, fits


class Strengths:
    """Strengths of the word features: of the word before and of the skip on the class, and of the word before on the word.

    P(class) = (m + s0 * n(before, class) + s1 * n(skip, class)) / (1 + s0 * n(before) + s1 * n(skip)), m being the class
    softmax; P(word in its class) = (q + s2 * n(before, word)) / (1 + s2 * n(before, class)), q being the word's smoothed
    share of its class. Both are softmaxes whose feature weights are the logarithms of the numerators' ratios to m and q,
    so features that training never saw weigh nothing, and sum to one.
    """

    @staticmethod
    def classes(s: np.ndarray, m: np.ndarray, n: np.ndarray, before: np.ndarray, skip: np.ndarray, skips: np.ndarray) -> np.ndarray:
        return (m + s[0] * n + s[1] * skip) / (1 + s[0] * before + s[1] * skips)

    @staticmethod
    def words(s: np.ndarray, q: np.ndarray, n: np.ndarray, of_class: np.ndarray) -> np.ndarray:
        return (q + s[2] * n) / (1 + s[2] * of_class)


def _level(n: np.ndarray) -> np.ndarray:
    """Level of a count: itself below 4, then by powers of two."""
    return np.where(n < 4, n, 2 + np.floor(np.log2(np.maximum(n, 1))).astype(np.int64))


def _count_of(level: np.ndarray) -> np.ndarray:
    return np.where(level < 4, level, 1.44 * np.exp2(level - 2.0))


def _parts(p: np.ndarray) -> np.ndarray:
    """Level of a probability: quarters of a power of two."""
    return np.clip(np.floor(-4 * np.log2(np.maximum(p, 1e-19))), 0, 255).astype(np.int64)


def _informed(row: dict, mask: np.uint64, log_class: np.ndarray, class_words: np.ndarray, class_tokens: np.ndarray):
    """The chunk, its words' counts, and for each token m, the count of the word before, q, and its features' counts."""
    chunk = _Chunk(row)
    known = chunk.word_counts(row["counts"])
    inside = np.where(chunk.classes == 0, 1.0, (known + 0.1) / (class_tokens[chunk.classes] + 0.1 * (class_words[chunk.classes] + 1)))
    counts = chunk.feature_counts(row["features"], mask)
    before = chunk.before(known[chunk.tokens], 1, int(known[-1]))  # as many starts as ends
    return chunk, known, np.exp2(log_class[chunk.context(), chunk.c].astype(np.float64)), before, inside[chunk.tokens], counts


def _cells(*model):
    """Counts of training tokens by the levels of what their probability is made of, each token's own count left out."""

    def cells(row: dict) -> pa.RecordBatch:
        chunk, _, m, before, q, counts = _informed(row, *model)
        n, of_class, skip, skips, before = (_level(np.maximum(c[chunk.train] - 1, 0)) for c in (*counts, before))
        inner = chunk.c[chunk.train] > 0
        of_classes = (_parts(m[chunk.train]) << 24) | (of_class << 18) | (before << 12) | (skip << 6) | skips
        of_words = ((1 << 40) | (_parts(q[chunk.train]) << 12) | (n << 6) | of_class)[inner]
        found = [np.unique(v, return_counts=True) for v in (of_classes, of_words)]
        return pa.record_batch([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], ["cell", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield cells(batch.slice(i, 1).to_pylist()[0])

    return run


def _fit(s: np.ndarray):
    """Of each strength, how much of the probability its features make up, and how much of the normaliser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = np.zeros(3), np.zeros(3)
        for batch in batches:
            cell, n = batch.column("cell").to_numpy(), batch.column("n").to_numpy()
            level = lambda shift: _count_of((cell >> shift) & 63)  # noqa: E731, B023
            words = cell >> 40 == 1
            share = np.exp2(-((cell >> np.where(words, 12, 24) & 255) + 0.5) / 4)
            features = ((0, ~words, level(18), level(12)), (1, ~words, level(6), level(0)), (2, words, level(6), level(0)))
            top, below = share.copy(), np.ones(len(n))
            for k, use, x, y in features:
                top += use * s[k] * x
                below += use * s[k] * y
            for k, use, x, y in features:
                up[k] += (n * s[k] * x / top)[use].sum()
                down[k] += (n * s[k] * y / below)[use].sum()
        yield pa.record_batch([pa.array(np.arange(3)), pa.array(up), pa.array(down)], ["k", "up", "down"])

    return run


def strengths(cells: DataFrame, updates: int = STRENGTH_UPDATES) -> np.ndarray:
    """Strengths fitted to counted cells (cell, n): the gradient of the log-likelihood by a strength's logarithm is up - down,
    and each update adds log(up / down), which has the gradient's sign. The cells are bounded in number, whatever the input."""
    cells = staged(cells.repartition(PARTS, "cell"))
    s = np.full(3, 0.01)
    for _ in range(updates):
        sums = cells.mapInArrow(_fit(s), "k long, up double, down double").groupBy("k").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        for r in sums.collect():
            if r["down"] > 0:
                s[r["k"]] *= np.clip(r["up"] / r["down"], 0.5**STRIDE, 2.0**STRIDE)
    return np.maximum(s, 1e-12)


def _scored(s: np.ndarray, *model):
    mask, log_class, class_words, class_tokens = model
    words, tokens = int(class_words.sum()), int(class_tokens.sum())

    def scores(row: dict) -> pa.RecordBatch:
        chunk, known, m, before, q, (n, of_class, skip, skips) = _informed(row, *model)
        base = np.log10((known + 0.1) / (tokens + 0.1 * (words + 1)))[chunk.tokens]
        score = np.log10(Strengths.classes(s, m, of_class, before, skip, skips))
        score += np.log10(np.where(chunk.c == 0, 1.0, Strengths.words(s, q, n, of_class)))
        k = len(chunk.n)
        add = lambda v: np.bincount(chunk.owner, v, minlength=k)
        return pa.record_batch(
            [pa.array(row["doc_ids"], pa.int64()), pa.array(chunk.out), pa.array(chunk.n), pa.array(add(known[chunk.tokens] > 0).astype(np.int64)), pa.array(np.full(k, tokens)), pa.array(add(base)), pa.array(add(score))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield scores(batch.slice(i, 1).to_pylist()[0])

    return run


def feature_mask(tokens: int) -> np.uint64:
    """High bits of a 64-bit hash that tell word features apart: SPARSE places or more for each training token."""
    bits = min(64, 2 + max(tokens * SPARSE, 1).bit_length())  # two for the kind
    return np.uint64(((1 << bits) - 1) << (64 - bits))


def lm_score(documents: DataFrame, updates: int = UPDATES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of `documents`.

    Tokens are the words, A-Z lower-cased, and one end, which is all that a null or empty text has. The
    model learns from the documents that are not held out: score is the log10 probability of the text as
    P(class of a token | what is before) * P(token | its class, what is before). The class softmax is a
    maximum-entropy model over hashed n-gram and skip features of the two classes before, trained by
    gradients that Spark adds up. Word features go into both factors (Strengths): the word before with the
    class and with the word, and, skipping one, the word before that with the class. Their counts are gathered from all training tokens, hashed to a space that grows with these, and their three
    strengths are trained on counts that leave each token itself out. Repeated rows are learnt from and
    scored each. Without training documents classes are equally likely. An empty table gives no rows;
    columns other than doc_id and text are not read.

    Documents are packed in chunks that hold their words as numbers; a chunk asks for the counts of each
    of its different words and features once. Words are told apart by 64-bit hashes.
    """
    kinds = "chunk long, doc_ids array<long>, hashes binary, classes binary, lengths binary, tokens binary"
    rows = documents.select("doc_id", "text")
    chunks = bucketed(rows.mapInArrow(_chunks, kinds), max(1, rows.rdd.getNumPartitions()))
    parts = bucket_count(chunks)
    told = exchange(chunks, parts, lambda row: _Chunk(row).words(), _sum, (np.int64, np.uint8), summary=_by_class)
    totals = np.zeros(2 * CLASSES)
    for r in told.filter("chunk < 0").mapInArrow(_class_totals, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        totals[r["at"]] = r["n"]
    class_words, class_tokens = totals[:CLASSES], totals[CLASSES:]
    counts = chunks.mapInArrow(_class_counts, "context int, class int, n long")
    weights, bias, _ = train(counts.groupBy("context", "class").agg(F.sum("n").alias("n")), updates)
    log_class = (log_softmax(weights, bias, np.arange(CLASSES**BEFORE)) / np.log(2)).astype(np.float32)
    mask = feature_mask(int(class_tokens.sum()))
    features = exchange(chunks, 4 * parts, lambda row: _Chunk(row).features(mask), _sum, (np.int64,))
    informed = beside_chunks(chunks, None, counts=told, features=features)
    model = mask, log_class, class_words, class_tokens
    s = strengths(informed.mapInArrow(_cells(*model), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")))
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return informed.mapInArrow(_scored(s, *model), kinds)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"))


SQL: dict[str, str] = {}
QUERIES = {"op8_lm_score": op8_lm_score}
