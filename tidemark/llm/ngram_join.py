"""Operator 3, n-gram Jaccard join: grouped prefix join over word shingles."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_BYTES, WordHashes, beside, ranges, slices, split_words, staged, table, windows
from tidemark.llm.components import components
from tidemark.llm.token_files import decode_values, encode_values

#: Bytes of text of a chunk, whose shingles are counted and asked about together, and chunks to a counting bucket.
CHUNK_BYTES, CHUNKS_PER_BUCKET = 8_000_000, 4
#: High bits of a shingle's hash that it is counted by, and values of a chunk that are merged with other chunks' at a time.
COUNTED_BITS, STRETCH = 40, 1 << 16
#: Documents that are compared in one block; larger lists are compared block by block.
BLOCK = 2048
#: Columns of the dense matrix that a block's prefixes are multiplied in, and rows that are compared at a time.
COLUMNS, TILE = 4096, 512
#: Cells that are multiplied in the time of one look-up.
LOOK_UP = 30


def _sets(texts: list[bytes], size: int, hashes: WordHashes) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text; of fewer words than `size`, one for the whole sequence."""
    out, first, held = [], 0, 0
    for last, t in enumerate(texts, 1):
        held += len(t)
        if held < SLICE_BYTES and last < len(texts):
            continue
        number, different, count = split_words(texts[first:last], lower=True)
        h = hashes.of(different)[number]
        all_, at = windows(h, size), 0
        for n in count.tolist():
            out.append(np.unique(all_[at : at + n - size + 1]) if n >= size else windows(h[at : at + n], n) if n else h[:0])
            at += n
        first, held = last, 0
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows with lists of megabytes, one at a time, as a batch of them twice over is more than a worker should hold."""
    return (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, number, ids, uids, texts, held = TaskContext.get().partitionId(), 0, [], [], [], 0

    def packed() -> pa.RecordBatch:
        lists = (pa.array([v], pa.list_(t)) for v, t in ((ids, pa.int64()), (uids, pa.int64()), (texts, pa.binary())))
        return pa.record_batch([pa.array([task << 24 | number], pa.int64()), *lists], ["chunk", "doc_ids", "uids", "texts"])

    for batch, some in slices(batches):
        for i, u, t in zip(batch.column("doc_id").to_pylist(), batch.column("uid").to_pylist(), some, strict=True):
            ids.append(i)
            uids.append(u)
            texts.append(t)
            held += len(t)
            if held >= CHUNK_BYTES:
                yield packed()
                ids, uids, texts, held, number = [], [], [], 0, number + 1
    if ids:
        yield packed()


def _counted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different counted hashes of a chunk, ascending, and the number of its documents that have each."""
    return np.unique(np.concatenate(sets) >> np.uint64(64 - COUNTED_BITS), return_counts=True)


def _asked(size: int, buckets: int):
    """(chunk, bucket, counted hashes as coded differences, documents that have them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for row in _rows(batches):
            value, count = _counted(_sets(row["texts"], size, hashes))
            ends = np.searchsorted(value, np.arange(buckets + 1, dtype=np.uint64) * np.uint64((1 << COUNTED_BITS) // buckets + 1))
            for k in np.flatnonzero(np.diff(ends)):
                part = slice(ends[k], ends[k + 1])
                step = np.diff(value[part], prepend=np.uint64(0))
                control, data = encode_values(step & np.uint64(0xFFFFFFFF))
                high, many = (zlib.compress(v, 1) for v in ((step >> np.uint64(32)).astype(np.uint8).tobytes(), b"".join(encode_values(count[part]))))
                yield pa.record_batch([pa.array([v]) for v in (row["chunk"], int(k), control, data, high, many)], ["chunk", "bucket", "control", "data", "high", "many"])

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: (chunk, bucket, level of each counted hash): the logarithm of its documents over all chunks."""

    def levels(bucket: int, rows: list) -> pa.RecordBatch:
        value, count = [], []
        for r in rows:
            many = zlib.decompress(r["many"])
            high = np.frombuffer(zlib.decompress(r["high"]), np.uint8).astype(np.uint64)
            value.append(np.cumsum(decode_values(r["control"], r["data"], len(high)).astype(np.uint64) | (high << np.uint64(32))))
            control = -(-len(high) // 4)
            count.append(decode_values(many[:control], many[control:], len(high)))
        cuts = max(value, key=len)[STRETCH::STRETCH]
        ends = [np.r_[0, np.searchsorted(v, cuts), len(v)] for v in value]
        level = [np.empty(len(v), np.uint8) for v in value]
        for k in range(len(cuts) + 1):
            part = [slice(e[k], e[k + 1]) for e in ends]
            every, number = np.unique(np.concatenate([v[p] for v, p in zip(value, part, strict=True)]), return_inverse=True)
            total = np.bincount(number, np.concatenate([c[p] for c, p in zip(count, part, strict=True)]), len(every))
            both = np.split(np.floor(np.log2(total)).astype(np.uint8)[number], np.cumsum([p.stop - p.start for p in part])[:-1])
            for out, p, v in zip(level, part, both, strict=True):
                out[p] = v
        out = [zlib.compress(v.tobytes(), 1) for v in level]
        return pa.record_batch([pa.array([r["chunk"] for r in rows], pa.int64()), pa.array([bucket] * len(rows), pa.int64()), pa.array(out, pa.binary())], ["chunk", "bucket", "levels"])

    bucket, rows = None, []
    for r in _rows(batches):
        if r["bucket"] != bucket:
            if rows:
                yield levels(bucket, rows)
            bucket, rows = r["bucket"], []
        rows.append(r)
    if rows:
        yield levels(bucket, rows)


def _prefixes(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, shift = WordHashes(), np.uint64(64 - COUNTED_BITS)
        for row in _rows(batches):
            sets = _sets(row["texts"], size, hashes)
            value, _ = _counted(sets)
            parts = sorted((x["bucket"], x["levels"]) for x in row["answers"] or [])
            levels = np.frombuffer(b"".join(zlib.decompress(x) for _, x in parts), np.uint8)
            prefix, group, whole = [], [], []
            for s in sets:
                n = len(s)
                level = levels[np.searchsorted(value, s >> shift)]
                p = s[np.lexsort((s, level))][: n - (percent * n + 99) // 100 + 1] if n else s
                prefix.append(p.view(np.int64))
                group.append(xxhash.xxh3_128_digest(p.tobytes() + n.to_bytes(8, "little")))
                whole.append(xxhash.xxh3_128_digest(s.tobytes()))
            ends = np.cumsum([0, *map(len, prefix)])
            yield pa.record_batch(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["uids"], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(whole, pa.binary()),
                    pa.array(group, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefix))),
                ],
                ["doc_id", "uid", "n_shingles", "whole", "grp", "prefix"],
            )

    return run


def prefixed(text: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, uid, n_shingles, whole, grp, prefix of (doc_id, uid, text); staged.

    A prefix has a set's first shingles in the order of how many documents have them, rare ones first,
    then of their hash. The frequencies come from all documents: each chunk asks for its different
    shingles, coded in about three bytes each, and is told their levels; a level is a function of the
    shingle alone, so the order is one for all documents.
    """
    chunks = staged(text.mapInArrow(_chunks, "chunk long, doc_ids array<long>, uids array<long>, texts array<binary>"))
    buckets = max(1, chunks.count() // CHUNKS_PER_BUCKET)
    asked = chunks.mapInArrow(_asked(size, buckets), "chunk long, bucket long, control binary, data binary, high binary, many binary")
    levels = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_answered, "chunk long, bucket long, levels binary")
    answers = staged(levels.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "levels")).alias("answers")))
    joined = chunks.join(answers.hint("merge"), "chunk", "left")
    return staged(joined.mapInArrow(_prefixes(size, percent), "doc_id long, uid long, n_shingles long, whole binary, grp binary, prefix array<long>"))


def incidence(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(set, number) of each element that two sets or more have, in the order of the elements' numbers."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    use = count[number] > 1
    owner, number = owner[use], (np.cumsum(count > 1) - 1)[number[use]]
    by = np.argsort(number, kind="stable")
    return owner[by], number[by]


def shared(owner: np.ndarray, number: np.ndarray, n: int, rows: slice) -> np.ndarray:
    """How many elements the sets of `rows` share with each of the n sets: products of stretches of the incidence matrix."""
    out = np.zeros((rows.stop - rows.start, n), np.float32)
    for a in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        lo, hi = np.searchsorted(number, [a, a + COLUMNS])
        m = np.zeros((n, min(COLUMNS, int(number[-1]) + 1 - a)), np.float32)
        m[owner[lo:hi], number[lo:hi] - a] = 1
        out += m[rows] @ m.T
    return out


def tiles(n: int) -> Iterator[slice]:
    return (slice(a, min(n, a + TILE)) for a in range(0, n, TILE))


def group_pairs(sizes: np.ndarray, prefixes: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of groups (set size, prefix) may hold documents that link.

    Sizes must be near enough for `percent`. Of two sets' common shingles, those in the prefix that ends
    first in the order are in both prefixes, the others lie behind it; so the common shingles of the
    prefixes and the longer rest together must reach the intersection that a link needs.
    """
    n, rest = len(sizes), sizes - np.array([len(p) for p in prefixes])
    owner, number = incidence(prefixes)
    out = np.zeros((n, n), bool)
    for t in tiles(n):
        both = sizes[t, None] + sizes[None, :]
        need = -(-percent * both // (100 + percent))
        common = shared(owner, number, n, t).astype(np.int64)
        near = 100 * np.minimum(sizes[t, None], sizes[None, :]) >= percent * np.maximum(sizes[t, None], sizes[None, :])
        out[t] = near & (common > 0) & (common + np.maximum(rest[t, None], rest[None, :]) >= need)
    return out


def labelled(link: np.ndarray) -> np.ndarray:
    """Label of each item: the first of those that it is connected to in a symmetric matrix of links."""
    label = np.arange(len(link))
    while True:
        low = label.copy()
        for t in tiles(len(link)):
            low[t] = np.minimum(label[t], np.where(link[t], label[None, :], len(link)).min(1))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def links_of(sets: list[np.ndarray], percent: int, group: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Label of each set: the first of those it is connected to by links within the block.

    Only members of one group, or of two groups (`group` has each set's number) that `pairs` says may link, are
    compared, and of these no two that are connected already. A set marks its elements and counts the marked
    ones of those it is compared with. Once a tile of sets has looked up so many that multiplying the rest of it would have
    taken as long, that rest is multiplied: either way has the same labels, and takes twice the cheaper one's time at most.
    """
    sizes, label = np.array([len(s) for s in sets], np.int64), np.arange(len(sets))
    ends, number = np.cumsum(sizes), np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    width, held = int((np.bincount(number) > 1).sum()), None
    marked = np.zeros(int(number.max(initial=-1)) + 1, bool)

    def join(met: np.ndarray) -> None:
        joined = np.unique(label[met])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]

    def compared(i: int) -> np.ndarray:
        others = i + 1 + np.flatnonzero(pairs[group[i], group[i + 1 :]] & (label[i + 1 :] != label[i]))
        return others[100 * np.minimum(sizes[i], sizes[others]) >= percent * np.maximum(sizes[i], sizes[others])] if sizes[i] else others[:0]

    for t in tiles(len(sets)):
        looked_up = 0
        for i in range(t.start, t.stop):
            others = compared(i)
            if not len(others):
                continue
            n = sizes[others]
            looked_up += int(n.sum())
            if looked_up * LOOK_UP > (t.stop - i) * len(sets) * width:
                rest = slice(i, t.stop)
                held = held or incidence(sets)
                common = shared(*held, len(sets), rest).astype(np.int64)
                link = pairs[group[rest]][:, group] & (100 * common >= percent * (sizes[rest, None] + sizes[None, :] - common))
                for k in range(i, t.stop):
                    join(np.r_[k, np.flatnonzero(link[k - i])])
                break
            own = number[ends[i] - sizes[i] : ends[i]]
            marked[own] = True
            common = np.add.reduceat(marked[number[ranges(ends[others] - n, n)]], np.cumsum(n) - n, dtype=np.int64)
            marked[own] = False
            join(np.r_[i, others[100 * common >= percent * (sizes[i] + n - common)]])
    return label


def _verified(size: int, percent: int):
    """Rows sorted by unit: filters the unit's pairs of groups, expands groups that hang together by them to their documents,
    verifies these, and returns each linked document with its label's id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def linked(ids: list, gids: list, prefixes: list, texts: list) -> Iterator[pa.RecordBatch]:
            _, first, group = np.unique(np.array(gids), return_index=True, return_inverse=True)
            sets = _sets(texts, size, hashes)
            pairs = group_pairs(np.array([len(sets[k]) for k in first]), [prefixes[k] for k in first], percent)
            np.fill_diagonal(pairs, True)
            together, ids = labelled(pairs)[group], np.array(ids, np.int64)
            by = np.lexsort((ids, together))
            for part in np.split(by, np.flatnonzero(np.diff(together[by])) + 1):
                if len(part) > 1:
                    label = links_of([sets[k] for k in part], percent, group[part], pairs)
                    i = np.flatnonzero(label < np.arange(len(label)))
                    yield pa.record_batch([pa.array(ids[part][i]), pa.array(ids[part][label[i]])], ["a", "b"])

        unit, held = None, ([], [], [], [])
        for batch, some in slices(batches):
            prefix = batch.column("prefix")
            ends = np.cumsum(pa.compute.list_value_length(prefix).to_numpy(zero_copy_only=False))[:-1]
            prefix = np.split(pa.compute.list_flatten(prefix).to_numpy(zero_copy_only=False), ends)
            for u, *row in zip(batch.column("unit").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("gid").to_pylist(), prefix, some, strict=True):
                if u != unit:
                    if len(held[0]) > 1:
                        yield from linked(*held)
                    unit, held = u, ([], [], [], [])
                for column, v in zip(held, row, strict=True):
                    column.append(v)
        if len(held[0]) > 1:
            yield from linked(*held)

    return run


def ngram_join(documents: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `documents`.

    A document's set has its different shingles of `size` words, A-Z lower-cased; with fewer words the
    whole sequence is the one shingle. Two documents link when 100 * intersection >= percent * union;
    component_id is the least doc_id that links reach, the own one included. Null and empty texts have
    empty sets, which link with nothing. Rows with a null id are in the component of an equal set's
    least id, else null. Repeated rows share a component. An empty table gives no rows; columns other
    than doc_id and text are not read.

    Documents with equal sets are one class, of which only the least takes part. Sets are ordered with
    common shingles last, so that two that link share one of their first n - ceil(percent * n) + 1
    shingles. Classes with equal prefixes and sizes are one group. Groups that share a prefix shingle meet
    in one task, where pairs of groups are filtered by size and by what their prefixes share, and the
    members of the pairs that are left are verified by exact intersections. Groups meet as a cluster,
    which lists that have groups in common hang together as, if it has at most BLOCK classes; of a larger
    cluster each shingle's list meets, of lists with the same groups one, and lists above BLOCK block by
    block. Pairs never leave a task, only links to the least document that is connected in it. Components
    of all tasks' links are joined at the end.
    """
    text = documents.select("doc_id", F.col("text"), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("uid"))
    docs = prefixed(text, size, percent)
    some = docs.filter("n_shingles > 0")
    gid = F.xxhash64("grp").alias("gid")
    # a struct with a null id would be the least
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "uid", "grp")))
    classes = staged(some.groupBy("whole").agg(least.alias("r")).select("whole", "r.doc_id", "r.uid", F.xxhash64("r.grp").alias("gid")))
    groups = some.groupBy("grp").agg(F.first("prefix").alias("prefix"))
    postings = groups.select(gid, F.explode("prefix").alias("token"))
    several = postings.groupBy("token").agg(F.count("*").alias("m"), F.min("gid").alias("least")).filter("m > 1").select("token", "least")
    postings = staged(postings.join(several, "token"))
    clusters = components(postings.select(F.col("least").alias("a"), F.col("gid").alias("b")).distinct()).select(F.col("node").alias("gid"), "component")
    reps = classes.filter("doc_id is not null").select("uid", "gid").join(clusters, "gid", "left").withColumn("component", F.coalesce("component", "gid"))
    sizes = reps.groupBy("component").agg(F.count("*").alias("m")).filter("m > 1")
    reps = staged(reps.join(staged(sizes), "component"))
    small = reps.filter(F.col("m") <= BLOCK).select(F.col("component").alias("token"), "uid", F.lit(2).alias("kind"))
    reps = reps.filter(F.col("m") > BLOCK).select("uid", "gid")
    postings = postings.join(reps.select("gid").distinct(), "gid", "left_semi")
    signs = postings.groupBy("token").agg(F.count("*").alias("m"), F.sum(F.expr("xxhash64(gid) div 65536")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "gid")).alias("x"))
    kept = signs.groupBy("m", "s", "x").agg(F.min("token").alias("token")).select("token")
    lists = postings.join(kept, "token").join(reps, "gid").select("token", "uid", F.lit(0).alias("kind"))
    own = reps.join(reps.groupBy("gid").agg(F.count("*").alias("m")).filter("m > 1").select("gid"), "gid").select(F.col("gid").alias("token"), "uid", F.lit(1).alias("kind"))
    lists = lists.unionByName(own).unionByName(small)
    members = staged(lists)
    blocks = members.groupBy("kind", "token").agg(F.count("*").alias("m")).filter("m > 1").select("kind", "token", F.ceil(F.col("m") / BLOCK).alias("blocks"))
    mine = F.pmod(F.xxhash64("uid"), F.col("blocks"))
    units = members.join(blocks, ["kind", "token"]).select("kind", "token", "uid", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    units = units.select("uid", F.xxhash64("kind", "token", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"))
    wanted = units.groupBy("uid").agg(F.collect_set("unit").alias("units"))
    # repeated rows share a uid, and so a prefix
    wanted = staged(wanted.join(some.groupBy("uid").agg(F.first(gid).alias("gid"), F.first("prefix").alias("prefix")), "uid"))
    texts = beside(text, wanted, ["uid"], "prefix", 8, every=False)
    texts = texts.select(F.explode("units").alias("unit"), "doc_id", "gid", "prefix", "text").repartition("unit").sortWithinPartitions("unit")
    found = components(texts.mapInArrow(_verified(size, percent), "a long, b long"))
    labels = classes.select("whole", "doc_id").join(found, F.col("doc_id") == F.col("node"), "left").select("whole", F.coalesce("component", "doc_id").alias("component_id"))
    out = docs.join(staged(labels), "whole", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


SQL = {
    "op3_ngram_join": """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
c(doc_id, r) AS (SELECT doc_id, doc_id FROM n UNION SELECT c.doc_id, l.b FROM c JOIN l ON l.a = c.r)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, coalesce(min(c.r), w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id GROUP BY w.doc_id"""
}
QUERIES = {"op3_ngram_join": op3_ngram_join}
