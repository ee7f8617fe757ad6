"""Item vectors from a factorised association matrix, exact neighbours by bounds, and vectors as tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import unit_vector
from tidemark.operators.aggregates import top
from tidemark.shared import stored

# ---- item vectors


def item_pmi(items: DataFrame, window: int = 5, least: int = 2, shift: float = 0.0) -> DataFrame:
    """a, b, value: positive pointwise mutual information of items at most `window` places apart in (items) lists, less `shift`.

    Both directions of a pair are there. Items in fewer than `least` lists, and lists of one item, don't count.
    Pairs are made inside a list, `window` for each place, and pre-aggregated, so no item's lists meet in one task.
    """
    lists = items.filter(F.size("items") > 1).select("items")
    known = lists.select(F.explode(F.array_distinct("items")).alias("a")).groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("a")
    place = F.sequence(F.lit(0), F.size("items") - 1)
    near = lambda i: F.transform(F.slice("items", i + 2, F.lit(window)), lambda b: F.struct(F.get("items", i).alias("a"), b.alias("b")))
    found = lists.select(F.explode(F.flatten(F.transform(place, near))).alias("p")).select("p.a", "p.b").filter("a <> b")
    counts = found.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("n"))
    counts = counts.join(known, "a", "left_semi").join(known.withColumnRenamed("a", "b"), "b", "left_semi")
    both = stored(counts.select("a", "b", "n").unionByName(counts.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")))
    own = both.groupBy("a").agg(F.sum("n").alias("own"))
    total = own.agg(F.sum("own").alias("total"))
    j = both.join(own, "a").join(own.select(F.col("a").alias("b"), F.col("own").alias("other")), "b").crossJoin(F.broadcast(total))
    value = F.log(F.col("n") * F.col("total") / (F.col("own") * F.col("other"))) - shift
    return j.select("a", "b", value.alias("value")).filter("value > 0")


def _grams(size: int):
    """Sums of outer products of columns q and y over a partition's rows, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size, size))
        for batch in batches:
            q, y = (np.asarray(batch.column(c).flatten(), float).reshape(-1, size) for c in ("q", "y"))
            total += np.stack([y.T @ y, q.T @ y])
        yield pa.record_batch([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["sums"])

    return run


def _turned(by: np.ndarray, column: str):
    """(id, q): a column's vectors times a small matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.asarray(batch.column(column).flatten(), float).reshape(-1, by.shape[0]) @ by
            yield pa.record_batch([batch.column("id"), pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), by.shape[1]).cast(pa.list_(pa.float64()))], ["id", "q"])

    return run


def factorised(entries: DataFrame, size: int = 64, rounds: int = 8, more: int = 8, seed: int = 7) -> tuple[DataFrame, list[float]]:
    """(id, vector) and the greatest singular values of a symmetric sparse matrix (a, b, value), by block power iteration.

    Each round multiplies a block of size + more vectors by the matrix: entries meet their column's row of the block,
    and products are summed by row, pre-aggregated, so a row with a third of all entries is spread like any other.
    Only the block's inner products, (size + more) ** 2 numbers for each partition, reach the driver, which
    makes the block orthonormal by them. The block starts from hashes of the ids, so reruns agree. A vector is its
    row of the leading eigenvectors times the roots of their singular values; signs are such that the greatest part of
    a direction is positive.
    """
    spark = entries.sparkSession
    wide = size + more
    start = F.array(*((F.xxhash64("id", F.lit(seed), F.lit(k)) / float(1 << 63)) for k in range(wide)))
    block = stored(entries.select(F.col("a").alias("id")).distinct().withColumn("q", start))
    kinds = f"id {entries.schema['a'].dataType.simpleString()}, q array<double>"

    def times(block: DataFrame) -> DataFrame:
        """(id, q, y): the block and the matrix times it."""
        sums = [F.sum(F.col("value") * F.col("q")[k]).alias(f"y{k}") for k in range(wide)]
        made = entries.join(block.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(*sums)
        return stored(block.join(made, "id").select("id", "q", F.array(*(f"y{k}" for k in range(wide))).alias("y")))

    def grams(rows: DataFrame) -> np.ndarray:
        parts = rows.mapInArrow(_grams(wide), "sums array<double>").collect()
        return np.sum([np.array(r["sums"]).reshape(2, wide, wide) for r in sorted(parts, key=lambda r: r["sums"])], axis=0)

    if block.isEmpty():
        return spark.createDataFrame([], kinds.replace("q array", "vector array")), []

    def orthonormal(gram: np.ndarray) -> np.ndarray:
        """By what to turn vectors with these inner products to make them orthonormal; directions that are lost become 0."""
        values, directions = np.linalg.eigh((gram + gram.T) / 2)
        fit = values > values[-1] * 1e-14
        return directions * np.where(fit, 1 / np.sqrt(np.where(fit, values, 1)), 0)

    for _ in range(rounds):
        rows = times(block)
        block = rows.mapInArrow(_turned(orthonormal(grams(rows)[0]), "y"), kinds)
    again = block.select("id", "q", F.col("q").alias("y"))  # twice is enough: rounding of the first turn goes
    rows = times(again.mapInArrow(_turned(orthonormal(grams(again)[0]), "y"), kinds))
    middle = grams(rows)[1]
    values, turn = np.linalg.eigh((middle + middle.T) / 2)
    best = np.argsort(-np.abs(values), kind="stable")[:size]
    values, turn = values[best], turn[:, best]
    vectors = rows.select("id", "q").mapInArrow(_turned(turn * np.sqrt(np.abs(values)), "q"), kinds)
    vectors = stored(vectors)
    ends = vectors.agg(*(f(F.col("q")[k]).alias(f"{n}{k}") for k in range(len(values)) for n, f in (("x", F.max), ("n", F.min)))).first()
    signs = F.array(*(F.lit(1.0 if ends[f"x{k}"] >= -ends[f"n{k}"] else -1.0) for k in range(len(values))))
    return vectors.select("id", F.zip_with("q", signs, lambda x, s: x * s).alias("vector")), np.abs(values).tolist()


def item_vectors(items: DataFrame, size: int = 64, window: int = 5, least: int = 2, shift: float = 0.0) -> DataFrame:
    """id, vector of items that stand together in (items) lists: the factorised association matrix."""
    return factorised(stored(item_pmi(items, window, least, shift)), size)[0]


def save_vectors(vectors: DataFrame, path: str) -> None:
    """(id, vector) as Parquet of unit vectors in 32-bit numbers."""
    vectors.select("id", unit_vector(F.col("vector")).cast("array<float>").alias("vector")).write.mode("overwrite").parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("id", "vector")


# ---- neighbours

#: The most centres; a means to skip work, so any number gives the same rows.
MOST_CENTRES = 2048
#: Cells of a matrix of cosines that is held at once.
CELLS = 4_000_000


def chunk_rows(count: int) -> int:
    """Rows of a chunk: eight times the root of all, 4096 at least. A query's vector is sent to each chunk it meets, so what is sent grows with queries * count ** 0.5 at most."""
    return max(4096, 8 * int(np.sqrt(count)))


def cosines(q: np.ndarray, v: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Cosines of unit vectors q with all of v, some rows of q at a time."""
    step = max(1, CELLS // max(1, len(v)))
    for a in range(0, len(q), step):
        yield slice(a, a + step), q[a : a + step] @ v.T


def nth_best(cos: np.ndarray, n: int) -> np.ndarray:
    return np.partition(cos, cos.shape[1] - n, axis=1)[:, cos.shape[1] - n]


def _grouped(ids: np.ndarray, centres: np.ndarray, n: int):
    """Adds the nearest centre, the angle to it, and a lower bound of the n-th best cosine, from the centres themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.asarray(batch.column("v").flatten(), float).reshape(-1, centres.shape[1])
            own = batch.column("id").to_numpy(zero_copy_only=False)
            group, angle, floor = np.empty(len(v), np.int32), np.empty(len(v)), np.full(len(v), -2.0)
            for at, cos in cosines(v, centres):
                group[at] = cos.argmax(1)
                angle[at] = np.arccos(np.clip(cos.max(1), -1, 1))
                if len(ids) > n:
                    cos[own[at, None] == ids] = -2
                    floor[at] = nth_best(cos, n)
            yield pa.record_batch([*batch.columns, pa.array(group), pa.array(angle), pa.array(floor)], ["id", "v", "asks", "group", "angle", "floor"])

    return run


PACKED = "group int, chunk int, ids binary, matrix binary, asks binary, asking binary, floor binary"


def _packed(n: int):
    """One row a chunk: its vectors as one matrix, those of its rows that ask by themselves, and better lower bounds from its own rows."""

    def run(key, rows):
        order = np.argsort(rows["id"].to_numpy(), kind="stable")
        ids, asks, floor = (rows[c].to_numpy()[order] for c in ("id", "asks", "floor"))
        v = np.asarray(rows["v"].combine_chunks().flatten(), float).reshape(len(ids), -1)[order]
        asked = np.flatnonzero(asks)
        floor = floor[asked]
        if len(ids) > n:
            for at, cos in cosines(v[asked], v):
                cos[np.arange(len(cos)), asked[at]] = -2
                floor[at] = np.maximum(floor[at], nth_best(cos, n))
        ids = ids.astype(np.int64)
        blobs = (x.tobytes() for x in (ids, v, ids[asked], v[asked], floor))
        return pa.table([pa.array([x.as_py()], pa.int32()) for x in key] + [pa.array([x], pa.binary()) for x in blobs], ["group", "chunk", "ids", "matrix", "asks", "asking", "floor"])

    return run


#: What rounding could take off a bound, and off the sixth place that cosines are ranked by.
SLACK = 2e-6


#: Queries of a chunk that are held against all centres at once.
ASKED_AT_ONCE = 2048


def _meets(n: int, centres: np.ndarray, groups: np.ndarray, radius: np.ndarray, chunks: np.ndarray, found: bool):
    """Each query of a chunk beside each chunk whose group's angle, less its radius, doesn't rule out the query's bound; the queries' chunk too if `found`."""
    size = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, floor, q = np.frombuffer(row["asks"], np.int64), np.frombuffer(row["floor"]), np.frombuffer(row["asking"]).reshape(-1, size)
                for s in range(0, len(own), ASKED_AT_ONCE):
                    at = slice(s, s + ASKED_AT_ONCE)
                    angle = np.arccos(np.clip(q[at] @ centres[groups].T, -1, 1))
                    fit = np.cos(np.maximum(angle - radius, 0)) + SLACK >= floor[at, None]
                    for g in np.flatnonzero(fit.any(0)):
                        some = np.flatnonzero(fit[:, g])
                        for chunk in range(chunks[g]):
                            k = len(some)
                            vectors = pa.FixedSizeListArray.from_arrays(pa.array(q[at][some].ravel()), size).cast(pa.list_(pa.float64()))
                            columns = [np.full(k, groups[g], np.int32), np.full(k, chunk, np.int32), own[at][some], vectors, floor[at][some]]
                            if found:
                                columns += [np.full(k, row["group"], np.int32), np.full(k, row["chunk"], np.int32)]
                            names = ["group", "chunk", "query", "q", "floor", "of_group", "of_chunk"]
                            yield pa.record_batch([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names[: len(columns)])

    return run


def _met(n: int, size: int):
    """(query, item, cos): the best n of each query among the rows of the chunk that it met, those below its bound left out. A chunk's matrix comes before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, v = np.empty(0, np.int64), np.empty((0, size))
        for batch in batches:
            query = batch.column("query")
            heads = np.flatnonzero(query.is_null().to_numpy(zero_copy_only=False))  # rows that are a chunk
            ends = [*heads, batch.num_rows]
            for first, end in zip([0, *(h + 1 for h in heads)], ends, strict=True):
                if first > 0:  # the row before is a chunk; else the last batch's goes on
                    ids, v = np.frombuffer(batch.column("ids")[first - 1].as_py(), np.int64), np.frombuffer(batch.column("matrix")[first - 1].as_py()).reshape(-1, size)
                if first == end:
                    continue
                part = batch.slice(first, end - first)
                own, floor = part.column("query").to_numpy(), part.column("floor").to_numpy()
                q = np.asarray(part.column("q").flatten(), float).reshape(-1, size)
                for at, cos in cosines(q, v):
                    cos = np.round(cos, 6)
                    cos[own[at, None] == ids] = -2
                    enough = (cos >= (floor[at] - SLACK)[:, None]) & (cos > -2)
                    if len(ids) > n:
                        enough &= cos >= nth_best(cos, n)[:, None]
                    a, b = np.nonzero(enough)
                    order = np.lexsort((b, -cos[a, b], a))  # ids ascend: of equal cosines the first ids stay, as in the last ranking
                    a, b = a[order], b[order]
                    least = np.arange(len(a)) - np.searchsorted(a, a) < n
                    a, b = a[least], b[least]
                    yield pa.record_batch([pa.array(own[at][a]), pa.array(ids[b]), pa.array(cos[a, b])], ["query", "item", "cos"])

    return run


def similar_items(vectors: DataFrame, n: int = 30, queries: str = "true", found: dict | None = None) -> DataFrame:
    """query, item, cos, rank: exact cosine neighbours, among all items of (id, vector), of those that `queries` (SQL over id) names.

    Items are grouped round centres (items of the lowest id hashes, MOST_CENTRES at most) and packed into chunks
    of chunk_rows() at most. An item's n-th best cosine is no less than the n-th best among the
    centres or in its own chunk; a query skips every chunk whose centre's angle to it, less the radius, rules that bound
    out. Only the queries' own vectors are sent to the chunks that they meet, and a chunk's matrix once. Results are those of
    comparing all with all; `found` is told how many pairs of chunks there are and how many met. Ids are different and not null.
    """
    spark = vectors.sparkSession
    v = stored(vectors.filter("id is not null and vector is not null").select("id", unit_vector(F.col("vector")).alias("v"), F.expr(queries).alias("asks")))
    shape = v.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("size")).first()
    count, size = shape["n"], shape["size"] or 0
    rows = chunk_rows(count)
    picked = v.orderBy(F.xxhash64("id"), "id").limit(min(MOST_CENTRES, max(1, 2 * count // rows))).collect()
    if not picked:
        return spark.createDataFrame([], "query long, item long, cos double, rank int")
    ids, centres = np.array([r["id"] for r in picked]), np.array([r["v"] for r in picked], float)
    grouped = v.mapInArrow(_grouped(ids, centres, n), "id long, v array<double>, asks boolean, group int, angle double, floor double")
    sizes = grouped.groupBy("group").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).orderBy("group").collect()  # a row a centre
    chunks = {r["group"]: max(1, -(-r["n"] // rows)) for r in sizes}
    parts = F.create_map(*(F.lit(x) for g, c in chunks.items() for x in (g, c)))
    dealt = grouped.withColumn("chunk", F.pmod(F.xxhash64("id"), parts[F.col("group")]).cast("int"))
    packed = stored(dealt.groupBy("group", "chunk").applyInArrow(_packed(n), PACKED))
    groups, radius = np.array([r["group"] for r in sizes]), np.array([r["radius"] for r in sizes])
    asking = packed.select("group", "chunk", "asks", "asking", "floor").filter("length(asks) > 0")
    kinds = "group int, chunk int, query long, q array<double>, floor double"
    parts = np.array([chunks[g] for g in groups])
    if found is not None:
        pairs = asking.mapInArrow(_meets(n, centres, groups, radius, parts, True), f"{kinds}, of_group int, of_chunk int").select("group", "chunk", "of_group", "of_chunk").distinct()
        found |= {"pairs": asking.count() * packed.count(), "met": pairs.count()}
    asked = asking.mapInArrow(_meets(n, centres, groups, radius, parts, False), kinds)
    both = packed.select("group", "chunk", "ids", "matrix").unionByName(asked, allowMissingColumns=True)
    both = both.repartition(int(parts.sum()), "group", "chunk").sortWithinPartitions("group", "chunk", F.col("query").asc_nulls_first())
    return top(both.mapInArrow(_met(n, size), "query long, item long, cos double"), [F.col("cos").desc(), "item"], ["query"], n)
