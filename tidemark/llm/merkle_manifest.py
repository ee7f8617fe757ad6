"""Operator 11, Merkle dataset manifest: trees over rows, with a butterfly exchange of subtree roots between partitions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_side, staged, table

#: Leaves that a partition of a tree holds, at most; the greatest power of the fanout up to it is taken.
PARTITION_LEAVES = 4096
#: Rounds of the exchange after which its state is written down.
ROUNDS_TO_STAGE = 4
_STEPS = "array<struct<before string, after string>>"
PROOF = _STEPS.replace("before ", "before:").replace("after ", "after:")


def encoded(column: Column) -> Column:
    """A field of a leaf: `-` if null, else its UTF-8 byte count, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*columns: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, columns)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def siblings(proof: Column) -> Column:
    """All siblings of a path, level by level and left to right, concatenated."""
    return F.concat_ws("", F.transform(proof, lambda s: F.concat(s["before"], s["after"])))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with place (0-based, within its tree, in `order`, nulls first) and n, its tree's rows; rows is staged.

    Rows are sorted in ranges of (tree, order), and a range's first place comes from the counts of the ranges
    before it, of which there is one row for each tree and partition. Rows equal in all of `order` are told
    apart by where they were read, so a large group of them spans ranges too.
    """
    keys = ["tree", *order, "__read"]
    cut = rows.withColumn("__read", F.monotonically_increasing_id()).repartitionByRange(*(F.asc_nulls_first(k) for k in keys))
    cut = staged(cut.sortWithinPartitions(*(F.asc_nulls_first(k) for k in keys)).drop("__read").withColumn("__at", F.monotonically_increasing_id()))
    cut = cut.withColumn("__part", F.shiftright("__at", 33))
    counts = cut.groupBy("tree", "__part").agg(F.count("*").alias("rows"), F.min("__at").alias("first"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = staged(counts.select(F.col("tree").alias("__tree"), F.col("__part").alias("__of"), (before - F.col("first")).alias("__shift"), F.sum("rows").over(own).alias("n")))
    j = cut.join(small_side(counts, 96), F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("__part") == F.col("__of")))
    return j.withColumn("place", F.col("__at") + F.col("__shift")).drop("__tree", "__of", "__shift", "__at", "__part")


def butterfly(nodes: DataFrame, fanout: int) -> DataFrame:
    """(tree, place, root, proof) of nodes (tree, place, node, n): one partition's subtree root each, n of them in a tree.

    In round r, partitions whose places differ in their r-th digit alone (base `fanout`) send each other the
    root of the subtree that each of them is in by then. So each gets all roots of its aligned group,
    hashes their parent itself, and writes down the others as the next level of its proof: after the last
    round every partition has its whole upper proof and the root, and nothing is sent down. Places up to
    the next power of the fanout take part without a root of their own, so that each subtree has as many senders
    as receivers. A message is one hash; each place gets `fanout` of them a round.
    """
    most = nodes.agg(F.max("n").alias("n")).first()["n"] or 1
    powers = [1]
    while powers[-1] < most:
        powers.append(powers[-1] * fanout)
    rounds = F.size(F.filter(F.array(*(F.lit(p).cast("long") for p in powers)), lambda p: p < F.col("n")))
    state = nodes.withColumn("rounds", rounds).withColumn("last", F.element_at(F.array(*(F.lit(p).cast("long") for p in powers)), F.col("rounds") + 1) - 1)
    state = state.withColumn("to", F.explode(F.sequence("place", "last", "n")))
    state = state.select("tree", F.col("to").alias("place"), F.when(F.col("to") == F.col("place"), F.col("node")).alias("node"), "rounds", "n", F.lit(None).cast(PROOF).alias("proof"))
    state = state.withColumn("proof", F.array().cast(PROOF))
    for r, span in enumerate(powers[:-1]):
        swaps = F.col("rounds") > r
        digit = (F.floor(F.col("place") / span) % fanout).cast("int")
        others = F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda d: F.col("place") + (d - F.col("digit")) * span)  # noqa: B023
        sent = state.withColumn("digit", digit).withColumn("to", F.explode(F.when(swaps, others).otherwise(F.array("place"))))
        own = F.col("to") == F.col("place")
        got = sent.groupBy("tree", "to").agg(
            F.array_sort(F.collect_list(F.when(F.col("node").isNotNull(), F.struct("digit", "node")))).alias("got"), F.max(F.when(own, F.col("digit"))).alias("digit"),
            F.first(F.when(own, F.col("proof")), ignorenulls=True).alias("proof"), F.max("rounds").alias("rounds"), F.max("n").alias("n"),
        )
        hashes = lambda keep: F.concat_ws("", F.transform(F.filter("got", keep), lambda g: g["node"]))
        step = F.struct(hashes(lambda g: g["digit"] < F.col("digit")).alias("before"), hashes(lambda g: g["digit"] > F.col("digit")).alias("after"))
        parent = F.when(swaps, F.sha2(hashes(lambda g: F.lit(True)), 256)).otherwise(F.element_at("got", 1)["node"])
        state = got.select("tree", F.col("to").alias("place"), F.when(F.size("got") > 0, parent).alias("node"), "rounds", "n", F.when(swaps, F.concat("proof", F.array(step))).otherwise(F.col("proof")).alias("proof"))
        if r % ROUNDS_TO_STAGE == ROUNDS_TO_STAGE - 1:
            state = staged(state)
    return state.filter(F.col("place") < F.col("n")).select("tree", "place", F.col("node").alias("root"), "proof")


def _levels(leaves: list[bytes], n: int, size: int, fanout: int) -> list[list[bytes]]:
    """Nodes of one partition's part of a tree of n leaves, leaves first, up to its single root."""
    levels, span = [leaves], 1
    while span < min(n, size):
        last = levels[-1]
        levels.append([hashlib.sha256(b"".join(last[i : i + fanout])).hexdigest().encode() for i in range(0, len(last), fanout)])
        span *= fanout
    return levels


def _roots(size: int, fanout: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [_levels([x.hex().encode() for x in leaves], n, size, fanout)[-1][0] for leaves, n in zip(batch.column("leaves").to_pylist(), batch.column("n").to_pylist(), strict=True)]
            yield pa.record_batch([batch.column("tree"), batch.column("block"), pa.array([x.decode() for x in nodes], pa.string()), batch.column("n")], ["tree", "place", "node", "leaves"])

    return run


def _proofs(size: int, fanout: int):
    """Adds the paths inside a partition, one for each of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(batch.num_rows):
                row = batch.slice(b, 1)
                levels = _levels([x.hex().encode() for x in row.column("leaves")[0].as_py()], row.column("n")[0].as_py(), size, fanout)
                count, before, after = len(levels[0]), [], []
                for i in range(count):
                    for level in levels[:-1]:
                        own, i = i, i // fanout
                        before.append(b"".join(level[i * fanout : own]))
                        after.append(b"".join(level[own + 1 : (i + 1) * fanout]))
                steps = pa.StructArray.from_arrays([pa.array(before, pa.binary()).cast(pa.string()), pa.array(after, pa.binary()).cast(pa.string())], ["before", "after"])
                each = pa.array(range(0, len(before) + 1, len(levels) - 1), pa.int32()) if len(levels) > 1 else pa.array([0] * (count + 1), pa.int32())
                paths = pa.ListArray.from_arrays(pa.array([0, count], pa.int32()), pa.ListArray.from_arrays(each, steps))
                yield pa.record_batch([*row.columns, paths], [*row.schema.names, "paths"])

    return run


def merkle_manifest(rows: DataFrame, tree: str = "lang", order: str = "doc_id", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), fanout: int = 2, keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per row: `order` and `tree`, the columns `keep` makes, leaf, subroot, root, and proof, an array of (before, after).

    A leaf is the SHA-256 of the row's `columns`; leaves of one value of `tree` ascend by `order`, `fanout` nodes
    that follow each other become one until one is left, and the subroots, by `tree`, become the root in
    the same way. fold(leaf, proof) gives the root, whatever `fanout` is. Hashes are lowercase hex, hashed as such.

    Null ids come first, and rows of one id by their leaf; rows equal in both are interchangeable. A null text is another leaf than
    an empty one. A null tree is a tree of its own, the first. An empty table gives no rows. Columns that aren't named are not read.

    Text is read once and hashed where it lies; what travels is 32 bytes a row. Rows are dealt to partitions of
    fanout ** k leaves that are aligned in their tree, each hashes its own part, and butterfly() gives it the upper
    proof. No task holds more than a partition's leaves, however large a tree is.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    size = fanout
    while size * fanout <= PARTITION_LEAVES:
        size *= fanout
    names = {"tree": F.col(tree), "id": F.col(order), "leaf": F.unhex(leaf_hash(*map(F.col, columns)))}
    kept = {f"keep_{name}": c for name, c in (keep or {}).items()}
    leaves = placed(staged(rows.select(*(c.alias(n) for n, c in (names | kept).items()))), ["id", "leaf"])
    member = F.struct("place", "leaf", "id", *kept)
    blocks = leaves.groupBy("tree", F.floor(F.col("place") / size).alias("block")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(member)).alias("members"))
    blocks = staged(blocks)
    tree_type = rows.schema[tree].dataType.simpleString()
    packed = blocks.select("tree", "block", F.col("members.leaf").alias("leaves"), "n")
    nodes = staged(packed.mapInArrow(_roots(size, fanout), f"tree {tree_type}, place long, node string, leaves long"))
    upper = staged(butterfly(nodes.select("tree", "place", "node", F.ceil(F.col("leaves") / size).alias("n")), fanout))
    subroots = staged(upper.filter("place = 0").select(F.lit(0).alias("tree"), F.col("tree").alias("own"), F.col("root").alias("node")))
    tops = placed(subroots, ["own"])
    above = butterfly(tops.select("tree", "place", "node", "n"), fanout).select("place", F.col("root").alias("whole"), F.col("proof").alias("top"))
    above = staged(tops.select(F.col("own").alias("__own"), "place").join(above, "place").drop("place"))
    upper = upper.join(small_side(above, 2048), F.col("tree").eqNullSafe(F.col("__own"))).select(F.col("tree").alias("__tree"), F.col("place").alias("__block"), F.col("root").alias("subroot"), F.col("whole").alias("root"), F.concat("proof", "top").alias("upper"))
    upper = small_side(staged(upper), 4096)
    kinds = blocks.select("tree", "block", "n", "members", F.col("members.leaf").alias("leaves")).schema
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds.fields)
    paths = blocks.select("tree", "block", "n", "members", F.col("members.leaf").alias("leaves")).mapInArrow(_proofs(size, fanout), f"{fields}, paths array<{PROOF}>")
    j = paths.drop("leaves").join(upper, F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("block") == F.col("__block")))
    j = j.select("tree", "subroot", "root", "upper", F.explode(F.arrays_zip("members", "paths")).alias("x"))
    m = F.col("x.members")
    return j.select(m["id"].alias(order), F.col("tree").alias(tree), *(m[f"keep_{name}"].alias(name) for name in keep or {}), F.lower(F.hex(m["leaf"])).alias("leaf"), "subroot", "root", F.concat("x.paths", "upper").alias("proof"))


def summary(manifest: DataFrame, tree: str = "lang") -> DataFrame:
    """The manifest file of a dataset: one row a tree with its leaves, subroot and the root of all."""
    return manifest.groupBy(tree, "subroot", "root").agg(F.count("*").alias("leaves"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(tampers & F.col("n_chars").isNotNull(), F.unhex(leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))))
    m = merkle_manifest(docs, keep={"changed": changed})
    m = m.withColumn("folded_root", fold(F.coalesce(F.lower(F.hex("changed")), F.col("leaf")), F.col("proof")))
    return m.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_FIELD = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
# crc32 by its polynomial, bit by bit
_CRC = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda a, b: list_reduce(list_transform(range(8), lambda k: k::BIGINT), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(a, b)), 4294967295::BIGINT), 4294967295)"""

SQL = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {_LEAF.format(n="n_chars")} AS leaf, CASE WHEN {_CRC} % 7 = 0 THEN {_LEAF.format(n="(n_chars + 1)")} END AS changed, n_chars FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
node AS (SELECT lang, 0 AS level, pos, leaf AS h, n FROM p
  UNION ALL SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM node WHERE n > 1 GROUP BY lang, level, pos // 2, n),
sub AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (SELECT 0 AS level, pos, h, n FROM sub UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (SELECT coalesce(lang, '-') AS l, level, pos, h FROM node WHERE n > 1 UNION ALL SELECT '+', level, pos, h FROM top WHERE n > 1),
walk AS (SELECT doc_id, pos AS start, coalesce(lang, '-') AS own, coalesce(lang, '-') AS l, 0 AS level, pos, CASE WHEN changed IS NULL OR n_chars IS NULL THEN leaf ELSE changed END AS h, '' AS proof, leaf FROM p
  UNION ALL SELECT * FROM (SELECT w.doc_id, w.start, w.own, w.l, w.level + 1, w.pos // 2, sha256(CASE WHEN o.h IS NULL THEN w.h WHEN w.pos % 2 = 1 THEN o.h || w.h ELSE w.h || o.h END), w.proof || coalesce(o.h, ''), w.leaf
    FROM walk w JOIN steps s ON s.l = w.l AND s.level = w.level AND s.pos = w.pos LEFT JOIN steps o ON o.l = w.l AND o.level = w.level AND o.pos = xor(w.pos, 1)
    UNION ALL SELECT w.doc_id, w.start, w.own, '+', 0, s.pos, w.h, w.proof, w.leaf FROM walk w JOIN sub s ON coalesce(s.lang, '-') = w.l WHERE NOT EXISTS (SELECT 1 FROM steps z WHERE z.l = w.l AND z.level = w.level))),
fin AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY own, start ORDER BY l = '+' DESC, level DESC) = 1)
SELECT f.doc_id, f.leaf, s.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM fin f JOIN sub s ON coalesce(s.lang, '-') = f.own, (SELECT h FROM top WHERE n = 1) r"""
}
QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
