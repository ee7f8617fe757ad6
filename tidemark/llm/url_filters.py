"""Operator 4, URL filters: path rules and a Bloom filter cascade, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table

#: (verdict, rule): a rule is host/path; it fits the host and its subdomains, and paths that start with its path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Words that put a host on the block list when it has one between dots or hyphens.
BLOCKED_WORDS = ("adult", "casino", "pills", "bets", "spam", "ads")
BITS_PER_KEY, HASHES = 10, 4
#: Largest array of a level, in bits (16 MB), and most arrays of a level; a list that needs more is matched by a shuffled join.
MAX_BITS, MAX_SHARDS = 1 << 27, 8
#: 64-bit words that are put in order together while a filter is built.
STRETCH = 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def best_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (of equally long ones the first in code-point order), or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, r in sorted(rules, key=lambda x: (len(x[1]), [-ord(c) for c in x[1]])):
        h, p = r.split("/", 1)
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _bits(key: Column, level: int, size: int) -> list[Column]:
    """Bit numbers of a key in the filter of a level: double hashing from one salted 64-bit hash pair."""
    a, b = (F.pmod(F.xxhash64(F.lit(2 * level + k), key), F.lit(1 << 31)) for k in (0, 1))
    return [F.pmod(a + i * b, F.lit(size)) for i in range(HASHES)]


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(shards))


def _filters(keys: DataFrame, level: int, size: int, shards: int) -> DataFrame:
    """shard, bits (an array of longs), one row a shard. Bits are set by pre-aggregated bit_or; gaps are filled
    from a range, and words put in order by stretches, then the stretches."""
    words = (size - 1) // 64 + 1
    bit = keys.select(_shard(F.col("key"), shards).alias("shard"), F.explode(F.array(*_bits(F.col("key"), level, size))).alias("bit"))
    held = bit.select("shard", F.expr("bit div 64").alias("w"), F.expr("shiftleft(1L, int(bit % 64))").alias("v"))
    gaps = keys.sparkSession.range(words * shards).select(F.expr(f"id div {words}").alias("shard"), F.expr(f"id % {words}").alias("w"), F.lit(0).cast("long").alias("v"))
    held = held.unionByName(gaps).groupBy("shard", "w").agg(F.bit_or("v").alias("v"))
    parts = held.groupBy("shard", F.expr(f"w div {STRETCH}").alias("s")).agg(F.array_sort(F.collect_list(F.struct("w", "v"))).getField("v").alias("part"))
    return staged(parts.groupBy("shard").agg(F.flatten(F.array_sort(F.collect_list(F.struct("s", "part"))).getField("part")).alias("bits")))


def _in(filters: DataFrame, key: Column, level: int, size: int, shards: int) -> Column:
    found = F.lit(False)
    for k in range(shards):
        bits, here = filters.filter(F.col("shard") == k).select("bits").scalar(), F.lit(True)
        for b in _bits(key, level, size):
            here &= F.getbit(F.element_at(bits, (F.shiftright(b, 6) + 1).cast("int")), (b % 64).cast("int")) == 1
        found = here if shards == 1 else F.when(_shard(key, shards) == k, here).otherwise(found)
    return found


class Cascade:
    """Exact membership in `listed` for every key of `universe`, by Bloom filters that alternate.

    Level 1 holds the listed keys; level 2 those keys of the universe that pass it though not listed;
    level 3 the listed keys that pass level 2; and so on until no key passes wrongly. A key is listed if
    the first level that it fails is an even one (or the last level that it passes is an odd one). Keys
    outside the universe get no promise. Nulls are left out of both tables, repeats are counted once,
    and an empty list gives a cascade without levels, which contains nothing. A level has its keys dealt
    by hash to arrays of at most max_bits bits, which come to the tasks as scalar subqueries' values. A
    level of more than max_shards arrays would be too much to send to every task: then mark() joins.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS, max_shards: int = MAX_SHARDS):
        name = lambda df: df.select(F.col(df.columns[0]).alias("key")).filter("key is not null").distinct()
        self.listed, self.levels = staged(name(listed)), []
        here, other = self.listed, staged(name(universe).join(self.listed, "key", "left_anti"))
        while count := here.count():
            shards = -(-count * BITS_PER_KEY // max_bits)
            if shards > max_shards:
                self.levels = None
                return
            level, size = len(self.levels), max(64, -(-count * BITS_PER_KEY // shards // 64) * 64)
            self.levels.append((_filters(here, level, size, shards), size, shards))
            wrong = staged(other.filter(_in(self.levels[-1][0], F.col("key"), level, size, shards)))
            here, other = wrong, here

    def contains(self, key: Column) -> Column:
        found = F.lit(len(self.levels) % 2 == 1)  # passed all levels
        for level in reversed(range(len(self.levels))):
            filters, size, shards = self.levels[level]
            found = F.when(_in(filters, key, level, size, shards), found).otherwise(level % 2 == 1)
        return F.coalesce(found, F.lit(False))

    def mark(self, df: DataFrame, key: str, out: str) -> DataFrame:
        """df with a boolean column that says whether its key is listed."""
        if self.levels is not None:
            return df.withColumn(out, self.contains(F.col(key)))
        listed = self.listed.select(F.col("key").alias("_listed"))  # beyond max_shards: a shuffled join
        return df.join(listed, F.col(key) == F.col("_listed"), "left").withColumn(out, F.col("_listed").isNotNull()).drop("_listed")


def blocked_hosts(hosts: DataFrame, words: tuple[str, ...] = BLOCKED_WORDS) -> DataFrame:
    """The hosts (column key) that have one of the words as a part between dots or hyphens."""
    return hosts.filter(F.arrays_overlap(F.split("key", "[.-]"), F.array(*map(F.lit, words))))


def url_filter(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, listed: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of `pages`.

    The longest fitting rule decides; without one a page is blocked if its host is listed, which the
    cascade answers for all hosts of the pages. `listed` has host names in its first column; by default
    it is blocked_hosts of the pages' own hosts. A null url, or one without `://`, has an empty host and
    path and is allowed. Repeated rows are judged each; an empty table gives no rows; other columns are
    not read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = staged(rows.select(F.col("host").alias("key")).distinct())
    cascade = Cascade(listed if listed is not None else blocked_hosts(hosts), hosts)
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    judged = cascade.mark(rows.withColumns({"rule": rule, "by_rule": verdict}), "host", "is_listed")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("is_listed"), "block").otherwise("allow")).alias("verdict"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


SQL = {
    "op4_url_filters": f"""
WITH r(what, h, p, rule) AS (VALUES {", ".join(f"('{w}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{r}')" for w, r in RULES)}),
a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h0 FROM a),
c AS (SELECT page_id, translate(h0, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path FROM b),
m AS (SELECT c.*, (SELECT max({{'n': length(r.rule), 'rule': r.rule, 'what': r.what}}) FROM r
                   WHERE (c.host = r.h OR ends_with(c.host, '.' || r.h)) AND starts_with(c.path, r.p)) AS best FROM c)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.what, CASE WHEN len(list_intersect(regexp_split_to_array(host, '[.-]'), [{", ".join(f"'{w}'" for w in BLOCKED_WORDS)}])) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM m"""
}
QUERIES = {"op4_url_filters": op4_url_filters}
