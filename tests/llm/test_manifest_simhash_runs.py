"""Merkle manifest, SimHash and periodic runs against SQL and brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.compare import assert_same, duck
from tidemark.llm import merkle_manifest as mm
from tidemark.llm import periodic_runs as pr
from tidemark.llm import simhash as sh

#: Extra columns with names that the operators use inside.
KINDS = "doc_id long, text string, lang string, source string, n_chars long, bits long, place long, tree string, h long, leaf string, root string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "t", 3, "l", "r") for r in rows], KINDS)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def some_rows(n=150):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(30)] + ["Été", "日本"]
    rows = [(i * 5 + 2, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "en", "fr", "Ünder", None]), rng.choice(["a", "b", None]), rng.choice([1, 70, None])) for i in range(n)]
    rows += [(9001, None, "de", "a", 3), (None, "null id", "en", None, 0), (None, None, None, None, None), (9002, "", "fr", "", 0), (9003, " \n", "fr", "a", 2)]
    return rows + [rows[4], rows[4], rows[7], (rows[9][0], "another text", *rows[9][2:])]


# ---- manifest


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf_of(r, more=0):
    i, text, lang, source, n = r[:5]
    return sha(*map(field, (i, source, lang, None if n is None else n + more, text)))


def tree_of(leaves, fanout):
    """Root and the (before, after) steps of each leaf."""
    paths, owners, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        groups = [range(a, min(a + fanout, len(nodes))) for a in range(0, len(nodes), fanout)]
        for g in groups:
            for k in g:
                for leaf in owners[k]:
                    paths[leaf].append(("".join(nodes[j] for j in g if j < k), "".join(nodes[j] for j in g if j > k)))
        owners = [[x for k in g for x in owners[k]] for g in groups]
        nodes = [sha(*(nodes[k] for k in g)) for g in groups]
    return nodes[0], paths


def brute_manifest(rows, fanout):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = (own, *tree_of([leaf_of(r) for r in own], fanout))
    root, tops = tree_of([trees[lang][1] for lang in langs], fanout)
    return sorted(str((r[0], leaf_of(r), sub, root, path + top)) for lang, top in zip(langs, tops, strict=True) for own, sub, paths in [trees[lang]] for r, path in zip(own, paths, strict=True))


@pytest.mark.parametrize("fanout, part", [(2, 4096), (2, 8), (3, 3)])
def test_manifest_equals_brute_force(spark, fanout, part, monkeypatch):
    """Also where trees span many partitions: place and level of every sibling, whatever the partition's size."""
    monkeypatch.setattr(mm, "PARTITION_LEAVES", part)
    rows = some_rows()
    got = mm.merkle_manifest(frame(spark, rows), fanout=fanout)
    assert got.columns == ["doc_id", "lang", "leaf", "subroot", "root", "proof"]
    got = got.withColumn("folded", mm.fold(F.col("leaf"), F.col("proof"))).collect()
    assert sorted(str((r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["proof"]])) for r in got) == brute_manifest(rows, fanout)
    assert all(r["folded"] == r["root"] for r in got)


def test_manifest_of_one_leaf_and_of_none(spark):
    one = mm.merkle_manifest(frame(spark, [(1, "a", "en", "s", 1)])).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] == leaf_of((1, "a", "en", "s", 1)) and one["proof"] == []
    assert mm.merkle_manifest(frame(spark, [])).count() == 0
    with pytest.raises(ValueError, match="fanout"):
        mm.merkle_manifest(frame(spark, []), fanout=1)


def test_manifest_summary_and_long_text(spark):
    rows = [(1, "word " * 400_000, "en", "s", 1), (2, "x", "en", "s", 1), (3, "x", None, "s", 1)]
    m = mm.merkle_manifest(frame(spark, rows))
    got = {r["lang"]: r for r in mm.summary(m).collect()}
    assert got["en"]["leaves"] == 2 and got["en"]["subroot"] == sha(leaf_of(rows[0]), leaf_of(rows[1]))
    assert got[None]["subroot"] == leaf_of(rows[2]) and got["en"]["root"] == sha(leaf_of(rows[2]), got["en"]["subroot"])


@pytest.mark.parametrize("part", [4096, 4])
def test_manifest_query(spark, tmp_path, part, monkeypatch):
    """Against SQL, and tampered rows alone fail."""
    monkeypatch.setattr(mm, "PARTITION_LEAVES", part)
    frame(spark, some_rows(60)[:60] + [(9001, None, None, "a", 3)]).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    c = duck(str(tmp_path))
    got = mm.op11_merkle_manifest(spark, str(tmp_path))
    assert_same(got, c, mm.SQL["op11_merkle_manifest"])
    counts = dict(spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", "n_chars").collect())
    failed = {r["doc_id"] for r in got.filter("not verified").collect()}
    assert failed == {i for i, n in counts.items() if n is not None and zlib.crc32(str(i).encode()) % 7 == 0} and failed


# ---- SimHash


def brute_print(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def classes(prints, distance):
    """Of different fingerprints, the number of each one's component."""
    prints = sorted(set(prints))
    of = {p: p for p in prints}

    def root(p):
        while of[p] != p:
            p = of[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= distance:
                of[root(a)] = root(b)
    return {p: root(p) for p in prints}


def near_rows():
    rng = random.Random(8)
    words = [f"word{k}" for k in range(300)]
    rows = [(7 * i + 3, " ".join(rng.choice(words) for _ in range(rng.randint(0, 90))), "en", "a", 1) for i in range(60)]
    base = [rng.choice(words) for _ in range(1500)]
    for i in range(25):
        base[(i * 53) % 1500] = f"new{i}"
        rows.append((1000 - i, " ".join(base), "en", "a", 1))
    rows += [(2000, rows[5][1].upper(), "en", "a", 1), (2001, None, "en", "a", 1), (2002, "", "en", "a", 1), (2003, "one two", "en", "a", 1), (2004, "ONE  two\n", "en", "a", 1), (None, rows[9][1], "en", "a", 1), (None, "alone and null", "en", "a", 1)]
    return rows + [rows[2], rows[2]] + [(3000, "very long text " * 100_000, "en", "a", 1)]


@pytest.mark.parametrize("distance, members", [(2, 1024), (2, 12), (0, 2), (4, 1024)])
def test_simhash_equals_brute_force(spark, distance, members):
    rows = near_rows()
    prints = [brute_print(r[1]) for r in rows]
    of = classes(prints, distance)
    least = {}
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            least[of[p]] = min(least.get(of[p], r[0]), r[0])
    want = sorted(str((r[0], p, least.get(of[p]))) for r, p in zip(rows, prints, strict=True))
    got = sh.simhash(frame(spark, rows), distance=distance, members=members).collect()
    assert sorted(str((r["doc_id"], r["bits"] % (1 << 64), r["component_id"])) for r in got) == want
    assert len(set(of.values())) < len(of) or not distance
    assert sh.simhash(frame(spark, []), distance=distance).count() == 0


@pytest.mark.parametrize("members", [10, 40])
def test_links_within_crowded_blocks(spark, members):
    """Fingerprints that nearly all share blocks: splitting them loses no pair and makes none."""
    rng = random.Random(4)
    prints = sorted({(0xABCDEF << 40) | (1 << rng.randrange(40)) | (1 << rng.randrange(40)) | rng.choice([0, 1 << 63, 3 << 21]) for _ in range(120)})
    numbers = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "bits long")
    got = [(r["a"], r["b"]) for r in sh.near_links(numbers, 2, members).distinct().collect()]
    want = {(a, b) for a in map(int, np.array(prints, np.uint64).view(np.int64)) for b in map(int, np.array(prints, np.uint64).view(np.int64)) if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2}
    assert len(got) == len(set(got)) and set(got) == want and want


def test_blocks_cover_all_bits():
    for count in (1, 2, 3, 7):
        parts = sh.parts_of((1 << 64) - 1, count)
        assert len(parts) == count and sum(parts) == (1 << 64) - 1
    assert sh.parts_of(0b101, 3) == [0b1, 0b100]


def test_majority_over_many_hashes():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 63, 2300).astype(np.uint64) | (np.arange(2300) % 3 == 0).astype(np.uint64) << np.uint64(63)
    count = np.array([0, 1, 2, 255, 256, 1786, 0])
    first = np.cumsum(count) - count
    want = [sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h[a : a + n]) > n) for a, n in zip(first, count, strict=True)]
    assert sh.majority(h, count).tolist() == want
    assert sh.majority(h[:0], np.array([0, 0])).tolist() == [0, 0]


# ---- runs


def brute_runs(w, least=24, times=3):
    out, n = [], len(w)
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            s, size = i - q, j - i + q
            if j > i and size >= max(least, times * q) and not any(all(w[k] == w[k - p] for k in range(s + p, s + size)) for p in range(1, q)):
                out.append((s, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(rng, n):
    w, k = [], rng.randint(1, 4)
    while len(w) < n:
        w += [rng.randrange(k) for _ in range(rng.randint(1, 8))] * rng.randint(1, 6) if rng.random() < 0.5 else [rng.randrange(k + 3)]
    return w


@pytest.mark.parametrize("least, times", [(24, 3), (6, 2), (2, 2), (9, 3), (20, 4)])
def test_finder_equals_brute_force(least, times):
    rng = random.Random(least)
    for _ in range(120):
        w = periodic_words(rng, rng.randint(1, 110))
        assert pr.RunFinder(w).runs(least, times) == brute_runs(w, least, times)


def run_rows():
    rng = random.Random(2)
    texts = [" ".join(f"w{x}" for x in periodic_words(rng, rng.randint(1, 200))) for _ in range(60)]
    texts += ["a b\tc\n" * 40, "x " * 23, "x " * 24, "", " \n ", None, "Été Été " * 30, "one two three", " ".join(f"u{i}" for i in range(500)) + " p q" * 12]
    return [(11 * i + 4, t, "en", "a", 1) for i, t in enumerate(texts)] + [(None, "n " * 30, "en", "a", 1), (4, texts[0], "en", "a", 1), (4, texts[0], "en", "a", 1)]


def collapsed(words, runs):
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def test_runs_equal_brute_force(spark):
    rows = run_rows()
    got = pr.periodic_runs(frame(spark, rows)).collect()
    want = []
    for r in rows:
        words = (r[1] or "").split()
        runs = brute_runs(words)
        want.append(str((r[0], len(words), runs, collapsed(words, runs))))
    assert sorted(str((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])) for r in got) == sorted(want)
    assert sum(len(r["runs"]) for r in got) > 40
    assert pr.periodic_runs(frame(spark, [])).count() == 0
    with pytest.raises(ValueError, match="times"):
        pr.periodic_runs(frame(spark, []), times=1)


def test_long_texts(spark):
    """A text that is one run of 300,000 words, and one with a run far inside, next to a text that goes on as the first ends."""
    rows = [(1, "a b c " * 100_000, "en", "a", 1), (2, "a b c " * 2, "en", "a", 1), (3, " ".join(f"v{i}" for i in range(200_000)) + " r s t" * 20 + " end", "en", "a", 1)]
    got = {r["doc_id"]: r for r in pr.periodic_runs(frame(spark, rows).coalesce(1)).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 300_000, 3)] and got[1]["collapsed"] == "a b c"
    assert got[2]["runs"] == [] and [tuple(x) for x in got[3]["runs"]] == [(200_000, 60, 3)]
    assert got[3]["collapsed"].endswith("v199999 r s t end")


def test_runs_query(spark, tmp_path):
    rows = [(i, t, "en", "a", 1) for i, (_, t, *_) in enumerate(run_rows())] + [(i, " ".join(f"d{i}x{k}" for k in range(i % 97)), "en", "a", 1) for i in range(300, 700)]
    frame(spark, rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in pr.op13_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, text, *_ in rows:
        words, h = (text or "").split(), zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            planted += 1
        runs = brute_runs(words)
        best = None
        for r in runs:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        want = (i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(*(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))
        assert tuple(got[i]) == want
    assert planted > 20 and got[rows[0][0]].asDict().keys() == {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"}


def test_queries_are_registered():
    from tidemark.llm import queries

    assert {"op11_merkle_manifest", "op12_simhash_dedup", "op13_periodic_runs"} <= set(queries.QUERIES)
