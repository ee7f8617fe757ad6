"""The ten operators and the pipeline on a small fixture, against SQL, libraries and brute force."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.compare import assert_same, duck
from tidemark.llm import exact_dedup, lm_scoring, mixing, ngram_join, quality, sentencepieces, substring_dedup, suffix_dedup, token_files, url_filters
from tidemark.llm.components import components
from tidemark.llm.run_index import RunIndex

tokenizers_dir = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def made_texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    words = [word() for _ in range(400)] + ["Été", "naïve", "日本", "x,y.", "It's", "$$%", "<|endoftext|>"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(70)
    out = [text(rng.randint(1, 160)) for _ in range(25)]
    out += [out[3], out[3].upper(), out[4] + " tail", "a " + out[5], out[6].replace(" ", "\n", 3)]
    out += [f"{text(30)} {passage} {text(20)}" for _ in range(3)] + [passage, "that " * 120, "z" * 900]
    near = text(150).split()
    for k in range(4):
        near[20 * k + 5] = f"edit{k}"
        out.append(" ".join(near))
    return [*out, None, "", "  \n\t ", "one", "one two", "line a b\nline a b\n\nline a b\nother"]


def made_rows():
    langs, sources = ("en", "fr", None), ("s1", "s2", "s3", "s4", None)
    return [(i * 3 + 1, t, langs[i % 3], sources[i % 5], len(t or ""), i, "x") for i, t in enumerate(made_texts())]


#: Extra columns with names that the operators use inside.
KINDS = "doc_id long, text string, lang string, source string, n_chars long, seed int, uid string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made_rows(), KINDS).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and repeated rows."""
    rows = made_rows()
    return spark.createDataFrame(rows[:6] + rows[:3] + [(None, "just some words", None, None, None, None, None), (None, None, "en", "s1", 0, 1, "")] + rows[-8:], KINDS)


@pytest.fixture(scope="module")
def tables(docs):
    c = duck()
    c.register("documents", docs.select("doc_id", "text", "lang", "source").toArrow())
    return c


WHOLE = {
    "op2": (quality.quality_rules, quality.quality_sql("documents")),
    "op3": (ngram_join.ngram_join, ngram_join.SQL["op3_ngram_join"]),
    "op6": (exact_dedup.exact_dedup, exact_dedup.SQL["op6_exact_dedup"]),
    "op9": (mixing.pareto_mix, mixing.mix_sql("documents")),
    "op10": (lambda d: substring_dedup.substring_dedup(d).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")), substring_dedup.SQL["op10_substring_dedup"]),
}


@pytest.mark.parametrize("name", WHOLE)
def test_against_sql(docs, tables, name):
    run, sql = WHOLE[name]
    assert_same(run(docs), tables, sql)


def encode(d):
    return sentencepieces.encode(d, tokenizers_dir.path("piece_bpe_32k.model"))


def token_table(d, path):
    token_files.write_tokens(d, path, tokenizers_dir.path("word_bpe_49k.json"))
    return token_files.read_tokens(d.sparkSession, path)


EVERY = {"op1": encode, "op5": suffix_dedup.suffix_dedup, "op8": lambda d: lm_scoring.lm_score(d, 2)} | {k: f for k, (f, _) in WHOLE.items()}


@pytest.mark.parametrize("name", EVERY)
def test_odd_and_empty_tables(odd, name):
    assert EVERY[name](odd).count() == odd.count()
    assert EVERY[name](odd.limit(0)).count() == 0


def test_pieces_equal_the_library(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizers_dir.path("piece_bpe_32k.model"))
    text = dict(docs.select("doc_id", "text").collect())
    for r in encode(docs).collect():
        assert r["ids"] == library.encode(text[r["doc_id"]] or "") and r["round_trip"] and r["n_tokens"] == len(r["ids"])


def test_piece_oddities():
    import sentencepiece

    path = tokenizers_dir.path("piece_bpe_32k.model")
    library, encoder = sentencepiece.SentencePieceProcessor(model_file=path), sentencepieces.Encoder(path)
    for t in ["", " ", "   ", " a", "a  b   c ", "\n\nx\ty", "▁x▁▁y", "日本語テスト🎉é́", "a\x00b", "1234 56.78", "x" * 3000, "ab" * 700 + "  z"]:
        ids = encoder.encode([t])[0]
        assert ids.tolist() == library.encode(t), t[:20]
        assert encoder.model.decode(ids) == t.replace("▁", " ")


def test_decode(docs):
    back = sentencepieces.decode(encode(docs), tokenizers_dir.path("piece_bpe_32k.model"))
    text = dict(docs.select("doc_id", "text").collect())
    assert all(r["text"] == (text[r["doc_id"]] or "") for r in back.collect())


def test_token_files_equal_the_library(docs, odd, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizers_dir.path("word_bpe_49k.json"))
    got, start = {r["doc_id"]: tuple(r) for r in token_table(docs, f"file://{tmp_path}/t").collect()}, 0
    for i, t in sorted(docs.select("doc_id", "text").collect()):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        assert got[i] == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_table(odd, f"file://{tmp_path}/o").count() == odd.count()
    assert token_table(odd.limit(0), f"file://{tmp_path}/e").count() == 0


def test_words_of_any_kind_get_the_library_ids():
    rng = random.Random(1)
    letters = "aBcé ß'.,!?*#$-_İẞǅ1²٣日́ \u200b\xa0힣🎉\n\t\x0b\x1c\x85J\u030cK"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["", "École, écOLE École!?", "x" * 5000, "Word," * 900]
    words = token_files.WordIds(tokenizers_dir.path("word_bpe_49k.json"))
    ids, n = words.of([t.encode() for t in texts])
    want = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert words.by_word and n.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]


def test_value_coding_round_trip():
    for values in ([], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], list(range(1000))):
        v = np.array(values, np.uint32)
        assert token_files.decode_values(*token_files.encode_values(v), len(v)).tolist() == values


def brute_cut(rows, match):
    places = Counter(t[k : k + match] for _, t in rows for k in range(len(t) - match + 1))
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - match + 1):
            if places[t[k : k + match]] > 1:
                gone[k : k + match] = b"\1" * match
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("match, most", [(200, 20_000), (60, 20_000), (60, 1)])
def test_suffix_dedup_equals_brute_force(docs, match, most):
    rows = [(i, (t or "").encode()) for i, t in docs.select("doc_id", "text").collect()]
    got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup.suffix_dedup(docs, match, most).collect()), key=str)
    assert got == brute_cut(rows, match)


def test_suffix_dedup_of_repeated_rows(odd):
    rows = [(i, (t or "").encode()) for i, t in odd.select("doc_id", "text").collect()]
    got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup.suffix_dedup(odd, 60).collect()), key=str)
    assert got == brute_cut(rows, 60)


def test_run_index_matching_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(30):
        base = rng.integers(97, 97 + rng.integers(1, 4), 50).astype(np.uint8)
        parts = []
        for _ in range(rng.integers(1, 6)):
            p = base.copy()
            p[rng.integers(0, 50, 2)] = rng.integers(97, 101, 2)
            a = rng.integers(0, 25)
            parts.append(p[a : a + rng.integers(1, 26)].tobytes())
        size = np.array([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        got = RunIndex(data, np.cumsum(size) - size, np.cumsum(size)).matching().tolist()
        places = [(i, j) for i, p in enumerate(parts) for j in range(len(p))]
        common = lambda a, b: len(os.path.commonprefix([parts[a[0]][a[1] :], parts[b[0]][b[1] :]]))  # noqa: E731, B023
        assert got == [max((common(a, b) for b in places if a != b), default=0) for a in places]


def test_exact_dedup_of_clashing_hashes(docs, tables):
    assert_same(exact_dedup.exact_dedup(docs, hash_bytes=1), tables, exact_dedup.SQL["op6_exact_dedup"])


def test_exact_dedup_of_null_and_repeated_ids(spark):
    rows = [(7, "Same"), (7, "same"), (3, "same"), (None, "SAME"), (None, "alone"), (None, "two"), (None, "two"), (1, None), (2, "")]
    for hash_bytes in (16, 0):
        got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), hash_bytes=hash_bytes).collect()
        by_text = {}
        for r in got:
            by_text.setdefault(r["text_sha256"], []).append((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]))
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        same = by_text[sha("same")]
        assert {x[:3] for x in same} == {(7, 7, 4), (3, 7, 4), (None, 7, 4)} and [x[0] for x in same if x[3]] == [7]
        assert by_text[sha("alone")] == [(None, None, 1, True)]
        assert sorted(by_text[sha("two")], key=str) == [(None, None, 2, False), (None, None, 2, True)]
        assert sorted(by_text[sha("")]) == [(1, 2, 2, False), (2, 2, 2, True)]


def test_exact_dedup_can_keep_the_least(docs):
    kept = {r["text_sha256"]: r["doc_id"] for r in exact_dedup.exact_dedup(docs, "min").filter("kept").collect()}
    first = {}
    for i, t in sorted(docs.select("doc_id", "text").collect()):
        first.setdefault(hashlib.sha256((t or "").encode().lower()).hexdigest(), i)
    assert kept == first


def test_large_lists_are_compared_block_by_block(docs, tables, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    assert_same(ngram_join.ngram_join(docs), tables, ngram_join.SQL["op3_ngram_join"])


def test_group_pairs_lose_no_link():
    """Sets with near copies, ordered by a common order: every pair that links passes the filters, and most others don't."""
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(30):
        base = rng.choice(4000, rng.integers(20, 80), replace=False)
        for _ in range(4):
            keep = base[rng.random(len(base)) > rng.choice([0, 0.05, 0.15])]
            sets.append(np.unique(np.r_[keep, rng.choice(4000, rng.integers(0, 4))]).astype(np.uint64))
    sizes = np.array([len(s) for s in sets])
    prefixes = [s[: len(s) - (85 * len(s) + 99) // 100 + 1] for s in sets]
    pairs, n_link = ngram_join.group_pairs(sizes, prefixes, 85), 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)):
                assert pairs[i, j]
                n_link += 1
    assert n_link <= pairs.sum() < 6 * n_link


@pytest.mark.parametrize("look_up", [0, 10, 10**9])
def test_only_pairs_that_are_left_are_verified(look_up, monkeypatch):
    """Labels within blocks of near copies equal brute force over the pairs of groups given, and over all pairs."""
    monkeypatch.setattr(ngram_join, "LOOK_UP", look_up)
    rng = np.random.default_rng(8)
    for _ in range(20):
        bases = [rng.choice(900, rng.integers(8, 60), replace=False) for _ in range(4)]
        sets = [np.unique(b[rng.random(len(b)) > 0.06]).astype(np.uint64) for b in (bases[rng.integers(4)] for _ in range(40))]
        group = rng.integers(0, 12, 40)
        some = rng.random((12, 12)) < 0.3
        for pairs in (np.ones((12, 12), bool), some | some.T | np.eye(12, dtype=bool)):
            links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if pairs[group[i], group[j]] and 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))]
            want, before = list(range(40)), None
            while want != before:
                before = list(want)
                for i, j in links:
                    want[i] = want[j] = min(want[i], want[j])
            assert ngram_join.links_of(sets, 85, group, pairs).tolist() == want


def test_null_ids_take_no_class_from_rows_with_ids(spark, docs, tables):
    """Null-id rows whose texts equal those of linked documents: other rows as by SQL, theirs the component of the equal text."""
    near = [r for r in made_rows() if " edit0 " in (r[1] or "")]
    rows = made_rows() + [(None, t, *rest) for _, t, *rest in near]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, KINDS)).collect()
    assert sorted(tuple(r) for r in got if r[0] is not None) == sorted(tables.sql(ngram_join.SQL["op3_ngram_join"]).fetchall())
    assert [r["component_id"] for r in got if r[0] is None] == [near[0][0]] * 4


def test_levels_count_all_documents_of_a_chunk():
    rows = [{"chunk": c, "doc_ids": [], "uids": [], "texts": [b"a b c d e"] * 300 + [b"p q r s"] * (c + 1)} for c in (0, 1)]
    asked = [b for r in rows for b in ngram_join._asked(4, 1)([pa.RecordBatch.from_pylist([r])])]
    for answer in ngram_join._answered(asked):
        levels = [sorted(zlib.decompress(v)) for v in answer.column("levels").to_pylist()]
    assert levels == [[1, 9, 9]] * 2


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8), (5, 5), (None, 1)] + [(i, i + 1) for i in range(100, 130)], "a long, b long")
    got = dict(components(links).collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8} | {i: 100 for i in range(100, 131)}


def test_lm_base_and_held_out_gain(spark, docs):
    rows = [(i, [*(t or "").encode().lower().split(), b""]) for i, t in docs.select("doc_id", "text").collect()]
    c = Counter(w for i, ws in rows if not lm_scoring.is_held_out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in lm_scoring.lm_score(docs, 3).collect()}
    for i, ws in rows:
        r = got[i]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), n) and r["base_score"] == pytest.approx(base)
    if os.path.isdir(SF):
        out = lm_scoring.op8_lm_score(spark, SF).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
        assert out[0] > out[1]


def test_lm_score_equals_brute_force(docs, odd, monkeypatch):
    """With given class weights and strengths; null ids and repeated rows are learnt from and scored each."""
    rng = np.random.default_rng(2)
    weights, bias, s = rng.normal(size=(lm_scoring.ROWS, lm_scoring.CLASSES)), rng.normal(size=lm_scoring.CLASSES), np.array([0.3, 0.05, 0.7])
    monkeypatch.setattr(lm_scoring, "train", lambda *_: (weights, bias, []))
    monkeypatch.setattr(lm_scoring, "strengths", lambda *_: s)
    monkeypatch.setattr(lm_scoring, "feature_mask", lambda _: np.uint64(2**64 - 1))  # no two features in one place
    for d in (docs, odd):
        rows = [(i, [b"<s>", b"<s>", *(t or "").encode().lower().split(), b""]) for i, t in d.select("doc_id", "text").collect()]
        cls = lambda w: 0 if w == b"" else lm_scoring.word_class(w)
        c, pair, pair_class, skip, skips = (Counter() for _ in range(5))
        for i, ws in rows:
            if not lm_scoring.is_held_out(i):
                for x, u, w in zip(ws, ws[1:], ws[2:]):
                    c[w] += 1
                    pair[u, w] += 1
                    pair_class[u, cls(w)] += 1
                    skip[x, cls(w)] += 1
                    skips[x] += 1
        follows, in_class, kinds = Counter(), Counter(), Counter()
        for (u, _), n in pair.items():
            follows[u] += n
        for w, n in c.items():
            in_class[cls(w)] += n
            kinds[cls(w)] += 1
        want = []
        for i, ws in rows:
            k, total = [0, 0], 0.0
            for x, u, w in zip(ws, ws[1:], ws[2:]):
                g = cls(w)
                m = math.exp(lm_scoring.log_softmax(weights, bias, np.array([k[0] + lm_scoring.CLASSES * k[1]]))[0, g])
                q = 1.0 if g == 0 else (c[w] + 0.1) / (in_class[g] + 0.1 * (kinds[g] + 1))
                total += math.log10((m + s[0] * pair_class[u, g] + s[1] * skip[x, g]) / (1 + s[0] * follows[u] + s[1] * skips[x]))
                if g:
                    total += math.log10((q + s[2] * pair[u, w]) / (1 + s[2] * pair_class[u, g]))
                k = [g, k[0]]
            want.append((str(i), len(ws) - 2, total))
        got = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in lm_scoring.lm_score(d).collect())
        assert [(i, n) for i, n, _ in got] == [(i, n) for i, n, _ in sorted(want)]
        assert np.allclose([x for _, _, x in got], [x for _, _, x in sorted(want)], rtol=1e-5)


def test_lm_is_a_distribution():
    rng = np.random.default_rng(1)
    p = np.exp(lm_scoring.log_softmax(rng.normal(size=(lm_scoring.ROWS, lm_scoring.CLASSES)), rng.normal(size=lm_scoring.CLASSES), np.arange(100)))
    assert np.allclose(p.sum(1), 1)


def test_own_quartiles_set_the_fences(spark):
    """A large group of texts with symbols keeps them, and a large group without rejects the like; both have the language in common."""
    text = lambda i, k: " ".join(f"w{i}x{j}" for j in range(60)) + " &" * k
    rows = [(i, text(i, i % 6), "en", "shop") for i in range(600)] + [(1000 + i, text(i, 0), "en", "news") for i in range(600)] + [(5000, text(9, 5), "en", "news"), (5001, text(9, 5), "en", "shop")]
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(v for k, v in got.items() if k != 5000) and not got[5000]


@pytest.mark.parametrize("longest_by_rounds", [1, 3, 100])
def test_long_units_equal_the_library(longest_by_rounds, monkeypatch):
    """Words of 200,000 letters, of equal pairs, and of signs without pieces: the same ids whichever way pairs are joined."""
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    monkeypatch.setattr(sentencepieces, "LONG_ATOM", longest_by_rounds)
    rng = random.Random(2)
    drawn = lambda signs, n: "".join(rng.choice(signs) for _ in range(n))
    texts = [drawn("abcdefghijklmnop", 200_000), "ab" * 30_000, "a" * 50_001, drawn("éàü漢字abc日本#$", 4000), " ".join(drawn("etaoinshr", rng.randint(1, 60)) for _ in range(300)), "日本語のテキスト" * 300, "one two"]
    if longest_by_rounds < 100:
        texts = texts[3:]
    encoder = sentencepieces.Encoder(path)
    assert [ids.tolist() for ids in encoder.encode(texts)] == [library.encode(t) for t in texts]
    assert [encoder.model.decode(ids) for ids in encoder.encode(texts)] == texts


@pytest.mark.parametrize("kind", ["repeats", "symbols", "lines"])
@pytest.mark.parametrize("beside", [0, 3])
@pytest.mark.parametrize("share", [0.02, 0.1, 0.4])
def test_much_junk_does_not_lift_the_fence(spark, kind, beside, share):
    """A source with 2 to 40 percent of junk, alone in its language or beside clean ones: no junk stays and no clean text goes."""

    def text(i, junk):
        words = [f"w{i}x{j}" for j in range(100)]
        if not junk:
            return " ".join(words)
        if kind == "repeats":
            return " ".join(words[:57] + (["again", "and", "again"] * 20)[:43])
        return " ".join(words) + (" " + "$" * 90 if kind == "symbols" else "\nsay\nit" * 9)

    n = 500
    rows = [(i, text(i, i < share * n), "en", "polluted") for i in range(n)] + [(n + i, text(n + i, False), "en", f"clean{i % beside}") for i in range(300 * beside)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {i for i, kept in got.items() if not kept} == set(range(int(share * n)))


def test_even_stretches_at_small_fractions(spark):
    """Rows without ids and a fraction of 0.0001: their texts tell them apart, and the words taken are near the targets."""
    rows = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("words and "), "id").alias("text"), F.when(F.col("id") < 3, "b").otherwise("a").alias("source"))
    out = mixing.pareto_mix(rows, weights=(1, 20_000)).groupBy("source_size").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(out) == 2 and all(abs(r["taken"] - r["target"]) <= 2 for r in out)


def test_inclusion_by_weight(spark):
    """Over many seeds a document is taken about min(3, level * weight) times, heavy ones up to three whole copies."""
    weights, sizes = [1, 1, 1, 2, 2, 3, 5, 9, 40] * 8, [3, 8, 5, 2, 9, 4, 6, 7, 5] * 8
    rows = [(i, " ".join(["w"] * n), s, w) for i, (w, n) in enumerate(zip(weights, sizes, strict=True)) for s in ("a" if i % 2 else "b",)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight long")
    got, times = Counter(), {}
    for seed in range(12):
        for r in mixing.pareto_mix(docs, seed=f"s{seed}", weight=F.col("weight")).collect():
            got[r["doc_id"]] += r["copies"]
            times[rows[r["doc_id"]][2]] = r["target"]
    for s, target in times.items():
        own = [r for r in rows if r[2] == s]
        low, high = 0.0, 9.0
        for _ in range(60):
            level = (low + high) / 2
            if sum(min(3, level * w) * sizes[i] for i, _, _, w in own) < target:
                low = level
            else:
                high = level
        for w in set(weights):
            ids = [r[0] for r in own if r[3] == w]
            mean, want = sum(got[i] for i in ids) / 12 / len(ids), min(3, level * w)
            assert mean == want == 3 or abs(mean - want) < 0.2, (s, w, mean, want)
            assert all(math.floor(want) * 12 <= got[i] <= math.ceil(want) * 12 for i in ids)


def test_mix_of_ties_and_long_texts(spark):
    """Equal rows, one very long text, null ids and a source without words, against SQL."""
    rows = [(1, "a b c", "s", 0)] * 5 + [(2, "word " * 300_000, "s", 0), (None, "x y", None, 0), (None, "x y z", None, 0), (None, None, "u", 0), (7, "", "u", 0), (8, "one", "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight int")
    c = duck()
    c.register("documents", docs.toArrow())
    assert_same(mixing.pareto_mix(docs), c, mixing.mix_sql("documents"))


def test_mix_meets_targets(docs):
    rows = docs.select("doc_id", "source").join(mixing.pareto_mix(docs), "doc_id").collect()
    assert all(r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] for r in rows)
    for s in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)


PAGES = ["http://A.example.org/en/1x", "https://example.org/es/y?q=1", "http://x.de.com/fr/a", "http://b.com/de/x#y", "http://casino-win.example.net/en", "https://adult-x.example.com/", "nothing", None, "", "://", "http://x.org", "http://ads.org/a?b/c", "http://h.net?x", "http://big-bets.net/", "http://big-bets.net/"]


def test_url_filters(spark):
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(PAGES)], "page_id long, url string, host string, verdict string")
    c = duck()
    c.register("pages", pages.select("page_id", "url").toArrow())
    assert_same(url_filters.url_filter(pages), c, url_filters.SQL["op4_url_filters"])
    assert url_filters.url_filter(pages.limit(0)).count() == 0


@pytest.mark.parametrize("max_bits, shards", [(1 << 20, 8), (256, 8), (64, 1)])
def test_cascade_is_exact(spark, max_bits, shards, monkeypatch):
    monkeypatch.setattr(url_filters, "BITS_PER_KEY", 2)  # many false positives, so several levels
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.filter(F.col("key").endswith("7"))
    cascade = url_filters.Cascade(listed, keys, max_bits, shards)
    assert cascade.levels is None if shards == 1 else len(cascade.levels) > 2
    assert shards == 1 or (cascade.levels[0][2] == 1) == (max_bits > 256)
    wrong = cascade.mark(keys, "key", "hit").filter(F.col("hit") != F.col("key").endswith("7"))
    assert wrong.count() == 0
    empty = url_filters.Cascade(listed.limit(0), keys)
    assert empty.mark(keys, "key", "hit").filter("hit").count() == 0


def test_cascade_of_many_keys(spark):
    keys = spark.range(400_000).select(F.concat(F.lit("host"), "id").alias("key"))
    listed = keys.filter("key like '%1' or key like '%4' or key like '%5' or key like '%8' or key like '%9'")
    out = url_filters.Cascade(listed, keys).mark(keys, "key", "hit")
    assert out.filter("hit").count() == out.filter("hit and key rlike '[14589]$'").count() == 200_000


def test_quality_keeps_clean_documents(spark):
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    q = quality.op2_quality_rules(spark, SF).join(labels, "doc_id").filter("quality = 1 and not base_failed")
    assert q.filter("not kept").count() <= 0.01 * q.count()
