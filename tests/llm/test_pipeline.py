"""The pipeline's stages against brute force over a small table."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import duck
from tests.llm.test_operators import KINDS, made_rows
from tidemark.llm import mixing, ngram_join, quality, sentencepieces

tokenizers_dir = pytest.importorskip("public_tokenizers")


def test_run_equals_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame(made_rows(), KINDS).write.parquet(f"{folder}/documents.parquet")
    c = duck()
    c.sql(f"CREATE TABLE docs AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    c.sql(f"DELETE FROM docs WHERE doc_id IN (SELECT doc_id FROM ({quality.quality_sql('docs')}) WHERE NOT kept)")
    kept, seen = {}, {}
    for i, t in c.sql("SELECT doc_id, text FROM docs ORDER BY doc_id").fetchall():
        seen[(t or "").encode().lower()] = i
    ids = set(seen.values())
    c.sql(f"CREATE VIEW documents AS SELECT DISTINCT ON (doc_id) * FROM docs WHERE doc_id IN ({', '.join(map(str, ids))})")
    c.sql(f"CREATE TABLE near AS SELECT d.* FROM documents d JOIN ({ngram_join.SQL['op3_ngram_join']}) n ON d.doc_id = n.doc_id WHERE n.component_id = d.doc_id")
    copies = dict(c.sql(f"SELECT doc_id, copies FROM ({mixing.mix_sql('near', row='doc_id')})").fetchall())
    encoder = sentencepieces.Encoder(tokenizers_dir.path("piece_bpe_32k.model"))
    want = []
    for i, t in c.sql("SELECT doc_id, text FROM near").fetchall():
        kept[i] = encoder.encode([t or ""])[0].tolist()
        want += [(i, kept[i])] * copies[i]
    got = [(r["doc_id"], r["ids"]) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(want)


def test_one_of_repeated_rows_stays(spark):
    docs = spark.createDataFrame(made_rows() + made_rows()[:2], KINDS)
    out = corpus_pipeline.exact(spark, docs, "")
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and {1, 4} <= set(ids)


def test_stages_keep_the_columns(spark):
    docs = spark.createDataFrame(made_rows(), KINDS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), "").columns == docs.columns


def test_near_copies_share_five_words(spark):
    """Texts with one and two words replaced, against a brute force over 5-word shingles and 0.8."""
    rng = random.Random(3)
    rows = []
    for k in range(12):
        words = [f"w{k}x{rng.randrange(9999)}" for _ in range(40 + 5 * k)]
        for at in ((), (k + 9,), (2, k + 14)):
            rows.append((len(rows) + 1, " ".join("new" if i in at else w for i, w in enumerate(words)), "en", "s", 0, 0, ""))

    def kept(size, least):
        shingles = {r[0]: {tuple(w[i : i + size]) for w in [r[1].split()] for i in range(len(w) - size + 1)} for r in rows}
        label = {i: i for i in shingles}
        for _ in rows:
            for a, x in shingles.items():
                for b, y in shingles.items():
                    if 100 * len(x & y) >= least * len(x | y):
                        label[a] = label[b] = min(label[a], label[b])
        return {i for i, c in label.items() if i == c}

    docs = spark.createDataFrame(rows, KINDS)
    got = {r["doc_id"] for r in corpus_pipeline.near(spark, docs, "").select("doc_id").collect()}
    assert got == kept(5, 80) != kept(4, 85)


def test_stages_decide_by_row(spark):
    """Null ids are judged too, and an id that repeats with other texts takes none of them away."""
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(9999)}" for _ in range(n))
    a, b, c, d = (text(80) for _ in range(4))
    near_a = a.rsplit(" ", 1)[0] + " other"
    texts = [(7, a), (None, a), (None, a), (None, b), (None, b), (3, c), (3, d), (3, "too short"), (None, "short"), (None, near_a), (9, text(70))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 0, "") for i, t in texts], KINDS).repartition(3)
    seen = lambda d: sorted(((r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()), key=str)
    want = [t for t in texts if "short" not in t[1]]
    docs = corpus_pipeline.quality(spark, docs, "")
    assert seen(docs) == sorted(want, key=str)
    want = [(7, a), (None, b), (3, c), (3, d), (None, near_a), texts[-1]]
    docs = corpus_pipeline.exact(spark, docs, "")
    assert seen(docs) == sorted(want, key=str)
    want.remove((None, near_a))
    docs = corpus_pipeline.near(spark, docs, "")
    assert seen(docs) == sorted(want, key=str)
    two = spark.createDataFrame([(i, t, "en", s, 0, 0, "") for i, t in enumerate((a, b, c, d)) for s in ("s1", "s2")], KINDS)
    taken = {}
    for r in corpus_pipeline.mix(spark, two.withColumn("doc_id", F.lit(None).cast("long")), "").collect():
        taken[r["source"]] = taken.get(r["source"], 0) + 1
    assert taken["s1"] == 6 and taken["s2"] == 2
