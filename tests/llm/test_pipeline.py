"""Each stage against a brute-force version on what the stage before kept."""

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from smogline.llm import quality
from tests.llm import test_decontam, test_lines, test_simhash
from tests.llm.helpers import AWKWARD, frame

TABLE, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_match_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLE}/documents.parquet")
    stages, columns = dict(P.STAGES), docs.columns
    scored = {r.doc_id: r.keep for r in quality.classify(docs, spark.read.parquet(f"{TABLE}/labels.parquet")).collect()}

    def step(name, df):
        out = str(tmp_path / name)
        stages[name](spark, df, TABLE).write.parquet(out)
        return spark.read.parquet(out)

    kept = step("quality", docs)
    assert kept.columns == columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k in scored.items() if k)
    before, kept = pairs(kept), step("line_dedup", kept)
    assert kept.columns == columns and all(r.n_chars == len(r.text) for r in kept.collect())
    assert sorted(pairs(kept)) == sorted((i, t) for i, n, gone, t in test_lines.plain(before, 50) if gone < n)
    before, kept = pairs(kept), step("near_duplicates", kept)
    assert kept.columns == columns
    assert sorted(i for i, _ in pairs(kept)) == sorted(i for i, _, c in test_simhash.want(before) if i == c)
    items = [r.text for r in spark.read.parquet(f"{TABLE}/benchmark.parquet").collect()]
    before, kept = pairs(kept), step("decontamination", kept)
    assert kept.columns == columns
    assert sorted(pairs(kept)) == sorted((i, t) for i, t in before if all(test_decontam.plain(t, x) is None for x in items))
    public = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before = dict(pairs(kept))
    got = step("tokens", kept).collect()
    assert len(got) == len(before)
    assert all(list(r.ids) == public.encode(before[r.doc_id], add_special_tokens=False).ids for r in got)


def test_stages_take_awkward_rows_and_none(spark):
    for rows in (AWKWARD, []):
        df = frame(spark, rows)
        for name, stage in P.STAGES:
            out = stage(spark, df, TABLE)
            if name != "tokens":
                assert out.columns == df.columns, name
            got = out.collect()
            assert len(got) <= len(rows)
            if name in ("quality", "decontamination", "tokens"):
                assert len(got) == len(rows), name
    assert P.ORACLE_SQL is None and len(P.STAGES) == 5


def test_stages_take_dotted_and_quoted_names(spark):
    df = frame(spark, AWKWARD).withColumns({"meta.host": F.lit("h"), "a`b": F.lit(1), "doc": F.lit(2), "row": F.lit(3), "kept": F.lit(4)})
    for name, stage in P.STAGES:
        out = stage(spark, df, TABLE)
        assert 0 < out.count() <= len(AWKWARD)
        if name != "tokens":
            assert out.columns == df.columns, name
            assert {tuple(r)[-5:] for r in out.collect()} == {("h", 1, 2, 3, 4)}, name


def test_rows_without_id_are_filtered_like_others(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    third = docs.withColumn("doc_id", F.expr("if(doc_id % 3 = 0, null, doc_id)"))
    reject = {r.row for r in quality.classify(third, labels, row=F.xxhash64("doc_id", "text")).collect() if not r.keep}
    keyed = third.withColumn("key", F.xxhash64("doc_id", "text"))
    kept = P.quality_stage(spark, keyed, LARGER).collect()
    assert sum(r.doc_id is None and r.key in reject for r in keyed.collect()) > 0
    assert sorted(r.key for r in kept) == sorted(r.key for r in keyed.collect() if r.key not in reject)
    words = "many words that stand in one text and its copies " * 3
    rows = [(None, words), (None, words), (None, words.upper()), (None, "a text of its own"), (4, "some other text"), (None, "some other text")]
    got = P.near_duplicate_stage(spark, frame(spark, rows), TABLE)
    assert sorted((str(i), t.lower()) for i, t in pairs(got)) == [("4", "some other text"), ("None", "a text of its own"), ("None", words)]


def test_rows_that_share_an_id_are_decided_each(spark):
    words = "many words that stand in one text and its copies " * 3
    rows = [(1, words), (1, "another text under the same id"), (1, "a third one, unlike both"), (2, words), (2, "and one more, alone"),
            (3, "twice in full"), (3, "twice in full")]
    got = P.near_duplicate_stage(spark, frame(spark, rows), TABLE)
    assert sorted(pairs(got)) == sorted([rows[0], rows[1], rows[2], rows[4], rows[5]])
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").withColumn("doc_id", F.expr("if(doc_id % 3 = 0, 0, doc_id)"))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    scored = quality.classify(docs, spark.read.parquet(f"{LARGER}/labels.parquet"), row=F.xxhash64("doc_id", "text"))
    keep = sorted(r.row for r in scored.collect() if r.keep)
    assert 0 < len(keep) < docs.count()
    assert sorted(r.key for r in P.quality_stage(spark, docs, LARGER).collect()) == keep
