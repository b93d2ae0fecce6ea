import math

from smogline.llm import quality
from tests.llm.helpers import AWKWARD, frame

TABLE = "/root/testdata/sf0.01"


def test_awkward_rows(spark):
    df = frame(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.classify(df, none).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in AWKWARD)
    assert all(r.keep for r in got)
    some = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (None, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.classify(df, some).count() == len(AWKWARD)
    assert quality.classify(frame(spark, []), none).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{TABLE}/documents.parquet")
    labels = spark.read.parquet(f"{TABLE}/labels.parquet")
    train, held = labels.filter("crc32(cast(doc_id as string)) % 3 > 0"), labels.filter("crc32(cast(doc_id as string)) % 3 = 0")
    got = quality.classify(docs, train).join(held, "doc_id").collect()
    low = [r for r in got if r.quality == 0]
    good = [r for r in got if r.quality == 1 and r.toxic == 0]
    assert sum(r.post_low_quality >= 0.5 for r in low) >= 0.85 * len(low)
    assert sum(r.keep for r in good) >= 0.93 * len(good)


def test_sites_shrink_towards_their_parents(spark):
    rows = [(i, "a", "x", 0.9, 0.1) for i in range(200)] + [(1000, "a", "y", 0.1, 0.1)]
    rows += [(2000 + i, "b", "x", 0.1, 0.1) for i in range(200)] + [(3000, None, None, 0.5, 0.1)]
    df = spark.createDataFrame(rows, "doc_id long, host string, path string, low_quality double, toxic double")
    sites, rates = quality.site_rates(df)
    got = {(r.host, r.path): r for r in sites.collect()}
    host_a, host_b = got["a", "x"].host_low_quality, got["b", "x"].host_low_quality
    assert 0.1 <= host_b < rates["low_quality"] < host_a <= 0.9
    assert len(got) == 4 and got[None, None].n == 1
    one = got["a", "y"]
    rate = (one.sum_low_quality + one.weight_low_quality * host_a) / (1 + one.weight_low_quality)
    assert 0.1 < rate < host_a and not math.isnan(rate)
