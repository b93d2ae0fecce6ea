"""Operator 6: SimHash near-duplicates, found by Golay-code fuzzy hashing.

Fingerprints: words of the text with A-Z in lower case, shingles of ``shingle`` words,
XXH64 (seed 42) of each shingle, and a bit is 1 where more than half the hashes have
it. Equal fingerprints become one node before anything is joined, so exact copies
cost nothing more.

Candidates: a fingerprint is cut into three segments of 22, 21 and 21 bits. Two
fingerprints that differ in up to three bits differ in at most one bit in each of
some two segments. There, decoding one side's segment gives a codeword index that is
among the indices of the other side's segment and its words one bit away. So every
fingerprint gets one plain key for each pair of segments, and several nearby keys;
plain and nearby keys meet in their bucket, and the bit distance of what meets is verified.

A bucket is worked through as a search that starts from one unvisited fingerprint,
takes all unvisited ones within the distance and goes on from those: it yields a
spanning set of links (fewer than the bucket has members), never all pairs, and members
already reached are not compared again. Components over all links follow in Spark.

Defined results: a null text counts as empty; a text without words has fingerprint
zero and links like any other; rows with a null id get a fingerprint and a null
component unless others with an id share or link to it; repeated rows repeat their
result; an empty table gives an empty result; whole texts count, in slices of
bounded size. Only the two named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from smogline.session import pin_table

from . import common, golay
from .components import components

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Shingles hashed at once.
SLICE = 1 << 15


def fingerprint(text: str, shingle: int) -> int:
    """Unsigned 64-bit SimHash of a text."""
    words = text.encode().lower().split()
    n = len(words)
    if not n:
        return 0
    size = min(n, shingle)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    count = n - size + 1
    votes = np.zeros(64, dtype=np.int64)
    digest, last = xxhash.xxh64_digest, size - 1
    for at in range(0, count, SLICE):
        to = min(count, at + SLICE)
        hashes = b"".join([digest(line[b:e], SEED) for b, e in zip(begins[at:to], ends[at + last:to + last])])
        votes += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > count).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id long, fp long): the 64 bits as a signed number."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return common.map_text(common.plain_rows(docs, id_col, text_col), run, "doc_id long, fp long")


def bucket_keys(fps: DataFrame) -> DataFrame:
    """(bucket long, plain boolean, fp): the plain key and the nearby keys of each pair of segments."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                fp = batch.column(0).slice(at, 1 << 14).to_numpy()
                bits = fp.view(np.uint64)
                words = [((bits >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
                near = [np.sort(golay.nearby(w, n).astype(np.int64), axis=1) for w, (_, n) in zip(words, SEGMENTS)]
                own = [golay.decode(w).astype(np.int64) for w in words]
                for k, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
                    tag = k << 24
                    yield _batch(tag | own[i] << 12 | own[j], np.ones(len(fp), bool), fp)
                    row_i, idx_i = _distinct(near[i])
                    # every nearby index of one segment beside every one of the other
                    row_j, idx_j = _distinct(near[j])
                    counts = np.bincount(row_j, minlength=len(fp))
                    starts = np.cumsum(counts) - counts
                    times = counts[row_i]
                    left = np.repeat(np.arange(len(row_i)), times)
                    right = starts[row_i[left]] + np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
                    yield _batch(tag | idx_i[left] << 12 | idx_j[right], np.zeros(len(left), bool), fp[row_i[left]])

    return fps.mapInArrow(run, "bucket long, plain boolean, fp long")


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the distinct values in each sorted row."""
    new = np.ones(rows.shape, bool)
    new[:, 1:] = rows[:, 1:] != rows[:, :-1]
    row, col = np.nonzero(new)
    return row, rows[row, col]


def _batch(bucket, plain, fp) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(plain), pa.array(fp)],
                                      names=["bucket", "plain", "fp"])


def spanning_links(plain: np.ndarray, near: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links within ``bits`` between plain and nearby members of one bucket, enough to
    connect whatever all such links would connect."""
    rest = np.unique(np.concatenate([plain, near])).view(np.uint64)
    links: list[tuple[int, int]] = []
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            hit = np.bitwise_count(rest ^ x) <= bits
            if hit.any():
                found = rest[hit]
                rest = rest[~hit]
                links += [(x, y) for y in found]
                todo += list(found)
    return [tuple(np.array(p, np.uint64).view(np.int64).tolist()) for p in links]


def linked(fps: DataFrame, bits: int) -> DataFrame:
    """(a long, b long): links that connect fingerprints within ``bits``, at most three."""
    if not 0 <= bits <= 3:
        raise ValueError("three segments of a 64-bit fingerprint are proof against up to 3 bits")
    spark = fps.sparkSession
    keys = bucket_keys(fps).repartition(common.shuffle_parts(spark), "bucket").sortWithinPartitions("bucket")

    def run(batches):
        kept = [[], [], []]
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            # a bucket may go on in the next batch: hold its rows back
            tail = int(np.searchsorted(cols[0], cols[0][-1])) if batch.num_rows else 0
            for k in range(3):
                kept[k].append(cols[k][:tail])
            if tail:
                yield from _bucket_links(*(np.concatenate(x) for x in kept), bits)
                kept = [[], [], []]
            for k in range(3):
                kept[k].append(cols[k][tail:])
        if kept[0]:
            yield from _bucket_links(*(np.concatenate(x) for x in kept), bits)

    return keys.mapInArrow(run, "a long, b long").distinct()


def _bucket_links(bucket, plain, fp, bits):
    bounds = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    links = []
    for b, e in zip(bounds[:-1], bounds[1:]):
        if e - b > 1 and plain[b:e].any():
            mine = plain[b:e]
            links += spanning_links(fp[b:e][mine], fp[b:e][~mine], bits)
    if links:
        got = np.array(links, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], names=["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, bits: int = 3) -> DataFrame:
    """(doc_id long, fp long, component_id long): the smallest id reachable over links
    of up to ``bits`` differing bits, a row for each row of ``docs``."""
    fps = pin_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = pin_table(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(linked(nodes.select("fp"), bits), "a", "b")
    part = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    least = part.groupBy("root").agg(F.min("least").alias("component_id"))
    names = part.join(least, "root").select("fp", "component_id")
    return fps.join(names, "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, bits: int = 3) -> DataFrame:
    """(place): for each group of ``near_duplicates``, those without an id included, the first
    ``common.row_place`` of its rows by id and text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["place", "fp"])

    rows = docs.select(common.row_place(id_col, text_col).alias("place"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    fps = common.map_text(rows, run, "place decimal(38,0), fp long")
    nodes = pin_table(fps.groupBy("fp").agg(F.min("place").alias("place")), "nodes")
    roots = components(linked(nodes.select("fp"), bits), "a", "b")
    part = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return part.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("place").alias("place")).select("place")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, up to 3 bits."""
    got = near_duplicates(common.table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
