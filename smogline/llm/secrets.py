"""Operator 8: secret scans with a random forest that removes false positives.

Candidates are whole tokens of at least 16 characters of the base64 and hexadecimal
alphabets, and, of any length and alphabet, the values assigned to a credential's name and the passwords in
URLs (a token inside a longer value is a candidate beside it). Each gets features: its length; whether it is such a value; how its characters follow one another (mean
log-probability under the character transitions of all documents, classes of characters and their
changes); how much of it dictionary words cover (the most frequent short words of all documents); its
path (the share of secrets among the labelled findings of its source); and its neighbours (the
share of secrets among the labelled findings beside the same word). A random forest of
``pyspark.ml`` is trained on labelled findings, a bounded sample of them (``fit_rows``; the shares above are over
all of them), and scores every candidate; those below ``keep`` are false positives.

``weak_labels`` labels findings by formats: a provider's key format or an assignment
to a credential's name is a secret; a token without digits that is no such value is none. Anything else has no
label and is left to the forest. Other labelled findings can be given instead.

Defined results: null and empty texts hold no candidate; a row with a null id is scanned and its
findings have a null id; repeated rows repeat their findings; a null source is a path
of its own; with fewer than ten labelled findings of either class there is no forest: the probability
is null and every candidate is kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smogline.operators.joins import checked_broadcasts
from smogline.session import pin_table

from . import common

CANDIDATE = re.compile(r"(?<![\w+/-])[A-Za-z0-9+/_-]{16,}={0,2}(?!\w)")
#: A credential's name with its assignment, the value that follows (quoted, or up to a space or what ends a
#: list entry), and the password in a URL.
ASSIGNMENT = re.compile(r"""(?:(?<![^\W\d_])(?i:password|passwd|pwd|passphrase|credentials?|secret|token|apikey|key)"""
                        r"""|(?<=[a-z])(?:Password|Passwd|Secret|Token|Key))\\?["'`]?\s*(?:=>|:=|==?|:(?!//))[^\S\n]*""")
QUOTED = re.compile(r"""\\?(?:"((?:[^"\\\n]|\\.)+)"|'((?:[^'\\\n]|\\.)+)'|`([^`\n]+)`)""")
#: Where an unquoted value ends: at a space or a double quote, before marks that a space follows, or before what
#: begins the next entry of a list.
STOP, MARKS = re.compile(r"""[\s"]"""), ".,;)]}'`\\"
NEXT_ENTRY = re.compile(r"[;,&](?=\s|$|[\w.-]{1,40}=)")
URL_PASSWORD = re.compile(r"://[^\s:/@]*:([^\s/]+)@")
NEIGHBOUR = re.compile(r"[^\W\d_]{2,}")
#: Labelled findings that the forest is trained on at most, and dictionary words.
FIT_ROWS, DICTIONARY = 20_000, 5_000
TREES, DEPTH, KEEP, SEED = 20, 8, 0.5, 8
#: Fixed formats: a cloud provider's access key, and names that credentials are assigned to.
KEY_FORMAT = r"^AKIA[0-9A-Z]{16}$"
CREDENTIAL_NAMES = ("password", "passwd", "secret", "token", "apikey", "key")
FOUND = "doc_id long, path string, start int, candidate string, before string, after string, assigned boolean, shape array<double>"


def corpus_tables(docs: DataFrame, words: int) -> tuple[np.ndarray, set[str]]:
    """(log-probabilities of ASCII character transitions, the ``words`` most frequent words of 3 to 6
    letters), both counted over all rows. The first is 128 * 128 numbers, whatever the size."""
    def transitions(batches):
        total = np.zeros(1 << 14, np.int64)
        for batch in common.text_slices(batches):
            raw, _ = common.string_bytes(batch.column(1))
            here = raw.astype(np.int32)
            pair = (here[:-1] << 7 | here[1:])[(here[:-1] < 128) & (here[1:] < 128)]
            total += np.bincount(pair, minlength=1 << 14)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code, pa.int32()), pa.array(total[code])], names=["code", "n"])

    def short_words(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter[str] = Counter()
        for text in batch.column(1).to_pylist():
            found.update(SHORT.findall(text.lower()))
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                          names=["word", "n"])

    table = np.ones(1 << 14)
    for r in docs.mapInArrow(transitions, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        table[r.code] += r.n
    table = table.reshape(128, 128)
    log_p = np.log(table / table.sum(axis=1, keepdims=True))
    counts = common.map_text(docs, short_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(words).collect()
    return log_p, {r.word for r in top}


SHORT = re.compile(r"(?<!\w)[a-z]{3,6}(?!\w)")


def covered(text: str, dictionary: set[str]) -> float:
    """Share of the characters that dictionary words cover, longest first from the left."""
    text, at, hit = text.lower(), 0, 0
    while at < len(text):
        size = next((n for n in (6, 5, 4, 3) if text[at:at + n] in dictionary), 0)
        hit += size
        at += size or 1
    return hit / max(1, len(text))


def shape(token: str, log_p: np.ndarray, dictionary: set[str]) -> list[float]:
    codes = np.frombuffer(token.encode("utf-32-le"), np.uint32)
    kinds = np.select([(codes >= 48) & (codes < 58), (codes >= 65) & (codes < 91), (codes >= 97) & (codes < 123)], [0, 1, 2], 3)
    n = len(codes)
    p = np.unique(codes, return_counts=True)[1] / n
    known = (codes[:-1] < 128) & (codes[1:] < 128)
    steps = log_p[codes[:-1][known], codes[1:][known]]
    return [float(n), float(steps.mean()) if len(steps) else -math.log(128), float((kinds[1:] != kinds[:-1]).mean()) if n > 1 else 0.0,
            *(float((kinds == k).mean()) for k in range(4)), float(-(p * np.log2(p)).sum()), covered(token, dictionary)]


class Values:
    """The values assigned at places of a text, asked for in ascending order: each part of it is read once."""

    def __init__(self, text: str):
        self.text, self.stop, self.end = text, -1, -1

    def _ends(self, at: int) -> None:
        """Where an unquoted value from ``at`` on stops, and its end without the marks before a space."""
        if at <= self.stop:
            return
        m = STOP.search(self.text, at)
        self.stop = self.end = m.start() if m else len(self.text)
        if not m or self.text[self.stop] != '"':
            while self.end > at and self.text[self.end - 1] in MARKS:
                self.end -= 1

    def find(self, at: int) -> tuple[int, int] | None:
        """(start, end) of the value at a place: quoted, or as far as it goes."""
        text = self.text
        m = QUOTED.match(text, at)
        if m:
            return m.span(m.lastindex)
        at += text[at:at + 1] == "\\"
        # a quote that nothing closes may open the value; if it is all there is, it is the value
        for start in ((at + 1, at) if text[at:at + 1] in ('"', "'", "`") and at < len(text) else (at,)):
            if text[start:start + 1] == '"':
                continue
            self._ends(start)
            entry = NEXT_ENTRY.search(text, start, min(len(text), self.end + 42))
            last = min(entry.start(), self.end) if entry else self.end
            if last > start and not (last == at + 1 == self.end and text[at] in MARKS and text[self.stop:self.stop + 1] != '"'):
                return start, last
        return None


def spans(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whether it is an assigned value or a URL's password) of every candidate in order. What is
    assigned within a value is part of that value, so the text is read once."""
    found = {m.span(): False for m in CANDIDATE.finditer(text)}
    values, reached = Values(text), 0
    for m in ASSIGNMENT.finditer(text):
        value = values.find(m.end()) if m.end() >= reached else None
        if value:
            found[value] = True
            reached = value[1]
    found |= {m.span(1): True for m in URL_PASSWORD.finditer(text)}
    return [(*at, found[at]) for at in sorted(found)]


def candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str, words: int = DICTIONARY) -> DataFrame:
    """FOUND: every candidate of every row, its neighbours and the features of its shape."""
    rows = common.plain_rows(docs, id_col, text_col)
    tables = corpus_tables(rows, words)
    sent = docs.sparkSession.sparkContext.broadcast(tables)
    wide = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.col(path_col).cast("string").alias("path"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        log_p, dictionary = sent.value
        out = []
        for doc, text, path in zip(*(c.to_pylist() for c in batch.columns)):
            for start, end, assigned in spans(text):
                before = NEIGHBOUR.findall(text[max(0, start - 40):start])
                after = NEIGHBOUR.search(text[end:end + 40])
                out.append((doc, path, start, text[start:end], before[-1].lower() if before else "",
                            after.group().lower() if after else "", assigned,
                            [*shape(text[start:end], log_p, dictionary), float(assigned)]))
        cols = list(zip(*out)) if out else [[]] * 8
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                          names=[f.split()[0] for f in FOUND.split(", ")])

    return common.map_text(wide, run, FOUND)


def weak_labels(found: DataFrame) -> Column:
    """1, 0 or null by the formats above."""
    yes = F.col("candidate").rlike(KEY_FORMAT) | (F.col("before").isin(*CREDENTIAL_NAMES) & F.col("candidate").rlike("[0-9]"))
    return F.when(yes, 1).when(~F.col("candidate").rlike("[0-9]") & ~F.col("assigned"), 0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", findings: DataFrame | None = None,
         fit_rows: int = FIT_ROWS, keep: float = KEEP) -> DataFrame:
    """(doc_id, start, candidate, probability, secret) of every candidate. ``findings`` has
    (doc_id, start, secret 0 or 1); without it, the weak labels serve."""
    found = pin_table(candidates(docs, id_col, text_col, path_col), "candidates")
    if findings is None:
        marked = found.withColumn("secret", weak_labels(found)).filter("secret IS NOT NULL")
    else:
        marked = found.join(findings.select("doc_id", "start", F.col("secret").cast("int").alias("secret")), ["doc_id", "start"])
    # a fixed sample: the smallest hashes, the same number of each class at most
    halves = [marked.filter(F.col("secret") == s).orderBy(F.xxhash64("candidate", "doc_id", "start"), "doc_id", "start").limit(fit_rows // 2)
              for s in (0, 1)]
    sample = pin_table(halves[0].union(halves[1]), "findings")
    sizes = {r.secret: r["count"] for r in sample.groupBy("secret").count().collect()}
    plain = found.select("doc_id", "start", "candidate")
    if min(sizes.get(0, 0), sizes.get(1, 0)) < 10:
        return plain.withColumn("probability", F.lit(None).cast("double")).withColumn("secret", F.lit(True))
    whole = marked.agg(F.avg("secret")).first()[0]
    columns = ("path", "before", "after")
    # over all labelled findings; a table beyond the bound is joined by a shuffle
    rates = dict(zip(columns, checked_broadcasts([pin_table(_rates(marked, c, whole), "rates") for c in columns])))

    def features(df: DataFrame) -> DataFrame:
        for c, rate in rates.items():
            df = df.join(rate, df[c].eqNullSafe(rate[f"at_{c}"]), "left").drop(f"at_{c}")
        known = [F.coalesce(F.col(f"rate_{c}"), F.lit(whole)) for c in rates]
        return df.withColumn("features", array_to_vector(F.concat("shape", F.array(*known))))

    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="secret", featuresCol="features",
                                    probabilityCol="chance", maxBins=64)
    model = forest.fit(features(sample).select("secret", "features"))
    scored = model.transform(features(found))
    p = F.element_at(vector_to_array("chance"), 2)
    return scored.select("doc_id", "start", "candidate", p.alias("probability"), (p >= keep).alias("secret"))


def _rates(findings: DataFrame, column: str, whole: float) -> DataFrame:
    """The share of secrets among labelled findings with the same value, shrunk to the whole's by 5 findings."""
    return (findings.groupBy(F.col(column).alias(f"at_{column}"))
            .agg(((F.sum("secret") + 5 * whole) / (F.count("*") + 5)).alias(f"rate_{column}")))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate in all ``documents``, scored."""
    return scan(common.table(spark, sf_dir, "documents"))
