"""Operator 3: quality classifier with hierarchical empirical Bayes over sites.

Document evidence: a logistic model for each target (low quality, toxic) over a few
shape features of the text and the presence of words that tell the targets apart. Words are
picked by grouped counts over labelled documents; the models are fitted on a bounded, documented
sample of labelled rows (``fit_rows``, those with the smallest hash of their id).

Site evidence: grouped sums of the document probabilities over *all* documents give
each host and each path below it a posterior rate. Sparse paths shrink to their host
and sparse hosts to the global rate, by a weight estimated from how far sites differ
beyond chance (moments of a beta-binomial). A document's own share is taken out of its
site's sums. The posterior of a document joins both in log odds; it is kept while every
target's posterior is below ``reject``.

Defined results: a null text counts as empty; a null host or path is a site of its
own; repeated rows are scored alike, each row counting in the sums; a null id matches no
label; several labels of one id count as the worst of them; with fewer than ten rows of either
class the model of a target is the global rate alone; with no label at all everything is kept;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smogline.session import pin_table

from . import common

TARGETS = ("low_quality", "toxic")
#: Labelled rows that the models are fitted on at most, and words per target among the features.
FIT_ROWS, WORDS = 20_000, 200
REJECT = 0.5
SHAPES = 10
_EDGES = ".,;:!?()[]\"'"
_CAPITALS = bytes(range(65, 91))
_MARKS = bytes(b for b in range(128) if not chr(b).isalpha())
_LONE_MARKS, _END_MARKS = re.compile(r"(?<!\S)[^\w\s]+(?!\S)"), re.compile(r"[^\w\s]{2,}(?!\S)")


def words_of(text: str) -> list[str]:
    return text.lower().split()


def shape(text: str, words: list[str]) -> list[float]:
    """Features of a text's shape, each about 0 to 1."""
    n, raw = len(words), text.encode()
    seen, lines = Counter(words), text.split("\n")
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    letters = len(raw.translate(None, _MARKS))
    return [
        1.0,
        math.log1p(n) / 10,
        min(1.0, len(text) / max(1, n) / 20),
        len(seen) / max(1, n),
        max(seen.values(), default=0) / max(1, n),
        len(_LONE_MARKS.findall(text)) / max(1, n),
        len(_END_MARKS.findall(text)) / max(1, n),
        capitals / max(1, letters),
        letters / max(1, len(raw)),
        len(set(lines)) / len(lines),
    ]


def features(texts: list[str], vocab: dict[str, int]) -> np.ndarray:
    """A row for each text: its shape, then 1 for each word of ``vocab`` that it has."""
    out = np.zeros((len(texts), SHAPES + len(vocab)))
    for r, text in enumerate(texts):
        words = words_of(text)
        out[r, :SHAPES] = shape(text, words)
        for w in set(words):
            k = vocab.get(w.strip(_EDGES))
            if k is not None:
                out[r, SHAPES + k] = 1
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 3.0, rounds: int = 12) -> np.ndarray:
    """Penalised maximum likelihood by Newton steps; the constant is not penalised."""
    w = np.zeros(x.shape[1])
    rate = min(max(y.mean(), 1e-6), 1 - 1e-6)
    w[0] = math.log(rate / (1 - rate))
    penalty = np.full(x.shape[1], ridge)
    penalty[0], penalty[1:SHAPES] = 1e-6, 0.1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def labelled(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """(text, low_quality, toxic) of at most ``fit_rows`` labelled documents."""
    few = (labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
           .agg(F.max((F.col("quality") == 0).cast("int")).alias("low_quality"),
                F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    # bounded by fit_rows: three numbers a row; of several texts with one id always the same one
    return docs.join(F.broadcast(few), "doc_id").groupBy("doc_id", *TARGETS).agg(F.min("text").alias("text")).select("text", *TARGETS)


def telling_words(sample: DataFrame, count: int) -> list[str]:
    """The ``count`` words for each target that tell it apart best, by a two-sample z-score."""
    def run(batches):
        for batch in batches:
            table: dict[str, list[int]] = {}
            for text, *ys in zip(*(c.to_pylist() for c in batch.columns)):
                for w in {x.strip(_EDGES) for x in words_of(text)}:
                    got = table.setdefault(w, [0] * (1 + len(TARGETS)))
                    got[0] += 1
                    for k, y in enumerate(ys):
                        got[k + 1] += y or 0
            cols = list(zip(*table.values())) if table else [[]] * (1 + len(TARGETS))
            yield pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), *(pa.array(c, pa.int64()) for c in cols)],
                                             names=["word", "n", *TARGETS])

    counts = (sample.mapInArrow(run, "word string, n long, " + ", ".join(f"{t} long" for t in TARGETS))
              .groupBy("word").agg(*(F.sum(c).alias(c) for c in ("n", *TARGETS))).filter("n >= 5 AND word <> ''"))
    counts = pin_table(counts, "word_counts")
    total = sample.agg(F.count("*").alias("n"), *(F.sum(t).alias(t) for t in TARGETS)).first()
    words: list[str] = []
    for t in TARGETS:
        if not total.n or not total[t] or total[t] == total.n:
            continue
        rate = total[t] / total.n
        z = (F.col(t) - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
        words += [r.word for r in counts.orderBy(F.desc(F.abs(z)), "word").limit(count).collect()]
    return sorted(set(words))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, words: int = WORDS) -> dict:
    """{"vocab": words, target: weights or None}; the driver holds ``fit_rows`` rows of small numbers at most."""
    sample = pin_table(labelled(docs, labels, fit_rows), "labelled")
    vocab = {w: k for k, w in enumerate(telling_words(sample, words))}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(batch.column(0).to_pylist(), vocab)
        body = [r.astype(np.float32).tobytes() for r in x[:, :SHAPES]]
        has = [np.flatnonzero(r).astype(np.int16).tobytes() for r in x[:, SHAPES:]]
        return pa.RecordBatch.from_arrays([pa.array(body, pa.binary()), pa.array(has, pa.binary()), *batch.columns[1:]],
                                          names=["shape", "has", *TARGETS])

    rows = common.map_text(sample, run, "shape binary, has binary, " + ", ".join(f"{t} int" for t in TARGETS)).collect()
    x = np.zeros((len(rows), SHAPES + len(vocab)), np.float32)
    for r, row in enumerate(rows):
        x[r, :SHAPES] = np.frombuffer(row["shape"], np.float32)
        x[r, SHAPES + np.frombuffer(row["has"], np.int16).astype(int)] = 1
    model: dict = {"vocab": vocab}
    for t in TARGETS:
        y = np.array([row[t] or 0 for row in rows], dtype=float)
        enough = 10 <= y.sum() <= len(y) - 10
        model[t] = fit_logistic(x.astype(float), y) if enough else None
        model[f"{t}_rate"] = float(min(max(y.mean(), 1e-4), 1 - 1e-4)) if len(y) else 1e-4
    return model


def evidence(docs: DataFrame, model: dict) -> DataFrame:
    """(all columns of ``docs`` but the text, a probability for each target) from the text alone."""
    names = [c for c in docs.columns if c != "text"]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 * WORDS words and their weights

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = sent.value
        x = features(batch.column(1).to_pylist(), model["vocab"])
        out = []
        for t in TARGETS:
            w = model[t]
            p = np.full(len(x), model[f"{t}_rate"]) if w is None else 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            out.append(pa.array(np.clip(p, 1e-6, 1 - 1e-6)))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *out], names=[*names, *TARGETS])

    kinds = dict(docs.dtypes)
    return common.map_text(docs, run, ", ".join([*(f"{c} {kinds[c]}" for c in names), *(f"{t} double" for t in TARGETS)]))


def shrink_weight(sites: DataFrame, target: str, parent: Column) -> Column:
    """Pseudo-count of the parent's rate from the moments of the sites' rates: the less
    sites differ beyond chance, the more weight the parent has."""
    n, rate = F.col("n"), F.col(f"sum_{target}") / F.col("n")
    chance = parent * (1 - parent)
    between = F.sum(n * (rate - parent) * (rate - parent) - chance) / F.sum(n)
    got = sites.agg(F.avg(chance).alias("c"), between.alias("b")).first()
    c, b = got.c or 0.01, got.b or 0.0
    return F.lit(float(min(max(c / b - 1, 1.0), 1e4)) if b > 1e-9 else 1e4)


def site_rates(scored: DataFrame) -> tuple[DataFrame, dict]:
    """(host, path, n, and for each target the path's sum, its host's shrunken rate and
    the weight of that rate), and the global rates."""
    sums = [F.sum(t).alias(f"sum_{t}") for t in TARGETS]
    paths = pin_table(scored.groupBy("host", "path").agg(F.count("*").alias("n"), *sums), "paths")
    hosts = pin_table(paths.groupBy("host").agg(F.sum("n").alias("n"), *(F.sum(f"sum_{t}").alias(f"sum_{t}") for t in TARGETS)), "hosts")
    whole = hosts.agg(F.sum("n").alias("n"), *(F.sum(f"sum_{t}").alias(t) for t in TARGETS)).first()
    rates = {t: min(max((whole[t] or 0) / (whole.n or 1), 1e-6), 1 - 1e-6) for t in TARGETS}
    above = hosts.select(F.col("host").alias("at_host"), *(
        ((F.col(f"sum_{t}") + (k := shrink_weight(hosts, t, F.lit(rates[t]))) * rates[t]) / (F.col("n") + k)).alias(f"host_{t}")
        for t in TARGETS))
    joined = paths.join(above, paths["host"].eqNullSafe(above["at_host"])).drop("at_host")
    for t in TARGETS:
        joined = joined.withColumn(f"weight_{t}", shrink_weight(joined, t, F.col(f"host_{t}")))
    return joined, rates


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source", path_col: str = "lang", reject: float = REJECT,
             fit_rows: int = FIT_ROWS, words: int = WORDS, row: Column | None = None) -> DataFrame:
    """(doc_id, ``row`` if given, for each target ``text_*`` the text's probability, ``site_*`` the site's rate and ``post_*`` the
    posterior, keep boolean), a row for each row of ``docs``."""
    rows = common.plain_rows(docs, id_col, text_col)
    wide = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"),
                       *([] if row is None else [row.alias("row")]))
    marks = labels.select("doc_id", "quality", "toxic")
    scored = pin_table(evidence(wide, fit(rows, marks, fit_rows, words)), "evidence")
    sites, rates = site_rates(scored)
    sites = sites.withColumnsRenamed({"host": "at_host", "path": "at_path"}).drop("index")
    got = scored.join(sites, scored["host"].eqNullSafe(sites["at_host"]) & scored["path"].eqNullSafe(sites["at_path"]), "left")

    def odds(p):
        return F.log(p / (1 - p))

    out, keep = [], F.lit(True)
    for t in TARGETS:
        k, own = F.col(f"weight_{t}"), F.col(t)
        site = (F.col(f"sum_{t}") - own + k * F.col(f"host_{t}")) / (F.col("n") - 1 + k)
        site = F.least(F.greatest(site, F.lit(1e-6)), F.lit(1 - 1e-6))
        logit = odds(own) + odds(site) - math.log(rates[t] / (1 - rates[t]))
        post = 1 / (1 + F.exp(-logit))
        out += [own.alias(f"text_{t}"), site.alias(f"site_{t}"), post.alias(f"post_{t}")]
        keep = keep & (post < reject)
    return got.select("doc_id", *([] if row is None else ["row"]), *out, keep.alias("keep"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and decisions for all ``documents``; source is the host and language the path."""
    return classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
