"""Operator 9: line dedup over a suffix array of line-ID sequences, by prefix doubling.

Every line is a letter, every text a sequence. Prefix doubling names the suffixes by their
first 1, 2, 4, ... lines: the name of a prefix is the earliest position at which the
same lines stand, so equal names mean equal prefixes, and the pair of names 2^k lines
apart gives the next names. Prefixes that stand nowhere else drop out at each level. A suffix
shares a long enough prefix with an earlier suffix exactly if some run of lines does, and
a run of any length is named by two overlapping prefixes of a power of two.

A run counts when its lines, with their line ends, hold at least ``min_chars`` characters. A
line goes if it lies in such a run that also stands earlier: in a document with a
smaller id, or further up in its own. It is enough to test, from each line on
and up to each line, the shortest run that is long enough: every line of a maximal repeated
run lies in one of these. A shortest run has ``min_chars`` lines at most, which bounds the levels.

Only DataFrame functions are used. Groups are summed up before they are shuffled, and
names go back to lines by joins that adaptive execution can split, so a line that a third
of all documents share is never gathered in one task.

Defined results: a null text has no line and stays null; an empty text has one empty line; rows with a
null id come after all others; rows with the same id are ordered by a hash of their
text, and rows repeated in full count once and lose the same lines; an empty table gives
an empty result. Columns other than id and text pass through ``drop_repeated`` unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from smogline.session import pin_table

from . import common

MIN_CHARS = 50
PLACE = "decimal(38,0)"


def line_table(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(row, line, h1, h2, at, ahead, back): a line of each distinct row, its place in the
    order of all lines, and the lengths of the shortest runs from it on and up to it."""
    # 64 bits of id, 31 bits of the text's hash, 31 bits of line number; without an id, beyond all of these and with
    # 92 bits of hash: below 10^38
    def wide(high, low):
        return ((high.cast("decimal(20,0)") * F.lit(2**62).cast("decimal(19,0)")).cast(PLACE)
                + (low.bitwiseAND(F.lit(2**31 - 1)) * F.lit(2**31)).cast("decimal(19,0)")).cast(PLACE)

    with_id = wide(F.col(id_col).cast("long").cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)"), F.col("row.a"))
    without = F.lit(str(2**126)).cast(PLACE) + wide(F.col("row.b").bitwiseAND(F.lit(2**61 - 1)), F.col("row.a"))
    base = F.when(F.col(id_col).isNull(), without).otherwise(with_id)
    rows = (docs.filter(F.col(text_col).isNotNull())
            .select(F.col(id_col), row_key(id_col, text_col).alias("row"), F.col(text_col).cast("string").alias("text"))
            .select("row", base.cast(PLACE).alias("base"), F.posexplode(F.split("text", "\n", -1)).alias("line", "body")))
    rows = rows.select("row", "line", F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(9), "body").alias("h2"),
                       (F.length("body") + 1).cast("long").alias("size"), (F.col("base") + F.col("line")).cast(PLACE).alias("at"))
    rows = rows.repartition(common.shuffle_parts(docs.sparkSession), "row").dropDuplicates(["row", "line"])
    doc = Window.partitionBy("row")
    rows = (rows.withColumn("until", F.sum("size").over(doc.orderBy("line").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("since", F.col("until") - F.col("size"))
            .withColumn("next", F.min("line").over(doc.orderBy(F.desc("since")).rangeBetween(Window.unboundedPreceding, -min_chars)))
            .withColumn("last", F.max("line").over(doc.orderBy("until").rangeBetween(Window.unboundedPreceding, -min_chars)))
            .withColumn("lines", F.count("*").over(doc)).withColumn("total", F.sum("size").over(doc)))
    return rows.select(
        "row", "line", "h1", "h2", "at",
        F.when(F.col("next").isNotNull(), F.col("next") - F.col("line"))
         .when(F.col("total") - F.col("since") >= min_chars, F.col("lines") - F.col("line")).cast("int").alias("ahead"),
        F.when(F.col("last").isNotNull(), F.col("line") - F.col("last"))
         .when(F.col("until") >= min_chars, F.col("line") + 1).cast("int").alias("back"))


def row_key(id_col: str, text_col: str):
    """128 bits of id and text: 64 alone would give two of some billion rows one key."""
    values = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(9), *values).alias("b"))


def named(rows: DataFrame, keys: list[str], name: str, how: str) -> DataFrame:
    """Give rows whose ``keys`` are shared the earliest place of those as their ``name``."""
    shared = (rows.filter(F.col(keys[-1]).isNotNull()).groupBy(*keys)
              .agg(F.min("at").alias(name), F.count("*").alias("copies")).filter("copies > 1").drop("copies"))
    # read back, both sides of the join have shuffles of their own, which adaptive execution can split
    return rows.join(pin_table(shared, "shared"), keys, how)


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(row, line): the lines to delete, by row key and line number."""
    table = pin_table(line_table(docs, id_col, text_col, min_chars), "lines")
    names = pin_table(named(table, ["h1", "h2"], "name0", "inner").drop("h1", "h2"), "names")
    longest = names.agg(F.max(F.greatest("ahead", "back"))).first()[0] or 0
    level, doc = 0, Window.partitionBy("row").orderBy("line")
    while 2 ** (level + 1) <= longest:
        step = 2 ** level
        pair = names.withColumn("beyond", F.max(f"name{level}").over(doc.rangeBetween(step, step)))
        names = pin_table(named(pair, [f"name{level}", "beyond"], f"name{level + 1}", "left").drop("beyond"), "names")
        level += 1
        if names.agg(F.count(f"name{level}")).first()[0] == 0:
            break
    # a longer run than the last level's would need names that no suffix shares
    most = 2 ** (level + 1) - 1
    runs = (names.select("row", "line", F.col("ahead").alias("len"))
            .union(names.select("row", F.col("line") - F.col("back") + 1, "back"))
            .filter(F.col("len").between(1, most)).distinct()
            .withColumn("level", F.floor(F.log2(F.col("len").cast("double"))).cast("int")))
    of_level = F.element_at(F.array(*(F.col(f"name{k}") for k in range(level + 1))), F.col("level") + 1)
    first = names.select("row", "line", "at", *(f"name{k}" for k in range(level + 1)))
    runs = (runs.join(first, ["row", "line"])
            .select("row", "line", "len", "level", "at", of_level.alias("head"),
                    (F.col("line") + F.col("len") - F.pow(F.lit(2), F.col("level")).cast("int")).alias("tail_line"))
            .filter("head IS NOT NULL"))
    tails = first.drop("at").withColumnRenamed("line", "tail_line")
    runs = (runs.join(tails, ["row", "tail_line"])
            .select("row", "line", "len", "at", "head", of_level.alias("tail")).filter("tail IS NOT NULL"))
    again = named(pin_table(runs, "runs"), ["len", "head", "tail"], "earliest", "inner").filter("earliest < at")
    return again.select("row", F.explode(F.sequence(F.col("line"), F.col("line") + F.col("len") - 1)).alias("line")).distinct()


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """(struct ``doc`` of all columns of a row, n_lines, n_removed, kept text): a row for each row of ``docs``."""
    if min_chars < 1:
        raise ValueError("min_chars must be positive")
    gone = repeated_lines(docs, id_col, text_col, min_chars).groupBy("row").agg(F.collect_list("line").alias("gone"))
    whole = docs.select(F.struct("*").alias("doc"), row_key(id_col, text_col).alias("row"), F.col(text_col).cast("string").alias("body"))
    parts = F.split("body", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("body")).otherwise(
        F.array_join(F.transform(left, lambda i: F.element_at(parts, i + 1)), "\n"))
    return whole.join(gone, "row", "left").select(
        "doc", F.when(F.col("body").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), kept.alias("kept"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without the later copies of repeated runs of lines."""
    got = drop_repeated(common.table(spark, sf_dir, "documents"))
    return got.select(F.col("doc.doc_id").alias("doc_id"), "n_lines",
                      F.greatest("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.col("kept").alias("text"))


ORACLE = f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS body,
                  unnest(range(len(string_split(text, chr(10))))) AS line FROM documents),
s AS (SELECT *, sum(length(body) + 1) OVER (PARTITION BY doc_id ORDER BY line) AS until,
             count(*) OVER (PARTITION BY doc_id) AS n FROM l),
b AS (SELECT *, until - length(body) - 1 AS since FROM s),
ahead AS (SELECT b.doc_id, b.line AS first, e.line AS last FROM b ASOF JOIN b e
          ON b.doc_id = e.doc_id AND b.since + {MIN_CHARS} <= e.until),
back AS (SELECT b.doc_id, e.line AS first, b.line AS last FROM b ASOF JOIN b e
         ON b.doc_id = e.doc_id AND b.until - {MIN_CHARS} >= e.since),
w AS (SELECT * FROM ahead UNION SELECT * FROM back),
t AS (SELECT w.doc_id, w.first, w.last, string_agg(b.body, chr(10) ORDER BY b.line) AS run
      FROM w JOIN b ON w.doc_id = b.doc_id AND b.line BETWEEN w.first AND w.last GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, first) AS copy FROM t),
g AS (SELECT DISTINCT b.doc_id, b.line FROM r JOIN b ON b.doc_id = r.doc_id AND b.line BETWEEN r.first AND r.last
      WHERE copy > 1),
k AS (SELECT b.doc_id, b.line, b.body, g.line IS NOT NULL AS gone FROM b LEFT JOIN g ON b.doc_id = g.doc_id AND b.line = g.line)
SELECT d.doc_id, CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS n_lines,
       CAST(coalesce(x.n_removed, 0) AS BIGINT) AS n_removed, coalesce(x.text, '') AS text
FROM documents d LEFT JOIN (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
                                   string_agg(body, chr(10) ORDER BY line) FILTER (NOT gone) AS text
                            FROM k GROUP BY doc_id) x ON d.doc_id = x.doc_id
"""
