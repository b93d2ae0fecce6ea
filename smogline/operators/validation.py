"""Row validation and referential checks (ops B12, B19, G8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from .joins import checked_broadcasts


def _text(c: str) -> Column:
    return F.trim(F.col(c).cast("string"))


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (_text(c) == "")


def rule_required(c: str) -> Column:
    return F.when(_blank(c), F.lit(f"{c}: required"))


def rule_int(c: str, required: bool = True) -> Column:
    bad = ~_blank(c) & _text(c).try_cast("int").isNull()
    r = F.when(bad, F.lit(f"{c}: not an integer"))
    return F.coalesce(rule_required(c), r) if required else r


def rule_decimal(c: str) -> Column:
    """Empty text is NULL (allowed); anything else must read as a number."""
    return F.when(~_blank(c) & _text(c).try_cast("double").isNull(), F.lit(f"{c}: not a decimal"))


def rule_max_len(c: str, n: int) -> Column:
    return F.when(F.length(F.col(c).cast("string")) > n, F.lit(f"{c}: longer than {n}"))


def rule_iso_datetime(c: str, required: bool = True) -> Column:
    r = F.when(~_blank(c) & cal.parse_iso_utc(c).isNull(), F.lit(f"{c}: not an ISO datetime"))
    return F.coalesce(rule_required(c), r) if required else r


# The texts that a form's boolean field takes, in any case.
BOOLEAN_TEXTS = ["0", "off", "f", "false", "n", "no", "1", "on", "t", "true", "y", "yes"]


def rule_bool(c: str) -> Column:
    """An empty field takes its default; anything else must read as true or false."""
    return F.when(~_blank(c) & ~F.lower(_text(c)).isin(BOOLEAN_TEXTS), F.lit(f"{c}: not a boolean"))


def measurement_rules(flagged: bool = False) -> list[Column]:
    """The measurement form: station int, pollutant <= 20, ISO time, decimal value,
    unit <= 20, source <= 50 (op B19); with ``flagged`` the form has ``is_valid`` too, a boolean (true if empty)."""
    rules = [rule_bool("is_valid")] if flagged else []
    return [
        rule_int("station_id"),
        F.coalesce(rule_required("pollutant_id"), rule_max_len("pollutant_id", 20)),
        rule_iso_datetime("ts_utc"),
        rule_decimal("value"),
        rule_max_len("unit", 20),
        rule_max_len("source", 50),
        *rules,
    ]


def _req_len(c: str, n: int) -> Column:
    return F.coalesce(rule_required(c), rule_max_len(c, n))


def station_rules() -> list[Column]:
    """Station form: id, code <= 50, name <= 200, zone id required; decimal
    coordinates; type and authority <= 100; integer years (op B19)."""
    return [rule_int("station_id"), _req_len("station_code", 50), _req_len("station_name", 200),
            rule_int("zone_id"), rule_decimal("lat"), rule_decimal("lon"),
            rule_max_len("station_type", 100), rule_max_len("authority", 100),
            rule_int("years_min", required=False), rule_int("years_max", required=False)]


def zone_rules() -> list[Column]:
    return [rule_int("zone_id"), _req_len("city_code", 10), _req_len("city_name", 100),
            rule_max_len("zone_code", 50), rule_max_len("zone_name", 100), rule_int("population", required=False),
            rule_decimal("centroid_lat"), rule_decimal("centroid_lon")]


def pollutant_rules() -> list[Column]:
    return [_req_len("pollutant_id", 20), _req_len("name", 100), rule_max_len("default_unit", 20),
            rule_decimal("who_daily_limit"), rule_decimal("who_annual_limit")]


def capability_rules() -> list[Column]:
    return [rule_int("station_id"), _req_len("pollutant_id", 20), rule_max_len("unit", 20)]


def validate(df: DataFrame, rules: list[Column]) -> DataFrame:
    """Adds ``errors`` (messages joined by '; ', '' when valid) and ``n_errors``."""
    errs = F.filter(F.array(*rules), lambda x: x.isNotNull())
    return df.withColumn("errors", F.array_join(errs, "; ")).withColumn("n_errors", F.size(errs))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = F.col("n_errors") == 0
    return validated.filter(ok), validated.filter(~ok)


def orphan_counts(checks: list[tuple[str, str, DataFrame, DataFrame]]) -> DataFrame:
    """(table, key, orphans) for each foreign key (op G8).

    Each table is scanned once: its rows are counted by all the keys that are checked, which is combined
    in the tasks that read it, so a hot key is one row before any shuffle. What is left, a row for each
    combination that occurs, is tested against each parent's keys (catalogues: broadcast behind a size check,
    all measured in one job)."""
    parents = checked_broadcasts([parent.select(F.col(key).alias(f"_parent_{i}")).distinct()
                                  for i, (_, key, _, parent) in enumerate(checks)])
    tables: dict[str, list[int]] = {}
    for i, (table, *_) in enumerate(checks):
        tables.setdefault(table, []).append(i)
    out = None
    for table, of_table in tables.items():
        child, keys = checks[of_table[0]][2], [checks[i][1] for i in of_table]
        seen = child.groupBy(*dict.fromkeys(keys)).agg(F.count(F.lit(1)).alias("_n"))
        for i in of_table:
            seen = seen.join(parents[i], F.col(checks[i][1]) == F.col(f"_parent_{i}"), "left")
        counts = seen.agg(*[F.coalesce(F.sum(F.when(F.col(k).isNotNull() & F.col(f"_parent_{i}").isNull(), F.col("_n"))), F.lit(0))
                            .alias(f"_orphans_{i}") for i, k in zip(of_table, keys)])
        part = counts.select(F.explode(F.array(*[
            F.struct(F.lit(table).alias("table"), F.lit(k).alias("key"), F.col(f"_orphans_{i}").cast("long").alias("orphans"))
            for i, k in zip(of_table, keys)])).alias("_r")).select("_r.*")
        out = part if out is None else out.unionByName(part)
    return out
