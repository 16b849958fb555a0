"""Incremental state: the evaluation ledger, keyed merges, forward-only snapshots, coalesced updates and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

LEDGER_KEY = ("land_id", "scene_id", "geometry_fingerprint")
MERGE_KEYS = {
    "observations": ("land_id", "scene_id"),
    "intelligence": ("tenant_id", "land_id", "scene_id"),
    "water_layers": ("tenant_id", "land_id", "scene_id", "layer_code"),
    "ledger": ("land_id", "scene_id", "pipeline_version", "geometry_fingerprint"),
}


def unseen(candidates: DataFrame, ledger: DataFrame, version: str, since: Column, key: Sequence[str] = LEDGER_KEY) -> DataFrame:
    """JN1, SM3: candidate scenes that this version has not evaluated for this boundary."""
    known = ledger.where((F.col("pipeline_version") == version) & (F.col("acquisition_date") >= since)).select(*key)
    return candidates.join(known, list(key), "left_anti")


def unchanged_lands(candidates: DataFrame, ledger: DataFrame, version: str, since: Column, land: str = "land_id", key: Sequence[str] = LEDGER_KEY) -> DataFrame:
    """JN2: lands all of whose scenes are known, at least one of them accepted."""
    known = ledger.where((F.col("pipeline_version") == version) & (F.col("acquisition_date") >= since)).groupBy(*key).agg(F.max(F.when(F.col("outcome") == "accepted", 1).otherwise(0)).alias("ok"))
    state = candidates.join(known, list(key), "left").groupBy(land).agg(F.bool_and(F.col("ok").isNotNull()).alias("all_known"), F.max(F.coalesce("ok", F.lit(0))).alias("any_ok"))
    return state.where(F.col("all_known") & (F.col("any_ok") == 1)).select(land)


def needed_scenes(todo: DataFrame, scene: str = "scene_id") -> DataFrame:
    """JN3: scenes that some land still lacks."""
    return todo.select(scene).distinct()


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """SNK1: the target after an idempotent upsert: source rows replace, of several with one key the last in order stays."""
    rest = [c for c in target.columns if c not in keys]
    last = source.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*(order or rest))).alias("r")).select(*keys, "r.*")
    return target.join(last.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(last.select(*target.columns))


def new_rows(before: DataFrame, after: DataFrame, keys: Sequence[str], land: str) -> DataFrame:
    """SNK2: how many rows of each land are new."""
    return after.join(before.select(*keys), list(keys), "left_anti").groupBy(land).agg(F.count("*").alias("new_rows"))


def coalesce_updates(events: DataFrame, key: str, order: str, fields: Sequence[str]) -> DataFrame:
    """SNK4: one entry per land; of each field the last value that was set."""
    return events.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in fields])


def apply_updates(lands: DataFrame, updates: DataFrame, key: str = "id") -> DataFrame:
    """SNK3, SNK5, JN13: set-based update of lands. updates: has_snapshot, value, status, set_note, note, thumbnail; a snapshot
    without a value is refused."""
    u = updates.select(*[F.col(c).alias(f"u_{c}") for c in updates.columns])
    j = lands.join(u, F.col(key) == F.col(f"u_{key}"), "left")
    snap = F.coalesce(F.col("u_has_snapshot"), F.lit(False))
    value = F.when(snap & F.col("u_value").isNull(), F.raise_error(F.lit("a snapshot needs a value"))).when(snap, F.col("u_value")).otherwise(F.col("value"))
    note = F.when(F.coalesce(F.col("u_set_note"), F.lit(False)), F.col("u_note")).otherwise(F.col("note"))
    new = {"value": value, "tested": F.when(snap, True).otherwise(F.col("tested")), "status": F.coalesce("u_status", "status"), "note": note, "thumbnail": F.coalesce("u_thumbnail", "thumbnail")}
    return j.select(*[new[c].alias(c) if c in new else F.col(c) for c in lands.columns])


def snapshot_forward(current: DataFrame, incoming: DataFrame, key: str, date: str) -> DataFrame:
    """SM4: the newest incoming row of each key replaces the current one only when it is not older."""
    rest = [c for c in current.columns if c != key]
    best = incoming.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(date, *rest)).alias("new"))
    j = current.select(key, F.struct(*rest).alias("old")).join(best, key, "full_outer")
    take = F.when(F.col("old").isNull() | (F.col(f"new.{date}") >= F.col(f"old.{date}")), F.col("new")).otherwise(F.col("old"))
    return j.select(key, F.coalesce(take, F.col("old")).alias("s")).select(key, "s.*")


def ledger_outcomes(accepted: DataFrame, rejected: DataFrame, retry: DataFrame, version: str) -> DataFrame:
    """CD10: accepted and rejected evaluations as ledger rows, reasons cut to 200 characters, scenes to be tried again left out."""
    cols = ["land_id", "scene_id", "geometry_fingerprint", "acquisition_date"]
    a = accepted.select(*cols, F.lit("accepted").alias("outcome"), F.lit(None).cast("string").alias("reason"))
    r = rejected.select(*cols, F.lit("rejected").alias("outcome"), F.substring("reason", 1, 200).alias("reason"))
    rows = a.unionByName(r).where(F.coalesce("geometry_fingerprint", F.lit("")) != "").withColumn("pipeline_version", F.lit(version))
    return rows.join(retry.select("land_id", "scene_id"), ["land_id", "scene_id"], "left_anti")


def land_status(df: DataFrame) -> DataFrame:
    """CD9: the status of each land from its outcome flags: error, n_rows, prior_accepted, stored, promoted, n_optical."""
    status = (
        F.when(F.col("error"), "failed")
        .when((F.col("n_rows") == 0) & F.col("prior_accepted"), "unchanged")
        .when(F.col("n_rows") == 0, "no_data")
        .when(~F.col("stored"), "failed")
        .when(~F.col("promoted"), "failed")
        .otherwise("completed")
    )
    return df.withColumn("status", status).withColumn("snapshot", (F.col("status") == "completed") & (F.col("n_optical") > 0))


def run_summary(results: DataFrame, status: str = "status", observations: str = "n_obs") -> DataFrame:
    """SNK7, AG19: one row of totals; -1 observations means unverified; the skip rate is over attempted lands."""
    n = F.col(observations)
    s = F.col(status)
    attempted = F.count_if(s != "unchanged")
    return results.agg(
        F.count("*").alias("lands"),
        F.count_if(s == "completed").alias("completed"),
        F.count_if(s == "failed").alias("failed"),
        F.count_if(~s.isin("completed", "failed", "unchanged")).alias("no_data"),
        F.count_if(s == "unchanged").alias("unchanged"),
        F.coalesce(F.sum(F.when(n >= 0, n)), F.lit(0)).cast("long").alias("observations"),
        F.count_if(n < 0).alias("unverified"),
        F.round(F.coalesce(100.0 * F.try_divide(F.count_if(~s.isin("completed", "failed", "unchanged")), attempted), F.lit(0.0)), 1).alias("skip_rate_pct"),
    )


def reason_counts(df: DataFrame, reason: str) -> DataFrame:
    """AG18: rows by the first word of the reason."""
    return df.where(F.col(reason).isNotNull()).groupBy(F.substring_index(reason, " ", 1).alias("reason")).agg(F.count("*").alias("n"))


def exit_code(observations: int, unchanged: int, promotion_failed: int) -> int:
    """SM8: 2 when nothing was observed and no land is unchanged (an outage), 3 when accepted rows were not promoted, else 0, a
    quiet night included; an exception of the job is 1."""
    if observations == 0 and unchanged == 0:
        return 2
    return 3 if promotion_failed else 0


def superseded(df: DataFrame, land: str, date: str, method: str, row_id: str, good: str) -> DataFrame:
    """JN15: rows of another method for which the good method has a row of the same land and day."""
    better = df.where(F.col(method) == good).select(land, date).distinct()
    return df.where(F.col(method) != good).join(better, [land, date], "left_semi").select(row_id)


def repair_from_newest(lands: DataFrame, rows: DataFrame, key: str, row_key: str, order: Sequence[str], value: str) -> DataFrame:
    """JN14: each land's value from its newest row that has one."""
    best = rows.where(F.col(value).isNotNull()).groupBy(F.col(row_key).alias(key)).agg(F.max_by(value, F.struct(*order)).alias("new_value"))
    return lands.join(best, key, "left")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG22."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """SNK10: rows that pass all rules, and the others with the names of those they break."""
    broken = F.filter(F.array(*[F.when(~c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    marked = df.withColumn("broken_rules", broken)
    return marked.where(F.size("broken_rules") == 0).drop("broken_rules"), marked.where(F.size("broken_rules") > 0)


def dedupe_tiles(scenes: DataFrame, key: Sequence[str], contains: str, overlap: str, order: str) -> DataFrame:
    """JN8: one item of each acquisition: the tile that contains the field, then the larger overlap, then input order."""
    score = F.when(F.col(contains), 2.0 + F.col(overlap)).otherwise(F.col(overlap))
    w = Window.partitionBy(*key).orderBy(score.desc(), F.col(order).asc())
    return scenes.withColumn("pick", F.row_number().over(w)).where("pick = 1").drop("pick")
