"""Incremental refresh of the campaign models as new days of raw sessions land (R9), published as snapshots.

A Structured Streaming file source watches the ``date=``-partitioned raw dataset. Each micro-batch only tells which days
received new files; ``foreachBatch`` recomputes the daily campaign metrics of exactly those days from the stored raw data
(partition-pruned read). All daily measures are per-day, so recomputing whole days is exact. The campaign mart is a roll-up
of the daily table; its distinct-visitor figure is by definition a sum of daily counts, so it needs no sessions.

Nothing that a reader sees is overwritten. A refresh writes under ``<out>``, in this order:

1. ``campaign_daily/version=<v>/session_date=<day>``: the recomputed days;
2. ``mart_campaign_performance/version=<v>``: the mart over the newest version of every day;
3. ``manifests/<v>.json``: which version holds each day and the mart. It is written under another name and renamed, so it is there
   whole or not at all.

A reader takes the newest manifest and reads just the folders that it names. Until step 3 it sees the snapshot before, the
daily table and the mart of one version; a refresh that dies leaves folders that no manifest names, and its repetition writes
them again. A manifest also names the stream and the epoch it comes from, so an epoch that Spark repeats after its manifest was
written does nothing. ``drop_old`` removes what the newest manifests don't name.

The stream's progress lives under the output folder, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.campaign import INT_CAMPAIGN_COLUMNS, daily_campaign_metrics, mart_from_daily
from ..operators.staging import stg_sessions
from ..schemas import RAW_SESSIONS
from ..sources.raw_sessions import files_of, read_sessions

DAILY, MART, MANIFESTS = "campaign_daily", "mart_campaign_performance", "manifests"


def manifests(spark: SparkSession, out_path: str) -> list[int]:
    """Versions with a manifest, ascending."""
    fs, path = files_of(spark, out_path)
    folder = path(f"{out_path}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, out_path: str, version: int | None = None) -> dict | None:
    """The manifest of a version, by default the newest; None before the first refresh."""
    versions = manifests(spark, out_path)
    if not versions:
        return None
    text = spark.read.option("wholetext", True).text(f"{out_path}/{MANIFESTS}/{versions[-1] if version is None else version}.json")
    return json.loads(text.first()[0])


def _publish(spark: SparkSession, out_path: str, entry: dict) -> None:
    fs, path = files_of(spark, out_path)
    final = path(f"{out_path}/{MANIFESTS}/{entry['version']}.json")
    draft = path(f"{out_path}/{MANIFESTS}/.{entry['version']}-{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"another refresh published version {entry['version']}; run this one again")


def _daily(spark: SparkSession, out_path: str, days: dict[str, int]) -> DataFrame:
    """The daily rows of a manifest's days, each from the version that holds it."""
    base = f"{out_path}/{DAILY}"
    folders = [f"{base}/version={v}/session_date={d}" for d, v in sorted(days.items())]
    rows = spark.read.option("basePath", base).parquet(*folders).drop("version")
    return rows.withColumn("session_date", F.col("session_date").cast("date"))


def refresh_days(spark: SparkSession, raw_path: str, out_path: str, days: list[str], start: str | None = None, end: str | None = None,
                 stream: str | None = None, epoch: int | None = None) -> int | None:
    """Recompute the given yyyyMMdd days and publish the next snapshot; returns its version, None if there was nothing to do.
    A bound that is not given holds back no day."""
    days = sorted(d for d in days if (start is None or start <= d) and (end is None or d <= end))
    last = manifest(spark, out_path) or {"version": 0, "days": {}, "epochs": {}}
    if not days or (epoch is not None and last["epochs"].get(stream, -1) >= epoch):
        return None
    version = last["version"] + 1
    raw = read_sessions(spark, raw_path, days[0], days[-1]).where(F.col("date").isin(days))
    daily = daily_campaign_metrics(stg_sessions(raw))
    daily.hint("rebalance", "session_date").write.mode("overwrite").partitionBy("session_date").parquet(f"{out_path}/{DAILY}/version={version}")
    held = {**last["days"], **{f"{d[:4]}-{d[4:6]}-{d[6:]}": version for d in days}}
    entry = {"version": version, "days": held, "epochs": {**last["epochs"], **({stream: epoch} if epoch is not None else {})}}
    mart_from_daily(_daily(spark, out_path, held)).write.mode("overwrite").parquet(f"{out_path}/{MART}/version={version}")
    _publish(spark, out_path, entry)
    return version


def start_campaign_refresh(spark: SparkSession, raw_path: str, out_path: str, start: str | None = None, end: str | None = None,
                           checkpoint: str | None = None, available_now: bool = False, files_per_batch: int = 1000):
    """Start the stream; returns the StreamingQuery. Every day that lands is refreshed unless ``start`` or
    ``end`` (yyyyMMdd, inclusive) says otherwise. ``available_now`` processes what exists and stops."""
    ckpt = checkpoint or f"{out_path}/.stream"

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # The list of days in one batch is small (one entry per day directory).
        days = [r["date"] for r in batch.select("date").distinct().collect()]
        refresh_days(spark, raw_path, out_path, days, start, end, ckpt, epoch_id)

    stream = (spark.readStream.schema(RAW_SESSIONS).option("maxFilesPerTrigger", files_per_batch).parquet(raw_path)
              .select("date"))
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def daily_table(spark: SparkSession, out_path: str, version: int | None = None) -> DataFrame:
    """The daily table of a snapshot, by default the newest."""
    entry = manifest(spark, out_path, version)
    if entry is None:
        raise FileNotFoundError(f"{out_path} has no snapshot yet")
    return _daily(spark, out_path, entry["days"]).select(*INT_CAMPAIGN_COLUMNS)


def mart_table(spark: SparkSession, out_path: str, version: int | None = None) -> DataFrame:
    """The campaign mart of a snapshot, by default the newest."""
    entry = manifest(spark, out_path, version)
    if entry is None:
        raise FileNotFoundError(f"{out_path} has no snapshot yet")
    return spark.read.parquet(f"{out_path}/{MART}/version={entry['version']}")


def drop_old(spark: SparkSession, out_path: str, keep: int = 2) -> list[int]:
    """Remove the manifests but the newest ``keep`` and the folders that these don't name; returns the versions removed.
    Readers still on an older snapshot lose it, so keep as many as a read may last."""
    fs, path = files_of(spark, out_path)
    versions = manifests(spark, out_path)
    old, kept = versions[:-keep], [manifest(spark, out_path, v) for v in versions[-keep:]]
    for v in old:
        fs.delete(path(f"{out_path}/{MANIFESTS}/{v}.json"), False)
    needed = {(f"version={v}", f"session_date={d}") for m in kept for d, v in m["days"].items()}
    for v in old:
        fs.delete(path(f"{out_path}/{MART}/version={v}"), True)
        folder = path(f"{out_path}/{DAILY}/version={v}")
        for day in fs.listStatus(folder) if fs.exists(folder) else ():
            if (f"version={v}", day.getPath().getName()) not in needed:
                fs.delete(day.getPath(), True)
    return old
