"""Settings, health checks, resource gates and telemetry of an installation."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import SparkSession

from marlstone.functions.scalars import redacted

# The folders of a data root.
FOLDERS = ("raw", "normalized", "derived", "quarantine", "control/manifests", "control/checkpoints", "control/gap_registry", "control/deletion_ledger", "control/instrument_metadata", "control/catalog", "control/ingestion_runs")


@dataclass(frozen=True)
class Config:
    """Settings, strictly typed. Disk thresholds in GiB must descend: below ``warn`` a warning, below ``degrade`` less work, below ``stop`` none."""

    data_root: str
    timezone: str = "UTC"
    schema_version: str = "2.1.0"
    log_level: str = "INFO"
    warn_gib: float = 80.0
    degrade_gib: float = 50.0
    stop_gib: float = 20.0

    def __post_init__(self) -> None:
        for f in fields(self):
            value, want = getattr(self, f.name), {"str": str, "float": (int, float)}[str(f.type)]
            if not isinstance(value, want) or isinstance(value, bool):
                raise ValueError(f"{f.name}: {value!r} is no {f.type}")
        if not self.data_root:
            raise ValueError("data_root is empty")
        if not self.warn_gib > self.degrade_gib > self.stop_gib >= 0:
            raise ValueError("disk thresholds must descend")


def load(path: str, environment: Mapping[str, str] | None = None) -> Config:
    """Settings of a JSON file; unknown ones are refused. MARLSTONE_LOG_LEVEL and MARLSTONE_DATA_ROOT override theirs."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    if unknown := set(given) - {f.name for f in fields(Config)}:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    config = Config(**given)
    found = os.environ if environment is None else environment
    return replace(config, **{n: found[f"MARLSTONE_{n.upper()}"] for n in ("log_level", "data_root") if found.get(f"MARLSTONE_{n.upper()}")})


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folders(spark: SparkSession, config: Config) -> list[str]:
    """Make the data root's folders; those that were new."""
    made = []
    for name in FOLDERS:
        at, fs = _folder(spark, f"{config.data_root}/{name}")
        if not fs.exists(at):
            fs.mkdirs(at)
            made.append(name)
    return made


def free_gib(spark: SparkSession, path: str) -> float:
    """What the file system that holds ``path`` has left."""
    at, fs = _folder(spark, path)
    while not fs.exists(at) and at.getParent() is not None:
        at = at.getParent()
    return fs.getStatus(at).getRemaining() / (1 << 30)


def disk_tier(free: float, config: Config) -> str:
    return "CRITICAL" if free < config.stop_gib else "DEGRADED" if free < config.degrade_gib else "WARNING" if free < config.warn_gib else "HEALTHY"


def admitted(free: float, parts: Mapping[str, float], reserve: float) -> tuple[bool, float]:
    """Whether a job's parts (in one unit) leave the reserve free, and what they leave."""
    left = free - sum(parts.values())
    return left >= reserve, left


def health(spark: SparkSession, config: Config) -> list[tuple[str, str, str]]:
    """(check, PASS, WARN, FAIL or UNKNOWN, detail) of every local check; nothing is created but a probe that goes again."""
    checks = [("timezone", "PASS" if config.timezone == "UTC" == spark.conf.get("spark.sql.session.timeZone") else "FAIL", f"{config.timezone}, session {spark.conf.get('spark.sql.session.timeZone')}")]
    at, fs = _folder(spark, config.data_root)
    if not fs.exists(at):
        checks += [("data_root", "WARN", "doesn't exist"), ("atomic_rename", "UNKNOWN", "no data root")]
    elif not fs.getFileStatus(at).isDirectory():
        checks.append(("data_root", "FAIL", "isn't a folder"))
    else:
        checks.append(("data_root", "PASS", "exists"))
        one, two = (spark._jvm.org.apache.hadoop.fs.Path(f"{config.data_root}/.probe-{os.getpid()}-{n}") for n in (1, 2))
        try:
            fs.create(one, True).close()
            ok = fs.rename(one, two) and fs.exists(two) and not fs.exists(one)
            checks.append(("atomic_rename", "PASS" if ok else "FAIL", "probe"))
        except Exception as e:
            checks.append(("atomic_rename", "FAIL", type(e).__name__))
        finally:
            for probe in (one, two):
                if fs.exists(probe):
                    fs.delete(probe, False)
        checks.append(("data_size", "PASS", str(fs.getContentSummary(at).getLength())))
    free = free_gib(spark, config.data_root)
    tier = disk_tier(free, config)
    checks.append(("disk_space", {"HEALTHY": "PASS", "WARNING": "WARN", "DEGRADED": "WARN"}.get(tier, "FAIL"), f"{free:.1f} GiB, {tier}"))
    from pyspark.sql import functions as F

    shown = spark.range(1).select(redacted(F.lit("token=probe-secret x probe-secret"), ["token"], known=["probe-secret"])).first()[0]
    checks.append(("redaction", "FAIL" if "probe-secret" in shown else "PASS", shown))
    return checks


def exit_code(checks: list[tuple[str, str, str]]) -> int:
    """2 if a check fails, 1 if one warns, else 0."""
    states = {c[1] for c in checks}
    return 2 if "FAIL" in states else 1 if "WARN" in states else 0


def shown(config: Config) -> str:
    return json.dumps(asdict(config), sort_keys=True)


def telemetry(progress: Mapping[str, object] | None, most_rows: int | None = None) -> dict[str, object]:
    """What a streaming query's last progress says of its queue: utilization, rows behind, and the watermark's lag; APPLICABLE only with a progress.

    utilization is a batch's rows over ``most_rows``, the most a trigger may take, if that is bounded.
    """
    if not progress:
        return {"state": "NOT_APPLICABLE", "utilization": None, "rows": None, "rows_a_second": None, "behind": None, "lag_seconds": None}
    import datetime as dt

    rows = int(progress.get("numInputRows") or 0)
    sources = progress.get("sources") or []
    behind = [int(m["numFilesOutstanding"]) for s in sources if (m := s.get("metrics") or {}).get("numFilesOutstanding") is not None]
    times = progress.get("eventTime") or {}
    parsed = {k: dt.datetime.fromisoformat(v.replace("Z", "+00:00")) for k, v in times.items()}
    lag = (parsed["max"] - parsed["watermark"]).total_seconds() if {"max", "watermark"} <= set(parsed) else None
    return {
        "state": "APPLICABLE", "utilization": round(rows / most_rows, 4) if most_rows else None, "rows": rows, "rows_a_second": progress.get("processedRowsPerSecond"),
        "behind": sum(behind) if behind else None, "lag_seconds": lag,
    }
