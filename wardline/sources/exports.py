"""Publishing of the small export files: a folder per run, checks, and a manifest that points to it."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from wardline.context import RunContext
from wardline.fixed_values import EXPORT_KEYS, EXPORT_REQUIRED, MAX_EXPORT_BYTES
from wardline.operators.quality import null_counts
from wardline.sources import files


def contract_errors(
    df: DataFrame,
    name: str,
    size: int | None = None,
    limit: int = MAX_EXPORT_BYTES,
) -> tuple[list[str], int]:
    """Violations of the export's contract, and its row count, from one pass over the data."""
    missing = [c for c in EXPORT_REQUIRED[name] if c not in df.columns]
    if missing:
        return [f"{name}: missing columns {missing}"], 0
    counts = null_counts(df, EXPORT_KEYS[name]).first().asDict()
    rows = counts.pop("rows")
    errors = [f"{name}: {n} NULLs in {c}" for c, n in counts.items() if n]
    if not rows:
        errors.append(f"{name}: no rows")
    if size is not None and size >= limit:
        errors.append(f"{name}: {size} bytes, limit {limit}")
    return errors, rows


def write_export(spark: SparkSession, df: DataFrame, name: str, folder: str, limit: int = MAX_EXPORT_BYTES) -> str:
    """Write the export below the run's folder: one file within `limit`, as written beyond it.

    It is computed and written in parallel first. Only rows proven to be within the size limit are
    gathered into a single file; whether a larger export may be published is `publish`'s to say.
    """
    parts, path = f"{folder}/_parts/{name}", f"{folder}/{name}.parquet"
    df.write.mode("overwrite").parquet(parts)
    if files.size_of(spark, parts) >= limit:
        files.rename(spark, parts, path)
        return path
    one_file = spark.read.parquet(parts).coalesce(1)
    one_file.write.mode("overwrite").option("compression", "snappy").parquet(path)
    files.delete(spark, parts)
    return path


def manifest_path(base: str) -> str:
    return f"{base}/latest/manifest.json"


def publish(
    spark: SparkSession,
    exports: Mapping[str, DataFrame],
    base: str,
    ctx: RunContext,
    limit: int = MAX_EXPORT_BYTES,
    allow_parts: bool = False,
) -> dict:
    """Write and check all exports in a folder of the run, then switch to it by its manifest.

    The manifest is the only thing that changes in place, so a reader sees all exports of one run,
    before, during and after a publish. Nothing is switched unless every written export meets its
    contract, its size included; `allow_parts` lets larger ones through as several files, with a
    warning. The folder of the run before stays for its readers; older ones go.
    """
    folder = f"{base}/runs/{ctx.run_ts.strftime('%Y%m%d_%H%M%S')}_{uuid.uuid4().hex[:8]}"
    before = _manifest(spark, base)
    paths = {n: write_export(spark, df, n, folder, limit) for n, df in exports.items()}
    found = {n: _state(spark, n, path, limit) for n, path in paths.items()}
    errors = []
    for name, state in found.items():
        oversized = state["bytes"] >= limit
        if oversized and allow_parts:
            text = f"{name}: {state['bytes']} bytes, limit {limit}; published as several files"
            warnings.warn(text, stacklevel=2)
        errors += state.pop("errors")
        if oversized and not allow_parts:
            errors.append(f"{name}: {state['bytes']} bytes, limit {limit}")
    if errors:
        files.delete(spark, folder)
        raise ValueError("export checks failed: " + "; ".join(errors))
    manifest = {
        "run_id": ctx.run_id,
        "published_at": ctx.run_ts.isoformat(),
        "limit": limit,
        "folder": folder,
        "before": before["folder"] if before else None,
        "exports": found,
    }
    files.write_text(spark, manifest_path(base), files.to_json(manifest))
    named = {folder.rsplit("/", 1)[1], before["folder"].rsplit("/", 1)[1] if before else None}
    for old in files.matching(spark, f"{base}/runs/*"):
        if old.rsplit("/", 1)[1] not in named:
            files.delete(spark, old)
    return manifest


def _state(spark: SparkSession, name: str, path: str, limit: int) -> dict:
    """What is stored of an export, from one pass over the written file."""
    errors, rows = contract_errors(spark.read.parquet(path), name)
    return {"path": path, "rows": rows, "bytes": files.size_of(spark, path), "errors": errors}


def _manifest(spark: SparkSession, base: str) -> dict | None:
    return files.from_json(files.read_text(spark, manifest_path(base)))


def load_exports(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The published exports by name, all of one run."""
    manifest = _manifest(spark, base)
    if manifest is None:
        raise ValueError(f"nothing was published at {base}")
    return {n: spark.read.parquet(e["path"]) for n, e in manifest["exports"].items()}


def export_states(spark: SparkSession, base: str) -> DataFrame:
    """Each published export checked again as it lies there: export, rows, within_limit, problems.

    A consumer runs this before it takes the files: rows and sizes must be those of the manifest.
    """
    manifest = _manifest(spark, base)
    if manifest is None:
        raise ValueError(f"nothing was published at {base}")
    out = []
    for name, said in manifest["exports"].items():
        if not files.exists(spark, said["path"]):
            out.append((name, 0, False, [f"{name}: missing"]))
            continue
        now = _state(spark, name, said["path"], manifest["limit"])
        problems = now["errors"] + [
            f"{name}: {now[k]} {k}, published with {said[k]}" for k in ("rows", "bytes") if now[k] != said[k]
        ]
        out.append((name, now["rows"], now["bytes"] < manifest["limit"], problems))
    return spark.createDataFrame(out, "export string, rows long, within_limit boolean, problems array<string>")
