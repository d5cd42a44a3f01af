"""The whole flow in order: staged tables, monthly measures, dimensions, fact, marts, history,
exports and checks. Order is the order of the calls; each layer is written and read back, so
no plan reaches further back than the layer below it.

    root/silver/<source>        staged rows by month and bucket of the key
    root/monthly/<source>       measures by month
    root/gold/<dim|fact>        dimensions, fact by month
    root/marts/<mart>           marts by month
    root/history                type-2 history: open and closed rows
    root/exports                published files
    root/state                  high-water marks

All but the dimensions are versioned tables (see `sources/versions.py`): a layer changes in one
commit, and readers keep to the version they opened.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline.context import RunContext, utc
from wardline.functions import Months, lookback_floor, with_gold_audit
from wardline.operators import history, quality, upsert
from wardline.plans import analysis, contract, dims, fact, kpi, marts, monthly, staging
from wardline.sources import files
from wardline.sources.exports import publish
from wardline.sources.tables import register_table, scan_nonempty, schema_for
from wardline.sources.versions import VersionedTable

KEYS = {
    "complaints": ("complaint_id",),
    "arrests": ("arrest_id",),
    "permits": ("permit_key",),
    "inspections": ("inspection_record_key",),
}


#: Raw tables and the sources whose freshness bounds they have.
FRESH_SOURCES = {"complaints": "service_requests", "arrests": "arrests", "permits": "permits", "inspections": "inspections"}
GOLD = ("zip_codes", "complaint_types", "permit_types", "dates", "fact")


@dataclass
class Pipeline:
    """One city's tables under `root`, updated by `run`."""

    spark: SparkSession
    root: str
    ctx: RunContext
    polygons: DataFrame | None
    zip_seed: DataFrame
    cell: float = 0.01
    # Buckets of each month of the staged tables, fixed by the first run (see `upsert.BUCKETS`).
    buckets: int = upsert.BUCKETS
    first_month: str = fv.FIRST_MONTH
    # Reference files of the types; without them the types come from the data.
    complaint_types: DataFrame | None = None
    permit_types: DataFrame | None = None
    # Hours until a source counts as late and as stale, where they differ from the fixed ones.
    fresh_hours: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    # Exports above the size limit stop a publish unless they may be several files.
    allow_parts: bool = False

    def run(self, raw: Mapping[str, DataFrame], full_refresh: bool = False) -> dict:
        """Bring every layer up to date with `raw` (source name -> raw table). The first run
        and a full refresh rebuild all months, later runs those within the lookback."""
        incremental = not full_refresh and bool(files.matching(self.spark, f"{self.root}/gold/fact/versions/*.json"))
        for name in KEYS:
            self.stage(name, raw[name], full_refresh)
        self.measure(incremental)
        self.dimensions()
        self.combine(incremental)
        measured = files.to_json(self._staged_folders())
        files.write_text(self.spark, f"{self.root}/state/measured.json", measured)
        self.keep_history()
        warnings = quality.enforce(self.check(raw))
        manifest = publish(self.spark, self.exports(), f"{self.root}/exports", self.ctx, allow_parts=self.allow_parts)
        return {"incremental": incremental, "warnings": warnings, "manifest": manifest}

    def read(self, layer: str, name: str) -> DataFrame:
        path = f"{self.root}/{layer}/{name}"
        if layer == "gold" and name != "fact":
            return self.spark.read.parquet(path)
        if layer == "silver":
            return upsert.keyed_table(self.spark, path).read().drop(upsert.BUCKET)
        return VersionedTable(self.spark, path, (upsert.MONTH,)).read()

    def silver(self) -> dict[str, DataFrame]:
        return {name: self.read("silver", name) for name in KEYS}

    # --- layers -------------------------------------------------------------------------

    def stage(self, name: str, raw: DataFrame, full_refresh: bool = False) -> None:
        """Stage the rows loaded since the last run and merge them by key."""
        build: Mapping[str, Callable[[DataFrame], DataFrame]] = {
            "complaints": lambda r: staging.stage_complaints(r, self.ctx),
            "arrests": lambda r: staging.stage_arrests(r, self.ctx, self.polygons, self.cell),
            "permits": lambda r: staging.stage_permits(r, self.ctx),
            "inspections": lambda r: staging.stage_inspections(r, self.ctx),
        }
        path, state = f"{self.root}/silver/{name}", f"{self.root}/state/{name}.json"
        mark = None
        if not full_refresh:
            stored = files.from_json(files.read_text(self.spark, state))
            mark = dt.datetime.fromisoformat(stored["high_water"]) if stored else None  # UTC
        new = staging.new_rows(raw, mark)
        # As UTC text: a datetime would come back in the driver's own zone.
        shown = F.date_format(F.max("_ingested_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        newest = quality.newest_day(new).agg(shown).first()[0]
        if newest is None:
            return
        newest = dt.datetime.fromisoformat(newest)
        # Rows that arrive while this runs belong to the next run.
        rows = build[name](new.filter(F.col("_ingested_at") <= utc(newest)))
        if mark is None:
            upsert.rewrite(self.spark, path, rows, KEYS[name], self.buckets)
        else:
            upsert.upsert(self.spark, path, rows, KEYS[name], self.buckets)
        # A run that dies before this line merges the same rows again, which changes nothing.
        files.write_text(self.spark, state, files.to_json({"high_water": newest.isoformat()}))

    def measure(self, incremental: bool) -> None:
        silver = self.silver()
        near, far = self.floors(incremental)
        tables = {
            "complaints": monthly.monthly_complaints(silver["complaints"], near),
            "arrests": monthly.monthly_arrests(silver["arrests"], far),
            "permits": monthly.monthly_permits(silver["permits"], near, self.ctx.as_of),
            "inspections": monthly.monthly_inspections(silver["inspections"], near),
        }
        for name, df in tables.items():
            self._put("monthly", name, df, far if name == "arrests" else near)
        pairs = monthly.complaints_with_permits(
            self.read("monthly", "complaints"), self.read("monthly", "permits"), near
        )
        self._put("monthly", "complaint_permit", pairs, near)

    def dimensions(self) -> None:
        silver = self.silver()
        self._put_dim("zip_codes", dims.dim_zip_codes(self.zip_seed, silver.values()))
        self._put_dim("dates", dims.dim_date(self.spark, self.ctx.as_of, self.first_month))
        complaints, permits = self.complaint_types, self.permit_types
        if complaints is None:
            complaints = analysis.complaint_type_seed(silver["complaints"])
        if permits is None:
            permits = analysis.permit_type_seed(silver["permits"])
        self._put_dim("complaint_types", dims.dim_complaint_types(complaints))
        self._put_dim("permit_types", dims.dim_permit_types(permits))

    def combine(self, incremental: bool) -> None:
        """Fact and marts. Those fed by arrests use the longer lookback of the arrests."""
        near, far = self.floors(incremental)
        month = {n: self.read("monthly", n) for n in KEYS}
        zips, dates = self.read("gold", "zip_codes"), self.read("gold", "dates")
        rows = fact.fact_neighborhood_monthly(
            zips,
            dates,
            month["complaints"],
            month["arrests"],
            month["permits"],
            month["inspections"],
            far,
        )
        self._put("gold", "fact", with_gold_audit(rows, "fact", self.ctx), far)
        plain = {
            # Month flags move with the run date, so all months are written again.
            "pulse": (None, marts.mart_neighborhood_pulse(
                self.read("gold", "fact").drop(*fv.GOLD_AUDIT_COLUMNS),
                zips.drop(*fv.GOLD_AUDIT_COLUMNS),
                dates.drop(*fv.GOLD_AUDIT_COLUMNS),
                None,
            )),
            "safety": (far, marts.mart_safety_infrastructure(month["arrests"], month["permits"], far)),
            "food": (near, marts.mart_food_compliance(month["inspections"], month["complaints"], near)),
            "top_types": (near, marts.mart_top_complaints(self.read("silver", "complaints"), near)),
        }
        for name, (since, df) in plain.items():
            self._put("marts", name, with_gold_audit(df, name, self.ctx), since)

    def keep_history(self) -> None:
        """Add this run to the restaurant history. Runs go forward in time; a repeated one
        changes nothing."""
        current = analysis.current_restaurants(self.read("silver", "inspections"))
        history.add_run(
            self.spark, f"{self.root}/history", current, "restaurant_id", analysis.RESTAURANT_CHECKED,
            self.ctx.run_ts, self.ctx.run_id,
        )

    def restaurant_history(self) -> DataFrame:
        return history.read_history(self.spark, f"{self.root}/history")

    def exports(self) -> dict[str, DataFrame]:
        """What is published: the marts without audit columns. An empty one stops the run."""
        return kpi.all_exports(
            *[scan_nonempty(self.read("marts", n), n) for n in ("pulse", "safety", "food", "top_types")]
        )

    def register(self) -> list[str]:
        """The dimensions as external tables of the gold schema; repeating it changes nothing."""
        names = [n for n in GOLD if n != "fact"]
        return [register_table(self.spark, schema_for("gold"), n, f"{self.root}/gold/{n}") for n in names]

    def check(self, raw: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """All data-quality checks over the stored tables, one row each; with `raw` also how fresh
        its sources are."""
        tables = self.silver()
        tables |= {f"monthly_{n}": self.read("monthly", n) for n in KEYS}
        tables["complaints_with_permits"] = self.read("monthly", "complaint_permit")
        tables |= {n: self.read("gold", n) for n in GOLD}
        tables |= {n: self.read("marts", n) for n in ("pulse", "safety", "food", "top_types")}
        checks = contract.check_tables(tables, self.ctx.as_of)
        if raw is not None:
            checks = checks.unionByName(quality.freshness_checks(self.freshness(raw)))
        return checks

    def freshness(self, raw: Mapping[str, DataFrame]) -> DataFrame:
        """The newest load of each source against its own bounds, from its newest day alone."""

        def one(name: str, source: str) -> DataFrame:
            hours = self.fresh_hours.get(source, fv.FRESHNESS_HOURS[source])
            return quality.freshness(quality.newest_day(raw[name]), source, self.ctx.run_ts, *hours)

        return reduce(DataFrame.unionByName, [one(n, s) for n, s in FRESH_SOURCES.items()])

    # --- helpers ------------------------------------------------------------------------

    def floors(self, incremental: bool) -> tuple[Months | None, Months | None]:
        """Months to work out anew: for most tables, and for those fed by arrests.

        Those of the lookback, and any earlier one in which staged rows came, changed or left
        since the measures were last complete.
        """
        if not incremental:
            return None, None
        known = files.from_json(files.read_text(self.spark, f"{self.root}/state/measured.json"))
        if known is None:
            return None, None
        also: frozenset[str] = frozenset()
        for name, folders in self._staged_folders().items():
            also |= upsert.changed_months(known.get(name, ()), folders)
        return (
            Months(lookback_floor(self.ctx.as_of, fv.LOOKBACK_DAYS), also),
            Months(lookback_floor(self.ctx.as_of, fv.ARREST_LOOKBACK_DAYS), also),
        )

    def _staged_folders(self) -> dict[str, list[str]]:
        tables = {n: upsert.keyed_table(self.spark, f"{self.root}/silver/{n}").version() for n in KEYS}
        return {n: list(v.folders) for n, v in tables.items()}

    def _put(self, layer: str, name: str, df: DataFrame, since: str | Months | None) -> None:
        upsert.replace_months(self.spark, f"{self.root}/{layer}/{name}", df, since)

    def _put_dim(self, name: str, df: DataFrame) -> None:
        with_gold_audit(df, f"dim_{name}", self.ctx).write.mode("overwrite").parquet(
            f"{self.root}/gold/{name}"
        )

