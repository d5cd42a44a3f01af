"""Raw string tables -> typed, cleaned, deduplicated staged tables.

Each source is described by a table of columns (raw name, staged name, kind) plus its few
derived columns; one projection applies both. Dedup comes first, so the spatial join and all
casts see one row per key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline.context import RunContext, utc
from wardline.functions import (
    clean_text,
    grade_number,
    hours_between,
    law_category,
    normalize_grade,
    normalize_status,
    standardize_borough,
    surrogate_key,
    tolerant,
    with_staging_audit,
    year_month,
)
from wardline.functions.keys import KEY_NULL
from wardline.operators.dedup import first_per_key, keep_latest
from wardline.operators.spatial import assign_zip

TEXT = "text"
ZIP = "zip"
NUMERIC = "decimal(10,0)"
#: Characters of a row's hash that go through the dedup's shuffle: of hex, one row in 65,536 ties.
HASH_START = 4


@dataclass(frozen=True)
class Source:
    """A raw table: its key, and its columns as raw name -> (staged name, kind)."""

    keys: Sequence[str]
    columns: Mapping[str, tuple[str, str]]
    also_read: Sequence[str] = ()

    @property
    def raw_columns(self) -> list[str]:
        return list(dict.fromkeys([*self.keys, *self.columns, *self.also_read]))


# Source column names and their staged names.
COMPLAINTS = Source(
    keys=("unique_key",),
    columns={
        "unique_key": ("complaint_id", "bigint"),
        "created_date": ("created_date", "timestamp"),
        "closed_date": ("closed_date", "timestamp"),
        "resolution_action_updated_date": ("resolution_action_updated_date", "timestamp"),
        "agency": ("responding_agency_code", TEXT),
        "complaint_type": ("complaint_type", TEXT),
        "descriptor": ("complaint_descriptor", TEXT),
        "location_type": ("location_type", TEXT),
        "resolution_description": ("resolution_description", TEXT),
        "open_data_channel_type": ("submission_channel", TEXT),
        "incident_address": ("incident_address", TEXT),
        "street_name": ("street_name", TEXT),
        "cross_street_1": ("cross_street_1", TEXT),
        "cross_street_2": ("cross_street_2", TEXT),
        "city": ("city", TEXT),
        "community_board": ("community_board", TEXT),
        "council_district": ("council_district", TEXT),
        "police_precinct": ("police_precinct", TEXT),
        "incident_zip": ("zip_code", ZIP),
        "bbl": ("borough_block_lot", NUMERIC),
        "latitude": ("latitude", "double"),
        "longitude": ("longitude", "double"),
    },
    also_read=("status", "borough"),
)

ARRESTS = Source(
    keys=("arrest_key",),
    columns={
        "arrest_key": ("arrest_id", "bigint"),
        "arrest_date": ("arrest_date", "date"),
        "pd_cd": ("nypd_classification_code", "int"),
        "ky_cd": ("offense_category_code", "int"),
        "arrest_precinct": ("arrest_precinct", "int"),
        "pd_desc": ("nypd_classification_desc", TEXT),
        "ofns_desc": ("offense_description", TEXT),
        "law_code": ("penal_law_code", TEXT),
        "arrest_boro": ("arrest_borough_raw", TEXT),
        "perp_race": ("perpetrator_race", TEXT),
        "latitude": ("latitude", "double"),
        "longitude": ("longitude", "double"),
    },
    also_read=("law_cat_cd", "age_group", "perp_sex"),
)

PERMITS = Source(
    keys=("job__", "permit_sequence__"),
    columns={
        "job__": ("job_number", TEXT),
        "permit_sequence__": ("permit_sequence_number", TEXT),
        "bin__": ("building_id_number", TEXT),
        "job_doc___": ("job_document_number", TEXT),
        "job_type": ("job_type", TEXT),
        "self_cert": ("is_self_certified", TEXT),
        "borough": ("borough_raw", TEXT),
        "house__": ("house_number", TEXT),
        "street_name": ("street_name", TEXT),
        "block": ("tax_block", TEXT),
        "lot": ("tax_lot", TEXT),
        "community_board": ("community_board", TEXT),
        "bldg_type": ("building_type", TEXT),
        "gis_council_district": ("council_district", TEXT),
        "gis_census_tract": ("census_tract", TEXT),
        "gis_nta_name": ("neighborhood_name", TEXT),
        "work_type": ("work_type", TEXT),
        "permit_status": ("permit_status", TEXT),
        "filing_status": ("filing_status", TEXT),
        "permit_type": ("permit_type", TEXT),
        "permit_subtype": ("permit_subtype", TEXT),
        "non_profit": ("is_non_profit", TEXT),
        "owner_s_business_type": ("owner_business_type", TEXT),
        "owner_s_business_name": ("owner_business_name", TEXT),
        "permittee_s_business_name": ("permittee_business_name", TEXT),
        "permittee_s_license_type": ("permittee_license_type", TEXT),
        "zip_code": ("zip_code", ZIP),
        "gis_latitude": ("latitude", "double"),
        "gis_longitude": ("longitude", "double"),
        "filing_date": ("filing_date", "date"),
        "issuance_date": ("issuance_date", "date"),
        "expiration_date": ("expiration_date", "date"),
        "job_start_date": ("job_start_date", "date"),
    },
)

INSPECTIONS = Source(
    keys=("camis", "inspection_date", "violation_code", "inspection_type"),
    columns={
        "camis": ("restaurant_id", TEXT),
        "violation_code": ("violation_code", TEXT),
        "inspection_type": ("inspection_type", TEXT),
        "dba": ("restaurant_name", TEXT),
        "cuisine_description": ("cuisine_type", TEXT),
        "boro": ("borough_raw", TEXT),
        "building": ("building_number", TEXT),
        "street": ("street_name", TEXT),
        "community_board": ("community_board", TEXT),
        "council_district": ("council_district", TEXT),
        "census_tract": ("census_tract", TEXT),
        "bin": ("building_id_number", TEXT),
        "nta": ("neighborhood_tabulation_area", TEXT),
        "action": ("enforcement_action", TEXT),
        "violation_description": ("violation_description", TEXT),
        "critical_flag": ("is_critical_violation", TEXT),
        "zipcode": ("zip_code", ZIP),
        "inspection_date": ("inspection_date", "date"),
        "grade_date": ("grade_assigned_date", "date"),
        "bbl": ("borough_block_lot", NUMERIC),
        "latitude": ("latitude", "double"),
        "longitude": ("longitude", "double"),
        "score": ("inspection_score", "int"),
    },
    also_read=("grade",),
)


@dataclass(frozen=True)
class RawRows:
    """A raw table whose text is still to be made: narrow `rows`, and the raw columns as SQL over them.

    Staging accepts it in place of the written-out table. Only the narrow rows, their key, load time
    and the start of the hash then go through the dedup's sorts and its shuffle; text is made of the
    rows that stay.
    `alike` names what counts and orders as some of these do, in fewer bytes, as SQL over the rows:
    a number for its text. `lookup` adds to rows, by joins that keep each as one, what the text also
    needs and the key, time and hash do not. `latest` says that there is one row per key already.
    """

    rows: DataFrame
    columns: Mapping[str, str]
    alike: Mapping[str, str] = field(default_factory=dict)
    lookup: Callable[[DataFrame], DataFrame] = lambda rows: rows
    latest: bool = False

    def text(self, *names: str) -> DataFrame:
        """The raw columns of these names, by default all."""
        return self.lookup(self.rows).select(*[F.expr(self.columns[n]).alias(n) for n in names or self.columns])

    def where(self, test: Column, *names: str) -> RawRows:
        """The rows that pass a test of the raw columns `names`."""
        placed = self.rows.withColumns({n: F.expr(self.columns[n]) for n in names})
        return replace(self, rows=placed.filter(test).drop(*names))

    def of(self, rows: DataFrame, latest: bool = True) -> RawRows:
        """The same raw columns over other rows of the same kind."""
        return replace(self, rows=rows, latest=latest)

    def replacing(self, columns: Mapping[str, str]) -> RawRows:
        """Some raw columns made otherwise; what stood for them does no longer."""
        alike = {n: x for n, x in self.alike.items() if n not in columns}
        return replace(self, columns={**self.columns, **columns}, alike=alike)

    def latest_rows(self, source: Source) -> RawRows:
        """The latest row per key, still narrow. The start of the hash settles almost all equal load times
        before the shuffle; the whole one, made again of the rows behind it, settles the rest."""
        if self.latest:
            return self
        held = self.rows.columns
        names = [*source.keys, "_ingested_at"]
        # A column that stands for another goes through the shuffle once.
        at = {n: self.alike[n] if self.alike.get(n) in held else n for n in names}
        rows = self.rows.withColumns({n: F.expr(self.alike.get(n, self.columns[n])) for n in names if at[n] == n})
        row_hash = F.expr(self.columns["_row_hash"])
        rows = rows.withColumn("_hash_start", F.substring(row_hash, 1, HASH_START))
        keyed, keys = typed_keys(rows, source, [k for k in source.keys if k not in self.alike])
        keys += [at[k] for k in source.keys if k in self.alike]
        newest = keep_latest(keyed, keys, at["_ingested_at"], ("_hash_start",), ties=True)
        kept = first_per_key(newest, keys, [row_hash.asc_nulls_last()])
        return replace(self, rows=kept.select(*held), latest=True)


def new_rows(raw: DataFrame | RawRows, high_water: dt.datetime | None) -> DataFrame | RawRows:
    """Rows ingested after the newest one already staged; all rows on a first run. The bound on the
    ingest date lets a partitioned raw table skip all older days."""
    if high_water is None:
        return raw
    day = F.col("_ingest_date")
    recent = day.isNull() | (day >= high_water.strftime("%Y-%m-%d"))
    newer = recent & (F.col("_ingested_at") > utc(high_water))
    return raw.where(newer, "_ingest_date", "_ingested_at") if isinstance(raw, RawRows) else raw.filter(newer)


def typed_keys(rows: DataFrame, source: Source, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows with what these keys count by, and the names of its columns.

    Keys count by their typed value, so `1` and ` 1` are one; a text without one is its own key.
    """
    typed = {k: source.columns[k][1] for k in keys if source.columns.get(k, (k, TEXT))[1] in ("bigint", "int")}
    names = {k: f"_key_{k}" for k in typed}
    keyed = rows.withColumns(
        {names[k]: F.coalesce(tolerant(F.col(k), kind).cast("string"), F.col(k)) for k, kind in typed.items()}
    )
    return keyed, [names.get(k, k) for k in keys]


def base_rows(raw: DataFrame | RawRows, source: Source) -> DataFrame:
    """Needed columns only (the others, personal data among them, stop here), latest per key."""
    needed = [*source.raw_columns, *fv.CARRIED_COLUMNS]
    if isinstance(raw, RawRows):
        return raw.latest_rows(source).text(*needed)
    keyed, keys = typed_keys(raw.select(*needed), source, source.keys)
    return keep_latest(keyed, keys).select(*needed)


def project(
    base: DataFrame, source: Source, derived: Mapping[str, Column], strict: bool, keep_zip: bool
) -> DataFrame:
    """Renamed and typed columns, then the derived ones, then the carried lineage.

    `strict` turns null tokens into NULL in every text column; by default only zips are
    cleaned, and `keep_zip` leaves even those as they come.
    """
    tokens = fv.STRICT_TOKENS if strict else ()
    zip_tokens = () if keep_zip and not strict else fv.STRICT_TOKENS

    def typed(raw: str, kind: str) -> Column:
        if kind == TEXT:
            return clean_text(F.col(raw), tokens)
        if kind == ZIP:
            return clean_text(F.col(raw), zip_tokens)
        return tolerant(F.col(raw), kind)

    return base.select(
        *[typed(raw, kind).alias(name) for raw, (name, kind) in source.columns.items()],
        *[column.alias(name) for name, column in derived.items()],
        *fv.CARRIED_COLUMNS,
    )


def stage_complaints(
    raw: DataFrame | RawRows, ctx: RunContext, strict: bool = False, keep_zip: bool = False
) -> DataFrame:
    created = tolerant(F.col("created_date"), "timestamp")
    closed = tolerant(F.col("closed_date"), "timestamp")
    derived = {
        "complaint_status": normalize_status(F.col("status")),
        "borough_raw": clean_text(F.col("borough"), fv.BLANK_BOROUGH_TOKENS),
        "borough": standardize_borough(F.col("borough")),
        "resolution_time_hours": hours_between(created, closed),
        "year_month": year_month(created),
    }
    staged = project(base_rows(raw, COMPLAINTS), COMPLAINTS, derived, strict, keep_zip)
    return with_staging_audit(staged, "stg_service_requests", ctx)


def stage_arrests(
    raw: DataFrame | RawRows,
    ctx: RunContext,
    polygons: DataFrame | None,
    cell: float = 0.01,
    strict: bool = False,
) -> DataFrame:
    def unredacted(name: str) -> Column:
        return F.nullif(F.trim(name), F.lit(fv.REDACTED))

    derived = {
        "law_category": law_category(F.col("law_cat_cd")),
        "borough": standardize_borough(F.col("arrest_boro")),
        "perpetrator_age_group": unredacted("age_group"),
        "perpetrator_sex": unredacted("perp_sex"),
        "year_month": year_month(tolerant(F.col("arrest_date"), "date")),
    }
    typed = project(base_rows(raw, ARRESTS), ARRESTS, derived, strict, False)
    placed = assign_zip(typed, polygons, cell=cell)
    return with_staging_audit(placed, "stg_arrests", ctx)


def is_active(expiration: Column, as_of: dt.date) -> Column:
    return F.when(expiration >= F.lit(as_of), 1).otherwise(0)


def stage_permits(
    raw: DataFrame | RawRows, ctx: RunContext, strict: bool = False, keep_zip: bool = False
) -> DataFrame:
    derived = {
        "permit_key": surrogate_key(F.col("job__"), F.col("permit_sequence__")),
        "borough": standardize_borough(F.col("borough")),
        "is_active_permit": is_active(tolerant(F.col("expiration_date"), "date"), ctx.as_of),
        "year_month": year_month(tolerant(F.col("issuance_date"), "date")),
    }
    staged = project(base_rows(raw, PERMITS), PERMITS, derived, strict, keep_zip)
    return with_staging_audit(staged, "stg_permits", ctx)


#: What a permit's key is made of, as text that is never NULL.
PERMIT_ROW = ("permit_job", "permit_sequence")


def keyed_permits(raw: RawRows) -> DataFrame:
    """The latest row per permit, still narrow, with the parts of its key and its month: what a
    stored table is merged and laid out by."""
    kept = raw.latest_rows(PERMITS)
    job, sequence, issued = (F.expr(kept.columns[n]) for n in (*PERMITS.keys, "issuance_date"))
    return kept.rows.withColumns(
        {
            PERMIT_ROW[0]: F.coalesce(job, F.lit(KEY_NULL)),
            PERMIT_ROW[1]: F.coalesce(sequence, F.lit(KEY_NULL)),
            "year_month": year_month(tolerant(issued, "date")),
        }
    )


def stage_inspections(
    raw: DataFrame | RawRows, ctx: RunContext, strict: bool = False, keep_zip: bool = False
) -> DataFrame:
    derived = {
        "inspection_record_key": surrogate_key(*[F.col(k) for k in INSPECTIONS.keys]),
        "borough": standardize_borough(F.col("boro")),
        "inspection_grade": normalize_grade(F.col("grade")),
        "grade_numeric": grade_number(F.col("grade")),
        "year_month": year_month(tolerant(F.col("inspection_date"), "date")),
    }
    staged = project(base_rows(raw, INSPECTIONS), INSPECTIONS, derived, strict, keep_zip)
    return with_staging_audit(staged, "stg_inspections", ctx)
