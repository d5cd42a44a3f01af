"""Oracle SQL. Each query is hand-written over a set of shared CTEs; only the derivation of
the raw rows (test input, not logic under test) is common with the Spark side."""

from __future__ import annotations

import re

from wardline.plans import star


class Dialect:
    @staticmethod
    def iso(x):
        return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.000')"

    @staticmethod
    def us_date(x):
        return f"strftime({x}, '%m/%d/%Y')"

    @staticmethod
    def later(x, minutes):
        return f"({x} + to_minutes({minutes}))"

    @staticmethod
    def stamp(x):
        return f"CAST({x} AS TIMESTAMP)"

    @staticmethod
    def table(name):
        return name


def ratio(top: str, bottom: str, digits: int) -> str:
    """top/bottom rounded half away from zero, exactly, by whole-number division."""
    scale = 10**digits
    return (
        f"CASE WHEN ({bottom}) IS NULL OR ({bottom}) = 0 THEN NULL ELSE "
        f"CAST(sign({top}) * ((2 * {scale} * abs(CAST({top} AS HUGEINT)) + ({bottom})) // (2 * ({bottom}))) AS DOUBLE)"
        f" / {scale}.0 END"
    )


def mean(x: str, digits: int) -> str:
    return ratio(f"sum({x})", f"count({x})", digits)


def mean_scaled(x: str, scale: int, digits: int) -> str:
    """Mean of doubles with a fixed number of decimals (scale = 10^decimals)."""
    whole = f"CAST(round({x} * {scale}) AS BIGINT)"
    return ratio(f"sum({whole})", f"(count({x}) * {scale})", digits)


def count_where(test: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {test}) AS BIGINT)"


def total(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


STRICT = "('', 'NAN', 'NONE', 'NULL', '(NULL)')"


def cleaned(x: str) -> str:
    return f"CASE WHEN upper(trim({x})) IN {STRICT} THEN NULL ELSE trim({x}) END"


def borough(x: str) -> str:
    return f"""CASE upper(trim({x}))
        WHEN 'MANHATTAN' THEN 'MANHATTAN' WHEN 'M' THEN 'MANHATTAN' WHEN '1' THEN 'MANHATTAN'
        WHEN 'BRONX' THEN 'BRONX' WHEN 'B' THEN 'BRONX' WHEN '2' THEN 'BRONX'
        WHEN 'BROOKLYN' THEN 'BROOKLYN' WHEN 'K' THEN 'BROOKLYN' WHEN '3' THEN 'BROOKLYN'
        WHEN 'QUEENS' THEN 'QUEENS' WHEN 'Q' THEN 'QUEENS' WHEN '4' THEN 'QUEENS'
        WHEN 'STATEN ISLAND' THEN 'STATEN ISLAND' WHEN 'STATEN IS' THEN 'STATEN ISLAND'
        WHEN 'S' THEN 'STATEN ISLAND' WHEN '5' THEN 'STATEN ISLAND' END"""


def status(x: str) -> str:
    return f"""CASE upper(trim({x})) WHEN 'OPEN' THEN 'Open' WHEN 'CLOSED' THEN 'Closed'
        WHEN 'PENDING' THEN 'Pending' WHEN 'STARTED' THEN 'Started' WHEN 'ASSIGNED' THEN 'Assigned'
        WHEN 'IN PROGRESS' THEN 'In Progress' WHEN 'IN_PROGRESS' THEN 'In Progress'
        WHEN 'DRAFT' THEN 'Draft' ELSE 'Unspecified' END"""


def upper_code(x: str) -> str:
    return f"CASE WHEN upper(trim({x})) IN ('', 'NAN', '(NULL)') THEN NULL ELSE upper(trim({x})) END"


def grade_number(x: str) -> str:
    return f"CAST(CASE upper(trim({x})) WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 END AS INTEGER)"


def number(x: str) -> str:
    return f"CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END"


def moment(x: str) -> str:
    return f"TRY_CAST({x} AS TIMESTAMP)"


def day(x: str) -> str:
    return f"CAST(TRY_CAST({x} AS TIMESTAMP) AS DATE)"


def month(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def key(*parts: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce({p}, '_null_')" for p in parts) + "))"


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def json_field(name: str) -> str:
    """The column as a text field of a JSON object; NULL fields are left out."""
    text = f"replace(replace(CAST({name} AS VARCHAR), '\\', '\\\\'), '\"', '\\\"')"
    return f"'\"{name}\":\"' || {text} || '\"'"


def has(x: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def category(x: str, lower: bool = False) -> str:
    rules = (
        ("Noise", ["Noise"]),
        ("Food", ["Food"]),
        ("Construction", ["Construction", "Building"]),
        ("Housing", ["Heat", "Hot Water"]),
        ("Infrastructure", ["Water", "Sewer"]),
        ("Streets", ["Street", "Sidewalk"]),
        ("Sanitation", ["Sanit", "Trash", "Dirty"]),
    )
    subject = f"lower({x})" if lower else x
    whens = " ".join(
        f"WHEN {has(subject, *[w.lower() if lower else w for w in words])} THEN '{label}'"
        for label, words in rules
    )
    return f"CASE {whens} ELSE 'Other' END"


def work(x: str) -> str:
    return f"""CASE {x} WHEN 'NB' THEN 'New Building' WHEN 'A1' THEN 'Alteration'
        WHEN 'A2' THEN 'Alteration' WHEN 'A3' THEN 'Alteration' WHEN 'DM' THEN 'Demolition'
        WHEN 'SG' THEN 'Sign' WHEN 'FO' THEN 'Foundation' ELSE 'Other' END"""


def tier(x: str, high: int, mid: int, low: int) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'unknown' WHEN {x} >= {high} THEN 'excellent' "
        f"WHEN {x} >= {mid} THEN 'good' WHEN {x} >= {low} THEN 'fair' ELSE 'poor' END"
    )


def latest(table: str, keys: str) -> str:
    return (
        f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} "
        "ORDER BY _ingested_at DESC NULLS LAST, _row_hash ASC NULLS LAST) = 1"
    )


def most_common(table: str, by: str, columns: str) -> str:
    order = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in columns.split(","))
    return (
        f"SELECT {by}, {columns} FROM (SELECT {by}, {columns}, count(*) AS _n FROM {table} GROUP BY ALL) "
        f"QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY _n DESC, {order}) = 1"
    )


def _edges() -> str:
    """Edges of every nation's polygon, ring by ring."""
    selects, earlier = [], []
    for test, rings, parts in star.SHAPES:
        guard = " AND ".join([test, *[f"NOT ({t})" for t in earlier]])
        earlier.append(test)
        for ring in (*rings, *parts):
            for (x1, y1), (x2, y2) in zip(ring, (*ring[1:], ring[0])):
                if y1 != y2:
                    selects.append(
                        f"SELECT n_name AS zip, bx + {x1} AS x1, by_ + {y1} AS y1, "
                        f"bx + {x2} AS x2, by_ + {y2} AS y2 FROM board WHERE {guard}"
                    )
    return " UNION ALL ".join(selects)


AUDIT = "_row_hash, _ingested_at, _source_file, _ingest_date"
AS_OF = "DATE '2001-11-30'"
# Some ids are null and some repeat.
POINT_ID = (
    "CASE WHEN arrest_id % 11 = 0 THEN NULL WHEN arrest_id % 7 = 0 THEN arrest_id - 1 ELSE arrest_id END AS point_id"
)
SINCE = "TIMESTAMP '2000-01-01 00:00:00'"


def stage_complaints(source: str, zip_code: str = cleaned("incident_zip"), text=lambda x: f"trim({x})") -> str:
    texts = {
        "agency": "responding_agency_code",
        "complaint_type": "complaint_type",
        "descriptor": "complaint_descriptor",
        "location_type": "location_type",
        "resolution_description": "resolution_description",
        "open_data_channel_type": "submission_channel",
        "incident_address": "incident_address",
        "street_name": "street_name",
        "cross_street_1": "cross_street_1",
        "cross_street_2": "cross_street_2",
        "city": "city",
        "community_board": "community_board",
        "council_district": "council_district",
        "police_precinct": "police_precinct",
    }
    return f"""SELECT TRY_CAST(unique_key AS BIGINT) AS complaint_id,
        {moment('created_date')} AS created_date, {moment('closed_date')} AS closed_date,
        {moment('resolution_action_updated_date')} AS resolution_action_updated_date,
        {', '.join(f'{text(a)} AS {b}' for a, b in texts.items())},
        {zip_code} AS zip_code,
        CAST(TRY_CAST(bbl AS DECIMAL(10,0)) AS BIGINT) AS borough_block_lot,
        {number('latitude')} AS latitude, {number('longitude')} AS longitude,
        {status('status')} AS complaint_status,
        CASE WHEN upper(trim(borough)) IN ('', 'UNSPECIFIED', 'NAN', '(NULL)') THEN NULL ELSE trim(borough) END AS borough_raw,
        {borough('borough')} AS borough,
        datesub('hour', {moment('created_date')}, {moment('closed_date')}) AS resolution_time_hours,
        {month(moment('created_date'))} AS year_month, {AUDIT} FROM {source}"""


def stage_permits(source: str) -> str:
    texts = (
        "job__:job_number permit_sequence__:permit_sequence_number bin__:building_id_number "
        "job_doc___:job_document_number job_type:job_type self_cert:is_self_certified "
        "borough:borough_raw house__:house_number street_name:street_name block:tax_block lot:tax_lot "
        "community_board:community_board bldg_type:building_type gis_council_district:council_district "
        "gis_census_tract:census_tract gis_nta_name:neighborhood_name work_type:work_type "
        "permit_status:permit_status filing_status:filing_status permit_type:permit_type "
        "permit_subtype:permit_subtype non_profit:is_non_profit owner_s_business_type:owner_business_type "
        "owner_s_business_name:owner_business_name permittee_s_business_name:permittee_business_name "
        "permittee_s_license_type:permittee_license_type"
    ).split()
    pairs = [t.split(":") for t in texts]
    return f"""SELECT {', '.join(f'trim({a}) AS {b}' for a, b in pairs)},
        {cleaned('zip_code')} AS zip_code,
        {number('gis_latitude')} AS latitude, {number('gis_longitude')} AS longitude,
        {day('filing_date')} AS filing_date, {day('issuance_date')} AS issuance_date,
        {day('expiration_date')} AS expiration_date, {day('job_start_date')} AS job_start_date,
        {key('job__', 'permit_sequence__')} AS permit_key, {borough('borough')} AS borough,
        CAST(CASE WHEN {day('expiration_date')} >= {AS_OF} THEN 1 ELSE 0 END AS INTEGER) AS is_active_permit,
        {month(day('issuance_date'))} AS year_month, {AUDIT} FROM ({source})"""


def monthly_permits(source: str, active: str = "is_active_permit", where: str = "TRUE") -> str:
    return f"""SELECT zip_code, year_month, count(*) AS total_permits_issued,
        {total(active)} AS active_permits, {count_where("job_type = 'NB'")} AS new_building_count,
        {count_where("job_type IN ('A1', 'A2', 'A3')")} AS alteration_count,
        {count_where("job_type = 'DM'")} AS demolition_count
        FROM ({source}) WHERE zip_code IS NOT NULL AND year_month IS NOT NULL AND {where}
        GROUP BY zip_code, year_month"""


PERMIT_ZEROS = ", ".join(
    f"coalesce(p.{c}, 0) AS {c}"
    for c in (
        "total_permits_issued",
        "active_permits",
        "new_building_count",
        "alteration_count",
        "demolition_count",
    )
)

RESTAURANT = (
    "restaurant_id, restaurant_name, cuisine_type, borough, zip_code, inspection_grade, "
    "inspection_score, grade_assigned_date, inspection_date"
)


# Every permit of one month loaded again with a date in the next.
MOVED_PERMITS = """(SELECT * FROM raw_permits UNION ALL SELECT * REPLACE ('2001-11-05T00:00:00.000' AS issuance_date, TIMESTAMP '2001-11-20' AS _ingested_at, '2001-11-20' AS _ingest_date) FROM raw_permits WHERE issuance_date LIKE '2001-10-%')"""


def restaurants(where: str) -> str:
    return f"""SELECT {RESTAURANT} FROM inspections WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY restaurant_id ORDER BY inspection_date DESC NULLS LAST,
            grade_assigned_date DESC NULLS LAST, inspection_record_key ASC) = 1"""


def restaurants_at(moment: str) -> str:
    """The newest row per restaurant up to a moment, without restaurants not seen for 180 days."""
    newest = restaurants(f"inspection_date <= DATE '{moment}'")
    return f"SELECT * FROM ({newest}) WHERE inspection_date >= DATE '{moment}' - 180"


def snapshot(before: str, current: str, at: str) -> str:
    same = " AND ".join(
        f"o.{c} IS NOT DISTINCT FROM n.{c}"
        for c in ("inspection_grade", "cuisine_type", "restaurant_name", "borough", "zip_code")
    )
    o = ", ".join(f"o.{c.strip()}" for c in RESTAURANT.split(","))
    n = ", ".join(f"n.{c.strip()}" for c in RESTAURANT.split(","))
    return f"""SELECT {RESTAURANT}, valid_from, valid_to FROM {before} WHERE valid_to IS NOT NULL
        UNION ALL SELECT {o}, o.valid_from,
            CASE WHEN n.restaurant_id IS NOT NULL AND {same} THEN NULL ELSE TIMESTAMP '{at}' END
            FROM {before} o LEFT JOIN {current} n USING (restaurant_id) WHERE o.valid_to IS NULL
        UNION ALL SELECT {n}, TIMESTAMP '{at}', NULL FROM {current} n
            LEFT JOIN (SELECT * FROM {before} WHERE valid_to IS NULL) o USING (restaurant_id)
            WHERE o.restaurant_id IS NULL OR NOT ({same})"""


SCORE = """CAST(((700000 - 25 * least(total_complaints, 10000) - 50 * least(total_arrests, 5000)
    - 100 * least(active_permit_count, 2000)
    + 30 * CAST(round(coalesce(pct_grade_a, 0) * 10000) AS BIGINT)) + 50) // 100 AS DOUBLE) / 100.0"""

CTES = {
    "raw_complaints": star.raw_complaints_sql(Dialect),
    "raw_permits": star.raw_permits_sql(Dialect),
    "raw_inspections": star.raw_inspections_sql(Dialect),
    "raw_arrests": star.raw_arrests_sql(Dialect),
    "complaints": stage_complaints(f"({latest('raw_complaints', 'unique_key')})"),
    "permits": stage_permits(latest("raw_permits", "job__, permit_sequence__")),
    "inspections": f"""SELECT trim(camis) AS restaurant_id, trim(violation_code) AS violation_code,
        trim(inspection_type) AS inspection_type, trim(dba) AS restaurant_name,
        trim(cuisine_description) AS cuisine_type, trim(boro) AS borough_raw,
        trim(building) AS building_number, trim(street) AS street_name,
        trim(community_board) AS community_board, trim(council_district) AS council_district,
        trim(census_tract) AS census_tract, trim(bin) AS building_id_number,
        trim(nta) AS neighborhood_tabulation_area, trim(action) AS enforcement_action,
        trim(violation_description) AS violation_description, trim(critical_flag) AS is_critical_violation,
        {cleaned('zipcode')} AS zip_code, {day('inspection_date')} AS inspection_date,
        {day('grade_date')} AS grade_assigned_date,
        CAST(TRY_CAST(bbl AS DECIMAL(10,0)) AS BIGINT) AS borough_block_lot,
        {number('latitude')} AS latitude, {number('longitude')} AS longitude,
        TRY_CAST(score AS INTEGER) AS inspection_score,
        {key('camis', 'inspection_date', 'violation_code', 'inspection_type')} AS inspection_record_key,
        {borough('boro')} AS borough, {upper_code('grade')} AS inspection_grade,
        {grade_number('grade')} AS grade_numeric, {month(day('inspection_date'))} AS year_month, {AUDIT}
        FROM ({latest('raw_inspections', 'camis, inspection_date, violation_code, inspection_type')})""",
    "board": "SELECT n_nationkey, n_name, (n_nationkey % 5) * 2 AS bx, (n_nationkey // 5) * 2 AS by_ FROM nation",
    "edges": _edges(),
    "typed_arrests": f"""SELECT TRY_CAST(arrest_key AS BIGINT) AS arrest_id, {day('arrest_date')} AS arrest_date,
        TRY_CAST(pd_cd AS INTEGER) AS nypd_classification_code, TRY_CAST(ky_cd AS INTEGER) AS offense_category_code,
        TRY_CAST(arrest_precinct AS INTEGER) AS arrest_precinct, trim(pd_desc) AS nypd_classification_desc,
        trim(ofns_desc) AS offense_description, trim(law_code) AS penal_law_code,
        trim(arrest_boro) AS arrest_borough_raw, trim(perp_race) AS perpetrator_race,
        {number('latitude')} AS latitude, {number('longitude')} AS longitude,
        {upper_code('law_cat_cd')} AS law_category, {borough('arrest_boro')} AS borough,
        nullif(trim(age_group), '(null)') AS perpetrator_age_group,
        nullif(trim(perp_sex), '(null)') AS perpetrator_sex,
        {month(day('arrest_date'))} AS year_month, {AUDIT} FROM ({latest('raw_arrests', 'arrest_key')})""",
    "places": """SELECT latitude, longitude, min(zip) AS zip FROM (
        SELECT p.latitude, p.longitude, e.zip
        FROM (SELECT DISTINCT latitude, longitude FROM typed_arrests) p, edges e
        WHERE (e.y1 > p.latitude) <> (e.y2 > p.latitude)
          AND p.longitude < (e.x2 - e.x1) * (p.latitude - e.y1) / (e.y2 - e.y1) + e.x1
        GROUP BY p.latitude, p.longitude, e.zip HAVING count(*) % 2 = 1) GROUP BY latitude, longitude""",
    "arrests": """SELECT a.*, coalesce(z.zip, 'UNKNOWN') AS zip_code,
        CASE WHEN z.zip IS NULL THEN 'borough_fallback' ELSE 'spatial' END AS zip_code_source
        FROM typed_arrests a LEFT JOIN places z USING (latitude, longitude)""",
    "m_complaints": f"""SELECT zip_code, year_month, count(*) AS total_complaints,
        {count_where(has('complaint_type', 'Noise'))} AS noise_complaints,
        {count_where(has('complaint_type', 'Food'))} AS food_complaints,
        {count_where(has('complaint_type', 'Construction', 'Building'))} AS construction_complaints,
        {mean('resolution_time_hours', 2)} AS avg_resolution_hours,
        {count_where("complaint_status = 'Open'")} AS open_complaints,
        {count_where("complaint_status = 'Closed'")} AS closed_complaints
        FROM complaints WHERE zip_code IS NOT NULL AND year_month IS NOT NULL GROUP BY zip_code, year_month""",
    "m_arrests": f"""SELECT zip_code, year_month, count(*) AS total_arrests,
        {count_where("law_category = 'F'")} AS felony_count,
        {count_where("law_category = 'M'")} AS misdemeanor_count,
        {count_where("law_category = 'V'")} AS violation_count
        FROM arrests WHERE zip_code <> 'UNKNOWN' AND year_month IS NOT NULL GROUP BY zip_code, year_month""",
    "m_permits": monthly_permits("FROM permits"),
    "visits": """SELECT * FROM inspections WHERE zip_code IS NOT NULL AND year_month IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY restaurant_id, inspection_date
            ORDER BY violation_code ASC NULLS FIRST, inspection_type ASC NULLS FIRST) = 1""",
    "m_inspections": f"""SELECT v.*, r.critical_violation_count FROM (
        SELECT zip_code, year_month, count(*) AS total_inspections,
            count(DISTINCT restaurant_id) AS unique_restaurants_inspected,
            {mean('inspection_score', 2)} AS avg_score,
            {', '.join(f"{ratio(count_where(f"inspection_grade = '{g}'"), 'count(inspection_grade)', 4)} AS pct_grade_{g.lower()}" for g in 'ABC')}
        FROM visits GROUP BY zip_code, year_month) v
        JOIN (SELECT zip_code, year_month, {count_where("is_critical_violation = 'Critical'")} AS critical_violation_count
            FROM inspections GROUP BY zip_code, year_month) r USING (zip_code, year_month)""",
    "pairs": f"SELECT c.*, {PERMIT_ZEROS} FROM m_complaints c LEFT JOIN m_permits p USING (zip_code, year_month)",
    "place_rows": """SELECT zip_code, borough FROM complaints UNION ALL SELECT zip_code, borough FROM arrests
        UNION ALL SELECT zip_code, borough FROM permits UNION ALL SELECT zip_code, borough FROM inspections""",
    "consensus": """SELECT zip_code, borough FROM (SELECT zip_code, borough, count(*) AS n FROM place_rows
        WHERE zip_code IS NOT NULL AND zip_code <> 'UNKNOWN' GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY zip_code ORDER BY borough IS NULL, n DESC, borough) = 1""",
    "seed": """SELECT n_name AS zip_code, CASE r_regionkey WHEN 0 THEN 'MANHATTAN' WHEN 1 THEN 'BRONX'
        WHEN 2 THEN 'BROOKLYN' WHEN 3 THEN 'QUEENS' ELSE 'STATEN ISLAND' END AS borough,
        r_name || ' ' || n_name AS neighborhood_name, 'NT' || CAST(n_nationkey AS VARCHAR) AS nta_code
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'""",
    "zips": """SELECT zip_code, borough, neighborhood_name, nta_code FROM seed UNION ALL
        SELECT zip_code, borough, NULL, NULL FROM consensus WHERE zip_code NOT IN (SELECT zip_code FROM seed)""",
    "dates": f"""SELECT strftime(d, '%Y-%m') AS year_month, CAST(year(d) AS INTEGER) AS year,
        CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter, monthname(d) AS month_name,
        d = date_trunc('month', {AS_OF}) AS is_current_month, d < date_trunc('month', {AS_OF}) AS is_complete_month
        FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), CAST({AS_OF} AS TIMESTAMP), INTERVAL 1 MONTH)) AS d FROM orders)""",
    "spine": "SELECT zip_code, borough, year_month FROM zips, dates",
    "fact_rows": """SELECT s.zip_code, s.year_month, s.borough,
        coalesce(total_complaints, 0) AS total_complaints, coalesce(noise_complaints, 0) AS noise_complaint_count,
        coalesce(food_complaints, 0) AS food_complaint_count,
        coalesce(construction_complaints, 0) AS construction_complaint_count, avg_resolution_hours,
        coalesce(open_complaints, 0) AS open_complaint_count, coalesce(closed_complaints, 0) AS closed_complaint_count,
        coalesce(total_arrests, 0) AS total_arrests, coalesce(felony_count, 0) AS felony_count,
        coalesce(misdemeanor_count, 0) AS misdemeanor_count, coalesce(violation_count, 0) AS violation_count,
        coalesce(total_permits_issued, 0) AS total_permits_issued, coalesce(active_permits, 0) AS active_permit_count,
        coalesce(new_building_count, 0) AS new_building_count, coalesce(alteration_count, 0) AS alteration_count,
        coalesce(demolition_count, 0) AS demolition_count, coalesce(total_inspections, 0) AS total_inspections,
        coalesce(unique_restaurants_inspected, 0) AS unique_restaurants_inspected,
        avg_score AS avg_inspection_score, pct_grade_a, pct_grade_b, pct_grade_c,
        coalesce(critical_violation_count, 0) AS critical_violation_count
        FROM spine s LEFT JOIN m_complaints USING (zip_code, year_month) LEFT JOIN m_arrests USING (zip_code, year_month)
        LEFT JOIN m_permits USING (zip_code, year_month) LEFT JOIN m_inspections USING (zip_code, year_month)""",
    "fact": f"SELECT *, {SCORE} AS neighborhood_pulse_score FROM fact_rows",
    "pulse": """SELECT f.* EXCLUDE (borough), z.borough, z.neighborhood_name, z.nta_code, d.* EXCLUDE (year_month)
        FROM fact f LEFT JOIN zips z USING (zip_code) LEFT JOIN dates d USING (year_month)""",
    "safety": f"""SELECT *, {ratio('total_arrests', 'total_permits_issued', 2)} AS arrests_per_permit,
        {ratio('felony_count', 'total_arrests', 4)} AS felony_pct FROM (
        SELECT coalesce(a.zip_code, p.zip_code) AS zip_code, coalesce(a.year_month, p.year_month) AS year_month,
        coalesce(total_arrests, 0) AS total_arrests, coalesce(felony_count, 0) AS felony_count,
        coalesce(misdemeanor_count, 0) AS misdemeanor_count, coalesce(violation_count, 0) AS violation_count,
        coalesce(total_permits_issued, 0) AS total_permits_issued, coalesce(active_permits, 0) AS active_permit_count,
        coalesce(new_building_count, 0) AS new_building_count, coalesce(alteration_count, 0) AS alteration_count,
        coalesce(demolition_count, 0) AS demolition_count
        FROM m_arrests a FULL OUTER JOIN m_permits p ON a.zip_code = p.zip_code AND a.year_month = p.year_month)""",
    "food": f"""SELECT *, {ratio('food_complaint_count', 'total_inspections', 4)} AS food_complaints_per_inspection FROM (
        SELECT coalesce(i.zip_code, c.zip_code) AS zip_code, coalesce(i.year_month, c.year_month) AS year_month,
        coalesce(total_inspections, 0) AS total_inspections,
        coalesce(unique_restaurants_inspected, 0) AS unique_restaurants_inspected, avg_score AS avg_inspection_score,
        pct_grade_a, pct_grade_b, pct_grade_c, coalesce(critical_violation_count, 0) AS critical_violation_count,
        coalesce(food_complaints, 0) AS food_complaint_count
        FROM m_inspections i FULL OUTER JOIN m_complaints c ON i.zip_code = c.zip_code AND i.year_month = c.year_month)""",
    "type_counts": """SELECT borough, year_month, complaint_type, count(*) AS complaint_count FROM complaints
        WHERE borough IS NOT NULL AND year_month IS NOT NULL AND complaint_type IS NOT NULL GROUP BY ALL""",
    "top_types": f"""SELECT t.*, CAST(1 + (SELECT count(DISTINCT o.complaint_count) FROM type_counts o
            WHERE o.borough = t.borough AND o.year_month = t.year_month AND o.complaint_count > t.complaint_count) AS INTEGER) AS borough_rank,
        {ratio('complaint_count', 'whole', 4)} AS pct_of_borough_total
        FROM type_counts t JOIN (SELECT borough, year_month, sum(complaint_count) AS whole FROM type_counts GROUP BY ALL)
        USING (borough, year_month)""",
    "summary": f"""SELECT p.*, b.borough_avg_pulse_score, b.borough_zip_count, c.city_avg_pulse_score,
        CAST(1 + (SELECT count(*) FROM pulse o WHERE o.borough IS NOT DISTINCT FROM p.borough AND o.year_month = p.year_month
            AND o.neighborhood_pulse_score > p.neighborhood_pulse_score) AS INTEGER) AS borough_pulse_rank,
        l.neighborhood_pulse_score AS pulse_score_prev_month,
        round((p.neighborhood_pulse_score - l.neighborhood_pulse_score) * 100) / 100 AS pulse_score_mom_delta
        FROM pulse p
        JOIN (SELECT borough, year_month, {mean_scaled('neighborhood_pulse_score', 100, 2)} AS borough_avg_pulse_score,
            count(*) AS borough_zip_count FROM pulse GROUP BY ALL) b
            ON b.borough IS NOT DISTINCT FROM p.borough AND b.year_month = p.year_month
        JOIN (SELECT year_month, {mean_scaled('neighborhood_pulse_score', 100, 2)} AS city_avg_pulse_score
            FROM pulse GROUP BY ALL) c ON c.year_month = p.year_month
        LEFT JOIN pulse l ON l.zip_code = p.zip_code AND l.year_month =
            strftime(CAST(p.year_month || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')""",
    "trends": f"""SELECT borough, year_month, max(year) AS year, max(quarter) AS quarter, max(month_name) AS month_name,
        bool_or(is_complete_month) AS is_complete_month, {total('total_complaints')} AS total_complaints,
        {total('total_arrests')} AS total_arrests, {total('total_permits_issued')} AS total_permits_issued,
        {total('total_inspections')} AS total_inspections, {total('noise_complaint_count')} AS noise_complaint_count,
        {total('food_complaint_count')} AS food_complaint_count,
        {total('construction_complaint_count')} AS construction_complaint_count, {total('felony_count')} AS felony_count,
        {total('misdemeanor_count')} AS misdemeanor_count, {total('critical_violation_count')} AS critical_violation_count,
        {mean_scaled('neighborhood_pulse_score', 100, 2)} AS avg_pulse_score, count(DISTINCT zip_code) AS zip_code_count
        FROM pulse GROUP BY borough, year_month""",
    "safety_logs": """SELECT *, round(log10(total_arrests + 1), 4) AS log_arrests,
        round(log10(total_permits_issued + 1), 4) AS log_permits FROM safety""",
    "rankings": "SELECT * FROM top_types WHERE borough_rank <= 15",
    "lag_source": "SELECT * FROM pairs WHERE total_complaints > 0 OR total_permits_issued > 0",
    "dense_pairs": f"""SELECT s.zip_code, s.year_month, coalesce(noise_complaints, 0) AS noise_complaints,
        coalesce(construction_complaints, 0) AS construction_complaints, coalesce(total_complaints, 0) AS total_complaints,
        {', '.join(f"coalesce({c}, 0) AS {c}" for c in ('total_permits_issued', 'active_permits', 'new_building_count'))}
        FROM spine s LEFT JOIN m_complaints USING (zip_code, year_month) LEFT JOIN m_permits USING (zip_code, year_month)""",
    "s1": restaurants_at("1998-06-30"),
    "s2": restaurants_at("1999-12-31"),
    "s3": restaurants_at("2000-12-31"),
    "s4": restaurants_at("2001-06-30"),
    "s5": restaurants_at("2001-11-30"),
    "h1": "SELECT *, TIMESTAMP '1998-06-30' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM s1",
    "h2": snapshot("h1", "s2", "1999-12-31"),
    "h3": snapshot("h2", "s3", "2000-12-31"),
    "h4": snapshot("h3", "s4", "2001-06-30"),
    "h5": snapshot("h4", "s5", "2001-11-30"),
}


def lag(source: str) -> str:
    def before(n: int) -> str:
        return (
            f"LEFT JOIN {source} l{n} ON l{n}.zip_code = b.zip_code AND l{n}.year_month = "
            f"strftime(CAST(b.year_month || '-01' AS DATE) - INTERVAL {n} MONTH, '%Y-%m')"
        )

    return f"""SELECT b.zip_code, b.year_month, b.noise_complaints AS noise_complaints_t,
        b.construction_complaints AS construction_complaints_t, b.total_complaints AS total_complaints_t,
        b.new_building_count AS new_building_count_t, l1.new_building_count AS new_building_count_t_minus_1,
        l1.total_permits_issued AS total_permits_t_minus_1, l1.active_permits AS active_permits_t_minus_1,
        l2.new_building_count AS new_building_count_t_minus_2, l2.total_permits_issued AS total_permits_t_minus_2
        FROM {source} b {before(1)} {before(2)}"""


def sums(source: str, names: str, extra: str = "", by: str = "year_month", where: str = "TRUE") -> str:
    pairs = [(n.split(":") * 2)[:2] for n in names.split()]
    columns = ", ".join(f"{total(a)} AS {b}" for a, b in pairs)
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"SELECT {lead}{columns}{', ' + extra if extra else ''} FROM {source} WHERE {where} {group}"


def rows_of(source: str, label: str, pairs: dict[str, str], where: str = "TRUE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, CAST(coalesce(sum({c}), 0) AS BIGINT) AS total FROM {source} WHERE {where}"
        for name, c in pairs.items()
    )


def check(name: str, source: str, bad: str, severity: str = "error") -> str:
    return (
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, {count_where(bad)} AS failures FROM {source}"
    )


def check_rows(name: str, failing: str, severity: str = "error") -> str:
    return f"SELECT '{name}' AS check_name, '{severity}' AS severity, count(*) AS failures FROM ({failing})"


def fresh(source: str, table: str, warn: int, error: int) -> str:
    age = "datesub('hour', max(_ingested_at), TIMESTAMP '2001-11-05 06:00:00')"
    return f"""SELECT '{source}' AS source, max(_ingested_at) AS newest, {age} AS age_hours,
        CASE WHEN TIMESTAMP '2001-11-05 06:00:00' > max(_ingested_at) + INTERVAL {error} HOUR THEN 'ERROR'
            WHEN TIMESTAMP '2001-11-05 06:00:00' > max(_ingested_at) + INTERVAL {warn} HOUR THEN 'WARN' ELSE 'PASS' END AS status FROM {table}"""


M, B = "'1998-05'", "'BROOKLYN'"
DOMAIN_SUMS = "total_complaints:complaints total_arrests:arrests total_permits_issued:permits total_inspections:inspections"
MODES = {
    "kept": stage_complaints("raw_complaints", "trim(incident_zip)"),
    "default": stage_complaints("raw_complaints"),
    "strict": stage_complaints("raw_complaints", text=cleaned),
}
RECENT = "(SELECT year_month, row_number() OVER (ORDER BY year_month) AS position FROM (SELECT DISTINCT year_month FROM trends ORDER BY year_month DESC LIMIT 24))"
CORR = "round(corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)), 6)"


def percent(x: str) -> str:
    return f"CAST((2 * CAST(round({x} * 10000) AS BIGINT) + 10) // 20 AS DOUBLE) / 10.0"


def mean_percent(x: str) -> str:
    whole = f"CAST(round({x} * 10000) AS BIGINT)"
    return ratio(f"sum({whole})", f"(count({x}) * 100)", 1)


GRADED = f"(SELECT * FROM food WHERE year_month = {M} AND pct_grade_a IS NOT NULL)"


QUERIES = {
    "stg_complaints": "SELECT * FROM complaints",
    "stg_arrests": "SELECT * FROM arrests",
    "stg_permits": "SELECT * FROM permits",
    "stg_inspections": "SELECT * FROM inspections",
    "stg_complaints_tokens": " UNION ALL ".join(
        f"SELECT '{name}' AS mode, zip_code, resolution_description, count(*) AS n FROM ({text}) GROUP BY ALL"
        for name, text in MODES.items()
    ),
    "new_rows_since": f"SELECT {month('_ingested_at')} AS loaded, count(*) AS n FROM raw_permits WHERE _ingested_at > {SINCE} GROUP BY ALL",
    "dedup_latest": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity) = 1""",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "tolerant_cast": f"""SELECT unique_key, CAST(TRY_CAST(bbl AS DECIMAL(10,0)) AS BIGINT) AS bbl,
        TRY_CAST(bbl AS BIGINT) AS bbl_wide, TRY_CAST(community_board AS INTEGER) AS board,
        {number('latitude')} AS latitude, {moment('closed_date')} AS closed, {day('closed_date')} AS closed_day,
        CAST(NULL AS DATE) AS us_style FROM raw_complaints""",
    "null_tokens": f"""SELECT trim(perp_sex) AS sex_text, nullif(trim(perp_sex), '(null)') AS sex,
        CASE WHEN upper(trim(law_cat_cd)) IN {STRICT} THEN NULL ELSE law_cat_cd END AS law_raw,
        {cleaned('perp_race')} AS race, count(*) AS n FROM raw_arrests GROUP BY ALL""",
    "standardize_boroughs": f"""SELECT borough, count(*) AS n, {borough('borough')} AS standard FROM (
        SELECT borough FROM raw_complaints UNION ALL SELECT borough FROM raw_permits
        UNION ALL SELECT boro FROM raw_inspections UNION ALL SELECT arrest_boro FROM raw_arrests) GROUP BY borough""",
    "status_normalize": f"SELECT status, count(*) AS n, {status('status')} AS complaint_status FROM raw_complaints GROUP BY status",
    "law_and_grade_codes": f"""SELECT 'law' AS kind, law_cat_cd AS raw, count(*) AS n, {upper_code('law_cat_cd')} AS code,
        CAST(NULL AS INTEGER) AS number FROM raw_arrests GROUP BY law_cat_cd UNION ALL
        SELECT 'grade', grade, count(*), {upper_code('grade')}, {grade_number('grade')} FROM raw_inspections GROUP BY grade""",
    "category_rules": f"""SELECT complaint_type, count(*) AS n, {category('complaint_type')} AS category,
        {category('complaint_type', True)} AS category_any_case FROM complaints GROUP BY complaint_type""",
    "work_categories": f"SELECT job_type, count(*) AS n, {work('job_type')} AS work_category FROM permits GROUP BY job_type",
    "surrogate_keys": f"""SELECT {key('camis', 'inspection_date', 'violation_code', 'inspection_type')} AS record_key,
        count(*) AS n FROM raw_inspections GROUP BY ALL""",
    "resolution_hours": "SELECT complaint_id, resolution_time_hours AS hours FROM complaints",
    "active_flags": """SELECT year_month, is_active_permit,
        CAST(CASE WHEN expiration_date >= DATE '2002-01-01' THEN 1 ELSE 0 END AS INTEGER) AS active_later,
        count(*) AS n FROM permits GROUP BY ALL""",
    "row_hashes": f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
        md5('{{' || concat_ws(',', {", ".join(json_field(c) for c in ORDER_COLUMNS)}) || '}}') AS _row_hash FROM orders""",
    "landing_strings": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
        o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
        o_orderpriority FROM orders""",
    "point_in_polygon": f"SELECT {POINT_ID}, latitude, longitude, zip_code, zip_code_source FROM arrests",
    "point_in_polygon_shuffled": f"SELECT {POINT_ID}, latitude, longitude, zip_code, zip_code_source FROM arrests",
    "polygon_file_loaded": f"SELECT {POINT_ID}, latitude, longitude, zip_code, zip_code_source FROM arrests",
    "point_without_polygons": f"""SELECT {POINT_ID}, latitude, longitude, 'UNKNOWN' AS zip_code,
        'borough_fallback' AS zip_code_source FROM typed_arrests""",
    "monthly_complaints": "SELECT * FROM m_complaints",
    "monthly_arrests": "SELECT * FROM m_arrests",
    "monthly_permits": "SELECT * FROM m_permits",
    "monthly_inspections": "SELECT * FROM m_inspections",
    "complaint_permit_left": "SELECT * FROM pairs",
    "dim_zip_codes": "SELECT * FROM zips",
    "seed_file_zips": "SELECT * FROM zips",
    "dim_date": "SELECT * FROM dates",
    "dim_complaint_types": f"""SELECT {key('complaint_type')} AS complaint_type_key, complaint_type,
        {category('complaint_type')} AS category, complaint_descriptor AS subcategory,
        responding_agency_code AS responsible_agency FROM ({most_common('complaints', 'complaint_type', 'complaint_descriptor, responding_agency_code')})
        WHERE complaint_type IS NOT NULL""",
    "dim_permit_types": f"""SELECT {key('permit_type')} AS permit_type_key, permit_type, permit_subtype AS permit_type_desc,
        job_type, {work('job_type')} AS work_category FROM ({most_common('permits', 'permit_type', 'permit_subtype, job_type, work_type')})""",
    "zip_month_spine": "SELECT * FROM spine",
    "fact_monthly": "SELECT * FROM fact",
    "mart_pulse_wide": "SELECT * FROM pulse",
    "mart_safety_full_outer": "SELECT * FROM safety",
    "mart_food_full_outer": "SELECT * FROM food",
    "mart_top_types": "SELECT * FROM top_types",
    "kpi_pulse_summary": "SELECT * FROM summary",
    "kpi_borough_trends": "SELECT * FROM trends",
    "kpi_log_scale": "SELECT * FROM safety_logs",
    "kpi_food": "SELECT * FROM food",
    "kpi_top15": "SELECT * FROM rankings",
    "kpi_top3": "SELECT * FROM top_types WHERE borough_rank <= 3",
    "log_scaled_values": "SELECT o_orderkey, round(log10(o_custkey + 1), 4) AS log_cust FROM orders",
    "lag_join": lag("lag_source"),
    "lag_join_dense": f"{lag('dense_pairs')} WHERE b.total_complaints > 0 OR b.total_permits_issued > 0",
    "lag_correlation": f"""SELECT {CORR.format(x='noise_complaints_t', y='new_building_count_t_minus_1')} AS noise_lag_1,
        {CORR.format(x='noise_complaints_t', y='new_building_count_t_minus_2')} AS noise_lag_2,
        {CORR.format(x='construction_complaints_t', y='new_building_count_t_minus_1')} AS construction_lag_1,
        {CORR.format(x='construction_complaints_t', y='new_building_count_t_minus_2')} AS construction_lag_2
        FROM ({lag('lag_source')})""",
    "zip_consensus": "SELECT * FROM consensus",
    "zip_seed": f"""SELECT c.zip_code, c.borough, n.neighborhood_name, a.neighborhood_tabulation_area AS nta_code
        FROM consensus c
        LEFT JOIN (SELECT zip_code, neighborhood_name FROM permits WHERE neighborhood_name IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY zip_code ORDER BY issuance_date DESC NULLS LAST, neighborhood_name DESC) = 1) n USING (zip_code)
        LEFT JOIN ({most_common('(SELECT * FROM inspections WHERE neighborhood_tabulation_area IS NOT NULL)', 'zip_code', 'neighborhood_tabulation_area')}) a USING (zip_code)
        WHERE c.borough IS NOT NULL""",
    "complaint_type_seed": f"""SELECT complaint_type, {category('complaint_type')} AS category, complaint_descriptor AS subcategory,
        responding_agency_code AS responsible_agency FROM ({most_common('complaints', 'complaint_type', 'complaint_descriptor, responding_agency_code')})
        WHERE complaint_type IS NOT NULL""",
    "permit_type_seed": f"""SELECT permit_type, permit_subtype AS permit_type_desc, job_type, {work('job_type')} AS work_category
        FROM ({most_common('permits', 'permit_type', 'permit_subtype, job_type, work_type')})""",
    "current_restaurants": restaurants("TRUE"),
    "keyset_page": """SELECT * FROM (SELECT CAST(l_shipdate AS VARCHAR) AS l_shipdate, CAST(l_orderkey AS VARCHAR) AS l_orderkey,
        CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_partkey AS VARCHAR) AS l_partkey FROM lineitem)
        WHERE (l_shipdate, l_orderkey, l_linenumber, l_partkey) > ('1998-03-10 00:00:00', '5', '3', '0')
        ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey LIMIT 1000""",
    "upsert_merge": "SELECT * FROM permits",
    "upsert_stored": "SELECT * FROM permits",
    "incremental_equals_full": monthly_permits(stage_permits(latest(MOVED_PERMITS, "job__, permit_sequence__"))),
    "lookback_recompute": f"""SELECT * FROM ({monthly_permits(stage_permits(latest("(SELECT * FROM raw_permits WHERE _ingested_at <= TIMESTAMP '2001-10-01 00:00:00')", "job__, permit_sequence__")))}) old
        WHERE NOT EXISTS (SELECT 1 FROM m_permits m WHERE m.year_month >= '2001-09' AND m.zip_code = old.zip_code AND m.year_month = old.year_month)
        UNION ALL SELECT * FROM m_permits WHERE year_month >= '2001-09'""",
    "scd2_history": "SELECT * FROM h5",
    "scd2_stored": "SELECT * FROM h5",
    "scd2_point_in_time": """SELECT * FROM h5 WHERE valid_from <= TIMESTAMP '2000-06-10'
        AND (valid_to IS NULL OR valid_to > TIMESTAMP '2000-06-10')""",
    "scd2_transitions": """SELECT a.inspection_grade AS inspection_grade_then, b.inspection_grade AS inspection_grade_now, count(*) AS keys
        FROM h5 a JOIN h5 b USING (restaurant_id)
        WHERE a.valid_from <= TIMESTAMP '2000-02-10' AND (a.valid_to IS NULL OR a.valid_to > TIMESTAMP '2000-02-10')
          AND b.valid_from <= TIMESTAMP '2001-07-10' AND (b.valid_to IS NULL OR b.valid_to > TIMESTAMP '2001-07-10')
        GROUP BY ALL""",
    "stream_added_column": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
        CASE WHEN o_orderkey % 2 = 0 AND o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority,
        CASE WHEN o_orderkey % 2 = 1 THEN 'r0' WHEN o_orderstatus = 'F' THEN 'r1' ELSE 'r2' END AS _job_run_id FROM orders""",
    "ingest_lineage": """SELECT '2001-11-30' AS _ingest_date, 'lineage' AS _job_run_id, 'jobs/events' AS _notebook_path,
        'EVENTS' AS _source_system, TIMESTAMP '2001-11-30 12:00:00' AS _ingested_at, TRUE AS from_events,
        count(*) AS rows, count(DISTINCT event_id) AS hashes FROM events""",
    "audit_columns": "SELECT TIMESTAMP '2001-11-30 12:00:00' AS loaded_at, model_name, 'star' AS run_id, rows FROM (" + " UNION ALL ".join(
        f"SELECT '{model}' AS model_name, count(*) AS rows FROM {table}"
        for model, table in (
            ("stg_service_requests", "complaints"), ("stg_arrests", "arrests"), ("stg_permits", "permits"),
            ("stg_inspections", "inspections"), ("fact", "fact"),
        )
    ) + ")",
    "stream_changed_type": """SELECT CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey,
        CASE WHEN o_orderkey % 3 = 1 THEN CASE WHEN o_orderkey % 7 = 0 THEN 'no. ' ELSE '' END || CAST(o_orderkey AS VARCHAR) END AS o_orderkey__text,
        o_orderstatus, 'r' || CAST(o_orderkey % 3 AS VARCHAR) AS _job_run_id FROM orders""",
    "extract_resumed": """SELECT CAST(l_shipdate AS VARCHAR) AS issuance_date, CAST(l_orderkey AS VARCHAR) AS job__,
        CAST(l_linenumber AS VARCHAR) AS permit_sequence__ FROM lineitem""",
    "stream_ingest": "SELECT event_type, 'first' AS _job_run_id, count(*) AS rows, count(DISTINCT event_id) AS hashes FROM events GROUP BY event_type",
    "dq_results": " UNION ALL ".join(
        [
            check("complaints.not_null:complaint_id", "complaints", "complaint_id IS NULL"),
            check("complaints.not_null:zip_code", "complaints", "zip_code IS NULL", "warn"),
            check("complaints.not_null:borough", "complaints", "borough_raw IS NOT NULL AND borough IS NULL"),
            check(
                "complaints.accepted_values:complaint_status",
                "complaints",
                "complaint_status NOT IN ('Open', 'Closed', 'Pending', 'Started', 'Assigned', 'In Progress', 'Draft', 'Unspecified')",
            ),
            check("complaints.not_after:created_date", "complaints", f"CAST(created_date AS DATE) > {AS_OF}"),
            check("arrests.not_null:arrest_id", "arrests", "arrest_id IS NULL"),
            check("arrests.accepted_values:law_category", "arrests", "law_category NOT IN ('F', 'M', 'V', '9', 'I')"),
            check("arrests.accepted_values:zip_code_source", "arrests", "zip_code_source NOT IN ('spatial', 'borough_fallback')"),
            check("permits.not_null:permit_key", "permits", "permit_key IS NULL"),
            check("permits.not_null:zip_code", "permits", "zip_code IS NULL", "warn"),
            check("permits.not_null:year_month", "permits", "year_month IS NULL", "warn"),
            check("permits.not_after:issuance_date", "permits", f"issuance_date > {AS_OF}", "warn"),
            check("inspections.not_null:inspection_record_key", "inspections", "inspection_record_key IS NULL"),
            check(
                "inspections.accepted_values:is_critical_violation",
                "inspections",
                "is_critical_violation NOT IN ('Critical', 'Not Critical', 'Not Applicable')",
            ),
            check(
                "inspections.accepted_values:inspection_grade",
                "inspections",
                "inspection_grade NOT IN ('A', 'B', 'C', 'Z', 'P', 'N')",
            ),
            check_rows("complaints.unique:complaint_id", "SELECT complaint_id FROM complaints GROUP BY ALL HAVING count(*) > 1"),
            check_rows("permits.unique:permit_key", "SELECT permit_key FROM permits GROUP BY ALL HAVING count(*) > 1"),
            check_rows(
                "raw_permits.unique:job__,permit_sequence__",
                "SELECT job__, permit_sequence__ FROM raw_permits GROUP BY ALL HAVING count(*) > 1",
                "warn",
            ),
            check_rows(
                "complaints.relationship:zip_code",
                "SELECT 1 FROM complaints WHERE zip_code NOT IN (SELECT zip_code FROM seed)",
                "warn",
            ),
        ]
    ),
    "dq_fact": " UNION ALL ".join(
        [
            check("fact.in_range:neighborhood_pulse_score", "fact", "neighborhood_pulse_score NOT BETWEEN 0 AND 100"),
            check("fact.not_null:neighborhood_pulse_score", "fact", "neighborhood_pulse_score IS NULL"),
            check("fact.not_null:zip_code", "fact", "zip_code IS NULL"),
            check("fact.not_null:borough", "fact", "borough IS NULL"),
            check_rows("fact.unique:zip_code,year_month", "SELECT zip_code, year_month FROM fact GROUP BY ALL HAVING count(*) > 1"),
            check_rows("fact.relationship:zip_code", "SELECT 1 FROM fact WHERE zip_code NOT IN (SELECT zip_code FROM zips)"),
        ]
    ),
    "orphan_keys": "SELECT zip_code, count(*) AS n FROM complaints WHERE zip_code NOT IN (SELECT zip_code FROM seed) GROUP BY zip_code",
    "future_dates": """SELECT 'complaints' AS source, CAST(complaint_id AS VARCHAR) AS record_id, CAST(created_date AS DATE) AS record_date
        FROM complaints WHERE CAST(created_date AS DATE) > DATE '2000-10-01'
        UNION ALL SELECT 'arrests', CAST(arrest_id AS VARCHAR), arrest_date FROM arrests WHERE arrest_date > DATE '2000-10-01'
        UNION ALL SELECT 'permits', permit_key, issuance_date FROM permits WHERE issuance_date > DATE '2000-10-01'
        UNION ALL SELECT 'inspections', inspection_record_key, inspection_date FROM inspections WHERE inspection_date > DATE '2000-10-01'""",
    "source_freshness": " UNION ALL ".join(
        [
            fresh("service_requests", "raw_complaints", 25, 49),
            fresh("permits", "raw_permits", 25, 49),
            fresh("inspections", "raw_inspections", 25, 49),
            fresh("arrests", "raw_arrests", 2400, 4800),
        ]
    ),
    "null_counts": "SELECT count(*) AS rows, "
    + ", ".join(
        f"{count_where(f'{c} IS NULL')} AS {c}"
        for c in ("complaint_id", "closed_date", "zip_code", "borough", "latitude", "borough_block_lot")
    )
    + " FROM complaints",
    "q01_zip_month": f"SELECT * FROM summary WHERE zip_code = 'NATION_7' AND year_month = {M}",
    "q02_zip_series": """SELECT *, NOT is_complete_month AND year_month = (SELECT max(year_month) FROM summary
        WHERE zip_code = 'NATION_7' AND NOT is_complete_month) AS is_month_to_date FROM summary WHERE zip_code = 'NATION_7'""",
    "q03_city_summary": sums("summary", DOMAIN_SUMS, f"{mean_scaled('neighborhood_pulse_score', 100, 6)} AS avg_score", "", f"year_month = {M}"),
    "q03_borough_summary": sums("summary", DOMAIN_SUMS, f"{mean_scaled('neighborhood_pulse_score', 100, 6)} AS avg_score", "", f"year_month = {M} AND borough = {B}"),
    "q04_borough_comparison": f"""SELECT borough, CASE borough WHEN 'MANHATTAN' THEN 'Manhattan' WHEN 'BRONX' THEN 'Bronx'
        WHEN 'BROOKLYN' THEN 'Brooklyn' WHEN 'QUEENS' THEN 'Queens' ELSE 'Staten Island' END AS label,
        CAST(CASE borough WHEN 'MANHATTAN' THEN 1 WHEN 'BROOKLYN' THEN 2 WHEN 'QUEENS' THEN 3 WHEN 'BRONX' THEN 4 ELSE 5 END AS INTEGER) AS position,
        total_complaints, total_arrests, total_permits_issued, total_inspections FROM trends WHERE year_month = {M}""",
    "q05_score_distribution": f"""SELECT zip_code, neighborhood_pulse_score, {tier('neighborhood_pulse_score', 75, 50, 25)} AS tier
        FROM summary WHERE year_month = {M} AND borough = {B} ORDER BY neighborhood_pulse_score DESC, zip_code LIMIT 3""",
    "q06_domain_balance": """SELECT borough, year_month, CAST(greatest(0, 100 - least(total_complaints, 100)) AS DOUBLE) AS complaints,
        CAST(greatest(0, 100 - least(total_arrests, 100)) AS DOUBLE) AS safety,
        CAST(least(total_permits_issued, 100) AS DOUBLE) AS infrastructure,
        CAST(least(total_inspections, 100) AS DOUBLE) AS food_safety FROM trends""",
    "q07_complaint_summary": sums(
        "summary",
        "total_complaints:total noise_complaint_count:noise food_complaint_count:food construction_complaint_count:construction",
        by="",
        where=f"year_month = {M}",
    ),
    "q08_top_types": f"""SELECT complaint_type, complaint_count, pct_of_borough_total FROM rankings
        WHERE year_month = {M} AND borough = {B} ORDER BY complaint_count DESC, complaint_type LIMIT 10""",
    "q09_category_trend": sums("trends", "noise_complaint_count:noise food_complaint_count:food construction_complaint_count:construction"),
    "q09_category_trend_borough": sums(
        "trends", "noise_complaint_count:noise food_complaint_count:food construction_complaint_count:construction", where=f"borough = {B}"
    ),
    "q10_borough_series": "SELECT borough, year_month, total_complaints FROM trends WHERE borough IS NOT NULL",
    "q11_volume_resolution": sums("summary", "total_complaints", f"{mean_scaled('avg_resolution_hours', 100, 6)} AS avg_resolution_hours"),
    "q12_safety_summary": f"""SELECT *, coalesce({ratio('arrests', 'permits', 2)}, 0) AS arrests_per_permit FROM ({sums(
        'trends', 'total_arrests:arrests total_permits_issued:permits felony_count:felonies misdemeanor_count:misdemeanors', by='', where=f'year_month = {M}')})""",
    "q13_safety_scatter": f"""SELECT zip_code, total_arrests, total_permits_issued, log_arrests, log_permits,
        coalesce(felony_pct, 0) AS felony_pct_display FROM safety_logs
        WHERE year_month = {M} AND (total_arrests > 0 OR total_permits_issued > 0)""",
    "q14_arrest_trend": sums("trends", "felony_count misdemeanor_count total_arrests"),
    "q14_permit_trend": sums("trends", "total_permits_issued", where=f"borough = {B}"),
    "q15_permit_ratio_rows": f"""SELECT borough, year_month, CAST(position AS INTEGER) AS position,
        {ratio('total_arrests', 'total_permits_issued', 2)} AS arrests_per_permit
        FROM trends JOIN {RECENT} USING (year_month)""",
    "q15_permit_ratio_matrix": f"""SELECT borough, {', '.join(
        f"max(r) FILTER (WHERE position = {i}) AS m{i:02d}" for i in range(1, 25))}
        FROM (SELECT borough, position, {ratio('total_arrests', 'total_permits_issued', 2)} AS r
            FROM trends JOIN {RECENT} USING (year_month) WHERE borough IS NOT NULL) GROUP BY borough""",
    "q16_food_summary": sums(
        "food",
        "total_inspections:inspections unique_restaurants_inspected:unique_restaurants food_complaint_count:food_complaints",
        f"{mean_scaled('pct_grade_a', 10000, 8)} AS avg_pct_a",
        "",
        f"year_month = {M} AND zip_code IN (SELECT zip_code FROM zips WHERE borough = {B})",
    ),
    "q17_grade_means": f"""SELECT 'ALL' AS zip_code,
        {', '.join(f'{mean_percent(f"pct_grade_{c}")} AS pct_grade_{c}' for c in "abc")} FROM {GRADED} HAVING count(*) > 0""",
    "q17_grade_rows": f"""SELECT zip_code, {', '.join(f'{percent(f"pct_grade_{c}")} AS pct_grade_{c}' for c in "abc")}
        FROM {GRADED}""",
    "q18_compliance_scatter": f"""WITH g AS (SELECT zip_code, pct_grade_a, food_complaints_per_inspection, total_inspections FROM food
            WHERE year_month = {M} AND pct_grade_a IS NOT NULL AND food_complaints_per_inspection IS NOT NULL)
        SELECT g.*, (SELECT median(pct_grade_a) FROM g) AS median_grade_a,
            (SELECT median(food_complaints_per_inspection) FROM g) AS median_complaints FROM g""",
    "q19_inspection_volume": sums("food", "total_inspections unique_restaurants_inspected"),
    "q19_grade_a_trend": f"""SELECT year_month, {ratio('sum(CAST(round(pct_grade_a * 10000) AS BIGINT))', '(count(pct_grade_a) * 100)', 4)} AS avg_grade_a
        FROM food WHERE pct_grade_a IS NOT NULL GROUP BY year_month""",
    "q20_food_critical": sums("trends", "food_complaint_count critical_violation_count"),
    "q21_latest_scores": f"""SELECT borough, year_month, avg_pulse_score, {tier('avg_pulse_score', 75, 50, 25)} AS tier,
        {tier('avg_pulse_score', 70, 50, 30)} AS city_tier FROM trends
        WHERE avg_pulse_score IS NOT NULL AND year_month = (SELECT max(year_month) FROM trends WHERE avg_pulse_score IS NOT NULL)""",
    "q21_monthly_activity": sums("trends", "total_complaints total_arrests total_permits_issued total_inspections"),
    "q22_arrest_composition": rows_of(
        "summary", "category", {"Felonies": "felony_count", "Misdemeanors": "misdemeanor_count", "Violations": "violation_count"}
    ),
    "q23_export_rows": """WITH c AS (SELECT 'neighborhood_pulse_summary' AS export, count(*) AS row_count FROM summary
        UNION ALL SELECT 'borough_monthly_trends', count(*) FROM trends UNION ALL SELECT 'safety_infrastructure_corr', count(*) FROM safety
        UNION ALL SELECT 'food_compliance_overview', count(*) FROM food UNION ALL SELECT 'complaint_type_rankings', count(*) FROM rankings)
        SELECT * FROM c UNION ALL SELECT 'all', CAST(sum(row_count) AS BIGINT) FROM c""",
    "export_contract": "SELECT export, rows, TRUE AS within_limit, 0 AS problems FROM (" + " UNION ALL ".join(
        f"SELECT '{name}' AS export, count(*) AS rows FROM {table}"
        for name, table in (
            ("neighborhood_pulse_summary", "summary"), ("borough_monthly_trends", "trends"),
            ("safety_infrastructure_corr", "safety"), ("food_compliance_overview", "food"),
            ("complaint_type_rankings", "rankings"),
        )
    ) + ")",
    "q23_boroughs": "SELECT DISTINCT borough FROM summary WHERE borough IS NOT NULL",
    "q23_year_months": "SELECT DISTINCT year_month FROM summary",
    "q23_zip_codes": f"SELECT DISTINCT zip_code FROM summary WHERE borough = {B}",
    "q24_domain_totals": rows_of(
        "summary",
        "domain",
        {"complaints": "total_complaints", "arrests": "total_arrests", "permits": "total_permits_issued", "inspections": "total_inspections"},
    ),
    "score_tiers": f"""SELECT {tier('neighborhood_pulse_score', 75, 50, 25)} AS tier,
        {tier('neighborhood_pulse_score', 70, 50, 30)} AS city_tier, count(*) AS n FROM summary GROUP BY ALL""",
}

# Columns that no row may lack, by table and source.
FILLED = {
    ("complaints", "complaints"): "complaint_id created_date zip_code",
    ("arrests", "arrests"): "arrest_id arrest_date borough zip_code",
    ("permits", "permits"): "permit_key job_number permit_sequence_number borough issuance_date",
    ("inspections", "inspections"): "inspection_record_key restaurant_id inspection_date",
    ("monthly_complaints", "m_complaints"): "zip_code year_month total_complaints",
    ("monthly_arrests", "m_arrests"): "zip_code year_month total_arrests",
    ("monthly_permits", "m_permits"): "zip_code year_month total_permits_issued",
    ("monthly_inspections", "m_inspections"): "zip_code year_month total_inspections",
    ("complaints_with_permits", "pairs"): "zip_code year_month",
    ("zip_codes", "zips"): "zip_code borough",
    ("complaint_types", f"({QUERIES['dim_complaint_types']})"): "complaint_type_key complaint_type",
    ("permit_types", f"({QUERIES['dim_permit_types']})"): "permit_type_key permit_type",
    ("dates", "dates"): "year_month year month quarter month_name is_current_month is_complete_month",
    ("fact", "fact"): "zip_code year_month borough total_complaints total_arrests total_permits_issued "
    "total_inspections neighborhood_pulse_score",
    ("pulse", "pulse"): "zip_code year_month borough neighborhood_pulse_score",
    ("safety", "safety"): "zip_code year_month",
    ("food", "food"): "zip_code year_month",
    ("top_types", "top_types"): "borough year_month complaint_type borough_rank",
}
KEYS = {
    "complaints": ["complaint_id"],
    "arrests": ["arrest_id"],
    "permits": ["permit_key"],
    "inspections": ["inspection_record_key"],
    "zip_codes": ["zip_code"],
    "complaint_types": ["complaint_type_key", "complaint_type"],
    "permit_types": ["permit_type_key", "permit_type"],
    "dates": ["year_month"],
    "fact": ["zip_code,year_month"],
}
QUERIES["dq_all_layers"] = " UNION ALL ".join(
    [
        check(f"{table}.not_null:{column}", source, f"{column} IS NULL")
        for (table, source), columns in FILLED.items()
        for column in columns.split()
    ]
    + [
        check_rows(f"{table}.unique:{key}", f"SELECT {key} FROM {source} GROUP BY ALL HAVING count(*) > 1")
        for table, source in FILLED
        for key in KEYS.get(table, [])
    ]
    + [
        check(
            "complaints.not_null:borough",
            "complaints",
            "trim(borough_raw) IS NOT NULL AND trim(borough_raw) NOT IN ('', 'Unspecified') AND borough IS NULL",
        ),
        check(
            "complaints.accepted_values:complaint_status",
            "complaints",
            "complaint_status NOT IN ('Open', 'Closed', 'Pending', 'Started', 'Assigned', 'In Progress', 'Draft', 'Unspecified')",
        ),
        check("complaints.not_after:created_date", "complaints", f"CAST(created_date AS DATE) > {AS_OF}"),
        check("arrests.accepted_values:law_category", "arrests", "law_category NOT IN ('F', 'M', 'V', '9', 'I')"),
        check("arrests.accepted_values:zip_code_source", "arrests", "zip_code_source NOT IN ('spatial', 'borough_fallback')"),
        check("arrests.not_after:arrest_date", "arrests", f"arrest_date > {AS_OF}"),
        check("permits.not_null:zip_code", "permits", "zip_code IS NULL", "warn"),
        check("permits.not_after:issuance_date", "permits", f"issuance_date > {AS_OF}"),
        check("inspections.not_null:zip_code", "inspections", "zip_code IS NULL", "warn"),
        check("inspections.not_null:borough", "inspections", "borough_raw <> '0' AND borough IS NULL"),
        check(
            "inspections.accepted_values:is_critical_violation",
            "inspections",
            "is_critical_violation NOT IN ('Critical', 'Not Critical', 'Not Applicable')",
        ),
        check("inspections.accepted_values:inspection_grade", "inspections", "inspection_grade NOT IN ('A', 'B', 'C', 'Z', 'P', 'N')"),
        check("inspections.not_after:inspection_date", "inspections", f"inspection_date > {AS_OF}"),
        check("fact.in_range:neighborhood_pulse_score", "fact", "neighborhood_pulse_score NOT BETWEEN 0 AND 100"),
        check_rows("fact.relationship:zip_code", "SELECT 1 FROM fact WHERE zip_code NOT IN (SELECT zip_code FROM zips)"),
        check_rows("fact.relationship:year_month", "SELECT 1 FROM fact WHERE year_month NOT IN (SELECT year_month FROM dates)"),
    ]
)

_WORDS = re.compile(r"\b[a-z_][a-z_0-9]*\b")


def _with(text: str) -> str:
    """The query behind the CTEs it needs, in their order of definition."""
    needed: set[str] = set()
    open_texts = [text]
    while open_texts:
        for word in set(_WORDS.findall(open_texts.pop())) & CTES.keys() - needed:
            needed.add(word)
            open_texts.append(CTES[word])
    heads = [f"{n} AS ({CTES[n]})" for n in CTES if n in needed]
    return f"WITH {', '.join(heads)} SELECT * FROM ({text})" if heads else text


def oracle_queries() -> dict[str, str]:
    return {name: _with(text) for name, text in QUERIES.items()}
