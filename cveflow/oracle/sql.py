"""The same results in DuckDB SQL, one statement per query key.

Written from the semantics, not from the Spark plans: plain casts, windows and joins.  Dates and
times come out as text, lists joined with commas, unrounded doubles rounded to eight places; averages
are exact and rounded once.
"""

from __future__ import annotations

import datetime as dt

from cveflow.sources import testfeeds

AS_OF = testfeeds.AS_OF
FIRST_RUN = "2001-08-01"
SPLIT_NEW, SPLIT_CHANGED = "2001-01-01", "1999-01-01"
KPI_DAYS = ("2001-06-01", "2001-07-20", AS_OF)

STRICT = r"'^CVE-\d{4}-\d{4,}$'"
LOOSE = "'^CVE-[0-9]{4}-[0-9]+$'"


def _raw(feed: str) -> str:
    text = testfeeds.STATEMENTS[feed].replace("{orders}", "orders").replace("{lineitem}", "lineitem")
    for sep in ("';'", "'\",\"'"):
        text = text.replace(f"listagg(cve, {sep}) WITHIN GROUP (ORDER BY cve)", f"string_agg(cve, {sep} ORDER BY cve)")
    return text


def _day(c: str) -> str:
    return f"try_strptime({c}, '%Y-%m-%d')::DATE"


def _clamp(c: str) -> str:
    return f"CASE WHEN {c} > 1 THEN 1.0::DOUBLE WHEN {c} < 0 THEN 0.0::DOUBLE ELSE {c} END"


def _txt(c: str) -> str:
    return f"cast({c} AS VARCHAR) AS {c}"


def _time(c: str, out: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {out or c}"


def _list(c: str) -> str:
    return f"array_to_string({c}, ',') AS {c}"


def _ymd(c: str) -> str:
    return ", ".join(f"cast({part}({c}) AS INTEGER) AS {part}" for part in ("year", "month", "day"))


def _r8(c: str) -> str:
    return f"round({c}, 8) AS {c}"


def _mean(c: str, places: int, where: str = "") -> str:
    """Average rounded half up once, in whole numbers; values are not negative and have at most nine places."""
    only = f" FILTER (WHERE {where})" if where else ""
    total = f"cast(sum(cast({c} AS DECIMAL(18, 9))){only} * 1000000000 AS HUGEINT)"
    unit = f"(cast(count({c}){only} AS HUGEINT) * {10 ** (9 - places)})"
    return f"cast((2 * {total} + {unit}) // (2 * {unit}) AS DOUBLE) / {10 ** places}"


def _n(cond: str) -> str:
    return f"cast(count(*) FILTER (WHERE {cond}) AS BIGINT)"


def _pct(a: str, b: str, places: int) -> str:
    return f"round(cast({a} AS DOUBLE) / {b} * 100, {places})"


NEWEST = "_ingested_at DESC NULLS LAST, _batch_id DESC NULLS LAST"

# Named subqueries; each may use those before it.
CTE: dict[str, str] = {f"raw_{f}": _raw(f) for f in testfeeds.STATEMENTS}

CTE["nvd_rows"] = f"""
SELECT upper(trim(id)) AS cve_id, sourceIdentifier, try_cast(published AS TIMESTAMP) AS published_ts,
  try_cast(lastModified AS TIMESTAMP) AS last_modified_ts, vulnStatus,
  json_extract_string(descriptions, '$[0].value') AS description_en,
  coalesce(try_cast(json_extract_string(metrics, '$.cvssMetricV31[0].cvssData.baseScore') AS DOUBLE), 0.0::DOUBLE) AS cvss_v31_base_score,
  coalesce(json_extract_string(metrics, '$.cvssMetricV31[0].cvssData.baseSeverity'), 'UNKNOWN') AS cvss_v31_severity,
  json_extract_string(metrics, '$.cvssMetricV31[0].cvssData.vectorString') AS cvss_v31_vector,
  json_extract_string(metrics, '$.cvssMetricV31[0].cvssData.attackVector') AS cvss_v31_attack_vector,
  json_extract_string(metrics, '$.cvssMetricV31[0].cvssData.attackComplexity') AS cvss_v31_attack_complexity,
  json_extract_string(weaknesses, '$[0].description[0].value') AS primary_cwe,
  refs AS "references", _ingested_at, _source, _batch_id
FROM raw_nvd WHERE regexp_matches(upper(trim(id)), {STRICT})"""
CTE["nvd"] = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY cve_id
  ORDER BY last_modified_ts DESC NULLS LAST, {NEWEST}) AS rn FROM nvd_rows) WHERE rn = 1"""

CTE["kev_rows"] = f"""
SELECT upper(trim(cveID)) AS cve_id, trim(vendorProject) AS vendor_project, trim(product) AS product,
  trim(vulnerabilityName) AS vulnerability_name, {_day('dateAdded')} AS date_added,
  trim(shortDescription) AS short_description, trim(requiredAction) AS required_action, {_day('dueDate')} AS due_date,
  coalesce(lower(knownRansomwareCampaignUse) = 'known', false) AS is_ransomware_related,
  notes, {_day('substring(dateReleased, 1, 10)')} AS date_released, _ingested_at, _batch_id
FROM raw_kev WHERE regexp_matches(upper(trim(cveID)), {STRICT})"""
CTE["kev"] = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY cve_id ORDER BY {NEWEST}) AS rn
  FROM kev_rows) WHERE rn = 1"""

CTE["epss_rows"] = f"""
SELECT cve_id, {_clamp('e')} AS epss_score, {_clamp('p')} AS epss_percentile, score_date, _ingested_at, _batch_id
FROM (SELECT upper(trim(cve)) AS cve_id, try_cast(epss AS DOUBLE) AS e, try_cast(percentile AS DOUBLE) AS p,
        {_day('date')} AS score_date, _ingested_at, _batch_id FROM raw_epss)
WHERE regexp_matches(cve_id, {STRICT}) AND e IS NOT NULL"""
CTE["epss"] = f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY cve_id, score_date ORDER BY {NEWEST}) AS rn
  FROM epss_rows) WHERE rn = 1"""

CTE["exploits"] = f"""
SELECT * EXCLUDE (rn), cast(len(cve_ids) AS INTEGER) AS cve_count FROM (SELECT trim(id) AS exploit_id, file, description,
    {_day('date_published')} AS date_published_dt, author, lower(trim(platform)) AS platform_clean,
    lower(trim(type)) AS exploit_type, try_cast(port AS INTEGER) AS port_num,
    list_filter(string_split(codes, ';'), lambda x: regexp_matches(x, {LOOSE})) AS cve_ids,
    _ingested_at, _batch_id,
    row_number() OVER (PARTITION BY trim(id) ORDER BY {NEWEST}) AS rn
  FROM raw_exploits WHERE trim(id) <> '') WHERE rn = 1"""
CTE["modules"] = f"""
SELECT * EXCLUDE (rn), cast(len(cve_ids) AS INTEGER) AS cve_count FROM (SELECT fullname, name, title,
    lower(trim(type)) AS module_type, from_json(platform, '["VARCHAR"]') AS platforms,
    lower(trim(rank)) AS rank_label,
    CASE lower(rank) WHEN 'excellent' THEN 7 WHEN 'great' THEN 6 WHEN 'good' THEN 5 WHEN 'normal' THEN 4
      WHEN 'average' THEN 3 WHEN 'low' THEN 2 WHEN 'manual' THEN 1 ELSE try_cast(rank AS INTEGER) END AS rank_numeric,
    {_day('disclosure_date')} AS disclosure_date_dt,
    try_strptime(substring(mod_time, 1, 19), '%Y-%m-%d %H:%M:%S') AS mod_time_ts, '' AS description,
    from_json(author, '["VARCHAR"]') AS authors,
    list_filter(from_json(refs, '["VARCHAR"]'), lambda x: regexp_matches(x, {LOOSE})) AS cve_ids,
    '' AS rport, '' AS "check", '' AS post_auth, _ingested_at, _batch_id,
    row_number() OVER (PARTITION BY fullname ORDER BY {NEWEST}) AS rn
  FROM raw_modules WHERE fullname <> '') WHERE rn = 1"""

CTE["exploit_links"] = """
SELECT unnest(cve_ids) AS cve_id, exploit_id, description AS exploit_description, date_published_dt,
  author AS exploit_author, platform_clean, exploit_type, port_num FROM exploits"""
CTE["module_links"] = """
SELECT unnest(cve_ids) AS cve_id, fullname, title AS msf_title, module_type, rank_label, rank_numeric,
  disclosure_date_dt FROM modules"""
CTE["exploit_agg"] = """
SELECT cve_id, count(exploit_id) AS exploit_count, list_sort(list(DISTINCT platform_clean)) AS exploit_platforms, list_sort(list(DISTINCT exploit_type)) AS exploit_types,
  min(date_published_dt) AS earliest_exploit_date FROM exploit_links GROUP BY cve_id"""
CTE["module_agg"] = """
SELECT cve_id, count(fullname) AS msf_module_count, list_sort(list(DISTINCT module_type)) AS msf_module_types, max(rank_numeric) AS msf_max_rank
FROM module_links GROUP BY cve_id"""
CTE["epss_latest"] = """
SELECT cve_id, epss_score, epss_percentile, score_date AS epss_score_date FROM (
  SELECT *, row_number() OVER (PARTITION BY cve_id ORDER BY score_date DESC NULLS LAST) AS rn FROM epss) WHERE rn = 1"""

CTE["master"] = f"""
SELECT n.cve_id, n.sourceIdentifier, n.published_ts, n.last_modified_ts, n.vulnStatus, n.description_en,
  n.cvss_v31_base_score, n.cvss_v31_severity, n.cvss_v31_vector, n.cvss_v31_attack_vector,
  n.cvss_v31_attack_complexity, n.primary_cwe, k.vendor_project, k.product, k.vulnerability_name,
  k.date_added, k.due_date, coalesce(k.is_ransomware_related, false) AS is_ransomware_related,
  k.required_action, k.cve_id IS NOT NULL AS in_cisa_kev,
  coalesce(e.epss_score, 0.0::DOUBLE) AS epss_score, coalesce(e.epss_percentile, 0.0::DOUBLE) AS epss_percentile,
  e.epss_score_date, coalesce(x.exploit_count, 0) AS exploit_count, x.exploit_platforms,
  x.exploit_types, x.earliest_exploit_date, coalesce(m.msf_module_count, 0) AS msf_module_count,
  m.msf_module_types, coalesce(m.msf_max_rank, 0) AS msf_max_rank,
  coalesce(x.exploit_count, 0) > 0 AS has_public_exploit, coalesce(m.msf_module_count, 0) > 0 AS has_msf_module,
  cast(DATE '{AS_OF}' - cast(n.published_ts AS DATE) AS INTEGER) AS days_since_published
FROM nvd n LEFT JOIN kev k USING (cve_id) LEFT JOIN epss_latest e USING (cve_id)
  LEFT JOIN exploit_agg x USING (cve_id) LEFT JOIN module_agg m USING (cve_id)"""

CTE["risk"] = """
SELECT *, CASE WHEN composite_risk_score >= 0.75 THEN 'CRITICAL' WHEN composite_risk_score >= 0.5 THEN 'HIGH'
    WHEN composite_risk_score >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
  cast(dense_rank() OVER (ORDER BY composite_risk_score DESC) AS INTEGER) AS priority_rank
FROM (SELECT cve_id, description_en, cvss_v31_base_score, cvss_v31_severity, epss_score, epss_percentile,
  in_cisa_kev, is_ransomware_related, has_public_exploit, exploit_count, has_msf_module, msf_module_count,
  round(cvss_v31_base_score / 10.0::DOUBLE * 0.30::DOUBLE + epss_score * 0.25::DOUBLE
    + (CASE WHEN in_cisa_kev THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 0.20::DOUBLE
    + (CASE WHEN has_public_exploit THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 0.10::DOUBLE
    + (CASE WHEN has_msf_module THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 0.10::DOUBLE
    + (CASE WHEN is_ransomware_related THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 0.05::DOUBLE, 4) AS composite_risk_score,
  published_ts, days_since_published, primary_cwe, vendor_project, product FROM master)"""

CTE["readiness"] = """
SELECT *, CASE WHEN days_to_exploit IS NULL THEN NULL WHEN days_to_exploit = 0 THEN 'SAME_DAY'
    WHEN days_to_exploit <= 7 THEN 'WITHIN_7D' WHEN days_to_exploit <= 30 THEN 'WITHIN_30D'
    WHEN days_to_exploit <= 90 THEN 'WITHIN_90D' ELSE 'OVER_90D' END AS t2e_category
FROM (SELECT cve_id, description_en, cvss_v31_severity, cvss_v31_base_score, epss_score, primary_cwe, published_ts,
  earliest_exploit_date, has_public_exploit, exploit_count, has_msf_module, msf_module_count,
  CASE WHEN has_public_exploit AND has_msf_module THEN 'FULL' WHEN has_msf_module THEN 'MODULE_ONLY'
    WHEN has_public_exploit THEN 'EXPLOIT_ONLY' ELSE 'NONE' END AS weaponization_level, in_cisa_kev,
  CASE WHEN has_public_exploit AND earliest_exploit_date >= cast(published_ts AS DATE)
    THEN cast(earliest_exploit_date - cast(published_ts AS DATE) AS INTEGER) END AS days_to_exploit FROM master)"""


def _trend_columns() -> str:
    return (
        f"count(cve_id) AS new_cves, {_mean('cvss_v31_base_score', 8)} AS avg_cvss, "
        f"{_mean('epss_score', 8)} AS avg_epss, {_n('in_cisa_kev')} AS cisa_kev_count, "
        f"{_n('has_public_exploit')} AS exploitable_count"
    )


CTE["trends"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS trend_type, cast({start} AS VARCHAR) AS period, {_trend_columns()} FROM master GROUP BY {start}"
    for kind, start in (
        ("daily", "cast(published_ts AS DATE)"),
        ("weekly", "cast(date_trunc('week', published_ts) AS DATE)"),
        ("monthly", "cast(date_trunc('month', published_ts) AS DATE)"),
    )
)

# Risk and readiness after two runs: the first over advisories published before SPLIT_NEW, the
# second over those published since SPLIT_CHANGED.
for _name in ("risk", "readiness"):
    CTE[f"{_name}_runs"] = f"""
SELECT *, CASE WHEN published_ts >= TIMESTAMP '{SPLIT_CHANGED}' THEN DATE '{AS_OF}' ELSE DATE '{FIRST_RUN}' END AS run
FROM {_name}"""

RISK_COLUMNS = f"""cve_id, description_en, {_r8('cvss_v31_base_score')}, cvss_v31_severity, {_r8('epss_score')},
  {_r8('epss_percentile')}, in_cisa_kev, is_ransomware_related, has_public_exploit, exploit_count, has_msf_module,
  msf_module_count, {_r8('composite_risk_score')}, risk_tier, priority_rank, {_time('published_ts')},
  days_since_published, primary_cwe, vendor_project, product"""


def _kpis(day: str) -> str:
    d = dt.date.fromisoformat(day)
    this = d.replace(day=1)
    last = (this - dt.timedelta(days=1)).replace(day=1)

    def since(x: dt.date) -> str:
        return f"cast(published_ts AS DATE) >= DATE '{x}'"

    back = {n: since(d - dt.timedelta(days=n)) for n in (7, 30, 90)}
    tier = "(SELECT count(*) FROM risk WHERE risk_tier = '{}') + 0 * count(*)"
    previous = f"{since(last)} AND cast(published_ts AS DATE) < DATE '{this}'"
    def avg(c: str, places: int) -> str:
        return f"coalesce({_mean(c, places, f'{c} > 0')}, 0)"

    rows = [
        ("total_active_cves", "count(*)", "count", "all_time"),
        ("new_cves_today", _n(f"cast(published_ts AS DATE) = DATE '{d}'"), "count", "daily"),
        ("new_cves_this_week", _n(back[7]), "count", "weekly"),
        ("new_cves_this_month", _n(back[30]), "count", "monthly"),
        ("new_cves_this_quarter", _n(back[90]), "count", "quarterly"),
        ("avg_cvss_scored", avg("cvss_v31_base_score", 2), "score", "all_time"),
        ("avg_epss_scored", avg("epss_score", 5), "score", "all_time"),
        ("high_epss_count", _n("epss_score > 0.5"), "count", "all_time"),
        ("critical_risk_count", tier.format("CRITICAL"), "count", "all_time"),
        ("high_risk_count", tier.format("HIGH"), "count", "all_time"),
        ("medium_risk_count", tier.format("MEDIUM"), "count", "all_time"),
        ("low_risk_count", tier.format("LOW"), "count", "all_time"),
        ("exploitable_count", _n("has_public_exploit"), "count", "all_time"),
        ("exploitable_pct", _pct(_n("has_public_exploit"), "greatest(count(*), 1)", 1), "percentage", "all_time"),
        ("msf_module_count", _n("has_msf_module"), "count", "all_time"),
        ("cisa_kev_count", _n("in_cisa_kev"), "count", "all_time"),
        ("cisa_kev_pct", _pct(_n("in_cisa_kev"), "greatest(count(*), 1)", 1), "percentage", "all_time"),
        ("ransomware_related_count", _n("is_ransomware_related"), "count", "all_time"),
        ("unpatched_critical",
         _n("cvss_v31_base_score >= 9 AND vulnStatus NOT IN ('Rejected', 'Analyzed')"), "count", "all_time"),
        ("mom_change_pct",
         f"round(cast({_n(since(this))} - {_n(previous)} AS DOUBLE) / greatest({_n(previous)}, 1) * 100, 1)",
         "percentage", "monthly"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{n}' AS kpi_name, cast({e} AS DOUBLE) AS kpi_value, '{k}' AS kpi_type, '{w}' AS time_window, "
        f"DATE '{d}' AS computed_date FROM master"
        for n, e, k, w in rows
    )


CTE["kpis"] = _kpis(AS_OF)
CTE["kpi_runs"] = " UNION ALL ".join(f"({_kpis(d)})" for d in KPI_DAYS)

# What each named subquery needs directly.
NEEDS = {
    "nvd_rows": ["raw_nvd"], "nvd": ["nvd_rows"], "kev_rows": ["raw_kev"], "kev": ["kev_rows"],
    "epss_rows": ["raw_epss"], "epss": ["epss_rows"], "exploits": ["raw_exploits"], "modules": ["raw_modules"],
    "exploit_links": ["exploits"], "module_links": ["modules"], "exploit_agg": ["exploit_links"],
    "module_agg": ["module_links"], "epss_latest": ["epss"],
    "master": ["nvd", "kev", "epss_latest", "exploit_agg", "module_agg"],
    "risk": ["master"], "readiness": ["master"], "trends": ["master"],
    "risk_runs": ["risk"], "readiness_runs": ["readiness"], "kpis": ["master", "risk"],
    "kpi_runs": ["master", "risk"],
}


def _with(name: str, select: str) -> str:
    """``select`` over the named subquery and everything below it."""
    used: list[str] = []

    def visit(n: str) -> None:
        for need in NEEDS.get(n, []):
            visit(need)
        if n not in used:
            used.append(n)

    visit(name)
    body = ",\n".join(f"{n} AS MATERIALIZED ({CTE[n].strip()})" for n in used)
    return f"WITH {body}{select if select.lstrip().startswith(',') else chr(10) + select.strip()}"


def _latest(rows: str, keys: str, order: str, out: str) -> str:
    return _with(rows, f"SELECT {out} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
                       f"FROM {rows}) WHERE rn = 1")


NVD_COLUMNS = f"""cve_id, sourceIdentifier, {_time('published_ts')}, {_time('last_modified_ts')}, vulnStatus, description_en,
  {_r8('cvss_v31_base_score')}, cvss_v31_severity, cvss_v31_vector, cvss_v31_attack_vector,
  cvss_v31_attack_complexity, primary_cwe"""
VENDOR = f"""
SELECT vendor_project, count(cve_id) AS total_cves, {_mean('cvss_v31_base_score', 2)} AS avg_cvss,
  {_mean('epss_score', 5)} AS avg_epss, {_n('in_cisa_kev')} AS kev_count, {_n('has_public_exploit')} AS exploitable,
  {_n('has_msf_module')} AS msf_modules, {_n("cvss_v31_severity = 'CRITICAL'")} AS critical_cves,
  {_pct(_n('has_public_exploit'), 'count(cve_id)', 1)} AS exploit_rate_pct
FROM master WHERE vendor_project IS NOT NULL AND vendor_project <> '' GROUP BY vendor_project
HAVING count(cve_id) >= 5 AND {_n('has_public_exploit')} >= 1
ORDER BY kev_count DESC, total_cves DESC, vendor_project"""
ALERTS = f"""
SELECT cve_id, description_en, {_r8('cvss_v31_base_score')}, cvss_v31_severity, {_r8('epss_score')}, in_cisa_kev,
  has_public_exploit, has_msf_module, is_ransomware_related, {_time('published_ts')}, vendor_project, product
FROM master WHERE cast(published_ts AS DATE) >= DATE '{AS_OF}' - 7
  AND (cvss_v31_base_score >= 9 OR in_cisa_kev OR epss_score > 0.7)"""
LEVELS = f"""weaponization_level, count(*) AS cve_count, {_mean('cvss_v31_base_score', 2)} AS avg_cvss,
  {_mean('epss_score', 5)} AS avg_epss, {_n('in_cisa_kev')} AS in_kev"""
MASTER_COLUMNS = f"""{NVD_COLUMNS}, vendor_project, product, vulnerability_name, {_txt('date_added')}, {_txt('due_date')},
  is_ransomware_related, required_action, in_cisa_kev, {_r8('epss_score')}, {_r8('epss_percentile')},
  {_txt('epss_score_date')}, exploit_count, {_list('exploit_platforms')},
  {_list('exploit_types')}, {_txt('earliest_exploit_date')}, msf_module_count, {_list('msf_module_types')}, msf_max_rank, has_public_exploit, has_msf_module, days_since_published"""
READINESS_COLUMNS = f"""cve_id, description_en, cvss_v31_severity, {_r8('cvss_v31_base_score')}, {_r8('epss_score')},
  primary_cwe, {_time('published_ts')}, {_txt('earliest_exploit_date')}, has_public_exploit, exploit_count,
  has_msf_module, msf_module_count, weaponization_level, in_cisa_kev, days_to_exploit, t2e_category"""
STEP = 119
Q: dict[str, str] = {}

# Sources
Q["q_read_nvd"] = _with("raw_nvd", """
SELECT id, sourceIdentifier, published, lastModified, vulnStatus, descriptions, metrics, weaknesses,
  refs AS "references", '[]' AS cveTags, '[]' AS configurations FROM raw_nvd""")
Q["q_read_kev"] = _with("raw_kev", """
SELECT cveID, vendorProject, product, vulnerabilityName, dateAdded, requiredAction, dueDate,
  knownRansomwareCampaignUse, shortDescription, notes, catalogVersion, dateReleased, cast(count(*) OVER (
    PARTITION BY catalogVersion, dateReleased, cast(regexp_extract(cveID, '([0-9]+)$', 1) AS BIGINT) // 1000) AS VARCHAR) AS "count"
FROM raw_kev""")
Q["q_read_epss"] = _with("raw_epss", """
SELECT cve, epss, percentile, date FROM raw_epss""")
Q["q_read_exploits"] = _with("raw_exploits", """
SELECT id, file, description, date_published, author, platform, type, port, codes FROM raw_exploits""")
Q["q_read_quoted"] = _with("raw_exploits", """
SELECT id, file, 'say "' || description || '",' || chr(10) || chr(10) || 'then ' || id AS description, date_published, author,
  platform, type, port, codes FROM raw_exploits""")
Q["q_read_modules"] = _with("raw_modules", """
SELECT fullname, name, title, rank, disclosure_date, type, platform, mod_time, author, refs AS "references",
  '[]' AS aliases, '[]' AS arch, '[]' AS autofilter_ports, '[]' AS autofilter_services, '[]' AS targets, '{}' AS notes,
  '[]' AS session_types, '[]' AS actions, '' AS rport, '' AS path, '' AS is_install_path, '' AS ref_name, '' AS "check",
  '' AS post_auth, '' AS default_credential, '' AS needs_cleanup, '' AS description FROM raw_modules""")
Q["q_stamp"] = _with("raw_epss", f"""
SELECT cve, epss, percentile, date, '{AS_OF} 06:30:00' AS _ingested_at, 'epss_api' AS _source, 'batch-1' AS _batch_id,
  2001 AS year, 8 AS month, 2 AS day FROM raw_epss""")
Q["q_plan_windows"] = _with("raw_nvd", f"""
, m AS (SELECT cast(lastModified AS TIMESTAMP) AS ts FROM raw_nvd),
s AS (SELECT cast(cast(min(ts) AS DATE) AS TIMESTAMP) AS since FROM m),
w AS (SELECT i, since + to_days(cast(i * {STEP} AS INTEGER)) AS window_start,
        least(since + to_days(cast((i + 1) * {STEP} AS INTEGER)), TIMESTAMP '{AS_OF}') AS window_end
      FROM (SELECT since, unnest(range(0, cast(ceil(date_diff('day', since, TIMESTAMP '{AS_OF}') / {STEP}.0) AS BIGINT))) AS i FROM s)),
c AS (SELECT cast(floor((epoch(least(ts, TIMESTAMP '{AS_OF}' - INTERVAL 1 SECOND)) - epoch(since)) / ({STEP} * 86400)) AS BIGINT) AS i,
        count(*) AS total FROM m, s WHERE ts <= TIMESTAMP '{AS_OF}' GROUP BY 1)
SELECT {_time('window_start')}, {_time('window_end')}, total, unnest(range(0, total, 2000)) AS "offset"
FROM w JOIN c USING (i)""")
Q["q_high_water"] = _with("raw_nvd", """
SELECT max(lastModified) AS high_water_mark FROM raw_nvd WHERE _source <> 'synthetic'""")
Q["q_top_up"] = _with("raw_nvd", """
SELECT id, published, lastModified, vulnStatus, _source FROM raw_nvd WHERE _source = 'nvd_api'
UNION ALL SELECT id, published, NULL, NULL, _source FROM raw_nvd WHERE _source = 'synthetic'""")
Q["q_incremental"] = _with("raw_nvd", """
SELECT id, lastModified, _batch_id FROM raw_nvd""")

# Sinks
Q["q_append_roundtrip"] = _with("kev_rows", f"""
SELECT cve_id, {_txt('date_added')}, {_txt('due_date')}, {_ymd('_ingested_at')} FROM kev_rows""")
Q["q_overwrite_roundtrip"] = _with("nvd", f"""
SELECT cve_id, {_time('last_modified_ts')}, {_ymd('_ingested_at')} FROM nvd""")
Q["q_clustered_write"] = _with("master", f"SELECT cve_id, {_time('published_ts')}, {_r8('epss_score')} FROM master")
Q["q_upsert"] = _with("risk_runs", f"""
SELECT {RISK_COLUMNS}, {_ymd('run')} FROM risk_runs""")
Q["q_merge_changes"] = Q["q_upsert"]
Q["q_compact"] = Q["q_append_roundtrip"]
Q["q_partition_scan"] = _with("risk_runs", f"""
SELECT {RISK_COLUMNS}, {_ymd('run')} FROM risk_runs
WHERE run = DATE '{AS_OF}'""")

# Cleaning
Q["q_clean_ids"] = _with("raw_nvd", f"""
SELECT id, upper(trim(id)) AS cve_id, _batch_id FROM raw_nvd WHERE regexp_matches(upper(trim(id)), {STRICT})""")
Q["q_json_extract"] = _with("nvd_rows", f"""
SELECT cve_id, description_en, {_r8('cvss_v31_base_score')}, cvss_v31_severity, cvss_v31_vector,
  cvss_v31_attack_vector, cvss_v31_attack_complexity, primary_cwe, _batch_id FROM nvd_rows""")
Q["q_parse_dates"] = _with("raw_kev", f"""
SELECT cveID, cast({_day('dateAdded')} AS VARCHAR) AS date_added, cast({_day('dueDate')} AS VARCHAR) AS due_date,
  _batch_id FROM raw_kev""")
Q["q_clamp"] = _with("raw_epss", f"""
SELECT cve, _batch_id, round({_clamp('try_cast(epss AS DOUBLE)')}, 8) AS epss_score,
  round({_clamp('try_cast(percentile AS DOUBLE)')}, 8) AS epss_percentile FROM raw_epss""")
Q["q_extract_codes"] = _with("raw_exploits", f"""
SELECT file, id, array_to_string(ids, ',') AS cve_ids, cast(len(ids) AS INTEGER) AS cve_count FROM (
  SELECT file, id, list_filter(string_split(codes, ';'), lambda x: regexp_matches(x, {LOOSE})) AS ids FROM raw_exploits)""")
Q["q_json_arrays"] = _with("raw_modules", """
SELECT fullname, array_to_string(from_json(platform, '["VARCHAR"]'), ',') AS platforms,
  array_to_string(from_json(author, '["VARCHAR"]'), ',') AS authors,
  array_to_string(from_json(refs, '["VARCHAR"]'), ',') AS refs FROM raw_modules""")
Q["q_rank_map"] = _with("modules", "SELECT fullname, rank_label, rank_numeric FROM modules")
Q["q_clean_nvd"] = _with("nvd", f'SELECT {NVD_COLUMNS}, "references", _source, _batch_id FROM nvd')
Q["q_clean_kev"] = _with("kev", f"""
SELECT cve_id, vendor_project, product, vulnerability_name, {_txt('date_added')}, short_description, required_action,
  {_txt('due_date')}, is_ransomware_related, notes, {_txt('date_released')}, _batch_id FROM kev""")
Q["q_clean_epss"] = _with("epss", f"""
SELECT cve_id, {_r8('epss_score')}, {_r8('epss_percentile')}, {_txt('score_date')}, _batch_id FROM epss""")
Q["q_clean_exploits"] = _with("exploits", f"""
SELECT exploit_id, file, description, {_txt('date_published_dt')}, author, platform_clean, exploit_type, port_num,
  {_list('cve_ids')}, cve_count FROM exploits""")
Q["q_clean_modules"] = _with("modules", f"""
SELECT fullname, name, title, module_type, {_list('platforms')}, rank_label, rank_numeric,
  {_txt('disclosure_date_dt')}, {_time('mod_time_ts')}, description, {_list('authors')}, {_list('cve_ids')},
  cve_count, rport, "check", post_auth FROM modules""")

# Newest row per key
Q["q_latest_nvd"] = _latest("nvd_rows", "cve_id", f"last_modified_ts DESC NULLS LAST, {NEWEST}",
                            f"cve_id, {_time('last_modified_ts')}, {_time('_ingested_at')}, _batch_id")
Q["q_stream_upsert"] = Q["q_latest_nvd"]
Q["q_latest_kev"] = _latest("kev_rows", "cve_id", NEWEST, f"cve_id, {_time('_ingested_at')}, _batch_id")
Q["q_latest_epss_day"] = _latest("epss_rows", "cve_id, score_date", NEWEST,
                                 f"cve_id, {_txt('score_date')}, {_time('_ingested_at')}, _batch_id")
Q["q_latest_exploit"] = _with("raw_exploits", f"""
SELECT id, {_time('_ingested_at')}, _batch_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {NEWEST}) AS rn
  FROM raw_exploits WHERE id <> '') WHERE rn = 1""")
Q["q_latest_module"] = _with("raw_modules", f"""
SELECT fullname, {_time('_ingested_at')}, _batch_id FROM (SELECT *, row_number() OVER (PARTITION BY fullname
  ORDER BY {NEWEST}) AS rn FROM raw_modules) WHERE rn = 1""")
Q["q_epss_latest"] = _with("epss_latest", f"""
SELECT cve_id, {_r8('epss_score')}, {_r8('epss_percentile')}, {_txt('epss_score_date')} FROM epss_latest""")

# Expansion and roll-up
Q["q_explode_exploits"] = _with("exploit_links", f"""
SELECT cve_id, exploit_id, exploit_description, {_txt('date_published_dt')}, exploit_author, platform_clean,
  exploit_type, port_num FROM exploit_links""")
Q["q_explode_modules"] = _with("module_links", f"""
SELECT cve_id, fullname, msf_title, module_type, rank_label, rank_numeric, {_txt('disclosure_date_dt')} FROM module_links""")
Q["q_exploit_ids"] = _with("exploit_links", "SELECT DISTINCT cve_id, exploit_id FROM exploit_links")
Q["q_module_names"] = _with("module_links", "SELECT DISTINCT cve_id, fullname FROM module_links")
Q["q_exploit_rollup"] = _with("exploit_agg", f"""
SELECT cve_id, exploit_count, {_list('exploit_platforms')}, {_list('exploit_types')},
  {_txt('earliest_exploit_date')} FROM exploit_agg""")
Q["q_module_rollup"] = _with("module_agg", f"""
SELECT cve_id, msf_module_count, {_list('msf_module_types')}, msf_max_rank FROM module_agg""")
Q["q_master"] = _with("master", f"SELECT {MASTER_COLUMNS} FROM master")
Q["q_age_days"] = _with("nvd", f"""
SELECT cve_id, cast(DATE '{AS_OF}' - cast(published_ts AS DATE) AS INTEGER) AS days_since_published FROM nvd""")

# Risk
Q["q_risk"] = _with("risk", f"SELECT {RISK_COLUMNS} FROM risk")
Q["q_priority_rank"] = _with("risk", f"SELECT cve_id, {_r8('composite_risk_score')}, priority_rank FROM risk")
Q["q_rank_of_any"] = _with("nvd_rows", f"""
SELECT cve_id, {_time('last_modified_ts')}, _batch_id, dense_rank() OVER (ORDER BY last_modified_ts DESC NULLS LAST)::INTEGER AS recency_rank FROM nvd_rows""")
Q["q_tier_distribution"] = _with("risk", 'SELECT risk_tier, count(*) AS "count" FROM risk GROUP BY risk_tier')
Q["q_top10"] = _with("risk", f"""
SELECT priority_rank, cve_id, round(composite_risk_score, 3) AS risk_score, risk_tier, {_r8('cvss_v31_base_score')},
  {_r8('epss_score')}, in_cisa_kev, has_public_exploit, has_msf_module, vendor_project, product
FROM risk WHERE composite_risk_score > 0.5 ORDER BY composite_risk_score DESC, cve_id LIMIT 10""")

# Trends
Q["q_trend_daily"] = _with("master", f"""
SELECT cast(cast(published_ts AS DATE) AS VARCHAR) AS publish_date, {_trend_columns()},
  {_n('has_msf_module')} AS msf_count, {_n("cvss_v31_severity = 'CRITICAL'")} AS critical_count,
  {_n("cvss_v31_severity = 'HIGH'")} AS high_count FROM master GROUP BY cast(published_ts AS DATE)""")
Q["q_trend_weekly"] = _with("master", f"""
SELECT cast(cast(date_trunc('week', published_ts) AS DATE) AS VARCHAR) AS week_start, {_trend_columns()},
  count(DISTINCT primary_cwe) AS unique_cwes FROM master GROUP BY date_trunc('week', published_ts)""")
Q["q_trend_monthly"] = _with("master", f"""
SELECT cast(cast(date_trunc('month', published_ts) AS DATE) AS VARCHAR) AS month_start, {_trend_columns()},
  {_n('has_msf_module')} AS msf_count, {_n("cvss_v31_severity = 'CRITICAL'")} AS critical_count,
  {_n("cvss_v31_severity = 'HIGH'")} AS high_count, {_n("cvss_v31_severity = 'MEDIUM'")} AS medium_count,
  {_n("cvss_v31_severity = 'LOW'")} AS low_count FROM master GROUP BY date_trunc('month', published_ts)""")
Q["q_severity_by_year"] = _with("master", """
SELECT cast(year(published_ts) AS INTEGER) AS pub_year, cvss_v31_severity, count(cve_id) AS cve_count FROM master GROUP BY 1, 2""")
Q["q_cwe_trend"] = _with("master", """
SELECT cast(year(published_ts) AS INTEGER) AS pub_year, primary_cwe, count(cve_id) AS cve_count,
  """ + _mean("cvss_v31_base_score", 8) + """ AS avg_cvss FROM master WHERE primary_cwe IS NOT NULL GROUP BY 1, 2""")
Q["q_trends"] = _with("trends", "SELECT * FROM trends")
Q["q_trends_kept_up"] = Q["q_trends"]

# Readiness
Q["q_readiness"] = _with("readiness", f"SELECT {READINESS_COLUMNS} FROM readiness")
Q["q_time_to_exploit"] = _with("readiness", f"""
SELECT cve_id, {_txt('earliest_exploit_date')}, days_to_exploit AS time_to_exploit_days FROM readiness
WHERE days_to_exploit IS NOT NULL""")
Q["q_tte_stats"] = _with("readiness", """
SELECT count(cve_id) AS cves_with_exploit_timing, """ + _mean("days_to_exploit", 8) + """ AS avg_days_to_exploit,
  quantile_disc(days_to_exploit, 0.5) AS median_days_to_exploit, min(days_to_exploit) AS min_days_to_exploit,
  max(days_to_exploit) AS max_days_to_exploit, quantile_disc(days_to_exploit, 0.25) AS p25_days,
  quantile_disc(days_to_exploit, 0.75) AS p75_days, quantile_disc(days_to_exploit, 0.9) AS p90_days
FROM readiness WHERE days_to_exploit IS NOT NULL""")
Q["q_readiness_by_severity"] = _with("master", f"""
SELECT cvss_v31_severity, count(cve_id) AS total_cves, {_n('has_public_exploit')} AS with_exploit,
  {_n('has_msf_module')} AS with_msf, {_n('in_cisa_kev')} AS in_kev, {_mean('epss_score', 8)} AS avg_epss,
  {_pct(_n('has_public_exploit'), 'count(cve_id)', 2)} AS exploit_rate_pct,
  {_pct(_n('has_msf_module'), 'count(cve_id)', 2)} AS msf_rate_pct FROM master GROUP BY cvss_v31_severity""")
Q["q_readiness_by_cwe"] = _with("master", f"""
SELECT primary_cwe, count(cve_id) AS total_cves, {_n('has_public_exploit')} AS with_exploit,
  {_n('has_msf_module')} AS with_msf, {_mean('cvss_v31_base_score', 8)} AS avg_cvss, {_mean('epss_score', 8)} AS avg_epss,
  {_pct(_n('has_public_exploit'), 'count(cve_id)', 2)} AS exploit_rate_pct
FROM master WHERE primary_cwe IS NOT NULL GROUP BY primary_cwe ORDER BY total_cves DESC, primary_cwe LIMIT 20""")
Q["q_readiness_overview"] = _with("master", f"""
SELECT count(*) AS total_cves, {_n('has_public_exploit')} AS with_public_exploit, {_n('has_msf_module')} AS with_msf_module,
  {_n('in_cisa_kev')} AS in_cisa_kev, {_n('has_public_exploit AND has_msf_module')} AS exploit_and_module FROM master""")

# KPIs and reports
Q["q_kpi_long"] = _with("kpis", f"""
SELECT kpi_name, kpi_value, kpi_type, time_window, {_txt('computed_date')} FROM kpis""")
_THIS, _LAST = "DATE '2001-08-01'", "DATE '2001-07-01'"
_CUR = f"cast(published_ts AS DATE) >= {_THIS}"
_PREV = f"cast(published_ts AS DATE) >= {_LAST} AND cast(published_ts AS DATE) < {_THIS}"
_CRIT = "cvss_v31_severity = 'CRITICAL'"
Q["q_mom"] = _with("master", f"""
SELECT {_n(_CUR)} AS this_month_cves, {_n(_PREV)} AS last_month_cves, {_n(f'{_CUR} AND {_CRIT}')} AS this_month_critical,
  {_n(f'{_PREV} AND {_CRIT}')} AS last_month_critical,
  round(cast({_n(_CUR)} - {_n(_PREV)} AS DOUBLE) / greatest({_n(_PREV)}, 1) * 100, 8) AS mom_change_pct FROM master""")
_D = "cast(published_ts AS DATE)"
Q["q_kpi_snapshot"] = _with("kpis", f"""
SELECT count(*) AS total_active_cves, {_n(f"{_D} = DATE '{AS_OF}'")} AS new_cves_today,
  {_n(f"{_D} >= DATE '{AS_OF}' - 7")} AS new_cves_this_week, {_n(f"{_D} >= DATE '{AS_OF}' - 30")} AS new_cves_this_month,
  {_n(f"{_D} >= DATE '{AS_OF}' - 90")} AS new_cves_this_quarter,
  coalesce({_mean('cvss_v31_base_score', 8, 'cvss_v31_base_score > 0')}, 0) AS avg_cvss_scored, coalesce({_mean('epss_score', 8, 'epss_score > 0')}, 0) AS avg_epss_scored,
  {_n('epss_score > 0.5')} AS high_epss_count, {_n('has_public_exploit')} AS exploitable_count,
  {_n('has_msf_module')} AS msf_module_count, {_n('in_cisa_kev')} AS cisa_kev_count,
  {_n('is_ransomware_related')} AS ransomware_related_count,
  {_n("cvss_v31_base_score >= 9 AND vulnStatus NOT IN ('Rejected', 'Analyzed')")} AS unpatched_critical,
  {_n(_CUR)} AS this_month_cves, {_n(_PREV)} AS last_month_cves, {_n(f'{_CUR} AND {_CRIT}')} AS this_month_critical,
  {_n(f'{_PREV} AND {_CRIT}')} AS last_month_critical,
  (SELECT count(*) FROM risk WHERE risk_tier = 'CRITICAL') AS critical_risk_count,
  (SELECT count(*) FROM risk WHERE risk_tier = 'HIGH') AS high_risk_count,
  (SELECT count(*) FROM risk WHERE risk_tier = 'MEDIUM') AS medium_risk_count,
  (SELECT count(*) FROM risk WHERE risk_tier = 'LOW') AS low_risk_count,
  {_pct(_n('has_public_exploit'), 'greatest(count(*), 1)', 8)} AS exploitable_pct,
  {_pct(_n('in_cisa_kev'), 'greatest(count(*), 1)', 8)} AS cisa_kev_pct,
  round(cast({_n(_CUR)} - {_n(_PREV)} AS DOUBLE) / greatest({_n(_PREV)}, 1) * 100, 8) AS mom_change_pct FROM master""")
Q["q_weaponization"] = _with("readiness", f"""
SELECT {LEVELS}, round(cast(count(*) AS DOUBLE) / (SELECT count(*) FROM readiness) * 100, 1) AS pct_of_total
FROM readiness GROUP BY weaponization_level""")
Q["q_vendor_risk"] = _with("master", f"{VENDOR} LIMIT 20")
Q["q_cwe_summary"] = _with("master", f"""
SELECT primary_cwe, count(cve_id) AS cve_count, {_mean('cvss_v31_base_score', 2)} AS avg_cvss,
  {_mean('epss_score', 5)} AS avg_epss, {_n('has_public_exploit')} AS exploitable, {_n('in_cisa_kev')} AS in_kev,
  {_pct(_n('has_public_exploit'), 'count(cve_id)', 1)} AS exploit_rate_pct
FROM master WHERE primary_cwe IS NOT NULL AND primary_cwe NOT IN ('NVD-CWE-noinfo', 'NVD-CWE-Other', '')
GROUP BY primary_cwe HAVING count(cve_id) >= 10 ORDER BY cve_count DESC, primary_cwe LIMIT 15""")
Q["q_alerts"] = _with("master", ALERTS)

# Views
Q["q_view_latest_kpis"] = _with("kpi_runs", f"""
SELECT kpi_name, kpi_value, kpi_type, time_window, cast(computed_date AS VARCHAR) || ' 00:00:00' AS computed_at,
  {_txt('computed_date')} FROM kpi_runs WHERE computed_date = (SELECT max(computed_date) FROM kpi_runs)""")
Q["q_view_kpi_history"] = _with("kpi_runs", f"""
SELECT kpi_name, kpi_value, kpi_type, {_txt('computed_date')} FROM kpi_runs WHERE computed_date >= DATE '{AS_OF}' - 30""")
Q["q_view_top_risks"] = _with("risk_runs", f"""
SELECT cve_id, {_r8('composite_risk_score')}, risk_tier, {_r8('cvss_v31_base_score')}, {_r8('epss_score')},
  {_r8('epss_percentile')}, in_cisa_kev, is_ransomware_related, has_public_exploit, exploit_count, has_msf_module,
  msf_module_count, vendor_project, product, description_en, {_time('published_ts')}, days_since_published, primary_cwe
FROM (SELECT * FROM risk_runs WHERE run = (SELECT max(run) FROM risk_runs) AND composite_risk_score > 0.5
      ORDER BY composite_risk_score DESC, cve_id LIMIT 100)""")
_TREND = "new_cves, avg_cvss, avg_epss, cisa_kev_count, exploitable_count FROM trends"
Q["q_view_daily_trends"] = _with("trends", f"""
SELECT period AS date, {_TREND} WHERE trend_type = 'daily' AND cast(period AS DATE) >= DATE '{AS_OF}' - 90""")
Q["q_view_monthly_trends"] = _with("trends", f"""
SELECT period AS month, {_TREND} WHERE trend_type = 'monthly' AND cast(period AS DATE) >= DATE '{AS_OF}' - 730""")
Q["q_view_weaponization"] = _with("readiness_runs", f"""
SELECT {LEVELS} FROM readiness_runs WHERE run = (SELECT max(run) FROM readiness_runs) GROUP BY weaponization_level""")
Q["q_view_critical_alerts"] = _with("master", ALERTS)
Q["q_view_vendor_risk"] = _with("master", f"SELECT * EXCLUDE (avg_epss) FROM ({VENDOR} LIMIT 50)")
