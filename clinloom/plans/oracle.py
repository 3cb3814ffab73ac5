"""DuckDB oracle SQL for every registered query (the correctness gate).

Independent re-statement of each job in plain SQL over the driver's tables: the
same derived feeds (integer arithmetic only) and the same stage order, written
with ordinary window functions, joins and aggregates.  Column names equal the
Spark outputs.  CTEs are declared once with their dependencies and assembled per
query.
"""
from __future__ import annotations

from ..schema import CDM_TABLES

P = 10_000_000
EPID = f"CAST(CASE WHEN event_id % 97 = 5 THEN user_id ELSE {P} + user_id END AS BIGINT)"
EPROV = "CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 5 END AS BIGINT)"
SQLT = {"bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
        "string": "VARCHAR", "double": "DOUBLE"}

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


def assemble(select: str, *deps: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order) + "\n" + select


def project(table: str, provided: dict[str, str], available: set[str] = frozenset()) -> str:
    """SELECT list of a CDM table: given expressions, available columns, typed nulls."""
    out = []
    for c, t in CDM_TABLES[table]:
        if c in provided:
            expr = provided[c]
        elif c in available:
            expr = c
        else:
            expr = "NULL"
        out.append(f"CAST({expr} AS {SQLT[t]}) AS {c}")
    return ", ".join(out)


def kcd(e: str) -> str:
    c = f"upper(trim(split_part({e}, '|', 1)))"
    return f"(CASE WHEN length({c}) > 3 AND strpos({c}, '.') = 0 THEN substr({c}, 1, 3) || '.' || substr({c}, 4) ELSE {c} END)"


def occ_id(hosp: str, date: str, code: str, seq: str, width: int) -> str:
    return (f"CAST(CAST({hosp} AS VARCHAR) || strftime({date}, '%y%m%d') || '{code}' || "
            f"printf('%0{width}d', {seq}) AS BIGINT)")


def born_after(yob: str, mob: str, d: str) -> str:
    return f"({yob} > year({d}) OR ({yob} = year({d}) AND {mob} > month({d})))"


# ---------------------------------------------------------------- person side
_PB = (f"SELECT {P} + c_custkey AS person_id, "
       "CAST(CASE WHEN c_custkey % 7 = 0 THEN 0 WHEN c_custkey % 2 = 0 THEN 8507 ELSE 8532 END AS BIGINT) AS gender_concept_id, "
       "{yob} AS year_of_birth, CAST(1 + c_custkey % 12 AS INTEGER) AS month_of_birth, "
       "CAST(1 + c_custkey % 28 AS INTEGER) AS day_of_birth, CAST(0 AS BIGINT) AS race_concept_id, "
       "CAST(0 AS BIGINT) AS ethnicity_concept_id, CAST(c_nationkey AS BIGINT) + {loc} AS location_id, "
       "c_custkey AS _rid, {batch} AS _batch FROM customer WHERE c_custkey % 10 <> 3 AND {cond}")
cte("person_b", (), _PB.format(yob="CAST(CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 1890 + c_custkey % 150 END AS INTEGER)",
                               loc=0, batch=0, cond="c_custkey % 3 <> 0")
    + "\nUNION ALL\n" + _PB.format(yob="CAST(1900 + c_custkey % 100 AS INTEGER)", loc=100, batch=1,
                                    cond="c_custkey % 2 = 0"))
cte("person_first", ("person_b",),
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY _batch, _rid) AS rn "
    "FROM person_b WHERE person_id IS NOT NULL) WHERE rn = 1")
_SHEET = (f"SELECT {P} + c_custkey AS person_id, CASE WHEN c_custkey % 2 = 0 THEN '남' ELSE '여' END AS sex, "
          "CASE WHEN c_custkey % 22 = 0 THEN '삭제' || c_name ELSE c_name END AS name, "
          "CAST(CASE WHEN c_custkey % 22 = 0 THEN 1800 ELSE 1950 + c_custkey % 40 END AS INTEGER) AS year_of_birth, "
          "CAST(1 + c_custkey % 12 AS INTEGER) AS month_of_birth FROM customer WHERE {cond}")
cte("sheet", (), _SHEET.format(cond="c_custkey % 11 = 0") + "\nUNION ALL\n" + _SHEET.format(cond="c_custkey % 55 = 0"))
cte("excluded", ("sheet",),
    "SELECT DISTINCT person_id FROM sheet WHERE contains(name, '삭제') AND year_of_birth < 1900")
cte("person_merged", ("person_first", "sheet", "excluded"), """
SELECT COALESCE(b.person_id, o.person_id) AS person_id,
       COALESCE(o.gender_concept_id, CASE WHEN b.gender_concept_id = 0 THEN NULL ELSE b.gender_concept_id END) AS gender_concept_id,
       COALESCE(o.year_of_birth, b.year_of_birth) AS year_of_birth,
       COALESCE(o.month_of_birth, b.month_of_birth) AS month_of_birth,
       b.day_of_birth, b.race_concept_id, b.ethnicity_concept_id, COALESCE(b.location_id, 0) AS location_id
FROM person_first b
FULL OUTER JOIN (SELECT person_id, CAST(CASE sex WHEN '남' THEN 8507 WHEN '여' THEN 8532 END AS BIGINT) AS gender_concept_id,
                        year_of_birth, month_of_birth FROM sheet) o
  ON b.person_id = o.person_id
WHERE NOT EXISTS (SELECT 1 FROM excluded x WHERE x.person_id = COALESCE(b.person_id, o.person_id))""")
cte("pseud", (), f"SELECT {P} + c_custkey AS person_id, 'PID' || CAST((c_custkey * 7919) % 1000003 AS VARCHAR) AS pid "
                 "FROM customer")
cte("person_tbl", ("person_merged",), "SELECT DISTINCT " + project("person", {
    "gender_source_value": "CASE gender_concept_id WHEN 8507 THEN 'Male' WHEN 8532 THEN 'Female' ELSE '' END",
    "provider_id": "0", "care_site_id": "0", "person_source_value": "''", "race_source_value": "''",
    "race_source_concept_id": "0", "ethnicity_source_value": "''", "ethnicity_source_concept_id": "0",
}, {"person_id", "gender_concept_id", "year_of_birth", "month_of_birth", "day_of_birth", "race_concept_id",
    "ethnicity_concept_id", "location_id"}) + " FROM person_merged")

# ---------------------------------------------------------------- death
_DR = (f"SELECT {P} + c_custkey AS person_id, {{date}} AS death_date, c_custkey AS _rid, {{batch}} AS _batch, c_custkey "
       "FROM customer WHERE {cond}")
cte("death_raw", (), _DR.format(date="CASE WHEN c_custkey % 45 = 0 THEN DATE '2026-03-01' "
                                     "ELSE DATE '2024-01-10' + CAST(c_custkey % 20 AS INTEGER) END",
                                batch=0, cond="c_custkey % 9 = 0")
    + "\nUNION ALL\n" + _DR.format(date="DATE '2024-01-05' + CAST(c_custkey % 30 AS INTEGER)", batch=1,
                                   cond="c_custkey % 18 = 0"))
cte("death_union", ("death_raw",),
    "SELECT person_id, death_date, CAST(death_date AS TIMESTAMP) AS death_datetime, "
    "CAST(38003569 AS BIGINT) AS death_type_concept_id, "
    "CAST(CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 4306655 END AS BIGINT) AS cause_concept_id, "
    "'C' || CAST(c_custkey % 7 AS VARCHAR) AS cause_source_value, CAST(NULL AS BIGINT) AS cause_source_concept_id, "
    "_rid, _batch FROM death_raw")
cte("death_pre", ("death_union", "excluded"), """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY death_date ASC NULLS LAST, _batch, _rid) AS rn
  FROM death_union WHERE death_date < DATE '2026-01-01') d
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM excluded x WHERE x.person_id = d.person_id)""")
cte("death_tbl", ("death_pre", "person_tbl"), "SELECT " + project("death", {
    "cause_concept_id": "COALESCE(cause_concept_id, 0)", "cause_source_concept_id": "COALESCE(cause_source_concept_id, 0)",
}, {"person_id", "death_date", "death_datetime", "death_type_concept_id", "cause_source_value"})
    + " FROM death_pre WHERE person_id IN (SELECT person_id FROM person_tbl)")
cte("death_min", ("death_tbl",), "SELECT person_id, min(death_date) AS dd FROM death_tbl GROUP BY person_id")


def violations(src: str, date_col: str) -> str:
    return (f"SELECT DISTINCT s.person_id FROM {src} s LEFT JOIN person_tbl p ON s.person_id = p.person_id "
            f"WHERE p.year_of_birth IS NULL OR COALESCE({born_after('p.year_of_birth', 'p.month_of_birth', 's.' + date_col)}, FALSE)")


cte("death_viol", ("death_pre", "person_tbl"), violations("death_pre", "death_date"))

# ---------------------------------------------------------------- visit
cte("vis_feed", (), f"""
SELECT {EPID} AS person_id, CAST(9201 + event_id % 3 AS BIGINT) AS visit_concept_id,
       CAST(ts AS DATE) AS visit_start_date, ts AS visit_start_time,
       CAST(ts AS DATE) + CAST(event_id % 4 AS INTEGER) AS visit_end_date,
       ts + to_days(CAST(event_id % 4 AS INTEGER)) AS visit_end_time,
       CAST(event_id % 5 AS BIGINT) AS provider_id, CAST(event_id % 25 AS BIGINT) AS care_site_id,
       CASE WHEN event_id % 2 = 0 THEN 'NHI' ELSE 'MED' END AS payer_source_value,
       'PLAN' || CAST(event_id % 3 AS VARCHAR) AS plan_source_value,
       CAST(1 + event_id % 2 AS INTEGER) AS hosp, event_id AS _rid
FROM events WHERE event_type IN ('view', 'signup')""")
cte("vis_num", ("vis_feed",), """
SELECT *, row_number() OVER (PARTITION BY visit_start_date ORDER BY visit_start_time ASC NULLS LAST, _rid % 2, _rid) AS _seq
FROM vis_feed WHERE visit_start_date IS NOT NULL""")
cte("vis_pre", ("vis_num", "death_min", "excluded"), f"""
SELECT v.*, {occ_id('v.hosp', 'v.visit_start_date', '01', 'v._seq', 5)} AS visit_occurrence_id
FROM vis_num v LEFT JOIN death_min dm ON v.person_id = dm.person_id
WHERE length(CAST(v.person_id AS VARCHAR)) = 8 AND v.visit_start_date < DATE '2026-01-01'
  AND (dm.dd IS NULL OR v.visit_start_date <= dm.dd)
  AND NOT EXISTS (SELECT 1 FROM excluded x WHERE x.person_id = v.person_id)""")
cte("vis_viol", ("vis_pre", "person_tbl"), violations("vis_pre", "visit_start_date"))
cte("vis_kept", ("vis_pre", "person_tbl"), "SELECT * FROM vis_pre WHERE person_id IN (SELECT person_id FROM person_tbl)")
cte("vis_lag", ("vis_kept",), """
SELECT *, lag(visit_occurrence_id) OVER w AS _prev_id, lag(visit_end_date) OVER w AS _prev_end FROM vis_kept
WINDOW w AS (PARTITION BY person_id ORDER BY visit_start_date ASC NULLS LAST, visit_end_date ASC NULLS LAST,
             _seq ASC NULLS LAST)""")
cte("vis_tbl", ("vis_lag",), "SELECT " + project("visit_occurrence", {
    "visit_start_datetime": "visit_start_time", "visit_end_datetime": "visit_end_time",
    "visit_type_concept_id": "44818518", "visit_source_value": "''", "visit_source_concept_id": "0",
    "admitting_source_concept_id": "CASE WHEN visit_concept_id = 9202 THEN 0 ELSE 38004515 END",
    "admitting_source_value": "''", "discharge_to_concept_id": "0", "discharge_to_source_value": "''",
    "preceding_visit_occurrence_id": "CASE WHEN visit_start_date IS NOT NULL AND _prev_end IS NOT NULL "
                                     "AND date_diff('day', _prev_end, visit_start_date) >= 0 THEN _prev_id ELSE 0 END",
}, {"visit_occurrence_id", "person_id", "visit_concept_id", "visit_start_date", "visit_end_date", "provider_id",
    "care_site_id"}) + " FROM vis_lag")
cte("ppp_tbl", ("vis_kept",), "SELECT " + project("payer_plan_period", {
    "payer_plan_period_id": occ_id("hosp", "visit_start_date", "07", "_seq", 5),
    "payer_plan_period_start_date": "visit_start_date", "payer_plan_period_end_date": "visit_end_date",
    "family_source_value": "''"}, {"person_id", "payer_source_value", "plan_source_value"}) + " FROM vis_kept")
cte("cost_tbl", ("vis_kept",), "SELECT " + project("cost", {
    "cost_id": "CAST(strftime(visit_start_date, '%y%m%d') || '08' || CAST(hosp AS VARCHAR) || printf('%05d', _seq) AS BIGINT)",
    "cost_event_id": "visit_occurrence_id", "cost_domain_id": "'Visit'", "cost_type_concept_id": "0",
    "payer_plan_period_id": occ_id("hosp", "visit_start_date", "07", "_seq", 5)}) + " FROM vis_kept")
cte("vis_lookup", ("vis_tbl",), """
SELECT person_id, visit_start_date, visit_end_date, provider_id, min(visit_occurrence_id) AS vid,
       arg_min(visit_concept_id, visit_occurrence_id) AS vconcept
FROM vis_tbl GROUP BY person_id, visit_start_date, visit_end_date, provider_id""")


def match_ctes(name: str, src: str, key: str, date_col: str, *, provider: bool, pre: int, diff: bool,
               null_9203: str, lookup: str = "vis_lookup") -> None:
    """Visit match of ``src`` (unique ``key``) -> CTE ``name`` with visit columns added."""
    pm = "COALESCE(e.provider_id = v.provider_id, FALSE)" if provider else "FALSE"
    order = ["_pm DESC", "vconcept ASC NULLS LAST"]
    if diff:
        order.append(f"date_diff('day', {date_col}, _vend) ASC NULLS LAST")
    order.append("vid ASC NULLS LAST")
    vid = {"none": "vid", "pass2": "CASE WHEN NOT _pm AND vconcept = 9203 THEN NULL ELSE vid END",
           "all": "CASE WHEN vconcept = 9203 THEN NULL ELSE vid END"}[null_9203]
    cte(name, (src, lookup), f"""
SELECT * EXCLUDE (_pm, _vend, vid, vconcept, _rn), CAST({vid} AS BIGINT) AS visit_occurrence_id,
       CAST(vconcept AS BIGINT) AS visit_concept_id
FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {', '.join(order)}) AS _rn
      FROM (SELECT e.*, v.vid, v.vconcept, v.visit_end_date AS _vend, {pm} AS _pm
            FROM {src} e LEFT JOIN {lookup} v
              ON e.person_id = v.person_id AND v.visit_start_date - {pre} <= e.{date_col}
             AND e.{date_col} <= v.visit_end_date))
WHERE _rn = 1""")


# ---------------------------------------------------------------- vocabulary
_KCD_CODE = "'A' || printf('%02d', p_partkey // 10) || '.' || CAST(p_partkey % 10 AS VARCHAR)"
cte("concept_t", (), f"""
SELECT CAST(1000000 + p_partkey AS VARCHAR) AS concept_id, p_name AS concept_name, 'Condition' AS domain_id,
       'KCD7' AS vocabulary_id, 'KCD7 code' AS concept_class_id,
       CASE WHEN p_partkey % 7 = 0 THEN 'S' ELSE '' END AS standard_concept, {_KCD_CODE} AS concept_code,
       '19700101' AS valid_start_date, '20991231' AS valid_end_date,
       CASE WHEN p_partkey % 13 = 0 THEN 'D' ELSE '' END AS invalid_reason
FROM part
UNION ALL
SELECT CAST(2000000 + p_partkey AS VARCHAR), p_name, 'Condition', 'SNOMED', 'Clinical Finding', 'S',
       CAST(2000000 + p_partkey AS VARCHAR), '19700101', '20991231', ''
FROM part WHERE p_partkey % 3 <> 0
UNION ALL
SELECT CAST(3000000 + p_partkey AS VARCHAR), p_name, 'Measurement', 'LOINC', 'Lab Test',
       CASE WHEN p_partkey % 4 = 3 THEN '' ELSE 'S' END, 'L' || printf('%02d', p_partkey), '19700101', '20991231', ''
FROM part""")
cte("rel_t", (), """
SELECT CAST(1000000 + p_partkey AS VARCHAR) AS concept_id_1, CAST(2000000 + p_partkey AS VARCHAR) AS concept_id_2,
       'Maps to' AS relationship_id, '19700101' AS valid_start_date, '20991231' AS valid_end_date,
       CASE WHEN p_partkey % 11 = 0 THEN 'D' ELSE '' END AS invalid_reason
FROM part WHERE p_partkey % 3 <> 0
UNION ALL
SELECT CAST(2000000 + p_partkey AS VARCHAR), CAST(1000000 + p_partkey AS VARCHAR), 'Mapped from', '19700101', '20991231', ''
FROM part WHERE p_partkey % 3 <> 0
UNION ALL
SELECT CAST(1000000 + p_partkey AS VARCHAR), CAST(4000000 + p_partkey AS VARCHAR), 'Maps to', '19700101', '20991231', ''
FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 8 = 1""")
cte("vocab_t", (), """
SELECT * FROM (VALUES
 ('KCD7', 'Korean Classification of Diseases', '', 'v7', '44819216'),
 ('SNOMED', 'Systematic Nomenclature of Medicine', '', 'v2024', '44819097'),
 ('LOINC', 'Logical Observation Identifiers Names and Codes', '', 'v2.7', '44819102'),
 ('ICD10', 'International Classification of Diseases', '', 'v2019', '44819124'))
 AS t(vocabulary_id, vocabulary_name, vocabulary_reference, vocabulary_version, vocabulary_concept_id)""")
cte("supp", (), f"SELECT {_KCD_CODE} AS code, CAST(7000000 + p_partkey AS BIGINT) AS concept_id FROM part "
                "WHERE p_partkey % 6 = 3")
cte("edges", ("rel_t",), """
SELECT TRY_CAST(concept_id_1 AS BIGINT) AS c1, max(TRY_CAST(concept_id_2 AS BIGINT)) AS tgt FROM rel_t
WHERE relationship_id = 'Maps to' AND COALESCE(invalid_reason, '') = ''
  AND TRY_CAST(concept_id_1 AS BIGINT) IS NOT NULL AND TRY_CAST(concept_id_2 AS BIGINT) IS NOT NULL
GROUP BY 1""")
for _v in ("KCD7", "LOINC"):
    cte(f"src_{_v}", ("concept_t",), f"""
SELECT source_code, cid, std FROM (
  SELECT concept_code AS source_code, TRY_CAST(concept_id AS BIGINT) AS cid, COALESCE(standard_concept, '') AS std,
         row_number() OVER (PARTITION BY concept_code ORDER BY TRY_CAST(concept_id AS BIGINT), COALESCE(standard_concept, '')) AS rn
  FROM concept_t WHERE vocabulary_id = '{_v}' AND COALESCE(invalid_reason, '') = ''
    AND TRY_CAST(concept_id AS BIGINT) IS NOT NULL) WHERE rn = 1""")
    cte(f"map_{_v}", (f"src_{_v}", "edges"), f"""
SELECT s.source_code, s.cid AS source_concept_id,
       CAST(CASE WHEN s.std = 'S' THEN s.cid ELSE COALESCE(e.tgt, 0) END AS BIGINT) AS concept_id,
       (s.std = 'S' OR COALESCE(e.tgt, 0) <> 0) AS mapped
FROM src_{_v} s LEFT JOIN edges e ON s.cid = e.c1""")

# ---------------------------------------------------------------- condition
cte("cond_feed", (), f"""
SELECT {EPID} AS person_id, CAST(ts AS DATE) AS condition_start_date, ts AS condition_start_datetime,
       CAST(ts AS DATE) AS condition_end_date, ts AS condition_end_datetime,
       CAST(32817 AS BIGINT) AS condition_type_concept_id,
       CASE WHEN event_id % 4 = 0 THEN 'stop' END AS stop_reason, {EPROV} AS provider_id,
       'A' || printf('%03d', event_id % 40) || '|' || CAST(event_id AS VARCHAR) AS condition_source_value,
       CAST(1 + event_id % 2 AS INTEGER) AS hosp, event_id AS _rid
FROM events WHERE event_type IN ('click', 'purchase', 'error')""")
_CCOLS = ("person_id, condition_start_date, condition_start_datetime, condition_end_date, condition_end_datetime, "
          "condition_type_concept_id, {stop} AS stop_reason, provider_id, condition_source_value, {hosp} AS hosp, _rid, "
          "{b} AS _batch")
cte("cond_union", ("cond_feed",),
    f"SELECT {_CCOLS.format(stop='stop_reason', hosp='CAST(1 AS INTEGER)', b=0)} FROM cond_feed WHERE _rid % 3 = 0\n"
    f"UNION ALL SELECT {_CCOLS.format(stop='CAST(NULL AS VARCHAR)', hosp='hosp', b=1)} FROM cond_feed WHERE _rid % 3 = 1\n"
    f"UNION ALL SELECT {_CCOLS.format(stop='stop_reason', hosp='hosp', b=2)} FROM cond_feed WHERE _rid % 3 = 2 "
    "AND condition_start_date >= DATE '2024-01-01' AND condition_start_date <= DATE '2024-01-25' "
    "AND year(condition_start_date) >= 2024")


def mapped_feed(name: str, src: str, code_expr: str, vocab: str, concept: str, source_concept: str,
                supplement: bool) -> None:
    concept_expr = ("CASE WHEN COALESCE(t.concept_id, 0) = 0 THEN COALESCE(s.concept_id, 0) ELSE t.concept_id END"
                    if supplement else "COALESCE(t.concept_id, 0)")
    supp_join = "LEFT JOIN supp s ON x._code = s.code" if supplement else ""
    deps = (src, f"map_{vocab}") + (("supp",) if supplement else ())
    cte(name, deps, f"""
SELECT x.* EXCLUDE (_code), CAST({concept_expr} AS BIGINT) AS {concept},
       CAST(COALESCE(t.source_concept_id, 0) AS BIGINT) AS {source_concept}
FROM (SELECT *, {code_expr} AS _code FROM {src}) x
LEFT JOIN map_{vocab} t ON x._code = t.source_code {supp_join}""")


def event_tail(prefix: str, src: str, date_col: str, table: str, *, id_len: str | None = "= 8",
               provided: dict[str, str] | None = None, extra_where: str = "", missing: tuple[str, ...] = ()) -> None:
    """J1, person-id length, J2, J4, J3 and the CDM projection (tail shared by event domains)."""
    len_cond = f"AND length(CAST(e.person_id AS VARCHAR)) {id_len}" if id_len else ""
    cte(f"{prefix}_pre", (src, "death_min", "excluded"), f"""
SELECT e.* FROM {src} e LEFT JOIN death_min dm ON e.person_id = dm.person_id
WHERE (dm.dd IS NULL OR e.{date_col} <= dm.dd) {len_cond} {extra_where}
  AND NOT EXISTS (SELECT 1 FROM excluded x WHERE x.person_id = e.person_id)""")
    cte(f"{prefix}_viol", (f"{prefix}_pre", "person_tbl"), violations(f"{prefix}_pre", date_col))
    cols = {c for c, _ in CDM_TABLES[table]} - set(missing)
    cte(f"{prefix}_tbl", (f"{prefix}_pre", "person_tbl"),
        "SELECT " + project(table, provided or {}, cols) + f" FROM {prefix}_pre WHERE person_id IN "
        "(SELECT person_id FROM person_tbl)")


def numbered(name: str, src: str, date_col: str, dt_col: str, code: str, width: int, id_col: str,
             where: str = "", tie: str = "_rid") -> None:
    cte(name, (src,), f"""
SELECT * EXCLUDE (_seq), {occ_id('hosp', date_col, code, '_seq', width)} AS {id_col}, _seq FROM (
  SELECT *, row_number() OVER (PARTITION BY {date_col} ORDER BY {dt_col} ASC NULLS LAST, {tie}) AS _seq
  FROM {src} WHERE {date_col} IS NOT NULL {where})""")


def condition_ctes(prefix: str, *, supplement: bool, feed: str = "cond_union") -> None:
    cte(f"{prefix}_c0", (feed,), f"SELECT * FROM {feed} WHERE person_id IS NOT NULL")
    mapped_feed(f"{prefix}_cm", f"{prefix}_c0", kcd("condition_source_value"), "KCD7", "condition_concept_id",
                "condition_source_concept_id", supplement)
    match_ctes(f"{prefix}_cv", f"{prefix}_cm", "_rid", "condition_start_date", provider=True, pre=0, diff=False,
               null_9203="none")
    numbered(f"{prefix}_cn", f"{prefix}_cv", "condition_start_date", "condition_start_datetime", "02", 5,
             "condition_occurrence_id", "AND condition_start_date < DATE '2026-01-01'", tie="_batch, _rid")
    event_tail(prefix, f"{prefix}_cn", "condition_start_date", "condition_occurrence", provided={
        "condition_status_concept_id": "0", "condition_status_source_value": "''",
        "visit_detail_id": "visit_occurrence_id", "condition_concept_id": "COALESCE(condition_concept_id, 0)"})


condition_ctes("cond", supplement=True)
condition_ctes("cgen", supplement=False)
cte("cond_older", ("cond_union",), "SELECT * REPLACE (CASE WHEN _batch = 2 THEN 'X' || condition_source_value "
    "ELSE condition_source_value END AS condition_source_value) FROM cond_union")
condition_ctes("cbase", supplement=True, feed="cond_older")

# ---------------------------------------------------------------- drug
cte("drug_feed", (), f"""
SELECT {EPID} AS person_id,
       CAST(CASE WHEN event_id % 23 = 0 THEN NULL ELSE 19000000 + event_id % 50 END AS BIGINT) AS conceptid,
       CAST(ts AS DATE) AS drug_exposure_start_date, ts AS drug_exposure_start_datetime,
       CAST(ts AS DATE) + CAST(event_id % 30 AS INTEGER) AS drug_exposure_end_date,
       ts + to_days(CAST(event_id % 30 AS INTEGER)) AS drug_exposure_end_datetime,
       CAST(38000177 AS BIGINT) AS drug_type_concept_id, CAST(1 + event_id % 3 AS INTEGER) AS quantity_days,
       CAST(CASE WHEN event_id % 13 = 0 THEN NULL ELSE 1 + event_id % 30 END AS INTEGER) AS days_supply,
       CAST(4132161 AS BIGINT) AS route_concept_id, {EPROV} AS provider_id,
       'D' || printf('%02d', event_id % 50) AS drug_source_value, CAST(1 + event_id % 2 AS INTEGER) AS hosp,
       event_id AS _rid
FROM events WHERE event_type = 'purchase'""")
cte("drug_q", ("drug_feed",), "SELECT *, CAST(quantity_days * days_supply AS DOUBLE) AS quantity FROM drug_feed")
match_ctes("drug_v", "drug_q", "_rid", "drug_exposure_start_date", provider=True, pre=0, diff=False, null_9203="pass2")
numbered("drug_n", "drug_v", "drug_exposure_start_date", "drug_exposure_start_datetime", "03", 5, "drug_exposure_id",
         "AND drug_exposure_start_date < DATE '2026-01-01'")
event_tail("drug", "drug_n", "drug_exposure_start_date", "drug_exposure", provided={
    "drug_concept_id": "conceptid", "verbatim_end_date": "''", "stop_reason": "''", "refills": "''",
    "sig": "NULL", "lot_number": "NULL", "visit_detail_id": "visit_occurrence_id", "drug_source_concept_id": "0",
    "route_source_value": "''", "dose_unit_source_value": "''"})

# ---------------------------------------------------------------- procedure
_PF = (f"SELECT {EPID} AS person_id, "
       "CAST(CASE WHEN event_id % 4 = 0 THEN NULL ELSE 2000000 + event_id % 20 + {shift} END AS BIGINT) AS procedure_concept_id, "
       "CAST(ts AS DATE) AS procedure_date, CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END AS procedure_datetime, "
       "CAST(38000275 AS BIGINT) AS procedure_type_concept_id, CAST(1 + event_id % 2 AS BIGINT) AS quantity, "
       f"{EPROV} AS provider_id, 'P' || printf('%02d', event_id % 20) AS procedure_source_value, "
       "CAST(0 AS BIGINT) AS procedure_source_concept_id, 'E' || CAST(event_id % 20 AS VARCHAR) AS edi_code, "
       "CAST(1 + event_id % 2 AS INTEGER) AS hosp, event_id AS _rid, {b} AS _batch "
       "FROM events WHERE event_type = 'error' {cond}")
cte("proc_union", (), _PF.format(shift=0, b=0, cond="") + "\nUNION ALL\n"
    + _PF.format(shift=1, b=1, cond="AND event_id % 10 = 0"))
cte("proc_w", ("proc_union",), """
SELECT * EXCLUDE (rn, procedure_concept_id), COALESCE(procedure_concept_id, 0) AS procedure_concept_id FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id, procedure_datetime, procedure_source_value
                               ORDER BY _batch, _rid) AS rn
  FROM proc_union WHERE procedure_datetime IS NOT NULL) WHERE rn = 1""")
numbered("proc_n", "proc_w", "procedure_date", "procedure_datetime", "04", 6, "procedure_occurrence_id", tie="_batch, _rid")
event_tail("proc", "proc_n", "procedure_date", "procedure_occurrence", provided={
    "modifier_concept_id": "0", "modifier_source_value": "''", "visit_occurrence_id": "NULL",
    "visit_detail_id": "NULL"}, extra_where="AND e.procedure_date < DATE '2026-01-01'")

# ---------------------------------------------------------------- observation
cte("obs_feed", (), f"""
SELECT {EPID} AS person_id,
       CAST(CASE WHEN event_id % 9 = 0 THEN NULL ELSE 4000000 + event_id % 25 END AS BIGINT) AS observation_concept_id,
       CAST(ts AS DATE) AS observation_date, ts AS observation_time,
       CAST(38000280 AS BIGINT) AS observation_type_concept_id, CAST(value AS DOUBLE) AS value_as_number,
       event_type AS value_as_string, CAST(0 AS BIGINT) AS value_as_concept_id,
       CAST(0 AS BIGINT) AS qualifier_concept_id, CAST(0 AS BIGINT) AS unit_concept_id, {EPROV} AS provider_id,
       'O' || CAST(event_id % 25 AS VARCHAR) AS observation_source_value,
       CAST(0 AS BIGINT) AS observation_source_concept_id, CAST(1 + (event_id // 2) % 2 AS INTEGER) AS hosp,
       event_id AS _rid
FROM events WHERE event_type IN ('click', 'purchase', 'error')""")
cte("obs_inp", ("obs_feed",), "SELECT * FROM obs_feed WHERE _rid % 2 = 1")
match_ctes("obs_inp_v", "obs_inp", "_rid", "observation_date", provider=False, pre=0, diff=False, null_9203="all")
cte("obs_all", ("obs_inp_v", "obs_feed"), """
SELECT * EXCLUDE (visit_concept_id) FROM obs_inp_v
UNION ALL BY NAME
SELECT *, CAST(NULL AS BIGINT) AS visit_occurrence_id FROM obs_feed WHERE _rid % 2 = 0""")
numbered("obs_n", "obs_all", "observation_date", "observation_time", "06", 5, "observation_id",
         "AND observation_date < DATE '2026-01-01' AND person_id IS NOT NULL")
event_tail("obs", "obs_n", "observation_date", "observation", id_len="> 1", provided={
    "observation_datetime": "observation_time", "visit_detail_id": "visit_occurrence_id",
    "observation_concept_id": "COALESCE(observation_concept_id, 0)"},
    missing=("unit_source_value", "qualifier_source_value"))

# ---------------------------------------------------------------- note
cte("note_feed", (), f"""
SELECT CAST({P} + doc_id % 150 AS BIGINT) AS person_id,
       CASE WHEN doc_id % 37 = 0 THEN DATE '2026-02-01' ELSE DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) END AS note_date,
       TIMESTAMP '2024-01-01 08:00:00' + to_days(CAST(doc_id % 30 AS INTEGER)) + to_minutes(CAST(doc_id % 600 AS BIGINT)) AS note_datetime,
       CAST(44814637 AS BIGINT) AS note_type_concept_id, CAST(44814639 AS BIGINT) AS note_class_concept_id,
       source AS note_title,
       CASE WHEN doc_id % 5 = 0 THEN '$$$$' || text || '""' ELSE text END AS note_text,
       CAST(32678 AS BIGINT) AS encoding_concept_id, CAST(0 AS BIGINT) AS language_concept_id,
       CAST(doc_id % 5 AS BIGINT) AS provider_id, lang AS note_source_value,
       CAST(1 + doc_id % 2 AS INTEGER) AS hosp, doc_id AS _rid
FROM documents""")
numbered("note_n", "note_feed", "note_date", "note_datetime", "09", 6, "note_id",
         "AND note_date >= DATE '2001-01-01' AND note_date <= DATE '2025-12-31'")
match_ctes("note_v", "note_n", "note_id", "note_date", provider=True, pre=7, diff=True, null_9203="pass2")


def clean(c: str) -> str:
    return (f"CASE WHEN {c} IS NOT NULL AND {c} <> '' THEN '\"' || replace(replace({c}, '$$$$', ''), '\"\"', '') || '\"' "
            f"ELSE {c} END")


event_tail("note", "note_v", "note_date", "note", provided={
    "visit_detail_id": "visit_occurrence_id", "note_title": clean("note_title"), "note_text": clean("note_text"),
    "note_source_value": clean("note_source_value")})

# ---------------------------------------------------------------- lab / measurement
_RES = ("CASE WHEN event_id % 53 = 0 THEN '' WHEN event_id % 8 = 0 THEN printf('%.2f', value) || ' ' "
        "WHEN event_id % 8 = 1 THEN '<' || printf('%.2f', value) WHEN event_id % 8 = 2 THEN '>' || printf('%.2f', value) "
        "WHEN event_id % 8 = 3 THEN '(' || printf('%.2f', value) || ')' WHEN event_id % 8 = 4 THEN '-' "
        "WHEN event_id % 8 = 5 THEN 'Negative' WHEN event_id % 8 = 6 THEN 'Positive' ELSE 'No WBC' END")
_CODE = "CASE WHEN event_id % 12 = 11 THEN 'MCV' ELSE 'L' || printf('%02d', event_id % 12) END"
cte("lab_raw", (), f"""
SELECT CASE WHEN event_id % 3 = 0 THEN 'SITE1 Lab Medicine' ELSE 'SITE2 Lab' END AS _c0,
       CAST({EPID} AS VARCHAR) AS _c1, strftime(ts, '%Y-%m-%d %H:%M:%S') AS _c5, {_CODE} AS _c6,
       {_RES} AS _c8, CAST(event_id % 5 AS VARCHAR) AS _c9, {_CODE} AS code, event_id AS _rid
FROM events""")
_NUM_RE = "^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
cte("lab_p0", ("lab_raw",), f"""
SELECT *, trim(regexp_replace(CASE WHEN regexp_replace(_c8, '[()]', '', 'g') = 'No WBC' THEN '0'
                                   ELSE regexp_replace(_c8, '[()]', '', 'g') END, '[()<>]', '', 'g')) AS _t,
       (_c8 = '-' OR contains(_c8, 'Negative') OR contains(_c8, 'Positive')) AS _qual,
       (contains(_c8, '<') OR contains(_c8, '>')) AS _cmp
FROM lab_raw""")
cte("lab_parsed", ("lab_p0",), f"""
SELECT CAST(CASE WHEN contains(_c0, 'SITE1') THEN 1 ELSE 2 END AS INTEGER) AS hosp,
       CASE WHEN TRY_CAST(_c1 AS DOUBLE) = floor(TRY_CAST(_c1 AS DOUBLE)) THEN CAST(TRY_CAST(_c1 AS DOUBLE) AS BIGINT) END AS person_id,
       CAST(TRY_CAST(_c5 AS TIMESTAMP) AS DATE) AS measurement_date, TRY_CAST(_c5 AS TIMESTAMP) AS measurement_time,
       regexp_replace(_c8, '\\s+', '', 'g') AS value_source_value, _c9 AS provide, _c6 AS localcode,
       CAST(CASE WHEN contains(_c8, '<') THEN 4171756 WHEN contains(_c8, '>') THEN 4172704 END AS BIGINT) AS operator_concept_id,
       CAST(CASE WHEN _c8 = '-' OR contains(_c8, 'Negative') THEN 9189 WHEN contains(_c8, 'Positive') THEN 9191 END AS BIGINT) AS value_as_concept_id,
       CASE WHEN _cmp OR NOT _qual THEN (CASE WHEN regexp_matches(_t, '{_NUM_RE}') THEN TRY_CAST(_t AS DOUBLE) END) END AS value_as_number,
       CAST(38000277 AS BIGINT) AS measurement_type_concept_id, CAST(NULL AS DOUBLE) AS range_low,
       CAST(NULL AS DOUBLE) AS range_high, CAST(0 AS BIGINT) AS measurement_source_concept_id,
       code AS measurement_source_value, _rid
FROM lab_p0 WHERE regexp_replace(_c8, '\\s+', '', 'g') IS NOT NULL AND regexp_replace(_c8, '\\s+', '', 'g') <> ''""")
cte("meas_prep", ("lab_parsed",), """
SELECT person_id, measurement_concept_id, measurement_date, measurement_time, measurement_type_concept_id,
       operator_concept_id, value_as_number, value_as_concept_id, range_low, range_high, measurement_source_value,
       measurement_source_concept_id, value_source_value, hosp, min(_rid) AS _rid
FROM (SELECT * EXCLUDE (operator_concept_id, value_as_concept_id),
             CAST(CASE WHEN split_part(measurement_source_value, '|', 1) = 'MCV' THEN 3023599
                       WHEN split_part(measurement_source_value, '|', 1) = 'Clostridium difficile cytotoxin A/B' THEN 3032068
                       ELSE 0 END AS BIGINT) AS measurement_concept_id,
             COALESCE(operator_concept_id, 0) AS operator_concept_id,
             COALESCE(value_as_concept_id, 0) AS value_as_concept_id
      FROM lab_parsed WHERE measurement_date >= DATE '2001-01-01' AND measurement_date <= DATE '2025-12-31')
GROUP BY ALL""")
cte("meas_m0", ("meas_prep",), "SELECT * EXCLUDE (measurement_concept_id, measurement_source_concept_id) FROM meas_prep")
mapped_feed("meas_m", "meas_m0", "measurement_source_value", "LOINC", "measurement_concept_id",
            "measurement_source_concept_id", False)
cte("meas_w", ("meas_m",), """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY measurement_date, measurement_time, person_id, measurement_concept_id,
                                            measurement_source_value, value_as_number ORDER BY _rid) AS rn
  FROM meas_m) WHERE rn = 1""")
numbered("meas_n", "meas_w", "measurement_date", "measurement_time", "05", 6, "measurement_id")
cte("meas_pre", ("meas_n", "death_min", "excluded"), """
SELECT e.*, CAST(NULL AS BIGINT) AS provider_id FROM meas_n e LEFT JOIN death_min dm ON e.person_id = dm.person_id
WHERE length(CAST(e.person_id AS VARCHAR)) = 8 AND (dm.dd IS NULL OR e.measurement_date <= dm.dd)
  AND NOT EXISTS (SELECT 1 FROM excluded x WHERE x.person_id = e.person_id)""")
cte("meas_viol", ("meas_pre", "person_tbl"), violations("meas_pre", "measurement_date"))
cte("meas_kept", ("meas_pre", "person_tbl"), "SELECT * FROM meas_pre WHERE person_id IN (SELECT person_id FROM person_tbl)")
match_ctes("meas_v", "meas_kept", "measurement_id", "measurement_date", provider=True, pre=7, diff=True,
           null_9203="pass2")
cte("meas_tbl", ("meas_v",), "SELECT " + project("measurement", {
    "measurement_datetime": "measurement_time", "measurement_time": "NULL", "provider_id": "NULL",
    "unit_concept_id": "NULL", "unit_source_value": "NULL", "visit_detail_id": "visit_occurrence_id"}, {c for c, _ in CDM_TABLES["measurement"]}) + " FROM meas_v")

# ---------------------------------------------------------------- provider list
cte("plist", (), """
SELECT CAST(s_nationkey AS BIGINT) AS care_site_id, s_name AS care_site_rawname,
       CAST(CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey END AS BIGINT) AS concept_id, s_suppkey AS _ord
FROM supplier
UNION ALL
SELECT CAST(s_nationkey AS BIGINT), s_name, CAST(CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey END AS BIGINT),
       s_suppkey + 100000 FROM supplier WHERE s_suppkey % 5 = 0""")
cte("site_roll", ("plist",), """
SELECT care_site_id,
       COALESCE(string_agg(care_site_rawname, ', ' ORDER BY _o) FILTER (WHERE care_site_rawname IS NOT NULL), '') AS names,
       COALESCE(arg_min(concept_id, _o) FILTER (WHERE concept_id IS NOT NULL), 0) AS first_concept
FROM (SELECT care_site_id, care_site_rawname, concept_id, min(_ord) AS _o FROM plist GROUP BY ALL)
GROUP BY care_site_id""")

# ---------------------------------------------------------------- dedupe
cte("cwc", ("cond_feed",), """
SELECT * FROM cond_feed
UNION ALL
SELECT person_id, condition_start_date, condition_start_datetime, condition_end_date, condition_end_datetime,
       condition_type_concept_id, stop_reason, provider_id, condition_source_value, CAST(3 - hosp AS INTEGER),
       _rid + 1000000000 FROM cond_feed WHERE _rid % 10 = 0""")
numbered("cwc_n", "cwc", "condition_start_date", "condition_start_datetime", "02", 5, "condition_occurrence_id")
_CWC_AVAIL = {"person_id", "condition_start_date", "condition_start_datetime", "condition_end_date",
              "condition_end_datetime", "condition_type_concept_id", "stop_reason", "provider_id",
              "condition_source_value", "condition_occurrence_id"}
cte("cwc_tbl", ("cwc_n",), "SELECT " + project("condition_occurrence", {}, _CWC_AVAIL) + ", _seq FROM cwc_n")
_NK = [c for c, _ in CDM_TABLES["condition_occurrence"] if c != "condition_occurrence_id"]
_VNK = [c for c, _ in CDM_TABLES["visit_occurrence"] if c != "visit_occurrence_id"]

# ---------------------------------------------------------------- queries
Q: dict[str, str] = {}


def q(name: str, select: str, *deps: str) -> None:
    Q[name] = assemble(select, *deps)


_COND_COLS = ("person_id, condition_start_date, condition_start_datetime, condition_end_date, condition_end_datetime, "
              "condition_type_concept_id, stop_reason, provider_id, condition_source_value, hosp")
q("batch_union", f"SELECT {_COND_COLS}, _rid AS source_row, _batch AS batch_no FROM cond_union", "cond_union")
q("cdm_projection", "SELECT " + project("visit_occurrence", {
    "visit_concept_id": "COALESCE(visit_concept_id, 0)", "visit_start_datetime": "visit_start_time",
    "visit_end_datetime": "visit_end_time", "visit_type_concept_id": "44818518", "visit_source_value": "''",
    "visit_source_concept_id": "0", "admitting_source_concept_id": "CASE WHEN visit_concept_id = 9202 THEN 0 ELSE 38004515 END",
    "admitting_source_value": "''", "discharge_to_concept_id": "0", "discharge_to_source_value": "''"},
    {"person_id", "visit_start_date", "visit_end_date", "provider_id", "care_site_id"}) + " FROM vis_feed", "vis_feed")
q("cutoff_filter", "SELECT person_id, death_date, _batch AS batch_no, _rid AS source_row FROM death_union "
                   "WHERE death_date < DATE '2026-01-01'", "death_union")
q("date_window", "SELECT _rid AS source_row, person_id, note_date FROM note_feed "
                 "WHERE note_date >= DATE '2001-01-01' AND note_date <= DATE '2025-12-31'", "note_feed")
q("measurement_window", "SELECT _rid AS source_row, person_id, measurement_date FROM lab_parsed "
                        "WHERE measurement_date >= DATE '2001-01-01' AND measurement_date <= DATE '2025-12-31'",
  "lab_parsed")
q("person_id_length", "SELECT _rid AS source_row, person_id, CAST(length(CAST(person_id AS VARCHAR)) AS INTEGER) AS id_length "
                      "FROM cond_feed WHERE length(CAST(person_id AS VARCHAR)) = 8", "cond_feed")
q("person_id_longer", "SELECT _rid AS source_row, person_id FROM cond_feed WHERE length(CAST(person_id AS VARCHAR)) > 1",
  "cond_feed")
q("remove_after_death", "SELECT c._rid AS source_row, c.person_id, c.condition_start_date FROM cond_feed c "
                        "LEFT JOIN (SELECT person_id, min(death_date) AS dd FROM death_union GROUP BY person_id) d "
                        "ON c.person_id = d.person_id WHERE d.dd IS NULL OR c.condition_start_date <= d.dd",
  "cond_feed", "death_union")
q("exclude_persons", "SELECT _rid AS source_row, person_id FROM cond_feed c "
                     "WHERE NOT EXISTS (SELECT 1 FROM excluded x WHERE x.person_id = c.person_id)", "cond_feed", "excluded")
q("keep_in_master", "SELECT _rid AS source_row, person_id FROM cond_feed WHERE person_id IN (SELECT person_id FROM person_tbl)",
  "cond_feed", "person_tbl")
q("validate_person", violations("cond_feed", "condition_start_date"), "cond_feed", "person_tbl")
q("person_build", "SELECT * FROM person_tbl", "person_tbl")
q("person_first_version", "SELECT person_id, gender_concept_id, year_of_birth, month_of_birth, location_id, "
                          "_batch AS batch_no FROM person_first", "person_first")
q("person_override", "SELECT person_id, gender_concept_id, year_of_birth, month_of_birth FROM person_merged",
  "person_merged")
q("person_pseudonym", "SELECT m.person_id, p.pid FROM person_merged m LEFT JOIN pseud p ON m.person_id = p.person_id",
  "person_merged", "pseud")
q("person_invalid", "SELECT person_id FROM person_tbl WHERE year_of_birth IS NULL OR year_of_birth < 1900", "person_tbl")
q("person_duplicated", "SELECT person_id FROM person_merged GROUP BY person_id HAVING count(*) >= 2", "person_merged")
q("death_first", "SELECT * FROM death_tbl", "death_tbl")
q("death_violations", "SELECT * FROM death_viol", "death_viol")
q("care_site_rollup", "SELECT " + project("care_site", {
    "care_site_name": "names", "place_of_service_concept_id": "first_concept", "care_site_source_value": "''",
    "place_of_service_source_value": "''"}, {"care_site_id"}) + " FROM site_roll", "site_roll")
q("provider_rollup", "SELECT " + project("provider", {
    "provider_id": "care_site_id", "provider_name": "names", "npi": "''", "dea": "''",
    "specialty_concept_id": "first_concept", "gender_concept_id": "0", "provider_source_value": "''",
    "specialty_source_value": "''", "specialty_source_concept_id": "0", "gender_source_value": "''",
    "gender_source_concept_id": "0"}, {"care_site_id"}) + " FROM site_roll", "site_roll")
q("occurrence_id", "SELECT _rid AS source_row, " + occ_id("hosp", "condition_start_date", "02", "_seq", 5)
  + " AS condition_occurrence_id FROM (SELECT *, row_number() OVER (PARTITION BY condition_start_date ORDER BY "
    "condition_start_datetime ASC NULLS LAST, _rid) AS _seq FROM cond_feed WHERE condition_start_date IS NOT NULL)",
  "cond_feed")
q("visit_build", "SELECT * FROM vis_tbl", "vis_tbl")
q("payer_plan_period", "SELECT * FROM ppp_tbl", "ppp_tbl")
q("visit_cost_rows", "SELECT * FROM cost_tbl", "cost_tbl")
q("visit_violations", "SELECT * FROM vis_viol", "vis_viol")
q("preceding_visit", "SELECT visit_occurrence_id, person_id, preceding_visit_occurrence_id FROM vis_tbl", "vis_tbl")
q("visit_lookup_dedupe", "SELECT person_id, visit_start_date, visit_end_date, provider_id, vid AS visit_occurrence_id, "
                         "vconcept AS visit_concept_id FROM vis_lookup", "vis_lookup")
match_ctes("m_two", "cond_feed", "_rid", "condition_start_date", provider=True, pre=0, diff=False, null_9203="none")
match_ctes("m_w7", "cond_feed", "_rid", "condition_start_date", provider=True, pre=7, diff=True, null_9203="pass2")
match_ctes("m_single", "cond_feed", "_rid", "condition_start_date", provider=False, pre=0, diff=False, null_9203="all")
for _n, _c in (("visit_match_two_pass", "m_two"), ("visit_match_window7_diff", "m_w7"), ("visit_match_single", "m_single")):
    q(_n, f"SELECT _rid AS source_row, visit_occurrence_id, visit_concept_id FROM {_c}", _c)
q("kcd_normalise", f"SELECT _rid AS source_row, {kcd('condition_source_value')} AS code FROM cond_feed", "cond_feed")
q("split_pipe", "SELECT _rid AS source_row, trim(split_part(condition_source_value, '|', 1)) AS code FROM cond_feed",
  "cond_feed")
q("concept_lookup", "SELECT source_code, cid AS source_concept_id, std AS standard_concept FROM src_KCD7", "src_KCD7")
q("maps_to", "SELECT c1 AS concept_id_1, tgt AS concept_id_2 FROM edges", "edges")
q("code_mapping", "SELECT * FROM map_KCD7", "map_KCD7")
mapped_feed("std_map", "cond_feed", kcd("condition_source_value"), "KCD7", "condition_concept_id",
            "condition_source_concept_id", False)
mapped_feed("supp_map", "cond_feed", kcd("condition_source_value"), "KCD7", "condition_concept_id",
            "condition_source_concept_id", True)
q("standard_mapping", "SELECT _rid AS source_row, condition_concept_id, condition_source_concept_id FROM std_map", "std_map")
q("supplement_fill", "SELECT _rid AS source_row, condition_concept_id, condition_source_concept_id FROM supp_map",
  "supp_map")
cte("code_counts", ("cond_feed",), f"""
SELECT {kcd('condition_source_value')} AS source_code, count(*) AS n_rows FROM cond_feed
WHERE {kcd('condition_source_value')} IS NOT NULL GROUP BY 1""")
cte("code_status", ("code_counts", "map_KCD7", "supp"), """
SELECT c.source_code, CAST(COALESCE(t.source_concept_id, 0) AS BIGINT) AS source_concept_id,
       CAST(COALESCE(t.concept_id, 0) AS BIGINT) AS concept_id,
       (COALESCE(t.mapped, FALSE) OR s.code IS NOT NULL) AS mapped, c.n_rows
FROM code_counts c LEFT JOIN map_KCD7 t ON c.source_code = t.source_code
LEFT JOIN (SELECT DISTINCT code FROM supp) s ON c.source_code = s.code""")
q("unmapped_report", "SELECT 'KCD7' AS vocabulary_id, source_code, source_concept_id, concept_id, mapped, n_rows "
                     "FROM code_status WHERE NOT mapped", "code_status")
cte("used_ids", ("code_status", "supp"), """
SELECT DISTINCT concept_id FROM (
  SELECT concept_id FROM code_status UNION ALL SELECT source_concept_id FROM code_status
  UNION ALL SELECT concept_id FROM supp) WHERE concept_id IS NOT NULL AND concept_id <> 0""")
q("used_concepts", "SELECT concept_id FROM used_ids", "used_ids")
q("used_vocab_concept", "SELECT * FROM concept_t WHERE TRY_CAST(concept_id AS BIGINT) IN (SELECT concept_id FROM used_ids)",
  "concept_t", "used_ids")
q("used_vocab_relationship", "SELECT * FROM rel_t WHERE TRY_CAST(concept_id_1 AS BIGINT) IN (SELECT concept_id FROM used_ids) "
                             "AND TRY_CAST(concept_id_2 AS BIGINT) IN (SELECT concept_id FROM used_ids)", "rel_t", "used_ids")
q("used_vocab_vocabulary", "SELECT * FROM vocab_t WHERE vocabulary_id IN (SELECT vocabulary_id FROM concept_t "
                           "WHERE TRY_CAST(concept_id AS BIGINT) IN (SELECT concept_id FROM used_ids))",
  "vocab_t", "concept_t", "used_ids")
q("condition_build", "SELECT * FROM cond_tbl", "cond_tbl")
q("condition_violations", "SELECT * FROM cond_viol", "cond_viol")
q("drug_build", "SELECT * FROM drug_tbl", "drug_tbl")
q("procedure_build", "SELECT * FROM proc_tbl", "proc_tbl")
q("observation_build", "SELECT * FROM obs_tbl", "obs_tbl")
q("note_build", "SELECT * FROM note_tbl", "note_tbl")
q("measurement_build", "SELECT * FROM meas_tbl", "meas_tbl")
q("lab_parse", "SELECT hosp, person_id, measurement_date, measurement_time, value_source_value, provide, localcode, "
               "operator_concept_id, value_as_concept_id, value_as_number, measurement_type_concept_id, range_low, "
               "range_high, measurement_source_concept_id, measurement_source_value, _rid AS source_row FROM lab_parsed",
  "lab_parsed")
q("natural_key_dedupe", "SELECT * EXCLUDE (_seq, rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
  + ", ".join(_NK) + " ORDER BY _seq) AS rn FROM cwc_tbl) WHERE rn = 1", "cwc_tbl")
q("dedupe_counts", f"""
SELECT 'condition_occurrence' AS table_name, (SELECT count(*) FROM cwc_tbl) AS rows_before,
       (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_NK)} FROM cwc_tbl)) AS rows_after,
       (SELECT count(*) FROM cwc_tbl) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_NK)} FROM cwc_tbl)) AS removed
UNION ALL
SELECT 'visit_occurrence', (SELECT count(*) FROM vis_tbl),
       (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_VNK)} FROM vis_tbl)),
       (SELECT count(*) FROM vis_tbl) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_VNK)} FROM vis_tbl))""",
  "cwc_tbl", "vis_tbl")

# ---------------------------------------------------------------- QC
_QC = [("person", "person_tbl", "person_id", False, None, None, None, False),
       ("death", "death_tbl", None, True, "death_date", None, None, False),
       ("visit_occurrence", "vis_tbl", "visit_occurrence_id", True, "visit_start_date", "visit_end_date", None, False),
       ("condition_occurrence", "cond_tbl", "condition_occurrence_id", True, "condition_start_date", None,
        "condition_concept_id", True),
       ("drug_exposure", "drug_tbl", "drug_exposure_id", True, "drug_exposure_start_date", None, "drug_concept_id", True),
       ("procedure_occurrence", "proc_tbl", "procedure_occurrence_id", True, "procedure_date", None,
        "procedure_concept_id", False)]
_QC_ALL = _QC + [
    ("measurement", "meas_tbl", "measurement_id", True, "measurement_date", None, "measurement_concept_id", True),
    ("observation", "obs_tbl", "observation_id", True, "observation_date", None, "observation_concept_id", True),
    ("note", "note_tbl", "note_id", True, "note_date", None, None, True)]


def _u(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _rows(src: str, check: str, col: str, bad: str, where: str = "") -> str:
    return (f"SELECT table_name, '{check}' AS check_name, CAST({col} AS BIGINT) AS n, "
            f"CASE WHEN {col} > 0 THEN '{bad}' ELSE 'OK' END AS severity FROM {src} {where}")


def qc_ctes(prefix: str, spec: list) -> list[str]:
    """One CTE per check over the tables of ``spec``; returns the CTE names."""
    deps = tuple(t for _, t, *_ in spec) + ("person_tbl", "vis_tbl", "death_min")
    pk = [f"SELECT '{n}' AS table_name, count(*) AS n_rows, count(*) - count(DISTINCT {k}) - "
          f"(CASE WHEN count_if({k} IS NULL) > 0 THEN 1 ELSE 0 END) AS pk_duplicates, count_if({k} IS NULL) AS pk_nulls "
          f"FROM {t}" for n, t, k, *_ in spec if k]
    pfk = [f"SELECT '{n}' AS table_name, count(*) AS person_fk_missing FROM {t} x WHERE NOT EXISTS "
           f"(SELECT 1 FROM person_tbl p WHERE p.person_id = x.person_id)" for n, t, k, fk, *_ in spec if fk]
    vfk = [f"SELECT '{n}' AS table_name, count_if(visit_occurrence_id IS NOT NULL AND visit_occurrence_id NOT IN "
           f"(SELECT visit_occurrence_id FROM vis_tbl)) AS visit_fk_missing, count(visit_occurrence_id) AS visit_non_null, "
           f"count(*) AS n_rows FROM {t}" for n, t, *_, v in spec if v]
    rate = [f"SELECT '{n}' AS table_name, count(*) AS n_rows, count_if(COALESCE({c}, 0) = 0) AS n_unmapped, "
            f"CASE WHEN count(*) > 0 THEN round(CAST(100.0 AS DOUBLE) * (count(*) - count_if(COALESCE({c}, 0) = 0)) / count(*), 1) "
            f"ELSE 0.0 END AS mapping_rate FROM {t}" for n, t, k, fk, d, e, c, v in spec if c]
    dr = [f"SELECT '{n}' AS table_name, count_if({d} < DATE '2001-01-01' OR {d} >= DATE '2027-01-01') AS out_of_range, "
          f"min({d}) AS min_date, max({d}) AS max_date FROM {t}" for n, t, k, fk, d, *_ in spec if d]
    ad = [f"SELECT '{n}' AS table_name, count_if(x.{d} > dm.dd) AS after_death FROM {t} x JOIN death_min dm "
          f"ON x.person_id = dm.person_id" for n, t, k, fk, d, *_ in spec if d]
    se = [f"SELECT '{n}' AS table_name, count_if({d} > {e}) AS start_after_end FROM {t}"
          for n, t, k, fk, d, e, *_ in spec if e]
    names = []
    for suffix, parts in (("pk", pk), ("person_fk", pfk), ("visit_fk", vfk), ("mapping_rate", rate),
                          ("date_range", dr), ("after_death", ad), ("start_end", se)):
        cte(f"{prefix}_{suffix}", deps, _u(parts))
        names.append(f"{prefix}_{suffix}")
    return names


def qc_report_sql(prefix: str) -> str:
    return _u([_rows(f"{prefix}_pk", "pk_duplicates", "pk_duplicates", "ERROR"),
               _rows(f"{prefix}_pk", "pk_nulls", "pk_nulls", "ERROR", "WHERE pk_nulls > 0"),
               _rows(f"{prefix}_person_fk", "person_fk", "person_fk_missing", "ERROR"),
               _rows(f"{prefix}_visit_fk", "visit_fk", "visit_fk_missing", "ERROR"),
               _rows(f"{prefix}_mapping_rate", "concept_unmapped", "n_unmapped", "WARN"),
               _rows(f"{prefix}_date_range", "date_range", "out_of_range", "WARN"),
               _rows(f"{prefix}_after_death", "after_death", "after_death", "ERROR"),
               _rows(f"{prefix}_start_end", "start_after_end", "start_after_end", "ERROR")])


_qc_names = qc_ctes("qc", _QC)
for _name, _cte in zip(("qc_pk", "qc_person_fk", "qc_visit_fk", "qc_mapping_rate", "qc_date_range", "qc_after_death",
                        "qc_start_end"), _qc_names):
    q(_name, f"SELECT * FROM {_cte}", _cte)
q("qc_report", qc_report_sql("qc"), *_qc_names)
q("pipeline_qc", qc_report_sql("pqc"), *qc_ctes("pqc", _QC_ALL))

# ---------------------------------------------------------------- compare / reconcile
cte("ck", ("cgen_tbl", "cbase_tbl"), """
SELECT g._g, b._b FROM
 (SELECT DISTINCT CAST(person_id AS VARCHAR) AS p, strftime(condition_start_date, '%Y-%m-%d') AS d,
         condition_source_value AS s, TRUE AS _g FROM cgen_tbl) g
FULL OUTER JOIN
 (SELECT DISTINCT CAST(person_id AS VARCHAR) AS p, strftime(condition_start_date, '%Y-%m-%d') AS d,
         condition_source_value AS s, TRUE AS _b FROM cbase_tbl) b
ON g.p IS NOT DISTINCT FROM b.p AND g.d IS NOT DISTINCT FROM b.d AND g.s IS NOT DISTINCT FROM b.s""")
q("compare_keys", "SELECT count_if(_g IS NOT NULL AND _b IS NOT NULL) AS n_both, count_if(_g IS NOT NULL AND _b IS NULL) "
                  "AS n_only_gen, count_if(_g IS NULL AND _b IS NOT NULL) AS n_only_base FROM ck", "ck")
cte("cmp", ("cgen_tbl", "cbase_tbl"), """
SELECT COALESCE(g.source_value, b.source_value) AS source_value, COALESCE(g.c, 0) AS gen, COALESCE(b.c, 0) AS base,
       COALESCE(g.c, 0) <> 0 AS gen_ok, COALESCE(b.c, 0) <> 0 AS base_ok
FROM (SELECT condition_source_value AS source_value, max(COALESCE(condition_concept_id, 0)) AS c FROM cgen_tbl GROUP BY 1) g
FULL OUTER JOIN
     (SELECT condition_source_value AS source_value, max(COALESCE(condition_concept_id, 0)) AS c FROM cbase_tbl GROUP BY 1) b
ON g.source_value IS NOT DISTINCT FROM b.source_value""")
q("compare_mapping", "SELECT * FROM cmp", "cmp")
q("compare_mapping_counts", "SELECT count(*) AS n_sources, count_if(gen = base AND gen_ok) AS n_same, "
                            "count_if(NOT gen_ok AND base_ok) AS n_base_only, count_if(gen_ok AND NOT base_ok) AS n_gen_only, "
                            "count_if(gen_ok AND base_ok AND gen <> base) AS n_both_differ, "
                            "count_if(NOT gen_ok AND NOT base_ok) AS n_neither FROM cmp", "cmp")
q("gap_missing", "SELECT * FROM cmp WHERE NOT gen_ok AND base_ok", "cmp")
q("gap_common_unmapped", "SELECT * FROM cmp WHERE NOT gen_ok AND NOT base_ok", "cmp")
q("recon_counts", "SELECT g AS rows_gen, b AS rows_base, g - b AS diff, "
                  "CASE WHEN b > 0 THEN round(CAST(100.0 AS DOUBLE) * g / b, 2) END AS pct FROM "
                  "(SELECT (SELECT count(*) FROM cgen_tbl) AS g, (SELECT count(*) FROM cbase_tbl) AS b)",
  "cgen_tbl", "cbase_tbl")


def _rk(col: str) -> str:
    return (f"SELECT '{col}' AS key_name, count(g.v) AS n_gen, count(b.v) AS n_base, "
            f"count_if(g.v IS NOT NULL AND b.v IS NOT NULL) AS n_both, count_if(b.v IS NULL) AS n_gen_only, "
            f"count_if(g.v IS NULL) AS n_base_only FROM "
            f"(SELECT DISTINCT {col} AS v FROM cgen_tbl WHERE {col} IS NOT NULL) g FULL OUTER JOIN "
            f"(SELECT DISTINCT {col} AS v FROM cbase_tbl WHERE {col} IS NOT NULL) b ON g.v = b.v")


q("recon_keys", _u([_rk("person_id"), _rk("condition_occurrence_id")]), "cgen_tbl", "cbase_tbl")
q("recon_concept_top10", """
SELECT * FROM (
  SELECT COALESCE(g.concept_id, b.concept_id) AS concept_id, COALESCE(g.n, 0) AS n_gen, COALESCE(b.n, 0) AS n_base,
         COALESCE(g.n, 0) - COALESCE(b.n, 0) AS diff
  FROM (SELECT condition_concept_id AS concept_id, count(*) AS n FROM cgen_tbl
        WHERE condition_concept_id IS NOT NULL GROUP BY 1) g
  FULL OUTER JOIN (SELECT condition_concept_id AS concept_id, count(*) AS n FROM cbase_tbl
        WHERE condition_concept_id IS NOT NULL GROUP BY 1) b
  ON g.concept_id = b.concept_id)
ORDER BY abs(diff) DESC, concept_id ASC NULLS FIRST LIMIT 10""", "cgen_tbl", "cbase_tbl")
q("recon_date_range", "SELECT (SELECT min(condition_start_date) FROM cgen_tbl) AS gen_min, "
                      "(SELECT max(condition_start_date) FROM cgen_tbl) AS gen_max, "
                      "(SELECT min(condition_start_date) FROM cbase_tbl) AS base_min, "
                      "(SELECT max(condition_start_date) FROM cbase_tbl) AS base_max", "cgen_tbl", "cbase_tbl")


q("stream_ids", "SELECT * EXCLUDE (condition_occurrence_id) FROM cond_tbl", "cond_tbl")


cte("cond_ids", ("cond_cn",), "SELECT condition_start_date AS event_date, count(*) AS issued FROM cond_cn GROUP BY 1")
q("stream_id_check", "SELECT condition_start_date AS event_date, count(*) AS n_rows, count(*) AS n_ids, any_value(issued) AS issued, "
  "TRUE AS in_range FROM cond_tbl JOIN cond_ids ON condition_start_date = event_date GROUP BY 1", "cond_tbl", "cond_ids")
cte("code_counts_u", ("cond_union",), CTES["code_counts"][1].replace("FROM cond_feed", "FROM cond_union"))
cte("code_status_u", ("code_counts_u", "map_KCD7", "supp"), CTES["code_status"][1].replace("code_counts c", "code_counts_u c"))
q("stream_unmapped", "SELECT 'KCD7' AS vocabulary_id, source_code, source_concept_id, concept_id, mapped, n_rows "
                     "FROM code_status_u WHERE NOT mapped", "code_status_u")
q("stream_dedupe", "SELECT DISTINCT " + ", ".join(_NK) + " FROM cond_tbl", "cond_tbl")
q("stream_dedupe_incremental", "SELECT DISTINCT " + ", ".join(_NK) + " FROM cond_tbl", "cond_tbl")
q("stream_options", "SELECT * EXCLUDE (condition_occurrence_id) FROM cond_tbl", "cond_tbl")
q("stream_observation", "SELECT * EXCLUDE (observation_id), TRUE AS unique_id FROM obs_tbl", "obs_tbl")
q("visit_sorted_file", "SELECT visit_occurrence_id, TRUE AS in_order FROM vis_tbl", "vis_tbl")
q("exclusion_sheet_csv", "SELECT DISTINCT person_id FROM excluded", "excluded")
q("batch_format_fallback", "SELECT _rid AS source_row, person_id, provider_id, hosp, condition_start_date, condition_start_datetime, "
  "condition_source_value FROM cond_feed", "cond_feed")
q("csv_feed_text_ids", "SELECT _rid AS source_row, person_id, provider_id, hosp, condition_start_date, condition_start_datetime, "
  "condition_source_value FROM cond_feed WHERE person_id IS NOT NULL", "cond_feed")
q("note_csv_load", "SELECT * REPLACE (NULLIF(note_title, '') AS note_title, NULLIF(note_text, '') AS note_text, "
  "NULLIF(note_source_value, '') AS note_source_value) FROM note_tbl", "note_tbl")
cte("vis_open", ("vis_tbl",), "SELECT * REPLACE (CASE WHEN visit_occurrence_id % 5 = 0 THEN DATE '9999-12-31' "
    "ELSE visit_end_date END AS visit_end_date) FROM vis_tbl")
cte("vis_lookup_open", ("vis_open",), CTES["vis_lookup"][1].replace("FROM vis_tbl", "FROM vis_open"))
match_ctes("m_open", "cond_feed", "_rid", "condition_start_date", provider=True, pre=0, diff=False, null_9203="none",
           lookup="vis_lookup_open")
cte("cond_third", ("cond_feed",), "SELECT * REPLACE (CASE WHEN _rid % 3 <> 0 THEN person_id END AS person_id) FROM cond_feed")
match_ctes("m_salt", "cond_third", "_rid", "condition_start_date", provider=True, pre=0, diff=False, null_9203="none")
cte("cond_one", ("cond_feed",), "SELECT * REPLACE (CASE WHEN _rid % 3 = 1 THEN (SELECT arg_min(person_id, _rid) FROM cond_feed "
    "WHERE person_id IS NOT NULL) ELSE person_id END AS person_id) FROM cond_feed")
match_ctes("m_one", "cond_one", "_rid", "condition_start_date", provider=True, pre=0, diff=False, null_9203="none")
for _n, _c in (("visit_match_open_ended", "m_open"), ("visit_match_salted", "m_salt"), ("visit_match_hot_person", "m_one")):
    q(_n, f"SELECT _rid AS source_row, visit_occurrence_id, visit_concept_id FROM {_c}", _c)
q("qc_totals", f"SELECT count_if(severity = 'ERROR') AS n_error, count_if(severity = 'WARN') AS n_warn FROM ({qc_report_sql('qc')})", *_qc_names)

# File round trips return what their in-memory counterparts return.
for _name, _same in (("vocab_tsv_concept_lookup", "concept_lookup"), ("provider_sheet_csv", "care_site_rollup"),
                     ("supplement_csv_fill", "supplement_fill"), ("supplement_repeated_code", "supplement_fill"),
                     ("dedupe_job", "dedupe_counts"), ("pipeline_streamed", "pipeline_qc"), ("gap_export_csv", "gap_missing")):
    Q[_name] = Q[_same]
# Plain CSV does not tell an empty string from a null: both load back as null.
q("condition_csv_load", "SELECT * REPLACE (NULLIF(stop_reason, '') AS stop_reason, NULLIF(condition_source_value, '') "
  "AS condition_source_value, NULLIF(condition_status_source_value, '') AS condition_status_source_value) "
  "FROM cond_tbl", "cond_tbl")


def oracle_sql() -> dict[str, str]:
    return dict(Q)
