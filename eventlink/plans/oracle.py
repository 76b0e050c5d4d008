"""DuckDB oracle SQL: an independent, literal formulation of every registered
query (fixture views inlined as CTEs, then the reference-style SQL).

Literal forms are used on purpose where our Spark plan uses a fast form: the
trailing-window count is a self-join here, prefix matches are ``LIKE``, range
matches are ``BETWEEN`` joins, surrogate ids are a global ``dense_rank``.
"""

from __future__ import annotations

import re

from ..sources.fixture_sql import FIXTURE_SQL

LO = "DATE '1995-01-01'"
HI = "DATE '2000-12-31'"


def _group_code(c: str) -> str:
    t = f"trim({c})"
    return (f"CASE WHEN length({t}) > 3 THEN ltrim({t}, '0') WHEN length({t}) < 3 THEN lpad({t}, 3, '0') "
            f"ELSE {t} END")


# Named CTE bodies; names start with o_ so they never collide with columns.
CTE: dict[str, str] = {}

CTE["o_span"] = f"""
SELECT patid, MIN(s) AS enr_start, MAX(e) AS enr_end FROM (
  SELECT patid, cov_start AS s, cov_end AS e FROM fx_coverage WHERE cov_end BETWEEN {LO} AND {HI}
  UNION ALL
  SELECT patid, COALESCE(discharge_date, admit_date), COALESCE(discharge_date, admit_date) FROM fx_encounter
  WHERE COALESCE(discharge_date, admit_date) BETWEEN {LO} AND {HI} AND enc_type NOT IN ('NI','UN','OT')
    AND trim(enc_type) <> ''
) u GROUP BY patid"""

CTE["o_death"] = f"""
SELECT patid, MAX(death_date) AS death_date FROM fx_death WHERE death_date BETWEEN {LO} AND {HI} GROUP BY patid"""

CTE["o_admit"] = f"""
SELECT e.patid, e.encounterid, e.enc_type, {_group_code('e.grp_code')} AS drg, e.admit_date, e.discharge_date,
       e.discharge_status, e.discharge_disposition, e.provider_id, s.enr_start, s.enr_end,
       s.enr_end AS censor_date, d.death_date
FROM o_cohort s JOIN fx_encounter e ON s.patid = e.patid LEFT JOIN o_death d ON s.patid = d.patid
WHERE e.enc_type IN ('IP','EI') AND e.admit_date BETWEEN s.enr_start AND s.enr_end"""

CTE["o_lagged"] = """
SELECT a.*,
  LEAD(encounterid) OVER w AS encounterid_lead, LEAD(admit_date) OVER w AS admit_date_lead,
  LEAD(enc_type) OVER w AS enc_type_lead, LEAD(drg) OVER w AS drg_lead, LEAD(provider_id) OVER w AS provider_id_lead
FROM o_admit a WINDOW w AS (PARTITION BY patid ORDER BY admit_date, encounterid)"""

CTE["o_lookback"] = """
SELECT a.patid, a.encounterid, COUNT(DISTINCT b.admit_date) AS n_prior_12m
FROM o_admit a JOIN o_admit b ON a.patid = b.patid
WHERE b.admit_date < a.admit_date AND b.admit_date >= a.admit_date - INTERVAL 12 MONTH
GROUP BY a.patid, a.encounterid"""

CTE["o_linked"] = """
SELECT * FROM (
  SELECT l.*, COALESCE(NULLIF(date_diff('day', l.admit_date, l.discharge_date), 0), 1) AS los,
         date_diff('day', l.discharge_date, l.admit_date_lead) AS days_to_next,
         date_diff('day', l.discharge_date, l.censor_date) AS days_to_censor,
         date_diff('day', l.discharge_date, l.death_date) AS days_to_death,
         lb.n_prior_12m
  FROM o_lagged l LEFT JOIN o_lookback lb ON l.patid = lb.patid AND l.encounterid = lb.encounterid
) t WHERE days_to_next > 0 OR days_to_next IS NULL"""

CTE["o_pdx"] = """
SELECT d.* FROM fx_dx d WHERE d.pdx = 'P' AND EXISTS (SELECT 1 FROM o_linked l WHERE l.patid = d.patid)"""

CTE["o_dx_grp"] = """
SELECT d.patid, d.encounterid, k.grp FROM o_pdx d JOIN fx_dict10 k ON replace(d.dx, '.', '') = k.code AND d.dx_type = '10'
UNION
SELECT d.patid, d.encounterid, k.grp FROM o_pdx d JOIN fx_dict9 k ON rpad(replace(d.dx, '.', ''), 5, '0') = k.code AND d.dx_type = '09'"""

CTE["o_ppx"] = """
SELECT p.* FROM fx_px p WHERE EXISTS (SELECT 1 FROM o_linked l WHERE l.patid = p.patid)"""

CTE["o_px_grp"] = """
SELECT p.patid, p.encounterid, r.grp FROM o_ppx p JOIN fx_ranges r
  ON TRY_CAST(p.px AS DOUBLE) BETWEEN TRY_CAST(r.lb AS DOUBLE) AND TRY_CAST(r.ub AS DOUBLE)
 AND p.px_type = 'CH' AND regexp_full_match(p.px, '[0-9]+') AND regexp_full_match(r.lb, '[0-9]+')
UNION
SELECT p.patid, p.encounterid, r.grp FROM o_ppx p JOIN fx_ranges r
  ON p.px = r.lb AND p.px_type = 'CH' AND NOT regexp_full_match(r.lb, '[0-9]+')
UNION
SELECT p.patid, p.encounterid, k.grp FROM o_ppx p JOIN fx_pxdict9 k ON replace(p.px, '.', '') = k.code AND p.px_type = '09'
UNION
SELECT p.patid, p.encounterid, k.grp FROM o_ppx p JOIN fx_pxdict10 k ON p.px = k.code AND p.px_type = '10'"""

CTE["o_index_keys"] = """
SELECT DISTINCT l.patid, l.encounterid, g.grp, x.excl_type
FROM o_linked l JOIN o_dx_grp g ON l.patid = g.patid AND l.encounterid = g.encounterid
JOIN fx_excl x ON g.grp = x.grp AND x.list = 'index'"""

CTE["o_planned_keys"] = """
SELECT l.patid, l.encounterid, g.grp
FROM o_linked l JOIN o_px_grp g ON l.patid = g.patid AND l.encounterid = g.encounterid
JOIN fx_excl x ON g.grp = x.grp AND x.list = 'planned' AND x.code_kind = 'px'
UNION
SELECT l.patid, l.encounterid, g.grp
FROM o_linked l JOIN o_dx_grp g ON l.patid = g.patid AND l.encounterid = g.encounterid
JOIN fx_excl x ON g.grp = x.grp AND x.list = 'planned' AND x.code_kind = 'dx'"""

_LEAST_STRICT = ("CASE WHEN l.days_to_censor IS NULL OR COALESCE(l.days_to_death, l.days_to_censor) IS NULL "
                 "THEN NULL ELSE least(COALESCE(l.days_to_death, l.days_to_censor), l.days_to_censor) END")

CTE["o_label"] = f"""
SELECT l.*, CASE WHEN (l.days_to_next <= 30 AND p.encounterid IS NULL)
                   OR (l.encounterid_lead IS NULL AND l.days_to_death <= 30) THEN 1 ELSE 0 END AS label
FROM o_linked l
LEFT JOIN (SELECT DISTINCT patid, encounterid FROM o_planned_keys) p
  ON l.patid = p.patid AND l.encounterid_lead = p.encounterid
WHERE {_LEAST_STRICT} > 30
  AND l.discharge_disposition NOT IN ('E') AND l.discharge_status NOT IN ('AM','EX','IP','SH')
  AND NOT EXISTS (SELECT 1 FROM o_index_keys i WHERE i.patid = l.patid AND i.encounterid = l.encounterid)"""

CTE["o_label_drop"] = f"""
SELECT l.*, CASE WHEN l.days_to_next <= 30 OR (l.encounterid_lead IS NULL AND l.days_to_death <= 30)
                 THEN 1 ELSE 0 END AS label
FROM o_linked l
WHERE {_LEAST_STRICT} > 30
  AND l.discharge_disposition NOT IN ('E') AND l.discharge_status NOT IN ('AM','EX','IP','SH')
  AND NOT EXISTS (SELECT 1 FROM o_index_keys i WHERE i.patid = l.patid AND i.encounterid = l.encounterid)
  AND NOT EXISTS (SELECT 1 FROM o_planned_keys c WHERE c.patid = l.patid AND c.encounterid = l.encounterid_lead)"""


CTE["o_firstm"] = """
SELECT patid, first_value, first_date FROM (
  SELECT patid, measure_num AS first_value, measure_date AS first_date,
         ROW_NUMBER() OVER (PARTITION BY patid ORDER BY measure_date, measure_num) AS rn
  FROM fx_measure WHERE measure_type = 'BMI' AND measure_num BETWEEN 30 AND 200) t WHERE rn = 1"""

CTE["o_cohort"] = """
SELECT patid, birth_date, sex, race, hispanic, enr_start, enr_end, ctx_id, first_value, first_date,
       age_at_enr_start, enr_dur FROM (
  SELECT p.patid, p.birth_date, p.sex, p.race, p.hispanic, s.enr_start, s.enr_end, c.ctx_id,
         f.first_value, f.first_date,
         CAST(round(date_diff('day', p.birth_date, s.enr_start) / 365.25) AS BIGINT) AS age_at_enr_start,
         date_diff('day', s.enr_start, s.enr_end) AS enr_dur,
         ROW_NUMBER() OVER (PARTITION BY p.patid ORDER BY date_diff('day', s.enr_start, s.enr_end), c.ctx_id) AS rn
  FROM fx_person p JOIN o_span s ON p.patid = s.patid JOIN fx_crosswalk c ON p.patid = c.patid
  LEFT JOIN o_firstm f ON p.patid = f.patid
  WHERE round(date_diff('day', p.birth_date, s.enr_start) / 365.25) >= 18) t WHERE rn = 1"""


_NAME = re.compile(r"\b(?:fx|o)_\w+\b")


def _deps(name: str, acc: list[str]) -> None:
    if name in acc:
        return
    body = FIXTURE_SQL.get(name) or CTE.get(name)
    if body is None:
        return
    for d in _NAME.findall(body):
        if d != name:
            _deps(d, acc)
    acc.append(name)


def compose(final_select: str, *extra: tuple[str, str]) -> str:
    """Prefix ``final_select`` with every fixture/oracle CTE it reads.

    ``extra`` adds query-local CTEs ``(name, body)`` (names must start ``o_``).
    """
    local = dict(extra)
    saved = {k: CTE.get(k) for k in local}
    CTE.update(local)
    try:
        acc: list[str] = []
        for n in _NAME.findall(final_select):
            _deps(n, acc)
        parts = []
        for n in acc:
            body = FIXTURE_SQL.get(n) or CTE[n]
            parts.append(f"{n} AS (\n{body.strip()}\n)")
    finally:
        for k, v in saved.items():
            if v is None:
                CTE.pop(k, None)
            else:
                CTE[k] = v
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final_select.strip()
