"""SQL building blocks: what the feeds hold, computed from the base tables."""

EVENTS = """
ev AS (
  SELECT event_id // 64 AS doc, event_id, user_id, event_type,
         CAST(round(value * 100) AS BIGINT) AS raw
  FROM events),
obj AS (
  SELECT *,
         CAST(dense_rank() OVER (PARTITION BY doc ORDER BY event_type) - 1 AS INTEGER) AS md,
         CAST(row_number() OVER (PARTITION BY doc, event_type ORDER BY event_id) - 1 AS INTEGER) AS mv,
         CAST(row_number() OVER (PARTITION BY doc ORDER BY event_id) - 1 AS INTEGER) AS object_pos,
         CAST(user_id % 40 AS VARCHAR) AS u,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc % 24 * 60 + doc % 4 * 15 AS INTEGER)) AS file_time
  FROM ev),
lte AS (
  SELECT *,
         CASE WHEN event_id % 10 = 9 THEN NULL ELSE 'C' || u END AS cell_id,
         CASE WHEN event_id % 10 = 9 THEN 'ManagedElement=1'
              WHEN event_id % 6 = 0 THEN 'ManagedElement=1,ENodeBFunction=1,EUtranCellFDD=C' || u
                || ',EUtranFreqRelation=' || (event_id % 4) || ',EUtranCellRelation=' || (event_id % 9)
              ELSE 'ManagedElement=1,ENodeBFunction=1,EUtranCellFDD=C' || u END AS moid,
         CASE WHEN raw % 11 = 0 THEN NULL WHEN raw % 7 = 0 THEN '0'
              ELSE (event_id % 50) || ',' || (raw % 9) END AS hist
  FROM obj),
tall AS (
  SELECT doc, md, mv, 0 AS r, moid, cell_id, 'pm_' || event_type AS counter, CAST(raw AS VARCHAR) AS raw FROM lte
  UNION ALL
  SELECT doc, md, mv, 1 AS r, moid, cell_id, 'pmHist' AS counter, hist AS raw FROM lte WHERE hist IS NOT NULL),
merged AS (
  SELECT doc, cell_id, counter, arg_max(raw, md * 100 + mv) AS raw
  FROM tall WHERE cell_id IS NOT NULL GROUP BY doc, cell_id, counter),
umts AS (
  SELECT *,
         CASE WHEN event_id % 10 = 9 THEN NULL ELSE 'U' || u END AS cell_id,
         CASE WHEN event_id % 10 = 9 THEN NULL WHEN event_id % 12 = 0 THEN 'umtscell'
              WHEN event_id % 12 = 4 THEN 'ltecell' WHEN event_id % 12 = 8 THEN 'gsmcell' END AS rel_type,
         CASE WHEN event_id % 10 <> 9 AND event_id % 4 = 0 THEN CAST(event_id % 4 AS VARCHAR) END AS freq_rel,
         CASE WHEN event_id % 10 <> 9 AND event_id % 4 = 0 THEN CAST(event_id % 9 AS VARCHAR) END AS cell_rel
  FROM obj)
"""

# The first 10 report columns, from doc and file_time, as an Ericsson report has them.
ERIC_FRONT = """
strftime(date_trunc('hour', file_time - INTERVAL 4 HOUR), '%Y-%m-%d %H:%M') AS "HL_DATE",
'HM' AS "HL_MARKET", '1' AS "Cntr", 'East' AS "Region", 'M1' AS "Market", 'Area' || (doc % 7) AS "SubNetwork_2",
strftime(file_time - INTERVAL 4 HOUR, '%Y-%m-%d %H:%M') AS "PERIOD_START_TIME", '15' AS "PERIOD_DURATION",
'N' || doc AS "MeContext", 'OSS' || (doc % 5) AS "OSSName"
"""
DOC_TIME = "TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc % 24 * 60 + doc % 4 * 15 AS INTEGER)) AS file_time"

# Nokia objects as the LTE feed writes them.
LTE_OBJECTS = EVENTS + """,
nok AS (
  SELECT *, 'PLMN-PLMN/MRBTS-' || u || '/LNBTS-' || u || '/LNCEL-' || (event_id % 3) AS cell,
         CASE WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN NULL
              ELSE '310' || (user_id % 3 + 260) END AS plmn,
         CASE event_type WHEN 'view' THEN 'lte_isys_ho_utran_nb' WHEN 'click' THEN 'lte_cell_avail'
              WHEN 'purchase' THEN 'lte_cell_throughput' WHEN 'signup' THEN 'lte_rrc' ELSE 'lte_unlisted' END AS meas_type,
         CASE WHEN event_type = 'view' THEN 3
              WHEN event_type = 'purchase' THEN 2 - CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END
                                             + CASE WHEN event_id % 3 = 1 THEN 1 ELSE 0 END
              ELSE 2 END AS n_mo,
         CASE WHEN event_type = 'view' OR (event_type = 'purchase' AND event_id % 3 = 1)
              THEN 'PLMN-PLMN/UTRAN-' || (event_id % 5) END AS neighbour
  FROM obj),
nok2 AS (
  SELECT *, coalesce(plmn, '') || '-' || u || '-' || (event_id % 3) AS cell_2, file_time AS period_start
  FROM nok),
elements AS (
  SELECT doc, object_pos, event_id, meas_type, 'M8017C7' AS code, raw AS val FROM nok2 WHERE event_type = 'view'
  UNION ALL SELECT doc, object_pos, event_id, meas_type, 'M8017C9', event_id % 100 FROM nok2
            WHERE event_type = 'view' AND event_id % 4 <> 0
  UNION ALL SELECT doc, object_pos, event_id, meas_type, 'M8020C3', raw FROM nok2 WHERE event_type = 'click'
  UNION ALL SELECT doc, object_pos, event_id, meas_type, 'M8020C6', event_id % 100 FROM nok2 WHERE event_type = 'click'
  UNION ALL SELECT doc, object_pos, event_id, meas_type, 'M8020C77', 1 FROM nok2 WHERE event_type = 'click'
  UNION ALL SELECT doc, object_pos, event_id, meas_type, 'M8012C22', raw FROM nok2
            WHERE event_type = 'purchase' AND n_mo = 2
  UNION ALL SELECT doc, object_pos, event_id, meas_type, 'M8008C1', raw FROM nok2
            WHERE event_type = 'signup' AND event_id % 4 <> 0
  UNION ALL SELECT doc, object_pos, event_id, meas_type, 'M9C1', raw FROM nok2 WHERE event_type = 'error'
  UNION ALL SELECT doc, object_pos, event_id, meas_type, 'M9C' || (event_id % 3 + 2), event_id % 3 + 2 FROM nok2
            WHERE event_type = 'error')
"""


def pick(key: str, *options: str) -> str:
    """One of the options by key modulo their number."""
    whens = " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(options))
    return f"CASE {key} % {len(options)} {whens} END"


TRAFFIC_CLASS = ("background", "interactive", "conversational")
TRAFFIC_SUBCLASS = ("PS_NRT_data", "CS_voice", "PS_RT_data", "PS_NRT_data", "other")
CHANNEL_TYPE = ("DCH", "HSUPA", "HSDPA", "HSUPA")

UMTS_OBJECTS = EVENTS + f""",
nok AS (
  SELECT *, 'NE-RNC-' || (user_id % 10) AS base_id, 'NE-WBTS-' || u || '/WCEL-' || (event_id % 3) AS local_moid,
         'PLMN-PLMN/RNC-' || (user_id % 10) || '/WBTS-' || u || '/WCEL-' || (event_id % 3) AS cell_id_1,
         (user_id % 10) || '-' || u || '-' || (event_id % 3) AS cell_id_2,
         {pick('event_id', *TRAFFIC_CLASS)} AS tr_class, {pick('event_id', *TRAFFIC_SUBCLASS)} AS tr_subclass,
         {pick('event_id', *CHANNEL_TYPE)} AS ch_type,
         CASE WHEN event_type IN ('view', 'click', 'error') THEN 'rcpm_rlc_wcel' ELSE 'rcpm_olpc_wcel' END AS meas_type
  FROM obj)
"""


def rlc_sums(c29: str, c30: str, c31: str, c33: str) -> str:
    ps = "tr_subclass IN ('PS_NRT_data', 'PS_RT_data')"
    columns = [
        ("dl_vol_dch", c31, f"{ps} AND ch_type = 'DCH'"), ("dl_vol_non_dch", c31, f"{ps} AND ch_type <> 'DCH'"),
        ("dl_time_dch", c29, f"{ps} AND ch_type = 'DCH'"), ("dl_time_non_dch", c29, f"{ps} AND ch_type <> 'DCH'"),
        ("ul_vol_non_hsupa", c30, f"{ps} AND ch_type <> 'HSUPA'"), ("ul_vol_hsupa", c30, "ch_type = 'HSUPA'"),
        ("ul_time_non_hsupa", c33, f"{ps} AND ch_type <> 'HSUPA'"), ("ul_time_hsupa", c33, "ch_type = 'HSUPA'"),
    ]
    return _case_sums([(n, v, w, "BIGINT") for n, v, w in columns])


def olpc_sums(c4: str, c5: str, c15: str, c17: str) -> str:
    groups = [
        ("cs", "tr_subclass = 'CS_voice'"),
        ("ps", "tr_subclass = 'PS_NRT_data' AND tr_class IN ('background', 'interactive')"),
        ("hsupa", "tr_subclass IN ('PS_NRT_data', 'PS_RT_data') AND ch_type = 'HSUPA'"),
    ]
    columns = []
    for name, where in groups:
        columns += [
            (f"crc_nok_{name}", c5, where, "BIGINT"), (f"crc_ok_{name}", c4, where, "BIGINT"),
            (f"pwr_sum_{name}", c15, where, "DOUBLE"), (f"pwr_samples_{name}", c17, where, "BIGINT"),
        ]
    return _case_sums(columns)


def _case_sums(columns) -> str:
    return ", ".join(
        f"CAST(coalesce(sum(CASE WHEN {w} THEN {v} END), 0) AS {t}) AS {n}" for n, v, w, t in columns
    )
