"""The model tables of ``bindings.py`` written as DuckDB SQL CTEs (oracle side).

Independent SQL formulations: the interval algebra here is the textbook boundary / containment
self-join, the tile dedup a GROUP BY with struct minimum, the medians DuckDB's own ``median``.
"""

from __future__ import annotations

from traitflow.plans import bindings as B


def _values(rows, types):
    out = []
    for row in rows:
        vals = []
        for v, t in zip(row, types):
            vals.append(f"'{v}'" if t == "s" else f"{float(v)!r}::DOUBLE")
        out.append("(" + ", ".join(vals) + ")")
    return ", ".join(out)


AS_OF = f"DATE '{B.AS_OF}'"

CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, sql: str, deps: list[str] = ()):
    CTES[name] = f"{name} AS ({sql})"
    DEPS[name] = list(deps)


def with_clause(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    return "WITH " + ",\n".join(CTES[n] for n in order) + "\n"


cte("traits_d", f"SELECT * FROM (VALUES {_values(B.TRAITS, 'ssdd')}) t(trait, target_units, \"min\", \"max\")")
cte("aliases_d", f"SELECT * FROM (VALUES {_values(B.ALIASES, 'ss')}) t(trait, alias)")
cte("units_d", f"SELECT * FROM (VALUES {_values(B.UNITS, 'ssd')}) t(result_value_units, target, multiplication_factor)")
cte("dict_d", "SELECT t.trait, t.target_units, t.\"min\", t.\"max\", a.alias FROM traits_d t "
              "LEFT JOIN aliases_d a ON t.trait = a.trait", ["traits_d", "aliases_d"])

cte("readings", """
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS pseudo_nhs_number,
         CAST(l_shipdate AS DATE) AS test_date,
         l_returnflag || l_linestatus AS original_term,
         l_quantity AS result,
         CASE l_linenumber % 4 WHEN 0 THEN 'g/dL' WHEN 1 THEN 'g/L'
              WHEN 2 THEN CASE WHEN l_orderkey % 2 = 0 THEN '%' ELSE 'zz' END END AS result_value_units,
         CASE l_suppkey % 4 WHEN 0 THEN 'pull_a' WHEN 1 THEN 'pull_b' WHEN 2 THEN 'pull_c' ELSE 'pull_d' END AS provenance,
         CASE WHEN l_suppkey % 2 = 0 THEN 'primary_care' ELSE 'secondary_care' END AS source,
         l_orderkey, l_linenumber, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

cte("dense", """
  SELECT 'U' || CAST(user_id AS VARCHAR) AS pseudo_nhs_number, CAST(ts AS DATE) AS test_date,
         event_type AS trait, CAST(floor(value / 100) AS DOUBLE) AS final
  FROM events""")

cte("stays_raw", """
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS STUDY_ID, CAST(o_orderdate AS DATE) AS adm_d,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL
              ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 12 AS INTEGER) END AS dis_d
  FROM orders""")
cte("stays", """
  SELECT DISTINCT STUDY_ID AS pseudo_nhs_number, CAST(adm_d AS TIMESTAMP) AS adm,
         CAST(dis_d AS TIMESTAMP) + INTERVAL '23:59:59' AS dis
  FROM stays_raw""", ["stays_raw"])


def merge_ctes(p: str, src: str, deps: list[str]):
    """Boundary split + containment join + island merge over ``src(id, s, e, a, bb, ba)``."""
    cte(f"{p}_b", f"SELECT DISTINCT id, x FROM (SELECT id, s AS x FROM {src} UNION ALL "
                  f"SELECT id, e AS x FROM {src}) u WHERE x IS NOT NULL", deps)
    cte(f"{p}_seg", f"SELECT id, x AS s, LEAD(x) OVER (PARTITION BY id ORDER BY x) AS e FROM {p}_b", [f"{p}_b"])
    cte(f"{p}_cov", f"""SELECT g.id, g.s, g.e, MAX(v.a) AS a, MAX(v.bb) AS bb, MAX(v.ba) AS ba
        FROM {p}_seg g JOIN {src} v ON g.id = v.id AND g.s >= v.s AND g.e <= v.e
        WHERE g.e IS NOT NULL GROUP BY g.id, g.s, g.e""", [f"{p}_seg"] + deps)
    cte(f"{p}_brk", f"""SELECT *, CASE WHEN LAG(e) OVER w IS NULL OR s > LAG(e) OVER w
        OR a <> LAG(a) OVER w OR bb <> LAG(bb) OVER w OR ba <> LAG(ba) OVER w THEN 1 ELSE 0 END AS n
        FROM {p}_cov WINDOW w AS (PARTITION BY id ORDER BY s)""", [f"{p}_cov"])
    cte(f"{p}_isl", f"SELECT *, SUM(n) OVER (PARTITION BY id ORDER BY s ROWS UNBOUNDED PRECEDING) AS g "
                    f"FROM {p}_brk", [f"{p}_brk"])
    cte(p, f"SELECT id, MIN(s) AS s, MAX(e) AS e, a, bb, ba FROM {p}_isl GROUP BY id, g, a, bb, ba",
        [f"{p}_isl"])


REGION_TEXT = ("NULLIF(concat_ws(',', CASE WHEN {t}a = 1 THEN 'APC' END, CASE WHEN {t}bb = 1 THEN "
               "'buffer_before' END, CASE WHEN {t}ba = 1 THEN 'buffer_after' END), '')")

cte("iv1", "SELECT pseudo_nhs_number AS id, adm AS s, dis AS e, 1 AS a, 0 AS bb, 0 AS ba FROM stays "
           "WHERE adm IS NOT NULL", ["stays"])
merge_ctes("m1", "iv1", ["iv1"])
cte("adm_days", """SELECT * FROM (SELECT id, CAST(date_trunc('day', s + INTERVAL 12 HOUR) AS DATE) AS sd,
        CAST(date_trunc('day', e + INTERVAL 12 HOUR) AS DATE) AS ed FROM m1) d
    WHERE date_diff('day', sd, ed) > 2""", ["m1"])
cte("buf", """SELECT id, sd - 14 AS s, sd AS e, 0 AS a, 1 AS bb, 0 AS ba FROM adm_days
    UNION ALL SELECT id, sd, ed, 1, 0, 0 FROM adm_days
    UNION ALL SELECT id, ed, ed + 14, 0, 0, 1 FROM adm_days""", ["adm_days"])
merge_ctes("segs", "buf", ["buf"])

cte("linkage", """
  SELECT 'O' || CAST(c_custkey AS VARCHAR) AS OrageneID,
         CASE WHEN c_custkey % 2 = 0 THEN '2' ELSE '1' END AS s1qst_gender,
         CASE WHEN c_custkey % 11 = 5 THEN NULL ELSE 'P' || CAST(c_custkey AS VARCHAR) END AS pseudo_nhs_number,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'G' || CAST(c_custkey AS VARCHAR) END AS gsa_id,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'X' || CAST(c_custkey AS VARCHAR) END AS exome_id
  FROM customer""")
cte("quest", """
  SELECT 'O' || CAST(c_custkey AS VARCHAR) AS OrageneID,
         CASE WHEN c_custkey % 2 = 0 THEN '2' ELSE '1' END AS gcode,
         CASE WHEN c_custkey % 13 = 0 THEN 'NA'
              ELSE strftime(DATE '1930-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER), '%m-%Y') END AS mmyyyy
  FROM customer""")
cte("demog", """
  SELECT OrageneID, min({'dob': dob, 'gender': gender}) AS w FROM (
    SELECT OrageneID, CAST(strptime('01-' || mmyyyy, '%d-%m-%Y') AS DATE) AS dob,
           CASE gcode WHEN '1' THEN 'M' WHEN '2' THEN 'F' END AS gender
    FROM quest WHERE mmyyyy <> 'NA') q GROUP BY OrageneID""", ["quest"])
cte("people", "SELECT pseudo_nhs_number, min(OrageneID) AS OrageneID FROM linkage "
              "WHERE pseudo_nhs_number IS NOT NULL GROUP BY pseudo_nhs_number", ["linkage"])
cte("valid_demo", """SELECT p.pseudo_nhs_number, p.OrageneID, d.w.dob AS dob, d.w.gender AS gender
    FROM people p LEFT JOIN demog d ON p.OrageneID = d.OrageneID""", ["people", "demog"])


def cohort_cte(name: str, col: str):
    cte(name, f"""
      SELECT w2.p AS pseudo_nhs_number, w2.i AS IID FROM (
        SELECT w.o AS OrageneID, min({{'p': pseudo_nhs_number, 'i': w.i}}) AS w2 FROM (
          SELECT pseudo_nhs_number, min({{'o': OrageneID, 'i': {col}}}) AS w
          FROM linkage WHERE {col} IS NOT NULL AND pseudo_nhs_number IS NOT NULL AND OrageneID IS NOT NULL
          GROUP BY pseudo_nhs_number) a GROUP BY w.o) b""", ["linkage"])


cohort_cte("gsa_ids", "gsa_id")
cohort_cte("exome_ids", "exome_id")

cte("mapped", """SELECT r.*, d.trait, d.target_units, d."min", d."max"
    FROM readings r JOIN dict_d d ON r.original_term = d.alias""", ["readings", "dict_d"])
cte("ranged0", """SELECT m.*, u.target, u.multiplication_factor, u.result_value_units IS NOT NULL AS unit_matched
    FROM mapped m LEFT JOIN units_d u
      ON m.result_value_units = u.result_value_units AND m.target_units = u.target
    WHERE m.result_value_units IS NOT NULL""", ["mapped", "units_d"])
cte("ranged1", """SELECT *, CASE
      WHEN trait = 'HbA1c' AND result_value_units IN ('%', '% total Hb', '%Hb', 'per cent')
        THEN 10.93::DOUBLE * result + (-23.5)::DOUBLE
      WHEN multiplication_factor <> 1 THEN result * multiplication_factor
      ELSE result END AS final FROM ranged0""", ["ranged0"])
cte("ranged", """SELECT *, CASE WHEN final < "min" THEN 'below_min'
      WHEN final >= "min" AND final <= "max" THEN 'ok' WHEN final > "max" THEN 'above_max' END AS range_position
    FROM ranged1""", ["ranged1"])
cte("valid_ids", "SELECT DISTINCT pseudo_nhs_number FROM linkage WHERE pseudo_nhs_number IS NOT NULL", ["linkage"])
cte("with_demo", """SELECT r.*, v.OrageneID, v.dob, v.gender,
      date_diff('day', v.dob, r.test_date)::DOUBLE / 365.25::DOUBLE AS age_at_test
    FROM ranged r SEMI JOIN valid_ids i ON r.pseudo_nhs_number = i.pseudo_nhs_number
    LEFT JOIN valid_demo v ON r.pseudo_nhs_number = v.pseudo_nhs_number""", ["ranged", "valid_ids", "valid_demo"])
cte("pre", f"""SELECT * FROM with_demo WHERE range_position = 'ok' AND age_at_test >= 0
    AND test_date <= {AS_OF} AND age_at_test >= 16""", ["with_demo"])
cte("tiles", """SELECT pseudo_nhs_number, trait, final AS value,
      min({'d': test_date, 'u': target_units, 'g': gender, 'a': age_at_test, 'r': range_position}) AS w
    FROM pre WHERE final IS NOT NULL
    GROUP BY pseudo_nhs_number, trait, final, floor(date_diff('day', DATE '1970-01-01', test_date) / 11.0)""",
    ["pre"])
cte("tiled", """SELECT t.pseudo_nhs_number, t.trait, t.w.u AS unit, t.value, t.w.d AS date, t.w.g AS gender,
      t.w.a AS age_at_test, t.w.r AS minmax_outlier,
      """ + REGION_TEXT.format(t="s.") + """ AS region_types
    FROM tiles t LEFT JOIN segs s ON t.pseudo_nhs_number = s.id AND t.w.d >= s.s AND t.w.d < s.e""",
    ["tiles", "segs"])
cte("tiled_set", """SELECT *, 'all' AS setting FROM tiled
    UNION ALL SELECT *, CASE WHEN region_types IS NULL THEN 'out_hospital' ELSE 'in_hospital' END FROM tiled""",
    ["tiled"])
