"""The same computations as ``table_queries``, written as DuckDB SQL.

These are independent restatements of each rule (DuckDB's own ``strip_accents``,
``regexp_*``, window functions), used only to check the Spark results. Small helpers
expand a rule into a SQL expression so every query states it the same way.
"""

from __future__ import annotations

from airledger import fixed_values as fv
from airledger.plans import table_queries as TQ


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def collapse(x: str) -> str:
    return strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def t1(x: str) -> str:
    return collapse(rf"regexp_replace(strip_accents(lower({strip(x)})), '[,.\-()]', ' ', 'g')")


def t2(x: str) -> str:
    return collapse(rf"regexp_replace(strip_accents(lower({strip(x)})), '[,():\[\]'']', '', 'g')")


def t3(x: str) -> str:
    return collapse(rf"regexp_replace(strip_accents(lower({x})), '[.,]', ' ', 'g')")


def t4(x: str) -> str:
    return collapse(rf"regexp_replace(translate(lower({strip(x)}), 'áéíóúñü', 'aeiounu'), '-', ' ', 'g')")


def t5(x: str) -> str:
    return collapse(rf"regexp_replace(strip_accents(lower({strip(x)})), '-', ' ', 'g')")


def t6(x: str) -> str:
    s = rf"regexp_replace(lower(strip_accents({strip(x)})), '[ \t\r\n\-/\\.,;:]', '_', 'g')"
    s = rf"regexp_replace({s}, '_{{2,}}', '_', 'g')"
    return rf"regexp_replace({s}, '^_+|_+$', '', 'g')"


def t7(x: str) -> str:
    s = rf"regexp_replace(strip_accents(lower({x})), '[\t\r\n,.;:]', ' ', 'g')"
    return collapse(f"replace({s}, 'region', ' ')")


def t9(x: str) -> str:
    s = rf"regexp_replace(regexp_replace({x}, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g')"
    return f"(CASE WHEN {s} = '' THEN 'contaminante' ELSE {s} END)"


def in_list(values: list[str]) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def na(x: str, words=fv.NA_WORDS) -> str:
    return f"({x} IS NULL OR lower({strip(x)}) IN {in_list(words)})"


def clean(x: str, words=fv.NA_WORDS) -> str:
    return f"(CASE WHEN {na(x, words)} THEN NULL ELSE {strip(x)} END)"


def thousands(t: str) -> str:
    return f"replace(CASE WHEN contains({t}, ',') AND contains({t}, '.') THEN replace({t}, '.', '') ELSE {t} END, ',', '.')"


def safe(t: str) -> str:
    pat = r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"
    return f"(CASE WHEN regexp_full_match({t}, '{pat}') THEN TRY_CAST({strip(t)} AS DOUBLE) END)"


def n1(x: str) -> str:
    c = clean(x)
    return f"(CASE WHEN regexp_full_match({c}, '[+-]?[0-9.,]+') THEN {thousands(c)} ELSE {c} END)"


def n2(x: str) -> str:
    c = clean(x)
    parsed = strip(thousands(f"replace({c}, ' ', '')"))
    return (rf"(CASE WHEN regexp_full_match({c}, '[+-]?[0-9.,\s]+') THEN "
            rf"(CASE WHEN {parsed} IN ('', '-') THEN NULL ELSE {parsed} END) ELSE {c} END)")


def n3(x: str) -> str:
    return safe(rf"regexp_replace(replace({strip(x)}, ',', '.'), '\s+', '', 'g')")


def n4(x: str) -> str:
    return safe(f"replace({strip(x)}, ',', '.')")


def n5_text(x: str) -> str:
    c = clean(x)
    spaces = "regexp_replace(" + c + ", '[ \u00a0]', '', 'g')"
    t = strip(f"replace({thousands(spaces)}, '·', '')")
    return f"(CASE WHEN {t} <> '' THEN {t} END)"


def n6(x: str) -> str:
    return safe(thousands(clean(x, fv.NA_WORDS_ANALYTIC)))


def n7(x: str) -> str:
    return safe(f"replace({clean(x, fv.NA_WORDS_ANALYTIC)}, ',', '.')")


def usable(x: str) -> str:
    return f"(CASE WHEN {x} <> '-' THEN {x} END)"


def values_table(rows: list[tuple], cols: list[str]) -> str:
    def v(x):
        if x is None:
            return "NULL"
        if isinstance(x, str):
            return lit(x)
        if isinstance(x, float):
            return f"CAST({x!r} AS DOUBLE)"
        return str(x)
    body = ", ".join("(" + ", ".join(v(x) for x in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def eu(x: str) -> str:
    return f"translate(format('{{:,.2f}}', {x}), ',.', '.,')"


def us(x: str) -> str:
    return f"format('{{:,.2f}}', {x})"


def initcap1(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


def type_label_sql() -> str:
    return (f"CASE WHEN p_size % 4 = 0 THEN p_type WHEN p_size % 4 = 1 THEN ' ' || lower(p_type) || ' ' "
            f"WHEN p_size % 4 = 2 THEN {initcap1('p_type')} || ':' ELSE replace(p_type, 'E', 'É') END")


def type_dim_sql() -> str:
    return f"(SELECT {t2('label')} AS k, code FROM {values_table(TQ.TYPE_LABELS, ['label', 'code'])})"


def group_dim_sql() -> str:
    return values_table(fv.POLLUTANT_ID_GROUPS, ["gid", "grupo"])


def id_int(x: str) -> str:
    return f"TRY_CAST(trunc({safe(x)}) AS BIGINT)"


def letter_case(code: str) -> str:
    letter = rf"upper(regexp_extract({code}, '(\p{{L}})', 1))"
    whens = " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in fv.LETTER_MACRO)
    return f"(CASE {letter} {whens} END)"


def keyword_case(desc_key: str) -> str:
    whens = " ".join(f"WHEN contains({desc_key}, {lit(k)}) THEN {lit(m)}" for k, m in fv.KEYWORD_MACRO)
    return f"(CASE {whens} END)"


def is_rm(x: str) -> str:
    n = t1(x)
    return (f"coalesce(({n} IN {in_list(fv.RM_ALIASES)} OR (contains({n}, 'metropolitana') AND contains({n}, 'santiago')) "
            f"OR suffix({n}, ' rm')) AND {n} <> '', false)")


BLANK_R_NAME = "coalesce(r_name, '')"
NATION_SPACED = "replace(n_name, '_', ' ')"


# --- queries ---------------------------------------------------------------------------

def q_locale_number_parse() -> str:
    texto = (f"CASE WHEN l_linenumber = 1 THEN {eu('l_extendedprice')} WHEN l_linenumber = 2 THEN {us('l_extendedprice')} "
             f"WHEN l_linenumber = 3 THEN replace({us('l_extendedprice')}, ',', '') "
             f"WHEN l_linenumber = 4 THEN translate(replace({us('l_extendedprice')}, ',', ''), '.', ',') "
             f"WHEN l_linenumber = 5 THEN ' ' || translate({eu('l_extendedprice')}, '.', ' ') || ' ' "
             f"WHEN l_linenumber = 6 THEN 'NA' ELSE '-' END")
    return (f"WITH d AS (SELECT l_orderkey, l_linenumber, {texto} AS texto FROM lineitem) "
            f"SELECT l_orderkey, l_linenumber, texto, {n1('texto')} AS n1, {n2('texto')} AS n2, {n3('texto')} AS n3, "
            f"{n4('texto')} AS n4, {safe(n5_text('texto'))} AS n5, {n6('texto')} AS n6, {n7('texto')} AS n7, "
            f"{safe('texto')} AS f2 FROM d")


def q_int_from_float_text() -> str:
    s = "CAST(p_size AS VARCHAR)"
    texto = (f"CASE p_type WHEN 'ECONOMY' THEN {s} || '.0' WHEN 'SMALL' THEN {s} || '.9' WHEN 'PROMO' THEN ' ' || {s} || ' ' "
             f"WHEN 'LARGE' THEN {s} || 'e0' WHEN 'MEDIUM' THEN 'n' || {s} ELSE {s} END")
    return (f"WITH d AS (SELECT p_partkey, {texto} AS texto FROM part), e AS (SELECT *, {id_int('texto')} AS id_int FROM d) "
            f"SELECT p_partkey, texto, id_int, coalesce(t.grupo, {lit(fv.DEFAULT_GROUP)}) AS grupo_canonico "
            f"FROM e LEFT JOIN {group_dim_sql()} ON t.gid = e.id_int")


def q_year_extract() -> str:
    return ("WITH d AS (SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS VARCHAR) AS fecha, "
            "'ruea-efp-' || CAST(year(o_orderdate) AS VARCHAR) || '-ckan_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS archivo FROM orders) "
            "SELECT o_orderkey, archivo, TRY_CAST(regexp_extract(fecha, '([0-9]{4})', 1) AS INTEGER) AS anio_fecha, "
            "TRY_CAST(regexp_extract(o_orderpriority, '([0-9]{4})', 1) AS INTEGER) AS anio_prioridad, "
            "regexp_extract_all(archivo, '([0-9]{4})', 1)[1] AS anio_primero, "
            "list_extract(regexp_extract_all(archivo, '([0-9]{4})', 1), -1) AS anio_ultimo FROM d")


def q_text_key() -> str:
    return (f"SELECT doc_id, {t1('text')} AS k_t1, {t2('text')} AS k_t2, {t3('text')} AS k_t3, "
            f"{t4('text')} AS k_t4, {t5('text')} AS k_t5 FROM documents")


def q_snake_name() -> str:
    label = "(p_brand || ' / ' || p_type)"
    return f"SELECT p_partkey, {t6('p_name')} AS nombre_snake, {t6(label)} AS marca_snake, {t9(label)} AS archivo FROM part"


def q_region_filter() -> str:
    target = "middle east"  # of TQ.REGION_TARGET, without the word
    return (f"WITH d AS (SELECT n_nationkey, n_name, r_name, r_name || ' (RM)' AS etiqueta FROM nation JOIN region ON n_regionkey = r_regionkey) "
            f"SELECT n_nationkey, n_name, r_name, CAST({is_rm('r_name')} AS INTEGER) AS es_rm_nombre, "
            f"CAST({is_rm('etiqueta')} AS INTEGER) AS es_rm_etiqueta, "
            f"CAST(coalesce({t7('r_name')} = {lit(target)}, false) AS INTEGER) AS coincide_objetivo, "
            f"CAST(lower({strip(BLANK_R_NAME)}) = 'europe' AS INTEGER) AS igual_exacto FROM d")


def q_range_and_list_filter() -> str:
    return ("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio, o_orderpriority FROM orders "
            "WHERE year(o_orderdate) BETWEEN 1995 AND 1997 AND o_orderpriority IN ('1-URGENT', '2-HIGH') "
            "AND o_totalprice IS NOT NULL")


def q_canon_label() -> str:
    return (f"WITH d AS (SELECT p_partkey, {type_label_sql()} AS etiqueta FROM part) "
            f"SELECT p_partkey, etiqueta, dim.code AS codigo FROM d LEFT JOIN {type_dim_sql()} dim ON dim.k = {t2('d.etiqueta')}")


def q_canon_unmapped() -> str:
    return (f"WITH d AS (SELECT DISTINCT {type_label_sql()} AS valor FROM part) "
            f"SELECT valor FROM d WHERE NOT {na('valor')} AND {t2('valor')} NOT IN (SELECT k FROM {type_dim_sql()}) ORDER BY valor")


def q_canon_spelling() -> str:
    raw = (f"CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment WHEN c_nationkey % 3 = 1 THEN {initcap1('c_mktsegment')} || ' ' "
           f"ELSE '-' || lower(c_mktsegment) END")
    dim = f"(SELECT {t5('key')} AS k, spelling FROM {values_table(TQ.SEGMENT_SPELLINGS, ['key', 'spelling'])})"
    return (f"WITH d AS (SELECT c_custkey, {raw} AS comuna FROM customer), "
            f"e AS (SELECT *, CASE WHEN NOT {na('comuna')} THEN {t5('comuna')} END AS k FROM d) "
            f"SELECT c_custkey, comuna, coalesce(dim.spelling, comuna) AS comuna_canon FROM e LEFT JOIN {dim} dim ON dim.k = e.k")


def q_canon_id_default() -> str:
    return (f"WITH e AS (SELECT n_nationkey, {id_int('CAST(n_nationkey AS VARCHAR)')} AS id_int FROM nation) "
            f"SELECT n_nationkey, coalesce(t.grupo, {lit(fv.DEFAULT_GROUP)}) AS grupo_canonico FROM e LEFT JOIN {group_dim_sql()} ON t.gid = e.id_int")


def q_macro_classify() -> str:
    ciiu6 = "CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN ' na ' ELSE CAST(p_partkey AS VARCHAR) END"
    ciiu4 = "substr(p_type, 1, 1) || CAST(p_size AS VARCHAR)"
    code = f"coalesce({clean('ciiu6_id')}, {clean('ciiu4_id')}, {clean('rubro_id')})"
    desc_key = t3("dim.descr")
    return (f"WITH f AS (SELECT p_partkey, {ciiu6} AS ciiu6_id, {ciiu4} AS ciiu4_id, CAST(p_size AS VARCHAR) AS rubro_id FROM part), "
            f"g AS (SELECT p_partkey, {code} AS code FROM f), "
            f"dim AS (SELECT {clean('CAST(doc_id AS VARCHAR)')} AS code, coalesce({strip('text')}, '') AS descr FROM documents) "
            f"SELECT g.p_partkey, CASE WHEN dim.code IS NOT NULL THEN g.code END AS actividad_canon, "
            f"coalesce({letter_case('g.code')}, CASE WHEN dim.descr IS NOT NULL AND dim.descr <> '' THEN {keyword_case(desc_key)} END, "
            f"{lit(fv.DEFAULT_MACRO)}) AS actividad_macro FROM g LEFT JOIN dim ON dim.code = g.code")


def _pair_sql() -> str:
    q = "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"
    return (f"SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL ELSE {q} END AS p, "
            f"CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN {q} || '.0' "
            f"WHEN l_linenumber = 4 THEN CAST(CAST(l_quantity AS BIGINT) + 1 AS VARCHAR) ELSE {q} END AS s, "
            f"CASE WHEN l_returnflag = 'R' THEN 'ton/año' WHEN l_returnflag = 'A' THEN 'Tn/año' ELSE 't/año' END AS unidad FROM lineitem")


def q_merge_pair() -> str:
    unit = " ".join(f"WHEN unidad = {lit(a)} THEN {lit(b)}" for a, b in fv.UNIT_VARIANTS)
    return (f"SELECT l_orderkey, l_linenumber, coalesce(p, s) AS cantidad_toneladas, CASE {unit} ELSE unidad END AS unidad "
            f"FROM ({_pair_sql()})")


def q_merge_conflicts() -> str:
    return ("SELECT 'cantidad_toneladas' AS primaria, 'emision_total' AS secundaria, "
            f"CAST(count(*) FILTER (WHERE p IS NOT NULL AND s IS NOT NULL AND p <> s) AS BIGINT) AS conflictos FROM ({_pair_sql()})")


def q_value_fallback() -> str:
    src = f"CASE WHEN l_linenumber = 1 THEN '-' WHEN l_linenumber = 2 THEN 'NA' WHEN l_linenumber = 3 THEN NULL ELSE {eu('l_extendedprice')} END"
    total = f"CASE WHEN l_linenumber <= 2 THEN NULL ELSE {us('l_extendedprice')} END"
    prim = f"CASE WHEN l_linenumber = 1 THEN '-' ELSE {eu('l_tax * 1000')} END"
    comb = eu("l_discount * 1000")
    chain = ", ".join(usable(n5_text(c)) for c in ["src", "total", "prim", "comb"])
    return (f"WITH d AS (SELECT l_orderkey, l_linenumber, {src} AS src, {total} AS total, {prim} AS prim, {comb} AS comb FROM lineitem), "
            f"e AS (SELECT l_orderkey, l_linenumber, coalesce({chain}) AS emision_texto FROM d) "
            f"SELECT l_orderkey, l_linenumber, emision_texto, {safe('emision_texto')} AS emision FROM e")


def _union_sides() -> tuple[dict, dict]:
    efp = {"id_vu": "CAST(s_suppkey AS VARCHAR)", "razon_social": "s_name", "comuna": "CAST(s_nationkey AS VARCHAR)",
           "sistema": "'EFP-v1'", "ccf8_primario": "'C' || CAST(s_nationkey AS VARCHAR)", "fuente_esquema": "'EFP'"}
    r23 = {"id_vu": "CAST(c_custkey AS VARCHAR)", "razon_social": "c_name", "comuna": "CAST(c_nationkey AS VARCHAR)",
           "contaminantes": "c_mktsegment", "id_ciiu4": "'R' || CAST(c_nationkey AS VARCHAR)", "tipo_outlier": "'x'",
           "fuente_esquema": "'RUEA2023'"}
    return efp, r23


def _union_select(cols: list[str], side: dict, table: str) -> str:
    return "SELECT " + ", ".join(f"{side.get(c, 'CAST(NULL AS VARCHAR)')} AS \"{c}\"" for c in cols) + f" FROM {table}"


def q_outer_union() -> str:
    efp, r23 = _union_sides()
    cols = fv.CANON_EQUIV + ["sistema", "fuente_esquema", "tipo_outlier"]
    return _union_select(cols, efp, "supplier") + " UNION ALL " + _union_select(cols, r23, "customer")


def q_min_union() -> str:
    efp, r23 = _union_sides()
    return _union_select(fv.MIN_COMMON, efp, "supplier") + " UNION ALL " + _union_select(fv.MIN_COMMON, r23, "customer")


def q_sequential_id() -> str:
    return ("WITH o AS (SELECT o_orderkey, CASE WHEN year(o_orderdate) <> 1996 THEN CAST(year(o_orderdate) AS INTEGER) END AS anio, o_totalprice, "
            "o_orderstatus, o_orderpriority FROM orders) SELECT *, printf('%s%09d', coalesce(CAST(anio AS VARCHAR), 's/a'), "
            "row_number() OVER (PARTITION BY anio ORDER BY o_totalprice, o_orderkey)) AS id_unico FROM o")


def q_fill_from_centre() -> str:
    facts = ("SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'Nation-' || CAST(c_nationkey AS VARCHAR) END AS comuna, "
             "CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 100 THEN ' na ' ELSE CAST(c_custkey AS VARCHAR) END AS latitud, "
             "CASE WHEN c_acctbal > 9000 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS longitud FROM customer")
    centres = (f"SELECT {t4(NATION_SPACED)} AS k, CAST(n_regionkey AS VARCHAR) AS lat_c, "
               "CAST(n_nationkey AS VARCHAR) AS lon_c FROM nation")
    centres1 = f"SELECT k, lat_c, lon_c FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lat_c, lon_c) rn FROM ({centres}) WHERE k IS NOT NULL) WHERE rn = 1"
    return (f"WITH f AS ({facts}), c AS ({centres1}) "
            f"SELECT c_custkey, CASE WHEN {na('latitud')} THEN c.lat_c ELSE latitud END AS latitud_nueva, "
            f"CASE WHEN {na('longitud')} THEN c.lon_c ELSE longitud END AS longitud_nueva "
            f"FROM f LEFT JOIN c ON c.k = {t4('f.comuna')}")


def q_point_in_polygon() -> str:
    edges = []
    for unit, rings in TQ.POLYGONS:
        for ring in rings:
            pts = list(ring)
            if pts[0] != pts[-1]:
                pts.append(pts[0])
            edges += [(unit, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(pts, pts[1:])]
    e = values_table(edges, ["unit", "x1", "y1", "x2", "y2"])
    cross = ("CASE WHEN ((e.y1 > p.y) <> (e.y2 > p.y)) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END")
    onedge = ("((e.x2 - e.x1) * (p.y - e.y1) = (e.y2 - e.y1) * (p.x - e.x1) AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
              "AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))")
    return (f"WITH p AS (SELECT vec_id, CAST(embedding[2] AS DOUBLE) AS x, CAST(embedding[3] AS DOUBLE) AS y FROM embeddings), "
            f"e AS (SELECT * FROM {e}), "
            f"pip AS (SELECT p.vec_id, e.unit, sum({cross}) AS cr, bool_or({onedge}) AS oe FROM p, e GROUP BY p.vec_id, e.unit), "
            f"w AS (SELECT vec_id, unit FROM pip WHERE cr % 2 = 1 AND NOT oe) "
            f"SELECT p.vec_id, w.unit AS unidad_paisaje FROM p LEFT JOIN w ON w.vec_id = p.vec_id")


def _grouped_part() -> str:
    return (f"SELECT {id_int('CAST(p_size AS VARCHAR)')} AS _id_int_, p_type AS contaminantes, "
            f"coalesce(t.grupo, {lit(fv.DEFAULT_GROUP)}) AS grupo_canonico FROM part LEFT JOIN {group_dim_sql()} "
            f"ON t.gid = {id_int('CAST(p_size AS VARCHAR)')}")


def q_group_sizes() -> str:
    return f"SELECT grupo_canonico, CAST(count(*) AS BIGINT) AS n_filas FROM ({_grouped_part()}) GROUP BY grupo_canonico"


def q_label_dictionary() -> str:
    return (f"SELECT DISTINCT _id_int_, contaminantes, grupo_canonico FROM ({_grouped_part()}) "
            f"WHERE grupo_canonico <> {lit(fv.DEFAULT_GROUP)} AND _id_int_ IS NOT NULL AND contaminantes IS NOT NULL")


def _events_frame() -> str:
    return ("SELECT event_type, CAST(user_id AS VARCHAR) AS user_id, CAST(CASE WHEN value < 5 THEN NULL ELSE value END AS VARCHAR) AS value_n, "
            "CASE WHEN suffix(props, '1}') THEN '' ELSE props END AS props_n, CAST(NULL AS VARCHAR) AS vacia FROM events")


def q_null_profile() -> str:
    parts = []
    for c in ["user_id", "value_n", "props_n", "vacia"]:
        parts.append(f"SELECT event_type, '{c}' AS columna, CAST(count(CASE WHEN {c} <> '' THEN 1 END) AS BIGINT) AS no_nulos, "
                     f"CAST(count(*) - count(CASE WHEN {c} <> '' THEN 1 END) AS BIGINT) AS nulos, CAST(count(*) AS BIGINT) AS total "
                     f"FROM ev GROUP BY event_type")
    return f"WITH ev AS ({_events_frame()}) " + " UNION ALL ".join(parts)


def q_type_profile() -> str:
    parts = []
    for c in ["event_type", "user_id", "value_n", "props_n", "vacia"]:
        parts.append(f"SELECT '{c}' AS columna, CASE WHEN count({c}) > 0 AND count(*) FILTER (WHERE {c} IS NOT NULL AND {safe(c)} IS NULL) = 0 "
                     f"THEN 'numerico' ELSE 'texto' END AS tipo FROM ev")
    return f"WITH ev AS ({_events_frame()}) " + " UNION ALL ".join(parts)


def _yearly() -> str:
    return ("SELECT l_returnflag AS contaminante, CAST(year(l_shipdate) AS INTEGER) AS year, "
            "CASE WHEN l_returnflag = 'A' AND year(l_shipdate) = 1996 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS v FROM lineitem")


def _yearly_totals() -> str:
    return f"SELECT contaminante, year, sum(v) AS t FROM ({_yearly()}) WHERE year IS NOT NULL GROUP BY contaminante, year"


def q_annual_totals() -> str:
    return f"SELECT contaminante, year, CAST(t AS DOUBLE) AS emision FROM ({_yearly_totals()})"


def q_running_totals() -> str:
    return (f"SELECT contaminante, year, CAST(t AS DOUBLE) AS emision, CAST(CASE WHEN t IS NULL THEN NULL ELSE "
            f"sum(t) OVER (PARTITION BY contaminante ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS DOUBLE) "
            f"AS emision_acumulada FROM ({_yearly_totals()})")


def _orders_customer() -> str:
    return ("SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, c_name AS comuna, c_mktsegment AS macro, o_orderpriority AS cont, "
            "CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders JOIN customer ON o_custkey = c_custkey")


def q_two_key_totals() -> str:
    return (f"SELECT macro AS comuna, cont AS contaminante_canon, CAST(sum(v) AS DOUBLE) AS emision_total FROM ({_orders_customer()}) "
            f"WHERE anio = 1996 AND macro IS NOT NULL AND cont IS NOT NULL AND v IS NOT NULL GROUP BY macro, cont")


def q_top20_per_group() -> str:
    return (f"WITH t AS (SELECT comuna, cont, sum(v) AS tot FROM ({_orders_customer()}) WHERE comuna IS NOT NULL AND cont IS NOT NULL "
            f"AND v IS NOT NULL GROUP BY comuna, cont), r AS (SELECT *, row_number() OVER (PARTITION BY cont ORDER BY tot DESC, comuna) AS rk FROM t) "
            f"SELECT cont AS contaminante_canon, comuna, CAST(tot AS DOUBLE) AS emision_total, CAST(rk AS BIGINT) AS rank FROM r WHERE rk <= 20")


def _unit_facts() -> str:
    return (f"SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, dim.code AS cont, n_name AS unidad, "
            f"CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS v "
            f"FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN {type_dim_sql()} dim ON dim.k = {t2(type_label_sql())} "
            f"JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey")


def q_unit_report() -> str:
    return (f"WITH t AS (SELECT cont, unidad, CAST(sum(v) AS DOUBLE) AS tot FROM ({_unit_facts()}) WHERE anio = {TQ.UNIT_YEAR} "
            f"AND cont IS NOT NULL AND unidad IS NOT NULL AND v IS NOT NULL GROUP BY cont, unidad) "
            f"SELECT cont AS contaminante_canon, unidad AS unidad_paisaje, tot AS emision_total, coalesce(printf('%.6f', tot), '') AS valor_texto FROM t")


def _balances() -> str:
    return "SELECT c_mktsegment AS g, CAST(c_acctbal AS DECIMAL(18,2)) AS v FROM customer WHERE c_mktsegment IS NOT NULL AND c_acctbal IS NOT NULL"


def q_distribution() -> str:
    return (f"WITH b AS ({_balances()}), "
            f"s AS (SELECT g, CAST(count(*) AS BIGINT) AS total_registros, CAST(count(*) FILTER (WHERE v > 0) AS BIGINT) AS registros_positivos, "
            f"CAST(count(*) FILTER (WHERE v <= 0) AS BIGINT) AS registros_cero_o_negativos, CAST(min(v) FILTER (WHERE v > 0) AS DOUBLE) AS emision_min, "
            f"CAST(max(v) FILTER (WHERE v > 0) AS DOUBLE) AS emision_max, "
            f"CAST(sum(v) FILTER (WHERE v > 0) AS DOUBLE) / count(v) FILTER (WHERE v > 0) AS emision_media FROM b GROUP BY g), "
            f"p AS (SELECT g, v, row_number() OVER (PARTITION BY g ORDER BY v) AS rn, count(*) OVER (PARTITION BY g) AS n FROM b WHERE v > 0), "
            f"m AS (SELECT g, CAST(sum(v) AS DOUBLE) / count(v) AS emision_mediana FROM p WHERE rn = floor((n + 1) / 2.0) OR rn = ceil((n + 1) / 2.0) GROUP BY g) "
            f"SELECT s.g AS contaminante_canon, total_registros, registros_positivos, registros_cero_o_negativos, emision_min, emision_max, "
            f"emision_media, emision_mediana FROM s LEFT JOIN m ON s.g = m.g WHERE registros_positivos > 0")


def q_log_histogram() -> str:
    return (f"WITH b AS (SELECT g, log10(greatest(CAST(v AS DOUBLE), 1e-20)) AS lv FROM ({_balances()}) WHERE v > 0), "
            f"bd AS (SELECT g, min(lv) AS lo0, max(lv) AS hi0 FROM b GROUP BY g), "
            f"bd2 AS (SELECT g, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM bd) "
            f"SELECT b.g AS contaminante_canon, CAST(least(floor((lv - lo) / (hi - lo) * {fv.HISTOGRAM_BINS}), {fv.HISTOGRAM_BINS - 1}) AS INTEGER) AS bin, "
            f"CAST(count(*) AS BIGINT) AS frecuencia FROM b JOIN bd2 ON b.g = bd2.g GROUP BY 1, 2")


def _series() -> str:
    return ("SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, l_returnflag AS grupo, "
            "CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS v FROM lineitem")


def q_pivot_series() -> str:
    cols = ", ".join(f"CAST(sum(CASE WHEN grupo = '{g}' THEN v END) AS DOUBLE) AS \"{g}\"" for g in TQ.GROUPS)
    return f"SELECT anio AS \"año\", {cols} FROM ({_series()}) GROUP BY anio"


def q_unpivot_series() -> str:
    parts = " UNION ALL ".join(f"SELECT \"año\", '{g}' AS grupo, \"{g}\" AS emision FROM w" for g in TQ.GROUPS)
    return (f"WITH w AS ({q_pivot_series()}), l AS ({parts}) "
            f"SELECT * FROM l WHERE grupo IN (SELECT grupo FROM l GROUP BY grupo HAVING count(emision) > 0)")


def q_link_discovery() -> str:
    """The pages' own anchors are all ``<a href="/...">``, so they are cut at that text; the
    query's rewriting is undone by rule: a capital first letter names the file type."""
    return ("WITH a AS (SELECT page_id, url, unnest(string_split(html, '<a href=\"')[2:]) AS rest, "
            "unnest(range(len(string_split(html, '<a href=\"')) - 1)) AS pos FROM pages), "
            "t AS (SELECT page_id, url, pos, split_part(rest, '\"', 1) AS path FROM a), "
            "d AS (SELECT *, CASE WHEN regexp_full_match(path, '/[A-H][A-Za-z]*') THEN '.csv' WHEN regexp_full_match(path, '/[I-P][A-Za-z]*') THEN '.XLSX' "
            "WHEN regexp_full_match(path, '/[Q-Z][A-Za-z]*') THEN '.xls' END AS kind FROM t) "
            "SELECT page_id, CAST(pos AS BIGINT) AS pos, split_part(url, '/', 1) || '//' || split_part(split_part(split_part(url, '/', 3), '?', 1), '#', 1) || path || kind AS enlace "
            "FROM d WHERE kind IS NOT NULL")


def q_top3_units() -> str:
    return (f"WITH m AS (SELECT unidad, CAST(sum(v) AS DOUBLE) / count(v) AS media FROM ({_unit_facts()}) WHERE anio = {TQ.UNIT_YEAR} "
            f"AND unidad IS NOT NULL AND v IS NOT NULL GROUP BY unidad), r AS (SELECT *, row_number() OVER (ORDER BY media DESC, unidad) AS rk FROM m) "
            f"SELECT unidad AS unidad_paisaje, media, CAST(rk AS BIGINT) AS rank FROM r WHERE rk <= 3")


def q_macro_share() -> str:
    return (f"WITH t AS (SELECT cont, macro, sum(v) AS tot FROM ({_orders_customer()}) WHERE cont IS NOT NULL AND macro IS NOT NULL "
            f"AND v IS NOT NULL GROUP BY cont, macro) SELECT cont AS contaminante_canon, macro AS actividad_macro, CAST(tot AS DOUBLE) AS total, "
            f"CAST(tot AS DOUBLE) / CAST(sum(tot) OVER (PARTITION BY cont) AS DOUBLE) AS participacion FROM t")


def q_extreme_years() -> str:
    return (f"WITH t AS (SELECT contaminante, year, CAST(t AS DOUBLE) AS e FROM ({_yearly_totals()}) WHERE t IS NOT NULL), "
            f"r AS (SELECT *, row_number() OVER (PARTITION BY contaminante ORDER BY e DESC, year) AS hi, "
            f"row_number() OVER (PARTITION BY contaminante ORDER BY e ASC, year) AS lo FROM t) "
            f"SELECT contaminante, max(CASE WHEN hi = 1 THEN year END) AS anio_max, max(CASE WHEN hi = 1 THEN e END) AS total_max, "
            f"max(CASE WHEN lo = 1 THEN year END) AS anio_min, max(CASE WHEN lo = 1 THEN e END) AS total_min FROM r GROUP BY contaminante")


def q_yearly_increase() -> str:
    totals = ("SELECT o_custkey AS contaminante, CAST(year(o_orderdate) AS INTEGER) AS year, "
              "sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2")
    return (f"WITH t AS (SELECT contaminante, year, CAST(t AS DOUBLE) AS emision FROM ({totals}) WHERE t IS NOT NULL), "
            f"l AS (SELECT *, lag(emision) OVER (PARTITION BY contaminante ORDER BY year) AS anterior FROM t), "
            f"c AS (SELECT *, (emision - anterior) / abs(anterior) AS cambio_relativo FROM l) "
            f"SELECT contaminante, year, emision, anterior, cambio_relativo FROM c WHERE cambio_relativo > 0.1")


def q_coverage_gaps() -> str:
    return ("WITH p AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders "
            "WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL), y AS (SELECT DISTINCT anio FROM p), k AS (SELECT DISTINCT o_custkey FROM p) "
            "SELECT k.o_custkey, y.anio FROM k, y WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.o_custkey = k.o_custkey AND p.anio = y.anio)")


ORACLE = {name: globals()[f"q_{name}"] for name in TQ.QUERIES}
