"""End to end: three register layouts over 19 years -> silver -> gold -> products, checked
against a plain-Python run of the same rules over the same files (csv module, dicts)."""

from __future__ import annotations

import csv
import io
import os
import random
import re
import tempfile
import unicodedata

import pytest
from pyspark.sql import functions as F

from airledger import fixed_values as fv
from airledger.operators import geo, ids
from airledger.plans import file_queries as FQ
from airledger.plans import pipeline as P
from airledger.sources import registers as R
from airledger.sources import sinks

EFP_V2 = [c for c in fv.ORDER_2019_2022 if c != "sistema"]
POLLUTANTS = ["MP2,5", "NOx", "Dióxido de azúfre (SO2)", "Ozono", "Benzene", "PM10, primary"]
COMUNAS = ["ÑUÑOA", "Maipu", "Til-Til", "santiago", None]
REGIONS = ["Metropolitana de Santiago", "Región Metropolitana de Santiago (RM)", "Valparaíso", "RM"]


def _row_values(year: int, i: int) -> dict:
    region = REGIONS[(year + i) % len(REGIONS)]
    qty = [f"{i + 1},5", f"1.{i:03d},25", "-", "", "NA", f"{year % 7}.5"][(year + i) % 6]
    return {
        "año": str(year), "razon_social": f"Empresa; {i}" if i == 1 else f"Empresa {i}",
        "rut_razon_social": f"{i}-K", "nombre_establecimiento": f"E{i}", "id_vu": str(i),
        "ciiu4": "x", "id_ciiu4": ["C101", "4510", "", "Z9"][i % 4], "rubro_vu": "r", "id_rubro_vu": "",
        "region": region, "provincia": "p", "comuna": COMUNAS[(year + i) % len(COMUNAS)] or "",
        "id_comuna": "1", "latitud": ["-33,45", "", "-33.5"][i % 3], "longitud": ["-70,6", "", "-70.7"][i % 3],
        "cantidad_toneladas": qty, "unidad": "ton/año",
        "contaminantes": POLLUTANTS[(year * 3 + i) % len(POLLUTANTS)], "id_contaminantes": "44.0",
        "fuente_emisora_general": "f", "id_fuente_emisora": "1",
        "emision_primario": f"{i},25", "emision_total": f"{i + 2},75",
        "contaminante": POLLUTANTS[(year + i) % len(POLLUTANTS)], "contaminante_id": "8",
        "emision_combustible_primario": "3,5",
    }


def write_registers(root: str) -> None:
    os.makedirs(root, exist_ok=True)
    for year in range(2005, 2024):
        if year == 2023:
            name, header = "ckan_ruea_2023.csv", list(fv.RUEA2023_EXPECTED)
        elif year >= 2019:
            name, header = f"ruea-efp-{year}-ckan.csv", list(EFP_V2)
        else:
            name, header = f"ruea-efp-{year}-ckan.csv", list(fv.EFP_EXPECTED)
        if year == 2014:  # column order differs in one year
            header[1], header[2] = header[2], header[1]
        enc = "latin-1" if year == 2010 else "utf-8"
        buf = io.StringIO()
        w = csv.writer(buf, delimiter=";", lineterminator="\n")
        w.writerow(header)
        for i in range(6):
            vals = _row_values(year, i)
            w.writerow([vals.get(c, "") for c in header])
        text = buf.getvalue()
        if year == 2008:  # a long row and a short row
            text += ";".join(["2008"] + ["x"] * len(header)) + "\n"
            text += "2008;solo;" + "Metropolitana de Santiago" + "\n"
        data = text.encode(enc)
        if year == 2012:
            data = "﻿".encode() + data
        with open(os.path.join(root, name), "wb") as fh:
            fh.write(data)


# --- plain-Python restatement of the chain, for the fixture only ---------------------------

def fold(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def t1(s):
    s = fold(s.strip().lower())
    for ch in ",.-()":
        s = s.replace(ch, " ")
    return " ".join(s.split())


def is_rm(v):
    n = t1(v or "")
    return bool(n) and (n in fv.RM_ALIASES or ("metropolitana" in n and "santiago" in n) or n.endswith(" rm"))


def t2(s):
    s = fold(s.strip().lower())
    for ch in ",():[]'":
        s = s.replace(ch, "")
    return " ".join(s.split())


CANON = {t2(a): b for a, b in fv.POLLUTANT_LABELS}
MUNI = {k: v for k, v in fv.MUNICIPALITIES}


def n1(v):
    if v is None:
        return None
    t = v.strip()
    if t.lower() in fv.NA_WORDS:
        return None
    if re.fullmatch(r"[+-]?[0-9.,]+", t):
        if "," in t and "." in t:
            t = t.replace(".", "")
        return t.replace(",", ".")
    return t


def n5(v):
    if v is None:
        return None
    t = v.strip()
    if t.lower() in fv.NA_WORDS or t == "":
        return None
    n = unicodedata.normalize("NFKC", t).replace(" ", "")
    if "," in n and "." in n:
        n = n.replace(".", "")
    return n.replace(",", ".").replace("·", "").strip() or None


def to_float(s):
    try:
        return float(s) if s is not None and re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", s) else None
    except ValueError:
        return None


def expected_silver(root):
    out = []
    seq = {}
    for name in sorted(os.listdir(root)):
        year = int(re.findall(r"(\d{4})", name)[-1])
        raw = open(os.path.join(root, name), "rb").read()
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            text = raw.decode("latin-1")
        text = text.lstrip("﻿")
        rows = list(csv.reader(io.StringIO(text), delimiter=";"))
        header, body = rows[0], rows[1:]
        label = next((str(min(ys)) for _, ys in fv.ERAS if year in ys), str(year))
        for r in body:
            if len(r) > len(header):
                continue
            d = {h: (r[k] if k < len(r) else None) for k, h in enumerate(header)}
            d = {h: (n1(v) if h != "unidad" else "t/año") for h, v in d.items()}
            if not is_rm(d.get("region")):
                continue
            seq[label] = seq.get(label, 0) + 1
            pol = d.get("contaminantes") or d.get("contaminante")
            src = d.get("emision_total") if year == 2023 else d.get("cantidad_toneladas")
            chain = [src] + [d.get(c) for c in fv.EMISSION_FALLBACK_WITH_TOTAL]
            em = next((x for x in (n5(c) for c in chain) if x not in (None, "-")), None)
            com = d.get("comuna")
            if com is not None and com.strip().lower() not in fv.NA_WORDS:
                key = " ".join(fold(com.strip().lower()).replace("-", " ").split())
                com = MUNI.get(key, com)
            out.append((f"{label}{seq[label]:09d}", year, CANON.get(t2(pol)) if pol else None, to_float(em), com))
    return out


@pytest.fixture(scope="module")
def registers(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("registers"))
    write_registers(root)
    return root


def test_catalogue(spark, registers):
    infos = R.catalogue(spark, R.list_files(spark, registers))
    assert len(infos) == 19
    by_name = {i.name: i for i in infos}
    assert by_name["ruea-efp-2010-ckan.csv"].encoding == R.LATIN1
    assert by_name["ruea-efp-2012-ckan.csv"].columns[0] == "año"  # BOM removed
    assert len(R.group_by_signature(infos)) == 5  # v1, v1 latin-1 (2010), v1 reordered (2014), v2, 2023
    cat = R.catalogue_frame(spark, infos)
    assert cat.count() == 19
    hm = {(r.columna_original, r.columna_normalizada): (r.apariciones, r.archivos_distintos)
          for r in R.header_map(cat).collect()}
    assert hm[("año", "ano")] == (19, 19)
    vocab = {r.columna_normalizada: r for r in R.header_vocabulary(cat).collect()}
    assert vocab["ano"].variantes_detectadas == 1 and vocab["ano"].ejemplos_variantes == "año"


def test_silver_matches_python(spark, registers):
    silver = P.silver(spark, registers)
    got = sorted((r.id_unico, r["año"], r.contaminante_canon, r.emision_total, r.comuna) for r in silver.collect())
    exp = sorted(expected_silver(registers))
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        assert g[:3] == e[:3] and g[4] == e[4], (g, e)
        assert (g[3] is None and e[3] is None) or g[3] == pytest.approx(e[3]), (g, e)
    ids = [g[0] for g in got]
    assert len(set(ids)) == len(ids)
    assert all(i.startswith("2005") for i, y, *_ in got if 2005 <= y <= 2015)


def test_missing_era_year_fails(spark, tmp_path):
    root = str(tmp_path / "r")
    write_registers(root)
    os.remove(os.path.join(root, "ruea-efp-2007-ckan.csv"))
    with pytest.raises(FileNotFoundError):
        P.silver(spark, root)
    assert P.silver(spark, root, strict_eras=False).where(F.col("año") == 2007).count() == 0


def test_gold_and_products(spark, registers, tmp_path):
    centres = spark.createDataFrame([("Ñuñoa", "-33.45", "-70.60"), ("Maipú", "-33.51", "-70.76"),
                                     ("Santiago", "-33.44", "-70.65"), ("Tiltil", "-33.08", "-70.93")],
                                    "comuna string, latitud string, longitud string")
    polys = geo.polygons_from_rings(spark, [("Valle central", [[(-71.0, -34.0), (-70.5, -34.0), (-70.5, -33.3), (-71.0, -33.3)]]),
                                            ("Precordillera", [[(-70.5, -34.0), (-70.0, -34.0), (-70.0, -33.3), (-70.5, -33.3)]])],
                                    name="unidad")
    gold = P.run_pipeline_a(spark, registers, str(tmp_path / "out"), centres=centres, polygons=polys)
    silver = spark.read.parquet(str(tmp_path / "out" / "silver"))
    assert gold.count() == silver.count()  # no overlapping polygons, centres de-duplicated
    rows = gold.collect()
    for r in rows:
        if r.latitud not in (None, "") and r.latitud.strip().lower() not in fv.NA_WORDS:
            assert r.latitud_nueva == r.latitud
    assert any(r.unidad_paisaje == "Valle central" for r in rows)
    prods = P.products(gold, year=2023)
    annual = {(r.contaminante_canon, r["año"]): r.emision for r in prods["annual_totals"].collect()}
    exp = {}
    for _, y, c, e, _ in expected_silver(registers):
        if e is not None:
            exp[(c, y)] = exp.get((c, y), 0.0) + e
    for k, v in exp.items():
        assert annual[k] == pytest.approx(v)
    assert prods["unit_report"].count() > 0 and prods["distribution"].count() > 0
    assert prods["coverage_gaps"].where(F.col("contaminante_canon").isNull()).count() == 0
    sinks.write_per_group(prods["annual_totals"].where(F.col("contaminante_canon").isNotNull()),
                          str(tmp_path / "per_group"), "contaminante_canon")
    assert len([d for d in os.listdir(tmp_path / "per_group") if d.startswith("grupo_archivo=")]) >= 3


def test_pipeline_b(spark, registers):
    infos = R.catalogue(spark, R.list_files(spark, registers))
    efp = P.filtered_family(spark, [i for i in infos if R.layout_of(i.name) == "efp"], "Metropolitana de Santiago")
    r23 = P.filtered_family(spark, [i for i in infos if R.layout_of(i.name) == "ruea2023"], "Metropolitana de Santiago")
    table = P.by_variable(efp, r23)
    assert table.where(F.col("unidad") == "ton/año").count() == 0
    groups = {r.grupo_canonico for r in table.select("grupo_canonico").distinct().collect()}
    assert {"Sulfur dioxide (SO2)", "Benzene"} <= groups
    totals, running = P.variable_totals(table)
    assert totals.count() > 0 and running.count() == totals.count()
    ex = P.extracts(table)
    assert ex.columns[-1] == "grupo_canonico" and "cantidad_toneladas" in ex.columns and ex.count() == table.count()
    summary = {r.archivo: (r.filas_entrada, r.filas_RM) for r in P.run_summary(spark, infos, "Metropolitana de Santiago").collect()}
    assert len(summary) == 19 and all(kept <= read for read, kept in summary.values())


# --- files as they are --------------------------------------------------------------------

def _put(root, name, text, enc="utf-8"):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "wb") as f:
        f.write(text.encode(enc))


def _read_all(spark, root):
    infos = R.catalogue(spark, R.list_files(spark, root))
    return {i.name: i for i in infos}, {i.name: sorted(tuple(r)[:len(i.columns)] for r in R.read_signature(spark, [i]).collect())
                                        for i in infos if not i.error}


def test_files_as_they_are(spark, scratch):
    _put(scratch, "ascii_header.csv", "region;x\nMetro;1\nValparaíso;2\n", "latin-1")
    _put(scratch, "bom.csv", "﻿region;x\nñ;1\n")
    _put(scratch, "quotes.csv", 'region;x\n"a ""b"" c";"1;2"\n"fin\\";3\n')
    _put(scratch, "newline.csv", 'region;x\n"two\nlines";1\nb;2\n')
    _put(scratch, "long_short.csv", "region;x\na;1;2\nb\nc;3\n")
    _put(scratch, "comma.csv", 'region,x\n"a;b",1\n')
    _put(scratch, "tab.csv", "region\tx\na\t1\n")
    _put(scratch, "pipe.csv", "region|x\na|1\n")
    _put(scratch, "empty.csv", "")
    _put(scratch, "head_only.csv", "region;x\n")
    _put(scratch, "same_names.csv", "region;;region\na;b;c\n")
    infos, rows = _read_all(spark, scratch)
    assert infos["ascii_header.csv"].encoding == R.LATIN1 and infos["bom.csv"].encoding == R.UTF8
    assert infos["empty.csv"].error == "empty file" and infos["newline.csv"].multiline and not infos["quotes.csv"].multiline
    assert infos["same_names.csv"].columns == ["region", "_c1", "region2"]
    assert rows == {
        "ascii_header.csv": [("Metro", "1"), ("Valparaíso", "2")], "bom.csv": [("ñ", "1")],
        "quotes.csv": [('a "b" c', "1;2"), ("fin\\", "3")], "newline.csv": [("b", "2"), ("two\nlines", "1")],
        "long_short.csv": [("b", None), ("c", "3")], "comma.csv": [("a;b", "1")], "tab.csv": [("a", "1")], "pipe.csv": [("a", "1")],
        "head_only.csv": [], "same_names.csv": [("a", "b", "c")]}


def _by_multiline(spark, path, sep=";"):
    """The rows that Spark's own reader gives without splits."""
    return sorted(map(tuple, spark.read.option("header", True).option("sep", sep).option("escape", '"').option("multiLine", True).csv(path).collect()), key=str)


@pytest.mark.parametrize("split", ["7", "40", "333", "128m"])
def test_quoted_line_breaks_at_any_split(spark, scratch, split):
    rng = random.Random(int(split.rstrip("m")))
    cell = lambda: rng.choice(["x", "", "ñandú", "12,5", '"a;b"', '"two\nlines"', '"q""uote"', '"\n\n"', '""', '"a\r\nb"', '"""\n"""', '"' + "long\n" * rng.randint(1, 30) + '"'])
    for f in range(3):
        body = "".join(f"{i};{cell()};{cell()}\n" for i in range(120 if split != "7" else 30))
        _put(scratch, f"f{f}.csv", f"n;first;second\n{body}{'last;no;newline' if f == 1 else ''}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        infos = R.catalogue(spark, R.list_files(spark, scratch))
        assert all(i.multiline for i in infos) and len(R.group_by_signature(infos)) == 1
        read = R.read_signature(spark, infos)
        order = {name: [r["n"] for r in ids.sequence_in_file_cols(read, "_file_path", "_file_block").where(F.col("_file_name") == name).orderBy("seq").collect()] for name in ("f0.csv", "f1.csv")}
        got = {i.name: sorted((tuple(r)[:3] for r in read.where(F.col("_file_name") == i.name).collect()), key=str) for i in infos}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i.name: _by_multiline(spark, i.path) for i in infos}
    n = 120 if split != "7" else 30
    assert order["f0.csv"] == [str(i) for i in range(n)] and order["f1.csv"] == [str(i) for i in range(n)] + ["last"]


def test_files_are_written_by_as_many_tasks_as_the_table_is_read_in(spark, scratch, monkeypatch):
    texts = ["", None, "plain", 'two\nlines; "quoted"', "é\r\nñ"]
    docs = spark.createDataFrame([(i if i % 9 else None, "es", texts[i % 5]) for i in range(300)], "doc_id long, lang string, text string")
    docs.repartition(12).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(i, f"{i % 3}-X") for i in range(300)], "o_orderkey long, o_orderpriority string").repartition(12).write.parquet(f"{scratch}/orders.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        for query, table in ((FQ.quoted_files, "documents"), (FQ.file_order_ids, "orders")):
            monkeypatch.setattr(FQ, "shared_dir", lambda _, t=table: f"{scratch}/written_{t}")
            splits = spark.read.parquet(f"{scratch}/{table}.parquet").rdd.getNumPartitions()
            rows = query(spark, scratch).collect()
            written = [f for f in os.listdir(f"{scratch}/written_{table}") if f.endswith(".csv")]
            assert splits >= 12 and len(written) >= 10
            if table == "documents":
                assert sorted(map(tuple, rows), key=str) == sorted(((d, g, t or None) for d, g, t in docs.collect()), key=str)
            else:
                assert sorted((r["o_orderkey"], r["seq"]) for r in rows) == [(i, i + 1) for i in range(300)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_header_with_line_break_and_unclosed_quote(spark, scratch):
    _put(scratch, "head.csv", '"re\ngion";x\r\n"a\r\nb";1\r\nc;2\r\n')
    _put(scratch, "open.csv", 'region;x\na;1\nb;"never\nclosed;3\n')
    infos, rows = _read_all(spark, scratch)
    assert infos["head.csv"].columns == ["re\ngion", "x"] and infos["head.csv"].multiline
    assert rows["head.csv"] == [("a\r\nb", "1"), ("c", "2")]
    assert len(rows["open.csv"]) == 2 and rows["open.csv"][0] == ("a", "1")


def test_each_line_is_decoded_by_itself(spark, scratch):
    with open(os.path.join(scratch, "mixed.csv"), "wb") as f:
        f.write("region;x\nValparaíso;ñ\n".encode() + "Valparaíso;2\n".encode("latin-1") + "plain;é\n".encode())
    for quoted in (True, False):
        info, = R.catalogue(spark, R.list_files(spark, scratch), quoted=quoted)
        assert info.encoding == (R.LATIN1 if quoted else R.UTF8)
        assert sorted(tuple(r)[:2] for r in R.read_signature(spark, [info]).collect()) == [("Valparaíso", "2"), ("Valparaíso", "ñ"), ("plain", "é")]
    _put(scratch, "breaks.csv", 'region;x\n"Ñuñoa\nsur";1\n')
    with open(os.path.join(scratch, "breaks.csv"), "ab") as f:
        f.write('"Ñuble\nnorte";2\n'.encode("latin-1"))
    _, rows = _read_all(spark, scratch)
    assert rows["breaks.csv"] == [("Ñuble\nnorte", "2"), ("Ñuñoa\nsur", "1")]


def test_tables_in_several_files(spark, scratch):
    _put(scratch, "a.csv", 'codigo,descripcion\n1,"uno\nlargo"\n2,\n')
    _put(scratch, "b.csv", "codigo,descripcion\n3,tres\n")
    assert sorted(map(tuple, R.read_table(spark, scratch).collect())) == [("1", "uno\nlargo"), ("2", None), ("3", "tres")]
    codes = R.read_activity_codes(spark, scratch)
    assert codes.columns == ["codigo", "descripcion", "_pos"] and [r["codigo"] for r in codes.orderBy("_pos").collect()] == ["1", "2", "3"]
    with pytest.raises(ValueError, match="not read"):
        R.read_table(spark, tempfile.mkdtemp(dir=scratch))


def _register(region="region", rut="rut", year="2019", n=1):
    return f"{region};año;{rut};contaminantes;cantidad_toneladas\n" + f"Región Metropolitana;{year};1-9;CO;1,5\n" * n


def test_decisions_per_table_and_unread_files(spark, scratch):
    _put(scratch, "ruea-efp-2019-ckan.csv", _register())
    _put(scratch, "ruea-efp-2020-ckan.csv", _register("nombre_region", "rut_razon_social"))
    _put(scratch, "ruea-efp-2021-a.csv", _register(n=2))
    _put(scratch, "ruea-efp-2021-b.csv", _register(n=3))
    _put(scratch, "ruea-efp-2022-ckan.csv", "")
    with pytest.raises(ValueError, match="not read"):
        P.silver(spark, scratch)
    got = P.silver(spark, scratch, allow_unread=True).collect()
    assert sorted((r["año"], r.rut) for r in got) == [(2019, "1-9"), (2020, "1-9"), (2021, "1-9"), (2021, "1-9"), (2021, "1-9")]
    infos = R.catalogue(spark, R.list_files(spark, scratch))
    assert {tuple(r) for r in P.file_report(spark, infos).collect()} == {
        ("ruea-efp-2019-ckan.csv", "ok", None), ("ruea-efp-2020-ckan.csv", "ok", None), ("ruea-efp-2021-b.csv", "ok", None),
        ("ruea-efp-2021-a.csv", "no_leido", "replaced by ruea-efp-2021-b.csv"), ("ruea-efp-2022-ckan.csv", "no_leido", "empty file")}


def test_years_in_cells_do_not_lose_rows(spark, scratch):
    for year, cell in ((2010, "2005.0"), (2019, ""), (2021, "2023"), (2022, "abc")):
        _put(scratch, f"ruea-efp-{year}-ckan.csv", _register(year=cell))
    infos = R.catalogue(spark, R.list_files(spark, scratch))
    efp = P.filtered_family(spark, infos, "Metropolitana de Santiago")
    assert efp.count() == P.by_variable(efp, None).count() == 4


def test_run_summary_counts_long_rows_and_unreadable_files(spark, scratch):
    _put(scratch, "ruea-efp-2019-ckan.csv", _register() + "x;y;z;CO;1;too;long\nOther;2019;1;CO;2\n")
    _put(scratch, "ruea-efp-2020-ckan.csv", "")
    infos = R.catalogue(spark, R.list_files(spark, scratch))
    got = {r.archivo: (r.filas_entrada, r.filas_largas, r.filas_RM, r.estado) for r in P.run_summary(spark, infos, "Metropolitana de Santiago").collect()}
    assert got == {"ruea-efp-2019-ckan.csv": (3, 1, 1, "ok"), "ruea-efp-2020-ckan.csv": (0, 0, 0, "empty file")}


def test_years_after_the_eras_must_follow(spark):
    with pytest.raises(FileNotFoundError):
        P.check_eras({2019, 2021})
    P.check_eras({2019, 2020, 2021})


def test_links_in_page_order_with_any_quotes(spark):
    html = """<a href='one.csv'>1</a><A class=x HREF="/two.CSV">2</a><a href=three.xls>3</a><a data-href="no.csv" href="four.xlsx">4</a><a href="no.html">n</a>"""
    from airledger.sources.links import discover_links
    pages = spark.createDataFrame([(1, "https://h.example/x/y", html)], "page_id long, url string, html string")
    got = sorted((r.pos, r.enlace) for r in discover_links(pages).collect())
    assert got == [(0, "one.csv"), (1, "https://h.example/two.CSV"), (2, "three.xls"), (3, "four.xlsx")]


def test_products_come_in_order(spark):
    rows = [("B", 2001, 1.0), ("A", 2002, 2.0), ("A", 2000, 3.0), ("B", 2000, 5.0)]
    gold = spark.createDataFrame([(*r, "c", "m") for r in rows], "contaminante_canon string, `año` int, emision_total double, comuna string, actividad_macro string")
    made = P.products(gold, year=2000)
    for name in ("annual_totals", "running_totals"):
        got = [(r.contaminante_canon, r["año"]) for r in made[name].collect()]
        assert got == sorted(got)


def test_stage_files_and_replacement(spark, scratch):
    df = spark.range(1000).selectExpr("id", "cast(2000 + id % 2 as int) as y")
    assert sinks.write_stage(df, scratch + "/s", ["y"]) == 1000
    assert sinks.write_stage(df.where("y = 2001"), scratch + "/s", ["y"]) == 500
    back = spark.read.parquet(scratch + "/s")
    assert back.count() == 1000 and len(back.inputFiles()) <= 16


def test_sums_do_not_depend_on_partitions(spark):
    """Doubles of very unlike size, dealt out in many ways, give the same totals to the last digit."""
    rows = [("PM10" if i % 3 else "NOx", "a" if i % 2 else "b", "ENERGY" if i % 5 else "TRANSPORT", 2020 + i % 4, 0.1 * i * 10 ** (i % 9 - 4)) for i in range(3000)]
    df = spark.createDataFrame(rows, "contaminante_canon string, comuna string, actividad_macro string, `año` int, emision_total double")
    seen = set()
    for n in (1, 3, 7):
        made = P.products(df.repartition(n), year=2021)
        seen.add(tuple(str(sorted(map(tuple, made[k].collect()))) for k in ("annual_totals", "running_totals", "municipality_totals", "macro_share", "trend", "change_points", "change_by_sector")))
    assert len(seen) == 1
