import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators import normalize as N


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def one(df, **where):
    found = [r for r in df.collect() if all(r[k] == v for k, v in where.items())]
    assert len(found) == 1
    return found[0]


def test_cases(spark):
    fields = "dataset citation_en citation_fr name_en name_fr url_en url_fr document_date_en document_date_fr".split()
    raw = rows(spark, [(1, "scc ", "2020 SCC 1", None, "None", "Nom", " ", None, "2020-01-01", ""), (2, "XX-FCA", "None", "", None, None, "http://x", None, None, None), (3, None, None, None, None, None, None, None, None, None), (4, "ZZZ", "c d", None, None, None, None, None, None, None)], "pos long, " + ", ".join(f"{f} string" for f in fields))
    got = {r.pos: r for r in N.normalize_cases(raw).collect()}
    assert (got[1].source_url, got[1].title, got[1].jurisdiction_code, got[1].metadata["court_name"]) == ("a2aj://case/2020_SCC_1", "Nom", "ca", "Supreme Court of Canada")
    assert (got[2].source_url, got[2].title, got[2].jurisdiction_code) == ("http://x", "", "ca") and got[3].source_url == "" and got[4].title == "c d"
    assert {r.dataset: r.jurisdiction_code for r in N.map_courts(rows(spark, [("NBCA",), ("x BCSC",), ("onca",), ("ZZZ",), (None,)], "dataset string")).collect()} == {"NBCA": "nb", "x BCSC": "bc", "onca": "on", "ZZZ": "ca", None: "ca"}


def test_decisions(spark):
    raw = rows(spark, [(1, "/nsc/nssc/en/item/522810/index.do", " A v B ", "2024 NSSC 100", "on 2024-12-31."), (2, "/nsc/x.do", "t", "c", "d"), (3, "/en/item/7/index.do", "", "oddity", "Spring")], "pos long, href string, title string, citation string, date_text string")
    got = {r.pos: r for r in N.normalize_decisions(raw, "https://d.ca/nsc", "nsc", "nsca").collect()}
    assert set(got) == {1, 3}
    assert (got[1].source_url, got[1].title, got[1].jurisdiction_code, got[1].metadata["court_name"], got[1].metadata["date"]) == ("https://d.ca/nsc/nssc/en/item/522810/index.do", "A v B", "ns", "Nova Scotia Supreme Court", "2024-12-31")
    assert (got[3].title, got[3].metadata["court"], got[3].metadata["sub_court"], got[3].metadata["date"]) == ("oddity", "", "nsca", "Spring")
    counts = rows(spark, [("387&nbsp;result(s)",), ("1,204 results",), ("none",)], "h string").select(N.result_count(F.col("h")).alias("n")).collect()
    assert [r.n for r in counts] == [387, 1204, None]


@pytest.mark.parametrize("chapter,kind", [("2011, c.101", "statute"), ("84-295", "regulation"), ("A-5.11", "statute"), ("Rule-57", "regulation"), ("odd", "statute")])
def test_chapter_class(spark, chapter, kind):
    assert rows(spark, [(chapter,)], "c string").select(N.chapter_class(F.col("c")).alias("k")).first().k == kind


def test_new_brunswick(spark):
    raw = rows(spark, [
        ("statutes", 0, "Chapter", "Title", "h"), ("statutes", 1, "A-5.11", "Agricultural Development Act", "https://laws.gnb.ca/en/document/cs/A-5.11"), ("statutes", 2, "84-295", "General", "https://laws.gnb.ca/x"),
        ("statutes", 3, "2011, c.101", "Other Act", "https://laws.gnb.ca/en/document/cs/2011, c.101?x=1"), ("statutes", 4, "90-1", "Fees", None), ("regs", 1, "84-295", "General", "https://laws.gnb.ca/x"), ("regs", 2, "99-9", "forms", "https://laws.gnb.ca/y"),
    ], "list string, pos long, chapter string, title string, href string")
    got = {r.citation: r for r in N.normalize_new_brunswick(raw).collect()}
    assert set(got) == {"A-5.11", "84-295", "2011, c.101", "99-9"}
    assert got["84-295"].title == "General — Agricultural Development Act (NB Reg. 84-295)" and got["84-295"].metadata["parent_act"] == "Agricultural Development Act"
    assert got["2011, c.101"].source_url == "https://laws.gnb.ca/en/document/cs/2011%2C%20c.101?x=1" and got["84-295"].source_url == "https://laws.gnb.ca/en/document/cr/84-295"
    assert got["99-9"].title == "forms (NB Reg. 99-9)"


def test_saskatchewan(spark):
    raw = rows(spark, [(1, "11", "Accounting Profession Act, SS 1986, c A-3.1", "", False), (2, "12", "Accessible Saskatchewan Regulations, SR 108/2023", None, True), (3, "13", "X", "A-3.1", False), (4, None, "Y", "", False), (5, "15", "Z, RRS c A-1 Reg 3", "", True), (6, "16", "W", "", True)], "pos long, product_id string, name string, custom_id string, regulation boolean")
    got = {r.pos: (r.citation, r.title) for r in N.normalize_saskatchewan(raw).collect()}
    assert got == {1: ("SS 1986, c A-3.1", "Accounting Profession Act"), 2: ("SR 108/2023", "Accessible Saskatchewan Regulations"), 3: ("RSS c A-3.1", "X"), 5: ("RRS c A-1 Reg 3", "Z"), 6: ("", "W")}
    formats = rows(spark, [([("PRINT", "PDF", 1), ("DIGITAL", "Word", 2), ("DIGITAL", "Adobe pdf", 3), ("DIGITAL", "PDF", 4)],), ([],)], "f array<struct<productFormatMediumType:string,productFormatType:string,productFormatId:int>>")
    assert [r.i for r in formats.select(N.pdf_format(F.col("f")).alias("i")).collect()] == [3, None]


def test_pei(spark):
    raw = rows(spark, [(1, "/legislation/A-01-Acadian%20Purchase%20Trust%20Act.pdf", "Acadian Act", None), (2, "/legislation/a-04-1-adoption_act.pdf", "Adoption Act (Repealed)", ""), (3, "/l/A%2608-01-Crop.pdf", "Crop Regulations", "x tw-ml-8"), (4, "/l/A%2608-01-Crop.pdf", "again", None), (5, "/l/q.htm", "no pdf", None)], "pos long, href string, title string, indent_class string")
    got = {r.pos: r for r in N.normalize_pei(raw).collect()}
    assert set(got) == {1, 2, 3}
    assert [got[i].citation for i in (1, 2, 3)] == ["RSPEI A-01", "RSPEI a-04-1", "PE Reg A&08-01"]
    assert (got[2].is_active, got[2].metadata["status"], got[3].metadata["parent_act"], got[3].document_type) == (False, "repealed", "Adoption Act (Repealed)", "regulation") and "status" not in got[1].metadata


def test_yukon_and_nunavut_and_nwt(spark):
    raw = rows(spark, [(1, "https://y/PRINCIPAL/2018/2018-0009/2018-0009_2.pdf", "LANDS ACT (LOI SUR LES TERRES) Open PDF"), (2, "https://y/SUBORDINATE/2019/2019-12/2019-13_2.pdf", "O'BRIEN RULES"), (3, "https://y/PRINCIPAL/2018/2018-0009/2018-0009_2.pdf", "again")], "pos long, href string, title string")
    got = {r.pos: r for r in N.normalize_yukon(raw).collect()}
    assert (got[1].citation, got[1].title, got[1].metadata["title_fr"]) == ("SY 2018, c.0009", "Lands Act", "LOI SUR LES TERRES") and (got[2].citation, got[2].title) == ("", "O'Brien Rules") and 3 not in got
    nu = rows(spark, [(1, "/en/consolidated-law/a", "Consolidation of Fisheries Order, R-1", "F"), (2, "/en/consolidated-law/b", "Fisheries Act, S.N.W.T. 1994,c.26, Official Consolidation of", "F"), (3, "/fr/consolidated-law/b", "Loi", "F"), (4, "/en/consolidated-law/d", "Rules of Practice Act, Order", "R")], "pos long, href string, title string, letter string")
    got = {r.pos: r for r in N.normalize_nunavut(nu).collect()}
    assert (got[1].title, got[1].document_type) == ("Fisheries Order, R-1", "regulation") and (got[2].citation, got[2].title) == ("S.N.W.T. 1994,c.26", "Fisheries Act, S.N.W.T. 1994,c.26") and 3 not in got and got[4].document_type == "legislation"
    nt = rows(spark, [(1, "/legislation/lands/lands.a.pdf", "Lands Act"), (2, "/legislation/lands/lands.r1.pdf", "Lands"), (3, "/legislation/x/y.pdf", "Court Rules")], "pos long, href string, title string")
    got = {r.pos: r for r in N.normalize_nwt(nt).collect()}
    assert [got[i].document_type for i in (1, 2, 3)] == ["legislation", "regulation", "regulation"] and got[1].citation == "RSNWT — Lands Act" and got[1].metadata["slug"] == "lands"
    folders = rows(spark, [(1, "#gn-filebrowse-0:/a/access/", "Access", "Justice"), (2, "#gn-filebrowse-0:/a/access/", "Again", ""), (3, "#gn-filebrowse-0:/a/", "A", "")], "pos long, href string, title string, department string")
    assert [(r.metadata["slug"], r.citation) for r in N.normalize_nwt_folders(folders).collect()] == [("access", "RSNWT Access")]


def test_quebec(spark):
    raw = rows(spark, [(1, "/fr/document/lc/A-2.001", "Act one", "clickable", "in force"), (2, "/fr/document/lc/B-1?x=1", "Act two", "clickable", "Abrogé et remplacé"), (3, "/fr/document/rc/A-2.1,%20r.%201", "Reg", "nestedRow", ""), (4, "/fr/document/lc/A-2.001", "again", "", "")], "pos long, href string, title string, row_class string, row_text string")
    got = {r.pos: r for r in N.normalize_quebec(raw, False).collect()}
    assert set(got) == {1, 2} and got[1].source_url.endswith("A-2.001?langCont=en") and got[2].source_url.endswith("?x=1&langCont=en")
    assert (got[1].citation, got[2].is_active, got[2].metadata["status"]) == ("CQLR c A-2.001", False, "replaced")
    assert {r.pos: r.citation for r in N.normalize_quebec(raw, True).collect()}[3] == "CQLR A-2.1, r. 1"


def test_other_provinces(spark):
    ns = rows(spark, [(1, "https://n/legc/statutes HTML/a.htm", "HTML", "* Acts  Act HTML PDF"), (2, "https://n/statutes/b.pdf.htm", "x", "abc")], "pos long, href string, title string, li_text string")
    r = one(N.normalize_nova_scotia(ns, False))
    assert (r.source_url, r.title, r.citation) == ("https://n/legc/statutes%20HTML/a.htm", "Acts Act", "RSNS a")
    regs = rows(spark, [(1, "https://n/just/regulations/regs/x.htm", "Reg X", ""), (2, "https://n/just/regulations/INDEX.htm", "Index", ""), (3, "https://n/just/regulations/regs/x.htm", "again", ""), (4, "https://other/x.htm", "Out", ""), (5, "https://n/just/regulations/rxaa-l.htm", "nav", "")], "pos long, href string, title string, li_text string")
    assert [(r.pos, r.citation) for r in N.normalize_nova_scotia(regs, True).collect()] == [(1, "NS Reg x")]
    mb = rows(spark, [(1, "C.C.S.M.", "Title", "h"), (2, "A1.5", "Act", "/a.php"), (3, "B", "Info", "/b_info.php"), (4, "", "Reg", "/current/171-2015.php")], "pos long, chapter string, title string, href string")
    assert [(r.pos, r.citation) for r in N.normalize_manitoba(mb, False).collect()] == [(2, "CCSM c A1.5")]
    assert [(r.pos, r.citation) for r in N.normalize_manitoba(mb, True).collect()] == [(4, "Man Reg 171-2015")]
    nl = rows(spark, [(1, "https://x/statutes/a01-01.htm", "LAND'S ACT"), (2, "statutes/b.htm", "No slash"), (3, "https://x/statutes/c.htm", "ab")], "pos long, href string, title string")
    assert [(r.title, r.citation) for r in N.normalize_newfoundland(nl, False).collect()] == [("Land'S Act", "SNL A01-01")]
    on = rows(spark, [(1, "statute/90a02", "A", None, None), (2, "statute/90a02", "B", None, None), (3, "", "C", None, None)], "pos long, alias string, title string, state string, date_from string")
    assert [(r.source_url, r.citation) for r in N.normalize_ontario(on, "statute").collect()] == [("https://www.ontario.ca/laws/statute/90a02", "90A02")]
    ab = rows(spark, [(1, "2021_265", "Reg", "", None), (2, "a1p4", None, "978", "d"), (3, "", "x", "", "")], "pos long, name string, title string, isbn string, date_modified string")
    got = {r.pos: r for r in N.normalize_alberta(ab).collect()}
    assert set(got) == {1, 2} and got[1].document_type == "regulation" and got[1].citation == "2021_265" and (got[2].citation, got[2].title, got[2].source_url) == ("A1P4", "a1p4", "https://kings-printer.alberta.ca/570.cfm?frm_isbn=978&search_by=link")
    fed = rows(spark, [(1, "eng/Regulations/SOR-1.xml", None), (2, "eng/acts/A-1.xml", "Act A")], "pos long, path string, title string")
    got = {r.pos: r for r in N.normalize_federal(fed).collect()}
    assert (got[1].document_type, got[1].title, got[2].source_url) == ("regulation", "SOR-1", "https://laws-lois.justice.gc.ca/eng/acts/A-1/")


def test_bc(spark):
    raw = rows(spark, [(1, "96001", "Family Law Act", "l", "--A"), (2, "2", "Act Regulation", "l", "--A"), (3, "", "x", "l", "--A")], "pos long, doc_id string, title string, letter_dir_id string, letter_group string")
    assert {r.citation: r.document_type for r in N.normalize_bc(raw).collect()} == {"96001": "legislation", "2": "regulation"}
    dirs = rows(spark, [("a",), ("b",), ("c",), ("d",)], "dir_id string")
    entries = rows(spark, [("a", "document", "a_02", "x", 2), ("a", "document", "a_01", "x", 1), ("b", "dir", "b1", "Act", 1), ("b1", "document", "b_1", "", 1), ("b1", "document", "b_multi", "", 2), ("c", "dir", "c1", "Act", 1), ("c1", "document", "c_9", "", 3)], "parent_id string, tag string, id string, title string, pos long")
    assert {r.dir_id: r.document_id for r in N.resolve_bc_documents(dirs, entries).collect()} == {"a": "a_01", "b": "b_multi", "c": "c_9", "d": "d_01"}


def test_statute_lists(spark):
    raw = rows(spark, [(1, "T", "C", "/ab/laws/x", ""), (2, None, None, "http://y", "REPEALED 2001"), (3, "Z", "", "", None)], "pos long, title string, citation string, path string, status string")
    got = {r.pos: (r.source_url, r.is_active) for r in N.normalize_statutes_json(raw).collect()}
    assert got == {1: ("https://www.canlii.org/ab/laws/x", True), 2: ("http://y", False), 3: ("", True)}
    html = rows(spark, [(1, '<tr><td> RSA 2000 </td><td><a href="/info/x">no</a> <a href="/ab/laws/stat/x">An <b>Act</b></a> <span>[Repealed]</span></td></tr>'), (2, "<tr><td>x</td></tr>"), (3, '<tr><td>x</td><td><a href="/en/help">Help</a></td></tr>')], "pos long, html string")
    r = one(N.normalize_statute_rows(html))
    assert (r.source_url, r.title, r.citation, r.is_active) == ("https://www.canlii.org/ab/laws/stat/x", "An Act", "RSA 2000", False)
    urls = rows(spark, [("https://c/ab/laws/stat/rsa-2000-c-a-1/latest/",), ("https://c/x",)], "u string")
    assert [r.c for r in urls.select(N.citation_from_url(F.col("u")).alias("c")).collect()] == ["RSA 2000, c A 1", ""]
    page = rows(spark, [("ab", 1, "h2", "Législation (3)", None), ("ab", 2, "a", "Statutes", "/en/ab/laws/stat/"), ("ab", 3, "h2", "News", None), ("ab", 4, "a", "Deep", "/ab/laws/stat/x/y/z"), ("ab", 5, "a", "Courts", "/ab/abca/"), ("ab", 6, "a", "Out", "http://x/ab/"), ("ab", 7, "a", "Other", "/bc/x")], "list string, pos long, tag string, text string, href string")
    got = [(r.pos, r.url, r.category, r.kind) for r in N.classify_databases(page, "ab").orderBy("pos").collect()]
    assert got == [(2, "https://www.canlii.org/ab/laws/stat", "Legislation", "statutes"), (5, "https://www.canlii.org/ab/abca", "Legislation", "decisions")]


def test_text_functions(spark):
    urls = ["https://h.ca/a b,c?q=a b#f", "https://h.ca/a%20b", "https://h.ca/a+b/%zz x", "/p/é(1)~*.htm", "https://h.ca"]
    df = rows(spark, [(u,) for u in urls], "u string").select("u", X.normalize_url(F.col("u")).alias("once"))
    got = {r.u: (r.once, r.twice) for r in df.withColumn("twice", X.normalize_url(F.col("once"))).collect()}
    assert got[urls[0]][0] == "https://h.ca/a%20b%2Cc?q=a b#f" and got[urls[1]][0] == urls[1] and got[urls[3]][0] == "/p/%C3%A9(1)~*.htm" and got[urls[4]][0] == urls[4]
    assert all(a == b for u, (a, b) in got.items() if "%zz" not in u)
    r = rows(spark, [("  x \n y ", "O'NEIL-SMITH 2ND", "a\n\n  b \n")], "a string, b string, c string").select(X.squeeze(F.col("a")).alias("a"), X.fix_caps(F.col("b")).alias("b"), X.clean_lines(F.col("c")).alias("c")).first()
    assert (r.a, r.b, r.c) == ("x y", "O'Neil-Smith 2Nd", "a\nb")
