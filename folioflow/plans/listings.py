"""Registered queries of source rules, readers, the snapshot store and streaming. Raw tables in each source's layout are
derived from the given ones, written to the shared folder where a reader takes files, and compared with SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators import extract, incremental, joins, normalize, quality, repair, runs, search, upsert
from folioflow.plans.model import Model, as_of, wall
from folioflow.plans.queries import DAY, ORACLE, QUERIES, T, query
from folioflow.schemas import DOCUMENTS, conform
from folioflow.session import scratch_folder
from folioflow.sources import profiles, readers, store
from folioflow.streaming import ingest

__all__ = ["ORACLE", "QUERIES"]


def n() -> Column:
    return F.col("doc_id")


def txt(*parts) -> Column:
    """Parts as one text; numbers and columns are cast."""
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def listed(df: DataFrame, *metadata: str) -> DataFrame:
    return df.select("source_url", "title", "citation", "document_type", "is_active", *[F.col("metadata")[k].alias(k) for k in metadata])


def raw(m: Model, **columns) -> DataFrame:
    """One raw row a document, in order of doc_id."""
    return m.corpus.select(n().alias("pos"), *[(c if isinstance(c, Column) else F.lit(c)).alias(name) for name, c in columns.items()])


# --- source rules

_L = "source_url, title, citation, document_type, is_active"


@query("SELECT doc_id AS pos, CASE doc_id % 3 WHEN 0 THEN 'ca' WHEN 1 THEN 'bc' ELSE 'on' END AS jurisdiction_code FROM docs")
def map_courts(m: Model) -> DataFrame:
    name = F.when(n() % 3 == 0, "no such court").when(n() % 3 == 1, "xx bcsc yy").otherwise("onca")
    return normalize.map_courts(raw(m, dataset=name)).select("pos", "jurisdiction_code")


@query("SELECT CASE doc_id % 3 WHEN 0 THEN 'ca' WHEN 1 THEN 'bc' ELSE 'on' END AS jurisdiction, count(*) AS documents FROM docs GROUP BY jurisdiction")
def court_dimension(m: Model) -> DataFrame:
    key = F.when(n() % 3 == 0, "SCC").when(n() % 3 == 1, "BCCA").otherwise("ONCA")
    return raw(m, court_key=key).join(F.broadcast(normalize.courts(m.spark)), "court_key").groupBy("jurisdiction").agg(F.count(F.lit(1)).alias("documents"))


@query("""SELECT 'https://b/' || c.sub || '/en/item/' || n || '/index.do' AS source_url, CASE WHEN n % 3 <> 0 THEN 'Case ' || n ELSE cite END AS title, cite AS citation, 'ns' AS jurisdiction_code, '2024-01-02' AS date, n::VARCHAR AS item_id
  FROM (SELECT doc_id AS n, CASE WHEN doc_id % 2 = 1 THEN 'nsca' ELSE 'nssc' END AS sub, CASE WHEN doc_id % 2 = 1 THEN '2024 NSCA ' || doc_id ELSE '' END AS cite FROM docs) c WHERE n % 5 <> 0""")
def normalize_decisions(m: Model) -> DataFrame:
    href = F.when(n() % 5 == 0, "/nowhere").otherwise(txt("/dec/", F.when(n() % 2 == 1, "nsca").otherwise("nssc"), "/en/item/", n(), "/index.do"))
    rows = raw(m, href=href, title=F.when(n() % 3 != 0, txt("Case ", n())), citation=F.when(n() % 2 == 1, txt("2024 NSCA ", n())), date_text="On 2024-01-02 heard")
    out = normalize.normalize_decisions(rows, "https://b", "dec", "nsc")
    return out.select("source_url", "title", "citation", "jurisdiction_code", F.col("metadata")["date"].alias("date"), F.col("metadata")["item_id"].alias("item_id"))


@query(f"""SELECT {_L} FROM (SELECT 'https://laws-lois.justice.gc.ca/' || p || '/' AS source_url, CASE WHEN doc_id % 4 < 2 THEN 'Act ' || doc_id ELSE split_part(p, '/', 3) END AS title, split_part(p, '/', 3) AS citation,
  CASE WHEN doc_id % 2 = 0 THEN 'regulation' ELSE 'legislation' END AS document_type, true AS is_active FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'eng/regulations/SOR-' ELSE 'eng/acts/A-' END || doc_id AS p FROM docs))""")
def normalize_federal(m: Model) -> DataFrame:
    path = txt(F.when(n() % 2 == 0, "eng/regulations/SOR-").otherwise("eng/acts/A-"), n(), ".xml")
    return listed(normalize.normalize_federal(raw(m, path=path, title=F.when(n() % 4 < 2, txt("Act ", n())).otherwise(""))))


@query(f"""SELECT {_L} FROM (SELECT 'https://www.bclaws.gov.bc.ca/civix/document/id/complete/statreg/d' || doc_id AS source_url, CASE doc_id % 3 WHEN 0 THEN 'Land Act ' WHEN 1 THEN 'Land Act Regulation ' ELSE 'Order ' END || doc_id AS title, 'd' || doc_id AS citation,
  CASE WHEN doc_id % 3 = 0 THEN 'legislation' ELSE 'regulation' END AS document_type, true AS is_active FROM docs WHERE doc_id % 7 <> 0)""")
def normalize_bc(m: Model) -> DataFrame:
    title = txt(F.when(n() % 3 == 0, "Land Act ").when(n() % 3 == 1, "Land Act Regulation ").otherwise("Order "), n())
    return listed(normalize.normalize_bc(raw(m, doc_id=F.when(n() % 7 == 0, "").otherwise(txt("d", n())), title=title, letter_dir_id="l", letter_group="A")))


@query("SELECT 'dir' || doc_id AS dir_id, CASE doc_id % 3 WHEN 0 THEN 'first' || doc_id WHEN 1 THEN 'y' || doc_id || '_multi' ELSE 'dir' || doc_id || '_01' END AS document_id FROM docs")
def resolve_bc_documents(m: Model) -> DataFrame:
    def entry(kind: int, pos: int, parent: str, tag: str, name: Column, title: str) -> DataFrame:
        return m.corpus.filter(n() % 3 == kind).select(txt(parent, n()).alias("parent_id"), F.lit(tag).alias("tag"), name.alias("id"), F.lit(title).alias("title"), F.lit(pos).alias("pos"))

    parts = [entry(0, 1, "dir", "document", txt("doc", n()), "x"), entry(0, 0, "dir", "document", txt("first", n()), "x"), entry(1, 2, "dir", "dir", txt("act", n()), "Act")]
    parts += [entry(1, 1, "act", "document", txt("x", n()), "x"), entry(1, 2, "act", "document", txt("y", n(), "_multi"), "x")]
    entries = parts[0]
    for p in parts[1:]:
        entries = entries.unionByName(p)
    return normalize.resolve_bc_documents(m.corpus.select(txt("dir", n()).alias("dir_id")), entries)


@query(f"SELECT {_L} FROM (SELECT 'https://n/legc/statutes/a' || doc_id || '.htm' AS source_url, 'Act ' || doc_id AS title, 'RSNS a' || doc_id AS citation, 'legislation' AS document_type, true AS is_active FROM docs WHERE doc_id % 4 <> 0)")
def normalize_nova_scotia(m: Model) -> DataFrame:
    rows = raw(m, href=txt("https://n/legc/statutes/a", n(), F.when(n() % 4 == 0, ".pdf").otherwise(".htm")), title=txt("Act ", n()), li_text=F.when(n() % 2 == 1, txt("* Act ", n(), " HTML")))
    return listed(normalize.normalize_nova_scotia(rows, False))


@query("SELECT 'https://n/just/regulations/regs/r' || k || '.htm' AS source_url, 'Reg ' || min(doc_id) AS title, 'NS Reg r' || k AS citation, 'regulation' AS document_type, true AS is_active FROM (SELECT doc_id, doc_id // 2 AS k FROM docs WHERE doc_id % 10 <> 0) GROUP BY k")
def normalize_nova_scotia_regulations(m: Model) -> DataFrame:
    href = F.when(n() % 10 == 0, txt("https://n/just/regulations/rxaa-", n(), ".htm")).otherwise(txt("https://n/just/regulations/regs/r", F.floor(n() / 2), ".htm"))
    return listed(normalize.normalize_nova_scotia(raw(m, href=href, title=txt(" Reg ", n()), li_text=None), True))


@query(f"""SELECT {_L} FROM (SELECT 'https://m/a' || doc_id || '.php' AS source_url, 'Act ' || doc_id AS title, 'CCSM c A' || doc_id AS citation, 'legislation' AS document_type, true AS is_active FROM docs WHERE doc_id % 6 <> 0 AND doc_id % 5 <> 0
  UNION ALL SELECT 'https://m/current/' || doc_id || '.php', 'Act ' || doc_id, 'Man Reg ' || doc_id, 'regulation', true FROM docs)""")
def normalize_manitoba(m: Model) -> DataFrame:
    acts = raw(m, chapter=F.when(n() % 6 == 0, "Chapter").otherwise(txt("A", n())), title=txt("Act ", n()), href=txt("https://m/a", n(), F.when(n() % 5 == 0, "_info.php").otherwise(".php")))
    regs = raw(m, chapter="", title=txt("Act ", n()), href=txt("https://m/current/", n(), ".php"))
    return listed(normalize.normalize_manitoba(acts, False)).unionByName(listed(normalize.normalize_manitoba(regs, True)))


@query("""SELECT 'https://x/regulations/nr' || doc_id || '.htm' AS source_url, CASE doc_id % 3 WHEN 0 THEN 'Labour Standards Act' WHEN 1 THEN 'Labour STANDARDS Act' ELSE 'Act ' || doc_id END AS title, 'NLR NR' || doc_id AS citation FROM docs WHERE doc_id % 8 <> 0""")
def normalize_newfoundland_capitals(m: Model) -> DataFrame:
    title = F.when(n() % 8 == 0, " x ").when(n() % 3 == 0, " LABOUR STANDARDS ACT").when(n() % 3 == 1, "Labour STANDARDS Act").otherwise(txt("Act ", n()))
    return normalize.normalize_newfoundland(raw(m, href=txt("https://x/regulations/nr", n(), ".htm"), title=title), True).select("source_url", "title", "citation")


@query("""SELECT 'https://www.ontario.ca/laws/statute/90a' || k AS source_url, 'Act ' || min(doc_id) AS title, '90A' || k AS citation, 'legislation' AS document_type, true AS is_active, '' AS state FROM (SELECT doc_id, doc_id // 2 AS k FROM docs WHERE doc_id % 9 <> 0) GROUP BY k""")
def normalize_ontario(m: Model) -> DataFrame:
    rows = raw(m, alias=txt("statute/90a", F.floor(n() / 2)), title=F.when(n() % 9 == 0, "").otherwise(txt("Act ", n())), state=F.lit(None).cast("string"), date_from="2020")
    return listed(normalize.normalize_ontario(rows, "statute"), "state")


@query(f"""SELECT {_L}, status FROM (SELECT 'https://q/en/document/lc/A-' || doc_id || '?langCont=en' AS source_url, 'Act ' || doc_id AS title, 'CQLR c A-' || doc_id AS citation, 'legislation' AS document_type, doc_id % 3 <> 0 AS is_active,
  CASE doc_id % 3 WHEN 0 THEN 'repealed' WHEN 1 THEN 'replaced' END AS status FROM docs WHERE doc_id % 8 <> 0 AND doc_id % 5 <> 0)""")
def normalize_quebec(m: Model) -> DataFrame:
    rows = raw(m, href=F.when(n() % 8 == 0, txt("https://q/other/", n())).otherwise(txt("https://q/en/document/lc/A-", n())), title=txt("Act ", n()), row_class=F.when(n() % 5 == 0, "nestedRow"), row_text=F.when(n() % 3 == 0, "Repealed").when(n() % 3 == 1, "Replaced by x"))
    return listed(normalize.normalize_quebec(rows, False), "status")


@query(f"""SELECT {_L}, title_fr FROM (SELECT 'https://y/' || CASE WHEN doc_id % 2 = 0 THEN 'PRINCIPAL' ELSE 'SUBORDINATE' END || '/2002-0007/2002-0007_' || doc_id || '.pdf' AS source_url, 'Act ' || doc_id AS title,
  CASE WHEN doc_id % 2 = 0 THEN 'SY ' ELSE 'YT OIC ' END || '2002, c.0007' AS citation, CASE WHEN doc_id % 2 = 0 THEN 'legislation' ELSE 'regulation' END AS document_type, true AS is_active, CASE WHEN doc_id % 3 = 0 THEN 'Loi ' || doc_id END AS title_fr FROM docs)""")
def normalize_yukon(m: Model) -> DataFrame:
    title = F.when(n() % 3 == 0, txt("Act ", n(), " (Loi ", n(), ") Open PDF")).otherwise(txt("Act ", n()))
    rows = raw(m, href=txt(" https://y/", F.when(n() % 2 == 0, "PRINCIPAL").otherwise("SUBORDINATE"), "/2002-0007/2002-0007_", n(), ".pdf"), title=title)
    return listed(normalize.normalize_yukon(rows), "title_fr")


@query(f"""SELECT {_L}, slug FROM (SELECT 'https://w/legislation/s' || doc_id || '/x' || CASE doc_id % 3 WHEN 0 THEN '.a' WHEN 1 THEN '.r1' ELSE '' END || '.pdf' AS source_url, 'Fees Order ' || doc_id AS title,
  CASE WHEN doc_id % 3 = 0 THEN 'RSNWT — ' ELSE 'NWT Reg — ' END || 'Fees Order ' || doc_id AS citation, CASE WHEN doc_id % 3 = 0 THEN 'legislation' ELSE 'regulation' END AS document_type, true AS is_active, 's' || doc_id AS slug FROM docs)""")
def normalize_nwt(m: Model) -> DataFrame:
    rows = raw(m, href=txt("https://w/legislation/s", n(), "/x", F.when(n() % 3 == 0, ".a").when(n() % 3 == 1, ".r1").otherwise(""), ".pdf"), title=txt("Fees Order ", n()))
    return listed(normalize.normalize_nwt(rows), "slug")


@query("""SELECT 'https://www.justice.gov.nt.ca/en/files/legislation/s' || k || '/s' || k || '.a.pdf' AS source_url, 'Act ' || min(doc_id) AS title, 'RSNWT Act ' || min(doc_id) AS citation, 'legislation' AS document_type, true AS is_active, 'Justice' AS department
  FROM (SELECT doc_id, doc_id // 2 AS k FROM docs WHERE doc_id % 7 <> 0) GROUP BY k""")
def normalize_nwt_folders(m: Model) -> DataFrame:
    rows = raw(m, href=txt(F.when(n() % 7 == 0, "#gn-filebrowse-0:/a/Complete").otherwise("#gn-filebrowse-0:/a/s"), F.floor(n() / 2), "/"), title=txt("Act ", n()), department="Justice")
    return listed(normalize.normalize_nwt_folders(rows), "department")


@query(f"""SELECT {_L} FROM (SELECT 'https://u/en/consolidated-law/a' || doc_id AS source_url, CASE WHEN doc_id % 3 = 0 THEN 'Act ' || doc_id || ', S.Nu. 2002, c. ' || doc_id ELSE 'Fees Regulations ' || doc_id END AS title, CASE WHEN doc_id % 3 = 0 THEN 'S.Nu. 2002, c. ' || doc_id ELSE '' END AS citation,
  CASE WHEN doc_id % 3 = 0 THEN 'legislation' ELSE 'regulation' END AS document_type, true AS is_active FROM docs WHERE doc_id % 4 <> 0)""")
def normalize_nunavut(m: Model) -> DataFrame:
    title = F.when(n() % 3 == 0, txt("Consolidation of Act ", n(), ", S.Nu. 2002, c. ", n())).otherwise(txt("Fees Regulations ", n()))
    return listed(normalize.normalize_nunavut(raw(m, href=txt("https://u/", F.when(n() % 4 == 0, "fr").otherwise("en"), "/consolidated-law/a", n()), title=title, letter="A")))


@query(f"""SELECT {_L} FROM (SELECT 'https://publications.saskatchewan.ca/#/products/' || doc_id AS source_url, 'Act ' || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN 'SS 2004, c A-' || doc_id WHEN doc_id % 4 = 3 THEN 'SK Reg c A-' || doc_id ELSE 'RSS c A-' || doc_id END AS citation,
  CASE WHEN doc_id % 4 = 3 THEN 'regulation' ELSE 'legislation' END AS document_type, true AS is_active FROM docs WHERE doc_id % 9 <> 0)""")
def normalize_saskatchewan(m: Model) -> DataFrame:
    rows = raw(m, product_id=F.when(n() % 9 == 0, "0").otherwise(txt(n())), name=F.when(n() % 2 == 0, txt("Act ", n(), ", SS 2004, c A-", n())).otherwise(txt("Act ", n())), custom_id=txt("A-", n()), regulation=n() % 4 == 3)
    return listed(normalize.normalize_saskatchewan(rows))


@query("SELECT doc_id AS pos, CASE WHEN doc_id % 3 <> 0 THEN doc_id + 2 END AS format_id FROM docs")
def pdf_format(m: Model) -> DataFrame:
    one = lambda medium, kind, k: F.struct(F.lit(medium).alias("productFormatMediumType"), F.lit(kind).alias("productFormatType"), (n() + k).alias("productFormatId"))
    formats = F.when(n() % 3 == 0, F.array(one("DIGITAL", "HTML", 0), one("PRINT", "PDF", 1))).otherwise(F.array(one("DIGITAL", "HTML", 0), one("PRINT", "PDF", 1), one("DIGITAL", "Pdf file", 2)))
    return m.corpus.select(n().alias("pos"), normalize.pdf_format(formats).alias("format_id"))


@query("""SELECT 'https://p/a-' || doc_id || '-x.pdf' AS source_url, title, CASE WHEN doc_id % 4 = 1 THEN 'PE Reg a-' ELSE 'RSPEI a-' END || doc_id AS citation, CASE WHEN doc_id % 4 = 1 THEN 'regulation' ELSE 'legislation' END AS document_type, doc_id % 5 <> 0 AS is_active,
  CASE WHEN doc_id % 4 = 1 THEN parent END AS parent_act FROM (SELECT doc_id, title, last_value(CASE WHEN doc_id % 4 <> 1 THEN title END IGNORE NULLS) OVER (PARTITION BY source_type ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS parent
  FROM (SELECT doc_id, source_type, 'Act ' || doc_id || CASE WHEN doc_id % 5 = 0 THEN ' (Repealed)' ELSE '' END AS title FROM docs))""")
def normalize_pei(m: Model) -> DataFrame:
    rows = raw(m, list=F.col("source_type"), href=txt("https://p/a-", n(), "-x.pdf"), title=txt("Act ", n(), F.when(n() % 5 == 0, " (Repealed)").otherwise("")), indent_class=F.when(n() % 4 == 1, "x tw-ml-8"))
    return listed(normalize.normalize_pei(rows), "parent_act")


@query(f"SELECT {_L} FROM (SELECT 'https://www.canlii.org/en/ab/laws/stat/a' || doc_id AS source_url, 'Act ' || doc_id AS title, 'c ' || doc_id AS citation, 'legislation' AS document_type, doc_id % 3 <> 0 AS is_active FROM docs)")
def normalize_statutes_json(m: Model) -> DataFrame:
    return listed(normalize.normalize_statutes_json(raw(m, title=txt("Act ", n()), citation=txt("c ", n()), path=txt("/en/ab/laws/stat/a", n()), status=F.when(n() % 3 == 0, "Repealed"))))


@query(f"SELECT {_L} FROM (SELECT 'https://www.canlii.org/ab/laws/stat/a' || doc_id AS source_url, 'Act ' || doc_id AS title, 'c ' || doc_id AS citation, 'legislation' AS document_type, doc_id % 4 <> 0 AS is_active FROM docs WHERE doc_id % 3 <> 0)")
def normalize_statute_rows(m: Model) -> DataFrame:
    other = F.when(n() % 3 == 1, '<a href="/info/x">info</a>').otherwise("")
    link = F.when(n() % 3 == 0, '<a href="/en/help">help</a>').otherwise(txt('<a class="l" href="/ab/laws/stat/a', n(), '">Act <b>', n(), "</b></a>"))
    return listed(normalize.normalize_statute_rows(raw(m, html=txt("<tr><td>c ", n(), "</td><td>", other, link, F.when(n() % 4 == 0, "<span>[Repealed]</span>").otherwise(""), "</td></tr>"))))


@query("""SELECT name, url, coalesce(category, 'Other') AS category, kind FROM (SELECT doc_id, 'Db ' || doc_id AS name, 'https://www.canlii.org/' || CASE WHEN doc_id % 7 = 0 THEN 'bc/' ELSE 'ab/' END || CASE doc_id % 3 WHEN 0 THEN 'laws/regu' WHEN 1 THEN 'laws/stat' ELSE 'abca' END AS url,
  last_value(CASE doc_id % 10 WHEN 0 THEN 'Legislation' WHEN 5 THEN 'Courts' END IGNORE NULLS) OVER (PARTITION BY source_type ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS category, CASE doc_id % 3 WHEN 0 THEN 'regulations' WHEN 1 THEN 'statutes' ELSE 'decisions' END AS kind FROM docs) WHERE doc_id % 5 <> 0 AND contains(url, '/ab')""")
def classify_databases(m: Model) -> DataFrame:
    text = F.when(n() % 10 == 0, "Legislation (all)").when(n() % 10 == 5, "Courts (all)").otherwise(txt("Db ", n()))
    href = txt("/en/", F.when(n() % 7 == 0, "bc/").otherwise("ab/"), F.when(n() % 3 == 0, "laws/regu/").when(n() % 3 == 1, "laws/stat/").otherwise("abca/"))
    return normalize.classify_databases(raw(m, list=F.col("source_type"), tag=F.when(n() % 5 == 0, "h2").otherwise("a"), text=text, href=href), "ab").drop("pos")


@query(f"SELECT {_L} FROM (SELECT 'https://www.canlii.org/en/ab/laws/stat/a' || doc_id AS source_url, 'Act ' || doc_id AS title, 'c ' || doc_id AS citation, 'legislation' AS document_type, doc_id % 3 <> 0 AS is_active FROM docs)")
def normalize_by_profile(m: Model) -> DataFrame:
    """A source that is a registered row of settings and a function, found by its name."""
    profiles.register_profile("statutes_json", {"status": "Repealed", "every": 3}, normalize.normalize_statutes_json)
    own = profiles.profile("statutes_json")
    rows = raw(m, title=txt("Act ", n()), citation=txt("c ", n()), path=txt("/en/ab/laws/stat/a", n()), status=F.when(n() % own["every"] == 0, own["status"]))
    return listed(profiles.normalize("statutes_json", rows))


@query("SELECT source_url, 'ab' AS jurisdiction_code, 'Legislation' AS category, 'canlii_legacy' AS source_type, true AS is_active, content_text FROM corpus")
def conform_batch(m: Model) -> DataFrame:
    return upsert.conform_batch(m.corpus.select("source_url", "content_text")).select("source_url", "jurisdiction_code", "category", "source_type", "is_active", "content_text")


@query("SELECT source_url, title, 'none' AS category, NULL AS metadata_text, is_active FROM docs")
def conform_columns(m: Model) -> DataFrame:
    out = conform(m.docs.select("is_active", "source_url", F.lit(1).alias("further"), "title"), DOCUMENTS, {"category": "none"})
    return out.select("source_url", "title", "category", F.to_json("metadata").alias("metadata_text"), "is_active")


# --- documents of other forms


@query("SELECT doc_id AS pos, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN 'Text ' || doc_id ELSE 'x' END, ''), 'Texte ' || doc_id) AS content_text FROM docs")
def case_text(m: Model) -> DataFrame:
    rows = raw(m, unofficial_text_en=F.when(n() % 3 == 0, " None ").when(n() % 3 == 1, txt(" Text ", n(), " ")).otherwise("x"), unofficial_text_fr=txt("Texte ", n()))
    return extract.case_text(rows).select("pos", "content_text")


def _as_xml(m: Model) -> DataFrame:
    """Whole texts, of which letters and digits are kept, as the body of a statute."""
    body = F.regexp_replace("content_text", "[^A-Za-z0-9]+", " ")
    return raw(m, xml=txt("<Act><ShortTitle> Act ", n(), "</ShortTitle><Body><Heading>H", n(), "</Heading> tail ", n(), "<Section><Label>", n(), "</Label><MarginalNote>note</MarginalNote><Text>", body, "</Text><Other>other</Other>end</Section></Body></Act>"))


_BODY = "(SELECT doc_id AS i, trim(regexp_replace(content_text, '[^A-Za-z0-9]+', ' ', 'g')) AS body, chr(10) AS br FROM docs)"


@query(f"SELECT i AS pos, br || '= Act ' || i || br || br || '- H' || i || br || 'tail ' || i || br || br || '- ' || i || br || br || '[note]' || CASE WHEN body <> '' THEN br || body ELSE '' END || br || 'end' AS content_text FROM {_BODY}")
def xml_to_marked_text(m: Model) -> DataFrame:
    return extract.xml_to_text(_as_xml(m), "federal").select("pos", "content_text")


@query(f"SELECT i AS pos, 'Act ' || i || br || 'H' || i || br || 'tail ' || i || br || i || br || 'note' || CASE WHEN body <> '' THEN br || body ELSE '' END || br || 'other' || br || 'end' AS content_text FROM {_BODY}")
def xml_to_flat_text(m: Model) -> DataFrame:
    return extract.xml_to_text(_as_xml(m), "flat").select("pos", "content_text")


@query("SELECT id, CASE WHEN doc_id % 2 = 0 THEN '<h2>c ' || doc_id || '</h2>' || content_html ELSE content_html END AS content_html FROM docs")
def prepend_chapter(m: Model) -> DataFrame:
    rows = m.corpus.select(F.sha2("source_url", 256).alias("id"), F.when(n() % 2 == 0, txt("c ", n())).otherwise("").alias("chapter"), "content_html")
    return extract.prepend_chapter(rows).select("id", "content_html")


@query("SELECT page_id, page_id % 3 = 0 OR (page_id % 5 = 0 AND length(html) < 100000) AS is_blocked FROM pages", prefix=False)
def flag_block_pages(m: Model) -> DataFrame:
    html = F.when(F.col("page_id") % 3 == 0, F.concat("html", F.lit(extract.BLOCK_PHRASES[0]))).when((F.col("page_id") % 5 == 0) & (F.length("html") < 100_000), F.concat(F.lit("Solve this captcha "), "html")).otherwise(F.col("html"))
    return extract.flag_block_pages(m.raw("pages").select("page_id", html.alias("html"), F.when(F.col("page_id") % 5 == 0, 403).otherwise(200).alias("status_code"))).select("page_id", "is_blocked")


@query("SELECT doc_id AS pos, doc_id % 3 <> 2 OR length(content_text) < 80 AS is_error FROM docs")
def flag_xml_errors(m: Model) -> DataFrame:
    xml = F.when(n() % 3 == 0, F.concat(F.lit("<HTML><p>"), "content_text", F.lit("</p></HTML>"))).when(n() % 3 == 1, "<a/>").otherwise(F.concat(F.lit("<act>"), F.rpad(F.left("content_text", F.lit(90)), 90, "."), F.lit("</act>")))
    return extract.flag_xml_errors(raw(m, xml=F.when((n() % 3 == 2) & (F.length("content_text") >= 80), F.concat(xml, F.lit("......."))).when(n() % 3 == 2, "<act/>").otherwise(xml))).select("pos", "is_error")


# --- selection, checks and repairs


@query("SELECT source_type FROM (SELECT DISTINCT source_type FROM docs) WHERE source_type IN ('src1', 'src2', 'src3') AND source_type <> 'src2'")
def select_sources(m: Model) -> DataFrame:
    config = m.docs.select("source_type").distinct().withColumn("enabled", F.col("source_type") != "src2")
    return joins.select_sources(config, source_types=["src1", "src2", "src3"]).select("source_type")


@query("SELECT source_url FROM docs WHERE doc_id % 7 = 5")
def restrict_to(m: Model) -> DataFrame:
    chosen = m.corpus.filter(n() % 7 == 5).select("source_url", F.explode(F.array(F.lit(1), F.lit(2))).alias("twice"))
    return incremental.restrict_to(m.docs.select("source_url"), chosen)


@query("SELECT * FROM (VALUES ('events', CAST(NULL AS VARCHAR), 'extra_table'), ('jobs', NULL, 'missing_table'), ('documents', 'no_such_column', 'missing_column')) t(table_name, column_name, finding)", prefix=False)
def check_schema(m: Model) -> DataFrame:
    tables = {n: m.raw(n) for n in ("documents", "labels", "events")}
    return quality.check_schema(m.spark, tables, {"documents": ["doc_id", "no_such_column"], "labels": ["toxic"], "jobs": ["id"]})


@query(f"SELECT 'https://k/a' || (doc_id // 2) || '%20b' AS url, strftime(min(created_at), '{DAY}') AS first_at FROM docs GROUP BY doc_id // 2")
def normalize_keys(m: Model) -> DataFrame:
    rows = m.docs.join(m.corpus.select("doc_id", "source_url"), "source_url")
    keys = rows.select(txt("https://k/a", F.floor(n() / 2), F.when(n() % 2 == 0, " b").otherwise("%20b")).alias("url"), F.col("created_at").alias("scraped_at"))
    return repair.normalize_keys(keys).select("url", wall("scraped_at").alias("first_at"))


@query(f"SELECT id FROM docs WHERE last_checked_at IS NULL OR last_checked_at < {T} - INTERVAL 7 DAY")
def due_batch(m: Model) -> DataFrame:
    return ingest.due_batch(m.docs, F.expr("INTERVAL 7 DAYS"), as_of()).select("id")


_FAILED = f"""SELECT CASE WHEN last_checked_at > {T} - INTERVAL 7 DAY THEN 'skipped_fresh' WHEN doc_id % 10 = 3 THEN 'failed' ELSE 'new' END AS outcome, source_type FROM docs"""


def _with_failures(m: Model) -> DataFrame:
    done = QUERIES["classified_outcomes"](m.spark, m.dir)
    return done.withColumn("outcome", F.when((F.col("outcome") == "new") & F.col("source_url").endswith("3"), "failed").otherwise(F.col("outcome")))


@query(f", o AS ({_FAILED}) SELECT count(*) FILTER (WHERE outcome = 'new') AS succeeded, count(*) FILTER (WHERE outcome = 'failed') AS failed, count(*) FILTER (WHERE outcome = 'skipped_fresh') AS skipped, round_even(count(*) FILTER (WHERE outcome = 'new') * 100.0::DOUBLE / count(*), 1)::DOUBLE AS success_rate FROM o")
def run_summary_failures(m: Model) -> DataFrame:
    return runs.run_summary(_with_failures(m))


@query(f""", o AS ({_FAILED}) SELECT source_type, count(*) AS docs_discovered, count(*) FILTER (WHERE outcome <> 'skipped_fresh') AS docs_checked, count(*) FILTER (WHERE outcome = 'new') AS docs_new, 0::BIGINT AS docs_updated, 0::BIGINT AS docs_unchanged,
  count(*) FILTER (WHERE outcome = 'failed') AS docs_failed, count(*) FILTER (WHERE outcome = 'skipped_fresh') AS docs_skipped_fresh FROM o GROUP BY source_type""")
def batch_progress(m: Model) -> DataFrame:
    return ingest.batch_progress(_with_failures(m))


@query("SELECT id, title FROM docs ORDER BY updated_at DESC, id LIMIT 20")
def browse_or_search_blank(m: Model) -> DataFrame:
    """Blank text browses, and no index is made for it."""
    titles, texts = search.build_title_index(m.docs), search.build_content_index(m.versions)
    return search.browse_or_search(m.docs, m.versions, titles, texts, "  ", per_page=20)[0].select("id", "title")


# --- readers: derived tables are written to the shared folder first

#: Tasks that write a file a row.
FILE_TASKS = 48


@query("SELECT 'set' || doc_id AS dataset, citation AS citation_en, title AS name_en, content_text AS unofficial_text_fr FROM docs")
def read_case_records(m: Model) -> DataFrame:
    at = scratch_folder(m.spark, "cases")
    own = {"dataset": txt("set", n()), "citation_en": F.col("citation"), "name_en": F.col("title"), "unofficial_text_fr": F.col("content_text")}
    m.corpus.select(*[own.get(c, F.lit(None).cast("string")).alias(c) for c in readers.CASE_FIELDS], F.lit(1).alias("further")).write.parquet(at)
    return readers.read_case_records(m.spark, at).select("dataset", "citation_en", "name_en", "unofficial_text_fr")


def _json_files(m: Model, item: Column, wrap: Column, name: str) -> str:
    """JSON files of 100 documents each; ``wrap`` makes a file's text of ``items``, a list of JSON texts."""
    at = scratch_folder(m.spark, name)
    rows = m.corpus.select(F.floor(n() / 100).alias("file"), n().alias("n"), F.to_json(item).alias("item")).groupBy("file").agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("items"))
    rows.select(F.transform("items", lambda x: x["item"]).alias("items")).select(wrap.alias("value")).write.option("maxRecordsPerFile", 1).text(at)
    return at


def _array() -> Column:
    return F.concat(F.lit("["), F.array_join("items", ","), F.lit("]"))


@query("SELECT 'p' || doc_id AS product_id, 'Act ' || doc_id AS name, 'A-' || doc_id AS custom_id, false AS regulation FROM docs UNION ALL SELECT 'r' || doc_id, 'Reg ' || doc_id, 'R-' || doc_id, true FROM docs WHERE doc_id % 2 = 0")
def read_act_tree(m: Model) -> DataFrame:
    one = lambda p, name, c: F.struct(txt(p, n()).alias("productId"), txt(name, n()).alias("name"), txt(c, n()).alias("customIdentifier"))
    at = _json_files(m, F.struct(one("p", "Act ", "A-").alias("act"), F.when(n() % 2 == 0, F.array(one("r", "Reg ", "R-"))).alias("regulations")), _array(), "acts")
    return readers.read_act_tree(m.spark, at).drop("pos")


@query("SELECT 'statute/' || doc_id AS alias, 'Act ' || doc_id AS title, 'current' AS state, CASE WHEN doc_id % 2 = 0 THEN '2020' END AS date_from FROM docs")
def read_bucket_hits(m: Model) -> DataFrame:
    en = lambda c: F.struct(c.alias("en"))
    source = F.struct(en(txt("statute/", n())).alias("alias"), en(txt("Act ", n())).alias("title"), en(F.lit("current")).alias("state"), F.when(n() % 2 == 0, en(F.lit("2020"))).alias("dateFrom"))
    wrap = F.concat(F.lit('{"aggregations":{"act":{"buckets":[{"statute":{"statute_hits":{"hits":{"hits":'), _array(), F.lit("}}}}]}}}"))
    return readers.read_bucket_hits(m.spark, _json_files(m, F.struct(source.alias("_source")), wrap, "hits"), "statute").drop("pos")


@query("SELECT 'a' || doc_id AS name, title, CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR END AS isbn, '2020-01-01' AS date_modified, 7::BIGINT AS total FROM docs")
def read_packages(m: Model) -> DataFrame:
    item = F.struct(txt("a", n()).alias("name"), "title", F.when(n() % 2 == 0, txt(n())).alias("identifier-ISBN-print"), F.lit("2020-01-01").alias("date_modified"))
    wrap = F.concat(F.lit('{"result":{"count":7,"results":'), _array(), F.lit("}}"))
    return readers.read_packages(m.spark, _json_files(m, item, wrap, "packages")).drop("pos")


@query("SELECT CASE s_suppkey % 3 WHEN 0 THEN 'Long ' || s_suppkey WHEN 1 THEN 'Short ' || s_suppkey ELSE 'Any ' || s_suppkey END AS title, trim(s_name) AS body FROM supplier", prefix=False)
def read_xml_docs(m: Model) -> DataFrame:
    at, key = scratch_folder(m.spark, "xml"), F.col("s_suppkey")
    titles = F.concat(F.when(key % 3 == 0, txt("<LongTitle>Long ", key, "</LongTitle>")).otherwise(""), F.when(key % 3 < 2, txt("<ShortTitle>Short ", key, "</ShortTitle>")).otherwise(""), txt("<Title>Any ", key, "</Title>"))
    m.raw("supplier").repartition(FILE_TASKS, key).select(F.concat(F.lit("<Act>"), titles, F.lit("<Body>"), F.trim("s_name"), F.lit("</Body></Act>")).alias("value")).write.option("maxRecordsPerFile", 1).text(at)
    rows = readers.read_xml_docs(m.spark, at, at)
    return rows.select("title", F.xpath_string("xml", F.lit("/Act/Body")).alias("body"))


@query("SELECT 'd' || c_custkey AS doc_id, CASE WHEN c_custkey % 10 = 0 THEN '-- A --' ELSE 'Act ' || c_custkey END AS title, c_custkey % 10 = 0 AS is_group FROM customer", prefix=False)
def read_xml_directory(m: Model) -> DataFrame:
    at, key = scratch_folder(m.spark, "directory"), F.col("c_custkey")
    rows = m.raw("customer").select(txt("d", key).alias("CIVIX_DOCUMENT_ID"), F.when(key % 10 == 0, "-- A --").otherwise(txt("Act ", key)).alias("CIVIX_DOCUMENT_TITLE"))
    rows.write.format("xml").option("rowTag", "dir").option("rootTag", "root").save(at)
    return readers.read_xml_directory(m.spark, at).drop("pos")


@query("SELECT url, html FROM pages", prefix=False)
def read_pages(m: Model) -> DataFrame:
    return readers.read_pages(m.spark, f"{m.dir}/pages.parquet")


@query("SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'too_small' WHEN s_suppkey % 3 = 1 THEN 'wrong_type' END AS reason, count(*) AS files FROM supplier GROUP BY reason", prefix=False)
def gate_binaries(m: Model) -> DataFrame:
    at, key = scratch_folder(m.spark, "binaries"), F.col("s_suppkey")
    body = F.when(key % 3 == 0, "%PDF small").when(key % 3 == 1, F.rpad("s_name", 300, "x")).otherwise(F.rpad(F.lit("%PDF"), 300, "x"))
    m.raw("supplier").repartition(FILE_TASKS, key).select(body.alias("value")).write.option("maxRecordsPerFile", 1).text(at)
    return readers.gate_binaries(m.spark, at).groupBy("reason").agg(F.count(F.lit(1)).alias("files"))


@query(f"SELECT DISTINCT source_url AS url, '{'2024-01-31 00:00:00'}' AS first_at FROM docs")
def read_keys(m: Model) -> DataFrame:
    at = _json_files(m, F.struct("source_url"), F.to_json(F.transform("items", lambda x: F.get_json_object(x, "$.source_url"))), "keys")
    return store.read_keys(m.spark, at, as_of()).select("url", wall("scraped_at").alias("first_at"))


# --- the snapshot store and streaming


@query("SELECT d.id, (SELECT count(*) FROM versions v WHERE v.doc_id = d.doc_id) AS versions FROM docs d")
def store_snapshot(m: Model) -> DataFrame:
    own = store.Store(m.spark, scratch_folder(m.spark, "store"), BUCKETS)
    own.write(m.some_docs, m.some_versions)
    own.write(m.docs, m.versions)
    docs, versions = own.read()
    counts = versions.groupBy(F.col("document_id").alias("id")).agg(F.count(F.lit(1)).alias("versions"))
    return docs.select("id").join(counts, "id", "left").withColumn("versions", F.coalesce("versions", F.lit(0)))


#: Buckets of the stores in these queries: tens of documents a bucket at the smallest size.
BUCKETS = 16
_BUCKET = f"('0x' || left(sha256({{}}), 8))::BIGINT % {BUCKETS}"


@query(f""", was AS (SELECT DISTINCT 'documents' AS table_name, {_BUCKET.format('source_url')} AS bucket FROM docs UNION ALL SELECT DISTINCT 'versions', {_BUCKET.format('id')} FROM docs),
  moved AS (SELECT DISTINCT 'documents' AS table_name, {_BUCKET.format('source_url')} AS bucket FROM docs WHERE source_type = 'src3' AND doc_id % 10 = 0 UNION ALL SELECT DISTINCT 'versions', {_BUCKET.format('id')} FROM docs WHERE source_type = 'src3' AND doc_id % 30 = 0)
  SELECT table_name, bucket::INTEGER AS bucket, CASE WHEN moved.bucket IS NULL THEN 1 ELSE 2 END AS since FROM was LEFT JOIN moved USING (table_name, bucket)""")
def store_touched_buckets(m: Model) -> DataFrame:
    """Which snapshot wrote the folder of each bucket: a batch moves those of its urls and of its changed texts alone."""
    own = store.Store(m.spark, scratch_folder(m.spark, "store"), BUCKETS)
    own.upsert(m.batches.filter("seq = 1"), as_of())
    number = F.regexp_extract("source_url", r"(\d+)$", 1).cast("long")
    own.upsert(m.batches.filter("seq = 2 AND source_type = 'src3'").filter(number % 10 == 0), as_of())
    return own.folders().select("table_name", "bucket", "since")


@query(r", t AS (SELECT document_id AS doc, unnest(regexp_extract_all(lower(content_text), '[\p{L}\p{N}]+')) AS term FROM versions WHERE is_latest AND content_text <> '') SELECT term, doc, count(*) AS places FROM t GROUP BY term, doc")
def index_after_upserts(m: Model) -> DataFrame:
    """The text index that a store keeps over three batches and a merge, from each batch's own texts."""
    own = store.Store(m.spark, scratch_folder(m.spark, "indexed"), BUCKETS, analyzer="simple")
    for k in (1, 2, 3):
        own.upsert(m.batches.filter(F.col("seq") == k), as_of())
    own.merge_index()
    return own.index("content").select("term", "doc", F.size("positions").cast("long").alias("places"))


@query("SELECT id, document_id, version_number::INTEGER AS version_number, is_latest FROM versions")
def upsert_in_steps(m: Model) -> DataFrame:
    """The batches one after another through a store end in the same versions as at once."""
    own = store.Store(m.spark, scratch_folder(m.spark, "steps"), BUCKETS)
    for k in (1, 2, 3):
        own.upsert(m.batches.filter(F.col("seq") == k), as_of())
    return own.read()[1].select("id", "document_id", "version_number", "is_latest")


def _landed(rows: DataFrame, at: str, files: int = 4) -> None:
    """Lands rows as so many files, which make one micro-batch."""
    rows.repartition(files).write.mode("append").parquet(at)


def _stream(m: Model, at: str, schema, files: int = 4) -> DataFrame:
    return ingest.stream_records(m.spark, f"{at}/in", schema, files_per_trigger=files)


#: Files of a micro-batch where all that have arrived make one.
EVERY_FILE = 1 << 30


class Broken(RuntimeError):
    """A fault that a query injects."""


def _run_with_a_fault(start) -> None:
    """Runs a stream that breaks off once, and then goes on."""
    try:
        start(True).awaitTermination()
    except StreamingQueryException as ended:
        if Broken.__name__ not in str(ended):
            raise
    start(False).awaitTermination()


def _stream_upsert(m: Model, name: str, fault: bool = False, measured: bool = False, **more) -> tuple[store.Store, object]:
    """The three batches arrive as files, each when the stream has taken those before, and go into a store; with ``fault``
    the second breaks off between the store and the checkpoint."""
    at = scratch_folder(m.spark, name)
    own, ledger = store.Store(m.spark, f"{at}/store", BUCKETS), ingest.Ledger(m.spark, f"{at}/ledger")
    log, runs_ = ingest.ProgressLog(), []
    m.spark.streams.addListener(log)

    def breaks(number: int, _: DataFrame) -> None:
        if number == 1:
            raise Broken

    def start(fails: bool):
        stream = ingest.stream_records(m.spark, f"{at}/in", m.batches.schema, EVERY_FILE)
        runs_.append(ingest.stream_upsert(stream, own, as_of(), f"{at}/checkpoint", breaks if fails else None, ledger=ledger, land=measured, **more))
        return runs_[-1]

    for seq in (1, 2, 3):
        m.batches.filter(F.col("seq") == seq).write.mode("append").option("compression", "zstd").parquet(f"{at}/in")
        if fault and seq == 2:
            _run_with_a_fault(start)
        else:
            start(False).awaitTermination()
    counted = ledger.read()
    if measured:
        counted = ingest.stream_progress(reduce(DataFrame.unionByName, [log.rows(r) for r in runs_]), counted)
    m.spark.streams.removeListener(log)
    return own, counted


_STREAMED = "SELECT document_id, id, version_number, is_latest, content_hash FROM versions"
_LEDGER = """SELECT (seq - 1)::BIGINT AS batch, count(*) AS taken, count(*) FILTER (WHERE seq = 1) AS docs_new, count(*) FILTER (WHERE seq > 1 AND content_hash IS DISTINCT FROM before) AS docs_updated, count(*) FILTER (WHERE seq > 1 AND content_hash IS NOT DISTINCT FROM before) AS docs_unchanged"""


@query(_STREAMED)
def stream_upsert(m: Model) -> DataFrame:
    return _stream_upsert(m, "stream")[0].read()[1].select("document_id", "id", "version_number", "is_latest", "content_hash")


@query(f"{_LEDGER}, count(*) AS input_rows FROM hashed GROUP BY seq")
def stream_progress(m: Model) -> DataFrame:
    """Each micro-batch: the rows that Spark measured, and what became of them."""
    return _stream_upsert(m, "progress", measured=True)[1].select("batch", "taken", "docs_new", "docs_updated", "docs_unchanged", "input_rows")


@query(_STREAMED)
def stream_upsert_recovered(m: Model) -> DataFrame:
    """The second batch breaks off after the store has it; a restart ends in the same tables."""
    return _stream_upsert(m, "recovered", fault=True)[0].read()[1].select("document_id", "id", "version_number", "is_latest", "content_hash")


@query(f"{_LEDGER} FROM hashed GROUP BY seq")
def stream_ledger_recovered(m: Model) -> DataFrame:
    """After such a fault the replayed batch still has its counters."""
    return _stream_upsert(m, "ledger", fault=True)[1].select("batch", "taken", "docs_new", "docs_updated", "docs_unchanged")


#: All of the first batch, a part of the second and nothing of the third.
_SOME = "(SELECT count(*) + count(*) // 4 FROM corpus)"


@query(f""", n AS (SELECT *, row_number() OVER (ORDER BY seq, source_url) AS place FROM batches), h AS (SELECT *, sha256(content_text) AS content_hash FROM n WHERE place <= {_SOME}),
  c AS (SELECT *, lag(content_hash) OVER (PARTITION BY doc_id ORDER BY seq) AS before FROM h) SELECT sha256(source_url) AS document_id, row_number() OVER (PARTITION BY doc_id ORDER BY seq)::INTEGER AS version_number, content_hash FROM c WHERE content_hash IS DISTINCT FROM before""")
def stream_limited(m: Model) -> DataFrame:
    """A limit on the rows of a stream holds over its batches and over a restart."""
    n = m.corpus.count()
    return _stream_upsert(m, "limited", fault=True, limit=n + n // 4)[0].read()[1].select("document_id", "version_number", "content_hash")


def _stream_unseen(m: Model, fault: bool = False) -> DataFrame:
    """Listings that repeat urls arrive as files; each url is passed on once. With ``fault`` the second batch breaks off
    between the sink and the keys."""
    at = scratch_folder(m.spark, "unseen")
    listing = m.docs.select("source_url")
    for part in (listing.filter("source_url NOT LIKE '%7'"), listing.unionByName(listing)):
        _landed(part, f"{at}/in")

    def start(fails: bool):
        def sink(fresh: DataFrame, number: int) -> None:
            fresh.write.mode("overwrite").parquet(f"{at}/out/batch={number}")
            if fails and number == 1:
                raise Broken

        return ingest.stream_unseen(_stream(m, at, listing.schema), f"{at}/keys", as_of(), f"{at}/checkpoint", sink)

    if fault:
        _run_with_a_fault(start)
    else:
        start(False).awaitTermination()
    return m.spark.read.parquet(f"{at}/out").select("source_url", F.col("batch").cast("int").alias("batch"))


_UNSEEN = "SELECT source_url, CASE WHEN source_url LIKE '%7' THEN 1 ELSE 0 END AS batch FROM docs"


@query(_UNSEEN)
def stream_unseen(m: Model) -> DataFrame:
    return _stream_unseen(m)


@query(_UNSEEN)
def stream_unseen_recovered(m: Model) -> DataFrame:
    return _stream_unseen(m, fault=True)


@query("""SELECT source_url, 0 AS day FROM docs UNION ALL SELECT 'mark 10 ' || source_url, 10 FROM docs UNION ALL SELECT 'mark 11 ' || source_url, 11 FROM docs UNION ALL SELECT source_url, 12 FROM docs""")
def stream_unseen_within(m: Model) -> DataFrame:
    """Urls listed again within a day go; listed again twelve days later, when the watermark has passed, they are new."""
    at = scratch_folder(m.spark, "within")
    listed_at = lambda d, hours=0: F.expr(f"TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, {d}, {hours})").alias("at")
    urls = m.docs.select("source_url")
    marks = lambda d: urls.select(F.concat(F.lit(f"mark {d} "), "source_url").alias("source_url"), listed_at(d))
    first = urls.select("source_url", listed_at(0))
    for part in (first.unionByName(first), urls.select("source_url", listed_at(0, 20)), marks(10), marks(11), urls.select("source_url", listed_at(12)).unionByName(urls.select("source_url", listed_at(12, 3)))):
        _landed(part, f"{at}/in")
    stream = ingest.unseen_within(_stream(m, at, first.schema), "at", "1 day")
    ingest.append_files(stream, f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return m.spark.read.schema(first.schema).parquet(f"{at}/out").select("source_url", F.datediff("at", F.lit("2024-01-01")).alias("day"))
