"""Landed listing records of each source to the one listing shape, as native column expressions.

Every raw table carries ``pos``, the listing order, and where it matters ``list``. Every result has the listing columns:
source_url, title, citation, jurisdiction_code, category, document_type, is_active, metadata, pos.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import SAFE_PATH, SAFE_PATH_COMMA, absolute, decoded, encoded, extract, filled, first_filled, fix_caps, last_segment, normalize_url, squeeze, strip, with_query
from folioflow.operators.incremental import first_wins
from folioflow.operators.ordering import carry_forward

#: Courts with their jurisdiction and name, in table order.
COURTS = (
    ("SCC", "ca", "Supreme Court of Canada"), ("SCC-L", "ca", "SCC Leave Applications"), ("FCA", "ca", "Federal Court of Appeal"), ("FC", "ca", "Federal Court"), ("TCC", "ca", "Tax Court of Canada"),
    ("CMAC", "ca", "Court Martial Appeal Court"), ("CHRT", "ca", "Canadian Human Rights Tribunal"), ("SST", "ca", "Social Security Tribunal"), ("IRB-RAD", "ca", "Refugee Appeal Division"),
    ("IRB-RPD", "ca", "Refugee Protection Division"), ("RAD", "ca", "Refugee Appeal Division"), ("RPD", "ca", "Refugee Protection Division"), ("RLLR", "ca", "Refugee Law Lab Reporter"),
    ("BCCA", "bc", "BC Court of Appeal"), ("BCSC", "bc", "BC Supreme Court"), ("ONCA", "on", "Ontario Court of Appeal"), ("ONSC", "on", "Ontario Superior Court"), ("ABCA", "ab", "Alberta Court of Appeal"),
    ("ABKB", "ab", "Alberta King's Bench"), ("ABQB", "ab", "Alberta Queen's Bench"), ("SKCA", "sk", "Saskatchewan Court of Appeal"), ("MBCA", "mb", "Manitoba Court of Appeal"), ("NBCA", "nb", "New Brunswick Court of Appeal"),
    ("NSCA", "ns", "Nova Scotia Court of Appeal"), ("PECA", "pe", "PEI Court of Appeal"), ("NLCA", "nl", "NL Court of Appeal"), ("YKCA", "yt", "Yukon Court of Appeal"), ("NWTCA", "nt", "NWT Court of Appeal"), ("NUCA", "nu", "Nunavut Court of Appeal"),
)
#: Prefixes of neutral citations with their jurisdiction, and names of their courts.
CITATION_COURTS = {"NSSC": "ns", "NSCA": "ns", "NSPC": "ns", "NSSM": "ns", "NSFC": "ns", "NSWCAT": "ns", "NSUARB": "ns", "NSLB": "ns", "NSLRB": "ns"}
CITATION_NAMES = {"NSSC": "Nova Scotia Supreme Court", "NSCA": "Nova Scotia Court of Appeal", "NSPC": "Nova Scotia Provincial Court", "NSSM": "Nova Scotia Small Claims Court", "NSFC": "Nova Scotia Family Court"}
#: Regulation titles that need their act, and navigation pages of a regulations site.
GENERIC_REGULATIONS = ("general", "forms", "fees", "exemptions", "exemption", "administration", "procedures", "procedural", "designation", "enforcement", "standards", "licensing", "inspection", "appeal", "board", "regions", "documents", "qualifications")
NAVIGATION = ("index.htm", "aboutrr.htm", "regsbydept.htm", "order.htm", "search.htm", "rg1.htm", "rg1issues.htm", "rg2.htm", "rg2issues.htm", "publicat.htm", "relsites.htm", "contacts.htm", "advertising.htm")

_EMPTY = "map<string,string>"


def _map(**values: Column | str) -> Column:
    """A map without the keys whose value is null."""
    pairs = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))]) if values else F.create_map().cast(_EMPTY)
    return F.map_filter(pairs, lambda _, v: v.isNotNull())


def _listing(df: DataFrame, url: Column, title: Column, citation: Column, jurisdiction: Column | str, regulation: Column, active: Column | None = None, **metadata: Column | str) -> DataFrame:
    j = jurisdiction if isinstance(jurisdiction, Column) else F.lit(jurisdiction)
    return df.select(
        url.alias("source_url"), title.alias("title"), citation.alias("citation"), j.alias("jurisdiction_code"), F.when(regulation, "Regulation").otherwise("Legislation").alias("category"),
        F.when(regulation, "regulation").otherwise("legislation").alias("document_type"), (F.lit(True) if active is None else active).alias("is_active"), _map(**metadata).alias("metadata"), "pos",
    )


def _class(regulation: Column) -> Column:
    return F.when(regulation, "regulation").otherwise("statute")


def _said(c: str | Column) -> Column:
    """Stripped, empty for null."""
    return strip(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))


def courts(spark: SparkSession) -> DataFrame:
    """The court dimension (ord, court_key, jurisdiction, court_name)."""
    return spark.createDataFrame([(i, *c) for i, c in enumerate(COURTS)], "ord int, court_key string, jurisdiction string, court_name string")


def map_courts(df: DataFrame, column: str = "dataset") -> DataFrame:
    """Adds jurisdiction_code: of the court named, else of the first in table order that the name holds, else ca. The
    table has 29 rows, so it goes along as an expression and nothing is joined."""
    name = F.upper(_said(column))
    exact = F.lit(None).cast("string")
    for key, jurisdiction, _ in reversed(COURTS):
        exact = F.when(name == key, jurisdiction).otherwise(exact)
    held = F.lit("ca")
    for key, jurisdiction, _ in reversed(COURTS):
        held = F.when(name.contains(key), jurisdiction).otherwise(held)
    return df.withColumn("jurisdiction_code", F.coalesce(exact, held))


def _field(c: str) -> Column:
    """A case-law field: stripped, with null and the word None as empty."""
    v = _said(c)
    return F.when(v == "None", "").otherwise(v)


def normalize_cases(raw: DataFrame) -> DataFrame:
    either = lambda name: first_filled(_field(f"{name}_en"), _field(f"{name}_fr"))
    citation, court, url = either("citation"), _field("dataset"), either("url")
    name = court
    for key, _, full in COURTS:
        name = F.when(F.upper(court) == key, full).otherwise(name)
    made = F.when((url == "") & (citation != ""), F.concat(F.lit("a2aj://case/"), F.replace(citation, F.lit(" "), F.lit("_")))).otherwise(url)
    out = _listing(map_courts(raw), made, first_filled(either("name"), citation), citation, F.col("jurisdiction_code"), F.lit(False), court=court, court_name=name, date=either("document_date"))
    return out.withColumns({"category": F.lit("Case Law"), "document_type": F.lit("case_law")})


def parse_citation(citation: Column, default: str = "ns") -> tuple[Column, Column]:
    """(court, jurisdiction) from the second word of a neutral citation."""
    parts = F.split(strip(F.coalesce(citation, F.lit(""))), r"(?U)\s+")
    court = F.coalesce(F.upper(F.get(parts, F.lit(1))), F.lit(""))
    jurisdiction = F.lit(default)
    for key, j in CITATION_COURTS.items():
        jurisdiction = F.when(court == key, j).otherwise(jurisdiction)
    return court, jurisdiction


def normalize_decisions(raw: DataFrame, base: str, instance: str, sub_court: str, court_name: str = "", default: str = "ns") -> DataFrame:
    """Rows (href, title, citation, date_text); those without an item number go."""
    item, sub = extract(F.col("href"), r"/item/(\d+)/index\.do"), F.coalesce(extract(F.col("href"), rf"/{instance}/(\w+)/en/"), F.lit(sub_court))
    citation = _said("citation")
    court, jurisdiction = parse_citation(citation, default)
    name = first_filled(court, F.lit(court_name))
    for key, full in CITATION_NAMES.items():
        name = F.when(court == key, full).otherwise(name)
    date = F.coalesce(extract(F.col("date_text"), r"(\d{4}-\d{2}-\d{2})"), _said("date_text"))
    url = F.concat(F.lit(f"{base}/"), sub, F.lit("/en/item/"), item, F.lit("/index.do"))
    out = _listing(raw.filter(item.isNotNull()), url, first_filled(_said("title"), citation), citation, jurisdiction, F.lit(False), court=court, court_name=name, date=date, item_id=item, sub_court=sub, decisia_instance=instance)
    return out.withColumns({"category": F.lit("Case Law"), "document_type": F.lit("case_law")})


def result_count(html: Column) -> Column:
    """The number before the word result; null without one."""
    return F.replace(extract(html, r"(?U)(\d[\d,]*)(?:\s|&nbsp;)+result"), F.lit(","), F.lit("")).cast("long")


def normalize_federal(raw: DataFrame) -> DataFrame:
    """XML documents (path below the source's folder, title)."""
    stem = F.regexp_replace(last_segment(F.col("path")), r"\.[^.]*$", "")
    regulation = F.lower("path").contains("regulations")
    url = F.concat(F.lit("https://laws-lois.justice.gc.ca/"), F.replace("path", F.lit(".xml"), F.lit("")), F.lit("/"))
    return _listing(raw, url, first_filled(_said("title"), stem), stem, "ca", regulation, xml_file=F.col("path"))


def normalize_bc(raw: DataFrame, url: str = "https://www.bclaws.gov.bc.ca/civix/document/id/complete/statreg/{}") -> DataFrame:
    """Directory entries (doc_id, title, letter_dir_id, letter_group)."""
    head, tail = url.split("{}")
    low = F.lower("title")
    regulation = ~(low.contains("act") & ~low.contains("regulation"))
    kept = raw.filter((_said("doc_id") != "") & (_said("title") != ""))
    return _listing(kept, F.concat(F.lit(head), "doc_id", F.lit(tail)), F.col("title"), F.col("doc_id"), "bc", regulation, civix_id=F.col("doc_id"), letter_dir_id=F.col("letter_dir_id"), letter_group=F.col("letter_group"))


def resolve_bc_documents(dirs: DataFrame, entries: DataFrame) -> DataFrame:
    """The document of each directory (dir_id) among entries (parent_id, tag, id, title, pos): its first direct one;
    else in its first directory named Act the first whose id holds _multi, else the first; else the id with _01."""
    documents = entries.filter("tag = 'document' AND id <> ''")
    direct = documents.groupBy(F.col("parent_id").alias("dir_id")).agg(F.min_by("id", "pos").alias("direct"))
    act = entries.filter("tag = 'dir' AND title = 'Act'").groupBy(F.col("parent_id").alias("dir_id")).agg(F.min_by("id", "pos").alias("act"))
    inside = documents.groupBy(F.col("parent_id").alias("act")).agg(F.min_by("id", F.struct(~F.col("id").contains("_multi"), F.col("pos"))).alias("nested"))
    found = dirs.select("dir_id").join(direct, "dir_id", "left").join(act.join(inside, "act"), "dir_id", "left")
    return found.select("dir_id", F.coalesce("direct", "nested", F.concat("dir_id", F.lit("_01"))).alias("document_id"))


def normalize_alberta(raw: DataFrame, base: str = "https://kings-printer.alberta.ca", content: str = "https://kings-printer.alberta.ca/1266.cfm") -> DataFrame:
    """Packages (name, title, isbn, date_modified)."""
    regulation, isbn = F.col("name").rlike(r"^\d{4}_\d{3}$"), F.coalesce("isbn", F.lit(""))
    kind = F.when(regulation, "Regs").otherwise("Acts")
    page = F.concat(F.lit(f"{content}?page="), "name", F.lit(".cfm&leg_type="), kind, F.lit("&isbncln="), isbn, F.lit("&display=html"))
    url = F.when(isbn != "", F.concat(F.lit(f"{base}/570.cfm?frm_isbn="), isbn, F.lit("&search_by=link"))).otherwise(page)
    citation = F.when(regulation, F.col("name")).otherwise(F.upper("name"))
    return _listing(raw.filter(F.coalesce(F.col("name") != "", F.lit(False))), url, F.coalesce("title", "name"), citation, "ab", regulation, ckan_name=F.col("name"), isbn=isbn, leg_type=kind, content_url=page, date_modified=F.coalesce("date_modified", F.lit("")))


def chapter_class(chapter: Column) -> Column:
    """statute or regulation by the form of a chapter; statutes are tested first, and are what is left."""
    statute = chapter.rlike(r"^\d{4},\s*c\.") | chapter.rlike(r"(?i)^[A-Z]-[\d.]+$")
    return F.when(statute, "statute").when(chapter.rlike(r"(?i)^(?:\d{2,4}-\d+|Rule-)"), "regulation").otherwise("statute")


def normalize_new_brunswick(raw: DataFrame, base: str = "https://laws.gnb.ca") -> DataFrame:
    """Rows (list, pos, chapter, title, href) of the list of statutes, in which regulations follow their act, and of the
    list of regulations, which adds what the first hasn't got. A column ``listing`` keeps several listings apart."""
    by = ["listing", "list"] if "listing" in raw.columns else ["list"]
    rows = raw.select(*by, "pos", _said("chapter").alias("chapter"), _said("title").alias("title"), F.coalesce("href", F.lit("")).alias("href"))
    rows = rows.filter((F.col("chapter") != "") & (F.col("title") != "") & (F.col("href") != "") & ~F.lower("title").isin("title", "titre", "chapter"))
    from_statutes = F.col("list") == "statutes"
    rows = rows.withColumn("regulation", ~from_statutes | (chapter_class(F.col("chapter")) == "regulation")).withColumn("act", F.when(from_statutes & ~F.col("regulation"), F.col("title")))
    rows = carry_forward(rows, "act", by, "pos", "parent")
    part = F.when(F.col("regulation"), "cr").otherwise("cs")
    place = F.concat(F.lit("/en/document/"), part, F.lit("/"))
    url = F.when(F.col("href").contains(place), normalize_url(F.col("href"), SAFE_PATH)).otherwise(F.concat(F.lit(base), place, encoded(F.col("chapter"), "-._~")))
    rows = rows.withColumn("source_url", url).withColumn("rank", F.when(from_statutes, 0).otherwise(1))
    rows = first_wins(rows, ["source_url"], ["rank", "pos"])
    reg = F.concat(F.lit(" (NB Reg. "), "chapter", F.lit(")"))
    generic = F.col("regulation") & F.lower(strip(F.col("title"))).isin(*GENERIC_REGULATIONS)
    title = F.when(generic & (F.coalesce("parent", F.lit("")) != ""), F.concat("title", F.lit(" — "), "parent", reg)).when(generic & ~from_statutes, F.concat("title", reg)).otherwise(F.col("title"))
    return _listing(
        rows, F.col("source_url"), title, F.col("chapter"), "nb", F.col("regulation"), doc_class=_class(F.col("regulation")), chapter=F.col("chapter"), corpus=F.when(F.col("regulation"), "regs").otherwise("statutes"),
        content_url=F.col("href"), parent_act=F.when(F.col("regulation"), F.coalesce("parent", F.lit(""))).otherwise(""),
    )


def normalize_nova_scotia(raw: DataFrame, regulations: bool) -> DataFrame:
    """Links (pos, href, title, li_text); of regulations the first of each normalised url stays."""
    name = F.replace(last_segment(F.col("href")), F.lit(".htm"), F.lit(""))
    url, low = normalize_url(F.col("href"), SAFE_PATH_COMMA), F.lower("href")
    if not regulations:
        text = squeeze(F.regexp_replace(F.coalesce("li_text", "title"), r"(?U)\s*(HTML|PDF)\s*", ""))
        title = F.regexp_replace(text, r"^[* ]*(?<=\*)[* ]*", "")
        kept = raw.filter(F.col("href").contains("statutes") & F.col("href").contains(".htm") & ~low.contains(".pdf") & (F.length(text) >= 3))
        return _listing(kept, url, title, F.concat(F.lit("RSNS "), name), "ns", F.lit(False), doc_class="statute", filename=name)
    index = F.col("href").rlike("regsbyact|rxaa-|rxam-|consregs")
    kept = raw.filter(F.col("href").contains(".htm") & (F.length(_said("title")) >= 3) & (low.contains("/just/regulations/") | low.contains("/legc/")) & ~index & ~F.lower(last_segment(F.col("href"))).isin(*NAVIGATION))
    kept = first_wins(kept.withColumn("_url", url), ["_url"], ["pos"])
    return _listing(kept, F.col("_url"), _said("title"), F.concat(F.lit("NS Reg "), name), "ns", F.lit(True), doc_class="regulation", filename=name)


def normalize_manitoba(raw: DataFrame, regulations: bool) -> DataFrame:
    """Table rows (pos, chapter, title, href)."""
    href, title = F.coalesce("href", F.lit("")), _said("title")
    kept = raw.filter((href != "") & (title != ""))
    if regulations:
        number = F.coalesce(extract(href, r"current/(.+?)\.php"), F.lit(""))
        kept = kept.filter(href.contains("current/") & href.contains(".php"))
        return _listing(kept, href, title, F.when(number != "", F.concat(F.lit("Man Reg "), number)).otherwise(""), "mb", F.lit(True), doc_class="regulation", reg_number=number)
    chapter = _said("chapter")
    kept = kept.filter((chapter != "") & ~F.lower(chapter).isin("c.c.s.m.", "chapter") & ~href.contains("_info") & ~href.contains("index"))
    return _listing(kept, href, title, F.concat(F.lit("CCSM c "), chapter), "mb", F.lit(False), doc_class="statute", chapter=chapter)


def normalize_newfoundland(raw: DataFrame, regulations: bool) -> DataFrame:
    part, prefix = ("/regulations/", "NLR ") if regulations else ("/statutes/", "SNL ")
    kept = raw.filter(F.col("href").contains(part) & F.col("href").contains(".htm") & (F.length(_said("title")) >= 3))
    name = F.replace(last_segment(F.col("href")), F.lit(".htm"), F.lit(""))
    return _listing(kept, F.col("href"), fix_caps(_said("title")), F.concat(F.lit(prefix), F.upper(name)), "nl", F.lit(regulations), doc_class="regulation" if regulations else "statute", filename=name)


def normalize_ontario(raw: DataFrame, doc_type: str, base: str = "https://www.ontario.ca") -> DataFrame:
    """Search hits (pos, alias, title, state, date_from); the first of each alias stays."""
    kept = first_wins(raw.filter((F.coalesce("alias", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != "")), ["alias"], ["pos"])
    own = F.when(F.col("alias").contains("/"), F.regexp_replace("alias", r"^[^/]*/", "")).otherwise(F.col("alias"))
    blank = lambda c: F.coalesce(c, F.lit(""))
    return _listing(kept, F.concat(F.lit(f"{base}/laws/"), "alias"), F.col("title"), F.upper(own), "on", F.lit(doc_type == "regulation"), doc_class=doc_type, url_id=own, alias=F.col("alias"), state=blank("state"), date_from=blank("date_from"))


def normalize_quebec(raw: DataFrame, regulations: bool) -> DataFrame:
    """Rows (pos, href, title, row_class, row_text)."""
    kept = raw.filter(F.col("href").contains("/document/") & (F.length(_said("title")) >= 3))
    if not regulations:
        kept = kept.filter(~F.coalesce("row_class", F.lit("")).contains("nestedRow"))
    kept = first_wins(kept.withColumn("_url", with_query(strip(F.col("href")), "langCont=en")), ["_url"], ["pos"])
    code = strip(decoded(F.coalesce(extract(F.col("_url"), r"/document/(?:lc|rc)/([^?]+)"), F.lit(""))))
    low = F.lower(F.coalesce("row_text", F.lit("")))
    repealed, replaced = low.rlike("abrog|repealed"), low.rlike("remplac|replaced")
    citation = F.when(code == "", "").otherwise(F.concat(F.lit("CQLR " if regulations else "CQLR c "), code))
    status = F.when(replaced, "replaced").when(repealed, "repealed")
    return _listing(kept, F.col("_url"), _said("title"), citation, "qc", F.lit(regulations), ~repealed, doc_class="regulation" if regulations else "statute", format="html", chapter_code=code, status=status)


def normalize_yukon(raw: DataFrame) -> DataFrame:
    """Links (pos, href, title), titles in two languages."""
    kept = raw.filter((F.coalesce("href", F.lit("")) != "") & (F.length(_said("title")) >= 3))
    kept = first_wins(kept.withColumn("_url", strip(F.col("href"))), ["_url"], ["pos"])
    title = strip(F.regexp_replace(_said("title"), r"(?U)\s*Open\s*PDF\s*$", ""))
    both = r"(?U)^(.+?)\s*\(([^)]+)\)\s*$"
    english = F.coalesce(filled(strip(F.regexp_extract(title, both, 1))), title)
    regulation = F.col("_url").contains("/SUBORDINATE/")
    year, number = (extract(F.col("_url"), r"/(\d{4})-(\w+)/\1-\2_(\d+)\.pdf$", g) for g in (1, 2))
    citation = F.when(year.isNull(), "").otherwise(F.concat(F.when(regulation, "YT OIC ").otherwise("SY "), year, F.lit(", c."), number))
    return _listing(kept, F.col("_url"), fix_caps(english), citation, "yt", regulation, doc_class=_class(regulation), format="pdf", title_fr=filled(strip(F.regexp_extract(title, both, 2))))


def normalize_nwt(raw: DataFrame) -> DataFrame:
    """Links to documents (pos, href, title)."""
    title, low = _said("title"), F.lower(_said("title"))
    kept = raw.filter((F.coalesce("href", F.lit("")) != "") & (F.length(title) >= 3))
    regulation = F.when(F.col("href").rlike(r"\.r\d+\.pdf$"), True).when(F.col("href").endswith(".a.pdf"), False).otherwise(low.rlike("regulation|rules|order") & ~low.contains("act"))
    citation = F.concat(F.when(regulation, "NWT Reg").otherwise("RSNWT"), F.lit(" — "), F.left(title, F.lit(50)))
    return _listing(kept, F.col("href"), title, citation, "nt", regulation, doc_class=_class(regulation), slug=F.coalesce(extract(F.col("href"), r"/legislation/([^/]+)/"), F.lit("")), format="pdf")


def normalize_nwt_folders(raw: DataFrame, base: str = "https://www.justice.gov.nt.ca") -> DataFrame:
    """The fallback: folder anchors (pos, href, title, department), the first of each slug."""
    title = _said("title")
    kept = raw.withColumn("_slug", extract(F.col("href"), r"#gn-filebrowse-0:/[a-z]/([^/]+)/")).filter((F.length(title) >= 2) & ~title.rlike(r"^\p{L}{1,2}$") & ~F.col("href").contains("Complete") & F.col("_slug").isNotNull())
    kept = first_wins(kept, ["_slug"], ["pos"])
    url = F.concat(F.lit(f"{base}/en/files/legislation/"), "_slug", F.lit("/"), "_slug", F.lit(".a.pdf"))
    return _listing(kept, url, title, F.concat(F.lit("RSNWT "), F.left(title, F.lit(30))), "nt", F.lit(False), doc_class="statute", slug=F.col("_slug"), format="pdf", department=_said("department"))


def normalize_nunavut(raw: DataFrame) -> DataFrame:
    """Links (pos, href, title, letter); other languages' pages go."""
    title = _said("title")
    kept = raw.filter(F.col("href").contains("/en/consolidated-law/") & ~F.col("href").rlike("/fr/|/iu/") & (F.length(title) >= 3))
    low = F.lower(title)
    regulation = low.rlike("regulation|order|rules|by-law") & ~F.split_part(low, F.lit(","), F.lit(1)).contains("act")
    clean = F.regexp_replace(F.regexp_replace(title, r"(?iU),?\s*(Official\s+)?Consolidation\s+of\s*$", ""), r"(?iU)^Consolidation\s+of\s+", "")
    citation = F.coalesce(extract(title, r"(?U)(S\.(?:Nu|N\.W\.T)\.\s*\d{4}\s*,\s*c\.\s*\d+)"), F.lit(""))
    return _listing(kept, F.col("href"), strip(fix_caps(clean)), citation, "nu", regulation, doc_class=_class(regulation), letter=F.col("letter"))


def normalize_saskatchewan(raw: DataFrame, base: str = "https://publications.saskatchewan.ca") -> DataFrame:
    """Products (pos, product_id, name, custom_id, regulation)."""
    name, custom, regulation = _said("name"), _said("custom_id"), F.col("regulation")
    product = F.col("product_id").cast("string")
    kept = raw.filter((name != "") & product.isNotNull() & ~product.isin("", "0"))
    found = [strip(extract(name, p)) for p in (r"(?U),\s*((?:SS|RSS|RRS)\s+\d{4},\s*c\s+[\w.-]+)$", r"(?U),\s*(SR\s+\d+/\d+)$", r"(?U),\s*(RRS\s+c\s+[\w.-]+\s+Reg\s+\d+)$")]
    other = F.when(custom != "", F.concat(F.when(regulation, "SK Reg").otherwise("RSS"), F.lit(" c "), custom)).otherwise("")
    title = strip(F.regexp_replace(name, r"(?U),\s*(?:SS|RSS|RRS|SR)\s+.*$", ""))
    return _listing(kept, F.concat(F.lit(f"{base}/#/products/"), product), title, F.coalesce(*found, other), "sk", regulation, doc_class=_class(regulation), format="pdf", product_id=product)


def pdf_format(formats: Column) -> Column:
    """The id of the first digital format of a PDF type; null without one."""
    fits = F.filter(formats, lambda f: (f["productFormatMediumType"] == "DIGITAL") & F.upper(f["productFormatType"]).contains("PDF"))
    return F.get(fits, F.lit(0))["productFormatId"]


def normalize_pei(raw: DataFrame) -> DataFrame:
    """Links (pos, href, title, indent_class): indented ones are regulations of the act before them."""
    title = _said("title")
    kept = raw.filter(F.col("href").contains(".pdf") & (F.length(title) >= 3))
    kept = first_wins(kept.withColumn("_url", strip(F.col("href"))), ["_url"], ["pos"])
    kept = kept.withColumn("_reg", F.coalesce(F.col("indent_class").rlike("tw-ml-8|tw-ml-9"), F.lit(False))).withColumn("_act", F.when(~F.col("_reg"), title)).withColumn("_all", F.lit(1))
    kept = carry_forward(kept, "_act", ["list"] if "list" in raw.columns else ["_all"], "pos", "_parent")
    code = extract(F.replace(decoded(last_segment(F.col("_url"))), F.lit(".pdf"), F.lit("")), r"^([A-Za-z&]+[-.]?\d+(?:[-.]\d+)*)")
    citation = F.when(code.isNull(), "").otherwise(F.concat(F.when(F.col("_reg"), "PE Reg ").otherwise("RSPEI "), code))
    repealed = title.contains("(Repealed)") | title.contains("(repealed)")
    return _listing(kept, F.col("_url"), title, citation, "pe", F.col("_reg"), ~repealed, doc_class=_class(F.col("_reg")), format="pdf", parent_act=F.when(F.col("_reg"), F.col("_parent")), status=F.when(repealed, "repealed"))


def normalize_statutes_json(raw: DataFrame, base: str = "https://www.canlii.org") -> DataFrame:
    """Rows (pos, title, citation, path, status)."""
    active = ~F.lower(F.coalesce("status", F.lit(""))).contains("repealed")
    blank = lambda c: F.coalesce(c, F.lit(""))
    return _listing(raw, absolute(blank("path"), base), blank("title"), blank("citation"), F.lit(None).cast("string"), F.lit(False), active)


#: Fixed value: what the url of a law holds.
LAW_LINK = r"(?:/[a-z]{2})?/[a-z]{2}/laws/(?:stat|astat|regu|aregu|const)/"


def normalize_statute_rows(raw: DataFrame, base: str = "https://www.canlii.org") -> DataFrame:
    """Row fragments (pos, html): the citation in the first cell, the first link to a law, and a status span for inactive
    ones. Rows without such a link go."""
    cell = squeeze(F.regexp_replace(F.regexp_extract("html", r"(?is)<td[^>]*>(.*?)</td>", 1), r"<[^>]+>", " "))
    link = rf"(?s)<[aA]\b[^>]*href=\"([^\"]*{LAW_LINK}[^\"]*)\"[^>]*>(.*?)</[aA]>"
    href = extract(F.col("html"), link)
    title = squeeze(F.regexp_replace(F.regexp_extract("html", link, 2), r"<[^>]+>", " "))
    gone = F.col("html").rlike(r"(?is)<span[^>]*>[^<]*(?:Repealed|spent|not in force)[^<]*</span>")
    return _listing(raw.filter(href.isNotNull()), absolute(href, base), title, cell, F.lit(None).cast("string"), F.lit(False), ~gone)


def citation_from_url(url: Column) -> Column:
    """rsa-2000-c-a-1 in a statute's url is RSA 2000, c A 1; empty elsewhere."""
    part = extract(url, r"/(?:stat|astat|regu|aregu|const)/([^/]+)/")
    return F.coalesce(F.regexp_replace(F.replace(F.upper(part), F.lit("-"), F.lit(" ")), r"\s+C\s+", ", c "), F.lit(""))


def classify_databases(raw: DataFrame, jurisdiction: str, base: str = "https://www.canlii.org") -> DataFrame:
    """Headings and links (list, pos, tag, text, href) of a database page: links with the category of the heading
    before them, inside the jurisdiction, no deeper than a database."""
    text = _said("text")
    known = text.rlike("Legislation|Courts|Boards and Tribunals|Législation|Tribunaux")
    name = strip(F.split_part(text, F.lit("("), F.lit(1)))
    english = F.when(name.contains("Législation"), "Legislation").when(name.contains("Tribunaux"), "Courts").when(name.contains("Boards") | name.contains("Tribunals"), "Boards and Tribunals").otherwise(name)
    rows = carry_forward(raw.withColumn("_head", F.when(F.col("tag").isin("h2", "h3") & known, english)), "_head", ["list"], "pos", "_category")
    href = F.col("href")
    path = F.when(href.startswith("/en/"), F.replace(href, F.lit("/en/"), F.lit("/"))).when(href.startswith("/"), href)
    rows = rows.withColumn("_path", F.regexp_replace(path, "/+$", "")).filter((F.col("tag") == "a") & F.col("_path").isNotNull() & ~href.rlike("reset|javascript"))
    rows = rows.filter(F.col("_path").contains(f"/{jurisdiction}") & (F.size(F.split(F.regexp_replace("_path", "^/", ""), "/")) <= 4))
    kind = F.when(F.col("_path").rlike("/laws/regu|/laws/aregu"), "regulations").when(F.col("_path").contains("/laws/"), "statutes").otherwise("decisions")
    return rows.select(text.alias("name"), F.concat(F.lit(base), "_path").alias("url"), F.coalesce("_category", F.lit("Other")).alias("category"), kind.alias("kind"), "pos")
