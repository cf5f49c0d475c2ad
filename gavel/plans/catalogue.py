"""Catalogue queries: classification, audit and URL functions over the pages' URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.functions import names, urls
from gavel.operators import catalogue, lookups, reports
from gavel.registry import query
from gavel.session import scratch, table


def _sql_test(kind: str, args: list) -> str:
    quoted = [f"'{a}'" for a in args if isinstance(a, str)]
    if kind == "empty":
        return "trim(u) = ''"
    if kind in ("any", "all"):
        return "(" + (" OR " if kind == "any" else " AND ").join(f"contains(u, {q})" for q in quoted) + ")"
    if kind == "pattern":
        return f"regexp_matches(u, {quoted[0]})"
    if kind == "id":
        return f"regexp_extract(u, {quoted[0]}, 1) IN ({', '.join(repr(str(i)) for i in args[1])})"
    return f"lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2)) IN ({', '.join(quoted)})"


CASCADE = "CASE " + " ".join(f"WHEN {_sql_test(k, a)} THEN '{t}'" for k, a, t in catalogue.RULES) + f" ELSE '{catalogue.OTHER}' END"
#: URLs of the pages, and the same with hosts of the catalogue put in for some, so that every rule has rows.
HOSTS = ["www.waterloo.be", "www.burdinne.be", "www.thuin.be", "raadpleeg-x.onlinesmartcities.be", "ebesluit.x.be", "x-echo.cipalschaubroeck.be", "x.meetingburger.net", "lblod.x.be", "xlblod.be", "x.bestuurlijkeinformatie.nl", "www.conseilcommunal.be/commune/13", "www.conseilcommunal.be/commune/5", "www.deliberations.be", "publi.irisnet.be", "molenbeek.irisnet.be", "www.1030.be", "app-pubcon-x.azurewebsites.net", "www.brussel.be", "x.be/sites/a/files", "x.be/system/files", "x.be/file/download", "x.be/download.ashx", "x.be/ac-file/docodis", "www.provincedeliege.be", "www.ixelles.be", "provincieantwerpen.be/provincieraad", "provincieantwerpen.be"]
HOST_SQL = "['" + "', '".join(HOSTS) + "']"
URLS = f"(SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://' || {HOST_SQL}[CAST(page_id // 3 % {len(HOSTS)} AS INT) + 1] || '/p/' || page_id WHEN page_id % 31 = 1 THEN ' ' WHEN page_id % 31 = 2 THEN 'ftp://x.be/a' ELSE url END AS url FROM pages)"


def catalogue_urls(spark, sf_dir):
    """page_id, url: the pages' URLs, a third of them at the catalogue's hosts, some empty or invalid."""
    known = F.concat(F.lit("https://"), F.element_at(F.lit(HOSTS), (F.floor(F.col("page_id") / 3) % len(HOSTS)).cast("int") + 1), F.lit("/p/"), F.col("page_id").cast("string"))
    url = F.when(F.col("page_id") % 3 == 0, known).when(F.col("page_id") % 31 == 1, " ").when(F.col("page_id") % 31 == 2, "ftp://x.be/a").otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"))


VALID = "coalesce(regexp_matches(trim(url), '^(?:[hH][tT][tT][pP][sS]?)://[^/?#]+'), false)"
ORIGIN = f"CASE WHEN {VALID} THEN lower(regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 1)) || '://' || regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2) ELSE '' END"
HOST = "lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)', 2))"


@query(f"SELECT page_id, {CASCADE} AS type, {VALID} AS valid, {ORIGIN} AS base_url FROM (SELECT page_id, url, lower(url) AS u FROM {URLS})")
def catalog_classify(spark, sf_dir):
    return catalogue_urls(spark, sf_dir).select("page_id", catalogue.classify(F.col("url")).alias("type"), urls.is_valid(F.col("url")).alias("valid"), urls.origin(F.col("url")).alias("base_url"))


@query(f"SELECT CASE WHEN grouping(type) = 1 THEN 'TOTAL' ELSE type END AS type, count(*) AS n FROM (SELECT {CASCADE} AS type FROM (SELECT lower(url) AS u FROM {URLS})) GROUP BY ROLLUP (type)")
def catalog_type_rollup(spark, sf_dir):
    return reports.counts_with_total(catalogue_urls(spark, sf_dir).select(catalogue.classify(F.col("url")).alias("type")), "type")


@query(
    "SELECT page_id, array_to_string(list_filter([CASE WHEN host <> '' AND fh < page_id THEN 'name of row ' || fh END, CASE WHEN url <> '' AND fu < page_id THEN 'URL of row ' || fu END, "
    f"CASE WHEN trim(url) = '' THEN 'no URL' WHEN NOT {VALID} THEN 'bad syntax' WHEN type IN ('overig', 'leeg') THEN 'no handler' END], lambda x: x IS NOT NULL), '; ') AS problems "
    f"FROM (SELECT *, min(page_id) OVER (PARTITION BY host) AS fh, min(page_id) OVER (PARTITION BY url) AS fu FROM (SELECT page_id, url, {HOST} AS host, {CASCADE} AS type FROM (SELECT page_id, url, lower(url) AS u FROM {URLS})))"
)
def catalog_duplicates(spark, sf_dir):
    rows = catalogue_urls(spark, sf_dir).withColumn("host", urls.host(F.col("url")))
    return catalogue.audit(rows, "host", "url", "page_id").select("page_id", F.array_join("problems", "; ").alias("problems"))


PROBE = "CASE page_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 403 WHEN 2 THEN 404 WHEN 3 THEN 301 ELSE 200 END"


@query(
    f"SELECT type, count(*) AS total, count(*) FILTER (WHERE outcome = 'ok') AS ok, count(*) FILTER (WHERE outcome = 'fout') AS bad, count(*) FILTER (WHERE code >= 400) AS http_errors FROM (SELECT type, code, CASE WHEN code IS NULL THEN 'fout' WHEN code = 403 AND type IN ('imio', 'wordpress') THEN 'ok' WHEN code >= 400 THEN 'fout' ELSE 'ok' END AS outcome FROM (SELECT {CASCADE} AS type, {PROBE} AS code FROM (SELECT page_id, lower(url) AS u FROM {URLS}))) GROUP BY type"
)
def catalog_audit_summary(spark, sf_dir):
    from gavel.functions import filters

    code = F.when(F.col("page_id") % 7 == 0, F.lit(None).cast("int")).when(F.col("page_id") % 7 == 1, 403).when(F.col("page_id") % 7 == 2, 404).when(F.col("page_id") % 7 == 3, 301).otherwise(200)
    rows = catalogue_urls(spark, sf_dir).select(catalogue.classify(F.col("url")).alias("type"), code.alias("code"))
    rows = rows.withColumn("outcome", filters.probe_outcome(F.col("code"), F.when(F.col("code").isNull(), "timeout"), F.col("type"), ["imio", "wordpress"]))
    return rows.groupBy("type").agg(F.count("*").alias("total"), F.count_if(F.col("outcome") == "ok").alias("ok"), F.count_if(F.col("outcome") == "fout").alias("bad"), F.count_if(F.col("code") >= 400).alias("http_errors"))


@query("SELECT DISTINCT regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS slug FROM pages WHERE contains(url, 'example')")
def catalog_slugs(spark, sf_dir):
    return table(spark, sf_dir, "pages").filter(F.col("url").contains("example")).select(F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1).alias("slug")).distinct()


@query("SELECT page_id, regexp_extract(url, '^https?://([^.]+)[.]([^/]+)', 1) AS subdomain, 'https://' || regexp_extract(url, '^https?://([^/]+)', 1) AS base_url FROM pages WHERE regexp_matches(url, '^https?://[^.]+[.]th')")
def catalog_vendor_rows(spark, sf_dir):
    u = F.col("url")
    rows = table(spark, sf_dir, "pages").filter(u.rlike(r"^https?://[^.]+[.]th"))
    return rows.select("page_id", F.regexp_extract(u, r"^https?://([^.]+)[.]([^/]+)", 1).alias("subdomain"), F.concat(F.lit("https://"), urls.host(u)).alias("base_url"))


@query(
    f"SELECT page_id, {HOST} AS host, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS path_key, "
    "list_extract(string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '/'), -1) AS segment, "
    "lower(regexp_extract(list_extract(string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '/'), -1), '[.]([A-Za-z0-9]+)$', 1)) AS ext, "
    "regexp_replace(list_extract(string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '/'), -1), '[.][A-Za-z0-9]+$', '') AS stem FROM pages"
)
def url_parts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.host(u).alias("host"), urls.path_key(u).alias("path_key"), urls.last_segment(u).alias("segment"), urls.extension(u).alias("ext"), urls.stem(u).alias("stem"))


@query(f"SELECT page_id, regexp_replace(h, '^[w.]+', '') AS faithful, regexp_replace(h, '^www[.]', '') AS bare FROM (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'www.' || {HOST} WHEN page_id % 4 = 1 THEN 'www.waterloo.be' ELSE {HOST} END AS h FROM pages)")
def host_normalise(spark, sf_dir):
    own = urls.host(F.col("url"))
    h = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("www."), own)).when(F.col("page_id") % 4 == 1, "www.waterloo.be").otherwise(own)
    return table(spark, sf_dir, "pages").select("page_id", urls.bare_host(h, faithful=True).alias("faithful"), urls.bare_host(h).alias("bare"))


@query("SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages")
def query_param(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.query_parameter(F.col("url"), "page").alias("page"), urls.query_parameter(F.col("url"), "ref").alias("ref"))


@query("SELECT t.type, t.has_handler, count(u.type) AS n FROM (VALUES " + ", ".join(f"('{t}', {str(h).lower()})" for t, h, *_ in catalogue.TYPES) + f") t(type, has_handler) LEFT JOIN (SELECT {CASCADE} AS type FROM (SELECT lower(url) AS u FROM {URLS})) u ON t.type = u.type GROUP BY 1, 2")
def catalog_groups(spark, sf_dir):
    """Every known type with its number of entries, empty ones too."""
    own = catalogue_urls(spark, sf_dir).groupBy(catalogue.classify(F.col("url")).alias("type")).agg(F.count("*").alias("n"))
    return catalogue.types(spark).join(own, "type", "left").select("type", "has_handler", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"SELECT page_id, type FROM (SELECT page_id, {CASCADE} AS type FROM (SELECT page_id, lower(url) AS u FROM {URLS})) WHERE type NOT IN ('overig', 'leeg')")
def semi_known_types(spark, sf_dir):
    rows = catalogue_urls(spark, sf_dir).select("page_id", catalogue.classify(F.col("url")).alias("type"))
    return rows.join(F.broadcast(catalogue.types(spark).filter("has_handler")), "type", "left_semi").select("page_id", "type")


@query(
    f"SELECT page_id, CASE WHEN type IN ('overig', 'leeg') THEN NULL ELSE concat_ws(' ', type, CASE WHEN type IN ('smartcities', 'cipalschaubroeck') THEN url ELSE {ORIGIN} END, CASE WHEN type <> 'imio' THEN '--all' END, CASE WHEN type IN ('smartcities', 'cipalschaubroeck', 'ibabs', 'vlaamsbrabant', 'deliberations') THEN '--items' END, CASE WHEN type = 'smartcities' THEN '--visible' END, '--months 12') END AS task FROM (SELECT page_id, url, {CASCADE} AS type FROM (SELECT page_id, url, lower(url) AS u FROM {URLS}))"
)
def task_plan(spark, sf_dir):
    """The options with which each entity would be harvested; null without a handler."""
    rows = catalogue_urls(spark, sf_dir).withColumn("type", catalogue.classify(F.col("url"))).join(F.broadcast(catalogue.types(spark)), "type")
    target = F.when(F.col("type").isin("smartcities", "cipalschaubroeck"), F.col("url")).otherwise(urls.origin(F.col("url")))
    flags = [F.when(F.col(c), f) for c, f in (("has_organs", "--all"), ("has_items", "--items"), ("has_browser", "--visible"))]
    return rows.select("page_id", F.when(F.col("has_handler"), F.concat_ws(" ", "type", target, *flags, F.lit("--months 12"))).alias("task"))


SANITISE = "CASE WHEN v = '' THEN 'document' ELSE v END"
STEPS = [("'[.]{2,}'", "'_'"), (r"""'[<>:"/\\|?*\x00-\x1F]'""", "'_'"), (r"'^[. \t\n\r]+'", "''"), (r"'[. \t\n\r]+$'", "''"), ("'_+'", "'_'"), ("'^_+|_+$'", "''")]


def sanitise_sql(value: str) -> str:
    for pattern, by in STEPS:
        value = f"regexp_replace({value}, {pattern}, {by}, 'g')"
    return value


RESERVED_SQL = ", ".join(f"'{r}'" for r in names.RESERVED)


@query(
    f"SELECT id, CASE WHEN w = '' THEN 'document' ELSE w END AS name FROM (SELECT id, CASE WHEN length(r) > 40 THEN substr(r, 1, 40 - length(regexp_extract(r, '([.][^.]{{1,9}})$', 1))) || regexp_extract(r, '([.][^.]{{1,9}})$', 1) ELSE r END AS w FROM (SELECT id, CASE WHEN upper(split_part(v, '.', 1)) IN ({RESERVED_SQL}) THEN '_' || v ELSE v END AS r FROM (SELECT id, {sanitise_sql('raw')} AS v FROM (SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN '../' || p_name || '.pdf' WHEN 1 THEN 'CON.' || p_partkey WHEN 2 THEN 'a<b>:' || p_name || '?' WHEN 3 THEN '...' WHEN 4 THEN p_name || p_type || p_brand || p_name || '.docx' ELSE p_name END AS raw FROM part))))"
)
def sanitize_names(spark, sf_dir):
    k, n = F.col("p_partkey"), F.col("p_name")
    raw = F.when(k % 6 == 0, F.concat(F.lit("../"), n, F.lit(".pdf"))).when(k % 6 == 1, F.concat(F.lit("CON."), k.cast("string"))).when(k % 6 == 2, F.concat(F.lit("a<b>:"), n, F.lit("?"))).when(k % 6 == 3, "...").when(k % 6 == 4, F.concat(n, F.col("p_type"), F.col("p_brand"), n, F.lit(".docx"))).otherwise(n)
    return table(spark, sf_dir, "part").select(k.alias("id"), names.sanitise(raw, 40).alias("name"))


@query(
    "SELECT doc_id, CASE WHEN substr(v, 1, 60) = '' THEN 'gemeente' ELSE substr(v, 1, 60) END AS slug, substr(translate(lower(raw), ' /', '__'), 1, 30) AS folder FROM (SELECT doc_id, raw, regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(raw, '''', ''), '[ /]', '_', 'g'), '[^A-Za-z0-9_-]', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS v FROM (SELECT doc_id, text AS raw FROM documents WHERE text IS NOT NULL))"
)
def slugify_names(spark, sf_dir):
    raw = F.col("text")
    return table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", names.slug(raw).alias("slug"), names.folder(raw).alias("folder"))


@query(
    f"SELECT folded, count(*) AS n, count(DISTINCT word) AS spellings FROM (SELECT word, translate(strip_accents(lower(word)), ' -', '') AS folded FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)) GROUP BY folded"
)
def accent_fold_match(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    return words.groupBy(names.folded(F.col("word")).alias("folded")).agg(F.count("*").alias("n"), F.countDistinct("word").alias("spellings"))


# letters with marks beside those of Western names, composed and not; by customer, in two spellings of a town
_SPELT = ["Ž", "ő", "ệ", "Ǻ", "ḿ", "Й", "ά", "e\u0301", "S\u0327\u030c", "ğ"]
_SPELT_SQL = "[" + ", ".join(f"'{x}'" for x in _SPELT) + "]"


@query(f"SELECT a.c_custkey, count(*) AS spellings, min(b.c_custkey) AS first FROM (SELECT c_custkey, c_nationkey, {_SPELT_SQL}[c_custkey % 10 + 1] || '-Stad ' || (c_custkey % 50) AS name FROM customer) a JOIN (SELECT c_custkey, strip_accents(lower({_SPELT_SQL}[c_custkey % 10 + 1])) || 'stad' || (c_custkey % 50) AS key FROM customer) b ON replace(replace(strip_accents(lower(a.name)), ' ', ''), '-', '') = b.key GROUP BY a.c_custkey")
def accent_fold_join(spark, sf_dir):
    """Names with marks of many scripts meet the same names without, spelt otherwise."""
    k, n = F.col("c_custkey"), (F.col("c_custkey") % 50).cast("string")
    mark = F.element_at(F.lit(_SPELT), (k % 10 + 1).cast("int"))
    own = table(spark, sf_dir, "customer")
    one = own.select("c_custkey", names.folded(F.concat(mark, F.lit("-Stad "), n)).alias("key"))
    two = own.select(k.alias("other"), names.folded(F.concat(names.without_marks(F.lower(mark)), F.lit("STAD"), n)).alias("key"))
    met = two.groupBy("key").agg(F.count("*").alias("n"), F.min("other").alias("first"))  # a row a key, so that its names never meet in pairs
    return one.join(met, "key").groupBy("c_custkey").agg(F.sum("n").alias("spellings"), F.min("first").alias("first"))


@query("SELECT name, count(*) AS n, count(DISTINCT spelt) AS spellings FROM (SELECT strip_accents(lower(c_mktsegment)) AS name, CASE c_custkey % 3 WHEN 0 THEN upper(c_mktsegment) WHEN 1 THEN lower(c_mktsegment) ELSE replace(replace(lower(c_mktsegment), 'i', 'ï'), 'e', 'ė') END AS spelt FROM customer) GROUP BY name")
def accent_group_by(spark, sf_dir):
    """Names grouped in a collation: spellings that differ by case and marks are one group."""
    s, k = F.col("c_mktsegment"), F.col("c_custkey") % 3
    spelt = F.when(k == 0, F.upper(s)).when(k == 1, F.lower(s)).otherwise(F.replace(F.replace(F.lower(s), F.lit("i"), F.lit("ï")), F.lit("e"), F.lit("ė")))
    rows = table(spark, sf_dir, "customer").select(spelt.alias("spelt")).withColumn("name", names.alike(F.col("spelt")))
    return rows.groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("spelt").alias("spellings")).select(names.without_marks(F.lower(F.collate("name", "UTF8_BINARY"))).alias("name"), "n", "spellings")


_TWO = "(SELECT c_custkey AS k, CASE WHEN c_custkey % 97 = 0 THEN '' ELSE substr(c_name, 1 + CAST(c_custkey % 5 AS INT), 4 + CAST(c_custkey % 12 AS INT)) END AS term FROM customer)"


@query(f"SELECT t.k AS c_custkey, t.term, coalesce(min_by(s_name, s_suppkey), t.term) AS resolved FROM {_TWO} t LEFT JOIN supplier ON contains(lower(s_name), lower(t.term)) OR contains(lower(t.term), lower(s_name)) GROUP BY 1, 2")
def names_contained(spark, sf_dir):
    """The first supplier whose name holds a term or is held by it, found by shared grams: no term meets all suppliers."""
    k = F.col("c_custkey")
    term = F.when(k % 97 == 0, "").otherwise(F.substr("c_name", (k % 5).cast("int") + 1, (k % 12).cast("int") + 4))
    terms = table(spark, sf_dir, "customer").select("c_custkey", term.alias("term"))
    return lookups.first_match(terms, table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "term", "s_name", "s_suppkey").select("c_custkey", "term", "resolved")


_LINES = "(SELECT c_custkey AS k, CAST(c_custkey % 4 AS BIGINT) AS part, CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN 'alone ' || c_custkey WHEN c_custkey % 7 = 0 THEN ' ;https://h.be/' || c_custkey ELSE c_name || '; https://h.be/' || c_custkey || ' ;more' END AS line FROM customer)"


@query(f"SELECT part, row_number() OVER (PARTITION BY part ORDER BY k) + 1 AS line_no, k, CASE WHEN k % 11 = 0 THEN 'fewer than two fields' WHEN k % 7 = 0 THEN 'no name' END AS reason FROM {_LINES} QUALIFY line <> ''")
def audit_lines(spark, sf_dir):
    """Lines of large catalogues by their numbers, with the reasons why some are left out."""
    k = F.col("c_custkey")
    line = F.when(k % 13 == 0, "").when(k % 11 == 0, F.concat(F.lit("alone "), k.cast("string"))).when(k % 7 == 0, F.concat(F.lit(" ;https://h.be/"), k.cast("string"))).otherwise(F.concat("c_name", F.lit("; https://h.be/"), k.cast("string"), F.lit(" ;more")))
    rows = table(spark, sf_dir, "customer").select((k % 4).alias("part"), k.alias("k"), line.alias("line"))
    headers = rows.select("part").distinct().select("part", F.lit(-1).cast("long").alias("k"), F.lit("entity;url").alias("line"))
    path = scratch(spark, "catalogue")
    rows.unionByName(headers).repartition(4, "part").sortWithinPartitions("part", "k").select("part", "line").write.partitionBy("part").text(path)
    found = catalogue.audit_scan(spark, path)
    return found.select(F.regexp_extract("file", r"part=(\d+)", 1).cast("long").alias("part"), "line_no", F.regexp_extract(F.concat("url", F.lit(" "), "entity"), r"(\d+)", 1).cast("long").alias("k"), "reason")


@query(
    "SELECT page_id, coalesce(CASE WHEN page_id % 4 = 1 THEN 'verslag ' || page_id || '.pdf' END, CASE WHEN page_id % 4 IN (0, 2) THEN 'n' || page_id || '.pdf' END, nullif(regexp_extract(url, '/([^/?#]+)/?(?:[?#].*)?$', 1), ''), 'document') AS name, CASE page_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN NULL ELSE '.bin' END AS ext FROM pages"
)
def filename_resolve(spark, sf_dir):
    k = F.col("page_id")
    header = F.when(k % 4 == 0, F.concat(F.lit('attachment; filename="n'), k.cast("string"), F.lit('.pdf"'))).when(k % 4 == 1, F.concat(F.lit("attachment; filename*=UTF-8''verslag%20"), k.cast("string"), F.lit(".pdf")))
    hint = F.when(k % 4 == 2, F.concat(F.lit("n"), k.cast("string"), F.lit(".pdf")))
    kind = F.when(k % 3 == 0, "application/pdf").when(k % 3 == 1, "text/html; charset=utf-8").otherwise("application/octet-stream")
    return table(spark, sf_dir, "pages").select("page_id", names.resolved(header, hint, F.col("url")).alias("name"), names.extension_for(kind).alias("ext"))


@query("SELECT page_id, regexp_replace(n || '. ' || t, '^[0-9]+[a-z]?[.] +', '') AS title, regexp_extract(n || '. ' || t, '^([0-9]+[a-z]?)[.] ', 1) AS nr, regexp_replace(regexp_replace(t || ' (12.3 KB)', '(?i) *[(]?[0-9]+(?:[.,][0-9]+)? *[KM]B[)]? *$', ''), '&amp;', '&', 'g') AS label FROM (SELECT page_id, page_id || CASE WHEN page_id % 2 = 0 THEN 'a' ELSE '' END AS n, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)")
def item_labels(spark, sf_dir):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    nr, rest = names.number_and_title(F.concat(F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, "a").otherwise(""), F.lit(". "), title))
    label = F.replace(urls.without_size(F.concat(title, F.lit(" (12.3 KB)"))), F.lit("&amp;"), F.lit("&"))
    return table(spark, sf_dir, "pages").select("page_id", rest.alias("title"), nr.alias("nr"), label.alias("label"))
