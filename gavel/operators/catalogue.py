"""The catalogue of source URLs: reading it, classifying it by an ordered cascade, auditing it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gavel.functions import urls

# fixed values: hosts and ids that belong to a source type
PLONE_HOSTS = (
    "www.viroinval.be",
    "www.couvin.be",
    "www.herstal.be",
    "www.burdinne.be",
    "www.andenne.be",
    "www.arlon.be",
    "www.blegny.be",
    "www.chaumont-gistoux.be",
    "www.daverdisse.be",
    "www.estinnes.be",
    "www.froidchapelle.be",
    "www.gerpinnes.be",
    "www.grace-hollogne.be",
    "www.heron.be",
    "www.honnelles.be",
    "www.jalhay.be",
    "www.jurbise.be",
    "www.meix-devant-virton.be",
    "www.mettet.be",
    "www.paliseul.be",
    "www.philippeville.be",
    "www.quaregnon.be",
    "www.saint-ghislain.be",
    "www.thimister-clermont.be",
    "www.thuin.be",
    "www.wasseiges.be",
    "www.clavier.be",
    "www.braine-lalleud.be",
    "www.villedefontaine.be",
    "www.lahulpe.be",
    "www.manage-commune.be",
)
PRESS_HOSTS = (
    "www.bernissart.be",
    "www.floreffe.be",
    "www.waterloo.be",
    "www.fernelmont.be",
    "www.chievres.be",
    "www.verlaine.be",
    "www.brugelette.be",
    "www.fosses-la-ville.be",
    "www.pecq.be",
    "www.herbeumont.be",
    "www.lalouviere.be",
    "rumes-online.be",
    "www.antoing.net",
    "www.ans-ville.be",
    "www.aubange.be",
    "www.burdinne.be",
    "www.crisnee.be",
    "www.gesves.be",
    "montdelenclus.be",
    "www.orp-jauche.be",
    "www.trooz.be",
    "www.vaux-sur-sure.be",
    "www.hastiere.be",
    "www.pontacelles.be",
    "www.province.namur.be",
    "www.courcelles.eu",
)
COMMUNES = [2, 8, 9, 10, 12, 13, 14, 16, 17, 18, 22, 26, 28, 29, 37, 40, 41, 44, 46, 53, 58, 63, 64, 65, 66, 67, 68, 69, 70, 72, 78, 80, 83, 92, 93, 97, 98, 99, 104]
# fixed values: the cascade, in order: (kind of test, its arguments, source type)
RULES: list[tuple[str, list, str]] = [
    ("empty", [], "leeg"),
    ("any", ["onlinesmartcities.be", "besluitvorming.", "ebesluitvorming.", "ebesluit."], "smartcities"),
    ("any", ["cipalschaubroeck.be", "csecho.be"], "cipalschaubroeck"),
    ("any", ["meetingburger.net"], "meetingburger"),
    ("any", ["www.ingelmunster.be/db_files_2"], "ingelmunster"),
    ("pattern", [r"\blblod\."], "lblod"),
    ("any", ["bestuurlijkeinformatie.nl"], "ibabs"),
    ("any", ["bestuur.vlaamsbrabant.be"], "vlaamsbrabant"),
    ("all", ["provincieantwerpen.be", "provincieraad"], "provantwerpen"),
    ("any", ["www.hainaut.be"], "hainaut"),
    ("any", ["province.luxembourg.be"], "luxemburg"),
    ("any", ["brabantwallon.be"], "brabantwallon"),
    ("id", [r"conseilcommunal\.be/commune/(\d+)", COMMUNES], "idelibe"),
    ("any", ["deliberations.be", "conseilcommunal.be"], "deliberations"),
    ("any", ["publi.irisnet.be"], "irisnet"),
    ("any", ["bruxelles.be", "brussel.be"], "brussel"),
    ("any", ["forest.brussels"], "forest"),
    ("any", ["molenbeek.irisnet.be"], "molenbeek"),
    ("any", ["1030.be"], "schaerbeek"),
    ("any", ["/file/download"], "icordis"),
    ("any", ["publicatie.gelinkt-notuleren.vlaanderen.be"], "gelinktnotuleren"),
    ("all", ["app-pubcon-", "azurewebsites.net"], "pubcon"),
    ("any", ["/wp-content/uploads", "www.st.vith.be", "/app/uploads", "/fileadmin/gemeinde_amel", "/pv-et-resumes-du-conseil", "@@folder_listing"], "wordpress"),
    ("host", PLONE_HOSTS, "imio"),
    ("host", PRESS_HOSTS, "wordpress"),
    ("any", ["provincedeliege.be"], "drupal"),
    ("pattern", [r"/sites/[^/]+/files"], "drupal"),
    ("any", ["/system/files"], "drupal"),
    ("any", ["/ac-file/docodis"], "docodis"),
    ("any", ["/download.ashx"], "linkebeek"),
    ("any", ["www.ixelles.be"], "ixelles"),
]
OTHER = "overig"
# fixed values: what each source type can do: type, has a handler, browser, items, organs
TYPES = [
    (kind, kind not in ("overig", "leeg"), kind == "smartcities", kind in ("smartcities", "cipalschaubroeck", "ibabs", "vlaamsbrabant", "deliberations"), kind != "imio")
    for kind in (
        "smartcities cipalschaubroeck meetingburger ingelmunster lblod ibabs vlaamsbrabant provantwerpen hainaut luxemburg "
        "brabantwallon deliberations irisnet brussel forest molenbeek schaerbeek icordis gelinktnotuleren docodis linkebeek "
        "drupal wordpress idelibe pubcon ixelles imio overig leeg"
    ).split()
]


def _test(kind: str, args: list, url: Column, lower: Column) -> Column:
    if kind == "empty":
        return F.btrim(lower, F.lit(urls.BLANK)) == ""
    if kind == "any":
        return F.greatest(F.lit(False), *(lower.contains(a) for a in args))
    if kind == "all":
        return F.least(F.lit(True), *(lower.contains(a) for a in args))
    if kind == "pattern":
        return lower.rlike(args[0])
    if kind == "id":
        return F.coalesce(F.regexp_extract(lower, args[0], 1).try_cast("int").isin([int(i) for i in args[1]]), F.lit(False))
    return urls.host(url).isin(*args)


def classify(url: Column, rules: list | None = None, other: str = OTHER) -> Column:
    """Source type of a URL: the first rule that holds names it. One CASE, so later rules are not evaluated."""
    value = F.coalesce(url, F.lit(""))
    out, rules = F.when(F.lit(False), ""), rules or RULES
    for kind, args, name in rules:
        out = out.when(_test(kind, args, value, F.lower(value)), name)
    return out.otherwise(other)


def types(spark: SparkSession) -> DataFrame:
    """The source types as a dimension."""
    return spark.createDataFrame(TYPES, "type string, has_handler boolean, has_browser boolean, has_items boolean, has_organs boolean")


def _trimmed(column: str) -> Column:
    return F.trim(F.coalesce(column, F.lit("")))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """entity, url, type, base_url, problem of a semicolon-separated catalogue with a header; further fields are ignored.

    problem says why a row must be left out (no name, invalid URL); rows without a URL are fine. A file whose header
    has fewer than two fields has no rows. Line order is not kept: audit_scan() gives it where it matters.
    """
    header = spark.read.text(path).limit(1).collect()
    known = bool(header) and ";" in header[0]["value"]
    raw = spark.read.option("sep", ";").option("header", True).schema("entity string, url string").csv(path)
    rows = (raw if known else raw.limit(0)).select(_trimmed("entity").alias("entity"), _trimmed("url").alias("url"))
    problem = F.when(F.col("entity") == "", "no name").when((F.col("url") != "") & ~urls.is_valid(F.col("url")), "invalid URL")
    return rows.select("entity", "url", classify(F.col("url")).alias("type"), urls.origin(F.col("url")).alias("base_url"), problem.alias("problem"))


#: Most splits whose offsets are broadcast (some 100 bytes each).
BROADCAST_SPLITS = 100_000


def numbered(spark: SparkSession, path: str, broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """file, line_no (from 1), line of text files of any size; empty lines count, and are left out.

    Each split counts its lines, prefix sums over the splits of a file say how many lines come before a split, and the
    place within it is the row's place in its task. No task holds more than a split, and no row is moved.
    """
    place = F.monotonically_increasing_id()
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value", place.alias("place"))
    splits = lines.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select("file", "start", "first", "before")
    splits = F.broadcast(splits) if splits.count() <= broadcast_splits else splits
    found = lines.join(splits, ["file", "start"]).select("file", (F.col("before") + F.col("place") - F.col("first") + 1).alias("line_no"), F.col("value").alias("line"))
    return found.filter("line <> ''")


def audit_scan(spark: SparkSession, path: str, **options) -> DataFrame:
    """file, line_no, entity, url, type, base_url, reason: the catalogue for an audit, each row with its line.

    Rows with an invalid URL are kept. reason says why a row is left out: fewer than two fields, or no name; the rows of
    a file whose header has fewer than two fields are all left out.
    """
    lines = numbered(spark, path, **options)
    headers = lines.filter("line_no = 1").select("file", F.contains("line", F.lit(";")).alias("__known"))
    rows = lines.filter("line_no > 1").join(headers, "file", "left").withColumn("__r", F.from_csv("line", "entity string, url string", {"sep": ";"}))
    rows = rows.select("file", "line_no", "line", "__known", _trimmed("__r.entity").alias("entity"), _trimmed("__r.url").alias("url"))
    reason = F.when(~F.coalesce("__known", F.lit(False)), "no header").when(~F.contains("line", F.lit(";")), "fewer than two fields").when(F.col("entity") == "", "no name")
    return rows.select("file", "line_no", "entity", "url", classify(F.col("url")).alias("type"), urls.origin(F.col("url")).alias("base_url"), reason.alias("reason"))


def audit(rows: DataFrame, key: str, url: str, order: str) -> DataFrame:
    """rows with `problems`: earlier row of the same key or URL, then the first of: no URL, bad syntax, no handler.

    The first row of a key is a minimum, so that it is found map-side first, however often the key occurs.
    """
    out = rows
    for c, what in ((key, "name"), (url, "URL")):
        first = rows.filter(F.col(c) != "").groupBy(F.col(c).alias("__c")).agg(F.min(order).alias("__first"), F.count("*").alias("__n")).filter("__n > 1")
        twice = F.when(F.col("__first") < F.col(order), F.concat(F.lit(f"{what} of row "), F.col("__first").cast("string")))
        out = out.join(first, F.col(c) == F.col("__c"), "left").withColumn(f"__{what}", twice).drop("__c", "__first", "__n")
    structure = F.when(F.btrim(url, F.lit(urls.BLANK)) == "", "no URL").when(~urls.is_valid(F.col(url)), "bad syntax").when(classify(F.col(url)).isin(OTHER, "leeg"), "no handler")
    return out.withColumn("problems", F.array_compact(F.array("__name", "__URL", structure))).drop("__name", "__URL")
