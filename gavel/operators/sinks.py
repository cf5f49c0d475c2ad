"""Sinks: what is new against a manifest, checks of bodies, the store of bodies, JSON documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.functions import filters, names, urls
from gavel.sources import files


@dataclass(frozen=True)
class Policy:
    """How a source stores documents: whether bodies must be PDF, their least size, what an existing file counts as.

    Each may be a column instead, where rows of several sources are stored together.
    """

    require_magic: bool = True
    least_bytes: int = 1
    existing_succeeds: bool = True
    force_extension: str | None = None


def stored(documents: DataFrame, manifest: DataFrame, policy: Policy | None = None, folder: str | None = None) -> DataFrame:
    """documents (url, hint, disposition, content_type, status, body) with file, success, skipped, error.

    manifest has the column file: what is there already, below a folder that a column names if `folder` is given.
    Failures are rows, never exceptions. The manifest is joined on the file's name, so a large one is shuffled and a
    small one broadcast by Spark's own choice.
    """
    policy = policy or Policy()
    of = lambda value: value if isinstance(value, Column) else F.lit(value)
    name = names.resolved(F.col("disposition"), F.col("hint"), F.col("url"))
    extension = names.extension_for(F.col("content_type"))
    dotted = F.substr(name, F.greatest(F.lit(1), F.length(name) - 5)).contains(".")
    named = F.when(dotted, name).otherwise(F.concat(name, extension))
    forced = of(policy.force_extension)
    named = F.when(forced.isNull(), named).when(F.lower(name).endswith(forced), name).otherwise(F.concat(name, forced))
    checked = documents.withColumn("file", names.sanitise(named)).withColumn("__page", named.isNull())
    there = manifest.select(F.col("file").alias("__path")).distinct().withColumn("__there", F.lit(True))
    at = F.concat_ws("/", F.col(folder), "file") if folder else F.col("file")
    joined = checked.join(there, at == F.col("__path"), "left").drop("__path").withColumn("skipped", F.coalesce("__there", F.lit(False)))
    size = F.octet_length(F.coalesce("body", F.lit("")))
    error = (
        F.when(~urls.is_valid(F.col("url")), "invalid URL")
        .when(F.col("status") != 200, F.concat(F.lit("HTTP "), F.col("status").cast("string")))
        .when(F.col("__page"), "page instead of document")
        .when(F.col("skipped"), F.when(~of(policy.existing_succeeds), "exists"))
        .when(size < of(policy.least_bytes), "empty")
        .when(of(policy.require_magic) & ~filters.body_ok(F.col("body")), "no PDF")
    )
    return joined.withColumn("error", error).withColumn("success", F.col("error").isNull()).drop("__there", "__page")


def save_bodies(judged: DataFrame, path: str) -> None:
    """Append the bodies of what `stored` found new and good to the store at path (Parquet: file, url, body).

    Skipped rows are not written again, failed ones never. Names that meet within one batch are all kept, each with its
    URL; `ordered.distinct_names` sets them apart. A job that fails leaves no rows.
    """
    judged.filter("success AND NOT skipped").select("file", "url", "body").write.mode("append").parquet(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The names in the store at path, as `stored` takes them; none where there is no store yet. No body is read."""
    try:
        return spark.read.schema("file string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string")


#: Policies of the older sinks: PDF by name whatever the body, least size, an existing file is no success; anything with any body.
LEGACY_PDF = Policy(require_magic=False, least_bytes=100, existing_succeeds=False, force_extension=".pdf")
LEGACY_ANY = Policy(require_magic=False)
#: Content that a payload holds itself is a page.
INLINE = Policy(require_magic=False, force_extension=".html")


def inline_documents(rows: DataFrame, name: str, content: str) -> DataFrame:
    """Rows with content of their own as documents for `stored` with the policy INLINE; those without content go."""
    missing = F.lit(None).cast("string")
    return rows.filter(F.col(content).isNotNull()).withColumns({"url": F.coalesce("url", F.lit("https://inline.invalid/")), "hint": F.col(name), "disposition": missing, "content_type": F.lit("text/html"), "status": F.lit(200), "body": F.col(content)})


def write_files(judged: DataFrame, path: str, folder: str | None = None, existing: str = "skip") -> None:
    """Write what `stored` found new and good below path, one file a document, in a folder named by a column if there is one.

    See sources.files: nothing is left of a job that fails, and one that is run again writes only what is missing. Two
    rows of one name are one file; `ordered.distinct_names` sets them apart beforehand.
    """
    files.register(judged.sparkSession)
    name = F.concat_ws("/", F.col(folder), "file") if folder else F.col("file")
    rows = judged.filter("success AND NOT skipped").select(name.alias("file"), F.col("body").cast("binary").alias("body"))
    rows.write.format("gavel-files").option("path", path).option("existing", existing).mode("append").save()


def files_below(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes for every file below path that is not empty; none where there is no such folder. No content is read.

    It is listed anew, by tasks, whenever it is asked for: see files.below.
    """
    return files.below(spark, path)


def json_documents(rows: DataFrame, keys: list[str], into: str = "document") -> DataFrame:
    """One JSON document a key of all the other columns' rows, which sort in their own order."""
    others = [c for c in rows.columns if c not in keys]
    items = F.sort_array(F.collect_list(F.struct(*others)))
    return rows.groupBy(*keys).agg(F.to_json(F.struct(F.count("*").alias("n"), items.alias("items"))).alias(into))


def write_by_entity(rows: DataFrame, path: str, keys: list[str], mode: str = "overwrite") -> None:
    """Rows as JSON lines, in a folder for each key; executors write and commit them, so a lost one leaves no halves."""
    rows.write.mode(mode).partitionBy(*keys).json(path)
