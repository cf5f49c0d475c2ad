"""Secret scan: fixed patterns, and two character Markov models compared by log-likelihood ratio.

Both models are first-order over a small alphabet: one of random strings, one of ordinary identifiers and words,
counted from labelled samples. A long token whose ratio clears the threshold is a secret that no pattern names; tokens
are judged whole, and where the whole is ordinary, by their parts between / and =. All of it is column expressions: tables and patterns are literals, nothing shuffles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.llm.storage import smallest

# fixed values: the patterns of the three kinds, in the order in which kinds are listed
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
}
#: Least length of the value of an assignment; the other two patterns hold theirs (a run is matched whole or not at all).
ASSIGNED = 8
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_CLASS = "A-Za-z0-9+/_=-"
#: A token that the models judge: 16 characters or more, a digit and a letter among them; a part of one, a letter in it.
CANDIDATE = rf"(?<![{_CLASS}])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[{_CLASS}]{{16,}}"
PART = r"(?<![A-Za-z0-9+_-])(?=[0-9+_-]*+[A-Za-z])[A-Za-z0-9+_-]{16,}"
#: Nats by which the random model must explain a token better, in all and for each character.
MARGIN, MARGIN_A_CHARACTER = 10.0, 0.35
#: The same for parts without a digit, which long words resemble more.
LETTERS_MARGIN, LETTERS_MARGIN_A_CHARACTER = 30.0, 1.0
#: Bounds of the training sample: random strings, identifiers, documents whose words count as ordinary.
SAMPLE_STRINGS, SAMPLE_DOCUMENTS = 6000, 1000

# fixed values: parts of ordinary identifiers
PARTS = (
    "account address admin alpha archive article backup batch binary block branch buffer build bundle button cache "
    "calendar channel chapter client cluster column command comment commit config connection content context control "
    "counter country create customer database default delete deploy detail device digest document download driver edit "
    "email engine entity entry error event export factory feature field file filter folder format function gateway "
    "group handler header helper history host image import index input instance invoice item journal kernel label "
    "language layer level library license list loader local logger manager market master member memory message method "
    "metric migration mobile model module monitor network node notice number object office option order output owner "
    "package page parser partner password path payment person plan platform player plugin policy pool port price "
    "process product profile project protocol provider query queue record region register release report request "
    "resource response result review route sample schedule schema screen script search section secret server service "
    "session setting shadow source stack stage status storage stream string student style summary support switch system "
    "table target task template test theme thread ticket title token tool topic track transfer tree trigger update "
    "upload user value vendor version video view volume widget window worker"
).split()


def samples(spark: SparkSession, documents: DataFrame, strings: int = SAMPLE_STRINGS, docs: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """token, random: labelled samples of bounded number, the same at every run.

    Random strings are digests in hexadecimal, in base 64 and in capitals; identifiers are parts joined in the usual
    ways, with years, counters and versions; ordinary words come from the `docs` documents of the smallest id hash,
    tokens with digits left out.
    """
    part = lambda n: F.element_at(F.lit(PARTS), (F.pmod(F.xxhash64("id", F.lit(n)), F.lit(len(PARTS))) + 1).cast("int"))
    ids, pick = spark.range(strings), lambda n: F.pmod(F.xxhash64("id", F.lit(f"pick{n}")), F.lit(n))
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 512)
    packed = F.regexp_replace(F.base64(F.unhex(digest)), "\\s", "")
    drawn = F.when(pick(3) == 0, digest).when(pick(3) == 1, packed).otherwise(F.upper(F.translate(packed, "+/=", "x7Q")))
    randoms = ids.select(F.substr(drawn, F.lit(1), (F.lit(16) + pick(29)).cast("int")).alias("token"), F.lit(True).alias("random"))
    number = F.when(pick(4) == 0, (F.lit(1990) + pick(40)).cast("string")).when(pick(4) == 1, F.lpad(pick(1000).cast("string"), 4, "0")).when(pick(4) == 2, F.concat(F.lit("v"), pick(9).cast("string"))).otherwise(pick(100).cast("string"))
    join = lambda sep: F.concat_ws(sep, part(1), part(2), part(3), number)
    date = F.concat_ws("-", (F.lit(1990) + pick(40)).cast("string"), F.lpad((pick(12) + 1).cast("string"), 2, "0"), F.lpad((pick(28) + 1).cast("string"), 2, "0"), part(1), part(2))
    camel = F.concat(part(1), F.initcap(part(2)), F.initcap(part(3)), number)
    named = F.when(pick(7) == 0, join("_")).when(pick(7) == 1, join("-")).when(pick(7) == 2, join("/")).when(pick(7) == 3, camel).when(pick(7) == 4, F.upper(join("_"))).when(pick(7) == 5, date).otherwise(join(""))
    identifiers = ids.select(named.alias("token"), F.lit(False).alias("random"))
    chosen = smallest(documents.filter("text is not null").select("doc_id", "text"), F.xxhash64("doc_id"), docs)
    word = F.explode(F.regexp_extract_all("text", F.lit(f"[{_CLASS}]{{3,}}"), F.lit(0)))
    ordinary = chosen.select(word.alias("token"), F.lit(False).alias("random")).filter(~F.col("token").rlike("[0-9]"))
    return randoms.unionAll(identifiers).unionAll(ordinary)


def train(labelled: DataFrame, smooth: float = 0.5) -> list[float]:
    """Table of log P(b | a, random) - log P(b | a, ordinary), at a * n + b for 1-based places a, b in the alphabet.

    Place 0 is the start, or any character outside the alphabet; n is the alphabet's length + 1. labelled: token,
    random; null tokens are ignored. Without samples of either label all entries are 0.
    """
    n = len(ALPHABET) + 1
    place = lambda at: F.instr(F.lit(ALPHABET), F.substr("token", at, F.lit(1)))
    step = F.transform(F.sequence(F.lit(1), F.length("token")), lambda i: F.when(i > 1, place(i - 1)).otherwise(0) * n + place(i))
    counted = labelled.filter("length(token) > 0").select("random", F.explode(step).alias("step")).groupBy("random", "step").count().collect()  # n * n * 2 rows at most
    if {r["random"] for r in counted} != {True, False}:
        return [0.0] * (n * n)
    logs = {}
    for label in (True, False):
        table = [smooth] * (n * n)
        for r in counted:
            if r["random"] == label:
                table[r["step"]] += r["count"]
        logs[label] = [math.log(x / sum(table[a * n : a * n + n])) for a in range(n) for x in table[a * n : a * n + n]]
    return [round(a - b, 6) for a, b in zip(logs[True], logs[False], strict=True)]


def ratio(token: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of token, summed over its characters."""
    n, values = len(ALPHABET) + 1, F.lit(table)
    place = lambda at: F.instr(F.lit(ALPHABET), F.substr(token, at, F.lit(1)))
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))

    def move(acc, i):
        here = place(i)
        return F.struct(here.alias("last"), (acc["sum"] + F.get(values, acc["last"] * n + here)).alias("sum"))

    return F.aggregate(F.sequence(F.lit(1), F.length(token)), start, move, lambda acc: acc["sum"])


def _with(value: Column, use) -> Column:
    """use(value), with value computed once however often the expression names it."""
    return F.transform(F.array(value), use)[0]


_SPANS = "array<struct<start:int,end:int,match:string,part:string>>"


def find(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, match, part) of the matches of pattern in text, in code points; part is the group.

    The pieces between matches and the matches alternate, so positions are sums of their lengths; sums are kept for
    each block of about sqrt(n) matches so that a text with very many stays cheap.
    """
    where = F.lit(pattern)

    def placed(found):
        n = F.size(found["match"])
        both = F.zip_with(F.slice(found["piece"], F.lit(1), n), found["match"], lambda p, m: F.length(p) + F.length(m))

        def offsets(sums):
            block = F.ceil(F.sqrt(n)).cast("int")
            add = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)

            def spread(bases):
                end = lambda i: F.get(bases, F.floor(i / block).cast("int")) + add(F.slice(sums, (F.floor(i / block) * block + 1).cast("int"), (i % block + 1).cast("int")))
                one = lambda i: _with(end(i), lambda e: F.struct((e - F.length(F.get(found["match"], i))).alias("start"), e.alias("end"), F.get(found["match"], i).alias("match"), F.get(found["part"], i).alias("part")))
                return F.transform(F.sequence(F.lit(0), n - 1), one)

            return _with(F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")), lambda k: add(F.slice(sums, F.lit(1), (k * block).cast("int")))), spread)

        return _with(both, offsets)

    parts = F.struct(F.split(text, pattern, -1).alias("piece"), F.regexp_extract_all(text, where, F.lit(0)).alias("match"), F.regexp_extract_all(text, where, F.lit(group)).alias("part"))
    return F.when(text.rlike(pattern), _with(parts, placed)).otherwise(F.array().cast(_SPANS))


def masked(text: Column, pattern: str) -> Column:
    """text with each match of pattern replaced by as many spaces."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(pieces, F.concat(found, F.array(F.lit(""))), lambda p, m: F.concat(p, F.repeat(F.lit(" "), F.length(m))))
    return F.when(text.rlike(pattern), F.array_join(both, "")).otherwise(text)


def scan(docs: DataFrame, table: list[float], text: str = "text", margin: float = MARGIN, each: float = MARGIN_A_CHARACTER, letters: float = LETTERS_MARGIN, each_letter: float = LETTERS_MARGIN_A_CHARACTER) -> DataFrame:
    """All columns of docs and `secrets`: array of (start, rank, kind, end), sorted by start, then kind as listed.

    Kinds: assign, access, hex (leftmost, not overlapping within a kind), markov (added by the models, apart from the
    others; a part within a token that is listed is not listed again). Positions are code points, ends exclusive. Texts of
    any length count whole, repeated rows each for itself. Null texts count as empty. Columns named secrets are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.withColumn("__assign", F.filter(find(body, PATTERNS["assign"], 2), lambda s: F.length(s["part"]) >= ASSIGNED))
    own = own.withColumn("__access", find(body, PATTERNS["access"])).withColumn("__hex", find(body, PATTERNS["hex"]))
    hides = lambda s: F.when(s.rlike(f"[{_CLASS}]{{16}}"), masked(masked(masked(s, PATTERNS["assign"]), PATTERNS["access"]), PATTERNS["hex"])).otherwise("")
    own = own.withColumn("__rest", hides(body))
    clears = lambda s, r, m, e: (r >= m) & (r >= e * F.length(s["match"]))
    random = lambda s: _with(ratio(s["match"], table), lambda r: F.when(s["match"].rlike("[0-9]"), clears(s, r, margin, each)).otherwise(clears(s, r, letters, each_letter)))
    own = own.withColumn("__whole", F.filter(find(F.col("__rest"), CANDIDATE), random))
    apart = lambda s: ~F.exists("__whole", lambda w: (w["start"] <= s["start"]) & (s["end"] <= w["end"]))
    parts = F.filter(F.filter(find(F.col("__rest"), PART), apart), random)
    own = own.withColumn("__markov", F.concat("__whole", parts))
    kinds = ["assign", "access", "hex", "markov"]
    named = lambda i: lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("rank"), F.lit(kinds[i]).alias("kind"), s["end"].alias("end"))
    tagged = [F.transform(f"__{k}", named(i)) for i, k in enumerate(kinds)]
    return own.withColumn("secrets", F.array_sort(F.concat(*tagged))).drop(*(f"__{k}" for k in kinds), "__rest", "__whole")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, by: str = "[SECRET]") -> Column:
    """text with each span of `scan` cut out; of overlapping spans the part not yet cut goes too."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("kept"))
    cut = lambda acc, s: F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["end"] <= acc["at"], acc["kept"]).otherwise(F.concat(acc["kept"], F.substr(text, acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"])), F.when(s["start"] >= acc["at"], by).otherwise(""))).alias("kept"))
    return F.aggregate(spans, start, cut, lambda acc: F.concat(acc["kept"], F.substr(text, acc["at"] + 1, F.length(text))))
