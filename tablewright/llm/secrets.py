"""Secrets in texts, and credentials in several parts linked by where they stand.

DataFrame operations only. Strong findings are reported as they are. Weak candidates (an account name, a short or
bare secret, an endpoint) are reported only where complementary parts stand within the same scope: an interval join
over (text, stretch of ``scope`` characters), against the outermost positions of each role in a stretch. These say
whether any part of the role is near enough, so no pairs are made, however many parts a text has.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import written

#: Kinds and patterns of findings that are reported wherever they stand.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LENGTH = 12
#: Patterns of candidates that count only near complementary parts.
ACCOUNT = r"""(access_?key_?id|client_?id|user_?name|account_?id|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]+)"""
ENDPOINT = r"""(https?|postgres|mysql|redis|amqp|mongodb|s3)://[A-Za-z0-9_.-]+"""
BARE = r"[A-Za-z0-9+/=_-]{40,}"
SHORT_LENGTH = 6
BARE_LENGTH = 88
#: Characters around a candidate in which its complement has to stand.
SCOPE = 240
#: Characters of the blocks into which a text is cut before what stands between findings is put together.
CUT = 1024

#: Kinds in the order in which those that start alike are listed, with the role each plays in a credential.
ROLES = {"assign": "secret", "access": "account", "hex": "secret", "account": "account", "key": "secret", "endpoint": "endpoint"}
STRONG = ("assign", "access", "hex")


def _any_case(pattern: str) -> str:
    return f"(?i){pattern}"


#: What is looked for: name of the scan and pattern. A scan's findings become kinds in ``_classified``.
SCANS = {
    "assign": _any_case(ASSIGN),
    "access": ACCESS,
    "hex": HEX,
    "account": _any_case(ACCOUNT),
    "endpoint": _any_case(ENDPOINT),
    "bare": BARE,
}


#: Plain strings of which one stands (in lower case) in every text with a match; a byte search is far cheaper than
#: a pattern. The two scans without any share the pattern LONG.
HINTS = {
    "assign": ("passw", "secret", "token", "api"),
    "account": ("key_id", "keyid", "client", "user", "account", "login"),
    "endpoint": ("://",),
    "access": ("akia",),
}
LONG = r"[0-9a-f]{16}|[A-Za-z0-9+/=_-]{40}"
PART = "array<struct<scan:string,gap:int,length:int,match:string>>"


def _matches(scan: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches, each with the length of what stands between it and the one before."""
    parts = F.zip_with(
        F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)),
        F.split("_text", pattern, -1),
        lambda match, gap: F.struct(
            F.lit(scan).alias("scan"), F.length(gap).alias("gap"), F.length(match).alias("length"), match.alias("match")
        ),
    )
    hints = HINTS.get(scan)
    hinted = F.col("_long") if hints is None else reduce(or_, (F.contains("_lower", F.lit(hint)) for hint in hints))
    return F.when(hinted, parts).otherwise(F.array().cast(PART))


def _classified(parts: DataFrame) -> DataFrame:
    """Findings with their kinds; matches that are too short or too long are dropped."""
    match, scan = F.col("match"), F.col("scan")
    value = F.length(F.regexp_extract(match, SCANS["assign"], 2))
    mixed = match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]") & (F.length(match) <= BARE_LENGTH)
    kind = (
        F.when(scan == "assign", F.when(value >= ASSIGN_LENGTH, "assign").when(value >= SHORT_LENGTH, "key"))
        .when(scan == "bare", F.when(mixed, "key"))
        .otherwise(scan)
    )
    return parts.withColumn("kind", kind).where(F.col("kind").isNotNull())


def _role(kind: Column) -> Column:
    out = F
    for name, role in ROLES.items():
        out = out.when(kind == name, role)
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: id and ``findings``, an array of (start, order, end, kind), sorted.

    Positions count code points; ends are exclusive. A NULL or empty text has no findings; rows with the same id
    are documents of their own; further columns are not read; no rows give no rows. Equal findings of one kind are
    listed once.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = (
        docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), text.alias("_text"))
        .withColumns({"_lower": F.lower("_text"), "_long": F.col("_text").rlike(LONG)})
        .select("_id", "_row", F.concat(*(_matches(*scan) for scan in SCANS.items())).alias("_parts"))
        .select("_id", "_row", F.posexplode_outer("_parts").alias("_pos", "_part"))
    )
    placed = written(found.select("_id", "_row", "_pos", "_part.*"), "secret-parts")
    # What follows a text's last match is no part.
    parts = placed.where(F.col("match").isNotNull())
    # Starts are running sums over a text's matches of one scan, which are as many as the text is long at most.
    ends = F.expr("sum(gap + length) over (partition by _row, scan order by _pos)")
    spans = _classified(parts.withColumn("end", ends)).select(
        "_row", "kind", _role(F.col("kind")).alias("role"), (F.col("end") - F.col("length")).alias("start"), "end"
    )
    spans = written(spans.distinct(), "secret-spans")
    order = F.array_position(F.array(*map(F.lit, ROLES)), F.col("kind"))
    reported = spans.where(F.col("kind").isin(*STRONG)).select("_row", "kind", "start", "end")
    reported = reported.unionByName(_confirmed(spans, scope)).groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("start", order.alias("order"), "end", "kind"))).alias("findings")
    )
    keys = placed.where("_pos is null or _pos = 0").select("_id", "_row")
    none = F.array().cast(reported.schema["findings"].dataType)
    return keys.join(reported, "_row", "left").select(
        F.col("_id").alias(id_col), F.coalesce("findings", none).alias("findings")
    )


def redact_secrets(docs: DataFrame, text_col: str = "text", placeholder: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs``, with all their columns, with every finding in a text replaced.

    Findings that overlap are replaced together. A text without findings stays as it is, NULL included. The work
    per text grows with its length and with the number of its findings, and not with their product.
    """
    text = F.col(text_col)
    digest = F.sha2(text.cast("binary"), 256)
    found = find_secrets(docs.select(digest.alias("_digest"), text), "_digest", text_col).where(F.size("findings") > 0)
    # What is found depends on the text alone: copies share it.
    found = written(found.groupBy("_digest").agg(F.any_value("findings").alias("findings")), "findings")
    joined = docs.withColumn("_digest", digest).join(_kept_stretches(found), "_digest", "left")
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    # The outer transform binds the blocks, so that they are made once and not for every stretch.
    redacted = F.transform(
        F.array(blocks),
        lambda blocks: F.array_join(F.transform("_stretches", lambda stretch: _cut(blocks, stretch, F.length(text))), placeholder),
    )[0]
    return joined.withColumn(text_col, F.when(F.col("_stretches").isNull(), text).otherwise(redacted)).drop(
        "_digest", "_stretches"
    )


def _kept_stretches(found: DataFrame) -> DataFrame:
    """``_digest`` and ``_stretches``: from where to where no finding stands (to the end: NULL), in order."""
    before = Window.partitionBy("_digest").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.select("_digest", F.inline("findings")).withColumn("at", F.coalesce(F.max("end").over(before), F.lit(0)))
    inner = F.when(F.col("start") >= F.col("at"), F.struct("at", F.col("start").alias("until")))
    last = F.struct(F.max("end").alias("at"), F.lit(None).cast("long").alias("until"))
    return placed.groupBy("_digest").agg(F.concat(F.sort_array(F.collect_list(inner)), F.array(last)).alias("_stretches"))


def _cut(blocks: Column, stretch: Column, length: Column) -> Column:
    """The text of a stretch, of which only the blocks that it touches are read."""
    until = F.coalesce(stretch["until"], length.cast("long"))
    first, beyond = F.floor(stretch["at"] / CUT).cast("int"), F.ceil(until / CUT).cast("int")
    touched = F.array_join(F.slice(blocks, first + 1, F.greatest(beyond - first, F.lit(0))), "")
    return F.substring(touched, (stretch["at"] - first * CUT + 1).cast("int"), (until - stretch["at"]).cast("int"))


def _confirmed(spans: DataFrame, scope: int) -> DataFrame:
    """Weak candidates whose complement stands within ``scope`` characters.

    A secret needs an account, an account a secret, an endpoint both. A part near a position p is in the stretch of
    p or beside it: all of p's own stretch is near enough, before it the last end and after it the first start decide.
    """
    stretch = F.floor(F.col("start") / scope)
    outermost = (
        spans.withColumn("stretch", stretch)
        .groupBy("_row", "stretch", "role")
        .agg(F.max("start").alias("last"), F.min("start").alias("first"))
    )
    beside = outermost.withColumn("stretch", F.explode(F.array(*(F.col("stretch") + d for d in (-1, 0, 1)))))
    weak = spans.where(~F.col("kind").isin(*STRONG)).withColumn("stretch", stretch).withColumnRenamed("role", "own")
    needed = (
        F.when(F.col("own") == "secret", F.col("role") == "account")
        .when(F.col("own") == "account", F.col("role") == "secret")
        .otherwise(F.col("role") != "endpoint")
    )
    near = (F.col("last") >= F.col("start") - scope) & (F.col("first") <= F.col("start") + scope)
    roles = F.when(F.col("own") == "endpoint", 2).otherwise(1)
    return (
        weak.join(beside, ["_row", "stretch"])
        .where(needed & near)
        .groupBy("_row", "kind", "own", "start", "end")
        .agg(F.count_distinct("role").alias("complements"))
        .where(F.col("complements") >= roles)
        .select("_row", "kind", "start", "end")
    )
