"""URL filters: a temporal join of captures with dated list entries.

An entry sets what holds for a pattern from its date on: ``block``, ``allow`` or ``remove`` (nothing
holds). It is valid until the pattern's next entry. A pattern is a host suffix of at least two labels
(``example.com``) or a host with the first part of a path (``blog.example.com/en``). A capture is
judged by the entries valid at its fetch time, and of these by the most specific.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SALTS = 8
URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)(?::[0-9]*)?(/[^?#]*)?"
#: At one date the stronger entry of a pattern holds.
STRENGTH = {"remove": 0, "allow": 1, "block": 2}


def host(url: Column) -> Column:
    """The host in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def first_folder(url: Column) -> Column:
    """The first part of the path; empty where there is none."""
    return F.regexp_extract(F.coalesce(F.regexp_extract(url, URL, 2), F.lit("")), "^/([^/]+)", 1)


def patterns(url: Column) -> Column:
    """All patterns that cover a URL, most specific first."""
    name = host(url)
    labels = F.split(name, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    folder = first_folder(url)
    path = F.when(folder != "", F.array(F.concat(name, F.lit("/"), folder))).otherwise(
        F.array().cast("array<string>")
    )
    return F.when(name != "", F.concat(path, suffixes)).otherwise(F.array().cast("array<string>"))


def validity(entries: DataFrame) -> DataFrame:
    """(pattern, action, valid_from, valid_to) of ``entries`` (pattern, action, dated).

    ``valid_to`` is the next entry's date, null for the last. Days are joined up by their first
    entries, so a pattern with a long history is handled a day at a time. Entries with a null or an
    unknown action are ignored.
    """
    rank = F.coalesce(*[F.when(F.col("action") == a, F.lit(s)) for a, s in STRENGTH.items()])
    known = (
        entries.select("pattern", "dated", rank.alias("rank"))
        .filter("pattern is not null and dated is not null and rank is not null")
        .groupBy("pattern", "dated")
        .agg(F.max("rank").alias("rank"))
        .withColumn("day", F.to_date("dated"))
    )
    days = (
        known.groupBy("pattern", "day")
        .agg(F.min("dated").alias("opens"))
        .withColumn("next_day", F.lead("opens").over(Window.partitionBy("pattern").orderBy("day")))
        .select("pattern", "day", "next_day")
    )
    following = F.lead("dated").over(Window.partitionBy("pattern", "day").orderBy("dated"))
    name = F.element_at(F.array(*[F.lit(a) for a in STRENGTH]), F.col("rank") + 1)
    return known.join(days, ["pattern", "day"]).select(
        "pattern",
        name.alias("action"),
        F.col("dated").alias("valid_from"),
        F.coalesce(following, "next_day").alias("valid_to"),
    )


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, fetched, decision, pattern, since), one row per row of ``captures``.

    ``captures``: (page_id, url, fetched). ``decision`` is ``block`` or ``allow`` by the most
    specific entry valid when the page was fetched, else ``none``, as it is for a null or
    unreadable URL or a null fetch time. An entry is valid from its date on and up to, not
    including, the next one's. Rows of equal page_id are judged each; other columns are ignored;
    empty tables give ``none`` or no rows.

    Intervals and captures meet by pattern and day. Captures are salted and the intervals copied,
    so a host with a large part of all pages is spread out.
    """
    rows = captures.select(
        F.monotonically_increasing_id().alias("row_id"), "page_id", "fetched", patterns(F.col("url")).alias("covers")
    )
    keyed = rows.select(
        "row_id", "page_id", "fetched", F.posexplode_outer("covers").alias("depth", "pattern")
    ).withColumns({"day": F.to_date("fetched"), "salt": F.pmod(F.xxhash64("page_id", "fetched"), F.lit(SALTS))})
    low, high = captures.agg(F.to_date(F.min("fetched")), F.to_date(F.max("fetched"))).first()
    active = (
        validity(entries)
        .filter("action <> 'remove'")
        .withColumn("low", F.greatest(F.lit(low).cast("date"), F.to_date("valid_from")))
        .withColumn("high", F.least(F.lit(high).cast("date"), F.to_date("valid_to")))
        .filter("low <= high")
        .withColumn("day", F.explode(F.sequence("low", "high")))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        .select("pattern", "day", "salt", "action", "valid_from", "valid_to")
    )
    found = F.struct("depth", F.col("action").alias("decision"), "pattern", F.col("valid_from").alias("since"))
    judged = (
        keyed.join(active, ["pattern", "day", "salt"], "left")
        .withColumn("valid", F.expr("valid_from <= fetched and (valid_to is null or fetched < valid_to)"))
        .groupBy("row_id", "page_id", "fetched")
        .agg(F.min(F.when(F.col("valid"), found)).alias("best"))
    )
    return judged.select(
        "page_id",
        "fetched",
        F.coalesce("best.decision", F.lit("none")).alias("decision"),
        F.col("best.pattern").alias("pattern"),
        F.col("best.since").alias("since"),
    )
