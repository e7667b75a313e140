"""Dated list entries joined to captures: what was listed when a page was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorloom.llm.common import side
from sensorloom.session import write_scratch


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user, port and final dot; null if there is none."""
    raw = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    host = F.regexp_replace(raw, r"\.+$", "")
    return F.when(host != "", host)


def domains_of(host: Column, fewest: int = 2) -> Column:
    """The host and its parent domains of at least ``fewest`` labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    starts = F.sequence(F.lit(1), F.greatest(n - fewest + 1, F.lit(1)))
    return F.when(host.isNotNull(), F.transform(starts, lambda i: F.array_join(F.slice(labels, i, n), ".")))


def validity(entries: DataFrame, key: str = "domain", listing: str = "listing", at: str = "at", listed: str = "listed") -> DataFrame:
    """Intervals ``domain``, ``listing``, ``valid_from``, ``valid_to`` (exclusive, null if open).

    An entry states that from ``at`` on the domain is (or is no longer) on the listing. It holds
    until the next entry of the same domain and listing; of several at one time, a listing wins.
    Entries with a null domain or time say nothing. Repeated entries change nothing.
    """
    rows = entries.select(F.lower(F.col(key)).alias("domain"), F.col(listing).alias("listing"), F.col(at).alias("at"), F.col(listed).alias("listed"))
    rows = rows.where("domain IS NOT NULL AND at IS NOT NULL").groupBy("domain", "listing", "at").agg(F.max(F.coalesce("listed", F.lit(False))).alias("listed"))
    # A change is an entry that differs from the one before: the rest repeats what holds.
    w = Window.partitionBy("domain", "listing").orderBy("at")
    changes = rows.withColumn("was", F.lag("listed").over(w)).where("was IS NULL OR was <> listed")
    spans = changes.withColumn("valid_to", F.lead("at").over(w)).where("listed")
    return spans.select("domain", "listing", F.col("at").alias("valid_from"), "valid_to")


def listed_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with ``host``, ``n_active`` (listings active at the fetch), and of the entry with the
    longest domain ``matched_domain``, ``matched_listing`` and ``listed_since``.

    A capture meets the intervals of its host and parent domains, and those remain in which its
    fetch lies. Intervals of one domain and listing do not overlap, so that a capture has at most
    one for each. They are sent to the tasks if few; else the join shuffles by domain, and adaptive
    execution splits a domain that holds a large part of all captures. Captures without host or
    time match nothing; each row of the input gives one row.
    """
    spans = side(write_scratch(validity(entries), "intervals"), 200_000)
    names = captures.columns
    rows = captures.toDF(*[f"k{i}" for i in range(len(names))])
    rows = rows.withColumns({"__host": host_of(F.col(f"k{names.index(url)}")), "__row": F.monotonically_increasing_id()})
    rows = write_scratch(rows, "captures")
    when = f"k{names.index(fetched)}"
    keyed = rows.select("__row", F.col(when).alias("__when"), F.explode(domains_of(F.col("__host"))).alias("domain"))
    active = (F.col("valid_from") <= F.col("__when")) & (F.col("valid_to").isNull() | (F.col("__when") < F.col("valid_to")))
    met = keyed.join(spans, "domain").where(active)
    best = met.groupBy("__row").agg(
        F.count("*").alias("n_active"),
        F.max_by(F.struct("domain", "listing", "valid_from"), F.struct(F.length("domain"), "domain", "valid_from", "listing")).alias("best"),
    )
    done = rows.join(best, "__row", "left")
    return done.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(names)], F.col("__host").alias("host"), F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.col("best.domain").alias("matched_domain"), F.col("best.listing").alias("matched_listing"), F.col("best.valid_from").alias("listed_since"),
    )
