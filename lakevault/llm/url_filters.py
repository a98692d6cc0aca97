"""Address lists over time: which list entries were active when each capture was fetched.

Dated entries (a domain or an address, added or removed on a day) become validity intervals: an
entry holds from its day until the day of the next entry for the same value. Captures then meet
the intervals in an as-of join: equal value, and the fetch day inside the interval; of one value
at most one interval is active on a day.

A domain covers its subdomains, so a host asks for each of its parent domains. Captures are first
reduced to distinct pairs of host and day, so a host with a third of all captures asks once for
each day. The join back to the captures is one that adaptive execution may split.

Defined results: an address without a host, and hosts over 253 characters (which no name may have),
match no domain; a null day or null value matches nothing; of entries for one value and day a removal
wins; repeated captures are answered each for itself; without entries nothing is blocked; columns of
any name are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.llm.storage import free_name

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"


def host_of(url: Column) -> Column:
    """Host in lower case without trailing dots; null if there is none."""
    host = F.regexp_replace(F.regexp_extract(F.lower(url), HOST, 1), r"\.+$", "")
    return F.when((F.char_length(host) > 0) & (F.char_length(host) <= 253), host)


def address_of(url: Column) -> Column:
    """The address without its fragment."""
    return F.regexp_replace(url, "#.*$", "")


def parents(host: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, value, from_day, to_day) of additions; ``entries`` have kind ('domain' or 'url'),
    value, action ('add' or 'remove') and day. to_day is excluded, null if the entry still holds."""
    value = F.when(F.col("kind") == "domain", F.lower("value")).otherwise(address_of(F.col("value")))
    days = entries.select("kind", value.alias("value"), "action", F.col("day").cast("date").alias("day")
                          ).filter("value is not null and day is not null").groupBy(
        "kind", "value", "day").agg(F.max("action").alias("action"))
    after = F.lead("day").over(Window.partitionBy("kind", "value").orderBy("day"))
    return days.withColumn("to_day", after).filter("action = 'add'").select(
        "kind", "value", F.col("day").alias("from_day"), "to_day")


def _active(asked: DataFrame, valid: DataFrame) -> DataFrame:
    """As-of join of (value, day, ...) with the intervals of one kind."""
    a, v = asked.alias("a"), valid.alias("v")
    on = (F.col("a.value") == F.col("v.value")) & (F.col("a.day") >= F.col("v.from_day")) & (
        F.col("v.to_day").isNull() | (F.col("a.day") < F.col("v.to_day")))
    return a.join(v, on).select("a.*", "v.from_day")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """The captures with a column ``verdict``: host, ``blocked``, the number of active entries that
    match, the longest matching domain (null if none), and the first day of its entry."""
    valid = intervals(entries)
    row, host, key = (free_name(captures.columns, n) for n in ("row", "host", "day"))
    rows = captures.select(
        F.struct(*(F.col(f"`{c}`") for c in captures.columns)).alias(row),
        host_of(F.col(f"`{url}`")).alias(host), F.col(f"`{day}`").cast("date").alias(key),
        address_of(F.col(f"`{url}`")).alias("address"))
    hosts = rows.select(F.col(host).alias("h"), F.col(key).alias("day")).filter(
        "h is not null and day is not null").distinct()
    asked = hosts.select("h", "day", F.explode(parents(F.col("h"))).alias("value"))
    domains = _active(asked, valid.filter("kind = 'domain'")).groupBy("h", "day").agg(
        F.count("*").alias("n"), F.max(F.struct(
            F.char_length("value").alias("length"), "value", "from_day")).alias("best"))
    urls = rows.select(F.col("address").alias("value"), F.col(key).alias("day")).filter(
        "value is not null and day is not null").distinct()
    exact = _active(urls, valid.filter("kind = 'url'")).select(
        F.col("value").alias("u"), F.col("day").alias("u_day"))
    out = rows.join(domains, (F.col(host) == F.col("h")) & (rows[key] == domains["day"]), "left").join(
        exact, (F.col("address") == F.col("u")) & (rows[key] == F.col("u_day")), "left")
    active = F.coalesce("n", F.lit(0)) + F.when(F.col("u").isNotNull(), 1).otherwise(0)
    verdict = F.struct(
        F.col(host).alias("host"), (active > 0).alias("blocked"), active.cast("long").alias("n_active"),
        F.col("best.value").alias("domain"), F.col("best.from_day").alias("since"))
    return out.select(f"{row}.*", verdict.alias("verdict"))
