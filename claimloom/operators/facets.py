"""Faceted queries: filters, counts that skip their own facet, and the figures beside them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chosen(filters: dict[str, list], skip: str | None = None) -> Column:
    """Rows that match all facets' choices but those of skip; a facet without choices takes all."""
    tests = [F.col(k).isin(v) for k, v in filters.items() if v and k != skip]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def facet_counts(rows: DataFrame, facets: list[str], filters: dict[str, list]) -> DataFrame:
    """(facet, value, n): counts of each facet under the choices of all others, in one pass over the rows."""
    entries = F.array(*(F.when(chosen(filters, f), F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value"))) for f in facets))
    each = rows.select(F.explode(F.array_compact(entries)).alias("e")).where("e.value is not null")
    return each.groupBy("e.facet", "e.value").agg(F.count(F.lit(1)).alias("n"))


def coverage(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(field, known, share): how many rows have a value."""
    flags = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).isNotNull().cast("long").alias("known")) for c in columns))
    return rows.select(F.inline(flags)).groupBy("field").agg(F.sum("known").alias("known"), F.round(F.avg("known"), 4).alias("share"))


def top_values(rows: DataFrame, column: str, k: int = 14) -> DataFrame:
    """(value, n) of the k most frequent values, ties by value."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(k)


def search_text(*columns: str | Column, aliases: str | None = None) -> Column:
    """Lower-cased text to search in: all columns and aliases that are there and not empty."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    extra = [F.array_join(aliases, " ")] if aliases else []
    return F.lower(F.concat_ws(" ", *(F.when(p != "", p) for p in [*parts, *extra])))


def matches(any_of: dict[str, list], one_of: dict[str, list], text: str = "", search: Column | None = None, least: float | None = None, review: bool = False, inside: bool = False, skip: str | None = None) -> Column:
    """The conjunctive filter of the query surface. any_of: choices for list columns; one_of: choices for plain ones, where null counts as 'unknown'; empty choices, and those of the facet skip, take all."""
    tests = [F.coalesce(F.arrays_overlap(F.col(k), F.array(*map(F.lit, v))), F.lit(False)) for k, v in any_of.items() if v and k != skip]
    tests += [F.coalesce(F.col(k), F.lit("unknown")).isin(v) for k, v in one_of.items() if v and k != skip]
    tests += [search.contains(text.lower())] if text and search is not None and skip != "text" else []
    tests += [F.col("confidence") >= least] if least is not None else []
    tests += [F.coalesce("needs_review", F.lit(False))] if review else []
    tests += [F.coalesce("in_council", F.lit(True))] if inside else []
    return F.coalesce(reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(False))


def counts_without_self(rows: DataFrame, any_of: dict[str, list], one_of: dict[str, list], **others) -> DataFrame:
    """(facet, value, n): counts of each facet's values under the choices of all others, for list facets (a row counts once for each of its values) and plain ones ('unknown' for null), in one pass."""
    entry = lambda f, v: F.struct(F.lit(f).alias("facet"), v.cast("string").alias("value"))
    of = lambda f: matches(any_of, one_of, skip=f, **others)
    lists = [F.when(of(f), F.transform(F.array_distinct(f), lambda v: entry(f, v))) for f in any_of]  # noqa: B023
    plain = [F.when(of(f), F.array(entry(f, F.coalesce(F.col(f).cast("string"), F.lit("unknown"))))) for f in one_of]
    none = F.array().cast("array<struct<facet:string,value:string>>")
    each = rows.select(F.explode(F.flatten(F.array(*(F.coalesce(x, none) for x in lists + plain)))).alias("e"))
    return each.groupBy("e.facet", "e.value").agg(F.count(F.lit(1)).alias("n"))


def facet_order(counts: DataFrame, collation: str = "he") -> DataFrame:
    """Facet values as they are listed: the most frequent first, then by the language's collation."""
    return counts.orderBy("facet", F.desc("n"), F.collate("value", collation))


def table_order(rows: DataFrame, column: str, descending: bool = False, collation: str = "he") -> DataFrame:
    """Rows by any column: numbers by value, texts by the language's collation, in either direction."""
    by = F.col(column) if dict(rows.dtypes)[column] != "string" else F.collate(column, collation)
    return rows.orderBy(by.desc() if descending else by.asc())


def localities(rows: DataFrame, place: Column, derived: Column, k: int = 14) -> tuple[DataFrame, DataFrame]:
    """((value, n) of the k most frequent places, ties by value), and one row with how many places there are and how many rows' place is derived."""
    named = rows.select(place.alias("value"), derived.alias("derived"))
    return top_values(named, "value", k), named.agg(F.count_distinct("value").alias("places"), F.count_if("derived").alias("derived"))


def year_label(year: Column, before: str = 'לפנה"ס', after: str = "לספירה") -> Column:
    """A year in words: thousands grouped, and whether it is before the common era; null for none."""
    return F.when(year < 0, F.concat(F.format_number(-year, 0), F.lit(f" {before}"))).when(year.isNotNull(), F.concat(F.format_number(year, 0), F.lit(f" {after}")))


def filters_to_hash(text: str = "", least: float = 0.0, review: bool = False, outside: bool = False, view: str = "map", selected: str | None = None, **choices: list[str]) -> str:
    """A URL hash of the filter's state: only what differs from the start; localities have no place in it. choices: cats, periods, types, and status axes by name."""
    from urllib.parse import urlencode

    short = {"cats": "c", "periods": "p", "types": "t"}
    pairs = [("v", view)] * (view != "map") + [("q", text)] * bool(text)
    pairs += [(short[k], ",".join(v)) for k, v in choices.items() if k in short and v]
    pairs += [("mc", str(round(least * 100)))] * bool(least) + [("rv", "1")] * review + [("out", "1")] * outside
    pairs += [(f"s.{k}", ",".join(v)) for k, v in choices.items() if k not in short and k != "localities" and v]
    pairs += [("id", selected)] * bool(selected)
    return "#" + urlencode(pairs) if pairs else ""


def status_distribution(sites: DataFrame, axes: dict[str, list[str]], category: str = "category") -> DataFrame:
    """(axis, value, n): values of status columns over the rows whose category the axis applies to; a missing value is 'unknown'."""
    entries = F.array(*(F.when(F.col(category).isin(on), F.struct(F.lit(k).alias("axis"), F.coalesce(F.col(k), F.lit("unknown")).alias("value"))) for k, on in axes.items()))
    return sites.select(F.explode(F.array_compact(entries)).alias("e")).groupBy("e.axis", "e.value").agg(F.count(F.lit(1)).alias("n"))


def list_histogram(rows: DataFrame, column: str) -> DataFrame:
    """(value, n): rows that hold each value of a list column, however often a row repeats it."""
    return rows.select(F.explode(F.array_distinct(column)).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def tiles(sites: DataFrame) -> DataFrame:
    """One row: n, mappable, gap (without a position), need_review, mean_confidence."""
    return sites.agg(
        F.count(F.lit(1)).alias("n"), F.count("lat").alias("mappable"), F.count_if(F.col("lat").isNull()).alias("gap"),
        F.count_if("needs_review").alias("need_review"), F.round(F.avg("confidence"), 3).alias("mean_confidence"),
    )


def hash_to_filters(text: Column) -> Column:
    """A URL hash like #cat=a,b&type=c as a map of lists."""
    pairs = F.filter(F.split(F.regexp_replace(text, "^#", ""), "&"), lambda p: F.instr(p, "=") > 1)
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1), F.split(F.url_decode(F.regexp_replace(p, "^[^=]*=", "")), ","))))
