"""Authors, their dates, and the influence network between them.

An edge runs from an author to another one whose date is one to ``years_threshold`` years
later. There is one edge for each such pair of dates. Edges per pair of authors grow with the square of
the authors, so the network is kept as classes: authors with the same number of dates in a year are
alike, and two classes within reach are linked author by author, all to all. ``influence_classes`` has a
row per pair of classes, ``influence_members`` one per author and year; ``edges_of_classes`` makes the
edges from them, of all authors or of some. The statistics need just the number of edges per author and
gap, which ``author_gaps`` works out from dates counted per year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import headers
from lectern.sources.scratch import written
from lectern.sources.text import megabytes

YEARS_THRESHOLD = 5

# Authors of one year that one part of the edge join takes, on either side.
AUTHORS_PER_SALT = 1000

# Edges that a task makes, about, unless there would be more tasks than this.
EDGES_PER_TASK = 4_000_000
MOST_TASKS = 20_000


def author_date(documents: DataFrame, text: str = "text") -> DataFrame:
    """The book record ``(file_name, author, release_date, size_mb)``, ``Unknown`` where absent.

    The size is that of the text, or of the file where ``documents`` has ``size_bytes``.
    """
    known = "size_bytes" in documents.columns
    size = F.col("size_bytes") if known else F.octet_length(F.col(text))
    cues = [match.alias(f"cue{i}") for i, match in enumerate(headers.cue_matches(F.col(text)))]
    found = F.struct(*cues, headers.first_date(F.col(text)).alias("found_date"))
    # A generator's output stays put: the optimizer would copy the patterns, which run over
    # whole texts, into each place that reads a match and into each filter on the result.
    matched = documents.select(
        "file_name", megabytes(size).alias("size_mb"), F.inline_outer(F.array(found))
    )
    return matched.select(
        "file_name",
        headers.author([F.col(f"cue{i}") for i in range(len(cues))]).alias("author"),
        headers.or_unknown(F.col("found_date")).alias("release_date"),
        "size_mb",
    )


def author_dates(books: DataFrame) -> DataFrame:
    """Distinct ``(author, date)`` of the known authors with a date that parses.

    There is no year 0.
    """
    return (
        books.where((F.col("author") != "Unknown") & (F.col("author") != ""))
        .select("author", headers.parse_date(F.col("release_date")).alias("date"))
        .where(F.year("date") >= 1)
        .distinct()
    )


def _active_years(dates: DataFrame) -> DataFrame:
    return dates.groupBy("author", F.year("date").alias("year")).agg(F.count("*").alias("dates"))


def _year_parts(years: DataFrame, authors_per_salt: int) -> DataFrame:
    """``(year, parts)``: how many parts a year's authors make. Fewer than 10,000 rows."""
    # Counting where there are dates, not rows, lets this read the shuffle that the join reads.
    authors = F.count_if(F.col("dates") > 0)
    parts = F.greatest(F.lit(1), F.ceil(authors / authors_per_salt)).cast("int")
    return years.groupBy("year").agg(parts.alias("parts"))


def _split_sides(years: DataFrame, years_threshold: int, authors_per_salt: int) -> tuple[DataFrame, DataFrame]:
    """The sides of the edge join, keyed by ``(later_year, year_difference, salt1, salt2)``.

    Both years are cut into parts of their own size, and each part of the one meets each part of
    the other. An author is copied once per year in reach and part of that year, so that a crowded
    year costs its own neighbours only.
    """
    parts = _year_parts(years, authors_per_salt)
    from_parts = F.broadcast(parts.select(F.col("year").alias("earlier_year"), F.col("parts").alias("parts1")))
    to_parts = F.broadcast(parts.select(F.col("year").alias("later_year"), F.col("parts").alias("parts2")))
    gap = F.explode(F.sequence(F.lit(1), F.lit(years_threshold))).alias("year_difference")

    def met(side: DataFrame) -> DataFrame:
        return side.join(from_parts, "earlier_year").join(to_parts, "later_year")

    def own(name: str, count: str):
        return F.pmod(F.xxhash64(name), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    keys = ["later_year", "year_difference", "salt1", "salt2"]
    earlier = years.select(
        F.col("author").alias("influencer"), F.col("dates").alias("dates1"), F.col("year").alias("earlier_year"), gap
    ).withColumn("later_year", F.col("earlier_year") + F.col("year_difference"))
    later = years.select(
        F.col("author").alias("influenced"), F.col("dates").alias("dates2"), F.col("year").alias("later_year"), gap
    ).withColumn("earlier_year", F.col("later_year") - F.col("year_difference"))
    return (
        met(earlier)
        .withColumn("salt1", own("influencer", "parts1"))
        .withColumn("salt2", every("parts2"))
        .select(*keys, "influencer", "dates1"),
        met(later)
        .withColumn("salt2", own("influenced", "parts2"))
        .withColumn("salt1", every("parts1"))
        .select(*keys, "influenced", "dates2"),
    )


def _pairs(years: DataFrame, years_threshold: int) -> int:
    """How many pairs of author-years are within reach. Years have four digits, so fewer than 10,000 rows reach the driver."""
    authors = dict(years.where("year IS NOT NULL").groupBy("year").agg(F.count("*")).collect())
    return sum(
        count * authors.get(year + gap, 0) for year, count in authors.items() for gap in range(1, years_threshold + 1)
    )


def influence_edges(
    dates: DataFrame,
    years_threshold: int = YEARS_THRESHOLD,
    authors_per_salt: int = AUTHORS_PER_SALT,
) -> DataFrame:
    """``(influencer, influenced, later_year, year_difference, edges)``: how many pairs of dates there are.

    The interval join is an equi-join on the later year and the gap, of one row per author and
    year; nothing is shuffled after it. A year with many authors is cut into parts of
    ``authors_per_salt``, on both sides. The sides are small and the edges many, so the number of tasks
    follows the edges, which are counted first, from the authors per year; the rows per author and year are written for that.
    """
    keys = ["later_year", "year_difference", "salt1", "salt2"]
    years = written(_active_years(dates), "active-years")
    tasks = min(MOST_TASKS, 1 + _pairs(years, years_threshold) // EDGES_PER_TASK)
    earlier, later = (side.repartition(tasks, *keys) for side in _split_sides(years, years_threshold, authors_per_salt))
    return (
        earlier.join(later, keys)
        .where("influencer <> influenced")
        .select(
            "influencer", "influenced", "later_year", "year_difference", (F.col("dates1") * F.col("dates2")).alias("edges")
        )
    )


CLASS = ["earlier_year", "earlier_dates", "later_year", "later_dates"]


def _reach(years: DataFrame, years_threshold: int, name: str, *carried: str) -> DataFrame:
    """Rows ``(earlier_year, year_difference, later_year, ...)``, one for each later year within reach."""
    gaps = F.explode(F.sequence(F.lit(1), F.lit(years_threshold))).alias("year_difference")
    return years.select(*carried, F.col("year").alias("earlier_year"), F.col("dates").alias(name), gaps).withColumn(
        "later_year", F.col("earlier_year") + F.col("year_difference")
    )


def influence_classes(dates: DataFrame, years_threshold: int = YEARS_THRESHOLD) -> DataFrame:
    """``(earlier_year, earlier_dates, later_year, later_dates, year_difference, pairs, edges)``.

    A class is the authors with so many dates in a year. Each author of the earlier class
    influences each other author of the later one; ``pairs`` counts them, without an author's
    own pair, and ``edges`` their pairs of dates. There are at most 366 classes a year, so that
    rows do not grow with the authors. Work is linear in the author-year rows.
    """
    years = _active_years(dates)
    classes = years.groupBy("year", "dates").agg(F.count("*").alias("authors"))
    later = classes.select(
        F.col("year").alias("later_year"), F.col("dates").alias("later_dates"), F.col("authors").alias("later_authors")
    )
    own_later = years.select("author", F.col("year").alias("later_year"), F.col("dates").alias("later_dates"))
    # Authors of both classes, who do not influence themselves.
    own = (
        _reach(years, years_threshold, "earlier_dates", "author")
        .join(own_later, ["author", "later_year"])
        .groupBy(*CLASS)
        .agg(F.count("*").alias("own"))
    )
    return (
        _reach(classes, years_threshold, "earlier_dates", "authors")
        .join(later, "later_year")
        .join(own, CLASS, "left")
        .withColumn("pairs", F.col("authors") * F.col("later_authors") - F.coalesce("own", F.lit(0)))
        .where("pairs > 0")
        .select(
            *CLASS,
            "year_difference",
            "pairs",
            (F.col("pairs") * F.col("earlier_dates") * F.col("later_dates")).alias("edges"),
        )
    )


def influence_members(dates: DataFrame, years_threshold: int = YEARS_THRESHOLD) -> DataFrame:
    """``(author, year, dates, out_links, in_links)``: every author and year with its class and links.

    The class is ``(year, dates)``. A link leads to one other author in one other year within reach. Links are
    counted from the authors per year, of which there are fewer than 10,000 rows.
    """
    years = _active_years(dates)
    per_year = years.groupBy("year").agg(F.count("*").alias("authors"))
    gaps = F.explode(F.array([F.lit(g) for g in range(-years_threshold, years_threshold + 1) if g])).alias("gap")
    reached = years.select("author", "year", "dates", gaps).withColumn("other_year", F.col("year") + F.col("gap"))
    own = years.select("author", F.col("year").alias("other_year"), F.lit(1).alias("own"))
    links = F.coalesce("authors", F.lit(0)) - F.coalesce("own", F.lit(0))
    return (
        reached.join(F.broadcast(per_year.withColumnRenamed("year", "other_year")), "other_year", "left")
        .join(own, ["author", "other_year"], "left")
        .groupBy("author", "year", "dates")
        .agg(
            F.sum(F.when(F.col("gap") > 0, links).otherwise(0)).alias("out_links"),
            F.sum(F.when(F.col("gap") < 0, links).otherwise(0)).alias("in_links"),
        )
    )


def edges_of_classes(classes: DataFrame, members: DataFrame, authors: DataFrame | None = None) -> DataFrame:
    """``influence_edges`` out of classes and members: of all authors, or from and to those in ``authors``.

    Without ``authors`` the answer has a row for every pair; ask for the authors that matter.
    """
    earlier = members.select(
        F.col("author").alias("influencer"), F.col("year").alias("earlier_year"), F.col("dates").alias("earlier_dates")
    )
    later = members.select(
        F.col("author").alias("influenced"), F.col("year").alias("later_year"), F.col("dates").alias("later_dates")
    )

    def linked(earlier: DataFrame, later: DataFrame) -> DataFrame:
        found = classes.join(earlier, ["earlier_year", "earlier_dates"]).join(later, ["later_year", "later_dates"])
        edges = (F.col("earlier_dates") * F.col("later_dates")).alias("edges")
        return found.where("influencer <> influenced").select(
            "influencer", "influenced", "later_year", "year_difference", edges
        )

    if authors is None:
        return linked(earlier, later)
    wanted = authors.select("author").distinct()
    to = later.join(wanted.withColumnRenamed("author", "influenced"), "influenced", "left_semi")
    out = earlier.join(wanted.withColumnRenamed("author", "influencer"), "influencer", "left_semi")
    others = earlier.join(wanted.withColumnRenamed("author", "influencer"), "influencer", "left_anti")
    return linked(out, later).unionByName(linked(others, to))


def author_gaps(dates: DataFrame, years_threshold: int = YEARS_THRESHOLD) -> DataFrame:
    """``(author, year_difference, out_edges, in_edges)`` without making any edge.

    From a date of one year, an author's edges to another year are all dates of that year
    but the author's own. Work is linear in the author-year rows. The dates per year are
    broadcast: years have four digits, so there are fewer than 10,000.
    """
    years = _active_years(dates)
    all_dates = years.groupBy("year").agg(F.sum("dates").alias("all_dates"))
    own = years.select("author", "year", F.col("dates").alias("own_dates"))
    reached = (
        years.withColumn("gap", F.explode(F.sequence(F.lit(-years_threshold), F.lit(years_threshold))))
        .where("gap <> 0")
        .withColumn("year", F.col("year") + F.col("gap"))
    )
    edges = F.col("dates") * (F.col("all_dates") - F.coalesce("own_dates", F.lit(0)))
    return (
        reached.join(F.broadcast(all_dates), "year")
        .join(own, ["author", "year"], "left")
        .groupBy("author", F.abs("gap").alias("year_difference"))
        .agg(
            F.sum(F.when(F.col("gap") > 0, edges).otherwise(0)).alias("out_edges"),
            F.sum(F.when(F.col("gap") < 0, edges).otherwise(0)).alias("in_edges"),
        )
        .where("out_edges > 0 OR in_edges > 0")
    )


def gaps_of_edges(edges: DataFrame) -> DataFrame:
    """The same table from edges that a caller already has."""
    ends = edges.select(
        "year_difference",
        "edges",
        F.inline(
            F.array(
                F.struct(F.col("influencer").alias("author"), F.lit(1).alias("out_end")),
                F.struct(F.col("influenced").alias("author"), F.lit(0).alias("out_end")),
            )
        ),
    )
    return ends.groupBy("author", "year_difference").agg(
        F.sum(F.col("edges") * F.col("out_end")).alias("out_edges"),
        F.sum(F.col("edges") * (1 - F.col("out_end"))).alias("in_edges"),
    )


def influencer_stats(gaps: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` authors with most edges out: count, mean, least and greatest years."""
    return _end_stats(gaps, "out_edges", "influencer", "influence_count", n)


def influenced_stats(gaps: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` authors with most edges in: count, mean, least and greatest years."""
    return _end_stats(gaps, "in_edges", "influenced", "times_influenced", n)


def _end_stats(gaps: DataFrame, edges: str, name: str, count: str, n: int) -> DataFrame:
    return (
        gaps.where(F.col(edges) > 0)
        .groupBy(F.col("author").alias(name))
        .agg(
            F.sum(edges).alias(count),
            F.round(F.sum(F.col(edges) * F.col("year_difference")) / F.sum(edges), 2).alias("avg_years"),
            F.min("year_difference").alias("min_years"),
            F.max("year_difference").alias("max_years"),
        )
        .orderBy(F.desc(count), name)
        .limit(n)
    )


def _edges_per_gap(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("year_difference").agg(F.sum("out_edges").alias("edges")).where("edges > 0")


def year_gap_stats(gaps: DataFrame) -> DataFrame:
    """One row ``(avg_years, min_years, max_years)`` over all edges."""
    return _edges_per_gap(gaps).agg(
        (F.sum(F.col("edges") * F.col("year_difference")) / F.sum("edges")).alias("avg_years"),
        F.min("year_difference").alias("min_years"),
        F.max("year_difference").alias("max_years"),
    )


def network_summary(gaps: DataFrame) -> DataFrame:
    """One row: distinct authors, and the distribution of the edges' year differences.

    The standard deviation is of the sample; quartiles interpolate linearly.
    """
    authors = gaps.agg(F.count_distinct("author")).scalar()
    count, gap = F.sum("edges"), F.col("year_difference")
    weighted = F.col("edges").cast("double") * gap
    total, squares = F.sum(weighted), F.sum(weighted * gap)
    variance = F.try_divide(squares - total * total / count, count - 1)
    return _edges_per_gap(gaps).agg(
        authors.alias("unique_authors"),
        F.coalesce(count, F.lit(0)).alias("count"),
        (total / count).alias("mean"),
        F.sqrt(variance).alias("std"),
        F.min(gap).alias("min"),
        *[
            F.percentile(gap, share, F.col("edges")).alias(name)
            for name, share in [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)]
        ],
        F.max(gap).alias("max"),
    )


def degree_metrics(gaps: DataFrame) -> DataFrame:
    """``(author, in_degree, out_degree, total_degree)``."""
    return (
        gaps.groupBy("author")
        .agg(F.sum("in_edges").alias("in_degree"), F.sum("out_edges").alias("out_degree"))
        .withColumn("total_degree", F.col("in_degree") + F.col("out_degree"))
    )


def degree_top_in(degrees: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` authors of highest in-degree, ties by author."""
    return degrees.select("author", "in_degree").orderBy(F.desc("in_degree"), "author").limit(n)


def degree_top_out(degrees: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` authors of highest out-degree, ties by author."""
    return degrees.select("author", "out_degree").orderBy(F.desc("out_degree"), "author").limit(n)


def degree_top_total(degrees: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` authors of highest total degree, ties by author."""
    return degrees.orderBy(F.desc("total_degree"), "author").limit(n)


def degree_stats(degrees: DataFrame) -> DataFrame:
    """One row: mean and greatest in-degree and out-degree."""
    return degrees.agg(
        F.avg("in_degree").alias("avg_in_degree"),
        F.avg("out_degree").alias("avg_out_degree"),
        F.max("in_degree").alias("max_in_degree"),
        F.max("out_degree").alias("max_out_degree"),
    )
