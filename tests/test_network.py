import datetime
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lectern.functions import headers
from lectern.operators import network
from lectern.plans.queries import QUERIES


def test_author_and_date(spark):
    texts = {
        "by": "Poems BY Ann\nLee Jr., of 12345 places",
        "header": "Author: José Ñ. Ruiz  - x July 4, 1888",
        "baby": "baby x; Author: Someone Else",
        "blank": "stand by \t- Author: Hidden 2000",
        "none": "Nothing here",
        "written": "written by Cy Twain!",
    }
    frame = spark.createDataFrame(list(texts.items()), "file_name string, text string")
    got = {r.file_name: (r.author, r.release_date) for r in network.author_date(frame).collect()}
    assert got == {
        "by": ("Ann\nLee Jr.", "1234"),
        "header": ("José Ñ. Ruiz", "1888"),
        "baby": ("x", "Unknown"),
        "blank": ("Unknown", "2000"),
        "none": ("Unknown", "Unknown"),
        "written": ("Cy Twain", "Unknown"),
    }


def test_dates(spark):
    books = [
        ("a", "July 4, 1999"), ("a", "7/4/1999"), ("a", "1999-07-04"), ("a", "1999-7-4"), ("b", "1999"),
        ("b", "0000"), ("c", "Unknown"), ("c", "February 30, 1999"), ("c", "12345"), ("c", "13/1/1999"),
        ("Unknown", "1999"), ("c", "Juli 4, 1999"),
    ]
    frame = spark.createDataFrame(books, "author string, release_date string")
    assert sorted(tuple(r) for r in network.author_dates(frame).collect()) == [
        ("a", datetime.date(1999, 7, 4)), ("b", datetime.date(1999, 1, 1))
    ]


@pytest.fixture(scope="module")
def dated():
    chance = random.Random(3)
    rows = {
        (f"a{chance.randrange(9)}", datetime.date(chance.randrange(1900, 1912), chance.randrange(1, 13), 1))
        for _ in range(120)
    }
    return sorted(rows | {("first", datetime.date(1896, 1, 1)), ("last", datetime.date(1915, 1, 1))})


@pytest.fixture(scope="module")
def dates(spark, dated):
    return spark.createDataFrame(dated, "author string, date date").repartition(4)


@pytest.fixture(scope="module")
def brute(dated):
    return Counter(
        (a, b, d2.year - d1.year)
        for a, d1 in dated
        for b, d2 in dated
        if a != b and 1 <= d2.year - d1.year <= 5
    )


def counted(edges):
    rows = edges.collect()
    assert len({(r.influencer, r.influenced, r.later_year, r.year_difference) for r in rows}) == len(rows)
    found = Counter()
    for r in rows:
        found[r.influencer, r.influenced, r.year_difference] += r.edges
    return found


@pytest.mark.parametrize("authors_per_salt", [1000, 2])
def test_edges_equal_brute_force(dates, brute, authors_per_salt):
    assert counted(network.influence_edges(dates, authors_per_salt=authors_per_salt)) == brute


def test_classes_and_members_hold_all_edges(dates, dated, brute):
    classes, members = network.influence_classes(dates).persist(), network.influence_members(dates).persist()
    assert counted(network.edges_of_classes(classes, members)) == brute
    assert sum(r.edges for r in classes.collect()) == sum(brute.values())
    rows = members.collect()
    assert len(rows) == len({(a, d.year) for a, d in dated})
    links = Counter()
    for a, b, y1, y2 in {(a, b, d1.year, d2.year) for a, d1 in dated for b, d2 in dated if a != b and 1 <= d2.year - d1.year <= 5}:
        links[a, y1, "out"] += 1
        links[b, y2, "in"] += 1
    assert all((r.out_links, r.in_links) == (links[r.author, r.year, "out"], links[r.author, r.year, "in"]) for r in rows)
    assert sum(r.out_links for r in rows) == sum(r.pairs for r in classes.collect())


def test_edges_of_some_authors(spark, dates, brute):
    classes, members = network.influence_classes(dates), network.influence_members(dates)
    some = spark.createDataFrame([("a1",), ("first",), ("nobody",), ("a1",)], "author string")
    got = counted(network.edges_of_classes(classes, members, some))
    assert got == Counter({edge: n for edge, n in brute.items() if {"a1", "first"} & set(edge[:2])})


def test_classes_do_not_grow_with_the_authors(spark):
    rows = [(f"c{i}", datetime.date(1950 + i % 4, 1, 1 + i % 2)) for i in range(4000)]
    frame = spark.createDataFrame(rows, "author string, date date")
    classes = network.influence_classes(frame, 2).collect()
    assert {(r.earlier_year, r.later_year, r.pairs, r.edges) for r in classes} == {
        (1950 + y, 1950 + y + gap, 10**6, 10**6) for y in range(4) for gap in (1, 2) if y + gap < 4
    }
    assert network.influence_members(frame).count() == 4000


def test_threshold(dates, brute):
    edges = network.influence_edges(dates, years_threshold=2)
    assert counted(edges) == Counter({edge: n for edge, n in brute.items() if edge[2] <= 2})


def test_a_crowded_year_costs_its_own_neighbours_only(spark):
    rows = [(f"c{i}", datetime.date(1950, 1, 1)) for i in range(60)]
    rows += [(f"q{year}{i}", datetime.date(year, 1, 1)) for year in range(1900, 1931) for i in range(3)]
    rows += [("near", datetime.date(1952, 1, 1))]
    years = network._active_years(spark.createDataFrame(rows, "author string, date date"))
    earlier, later = network._split_sides(years, 5, 10)
    first = Counter(r.influencer for r in earlier.collect())
    second = Counter(r.influenced for r in later.collect())
    # A quiet author is copied once for each year in reach that has authors, and no more.
    assert first["q19001"] == 5 and second["q19251"] == 5 and second["q19001"] == 0
    # The neighbour of the crowded year meets each of its six parts; their members meet it once.
    assert second["near"] == 6 and first["c1"] == 1
    parts = Counter((r.later_year, r.year_difference, r.salt1, r.salt2) for r in earlier.collect())
    assert max(parts.values()) < 30
    want = Counter((f"c{i}", "near", 2) for i in range(60))
    got = counted(network.influence_edges(spark.createDataFrame(rows, "author string, date date"), authors_per_salt=10))
    assert {edge: n for edge, n in got.items() if edge[1] == "near"} == want


def test_gaps_need_no_edges(dates):
    direct = network.author_gaps(dates)
    counted = network.gaps_of_edges(network.influence_edges(dates))
    key = ["author", "year_difference", "out_edges", "in_edges"]
    assert sorted(direct.select(key).collect()) == sorted(counted.select(key).collect())


def test_stats_equal_pandas(dates, brute):
    edges = pd.DataFrame(list(brute.elements()), columns=["influencer", "influenced", "years"])
    gaps = network.author_gaps(dates)

    for name, ours in [
        ("influencer", network.influencer_stats(gaps, 4)), ("influenced", network.influenced_stats(gaps, 4))
    ]:
        theirs = edges.groupby(name)["years"].agg(["count", "mean", "min", "max"]).reset_index()
        theirs = theirs.sort_values(["count", name], ascending=[False, True]).head(4).round(2)
        assert [tuple(r) for r in ours.collect()] == [tuple(r) for r in theirs.itertuples(index=False)]

    years = edges["years"]
    assert tuple(network.year_gap_stats(gaps).first()) == pytest.approx((years.mean(), years.min(), years.max()))
    authors = len(set(edges["influencer"]) | set(edges["influenced"]))
    assert tuple(network.network_summary(gaps).first()) == pytest.approx((authors, *years.describe()))

    degrees = network.degree_metrics(gaps)
    rows = {r.author: r for r in degrees.collect()}
    assert rows["first"].in_degree == 0 and rows["first"].out_degree > 0
    assert rows["last"].out_degree == 0 and rows["last"].in_degree > 0
    assert sum(r.in_degree for r in rows.values()) == sum(r.out_degree for r in rows.values()) == len(edges)
    incoming, outgoing = edges["influenced"].value_counts(), edges["influencer"].value_counts()
    assert {a: (r.in_degree, r.out_degree) for a, r in rows.items()} == {
        a: (incoming.get(a, 0), outgoing.get(a, 0)) for a in rows
    }
    top = [r.author for r in network.degree_top_total(degrees, 3).collect()]
    assert top == sorted(rows, key=lambda a: (-rows[a].total_degree, a))[:3]
    assert network.degree_top_in(degrees, 1).first().in_degree == incoming.max()
    assert network.degree_top_out(degrees, 1).first().out_degree == outgoing.max()
    stats = network.degree_stats(degrees).first()
    assert stats.avg_in_degree == pytest.approx(len(edges) / len(rows))
    assert (stats.max_in_degree, stats.max_out_degree) == (incoming.max(), outgoing.max())


def test_no_dates_make_no_network(spark):
    none = spark.createDataFrame([], "author string, date date")
    assert network.influence_edges(none).isEmpty()
    assert network.influence_classes(none).isEmpty() and network.influence_members(none).isEmpty()
    summary = network.network_summary(network.author_gaps(none)).first()
    assert (summary.unique_authors, summary["count"], summary["mean"]) == (0, 0, None)


def test_parse_date_never_fails(spark):
    texts = ["", "99999", "x 1, 2000", "1/1/20000", "2000-1-1-1", None, "٢٠٠٠"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert frame.select(headers.parse_date(F.col("t")).alias("d")).where("d IS NOT NULL").isEmpty()


def test_the_query_makes_every_edge(spark, sf_dir):
    """One row per pair of authors and years, as many as the classes count."""
    edges = QUERIES["influence_edges"](spark, sf_dir)
    assert edges.columns == ["influencer", "influenced", "later_year", "year_difference", "edges"]
    made = edges.agg(F.count("*").alias("pairs"), F.sum("edges").alias("edges")).first()
    counted = QUERIES["influence_classes"](spark, sf_dir).agg(F.sum("pairs").alias("pairs"), F.sum("edges").alias("edges")).first()
    assert made == counted and made.pairs > 1000


def test_edges_are_spread_over_tasks(spark, monkeypatch):
    """The sides of the join are small, but what they make is not left to a few tasks."""
    rows = [(f"a{i:03d}", datetime.date(1950 + i % 5, 1, 1)) for i in range(400)]
    frame = spark.createDataFrame(rows, "author string, date date")
    monkeypatch.setattr(network, "EDGES_PER_TASK", 2000)
    edges = network.influence_edges(frame, authors_per_salt=20)
    made = [r["count"] for r in edges.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(made) == 10 * 80 * 80 and len(made) > 15 and max(made) < 0.2 * sum(made)
