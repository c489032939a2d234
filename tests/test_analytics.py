from rateflow.operators import analytics as A

# Fixed expected values over the fixed input rows in tests/fixtures.
YEAR_COUNTS = [
    (1996, 4), (1997, 4), (1998, 1), (1999, 7), (2000, 7), (2001, 7), (2002, 10), (2003, 11),
    (2004, 11), (2005, 12), (2006, 12), (2007, 11), (2008, 12), (2009, 12), (2010, 13),
    (2011, 11), (2012, 13), (2013, 12), (2014, 13), (2015, 14), (2016, 15), (2017, 16), (2018, 17),
]

# Fixed expected values over the fixed input rows in tests/fixtures.
TOP_TITLE = {
    1996: "Toy Story (1995)",
    1997: "Star Wars: Episode VI - Return of the Jedi (1983)",
    1998: "Star Wars: Episode V - The Empire Strikes Back (1980)",
    1999: "Star Wars: Episode I - The Phantom Menace (1999)",
    2000: "Star Wars: Episode IV - A New Hope (1977)",
    2001: "Star Wars: Episode V - The Empire Strikes Back (1980)",
    2002: "Lord of the Rings: The Fellowship of the Ring, The (2001)",
    2003: "Lord of the Rings: The Two Towers, The (2002)",
    2004: "Lord of the Rings: The Return of the King, The (2003)",
    2005: "Star Wars: Episode III - Revenge of the Sith (2005)",
    2006: "Lord of the Rings: The Return of the King, The (2003)",
    2007: "Star Wars: Episode V - The Empire Strikes Back (1980)",
    2008: "Lord of the Rings: The Return of the King, The (2003)",
    2009: "Star Wars: Episode I - The Phantom Menace (1999)",
    2010: "Avatar (2009)",
    2011: "Toy Story 3 (2010)",
    2012: "Lord of the Rings: The Return of the King, The (2003)",
    2013: "Avatar (2009)",
    2014: "Toy Story 3 (2010)",
    2015: "Lord of the Rings: The Return of the King, The (2003)",
    2016: "Star Wars: Episode VII - The Force Awakens (2015)",
    2017: "Star Wars: Episode IV - A New Hope (1977)",
    2018: "Lord of the Rings: The Return of the King, The (2003)",
}

SW = ["Action", "Adventure", "Sci-Fi"]
LOTR3 = ["Action", "Adventure", "Drama", "Fantasy"]
# Fixed expected values over the fixed input rows in tests/fixtures.
TOP_TAGS = {
    1996: ["Adventure", "Animation", "Children", "Comedy", "Fantasy"],
    1997: SW, 1998: SW, 1999: SW, 2000: SW, 2001: SW,
    2002: ["Adventure", "Fantasy"], 2003: ["Adventure", "Fantasy"],
    2004: LOTR3, 2005: SW, 2006: LOTR3, 2007: SW, 2008: LOTR3, 2009: SW,
    2010: ["Action", "Adventure", "Sci-Fi", "IMAX"],
    2011: ["Adventure", "Animation", "Children", "Comedy", "Fantasy", "IMAX"],
    2012: LOTR3, 2013: ["Action", "Adventure", "Sci-Fi", "IMAX"],
    2014: ["Adventure", "Animation", "Children", "Comedy", "Fantasy", "IMAX"],
    2015: LOTR3, 2016: ["Action", "Adventure", "Fantasy", "Sci-Fi", "IMAX"],
    2017: SW, 2018: LOTR3,
}

IMAX = ["Avatar (2009)", "Star Wars: Episode II - Attack of the Clones (2002)",
        "Star Wars: Episode VII - The Force Awakens (2015)", "Toy Story 3 (2010)"]


def test_items_rated_per_year(ratings):
    got = sorted((r.year, r.n_items) for r in A.items_rated_per_year(ratings).collect())
    assert got == YEAR_COUNTS


def test_top_item_per_year(ratings, items):
    got = {r.year: r.title for r in A.top_item_per_year(ratings, items).collect()}
    assert got == TOP_TITLE


def test_top_tags_per_year(ratings, items):
    got = {r.year: r.tags for r in A.top_tags_per_year(ratings, items).collect()}
    assert got == TOP_TAGS


def test_least_most_tag(ratings, items):
    r = A.least_most_tag(ratings, items).collect()[0]
    assert (r.least_tag, r.least_years) == ("Animation", 3)
    assert (r.most_tag, r.most_years) == ("Adventure", 23)


def test_tag_filters(items):
    assert sorted(r.title for r in A.items_with_all_tags(items, ["IMAX"]).collect()) == IMAX
    assert sorted(r.title for r in A.items_with_any_tag(items, ["IMAX"]).collect()) == IMAX
    # ALL vs ANY differ on several tags
    both = A.items_with_all_tags(items, ["IMAX", "Comedy"]).collect()
    either = A.items_with_any_tag(items, ["IMAX", "Comedy"]).collect()
    assert [r.title for r in both] == ["Toy Story 3 (2010)"]
    assert len(either) == 6
    assert A.items_with_all_tags(items, []).count() == 17
    assert A.items_with_any_tag(items, []).count() == 0


def test_tie_goes_to_largest_id_and_orphans_drop(spark):
    items = spark.createDataFrame([(1, "a", ["x"]), (2, "b", ["y"])], "item_id long, title string, tags array<string>")
    # 2020: item 1 and 2 tie with 1 rating each; item 9 (no item row) has 3 ratings.
    ts = 1600000000
    ratings = spark.createDataFrame(
        [(1, 1, None, 3.0, ts), (2, 2, None, 3.0, ts)] + [(u, 9, None, 1.0, ts) for u in range(3)],
        "user_id long, item_id long, old_rating double, rating double, ts long")
    r = A.top_item_per_year(ratings, items).collect()
    assert [(x.year, x.item_id, x.title) for x in r] == [(2020, 2, "b")]
    # the year count has no join, so the orphan counts
    assert A.items_rated_per_year(ratings).collect()[0].n_items == 3


def test_year_boundary_utc(spark):
    items = spark.createDataFrame([(1, "a", ["x"])], "item_id long, title string, tags array<string>")
    # 1999-12-31T23:59:59Z and 2000-01-01T00:00:00Z
    ratings = spark.createDataFrame([(1, 1, None, 3.0, 946684799), (2, 1, None, 3.0, 946684800)],
                                    "user_id long, item_id long, old_rating double, rating double, ts long")
    got = sorted((r.year, r.n_items) for r in A.items_rated_per_year(ratings).collect())
    assert got == [(1999, 1), (2000, 1)]


def test_duplicate_item_ids_resolve_deterministically(spark):
    items = spark.createDataFrame([(1, "b", ["y"]), (1, "a", ["x"])], "item_id long, title string, tags array<string>")
    assert [tuple(r) for r in A.dedup_items(items).collect()] == [(1, "a", ["x"])]


def test_least_most_tie_rule(spark):
    """Least: fewest years, then the lexicographically first tag. Most: most years, then
    the lexicographically last tag (the original's code, not its docstring)."""
    # one rating per year; year y's only item carries tags of that item
    items = spark.createDataFrame([(1, "a", ["b", "c"]), (2, "b", ["a", "d"])],
                                  "item_id long, title string, tags array<string>")
    ratings = spark.createDataFrame([(1, 1, None, 3.0, 0), (1, 2, None, 3.0, 400000000)],
                                    "user_id long, item_id long, old_rating double, rating double, ts long")
    r = A.least_most_tag(ratings, items).collect()[0]
    assert (r.least_tag, r.least_years) == ("a", 1)
    assert (r.most_tag, r.most_years) == ("d", 1)
