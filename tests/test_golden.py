"""Tiny text inputs with answers worked out by hand (FIXTURES.md, part 3)."""

import datetime

import pytest
from pyspark.sql import functions as F

from amity import schemas, sources
from amity.functions import age_years, parse_dob
from amity.operators import people
from amity.plans import programs, questions

AS_OF = datetime.date(2024, 12, 30)

ADJACENCY = """\
0\t1,2,3,4
1\t0,2,3
2\t0,1,3
3\t0,1,2,2
4\t0,5,4
5\t
6
7\t8
8\t7
9\t0\textra
10\t11,12
11\t12
12\t10,11
x\t1
"""

PROFILES = """\
0,Ann,Ash,1 Elm,Dallas,TX,75001,US,ann,01/05/1950
1,Bob,Bay,2 Oak,Plano,TX,75002,US,bob,1/5/1990
2,Cy,Cole,3 Fir,Austin,TX,75003,US,cy,12/31/1980
3,Di,Dow,4 Ash,Waco,TX,75004,US,di,01/01/1981
4,Bob,Eve,5 Yew,Tyler,TX,75005,US,bob2,1/5/1990
5,Flo,Fox,6 Bay,Paris,TX,75006,US,flo
7,Gus,Gray,7 Fig,Bryan,TX,75007,US,gus,01/01/2030
8,Hal,Hill,8 Gum,Allen,TX,75008,US,hal,13/45/1990
"""

REVIEWS = """\
r1::u1::b1::5.0
r2::u2::b1::4.0
r3::u1::b2::3.0
r4::u3::b3::x
r5::u4::b9::5.0
r6::u5
"""

BUSINESSES = """\
b1::1 Main St, Stanford, CA::List(Food)
b2::2 stanford Rd, Palo Alto, CA::List(Bars)
b3::3 Oak, Stanford, CA::List(Gyms)
b1::1 Main St, Stanford, CA::List(Food)
"""

COUNTS = {
    (0, 1): "2, 3",
    (0, 2): "1, 3",
    (0, 3): "1, 2",
    (0, 4): "",
    (1, 2): "0, 3",
    (1, 3): "0, 2",
    (2, 3): "0, 1",
    (4, 5): "",
    (7, 8): "",
    (10, 11): "",
    (10, 12): "11",
    (11, 12): "",
}


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("golden")
    texts = {
        "adjacency": ADJACENCY,
        "profiles": PROFILES,
        "reviews": REVIEWS,
        "businesses": BUSINESSES,
    }
    paths = {}
    for name, text in texts.items():
        path = folder / f"{name}.txt"
        path.write_text(text)
        paths[name] = str(path)
    return paths


@pytest.fixture(scope="module")
def edges(spark, files):
    return sources.read_adjacency(spark, files["adjacency"])


@pytest.fixture(scope="module")
def profiles(spark, files):
    return sources.read_profiles(spark, files["profiles"])


@pytest.fixture(scope="module")
def reviews(spark, files):
    return sources.read_reviews(spark, files["reviews"])


@pytest.fixture(scope="module")
def businesses(spark, files):
    return sources.read_businesses(spark, files["businesses"])


def tuples(df):
    return [tuple(row) for row in df.collect()]


def test_adjacency(edges):
    lists = {
        0: [1, 2, 3, 4],
        1: [0, 2, 3],
        2: [0, 1, 3],
        3: [0, 1, 2],
        4: [0, 5],
        7: [8],
        8: [7],
        10: [11, 12],
        11: [12],
        12: [10, 11],
    }
    assert sorted(tuples(edges)) == [(u, f) for u, fs in lists.items() for f in fs]


def test_adjacency_without_removing_repetitions(spark, files, edges):
    raw = sources.read_adjacency(spark, files["adjacency"], distinct=False)
    assert raw.count() == edges.count() + 1
    assert set(tuples(raw)) == set(tuples(edges))


def test_separators_at_the_end_of_a_line_open_no_field(spark):
    lines = spark.createDataFrame(
        [("1\t2,3,\t",), ("4\t\t5",), ("\t6",), ("7\t\t",)], "value string"
    )
    assert sorted(tuples(sources.parse_adjacency(lines))) == [(1, 2), (1, 3)]


def test_lists(spark, edges):
    pairs = spark.createDataFrame(list(COUNTS) + [(1, 0), (1, 4), (3, 3)], schemas.PAIRS)
    got = {(a, b): ids for a, b, ids in tuples(questions.mutual_friends(edges, pairs))}
    assert got == COUNTS


def test_lists_of_some_pairs(spark, edges):
    pairs = spark.createDataFrame([(12, 10), (2, 3), (0, 7)], schemas.PAIRS)
    got = sorted(tuples(questions.mutual_friends(edges, pairs)))
    assert got == [(2, 3, "0, 1"), (10, 12, "11")]


def test_counts(edges):
    got = {(a, b): n for a, b, n in tuples(questions.mutual_friend_counts(edges))}
    assert got == {p: len(ids.split(", ")) if ids else 0 for p, ids in COUNTS.items()}


def test_top_pairs(edges):
    assert tuples(questions.top_mutual_pairs(edges)) == [
        (0, 1, 2),
        (0, 2, 2),
        (0, 3, 2),
        (1, 2, 2),
        (1, 3, 2),
        (2, 3, 2),
        (10, 12, 1),
        (0, 4, 0),
        (4, 5, 0),
        (7, 8, 0),
    ]


def test_top_pairs_with_profiles(edges, profiles):
    got = tuples(questions.top_mutual_pairs_with_profiles(edges, profiles))
    assert got[0] == (2, "Ann", "Ash", "1 Elm", "Bob", "Bay", "2 Oak")
    assert got[6] == (1,) + (None,) * 6
    assert len(got) == 10


def test_profiles(profiles):
    assert sorted(row.user_id for row in profiles.collect()) == [0, 1, 2, 3, 4, 7, 8]
    assert profiles.schema == schemas.PROFILES


def test_ages(profiles):
    rows = profiles.select("user_id", age_years(profiles.dob, AS_OF)).collect()
    assert dict(rows) == {0: 74, 1: 34, 2: 43, 3: 43, 4: 34, 7: -5, 8: 33}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1/5/1990", (1990, 1, 5)),
        ("01/05/1990", (1990, 1, 5)),
        ("13/45/1990", (1991, 2, 14)),
        ("0/0/1990", (1989, 11, 30)),
        ("2/30/2023", (2023, 3, 2)),
        ("01/05/1990 x", (1990, 1, 5)),
        ("", None),
        ("1990", None),
        ("x1/5/1990", None),
        (None, None),
    ],
)
def test_dates(spark, text, expected):
    df = spark.createDataFrame([(text,)], "d string")
    day = expected and datetime.date(*expected)
    assert tuples(df.select(parse_dob(df.d))) == [(day,)]


def test_one_label_per_edge_with_repeated_profiles(spark, edges, profiles):
    again = profiles.unionByName(profiles.withColumn("first_name", F.lit("Zed")))
    labelled = people.with_friend_profiles(edges, again).collect()
    assert len(labelled) == edges.count()
    labels = {r.friend_id: r.label for r in labelled}
    assert labels[1] == "Zed: 1/5/1990" and labels[11] is None


@pytest.mark.parametrize(
    "a, b, expected",
    [
        (0, 1, "[Cy: 12/31/1980, Di: 01/01/1981]"),
        (2, 0, "[Bob: 1/5/1990, Di: 01/01/1981]"),
        (0, 7, "[]"),
        (1, 4, "[Ann: 01/05/1950]"),
        (10, 12, "[11]"),
    ],
)
def test_mutual_friend_info(edges, profiles, a, b, expected):
    got = tuples(questions.mutual_friend_info(edges, profiles, a, b))
    assert got == [(a, b, expected)]


def test_oldest_friends(edges, profiles):
    got = tuples(questions.oldest_friend_top(edges, profiles, AS_OF))
    assert got[0] == (1, "2 Oak", "Plano", "TX", 74)
    assert [(row[0], row[-1]) for row in got] == [
        (1, 74),
        (2, 74),
        (3, 74),
        (4, 74),
        (0, 43),
        (7, 33),
        (8, 0),
        (10, 0),
        (11, 0),
        (12, 0),
    ]
    assert got[7] == (10, None, None, None, 0)


def test_oldest_friends_today(edges, profiles):
    today = datetime.date.today()
    assert tuples(questions.oldest_friend_top(edges, profiles)) == tuples(
        questions.oldest_friend_top(edges, profiles, today)
    )


def test_a_repeated_profile_gives_one_row(spark, edges, profiles):
    again = profiles.unionByName(profiles).unionByName(profiles)
    assert tuples(questions.top_mutual_pairs_with_profiles(edges, again)) == tuples(
        questions.top_mutual_pairs_with_profiles(edges, profiles)
    )
    assert tuples(questions.oldest_friend_top(edges, again, AS_OF)) == tuples(
        questions.oldest_friend_top(edges, profiles, AS_OF)
    )
    assert tuples(questions.mutual_friend_info(edges, again, 0, 1)) == tuples(
        questions.mutual_friend_info(edges, profiles, 0, 1)
    )


def test_reviewers(reviews, businesses):
    got = sorted(tuples(questions.reviewers_in_place(reviews, businesses, "Stanford")))
    assert got == [("u1", "5.0"), ("u1", "5.0"), ("u2", "4.0"), ("u2", "4.0"), ("u3", "x")]


def test_top_rated(reviews, businesses):
    got = tuples(questions.top_rated_businesses(reviews, businesses))
    assert got == [
        ("b1", "1 Main St, Stanford, CA", "List(Food)", 4.5),
        ("b2", "2 stanford Rd, Palo Alto, CA", "List(Bars)", 3.0),
        ("b3", "3 Oak, Stanford, CA", "List(Gyms)", None),
    ]
    assert tuples(questions.top_rated_businesses(reviews, businesses, k=1)) == []


def lines_of(spark, path):
    return [row.value for row in sources.read_lines(spark, path).collect()]


def test_programs_on_friends(spark, files, tmp_path):
    adjacency, profiles = files["adjacency"], files["profiles"]
    out = lambda name: str(tmp_path / name)

    programs.write_mutual_friends(spark, adjacency, out("q1"))
    assert lines_of(spark, out("q1")) == ["0, 1\t2, 3"]

    programs.write_mutual_friend_counts(spark, adjacency, out("q2"))
    assert sorted(lines_of(spark, out("q2")))[:2] == ["('0, 1', 2)", "('0, 2', 2)"]
    assert len(lines_of(spark, out("q2"))) == 12

    programs.write_top_mutual_pairs(spark, adjacency, out("q3"), k=2)
    assert lines_of(spark, out("q3")) == ["0, 1\t2", "0, 2\t2"]

    programs.write_top_mutual_pairs_with_profiles(spark, adjacency, profiles, out("q4"), k=1)
    assert lines_of(spark, out("q4")) == ["2\tAnn\tAsh\t1 Elm\tBob\tBay\t2 Oak"]

    programs.write_mutual_friend_info(spark, adjacency, profiles, out("q5"), 0, 1)
    assert lines_of(spark, out("q5")) == ["0 1\t[Cy: 12/31/1980, Di: 01/01/1981]"]

    programs.write_oldest_friend_top(spark, adjacency, profiles, out("q6"), AS_OF)
    got = lines_of(spark, out("q6"))
    assert got[0] == "1\t2 Oak, Plano, TX, 74"
    assert got[7] == "10\tnull, 0"


def test_programs_on_reviews(spark, files, tmp_path):
    reviews, businesses = files["reviews"], files["businesses"]
    q7, q8 = str(tmp_path / "q7"), str(tmp_path / "q8")

    programs.write_reviewers_in_place(spark, reviews, businesses, q7, "Stanford")
    back = spark.read.csv(q7, header=True)
    assert back.columns == ["user_id", "stars"]
    assert back.count() == 5

    programs.write_top_rated_businesses(spark, reviews, businesses, q8)
    back = spark.read.csv(q8, header=True)
    assert back.columns == ["business_id", "full_address", "categories", "avg(stars)"]
    assert len(list((tmp_path / "q8").glob("*.csv"))) == 1
    assert sorted(row[0] for row in back.collect()) == ["b1", "b2", "b3"]
