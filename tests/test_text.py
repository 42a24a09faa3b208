import pytest
from pyspark.sql import functions as F

from korrel.functions import similarity as S
from korrel.functions import text as T


def one(spark, f, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"x{i} string" for i in range(len(values))))
    return df.select(f(*(F.col(c) for c in df.columns)).alias("r")).first().r


@pytest.mark.parametrize(
    ("x", "want"),
    [
        (None, ""),
        (" NaN ", ""),
        ("none", ""),
        ("Acme, Inc.", "acme inc"),
        ("A&B", "a and b"),
        ("Café_1 x", "café_1 x"),
        ("\t a \n b ", "a b"),
        ("हिंदी", "ह द"),
        ("...", ""),
    ],
)
def test_clean(spark, x, want):
    assert one(spark, T.clean, x) == want


@pytest.mark.parametrize(
    ("x", "canonical", "root"),
    [
        ("Acme Technologies, Inc.", "acme tech inc", "acme tech"),
        ("Co Ltd", "co ltd", "co ltd"),
        ("Northern Solutions Limited Company Inc", "northern soln ltd co inc", "northern soln"),
        ("Inc Acme", "inc acme", "inc acme"),
        ("zinc", "zinc", "zinc"),
        (None, "", ""),
    ],
)
def test_name(spark, x, canonical, root):
    assert one(spark, T.name, x) == canonical
    assert one(spark, lambda c: T.root(T.name(c)), x) == root


@pytest.mark.parametrize(
    ("x", "want"),
    [
        ("12 North Main Street, Suite 4", "12 n main st ste 4"),
        ("New York, New York", "ny ny"),
        ("1 West Virginia Way", "1 wv way"),
        ("Renew York St", "renew york st"),
        ("5 Oak Avenue, Raleigh North Carolina 27601", "5 oak ave raleigh nc 27601"),
        (None, ""),
    ],
)
def test_address(spark, x, want):
    assert one(spark, T.address, x) == want


def test_numbers_ngrams_words_country(spark):
    assert one(spark, T.numbers, "12_3 A4 56-78") == ["56", "78"]
    assert one(spark, T.numbers, None) == []
    assert one(spark, T.ngrams, "ab") == [" ab", "ab "]
    assert one(spark, T.ngrams, "a") == [" a "]
    assert one(spark, T.ngrams, "") == []
    assert one(spark, T.words, "b a b") == ["b", "a"]
    assert one(spark, T.words, "") == []
    assert one(spark, T.country, "United States") == "us"
    assert one(spark, T.country, "U.S.A.") == "u s a"
    assert one(spark, T.country, "Narnia!") == "narnia"


def test_blocking_family(spark):
    assert one(spark, T.block_name, "Acme Inc & Private Limited Sons") == "acme sons"
    assert one(spark, T.block_name, "NA") == ""
    assert one(spark, T.block_name, "na") == "na"
    assert one(spark, T.block_address, "9 st nr park, Flr 2") == "9 street near park floor 2"
    assert one(spark, T.block_address, None) == ""


@pytest.mark.parametrize("f", [S.edit, S.token_sort, S.token_set])
def test_similarity_properties(spark, f):
    values = ["", "a", "ab c", "c ab", "ab c d d", "héllo wörld", "completely other"]
    rows = [(x, y) for x in values for y in values]
    df = spark.createDataFrame(rows, "x string, y string").select("x", "y", f(F.col("x"), F.col("y")).alias("a"), f(F.col("y"), F.col("x")).alias("b"))
    for r in df.collect():
        assert 0 <= r.a <= 1 and abs(r.a - r.b) < 1e-12
        assert (r.a == 1) if r.x == r.y else True
        assert (r.a == 0) if (r.x == "") != (r.y == "") else True


def test_similarity_values(spark):
    assert one(spark, S.edit, "kitten", "sitting") == pytest.approx(1 - 3 / 7)
    assert one(spark, S.edit, "é", "e") == 0
    assert one(spark, S.token_sort, "b a", "a b") == 1
    assert one(spark, S.token_set, "a b", "a b c") == 1  # the common words are all of one side
    assert one(spark, S.token_set, "a b x", "a b c") == pytest.approx(1 - 1 / 5)
    df = spark.createDataFrame([(["a", "b"], ["b", "c"], [])], "x array<string>, y array<string>, z array<string>")
    assert df.select(S.jaccard(F.col("x"), F.col("y")), S.jaccard(F.col("x"), F.col("z")), S.jaccard(F.col("z"), F.col("z"))).first()[:] == (1 / 3, 0.0, 1.0)
