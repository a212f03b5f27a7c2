import pytest
from pyspark.sql import functions as F

from upcharts.functions.credits import primary_artist

CASES = {
    "A Featuring B": "A",
    "Tyler, The Creator": "Tyler",
    "Earth, Wind & Fire": "Earth",
    "Lil Nas X & Jack": "Lil Nas X",
    "Lil Nas X": "Lil Nas X",
    "J X K With L": "J",
    "A ft. B": "A ft. B",
    "A FEATURING B": "A FEATURING B",
    "A,B": "A,B",
    " & Foo": "",
    "A Feat. B": "A",
    "A feat. B": "A",
    "A FeatX B": "A FeatX B",
    "A x B, C": "A",
    "  padded\t": "padded",
    "A With B": "A",
    "A & B": "A",
    "A\x1fWith\x1fB": "A",
    "\x1cA\x1d": "A",
    "A With B With C": "A",
    "": "",
}


@pytest.mark.parametrize("credit,expected", CASES.items())
def test_lead_artist(spark, credit, expected):
    df = spark.createDataFrame([(credit,)], "artist string")
    assert df.select(primary_artist("artist")).first()[0] == expected


def test_null_credit(spark):
    assert spark.range(1).select(primary_artist(F.lit(None).cast("string"))).first()[0] is None
