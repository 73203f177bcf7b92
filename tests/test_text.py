import pytest
from pyspark.sql import functions as F

from accordant.functions import text


@pytest.fixture(scope="module")
def names(spark):
    def run(*values):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, account_name string")
        return text.normalise(rows).orderBy("i").collect()

    return run


@pytest.mark.parametrize("name", ["20-20 Plumbing & Heating, Inc.", "20/20 Plumbing & Heating, Inc.", "20 20 Plumbing & Heating, Inc."])
def test_base_and_suffix(names, name):
    (r,) = names(name)
    assert (r.name_base, r.suffix_class, r.name_core) == ("20 20 plumbing and heating inc", "INC", "20 20 plumbing and heating")


def test_suffix_classes(names):
    got = [(r.suffix_class, r.name_core) for r in names("Acme Inc", "Acme Inc.", "Acme Incorporated", "Acme LLC", "Acme Company", "Acme Corporation", "Acme Limited Liability Company", "Inc", "Acme L.L.C.")]
    assert got == [("INC", "acme")] * 3 + [("LLC", "acme"), ("CO", "acme"), ("CORP", "acme"), ("LLC", "acme"), ("INC", ""), ("NONE", "acme l l c")]


def test_odd_names(names):
    got = names("Company@123.com", "100-200 Company", "A1-B2-C3", None, "", "A", "a ( b")
    assert [r.name_base for r in got] == ["company at 123 com", "100 200 company", "a1 b2 c3", None, "", "a", "a  b"]
    assert got[3].name_core is None and got[4].name_core == "" and got[4].suffix_class == "NONE"


def test_aliases(names):
    a, b, c, d = names("(1)Don Roberto Jewelers; (2) BYD Auto", "BMW of Ontario (Penske Auto Group Ontario B1)", "Acme Corp (Delaware)", "Test Company (paystub)")
    assert [(x.alias, x.source) for x in a.aliases] == [("Don Roberto Jewelers", "semicolon"), ("BYD Auto", "semicolon")]
    assert [(x.alias, x.source) for x in b.aliases] == [("Penske Auto Group Ontario B1", "parentheses")]
    assert c.aliases == [] and d.aliases == []
    assert a.has_multiple_names and not c.has_multiple_names


def test_ids(spark):
    rows = spark.createDataFrame([("001Hs000054S8kI",), ("001HS000054S8KI",), ("",), (None,), ("001Hs000054S8kIIAS",)], "a string")
    assert [r[0] for r in rows.select(text.id_15_to_18("a")).collect()] == ["001Hs000054S8kIIAS", "001HS000054S8KIYA0", "", None, "001Hs000054S8kIIAS"]
    for bad in ("123", "001Hs000054S8k!"):
        with pytest.raises(Exception, match="not a 15 or 18"):
            spark.createDataFrame([(bad,)], "a string").select(text.id_15_to_18("a")).collect()


def test_dates(spark):
    values = ["44197", "2024-01-02", "1/31/2024", "31/01/2024", "2024/01/02", "44197.5", "no", None, "9999999999"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, d string").withColumn("t", F.date_format(text.parse_date("d"), "yyyy-MM-dd HH"))
    assert [r.t for r in rows.orderBy("i").collect()] == ["2021-01-01 00", "2024-01-02 00", "2024-01-31 00", "2024-01-31 00", "2024-01-02 00", "2021-01-01 12", None, None, None]


def test_keys(spark):
    rows = spark.createDataFrame([(0, "  Walmart  "), (1, "Walmart    Inc    Corp"), (2, "   "), (3, None)], "i int, n string")
    assert [r[0] for r in rows.orderBy("i").select(text.raw_exact_key("n")).collect()] == ["Walmart", "Walmart Inc Corp", "", ""]
