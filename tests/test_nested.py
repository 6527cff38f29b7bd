"""XML and list text."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendloom.operators import jsontab, xmltab


def struct(**fields):
    return T.StructType([T.StructField(k, v or T.StringType()) for k, v in fields.items()])


def test_named_values(spark):
    entry = '<data name="{}">{}</data>'.format
    rows = [
        (1, '<?xml version="1.0"?><loan_request>' + entry("a", "1 & 2") + entry("b", "x") + entry("a", "9") + "</loan_request>"),
        (2, None), (3, "<loan_request><data"), (4, "<other>" + entry("a", "1") + "</other>"),
        (5, "<loan_request>" + entry("a", "5") + "</loan_request><loan_request>" + entry("b", "6") + "</loan_request>"),
    ]
    df = spark.createDataFrame(rows, "id int, x string")
    found = sorted((r["id"], r["a"], r["b"]) for r in xmltab.named_values(df, "x", ["a", "b"]).collect() if r["id"] != 5)
    assert found == [(1, "1  2", "x"), (2, None, None), (3, None, None), (4, None, None)]
    assert {(r["a"], r["b"]) for r in xmltab.named_values(df, "x", ["a", "b"]).where("id = 5").collect()} == {("5", None), (None, "6")}


def test_flatten_skips_root_children_and_carries_nothing_over(spark):
    deep = struct(four=struct(five=struct(six=None)))
    schema = struct(top=None, info=struct(f1=None, sub=struct(g=None)), more=struct(f1=None), d=struct(two=struct(three=deep)))
    rows = [
        (1, "<r><top>t</top><info><f1>a</f1><f1>b</f1><sub><g>1</g></sub></info><more><f1>c</f1></more></r>"),
        (2, "<r><info><f1>x</f1></info></r>"), (3, "<r/>"), (4, "bad<"), (5, None),
    ]
    df = xmltab.flatten_xml(spark.createDataFrame(rows, "id int, x string"), "x", schema, ["id"])
    assert df.columns == ["id", "f1", "g"]
    assert sorted((r["id"], r["f1"], r["g"]) for r in df.collect()) == [(1, "c", "1"), (2, "x", None), (3, None, None), (4, None, None), (5, None, None)]


JOB = '{{"EmploymentStatus":"{}","CurrDateAsOf":"{}","PaymentFrequency":"{}","PeriodPaymentInfo":"{}","PeriodIncome":"{}"}}'.format
TAIL = ', {"a": 1}, {"b": None}]'


def rollup(spark, text):
    df = spark.createDataFrame([(text,)], "r string")
    row = jsontab.add_monthly_income(jsontab.employment_rollup(df, "r")).first()
    return row and (row["employer_count"], row["active_count"], row["pay_frequency"], row["period_income"], row["monthly_income"])


def test_latest_active_by_text_order(spark):
    text = "[" + JOB("Active", "9/1/2020", "W", "Weekly", "12") + "," + JOB("Active", "10/1/2020", "M", "Monthly", "99") + TAIL
    assert rollup(spark, text) == (2, 2, "W", "12", 52.0)


def test_tie_takes_the_first(spark):
    text = "[" + JOB("Active", "9/1/2020", "W", "Weekly", "12") + "," + JOB("Active", "9/1/2020", "M", "Monthly", "99") + TAIL
    assert rollup(spark, text)[2] == "W"


def test_none_active_and_missing_keys(spark):
    assert rollup(spark, "[" + JOB("Inactive", "9/1/2020", "W", "Weekly", "12") + TAIL) == (1, 0, "N/A", "0", 0.0)
    assert rollup(spark, "[{'EmploymentStatus': 'Active', 'CurrDateAsOf': '1/1/2020'}" + TAIL) == (1, 1, "N/A", "0", 0.0)
    assert rollup(spark, "no list") is None


def test_truncated_lists_lose_two_real_employers(spark):
    jobs = [JOB("Active", "1/1/2020", "W", "Weekly", "12")] * 3
    for glue in (",", ", "):
        assert rollup(spark, "[" + glue.join(jobs) + glue + '{"Empl')[:2] == (1, 1)


def test_repair_keeps_closed_lists(spark):
    df = spark.createDataFrame([("[1]",), ("[{a},{b",), ("[{a}, {b",), ("nothing",)], "t string")
    assert [r[0] for r in df.select(jsontab.close_truncated(F.col("t"))).collect()] == ["[1]", "[{a}]", "[{a}]", None]


def test_open_flattening(spark):
    """Tags that no schema names: attributes, mixed text, repeats, sections, malformed and empty documents."""
    docs = [
        (1, '<?xml version="1.0"?><root><a><b>1</b><c at="z">two</c><b>3</b></a><d>top</d><e><f><g>deep</g></f></e></root>'),
        (2, "<root><a><b> 5 </b></a><e><h/></e></root>"), (3, None), (4, "<bad"), (5, "<root>t</root>"), (6, "<root><a>x<b>1</b>y</a><a><b>9</b><k>true</k></a></root>"),
        (7, "<root><a><b>1</root>"), (8, ""), (9, "plain"), (10, '<root><a><n:z xmlns:n="u">007</n:z><w>1.50</w><id>5</id></a></root>'),
        (11, "<root><a><c>t<cc>1</cc></c></a><z><y><x><w><v><u>too deep</u></v></w></x></y></z></root>"), (12, "<root><last><only>&lt;here&gt;</only></last></root>"),
    ]
    df = spark.createDataFrame(docs, "id int, t string").repartition(5)
    rows = {r["id"]: r.asDict() for r in xmltab.flatten_open(df, "t", ["id"]).collect()}
    assert list(rows[1]) == ["id", "b", "c", "cc", "g", "h", "id_xml", "k", "n:z", "only", "w"]
    filled = {i: {k: v for k, v in r.items() if k != "id" and v is not None} for i, r in rows.items()}
    assert filled == {
        1: {"b": "3", "c": "two", "g": "deep"}, 2: {"b": "5", "h": ""}, 3: {}, 4: {}, 5: {}, 6: {"b": "9", "k": "true"}, 7: {}, 8: {}, 9: {},
        10: {"id_xml": "5", "n:z": "007", "w": "1.50"}, 11: {"c": "t", "cc": "1"}, 12: {"only": "<here>"},
    }
    paths = {tuple(r["path"]): r["n"] for r in xmltab.discover_paths(df, "t").collect()}
    assert paths[("a", "b")] == 5 and ("d",) in paths and not any(len(p) > 5 for p in paths)


def test_open_flattening_of_nothing_and_limits(spark):
    none = spark.createDataFrame([], "id int, t string")
    assert xmltab.flatten_open(none, "t", ["id"]).columns == ["id"]
    some = spark.createDataFrame([(1, "<r><a><b>1</b><B>2</B></a></r>"), (2, "<r><a><B>7</B><c/></a></r>")], "id int, t string")
    assert sorted(tuple(r) for r in xmltab.flatten_open(some, "t", ["id"]).collect()) == [(1, "2", None), (2, "7", "")]
    with pytest.raises(ValueError, match="more than"):
        xmltab.flatten_open(some, "t", ["id"], most_tags=1)
