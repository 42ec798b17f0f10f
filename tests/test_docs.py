import regex
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.functions.text import tokens
from tillstream.operators import docs
from tillstream.operators.records import accepted, rejected
from tillstream.session import scratch_dir
from tillstream.sinks.keyed_table import KeyedTable
from tillstream.sources.lookups import lookup_rows, point_get



def words(text):
    return set(regex.findall(r"\p{Han}|[\p{L}\p{N}--\p{Han}]+", text.lower(), flags=regex.V1))


def test_match_highlight_and_tokens_agree_with_brute_force(spark):
    texts = [
        "blue kettle", "Kettle-blue", "bluebell", "BLUE", "竹林雨后", "雨blue竹", "crème brûlée", "", "7 blue7", "7",
        "(kettle)", "__blue", "y雨", "页 7 页", "kettle\tblue\nlamp",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id BIGINT, name STRING")
    for query in ["kettle BLUE", "雨 lamp", "CRÈME", "7", "后林", "q Y", "lamp.bell", ")", "", "lamp|kettle"]:
        want = sorted(i for i, text in enumerate(texts) if words(text) & words(query))
        hits = docs.doc_match(df, query)
        assert sorted(r["id"] for r in hits.collect()) == want, query
        for row in docs.doc_highlight(df, query).collect():
            assert row["highlight"].replace("<em>", "").replace("</em>", "") == row["name"]
            marked = {m.lower() for m in regex.findall("<em>(.*?)</em>", row["highlight"])}
            assert marked == words(row["name"]) & words(query), (query, row)
    got = {r["name"]: set(r["t"]) for r in df.select("name", tokens(F.col("name")).alias("t")).collect()}
    assert got == {text: words(text) for text in texts}


@settings(max_examples=15, deadline=None)
@given(query=st.text(alphabet="cd 3雨.|", max_size=6))
def test_match_on_any_query(spark, query):
    texts = ["c", "d c", "cd", "雨", "c雨d", "3", "3c", "c3 d", "c.d|雨", ""]
    df = spark.createDataFrame([(t,) for t in texts], "name STRING")
    got = sorted(r["name"] for r in docs.doc_match(df, query).collect())
    assert got == sorted(t for t in texts if words(t) & words(query))


def recipes(spark):
    return spark.createDataFrame([
        (11, "onion soup with bread", 4.0, [(1, "stove")]),
        (12, "番茄牛肉", 4.5, [(2, "铁锅"), (3, "oven")]),
        (13, "番茄汤", 4.5, [(2, "铁锅")]),
        (14, "牛肉面", None, [(2, "铁锅")]),
        (15, "soup", 5.0, [(3, "oven")]),
        (16, "米饭", 4.9, [(2, "铁锅")]),
        (17, "牛", 4.2, None),
    ], schemas.DOCUMENT)


def test_search(spark):
    hits = docs.search(recipes(spark), "牛肉 茄", "铁锅").collect()
    assert [(h["id"], h["highlight"]) for h in hits] == [
        (12, "番<em>茄</em><em>牛</em><em>肉</em>"), (13, "番<em>茄</em>汤"), (14, "<em>牛</em><em>肉</em>面"),
    ]
    assert [h["id"] for h in docs.search(recipes(spark), "牛肉 茄", "铁锅", size=1, start=1).collect()] == [13]


def test_nested_term_is_exact(spark):
    assert docs.doc_term_nested(recipes(spark), "铁").count() == 0
    assert docs.doc_term_nested(recipes(spark), "oven").count() == 2


def test_pages_join_up(spark):
    pages = [[r["id"] for r in docs.doc_top_n(recipes(spark), 3, start).collect()] for start in (0, 3, 6, 9)]
    assert sum(pages, []) == [15, 16, 12, 13, 17, 11, 14] and pages[3] == []


def test_point_get_and_lookup(spark, rows):
    assert rows(point_get(recipes(spark), 12), "name") == [("番茄牛肉",)]
    assert point_get(recipes(spark), 44).count() == 0
    found = lookup_rows(spark, "SELECT id, name, doubanScore FROM {m} WHERE id IN (15, 14)", m=recipes(spark))
    assert rows(found) == [('{"id":14,"name":"牛肉面"}',), ('{"id":15,"name":"soup","doubanScore":5.0}',)]


def test_single_documents_are_put_and_fetched(spark, records, rows):
    index = KeyedTable(scratch_dir(spark, "recipes"), schemas.DOCUMENT, ("id",))
    as_text = '{"name": "plum cake", "id": "21", "actorList": [{"name": "oven", "id": 3}], "doubanScore": 3.5}'
    parsed = docs.parse_documents(records(as_text, "{bad", '{"name": "x"}', as_text + ' {"id": 22}'))
    assert rows(rejected(parsed), "offset", "reason") == [(1, "bad_json"), (2, "missing:id"), (3, "bad_json")]
    index.upsert(accepted(parsed), 0)
    as_object = spark.createDataFrame([(23, "番茄", 4.0, [(2, "铁锅")])], schemas.DOCUMENT)
    index.upsert(as_object, 1)
    assert rows(point_get(index.read(spark), 21), "name", "doubanScore") == [("plum cake", 3.5)]
    assert point_get(index.read(spark), 21).head()["actorList"] == [(3, "oven")]
    assert [h["id"] for h in docs.search(index.read(spark), "番", "铁锅").collect()] == [23]
