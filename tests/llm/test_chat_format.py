import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from tillstream.llm.chat_format import (
    CONTROLS, TEMPLATE, Constant, Escaping, If, Output, Template, TemplateError, format_conversations, parse, read_back, read_turns,
)
from tillstream.llm.queries import PROBE, QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, part STRING"
PIECES = st.lists(st.sampled_from(["\\", "<", "[", "]", "s>", "/INST]", "a", "é", "\n", *CONTROLS]), max_size=12).map("".join)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """What has to come back for each conversation."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        loss = "".join(text for _, _, role, text in sorted(turns) if role == "assistant")
        out[conv] = (len(turns), sha("".join(f"{role}\n{text}\n" for _, _, role, text in sorted(turns))), len(loss), sha(loss))
    return out


def found(df):
    rows = df.collect()
    out = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_against_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)]
    got = QUERIES["op13_chat_format"](spark, SMALL)
    assert found(got) == plain(rows)
    template = Template()
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        convs.setdefault(conv, []).append((role, text))
    chars = {conv: len(template.render(conv, turns)[0]) for conv, turns in convs.items()}
    assert {r["conv_id"]: r["formatted_chars"] for r in got.collect()} == chars


@pytest.mark.parametrize("piece", [1, 60, 10_000])
def test_pieces_and_many_tasks(spark, piece):
    """One conversation holds a third of all rows; conversations lie across tasks and in pieces of any size."""
    draw = random.Random(piece)
    rows = [
        (k if k % 3 else 7, k, draw.choice(["user", "assistant", "tool", None]), draw.choice(["", None, "a[INST]", "é" * 30, "</s>\\", "x"]))
        for k in range(400)
    ] + [(None, None, None, None), (None, 2, "assistant", "b"), (9_999, 5, "user", "u"), (9_999, 5, "user", "u")]
    draw.shuffle(rows)
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = format_conversations(df, piece=piece)
        assert found(read_back(pieces)) == plain(rows)
        longest = pieces.selectExpr("max(length(formatted))").first()[0]
        assert longest <= piece + 100
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_whole_rows_are_what_the_template_renders(spark):
    rows = [(1, 0, "user", "hi <s>"), (1, 1, "assistant", "[/INST] yo"), (2, 0, "assistant", "")]
    out = {r["conv_id"]: r for r in format_conversations(spark.createDataFrame([(*r, "") for r in rows], SCHEMA).coalesce(1)).collect()}
    assert out[1]["formatted"] == "<s>[INST]hi <\\s>[/INST][ASST][\\/INST] yo</s>"
    [span] = out[1]["spans"]
    assert out[1]["formatted"][span["start"]:span["end"]] == "[\\/INST] yo"
    assert out[2]["formatted"] == "<s>[ASST]</s>" and out[2]["spans"][0]["start"] == out[2]["spans"][0]["end"]


def test_empty_table(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "</s>", "a\\b"]), PIECES), max_size=5))
def test_round_trip(turns):
    escaping = Escaping()
    formatted, spans = Template().render(1, turns)
    assert read_turns(formatted, escaping) == turns
    assert "".join(escaping.unescape(formatted[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")
    for _, text in turns:
        assert not escaping.control.search(escaping.escape(text)) and escaping.unescape(escaping.escape(text)) == text


def rendered(source, **message):
    values = {"role": "user", "text": "Hi", **message}
    return Template("{% turn %}" + source).render(7, [(values["role"], values["text"])])[0]


@pytest.mark.parametrize("source, want", [
    ("{{ 'a' ~ 1 ~ none ~ true }}", "a1true"),
    ("{{ message.text | upper ~ conversation.id }}{# no #}", "HI7"),
    ("{% if message.role == 'x' %}1{% elif message.turn == 0 and not false %}2{% else %}3{% endif %}", "2"),
    ("{% if 'H' in message.text %}yes{% endif %}", "yes"),
    ("{{ none | default('d') }}{{ '  t ' | trim }}{{ message.text | length }}", "dt2"),
    ("{{ (message.text == 'Hi' or 1 < 'a') }}{{ 1 < 'a' }}", "truefalse"),
    ("{% if false %}{{ message.text }}{% endif %}-", "-"),
    ("{{ \"it's\" | escape }}", "it's"),
])
def test_language(source, want):
    assert rendered(source) == want


@pytest.mark.parametrize("source", [
    "{{ message }}", "{{ message.__class__ }}", "{{ message.text.upper }}", "{{ open('x') }}", "{{ message.text | eval }}", "{{ 1 + 1 }}",
    "{{ message.text[0] }}", "{% if 1 %}", "{% endif %}", "{% for x in y %}{% endfor %}", "{{ }}", "{{ 'a' | in('b') }}", "{{ ('a' }}",
    "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{% if 1 %}{% else %}{% else %}{% endif %}", "{{ 'a' | escape(1) }}",
])
def test_what_is_outside_the_language_is_refused(source):
    with pytest.raises(TemplateError):
        parse("{% turn %}" + source)
    with pytest.raises(TemplateError):
        parse("{% open %}{{ message.text }}")


def test_constants_are_folded():
    tree = Template("{% turn %}a{{ 'b' ~ 1 }}{% if 1 == 2 %}x{% elif 'q' in 'pq' %}c{% else %}{{ message.text }}{% endif %}{{ '<s>' | escape }}").tree["turn"]
    assert tree == (Output(Constant("ab1c<\\s>")),)
    assert isinstance(Template(TEMPLATE).tree["turn"][0], If)
    assert Template("{% turn %}{{ false or message.text }}{{ true and message.role }}").tree["turn"][0].value.path == "message.text"


def test_control_strings_that_cannot_be_escaped():
    with pytest.raises(ValueError):
        Escaping(("[a]", "x["))
