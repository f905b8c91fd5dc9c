import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import chat_template as C

PIECES = st.lists(st.one_of(st.sampled_from([*C.CONTROLS.strings, "\\", "<", "|", "[", "\n", " "]), st.text(max_size=4)), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), PIECES), PIECES), max_size=5))
def test_round_trip(turns):
    formatted, spans = C.compile_template(C.TEMPLATE, C.CONTROLS)([{"role": r, "text": t} for r, t in turns])
    assert C.read_back(formatted) == turns
    assert C.CONTROLS.unescape("".join(formatted[a:b] for a, b in spans)) == "".join(t for r, t in turns if r == "assistant")


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_escape(text):
    escaped = C.CONTROLS.escape(text)
    assert C.CONTROLS.unescape(escaped) == text
    assert not any(s in escaped for s in C.CONTROLS.strings)


@pytest.mark.parametrize(
    ("template", "wanted"),
    [
        ("{{ 'a' + 'b' }}{# no #}", "ab"),
        ("{% if 1 == 1 and not false %}yes{% else %}no{% endif %}", "yes"),
        ("{% for m in messages %}{{ loop.index }}{{ m.role | upper }}{% if not loop.last %},{% endif %}{% endfor %}", "1USER,2X"),
        ("{% set n = messages | length %}{{ n + 1 }}", "3"),
        ("{{ messages[0]['text'] }}{{ messages[9].text }}{{ nothing.at.all }}", "hi"),
        ("{{ 'a' if 'x' in messages[1].role else 'b' }}", "a"),
        ("{{ messages.__class__ }}{{ messages[0].__len__ }}", ""),
    ],
)
def test_language(template, wanted):
    assert C.compile_template(template, C.CONTROLS)([{"role": "user", "text": "hi"}, {"role": "x", "text": None}])[0] == wanted


@pytest.mark.parametrize("template", ["{% if x %}", "{{ a( }}", "{{ f() }}", "{% nope %}", "{% for x %}{% endfor %}", "{{ a | nofilter }}", "{{ 'a }}"])
def test_errors(template):
    with pytest.raises(C.TemplateError):
        C.compile_template(template, C.CONTROLS)


def test_constants_are_folded():
    tree = C.fold(C.parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}x{% else %}d{% endif %}"), C.CONTROLS)
    assert tree == C.Node("block", (C.Node("text", ("abcd",)),))


def test_spans_mark_generation():
    text, spans = C.compile_template("{% for m in messages %}<{% generation %}{{ m.text }}{% endgeneration %}>{% endfor %}", C.CONTROLS)([{"text": "ab"}, {"text": ""}, {"text": "c"}])
    assert text == "<ab><><c>" and [text[a:b] for a, b in spans] == ["ab", "c"]


def test_table(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 0, "user", None), (None, 0, None, "x"), (2, None, "assistant", "</s>"), (2, 0, "system", "y" * 100_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 as formatted", "2 as spans", "3 as n_turns")
    got = {r["conv_id"]: r for r in C.format_conversations(turns).collect()}
    assert C.read_back(got[1]["formatted"]) == [("user", ""), ("user", ""), ("assistant", "b")] and got[1]["n_turns"] == 3
    assert C.read_back(got[None]["formatted"]) == [("", "x")]
    assert C.read_back(got[2]["formatted"])[0] == ("assistant", "</s>")
    assert C.format_conversations(turns.limit(0)).count() == 0
    assert hashlib.sha256(got[2]["formatted"].encode()).hexdigest()
