import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import chat
from shelfwise.llm.template import Template, TemplateError, fold_block, parse

PIECES = st.lists(st.sampled_from([*chat.CONTROLS, "<", ">", "[", "]", "/", "\\", "s", "INST", "SYS", "ROLE", " ", "\n", "é"]),
                  max_size=12).map("".join)
ROLES = st.sampled_from(["user", "assistant", "system", "", "tool", "<<ROLE>>", "a\\"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLES, PIECES), max_size=6))
def test_round_trip(turns):
    out = chat.chat_template().render([{"role": r, "text": t} for r, t in turns])
    assert list(chat.read_back(out.text())) == turns
    said = [chat.unescape(out.text()[a:b]) for a, b in out.spans]
    assert "".join(said) == "".join(t for r, t in turns if r == "assistant")


def test_constants_are_folded():
    tree = fold_block(parse("{% if 1 == 2 %}a{% elif true %}b{{ 'c' ~ 4 }}{{ 'x' | up }}{% else %}d{% endif %}e"),
                      {"up": str.upper})
    assert tree == [("text", "bc4Xe")]


def test_language():
    source = "{% for t in turns %}{{ loop.index }}{% if loop.first and not t.b %}!{% endif %}{{ t.a }}{% endfor %}"
    assert Template(source, {}).render([{"a": "x"}, {"a": None, "b": 1}]).text() == "1!x2"


@pytest.mark.parametrize("source", ["{{ turns.__class__ | nope }}", "{% if x %}", "{% while 1 %}", "{{ f(1) }}", "{{ }}",
                                    "{% endfor %}", "{{ 1 2 }}", "{% for x %}{% endfor %}"])
def test_refused(source):
    with pytest.raises(TemplateError):
        Template(source, {})


def test_nothing_of_python_is_reached():
    assert Template("{{ turns.__class__ }}{{ __import__ }}", {}).render([]).text() == ""


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a", 5), (1, 0, "user", "a", 5), (1, None, None, None, 5), (None, 1, "assistant", "x" * 50_000, 5),
            (2, 1, "assistant", "", 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, spans int")
    found = {r.conv_id: r for r in chat.conversation_digests(df).collect()}
    assert {k: r.n_turns for k, r in found.items()} == {1: 3, None: 1, 2: 1}
    assert found[None].loss_chars == 50_000 and found[2].loss_chars == 0
    assert chat.conversation_digests(df.limit(0)).count() == 0
    long = spark.range(300).selectExpr("7 as conv_id", "id as turn", "'user' as role", "string(id) as text")
    assert chat.conversation_digests(long).first().n_turns == 300
    parts = chat.format_conversations(long).orderBy("part").collect()
    assert [r.part for r in parts] == [0, 1, 2, 3, 4]
    read = [t for r in parts for _, t in chat.read_back(r.text)]
    assert read == [str(i) for i in range(300)]
